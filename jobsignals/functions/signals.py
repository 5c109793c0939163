"""Vocabulary of the five extracted signals and the expressions that check a payload."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignals.functions.text import dedupe_ignoring_case, utrim

# The contract of the extraction record.
SPONSORSHIP_VALUES = ["explicit_yes", "explicit_no", "unspecified"]
REMOTE_VALUES = ["remote", "hybrid", "onsite", "unspecified"]
STATUS_OK, STATUS_ERROR = "ok", "error"
MAX_SKILLS = 20
MIN_YEARS, MAX_YEARS = 0, 40
MIN_DESCRIPTION_LENGTH = 20
MAX_ERROR_LENGTH = 500
SIGNAL_FIELDS = [
    "required_skills",
    "years_experience",
    "sponsorship_signal",
    "local_experience_required",
    "remote_friendly",
]

# Spellings accepted for the work mode.
REMOTE_ALIASES = {
    "fully remote": "remote",
    "full remote": "remote",
    "fully-remote": "remote",
    "fully_remote": "remote",
    "100% remote": "remote",
    "wfh": "remote",
    "work from home": "remote",
    "fully hybrid": "hybrid",
    "hybrid working": "hybrid",
    "hybrid work": "hybrid",
    "on site": "onsite",
    "on-site": "onsite",
    "in office": "onsite",
    "in-office": "onsite",
    "office based": "onsite",
    "office-based": "onsite",
    "in person": "onsite",
    "not specified": "unspecified",
    "unknown": "unspecified",
    "n/a": "unspecified",
    "none": "unspecified",
    "null": "unspecified",
}

# Spellings accepted for the sponsorship signal.
SPONSORSHIP_ALIASES = {
    "yes": "explicit_yes",
    "explicit yes": "explicit_yes",
    "available": "explicit_yes",
    "no": "explicit_no",
    "explicit no": "explicit_no",
    "not available": "explicit_no",
    "not specified": "unspecified",
    "unknown": "unspecified",
    "n/a": "unspecified",
    "none": "unspecified",
    "null": "unspecified",
}

# Texts a lax boolean accepts, in any case and untrimmed.
TRUE_TEXTS = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXTS = ["0", "off", "f", "false", "n", "no"]

_INTEGER_TEXT = r"^[+-]?\d+(_\d+)*(\.0+)?$"


def normalise_alias(column: Column, aliases: dict[str, str]) -> Column:
    """Trim, lower-case and translate known spellings; anything else passes through."""
    key = F.lower(utrim(column))
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
    return F.coalesce(table[key], key)


def _path(field: str) -> str:
    return f"$.{field}"


def probe(parsed: Column) -> dict[str, Column]:
    """What the readers below look at, per field, as columns of their own.

    ``<field>_kind`` is the type name of the field: NULL when it is missing, ``VOID`` for JSON
    null. Kept as columns, each is worked out once per row however often a reader uses it.
    """

    def get(field: str, kind: str) -> Column:
        return F.try_variant_get(parsed, _path(field), kind)

    kinds = {
        f"_{f}_kind": F.schema_of_variant(F.variant_get(parsed, _path(f), "variant"))
        for f in SIGNAL_FIELDS
    }
    return {
        "_root_kind": F.schema_of_variant(parsed),
        **kinds,
        "_skill_items": get("required_skills", "array<variant>"),
        "_skill_texts": get("required_skills", "array<string>"),
        "_years_text": utrim(get("years_experience", "string")),
        "_years_number": get("years_experience", "double"),
        "_flag_text": F.lower(get("local_experience_required", "string")),
        "_flag_number": get("local_experience_required", "double"),
        "_sponsorship_text": get("sponsorship_signal", "string"),
        "_remote_text": get("remote_friendly", "string"),
    }


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def root_is_object() -> Column:
    return F.coalesce(F.col("_root_kind").startswith("OBJECT"), F.lit(False))


def read_skills() -> tuple[Column, Column]:
    """(value, valid): an array of texts, at most 20 before the spellings are merged."""
    kind, items = F.col("_required_skills_kind"), F.col("_skill_items")
    all_texts = F.forall(items, lambda x: F.schema_of_variant(x) == "STRING")
    valid = kind.isNull() | (kind.startswith("ARRAY") & (F.size(items) <= MAX_SKILLS) & all_texts)
    empty = F.array().cast("array<string>")
    value = F.coalesce(dedupe_ignoring_case(F.col("_skill_texts")), empty)
    return value, F.coalesce(valid, F.lit(False))


def years_value() -> Column:
    """The years as a double: a number, a boolean, or text holding a whole number."""
    kind, text = F.col("_years_experience_kind"), F.col("_years_text")
    whole_text = F.when(text.rlike(_INTEGER_TEXT), F.replace(text, F.lit("_"), F.lit("")))
    return F.when(kind == "STRING", whole_text.try_cast("double")).when(
        _is_number(kind) | (kind == "BOOLEAN"), F.col("_years_number")
    )


def read_years() -> tuple[Column, Column]:
    """(value, valid): missing or null, or a whole number 0..40; reads ``_years``."""
    kind, number = F.col("_years_experience_kind"), F.col("_years")
    whole = F.coalesce(
        (number == F.floor(number)) & number.between(MIN_YEARS, MAX_YEARS), F.lit(False)
    )
    return F.when(whole, number.cast("long")), kind.isNull() | (kind == "VOID") | whole


def flag_value() -> Column:
    """The local-experience flag: boolean, 0/1, or an accepted text; missing means false."""
    kind = F.col("_local_experience_required_kind")
    text, number = F.col("_flag_text"), F.col("_flag_number")
    return (
        F.when(kind.isNull(), F.lit(False))
        .when((kind == "BOOLEAN") | _is_number(kind), F.when(number == 1, True).when(number == 0, False))
        .when(kind == "STRING", F.when(text.isin(TRUE_TEXTS), True).when(text.isin(FALSE_TEXTS), False))
    )


def enum_value(kind: Column, text: Column, aliases: dict[str, str]) -> Column:
    """A known spelling; missing means unspecified, JSON null and other types are invalid."""
    return F.when(kind.isNull(), F.lit("unspecified")).when(
        kind == "STRING", normalise_alias(text, aliases)
    )
