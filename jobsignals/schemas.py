"""Declared schemas. Nothing in the library infers a schema from data.

Fixed values: names and types of columns must stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _B, _F, _TS = (
    T.StringType(),
    T.DateType(),
    T.LongType(),
    T.BooleanType(),
    T.DoubleType(),
    T.TimestampType(),
)


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


RAW_POSTING = _struct(
    required=("snapshot_date", "ingested_at", "source_city", "id"),
    snapshot_date=_D,
    ingested_at=_TS,
    source_city=_S,
    id=_S,
    title=_S,
    description=_S,
    created=_TS,
    redirect_url=_S,
    adref=_S,
    salary_min=_F,
    salary_max=_F,
    salary_is_predicted=_S,
    contract_type=_S,
    contract_time=_S,
    latitude=_F,
    longitude=_F,
    location=_struct(display_name=_S, area=T.ArrayType(_S)),
    company=_struct(display_name=_S),
    category=_struct(tag=_S, label=_S),
)

EXTRACT = _struct(
    required=(
        "job_id",
        "snapshot_date",
        "sponsorship_signal",
        "local_experience_required",
        "remote_friendly",
        "model_version",
        "extracted_at",
        "extraction_status",
    ),
    job_id=_S,
    snapshot_date=_D,
    required_skills=T.ArrayType(_S),
    years_experience=_L,
    sponsorship_signal=_S,
    local_experience_required=_B,
    remote_friendly=_S,
    model_version=_S,
    extracted_at=_TS,
    extraction_status=_S,
    error_message=_S,
)

SEEDS: dict[str, T.StructType] = {
    "occupation_lists": _struct(
        anzsco_code=_S, occupation_name=_S, list_name=_S, effective_date=_D
    ),
    "eoi_invitations": _struct(
        round_date=_D, visa_subclass=_S, anzsco_code=_S, points_cutoff=_L, invitations_issued=_L
    ),
    "anzsco_title_patterns": _struct(
        priority=_L, anzsco_code=_S, occupation_name=_S, title_pattern=_S
    ),
    "occupation_ceilings": _struct(
        anzsco_unit_group=_S,
        unit_group_name=_S,
        tier=_L,
        avg_stock=_L,
        annual_ceiling=_L,
        grants_py24_25=_L,
        remaining_py25_26=_L,
        program_year=_S,
        source=_S,
        source_url=_S,
        retrieved_date=_D,
    ),
}


def required_columns(schema: T.StructType) -> list[str]:
    """Columns declared NOT NULL. File readers relax them, so loads assert them explicitly."""
    return [f.name for f in schema.fields if not f.nullable]


def optional(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
