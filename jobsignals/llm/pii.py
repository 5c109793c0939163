"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import arrow_type, body, by_slice, query, table, with_values

# The four kinds of the contract in its order, then the kinds added here.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]

# A match can only begin where the look-behind allows: further right in the same run the rest of
# the pattern would meet the same characters. Possessive repeats then keep every scan linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}+")
# Countries by the length of their IBANs, from the registry of ISO 13616.
IBAN_COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
IBAN_LENGTHS = {country: n for n, countries in IBAN_COUNTRIES.items() for country in countries.split()}
NOT_DIGIT = re.compile(r"[^0-9]")

# Words whose presence near a span raises its score, by kind.
CONTEXT = {
    "email": re.compile(r"mail|contact|write|address", re.I),
    "ip": re.compile(r"\bip\b|server|host|address", re.I),
    "card": re.compile(r"card|visa|credit|payment", re.I),
    "phone": re.compile(r"phone|call|tel\b|mobile|fax", re.I),
    "iban": re.compile(r"iban|account|bank|transfer|\bbic\b|swift", re.I),
}
PATTERN_SCORE, CHECKSUM_SCORE, CONTEXT_SCORE = 0.6, 0.9, 0.1
# A passed checksum of a country that the registry does not list; spans of added kinds need ACCEPTED.
UNLISTED_SCORE, ACCEPTED = 0.75, 0.8
CONTEXT_WIDTH = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def find_emails(text: str) -> Iterator[tuple[int, int]]:
    """Work from each '@': the leftmost start is where the run of allowed characters before it
    begins, no earlier than the end of the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        # The run cannot hold an '@', so stretches between two of them are scanned once.
        low = max(done, text.rfind("@", done, at) + 1)
        start = at
        while start > low and LOCAL_RUN.fullmatch(text, max(low, start - 64), start):
            start = max(low, start - 64)
        while start > low and LOCAL_RUN.fullmatch(text, start - 1, start):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def find_ibans(text: str) -> Iterator[tuple[int, int]]:
    """Every head is tried, with the length of its country first, then as long as the run goes; of a
    country that is not listed every end of a word is tried, the last one first."""
    at = 0
    while head := IBAN_HEAD.search(text, at):
        at = head.end()
        rest = IBAN_REST.match(text, at)
        if not rest:
            continue
        ends = [i + 1 for i in range(at, rest.end()) if text[i] != " "]
        word_ends = [(n, end) for n, end in enumerate(ends, 5) if n >= 15 and not (text[end : end + 1].isascii() and text[end : end + 1].isalnum())]
        length = IBAN_LENGTHS.get(head.group()[:2])
        tried = [w for w in word_ends if w[0] == length] + word_ends[-1:] if length else word_ends[::-1]
        for _, end in tried:
            if mod_97(text[head.start() : end].replace(" ", "")):
                yield head.start(), end
                at = end
                break


def propose(text: str) -> Iterator[tuple[str, int, int, float]]:
    """(kind, start, end, score without context) of every span whose check passes."""
    for start, end in find_emails(text):
        yield "email", start, end, PATTERN_SCORE
    for m in IP.finditer(text):
        if all(len(g.lstrip("0")) <= 3 and int(g[-4:]) <= 255 for g in m.groups()):
            yield "ip", m.start(), m.end(), PATTERN_SCORE
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), CHECKSUM_SCORE
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                yield "phone", m.start(), m.end(), PATTERN_SCORE
    for start, end in find_ibans(text):
        yield "iban", start, end, CHECKSUM_SCORE if text[start : start + 2] in IBAN_LENGTHS else UNLISTED_SCORE


def find_pii(text: str) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, score) by kind as listed, then start; offsets in code points."""
    found = []
    for kind, start, end, score in propose(text):
        near = text[max(0, start - CONTEXT_WIDTH) : start] + " " + text[end : end + CONTEXT_WIDTH]
        score = round(score + CONTEXT_SCORE * bool(CONTEXT[kind].search(near)), 2)
        if kind in BASE_KINDS or score >= ACCEPTED:
            found.append((kind, start, end, score))
    return found


def redact_text(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Replace spans by their kind; of overlapping spans the earlier, then the longer one names the
    place, and the place covers them all."""
    out, done, opened = [], 0, None
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if opened and start < opened[1]:
            opened = (opened[0], max(opened[1], end))
            continue
        if opened:
            out.append(f"<{opened[0].upper()}>")
            done = opened[1]
        out.append(text[done:start])
        opened = (kind, end)
    if opened:
        out.append(f"<{opened[0].upper()}>")
        done = opened[1]
    return "".join(out) + text[done:]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def detect_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, spans (array of kind, start, end, score) and the redacted text.

    Emails, addresses, card numbers (Luhn), phone numbers and IBANs (mod 97) of the whole text. The
    score is 0.6 for a pattern, 0.9 for a passed checksum (0.75 for an IBAN of a country that is not
    listed) and 0.1 more with a context word within 40 characters. Spans of the four base kinds stay
    at any score; others need 0.8, so an IBAN of an unlisted country counts by its context only. A span's check fails or passes once, there are no
    retries inside it, but for IBANs, which what follows or stands before must not spoil. Null text
    counts as empty and has no spans; null ids and repeated rows are kept as they are; other columns
    are not read.
    """
    def find(ids: list, texts: list[str]) -> Iterator[tuple]:
        for key, text in zip(ids, texts):
            spans = find_pii(text)
            yield key, [dict(zip(("kind", "start", "end", "score"), s)) for s in spans], redact_text(text, spans)

    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = pa.schema([("id", arrow_type(kind)), ("spans", pa.list_(SPAN)), ("redacted", pa.string())])
    out = rows.mapInArrow(by_slice(find, schema), f"id {kind}, spans array<struct<kind string, start bigint, end bigint, score double>>, redacted string")
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind; null stays null."""
    return with_values(docs, text_col, text_col, pa.string(), lambda t: t if t is None else redact_text(t, find_pii(t)))


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(table(spark, sf_dir, "documents")).select("doc_id", "spans")

    def of_kind(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    def shown(kinds: tuple[str, ...]) -> Column:
        in_order = F.concat(*(of_kind(k) for k in kinds))
        return F.array_join(F.transform(in_order, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(shown(BASE_KINDS), 256).alias("base_sha256"),
        shown(KINDS).alias("spans"),
        F.array_join(F.transform(F.concat(*(of_kind(k) for k in KINDS)), lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
