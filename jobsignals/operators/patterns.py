"""Map a text column to the best-ranked matching pattern of a pattern table.

Every pattern row is ``(priority, code, pattern)``. The smallest priority wins (NULL last);
equal priorities are settled by code and pattern so that the answer is reproducible.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and distinct texts that one cell of the grid is meant to hold.
CELL_PATTERNS, CELL_TEXTS = 1_000, 20_000

# Patterns whose required literals one automaton holds, which is what a pass over the texts broadcasts.
AUTOMATON_PATTERNS = 20_000
# Shortest literal worth searching for.
LEAST_LITERAL = 2

_TEXT, _DIGEST, _BEST = "_text", "_digest", "_best"
_RANKED_TYPE = "struct<unranked: boolean, priority: bigint, code: string, pattern: string>"
_RANKED = f"p {_RANKED_TYPE}"
_ROW, _PART = "_grid_row", "_grid_part"


def _rank_key(priority, code, pattern) -> tuple:
    """The order of the ranked column: the smallest priority, NULL last; then code, NULL first."""
    return (priority is None, priority if priority is not None else 0, code is not None, code or "", pattern)


def _case_column(text: Column, patterns: Sequence[Mapping], priority: str, code: str, pattern: str) -> Column:
    result = None
    known = [r for r in patterns if r[pattern] is not None]
    for row in sorted(known, key=lambda r: _rank_key(r[priority], r[code], r[pattern])):
        hit = F.rlike(text, F.lit(row[pattern]))
        result = F.when(hit, F.lit(row[code])) if result is None else result.when(hit, F.lit(row[code]))
    return F.lit(None).cast("string") if result is None else result.cast("string")


# Escapes that stand for one character of a kind, or for a place, and take nothing after them.
_PLAIN_ESCAPES = set("bBdDwWsStnrf")
_FLAGS = re.compile(r"\(\?[A-Za-z-]")


def _closing(pattern: str, at: int) -> int | None:
    """The place after the group or class that opens at ``at``; None where that is not plain."""
    if pattern[at] == "[" and pattern[at + 1 : at + 3].lstrip("^").startswith("]"):
        return None
    depth = classes = 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            if pattern[at + 1 : at + 2] in ("Q", "E"):
                return None
            at += 1
        elif c == "[":
            classes += 1
        elif c == "]" and classes:
            classes -= 1
        elif not classes:
            depth += {"(": 1, ")": -1}.get(c, 0)
        at += 1
        if not depth and not classes:
            return at
    return None


def required_literals(pattern: str) -> list[str] | None:
    """Texts of which every match of ``pattern`` holds at least one, None if that cannot be told.

    Each alternative gives its longest run of plain characters outside groups, classes and anything
    optional. Patterns with flags, quotations or escapes of several characters are left alone.
    """
    if _FLAGS.search(pattern):
        return None
    found, runs, run, at = [], [], "", 0
    while True:
        c = pattern[at] if at < len(pattern) else "|"
        if c == "|":
            best = max([*runs, run], key=len)
            if len(best) < LEAST_LITERAL:
                return None
            found.append(best)
            if at >= len(pattern):
                return found
            runs, run, at = [], "", at + 1
            continue
        if c == "\\":
            escaped = pattern[at + 1 : at + 2]
            if not escaped or (escaped.isalnum() and escaped not in _PLAIN_ESCAPES):
                return None
            if escaped.isalnum():
                runs, run = [*runs, run], ""
            else:
                run += escaped
            at += 2
        elif c in "([":
            end = _closing(pattern, at)
            if end is None:
                return None
            runs, run, at = [*runs, run], "", end
        elif c in "?*{":
            # The character before may be absent, or is repeated.
            runs, run = [*runs, run[:-1]], ""
            if c == "{":
                at = pattern.find("}", at)
                if at < 0:
                    return None
            at += 1
        elif c in ".^$+":
            runs, run, at = [*runs, run], "", at + 1
        elif c in ")]}":
            return None
        else:
            run, at = run + c, at + 1


def _literal_hits(texts: DataFrame, literals: Mapping[str, list[int]]) -> DataFrame:
    """(text, i) for every text and pattern number of which it holds a literal: all literals are
    searched in one pass over a text, by a trie with failure links that each task builds."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for literal, numbers in literals.items():
            automaton.add_word(literal, numbers)
        automaton.make_automaton()
        for batch in batches:
            held, numbers = [], []
            for at, text in enumerate(batch.column(0).to_pylist()):
                hits = {n for _, found in automaton.iter(text) for n in found}
                held.extend([at] * len(hits))
                numbers.extend(hits)
            yield pa.record_batch([batch.column(0).take(pa.array(held, pa.int64())), pa.array(numbers, pa.int32())], names=[_TEXT, "i"])

    return texts.select(_TEXT).mapInArrow(search, f"{_TEXT} string, i int")


def _automaton_matches(texts: DataFrame, rows: list) -> DataFrame:
    """Texts and patterns (p, literals) that match: a pattern is tried on the texts that hold one of
    its literals only."""
    numbers: dict[str, list[int]] = {}
    for i, (_, literals) in enumerate(rows):
        for literal in literals:
            numbers.setdefault(literal, []).append(i)
    # At most AUTOMATON_PATTERNS rows, so this broadcast is bounded.
    known = F.broadcast(texts.sparkSession.createDataFrame([(i, tuple(p)) for i, (p, _) in enumerate(rows)], f"i int, {_RANKED}"))
    return _literal_hits(texts, numbers).join(known, "i").where(F.rlike(F.col(_TEXT), F.col("p.pattern"))).select(_TEXT, "p")


def _matches(texts: DataFrame, ranked: DataFrame, parts: int, rows: int) -> DataFrame:
    """Theta join by cells: a text meets each pattern in exactly one (row, part) cell.

    Patterns are spread over ``parts`` and repeated per row, texts over ``rows`` and repeated per
    part, so no cell holds more than about 1/parts of the patterns and 1/rows of the texts.
    """
    texts = texts.select(
        _TEXT,
        F.pmod(F.xxhash64(_TEXT), F.lit(rows)).cast("int").alias(_ROW),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(_PART),
    )
    ranked = ranked.select(
        "p",
        F.pmod(F.xxhash64("p.pattern", "p.code"), F.lit(parts)).cast("int").alias(_PART),
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias(_ROW),
    )
    same_cell = [texts[_ROW] == ranked[_ROW], texts[_PART] == ranked[_PART]]
    hit = F.rlike(F.col(_TEXT), F.col("p.pattern"))
    return texts.join(ranked, [*same_cell, hit]).select(_TEXT, "p")


def map_by_pattern(
    df: DataFrame,
    text: Column,
    patterns: DataFrame | Sequence[Mapping],
    priority: str = "priority",
    code: str = "anzsco_code",
    pattern: str = "title_pattern",
    output: str = "anzsco_code",
    cells: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``output``: the code of the best pattern found in ``text``, NULL when none matches.

    Patterns given as rows (mappings) become one CASE over literals: no join, no shuffle, rows
    never multiply. Patterns given as a DataFrame meet the *distinct* texts, and the best hit is
    joined back. They are taken in buckets of about ``AUTOMATON_PATTERNS``, the most that is collected
    and broadcast: literals that each pattern requires are searched in one pass over a text, and the
    pattern is tried only where one is found. Patterns that require no literal meet the texts in
    cells of a grid, so that no task meets all of either. Both kinds of argument give the same codes.
    ``cells`` sets (parts of the patterns, rows of the texts) of the grid without counting.
    """
    if not isinstance(patterns, DataFrame):
        case = _case_column(F.col(_TEXT), patterns, priority, code, pattern)
        return df.withColumn(_TEXT, text).withColumn(output, case).drop(_TEXT)
    ranked = patterns.where(F.col(pattern).isNotNull()).select(
        F.struct(
            F.col(priority).isNull().alias("unranked"),
            F.col(priority).cast("long").alias("priority"),
            F.col(code).cast("string").alias("code"),
            F.col(pattern).alias("pattern"),
        ).alias("p")
    )
    # Repeated titles are matched once. A hot title is one row here.
    texts = df.select(text.alias(_TEXT)).where(F.col(_TEXT).isNotNull()).distinct()
    spark = df.sparkSession
    ranked = ranked.select("p").distinct()
    buckets = max(1, -(-ranked.count() // AUTOMATON_PATTERNS))
    hits = []
    for bucket in range(buckets):
        rows = ranked.where(F.pmod(F.xxhash64("p"), F.lit(buckets)) == bucket).collect()
        split = [(r.p, required_literals(r.p.pattern)) for r in rows]
        searched = [(p, literals) for p, literals in split if literals is not None]
        free = [(tuple(p),) for p, literals in split if literals is None]
        if searched:
            hits.append(_automaton_matches(texts, searched))
        if free:
            grid = cells or (-(-len(free) // CELL_PATTERNS), -(-texts.agg(F.approx_count_distinct(_TEXT)).first()[0] // CELL_TEXTS))
            hits.append(_matches(texts, spark.createDataFrame(free, _RANKED), *(max(1, n) for n in grid)))
    hits = reduce(DataFrame.unionByName, hits) if hits else texts.select(_TEXT, F.lit(None).cast(_RANKED_TYPE).alias("p")).limit(0)
    best = hits.groupBy(_TEXT).agg(F.min("p").alias(_BEST))
    # The hash as a second key makes Spark shuffle both sides for this join alone. Without it the
    # right side would reuse the shuffle below its aggregate, and AQE splits a hot title only when
    # both shuffles feed the join directly.
    digest = F.xxhash64(_TEXT)
    return (
        df.withColumn(_TEXT, text)
        .withColumn(_DIGEST, digest)
        .join(best.withColumn(_DIGEST, digest), [_TEXT, _DIGEST], "left")
        .withColumn(output, F.col(f"{_BEST}.code"))
        .drop(_TEXT, _DIGEST, _BEST)
    )
