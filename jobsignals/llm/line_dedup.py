"""Line dedup over content-defined chunks, with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import body, query, stored, table

# The rolling hash over two lines is BASE * first + second; line hashes have 58 bits, so it fits.
BASE, SPARE_BITS = 31, 6
BLANK = " \t\r"


def line_hash(line: Column) -> Column:
    """An odd number, and 0 for a line of blanks."""
    return F.when(F.length(F.trim(line, F.lit(BLANK))) == 0, F.lit(0).cast("long")).otherwise(F.shiftright(F.xxhash64(line), SPARE_BITS).bitwiseOR(F.lit(1)))


def rolled(hashes: Column) -> Column:
    """The rolling hash of each two-line window, by the place of its first line; null where both
    lines are blank, and after the last line."""
    return F.zip_with(hashes, F.slice(hashes, 2, F.size(hashes)), lambda a, b: F.when((a != 0) | (b != 0), a * BASE + b))


def n_lines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def windows(keyed: DataFrame) -> DataFrame:
    """(id, version, place, hash) of the two-line windows of every text."""
    hashed = keyed.select("id", "version", F.transform(F.split("text", "\n", -1), line_hash).alias("hashes"))
    return hashed.select("id", "version", F.posexplode(rolled(F.col("hashes"))).alias("place", "hash")).where("hash IS NOT NULL")


def position(*more: str) -> Column:
    return F.struct(F.col("id").isNull().alias("last"), "id", "version", "place", *more)


def same_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by (id, version), null ids included; ``right`` calls them of, of_version."""
    return left.join(right, F.col("version").eqNullSafe(F.col("of_version")) & F.col("id").eqNullSafe(F.col("of")), "left").drop("of", "of_version")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, the text without passages that stand elsewhere first, n_lines of the
    original and n_removed of them.

    The rolling hash over the hashes of two adjacent lines depends on these lines alone. Where it
    changes between repeated and unique in the corpus, a text is cut: a chunk is a longest run of
    lines whose every adjacent pair occurs earlier, byte for byte, and goes. So every repeated run of
    two or more lines is found whole, wherever it stands and whatever stands around it. Earlier means
    a smaller id, or a smaller place in the text; the first occurrence of every line stays. A
    repeated line alone and pairs of blank lines are not touched.

    Hashes are counted first, so that only windows repeated by hash meet their documents; the bytes
    of these are then grouped below their hash, copies combined before the shuffle. A window that is
    the first of its bytes although another shares its hash is taken back. The first two joins are
    merge joins at any size, as both sides grow with the corpus, and AQE splits the rows of a window
    that very many documents hold; windows taken back are nearly none, and Catalyst goes by size.

    Null text counts as empty, one empty line. Null ids take part and stay last; rows repeating id
    and text are one document and lose the same lines; other columns are not read. An empty table
    gives an empty result. The places of one document have to fit into a row, as its text does.
    """
    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"))
    keyed = rows.select("id", F.unhex(F.md5("text")).alias("version"), "text")
    seen = windows(keyed)
    repeated = stored(seen.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(position()).alias("first")).where("n > 1").drop("n"), "repeated_windows")
    found = seen.join(repeated.hint("merge"), "hash").withColumn("later", ~position().eqNullSafe(F.col("first")))
    marks = found.groupBy("id", "version").agg(F.collect_set(F.struct("place", "later", "hash")).alias("marks"))
    of = (F.col("id").alias("of"), F.col("version").alias("of_version"))
    marked = stored(same_row(keyed, marks.select(*of, "marks").hint("merge")), "marked_texts")

    cut = marked.where("marks IS NOT NULL").select("id", "version", "marks", F.split("text", "\n", -1).alias("lines"))
    line = F.col("lines")
    pairs = cut.select("id", "version", F.explode(F.transform("marks", lambda m: F.struct(m["place"], m["later"], m["hash"], F.concat(line[m["place"]], F.lit("\n"), line[m["place"] + 1]).alias("bytes")))).alias("w")).select("id", "version", "w.*")
    firsts = pairs.groupBy("hash", "bytes").agg(F.min(position("later")).alias("first"))
    spared = stored(firsts.where("first.later").select("first.*").groupBy("id", "version").agg(F.collect_set("place").alias("spared")), "spared_windows")

    joined = same_row(marked, spared.select(*of, "spared"))
    later = F.transform(F.filter("marks", lambda m: m["later"]), lambda m: m["place"])
    gone = F.sort_array(F.array_except(later, F.coalesce("spared", F.array().cast("array<int>"))))
    parts = joined.select("id", "text", n_lines(F.col("text")).alias("n_lines"), gone.alias("gone"), F.when(F.size(gone) > 0, F.split("text", "\n", -1)).alias("lines"))
    # What stays lies between the windows that go: after the two lines of one, up to the next.
    ends = F.concat(F.col("gone"), F.array(F.size("lines")))
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda p: p + 2))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice("lines", a + 1, F.greatest(b - a, F.lit(0)))))
    result = parts.select("id", "text", "n_lines", F.when(F.col("lines").isNotNull(), kept).alias("kept"))
    return result.select(
        F.col("id").alias(id_col),
        F.coalesce(F.array_join("kept", "\n"), "text").alias(text_col),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
    )


@query(
    "op4_line_dedup",
    """
    WITH lines AS (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    ), pairs AS (
        SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS following, trim(line, ' ' || chr(9) || chr(13)) = '' AS blank FROM lines
    ), ranked AS (
        SELECT *, following IS NOT NULL AND NOT (blank AND trim(following, ' ' || chr(9) || chr(13)) = '')
                  AND row_number() OVER (PARTITION BY line, following ORDER BY doc_id, i) > 1 AS later FROM pairs
    ), marked AS (
        SELECT *, later OR coalesce(lag(later) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM ranked
    )
    SELECT doc_id,
           coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
           count(*) AS n_lines,
           count(*) FILTER (gone) AS n_removed
    FROM marked GROUP BY doc_id
    """,
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))
