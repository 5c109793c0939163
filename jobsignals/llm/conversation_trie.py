"""Trie over the prefixes of conversations, by collapsing whole sequences before prefixes are counted."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobsignals.llm.common import body, discard, query, stored, table

# What names a prefix: its number of turns and four sums over its turns' hashes.
LANES = ["k1", "k2", "k3", "k4"]
KEY = ["depth", *LANES]
PARENT = ["parent_depth", *(f"parent_{c}" for c in LANES)]
# Turns that a window adds up in one go; longer conversations are summed chunk by chunk.
CHUNK = 4096
# Ids that a row of an end list holds.
PIECE = 4096


def running_sums(rows: DataFrame, key: str, place: str, sums: list[str], chunk: int = CHUNK) -> DataFrame:
    """``rows`` (stored) with each column of ``sums`` added up over the rows of a key up to its place.

    Rows of a key are cut into chunks of places, which are summed apart, so that a key with a third
    of all rows is spread over many tasks; the chunks' totals then give what lies before each.
    """
    cut = rows.withColumn("chunk", F.floor((F.col(place) - 1) / chunk))
    inside = Window.partitionBy(key, "chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(key, "chunk").agg(*(F.sum(c).alias(c) for c in sums))
    base = totals.select(key, "chunk", *(F.sum(c).over(before).alias(f"before_{c}") for c in sums)).where(F.col(f"before_{sums[0]}").isNotNull())
    local = cut.withColumns({c: F.sum(c).over(inside) for c in sums})
    joined = local.join(base, [key, "chunk"], "left")
    return joined.select(*(c if c not in sums else (F.col(c) + F.coalesce(f"before_{c}", F.lit(0))).alias(c) for c in rows.columns))


def numbered_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, place from 1, digest, chars), a written table without the texts. Rows are sorted by
    range, so a conversation of any length is cut over several tasks; the counts of the earlier
    parts of a conversation give the places in the later ones."""
    role, text = body(role_col), body(text_col)
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    rows = stored(rows, "turns")
    order = ["conv_id", "turn", "digest"]
    parts = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "turns_by_range")
    counts = parts.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")).where(F.col("earlier") > 0)
    local = parts.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "digest")))
    placed = local.join(counts, ["conv_id", "part"], "left").select("conv_id", (F.col("place") + F.coalesce("earlier", F.lit(0))).cast("long").alias("place"), "digest", "chars")
    out = stored(placed, "numbered_turns")
    discard(rows, parts)
    return out


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its hundred: 0 to 5."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 6


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, place, digest, chars) of the rebuilt conversations, and a row of place 0 for each."""
    first = F.col("conv_id") - F.col("conv_id") % 100
    ids = turns.groupBy("conv_id").agg(F.lit(0).alias("_")).select("conv_id", first.alias("head"), shared_turns(F.col("conv_id")).alias("h"))
    heads = stored(turns.where((F.col("conv_id") % 100 == 0) & (F.col("place") <= 5)).select(F.col("conv_id").alias("head"), "place", "digest", "chars"), "heads")
    taken = ids.join(heads, "head").where(F.col("place") <= F.col("h")).select("conv_id", "place", "digest", "chars")
    lengths = heads.groupBy("head").agg(F.count(F.lit(1)).alias("length"))
    own = turns.withColumns({"head": first, "h": shared_turns(F.col("conv_id"))}).where(F.col("place") > F.col("h"))
    kept = own.join(lengths, "head", "left").select("conv_id", (F.col("place") - F.col("h") + F.least("h", F.coalesce("length", F.lit(0)))).alias("place"), "digest", "chars")
    start = ids.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return taken.unionByName(kept).unionByName(start)


def lane_hashes() -> list[Column]:
    """Four numbers of 32 bits from a turn and its place; sums of them over a prefix name the prefix,
    and can be added up in parts."""
    wide = [F.xxhash64("digest", "place", F.lit(salt)) for salt in (1, 2)]
    parts = [p for w in wide for p in (F.shiftrightunsigned(w, 32), w.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return [F.when(F.col("place") == 0, F.lit(0).cast("long")).otherwise(p).alias(c) for p, c in zip(parts, LANES)]


def prefixes_of(rows: DataFrame) -> DataFrame:
    """One row per conversation and prefix: conv_id, the prefix, its parent, code points of its last text."""
    hashed = stored(rows.select("conv_id", "place", "chars", *lane_hashes()).withColumns({f"own_{c}": F.col(c) for c in LANES}), "turn_hashes")
    summed = running_sums(hashed, "conv_id", "place", LANES)
    parent = [(F.col(c) - F.col(f"own_{c}")).alias(f"parent_{c}") for c in LANES]
    out = stored(summed.select("conv_id", F.col("place").alias("depth"), *LANES, (F.col("place") - 1).alias("parent_depth"), *parent, "chars"), "prefixes")
    discard(hashed)
    return out


def end_digests(ends: DataFrame) -> DataFrame:
    """(prefix, digest) of the ascending ids of the conversations (prefix, conv_id) that end there.

    Ids are sorted by range and joined into rows of up to ``PIECE`` ids, so a prefix at which a third
    of all conversations end is spread over many tasks; the last step hashes such rows one after
    another and holds one at a time.
    """
    places = ", ".join(f"{c} long" for c in KEY)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(len(KEY))]
            ids = batch.column(len(KEY)).to_numpy()
            if not len(ids):
                continue
            changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            edges = np.flatnonzero(np.r_[True, changes, True])
            starts = np.array([a for x, y in zip(edges[:-1], edges[1:]) for a in range(x, y, PIECE)])
            stops = np.array([min(a + PIECE, y) for x, y in zip(edges[:-1], edges[1:]) for a in range(x, y, PIECE)])
            joined = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, stops)]
            yield pa.record_batch([*(pa.array(c[starts]) for c in columns), pa.array(ids[starts]), pa.array(joined)], names=[*KEY, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(len(KEY))), batch.column(len(KEY) + 1).to_pylist()):
                if key == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield rows_of(done)
        if now is not None:
            yield rows_of([(*now, sha.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])

    order = [*KEY, "conv_id"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, f"{places}, first long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, f"{places}, ends_sha256 string")


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per prefix that rebuilt conversations share: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Identical rebuilt conversations become one sequence with its weight, smallest id and end list.
    The sequences' prefixes are weighted sums over sequences; sequences that are no other one's
    proper prefix (anti join) are the leaves. A subtree's savings need no second look at the tree:
    each prefix belongs to its smallest member's sequence, so a subtree holds all savings of the
    sequences through it, but for those that its own sequence has above it.

    Prefixes are named by sums over hashes of (place, role, text): 128 bits that come from SHA-256
    of the turns. Rows order by turn, null first, then by that digest, so ties have one order; rows
    repeating all of it are turns of their own. Null roles and texts are empty; rows with null
    conv_id take no part. A conversation may be turnless once rebuilt and then ends at the root. Other columns are not
    read. An empty table gives an empty result. No conversation, sequence or end list is held whole.
    """
    turns = numbered_turns(conversations, conv_col, turn_col, role_col, text_col)
    prefixes = prefixes_of(rebuilt(turns))
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("last")).select("conv_id", "last.*")
    last = stored(last, "whole_sequences")
    sequences = stored(last.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")
    paths = stored(prefixes.join(sequences.select("conv_id", "weight"), "conv_id"), "paths")
    nodes = paths.groupBy(*KEY).agg(F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), *(F.first(c).alias(c) for c in PARENT))
    nodes = stored(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie_nodes")

    children = nodes.where("depth > 0").groupBy(*(F.col(c).alias(k) for c, k in zip(PARENT, KEY))).agg(F.count(F.lit(1)).alias("n_children"))
    leaves = sequences.join(children, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    savings = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"))
    sums = sequences.select("conv_id").join(leaves, "conv_id", "left").join(savings, "conv_id", "left")
    sums = sums.select("conv_id", F.coalesce("leaf", F.lit(0)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    through = paths.select("conv_id", *KEY).join(stored(sums, "sequence_sums"), "conv_id").groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("through"))
    # Of a prefix's own sequence: what it saves down to the prefix, less the prefix itself.
    above = running_sums(nodes.select("conv_id", F.col("depth").alias("place"), F.col("saved").alias("above"), "saved"), "conv_id", "place", ["above"])
    above = above.select("conv_id", F.col("place").alias("depth"), (F.col("above") - F.col("saved")).alias("above"))

    parents = nodes.select(*(F.col(k).alias(c) for c, k in zip(PARENT, KEY)), F.col("conv_id").alias("parent_conv_id"))
    shown = (
        nodes.join(through, KEY)
        .join(children, KEY, "left")
        .join(end_digests(last), KEY, "left")
        .join(above, ["conv_id", "depth"])
        .join(parents, PARENT, "left")
    )
    return shown.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("through") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


@query(
    "op13_conversation_trie",
    """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    original AS (
        SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, digest) AS turns
        FROM turns GROUP BY conv_id
    ),
    coded AS (
        SELECT *, conv_id::VARCHAR AS name,
               flatten(list_transform(range(length(name)), lambda i: list_transform(range(8), lambda j: (ord(name[i + 1]) >> j) & 1))) AS bits
        FROM original
    ),
    shares AS (
        SELECT conv_id, turns, conv_id - conv_id % 100 AS head,
               xor(4294967295, list_reduce(bits, lambda crc, bit: xor(crc >> 1, CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT)) % 6 AS h
        FROM coded
    ),
    rebuilt AS (
        SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
        FROM shares a LEFT JOIN original b ON b.conv_id = a.head
    ),
    prefixes AS (
        SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns, len(turns) AS n FROM rebuilt
    ),
    named AS (
        SELECT conv_id, depth, n, turns[1:depth] AS prefix, CASE WHEN depth > 0 THEN turns[1:depth - 1] END AS above,
               CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS chars
        FROM prefixes
    ),
    nodes AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(chars) AS chars,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
        FROM named GROUP BY prefix, depth
    ),
    below AS (
        SELECT DISTINCT u.conv_id AS u_conv, u.depth AS u_depth, v.conv_id AS v_conv, v.depth AS v_depth
        FROM (SELECT n.conv_id AS member, m.conv_id, m.depth FROM named n JOIN nodes m ON m.depth = n.depth AND m.prefix = n.prefix) u
        JOIN (SELECT n.conv_id AS member, m.conv_id, m.depth FROM named n JOIN nodes m ON m.depth = n.depth AND m.prefix = n.prefix) v
          ON u.member = v.member AND u.depth <= v.depth
    ),
    children AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
    full_nodes AS (
        SELECT x.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
        FROM nodes x LEFT JOIN children c ON c.prefix = x.prefix
        LEFT JOIN nodes p ON p.depth = x.depth - 1 AND p.prefix = x.above
    )
    SELECT u.conv_id, u.depth, u.parent_conv_id, u.n_convs, u.n_children,
           count(*) FILTER (WHERE v.n_children = 0) AS n_leaves,
           sum((v.n_convs - 1) * v.chars)::BIGINT AS saved_tokens, u.ends_sha256
    FROM full_nodes u
    JOIN below b ON b.u_conv = u.conv_id AND b.u_depth = u.depth
    JOIN full_nodes v ON b.v_conv = v.conv_id AND b.v_depth = v.depth
    GROUP BY ALL
    """,
)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
