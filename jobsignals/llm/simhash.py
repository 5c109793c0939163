"""SimHash near-dedup: fingerprints of word shingles, linked through BK-trees of shards."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import arrow_type, body, by_slice, query, slices, stored, table
from jobsignals.llm.components import roots

WORDS, RADIUS, SEED, BITS = 4, 4, 42, 64
# Members of one tree; larger shards are cut into several trees, and every member asks each.
TREE_MEMBERS = 2_000

# bits[b, i]: bit i of byte b, lowest first
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of a text's word shingles, repeats included; of the whole text if it has fewer words."""
    # bytes.lower and bytes.split know ASCII only: A to Z; blank, tab to carriage return.
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    last = ends[words - 1 :] if len(tokens) >= words else ends[-1:]
    shingles = [joined[a:b] for a, b in zip(starts[:n].tolist(), last.tolist())]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)


def mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Further 64-bit hashes from one: the finaliser of splitmix64 on a shifted sequence."""
    z = hashes + np.uint64((0x9E3779B97F4A7C15 * lane) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def majority(hashes: np.ndarray) -> bytes:
    """The bits that are set in over half of the hashes (rows of 64-bit words), lowest first; zero
    for no hashes."""
    n = len(hashes)
    if not n:
        return bytes(8)
    lanes = hashes.astype("<u8").reshape(n, -1).view(np.uint8)
    width = lanes.shape[1]
    counts = np.zeros(width * 256, np.int64)
    for at in range(0, n, 8192):
        counts += np.bincount((lanes[at : at + 8192] + np.arange(width) * 256).ravel(), minlength=width * 256)
    set_bits = counts.reshape(width, 256) @ BYTE_BITS
    return np.packbits((set_bits * 2 > n).ravel(), bitorder="little").tobytes()


def fingerprint(text: str, words: int = WORDS) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit number."""
    return int.from_bytes(majority(shingle_hashes(text, words)), "little", signed=True)


def wide_fingerprint(hashes: np.ndarray, bits: int) -> bytes:
    """Of each shingle once, so that differing bits follow the similarity of sets."""
    if not len(hashes):
        return bytes(bits // 8)
    return majority(np.stack([mixed(hashes, lane) for lane in range(1, bits // 64 + 1)], axis=1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row: id and ``fp``. Null text counts as empty, whose fingerprint is zero."""
    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(ids: list, texts: list[str]) -> Iterator[tuple]:
        return zip(ids, (fingerprint(t, words) for t in texts))

    return rows.mapInArrow(by_slice(run, pa.schema([("id", arrow_type(kind)), ("fp", pa.int64())])), f"id {kind}, fp long")


class BKTree:
    """Fingerprints as nodes; a child's key is its Hamming distance to its parent."""

    def __init__(self):
        self.root: tuple[int, int, dict] | None = None

    def add(self, value: int, label: int) -> None:
        node = self.root
        if node is None:
            self.root = (value, label, {})
            return
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[2].get(d)
            if child is None:
                node[2][d] = (value, label, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """The labels of all nodes at most ``radius`` away."""
        return list(self.near(value, radius))

    def near(self, value: int, radius: int) -> Iterator[int]:
        """The same one by one, for callers that may stop: by the triangle inequality they lie under
        edges that differ from the distance to their parent by no more."""
        open_nodes = [self.root] if self.root else []
        while open_nodes:
            other, label, children = open_nodes.pop()
            d = (other ^ value).bit_count()
            if d <= radius:
                yield label
            if children:
                low, high = d - radius, d + radius
                open_nodes += [c for k, c in children.items() if low <= k <= high]


def blocks_for(n: int, radius: int) -> int:
    """Into how many blocks to cut a fingerprint. Of m blocks all but ``radius`` agree in a pair, so
    a shard is a choice of m - radius blocks with their values; more blocks make smaller shards but
    more choices. The links found are the same for any m."""

    def cost(m: int) -> float:
        bits = BITS * (m - radius) // m
        # To deal a row out takes about as long as 60 comparisons.
        return math.comb(m, radius) * (60 + n / 2.0**bits)

    return min(range(radius + 1, radius + 6), key=cost)


def shard_keys(m: int, radius: int) -> list[int]:
    """The masks of the choices: bits that have to agree."""
    edges = [BITS * i // m for i in range(m + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(m)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(m), m - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class ShardLinks:
    """Pairs that connect what is near in one tree of a shard. Members come first and enter the tree,
    other rows of the shard only ask; both may carry a ``label`` of what is connected already, and a
    ``shingles`` set that decides. Once all of the tree is connected, a row stops at its first link."""

    def __init__(self, radius: int, similarity: float | None):
        self.radius, self.similarity = radius, similarity
        self.tree = BKTree()
        self.nodes: list[int] = []
        self.groups: list[int] = []
        self.sets: list[np.ndarray | None] = []
        self.parent: dict[int, int] = {}
        self.apart = 0  # groups among the members that are not connected

    def top(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def similar(self, x: np.ndarray | None, y: np.ndarray | None) -> bool:
        if self.similarity is None:
            return True
        if min(len(x), len(y)) < self.similarity * max(len(x), len(y)):
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both >= self.similarity * (len(x) + len(y) - both)

    def add(self, node: int, bits: int | bytes, inside: bool, label: int | None, shingles: bytes | None) -> Iterator[tuple[int, int]]:
        value = int.from_bytes(bits, "little") if isinstance(bits, bytes) else bits & 0xFFFFFFFFFFFFFFFF
        group = node if label is None else label
        own = None if shingles is None else np.frombuffer(shingles, "<u8")
        root = self.top(group) if group in self.parent else None
        if root is None or self.apart > 1:
            for j in self.tree.near(value, self.radius):
                other = self.top(self.groups[j])
                if other == root or not self.similar(own, self.sets[j]):
                    continue
                yield node, self.nodes[j]
                if root is not None:
                    self.parent[other] = root
                    self.apart -= 1
                else:
                    root = other
                if self.apart == 1:
                    break
                root = self.top(root)
        if inside:
            self.tree.add(value, len(self.nodes))
            self.nodes.append(node)
            self.groups.append(group)
            self.sets.append(own)
            if group not in self.parent:
                self.parent[group] = group if root is None else root
                self.apart += root is None


def link_shards(keyed: DataFrame, radius: int, tree_members: int, sets: DataFrame | None = None, similarity: float | None = None) -> DataFrame:
    """Pairs (a, b) of ``node`` that connect all nodes of a shard (t, key) whose ``bits`` differ in
    at most ``radius`` places: of a tree's links only as many as connect its members are sent. With
    ``sets`` (node, hashes) a link also needs that Jaccard similarity, and nodes of one ``label`` are
    connected already.

    Shards are dealt out by key, not broadcast, as together they grow with the input; a shard of
    many near copies is cut into trees of ``tree_members``, each asked by the whole shard. A task
    holds the members of one tree and a slice of rows at a time.
    """
    large = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tree_members)
    trees = large.select("t", "key", F.ceil(F.col("size") / tree_members).cast("int").alias("trees"))
    members = keyed.join(trees, ["t", "key"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    home = F.pmod(F.xxhash64("node"), "trees").cast("int")
    # A pair meets once: a row asks its own tree and the later ones.
    asked = members.withColumn("tree", F.explode(F.sequence(home, F.col("trees") - 1)))
    checked = sets is not None
    names = ["t", "key", "tree", "inside", "node", "bits", *(["label", "hashes"] if checked else [])]
    asked = asked.withColumn("inside", home == F.col("tree"))
    if checked:
        asked = asked.join(sets.hint("merge"), "node")
    tasks = asked.select(*names).repartition("t", "key", "tree").sortWithinPartitions("t", "key", "tree", F.col("inside").desc(), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards arrive one after another, and may go on in the next batch."""
        now, shard, pairs = None, None, []
        for part in slices(batches, 2048):
            columns = [part.column(n).to_pylist() for n in names]
            given = zip(*columns) if checked else zip(*columns, repeat(None), repeat(None))
            for t, key, tree, inside, node, bits, label, hashes in given:
                if now != (t, key, tree):
                    now, shard = (t, key, tree), ShardLinks(radius, similarity)
                pairs.extend(shard.add(node, bits, inside, label, hashes))
            if pairs:
                yield pair_batch(pairs)
                pairs = []

    def pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*pairs)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return tasks.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int = RADIUS, tree_members: int = TREE_MEMBERS) -> DataFrame:
    """Pairs (a, b) of fingerprints of column ``fp`` (distinct, stored) that connect all that differ
    in at most ``radius`` bits."""
    masks = shard_keys(blocks_for(distinct.count(), radius), radius)
    tables = F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.lit(signed(m)).alias("mask")) for i, m in enumerate(masks))))
    keyed = distinct.select("fp", tables.alias("m")).select("m.t", F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), F.col("fp").alias("node"), F.col("fp").alias("bits"))
    return link_shards(keyed, radius, tree_members)


def component_ids(nodes: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """(fp, root, component_id): the smallest id under each root. ``nodes`` has ``key``, fp and least, the
    smallest id of the node; ``found`` names the root of ``key`` where it has another.

    Both sides of the last join are stored, so that AQE can split the rows of a large component.
    """
    links = found.select(F.col("node").alias("of"), "root")
    rooted = stored(nodes.join(links, F.col(key) == F.col("of"), "left").select("fp", "least", F.coalesce("root", key).alias("root")), "rooted")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    return stored(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row: id, fingerprint (16 hex digits), component_id, the smallest id among all
    rows that links of at most ``radius`` differing bits reach.

    Rows of one fingerprint are one node, so copies are never paired. Texts of fewer than ``words``
    words are one shingle, texts without words (null ones too) have fingerprint zero and link like
    others. Null ids take part but are never a component's id unless it holds nothing else; repeated
    rows stay; other columns are not read; an empty table gives an empty result.
    """
    marked = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    classes = component_ids(nodes, "fp", roots(stored(links(nodes.select("fp"), radius), "edges")))
    return marked.join(classes, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def differing_bits(similarity: float, bits: int) -> float:
    """Bits in which the SimHashes of two equally large sets of that Jaccard similarity are expected
    to differ: in proportion to the angle between the sets' indicator vectors."""
    return bits * math.acos(2 * similarity / (1 + similarity)) / math.pi


# Of wide fingerprints: bits, and how many standard deviations above the expected difference still link.
# Where the sets decide, three deviations would do for large ones; sets of four and five shingles
# differ in 96 bits on average.
WIDE_BITS, WIDE_SLACK, CONFIRMED_SLACK = 512, 0.8, 5.5
# Bands of a text, and least hashes in each. Texts of similarity s share a band with probability
# 1 - (1 - s**BAND_ROWS)**BANDS, 99.93% at 0.8, however many texts there are.
BANDS, BAND_ROWS = 24, 6
_DRAWN = random.Random(SEED)
FACTORS, TERMS = (np.array([_DRAWN.getrandbits(64) | odd for _ in range(BANDS * BAND_ROWS)], np.uint64) for odd in (1, 0))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band from the least of a text's shingle hashes under BANDS * BAND_ROWS orders."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * FACTORS + TERMS).min(axis=0), out=least)
    return [signed(xxhash.xxh64_intdigest(band.tobytes(), SEED)) for band in least.astype("<u8").reshape(BANDS, BAND_ROWS)]


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets (node, hashes) have at least that Jaccard similarity."""

    def check(a: list[int], b: list[int], left: list[bytes], right: list[bytes]) -> Iterator[tuple]:
        for i, j, x, y in zip(a, b, left, right):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= similarity * (len(x) + len(y) - both):
                yield i, j

    left, right = (sets.select(F.col("node").alias(end), F.col("hashes").alias(name)) for end, name in (("a", "left_hashes"), ("b", "right_hashes")))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "left_hashes", "right_hashes")
    return joined.mapInArrow(by_slice(check, pa.schema([("a", pa.int64()), ("b", pa.int64())])), "a long, b long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, tree_members: int = TREE_MEMBERS, confirm: bool = False) -> DataFrame:
    """One row per row: id and component_id, the smallest id that links reach, for texts whose word
    shingles have at least the given Jaccard similarity: as far as SimHash can tell, or with
    ``confirm`` by the shingle sets of the pairs that SimHash proposes.

    At 0.8 two fingerprints differ in 15% of their bits, too many for 64 bits and shards of equal
    blocks. So fingerprints have ``WIDE_BITS`` bits, and a shard is a value of one of ``BANDS`` bands
    of least shingle hashes. Whether a pair meets in a shard depends on its similarity alone, not on
    the size of the corpus. Inside a shard the BK-tree links at the expected difference plus
    ``WIDE_SLACK`` deviations. With ``confirm`` it proposes up to ``CONFIRMED_SLACK`` deviations, and
    the sets of 64-bit shingle hashes confirm a pair, so no two less similar texts are linked.

    To confirm, first only as many pairs as connect a shard are confirmed. Where one of them is refused,
    the members of that loose group meet again in their shards, with their sets: there a pair that is
    not connected yet is compared in place, and only pairs that connect leave the task, fewer than
    members. So no pair is passed over. Texts of equal sets are one node. Nulls, repeats and empty tables are treated as in ``near_duplicates``.
    """
    found = similar_rows(docs, id_col, text_col, words, similarity, tree_members, confirm)
    return found.select(F.col("id").alias(id_col), "component_id")


def text_version(text_col: str) -> Column:
    return F.unhex(F.sha2(body(text_col), 256))


def first_of_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when of each group of ``similar_documents`` one does: the whole
    row with the smallest id (null after all others), then the smallest digest of its text.

    Rows are told apart by id and text, so rows with null or repeated ids are decided one by one; of
    rows equal in both one stays.
    """
    found = similar_rows(docs, id_col, text_col, confirm=True, **options)
    rows = found.groupBy("root", "id", "version").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("version"))
    kept = rows.groupBy("root").agg(F.min_by(F.struct("id", "version", "copies"), order).alias("kept"))
    kept = stored(kept.select(F.col("kept.id").alias("kept_id"), F.col("kept.version").alias("kept_version"), F.col("kept.copies").alias("kept_copies")), "kept")
    same = (text_version(text_col) == F.col("kept_version")) & F.col(id_col).eqNullSafe(F.col("kept_id"))
    single = docs.join(kept.where("kept_copies = 1"), same, "left_semi")
    repeated = docs.join(kept.where("kept_copies > 1"), same)
    one = repeated.groupBy("kept_version", "kept_id").agg(F.first(F.struct(*(docs[c] for c in docs.columns))).alias("row")).select("row.*")
    return single.unionByName(one)


def similar_rows(docs: DataFrame, id_col: str, text_col: str, words: int = 5, similarity: float = 0.8, tree_members: int = TREE_MEMBERS, confirm: bool = True) -> DataFrame:
    """Each row's id, version (digest of its text), root (a number of its group) and component_id."""
    rows = docs.select(F.col(id_col).alias("id"), text_version(text_col).alias("version"), body(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def mark(ids: list, versions: list[bytes], texts: list[str]) -> Iterator[tuple]:
        for key, version, text in zip(ids, versions, texts):
            hashes = np.unique(shingle_hashes(text, words))
            yield key, version, hashlib.sha256(hashes.astype("<u8").tobytes()).digest(), wide_fingerprint(hashes, WIDE_BITS), band_keys(hashes)

    schema = pa.schema([("id", arrow_type(kind)), ("version", pa.binary()), ("fp", pa.binary()), ("bits", pa.binary()), ("bands", pa.list_(pa.int64()))])
    marked = stored(rows.mapInArrow(by_slice(mark, schema), f"id {kind}, version binary, fp binary, bits binary, bands array<bigint>"), "fingerprints")
    grouped = marked.groupBy("fp").agg(F.min("id").alias("least"), *(F.min(c).alias(c) for c in ("version", "bits", "bands")))
    nodes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    expected = differing_bits(similarity, WIDE_BITS)
    radius = int(expected + (CONFIRMED_SLACK if confirm else WIDE_SLACK) * math.sqrt(expected * (1 - expected / WIDE_BITS)))
    keyed = nodes.select("node", "bits", F.posexplode("bands").alias("t", "key"))
    ordered = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    proposed = stored(link_shards(keyed, radius, tree_members).select(*ordered).distinct(), "proposed")

    def connected(edges: DataFrame) -> DataFrame:
        classes = component_ids(nodes, "node", roots(edges))
        return marked.select("id", "version", "fp").join(classes, "fp").select("id", "version", "root", "component_id")

    if not confirm:
        return connected(proposed)

    def gather(numbers: list[int], texts: list[str]) -> Iterator[tuple]:
        return zip(numbers, (np.unique(shingle_hashes(t, words)).astype("<u8").tobytes() for t in texts))

    wanted = proposed.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "version"), "node")
    texts = rows.select("version", "text").dropDuplicates(["version"]).join(wanted, "version").select("node", "text")
    sets = stored(texts.mapInArrow(by_slice(gather, pa.schema([("node", pa.int64()), ("hashes", pa.binary())])), "node long, hashes binary"), "shingles")
    edges = stored(confirmed(proposed, sets, similarity), "confirmed")
    refused = proposed.join(edges, ["a", "b"], "left_anti")
    if not refused.isEmpty():
        loose = roots(proposed)
        doubtful = refused.select("a").distinct().join(loose, F.col("a") == F.col("node"), "left").select(F.coalesce("root", "a").alias("root")).distinct()
        members = loose.join(doubtful, "root", "left_semi").select("node").unionByName(doubtful.select(F.col("root").alias("node")))
        known = roots(edges).withColumnRenamed("root", "label")
        labelled = members.join(known, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
        labelled = stored(labelled.join(nodes, "node").select("node", "label", "bits", F.posexplode("bands").alias("t", "key")), "doubtful")
        # Only shards that hold nodes not connected yet.
        mixed = labelled.groupBy("t", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        again = labelled.join(mixed.select("t", "key"), ["t", "key"], "left_semi")
        edges = edges.unionByName(stored(link_shards(again, radius, tree_members, sets, similarity), "confirmed"))
    return connected(edges)


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
