"""Approximate nearest neighbours: a graph by NN-descent, searched greedily for many queries at once.

All joins are dealt out in blocks: a block gets the rows that name its nodes and every vector it
needs once, so its size is bounded by the block and the degree, whatever the table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobsignals.llm.common import bounded_sample, discard, free_rounds, query, stored, table

K = 32  # neighbours a node keeps in the graph
TREES = 3  # random projection trees that start it; links of a single one would not leave its leaves
LEAF = 2048  # vectors that are compared exhaustively at the start
SAMPLE = 10_000  # vectors the trees are fitted on; all vectors are indexed
BLOCK = 2048  # nodes of a block
DEGREE = 128  # links of one node in one row; more go to further rows
SETTLED = 0.1  # share of changed links at which the graph is left as it is
BEAM = 400  # nearest nodes a search keeps, and expands all of
HOME = 64  # searches whose beams are kept up to date together
SEED = 7


# --- vectors


def usable(vec: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def classes_of(vectors: DataFrame, id_col: str, vec_col: str, keep: int) -> DataFrame:
    """One row per different vector: node (smallest id), vec, and its ``keep`` smallest ids.

    The rank limit acts before the shuffle, so of a vector that a third of all rows share, a map
    task sends ``keep`` rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(F.col("id").isNotNull() & usable(F.col("vec")))
    rows = rows.groupBy("id").agg(F.min("vec").alias("vec"))
    top = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    rows = rows.where(F.size("vec") == (top.dim if top else 0))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("rank") <= keep)
    return ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members")).select(F.col("members")[0].alias("node"), "vec", "members")


def blocks_for(n: int) -> int:
    """A prime, so that ids in steps of any other number are spread evenly."""
    blocks = max(1, math.ceil(n / BLOCK))
    while any(blocks % i == 0 for i in range(2, math.isqrt(blocks) + 1)):
        blocks += 1
    return blocks


def block_of(node: str, blocks: int) -> Column:
    return F.pmod(F.col(node), F.lit(blocks)).cast("int")


def matrix(column: pa.ChunkedArray, kind=np.float32) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def flat_lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a list column."""
    joined = column.combine_chunks()
    return joined.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), joined.flatten().to_numpy(zero_copy_only=False)


def list_column(starts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values))


def nearest_of(owner: np.ndarray, other: np.ndarray, d: np.ndarray, done: np.ndarray, most: int) -> tuple:
    """Of (owner, other) pairs each once, a done one before others, the ``most`` nearest by owner:
    (owners, starts of their lists, others, distances, done)."""
    order = np.lexsort((~done, other, owner))
    owner, other, d, done = owner[order], other[order], d[order], done[order]
    if len(owner):
        once = np.r_[True, (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])]
        owner, other, d, done = owner[once], other[once], d[once], done[once]
    order = np.lexsort((other, d, owner))
    owner, other, d, done = owner[order], other[order], d[order], done[order]
    owners, first, counts = np.unique(owner, return_index=True, return_counts=True)
    kept = np.arange(len(owner)) - np.repeat(first, counts) < most
    starts = np.r_[0, np.cumsum(np.minimum(counts, most))[:-1]] if len(owners) else np.zeros(0, np.int64)
    return owners, starts, other[kept], d[kept], done[kept]


# One row per node, and what tasks send each other: one row per block with all pairs for its nodes.
LISTS = "node long, ids array<long>, ds array<double>, done array<boolean>"
PARCELS = "at int, owner array<long>, other array<long>, d array<double>"


def parcels(owner: np.ndarray, other: np.ndarray, d: np.ndarray, most: int, blocks: int) -> pa.Table:
    """The ``most`` nearest pairs of each owner, packed by the block that the owner belongs to."""
    owners, starts, others, ds, _ = nearest_of(owner, other, d, np.zeros(len(owner), bool), most)
    owner = np.repeat(owners, np.diff(np.append(starts, len(others))))
    order = np.argsort(owner % blocks, kind="stable")
    owner, others, ds = owner[order], others[order], ds[order]
    at, first = np.unique(owner % blocks, return_index=True)
    columns = {"owner": owner.astype(np.int64), "other": others.astype(np.int64), "d": ds.astype(np.float64)}
    return pa.table({"at": pa.array(at.astype(np.int32)), **{n: list_column(first, c) for n, c in columns.items()}})


def merge(lists: DataFrame, sent: DataFrame, most: int, blocks: int) -> DataFrame:
    """The lists of ``lists``, whose entries are done, with what was sent for them."""

    def together(lists: pa.Table, sent: pa.Table) -> pa.Table:
        counts, ids = flat_lists(lists["ids"])
        owner = np.concatenate([np.repeat(lists["node"].to_numpy(), counts), flat_lists(sent["owner"])[1]])
        other = np.concatenate([ids, flat_lists(sent["other"])[1]])
        d = np.concatenate([flat_lists(lists["ds"])[1], flat_lists(sent["d"])[1]])
        owners, starts, others, ds, done = nearest_of(owner, other, d, np.arange(len(owner)) < len(ids), most)
        return pa.table({"node": pa.array(owners.astype(np.int64)), "ids": list_column(starts, others.astype(np.int64)), "ds": list_column(starts, ds.astype(np.float64)), "done": list_column(starts, done)})

    known = lists.select(block_of("node", blocks).alias("block"), "node", "ids", "ds")
    return known.groupBy("block").cogroup(sent.groupBy("at")).applyInArrow(together, LISTS)


# --- the graph


class ProjectionTree:
    """Medians of random projections, fitted on a sample down to ``leaf`` of its rows."""

    def __init__(self, sample: np.ndarray, leaf: int, seed: int):
        self.rng = np.random.default_rng(seed)
        self.normals: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.below: list[tuple[int, int]] = []  # children: a node, or a leaf as -1 - its number
        self.leaves = 0
        self.root = self.grow(sample, leaf)
        del self.rng

    def grow(self, rows: np.ndarray, leaf: int) -> int:
        normal = self.rng.normal(size=rows.shape[1]).astype(np.float32)
        place = rows @ normal
        cut = float(np.median(place)) if len(rows) else 0.0
        high = place > cut
        if len(rows) <= leaf or not high.any() or high.all():
            self.leaves += 1
            return -self.leaves
        at = len(self.cuts)
        self.normals.append(normal)
        self.cuts.append(cut)
        self.below.append((0, 0))
        self.below[at] = (self.grow(rows[~high], leaf), self.grow(rows[high], leaf))
        return at

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        open_nodes = [(self.root, np.arange(len(rows)))]
        while open_nodes:
            node, at = open_nodes.pop()
            if node < 0:
                out[at] = -1 - node
                continue
            high = rows[at] @ self.normals[node] > self.cuts[node]
            open_nodes += [(self.below[node][0], at[~high]), (self.below[node][1], at[high])]
        return out


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)


def leaves_of(nodes: DataFrame, n: int, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(tree, leaf, node, vec, part): each node's leaf in every random tree; a leaf that holds more
    than twice what it should is cut into parts by a hash."""
    picked = bounded_sample(nodes, "node", n, SAMPLE).select("vec").toArrow()
    sample = matrix(picked["vec"])
    size = max(16, leaf * len(sample) // n)
    forest = [ProjectionTree(sample, size, SEED + i) for i in range(trees)]

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                rows = matrix(pa.chunked_array([batch.column(1)]))
                for i, tree in enumerate(forest):
                    yield pa.record_batch([pa.array(np.full(len(rows), i, np.int32)), pa.array(tree.leaf_of(rows)), batch.column(0), batch.column(1)], names=["tree", "leaf", "node", "vec"])

    vec = nodes.schema["vec"].dataType.simpleString()
    dealt = stored(nodes.select("node", "vec").mapInArrow(deal, f"tree int, leaf long, node long, vec {vec}"), "leaves")
    # At most SAMPLE / 16 leaves a tree, so this broadcast is bounded.
    parts = dealt.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * leaf)).cast("int").alias("parts"))
    return dealt.join(F.broadcast(parts), ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts")).drop("parts")


def first_lists(nodes: DataFrame, n: int, k: int, trees: int, leaf: int, blocks: int, leaves: DataFrame | None = None) -> DataFrame:
    """Lists from exhaustive comparison in the leaves of random trees (``leaves``, if they are there)."""
    cut = leaves_of(nodes, n, trees, leaf) if leaves is None else leaves

    def compare(t: pa.Table) -> pa.Table:
        ids, rows = t["node"].to_numpy(), matrix(t["vec"])
        most = min(k, len(ids) - 1)
        owner, other, near = [ids[:0]], [ids[:0]], [np.zeros(0, np.float32)]
        for at in range(0, len(ids) if most > 0 else 0, 512):
            d = squared(rows[at : at + 512], rows)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            best = np.argpartition(d, most - 1, axis=1)[:, :most]
            owner.append(np.repeat(ids[at : at + 512], most))
            other.append(ids[best].ravel())
            near.append(np.take_along_axis(d, best, 1).ravel())
        owner, other, near = map(np.concatenate, (owner, other, near))
        return parcels(owner, other, near, k, blocks)

    empty = nodes.sparkSession.createDataFrame([], LISTS)
    return merge(empty, cut.groupBy("tree", "leaf", "part").applyInArrow(compare, PARCELS), k, blocks)


def links_of(graph: DataFrame, turn: int = 0) -> DataFrame:
    """(node, part, other, done): every link from both its ends. The links of a node that many
    others list are cut into parts of about ``DEGREE``, otherwise in every ``turn``; none is left out."""
    ends = F.explode(F.arrays_zip("ids", "done")).alias("e")
    out = graph.select("node", ends).select("node", F.col("e.ids").alias("other"), F.col("e.done").alias("done"))
    both = out.unionByName(out.select(F.col("other").alias("node"), F.col("node").alias("other"), "done"))
    many = both.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / DEGREE).cast("int").alias("parts"))
    return both.join(many.hint("merge"), "node").select("node", F.pmod(F.xxhash64("other", F.lit(turn)), "parts").cast("int").alias("part"), "other", "done")


def improve(graph: DataFrame, nodes: DataFrame, k: int, blocks: int, turn: int = 0) -> DataFrame:
    """One round of NN-descent: the neighbours of a node get to know each other, unless both links
    were there in an earlier round already."""
    links = links_of(graph, turn).withColumn("block", F.pmod(F.xxhash64("node", "part"), F.lit(blocks)).cast("int"))
    lists = graph.select("node", F.element_at("ds", -1).alias("worst"), F.size("ids").alias("n"))
    known = nodes.select("node", "vec").join(lists.hint("merge"), "node")
    needed = links.select(F.col("block").alias("at"), F.col("other").alias("node")).distinct().join(known.hint("merge"), "node").select("at", "node", "vec", "worst", "n")

    def meet(links: pa.Table, members: pa.Table) -> pa.Table:
        ids = members["node"].to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        rows = matrix(members["vec"])[order]
        # A list that is not full takes any neighbour.
        worst = np.where(members["n"].to_numpy()[order] < k, np.inf, members["worst"].to_numpy()[order]).astype(np.float32)
        centre, part = links["node"].to_numpy(), links["part"].to_numpy()
        at, fresh = np.searchsorted(ids, links["other"].to_numpy()), ~links["done"].to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort((~fresh, at, part, centre))
        centre, part, at, fresh = centre[order], part[order], at[order], fresh[order]
        edges = np.flatnonzero(np.r_[True, (centre[1:] != centre[:-1]) | (part[1:] != part[:-1]), True])
        found = [(at[:0], at[:0], worst[:0])]
        for a, b in zip(edges[:-1], edges[1:]):
            m, f = at[a:b], fresh[a:b]
            if not f.any():
                continue
            once = np.r_[True, m[1:] != m[:-1]]
            m, f = m[once], f[once]
            x = rows[m]
            d = squared(x, x)
            good = (f[:, None] | f[None]) & (d < worst[m][:, None])
            np.fill_diagonal(good, False)
            i, j = np.nonzero(good)
            found.append((m[i], m[j], d[i, j]))
        owner, other, d = (np.concatenate(c) for c in zip(*found))
        return parcels(ids[owner], ids[other], d, k, blocks)

    met = links.groupBy("block").cogroup(needed.groupBy("at")).applyInArrow(meet, PARCELS)
    return merge(graph, met, k, blocks)


def build_graph(nodes: DataFrame, n: int, k: int = K, trees: int = TREES, leaf: int = LEAF, settled: float = SETTLED, leaves: DataFrame | None = None) -> DataFrame:
    """(node, ids, ds, done) by NN-descent, until a round changes less than ``settled`` of the links;
    each round's write counts what it changed."""
    blocks = blocks_for(n)
    graph = stored(first_lists(nodes, n, k, trees, leaf, blocks, leaves), "graph")
    turn = 0
    while True:
        turn, counts = turn + 1, Observation()
        changed, all_links = F.sum(F.size(F.filter("done", lambda x: ~x))), F.sum(F.size("done"))
        last, graph = graph, stored(improve(graph, nodes, k, blocks, turn).observe(counts, changed.alias("changed"), all_links.alias("links")), "graph")
        discard(last)
        free_rounds(nodes.sparkSession)
        if not counts.get["changed"] or counts.get["changed"] < settled * counts.get["links"]:
            return graph


# --- the search


def walkable(graph: DataFrame, nodes: DataFrame, places: DataFrame) -> DataFrame:
    """What a block holds to walk in, (at, node, vec, others, others_at): a row with the vector of
    each node, and rows with its links. ``places`` (node, at) names each node's block; every link
    carries that of its end."""
    there = places.select(F.col("node").alias("other"), F.col("at").alias("other_at"))
    links = links_of(graph).select("node", "part", "other").join(there.hint("merge"), "other")
    rows = links.groupBy("node", "part").agg(F.collect_set(F.struct("other", "other_at")).alias("ends"))
    vec = nodes.schema["vec"].dataType.simpleString()
    ends = places.join(rows.hint("merge"), "node").select("at", "node", F.lit(None).cast(vec).alias("vec"), F.col("ends.other").alias("others"), F.col("ends.other_at").alias("others_at"))
    vectors = places.join(nodes.select("node", "vec").hint("merge"), "node")
    return ends.unionByName(vectors.select("at", "node", "vec", F.lit(None).cast("array<long>").alias("others"), F.lit(None).cast("array<int>").alias("others_at")))


class Block:
    """The nodes of a block with their vectors and links inside it, and the walk of one search there."""

    def __init__(self, stock: pa.Table):
        has = stock["vec"].is_valid().to_numpy(zero_copy_only=False)
        held = stock.filter(pa.array(has))
        order = np.argsort(held["node"].to_numpy())
        self.ids = held["node"].to_numpy()[order]
        self.rows = matrix(held["vec"], np.float64)[order]
        linked = stock.filter(pa.array(~has))
        counts, ends = flat_lists(linked["others"])
        owner = np.repeat(np.searchsorted(self.ids, linked["node"].to_numpy()), counts)
        local = np.minimum(np.searchsorted(self.ids, ends), max(0, len(self.ids) - 1))
        inside = self.ids[local] == ends if len(self.ids) else np.zeros(len(ends), bool)
        owner, local = owner[inside], local[inside]
        order = np.argsort(owner, kind="stable")
        self.ends = local[order]
        self.first = np.searchsorted(owner[order], np.arange(len(self.ids) + 1))

    def linked(self, at: np.ndarray) -> np.ndarray:
        """Places of the nodes that those at ``at`` are linked with."""
        sizes = self.first[at + 1] - self.first[at]
        return np.unique(self.ends[np.repeat(self.first[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())])

    def places_of(self, ids: np.ndarray) -> np.ndarray:
        """Where the block holds those of ``ids`` that it has."""
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.unique(at[self.ids[at] == ids])

    def walk(self, vec: np.ndarray, start: np.ndarray, known: np.ndarray, worst: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the nodes reached that may be among the ``beam`` nearest. ``known`` nodes
        are left out. A search that has not yet found ``beam`` nodes, so that any distance would lead
        on, goes no further than to ``start``."""
        seen = np.zeros(len(self.ids), bool)
        seen[self.places_of(known)] = True
        front, walks = self.places_of(start), worst < np.inf
        front = front[~seen[front]]
        near, ds = [front[:0]], [np.zeros(0)]
        while len(front):
            seen[front] = True
            diff = self.rows[front] - vec
            d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            good = d < worst
            front, d = front[good], d[good]
            near.append(front)
            ds.append(d)
            if not walks:
                break
            found = np.concatenate(ds)
            if len(found) >= beam:
                worst = min(worst, float(np.partition(found, beam - 1)[beam - 1]))
            front = self.linked(front)
            front = front[~seen[front]]
        at, d = np.concatenate(near), np.concatenate(ds)
        best = np.lexsort((self.ids[at], d))[:beam]
        return self.ids[at[best]], d[best]


def search_graph(graph: DataFrame, nodes: DataFrame, places: DataFrame, starts: DataFrame, beam: int = BEAM) -> DataFrame:
    """For each node of ``starts`` (node, vec) the nodes nearest to it: (node, ids, ds), itself
    included; distances are in double precision.

    A search keeps its ``beam`` nearest nodes. A round looks up the links of those it has not followed
    yet, and visits the blocks where they end: there it walks on from node to nearer node as far as
    the block's own links lead. What it found comes back without links, so that links are looked up
    only for nodes that are among the nearest of all blocks: what a search moves in a round is bounded
    by ``beam`` and the links of a node, however many blocks there are. A round serves all searches,
    and all end when no search has a kept node left whose links were not followed. ``places`` puts
    near nodes into one block.
    """
    homes = max(1, math.ceil(starts.count() / HOME))
    stock = stored(walkable(graph, nodes, places), "ways")
    links = stock.where(F.col("others").isNotNull()).select("node", F.arrays_zip("others", "others_at").alias("ends"))
    itself = (F.array("node").alias("ids"), F.array(F.lit(0.0)).alias("ds"), F.array(F.lit(False)).alias("done"))
    state = stored(starts.select("node", *itself), "beam")

    def look(asked: pa.Table, stock: pa.Table) -> pa.Table:
        owner, other, near = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if asked.num_rows and stock.num_rows:
            block, vectors = Block(stock), matrix(asked["vec"], np.float64)
            searches, worsts, wanted, known = asked["search"].to_numpy(), asked["worst"].to_numpy(), asked["wanted"], asked["ids"]
            for i in range(len(searches)):
                start, kept = (lists[i].values.to_numpy(zero_copy_only=False) for lists in (wanted, known))
                ids, ds = block.walk(vectors[i], start, kept, worsts[i], beam)
                owner.append(np.full(len(ids), searches[i]))
                other.append(ids)
                near.append(ds)
        return parcels(*map(np.concatenate, (owner, other, near)), beam, homes)

    while True:
        worst = F.when(F.size("ids") < beam, float("inf")).otherwise(F.get("ds", F.lit(beam - 1))).alias("worst")
        asks = state.select("node", "ids", worst).join(starts, "node").withColumnRenamed("node", "search")
        fresh = state.select(F.col("node").alias("search"), F.explode(F.filter(F.arrays_zip("ids", "done"), lambda x: ~x["done"])).alias("e"))
        ends = fresh.select("search", F.col("e.ids").alias("node")).join(links, "node").select("search", F.explode("ends").alias("e"))
        # One row for each block that a search visits, with all ids it wants there.
        visits = ends.groupBy("search", F.col("e.others_at").alias("at")).agg(F.collect_set("e.others").alias("wanted"))
        seen = visits.join(asks, "search").groupBy("at").cogroup(stock.select("at", "node", "vec", "others").groupBy("at")).applyInArrow(look, PARCELS)
        open_ends = Observation()
        left = F.sum(F.size(F.filter("done", lambda x: ~x))).alias("n")
        last, state = state, stored(merge(state, seen, beam, homes).observe(open_ends, left), "beam")
        discard(last)
        free_rounds(nodes.sparkSession)
        if not open_ends.get["n"]:
            discard(stock)
            return state.select("node", "ids", "ds")


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 10) -> DataFrame:
    """For each row of ``vectors`` that ``is_query`` (an expression on ``id_col``) names, its ``top``
    nearest others by Euclidean distance: query_id, rank from 1, id, score; ties to smaller ids.

    Equal vectors are one node of the graph; with the ``top`` + 1 smallest ids of each node the
    answer is the same as if all copies were nodes. Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do null ids, nor vectors not of the commonest length; of
    several vectors of an id the smallest counts. Other columns are not read. An empty table, or one
    of a single vector, gives an empty result. Recall is approximate by nature; tests measure it.
    """
    nodes = stored(classes_of(vectors, id_col, vec_col, top + 1), "nodes")
    n = nodes.count()
    chosen = vectors.where(is_query).select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("vec")).where(F.col("query_id").isNotNull() & usable(F.col("vec")))
    chosen = chosen.groupBy("query_id").agg(F.min("vec").alias("vec"))
    asked = stored(chosen.join(nodes.select("node", "vec"), "vec"), "queries")
    starts = stored(asked.groupBy("node").agg(F.first("vec").alias("vec")), "starts")
    if n:
        leaves = leaves_of(nodes, n)
        # A leaf of the first tree, or a part of one, is a block of near nodes.
        at = F.pmod(F.xxhash64("leaf", "part"), F.lit(2**31 - 1)).cast("int").alias("at")
        places = stored(leaves.where("tree = 0").select("node", at), "places")
        graph = build_graph(nodes, n, leaves=leaves)
    found = search_graph(graph, nodes, places, starts) if n else starts.select("node", F.array("node").alias("ids"), F.array(F.lit(0.0)).alias("ds"))
    near = found.select("node", F.explode(F.arrays_zip("ids", "ds")).alias("e")).select("node", F.col("e.ids").alias("other"), F.col("e.ds").alias("score"))
    copies = nodes.select(F.col("node").alias("other"), "members")
    listed = near.join(copies, "other").select("node", "score", F.explode("members").alias("id"))
    # Per search only the nearest can count: those before the query itself is left out.
    listed = listed.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("score", "id"))).where(F.col("r") <= top + 1).drop("r")
    best = listed.join(asked.select("query_id", "node"), "node").where(F.col("id") != F.col("query_id"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


@query("op10_ann")
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
