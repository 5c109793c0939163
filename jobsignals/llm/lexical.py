"""Ranked lexical search of many queries at once: term sets that queries share are added up once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobsignals.llm.common import arrow_type, body, discard, query, slices, stored, table

# Terms of queries that are ranked in one pass over the documents; more queries go to further passes.
BLOCK_TERMS = 50_000
# Partners that a term tries in a query when shared sets are mined.
REACH = 16
# Cells of the accumulators that a task holds at once.
CELLS = 2_000_000
# Bytes of a text that are cut into terms at once.
WINDOW = 1 << 20

# Letters and digits of ASCII (A to Z as a to z) and all bytes above stand for themselves, others part terms.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str) -> Iterator[list[bytes]]:
    """A text's terms in order, in lists of bounded length."""
    folded = text.encode("utf-8", "surrogatepass").translate(FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + WINDOW)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


# --- sharing among queries


@dataclass
class SharingPlan:
    """A DAG of partial sums. Nodes 0 to len(leaf_term) - 1 are a term times its repeats in a query;
    of every further node ``pairs`` has the two nodes that it adds, ``levels`` the ends of the runs
    of nodes that need earlier runs only. ``sources`` lists each query's nodes, from ``starts`` on."""

    leaf_term: np.ndarray
    leaf_times: np.ndarray
    pairs: np.ndarray
    levels: list[int]
    sources: np.ndarray
    starts: np.ndarray

    @property
    def nodes(self) -> int:
        return len(self.leaf_term) + len(self.pairs)

    def evaluate(self, weights: np.ndarray) -> np.ndarray:
        """Scores (query, document) from the terms' weights (term, document)."""
        acc = np.empty((self.nodes, weights.shape[1]), np.int64)
        n = len(self.leaf_term)
        np.multiply(weights[self.leaf_term], self.leaf_times[:, None], out=acc[:n])
        for end in self.levels:
            a, b = self.pairs[n - len(self.leaf_term) : end - len(self.leaf_term)].T
            np.add(acc[a], acc[b], out=acc[n:end])
            n = end
        return np.add.reduceat(acc[self.sources], self.starts, axis=0)


def mine_shared_sets(queries: list[dict[int, int]], reach: int = REACH) -> SharingPlan:
    """Plan for queries given as {term: repeats}, none empty.

    Pairs of nodes that at least two queries hold become a node of their own, most shared first,
    until no pair is left, so that shared sets of any size grow from pairs. A node tries only the
    ``reach`` next ones in the order of sharing: that bounds the work and changes no score.
    """
    leaves = {leaf: i for i, leaf in enumerate(sorted({leaf for q in queries for leaf in q.items()}))}
    held = [{leaves[leaf] for leaf in q.items()} for q in queries]
    where: dict[int, set[int]] = {}
    for i, nodes in enumerate(held):
        for node in nodes:
            where.setdefault(node, set()).add(i)
    made: list[tuple[int, int]] = []
    while True:
        together: Counter = Counter()
        for nodes in held:
            shared = sorted((n for n in nodes if len(where[n]) > 1), key=lambda n: (-len(where[n]), n))
            for i, a in enumerate(shared):
                together.update((a, b) if a < b else (b, a) for b in shared[i + 1 : i + 1 + reach])
        before = len(made)
        for (a, b), n in sorted(together.items(), key=lambda x: (-x[1], x[0])):
            both = where[a] & where[b] if n > 1 else ()
            if len(both) < 2:
                continue
            node = len(leaves) + len(made)
            made.append((a, b))
            where[node] = both
            for i in both:
                held[i] -= {a, b}
                held[i].add(node)
            where[a] = where[a] - both
            where[b] = where[b] - both
        if len(made) == before:
            break
    level = [0] * len(leaves)
    for a, b in made:
        level.append(1 + max(level[a], level[b]))
    order = sorted(range(len(level)), key=lambda n: (level[n], n))
    place = {n: i for i, n in enumerate(order)}
    pairs = np.array([[place[a], place[b]] for a, b in (made[n - len(leaves)] for n in order[len(leaves) :])], np.int64).reshape(-1, 2)
    ends = np.cumsum(np.bincount(level))[1:].tolist()
    sizes = [len(nodes) for nodes in held]
    return SharingPlan(
        np.array([t for t, _ in leaves], np.int64),
        np.array([n for _, n in leaves], np.int64),
        pairs,
        ends,
        np.array([p for nodes in held for p in sorted(place[n] for n in nodes)], np.int64),
        np.cumsum([0, *sizes[:-1]]),
    )


# --- documents


def index_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of every document (id, text) that has a term: all its terms counted, and
    those of the vocabulary with their occurrences."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = pa.schema([("id", arrow_type(kind)), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes, counted = [], []
            for text in part.column(1).to_pylist():
                n, found = 0, Counter()
                for terms in terms_of(text):
                    n += len(terms)
                    found.update(map(vocabulary.get, terms))
                found.pop(None, None)
                sizes.append(n)
                counted.append(found)
            columns = [part.column(0), pa.array(sizes, pa.int64())]
            columns += [pa.array(list(map(list, values)), kind) for values, kind in (((c.keys() for c in counted), schema[2].type), ((c.values() for c in counted), schema[3].type))]
            rows = pa.record_batch(columns, schema=schema)
            yield rows.filter(pa.array([n > 0 for n in sizes]))

    return docs.mapInArrow(run, f"id {kind}, n long, terms array<int>, tfs array<long>")


def document_frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term occurs; a task sends one row per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.record_batch([pa.array(held), pa.array(df[held])], names=["term", "df"])

    summed = index.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[summed["term"].to_numpy()] = summed["df"].to_numpy()
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def best_of(rows: pa.Table, top: int) -> pa.Table:
    """Of rows (query, id, score) each query's ``top`` best, ties to the smaller id, null ids last."""
    rows = rows.sort_by([("query", "ascending"), ("score", "descending"), ("id", "ascending")])
    numbers = rows["query"].to_numpy()
    first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(numbers) else np.zeros(0, np.int64)
    rank = np.arange(len(numbers)) - np.repeat(first, np.diff(np.r_[first, len(numbers)]))
    return rows.filter(pa.array(rank < top))


def rank_documents(index: DataFrame, plan: SharingPlan, weights: np.ndarray, n_docs: int, all_terms: int, top: int) -> DataFrame:
    """(query, id, score): each task's ``top`` best documents of every query, scores above 0."""
    kind = index.schema["id"].dataType.simpleString()
    schema = pa.schema([("query", pa.int32()), ("id", arrow_type(kind)), ("score", pa.int64())])
    held = max(16, CELLS // (plan.nodes + len(weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, least = schema.empty_table(), np.zeros((len(plan.starts), top), np.int64)
        for part in slices(batches, held):
            n = part.column(1).to_numpy()
            m = 25 + 75 * n * n_docs // all_terms
            lists = part.column(2)
            row = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy(zero_copy_only=False))
            term = lists.flatten().to_numpy(zero_copy_only=False)
            tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
            parts = np.zeros((len(weights), len(n)), np.int64)
            parts[term, row] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            scores = plan.evaluate(parts)
            # A document below the best ones seen so far is no candidate; one that equals the last may be.
            least = np.sort(np.concatenate([least, scores], axis=1), axis=1)[:, -top:]
            at, doc = np.nonzero(scores >= np.maximum(least[:, :1], 1))
            if len(at):
                found = pa.table([pa.array(at.astype(np.int32)), part.column(0).take(pa.array(doc)), pa.array(scores[at, doc])], schema=schema)
                best = best_of(pa.concat_tables([best, found]), top)
        yield from best.combine_chunks().to_batches()

    return index.mapInArrow(run, f"query int, id {kind}, score long")


# --- the operator


def blocks_of(items: DataFrame, block_terms: int) -> tuple[DataFrame, int]:
    """(id, terms, times) of the different items (id, text) that have terms, and the number of
    blocks that hold about ``block_terms`` terms each."""
    kind = items.schema["id"].dataType.simpleString()
    schema = pa.schema([("id", arrow_type(kind)), ("terms", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [Counter(t for terms in terms_of(text) for t in terms) for text in part.column(1).to_pylist()]
            yield pa.record_batch([part.column(0), pa.array([sorted(c) for c in found], schema[1].type), pa.array([[c[t] for t in sorted(c)] for c in found], schema[2].type)], schema=schema)

    cut = items.distinct().mapInArrow(run, f"id {kind}, terms array<binary>, times array<long>")
    cut = stored(cut.where(F.size("terms") > 0), "queries")
    blocks = max(1, math.ceil((cut.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms))
    return cut, blocks


def lexical_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", top: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Each item's ``top`` best documents: item, rank from 1, id, score; weights and saturation of
    terms in whole numbers, over all documents and all their terms.

    Items are read in blocks of about ``block_terms`` terms (the most that is broadcast). A block's
    sharing plan is mined once; documents become an index of the block's terms, a written table, and
    every task evaluates the plan for a slice of documents: a partial sum that several items share
    is added up once. A task keeps ``top`` documents an item, so no item's documents are gathered.

    Null texts have no terms; documents and items without terms take no part, and neither do
    documents that score 0. A document with null id ranks behind equal scores, rows that repeat an
    id are documents of their own, and so are different texts under one item id; an item row that repeats
    both counts once. Other columns are not read. Without documents or items the result is empty.
    """
    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"))
    cut, blocks = blocks_of(items.select(F.col(item_col).alias("id"), body(text_col).alias("text")), block_terms)
    out: DataFrame | None = None
    for block in range(blocks):
        asked = cut.where(F.pmod(F.xxhash64("id", "terms", "times"), F.lit(blocks)) == block).collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for q in asked for t in q.terms}))}
        index = stored(index_documents(rows, vocabulary), "lexical_index")
        n_docs, all_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        found = stored(ranked(index, asked, vocabulary, n_docs, all_terms or 1, top, cut.schema["id"].dataType.simpleString()), "ranked")
        discard(index)
        out = found if out is None else out.unionByName(found)
    discard(cut)
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def ranked(index: DataFrame, asked: list, vocabulary: dict[bytes, int], n_docs: int, all_terms: int, top: int, kind: str) -> DataFrame:
    """(item, rank, id, score) of one block."""
    names = index.sparkSession.createDataFrame([(i, q.id) for i, q in enumerate(asked)], f"query int, item {kind}")
    if asked:
        plan = mine_shared_sets([{vocabulary[bytes(t)]: n for t, n in zip(q.terms, q.times)} for q in asked])
        weights = term_weights(document_frequencies(index, len(vocabulary)), n_docs)
        found = rank_documents(index, plan, weights, n_docs, all_terms, top)
    else:
        found = index.select(F.lit(0).alias("query"), "id", F.col("n").alias("score")).limit(0)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # At most a block's items, so this broadcast is bounded.
    return best.join(F.broadcast(names), "query").select("item", "rank", "id", "score")


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms_sql(source: str, key: str) -> str:
    folded = f"translate({source}.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, unnest(regexp_extract_all({folded}, '{TERM}')) AS term FROM {source}"


@query(
    "op11_lexical_search",
    f"""
    WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    items AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    found AS ({_terms_sql("numbered", "r")}),
    asked AS (SELECT i, term, count(*) AS times FROM ({_terms_sql("items", "i")}) GROUP BY ALL),
    tfs AS (SELECT r, term, count(*) AS tf FROM found GROUP BY ALL),
    sizes AS (SELECT r, count(*) AS n FROM found GROUP BY r),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
    weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM tfs, total GROUP BY term, docs
    ),
    scores AS (
        SELECT i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
        FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (r), total
        GROUP BY i, r
    )
    SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scores JOIN numbered USING (r) JOIN items USING (i)
    WHERE score > 0
    QUALIFY rank <= 10
    """,
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
