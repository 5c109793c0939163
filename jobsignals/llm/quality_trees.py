"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import arrow_type, body, bounded_sample, query, slices, table

SAMPLE_ROWS, TREES, DEPTH, BINS, RATE, SHRINK, LEAST_ROWS = 20_000, 80, 4, 64, 0.15, 1.0, 8.0
FOLDS, HELD_OUT = 4, 2

# --- statistics

# Each byte's class; bytes that go on a character have none.
CLASSES = ["upper", "lower", "digit", "blank", "line", "stop", "mark", "quote", "bracket", "bar", "symbol", "control", "wide"]


def _class_table() -> np.ndarray:
    groups = {"stop": b".,;:", "mark": b"!?", "quote": b"\"'`", "bracket": b"()[]{}<>", "bar": b"|", "blank": b" \t", "line": b"\n\r"}
    kinds = np.full(256, CLASSES.index("symbol"), np.int64)
    for b in range(256):
        char = chr(b)
        if b >= 128:
            kinds[b] = len(CLASSES) if b < 192 else CLASSES.index("wide")
        elif char.isalpha():
            kinds[b] = CLASSES.index("upper" if char.isupper() else "lower")
        elif char.isdigit():
            kinds[b] = CLASSES.index("digit")
        elif b < 32 or b == 127:
            kinds[b] = CLASSES.index("control")
    for name, members in groups.items():
        kinds[list(members)] = CLASSES.index(name)
    return kinds


BYTE_CLASS = _class_table()
FEATURES = [
    "log_chars", "log_words", "log_lines", *CLASSES, "capitals", "entropy",
    "word_mean", "word_deviation", "word_longest", "distinct_words", "root_words", "top_word", "repeated_next", "distinct_pairs",
    "word_ends_sign", "word_starts_capital", "words_single", "words_with_sign_only",
    "line_mean", "line_deviation", "repeated_lines", "short_lines", "closed_lines",
]


def entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / max(1, counts.sum())
    return float(-(p * np.log2(p)).sum())


def statistics(text: str) -> list[float]:
    """The values of ``FEATURES`` for a whole text; an empty one has zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    by_class = np.bincount(BYTE_CLASS, weights=counts, minlength=len(CLASSES) + 1)[: len(CLASSES)]
    chars = max(1.0, by_class.sum())
    letters = max(1.0, by_class[0] + by_class[1])
    words = raw.split()
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen = Counter(words)
    ends = BYTE_CLASS[np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)]
    starts = BYTE_CLASS[np.frombuffer(b"".join(w[:1] for w in words), np.uint8)]
    sign, stop = CLASSES.index("mark"), CLASSES.index("stop")
    strange = ((ends >= sign) & (ends < CLASSES.index("control"))).sum()
    lines = [line for line in map(bytes.strip, raw.split(b"\n")) if line]
    widths = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1, np.int64)
    many = max(1, len(lines))
    return [
        math.log1p(chars), math.log1p(len(words)), math.log1p(len(lines)), *(by_class / chars), by_class[0] / letters, entropy(counts),
        sizes.mean(), sizes.std(), math.log1p(sizes.max()), len(seen) / n, len(seen) / math.sqrt(n), max(seen.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n, len(set(zip(words, words[1:]))) / n,
        strange / n, (starts == 0).sum() / n, (sizes == 1).sum() / n, ((starts >= stop) & (starts < CLASSES.index("control")) & (sizes == 1)).sum() / n,
        math.log1p(widths.mean()), math.log1p(widths.std()), 1 - len(set(lines)) / many, (widths < 20).sum() / many, sum(line.endswith((b".", b"!", b"?")) for line in lines) / many,
    ]


def statistics_of(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts], np.float64).reshape(len(texts), len(FEATURES))


# --- trees


@dataclass
class Forest:
    """Trees of equal depth in flat arrays: below node i are 2i + 1 (value at most the cut) and
    2i + 2. ``features`` and ``cuts`` are (tree, inner node), ``leaves`` (tree, leaf)."""

    bias: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.leaves))[None]
        at = np.zeros((len(x), len(self.leaves)), np.int64)
        inner = self.features.shape[1]
        for _ in range(int(math.log2(inner + 1))):
            at = 2 * at + 1 + (x[rows, self.features[trees, at]] > self.cuts[trees, at])
        return self.bias + self.leaves[trees, at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def bin_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """(feature, bins - 1) cuts at quantiles of the different values; unused places are infinite."""
    cuts = np.full((x.shape[1], bins - 1), np.inf)
    for j, column in enumerate(x.T):
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        chosen = middles if len(middles) < bins else np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower"))
        cuts[j, : len(chosen)] = chosen[: bins - 1]
    return cuts


def best_splits(keys: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, shape: tuple[int, int], shrink: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(feature, bin) of each node's best split by its histograms, bin -1 where none helps. ``keys``
    are (row, feature) places of a row's bins in the histograms of all nodes."""
    n_features, bins = shape

    def histogram(weights: np.ndarray) -> np.ndarray:
        flat = np.bincount(keys.ravel(), np.repeat(weights, n_features), minlength=nodes * n_features * bins)
        return flat.reshape(nodes, n_features, bins).cumsum(axis=2)

    left_g, left_h, left_n = histogram(g), histogram(h), histogram(np.ones(len(g)))
    all_g, all_h, all_n = (x[:, :1, -1:] for x in (left_g, left_h, left_n))

    def gain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * a / (b + shrink)

    gains = gain(left_g, left_h) + gain(all_g - left_g, all_h - left_h) - gain(all_g, all_h)
    gains[(left_n < least) | (all_n - left_n < least)] = 0
    flat = gains.reshape(nodes, -1)
    best = flat.argmax(axis=1)
    helps = flat[np.arange(nodes), best] > 1e-9
    return best // bins, np.where(helps, best % bins, -1)


def boost(x: np.ndarray, y: np.ndarray, prior: float, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, shrink: float = SHRINK, least: float = LEAST_ROWS) -> Forest:
    """Newton boosting of the logistic loss; ``prior`` is the log odds that the trees start from."""
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    cuts = bin_cuts(x, bins)
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    n_features = x.shape[1]
    offsets = np.arange(n_features)[None] * bins
    inner = 2**depth - 1
    forest = Forest(prior, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    margin = np.full(len(y), prior)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = y - p, p * (1 - p) + 1e-9
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes = 2**level
            feature, cut = best_splits(at[:, None] * (n_features * bins) + offsets + binned, g, h, nodes, (n_features, bins), shrink, least)
            places = nodes - 1 + np.arange(nodes)
            forest.features[t, places] = np.where(cut >= 0, feature, 0)
            forest.cuts[t, places] = np.where(cut >= 0, cuts[feature, np.minimum(cut, bins - 2)], np.inf)
            bound = np.where(cut >= 0, cut, bins)
            at = 2 * at + (binned[np.arange(len(y)), feature[at]] > bound[at])
        sums_g, sums_h = (np.bincount(at, w, minlength=inner + 1) for w in (g, h))
        forest.leaves[t] = rate * sums_g / (sums_h + shrink)
        margin += forest.leaves[t][at]
    return forest


# --- on Spark


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Learn from at most ``sample_rows`` labelled ids, half of either class at most, chosen by a
    hash of the id; the trees start from the classes' shares among all labels.

    Null labels and null ids are left out, of several labels of an id the larger counts, of several
    texts of an id the smallest. Without rows of both classes every score is the smoothed share.
    Statistics are worked out in the tasks; the driver sees numbers of the sample only.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    share = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = share.get(1, 0), share.get(0, 0)
    picks = [bounded_sample(known.where(F.col("y") == y), "id", n, sample_rows // 2) for y, n in ((0, neg), (1, pos))]
    # At most sample_rows narrow rows, so this broadcast is bounded.
    chosen = F.broadcast(picks[0].unionByName(picks[1]))
    texts = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text")).join(chosen, "id").groupBy("id", "y").agg(F.min("text").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = statistics_of(part.column(1).to_pylist())
            yield pa.record_batch([part.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], names=["y", "x"])

    rows = texts.select("y", "text").mapInArrow(measure, "y int, x array<double>").toArrow()
    y = rows["y"].to_numpy().astype(np.float64)
    prior = math.log((pos + 0.5) / (neg + 0.5))
    n1, n0 = y.sum(), (1 - y).sum()
    if not (n1 and n0):
        return Forest(prior, np.zeros((1, 1), np.int64), np.full((1, 1), np.inf), np.zeros((1, 2)))
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), len(FEATURES))
    forest = boost(x, y, math.log(n1 / n0))
    # The sample holds other shares of the classes than the labels do.
    forest.bias += prior - math.log(n1 / n0)
    return forest


def score_quality(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, 0 to 1 and higher for better texts. Null text counts as empty; null
    and repeated ids are scored row by row, other columns are not read, an empty table gives none."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = pa.schema([("id", arrow_type(kind)), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.record_batch([part.column(0), pa.array(forest.score(statistics_of(part.column(1).to_pylist())))], schema=schema)

    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def held_out(key: str) -> Column:
    """Whether an id is held out; a null id always is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


@query("op12_quality_trees")
def op12_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    return score_quality(docs, forest).select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
