"""Toxicity: a noisy-channel decoder restores obfuscated words, then a linear model scores them.

Writers hide a word by look-alike characters (``1d10t``), separators (``i.d.i.o.t``, ``i d i o t``)
and repeats (``idiiiot``). Each hidden word is a lattice of the letters its characters may stand
for; a Viterbi search finds the path that channel costs and a character language model like best.
A word of plain letters without long repeats has one path only and is taken as it is.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import body, by_slice, discard, free_rounds, query, slices, stored, table, with_values

# Which letters a character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "€": "e", "£": "l", "¥": "y", "*": "aeiou",
}

# Costs in nats of what the channel did: write a look-alike, insert a character, repeat a letter.
LOOKALIKE_COST, INSERT_COST, INSERT_DIGIT_COST, REPEAT_COST, DOUBLE_COST = 1.0, 1.5, 6.0, 0.3, 3.0
# Costs of a word's end: at a separator, at a gap wider than the others, after a word of one letter;
# and of no end at such a gap.
BREAK_COST, GAP_COST, ONE_LETTER_COST, NO_GAP_COST = 1.0, 0.5, 3.0, 2.0

ORDER = 4
LETTERS = 27  # a word's edge, then a to z
EDGE = "`"  # the character before 'a', so that its code is 0

LONG_RUN = re.compile(r"([a-z])\1\1")
RUN = re.compile(r"([a-z])\1*|([^\w\s])\2*|.", re.S)
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]{1,3}\S){2,}(?!\S)")
SPACED_LETTER = re.compile(r"(\S)([ \t]*)")
PUNCTUATION = ".,;:!?\"'()[]{}<>…«»“”-_*&%~=/\\"
BETWEEN_WORDS = re.compile(r"[,;:?\"/\\)\[\]{}…«»“”=]+")
BETWEEN_LONG_WORDS = re.compile(r"[.\-_](?=[a-z]{4})(?<=[a-z]{4}.)")
SEPARATORS = ".-_"
# Words of one letter.
ONE_LETTER_WORDS = "aioyeu"

MEMO_TOKENS, MEMO_LENGTH = 200_000, 64


def fold(token: str) -> str:
    """Accents and compatibility forms go: ``ïdìot`` and full-width letters become plain ones."""
    return "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c)).lower()


class CharModel:
    """Interpolated character n-grams over a to z and the edges of words; ``logp`` is indexed by the
    last ``ORDER`` codes in base ``LETTERS``, so its size is fixed."""

    def __init__(self, counts: np.ndarray):
        grams = counts.reshape((LETTERS,) * ORDER).astype(np.float64)
        lower = np.full(LETTERS, 1.0 / LETTERS)
        for n in range(1, ORDER + 1):
            seen = grams.sum(axis=tuple(range(ORDER - n))) if n < ORDER else grams
            total = seen.sum(axis=-1, keepdims=True)
            lower = (seen + 5.0 * lower) / (total + 5.0)
        self.logp = np.log(lower).ravel().tolist()

    @staticmethod
    def grams(words: Iterable[str]) -> np.ndarray:
        """The positions that ``words`` count at."""
        return CharModel.grams_of_words(words)[0]

    @staticmethod
    def grams_of_words(words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``grams``, and the place of the word that each of them comes from."""
        words = list(words)
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = "".join(EDGE * (ORDER - 1) + w + EDGE for w in words)
        codes = np.frombuffer(text.encode("ascii"), np.uint8).astype(np.int64) - ord(EDGE)
        keys = np.zeros(len(codes) - ORDER + 1, np.int64)
        for i in range(ORDER):
            keys = keys * LETTERS + codes[i : len(codes) - ORDER + 1 + i]
        kept = codes[ORDER - 1 :][: len(keys)] + codes[ORDER - 2 : -1][: len(keys)] > 0
        owner = np.repeat(np.arange(len(words)), [len(w) + ORDER for w in words])[ORDER - 1 :]
        return keys[kept], owner[kept]


def options(token: str) -> Iterable[list[tuple[str, float]]]:
    """The lattice: for each stretch of a token, what it may have been and at which cost. A run of
    one symbol stands for a letter, a doubled letter or nothing."""
    for m in RUN.finditer(token):
        c, n = m.group()[0], len(m.group())
        if "a" <= c <= "z":
            if n == 1:
                yield [(c, 0.0)]
            elif n == 2:
                yield [(c + c, 0.0), (c, DOUBLE_COST)]
            else:
                yield [(c, REPEAT_COST), (c + c, REPEAT_COST)]
        else:
            lost = INSERT_DIGIT_COST if c.isdigit() else INSERT_COST
            once = LOOKALIKE_COST + REPEAT_COST * (n > 1)
            doubled = ((x + x, once) for x in LOOKALIKES.get(c, "") if n > 1)
            yield [*((x, once) for x in LOOKALIKES.get(c, "")), *doubled, ("", lost)]


def options_of_words(part: str) -> Iterable[list[tuple[str, float]]]:
    """As ``options``; a separator may also end a word, which a blank stands for."""
    for i, piece in enumerate(re.split(r"([.\-_]+)", part)):
        if i % 2:
            yield [(" ", BREAK_COST), ("", INSERT_COST)]
        else:
            yield from options(piece)


def options_of_spaced(run: str) -> Iterable[list[tuple[str, float]]]:
    """As ``options`` for characters that stand apart: a word may end where a gap is wider than the
    least one, and a first or last word of one letter may be none of the hidden word's."""
    letters = SPACED_LETTER.findall(run)
    least = min(len(gap) for _, gap in letters[:-1])
    before = ""
    for i, (c, gap) in enumerate(letters):
        choices = list(next(iter(options(c))))
        if c == before:
            choices.append(("", DOUBLE_COST))
        if c in ONE_LETTER_WORDS and i in (0, len(letters) - 1):
            choices.append((" ", ONE_LETTER_COST))
        yield choices
        if len(gap) > least:
            yield [(" ", GAP_COST), ("", NO_GAP_COST)]
        before = c


def decode(token: str, model: CharModel) -> str:
    return best_path(options(token), model)


def best_path(lattice: Iterable[list[tuple[str, float]]], model: CharModel) -> str:
    """The best path through the lattice; equal paths: the smaller string's state first. A blank ends
    the word before it, if there is one, and the next begins."""
    logp, states = model.logp, LETTERS ** (ORDER - 1)
    # state of the language model -> (score, the path as a linked list)
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for choices in lattice:
        step: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, path) in sorted(best.items()):
            for letters, cost in choices:
                now, total, grown = state, score - cost, path
                for c in letters:
                    if c == " ":
                        total += logp[now * LETTERS] if now else 0.0
                        now, grown = 0, (grown, c)
                        continue
                    key = now * LETTERS + ord(c) - 96
                    total += logp[key]
                    now, grown = key % states, (grown, c)
                if now not in step or total > step[now][0]:
                    step[now] = (total, grown)
        best = step
    path = max(sorted(best.items()), key=lambda kv: kv[1][0] + (logp[kv[0] * LETTERS] if kv[0] or kv[1][1] is None or kv[1][1][1] != " " else 0.0))[1][1]
    out = []
    while path:
        path, c = path[0], path[1]
        out.append(c)
    return "".join(reversed(out))


def hides(part: str) -> bool:
    """Whether a part may hide a word: it holds a letter, or different look-alikes, mostly symbols."""
    if any("a" <= c <= "z" for c in part):
        return True
    alike = {c for c in part if c in LOOKALIKES}
    return len(alike) > 1 and 2 * sum(c.isdigit() for c in part) < len(part)


def restore_token(token: str, model: CharModel) -> list[str]:
    """The words of a lower-case token without white space."""
    if token.isascii() and token.isalpha():
        return [decode(token, model) if LONG_RUN.search(token) else token]
    token = fold(token)
    if ")" in token:
        token = token.replace("(", ",")
    token = token.rstrip(PUNCTUATION).lstrip(".,;:?\"'[]{}<>…«»“”-_&%~=/\\")
    words = []
    for part in (p for hard in BETWEEN_WORDS.split(token) for p in BETWEEN_LONG_WORDS.split(hard)):
        if part.isascii() and part.isalpha() and not LONG_RUN.search(part):
            words.append(part)
        elif part and hides(part):
            words += best_path(options_of_words(part), model).split()
    return words


def restore_spaced(run: str, model: CharModel) -> list[str]:
    """The words of a run of characters that stand apart."""
    return best_path(options_of_spaced(fold(run)), model).split()


def restore(text: str, model: CharModel) -> list[str]:
    """Every word of a text as a reader would take it, spaced-out words joined."""
    text = text.lower()
    words = [w for token in text.split() for w in restore_token(token, model)]
    return words + [w for m in SPACED.finditer(text) for w in restore_spaced(m.group(), model)]


# Lengths of word beginnings that are features besides whole words: inflected forms share them.
PREFIXES = (4, 5, 6)


def features_of(word: str) -> list[int]:
    return [zlib.crc32(word.encode()), *(zlib.crc32(f"^{word[:n]}".encode()) for n in PREFIXES if len(word) > n)]


def plain_words(text: str) -> set[str]:
    """The words of a text that leave nothing to decode."""
    words = (w.strip(PUNCTUATION) for w in text.lower().split())
    return {w for w in words if w.isascii() and w.isalpha() and not LONG_RUN.search(w)}


def features_of_token(token: str, chars: CharModel) -> tuple:
    """Of a token, or of a spaced run, which alone holds blanks."""
    words = (restore_token if len(token.split()) == 1 else restore_spaced)(token, chars)
    return tuple(f for w in words for f in features_of(w))


def features_of_text(text: str, memo: dict, of_token: Callable[[str], tuple]) -> set[int]:
    """The features of every word of a text, spaced-out words joined; ``memo`` keeps those of tokens."""
    text, found = text.lower(), set()
    for token in {*text.split(), *(m.group() for m in SPACED.finditer(text))}:
        features = memo.get(token)
        if features is None:
            features = of_token(token)
            if len(memo) < MEMO_TOKENS and len(token) <= MEMO_LENGTH:
                memo[token] = features
        found.update(features)
    return found


@dataclass
class ToxicityModel:
    """``weights`` by feature; at most ``fit_toxicity``'s number of them."""

    chars: CharModel
    bias: float
    weights: dict[int, float]
    memo: dict = field(default_factory=dict)

    def token_weights(self, token: str) -> tuple:
        return tuple(f for f in features_of_token(token, self.chars) if f in self.weights)

    def __getstate__(self):
        return {"chars": self.chars, "bias": self.bias, "weights": self.weights, "memo": {}}

    def score(self, text: str) -> float:
        found = features_of_text(text, self.memo, self.token_weights)
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))))


# Numbers that the pairs of one step of ``newton_sums`` take, about.
PAIRS = 1 << 20


def newton_sums(flat: np.ndarray, lengths: np.ndarray, ones: np.ndarray, zeros: np.ndarray, w: np.ndarray, scale: float = 2.0**40) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss over patterns: ``flat`` holds the places of the
    features of each, ``lengths`` their numbers; ``ones`` and ``zeros`` count its rows of either class.
    What a row adds is a multiple of 1 / ``scale``, so sums below 2**53 / ``scale`` are exact."""
    d = len(w)
    gradient, curvature = np.zeros(d), np.zeros(d * d)
    starts = np.cumsum(lengths) - lengths
    for a in np.unique(lengths):
        alike = np.flatnonzero(lengths == a)
        step = max(1, PAIRS // (a + 1) ** 2)
        for at in range(0, len(alike), step):
            rows = alike[at : at + step]
            places = np.full((len(rows), a + 1), d - 1)
            places[:, :a] = flat[starts[rows][:, None] + np.arange(a)]
            p = 1.0 / (1.0 + np.exp(-np.clip(w[places].sum(axis=1), -30, 30)))
            n = ones[rows] + zeros[rows]
            gradient += np.bincount(places.ravel(), np.repeat(n * np.rint(p * scale) / scale - ones[rows], a + 1), d)
            pairs = places[:, :, None] * d + places[:, None, :]
            curvature += np.bincount(pairs.ravel(), np.repeat(n * np.rint((p * (1 - p) + 1e-9) * scale) / scale, (a + 1) ** 2), d * d)
    return gradient, curvature.reshape(d, d)


def solve(patterns: DataFrame, d: int, n: int, penalty: float = 0.02) -> np.ndarray:
    """Ridge logistic regression by Newton steps over ``n`` rows of all ``patterns`` (f, ones, zeros);
    the last of ``d`` weights is the bias and goes unpenalised. A task adds up its rows and sends half of
    its symmetric matrix, so what comes to the driver is bounded by the tasks, however many files the
    patterns lie in. The sums are exact, so no order of rows or tasks changes them."""
    spark = patterns.sparkSession
    few = patterns.coalesce(min(spark.sparkContext.defaultParallelism, MOST_TASKS))
    scale = 2.0 ** (52 - int(n).bit_length())
    half = np.triu_indices(d)
    ridge = np.full(d, penalty)
    ridge[-1] = 1e-6
    w = np.zeros(d)
    for _ in range(30):

        def sums_of(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            gradient, curvature = np.zeros(d), np.zeros((d, d))
            for batch in slices(batches, 4096):
                f = batch.column(0)
                ones, zeros = batch.column(1).to_numpy().astype(float), batch.column(2).to_numpy().astype(float)
                more = newton_sums(f.flatten().to_numpy(), np.diff(f.offsets.to_numpy()), ones, zeros, w, scale)
                gradient, curvature = gradient + more[0], curvature + more[1]
            yield pa.record_batch([pa.array([np.concatenate([gradient, curvature[np.triu_indices(d)]]).tobytes()], pa.binary())], names=["sums"])

        sums = np.zeros(d + len(half[0]))
        for r in few.mapInArrow(sums_of, "sums binary").collect():
            sums += np.frombuffer(r.sums)
        free_rounds(spark)
        curvature = np.zeros((d, d))
        curvature[half] = sums[d:]
        curvature += np.triu(curvature, 1).T + np.diag(ridge)
        step = np.linalg.solve(curvature, sums[:d] + ridge * w)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-5:
            break
    return w


def telling(counted: DataFrame, n1: int, n0: int, limit: int) -> list:
    """The items of ``counted`` (i, rows of either class a and b) that tell the classes apart best, by
    chi-square."""
    n, a, b = F.lit(float(n1 + n0)), F.col("a"), F.col("b")
    chi = n * F.pow(a * (n0 - b) - b * (n1 - a), F.lit(2.0)) / (F.lit(float(n1)) * n0 * (a + b) * (n - a - b + 0.5))
    return [r.i for r in counted.where((a + b >= 3) & (a * n0 > b * n1)).orderBy(chi.desc(), "i").limit(limit).collect()]


def added_up(counts: DataFrame) -> DataFrame:
    """Counts (i, a, b) of slices, by item."""
    return counts.groupBy("i").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))


# Rows of texts that a part of the training texts holds, about.
TEXTS_IN_PART = 2_000
# Bits of the filter by which texts are left out before they are shuffled: eight a text, at most 4 MB.
MOST_BITS = 1 << 25
# Tasks of a Newton step, each of which sends half a matrix, 1 MB, to the driver.
MOST_TASKS = 32


def perhaps_among(docs: DataFrame, wanted: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """``docs`` without most rows whose ``keys`` are not in the ``n`` rows of ``wanted``: a bitmap of
    hashes of bounded size goes to every task, so their texts are not shuffled for a join."""
    bits = min(MOST_BITS, 1 << max(15, (8 * n).bit_length()))
    place = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    maps = wanted.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_map"))
    bit = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = docs.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "_bucket")
    return marked.where(F.getbit(byte, F.pmod(bit, F.lit(8))) == 1).select(*docs.columns)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", n_features: int = 512) -> ToxicityModel:
    """Learn from every labelled row; copies of a text count once, and the bias follows the classes'
    shares among all labels. The character model learns from the plain words of these texts, once for
    each that holds the word, a tenth of its mass being the words that tell toxic rows best: a hidden
    word is likelier one of those. ``n_features`` words and beginnings of words are used, those of
    largest chi-square.

    Null labels are left out, and of several labels of an id the larger counts. Without rows of both
    classes the score is the smoothed share of toxic labels.
    """
    spark = docs.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    share = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = share.get(1, 0), share.get(0, 0)
    keyed = docs.select(F.col(id_col).alias("id"), F.md5(body(text_col).cast("binary")).alias("hash"), body(text_col).alias("text"))
    # Of copies the smallest id, found without their texts.
    first = stored(keyed.select("id", "hash").join(known, "id").groupBy("y", "hash").agg(F.min("id").alias("id")), "toxicity_ids")
    size = {r.y: r.n for r in first.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not (pos and neg and n1 and n0):
        discard(first)
        return ToxicityModel(CharModel(np.zeros(LETTERS**ORDER)), float(np.log((pos + 0.5) / (neg + 1.5))), {})

    def word_rows(ys: list[int], batch: list[str]) -> list[tuple]:
        counts = (Counter(), Counter())
        for y, text in zip(ys, batch):
            counts[y].update(plain_words(text))
        return [(w, counts[1][w], counts[0][w]) for w in sorted({*counts[0], *counts[1]})]

    def gram_rows(words: list[str], a: list[float], b: list[float]) -> list[tuple]:
        keys, owner = CharModel.grams_of_words(words)
        found, at = np.unique(keys, return_inverse=True)
        return list(zip(found.tolist(), np.bincount(at, (np.array(a) + np.array(b))[owner], len(found)).tolist()))

    memo: dict = {}

    def feature_rows(ys: list[int], batch: list[str]) -> list[tuple]:
        return [(y, sorted(features_of_text(t, memo, lambda token: features_of_token(token, chars)))) for y, t in zip(ys, batch)]

    def feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            f = part.column(1)
            toxic = np.repeat(part.column(0).to_numpy(), np.diff(f.offsets.to_numpy()))
            items, at = np.unique(f.flatten().to_numpy(), return_inverse=True)
            a, n = np.bincount(at, toxic, len(items)).astype(np.int64), np.bincount(at, minlength=len(items))
            yield pa.record_batch([pa.array(items), pa.array(a), pa.array(n - a)], names=["i", "a", "b"])

    parts = max(parallelism, -(-(n1 + n0) // TEXTS_IN_PART))
    near = perhaps_among(keyed, first, n1 + n0, ["id", "hash"]).repartition(parts, "id", "hash")
    sample = stored(near.join(first.repartition(parts, "id", "hash").hint("merge"), ["id", "hash"]).dropDuplicates(["id", "hash"]).select("y", "text"), "toxicity_texts")
    counts_schema = "i {}, a long, b long"
    found = sample.mapInArrow(by_slice(word_rows, pa.schema([("i", pa.string()), ("a", pa.int64()), ("b", pa.int64())])), counts_schema.format("string"))
    words = stored(added_up(found), "toxicity_words")
    counts = np.zeros(LETTERS**ORDER)
    grams = words.mapInArrow(by_slice(gram_rows, pa.schema([("gram", pa.int64()), ("n", pa.float64())])), "gram long, n double")
    summed = grams.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts[summed["gram"].to_numpy()] = summed["n"].to_numpy()
    lexicon = CharModel.grams(telling(words, n1, n0, n_features))
    np.add.at(counts, lexicon, 0.1 * counts.sum() / max(1, len(lexicon)))
    chars = CharModel(counts)

    schema = pa.schema([("y", pa.int32()), ("features", pa.list_(pa.int64()))])
    rows = stored(sample.mapInArrow(by_slice(feature_rows, schema), "y int, features array<long>"), "toxicity_features")
    best = telling(added_up(rows.mapInArrow(feature_counts, counts_schema.format("long"))), n1, n0, n_features)
    place = {f: i for i, f in enumerate(best)}

    def pattern_rows(ys: list[int], batch: list[list[int]]) -> list[tuple]:
        return [(y, sorted(place[f] for f in fs if f in place)) for y, fs in zip(ys, batch)]

    schema = pa.schema([("y", pa.int32()), ("f", pa.list_(pa.int32()))])
    told = rows.mapInArrow(by_slice(pattern_rows, schema), "y int, f array<int>")
    grouped = told.groupBy("f").agg(F.sum("y").alias("ones"), F.sum(1 - F.col("y")).alias("zeros"))
    patterns = stored(grouped.repartition(min(parallelism, MOST_TASKS), "f"), "toxicity_patterns")
    w = solve(patterns, len(best) + 1, n1 + n0)
    discard(first, sample, words, rows, patterns)
    # Copies, which count once, leave other shares of the classes than the labels have.
    bias = float(w[-1] + np.log(pos / neg) - np.log(n1 / n0))
    return ToxicityModel(chars, bias, {f: float(w[i]) for f, i in place.items()})


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1. Null text counts as empty and scores the bias."""
    return with_values(docs, text_col, score_col, pa.float64(), lambda text: model.score(text or ""))


def in_fold(key: str, folds: int):
    """Whether an id is held out; a null id always is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit_on_folds(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return fit_toxicity(docs, labels.where(~in_fold("doc_id", 5)))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on_folds(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", in_fold("doc_id", 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
