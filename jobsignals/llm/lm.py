"""LM scoring with a weighted backoff automaton over word n-grams.

Documents are read once and kept as blocks: the words of a block, their counts, and each document
as places in that word list. The words and n-grams of a block travel as sorted arrays, one for each
range of hashes, and every block gets back the counts of its own, so no task ever holds the
vocabulary or the model, and every n-gram takes part.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import arrow_type, body, free_rounds, query, slices, stored, table

ADDED = 0.1  # added to each count of the base model
PRIOR = 100.0  # how many tokens the shorter context is worth in a longer one
BLOCK_CHARS = 8_000_000
# Tasks that blocks are dealt to when they are scored; beyond, a task scores one block after another.
MOST_TASKS = 20_000
# Entries (an n-gram of a block) that one range of hashes holds on average, at most.
RANGE_ENTRIES = 3_000_000
END = b""  # the end of a text; words are never empty


def words_of(text: str) -> list[bytes]:
    """Lower-case A to Z, cut at blanks and at tab to carriage return: bytes know no other case or
    white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Places(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def planes(numbers: np.ndarray, width: int) -> bytes:
    """The ``width`` lower bytes of numbers, all lowest bytes first: these compress better so."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(packed: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(packed) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(packed, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def packed_numbers(numbers: np.ndarray, width: int = 6) -> bytes:
    return zlib.compress(planes(numbers, width), 1)


def unpacked_numbers(packed: bytes, width: int = 6) -> np.ndarray:
    return from_planes(zlib.decompress(packed), width)


def packed_words(words: Iterable[bytes]) -> bytes:
    """Words hold no line break."""
    return zlib.compress(b"\n".join(words), 1)


def unpacked_words(packed: bytes) -> list[bytes]:
    return zlib.decompress(packed).split(b"\n")


BLOCKS = "block long, ids array<{id}>, held array<boolean>, sizes array<long>, tokens binary, n_words long, n_learnt long, words binary, counts binary"


def blocks_of(docs: DataFrame, id_col: str, text_col: str, held_out, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block of about ``block_chars`` characters; ``tokens`` are the documents' places
    one after another (compressed 32-bit numbers), each ended by the place of ``END``; ``counts``
    are those of documents not held out."""
    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held"))
    kind = rows.schema["id"].dataType.simpleString()
    id_type = arrow_type(kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, partition = 0, TaskContext.get().partitionId()
        places, ids, held, sizes, tokens, chars = Places(), [], [], [], array("I"), 0

        def block() -> pa.RecordBatch:
            at = np.frombuffer(tokens, np.uint32)
            learnt = np.repeat(~np.array(held, bool), sizes)
            counts = np.bincount(at[learnt], minlength=len(places))
            packed = packed_numbers(at, 4)
            columns = [pa.array([partition << 32 | number]), pa.array([ids], pa.list_(id_type)), pa.array([held]), pa.array([sizes], pa.list_(pa.int64())), pa.array([packed]), pa.array([len(places)]), pa.array([int(counts.sum())]), pa.array([packed_words(places)]), pa.array([packed_numbers(counts, 4)])]
            return pa.record_batch(columns, names=["block", "ids", "held", "sizes", "tokens", "n_words", "n_learnt", "words", "counts"])

        for part in slices(batches):
            for key, text, out in zip(*(part.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                words.append(END)
                tokens.extend(map(places.__getitem__, words))
                ids.append(key)
                held.append(out)
                sizes.append(len(words))
                chars += len(text)
                if chars >= block_chars:
                    yield block()
                    number += 1
                    places, ids, held, sizes, tokens, chars = Places(), [], [], [], array("I"), 0
        if ids:
            yield block()

    return stored(rows.mapInArrow(cut, BLOCKS.format(id=kind)), "lm_blocks")


FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mixed(before: np.ndarray, word: np.ndarray, factor: int) -> np.ndarray:
    """64-bit hash of an n-gram from that of its context and of its last word."""
    h = before * np.uint64(factor) ^ word
    h = (h ^ (h >> np.uint64(32))) * np.uint64(FACTORS[0])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(FACTORS[1])
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Grams:
    """The 2- and 3-grams of a block: ``places`` are those of their last tokens by length,
    ``different`` the sorted hashes, ``which`` the index into these for each place."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, hashes: np.ndarray):
        words = hashes[tokens]
        ends = np.cumsum(sizes)
        depth = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)  # tokens before, in its text
        two = mixed(words[:-1], words[1:], FACTORS[0])
        three = mixed(two[:-1], words[2:], FACTORS[1])
        self.places = (np.flatnonzero(depth >= 1), np.flatnonzero(depth >= 2))
        first, second = self.places
        self.different, which = np.unique(np.concatenate([two[first - 1], three[second - 2]]), return_inverse=True)
        self.which = (which[: len(first)], which[len(first) :])

    def counts(self, learnt: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.different))
        for which, places in zip(self.which, self.places):
            out += np.bincount(which, learnt[places], len(out))
        return out


def ranges_of(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(range, key) of sorted hashes: the whole part of n * hash / 2**64 and 40 bits of the fraction.
    Both ascend, and more ranges tell more hashes apart."""
    many, half = np.uint64(n), np.uint64(32)
    low = (hashes & np.uint64(0xFFFFFFFF)) * many >> half
    return ((hashes >> half) * many + low >> half).astype(np.int64), hashes * many >> np.uint64(24)


def cuts(ranges: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Every range that occurs and where its entries stand."""
    present, starts = np.unique(ranges, return_index=True)
    for number, a, b in zip(present.tolist(), starts, [*starts[1:], len(ranges)]):
        yield number, slice(a, b)


def packed_keys(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending keys as steps of the upper 16 bits, which compress, and the lower 24 as they are."""
    return packed_numbers(np.diff(keys >> np.uint64(24), prepend=np.uint64(0)), 2), planes(keys, 3)


def unpacked_keys(upper: bytes, lower: bytes) -> np.ndarray:
    return (np.cumsum(unpacked_numbers(upper, 2), dtype=np.uint64) << np.uint64(24)) + from_planes(lower, 3)


def answers(group: pa.Table, which: np.ndarray, sizes: list[int], different: int) -> tuple[np.ndarray, pa.Array]:
    """Counts summed by entry, and for each row of ``group`` the sums of its entries."""
    counts = np.concatenate([unpacked_numbers(c, 4) for c in group["counts"].to_pylist()])
    sums = np.bincount(which, counts, different)
    return sums, pa.array([packed_numbers(part) for part in np.split(sums[which], np.cumsum(sizes)[:-1])], pa.binary())


# A block sends a word or an n-gram once, with its count, so even the commonest has no more entries
# than there are blocks, and ranges of hashes are even.


def word_totals(blocks: DataFrame, n_ranges: int) -> DataFrame:
    """(block, range, totals, known): the counts over all blocks of the block's words in a range, by
    hash, and how many different words of the range were seen. Words are told apart by their bytes."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            block, words, counts = (part.column(i).to_pylist()[0] for i in range(3))
            words, counts = unpacked_words(words), unpacked_numbers(counts, 4)
            hashes = word_hashes(words)
            order = np.argsort(hashes, kind="stable")
            rows = [(n, block, packed_words(words[i] for i in order[at]), packed_numbers(counts[order[at]], 4)) for n, at in cuts(ranges_of(hashes[order], n_ranges)[0])]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["range", "block", "words", "counts"])

    def total(group: pa.Table) -> pa.Table:
        words = [unpacked_words(w) for w in group["words"].to_pylist()]
        found = pa.array([w for part in words for w in part], pa.binary()).dictionary_encode()
        sums, totals = answers(group, found.indices.to_numpy(), [len(w) for w in words], len(found.dictionary))
        return pa.table({"block": group["block"], "range": group["range"], "totals": totals, "known": pa.array(np.full(len(words), (sums > 0).sum(), np.int64))})

    sent = blocks.select("block", "words", "counts").mapInArrow(send, "range long, block long, words binary, counts binary")
    return sent.groupBy("range").applyInArrow(total, "block long, range long, totals binary, known long")


def gram_totals(blocks: DataFrame, n_ranges: int) -> DataFrame:
    """(block, range, totals): the counts over all blocks of the block's n-grams in a range, by hash."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            block, held, sizes, tokens, words = (part.column(i).to_pylist()[0] for i in range(5))
            grams = Grams(unpacked_numbers(tokens, 4), np.array(sizes), word_hashes(unpacked_words(words)))
            counts = grams.counts(np.repeat(~np.array(held, bool), sizes))
            ranges, keys = ranges_of(grams.different, n_ranges)
            rows = [(n, block, *packed_keys(keys[at]), packed_numbers(counts[at], 4)) for n, at in cuts(ranges)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["range", "block", "upper", "lower", "counts"])

    def total(group: pa.Table) -> pa.Table:
        keys = [unpacked_keys(u, v) for u, v in zip(group["upper"].to_pylist(), group["lower"].to_pylist())]
        sizes, keys = [len(k) for k in keys], np.concatenate(keys)
        different, which = np.unique(keys, return_inverse=True)
        _, totals = answers(group, which, sizes, len(different))
        return pa.table({"block": group["block"], "range": group["range"], "totals": totals})

    sent = blocks.select("block", "held", "sizes", "tokens", "words").mapInArrow(send, "range long, block long, upper binary, lower binary, counts binary")
    return sent.groupBy("range").applyInArrow(total, "block long, range long, totals binary")


def given_totals(hashes: np.ndarray, n_ranges: int, totals: dict[int, bytes]) -> np.ndarray:
    """The counts of sorted ``hashes`` from the answers by range."""
    out = np.zeros(len(hashes))
    for number, at in cuts(ranges_of(hashes, n_ranges)[0]):
        out[at] = unpacked_numbers(totals[number])
    return out


class Automaton:
    """The part of the backoff automaton that the texts of a block can reach.

    States are contexts seen in training, of two words, one or none. An arc for each n-gram seen
    leaves its context with log10 of (count + PRIOR * what the shorter context gives) / (count of
    the context + PRIOR). Where there is no arc, the failure arc leads to the context without its
    first word at the cost log10 of PRIOR / (count of the context + PRIOR); without context a word
    costs its base probability.
    """

    def __init__(self, base: np.ndarray, word_counts: np.ndarray, prior: float = PRIOR):
        self.base, self.word_counts, self.prior = base, word_counts, prior

    def walk(self, tokens: np.ndarray, grams: Grams, totals: np.ndarray) -> np.ndarray:
        """log10 probability of each token, read from left to right.

        The state that reading carries to a token is the longest context before it that was seen;
        each failure step is taken for all tokens that have no arc at once.
        """
        n = len(tokens)
        seen, context = np.zeros((2, n)), np.zeros((2, n))
        for order in (0, 1):
            seen[order][grams.places[order]] = totals[grams.which[order]]
        first, second = grams.places
        context[0][first] = self.word_counts[tokens[first - 1]]
        context[1][second] = seen[0][second - 1]
        given = [self.base[tokens]]
        for order in (0, 1):
            given.append((seen[order] + self.prior * given[-1]) / (context[order] + self.prior))
        state = np.where(context[1] > 0, 2, np.where(context[0] > 0, 1, 0))
        score, moving = np.zeros(n), np.ones(n, bool)
        for length in (2, 1):
            here = moving & (state == length)
            arc = here & (seen[length - 1] > 0)
            score[arc] += np.log10(given[length][arc])
            moving &= ~arc
            fails = here & ~arc
            score[fails] += np.log10(self.prior / (context[length - 1][fails] + self.prior))
            state[fails] = length - 1
        score[moving] += np.log10(given[0][moving])
        return score


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, block_chars: int = BLOCK_CHARS, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """One row per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learnt from all rows for which ``held_out`` is false. A text is its words and one end. The base
    score adds ``ADDED`` to the exact counts of all words. The model is a trigram model: a context
    of two words or one mixes its own counts with what the shorter context gives, which weighs as
    much as ``prior`` tokens, down to the base model. All 2- and 3-grams take part, without a least
    count at any size. Words are told apart by their bytes, the n-grams of a range by 40 bits; as a
    range holds about ``range_entries``, at any size some 3 in a million n-grams share theirs.

    Null text counts as empty, an end alone. Rows with a null id are scored but not learnt from;
    repeated rows are texts of their own; other columns are not read. An empty table gives an empty
    result; with no training rows every token has the probability of an unseen one.
    """
    blocks = blocks_of(docs, id_col, text_col, held_out, block_chars)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    all_tokens = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    sums = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n_learnt", all_tokens, "n_words"))
    n_blocks, total, n_tokens, n_words = blocks.agg(F.count(F.lit(1)), *sums).first()
    word_ranges, gram_ranges = (max(1, -(-n // range_entries)) for n in (4 * n_words, 2 * n_tokens))
    words = stored(word_totals(blocks, word_ranges), "lm_words")
    distinct = words.select("range", "known").distinct().agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    grams = stored(gram_totals(blocks, gram_ranges), "lm_grams")
    free_rounds(docs.sparkSession)
    # What a block gets back: counts by range of hashes, of its words and of its n-grams.
    facts = words.select(F.col("block").alias("of"), "range", "totals", F.lit(True).alias("word")).unionByName(grams.select(F.col("block").alias("of"), "range", "totals", F.lit(False).alias("word")))
    id_type = arrow_type(kind)
    fields = [("id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def score(block: pa.Table, facts: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        hashes = word_hashes(unpacked_words(row["words"]))
        found: dict[bool, dict[int, bytes]] = {True: {}, False: {}}
        for number, packed, word in zip(*(facts[c].to_pylist() for c in ("range", "totals", "word"))):
            found[word][number] = packed
        order = np.argsort(hashes, kind="stable")
        counts = np.zeros(len(hashes))
        counts[order] = given_totals(hashes[order], word_ranges, found[True])
        base = (counts + ADDED) / (total + ADDED * (distinct + 1))
        tokens, sizes = unpacked_numbers(row["tokens"], 4), np.array(row["sizes"])
        grams = Grams(tokens, sizes, hashes)
        answers = given_totals(grams.different, gram_ranges, found[False])
        logs = Automaton(base, counts, prior).walk(tokens, grams, answers)
        starts = np.cumsum(sizes) - sizes
        columns = [row["ids"], row["held"], row["sizes"], np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts), [total] * len(sizes), np.add.reduceat(np.log10(base)[tokens], starts), np.add.reduceat(logs, starts)]
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # Blocks are even, so about one of them per task is the finest deal there is.
    tasks = max(1, min(n_blocks, MOST_TASKS))
    small = blocks.select("block", "ids", "held", "sizes", "tokens", "words")
    scored = small.repartition(tasks, "block").groupBy("block").cogroup(facts.repartition(tasks, "of").groupBy("of")).applyInArrow(score, schema)
    return scored.withColumnRenamed("id", id_col)


@query("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return score_texts(table(spark, sf_dir, "documents"), held_out)
