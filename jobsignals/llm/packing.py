"""Packing: first-fit decreasing over a tournament tree, in randomised groups of pieces."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.bpe import encode_slices
from jobsignals.llm.common import arrow_type, body, by_slice, query, stored, table

CAPACITY = 4096
END_ID = 2
# Full sequences a group is expected to fill; bounds what one task holds.
GROUP_BINS = 1024
BIN_BITS = 32


class Tournament:
    """Bins of equal capacity in order; each inner node holds the larger room of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room for it: (bin, room that was there before)."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        before = room[at]
        room[at] = before - size
        leaf = at
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return leaf - self.leaves, before


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; ``lengths`` come in decreasing order and fit into a bin."""
    tree = Tournament(len(lengths), capacity)
    placed = [tree.place(n) for n in lengths.tolist()]
    return np.array([b for b, _ in placed], np.int64), np.array([capacity - r for _, r in placed], np.int64)


def pieces_of(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, path: str | None) -> DataFrame:
    """Every document's ids, the end id behind them, cut at multiples of ``capacity``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), body(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    encode = encode_slices(path)

    def cut(keys: list, texts: list[str]) -> Iterator[tuple]:
        for key, ids in zip(keys, encode(texts)):
            ids = np.append(ids, end_id).astype("<u4")
            for start in range(0, len(ids), capacity):
                piece = ids[start : start + capacity]
                yield key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)

    numbers = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([("doc_id", arrow_type(kind)), *((n, pa.int64()) for n in numbers)])
    return rows.mapInArrow(by_slice(cut, schema), f"doc_id {kind}, " + ", ".join(f"{n} long" for n in numbers))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, group_bins: int = GROUP_BINS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids and ``end_id`` are cut only where a piece is full, so a document has at most
    one piece shorter than ``capacity``. Pieces are dealt to groups by a hash of id, start, content and
    a stored row number, so that rows of one id, or of none, are spread like others; the groups' number follows the tokens counted, so a group fills about ``group_bins`` sequences whatever the
    size of the input or of a document. Inside a group pieces go, longest first (equal ones by id
    and start), into the first sequence with room. A sequence id holds group and place in it.

    Null text counts as empty: a piece with the end id alone. Null ids and repeated rows are packed
    like others, other columns are not read, an empty table gives an empty result.
    """
    pieces = stored(pieces_of(docs, id_col, text_col, capacity, end_id, path).withColumn("row", F.monotonically_increasing_id()), "pieces")
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(tokens / (capacity * group_bins)))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row", F.lit("pack")), F.lit(groups)))

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        ids = (group["group"].to_numpy() << BIN_BITS) + bins
        return group.drop_columns(["group", "row"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("group").applyInArrow(fill, schema).withColumnRenamed("doc_id", id_col)


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
