"""BPE encoding and decoding by tree concatenation.

A text is cut into halves, these again, down to leaves that are encoded independently. A join
re-encodes a window around the cut, and the window grows until its first and last tokens agree
with what either side already has. Texts over ``FAR_CHARS`` send their parts to different tasks.

Why agreement is enough: a sequence of tokens is the encoding of its text exactly if every two
neighbours are the encoding of their own text. A token that window and side share, with the same
place and id, makes every pair across the seam a pair that one of them holds already.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import arrow_type, body, by_slice, query, stored, table

VOCABULARY = "word_bpe_49k.json"

LEAF_CHARS = 4096
FAR_CHARS = 65_536
# A word is looked up and re-encoded whole; what is longer is joined token by token.
WORD_CHARS = 256
# Words remembered: those of the present and of the last generation.
MEMO_WORDS = 300_000
# Characters around a seam that pattern look-ahead or the end-of-word mark may change.
MARGIN = 8
WORD_END = "</w>"

# The settings of a tokenizer file (fixed values) whose Latin words need only the merges from the
# library: lower case, cut by this pattern, bytes shown as in byte-level BPE.
PLAIN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_LIMIT = "\u0250"
LATIN = [chr(c) for c in range(0xA1, ord(PLAIN_LIMIT))]
_LETTERS = "a-z" + "".join(c for c in LATIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "0-9" + "".join(c for c in LATIN if unicodedata.category(c)[0] == "N")
PLAIN_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


def byte_names() -> dict[int, str]:
    """Byte-level BPE names a byte by its Latin-1 character if that prints, else by one from 256 on."""
    prints = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


_NAMES = byte_names()
SHOWN = {ord(c): "".join(_NAMES[b] for b in c.encode()) for c in LATIN}


def packed(ids) -> bytes:
    """Little-endian 32-bit ids."""
    return np.array(ids, "<u4").tobytes() if array("I").itemsize != 4 or sys.byteorder != "little" else array("I", ids).tobytes()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """A tokenizer file with the lookups that joining needs; made once in each Python worker."""

    _made: dict[str, Codec] = {}

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        joinable = settings["decoder"] is None and settings["normalizer"] is not None and settings["model"].get("end_of_word_suffix") == WORD_END
        if not joinable or self.ids_of("a b") != self.ids_of("a") + self.ids_of("b"):
            raise ValueError(f"{path}: parts are joined for tokenizers without a decoder, with a normaliser, word ends and cuts at blanks only")
        added = {t["content"]: t["id"] for t in settings["added_tokens"]}
        self.normalise = self.whole.normalizer.normalize_str
        self.bare = Tokenizer(self.whole.model)  # for text that is normalised already
        self.bare.pre_tokenizer = self.whole.pre_tokenizer
        self.specials = re.compile("|".join(map(re.escape, added))) if added else re.compile(r"(?!)")
        self.longest_special = max(map(len, added), default=0)
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.tokens = [""] * (max(vocab.values()) + 1)
        self.width = np.zeros(len(self.tokens), np.int64)  # bytes of text that a token stands for
        for token, i in vocab.items():
            self.tokens[i] = token
            self.width[i] = 0 if token in added else len(token.removesuffix(WORD_END))
        self.merges = self.whole.model.tokenize
        cuts = [step.get("pattern", {}).get("Regex") for step in settings["pre_tokenizer"].get("pretokenizers", [])]
        self.plain = PLAIN_CUT in cuts and any(step["type"] == "Lowercase" for step in settings["normalizer"].get("normalizers", []))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids_of(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    # --- words

    def fill(self, words: list[str], parts: list[bytes | None]) -> None:
        """Put the ids of the words that ``memo`` did not know into ``parts``."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        for i, known in enumerate(parts):
            if known is None:
                word = words[i]
                known = memo.get(word)
                if known is None:
                    known = older.get(word)
                    if known is None:
                        known = self.word(word)
                    if len(word) <= WORD_CHARS:
                        memo[word] = known
                parts[i] = known

    def plain_word(self, word: str) -> bytes | None:
        """Pieces are remembered too: words share them with and without capitals and full stops."""
        if not word.isascii() and max(word) >= PLAIN_LIMIT:
            return None
        memo, ids = self.memo, []
        for piece in (word,) if word.isalpha() else PLAIN_PIECE.findall(word):
            known = memo.get(piece)
            if known is None:
                known = memo[piece] = packed([t.id for t in self.merges(piece.translate(SHOWN))])
            ids.append(known)
        return ids[0] if len(ids) == 1 else b"".join(ids)

    def word(self, text: str) -> bytes:
        known = None
        if self.plain and len(text) <= WORD_CHARS and text.isprintable() and "<|" not in text:
            known = self.plain_word(text.lower() if text.isascii() else self.normalise(text))
        return packed(self.ids_of(text)) if known is None else known

    # --- cuts

    def cut_near(self, text: str, at: int) -> int:
        """The next place at or before ``at`` where normalising either side alone changes nothing
        and which is not inside a special token; 0 if there is none."""
        while at > 0:
            inside = next((m for m in self.specials.finditer(text, max(0, at - self.longest_special), at + self.longest_special) if m.start() < at < m.end()), None)
            if inside:
                at = inside.start()
                continue
            left, right = text[max(0, at - MARGIN) : at], text[at : at + MARGIN]
            if (left + right).isascii() or self.normalise(left + "|" + right).split("|", 1) == [self.normalise(left), self.normalise(right)] and self.normalise(left + right) == self.normalise(left) + self.normalise(right):
                return at
            at -= 1
        return 0

    def leaves(self, text: str, most: int = LEAF_CHARS) -> list[str]:
        if len(text) <= most:
            return [text]
        at = self.cut_near(text, len(text) // 2)
        return [*self.leaves(text[:at], most), *self.leaves(text[at:], most)] if at else [text]

    # --- nodes: the words of a stretch of text, the outer two with their text

    def leaf(self, text: str) -> Node:
        words = text.replace("\n", " ").split(" ")
        parts = list(map(self.memo.get, words))
        if None in parts:
            self.fill(words, parts)
        return Node(words[0], words[-1], parts)

    def encode(self, text: str) -> np.ndarray:
        return self.concatenate([self.leaf(t) for t in self.leaves(text)]).ids()

    def concatenate(self, nodes: list[Node]) -> Node:
        while len(nodes) > 1:
            nodes = [self.join(*nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    def join(self, a: Node, b: Node) -> Node:
        """The last word of ``a`` and the first of ``b`` become one; blanks are hard borders."""
        seam = a.last + b.first
        if not a.last or not b.first:
            ids = a.parts[-1] + b.parts[0]
        elif len(seam) <= WORD_CHARS:
            ids = self.word(seam)
        else:
            ids = self.join_long(a.last, a.parts[-1], b.first, b.parts[0])
        first = seam if len(a.parts) == 1 else a.first
        last = seam if len(b.parts) == 1 else b.last
        return Node(first, last, a.parts[:-1] + [ids] + b.parts[1:])

    def join_long(self, a: str, a_ids: bytes, b: str, b_ids: bytes) -> bytes:
        """Join two parts of a word; other blanks and special tokens inside them are borders too."""
        left, right = np.frombuffer(a_ids, "<u4"), np.frombuffer(b_ids, "<u4")
        tail = self.normalise(self.specials.split(a)[-1]).rpartition(" ")[2].encode()
        head = self.normalise(self.specials.split(b)[0]).partition(" ")[0].encode()
        n = int(np.searchsorted(np.cumsum(self.width[left][::-1]), len(tail))) + 1 if tail else 0
        m = int(np.searchsorted(np.cumsum(self.width[right]), len(head))) + 1 if head else 0
        seam = self.grow(tail, left[len(left) - n :], head, right[:m])
        return np.concatenate([left[: len(left) - n], seam, right[m:]]).astype("<u4").tobytes()

    def grow(self, a: bytes, left: np.ndarray, b: bytes, right: np.ndarray) -> np.ndarray:
        ends_a, ends_b = np.cumsum(self.width[left]), len(a) + np.cumsum(self.width[right])
        starts_a, starts_b = ends_a - self.width[left], ends_b - self.width[right]
        text, size = a + b, 8
        while True:
            low = int(starts_a[len(left) - size]) if size < len(left) else 0
            high = int(ends_b[size - 1]) if size < len(right) else len(text)
            while low > 0 and text[low] & 0xC0 == 0x80:
                low -= 1
            while high < len(text) and text[high] & 0xC0 == 0x80:
                high += 1
            window = np.array(self.bare.encode(text[low:high].decode(), add_special_tokens=False).ids, np.int64)
            ends = low + np.cumsum(self.width[window])
            starts = ends - self.width[window]
            begin = 0 if low == 0 else self.shared(starts, ends, window, starts_a, ends_a, left, low, len(a) - MARGIN)
            stop = len(window) if high == len(text) else self.shared(starts, ends, window, starts_b, ends_b, right, len(a) + MARGIN, high - MARGIN)
            if begin is not None and stop is not None and begin <= stop:
                before = left[: int(np.searchsorted(starts_a, starts[begin]))] if low else left[:0]
                after = right[int(np.searchsorted(starts_b, starts[stop])) :] if high < len(text) else right[:0]
                return np.concatenate([before, window[begin:stop], after])
            size *= 2

    @staticmethod
    def shared(starts, ends, window, side_starts, side_ends, side, low: int, high: int) -> int | None:
        """The first token of the window, inside [low, high], that a side has at the same place."""
        at = np.searchsorted(side_starts, starts)
        at = np.minimum(at, len(side) - 1)
        same = (side_starts[at] == starts) & (side_ends[at] == ends) & (side[at] == window) & (starts >= low) & (ends <= high)
        found = np.flatnonzero(same)
        return int(found[0]) if len(found) else None

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


class Node:
    """``parts`` holds the ids of each word of a stretch; ``first`` and ``last`` are the texts of the
    outer words, which may go on beyond it."""

    __slots__ = ("first", "last", "parts")

    def __init__(self, first: str, last: str, parts: list[bytes]):
        self.first, self.last, self.parts = first, last, parts

    def ids(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts), "<u4")


def encode_slices(path: str | None = None):
    """A function from texts to arrays of ids, for use inside tasks."""

    def encode(texts: list[str]) -> Iterator[np.ndarray]:
        codec = Codec.of(path or vocabulary_path())
        for text in texts:
            yield codec.encode(text)

    return encode


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, far_chars: int = FAR_CHARS, decoded: bool = False) -> DataFrame:
    """One row per row: id and ``ids`` (array<int>), as the tokenizers library encodes the text
    without adding special tokens; strings of special tokens inside a text become their ids, as
    there. ``path`` is the tokenizer file, to be found on every executor; a task raises ValueError if
    its words do not end at blanks, mark their end, and decode by joining tokens with blanks. With
    ``decoded`` the ids are decoded as well, in the same tasks. Texts over ``far_chars`` are numbered
    and written to the scratch folder, so that a part worked out again finds the others by number.

    Null text counts as empty and has no ids. Null ids and repeated rows are kept as they are, other
    columns are not read, an empty table gives an empty result. One text, with its ids, has to fit
    into a task, as it has to fit into a row.
    """
    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    id_type = arrow_type(kind)
    fields = [("id", id_type), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decoded
    result = f"id {kind}, ids array<int>" + ", decoded string" * decoded

    def shown(codec: Codec, key, ids: np.ndarray) -> tuple:
        return (key, ids.astype(np.int32), codec.decode(ids.tolist())) if decoded else (key, ids.astype(np.int32))

    def near(keys: list, texts: list[str]) -> Iterator[tuple]:
        codec = Codec.of(path or vocabulary_path())
        for key, text in zip(keys, texts):
            yield shown(codec, key, codec.encode(text))

    def cut(rows: list[int], keys: list, texts: list[str]) -> Iterator[tuple]:
        codec = Codec.of(path or vocabulary_path())
        for row, key, text in zip(rows, keys, texts):
            for i, part in enumerate(codec.leaves(text, far_chars)):
                yield row, key, i, part

    def part(rows: list[int], keys: list, places: list[int], texts: list[str]) -> Iterator[tuple]:
        codec = Codec.of(path or vocabulary_path())
        for row, key, place, text in zip(rows, keys, places, texts):
            node = codec.concatenate([codec.leaf(t) for t in codec.leaves(text)])
            inner = b"".join(node.parts[1:-1])
            yield row, key, place, node.first, node.last, len(node.parts) > 1, node.parts[0], inner, node.parts[-1]

    def whole(parts: pa.Table) -> pa.Table:
        codec = Codec.of(path or vocabulary_path())
        parts = parts.sort_by("place").to_pylist()
        nodes = [Node(p["first"], p["last"], [p["head"], p["inner"], p["tail"]] if p["open"] else [p["head"]]) for p in parts]
        row = shown(codec, parts[0]["id"], codec.concatenate(nodes).ids())
        return pa.table([pa.array([v], t) for v, (_, t) in zip(row, fields)], names=[n for n, _ in fields])

    short = rows.where(F.length("text") <= far_chars)
    out = short.mapInArrow(by_slice(near, pa.schema(fields)), result)

    cut_schema = pa.schema([("row", pa.int64()), ("id", id_type), ("place", pa.int32()), ("text", pa.string())])
    part_schema = pa.schema([("row", pa.int64()), ("id", id_type), ("place", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("open", pa.bool_()), ("head", pa.binary()), ("inner", pa.binary()), ("tail", pa.binary())])
    long = stored(rows.where(F.length("text") > far_chars).select(F.monotonically_increasing_id().alias("row"), "id", "text"), "long_texts")
    cuts = long.mapInArrow(by_slice(cut, cut_schema), f"row long, id {kind}, place int, text string")
    parts = cuts.repartition("row", "place").mapInArrow(by_slice(part, part_schema), f"row long, id {kind}, place int, first string, last string, open boolean, head binary, inner binary, tail binary")
    far = parts.groupBy("row").applyInArrow(whole, result)
    return out.unionByName(far).withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the library's text for the ids, special tokens shown."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        codec = Codec.of(path or vocabulary_path())
        return ids.map(lambda row: codec.decode(row.tolist()))

    return encoded.withColumn("decoded", decode(ids_col))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"), decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
