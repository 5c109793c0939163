"""Packing against a plain first fit, and the rules every packing has to keep."""

from __future__ import annotations

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from jobsignals.llm import bpe, packing
from jobsignals.llm.queries import all_queries
from llm_fixtures import con  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plain_first_fit(lengths, capacity):
    used, out = [], []
    for n in lengths:
        b = next((i for i, u in enumerate(used) if u + n <= capacity), len(used))
        if b == len(used):
            used.append(0)
        out.append((b, used[b]))
        used[b] += n
    return out


def test_tournament_is_first_fit():
    random.seed(4)
    for _ in range(200):
        lengths = sorted((random.randrange(1, 65) for _ in range(random.randrange(1, 80))), reverse=True)
        bins, offsets = packing.first_fit_decreasing(np.array(lengths), 64)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain_first_fit(lengths, 64)


def check_rules(rows, texts, capacity):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_query(spark, con):
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = all_queries()["op9_packing"](spark, SMALL).collect()
    sequences = check_rules(rows, texts, 4096)
    assert sum(r.length for r in rows) / (4096 * sequences) > 0.97


def test_small_groups_and_edges(spark):
    rows = [(i, "cat " * (i % 50)) for i in range(300)] + [(1000, None), (1001, "x" * 9_000), (1002, "the end " * 3_000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, offset int")
    out = packing.pack(df, capacity=64, group_bins=8)
    assert out.select("sequence_id").distinct().count() > 8
    check_rules(out.collect(), dict(rows), 64)
    assert packing.pack(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "a"), (None, "a"), (7, "b"), (7, "b")], "doc_id long, text string")
    packed = packing.pack(twice).collect()
    assert sorted(r.offset for r in packed) == [0, 2, 4, 6] and len({r.sequence_id for r in packed}) == 1


def test_rows_of_one_id_are_spread_over_the_groups(spark):
    """4,000 rows with null id, half of them equal in text too, fill many groups and lose nothing."""
    df = spark.createDataFrame([(None, "word " * 60 if i % 2 else f"word {i} " * 60) for i in range(4000)], "doc_id long, text string")
    rows = packing.pack(df, group_bins=4).collect()
    assert len(rows) == 4000
    groups = {}
    for r in rows:
        groups.setdefault(r.sequence_id >> packing.BIN_BITS, []).append(r.length)
    assert len(groups) > 10 and max(map(len, groups.values())) < 4 * 4000 / len(groups)
