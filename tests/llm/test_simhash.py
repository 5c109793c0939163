"""Fingerprints and components against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from jobsignals.llm import simhash
from jobsignals.llm.common import stored
from jobsignals.llm.components import roots
from jobsignals.llm.queries import all_queries
from llm_fixtures import con  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    """Smallest index reachable, for each value."""
    parent = list(range(len(values)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(values))]


def test_fingerprint():
    for text in ("", " \n", "One", "a B c", "a b c d", "É É é x\x0by", "the cat sat on the mat " * 30, "\x85 a\xa0b c d e f"):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text), repr(text)


def clusters(n, seed):
    random.seed(seed)
    out = [0, 1 << 63]
    while len(out) < n:
        centre = random.getrandbits(64)
        for _ in range(random.choice((1, 1, 3, 30))):
            x = centre
            for _ in range(random.randrange(0, 6)):
                x ^= 1 << random.randrange(64)
            out.append(x)
    return out[:n]


def test_bk_tree_finds_all_in_reach():
    values = clusters(400, 1)
    tree = simhash.BKTree()
    for i, v in enumerate(values):
        tree.add(v, i)
    for v in values[::7]:
        assert sorted(tree.within(v, 4)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 4]


@pytest.mark.parametrize("blocks,members", [(5, 2000), (6, 2000), (7, 2000), (5, 10)])
def test_links_connect_all_in_reach(spark, monkeypatch, blocks, members):
    monkeypatch.setattr(simhash, "blocks_for", lambda n, radius: blocks)
    values = sorted(set(clusters(500, blocks)))
    df = stored(spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long"), "test")
    pairs = stored(simhash.links(df, 4, members), "test")
    found = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in roots(pairs).collect()}
    groups = plain_components(values, 4)
    mine = [found.get(v, v) for v in values]
    assert len(set(zip(mine, groups))) == len(set(mine)) == len(set(groups))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000), (None, 3), (2000, 1999), (2000, 1999)]
    random.shuffle(edges)
    got = {r.node: r.root for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 2000: 1999}


def test_query(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    prints = [plain_fingerprint(t) for _, t in rows]
    components = plain_components(prints, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in all_queries()["op8_simhash"](spark, SMALL).collect()}
    assert got == {doc_id: (f"{p:016x}", rows[c][0]) for (doc_id, _), p, c in zip(rows, prints, components)}


def edited(words, share, rng):
    return [w if rng.random() > share else f"new{rng.randrange(10**9)}" for w in words]


def test_similar_documents(spark):
    """Copies with single words changed are found, texts that share a passage are not."""
    rng = random.Random(2)
    rows, groups = [], []
    for g in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((120, 400)))]
        members = [base] + [edited(base, 0.01, rng) for _ in range(3)]  # similarity about 0.9
        passage = base[: len(base) // 2] + [f"w{rng.randrange(10**6)}" for _ in range(len(base) // 2)]
        for m in (*members, passage):
            rows.append((len(rows), " ".join(m)))
            groups.append(g if m is not passage else -len(rows))
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), tree_members=50).collect()}
    wanted = {i: groups.index(groups[i]) for i, _ in rows}
    assert sum(got[i] == wanted[i] for i in wanted) >= 0.98 * len(rows)
    assert all(got[i] == i for i in wanted if groups[i] < 0)


def test_wide_fingerprints_follow_similarity():
    rng = random.Random(5)
    for similarity in (0.8, 0.9):
        differ = []
        for _ in range(60):
            shared = [rng.getrandbits(64) for _ in range(int(600 * similarity))]
            own = (600 - len(shared)) // 2
            a, b = ([*shared, *(rng.getrandbits(64) for _ in range(own))] for _ in range(2))
            prints = [b"".join(simhash.majority(simhash.mixed(np.array(x, "u8"), lane)) for lane in range(1, 5)) for x in (a, b)]
            differ.append((int.from_bytes(prints[0]) ^ int.from_bytes(prints[1])).bit_count())
        assert sum(differ) / len(differ) == pytest.approx(simhash.differing_bits(similarity, 256), rel=0.1)


def test_pairs_at_the_threshold_share_a_band_whatever_the_size():
    rng = random.Random(6)
    for size in (10, 100, 1000):
        met = 0
        for _ in range(400):
            shared = [rng.getrandbits(64) for _ in range(size * 8 // 10)]
            own = (size - len(shared)) // 2
            a, b = (simhash.band_keys(np.array([*shared, *(rng.getrandbits(64) for _ in range(own))], "u8")) for _ in range(2))
            met += any(x == y for x, y in zip(a, b))
        assert met >= 396, size
    unrelated = [simhash.band_keys(np.array([rng.getrandbits(64) for _ in range(100)], "u8")) for _ in range(400)]
    assert len({(t, k) for keys in unrelated for t, k in enumerate(keys)}) == 400 * simhash.BANDS


def test_similar_documents_at_the_threshold(spark):
    """Pairs at 0.8 are linked, pairs at 0.79 and 0.7 are not."""
    rng = random.Random(7)
    rows, wanted = [], {}

    def word():
        return f"w{rng.randrange(10**9)}"

    for shared, own in ((80, (10, 10)), (79, (10, 11)), (70, (15, 15)), (4, (0, 1))):
        for _ in range(150):
            passage = [word() for _ in range(shared + 4)]
            for n in own:
                rows.append((len(rows), " ".join(passage + [word() for _ in range(n)])))
                wanted[len(rows) - 1] = len(rows) - 1
            if shared / (shared + sum(own)) >= 0.8:
                wanted[len(rows) - 1] -= 1
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), confirm=True).collect()}
    assert all(got[i] == i for i in wanted if wanted[i] == i)
    assert sum(got[i] == wanted[i] for i in wanted) >= len(rows) - 4


@pytest.mark.parametrize("members", [2000, 4])
def test_similar_documents_of_drifting_texts(spark, members):
    """Texts that drift away step by step: components as by comparing all pairs."""
    rng = random.Random(8)
    rows = []
    for _ in range(25):
        text = [f"w{rng.randrange(10**9)}" for _ in range(150)]
        for _ in range(8):
            rows.append((len(rows), " ".join(text)))
            text = edited(text, rng.choice((0.005, 0.015, 0.03)), rng)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8 and parent[i] != parent[j]:
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), tree_members=members, confirm=True).collect()}
    assert [got[i] for i, _ in rows] == parent


def test_edges(spark):
    rows = [(1, "a b c d e"), (2, "A b C d e"), (3, None), (4, ""), (5, "\n"), (None, "a b c d e"), (7, "w " * 100_000), (1, "a b c d e")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (None, 1), (7, 7), (1, 1)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    got = sorted(((r.doc_id, r.component_id) for r in simhash.similar_documents(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (None, 1), (7, 7), (1, 1)], key=str)
    assert simhash.similar_documents(df.limit(0)).count() == 0


def test_shards_connect_by_similarity_and_labels():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 14)
        sets = [np.unique(np.array(rng.sample(range(12), rng.randrange(1, 9)), np.uint64)) for _ in range(n)]
        bits = [rng.getrandbits(4) for _ in range(n)]
        labels = [rng.randrange(100, 104) if rng.random() < 0.5 else i for i in range(n)]
        inside = sorted((rng.random() < 0.7 for _ in range(n)), reverse=True)
        shard, found = simhash.ShardLinks(2, 0.5), []
        for i in range(n):
            found += shard.add(i, bits[i], inside[i], labels[i], sets[i].astype("<u8").tobytes())

        def near(i, j):
            both = len(np.intersect1d(sets[i], sets[j]))
            return (bits[i] ^ bits[j]).bit_count() <= 2 and both >= 0.5 * (len(sets[i]) + len(sets[j]) - both)

        assert all(near(i, j) for i, j in found)
        pairs = [(i, j) for i in range(n) for j in range(i) if near(i, j) and (inside[i] or inside[j])]
        same = [(i, j) for i in range(n) for j in range(i) if labels[i] == labels[j]]
        assert components(n, pairs + same) == components(n, found + same)


def components(n, pairs):
    root = list(range(n))
    for _ in range(n):
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    return root


def test_a_large_neighbourhood_of_one_fingerprint(spark):
    """100,000 fingerprints within three bits of one: connected, in trees of bounded size, and no more
    pairs than rows and trees ask for."""
    rng = random.Random(6)
    values = set()
    while len(values) < 100_000:
        value = 0
        for bit in rng.sample(range(64), rng.randrange(0, 5)):
            value |= 1 << bit
        values.add(value)
    keyed = spark.createDataFrame([(0, 0, v - (1 << 64) if v >> 63 else v) for v in values], "t int, key long, node long").withColumn("bits", F.col("node"))
    pairs = stored(simhash.link_shards(keyed, 8, 2000), "test")
    assert pairs.count() < 50 * 100_000
    assert simhash.roots(pairs).select("root").distinct().count() == 1


def test_one_row_of_each_similar_group_stays(spark):
    words = [f"w{i}" for i in range(60)]
    one, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(f"x{i}" for i in range(60))
    rows = [(5, one, "a"), (None, near, "b"), (None, other, "c"), (9, other + " y", "d"), (9, " ".join(f"z{i}" for i in range(60)), "e"), (9, "lone text here", "f"), (9, "lone text here", "g"), (7, "", "h"), (8, None, "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    kept = sorted(map(tuple, simhash.first_of_similar(df).collect()), key=str)
    assert len(kept) == 5 and {r[2] for r in kept} - {"f", "g"} == {"a", "d", "e", "h"}
    assert len({r[2] for r in kept} & {"f", "g"}) == 1 and simhash.first_of_similar(df.limit(0)).count() == 0
