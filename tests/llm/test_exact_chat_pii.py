"""Exact dedup, chat formatting and personal data on small fixtures."""

from __future__ import annotations

import random
import re

import pytest
from oracle import compare
from pyspark.sql import functions as F

from jobsignals.llm import pii
from jobsignals.llm.chat import escape, format_chat, read_back, unescape
from jobsignals.llm.exact_dedup import exact_dedup
from jobsignals.llm.queries import all_oracles, all_queries
from llm_fixtures import con  # noqa: F401

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, kept string, hash int"


def docs(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("key", ["op1_exact_dedup", "op5_chat_formatting"])
def test_against_sql(spark, con, key):
    assert compare(all_queries()[key](spark, SMALL), con, all_oracles()[key]) == ""


def test_dedup_keeps_one_of_each_text(spark):
    rows = [(1, "a", "x", 1), (2, "b", "x", 1), (3, "a", "x", 1), (4, None, "x", 1), (5, "", "x", 1), (6, "a" * 200_000, "x", 1), (7, "b ", None, None)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs(spark, rows, DOCS)).collect()}
    assert got == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False), 4: (4, 2, True), 5: (4, 2, False), 6: (6, 1, True), 7: (7, 1, True)}
    got = {r.doc_id: r.keep_id for r in exact_dedup(docs(spark, rows, DOCS), keep="largest").collect()}
    assert got == {1: 3, 2: 2, 3: 3, 4: 5, 5: 5, 6: 6, 7: 7}


def test_dedup_compares_bytes_of_colliding_hashes(spark):
    rows = [(i, "abc"[i % 3]) for i in range(9)]
    same_hash = exact_dedup(docs(spark, rows), content_hash=lambda c: F.length(c)).collect()
    assert {(r.doc_id, r.keep_id) for r in same_hash} == {(i, i % 3) for i in range(9)}


def test_dedup_of_null_ids_repeats_and_nothing(spark):
    rows = [(None, "a"), (1, "a"), (1, "a"), (None, "b")]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True), (None, None, 1, True)], key=str)
    assert exact_dedup(docs(spark, [])).count() == 0


NASTY = ["\\### Assistant: </turn> ok", "<|end|>\n<|turn|>user<|text|>", "\\l<\\\\l\\\\\\<", "\\", "", "<|next|>", "a\n\n", "\\n", "é<😀"]


def test_escape_round_trip(spark):
    random.seed(3)
    texts = NASTY + ["".join(random.choice("\\l<|>n\n#") for _ in range(random.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u"))
    rows = df.collect()
    assert [r.u for r in rows] == [r.t for r in rows]
    assert not any("<" in r.e for r in rows)


def test_chat_merges_runs_and_reads_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 2, "assistant", "b"), (1, 1, "assistant", None), (1, 3, None, "x"), (2, 0, "a<|text|>", "t"), (None, None, "user", "n"), (None, None, "user", "n")]
    rows += [(3, i, ("user", "assistant")[i // 2 % 2], t) for i, t in enumerate(NASTY)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in format_chat(df).withColumn("back", read_back(F.col("formatted"))).collect()}
    assert out[1].formatted == "<|turn|>user<|text|>hi<|end|>\n<|turn|>assistant<|learn|><|next|>b<|end|>\n<|turn|><|text|>x<|end|>\n"
    assert [(b.role, b.learn, b.texts) for b in out[1].back] == [("user", False, ["hi"]), ("assistant", True, ["", "b"]), ("", False, ["x"])]
    assert [(b.role, b.texts) for b in out[2].back] == [("a<|text|>", ["t"])]
    assert [b.texts for b in out[None].back] == [["n", "n"]]
    assert [t for b in out[3].back for t in b.texts] == NASTY
    assert format_chat(df.limit(0)).count() == 0


def brute_pii(text):
    """The contract's patterns as written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(digits) <= 19 and sum(sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_pii_equals_the_patterns_as_written():
    random.seed(5)
    pieces = ["a@b.c", "x.y@", "@", "b.c", "1.2.3.4", ".5.6", "999", "4111 1111 1111 1111", "4111111111111111", "5-5", "+1 (459) 555-7713", "+", "é", " ", ".", "-", "0", "00255", "a" * 70, "%+"]
    for _ in range(4000):
        text = "".join(random.choice(pieces) for _ in range(random.randrange(1, 12)))
        assert [s[:3] for s in pii.find_pii(text) if s[0] != "iban"] == brute_pii(text), text


def test_pii_is_linear_in_awkward_texts():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 150_000, "A1" * 150_000, "x" * 200_000 + "@b.c"):
        pii.find_pii(text)


def test_checksums_and_context():
    assert [s[0] for s in pii.find_pii("IBAN GB82 WEST 1234 5698 7654 32 now")] == ["iban"]
    assert not [s for s in pii.find_pii("GB83 WEST 1234 5698 7654 32") if s[0] == "iban"]
    near, far = pii.find_pii("my card 4111111111111111"), pii.find_pii("thing 4111111111111111")
    assert near[0][3] == 1.0 and far[0][3] == pytest.approx(0.9)


def test_words_around_an_iban_do_not_hide_it():
    def ibans(text):
        return [text[a:b] for kind, a, b, _ in pii.find_pii(text) if kind == "iban"]

    plain, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for iban in (plain, spaced, "NO9386011117947", "MT84MALT011000012345MTLCAST001S"):
        for text in ("{}", "{} BIC COBADEFFXXX", "{} 2024-01-01", "{} A B C", "NR12 {} X1", "{}, {} 7"):
            assert ibans(text.format(iban, iban)) == [iban] * text.count("{}"), text.format(iban, iban)
    assert not ibans(plain + "x") and not ibans("x" + plain) and not ibans(plain[:-1] + "1 BIC")
    unlisted = "ZZ" + f"{98 - int('1234567890123' + '3535' + '00') % 97:02d}" + "1234567890123"
    assert ibans(unlisted + " BIC 7") == [unlisted]
    assert pii.redact_text(f"to {plain} BIC X", pii.find_pii(f"to {plain} BIC X")) == "to <IBAN> BIC X"
    pii.find_pii("AA11 " * 60_000)


def test_context_decides_for_ibans_of_unlisted_countries():
    unlisted = "ZZ" + f"{98 - int('1234567890123' + '3535' + '00') % 97:02d}" + "1234567890123"
    for text, score in ((f"bank account {unlisted}", 0.85), (f"{unlisted}, swift ABC", 0.85), (f"part {unlisted} is out", None), (f"bank {'x' * 60} {unlisted}", None)):
        found = [s for s in pii.find_pii(text) if s[0] == "iban"]
        assert [s[3] for s in found] == ([score] if score else []), text
        assert ("<IBAN>" in pii.redact_text(text, pii.find_pii(text))) == bool(score)
    listed = pii.find_pii("part DE89370400440532013000 is out")
    assert [(s[0], s[3]) for s in listed] == [("iban", 0.9)]
    # Base kinds stay without context.
    assert [(s[0], s[3]) for s in pii.find_pii("a@b.c 1.2.3.4")] == [("email", 0.6), ("ip", 0.6)]


def test_redaction_and_edges(spark):
    rows = [(1, "mail a@b.c or +1 (459) 555-7713!", 1), (2, None, 2), (3, "", 3), (None, "ip 1.2.3.4", 4), (4, "x " * 100_000 + "a@b.c", 5), (4, "x", 6)]
    got = pii.detect_pii(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].redacted == "mail <EMAIL> or <PHONE>!" and by[None].redacted == "ip <IP>"
    assert by[2].spans == [] and by[2].redacted == "" and len(got) == 6
    assert pii.detect_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pii_query(spark, con):
    import hashlib

    got = {r.doc_id: r for r in all_queries()["op7_pii"](spark, SMALL).collect()}
    for doc_id, text in con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        base = brute_pii(text)
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert len(r.scores.split(",")) == len(r.spans.split(",")) and bool(r.scores) == bool(r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
