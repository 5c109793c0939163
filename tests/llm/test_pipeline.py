"""The pipeline stage by stage."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from jobsignals.llm import bpe, pii  # noqa: E402
from jobsignals.llm.common import stored, table  # noqa: E402
from jobsignals.llm.exact_dedup import drop_copies  # noqa: E402
from jobsignals.llm.toxicity import fit_on_folds  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), name))
    return out


def test_stages_keep_the_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_each_stage_equals_a_plain_version(spark, stages):
    rows = [{r.doc_id: r for r in df.collect()} for df in stages[:-1]]
    raw, clean, unique, distinct, redacted = rows
    model = fit_on_folds(stages[0], table(spark, SMALL, "labels"))
    assert set(clean) == {i for i, r in raw.items() if model.score(r.text or "") < 0.5}

    first = {}
    for i in sorted(clean):
        first.setdefault(clean[i].text or "", i)
    assert set(unique) == set(first.values())

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {i: shingles(r.text) for i, r in unique.items()}

    def similarity(a, b):
        return len(sets[a] & sets[b]) / len(sets[a] | sets[b])

    assert set(distinct) <= set(unique)
    for i in set(unique) - set(distinct):  # nothing goes that has no near copy
        assert max(similarity(i, j) for j in unique if j != i) >= 0.8
    left = sorted(distinct)
    assert not [(a, b) for a in left for b in left if a < b and similarity(a, b) >= 0.8]

    assert set(redacted) == set(distinct)
    for i, r in redacted.items():
        text = distinct[i].text
        assert r.text == pii.redact_text(text, pii.find_pii(text)) and r.n_chars == len(r.text)
        assert not [s for s in pii.find_pii(r.text) if s[0] == "email"]


def test_packs_all_that_is_left(spark, stages):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    lengths = {}
    for r in stages[-1].collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[-2].collect()}


def test_run(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(stages[-1].collect())


def test_drop_copies_keeps_whole_rows(spark):
    rows = [(3, "a", "x", 1), (1, "a", "y", 2), (None, "a", "z", 3), (4, None, "n", 4), (5, "", "e", 5), (None, "q", "w", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, hash int")
    assert sorted(drop_copies(df).collect(), key=str) == sorted([df.collect()[i] for i in (1, 3, 5)], key=str)
    assert drop_copies(df, content_hash=lambda c: c.substr(1, 0)).count() == 3
    assert drop_copies(df.limit(0)).columns == df.columns


def test_empty_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
