"""Calls in flight, order, retries."""

from __future__ import annotations

import asyncio
import threading
import time
from datetime import datetime

import pytest

from jobsignals.operators.calls import Caller, CallPolicy
from jobsignals.operators.evaluation import judge
from jobsignals.operators.extraction import extract_signals
from postings_fixture import DAY

QUICK = {"first_wait": 0.001, "longest_wait": 0.002}


class Gauge:
    """How many calls are open, and the most that ever were."""

    def __init__(self):
        self.now = self.most = 0
        self.lock = threading.Lock()

    def __enter__(self):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)

    def __exit__(self, *_):
        with self.lock:
            self.now -= 1


@pytest.mark.parametrize("kind", ["plain", "coroutine"])
def test_calls_overlap_up_to_the_bound_and_keep_their_order(kind):
    gauge = Gauge()

    def plain(n):
        with gauge:
            time.sleep(0.002 * (n % 5))
        return n * n

    async def coroutine(n):
        with gauge:
            await asyncio.sleep(0.002 * (n % 5))
        return n * n

    with Caller({"plain": plain, "coroutine": coroutine}[kind], CallPolicy(in_flight=4)) as caller:
        for size in (60, 0, 7):
            assert list(caller.outcomes((i,) for i in range(size))) == [(i * i, None) for i in range(size)]
    assert gauge.most == 4


@pytest.mark.parametrize("coroutine", [False, True])
def test_passing_errors_are_tried_again(coroutine):
    tries = {}

    def answer(n):
        tries[n] = tries.get(n, 0) + 1
        if n == 1 and tries[n] < 3:
            raise ConnectionError("busy")
        if n == 2:
            raise TimeoutError("never")
        if n == 3:
            raise ValueError("no use")
        return n

    async def answer_later(n):
        return answer(n)

    with Caller(answer_later if coroutine else answer, CallPolicy(in_flight=2, attempts=3, **QUICK)) as caller:
        found = list(caller.outcomes((i,) for i in range(5)))
    assert [a for a, _ in found] == [0, 1, None, None, 4]
    assert isinstance(found[2][1], TimeoutError) and isinstance(found[3][1], ValueError)
    assert tries == {0: 1, 1: 3, 2: 3, 3: 1, 4: 1}


def test_waits_grow_to_a_bound():
    waits = list(CallPolicy(attempts=6, first_wait=1, longest_wait=8).waits())
    assert len(waits) == 5 and all(w / 2 <= x <= w for x, w in zip(waits, (1, 2, 4, 8, 8)))
    with pytest.raises(ValueError):
        CallPolicy(in_flight=0)


def test_the_end_of_the_process_is_no_result():
    def answer(n):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt), Caller(answer, CallPolicy()) as caller:
        list(caller.outcomes([(1,)]))


def test_calls_of_one_task_overlap(spark):
    """Eight calls that wait for one another: they end only if all are open at once."""

    barrier = []

    def extractor(text):
        if not barrier:
            barrier.append(threading.Barrier(8, timeout=20))
        barrier[0].wait()
        return {"years_experience": 3}

    rows = spark.createDataFrame([(str(i), DAY, f"text {i}") for i in range(16)], "job_id string, snapshot_date date, description_text string")
    records = extract_signals(rows, extractor, "m", datetime(2026, 5, 6), parallelism=1, policy=CallPolicy(in_flight=8, attempts=1)).collect()
    assert len(records) == 16 and {r.extraction_status for r in records} == {"ok"}


def test_a_call_that_succeeds_at_its_third_try(spark):
    tries = {}

    async def extractor(text):
        tries[text] = tries.get(text, 0) + 1
        if tries[text] < 3:
            raise ConnectionError("busy")
        return {"years_experience": tries[text]}

    rows = spark.createDataFrame([(str(i), DAY, f"text {i}") for i in range(12)], "job_id string, snapshot_date date, description_text string")
    for attempts, status in ((3, "ok"), (2, "error")):
        policy = CallPolicy(in_flight=5, attempts=attempts, **QUICK)
        records = extract_signals(rows, extractor, "m", datetime(2026, 5, 6), parallelism=2, policy=policy).collect()
        assert sorted(int(r.job_id) for r in records) == list(range(12))
        assert {(r.extraction_status, r.years_experience) for r in records} == {(status, 3 if status == "ok" else None)}


def test_answers_without_a_json_form_are_error_rows(spark):
    rows = spark.createDataFrame([("1", DAY, "a"), ("2", DAY, "b")], "job_id string, snapshot_date date, description_text string")
    records = extract_signals(rows, lambda text: {"x": {1, 2}} if text == "a" else {}, "m", datetime(2026, 5, 6)).collect()
    assert {r.job_id: r.extraction_status for r in records} == {"1": "error", "2": "ok"}


def test_judges_are_called_by_the_same_policy(spark):
    tries = {}

    def judge_fn(text, extraction):
        tries[text] = tries.get(text, 0) + 1
        if tries[text] < 2:
            raise TimeoutError("busy")
        return {"skill": {"verdict": "correct", "reasoning": extraction["skill"]}}

    rows = spark.createDataFrame([(str(i), f"text {i}") for i in range(9)], "skill string, description_text string")
    judged = judge(rows, judge_fn, ["skill"], parallelism=1, policy=CallPolicy(**QUICK)).collect()
    assert all(r.error is None and r.skill_judgment.reasoning == r.skill for r in judged) and len(judged) == 9


@pytest.mark.parametrize("coroutine", [False, True])
def test_calls_that_wait_give_up_their_place(coroutine):
    """Fifty calls wait a quarter of a second each; one after the other in two places they took over four."""

    def answer(n):
        if n % 2:
            raise TimeoutError("never")
        return n

    async def answer_later(n):
        return answer(n)

    begun = time.monotonic()
    with Caller(answer_later if coroutine else answer, CallPolicy(in_flight=2, attempts=2, first_wait=0.5)) as caller:
        found = list(caller.outcomes((i,) for i in range(100)))
    assert [a for a, _ in found] == [None if i % 2 else i for i in range(100)]
    assert time.monotonic() - begun < 2.5


def test_slices_get_the_outcomes_of_their_rows():
    """Rows of an Arrow batch are handed over in small slices, and calls do not pause between them."""
    import pyarrow as pa

    from jobsignals.operators.calls import SLICE_ROWS, Caller

    batches = [pa.record_batch({"x": list(range(lo, hi))}) for lo, hi in ((0, 3000), (3000, 3000), (3000, 3001))]
    with Caller(lambda x: -x, CallPolicy(in_flight=3)) as caller:
        parts = list(caller.outcomes_by_slice(batches, lambda part: ((x,) for x in part.column(0).to_pylist())))
    assert max(part.num_rows for part, _ in parts) == SLICE_ROWS
    assert [x for part, _ in parts for x in part.column(0).to_pylist()] == list(range(3001))
    assert [answer for _, outcomes in parts for answer, _ in outcomes] == [-x for x in range(3001)]
