"""Slow calls from inside a task: several in flight, tried again when they fail for a passing reason."""

from __future__ import annotations

import asyncio
import inspect
import random
import threading
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa


@dataclass(frozen=True)
class CallPolicy:
    """How a task calls: at most ``in_flight`` calls at once, each up to ``attempts`` times.

    Only errors of ``retry_on`` are tried again (by default connection and time-out errors: an answer
    that breaks a contract does not get better). Waits double from ``first_wait`` seconds up to
    ``longest_wait``, shortened at random by up to half so that tasks do not return all at once.
    """

    in_flight: int = 5
    attempts: int = 3
    first_wait: float = 1.0
    longest_wait: float = 8.0
    retry_on: tuple[type[Exception], ...] = (OSError,)

    def __post_init__(self) -> None:
        if self.in_flight < 1 or self.attempts < 1:
            raise ValueError("in_flight and attempts are at least 1")

    def waits(self) -> Iterator[float]:
        """Seconds to wait after each failed attempt but the last."""
        for i in range(self.attempts - 1):
            yield min(self.longest_wait, self.first_wait * 2.0**i) * random.uniform(0.5, 1.0)


Outcome = tuple[object, BaseException | None]

# Rows that Python handles at once; bounds its memory whatever the size of an Arrow batch.
SLICE_ROWS = 256

# Outcomes that wait, at most, for an earlier one that is tried again.
HELD_OUTCOMES = 10_000


class Caller:
    """Calls ``function``, plain or a coroutine function, by a policy; use as a context.

    Plain functions run on threads and must be safe to call from several of them. Coroutines share
    one event loop, so that a client opened on it serves all calls of a task. A call that waits to be
    tried again gives up its place, so the others go on. An exception that is no ``Exception`` (the
    process is to end) leaves the task.
    """

    def __init__(self, function: Callable, policy: CallPolicy):
        self.function, self.policy = function, policy
        self.coroutine = inspect.iscoroutinefunction(function)
        # Calls handed over ahead, so that a slow one at the front does not leave the others idle.
        self.ahead = 4 * policy.in_flight

    def __enter__(self) -> Caller:
        self.room = threading.Semaphore(self.ahead)
        self.loop = asyncio.new_event_loop()
        self.thread = threading.Thread(target=self.loop.run_forever, daemon=True)
        self.thread.start()
        if self.coroutine:
            self.gate = asyncio.Semaphore(self.policy.in_flight)
        else:
            self.pool = ThreadPoolExecutor(self.policy.in_flight)
        return self

    def __exit__(self, *_: object) -> None:
        self.loop.call_soon_threadsafe(self.loop.stop)
        self.thread.join()
        if not self.coroutine:
            self.pool.shutdown(wait=False, cancel_futures=True)

    def _start(self, arguments: tuple, waits: Iterator[float], outcome: Future) -> None:
        if self.coroutine:
            asyncio.run_coroutine_threadsafe(self._call_async(arguments, waits, outcome), self.loop)
        else:
            self.pool.submit(self._call, arguments, waits, outcome)

    def _call(self, arguments: tuple, waits: Iterator[float], outcome: Future) -> None:
        try:
            answer, error = self.function(*arguments), None
        except BaseException as exc:  # noqa: BLE001 - a failed call is a result row
            answer, error = None, exc
        self._ended(answer, error, arguments, waits, outcome)

    async def _call_async(self, arguments: tuple, waits: Iterator[float], outcome: Future) -> None:
        async with self.gate:
            try:
                answer, error = await self.function(*arguments), None
            except BaseException as exc:  # noqa: BLE001 - a failed call is a result row
                answer, error = None, exc
        self._ended(answer, error, arguments, waits, outcome)

    def _ended(self, answer: object, error: BaseException | None, arguments: tuple, waits: Iterator[float], outcome: Future) -> None:
        """One attempt is over: its outcome stands, or the next attempt is put on the clock."""
        wait = next(waits, None) if isinstance(error, self.policy.retry_on) else None
        if wait is None:
            outcome.set_result((answer, error))
        else:
            self.loop.call_soon_threadsafe(self.loop.call_later, wait, self._start, arguments, waits, outcome)
        # Later attempts of a call take no room: it is handed over once.
        if not getattr(outcome, "left", False):
            outcome.left = True
            self.room.release()

    def outcomes(self, arguments: Iterable[tuple]) -> Iterator[Outcome]:
        """(answer, error) of every call, in the order of the arguments."""
        held: deque[Future] = deque()
        for given in arguments:
            self.room.acquire()
            held.append(Future())
            self._start(given, self.policy.waits(), held[-1])
            while held and (held[0].done() or len(held) >= HELD_OUTCOMES):
                yield self._taken(held)
        while held:
            yield self._taken(held)

    def outcomes_by_slice(
        self, batches: Iterable[pa.RecordBatch], arguments: Callable[[pa.RecordBatch], Iterable[tuple]]
    ) -> Iterator[tuple[pa.RecordBatch, list[Outcome]]]:
        """Slices of the batches, each with the outcomes of its rows. Only a slice's texts become Python
        objects; the calls go on from one slice to the next without a pause."""
        begun: deque[pa.RecordBatch] = deque()

        def given() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE_ROWS):
                    begun.append(batch.slice(start, SLICE_ROWS))
                    yield from arguments(begun[-1])

        ready: list[Outcome] = []
        for outcome in self.outcomes(given()):
            ready.append(outcome)
            if len(ready) == begun[0].num_rows:
                yield begun.popleft(), ready
                ready = []

    @staticmethod
    def _taken(held: deque[Future]) -> Outcome:
        answer, error = held.popleft().result()
        if error is not None and not isinstance(error, Exception):
            raise error
        return answer, error
