"""The operators and plans applied to the benchmark tables, each with its SQL oracle."""

from __future__ import annotations

from jobsignals.lens import postings, storage, tables  # noqa: F401
from jobsignals.lens.registry import ORACLES, QUERIES, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
