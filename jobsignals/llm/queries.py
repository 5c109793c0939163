"""Every query of the package; importing this module registers them."""

from __future__ import annotations

from jobsignals.llm import ann, bpe, chat, conversation_trie, exact_dedup, lexical, line_dedup, lm, packing, pii, quality_trees, simhash, toxicity  # noqa: F401
from jobsignals.llm.common import ORACLES, QUERIES, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
