"""Operators for training-data corpora. Nothing else in the library imports this package.

A name's module is imported when the name is first used, so that Python workers load what their
own operator needs and no more.
"""

from __future__ import annotations

import importlib

_MODULES = {
    "archive": "warc",
    "count_tokens": "tokencount",
    "decontaminate": "decontamination",
    "find_contamination": "decontamination",
    "find_repeats": "repeats",
    "find_runs": "periodic",
    "first_rows": "simhash",
    "identify_languages": "langid",
    "lookup": "warc",
    "manifest": "merkle",
    "near_duplicates": "simhash",
    "pack": "packing",
    "read_index": "warc",
    "remove_repeats": "repeats",
    "score_texts": "lbl",
    "score_toxicity": "toxicity",
    "shard_groups": "sharding",
    "tampered_proofs": "merkle",
    "top_k": "topk",
    "write_archives": "warc",
}
__all__ = list(_MODULES)


def __getattr__(name: str):
    if name not in _MODULES:
        raise AttributeError(name)
    return getattr(importlib.import_module(f"assayer.llm.{_MODULES[name]}"), name)
