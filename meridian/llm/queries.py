"""The queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

from meridian.llm import bpe, byte_bpe, byte_dedup, language, media, merkle, mixing, periodic, sharding, simhash, substring_dedup, topk, toxicity

_MODULES = (substring_dedup, mixing, language, topk, media, simhash, bpe, toxicity, byte_dedup, sharding, merkle, periodic, byte_bpe)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
