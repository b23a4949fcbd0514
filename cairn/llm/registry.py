"""The queries of this package: name to builder, and their DuckDB SQL."""

from __future__ import annotations

import importlib

#: Modules that register a query with ``query``.
MODULES = ("embedding_dedup", "license_scan", "line_dedup", "quality_rules", "secret_scan",
           "piece_codec", "packing", "hilbert_shards", "toxicity", "minhash_dedup", "lexical_search",
           "merkle_manifest", "bpe_codec")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _load():
    for m in MODULES:
        importlib.import_module(f"cairn.llm.{m}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
