"""Registered queries: each plan module exposes ``QUERIES`` (name -> (spark, sf_dir) -> DataFrame)
and ``SQL`` (name -> DuckDB SQL over the same tables).  Every query reads whole tables."""

from __future__ import annotations

import importlib

MODULES = (
    "corpus", "textops", "retrieval_plans", "sequence_plans", "eval_plans", "web_plans",
    "conversation_plans", "quality_plans", "log_plans", "vocab_plans", "label_plans", "streaming_plans", "source_plans",
)


def _load():
    queries, sql = {}, {}
    for m in MODULES:
        try:
            mod = importlib.import_module(f"corpusprep.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name == f"corpusprep.plans.{m}":
                continue
            raise
        for k in mod.QUERIES:
            if k in queries:
                raise ValueError(f"query {k} registered twice")
        queries.update(mod.QUERIES)
        sql.update(getattr(mod, "SQL", {}))
    return queries, sql


def all_queries():
    return _load()[0]


def all_sql():
    return _load()[1]
