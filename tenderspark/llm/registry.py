"""The queries of this subpackage and their SQL, gathered for the repository's entry module."""

from __future__ import annotations

import corpus_pipeline
from tenderspark.llm import q_archive, q_corpus, q_models, q_search, q_text

MODULES = (q_archive, q_corpus, q_models, q_search, q_text)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {name: sql for m in MODULES for name, sql in m.SQL.items()} | own
