"""The queries of this subpackage with the SQL that must agree, where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}

MODULES = ["suffix_dedup", "ngram_join", "vectors", "licenses", "secrets", "quality", "lm", "urls", "mixing", "packing", "line_dedup", "negatives", "spelling"]

for _module in MODULES:
    REGISTRY.update(importlib.import_module(f"panelcast.llm.{_module}").QUERIES)

REGISTRY["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
