"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import corpus, general, index, inventory, ledger, records, shapes, store, streams

_PARTS = [general, index, store, corpus, inventory, streams, records, ledger, shapes]
QUERIES = {k: f for m in _PARTS for k, f in m.QUERIES.items()}
SQL = {k: s for m in _PARTS for k, s in m.SQL.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["pointer_lookup"](spark, folder)
