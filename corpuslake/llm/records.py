"""The text inside a JSON source record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SHAPE = "text string, full_text string, record struct<text: string, full_text: string>"


def record_text(raw: Column) -> Column:
    """`text` or `full_text`, at the top or inside `record`, the first that is
    not empty; null for a raw that is null or no valid JSON. One parse."""
    got = F.from_json(raw, _SHAPE, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    parts = [got["text"], got["full_text"], got["record"]["text"], got["record"]["full_text"]]
    return F.coalesce(*[F.when(p != "", p) for p in parts])
