"""Content identifiers as plain column expressions."""

from __future__ import annotations

import base64
import hashlib
import json

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

#: Version 1, the JSON codec, SHA-256 of 32 bytes.
_PREFIX = "01a9021220"


def cid_v1(canonical: Column) -> Column:
    """'b' and the lower-case base 32 of prefix and SHA-256, without padding.

    74 hex digits are cut into tens, each eight base-32 digits; no UDF."""
    h = F.concat(F.lit(_PREFIX), F.sha2(canonical, 256))
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(7)]
    parts.append(F.lpad(F.conv(F.concat(F.substring(h, 71, 4), F.lit("0")), 16, 32), 4, "0"))
    digits = F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "abcdefghijklmnopqrstuvwxyz234567")
    return F.concat(F.lit("b"), digits)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON of string fields, keys sorted, nulls left out."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


@F.pandas_udf(T.StringType())
def canonical_any(raw: pd.Series) -> pd.Series:
    """Canonical form of arbitrary JSON objects, number spelling kept and
    their own identifiers left out; null for what is no JSON object."""

    def one(text):
        try:
            got = json.loads(text)
        except (TypeError, ValueError):
            return None
        if not isinstance(got, dict):
            return None
        return json.dumps({k: v for k, v in got.items() if k not in ("cid", "ipfs_cid")}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    return raw.map(one)


def cid_of_text(text: str) -> str:
    """The same identifier in plain Python, for tests."""
    data = bytes.fromhex(_PREFIX) + hashlib.sha256(text.encode()).digest()
    return "b" + base64.b32encode(data).decode().lower().rstrip("=")
