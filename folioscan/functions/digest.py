"""Digests and canonical JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(value: Column) -> Column:
    """Hex SHA-256 of bytes or UTF-8 text."""
    return F.sha2(value.cast("binary"), 256)


def canonical_json(value: Column) -> Column:
    """JSON text with sorted keys, no spaces and raw UTF-8; null for text that isn't JSON."""
    return F.pandas_udf(_canonical, "string")(value)


def _canonical(value: pd.Series) -> pd.Series:
    def one(text):
        try:
            return None if text is None else json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    return value.map(one)


def quoted(text: Column) -> Column:
    """A string as JSON, natively."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r"(?s)\A\{\"v\":(.*)\}\z", 1)


def multiset_revision(digest: Column) -> Column:
    """SHA-256 of the JSON list of a group's sorted digests; equal for equal multisets, whatever the order."""
    return sha256(F.concat(F.lit("["), F.coalesce(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('"'), digest, F.lit('"')))), ","), F.lit("")), F.lit("]")))


def bundle_digest(path: Column, digest: Column, order: Column) -> Column:
    """SHA-256 over path, NUL and raw digest of every asset of a group, in reference order."""
    parts = F.sort_array(F.collect_list(F.struct(order.alias("at"), F.concat(F.hex(path.cast("binary")), F.lit("00"), F.upper(digest)).alias("part"))))
    return F.sha2(F.unhex(F.array_join(F.transform(parts, lambda x: x["part"]), "")), 256)
