"""JSON in model replies, page differences and policies."""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A fence around JSON, and how a reply of claims begins.
FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.IGNORECASE | re.DOTALL)
OPENER = '{"claims"'


def _whole(text: str):
    """(True, value) if a text is JSON."""
    try:
        return True, json.loads(text.strip())
    except ValueError:
        return False, None


def _objects(text: str, starts: Iterator[int], unfold: bool) -> Iterator:
    """Values that begin at given places; wrapped lines are joined first if asked for."""
    decoder = json.JSONDecoder()
    for at in starts:
        part = text[at:]
        try:
            yield decoder.raw_decode(re.sub(r"\n[ \t]+", " ", part) if unfold else part)[0]
        except (ValueError, RecursionError):
            continue


def packet_json(reply: str | None):
    """The packet in a reply: all of it, a fenced part, or the first object with a list of claims, the protocol's opener first."""
    text = (reply or "").strip()
    for part in (text, *FENCE.findall(text)):
        ok, value = _whole(part)
        if ok:
            return value
    first = text.find(OPENER)
    starts = [first] if first >= 0 else []
    starts += [m.start() for m in re.finditer(r"[\[{]", text) if m.start() != first]
    return next((v for v in _objects(text, iter(starts), True) if isinstance(v, dict) and isinstance(v.get("claims"), list)), None)


def repair_json(reply: str | None):
    """The proposal in a reply: an object with the key "found"."""
    text = (reply or "").strip()
    ok, value = _whole(text)
    if ok and isinstance(value, dict) and "found" in value:
        return value
    return next((v for v in _objects(text, (m.start() for m in re.finditer(r"\{", text)), False) if isinstance(v, dict) and "found" in v), None)


def worker_json(reply: str | None):
    """A worker's packet: fences off, cut to the protocol's opener."""
    text = re.sub(r"\A```(?:json)?\s*|\s*```\Z", "", (reply or "").strip())
    at = text.find(OPENER)
    return next(_objects(text, iter([max(at, 0)]), False), None)


def _as_text(function, replies: pd.Series) -> pd.Series:
    found = replies.map(function)
    return found.map(lambda v: None if v is None else json.dumps(v, ensure_ascii=False))


def _packets(replies: pd.Series) -> pd.Series:
    return _as_text(packet_json, replies)


def _repairs(replies: pd.Series) -> pd.Series:
    return _as_text(repair_json, replies)


def packets(reply: Column) -> Column:
    """packet_json() as JSON text; null if there is none."""
    return F.pandas_udf(_packets, "string")(reply)


def repairs(reply: Column) -> Column:
    """repair_json() as JSON text; null if there is none."""
    return F.pandas_udf(_repairs, "string")(reply)


def _differences(before: pd.Series, after: pd.Series, path: pd.Series) -> pd.Series:
    def one(a, b, p):
        lines = difflib.unified_diff((a or "").splitlines(True), (b or "").splitlines(True), f"before/{p}", f"after/{p}")
        return "".join(lines)

    return pd.Series([one(a, b, p) for a, b, p in zip(before, after, path, strict=True)], dtype="object")


def unified_diff(before: Column, after: Column, path: Column) -> Column:
    """Unified diff of two versions of a page; null counts as no lines."""
    return F.pandas_udf(_differences, "string")(before, after, path)


def policy_errors(policy: dict, keys: tuple[str, ...]) -> list[str]:
    """What is wrong with a policy: keys that lack or are unknown, numbers that aren't positive integers (true is none)."""
    bad = [f"missing {k}" for k in keys if k not in policy] + [f"unknown {k}" for k in policy if k not in keys]
    return bad + [f"{k} must be a positive integer" for k in keys if k in policy and (type(policy[k]) is not int or policy[k] < 1)]


def layered(*layers: dict | None) -> dict:
    """Settings of several layers, later ones first; nested settings are merged, null layers skipped."""
    out: dict = {}
    for layer in layers:
        for k, v in (layer or {}).items():
            out[k] = layered(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


#: Fields that every project must have, and those that only projects without readings must have.
ALWAYS, WITHOUT_READINGS = 2, 5


def missing_fields(project: dict, required: tuple[str, ...]) -> list[str]:
    """Required fields that a project lacks; one with readings needs the first ALWAYS of them only."""
    return [f for f in required[: ALWAYS if "reading" in project else WITHOUT_READINGS] if f not in project]
