"""Block structure of Markdown by lines: headings, and places where a reading may be cut.

A small scanner, not a CommonMark parser: it knows frontmatter, fences, math
blocks, ATX headings and runs of other lines (paragraphs, lists, quotes and
tables end at a blank line). It never allows a cut inside one of them.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HEADING = re.compile(r" {0,3}#{1,6}(\s|\Z)")
FENCE = re.compile(r" {0,3}(`{3,}|~{3,})")
DEFINITION = re.compile(r" {0,3}\[(\^?[^\]]+)\]:")


def structure(text: str) -> tuple[list[int], list[int], list[tuple[str, int]]]:
    """(headings, cuts, definitions) in 0-based lines; a cut at i is one before line i; definitions are (label, line)."""
    lines = text.split("\n")
    headings, inside, definitions = [], set(), []
    i = 0
    if lines[0].strip() == "---":
        ends = [k for k, x in enumerate(lines[1:], 1) if x.strip() in ("---", "...")]
        if ends:
            i = ends[0] + 1
            inside.update(range(1, i))
    while i < len(lines):
        line, start = lines[i], i
        if not line.strip():
            i += 1
            continue
        if fence := FENCE.match(line):
            mark = fence[1]
            i += 1
            while i < len(lines) and not re.match(rf" {{0,3}}{re.escape(mark[0])}{{{len(mark)},}}\s*\Z", lines[i]):
                i += 1
            i = min(i + 1, len(lines))
        elif line.strip() == "$$":
            i += 1
            while i < len(lines) and lines[i].strip() != "$$":
                i += 1
            i = min(i + 1, len(lines))
        elif HEADING.match(line):
            headings.append(i)
            i += 1
        else:
            while i < len(lines) and lines[i].strip() and not HEADING.match(lines[i]) and not FENCE.match(lines[i]) and lines[i].strip() != "$$":
                if found := DEFINITION.match(lines[i]):
                    definitions.append((found[1].upper(), i))
                i += 1
        inside.update(range(start + 1, i))
    return headings, [k for k in range(len(lines) + 1) if k not in inside], definitions


def _structures(text: pd.Series) -> pd.DataFrame:
    found = [structure(t or "") for t in text]
    return pd.DataFrame({"headings": [h for h, _, _ in found], "cuts": [c for _, c, _ in found], "definitions": [[{"label": x, "line": n} for x, n in d] for _, _, d in found]})


def structures(text: Column) -> Column:
    """structure() as struct(headings, cuts, definitions) of 0-based lines."""
    return F.pandas_udf(_structures, "headings array<int>, cuts array<int>, definitions array<struct<label:string,line:int>>")(text)
