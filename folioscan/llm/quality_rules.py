"""Quality rules whose cutoffs limit false rejection, with exact binomial bounds on labelled holdouts.

Each rule scores a document and rejects scores above a cutoff. On the good
documents of the labelled holdout, for each stratum and rule, cutoffs are
tested from the most lenient to stricter ones: "this cutoff rejects more than
`risk` of good documents" must be refuted by an exact binomial tail. The first
cutoff that can't be certified ends the sequence (so the order itself pays for
the many cutoffs), and the level is divided by the number of strata and rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import SPARING, hashed, materialise, raw, small, windows, word_hashes

#: Each rule with its cutoffs from strict to lenient.
GRIDS = {
    "symbols_per_word": np.geomspace(0.01, 1.0, 41),
    "repeated_lines": np.linspace(0.02, 0.98, 49),
    "repeated_words": np.linspace(0.02, 0.30, 29),
    "long_words": np.linspace(4.0, 20.0, 65),
    "short_words": np.linspace(-6.0, -1.0, 51),
}
WINDOW = 8
BLANK = b" \t\n\r\x0b\x0c"


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a window of eight words which occurs twice or more in the text."""
    n = len(hashes)
    if n <= WINDOW:
        return 0
    runs = windows(hashes, WINDOW)
    order = np.sort(runs)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(runs, twice))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def base(data: bytes, memo) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the lines that have words."""
    words = data.split()
    blanks = sum(data.count(b) for b in BLANK)
    chars = len(data) if data.isascii() else len(data.decode())
    lines = [x for x in data.split(b"\n") if x.strip(BLANK)]
    symbols = sum(data.count(b) for b in b"#*$%&|<>")
    return len(words), chars - blanks, symbols, len(lines) - len(set(lines)), repeated_words(hashed(words, memo)), len(lines)


def scores(n_words: int, chars: int, symbols: int, dup_lines: int, repeats: int, lines: int) -> tuple[float, ...]:
    """The rules' scores, in the order of GRIDS."""
    w = max(n_words, 1)
    return symbols / w, dup_lines / max(lines, 1), repeats / w, chars / w, -chars / w


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base counts, and for each rule the number of cutoffs that would reject the document."""
    memo = word_hashes()
    grids = list(GRIDS.values())
    for batch in batches:
        rows = [base(x, memo) for x in raw(batch)]
        bins = [[int(np.searchsorted(g, s, "left")) for g, s in zip(grids, scores(*r), strict=True)] for r in rows]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        arrays = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"] + [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(bins, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(arrays, [x for x in batch.schema.names if x != "text"] + BASE + ["bins"])


def failed(n_words, n_repeat_words):
    """The base rule: fewer than 20 words, or over 30 per cent of them in repeated windows."""
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def log_tail(k: np.ndarray, n: int, p: float) -> np.ndarray:
    """log P(Bin(n, p) <= k) for sorted or unsorted k, exact but for rounding."""
    top = int(k.max())
    i = np.arange(1, top + 1)
    terms = np.concatenate([[n * np.log1p(-p)], np.zeros(top)])
    if top:
        with np.errstate(divide="ignore"):
            terms[1:] = terms[0] + np.cumsum(np.log(np.maximum(n - i + 1, 0) / i * (p / (1 - p))))
    return np.logaddexp.accumulate(terms)[k]


def certified(counts: np.ndarray, risk: float, level: float) -> int:
    """Index of the strictest certified cutoff; len(counts) - 1 (no cutoff) if there is none.

    counts[b]: good holdout documents that b cutoffs reject. Cutoff j rejects
    those with b > j.
    """
    n = int(counts.sum())
    grid = len(counts) - 1
    if not n:
        return grid
    rejected = n - np.cumsum(counts)[:grid]
    refuted = log_tail(rejected, n, risk) <= np.log(level)
    best = grid
    for j in range(grid - 1, -1, -1):
        if not refuted[j]:
            break
        best = j
    return best


def measured(docs: DataFrame, id_col: str, text_col: str, stratum_col: str | None) -> DataFrame:
    stratum = F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")
    t = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), stratum.alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return t.mapInArrow(_measure, "doc_id long, stratum string, " + ", ".join(f"{x} long" for x in BASE) + ", bins array<int>")


def cutoffs(seen: DataFrame, labels: DataFrame, risk: float, level: float) -> DataFrame:
    """stratum, limits: for each rule the largest number of rejecting cutoffs that a kept document may have.

    seen: the rows of measured(). Only counts by stratum, rule and bin are
    shuffled. Labels with a null id or quality don't count; several labels of
    one document count once, as the worst of them.
    """
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality")).where("quality = 1 AND doc_id IS NOT NULL").select("doc_id")
    holdout = seen.where(~failed(F.col("n_words"), F.col("n_repeat_words"))).join(small(good, **SPARING), "doc_id", "left_semi")
    counts = holdout.select("stratum", F.posexplode("bins").alias("rule", "bin")).groupBy("stratum", "rule", "bin").count()
    tests = max(1, counts.select("stratum").distinct().count()) * len(GRIDS)
    sizes = [len(g) for g in GRIDS.values()]

    def limits(pdf: pd.DataFrame) -> pd.DataFrame:
        of = []
        for rule, size in enumerate(sizes):
            part = pdf[pdf["rule"] == rule]
            of.append(certified(np.bincount(part["bin"], weights=part["count"], minlength=size + 1).astype(np.int64), risk / len(sizes), level / tests))
        return pd.DataFrame({"stratum": pdf["stratum"].iloc[:1].to_numpy(), "limits": [of]})

    return counts.groupBy("stratum").applyInPandas(limits, "stratum string, limits array<int>")


def _within() -> F.Column:
    return F.coalesce(F.forall(F.arrays_zip("bins", "limits"), lambda x: x["bins"] <= x["limits"]), F.lit(True))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.05, level: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """One row for each row of docs: doc_id, the base counts, base_failed, kept.

    With probability 1 - level, in every stratum at once, the certified rules
    reject at most a share `risk` of the good documents that pass the base
    rule. A stratum without enough labelled documents gets no cutoffs. A null
    text has no words (base_failed); a null stratum is one stratum; null ids
    stay null; repeated rows give repeated rows; an empty table an empty one.
    """
    seen = materialise(measured(docs, id_col, text_col, stratum_col), "quality")
    limits = materialise(cutoffs(seen, labels, risk, level), "cutoffs")
    bad = failed(F.col("n_words"), F.col("n_repeat_words"))
    return seen.join(small(limits), "stratum", "left").select("doc_id", *BASE, bad.alias("base_failed"), (~bad & _within()).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = 0.05, level: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """The rows of docs, all columns unchanged, that quality_rules keeps; no text is shuffled.

    The texts are read twice, once for the holdout's counts and once to filter.
    """
    seen = materialise(measured(docs, id_col, text_col, stratum_col), "quality")
    limits = materialise(cutoffs(seen, labels, risk, level), "cutoffs")
    names = docs.columns
    stratum = F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")
    flat = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), stratum.alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text"))
    joined = flat.join(small(limits), "stratum", "left").select("row", "limits", "text")
    verdict = F.pandas_udf(_verdict, "boolean")
    return joined.where(verdict("text", "limits")).select("row.*")


def _verdict(text: pd.Series, limits: pd.Series) -> pd.Series:
    memo = word_hashes()
    grids = list(GRIDS.values())
    out = []
    for t, most in zip(text, limits, strict=True):
        r = base((t or "").encode(), memo)
        ok = not failed(r[0], r[4])
        out.append(ok and (most is None or all(np.searchsorted(g, s, "left") <= m for g, s, m in zip(grids, scores(*r), most, strict=True))))
    return pd.Series(out, dtype=bool)
