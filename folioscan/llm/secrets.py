"""Secret scan: known forms first, then strings that a randomness battery tells from ordinary text.

Long runs of key characters are candidates; one whose separators come every few
characters, as in paths and slugs, is no single encoding and is judged by its
parts. For each, the smallest alphabet
that holds it is inferred, and three statistics are taken: chi-squared against
a uniform alphabet, changes between character classes (a runs test), and the
lag-one serial correlation of the alphabet's indices. Each gives a p-value
under the null hypothesis "ordinary text"; they are combined, and a weighted
Benjamini-Hochberg rule over all candidates of the corpus, with weights by
length, decides.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import materialise, strings, texts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SEPARATORS = re.compile(r"[+/_=-]+")
#: Characters from one separator to the next, on average, below which a run is several words.
APART = 12
KINDS = ("assign", "access", "hex", "random")

LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
WORDS = frozenset(LOWER)
#: Alphabets from the smallest to the largest; the first that holds a string is inferred.
ALPHABETS = (DIGIT, DIGIT + "abcdef", DIGIT + "ABCDEF", LOWER, UPPER, UPPER + "234567", DIGIT + LOWER, DIGIT + UPPER, LOWER + UPPER, LOWER + UPPER + DIGIT, LOWER + UPPER + DIGIT + "+/_=-")
#: Shares of the letters a to z in ordinary English text, in per mille.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: Chance of a change of class between neighbours, and the serial correlation, in ordinary text.
CHANGES, SERIAL = 0.12, 0.35
#: Bands of lengths with their prior weights; longer strings carry more evidence.
BANDS = ((16, 0.3), (20, 0.5), (24, 0.8), (32, 1.2), (48, 1.5), (64, 1.5))
STEPS, DEPTH = 10, 400


def _normal(z: float) -> float:
    """Lower tail of the standard normal, as a natural logarithm that doesn't underflow."""
    if z > -30:
        return math.log(max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-300))
    return -0.5 * z * z - math.log(-z * math.sqrt(2 * math.pi))


@lru_cache(maxsize=64)
def _moments(alphabet: str) -> tuple[float, float, float]:
    """Sums of the squared and cubed character shares of ordinary text over an alphabet."""
    shares = {c: LETTERS[ord(c) - 97] for c in alphabet if c in LOWER} or {c: LETTERS[ord(c) - 65] for c in alphabet if c in UPPER} or dict.fromkeys(alphabet, 1)
    total = sum(shares.values())
    p = [v / total for v in shares.values()]
    return sum(x**2 for x in p), sum(x**3 for x in p), len(alphabet)


def infer(s: str) -> str:
    """The smallest of the alphabets that holds all of s."""
    have = set(s)
    return next(a for a in ALPHABETS if have <= set(a))


def battery(s: str) -> float:
    """log10 of the combined p-value of s under "ordinary text"; 0 for s that no test tells apart."""
    n, alphabet = len(s), infer(s)
    if alphabet == DIGIT:
        return 0.0
    two, three, k = _moments(alphabet)
    index = np.array([alphabet.index(c) for c in s], float)
    counts = np.bincount(index.astype(int), minlength=int(k))
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    mean = (k - 1) + (n - 1) * max(k * two - 1, 0.15 * (k - 1) / 2)
    spread = math.sqrt(2 * (k - 1) + 4 * n * max(k * k * (three - two * two), 0.05 * k))
    # a capital that begins a word in lower case is of the word's class
    classes = np.array([0 if c in LOWER or (c in UPPER and s[i + 1 : i + 2] in WORDS and (not i or s[i - 1] not in UPPER + DIGIT)) else 1 if c in UPPER else 2 if c in DIGIT else 3 for i, c in enumerate(s)])
    changes = int((classes[1:] != classes[:-1]).sum())
    expect, dev = (n - 1) * CHANGES, math.sqrt((n - 1) * CHANGES * (1 - CHANGES))
    centred = index - index.mean()
    power = float((centred**2).sum())
    serial = abs(float((centred[1:] * centred[:-1]).sum()) / power) if power else 1.0
    z = ((mean - chi) / spread, (changes - 0.5 - expect) / dev, (SERIAL - serial) * math.sqrt(n) / (1 - SERIAL**2))
    # the tests share the string: their scores are added as if correlated by a half
    return min(0.0, _normal(-sum(z) / math.sqrt(6)) / math.log(10))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[re.Match]]:
    """(start, kind, end) of the known forms, and the runs of key characters."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    runs = list(RUN.finditer(text))
    for m in runs:
        spans += [(a.start(), 1, a.end()) for a in ACCESS.finditer(text, m.start(), m.end())]
        spans += [(h.start(), 2, h.end()) for h in HEX.finditer(text, m.start(), m.end())]
    return sorted(spans), runs


def _parts(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs that may be one encoding, and the long enough parts of the others."""
    out = []
    for a, b in spans:
        marks = [m.span() for m in SEPARATORS.finditer(text, a, b) if a < m.start() and m.end() < b]
        if b - a >= APART * (len(marks) + 1) + len(marks):
            out.append((a, b))
        else:
            edges = [a, *(x for m in marks for x in m), b]
            out += [(x, y) for x, y in zip(edges[::2], edges[1::2], strict=True) if y - x >= BANDS[0][0]]
    return out


def _clear(runs: list[re.Match], spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the runs that touch no span; both go by start, and runs don't overlap, so one walk does."""
    out, at, reached = [], 0, 0
    for m in runs:
        while at < len(spans) and spans[at][0] < m.end():
            reached = max(reached, spans[at][2])
            at += 1
        if reached <= m.start():
            out.append((m.start(), m.end()))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCAN = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, starts array<long>, ends array<long>, bands array<int>, bins array<int>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "starts", "ends", "bands", "bins"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.int32())] * 2
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch), strict=True):
            spans, runs = base_spans(text)
            found = _parts(text, _clear(runs, spans))
            bands = [max(i for i, (least, _) in enumerate(BANDS) if b - a >= least) for a, b in found]
            bins = [max(-DEPTH, math.ceil(battery(text[a:b]) * STEPS)) for a, b in found]
            base = joined(spans)
            rows.append((doc_id, *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(base.encode()).hexdigest(), base, [a for a, _ in found], [b for _, b in found], bands, bins))
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], fields)


def cutoffs(counts: dict[tuple[int, int], int], rate: float) -> list[int]:
    """For each band, the largest bin that is discovered; below -DEPTH if none is.

    counts: candidates by (band, bin); bin b holds p-values up to 10**(b / STEPS).
    """
    m = sum(counts.values())
    if not m:
        return [-DEPTH - 1] * len(BANDS)
    scale = m / sum(n * BANDS[band][1] for (band, _), n in counts.items())
    edge = {(band, b): 10 ** (b / STEPS) / (BANDS[band][1] * scale) for band, b in counts}
    best, seen = 0.0, 0
    for at in sorted(counts, key=edge.get):
        seen += counts[at]
        if edge[at] <= rate * seen / m:
            best = edge[at]
    # equal edges in several bands go together
    return [max([b for (k, b) in counts if k == band and edge[k, b] <= best], default=-DEPTH - 1) for band in range(len(BANDS))]


def secret_scan(docs: DataFrame, rate: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    spans lists kind:start:end in code points, ends exclusive, by start and
    kind. `rate` is the share of false discoveries allowed among the spans
    that the battery adds; those that touch a known form are not added. A null
    text counts as empty, a null id stays null, repeated rows give repeated
    rows, an empty table an empty one. The scan's small results are written
    once; only the candidates' counts by band and p-value bin, at most
    len(BANDS) * (DEPTH + 1) rows, reach the driver.
    """
    seen = materialise(texts(docs, id_col, text_col).mapInArrow(_scan, SCAN), "secrets")
    pairs = seen.select(F.explode(F.arrays_zip("bands", "bins")).alias("c"))
    counts = {(r[0], r[1]): r[2] for r in pairs.groupBy("c.bands", "c.bins").count().collect()}
    most = F.array(*[F.lit(b) for b in cutoffs(counts, rate)])
    picked = F.filter(F.arrays_zip("starts", "ends", "bands", "bins"), lambda c: c["bins"] <= F.element_at(most, c["bands"] + 1))
    order = {k: i for i, k in enumerate(KINDS)}
    base = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(2)).cast("long").alias("a"), F.element_at(F.create_map(*[F.lit(y) for kv in order.items() for y in kv]), F.split_part(x, F.lit(":"), F.lit(1))).alias("k"), x.alias("s")))
    more = F.transform(picked, lambda c: F.struct(c["starts"].alias("a"), F.lit(order["random"]).alias("k"), F.concat_ws(":", F.lit("random"), c["starts"], c["ends"]).alias("s")))
    spans = F.array_join(F.transform(F.array_sort(F.concat(base, more)), lambda x: x["s"]), ",")
    return seen.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.when(F.size(picked) == 0, F.col("base")).otherwise(spans).alias("spans"))
