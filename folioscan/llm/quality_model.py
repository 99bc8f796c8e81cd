"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document. Expectation
maximisation over the counts of vote patterns (at most 3**8 of them, however
many documents there are) estimates each labeller's accuracy and gives every
pattern a posterior. The posteriors of a bounded sample train a linear scorer
over hashed features, which then scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import Memo, hashed, materialise, raw, texts, word_hashes
from folioscan.llm.quality_rules import base

#: Dimensions of the hashed features; the first PLAIN are kept for bins of document measures.
DIMENSIONS = 1 << 16
PLAIN = 256
VOTES = "-01"


SIGNS = b"#*$%&|<>"
#: What document measures() returns, after the words, in this order.
MEASURES = ("words", "symbols", "pipes", "marked", "signs", "ends", "repeats", "distinct", "length", "lines", "stutter")


def measures(data: bytes, memo: Memo) -> tuple[list[bytes], list[float]]:
    """The words of a text, and per word: symbols, pipes, words that end in a symbol, sentence marks, words in repeated windows, distinct words, characters, immediate repeats; also signs a byte and the share of repeated lines."""
    words = data.split()
    n, chars, symbols, dup_lines, repeats, lines = base(data, memo)
    w = max(n, 1)
    ends = sum(data.count(x) for x in (b". ", b", ", b".\n", b"; ", b"! ", b"? "))
    marked = sum(x[-1] in SIGNS for x in words)
    signs = len(data) - len(data.translate(None, SIGNS + b"@^_~=+\\/{}[]"))
    stutter = sum(map(bytes.__eq__, words, words[1:]))
    return words, [n, symbols / w, data.count(b"|") / w, marked / w, signs / max(len(data), 1), ends / w, repeats / w, len(set(words)) / w, chars / w, dup_lines / max(lines, 1), stutter / w]


def votes(m: list[float]) -> str:
    """The labellers' votes: 1 good, 0 bad, - abstains."""
    n, symbols, pipes, marked, signs, ends, repeats, distinct, length, lines, stutter = m
    rules = (
        (symbols > 0.10, symbols < 0.02),
        (marked > 0.20 or pipes > 0.15, marked < 0.02),
        (signs > 0.03, signs < 0.01),
        (n >= 20 and not 0.01 <= ends <= 0.6, 0.03 <= ends <= 0.4),
        (stutter > 0.10, stutter < 0.03),
        (repeats > 0.20, repeats < 0.02),
        (n >= 50 and distinct < 0.15, distinct > 0.30),
        (lines > 0.40 or not 2.5 <= length <= 11, lines < 0.10 and 3.5 <= length <= 8.5),
    )
    return "".join("0" if bad else "1" if good else "-" for bad, good in rules)


LABELLERS = len(votes([0.0] * len(MEASURES)))


def fit_labellers(patterns: dict[str, int], rounds: int = 100, prior: float = 0.8) -> tuple[dict[str, float], np.ndarray, float]:
    """Posterior P(good) of each pattern, P(vote | class) [class, labeller, vote], and the share of good documents.

    Labellers are taken as independent given the class. At the start two bad
    votes outweigh any good ones, as a document that is bad in one way is good
    in others; so the classes keep their meaning.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.full((2, LABELLERS, 3), 1 / 3), prior
    vote = np.array([[VOTES.index(c) for c in p] for p in names])
    weight = np.array([patterns[p] for p in names], float)
    good = 1 / (1 + np.exp(2.0 * (vote == 1).sum(1) - 2.5))
    chance = np.zeros((2, LABELLERS, 3))
    for _ in range(rounds):
        for c, p in ((1, good), (0, 1 - good)):
            for v in range(3):
                chance[c, :, v] = ((vote == v) * (weight * p)[:, None]).sum(0) + 1
            chance[c] /= chance[c].sum(1, keepdims=True)
        share = (weight * good).sum() / weight.sum()
        share = min(max(share, 1e-3), 1 - 1e-3)
        pick = np.log(chance[:, np.arange(LABELLERS)[None, :], vote]).sum(2)
        new = 1 / (1 + np.exp(np.clip(pick[0] - pick[1] + np.log((1 - share) / share), -500, 500)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return dict(zip(names, good.tolist(), strict=True)), chance, float(share)


def _bins(m: list[float]) -> list[int]:
    """Document measures as indices below PLAIN, 16 bins each."""
    scaled = [np.log1p(m[0]) * 1.5, m[1] * 15, m[2] * 15, m[3] * 15, m[4] * 100, m[5] * 30, m[6] * 15, m[7] * 15, m[8], m[9] * 15, m[10] * 15]
    return [16 * k + int(min(max(x, 0), 15)) for k, x in enumerate(scaled)]


def shape(word: bytes) -> bytes:
    """Runs of letters, digits and bytes above ASCII as one character each; signs stay."""
    out = bytearray()
    for b in word:
        c = 97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
        if not out or out[-1] != c:
            out.append(c)
    return bytes(out)


@lru_cache(maxsize=1)
def _features() -> Features:
    return Features()


def features() -> Features:
    """One Features for each worker, kept from task to task; other memos are emptied."""
    f = _features()
    Memo.only(f.memo, f.slots)
    return f


class Features:
    def __init__(self):
        self.memo = word_hashes()
        self.hash = self.memo.compute
        self.slots = Memo(self._slots, 300_000)

    def _slots(self, word: bytes) -> int:
        """Two indices in one number: of the word and of its shape."""
        at = lambda x: PLAIN + x % (DIMENSIONS - PLAIN)
        return at(self.hash(word)) << 32 | at(self.hash(b"shape " + shape(word)))

    def of(self, data: bytes) -> tuple[str, np.ndarray, np.ndarray]:
        """Votes, indices of the bins, and indices of the words and their shapes."""
        words, m = measures(data, self.memo)
        pair = hashed(words, self.slots)
        return votes(m), np.array(_bins(m)), np.concatenate([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)]).astype(np.int64)


def train(rows: list[tuple[float, np.ndarray, np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 0.5, decay: float = 1e-6, seed: int = 7) -> np.ndarray:
    """Weights of the scorer by AdaGrad; rows: target, bins, word indices, shares of the words."""
    weights, power = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-2)
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            target, bins, index, share = rows[k]
            z = weights[bins].sum() + (weights[index] * share).sum() + weights[-1]
            step = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
            for at, g in ((bins, step + decay * weights[bins]), (index, step * share + decay * weights[index]), (np.array([DIMENSIONS]), np.array([step]))):
                power[at] += g * g
                weights[at] -= rate * g / np.sqrt(power[at])
    return weights


def classify(docs: DataFrame, sample: int = 10_000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, votes, posterior, score, kept.

    posterior: P(good) by the label model; score: P(good) by the scorer; kept:
    score >= threshold. The label model counts the votes of all documents; the
    scorer is fitted on about `sample` different rows, those with the smallest
    hashes of id and text, whatever the input's size and however often a row
    is repeated; all of them if there are fewer. A null text counts as
    empty (few words, so most labellers abstain or vote bad); a null id stays
    null; repeated rows give repeated rows; an empty table gives an empty one.
    """
    t = texts(docs, id_col, text_col)
    spark = docs.sparkSession

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_hashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(measures(x, memo)[1]) for x in raw(batch)], pa.string()), batch.column("at")], ["votes", "at"])

    at = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 33)
    seen = materialise(t.withColumn("at", at).select("text", "at").mapInArrow(look, "votes string, at long"), "votes")
    patterns = {r[0]: r[1] for r in seen.groupBy("votes").count().collect()}
    posterior, _, _ = fit_labellers(patterns)
    # the hashes of different rows lie evenly below 2**31, repeats add none
    different = seen.agg(F.approx_count_distinct("at", 0.02)).first()[0]
    below = int(2**31 * min(1.0, sample / max(different, 1)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = features()
        for batch in batches:
            rows = []
            for x in raw(batch):
                vote, bins, words = f.of(x)
                index, n = np.unique(words, return_counts=True)
                rows.append((vote, bins, index, n / max(len(words) // 2, 1)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float32())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", "votes", "bins", "index", "share"])

    # one row for each hash, in the hashes' order: the fit doesn't depend on partitions, and repeats of a row count once
    picked = t.where(at < below).withColumn("key", F.xxhash64("doc_id", "text")).dropDuplicates(["key"])
    picked = picked.mapInArrow(gather, "key long, votes string, bins array<int>, index array<int>, share array<float>").orderBy("key").limit(2 * sample)
    rows = [(posterior[r[1]], np.array(r[2]), np.array(r[3], int), np.array(r[4])) for r in picked.collect()]
    model = spark.sparkContext.broadcast((train(rows).astype(np.float32), posterior))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, of = model.value
        f = features()
        for batch in batches:
            out = []
            for x in raw(batch):
                vote, bins, words = f.of(x)
                z = float(weights[bins].sum(dtype=np.float64) + weights[-1] + (2 * weights[words].mean(dtype=np.float64) if len(words) else 0))
                p = 1 / (1 + np.exp(-min(max(z, -30), 30)))
                out.append((vote, of[vote], p, p >= threshold))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "votes", "posterior", "score", "kept"])

    return t.mapInArrow(score, "doc_id long, votes string, posterior double, score double, kept boolean")
