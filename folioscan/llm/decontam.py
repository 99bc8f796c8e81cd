"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive tokens; the hash of a window uses the
positions marked 1 and ignores the others, so a substituted token at an
ignored position still hits. Hits between a benchmark item and a text lie on
a diagonal; along it, the longest window of which at least four in five tokens
agree is the verified overlap. Any window of six tokens or more that agrees so
far has four equal tokens in a row, or two, any one and two more: if no run is
longer than three, there are at least two neighbouring runs of two or three.

The benchmark is the small side: it is taken to the tasks in blocks of a
bounded number of bytes, and all documents are scanned against each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import Memo, hashed, mixed, multipliers, raw, texts, word_hashes

#: Fixed masks that serve windows of LEAST_SEEDED tokens or more.
MASKS = ("1111", "11011")
LEAST_SEEDED = 6
#: Masks for items of five tokens, of which one may differ; shorter ones must be equal.
FIVE = ("1111", "01111", "10111", "11011", "11101")
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
#: Bytes of benchmark text in one block.
BLOCK_BYTES = 32 << 20
#: Tokens that are hashed at once in a task.
CHUNK = 1 << 19
MISMATCH = -4


def tokens(data: bytes) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    low = data if data.isascii() else data.decode("utf-8", "replace").lower().encode()
    return low.lower().translate(None, PUNCTUATION).split()


def seeds(hashes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hashes of all windows under a mask."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    m = multipliers(len(mask), salt)
    out = np.zeros(n, np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out += hashes[i : i + n] * m[i]
    return mixed(out)


@dataclass
class Index:
    """The seeds of a block of items, sorted, by mask; items of fewer than LEAST_SEEDED tokens have masks of their own."""

    ids: np.ndarray
    items: list[np.ndarray]
    tables: list[tuple[str, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]]) -> Index:
        memo = word_hashes()
        items = [hashed(tokens((t or "").encode()), memo) for _, t in rows]
        served = [(mask, range(LEAST_SEEDED, 1 << 62)) for mask in MASKS]
        served += [(mask, range(5, 6)) for mask in FIVE] + [("1" * n, range(n, n + 1)) for n in range(1, 5)]
        tables = []
        for salt, (mask, sizes) in enumerate(served, 1):
            keys, item, at = [], [], []
            for k, x in enumerate(items):
                if len(x) in sizes:
                    found = seeds(x, mask, salt)
                    keys.append(found)
                    item.append(np.full(len(found), k, np.int32))
                    at.append(np.arange(len(found), dtype=np.int32))
            if keys:
                key = np.concatenate(keys)
                order = np.argsort(key, kind="stable")
                seen = np.zeros(1 << 20, bool)
                seen[key >> np.uint64(44)] = True
                tables.append((mask, salt, key[order], np.concatenate(item)[order], np.concatenate(at)[order], seen))
        return cls(np.array([i for i, _ in rows], dtype=object), items, tables)

    def hits(self, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Distinct (doc, item, diagonal) of all seed hits; doc: the document of each token."""
        found = []
        for mask, salt, key, item, at, seen in self.tables:
            h = seeds(hashes, mask, salt)
            pos = np.flatnonzero(seen[h >> np.uint64(44)])
            pos = pos[doc[pos] == doc[pos + len(mask) - 1]]
            low = np.searchsorted(key, h[pos], "left")
            many = np.searchsorted(key, h[pos], "right") - low
            pos, low, many = pos[many > 0], low[many > 0], many[many > 0]
            # parts of bounded size, as a repetitive text may hit an item in many places
            ends = np.cumsum(many)
            for part in np.split(np.arange(len(pos)), np.flatnonzero(np.diff(ends // CHUNK)) + 1):
                if len(part):
                    each = np.repeat(part, many[part])
                    slot = np.arange(len(each)) - np.repeat(np.cumsum(many[part]) - many[part], many[part]) + low[each]
                    found.append(np.unique(np.stack([doc[pos[each]], item[slot], pos[each] - at[slot]], axis=1), axis=0))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def plausible(self, hits: np.ndarray, hashes: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
        """The hits on whose diagonals as many tokens are equal as the shortest window must have."""
        size = np.array([len(x) for x in self.items])
        first, flat = np.cumsum(size) - size, np.concatenate(self.items)
        kept, ends = [], np.cumsum(size[hits[:, 1]])
        for part in np.split(hits, np.flatnonzero(np.diff(ends // CHUNK)) + 1):
            n = size[part[:, 1]]
            of = np.repeat(np.arange(len(part)), n)
            j = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            at = part[of, 2] + j
            ok = (at >= 0) & (at < len(hashes))
            at = np.where(ok, at, 0)
            same = ok & (doc[at] == part[of, 0]) & (flat[first[part[of, 1]] + j] == hashes[at])
            shortest = np.minimum(n, least)
            kept.append(part[5 * np.bincount(of, same, len(part)) >= 4 * shortest])
        return np.concatenate(kept)

    def overlap(self, text: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int]:
        """(start, end, matches) of the longest window of the item along a diagonal of the text with four in five tokens equal, the first of equal ones."""
        x = self.items[item]
        low, high = max(0, -diagonal), min(len(x), len(text) - diagonal)
        gain = np.where(x[low:high] == text[low + diagonal : high + diagonal], 1, MISMATCH)
        total = np.concatenate([[0], np.cumsum(gain)])
        # for each end, the first start from which the sum isn't negative
        starts = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
        end = int((np.arange(len(total)) - starts).argmax())
        start = int(starts[end])
        return low + diagonal + start, low + diagonal + end, int((gain[start:end] == 1).sum())

    def search(self, batch: list[np.ndarray], least: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(document of the batch, item, start, end, matches): the best verified overlap of each pair."""
        if not batch or not sum(map(len, batch)):
            return
        doc = np.repeat(np.arange(len(batch)), [len(x) for x in batch])
        first = np.cumsum([0, *(len(x) for x in batch)])
        best: dict[tuple[int, int], tuple] = {}
        hashes = np.concatenate(batch)
        hits = self.hits(hashes, doc)
        if not len(hits):
            return
        for d, item, diagonal in self.plausible(hits, hashes, doc, least).tolist():
            start, end, same = self.overlap(batch[d], item, diagonal - int(first[d]))
            if same and end - start >= min(least, len(self.items[item])):
                rank = (same, -start)
                if (d, item) not in best or rank > best[d, item][0]:
                    best[d, item] = (rank, start, end, same)
        for (d, item), (_, start, end, same) in best.items():
            yield d, item, start, end, same


def chunks(stream: Iterator, memo: Memo) -> Iterator[list[np.ndarray]]:
    """Token hashes of texts in lists of a bounded number of tokens; a longer text is alone."""
    held, n = [], 0
    for data in stream:
        x = hashed(tokens(data), memo)
        if held and n + len(x) > CHUNK:
            yield held
            held, n = [], 0
        held.append(x)
        n += len(x)
    if held:
        yield held


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Index]:
    """The benchmark's distinct rows as indexes over at most about block_bytes of text each."""
    rows = texts(benchmark, id_col, text_col).where("doc_id IS NOT NULL AND text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == k)
        yield Index.of([(r[0], r[1]) for r in part.orderBy("doc_id", "text").toLocalIterator()])


SCHEMA = "doc_id long, item_id long, start long, end long, n_matches long, item_tokens long"


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 13, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The best overlap of each pair of a document row and a benchmark item.

    doc_id, item_id, start and end in tokens of the document (end exclusive),
    n_matches, item_tokens. An overlap has at least `least` tokens, or the
    whole of a shorter item, at least four in five of them equal; every such
    pair is found if `least` is at least LEAST_SEEDED. It is the longest
    window on its diagonal, and of several diagonals the one with the most
    equal tokens. Null and
    empty texts on either side and items without an id overlap with nothing; a
    null doc_id stays null; repeated rows of docs give repeated rows; equal
    rows of the benchmark count once; ties go to the earliest place. No
    shuffle: the documents are streamed once for each block of the benchmark.
    """
    t = texts(docs, id_col, text_col)
    spark = docs.sparkSession
    out = None
    for index in blocks(benchmark, item_col, item_text, block_bytes):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, memo = sent.value, word_hashes()
            for batch in batches:
                ids, at, rows = batch.column("doc_id").to_pylist(), 0, []
                for part in chunks(raw(batch), memo):
                    rows += [(ids[at + d], own.ids[i], a, b, n, len(own.items[i])) for d, i, a, b, n in own.search(part, least)]
                    at += len(part)
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "n_matches", "item_tokens"])

        found = t.mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: int = 13, block_bytes: int = BLOCK_BYTES, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, all columns unchanged, without those that overlap a benchmark item."""
    spark = docs.sparkSession
    for index in blocks(benchmark, item_col, item_text, block_bytes):
        sent = spark.sparkContext.broadcast(index)

        docs = docs.where(_cleaner(sent, least)(F.col(f"`{text_col}`").cast("string")))
    return docs


def _cleaner(sent, least: int):
    """A pandas UDF: whether a text overlaps with no item of the index."""

    def clean(text: pd.Series) -> pd.Series:
        own, memo, at = sent.value, word_hashes(), 0
        ok = np.ones(len(text), bool)
        for part in chunks(((t or "").encode() for t in text), memo):
            for d, *_ in own.search(part, least):
                ok[at + d] = False
            at += len(part)
        return pd.Series(ok)

    return F.pandas_udf(clean, "boolean")
