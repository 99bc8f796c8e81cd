"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Every task packs the rows of its own part of the scan and closes its own
sequences, so nothing is shuffled and a lost task is repeated by itself. The
pool of open pieces is bounded by rows and tokens, whatever the input's size.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import Memo, strings, texts
from folioscan.llm.token_counts import byte_symbols

#: Texts with other white space than single spaces and single line ends between words.
ODD = re.compile(r"[^\S \n]|  | \n|\n[ \n]|\A[ \n]|[ \n]\Z")
SAFE = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Token ids of whole texts by a byte-level vocabulary file (.json of the tokenizers library).

    A text is cut at places where the vocabulary's split pattern always
    splits; the ids of the pieces are kept in a bounded memo, and tiktoken
    encodes the missing ones from the ranks that the file's merges give.
    """

    def __init__(self, path: str, memo: int = 400_000):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("a plain byte-level byte-pair vocabulary is needed")
        byte = {c: b for b, c in enumerate(byte_symbols())}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in itertools.pairwise(made)):
            raise ValueError("ids must follow the order of the merges")
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.raw = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = {k: np.array([i], "<u4").tobytes() for k, i in special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.first, self.later = Memo(self.encode, memo // 8), Memo(self._later, memo)

    def encode(self, text: str) -> bytes:
        return np.array(self.raw(text), "<u4").tobytes()

    def _later(self, word: str) -> bytes:
        """Ids of a word after a space; marks after letters are pieces of their own."""
        core = word.rstrip(".,;:!?")
        if len(core) < len(word) and core.isalpha():
            return self.later[core] + self.first[word[len(core) :]]
        return self.encode(" " + word)

    def _ids(self, text: str) -> bytes:
        if ODD.search(text):
            parts = SAFE.split(text)
            return b"".join([self.encode(parts[0]), *(self.later[p] if len(p) < 100 else self.encode(" " + p) for p in parts[1:])])
        out: list[bytes] = []
        first, later = self.first.__getitem__, self.later.__getitem__
        for line in text.split("\n"):
            words = line.split(" ")
            out += (first("\n"), first(words[0]))
            out.extend(map(later, words[1:]))
        return b"".join(out[1:])

    def ids(self, text: str, end: int | None = None) -> np.ndarray:
        """Ids of a text, special strings inside it included, and then `end`."""
        if self.at_special and any(s in text for s in self.special):
            out = b"".join(self.special.get(p) or self._ids(p) for p in self.at_special.split(text) if p)
        else:
            out = self._ids(text) if text else b""
        return np.frombuffer(out if end is None else out + np.array([end], "<u4").tobytes(), "<u4")


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def text_encoder(path: str) -> Encoder:
    """One encoder for each worker, kept from task to task; other memos are emptied."""
    encoder = _encoder(path)
    Memo.only(encoder.first, encoder.later)
    return encoder


class Packer:
    """Fills sequences from a pool by the dot-product heuristic.

    A piece is (key, ids, loss mask or None, start). For the open sequence,
    the fitting piece with the largest dot product of its demand and the
    sequence's remaining room goes in, each limit as a share of its capacity.
    If none fits and cutting is allowed, the piece with the most tokens is cut
    to the room that is left.
    """

    def __init__(self, tokens: int, segments: int, loss: int, cut: bool, pool: int = 1024, flush_tokens: int = 1 << 21):
        self.capacity = np.array([tokens, segments, loss], np.float64)
        self.cut, self.pool, self.flush_tokens = cut, pool, flush_tokens
        self.waiting: list[tuple] = []
        self.load = 0
        self.sequence = 0

    @staticmethod
    def demand(piece: tuple) -> tuple[int, int, int]:
        return len(piece[1]), 1, len(piece[1]) if piece[2] is None else int(piece[2].sum())

    def add(self, key, ids: np.ndarray, mask: np.ndarray | None) -> Iterator[tuple]:
        """Take one document; yields (piece, sequence, offset) of what was placed."""
        self.waiting.append((key, ids, mask, 0))
        self.load += len(ids)
        if len(self.waiting) >= self.pool or self.load >= self.flush_tokens:
            yield from self.flush(False)

    def _split(self, piece: tuple, n: int) -> tuple[tuple, tuple]:
        key, ids, mask, start = piece
        return (key, ids[:n], None if mask is None else mask[:n], start), (key, ids[n:], None if mask is None else mask[n:], start + n)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Close sequences from the pool; unless it is the last call, keep what doesn't fill one."""
        tokens = int(self.capacity[0])
        items = self.waiting
        size = np.array([self.demand(p) for p in items], np.float64).reshape(-1, 3)
        alive = np.ones(len(items), bool)
        total = size[:, 0].sum()
        while alive.any() and (last or total >= tokens):
            room, offset = self.capacity.copy(), 0
            placed = []
            while True:
                fits = alive & (size <= room).all(axis=1)
                if fits.any():
                    score = np.where(fits, (size / self.capacity) @ (room / self.capacity), -1.0)
                    i = int(score.argmax())
                    piece = items[i]
                    alive[i] = False
                else:
                    n = int(min(room[0], room[2]))
                    if room[1] < 1 or n < 1 or not alive.any() or not (self.cut or not placed):
                        break
                    i = int(np.where(alive, size[:, 0], -1.0).argmax())
                    piece, items[i] = self._split(items[i], min(n, int(size[i, 0]) - 1) if size[i, 0] > 1 else 1)
                    size[i] = self.demand(items[i])
                    alive[i] = size[i, 0] > 0
                need = self.demand(piece)
                placed.append((piece, self.sequence, offset))
                offset += need[0]
                total -= need[0]
                room -= need
            yield from placed
            self.sequence += 1
        self.waiting = [items[i] for i in np.flatnonzero(alive)]
        self.load = int(total)


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def _run(name: str, encode: Callable, packer: Callable, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, pack = encode(), packer()
        base = TaskContext.get().partitionId() << 40
        columns: list[list] = [[] for _ in range(8 + with_ids)]

        def take(placed):
            for (key, ids, mask, start), sequence, offset in placed:
                row = (key[0], start, len(ids), zlib.crc32(ids.tobytes()), key[1], base | sequence, offset, len(ids) if mask is None else int(mask.sum()))
                for column, x in zip(columns, row, strict=False):
                    column.append(x)
                if with_ids:
                    columns[8].append(ids.astype(np.int64))

        def out():
            arrays = [pa.array(c, pa.int64()) for c in columns[:8]] + [pa.array(c, pa.list_(pa.int64())) for c in columns[8:]]
            for c in columns:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, [x.split(" ")[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids)

        for batch in batches:
            for key, (ids, mask) in zip(batch.column(name).to_pylist(), of(batch), strict=True):
                if len(ids):
                    take(pack.add((key, len(ids)), ids, mask))
                if len(columns[0]) >= 4096:
                    yield out()
        take(pack.flush(True))
        yield out()

    return run


def pack_documents(docs: DataFrame, path: str, tokens: int = 2048, segments: int = 256, loss_tokens: int | None = None, end: int = 1, cut: bool = True, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents placed in sequences of at most `tokens` ids.

    One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, loss_tokens and, if asked for, ids. All ids of a text
    bear loss. A null or empty text is the end id alone; a null id stays null;
    each of several equal rows is packed; an empty table gives an empty one.
    With cut=False only a document longer than a sequence is cut.
    """

    def encode():
        encoder = text_encoder(path)
        return lambda batch: ((encoder.ids(t, end), None) for t in strings(batch))

    limit = loss_tokens or tokens
    run = _run("doc_id", encode, lambda: Packer(tokens, segments, limit, cut), with_ids)
    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))


def pack_conversations(turns: DataFrame, path: str, tokens: int = 2048, segments: int = 64, loss_tokens: int = 1536, end: int = 1, with_ids: bool = False) -> DataFrame:
    """Conversations placed whole in sequences; only the assistant's turns bear loss.

    turns: conv_id, turn, role, text. The rows are those of pack_documents,
    with conv_id as doc_id. A conversation above a limit of its own is cut,
    all others stay in one piece. Null texts and roles count as empty; rows
    with the same turn go by role and text; conversations without an id are
    one conversation each row.
    """
    name = F.coalesce(F.col("conv_id").cast("string"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
    kept = turns.select(F.col("conv_id").cast("long").alias("doc_id"), name.alias("conv"), F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"))
    whole = kept.groupBy("conv").agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list("said")).alias("said")).drop("conv")

    def encode():
        encoder = text_encoder(path)

        def one(said):
            ids = [encoder.ids(x["text"], end) for x in said]
            mask = [np.full(len(i), x["role"] == "assistant") for i, x in zip(ids, said, strict=True)]
            return np.concatenate(ids), np.concatenate(mask)

        return lambda batch: map(one, batch.column("said").to_pylist())

    run = _run("doc_id", encode, lambda: Packer(tokens, segments, loss_tokens, False), with_ids)
    return whole.mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))
