"""Alignment of the tokens of two tokenizers, with how usual each link of two ids is in the corpus.

Both vocabularies cut a text before a single space or line break between two
other characters, so units that begin there are aligned once and kept in a
bounded memo. Every task gathers documents into chunks of bounded size and
writes their postings: for each A id, the linked B ids, and for each of those
the documents with the number of links. The postings are shuffled by buckets of A
ids and sorted there behind each id's counts, which say in how many documents
each pair occurs; one pass over that stream finds what the documents get from
the bucket. These contributions, packed by chunk, are summed by document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import Memo, materialise, texts
from folioscan.llm.packing import ODD, Encoder
from folioscan.llm.token_counts import byte_symbols

#: Where both vocabularies' tokens always end: before a space or line break between two other characters.
BEFORE = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Links in a chunk of documents at most (but for a single longer document), and documents.
CHUNK_LINKS, CHUNK_DOCS = 3_000_000, 1 << 16
#: Characters of the texts whose unknown units are aligned together.
TOGETHER = 1 << 19
#: Buckets of A ids: of so many tasks, and not more, a document gets contributions, but for ids that fill more than a bucket. Postings that a part of a bucket has on average at most.
BUCKETS, PIECE = 64, 1 << 20
#: Documents whose contributions a task holds before it emits them.
HELD = 1 << 20


def byte_tokens(path: str) -> dict[int, bytes]:
    """The bytes of each id of a byte-level vocabulary file."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = {c: b for b, c in enumerate(byte_symbols())}
    special = {x["content"] for x in spec["added_tokens"]}
    return {i: bytes(byte[c] for c in token) for token, i in spec["model"]["vocab"].items() if token not in special}


def piece_tokens(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model; a piece <0xHH> is that byte."""
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class Aligner:
    """Aligns the tokens of texts, unit by unit; a unit is a word after a space, or a line break and the word after it."""

    def __init__(self, path_a: str, path_b: str, memo: int = 250_000):
        import sentencepiece

        self.encode_a = Encoder(path_a, 8).raw
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.encode_b = self.model.encode
        self.bytes_a, self.bytes_b = byte_tokens(path_a), piece_tokens(self.model)
        most = max(self.bytes_a) + 1
        if most > 1 << 16 or len(self.bytes_b) > 1 << 16:
            raise ValueError("ids must fit into 16 bits")
        if any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(len(self.bytes_b))):
            raise ValueError("a piece may begin with spaces and hold none elsewhere")
        if len(self.encode_b("\n")) != 2 or any(len(x) > 1 and b"\n" in x for x in self.bytes_b):
            raise ValueError("a line break must be a token of its own")
        self.width_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(most)])
        self.width_b = np.array([len(x) for x in self.bytes_b])
        # how an id is written where its group goes on, and where its side of the group ends
        self.written = [f"{i}{mark}" for n, end in ((most, "|"), (len(self.bytes_b), ";")) for i in range(n) for mark in (",", end)]
        self.written_width, self.at_b = np.array([len(x) for x in self.written]), 2 * most
        self.memo, self.units = memo, Memo(self._unit, memo)

    def _unit(self, unit: str | tuple[str]) -> tuple[int, int, int, bytes, str] | None:
        """A single unit: n_a, n_b, n_groups, the links as 32-bit codes and the groups' text; None if bytes differ.

        A tuple holds the first unit of a text that begins with a line break.
        """
        breaks = unit[0:1] == "\n"
        unit = unit if isinstance(unit, str) else unit[0]
        data = unit if breaks else " " + unit
        a, b = self.encode_a(data), self.encode_b(unit)[breaks:]
        if b"".join(self.bytes_b[i] for i in b) != data.encode():
            return None
        return self._aligned(np.array(a), np.array(b), np.array([len(data.encode())]))[0]

    def _aligned(self, a: np.ndarray, b: np.ndarray, units: np.ndarray) -> list[tuple[int, int, int, bytes, str]] | None:
        """The units' results from the ids of all of them in a row and the places where they end; None if tokens cross these."""
        ends_a, ends_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last = np.searchsorted(common, units)
        if ends_a[-1] != units[-1] or ends_b[-1] != units[-1] or (common[np.minimum(last, len(common) - 1)] != units).any():
            return None
        # each stretch between two neighbouring ends, of whichever side, is the overlap of just one pair of tokens
        ends = np.union1d(ends_a, ends_b)
        codes = (a[np.searchsorted(ends_a, ends)] << 16 | b[np.searchsorted(ends_b, ends)]).astype("<u4").tobytes()
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        signs = np.concatenate([2 * a + (common[group_a] == ends_a), self.at_b + 2 * b + (common[group_b] == ends_b)])[order]
        text = "".join(map(self.written.__getitem__, signs.tolist()))
        upto = np.cumsum(self.written_width[signs])
        n_a, n_b, n_links, n_groups = (np.concatenate([[0], np.searchsorted(x, units) + 1]) for x in (ends_a, ends_b, ends, common))
        place = np.concatenate([[0], upto[n_a[1:] + n_b[1:] - 1]]).tolist()
        link = (4 * n_links).tolist()
        sizes = zip(np.diff(n_a).tolist(), np.diff(n_b).tolist(), np.diff(n_groups).tolist(), strict=True)
        return [(*size, codes[link[k] : link[k + 1]], text[place[k] : place[k + 1] - 1]) for k, size in enumerate(sizes)]

    def learn(self, units: list[str]) -> None:
        """Align units that aren't known yet, all in a row where that gives each the same as by itself."""
        plain = [u for u in units if isinstance(u, str) and u.strip("\n") and not u[u[0] == "\n"].isspace() and not u[-1].isspace()]
        plain.sort(key=lambda u: u[0] == "\n")
        data = "".join(u if u[0] == "\n" else " " + u for u in plain)
        found = None
        if data:
            breaks = data[0] == "\n"
            a, b = self.encode_a(data), self.encode_b(data if breaks else data[1:])[breaks:]
            if b"".join(map(self.bytes_b.__getitem__, b)) == data.encode():
                widths = [len(u.encode()) + (u[0] != "\n") for u in plain]
                found = self._aligned(np.array(a), np.array(b), np.cumsum(widths))
        if found:
            self.units.update(zip(plain, found, strict=True))
            known = set(plain)
            units = [u for u in units if u not in known]
        for u in units:
            self.units[u] = self._unit(u)

    @staticmethod
    def split(text: str) -> list[str | tuple[str]]:
        """The units of a text that isn't empty; those after a line break begin with it."""
        if ODD.search(text):
            first, *rest = BEFORE.split(text)
            return [(first,) if first[0] == "\n" else first, *(x[1:] if x[0] == " " else x for x in rest)]
        first, *rest = text.split("\n")
        units = first.split(" ")
        for line in rest:
            word, *words = line.split(" ")
            units.append("\n" + word)
            units += words
        return units

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, bytes, str] | None]:
        """The same of whole texts; None for no tokens (null or empty text, bytes that differ)."""
        if len(self.units) > self.memo:
            self.units.clear()
        split = [self.split(t) if t else [] for t in texts]
        known = self.units
        missing = {u for own in split for u in own if u not in known}
        self.learn(list(missing))
        for own in split:
            parts = [known[u] for u in own]
            if not parts or None in parts:  # where a unit's bytes differ the whole text's do
                yield None
            else:
                n_a, n_b, n_groups, codes, groups = zip(*parts, strict=True)
                yield sum(n_a), sum(n_b), sum(n_groups), b"".join(codes), ";".join(groups)
        for u in missing:  # long units aren't kept
            if isinstance(u, tuple) or len(u) > Memo.LONGEST:
                del known[u]


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each worker, kept from task to task; other memos are emptied."""
    found = _aligner(path_a, path_b)
    Memo.only(found.units)
    return found


def _cut(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """values cut into binaries of so many entries each."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _needed(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """values cut as above; binaries of zeros only are empty."""
    keep = np.maximum.reduceat(values, starts) > 0
    return _cut(values[np.repeat(keep, lengths)], lengths * keep)


DOCS = "doc_id long, doc int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTINGS = "a int, b binary, n binary, low binary, high binary, links binary, more binary"
#: A row is a document's (a is null) or holds one A id's postings in a chunk: B ids (16 bits) and for each the number of documents (32 bits), then for each document the distance from the one before (low and high byte) and links - 1 (low byte; the rest in 32 bits).
SCHEMA = f"chunk long, size int, {DOCS}, {POSTINGS}"


def postings(codes: np.ndarray, docs: np.ndarray) -> dict[str, pa.Array]:
    """The postings' columns of a chunk from the links' codes and the numbers of their documents."""
    keys = codes.astype(np.uint64) << np.uint64(16) | docs.astype(np.uint64)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    links = np.diff(np.append(first, len(keys))) - 1
    keys = keys[first]
    pair, doc = keys >> np.uint64(16), (keys & np.uint64(0xFFFF)).astype(np.int64)
    new_pair = np.concatenate([[True], pair[1:] != pair[:-1]])
    at_pair = np.flatnonzero(new_pair)
    step = np.where(new_pair, doc, np.concatenate([[0], np.diff(doc)]))
    pairs = pair[at_pair]
    a = (pairs >> np.uint64(16)).astype(np.int32)
    at_a = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    of_pairs = np.diff(np.append(at_a, len(a)))
    starts = at_pair[at_a]
    lengths = np.diff(np.append(starts, len(keys)))
    return {
        "a": pa.array(a[at_a]),
        "b": _cut((pairs & np.uint64(0xFFFF)).astype("<u2"), of_pairs),
        "n": _cut(np.diff(np.append(at_pair, len(keys))).astype("<u4"), of_pairs),
        "low": _cut((step & 255).astype(np.uint8), lengths),
        "high": _needed((step >> 8).astype(np.uint8), starts, lengths),
        "links": _cut((links & 255).astype(np.uint8), lengths),
        "more": _needed((links >> 8).astype("<u4"), starts, lengths),
    }


def entries(n: bytes, low: bytes, high: bytes, links: bytes, more: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each entry of a posting row the place of its B id, its document and its links."""
    of = np.frombuffer(n, "<u4").astype(np.int64)
    step = np.frombuffer(low, np.uint8).astype(np.int64)
    if high:
        step += np.frombuffer(high, np.uint8).astype(np.int64) << 8
    times = np.frombuffer(links, np.uint8).astype(np.int64) + 1
    if more:
        times += np.frombuffer(more, "<u4").astype(np.int64) << 8
    run = np.cumsum(step)
    start = np.cumsum(of) - of
    doc = run - np.repeat(run[start] - step[start], of)
    return np.repeat(np.arange(len(of)), of), doc, times


def _emit(kind: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in kind], schema=kind)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def together(batches: Iterator[pa.RecordBatch], of: Aligner) -> Iterator[tuple]:
    """Ids and results of the rows of batches; texts are aligned together up to TOGETHER characters, or alone."""
    ids, held, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            ids.append(i.as_py())
            held.append(t.as_py())
            size += len(held[-1] or "")
            if size >= TOGETHER or len(held) >= 4096:
                yield from zip(ids, of.align(held), strict=True)
                ids, held, size = [], [], 0
    yield from zip(ids, of.align(held), strict=True)


def aligned(docs: DataFrame, path_a: str, path_b: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Rows of SCHEMA: every document's own numbers, and the postings of its chunk."""
    kind, names = _arrow(SCHEMA), [x.split(" ")[0] for x in DOCS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = aligner(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        rows, codes, held = [], [], 0

        def flush():
            n = len(rows)
            size = {"chunk": pa.array(np.full(n, chunk)), "size": pa.array(np.full(n, n, np.int32))}
            yield _emit(kind, n, size | {k: pa.array(v, kind.field(k).type) for k, v in zip(names, zip(*rows, strict=True), strict=True)})
            if held:
                at = np.repeat(np.arange(n), [len(c) // 4 for c in codes])
                made = postings(np.frombuffer(b"".join(codes), "<u4"), at)
                k = len(made["a"])
                made |= {"chunk": pa.array(np.full(k, chunk)), "size": pa.array(np.full(k, n, np.int32))}
                for start in range(0, k, 4096):  # one row may hold many postings
                    yield _emit(kind, min(4096, k - start), {c: v.slice(start, 4096) for c, v in made.items()})

        for i, got in together(batches, of):
            n_a, n_b, n_groups, own, groups = got or (0, 0, 0, b"", "")
            rows.append((i, len(rows), n_a, n_b, n_groups, len(own) // 4, hashlib.sha256(groups.encode()).hexdigest() if got else ""))
            codes.append(own)
            held += len(own) // 4
            if held >= chunk_links or len(rows) >= CHUNK_DOCS:
                yield from flush()
                chunk, rows, codes, held = chunk + 1, [], [], 0
        if rows:
            yield from flush()

    return texts(docs).mapInArrow(run, SCHEMA)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of these postings each pair occurs: a, b, n."""
    keys, numbers, held = [], [], 0

    def flush():
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place, np.concatenate(numbers))
        return found, total

    for batch in batches:
        for a, b, n in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("n").to_pylist(), strict=True):
            keys.append(np.frombuffer(b, "<u2").astype(np.int64) | a << 16)
            numbers.append(np.frombuffer(n, "<u4").astype(np.int64))
            held += len(numbers[-1])
        if held > 1 << 20:
            found, total = flush()
            keys, numbers = [found], [total]
            held = 0
            if len(found) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(found >> 16, pa.int32()), pa.array(found & 0xFFFF, pa.int32()), pa.array(total)], ["a", "b", "n"])
                keys, numbers = [], []
    if keys:
        found, total = flush()
        yield pa.RecordBatch.from_arrays([pa.array(found >> 16, pa.int32()), pa.array(found & 0xFFFF, pa.int32()), pa.array(total)], ["a", "b", "n"])


def contributions(held_docs: int = HELD):
    """A function of sorted batches that gives what the documents get from a task's A ids: chunk, docs, sums, best.

    The rows are sorted by bucket, part and A id, an id's counts first. A row
    holds a chunk's documents (16 bits), their count_sum (64 bits) and n_best
    (32 bits); it is emitted at the end, or once sums are held for more than
    held_docs documents.
    """

    def emitted(held):
        for chunk, of in held.items():
            at = np.flatnonzero(of[0])
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), *(pa.array([x.tobytes()], pa.binary()) for x in (at.astype("<u2"), of[0][at].astype("<i8"), of[1][at].astype("<u4")))], ["chunk", "docs", "sums", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        ids = totals = best = None
        for batch in batches:
            of = {name: batch.column(name) for name in batch.schema.names}
            for r in range(batch.num_rows):
                if not of["chunk"][r].is_valid:
                    ids, totals = (np.array(of[c][r].as_py(), np.int64) for c in ("ids", "totals"))
                    best = totals == totals.max()
                    continue
                chunk, n = of["chunk"][r].as_py(), of["size"][r].as_py()
                b = np.searchsorted(ids, np.frombuffer(of["b"][r].as_py(), "<u2"))
                place, doc, links = entries(*(of[c][r].as_py() for c in ("n", "low", "high", "links", "more")))
                got = held.get(chunk)
                if got is None:
                    got = held[chunk] = np.zeros((2, n), np.int64)
                    size += n
                np.add.at(got[0], doc, links * totals[b][place])
                np.add.at(got[1], doc, links * best[b][place])
                if size > held_docs:
                    yield from emitted(held)
                    held, size = {}, 0
        yield from emitted(held)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, doc, count_sum, n_best: the contributions of rows that are sorted by chunk, added up by document."""
    chunk = total = None

    def emit():
        at = np.flatnonzero(total[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), chunk)), pa.array(at, pa.int32()), pa.array(total[0][at]), pa.array(total[1][at])], ["chunk", "doc", "count_sum", "n_best"])

    for batch in batches:
        for number, docs, sums, best in zip(*(batch.column(c).to_pylist() for c in ("chunk", "docs", "sums", "best")), strict=True):
            if number != chunk:
                if total is not None:
                    yield emit()
                chunk, total = number, np.zeros((2, CHUNK_DOCS), np.int64)
            at = np.frombuffer(docs, "<u2")
            total[0][at] += np.frombuffer(sums, "<i8")
            total[1][at] += np.frombuffer(best, "<u4")
    if total is not None:
        yield emit()


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE, chunk_links: int = CHUNK_LINKS, held_docs: int = HELD) -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A: the byte-level vocabulary file path_a over a space and the text; B: the
    sentencepiece model path_b over the text. Groups end where tokens of both
    end; links are the overlapping pairs of tokens; an id pair's count is the
    number of rows that hold it linked; n_best counts the links whose count is
    their A id's highest (ties included), count_sum adds the links' counts.

    Null and empty texts, and those that a vocabulary doesn't give back byte by
    byte (such as texts with U+2581), have no tokens: zeros and ''. Null ids
    stay null; repeated rows give repeated rows and count as documents of their
    own; an empty table gives an empty one. Texts of any length are aligned
    whole. The postings of a bucket of A ids are dealt by chunk over parts of some
    `piece`; what is broadcast has a row for each A id, so it is bounded by the
    vocabulary (a megabyte).
    """
    table = materialise(aligned(texts(docs, id_col, text_col), path_a, path_b, chunk_links), "aligned")
    mine = table.where("a IS NOT NULL")
    pairs = mine.select("a", "b", "n").mapInArrow(_pair_counts, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # at most as many entries in a list as B has ids
    lists = pairs.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("b", "n"))).alias("of"), F.sum("n").alias("total"))
    lists = materialise(lists.select("a", "total", F.col("of.b").alias("ids"), F.col("of.n").alias("totals")), "pair-counts")
    every = lists.agg(F.sum("total").alias("n")).first()["n"] or 0
    # a bucket's postings are dealt over as many parts as pieces of them need, those of an id that fills more than a bucket over more
    parts = max(1, -(-every // (BUCKETS * piece)))
    counts = lists.withColumn("parts", (F.lit(parts) * F.ceil(F.col("total") * BUCKETS / max(every, 1))).cast("int"))
    dealt = counts.select("a", "parts")
    bucket = F.pmod(F.xxhash64("a"), F.lit(BUCKETS)).cast("int").alias("bucket")
    empty = [F.lit(None).cast("binary").alias(c) for c in ("b", "n", "low", "high", "links", "more")]
    heads = counts.select(bucket, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "a", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("int").alias("size"), *empty, "ids", "totals")
    part = F.pmod(F.xxhash64("chunk"), F.col("parts")).cast("int")
    rest = mine.join(F.broadcast(dealt), "a").select(bucket, part.alias("part"), "a", "chunk", "size", "b", "n", "low", "high", "links", "more", F.lit(None).cast("array<int>").alias("ids"), F.lit(None).cast("array<long>").alias("totals"))
    stream = heads.unionByName(rest).repartition("bucket", "part").sortWithinPartitions("bucket", "part", "a", F.col("chunk").asc_nulls_first())
    each = stream.mapInArrow(contributions(held_docs), "chunk long, docs binary, sums binary, best binary")
    summed = each.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed, "chunk long, doc int, count_sum long, n_best long")
    own = table.where("a IS NULL").select("chunk", *[x.split(" ")[0] for x in DOCS.split(", ")])
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return own.join(summed, ["chunk", "doc"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
