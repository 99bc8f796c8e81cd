"""Token counts by heap-and-linked-list byte-pair merging.

A text's count is the number of its initial symbols minus the merges that
apply; no token identifiers are made. The vocabulary file gives the ranks of
the pairs, the split pattern, the normal form and the special strings.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import Memo, strings, texts


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take code points
    from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts the symbols that are left of a piece after all merges.

    Symbols are numbers; a pair of them is one integer, left * 2**32 + right,
    that leads to its rank and to the number of the merged symbol.
    """

    def __init__(self, merges: list, end_of_word: str = ""):
        alphabet = byte_symbols()
        number: dict[str, int] = {}
        of = lambda symbol: number.setdefault(symbol, len(number))
        self.inner = [of(x) for x in alphabet]
        self.last = [of(x + end_of_word) for x in alphabet]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(of(left) << 32 | of(right), (rank, of(left + right)))

    def count(self, piece: str) -> int:
        """Initial symbols minus merges of one piece between split points.

        The heap holds rank * 2**32 + left index of adjacent pairs; an entry
        counts only if the pair at that index still has that rank. Equal ranks
        go from left to right.
        """
        data = piece.encode()
        n = len(data)
        if n < 2:
            return n
        inner, get = self.inner, self.pairs.get
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        heap = [p[0] << 32 | i for i in range(n - 1) if (p := get(symbols[i] << 32 | symbols[i + 1]))]
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue
            p = get(symbols[i] << 32 | symbols[j])
            if not p or p[0] != entry >> 32:
                continue
            symbols[i], symbols[j] = p[1], -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if p := get(symbols[i] << 32 | symbols[k]):
                    push(heap, p[0] << 32 | i)
            h = before[i]
            if h >= 0 and (p := get(symbols[h] << 32 | symbols[i])):
                push(heap, p[0] << 32 | h)
        return left


class TextCounter:
    """Counts the tokens of whole texts as the vocabulary file at `path` defines them."""

    def __init__(self, path: str, memo: int = 300_000):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout"):
            raise ValueError("only deterministic byte-pair vocabularies are counted")
        self.normal = Tokenizer.from_file(path).normalizer
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or spec["pre_tokenizer"]["pretokenizers"][1]["type"] != "ByteLevel":
            raise ValueError("the vocabulary must split by a pattern and then go by bytes")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = [re.escape(x["content"]) for x in spec["added_tokens"]]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.pieces = Memo(MergeCounter(model["merges"], model.get("end_of_word_suffix") or "").count, memo)
        self.words = Memo(self._word, memo)

    def _word(self, word: str) -> int:
        """Tokens of a word without white space.

        Below U+0250 every text is in normal form and lower case is taken
        character by character; letters with trailing marks are two pieces.
        """
        if word and max(word) < "\u0250":
            word = word.lower()
            core = word.rstrip(".,;:!?|%&*#$")
            if core.isalpha():
                return self.pieces[core] + (self.pieces[word[len(core) :]] if len(core) < len(word) else 0)
        else:
            word = self.normal.normalize_str(word)
        return sum(map(self.pieces.__getitem__, self.pattern.findall(word)))

    def count(self, text: str) -> int:
        """Tokens of a text; a special string inside it is one token.

        Words between white space are counted apart, as the pattern drops
        white space and no normal form reaches across it. Python also splits
        at four control characters that the pattern keeps; texts that have
        them are split at plain spaces only.
        """
        parts = self.special.split(text) if self.special and "<" in text else [text]
        by = " " if CONTROLS.search(text) else None
        return len(parts) - 1 + sum(sum(map(self.words.__getitem__, part.split(by))) for part in parts)


@lru_cache(maxsize=1)
def _counter(path: str) -> TextCounter:
    return TextCounter(path)


def text_counter(path: str) -> TextCounter:
    """One counter for each worker, kept from task to task; other memos are emptied."""
    counter = _counter(path)
    Memo.only(counter.pieces, counter.words)
    return counter


CONTROLS = re.compile("[\x1c-\x1f]")
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_tokens, over_limit.

    path: the vocabulary file, at the same place on every machine. A null text
    counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows
    give repeated rows; an empty table gives an empty one. No shuffle: each
    task streams its part of the scan and keeps a bounded memo of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = text_counter(path)
        for batch in batches:
            n = [counter.count(t) for t in strings(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    t = texts(docs, id_col, text_col)
    return t.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).mapInArrow(run, SCHEMA)
