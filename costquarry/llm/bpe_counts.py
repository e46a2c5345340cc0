"""Token counts: byte-pair merging with a heap of adjacent pairs over a doubly linked list.

A piece starts as one symbol per byte; the pair of lowest rank (leftmost first) is merged until no
adjacent pair has a rank. Its count is the number of initial symbols minus the number of merges, so
no token ids are ever made. Counts of pieces are remembered in a table of bounded size per worker.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from costquarry.llm import runtime

# The split pattern that belongs to the byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Python's \s has the four separators U+001C to U+001F, which are no white space to the tokenizer.
SPACE, NOT_SPACE = r"\p{White_Space}", r"\P{White_Space}"

#: A space with white space before it and white space or the end after it.
INSIDE_RUN = re.compile(r"\s (?:\s|\Z)").search

REMEMBERED = 400_000
LONGEST_REMEMBERED = 48


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counts(dict):
    """Key -> count of tokens, made by `make` when first asked for; forgets all at a bounded size."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> int:
        n = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = n
        return n


class Merges:
    """Ranked merges over numbered symbols; the numbers serve lookups only and are never returned."""

    def __init__(self, pairs: list[tuple[bytes, bytes]]):
        number = {bytes([b]): b for b in range(256)}
        self.ranked: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            joined = number.setdefault(a + b, len(number))
            self.ranked.setdefault(number[a] << 24 | number[b], (rank, joined))

    def count(self, piece: bytes) -> int:
        """Initial symbols minus merges of one piece (empty: 0)."""
        n = len(piece)
        symbol, ranked = list(piece), self.ranked.get
        #: Of each symbol, the pair it starts: rank and joined symbol. A heap entry is rank * n + place.
        pair = [ranked(a << 24 | b) for a, b in zip(symbol, symbol[1:])]
        heap = [p[0] * n + i for i, p in enumerate(pair) if p]
        if not heap:
            return n
        pair.append(None)
        heapq.heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            p = pair[i]
            if p is None or p[0] != rank:
                continue  # one of its two symbols has been merged since
            merges += 1
            j = after[i]
            symbol[i] = joined = p[1]
            pair[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                p = pair[i] = ranked(joined << 24 | symbol[k])
                if p:
                    heapq.heappush(heap, p[0] * n + i)
            else:
                pair[i] = None
            h = before[i]
            if h >= 0:
                p = pair[h] = ranked(symbol[h] << 24 | joined)
                if p:
                    heapq.heappush(heap, p[0] * n + h)
        return n - merges


class TokenCounter:
    """Counts tokens as the tokenizers library does for a byte-level BPE file, special strings included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        merges = Merges([tuple(map(raw, m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]])
        self.pieces = Counts(lambda piece: merges.count(piece.encode()))
        self.findall = regex.compile(SPLIT.replace(r"[^\s", rf"[^{SPACE}").replace(r"\S", NOT_SPACE).replace(r"\s+", SPACE + "+")).findall
        self.spaced = Counts(lambda rest: self.split_count(" " + rest))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def split_count(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, self.findall(text)))

    def ordinary(self, text: str) -> int:
        """No piece spans a space that starts or ends a run of white space, so the parts between such spaces count alone."""
        if INSIDE_RUN(text):
            return self.split_count(text)
        first, *rest = text.split(" ")
        return (self.split_count(first) if first else 0) + sum(map(self.spaced.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(map(self.ordinary, parts))


_counters: dict[str, TokenCounter] = {}


def counter(tokenizer: str, path: str | None = None) -> TokenCounter:
    """One counter per worker process."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(tokenizer)
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def token_counts(df: DataFrame, text: str = "text", id_col: str = "doc_id", tokenizer: str = "byte_bpe_50k.json", path: str | None = None,
    limit: int = 512) -> DataFrame:
    """One row per input row: the id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts: 0 bytes, 0 tokens. A text is counted whole, however long. Null ids and repeated
    rows are kept as they are, and an empty table gives no rows; other columns are not read, so clashing
    names do no harm. path: the vocabulary file on the executors,
    by default where the installed tokenizer files are.
    """
    runtime.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer, path).count
        for b in runtime.slices(batches, "t"):
            n = [count(t) for t in b.column("t").to_pylist()]
            size = pa.compute.fill_null(pa.compute.binary_length(b.column("t")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("i"), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                ["i", "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(df[id_col].alias("i"), df[text].alias("t"))
    return src.mapInArrow(run, f"i {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("i", id_col)
