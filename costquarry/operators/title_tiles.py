"""Pairs of titles that may be alike, found in tiles: titles that share a key meet in tiles of two chunks, whatever else they hold.

Names made of few syllables share parts with nearly all others, so that a join on parts makes about as many rows as there
are pairs. A tile makes rows of pairs that reach the score alone: all its pairs are held against three bounds, each of
which costs more and leaves less than the one before, and only what passes them is compared by the standard library's matcher.

Of two titles of together S characters whose matching blocks have M, b - 1 places part b blocks, and at each a character
of one of them is unmatched, so there are at most S - 2M + 1 blocks and at least 3M - S - 1 runs of two characters that
both hold. At a ratio 2M / S of t or more both hold M = tS / 2 letters or more, in the same order, and (1.5t - 1)S - 1
runs or more. A title that is within the other shares all its letters and runs.

Letters and runs are numbered (the k-th of a kind) and are bits of a few words. Where a title has `over` parts more than
bits, as several have the same one, what two titles share is at most their common bits and the smaller `over`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costquarry import ship
from costquarry.spread import TASKS_A_CORE

#: Titles of a chunk, a side of a tile.
CHUNK = 8192
#: Pairs whose common bits are counted at once.
BLOCK = 1 << 18
WITHIN, WITHIN_SCORE = 12, 0.99


@dataclass
class Parts:
    """Parts of some titles, in the order of the titles: whose each is, and its code."""

    row: np.ndarray
    code: np.ndarray
    n: int

    def numbered(self) -> np.ndarray:
        """Codes in which the k-th part of a kind in a title is told from the others."""
        order = np.lexsort((self.code, self.row))
        row, code = self.row[order], self.code[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        at = np.arange(len(row))
        out = np.empty(len(row), np.int64)
        out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        return self.code * 4096 + np.minimum(out, 4095)


def letters(titles: list[str]) -> tuple[Parts, np.ndarray]:
    """The characters of titles, and how many each has."""
    size = np.array([len(t) for t in titles], np.int64)
    code = np.frombuffer("".join(titles).encode("utf-32-le"), np.uint32).astype(np.int64)
    return Parts(np.repeat(np.arange(len(titles)), size), code, len(titles)), size


def runs(chars: Parts) -> Parts:
    """Of titles' characters the runs of two."""
    same = chars.row[1:] == chars.row[:-1]
    return Parts(chars.row[1:][same], (chars.code[:-1] << 21 | chars.code[1:])[same], chars.n)


def ranked(a: np.ndarray, b: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of two sides as numbers below `kinds`, such that the most frequent ones have one each."""
    _, at, often = np.unique(np.concatenate([a, b]), return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often)) % kinds
    return rank[at[: len(a)]], rank[at[len(a) :]]


def bits(parts: Parts, kind: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(words of bits, over) of each title."""
    held = np.zeros((parts.n, words), np.uint64)
    np.bitwise_or.at(held, (parts.row, kind >> 6), np.uint64(1) << (kind & 63).astype(np.uint64))
    return held, np.bincount(parts.row, minlength=parts.n) - np.bitwise_count(held).sum(axis=1, dtype=np.int64)


def sketches(a: Parts, b: Parts, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits and over of both sides' numbered parts."""
    ka, kb = ranked(a.numbered(), b.numbered(), 64 * words)
    return (*bits(a, ka, words), *bits(b, kb, words))


def least_letters(la: np.ndarray, lb: np.ndarray, least: float) -> np.ndarray:
    """Letters that titles of these lengths share, in the same order, at the score `least`, or more."""
    short = np.minimum(la, lb)
    need = np.ceil(least / 2 * (la + lb) - 1e-9).astype(np.int64)
    return np.where(short >= WITHIN, np.minimum(need, short), need)


def least_runs(la: np.ndarray, lb: np.ndarray, least: float) -> np.ndarray:
    short = np.minimum(la, lb)
    need = np.ceil((1.5 * least - 1) * (la + lb) - 1 - 1e-9).astype(np.int64)
    return np.where(short >= WITHIN, np.minimum(need, short - 1), need)


def by_letters(a: Parts, b: Parts, la: np.ndarray, lb: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs that may share enough letters, in blocks."""
    words = min(8, 1 + int(la.mean() + lb.mean()) // 48)
    bits_a, over_a, bits_b, over_b = sketches(a, b, words)
    order = np.lexsort((over_a, la))
    ends = np.flatnonzero(np.diff(la[order], append=-1) | np.diff(over_a[order], append=-1)) + 1
    wide = max(1, BLOCK // len(lb))
    columns, begin = np.ascontiguousarray(bits_b.T), 0
    for end in ends:
        one = order[begin]
        need = least_letters(la[one], lb, least) - np.minimum(over_a[one], over_b)
        need = np.clip(need, 0, 255).astype(np.uint8) if words == 1 else need.astype(np.int16)
        for at in range(begin, end, wide):
            rows = order[at : min(at + wide, end)]
            shared = np.bitwise_count(bits_a[rows, :1] & columns[0])
            if words > 1:
                shared = shared.astype(np.int16)
                for w in range(1, words):
                    shared += np.bitwise_count(bits_a[rows, w : w + 1] & columns[w])
            hit = np.flatnonzero(shared >= need)
            if len(hit):
                yield rows[hit // len(lb)], hit % len(lb)
        begin = end


def in_order(a: Parts, b: Parts, la: np.ndarray, lb: np.ndarray) -> Iterator[np.ndarray]:
    """A generator that is sent pairs (i, j) and gives the length of their longest common subsequence or more; titles i have up to 64 characters."""
    ka, kb = ranked(a.code, b.code, 64)
    place = lambda p, size: np.arange(len(p.row)) - np.repeat(np.cumsum(size) - size, size)
    masks = np.zeros((a.n, 65), np.uint64)
    pa_ = place(a, la)
    short = pa_ < 64
    np.bitwise_or.at(masks, (a.row[short], ka[short]), np.uint64(1) << pa_[short].astype(np.uint64))
    chars = np.full((int(lb.max()), b.n), 64, np.int64)
    chars[place(b, lb), b.row] = kb
    found = None
    while True:
        i, j = yield found
        free = np.full(len(i), ~np.uint64(0))
        for at in range(int(lb[j].max())):
            met = free & masks[i, chars[at, j]]
            free = (free + met) | (free - met)
        found = 64 - np.bitwise_count(free).astype(np.int64)


def may_be_alike(left: list[str], right: list[str], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), in blocks, of all pairs whose score is `least` or more, and of few others."""
    (a, la), (b, lb) = letters(left), letters(right)
    ra, rb = runs(a), runs(b)
    words = min(32, 4 * (1 + int(la.mean() + lb.mean()) // 48))
    bits_a, over_a, bits_b, over_b = sketches(ra, rb, words)
    ordered = in_order(a, b, la, lb)
    next(ordered)
    for i, j in by_letters(a, b, la, lb, least):
        shared = np.bitwise_count(bits_a[i] & bits_b[j]).sum(axis=1, dtype=np.int64) + np.minimum(over_a[i], over_b[j])
        keep = shared >= least_runs(la[i], lb[j], least)
        i, j = i[keep], j[keep]
        if len(i):
            keep = (la[i] > 64) | (ordered.send((i, j)) >= least_letters(la[i], lb[j], least))
            yield i[keep], j[keep]


def dealt_into_tiles(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Titles (id, t, keys) of both sides as (key, i, j, id, t): chunk i of a key's left titles meets chunk j of its right ones."""
    a, b = (df.select("id", "t", F.explode("keys").alias("key")) for df in (left, right))
    chunks = lambda df, name: df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias(name))
    sizes = chunks(a, "na").join(chunks(b, "nb"), "key")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    a = a.join(sizes, "key").select("key", own("na").alias("i"), each("nb").alias("j"), "id", "t")
    b = b.join(sizes, "key").select("key", each("na").alias("i"), own("nb").alias("j"), "id", "t")
    n = TASKS_A_CORE * left.sparkSession.sparkContext.defaultParallelism
    # A tile is few bytes and much work, so tasks are counted by tiles.
    return tuple(df.repartition(n, "key", "i", "j") for df in (a, b))


def alike(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, score): of titles (id, t, keys) that share a key those whose score is `least` or more; of several shared keys, once for each.

    `least` has to be over 2/3, and titles have a character at least.
    """
    from costquarry.operators.titles import title_score

    if least <= 2 / 3:
        raise ValueError("similar titles may share no run of two characters below 2/3")
    ship(left.sparkSession)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if len(a) and len(b):
            (ia, ta), (ib, tb) = ((x.column("id").to_pylist(), x.column("t").to_pylist()) for x in (a, b))
            for i, j in may_be_alike(ta, tb, least):
                each = ((ia[x], ib[y], title_score(ta[x], tb[y], least)) for x, y in zip(i.tolist(), j.tolist()))
                found += (x for x in each if x[2] >= least)
        return pa.table([pa.array(c, k) for c, k in zip(zip(*found) if found else ([], [], []), (pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "score"])

    tile = ("key", "i", "j")
    a, b = dealt_into_tiles(left, right)
    return a.groupBy(*tile).cogroup(b.groupBy(*tile)).applyInArrow(run, "a long, b long, score double")
