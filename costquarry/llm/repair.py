"""Token-id output: binary shards compressed by a Re-Pair grammar, decoded by random access.

Documents are dealt by ranges of doc_id and sorted, so shards follow each other in ascending id order.
A shard holds about SHARD_IDS token ids. Rounds replace the most frequent adjacent id pairs of the
shard by nonterminals until no pair occurs LEAST_COUNT times; the shard stores the rules, the length each
rule expands to, and the shortened sequence. A document is decoded by finding its place in the summed
expansion lengths, without decoding what is before it.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costquarry.llm import runtime

SHARD_IDS = 1 << 20
MAGIC = b"RPS1"
HEADER = struct.Struct("<4sIIQQIII")  # magic, symbol base, rules, sequence length, ids, documents, bytes a symbol, crc32 of the rest
PER_ROUND, LEAST_COUNT = 2048, 8
REMEMBERED = 200_000  #: words of each of two generations: what the younger one lacks is looked up in the older one
AT_ONCE = 500
#: Tokenizers that split and lower texts by these rules have words remembered; texts go whole through any other one.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

SPACE, LETTER, MARK, DIGIT, ODD = range(5)


def _kinds() -> np.ndarray:
    """What each byte is. Odd: bytes that the rules here say nothing of; parts with one go to the tokenizer as they are."""
    kind = np.full(256, ODD, np.uint8)
    kind[33:127] = MARK
    kind[[9, 10, 11, 12, 13, 32]] = SPACE
    kind[48:58] = DIGIT
    kind[65:91] = kind[97:123] = LETTER
    kind[[ord("'"), ord("<")]] = ODD  # contractions, special tokens
    return kind


KIND = _kinds()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] of them), then the same of the next."""
    ends = np.cumsum(size, dtype=np.int32)
    out = np.repeat(begin.astype(np.int32) - (ends - size.astype(np.int32)), size)
    out += np.arange(len(out), dtype=np.int32)
    return out


def words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut UTF-8 bytes into words: (their bytes, lengths, kinds, words before each text). Texts start at `begins`.

    A word is a run of letters (ASCII or two bytes C3 xx, lowered), a run of ASCII marks, a digit, or a whole
    part between ASCII white space that has other characters in it (kept as it is).
    """
    n = len(data)
    kind, low = KIND[data], LOWER[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    second = data[at + 1]
    fine = (second != 0x97) & (second != 0xB7)  # the signs of multiplication and division
    at, second = at[fine] + 1, second[fine]
    kind[at] = kind[at - 1] = LETTER
    low[at[second <= 0x9E]] += 32
    first = np.zeros(n + 1, bool)
    first[begins] = True
    first[1:n] |= kind[1:] != kind[:-1]
    first[:n] |= kind == DIGIT
    odd = np.flatnonzero(kind == ODD)
    if len(odd):
        part = np.zeros(n + 1, bool)
        part[begins] = True
        part[1:n] |= (kind[1:] == SPACE) != (kind[:-1] == SPACE)
        part = np.flatnonzero(part[:n])
        here = np.unique(np.searchsorted(part, odd, "right") - 1)
        size = np.append(part, n)[here + 1] - part[here]
        inside = _spread(part[here], size)
        kind[inside], low[inside], first[inside] = ODD, data[inside], False
        first[part[here]] = True
    start = np.flatnonzero(first[:n]).astype(np.int32)
    del first
    size, kinds = np.diff(np.append(start, np.int32(n))), kind[start]
    real = kinds != SPACE
    start = start[real]
    return low[kind != SPACE], size[real], kinds[real], np.searchsorted(start, begins)


class Encoder:
    """Ids of whole texts by the tokenizers library, each followed by an end id.

    Of a tokenizer with the rules above, the ids of words are remembered: it drops white space and encodes
    each word by itself. Any other tokenizer encodes the texts one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        split = ((rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        added = [t["content"] for t in rules.get("added_tokens",
            []) if t["content"][:1] != "<" or t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]]
        lowered = (rules.get("normalizer") or {}).get("normalizers") == NORMALIZER and split.get("pattern") == {"Regex": SPLIT}
        self.by_words = lowered and not added and rules["model"].get("end_of_word_suffix") == WORD_END and rules.get("post_processor") is None
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """The ids of each text (null: none), then end_id."""
        texts = pa.compute.fill_null(texts.cast(pa.string()), "")
        end = np.array([end_id], self.dtype)
        if not self.by_words:
            found = self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return [np.append(np.array(e.ids, self.dtype), end) for e in found]
        cut = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        if cut[0] == cut[-1]:
            return [end] * len(texts)
        data, size, kinds, before = words(np.frombuffer(texts.buffers()[2], np.uint8)[cut[0] : cut[-1]], cut[:-1] - cut[0])
        ends = np.zeros(len(size) + 1, np.int32)
        np.cumsum(size, out=ends[1:])
        coded = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        del ends, data, size
        which = coded.indices.to_numpy()
        kind = np.zeros(len(coded.dictionary), np.uint8)
        kind[which] = kinds
        found = [*self._ids(coded.dictionary.to_pylist(), kind == ODD), end.tobytes()]
        flat = np.frombuffer(b"".join(found), self.dtype)
        long = np.fromiter(map(len, found), np.int32, len(found)) // self.dtype.itemsize
        after = np.append(before[1:], len(which))
        which = np.insert(which, after, len(found) - 1)
        n = long[which]
        ids = flat[_spread((np.cumsum(long) - long)[which], n)]
        cuts = np.append(0, np.cumsum(n))[np.append(0, after + np.arange(1, len(texts) + 1))].tolist()
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]

    def _ids(self, distinct: list[bytes], odd: np.ndarray) -> list[bytes]:
        """The ids of each of distinct words, as bytes."""
        young, old = self.young, self.old
        found = list(map(young.get, distinct))
        new = []
        for i, x in enumerate(found):
            if x is None:
                x = old.get(w := distinct[i])
                if x is None:
                    new.append(i)
                else:
                    young[w] = found[i] = x
        alone = [i for i in new if odd[i]]
        plain = [i for i in new if not odd[i]]
        groups = [plain[i : i + AT_ONCE] for i in range(0, len(plain), AT_ONCE)]
        width = self.dtype.itemsize
        for group, e in zip(groups, self.tok.encode_batch_fast([b" ".join([distinct[i] for i in g]).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            if len(ends) != len(group):
                alone += group
                continue
            raw = ids.tobytes()
            for i, begin, stop in zip(group, [0, *ends], ends):
                young[distinct[i]] = found[i] = raw[begin:stop]
        for i, e in zip(alone, self.tok.encode_batch_fast([distinct[i].decode() for i in alone], add_special_tokens=False)):
            young[distinct[i]] = found[i] = np.array(e.ids, self.dtype).tobytes()
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return found


_encoders: dict[str, Encoder] = {}


def encoder(tokenizer: str, path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(tokenizer)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules, sequence): rule i is the pair that symbol base + i stands for; later rules may use earlier ones."""
    seq, rules, n_rules = ids.astype(np.uint32), [np.zeros((0, 2), np.uint32)], 0
    while len(seq) > 1:
        # Pairs of symbols of 16 bits fit 32 bits.
        half, kind, mix = (16, np.uint32, 0x9E3779B1) if base + n_rules <= 1 << 16 else (32, np.uint64, 0x9E3779B97F4A7C15)
        pair = seq[:-1].astype(kind) << kind(half) | seq[1:]
        order = np.sort(pair)
        first = np.flatnonzero(np.r_[True, order[1:] != order[:-1]])
        count = np.diff(np.r_[first, len(order)])
        often = np.flatnonzero(count >= LEAST_COUNT)
        if not len(often):
            break
        if len(often) > PER_ROUND:
            often = often[np.lexsort((first[often], -count[often]))[:PER_ROUND]]
        chosen = np.sort(order[first[often]])
        # Each chosen pair has a slot of a table; of pairs that meet in a slot the last one counts in this round.
        slot = lambda p: (p * kind(mix)) >> kind(2 * half - 20)
        table = np.zeros(1 << 20, np.uint16)
        table[slot(chosen)] = np.arange(len(chosen))
        rank = table[slot(pair)]
        at = np.flatnonzero(chosen[rank] == pair)
        rank = rank[at]
        # Of overlapping hits every second one counts, from the left.
        new_run = np.r_[True, np.diff(at) != 1]
        begin = at[np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))]
        take = (at - begin) % 2 == 0
        at, rank = at[take], rank[take]
        # A pair that met another one in its slot, or whose hits all overlapped others, has no rule in this round.
        used = np.zeros(len(chosen), bool)
        used[rank] = True
        chosen = chosen[used]
        seq[at] = base + n_rules + (np.cumsum(used) - 1)[rank].astype(np.uint32)
        rules.append(np.stack([chosen >> kind(half), chosen & kind((1 << half) - 1)], axis=1).astype(np.uint32))
        n_rules += len(chosen)
        gone = np.ones(len(seq), bool)
        gone[at + 1] = False
        seq = seq[gone]
    return np.concatenate(rules), seq


def expansions(rules: np.ndarray, base: int) -> list[list[int]]:
    """The ids that each rule stands for."""
    out: list[list[int]] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else [a]) + (out[b - base] if b >= base else [b]))
    return out


def lengths(rules: np.ndarray, base: int) -> list[int]:
    """How many ids each rule stands for."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return out


def pack(docs: list[int | None], counts: list[int], ids: np.ndarray, base: int) -> bytes:
    """One shard as bytes."""
    rules, seq = compress(ids, base)
    length = np.array(lengths(rules, base), np.uint32)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")
    known = np.array([d is not None for d in docs], np.uint8)
    body = b"".join(
        [rules.astype(kind).tobytes(), length.astype("<u4").tobytes(), known.tobytes(), np.array([d or 0 for d in docs], "<i8").tobytes(),
            np.array(counts, "<u8").tobytes(), seq.astype(kind).tobytes()]
    )
    return HEADER.pack(MAGIC, base, len(rules), len(seq), len(ids), len(docs), width, zlib.crc32(body)) + body


class Shard:
    """Reads one shard's bytes; ids of any range are decoded without the rest."""

    def __init__(self, data: bytes):
        magic, self.base, n_rules, n_seq, self.n_ids, n_docs, width, crc = HEADER.unpack_from(data)
        if magic != MAGIC or zlib.crc32(data[HEADER.size :]) != crc:
            raise ValueError("not a whole shard")
        at, kind = HEADER.size, f"<u{width}"

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, dtype, n, at)
            at += got.nbytes
            return got

        rules = take(kind, 2 * n_rules).reshape(-1, 2)
        length = take("<u4", n_rules)
        known, names, self.counts = take("u1", n_docs), take("<i8", n_docs), take("<u8", n_docs).astype(np.int64)
        self.docs = [int(d) if k else None for d, k in zip(names, known)]
        self.seq = take(kind, n_seq).astype(np.int64)
        # A plain symbol expands to itself, a rule to its stretch of one flat array.
        ids = itertools.chain.from_iterable(expansions(rules, self.base))
        self.flat = np.concatenate([np.arange(self.base, dtype=np.uint32), np.fromiter(ids, np.uint32)])
        size = np.concatenate([np.ones(self.base, np.int64), length.astype(np.int64)])
        self.offset = np.cumsum(size) - size
        self.size = size[self.seq]
        self.ends = np.cumsum(self.size)
        self.starts = np.cumsum(self.counts) - self.counts

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids begin..end of the shard."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        i, j = np.searchsorted(self.ends, begin, "right"), np.searchsorted(self.ends, end, "left") + 1
        size, symbol = self.size[i:j], self.seq[i:j]
        shift = np.repeat(self.offset[symbol] - (np.cumsum(size) - size), size)
        out = self.flat[shift + np.arange(len(shift))]
        skip = begin - int(self.ends[i] - self.size[i])
        return out[skip : skip + end - begin]

    def doc(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i] + self.counts[i]))


def write_shards(df: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json", path: str | None = None,
    end_id: int = 1) -> DataFrame:
    """Encode, compress and write all texts to the shared folder; returns the table of shards (part, shard, shard_ids, data) read from it.

    Null texts are empty (the end id alone). Null ids come first; rows of one id follow each other, ordered
    by a hash of the text, and may lie in several shards. A text of more than SHARD_IDS ids is a shard of its
    own. Other columns are not read. An empty table gives no shards.
    """
    spark = df.sparkSession
    runtime.ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, shard = encoder(tokenizer, path), TaskContext.get().partitionId(), 0
        docs, parts, counts, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            data = pack(docs, counts, np.concatenate(parts), enc.size)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([total], pa.int64()),
                pa.array([data], pa.binary())], ["part", "shard", "shard_ids", "data"])

        for b in runtime.slices(batches, "_t", max_rows=4096, max_bytes=8 << 20):
            for d, e in zip(b.column("_i").to_pylist(), enc.encode(b.column("_t"), end_id)):
                n = len(e)
                if docs and total + n > SHARD_IDS:
                    yield flush()
                    docs, parts, counts, total, shard = [], [], [], 0, shard + 1
                docs.append(d)
                parts.append(e)
                counts.append(n)
                total += n
        if docs:
            yield flush()
        docs, parts, counts = [], [], []
        runtime.tidy()

    # The hash parts the rows of one id, the last column those that are equal.
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(997))
    src = df.select(df[id_col].cast("long").alias("_i"), df[text].alias("_t"), F.xxhash64(df[text]).alias("_h"), turn.alias("_n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = src.repartitionByRange(parts, "_i", "_h", "_n").sortWithinPartitions("_i", "_h", "_t").select("_i", "_t")
    return runtime.stage(dealt.mapInArrow(run, "part int, shard int, shard_ids long, data binary"), "shards")


def read_shards(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From the stored bytes, each document decoded by itself: a row per document with id, start (ids before it), n_tokens and ids_crc32. No shards: no rows."""
    runtime.ship(shards.sparkSession)
    by_part = shards.groupBy("part").agg(F.sum("shard_ids").alias("ids"))
    before = by_part.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    own = F.sum("shard_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("shard_ids")
    place = shards.select("part", "shard", own.alias("own")).join(before, "part").select("part", "shard", (F.col("before") + F.col("own")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                s = Shard(b.column("data")[row].as_py())
                crc = [zlib.crc32(s.doc(i).astype("<u4").tobytes()) for i in range(len(s.docs))]
                same = lambda x: pa.array([x] * len(crc), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [same(b.column("part")[row].as_py()), same(b.column("shard")[row].as_py()), pa.array(s.docs, pa.int64()),
                        pa.array(s.starts), pa.array(s.counts), pa.array(crc, pa.int64())],
                    ["part", "shard", "_i", "own_start", "n_tokens", "ids_crc32"],
                )

    docs = shards.select("part", "shard", "data").mapInArrow(run, "part int, shard int, _i long, own_start long, n_tokens long, ids_crc32 long")
    return docs.join(place, ["part", "shard"]).select(F.col("_i").alias(id_col), (F.col("base") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32")
