"""Full-text search by an inverted index: runs of two characters with their places, written in buckets of the run's hash.

Texts are put together in segments of some millions of characters, with a gap behind each, and a gram has one row for each
segment: the keys of its texts, where these begin in the segment, and all its places. A query reads only the buckets of its
own grams. A word of n characters is met by the grams that cover it, rarest first: a place that all of them agree on is
a place of the word, so that a phrase costs what a word costs and no text is read. Words are parts of texts here, as in
`search.text_query`, whose results these are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from costquarry import ship
from costquarry.operators.search import Terms, parsed
from costquarry.spread import TASKS_A_CORE

BUCKETS = 64
#: Characters from which a segment is full; a text is never cut.
SEGMENT = 1 << 21
#: Tasks that write at most, unless there are so many cores: each has a file in each bucket.
WRITERS = 64
#: What stands behind each text; no text has it.
GAP = "\ud800"


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def _listed(code: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of grams' codes at ascending places: the codes that occur, ends of their places, places, ends of their texts, texts in order."""
    order = np.argsort(code, kind="stable")
    code, at = code[order], at[order]
    doc = doc[at]
    new, first = np.ones(len(code), bool), np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    first[1:] = new[1:] | (doc[1:] != doc[:-1])
    begin, texts = np.flatnonzero(new), np.flatnonzero(first)
    return code[begin], np.append(begin, len(code)), at, np.append(np.searchsorted(texts, begin), len(texts)), doc[texts]


def segment_postings(keys: list, texts: list[str], segment: int, schema: pa.Schema) -> pa.RecordBatch:
    """A segment's rows (gram, segment, n, keys, starts, places): runs of two characters, and single ones without their places."""
    chars = np.frombuffer("".join(x for t in texts for x in (t, GAP)).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 1 for t in texts])
    starts, doc = np.cumsum(size) - size, np.repeat(np.arange(len(texts)), size)
    known = np.zeros(0x110000, np.uint32)
    known[chars] = 1
    alphabet = np.flatnonzero(known)
    known[alphabet] = np.arange(len(alphabet))
    code, text, many = known[chars].astype(np.int64), chars != ord(GAP), len(alphabet)
    narrow = lambda c: c.astype(np.uint16) if many * many <= 1 << 16 else c
    inside, pair = np.flatnonzero(text), np.flatnonzero(text[:-1] & text[1:])
    ones, _, _, ends1, docs1 = _listed(narrow(code[inside]), inside, doc)
    twos, ends, places, ends2, docs2 = _listed(narrow(code[pair] * many + code[pair + 1]), pair, doc)
    grams = [chr(alphabet[c]) for c in ones] + [chr(alphabet[c // many]) + chr(alphabet[c % many]) for c in twos.tolist()]
    docs, doc_ends = np.concatenate([docs1, docs2]), np.concatenate([ends1, ends2[1:] + len(docs1)]).astype(np.int32)
    place_ends = np.concatenate([np.zeros(len(ones), np.int64), ends]).astype(np.int32)
    n = np.concatenate([np.diff(ends1), np.diff(ends)])
    lists = lambda ends, values, name: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, type=schema.field(name).type)
    held = pa.array(keys, schema.field("keys").type.value_type).take(pa.array(docs))
    return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(np.full(len(grams), segment), pa.int64()), pa.array(n, pa.int64()),
        lists(doc_ends, held, "keys"), lists(doc_ends, pa.array(starts[docs], pa.int32()), "starts"), lists(place_ends, pa.array(places, pa.int32()), "places")], schema=schema)


def write_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> str:
    """Write the index of a table below a path: postings (bucket, gram, segment, n, keys, starts, places), grams (how often each occurs) and keys.

    Keys are unique; rows with a null key aren't indexed. Tasks write the segments of their own texts, so that nothing is
    shuffled. Places count characters of the segment from 0. A single character has its texts alone, by which a query of
    one character is met.
    """
    spark = docs.sparkSession
    ship(spark)
    ddl = f"gram string, segment long, n long, keys array<{docs.schema[key].dataType.simpleString()}>, starts array<int>, places array<int>"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size, segment = [], [], 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for k, t in zip(b.column("key"), b.column("text")):
                keys.append(k.as_py())
                texts.append(t.as_py().decode("utf-8", "replace"))
                size += len(texts[-1]) + 1
                if size >= SEGMENT:
                    yield segment_postings(keys, texts, segment, schema)
                    keys, texts, size, segment = [], [], 0, segment + 1
        if texts:
            yield segment_postings(keys, texts, segment, schema)

    cores = spark.sparkContext.defaultParallelism
    rows = docs.where(docs[key].isNotNull())
    lowered = rows.select(docs[key].alias("key"), F.lower(F.coalesce(docs[text], F.lit(""))).cast("binary").alias("text")).where(F.length("text") > 0)
    # A small table may be one task by itself.
    lowered = lowered.repartition(cores) if docs.rdd.getNumPartitions() < cores else lowered.coalesce(max(WRITERS, TASKS_A_CORE * cores))
    postings = lowered.mapInArrow(run, ddl).withColumn("bucket", _bucket(F.col("gram"), buckets))
    # Sorted by gram, so that row groups hold few grams and others are skipped. Places ascend: their steps are few bits.
    plain = {f"parquet.enable.dictionary#{c}.list.element": "false" for c in ("starts", "places")}
    postings.sortWithinPartitions("bucket", "gram", "segment").write.options(**{"parquet.block.size": 16 << 20, "parquet.writer.version": "v2"}, **plain).partitionBy("bucket").parquet(f"{path}/postings")
    held = spark.read.parquet(f"{path}/postings")
    held.groupBy("bucket", "gram").agg(F.sum("n").alias("n")).repartition("bucket").sortWithinPartitions("bucket",
        "gram").write.partitionBy("bucket").parquet(f"{path}/grams")
    rows.select(docs[key].alias("key")).write.parquet(f"{path}/keys")
    return path


def _texts_of(begins: DataFrame) -> DataFrame:
    """Keys of the texts (keys, starts) in which places of a segment (begins) are."""
    kind = begins.schema["keys"].dataType.elementType.simpleString()
    schema = to_arrow_schema(StructType.fromDDL(f"key {kind}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, starts, at in zip(*(b.column(c) for c in ("keys", "starts", "begins"))):
                text = np.unique(np.searchsorted(starts.values.to_numpy(), at.values.to_numpy(), "right")) - 1
                yield pa.RecordBatch.from_arrays([keys.values.take(pa.array(text)).cast(schema.field(0).type)], schema=schema)

    return begins.select("keys", "starts", "begins").mapInArrow(run, f"key {kind}")


class Index:
    """A written index."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.postings, self.grams, self.keys = (spark.read.parquet(f"{path}/{x}") for x in ("postings", "grams", "keys"))

    def _rows(self, table: DataFrame, grams: list[str]) -> DataFrame:
        """Rows of some grams: the buckets are constants, so that no other's files are read."""
        inside = F.lit(False)
        for g in grams:
            inside = inside | ((F.col("bucket") == _bucket(F.lit(g), self.buckets)) & (F.col("gram") == g))
        return table.where(inside)

    def counts(self, words: list[str]) -> dict[str, int]:
        """How often the grams of some words occur: as many rows as the query has grams."""
        wanted = sorted({g for w in words for g, _ in cover(w)})
        return {r.gram: r.n for r in self._rows(self.grams, wanted).collect()} if wanted else {}

    def word(self, word: str, counts: dict[str, int], among: DataFrame | None = None) -> DataFrame:
        """Keys of the texts that hold a word of at least one character; among: only of these keys."""
        grams = sorted(cover(word), key=lambda p: (counts.get(p[0], 0), p[1]))
        rows = [self._rows(self.postings, [gram]) for gram, _ in grams]
        if len(grams) == 1:
            found = rows[0].select(F.explode("keys").alias("key"))
        else:
            begun = lambda at: F.transform("places", lambda p: p - at)
            met = rows[0].select("segment", "keys", "starts", begun(grams[0][1]).alias("begins"))
            for df, (_, at) in zip(rows[1:], grams[1:]):
                met = met.join(df.select("segment", begun(at).alias("others")), "segment")
                met = met.select("segment", "keys", "starts", F.array_intersect("begins", "others").alias("begins"))
            found = _texts_of(met)
        return (found if among is None else found.join(among, "key", "left_semi")).distinct()

    def search(self, query: str | None) -> DataFrame:
        """Keys of the texts that meet a query: words are all needed, OR, a leading minus, quoted phrases; a blank query is met by all."""
        groups = [g for g in parsed(query) if not any(w == "" and not minus for w, minus in g)]
        words = [w.lower() for g in groups for w, _ in g]
        counts = self.counts(words)
        rarity = lambda w: min((counts.get(g, 0) for g, _ in cover(w)), default=0)
        wanted = sorted((g for g in groups if not any(minus for _, minus in g)), key=lambda g: sum(rarity(w.lower()) for w, _ in g))
        found = None
        for g in wanted:
            found = self._either([w.lower() for w, _ in g], counts, found)
        found = self.keys if found is None else found
        for g in (g for g in groups if any(minus for _, minus in g)):
            # Left out are texts that hold all excluded words of the group and none of its others.
            out = found
            for w in (w.lower() for w, minus in g if minus):
                out = self.word(w, counts, out)
            others = [w.lower() for w, minus in g if not minus]
            if others:
                out = out.join(self._either(others, counts, out), "key", "left_anti")
            found = found.join(out, "key", "left_anti")
        return found

    def _either(self, words: list[str], counts: dict[str, int], among: DataFrame | None) -> DataFrame:
        found = self.word(words[0], counts, among)
        for w in words[1:]:
            found = found.union(self.word(w, counts, among))
        return found.distinct() if len(words) > 1 else found


def cover(word: str) -> list[tuple[str, int]]:
    """Grams that cover a word, with their places in it: each second one and the last; of a single character itself."""
    if len(word) < 2:
        return [(word, 0)] if word else []
    return [(word[i : i + 2], i) for i in sorted({*range(0, len(word) - 1, 2), len(word) - 2})]


__all__ = ["Index", "Terms", "cover", "write_index"]
