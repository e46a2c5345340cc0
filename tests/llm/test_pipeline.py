"""Stages of the corpus pipeline: their decisions take effect, columns go through, clean documents stay."""

import functools
import random
import zlib

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from costquarry.llm import simhash
from costquarry.llm.runtime import stage


@pytest.fixture(scope="module")
def docs(spark):
    body = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    item = " ".join(f"b{i}" for i in range(30))
    rows = [(i, body(i), "en", f"s{i % 3}", 400, "extra") for i in range(30)]
    rows += [(100, body(3), "en", "s0", 400, "copy"), (101, body(4).replace("w4x40", "changed"), "en", "s1", 400, "near"),
        (102, f"{body(50)} {item}", "en", "s1", 400, "leak"), (103, "12345 67 89", "en", "s1", 11, "no letter"),
        (104, None, None, None, None, None), (5, body(5), "en", "s2", 400, "extra")]
    return stage(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string"), "test")


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is None, i))


def test_language_stage(spark, docs, sf_dir):
    got = pipeline.language_id(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert set(ids(docs)) - set(ids(got)) == {103, 104}


def test_near_dedup_stage(spark, docs, sf_dir):
    got = pipeline.near_dedup(spark, docs, sf_dir)
    assert got.columns == docs.columns
    kept = ids(got)
    assert set(ids(docs)) - set(kept) == {100, 101} and kept.count(5) == 1


@functools.cache
def shingles(text):
    w = text.lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def brute_kept(rows):
    """Ids of the first of each component of texts with a similarity of 0.8 or more."""
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if similarity(a, b) >= 0.8:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return sorted(i for i in root if top(i) == i)


@pytest.mark.parametrize("chunk", [2, 2048])
def test_near_dedup_is_exact(spark, sf_dir, monkeypatch, chunk):
    """Pairs around a similarity of 0.8, of few shingles and of many: those at 0.8 lose one text, those below none."""
    monkeypatch.setattr(simhash, "CHUNK_TEXTS", chunk)
    rows, seen = [], set()

    def pair(shingles, ends, cut=0):  # the second has other words at its end, and fewer at its beginning
        w = [f"w{len(rows)}x{i}" for i in range(shingles + 4)]
        v = [*w[cut : len(w) - ends], *(f"v{i}" for i in range(ends))]
        rows.extend([(len(rows), " ".join(w)), (len(rows) + 1, " ".join(v))])
        seen.add(round(similarity(rows[-1][1], rows[-2][1]), 2))

    for _ in range(25):
        for shingles, ends, cut in ((5, 0, 1), (4, 0, 1), (6, 0, 1), (6, 1, 0), (8, 1, 1), (9, 1, 0), (10, 0, 2), (8, 2, 0), (100, 25, 0),
            (100, 14, 0), (100, 11, 0), (100, 0, 20), (100, 8, 0), (360, 40, 0), (20, 0, 3)):
            pair(shingles, ends, cut)
    chain = [f"c{i}" for i in range(200)]
    rows += [(len(rows) + k, " ".join(chain[8 * k : 8 * k + 84])) for k in range(12)]
    assert {0.6, 0.75, 0.8, 0.85} <= seen
    df = spark.createDataFrame([(i, t, "en", "s0") for i, t in rows], "doc_id long, text string, lang string, source string")
    assert ids(pipeline.near_dedup(spark, df, sf_dir)) == brute_kept(rows)


def test_decontamination_stage(spark, docs, sf_dir, tmp_path):
    spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = pipeline.decontaminated(spark, docs, f"file://{tmp_path}")
    assert got.columns == docs.columns and set(ids(docs)) - set(ids(got)) == {102}


LONG = "long " * 40_000


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, ids and rows that repeat, empty and very long texts, nulls in other columns, names that are used inside."""
    item = " ".join(f"b{i}" for i in range(30))
    body = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [
        (None, f"leak {item}", "a", 1), (None, body(1), "b", 2), (7, f"other {body(5)} leak {item}", "c", 3), (7, body(2), "d", 4),
        (7, body(2), "e", 5), (7, body(2), "d", 4),
        (8, body(3), None, None), (9, "", "g", 7), (10, None, "h", 8), (11, LONG + body(4), "i", 9), (12, "  \n", "j", 10),
        (None, None, "k", 11), (None, "", "l", 12),
    ]
    return stage(spark.createDataFrame([(i, t, "en", k, n, "r", 0.5) for i, t, k, n in rows],
        "doc_id long, text string, lang string, source string, key int, row string, score double"), "odd")


def whole(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_decontamination_stage_tells_rows_of_one_id_apart(spark, odd, sf_dir, tmp_path):
    spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = pipeline.decontaminated(spark, odd, f"file://{tmp_path}")
    assert got.columns == odd.columns and whole(got) == whole(odd.where("text is null or text not like '%leak%'"))


@pytest.mark.parametrize("k", range(5))
def test_odd_rows(spark, odd, sf_dir, k):
    """Each stage takes them, gives columns through, and gives the same rows again in another order of input."""
    name, stage_of = pipeline.STAGES[k]
    got = stage_of(spark, odd, sf_dir)
    assert k == 4 or got.columns == odd.columns
    rows = whole(got)
    assert rows == whole(stage_of(spark, odd.orderBy("source").repartition(3), sf_dir))
    if name == "language ID":
        assert rows == [r for r in whole(odd) if r[1] and r[1].strip()]
    elif name == "SimHash near-dedup":
        # Texts without a word are one group; rows equal in id and text are one document.
        texts = [r[1] for r in rows]
        assert sorted(t for t in texts if t and t.strip()) == sorted({r.text for r in odd.collect() if r.text and r.text.strip()}) and sum(not t or not t.strip() for t in texts) == 1
        assert next(r for r in rows if r[0] == 7 and "w2x" in r[1])[3] == "d"
    elif name == "token-ID output":
        assert len(rows) == odd.count()


def test_near_copies_are_found(spark, sf_dir):
    """Of near copies of the table's own texts, planted at 0.8 or more, at least nine in ten go, and what stays is what an exact comparison keeps."""
    rnd, rows, planted = random.Random(4), [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()], 0
    rows = [r for r in rows if len(r[1].split()) >= 12]
    for i, t in rows[:120]:
        w = t.split()
        for _ in range(max(1, len(w) // 60)):
            w[rnd.randrange(len(w))] = f"swap{rnd.randrange(10**6)}"
        if similarity(t, " ".join(w)) >= 0.8:
            rows.append((10_000 + i, " ".join(w)))
            planted += 1
    df = spark.createDataFrame([(i, t, "en", "s0") for i, t in rows], "doc_id long, text string, lang string, source string")
    kept = ids(pipeline.near_dedup(spark, df, sf_dir))
    assert planted > 60 and sum(i >= 10_000 for i in kept) <= planted / 10
    assert kept == brute_kept(rows)


def test_language_stage_decides(spark, sf_dir):
    """Texts of which no language has most, and texts of a script that was not learned, go, whatever their label; a table's own texts stay."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = lambda lang: "".join(r.text for r in table.where(f"lang = '{lang}' and length(text) > 600").orderBy("doc_id").limit(3).collect())[:1536]
    mixed, hangul = "".join(part(x) for x in ("en", "de", "fr", "es")), "가나다라 마바사 아자차카타파하 " * 20
    a, b, c = [i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 4 == 2][:3]  # nothing is learned from them
    more = spark.createDataFrame([(a, mixed, "en", "s", 1), (b, hangul, "en", "s", 1), (c, part("de"), "fr", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long")
    got = set(ids(pipeline.language_id(spark, table.unionByName(more), sf_dir)))
    assert not got & {a, b} and c in got
    own = table.where("length(text) > 100 and text rlike '[A-Za-z]{3}'")
    assert len(got & set(ids(own))) >= 0.98 * own.count()


def test_mixing_stage(spark, docs, sf_dir):
    clean = docs.where("doc_id < 100").dropDuplicates(["doc_id"])
    got = pipeline.mixed(spark, clean, sf_dir)
    assert got.columns == docs.columns
    by = {r.source: r.n for r in got.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = 30 * 80 * 5 / 8 / 80
    assert abs(by["s0"] - total) <= 1 and by["s0"] > by["s1"] > by["s2"]


def test_run(spark, sf_dir):
    got = pipeline.run(spark, sf_dir).orderBy("start").collect()
    assert got and got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("k", range(5))
def test_empty_tables(spark, docs, sf_dir, k):
    name, stage_of = pipeline.STAGES[k]
    assert stage_of(spark, docs.limit(0), sf_dir).count() == 0
