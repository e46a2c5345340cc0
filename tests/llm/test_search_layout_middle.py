"""Nearest neighbours, clustered layout and fill-in-middle against plain loops, and the cases that no table has."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from costquarry.llm import clustered, middle, neighbours, queries

ODD = [None, "", " ", "a", "\n", "\n\n", "a\nb", "a\nb\n", "é\nñ 가나\n\U0001f600", "x" * 70_000, "line\n" * 9_000, "<P>", "a <M>\nb", "a<\nS>\n<", "same", "same", "\r\n\n"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None if i == 1 else i // 2, t, None if i % 5 == 0 else f"s{i % 2}", None if i % 4 == 0 else "en", "clash", 1, 2.0) for i, t in enumerate(ODD)]
    rows.append(rows[3])
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, _t string, n int, z double").repartition(3)


# 11: nearest neighbours


def plain_nearest(points, asked, k):
    """{query: [(rank, row, score)]} by comparing all; points and asked: (id, vector)."""
    out = {}
    for q, x in asked:
        best = {}
        for i, v in points:
            if i != q:
                best[i] = max(best.get(i, -np.inf), float((np.float64(x) * np.float64(v)).sum()))
        got = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
        if q not in out or got[0][1] > out[q][0][2]:
            out[q] = [(r, i, s) for r, (i, s) in enumerate(got, 1)]
    return out


def rows_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [g[:2] for g in got[q]] == [w[:2] for w in want[q]]
        assert np.allclose([g[2] for g in got[q]], [w[2] for w in want[q]], rtol=1e-12)


def test_neighbours_recall(spark, sf_dir):
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain_nearest(table, [r for r in table if r[0] % 20 == 0], 20)
    got = rows_of(queries.op11_neighbours(spark, sf_dir))
    assert got.keys() == want.keys() and all([g[0] for g in v] == list(range(1, 21)) for v in got.values())
    share = [len({g[1] for g in got[q]} & {w[1] for w in want[q]}) / 20 for q in want]
    assert np.mean(share) >= 0.9
    exact = dict(table)
    assert all(abs(s - float((np.float64(exact[q]) * np.float64(exact[i])).sum())) < 1e-12 for q, v in got.items() for _, i, s in v)


def test_neighbours_of_unlike_lengths_and_clusters(spark):
    """Lengths from 0.1 to 10, tight clusters and a vector on a third of all rows: found rows are what comparing all gives."""
    rng = np.random.default_rng(3)
    v = rng.normal(0, 1, (3000, 16)) * rng.uniform(0.1, 10, (3000, 1))
    v[1000:2000] = v[1000] + rng.normal(0, 0.01, (1000, 16))
    v[2000:] = v[2000]
    table = [(int(i), [float(y) for y in x]) for i, x in enumerate(v)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    want = plain_nearest(table, table[::20], 20)
    got = rows_of(neighbours.nearest(df, df.where(neighbours.every(df, 20))))
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    assert np.mean([len({g[1] for g in got[q]} & {w[1] for w in want[q]}) / 20 for q in want]) >= 0.9
    copies = [q for q in want if q >= 2000]
    assert copies and all([g[1] for g in got[q]] == [w[1] for w in want[q]] for q in copies)


def test_neighbours_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.5]), (3, [0.5, 0.5]), (40, None), (60, []),
        (80, [0.0, 0.0]), (100, [1.0, None]), (120, [nan, 1.0]), (140, [inf, 1.0]), (160, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (180, [0.2, 0.1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int").repartition(3)
    able = [(i, tuple(v)) for i, v in rows if i in (0, 1, 2, 3, 20, 180)]
    want = plain_nearest(able, [(i, v) for i, v in able if i % 20 == 0], 20)
    got = rows_of(neighbours.nearest(df, df.where(neighbours.every(df, 20))))
    assert {q: [(r, i) for r, i, _ in v] for q, v in got.items()} == {q: [(r, i) for r, i, _ in v] for q, v in want.items()}
    assert neighbours.nearest(df.limit(0), df).count() == 0
    assert neighbours.nearest(df, df.limit(0)).count() == 0


def test_neighbours_tiles_and_fallback(spark, monkeypatch):
    """Small tiles and no probe but the first: queries that find too little are compared with all."""
    rng = np.random.default_rng(4)
    table = [(int(i), [float(y) for y in x]) for i, x in enumerate(rng.normal(0, 1, (400, 8)))]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "TILE_ROWS", 30)
    monkeypatch.setattr(neighbours, "CELL", 100)
    monkeypatch.setattr(neighbours, "BUCKET", 1)
    got = rows_of(neighbours.nearest(df, df.where(neighbours.every(df, 20)), target=0.0))
    want = plain_nearest(table, table[::20], 20)
    assert all(len(g) == 20 for g in got.values()) and got.keys() == want.keys()
    monkeypatch.setattr(neighbours, "BUCKET", 1000)
    same(rows_of(neighbours.nearest(df, df.where(neighbours.every(df, 20)))), want)


def test_visits_in_order():
    """Buckets come in falling order of probability, each once, and all of them if the target asks for all."""
    rng = random.Random(5)
    for _ in range(50):
        others = sorted(([(loss, 0, (7 * i + j + 1) * 1000**i) for j, loss in enumerate(sorted(rng.uniform(0.1, 3) for _ in range(rng.randint(1, 3))))]
            for i in range(rng.randint(1, 4))), key=lambda m: m[0][0])
        got = [b for _, b in neighbours.visited(0.2, others, 0, 0, 99.0)]
        every = {sum(b for _, b in c): sum(x for x, _ in c) for c in itertools.product(*[[(0.0, 0), *((m[0], m[2]) for m in o)] for o in others])}
        assert sorted(got) == sorted(every)
        assert [round(every[b], 9) for b in got] == [round(x, 9) for x in heapq.nsmallest(len(every), every.values())]


# 12: clustered layout


def plain_layout(docs, rows_a_file):
    """Rows (doc_id, z, position, file, touched, matching, bounds) of docs (doc_id, text, source, lang)."""
    low = lambda v: (v is not None, v)
    raw = [(None if s is None else s.encode(), None if g is None else g.encode(), -1 if t is None else len(t.encode()),
        None if i is None else zlib.crc32(str(i).encode()) % 365) for i, t, s, g in docs]
    coords = []
    for d in range(4):
        order = sorted(low(r[d]) for r in raw)
        coords.append([8 * order.index(low(r[d])) // len(raw) for r in raw])
    cells = list(zip(*coords))
    z = [sum((c[d] >> b & 1) << (4 * b + 3 - k) for b in range(3) for k, d in enumerate((3, 2, 1, 0))) for c in cells]
    order = sorted(range(len(docs)), key=lambda r: (z[r], low(docs[r][0])))
    file = {r: p // rows_a_file for p, r in enumerate(order)}
    held = {}
    for r in order:
        held.setdefault(file[r], []).append(cells[r])
    box = {f: [(min(c[d] for c in cs), max(c[d] for c in cs)) for d in range(4)] for f, cs in held.items()}
    reach = (0, 0, 1, 1)
    out = []
    for p, r in enumerate(order):
        c = cells[r]
        touched = sum(all(lo <= c[d] + reach[d] and hi >= c[d] - reach[d] for d, (lo, hi) in enumerate(b)) for b in box.values())
        matching = sum(any(all(abs(o[d] - c[d]) <= reach[d] for d in range(4)) for o in cs) for cs in held.values())
        out.append((docs[r][0], z[r], p, file[r], touched, matching, ",".join(f"{lo},{hi}" for lo, hi in box[file[r]])))
    return out


@pytest.mark.parametrize("rows_a_file", [1, 7, 2000])
def test_layout(spark, sf_dir, rows_a_file):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain_layout([(r.doc_id, r.text, r.source, r.lang) for r in df.collect()], rows_a_file)
    assert sorted(map(tuple, clustered.layout(df, rows_a_file=rows_a_file).collect())) == sorted(want)


def test_layout_odd(odd):
    key = lambda r: tuple((v is not None, v) for v in r)
    want = plain_layout([(r.doc_id, r.text, r.source, r.lang) for r in odd.collect()], 4)
    got = sorted(map(tuple, clustered.layout(odd, rows_a_file=4).collect()), key=key)
    assert sorted(r[:2] for r in got if r[0]) == sorted(r[:2] for r in want if r[0])
    assert sorted(r[2] for r in got) == list(range(len(want))) and got == sorted(want, key=key)
    assert clustered.layout(odd.limit(0)).count() == 0


def test_layout_of_one_id(spark):
    """One id, source and language on all rows: places are still numbered one by one."""
    df = spark.range(3000).select(F.lit(5).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"))
    got = clustered.layout(df, rows_a_file=100).collect()
    assert sorted(r.position for r in got) == list(range(3000)) and {r.file for r in got} == set(range(30))


def test_layout_files(spark, sf_dir, tmp_path):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    places = clustered.layout(df, rows_a_file=50)
    clustered.write_files(df, places, str(tmp_path / "laid"))
    back = spark.read.parquet(str(tmp_path / "laid"))
    assert sorted((r.doc_id, r.file) for r in back.collect()) == sorted((r.doc_id, r.file) for r in places.collect())


# 13: fill-in-middle


def plain_middle(i, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hashed = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hashed[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [100, 60])
def test_middle_odd(odd, rate):
    got = middle.fill_in_middle(odd, rate=rate).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(repr((i, *plain_middle(i, t, rate))) for i, t in docs)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in docs)
    assert middle.digests(middle.fill_in_middle(odd.limit(0))).count() == 0


def test_middle_of_any_text():
    rng = random.Random(8)
    for i in range(3000):
        t = "".join(rng.choice(["a", "\n", "é", "<", "S", ">", "P", "M", "가", "\U0001f600", "\r"]) for _ in range(rng.randint(0, 40)))
        n, form, prefix, mid, out = middle.cut(t.encode(), i)
        assert (n, form, prefix, mid, out.decode()) == plain_middle(i, t)
        assert middle.cut(t.encode(), i, unit="chars")[0] == len(t)


def test_ranked_by_halves():
    rng = random.Random(9)
    for _ in range(300):
        places = sorted(rng.sample(range(5000), rng.randint(1, 60)))
        bits = sum(1 << p for p in places)
        assert [middle.ranked(bits, j) for j in range(1, len(places) + 1)] == places


@pytest.mark.parametrize("name", ["op12_clustered_layout", "op13_fill_in_middle"])
def test_matches_sql(spark, sf_dir, name):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = c.sql(queries.oracle_sql()[name])
    cols = sorted(want.columns)
    plain = lambda v: None if v is None or v != v else v
    got = queries.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted((tuple(map(plain, r)) for r in c.sql(f"SELECT {', '.join(cols)} FROM want").fetchall()), key=repr)
