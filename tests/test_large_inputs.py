"""What grows with the input, and what must not: rows of joins, shuffled bytes, rows of an index."""

import random

from pyspark.sql import functions as F


def shuffled(spark):
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def test_titles_of_few_syllables_make_no_rows_of_pairs(spark):
    """Each two share several runs: what is shuffled goes by the titles, not by the pairs that share one."""
    from costquarry.operators import titles

    rng = random.Random(5)
    name = lambda: "".join(rng.choice(["ber", "ley", "son", "ham", "gut", "mal", "dal", "rez", "vic", "str"]) for _ in range(5))
    rec = spark.createDataFrame([(i, name(), ["K"]) for i in range(1500)], "record_id int, title string, countries array<string>")
    cand = spark.createDataFrame([(str(i), name(), "K") for i in range(1500)], "project_no string, title string, country string")
    before = shuffled(spark)
    assert titles.score_titles(rec, cand).count() > 100
    assert shuffled(spark) - before < 1_000_000


def test_no_alike_pair_is_left_out():
    """The bounds of a tile against the matcher itself, for short and long titles, few and many letters."""
    from costquarry.operators.title_tiles import may_be_alike
    from costquarry.operators.titles import title_score

    rng = random.Random(3)
    for letters, most in (("ab", 3), ("ab", 40), ("abcde", 15), ("가나다라마바사abc0123456789", 30), ("abcde", 90), ("가나다라마바사abc0123456789", 160)):
        base = ["".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(10)]

        def near(letters=letters, base=base):
            t = list(rng.choice(base))
            for _ in range(rng.randint(0, max(1, len(t) // 5))):
                at = rng.randint(0, len(t))
                t[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
            return "".join(t) or letters[0]

        left, right = sorted({near() for _ in range(50)}), sorted({near() for _ in range(50)} | {x + y for x in base[:3] for y in base[:2]})
        for least in (0.7, 0.82):
            want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if title_score(x, y) >= least}
            got = [p for i, j in may_be_alike(left, right, least) for p in zip(i.tolist(), j.tolist())]
            assert want and want <= set(got) and len(got) == len(set(got))


def test_index_has_a_row_for_a_gram_and_segment(spark, tmp_path, monkeypatch):
    """Not one for each place; texts over several segments, equal keys' order and long texts included."""
    from costquarry.operators import fulltext, search

    monkeypatch.setattr(fulltext, "SEGMENT", 5_000)
    rng = random.Random(9)
    rows = [(f"k{i}", "".join(rng.choice("abc \U0001f600é") for _ in range(rng.choice([0, 1, 2, 300])))) for i in range(200)] + [("long", "xy" * 20_000 + "zz"), ("none", None)]
    docs = spark.createDataFrame(rows, "name string, body string")
    path = fulltext.write_index(docs, str(tmp_path / "index"), "name", "body", 4)
    index = fulltext.Index(spark, path, 4)
    places = sum(max(0, len(t or "") - 1) for _, t in rows)
    assert index.postings.agg(F.sum("n")).first()[0] > places and index.postings.count() < places / 10
    for q in ("abca", "xyzz", "yx", "yxyxyxy", "-ab", '"é\U0001f600a"', "aab OR cbb", "-x -a", '"  a" -b'):
        want = sorted(r.name for r in docs.where(search.text_query(F.col("body"), q)).collect())
        assert sorted(r.key for r in index.search(q).collect()) == want, q
