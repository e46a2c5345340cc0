import io
import random
import zipfile

import plain_bills
import pytest
from pyspark.sql import functions as F

from costquarry.operators import boq, evidence, grading, linking, merge, partitioned, pricing, quality, search
from costquarry.sources import archives, office, tables


def table_of(rows):
    return [["Description", "Unit", "Quantity", "Unit Rate", "Amount"], *rows]


def test_priced_table():
    got = plain_bills.table_signals(table_of([["Wall", "m2", "10", "5", "50"], ["Roof", "m2", "4", "2", "8"], ["Door", "no", "3", "7", "21"],
        ["TOTAL", "", "17", "", "79"]]))
    assert [(g["quantity_rows"], g["priced_rows"], g["priced_ratio"]) for g in got] == [(3, 3, 1.0)]


def test_unpriced_table():
    got = plain_bills.table_signals(table_of([["Wall", "m2", "10", "0", ""], ["Roof", "m2", "4", "", "0"], ["Door", "no", "3", None, None]]))
    assert [(g["quantity_rows"], g["priced_rows"]) for g in got] == [(3, 0)]


@pytest.mark.parametrize("matrix", [[], [[]], [["x"]], table_of([["Wall", "m2", "10", "5", "50"]])])
def test_no_table(matrix):
    assert plain_bills.table_signals(matrix) == []


@pytest.mark.parametrize(("text", "expected"), [("cell $F$30 only", []), ("US$ 272,603 paid", ["US$ 272,603"]),
    ("at $ 30.00 each", ["$ 30.00"]), ("", []), (None, None)])
def test_currency_tokens(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(evidence.currency_tokens(F.col("t")).alias("x")).first().x
    assert (got is None) if expected is None else [g.strip() for g in got] == expected


def test_areas_by_nearest_label(spark):
    text = "site area 6,070.35 m2; gross floor area 835.67 m2; painting 12 m2"
    rows = spark.createDataFrame([("b", "f", "l", text, "")],
        "bid_no string, source_file string, source_locator string, evidence_text string, area_mentions string")
    got = {(r.value, r.semantic) for r in evidence.area_observations(rows).collect()}
    assert got == {(6070.35, "SITE_AREA"), (835.67, "GFA"), (12.0, "WORK_ITEM_AREA")}
    assert evidence.best_area(evidence.area_observations(rows)).first().value == 835.67


@pytest.mark.parametrize(
    ("text", "value", "method"),
    [("연면적: 약 1,200㎡", 1200.0, "explicit_gross_floor_area"), ("연면적 10㎡ 연면적 20㎡", None, "multiple_explicit_gross_floor_areas"),
        ("규모 300㎡", 300.0, "single_unlabelled_area"), ("대지 면적 300㎡", None, ""), ("없음", None, "")],
)
def test_gross_floor_area(spark, text, value, method):
    r = spark.range(1).select(evidence.gross_floor_area(F.lit(text)).alias("x")).first().x
    assert (r.value, r.method) == (value, method)


def test_links(spark):
    rec = spark.createDataFrame([(1, "2020-00001", "x", ["가나"]), (2, "", "School of agriculture in the north", ["가나"]), (3, "", "zzz", [])],
        "record_id int, project_no string, title string, countries array<string>")
    off = spark.createDataFrame([("2020-00002", "The school of agriculture in the north project", "가나"),
        ("2020-00003", "Water supply", "네팔")], "project_no string, title string, country string")
    got = {r.record_id: (r.project_no_linked, r.project_link_method) for r in linking.link(rec, off, off.limit(0)).collect()}
    assert got == {1: ("2020-00001", "source_direct"), 2: ("2020-00002", "official_report_title_containment"), 3: (None, None)}


def test_cycles(spark):
    f = spark.createDataFrame([(1, 2), (2, 1), (3, None), (4, 3)], "file_id int, duplicate_of int")
    assert {r.file_id for r in linking.cyclic_parents(f).collect()} == {1, 2}


def test_pricing_needs_both_periods(spark):
    cases = spark.createDataFrame([("a", "X", "2019-03-01", 10.0), ("b", "Y", "2019-03-01", 10.0)],
        "bid_no string, country string, notice_date string, unit_usd_m2_nominal double")
    src = spark.createDataFrame([("s1", "X", "XXX", 2, True, "annual", "price"), ("s2", "X", "XXX", 1, False, "annual", "price"),
        ("fx", "X", "XXX", None, False, "annual", "official_exchange_rate")],
        "source_id string, country string, iso3 string, priority int, construction_specific boolean, frequency string, index_class string")
    val = spark.createDataFrame([("s1", "2019", 100.0, True), ("s1", "2021", 110.0, True), ("s2", "2019", 100.0, True),
        ("s2", "2021", 120.0, False), ("fx", "2019", 2.0, True), ("fx", "2021", 4.0, True)], "source_id string, period string, value double, is_actual boolean")
    got = {r.bid_no: r for r in pricing.normalize(cases, src, val, "2021-12-31", True).collect()}
    assert got["a"].source_id == "s1" and got["a"].status == pricing.SCENARIO and abs(got["a"].adjusted_unit_usd_m2 - 10 * 1.1 * 0.5) < 1e-9
    assert got["b"].status == pricing.NO_INDEX and got["b"].adjusted_unit_usd_m2 is None
    unsure = {r.bid_no: r for r in pricing.normalize(cases, src, val, "2021-12-31").collect()}
    assert unsure["a"].status == pricing.UNCONFIRMED and unsure["a"].adjusted_unit_usd_m2 is None


def test_no_unit_cost_without_scope(spark, sf_dir):
    from costquarry.plans import queries

    bad = queries.notice_grades(spark,
        sf_dir).where("final_grade in ('U', 'X') and selected_construction_cost_usd is not null and selected_area_m2 is not null and same_scope_status = 'MATCH'")
    assert bad.count() == 0


@pytest.mark.parametrize(("n", "default", "most", "expected"), [(None, 10, 50, 10), (0, 10, 50, 1), (99, 10, 50, 50), (7, 20, 100, 7)])
def test_clamp(n, default, most, expected):
    assert search.clamp(n, default, most) == expected


@pytest.mark.parametrize(("query", "hits"), [("red wall", [1]), ("red OR blue", [1, 2]), ("wall -red", [2]), ('"red wall"', [1]),
    ("", [1, 2, 3]), ("nothing", [])])
def test_text_queries(spark, query, hits):
    df = spark.createDataFrame([(1, "a RED wall"), (2, "blue wall"), (3, None)], "i int, t string")
    assert [r.i for r in df.where(search.text_query(F.col("t"), query)).orderBy("i").collect()] == hits


def test_gate_keeps_the_old_version(spark, tmp_path):
    store = merge.SnapshotStore(spark, f"file://{tmp_path}/store")
    with pytest.raises(FileNotFoundError):
        store.read("cases")
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    store.publish({"cases": first}, {"repeated": quality.unique(first, "id")})
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(quality.QualityError):
        store.publish({"cases": twice}, {"repeated": quality.unique(twice, "id")})
    assert [tuple(r) for r in store.read("cases").collect()] == [(1, "a")]


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", True)], "id int, v string, is_published boolean")
    new = spark.createDataFrame([(2, "b", None), (3, "c", False)], "id int, v string, is_published boolean")
    once = merge.merge(old, new, ["id"])
    assert sorted(map(tuple, merge.merge(once, new, ["id"]).collect())) == sorted(map(tuple, once.collect())) == [(2, "b", True), (3, "c", False)]


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in files.items():
            z.writestr(name.replace("__", "/"), content)
    return out.getvalue()


def test_nested_archives():
    inner = zipped(**{"deep.txt": "x"})
    got = list(archives.unpack("r.zip", zipped(**{"a.txt": "1", "in.zip": inner, "../bad.txt": "no"})))
    assert {(p, d) for p, d, _, e in got if not e} == {("a.txt", 0), ("in.zip", 0), ("in.zip!/deep.txt", 1)}
    assert [e for _, _, _, e in got if e] == ["unsafe path"]
    assert [e for *_, e in archives.unpack("r.zip", b"not a zip")][0].startswith("BadZipFile")
    assert any("exceeds" in e for *_, e in archives.unpack("r.zip", zipped(a="1", b="2"), archives.Limits(members=1)))


def test_workbook_rows():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    raw = zipped(**{
        "xl__workbook.xml": f'<workbook {ns}><sheets><sheet name="Sheet" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl___rels__workbook.xml.rels": '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl__worksheets__sheet1.xml": f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>BOQ</t></is></c><c r="B1"><v>12</v></c><c r="C1"><f>B1*2</f><v>24</v></c></row></sheetData></worksheet>',
    })
    assert list(office.xlsx(raw)) == [("Sheet!1", "A1=BOQ | B1=12 | C1==B1*2")]


def test_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("이름,값\n가나,1\n".encode("cp949"))
    got = tables.read_csv_any_encoding(spark, f"file://{tmp_path}/a.csv", ["이름"]).collect()
    assert [(r.encoding, r.values) for r in got] == [("cp949", {"이름": "가나", "값": "1"})]
    with pytest.raises(Exception, match="lacks"):
        tables.read_csv_any_encoding(spark, f"file://{tmp_path}/a.csv", ["x"]).collect()


def test_changed_archives_are_read_again(spark, tmp_path):
    import os
    import zipfile

    from costquarry.streaming.markers import WatchedFiles, list_files, members_of_changed

    source = f"{tmp_path}/in"
    os.makedirs(source)

    def write(name, members, at):
        with zipfile.ZipFile(f"{source}/{name}", "w") as z:
            for member, text in members.items():
                z.writestr(member, text)
        os.utime(f"{source}/{name}", (at, at))

    def update(watched):
        watched.update(list_files(spark, source), members_of_changed(spark, source))

    def members(watched):
        return sorted((r.path.rsplit("/")[-1], r.member, bytes(r.content)) for r in watched.results().collect())

    def handed(watched):
        return sorted((r.run, r.path.rsplit("/")[-1], r.action) for r in watched.changed().collect())

    write("a.zip", {"x": "1"}, 1000)
    write("b.zip", {"y": "2"}, 1000)
    watched = WatchedFiles(spark, f"file://{tmp_path}/state")
    update(watched)
    assert members(watched) == [("a.zip", "x", b"1"), ("b.zip", "y", b"2")]
    write("b.zip", {"z": "3"}, 2000)  # as many bytes as before, at another time
    write("c.zip", {}, 1000)
    update(watched)
    assert members(watched) == [("a.zip", "x", b"1"), ("b.zip", "z", b"3")]
    update(watched)
    expected = [(1, "a.zip", "new"), (1, "b.zip", "new"), (2, "b.zip", "changed"), (2, "c.zip", "new")]
    assert handed(watched) == expected

    def broken(changed):
        raise RuntimeError("no")

    write("a.zip", {"x": "back"}, 3000)
    with pytest.raises(Exception, match="no"):
        watched.update(list_files(spark, source), broken)
    later = WatchedFiles(spark, watched.path, version="2")
    update(watched)
    assert handed(watched)[len(expected):] == [(4, "a.zip", "changed")]
    assert members(watched) == [("a.zip", "x", b"back"), ("b.zip", "z", b"3")]
    update(later)
    assert [x for x in handed(watched) if x[2] == "version"] == [(6, f"{n}.zip", "version") for n in "abc"]


def test_incremental_collection(spark, tmp_path):
    from costquarry.streaming.incremental import collect_incrementally

    src, out, check = (f"file://{tmp_path}/{n}" for n in ("src", "out", "check"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    first.write.parquet(src)
    collect_incrementally(spark, src, first.schema, out, check, "id").awaitTermination()
    spark.createDataFrame([(2, "again"), (3, "c")], "id int, v string").write.mode("append").parquet(src)
    collect_incrementally(spark, src, first.schema, out, check, "id").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_packages_are_reproducible():
    from costquarry.sources import files

    a, manifest = files.package({"b": b"2", "a": b"1"})
    assert a == files.package({"a": b"1", "b": b"2"})[0] and [m["path"] for m in manifest] == ["a", "b"]
    assert files.canonical_digest({"b": 1, "a": [2]}) == files.canonical_digest({"a": [2], "b": 1})
    assert files.choose_source("x", ["x", "z"]) == "x" and files.choose_source("y", ["x", "z"]) == "z" and files.choose_source(None, []) is None


def test_sqlite_and_pages(spark, tmp_path):
    import sqlite3

    from costquarry.sources import files

    db = sqlite3.connect(tmp_path / "a.db")
    db.execute("CREATE TABLE t (id INTEGER, v TEXT)")
    db.executemany("INSERT INTO t VALUES (?, ?)", [(1, "a"), (2, None)])
    db.commit()
    db.close()
    got = files.read_sqlite(spark, f"file://{tmp_path}/a.db", "SELECT id, v FROM t ORDER BY id", "id long, v string").collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, None)]
    (tmp_path / "doc1").mkdir()
    for i in (1, 3):
        (tmp_path / "doc1" / f"page-{i:03}.txt").write_text(f"text {i}")
    pages = files.read_page_texts(spark, f"file://{tmp_path}/doc1")
    docs = spark.createDataFrame([("doc1", 3), ("doc2", 0)], "document string, page_count int")
    assert {(r.document, r.page) for r in pages.collect()} == {("doc1", 1), ("doc1", 3)}
    assert [r.document for r in files.incomplete_pages(pages, docs).collect()] == ["doc1"]
    assert files.page_digests(pages).count() == 1


def test_fragments_and_records(spark):
    from costquarry.sources import files

    a, b = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(2,)], "id int")
    assert files.merge_fragments(a, b, keys=["id"]).count() == 2
    with pytest.raises(quality.QualityError):
        files.merge_fragments(a, a, keys=["id"])
    j = spark.createDataFrame([(7, '[{"k": "a", "n": 1}, {"k": "b"}]')], "id int, doc string")
    assert sorted(map(tuple, files.unpack_records(j, "doc", "k string, n int").collect())) == [(7, "a", 1), (7, "b", None)]


def test_locators_and_fees(spark):
    rows = spark.createDataFrame([("b", "c1", "f", "p2", "t2"), ("b", "c1", "f", "p1", "t1")],
        "bid_no string, category string, source_file string, source_locator string, evidence_text string")
    cases = spark.createDataFrame([("b", "c1", "p2"), ("b", "c9", "p9"), ("z", "c1", "p1")], "bid_no string, category string, source_locator string")
    got = {(r.bid_no, r.category): (r.evidence.evidence_text if r.evidence else None, r.is_exact) for r in evidence.locate(cases, rows).collect()}
    assert got == {("b", "c1"): ("t2", True), ("b", "c9"): ("t1", False), ("z", "c1"): (None, False)}
    f = pricing.fee_rates(spark.createDataFrame([(100.0, 1000.0, 50.0, None)],
        "gross_floor_area_m2 double, construction_cost_usd double, design_fee_usd double, supervision_fee_usd double")).first()
    assert (f.design_rate, f.supervision_rate, f.combined_rate, f.combined_fee_usd_m2) == (0.05, None, 0.05, 0.5)


def test_finding_checks(spark):
    finds = spark.createDataFrame([(1, 9, 1, 2, "cost 1,200 USD", 1200.0, "USD"), (2, 9, 3, 3, "nowhere", 5.0, "stone")],
        "finding_id int, report_id int, pdf_page_start int, pdf_page_end int, evidence_excerpt string, value_numeric double, unit string")
    pages = spark.createDataFrame([(9, 2, "the cost  1,200 USD was"), (9, 3, "other")], "report_id int, page int, text string")
    assert {tuple(r) for r in linking.finding_violations(finds, pages, ["USD"]).collect()} == {(2, "excerpt not on pages"),
        (2, "value not in excerpt"), (2, "unit")}


def test_grades(spark):
    rows = [("WORKS", "MATCH", 10.0, 5.0, True, None), ("WORKS", "MATCH", 10.0, 5.0, False, None),
        ("GOODS", "NO_MATCH", None, None, False, None), ("WORKS", "NO_MATCH", None, None, False, None),
        ("WORKS", "PARTIAL_SCOPE", 10.0, 5.0, True, None), ("WORKS", "MATCH", None, None, False, "A-부분"), ("OTHER_SERVICE", "MATCH", 1.0, None, False, None)]
    df = spark.createDataFrame(rows, "role string, scope string, area double, cost double, seen boolean, strict string").withColumn("i",
        F.monotonically_increasing_id())
    g = df.withColumn("g", grading.final_grade(*map(F.col, ("role", "scope", "area", "cost", "seen", "strict")))).orderBy("i").collect()
    assert [r.g.grade for r in g] == ["C", "C?", "X", "U", "C-부분", "A-부분", "X"]


def test_sql_surface(spark):
    from costquarry.plans import views

    cases = spark.createDataFrame([("1", "a", True), ("2", "b", False)], "case_id string, display_name string, is_published boolean")
    files = spark.createDataFrame([("x", 1), ("x", 2), ("", 3), (None, 4)], "sha256 string, bytes long")
    sources = spark.createDataFrame([("s", "X", 1), ("n", "X", None), ("e", "Y", 2)], "source_id string, country string, priority int")
    values = spark.createDataFrame([("s", "2019", 1.0, True, "final", "d"), ("s", "2020", 1.0, True, "early", "d"),
        ("s", "2021", 1.0, False, "late", "d")],
        "source_id string, period string, value double, is_actual boolean, observation_status string, retrieved_at string")
    made = views.register(spark, {"cases": cases, "attachments": files, "price_index_sources": sources, "price_index_values": values})
    assert set(made) == {"v_duplicate_attachments", "v_price_index_coverage", "v_best_available_price_index", "public_cases", "cases_of"}
    assert [tuple(r) for r in spark.sql("SELECT * FROM v_duplicate_attachments").collect()] == [("x", 2, 3)]
    assert [tuple(r) for r in spark.sql("SELECT display_name FROM cases_of('1')").collect()] == [("a",)]
    assert spark.sql("SELECT * FROM cases_of('2')").count() == 0
    got = {r.source_id: (r.actual_observation_count, r.latest_observation_status) for r in spark.sql("SELECT * FROM v_price_index_coverage").collect()}
    assert got == {"s": (2, "early"), "e": (0, None)}
    assert [r.source_id for r in spark.sql("SELECT * FROM v_best_available_price_index").collect()] == ["s"]


def plain_links(records, candidates, least=0.82):
    """Best project, score and second by comparing each record (id, title, countries) with each candidate (project, title, country)."""
    from costquarry.operators.titles import title_score

    out, known = {}, {}
    for i, title, countries in records:
        scores = {}
        for project, other, country in candidates:
            if not countries or not country or country in countries:
                if (title, other) not in known:
                    known[title, other] = title_score(title, other)
                scores[project] = max(scores.get(project, 0.0), known[title, other])
        best = sorted((-s, p) for p, s in scores.items() if s >= least)[:2]
        if best:
            out[i] = (best[0][1], round(-best[0][0], 9), round(-best[1][0], 9) if len(best) > 1 else None)
    return out


def told(df):
    return {r.record_id: (r.project_no, round(r.score, 9), None if r.second is None else round(r.second, 9)) for r in df.collect()}


def plain_title(x):
    return "".join(ch for ch in (x or "").lower() if ch.isascii() and ch.isalnum() or "가" <= ch <= "힣")


def test_title_link_equals_plain_loops(spark, sf_dir):
    """Every record against every candidate of its country, by the standard library's matcher: titles of parts, then names of clients."""
    from costquarry.plans import catalog

    parts = spark.read.parquet(f"{sf_dir}/part.parquet").collect()
    clients = spark.read.parquet(f"{sf_dir}/clients.parquet").collect()
    nation = lambda r: "" if r.nation_id is None else str(r.nation_id)
    for name, rec, cand in (
        ("title_link", [(r.p_partkey, plain_title(f"{r.p_name} of the {r.p_brand}"), [r.p_type]) for r in parts],
            [(str(r.p_partkey), plain_title(f"{r.p_name} of the brand"), r.p_type) for r in parts]),
        ("client_links", [(r.client_id, plain_title(r.name), [nation(r)] if nation(r) else []) for r in clients if r.source == "web"],
            [(str(r.client_id), plain_title(r.name), nation(r)) for r in clients if r.source not in (None, "web")]),
    ):
        want = {}
        for i, (project, best, second) in plain_links(rec, cand).items():
            gap = best - (second or 0.0)
            method = "official_report_title_containment" if best >= 0.98 and gap > 0.005 else "official_report_title_fuzzy" if best >= 0.86 and gap >= 0.04 else None
            want[i] = (project if method else None, method, best)
        got = {r.record_id: (r.project_no, r.method, round(r.score, 9)) for r in catalog.QUERIES[name](spark, sf_dir).collect()}
        assert got == want and any(m for _, m, _ in got.values()) and any(m is None for _, m, _ in got.values())


def test_titles_lose_no_pair(spark):
    """Random titles of few letters, near the least score and below, with nulls, blanks, single letters, repeats and several titles of a project."""
    import random

    from costquarry.operators import titles

    rng = random.Random(6)
    words = ["school", "hospital", "road", "water", "training", "centre", "a", "가나", "병원", "건립", "o"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 5)))
    base = [text() for _ in range(60)]
    changed = lambda x: "".join(rng.choice("abx가") if rng.random() < 0.12 else ch for ch in x if rng.random() > 0.06)
    rec = [(i, changed(rng.choice(base)), rng.choice([[], ["K"], ["K", "L"], ["M", ""], None])) for i in range(150)] + [(900, None, ["K"]), (901, "", []), (902, "o", [])]
    cand = [(f"p{i % 90}", changed(rng.choice(base)), rng.choice(["", "K", "L", None])) for i in range(200)] + [("q", None, "K"), ("r", "O", ""), ("s", "o", "K"), ("t", "o", "K")]
    r = spark.createDataFrame([(*x, "clash") for x in rec], "record_id int, title string, countries array<string>, score string")
    c = spark.createDataFrame(cand, "project_no string, title string, country string")
    clean = lambda cs: [x for x in cs or [] if x]
    want = plain_links([(i, plain_title(t), clean(cs)) for i, t, cs in rec], [(p, plain_title(t), k or "") for p, t, k in cand])
    assert told(titles.score_titles(r, c)) == want and len(want) > 40
    want = plain_links([(i, plain_title(t), clean(cs)) for i, t, cs in rec], [(p, plain_title(t), k or "") for p, t, k in cand], 0.7)
    assert told(titles.score_titles(r, c, least=0.7)) == want
    assert titles.score_titles(r.limit(0), c).count() == 0 and titles.score_titles(r, c.limit(0)).count() == 0
    with pytest.raises(ValueError):
        titles.score_titles(r, c, least=0.5)


def test_links_read_no_list_on_the_driver(spark, sf_dir):
    """More candidates than any list held before: pairs are joined."""
    from costquarry.operators import titles

    cand = spark.range(60_000).select(F.col("id").cast("string").alias("project_no"), F.md5(F.col("id").cast("string")).alias("title"), F.lit("K").alias("country"))
    rec = cand.where("project_no % 20000 = 7").select(F.col("project_no").cast("int").alias("record_id"), F.concat("title", F.lit("x")).alias("title"), F.array("country").alias("countries"))
    got = told(titles.score_titles(rec, cand))
    assert {i: (p, s) for i, (p, s, _) in got.items()} == {i: (str(i), 0.99) for i in (7, 20007, 40007)}


def test_markers_equal_plain_search(spark):
    import random

    from costquarry.operators import titles

    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abAB 가é\n") for _ in range(n))
    markers = [(rng.choice("xyz"), text(rng.randint(1, 6))) for _ in range(300)] + [("none", ""), ("none", None), ("n", "absent marker")]
    rows = [(i % 40, text(rng.randint(0, 30))) for i in range(200)] + [(1, None), (2, ""), (2, "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k int, text string, label string")
    got = titles.longest_marker(df, "text", spark.createDataFrame(markers, "label string, marker string"), "hit").collect()
    want = []
    for k, t in rows:
        hit = sorted((-len(m), label) for label, m in markers if m and m.lower() in (t or "").lower())
        want.append((k, t, "clash", hit[0][1] if hit else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    many = spark.range(200_000).select(F.concat(F.lit("L"), F.col("id")).alias("label"), F.md5(F.col("id").cast("string")).alias("marker"))
    one = spark.createDataFrame([(1, "x" + __import__("hashlib").md5(b"123456").hexdigest())], "k int, text string")
    assert [r.hit for r in titles.longest_marker(one, "text", many, "hit").collect()] == ["L123456"]


def test_areas_are_found_in_linear_time_and_place(spark):
    """What stands around each area is the text's, also across blocks and beyond the longest window; four times the areas take about four times as long."""
    import re
    import time

    text = lambda n: " ".join(f"plot {i} 가나 gross floor area: {i + 20} m2;" + " " * (i % 7) + "x" * (i % 90) for i in range(n))
    t = text(60) + " 77 " + " " * 1500 + "m2 end"
    got = evidence.with_spans(spark.createDataFrame([(t,), ("",), (None,), ("no area",)], "t string"), "t", evidence.AREA_UNIT).select("t", F.inline("_m")).collect()
    want = [(m[1], t[max(0, m.start() - 140) : m.start()], t[max(0, m.start() - 140) : m.end() + 70]) for m in re.finditer(evidence.AREA_UNIT, t)]
    assert [(r.raw, r.before, r.local) for r in got] == want and len(want) == 61
    took = []
    for n in (800, 800, 3200):
        df = spark.createDataFrame([("b", "f", "l", text(n), "")], "bid_no string, source_file string, source_locator string, evidence_text string, area_mentions string")
        begin = time.time()
        assert evidence.area_observations(df).count() == n
        took.append(time.time() - begin)
    assert took[2] < 5 * took[1] + 3


def test_index_equals_scan(spark, tmp_path):
    import random

    from costquarry.operators import fulltext

    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["ab", "Ba", " ", "가나", "\U0001f600", "c", "\n", "ß", "İ"]) for _ in range(rng.randint(0, 12)))) for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    index = fulltext.Index(spark, fulltext.write_index(docs, str(tmp_path / "index"), buckets=16), 16)
    for q in ("ab", "AB ba", '"b a"', "-ab", "ab -ba", "ab OR c", "c -ab OR 가나", "-ab -c", "가나", "\U0001f600", "ß", "c", "-c", '""', "OR ab", "zz", "zz OR ab", "-zz", "abba", '"가나 "', "-", None, " ", '"ab', "İ"):
        want = {r.doc_id for r in docs.where(search.text_query(F.col("text"), q)).collect()}
        got = [r.key for r in index.search(q).collect()]
        assert len(got) == len(set(got)) and set(got) == want, q
    plan = index.search("abba")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(bucket") == plan.count("FileScan parquet") == 2


def test_long_chains_are_no_cycles(spark):
    rows = [(i, i + 1) for i in range(99)] + [(99, None), (200, 201), (201, 200), (202, 200)]
    assert {r.file_id for r in linking.cyclic_parents(spark.createDataFrame(rows, "file_id int, duplicate_of int")).collect()} == {200, 201, 202}


def test_merge_refuses_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(quality.QualityError):
        merge.merge(old, spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string"), ["id"])


def test_second_table_begins_behind_the_first():
    rows = table_of([["Wall", "m2", "10", "5", "50"], ["Roof", "m2", "4", "2", "8"], ["Door", "no", "3", "7", "21"]])
    got = plain_bills.table_signals([*rows, *([[None] * 5] * 26), *rows])
    assert [(g["header_row"], g["quantity_rows"], g["description_columns"], g["quantity_columns"]) for g in got] == [(1, 3, "A", "C"),
        (29, 3, "A", "C")]  # headers are joined over three rows
    # A header without items doesn't hide the next one.
    assert [g["header_row"] for g in plain_bills.table_signals([["Quantity", "Description"], ["", ""], ["", ""], *rows])] == [2]


def test_workbooks_are_written_and_read():
    book = office.write_xlsx({"A & B": [["x", 1, 2.5, None, "=SUM(B1:C1)"]], "Two": []})
    assert [(n, m, f) for n, _, m, f in office.sheets(book)] == [("A & B", [["x", "1", "2.5", "", ""]], {"E1": "=SUM(B1:C1)"}), ("Two", [], {})]
    assert book == office.write_xlsx({"A & B": [["x", 1, 2.5, None, "=SUM(B1:C1)"]], "Two": []})


@pytest.mark.parametrize(("text", "pattern", "fits"), [("a.txt", "*.txt", True), ("a.txt", "?.txt", True), ("ab.txt", "?.txt", False),
    ("b1", "[a-c][0-9]", True), ("d1", "[^a-c]1", True), ("a+b", "a+b", True), ("aab", "a+b", False), ("[x", "[x", True)])
def test_globs(spark, text, pattern, fits):
    from costquarry.functions import scalars

    assert spark.range(1).select(scalars.glob(F.lit(text), pattern).alias("x")).first().x is fits


def test_partitioned_merge(spark, tmp_path):
    table = partitioned.PartitionedTable(spark, f"file://{tmp_path}/t", ["id", "k"], parts=8)
    with pytest.raises(FileNotFoundError):
        table.read()
    frame = lambda rows: spark.createDataFrame(rows, "id long, k string, v string, w int")
    base = [(i, None if i < 0 else str(i % 3), f"v{i}", i) for i in range(60)]
    total = lambda d: tuple(d.agg(*(F.sum(a) for a in partitioned.ACTIONS)).first())
    assert total(table.merge(frame(base), "2024-01-01")) == (60, 0, 0, 0)
    names = lambda: {f for f in (tmp_path / "t" / "rows").rglob("*.parquet")}
    before = names()
    # The same rows again: no file is written. A changed row: the files of its part alone.
    assert total(table.merge(frame(base), "2024-01-02")) == (0, 0, 60, 0) and names() == before
    assert total(table.merge(frame([(0, "0", None, None), *base[1:]]), "2024-01-03")) == (0, 1, 59, 0)
    assert len({f.parent for f in names() ^ before}) == 1
    got = {r["id"]: r for r in table.read().collect()}
    assert len(got) == 60 and got[0]["v"] is None and str(got[0]["synced_at"])[:10] == "2024-01-03" and str(got[1]["synced_at"])[:10] == "2024-01-01"
    # Columns that are not there keep their values; columns that the table lacks are left out.
    assert total(table.merge(frame(base).drop("w").withColumn("other", F.lit(1)), "2024-01-04")) == (0, 1, 59, 0)
    assert {r["id"]: r["w"] for r in table.read().collect()} == {0: None, **{i: i for i in range(1, 60)}}
    for bad in ([*base, base[0]], [*base, (None, "1", "v", 1)]):
        with pytest.raises(quality.QualityError):
            table.merge(frame(bad))
        assert table.read().count() == 60
    with pytest.raises(ValueError, match="_digest"):
        table.merge(frame(base).withColumn("_digest", F.lit(1)))
    # Parts whose keys all go are removed.
    assert total(table.merge(frame(base[:2]), "2024-01-05")) == (0, 1, 1, 58)
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1] and len({f.parent for f in names()}) <= 2
    assert total(table.merge(frame([]), "2024-01-06")) == (0, 0, 0, 2) and table.read().count() == 0
    assert total(table.merge(frame(base[:3]), "2024-01-07")) == (3, 0, 0, 0) and table.read().count() == 3


def test_bills_equal_a_loop_over_rows(spark):
    rng = random.Random(5)
    words = ["Description", "Item description", "Qty", "수량", "Unit", "ед.", "Unit Rate", "Amount", "Wall", "TOTAL", "sub total 2", "Total", "", "", "  ", None,
        "3", "1,200.5", "-4", "+7", "0", "12a", "\u00a0", "Кол", "количеств", "UNIT", "quantity\n(m2)", "totally"]
    sheets = [[], [[]], [[None] * 3] * 4, [None, ["Quantity", "Description"], None]]
    for _ in range(120):
        width = rng.choice([2, 4, 6, 30])
        head = ["Description", "Unit", "Quantity", "Rate", "Amount"] + [""] * (width - 5)
        rows = []
        for _ in range(rng.randrange(1, 90)):
            kind = rng.random()
            if kind < 0.05:
                rows.append(rng.sample(head, len(head)))
            elif kind < 0.12:
                rows += [[rng.choice(["", None, " "])] * width] * rng.choice([3, 24, 25, 26, 40])
            elif kind < 0.6:
                rows.append(["Wall", "m2", rng.choice(["3", "4.5", "x", "0"]), rng.choice(["", "2"]), rng.choice(["9", None])])
            else:
                rows.append([rng.choice(words) for _ in range(rng.randrange(0, width + 2))])
        sheets.append(rows)
    long = [["Qty", "Description"], *[["1", "a"]] * 2100]
    sheets += [long, [["x"]] * 249 + long, [["x"]] * 250 + long, [*[["1", "a"]] * 3, *long[:5]]]
    df = spark.createDataFrame(list(enumerate(sheets)), "sheet_id int, cells array<array<string>>")
    found = boq.find_tables(df)
    got = sorted((r["sheet_id"], *(r[c] for c in found.columns[2:])) for r in found.collect())
    plain = [{"sheet_id": i, **s} for i, m in enumerate(sheets) for s in plain_bills.table_signals([r or [] for r in m])]
    assert got == sorted((s["sheet_id"], *(s[c] for c in found.columns[2:])) for s in plain) and len(got) > 60
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert boq.find_tables(df.limit(0)).count() == 0


def _rules():
    col = F.col
    child = quality.Rules({"a": col("a") > 0, "b": col("b").isin("x", "y"), "c": col("a") < col("c"), "d": col("c").isNotNull()},
        unique={"id": ("id",), "pair": ("a", "b")}, foreign={"parent": (("p",), "parent", ("id",)), "self": (("p",), "child", ("id",)),
            "two": (("p", "b"), "parent", ("id", "kind"))}, least=2)
    return {"child": child, "parent": quality.Rules(unique={"id": ("id",)}, most=3)}


def test_gate_of_ten_checks_reads_a_table_twice(spark, tmp_path):
    child = spark.createDataFrame([(1, 1, "x", 5, 1), (2, 0, "z", None, 9), (2, 3, "y", 1, 2), (None, None, None, None, None), (None, 1, "x", 2, None),
        (3, 1, "x", 2, 2)], "id int, a int, b string, c int, p int")
    parent = spark.createDataFrame([(1, "x"), (2, "q"), (2, "y"), (4, None)], "id long, kind string")
    found = {(r["table"], r["name"]): r["n"] for r in quality.check_tables({"child": child, "parent": parent}, _rules()).collect()}
    assert found == {("child", "a"): 1, ("child", "b"): 1, ("child", "c"): 1, ("child", "d"): 2, ("child", "number of rows"): 0, ("child", "id"): 2,
        ("child", "pair"): 1, ("child", "parent"): 1, ("child", "self"): 1, ("child", "two"): 2, ("parent", "id"): 1, ("parent", "number of rows"): 1}
    written = quality.write_checked({"child": child, "parent": parent}, f"file://{tmp_path}/w", _rules())
    assert written == {f"{t}: {n}": c for (t, n), c in found.items()}
    tables_ = {n: spark.read.parquet(f"file://{tmp_path}/w/{n}") for n in ("child", "parent")}
    plan = quality.check_tables(tables_, _rules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4
    # Empty tables have counts too.
    empty = quality.check_tables({n: df.limit(0) for n, df in tables_.items()}, _rules())
    assert {r["name"]: r["n"] for r in empty.where("n > 0").collect()} == {"number of rows": 1} and empty.count() == 12
    with pytest.raises(quality.QualityError) as e:
        quality.gate_tables(tables_, _rules())
    assert e.value.counts["child: id"] == 2 and "child: number of rows" not in e.value.counts


def test_publishing_checks_rules_as_it_writes(spark, tmp_path):
    store = merge.SnapshotStore(spark, f"file://{tmp_path}/store")
    rules = {"t": quality.Rules({"positive": F.col("a") > 0}, unique={"key": ("k",)})}
    good = spark.createDataFrame([(1, 1), (2, 2)], "k int, a int")
    version = store.publish({"t": good}, rules=rules)
    for bad, name in (((3, -1), "t: positive"), ((1, 5), "t: key")):
        with pytest.raises(quality.QualityError) as e:
            store.publish({"t": good.union(spark.createDataFrame([bad], good.schema))}, rules=rules)
        assert e.value.counts == {name: 1} and store.version() == version
    assert store.read("t").count() == 2


def test_snapshots_of_any_size_go_through_where_no_payload_bounds_them(spark, tmp_path):
    cases = spark.range(10_001).select(F.col("id").cast("string").alias("case_id"), F.lit("A").alias("evidence_grade"), F.lit("CONSTRUCTION_NOTICE").alias("case_kind"),
        F.lit(1.0).alias("gross_floor_area_m2"), F.lit(1.0).alias("construction_cost_usd"))
    one = lambda **values: spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    parts = {"cases": cases, "related_notices": cases.select("case_id", F.lit("n").alias("related_bid_base_no")), "evaluation_projects": one(project_no="p"),
        "evaluation_reports": one(report_id="r", page_count=9), "evaluation_matches": one(match_id=1, project_no="p", report_id="r", match_score=0.9),
        "evaluation_findings": one(finding_id=1, match_id=1, pdf_page_start=1, pdf_page_end=2, value_numeric=1.0, unit="USD")}
    store, identity = merge.SnapshotStore(spark, str(tmp_path / "store")), {k: "1" for k in merge.IDENTITY}
    with pytest.raises(quality.QualityError, match="cases: number of rows"):
        merge.sync(store, parts, identity)
    assert len(merge.sync(store, parts, identity, limits={})) == 2 and store.read("cases").count() == 10_001


def test_sheets_are_read_to_their_ends_on_demand(spark):
    long = [["Qty", "Description", "Rate"], *[["1", "a", "2"]] * 2100, *[["", None]] * 25, ["1", "b", "2"]]
    df = spark.createDataFrame([(1, long)], "sheet_id int, cells array<array<string>>")
    got = lambda **how: [(r.quantity_rows, r.priced_rows) for r in boq.find_tables(df, **how).collect()]
    assert got() == [(2000, 2000)] and got(body_rows=None) == [(2100, 2100)]
    # The width of a sheet is no expression over all its cells beside the generator, where each row would count it anew.
    assert "array_max" not in str(boq.sheet_rows(df.withColumn("sheet_state", F.lit("visible")))._jdf.queryExecution().optimizedPlan()).split("Generate")[0]


def test_bill_tables_are_found_in_all_rows_of_parts(spark, tmp_path):
    """Parts without a brand are a sheet, and a bill may begin in any row of one."""
    from costquarry.plans.catalog import QUERIES

    named = [(i, "bolt", None if i < 8 else "Brand#1", 3) for i in range(1, 13)]
    behind = [(1000 + i, "bolt", "Brand#2", 0) for i in range(300)] + [(1300, "Quantity Description", "Brand#2", 0)] + [(1301 + i, "5", "Brand#2", 0) for i in range(4)]
    df = spark.createDataFrame(named + behind, "p_partkey bigint, p_name string, p_brand string, p_size int")
    df.withColumn("p_retailprice", F.lit(9.5)).write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["bill_table_signals"](spark, str(tmp_path)).select("sheet_id", "header_row", "quantity_rows", "priced_rows", "quantity_columns").collect()
    assert {tuple(r) for r in got} == {(None, 1, 7, 7, "C"), ("Brand#1", 1, 5, 4, "C"), ("Brand#2", 300, 4, 0, "A")} and len(got) == 3


def test_bills_begin_in_any_row_on_demand(spark, monkeypatch):
    table = lambda n, gap: [["Qty", "Description", "Rate"], *[["1", "a", "2"]] * n, *[["", None]] * gap]
    sheets = {None: [["x"]] * 300 + table(4, 25) * 3, "s": table(3, 25) * 40, "t": table(3, 24) * 40, "u": (table(2, 30) + [["Qty", "Unit", "Amount"]] + table(3, 26)) * 20}
    df = spark.createDataFrame(list(sheets.items()), "sheet_id string, cells array<array<string>>")
    for body, head in ((None, None), (None, 250), (40, None), (2, None), (3, 400)):
        monkeypatch.setattr(plain_bills, "BODY_ROWS", body or 10**9)
        monkeypatch.setattr(plain_bills, "HEADER_ROWS", head or 10**9)
        found = boq.find_tables(df, body_rows=body, header_rows=head)
        got = [(str(r["sheet_id"]), *(r[c] for c in found.columns[2:])) for r in found.collect()]
        plain = [(str(i), *({"sheet_id": i, **s}[c] for c in found.columns[2:])) for i, m in sheets.items() for s in plain_bills.table_signals(m)]
        assert sorted(got) == sorted(plain) and (len(got) > 60 or head or body)


def test_scanned_files_counts_all_rows_of_long_sheets(spark, tmp_path):
    from costquarry.plans.catalog import QUERIES

    spark.range(1, 2102).select(F.col("id").alias("p_partkey"), F.lit("bolt").alias("p_name"), F.lit("Brand#1").alias("p_brand"), F.lit("PROMO").alias("p_type"),
        F.lit(3).alias("p_size"), F.lit(9.5).alias("p_retailprice")).write.parquet(f"{tmp_path}/part.parquet")
    assert [tuple(r) for r in QUERIES["scanned_files"](spark, str(tmp_path)).collect()] == [("PROMO", 1, 2101, 1891, True, 2101 * 1000 + 1891)]


def test_rows_of_small_files_share_batches_of_bounded_size(spark):
    import pyarrow as pa

    from costquarry.plans.made import archive_file, made_files
    from costquarry.sources.batches import MOST_BYTES, MOST_ROWS, batched

    schema = pa.schema([("n", pa.int64()), ("content", pa.binary())])
    small = list(batched(((i, b"x") for i in range(2 * MOST_ROWS + 1)), schema))
    assert [b.num_rows for b in small] == [MOST_ROWS, MOST_ROWS, 1]
    assert [b.num_rows for b in batched(((i, bytes(MOST_BYTES // 2)) for i in range(5)), schema)] == [2, 2, 1] and not list(batched(iter([]), schema))
    rows = spark.range(500).coalesce(1).select("id", F.lit("name"), F.lit("segment"))
    made = made_files(rows, archive_file)
    assert made.rdd.getNumPartitions() > 1 and archives.unpack_archives(made).where("path <> 'in.zip'").count() == 800
    assert "MapInPandas" not in archives.unpack_archives(made)._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_of_office_files_share_batches(spark):
    files = spark.createDataFrame([(f"{i}.html", b"<p>a</p>") for i in range(50)] + [("x.xlsx", b"broken"), ("y.bin", b"x")], "path string, content binary").coalesce(1)
    got = office.extract_chunks(files)
    assert got.where("text = 'a'").count() == 50 and got.where("error is not null").count() == 1 and got.count() == 51
    assert "MapInPandas" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_sheets_of_office_files_share_batches(spark):
    raw = office.write_xlsx({"One": [["a", 1], [None, "=1+2"]], "Two": []})
    files = spark.createDataFrame([(f"{i}.xlsx", raw) for i in range(20)] + [("x.xlsx", b"broken")], "path string, content binary").coalesce(1)
    got = office.extract_sheets(files)
    assert got.where("sheet = 'One' and cells[0] = array('a', '1')").count() == 20 and got.where("error is not null").count() == 1 and got.count() == 41
    assert "MapInPandas" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_evidence_of_a_small_file_is_many_tasks(spark):
    chunks = spark.range(40).coalesce(1).select(F.col("id").alias("bid_no"), F.lit("f").alias("source_file"), F.lit("l").alias("locator"), F.lit("floor area 50 m2, VAT 10 %").alias("text"))
    got = evidence.evidence(chunks)
    assert got.rdd.getNumPartitions() > 1 and got.count() == 80


def test_titles_of_a_small_file_are_many_tasks(spark, sf_dir):
    from costquarry.plans.queries import titles

    assert titles(spark, sf_dir).rdd.getNumPartitions() > 1


def test_areas_of_a_text_are_looked_for_once_for_all_its_categories(spark):
    one = ("b", "f", "l", "floor area 50 m2, site area 70 m2", "50 m2 | 70 m2")
    rows = spark.createDataFrame([(*one, c) for c in "xyz"], "bid_no string, source_file string, source_locator string, evidence_text string, area_mentions string, category string")
    got = evidence.area_observations(rows)
    assert sorted((r.value, r.semantic) for r in got.collect()) == [(50.0, "GFA"), (70.0, "SITE_AREA")]
    # An aggregation by text stands under the search for spans, besides that by value above it.
    assert str(got._jdf.queryExecution().optimizedPlan()).split("Generate")[1].count("Aggregate") == 1


def test_occurrences_equal_plain_search_across_blocks(spark):
    from costquarry.operators.occurrences import BLOCK, occurrences

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abé가 ") for _ in range(n))
    texts = [(i, rng.choice("st"), word(rng.choice([0, 5, 40, 3 * BLOCK]))) for i in range(30)] + [(30, "s", None), (31, "s", "")]
    cuts = [(s, t[k : k + rng.randint(1, 60)]) for _, s, t in texts if t for k in (0, len(t) // 2, *(b - 20 for b in (BLOCK, 2 * BLOCK) if b < len(t)))]
    markers = [*cuts, *(("s" if s == "t" else "t", m) for s, m in cuts), ("s", "absent marker, of more bytes than a window"), ("s", ""), ("t", None), (None, "a")]
    got = occurrences(spark.createDataFrame(texts, "id long, scope string, text string"), spark.createDataFrame(markers, "scope string, marker string"))
    want = {(i, s, m) for i, s, t in texts if t for c, m in markers if c == s and m and m in t}
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100
    assert occurrences(spark.createDataFrame(texts, "id long, scope string, text string"), spark.createDataFrame([], "scope string, marker string")).count() == 0


def test_findings_are_held_against_their_pages_by_windows(spark):
    finds = spark.createDataFrame([(1, 1, 2, 3, "the price  is 5", 5.0, "USD"), (2, 1, 2, 3, "", None, None), (3, 1, 8, 9, "", None, None), (4, 2, 2, 3, "the price is 5", 5.0, "USD"),
        (5, 1, 4, 9, "the price is 5", 5.0, "USD"), (6, None, 2, 3, "the price is 5", 5.0, "USD"), (7, 1, 2, 3, None, None, None)],
        "finding_id int, report_id int, pdf_page_start int, pdf_page_end int, evidence_excerpt string, value_numeric double, unit string")
    pages = spark.createDataFrame([(1, 3, "here the price is\n 5 of all"), (1, 2, None), (2, 9, "the price is 5"), (None, 2, "the price is 5")], "report_id int, page int, text string")
    got = linking.finding_violations(finds, pages, ["USD"])
    assert sorted(map(tuple, got.collect())) == [(k, "excerpt not on pages") for k in (3, 4, 5, 6)]
    # A page's text and an excerpt meet in blocks that hold a window of the excerpt, never as such.
    assert "Contains(_text" not in str(got._jdf.queryExecution().optimizedPlan()) and "Contains(piece" in str(got._jdf.queryExecution().optimizedPlan())


def test_matches_are_named_in_their_reports_texts(spark):
    matches = spark.createDataFrame([(1, 1, "accepted", 0.9, "Big SCHOOL"), (2, 1, "accepted", 0.9, "other"), (3, 2, "accepted", 0.9, "big school"), (4, 3, "accepted", 0.9, "x"),
        (5, 1, "accepted", 0.9, None), (6, 1, "accepted", 0.9, ""), (7, 1, "rejected", 0.1, "y")], "match_id int, report_id int, review_status string, match_score double, report_project_name string")
    reports = spark.createDataFrame([(1, "a big school here", True), (2, "a school", True), (3, None, True), (2, "big  school", True)], "report_id int, text string, multi_project boolean")
    got = linking.match_violations(matches, reports)
    assert sorted(map(tuple, got.collect())) == [(2, "name not in report"), (3, "name not in report"), (3, "name not in report")]
    # No match is held against a whole text.
    assert "Contains(piece" in str(got._jdf.queryExecution().optimizedPlan())


def test_scenario_lines_are_not_gathered_by_sheet(spark, sf_dir):
    from costquarry.plans.catalog import QUERIES

    plan = str(QUERIES["scenario_quantities"](spark, sf_dir)._jdf.queryExecution().executedPlan())
    assert "SortMergeJoin" not in plan and "hashpartitioning(sheet" not in plan


def test_packages_follow_each_other_in_a_task(spark):
    from costquarry.sources import files

    rows = spark.createDataFrame([(k, f"{i}.txt", bytes([65 + i]) * n) for k in (1, 2, None) for i in range(3) for n in (1, 200)] + [(1, "z", None), (1, None, b"x")], "p int, path string, content binary")
    got = files.pack(rows, "p")
    plan = str(got._jdf.queryExecution().optimizedPlan())
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan
    for r in got.collect():
        z = zipfile.ZipFile(io.BytesIO(r["content"]))
        want = {f"{i}.txt": bytes([65 + i]) * 200 for i in range(3)} | ({"z": b""} if r["p"] == 1 else {})
        assert {n: z.read(n) for n in z.namelist()} == want == {m["path"]: z.read(m["path"]) for m in r["manifest"]}
        assert all((e.compress_type == zipfile.ZIP_DEFLATED) == (e.file_size >= files.LEAST_DEFLATED) for e in z.infolist())
    assert {r["p"] for r in got.collect()} == {1, 2, None} and got.count() == 3


def test_words_of_rules_are_found_as_their_patterns_find_them(spark):
    from costquarry.functions import rules

    rng = random.Random(3)
    parts = sorted({a for _, p in rules.TRADES for a in rules._alternatives(p)})
    bits = [p.replace("\\s*", " ").replace("\\b", "").replace("(?:ing)?", "ing").replace("[- ]", "-") for p in parts] + ["wc", "xwcx", "33kv", "", "doo", "ti le"]
    df = spark.createDataFrame([(" ".join(rng.choice(bits) for _ in range(2)),) for _ in range(400)], "t string")
    got = df.select(*(rules.holds(F.col("t"), p).alias(f"a{i}") for i, (_, p) in enumerate(rules.TRADES)), *(F.col("t").rlike(p).alias(f"b{i}") for i, (_, p) in enumerate(rules.TRADES)))
    n = len(rules.TRADES)
    rows = got.collect()
    assert all(r[:n] == r[n:] for r in rows) and sum(map(sum, rows)) > 400
    assert "contains" in str(rules.holds(F.col("t"), "door|window")) and "rlike" in str(rules.holds(F.col("t"), "(a|b)c")).lower()
