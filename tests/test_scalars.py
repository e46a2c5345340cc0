import hashlib

import pytest
from pyspark.sql import functions as F

from costquarry.functions import documents, rules, scalars
from costquarry.operators import titles


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("function", "given", "expected"),
    [
        (scalars.clean, "  a  　b ", "a b"), (scalars.clean, "  ", None), (scalars.clean_or_empty, None, ""),
        (scalars.amount, "$ 5,497,600 (환율 : 1150)", 5497600.0), (scalars.amount, "USD 12", 12.0), (scalars.amount, "3,000 원", 3000.0),
        (scalars.amount, "", None),
        (scalars.usd_ceiling, "3,000 원", None), (scalars.usd_ceiling, "US$ 272,603", 272603.0), (scalars.usd_ceiling, None, None),
        (scalars.area_number, "1, 706", 1706.0), (scalars.area_number, "255,52", 255.52), (scalars.area_number, "1,0 8 0", 1080.0),
        (scalars.area_number, "1,234,567", 1234567.0), (scalars.area_number, "0", None), (scalars.area_number, "", None),
        (scalars.strict_number, "1,234.5", 1234.5), (scalars.strict_number, "12 m", None), (scalars.digits_to_long, "1,234 건", 1234),
        (scalars.digits_to_long, "-", None),
        (scalars.program_budget_usd, "사업('23-'28/1,220만불)", 12_200_000), (scalars.program_budget_usd, "3백만불", 3_000_000),
        (scalars.program_budget_usd, "없음", None),
        (scalars.normalize_title, "Vocational School ('23-'28/500만불)", "vocationalschool"), (scalars.normalize_title, None, ""),
        (scalars.compact_text, "Ａ-b 가", "ab가"),
        (scalars.project_no, "no 2019-00012 x", "2019-00012"), (scalars.bid_no, "l2025-00018-1", "L2025-00018-1"),
        (scalars.bid_base, "L2025-00018-1", "L2025-00018"), (scalars.bid_base, "L2025-00018", "L2025-00018"),
        (scalars.normalize_unit, "sm", "m²"), (scalars.normalize_unit, "CM", "m³"), (scalars.normalize_unit, "Meters", "m"),
        (scalars.normalize_unit, "pieces", "no."), (scalars.normalize_unit, "bag", "bag"), (scalars.normalize_unit, None, ""),
        (scalars.country_tokens, "가나, 네팔 및 페루", ["가나", "네팔", "페루"]), (scalars.stamp_to_iso, "20240102030405", "2024-01-02T03:04:05"),
        (scalars.work_code, "1234.0", "001234"),
        (scalars.valid_partial_date, "2020-13", False), (scalars.valid_partial_date, "2020-12-31", True),
        (scalars.safe_member_path, "a/../b", None), (scalars.safe_member_path, "a\\b", "a/b"),
        (rules.compact_grade, "C?-부분", "C?"), (rules.compact_grade, "C-부분", "C"), (rules.compact_grade, "Z", None),
        (rules.work, "청사 보수 및 증축", "리모델링·개보수"), (rules.cost_stage, "심층기획 결과", "DESIGN_ESTIMATE"),
    ],
)
def test_values(spark, function, given, expected):
    assert one(spark, function(F.lit(given).cast("string"))) == expected


def test_excel_columns(spark):
    got = spark.createDataFrame([(i,) for i in (0, 25, 26, 51, 701, 702)], "i int").select(scalars.excel_column(F.col("i")).alias("x")).collect()
    assert [r.x for r in got] == ["A", "Z", "AA", "AZ", "ZZ", "AAA"]


def test_period_keys(spark):
    day = F.lit("2021-05-09")
    assert [one(spark, scalars.period_key(day, F.lit(f))) for f in ("annual", "quarterly", "monthly", "daily")] == ["2021", "2021-Q2", "2021-05", None]


def test_clean_is_idempotent(spark):
    texts = ["", " ", "a  b", " x　", None, "\t\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(scalars.clean(F.col("t")).alias("a"))
    assert df.where(~scalars.clean(F.col("a")).eqNullSafe(F.col("a"))).count() == 0


@pytest.mark.parametrize(
    ("contract", "title", "role"),
    [("공사", "학교 신축공사", "WORKS"), ("공사", "병원 설계·시공", "DESIGN_BUILD_WORKS"), ("용역", "설계 및 감리 용역", "DESIGN_OR_SUPERVISION_SERVICE"),
        ("물품", "가구", "GOODS"), ("용역", "조사", "OTHER_SERVICE")],
)
def test_scope_roles(spark, contract, title, role):
    assert one(spark, rules.scope_role(F.lit(contract), F.lit(title))) == role


def test_longest_marker_wins(spark):
    markers = spark.createDataFrame([("Ghana", "가나"), ("Uzbekistan", "우즈베키스탄"), ("Ghana", "gana")], "label string, marker string")
    df = spark.createDataFrame([("우즈베키스탄 페르가나",), ("가나 관개지구",), ("none",), (None,)], "t string")
    assert [r.country for r in titles.longest_marker(df, "t", markers).collect()] == ["Uzbekistan", "Ghana", None, None]


def test_variant_documents(spark):
    rows = ['{"b": 1, "a": [{"z": 1.50, "y": "é\\u00e9"}], "k": null}', '{ "a":[{"y":"éé","z":1.5}],"k":null,"b":1 }', '{"k": 1, "k": 2}', "[2, 1]",
        "{broken", '{"a": 1} x', "", None, "{}"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string").withColumn("d", documents.document(F.col("x")))
    other = documents.document(F.lit('{"b": {"c": 2}, "A": "new"}'))
    got = df.select("i", documents.canonical(F.col("d")).alias("c"), documents.digest(F.col("d")).alias("s"),
        documents.canonical(documents.merged(F.col("d"), other)).alias("m"), documents.canonical(documents.with_fields(F.col("d"), n=F.lit(None).cast("int"))).alias("w"),
        documents.canonical(documents.without_fields(F.col("d"), "a", "q")).alias("o")).orderBy("i").collect()
    whole = '{"a":[{"y":"éé","z":1.5}],"b":1,"k":null}'
    assert [r["c"] for r in got] == [whole, whole, None, "[2,1]", None, None, None, None, "{}"]
    assert got[0]["s"] == got[1]["s"] == hashlib.sha256(whole.encode()).hexdigest()
    assert [r["m"] for r in got] == ['{"A":"new","a":[{"y":"éé","z":1.5}],"b":{"c":2},"k":null}'] * 2 + [None] * 6 + ['{"A":"new","b":{"c":2}}']
    assert got[8]["w"] == '{"n":null}' and got[0]["o"] == '{"b":1,"k":null}' and got[3]["w"] is None and got[7]["o"] is None
