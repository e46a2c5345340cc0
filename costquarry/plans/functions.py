"""Queries of the column functions: each function over texts, numbers and dates made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry.functions import documents, rules, scalars
from costquarry.plans.queries import query, t, titles

_TAILS = "CASE p_partkey % 8 WHEN 0 THEN ' 병원 신축공사' WHEN 1 THEN ' school renovation 감리' WHEN 2 THEN ' 농업 시설 설계' WHEN 3 THEN ' 연구소 기자재 PMC' WHEN 4 THEN ' 청사 증축' WHEN 5 THEN ' water treatment plant' WHEN 6 THEN ' 물품 구매' ELSE '' END"
_CONTRACT = "CASE p_size % 3 WHEN 0 THEN '공사' WHEN 1 THEN '용역' ELSE '물품' END"


def by_rest(key: str, n: int, *values: Column) -> Column:
    """The value for the key's rest modulo n; the last for all further ones."""
    rest = F.col(key) % n
    out = F.when(rest == 0, values[0])
    for i, v in enumerate(values[1:-1], 1):
        out = out.when(rest == i, v)
    return out.otherwise(values[-1])


@query(
    r"""SELECT p_partkey, 'é ' || p_name || ' x' AS nfc, 'A ' || p_name AS nfkc, lower(regexp_replace(p_name, '[^0-9A-Za-z]+', '',
'g')) || 'a가' AS compact, lower(regexp_replace(p_name, '[^0-9A-Za-z]+', '', 'g')) AS title,
p_brand || '_a_b_.txt' AS file_name,
CASE p_partkey % 3 WHEN 0 THEN 'a/' || p_name WHEN 1 THEN 'manifests/' || p_name ELSE 'else/' || p_name END AS portable,
CASE p_partkey % 3 WHEN 0 THEN 'a/' || p_name END AS member, p_name GLOB '*d [a-r]*g*' AS fits,
CASE WHEN n < 26 THEN chr(65 + n) WHEN n < 702 THEN chr(64 + n // 26) || chr(65 + n % 26)
ELSE chr(64 + (n - 26) // 676) || chr(65 + (n - 702) // 26 % 26) || chr(65 + n % 26) END AS letters,
CASE p_partkey % 4 WHEN 0 THEN 'BOQ' WHEN 1 THEN '도면' WHEN 2 THEN '시방서 | 가격·견적' ELSE '' END AS types,
CASE WHEN p_size % 2 = 0 THEN p_brand || '·' || p_type ELSE '없음' END AS label, contains(lower(p_name), 'ring') AS holds_ring
FROM (SELECT *, CAST(p_partkey % 1400 AS INTEGER) AS n FROM part)"""
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, lit = F.col("p_name"), F.lit
    path = by_rest("p_partkey", 3, F.concat(lit("/data/root/a/"), name), F.concat(lit("C:\\old\\manifests\\"), name), F.concat(lit("else/"), name))
    member = by_rest("p_partkey", 3, F.concat(lit("a\\"), name), F.concat(lit("b/../"), name), F.concat(lit("/"), name))
    file = F.concat(name, by_rest("p_partkey", 4, lit("/BoQ.xlsx"), lit("/도면.bin"), lit("/price 시방.pdf"), lit("/other")))
    half = F.col("p_size") % 2 == 0
    return t(spark, sf_dir, "part").select(
        "p_partkey", scalars.clean_nfc(F.concat(lit("é  "), name, lit("\0x "))).alias("nfc"),
        scalars.normalize_text(F.concat(lit("Ａ　"), name, lit("　"))).alias("nfkc"),
        scalars.compact_text(F.concat(name, lit("-Ａ 가 é"))).alias("compact"),
        scalars.normalize_title(F.concat(name, lit(" (2020/300만불) … and more"))).alias("title"),
        scalars.safe_file_name(F.concat("p_brand", lit("/a:b*?.txt"))).alias("file_name"),
        scalars.portable_path(path, "/data/root", ("manifests", "data")).alias("portable"),
        scalars.safe_member_path(member).alias("member"), scalars.glob(name, "*d [a-r]*g*").alias("fits"),
        scalars.excel_column(F.col("p_partkey") % 1400).alias("letters"),
        F.array_join(rules.document_types(file), " | ").alias("types"),
        scalars.label_list(F.when(half, F.col("p_brand")), F.when(half, F.col("p_type")), default="없음").alias("label"),
        scalars.contains_ci(name, lit("RING")).alias("holds_ring"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_totalprice END AS as_double, CASE
WHEN o_orderkey % 4 <> 3 THEN o_orderkey END AS as_long, o_totalprice AS as_money, o_totalprice AS first_number,
CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 2 THEN 3.0 END AS strict, CASE WHEN o_orderkey % 4 <> 1 THEN o_orderkey END AS digits,
CAST(CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 900 + 1) * 10000 WHEN 1 THEN (o_orderkey % 900 + 1) * 1000000
WHEN 2 THEN (o_orderkey % 900 + 1) * 100000000 END AS BIGINT) AS budget,
CASE WHEN o_orderstatus = 'F' THEN round((o_totalprice / 100000 - 1) * 100, 7) END AS gap, o_orderkey % 3 <> 0 AS stands_there, round(CASE
WHEN o_orderkey % 2 = 0 THEN o_totalprice / 250 END, 4) AS ratio,
CAST(CASE o_orderkey % 4 WHEN 0 THEN 1706.0 WHEN 1 THEN 255.52 WHEN 2 THEN 1234567.0 END AS DOUBLE) AS area, CASE
WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS ceiling FROM orders"""
)
def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price, lit = "o_orderkey", F.col("o_totalprice"), F.lit
    n, shown, plain = F.col(key), F.format_number("o_totalprice", 2), price.cast("decimal(14,2)").cast("string")
    odd = F.col(key) % 4 == 3
    budget = F.concat(lit("사업('23/"), (n % 900 + 1).cast("string"), by_rest(key, 4, lit("만불)"), lit("백만불)"), lit("억불)"), lit("원)")))
    whole = n * 1000 + 7
    text = by_rest(key, 3, lit("no such"), F.concat(lit("sum of "), F.format_number(whole, 0), lit(" m2")), F.concat(lit("sum "), whole.cast("string")))
    return t(spark, sf_dir, "orders").select(
        key, scalars.to_double(F.when(odd, "x1").otherwise(F.concat(lit(" "), plain, lit(" ")))).alias("as_double"),
        scalars.to_long(F.when(odd, "").otherwise(n.cast("string"))).alias("as_long"),
        scalars.money(plain).alias("as_money"), scalars.first_number(F.concat(lit("total: "), shown, lit(" of 12"))).alias("first_number"),
        scalars.strict_number(by_rest(key, 4, shown, lit("12 m"), lit("+3"), lit(""))).alias("strict"),
        scalars.digits_to_long(F.when(n % 4 == 1, "-").otherwise(F.concat(n.cast("string"), lit(" 건")))).alias("digits"),
        scalars.program_budget_usd(budget).alias("budget"), F.round(scalars.gap_percent(price, lit(100000.0),
            F.col("o_orderstatus") == "F"), 7).alias("gap"), scalars.number_in_text(whole, text).alias("stands_there"),
        F.round(scalars.ratio(price, F.when(n % 2 == 0, 250.0)), 4).alias("ratio"),
        scalars.area_number(by_rest(key, 4, lit("1, 706"), lit("255,52"), lit("1,234,567"), lit("0"))).alias("area"),
        scalars.usd_ceiling(F.concat(F.when(n % 2 == 0, "약 US $ ").otherwise("KRW "), shown)).alias("ceiling"),
    )


@query(
    """SELECT o_orderkey, o_orderkey % 4 < 2 AS valid_partial, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
ELSE 'kept' END AS iso, o_orderkey % 3 = 0 AS zoned, strftime(o_orderdate, '%Y') AS year_key,
CAST(NULL AS VARCHAR) AS no_key FROM orders"""
)
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day, lit = "o_orderkey", F.col("o_orderdate"), F.lit
    partial = by_rest(key, 4, F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy-MM-dd"),
        F.concat(F.date_format(day, "yyyy"), lit("-13")), F.concat(F.date_format(day, "yyyy-MM"), lit("-32")))
    stamp = F.when(F.col(key) % 2 == 0, F.date_format(day, "yyyyMMddHHmmss")).otherwise("kept")
    zone = by_rest(key, 3, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'+09:00'"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(day, "yyyy-'99'-dd'T'HH:mm:ss'Z'"))
    return t(spark, sf_dir, "orders").select(
        key, scalars.valid_partial_date(partial).alias("valid_partial"), scalars.stamp_to_iso(stamp).alias("iso"),
        scalars.has_zone(zone).alias("zoned"), scalars.period_key(day, lit("annual")).alias("year_key"), scalars.period_key(day, lit("weekly")).alias("no_key")
    )


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '2019-' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0')
ELSE '' END AS project_no, CASE WHEN p_partkey % 2 = 1 THEN 'L2020-' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') || '-3' ELSE '' END AS bid_no,
'L2020-' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS base, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_type || ';' || p_brand || ';가나' AS countries,
CASE p_partkey % 6 WHEN 0 THEN 'm²' WHEN 1 THEN 'm³' WHEN 2 THEN 'm' WHEN 3 THEN 'no.' WHEN 4 THEN 'bag of 5' ELSE '' END AS unit FROM part"""
)
def identifier_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, lit = "p_partkey", F.lit
    five = F.lpad((F.col(key) % 100000).cast("string"), 5, "0")
    even = F.col(key) % 2 == 0
    return t(spark, sf_dir, "part").select(
        key, scalars.project_no(F.when(even, F.concat(lit("사업 2019-"), five, lit(" 외"))).otherwise(F.concat(lit("X2019-"), five))).alias("project_no"),
        scalars.bid_no(F.when(even, F.concat(lit("xL2020-"), five)).otherwise(F.concat(lit("no. l2020-"), five, lit("-3 ")))).alias("bid_no"),
        scalars.bid_base(F.concat(lit("L2020-"), five, F.when(even, "-7").otherwise(""))).alias("base"),
        scalars.work_code(F.concat(F.col(key).cast("string"), lit(".0"))).alias("code"),
        F.array_join(scalars.country_tokens(F.concat("p_type", lit(" / "), "p_brand", lit(" 및 가나, "))), ";").alias("countries"),
        scalars.normalize_unit(by_rest(key, 6, lit(" s m "), lit("CUM"), lit("Metres"), lit("Nr"), lit("bag  of 5"), lit(None).cast("string"))).alias("unit"),
    )


@query(
    """SELECT n_nationkey, n_nationkey % 2 = 0 AS is_digest, n_nationkey % 3 <> 2 AS is_json,
'{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","none":null,"region":' || (n_regionkey + 1) || '}' AS doc,
CASE n_nationkey % 4 WHEN 0 THEN 'p_cases must be a non-empty JSON array' WHEN 1 THEN 'p_cases must be a non-empty JSON array'
WHEN 2 THEN 'p_cases exceeds the 2 row safety limit' END AS problem FROM nation"""
)
def json_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, lit = "n_nationkey", F.lit
    name = F.col("n_name").cast("binary")
    digest = F.when(F.col(key) % 2 == 0, F.sha2(name, 256)).otherwise(F.upper(F.sha2(name, 256)))
    doc = F.concat(lit('{"k": "'), "n_name", lit('"}'))
    row = F.struct(key, "n_name", lit(None).cast("string").alias("none"), lit(0).alias("region"))
    return t(spark, sf_dir, "nation").select(
        key, scalars.is_sha256(digest).alias("is_digest"), scalars.valid_json(by_rest(key, 3, doc, lit("[1, null]"), F.concat(doc, lit("}")))).alias("is_json"),
        scalars.to_json_with_nulls(scalars.merge_fields(row, region=F.col("n_regionkey") + 1)).alias("doc"),
        scalars.array_problem(by_rest(key, 4, lit("[]"), lit('{"a": 1}'), lit("[1, 2, 3]"), lit(" [1]")), "p_cases", 2, 1).alias("problem"),
    )


@query(
    f"""WITH x AS (SELECT p_partkey, lower(p_name || {_TAILS}) AS title, {_CONTRACT} AS contract FROM part)
SELECT p_partkey, contract = '공사' OR regexp_matches(title, '{"|".join(rules.CONSTRUCTION_KEYWORDS)}') AS candidate FROM x"""
)
def construction_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select("p_partkey", rules.construction_candidate(F.col("title"), F.col("contract")).alias("candidate"))


@query(f"WITH x AS (SELECT p_partkey, lower(p_name || {_TAILS}) AS title, {_CONTRACT} AS contract FROM part) SELECT 'construction' AS scope, p_partkey FROM x WHERE contract = '공사' OR regexp_matches(title, '{'|'.join(rules.CONSTRUCTION_KEYWORDS)}') UNION ALL SELECT 'all', p_partkey FROM x")
def scope_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    bids = construction_candidates(spark, sf_dir).withColumnRenamed("candidate", "construction_candidate")
    out = [rules.select_scope(bids, s).select(F.lit(s).alias("scope"), "p_partkey") for s in ("construction", "none", "all")]
    return out[0].union(out[1]).union(out[2])


@query(
    """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '우즈베키스탄' WHEN 1 THEN '가나' WHEN 2 THEN '우즈베키스탄' WHEN 3 THEN '도미니카' WHEN 4 THEN '동티모르'
WHEN 6 THEN '가나' END AS ko,
CASE p_partkey % 8 WHEN 0 THEN 'Uzbekistan' WHEN 1 THEN 'Ghana' WHEN 2 THEN 'Uzbekistan' WHEN 3 THEN 'Dominican Republic'
WHEN 4 THEN 'Timor-Leste' WHEN 6 THEN 'Ghana' END AS en,
CASE p_partkey % 8 WHEN 0 THEN '우즈베키스탄' WHEN 1 THEN '가나' WHEN 4 THEN p_type WHEN 5 THEN '키르기스스탄' WHEN 7 THEN p_type ELSE '미상' END AS by_name FROM part"""
)
def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of 페르가나 the name 가나 is a part, of Dominican Republic of the Ghana-free text the longest name; prefixes only where a name begins so."""
    key, lit, name = "p_partkey", F.lit, F.col("p_name")
    text = by_rest(key, 8, F.concat(lit("우즈베키스탄 페르가나 "), name), F.concat(lit("가나 관개지구 "), name), F.concat(name, lit(" 우즈벡 사업")),
        F.concat(name, lit(" in the DOMINICAN republic, 네팔 too")), F.concat(lit("timor-leste 피지 "), name), name, F.concat(name, lit(" ghana")), F.upper(name))
    project = by_rest(key, 8, lit("우즈베키스탄 학교"), lit("　가나　병원"), lit("the 가나"), lit(""), lit("네팔"), lit("키르기스스탄 농업"), lit(None).cast("string"), lit("페루"))
    given = F.when((F.col(key) % 8).isin(4, 7), F.col("p_type")).otherwise("  ")
    found = rules.find_country(text)
    return t(spark, sf_dir, "part").select(key, found["ko"].alias("ko"), found["en"].alias("en"), rules.country_by_name(given, project).alias("by_name"))


@query(
    """SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'NOTICE_EXECUTION_CEILING' WHEN 1 THEN 'CONSTRUCTION_BUDGET'
WHEN 2 THEN 'DESIGN_ESTIMATE' WHEN 3 THEN 'ADVERTISED_ESTIMATED_BUDGET' WHEN 4 THEN 'DIRECT_UNIT_RATE_ONLY' ELSE 'OTHER_PLANNING_AMOUNT' END AS stage,
CASE p_partkey % 7 WHEN 0 THEN '집행한도' WHEN 1 THEN '공사예산' WHEN 2 THEN '설계 추정금액' WHEN 3 THEN '광고 추정예산' WHEN 4 THEN 'DIRECT_UNIT_RATE_ONLY'
ELSE 'OTHER_PLANNING_AMOUNT' END AS label,
CASE p_partkey % 7 WHEN 0 THEN 'total' WHEN 1 THEN 'item' WHEN 2 THEN 'item_unquantified' WHEN 3 THEN 'item' ELSE 'heading' END AS kind,
CASE p_partkey % 7 WHEN 0 THEN '소방' WHEN 1 THEN '콘크리트·철근·거푸집' WHEN 2 THEN '지붕' WHEN 3 THEN '마감' WHEN 4 THEN '가설·일반조건' WHEN 5 THEN '토공·기초' ELSE '기타' END AS trade,
CASE p_partkey % 7 WHEN 0 THEN 6 WHEN 1 THEN 5 WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 2
ELSE 1 END AS grade_rank, CASE p_partkey % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'C?' WHEN 4 THEN 'U' WHEN 5 THEN 'X' END AS compact,
CASE p_partkey % 7 WHEN 0 THEN '병원 의료 보건 보건의료 의료인프라 모자보건 병동 진료' WHEN 1 THEN '학교 교육 훈련 대학 직업교육 TVET' END AS aliases,
CASE p_partkey % 7 WHEN 3 THEN 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 4 THEN 7 ELSE 99 END AS category_rank
FROM part"""
)
def label_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, lit, name = "p_partkey", F.lit, F.col("p_name")
    empty, none = lit(""), lit(None).cast("double")
    stage = rules.cost_stage(by_rest(key, 7, F.concat(name, lit(" 입찰 집행한도")), lit("the Project Budget of"), lit("심층기획 결과"), lit("추정예산 기준"),
        lit("직접 제시 계획단가"), name))
    line = by_rest(key, 7, lit("Sub Total carried"), lit("Concrete slab"), lit("roof truss"), lit("Paint finish"), name, lit("ELEMENT 3"))
    code, unit = by_rest(key, 7, empty, empty, lit("2.1"), lit("3"), empty), by_rest(key, 7, lit("m2"), lit("m3"), empty, lit("m2"), empty)
    quantity, formula = by_rest(key, 7, lit(5.0), lit(2.0), none, none, none), F.when(F.col(key) % 7 == 3, "=A1*2").otherwise("")
    sheet = by_rest(key, 7, lit("fire alarm"), lit("Bill 2"), lit("Bill 3"), lit("Bill 4"), lit("1 PRELIMINARIES"), lit("excavation"), lit("Bill 7"))
    described = by_rest(key, 7, lit("concrete"), lit("Concrete slab"), lit("roof truss"), lit("Paint finish"), lit("concrete"),
        lit("fill and ram"), lit("wholly else"))
    grade = by_rest(key, 7, lit("A-부분"), lit("B"), lit("C-부분"), lit("C?"), lit("U"), lit("X"), lit(None).cast("string"))
    family = by_rest(key, 7, lit("보건·의료시설"), lit("교육·훈련시설"), lit("no family"))
    category = by_rest(key, 7, lit("공사비"), lit("설계비"), lit("감리·CM비"), lit("연면적·면적"), lit("기간"), lit("else"), lit(None).cast("string"))
    return t(spark, sf_dir, "part").select(
        key, stage.alias("stage"), rules.stage_label(stage).alias("label"),
        rules.row_kind(line, code, unit, quantity, formula, F.col(key) % 7 == 2).alias("kind"),
        rules.trade(sheet, empty, empty, described).alias("trade"), F.coalesce(rules.grade_rank(grade), lit(1)).alias("grade_rank"),
        rules.compact_grade(grade).alias("compact"), rules.family_aliases(family).alias("aliases"),
        rules.category_rank(category).alias("category_rank"),
    )


def _sorted_object(j: str, depth: str = "") -> str:
    """DuckDB's text of an object with its fields in order; `device` and the objects of `items` are nested ones."""
    k = f"k{depth}"
    value = f"CAST({j} -> {k} AS VARCHAR)"
    if not depth:
        items = f"'[' || array_to_string(list_transform(CAST({j} -> 'items' AS JSON[]), lambda x: {_sorted_object('x', '2')}), ',') || ']'"
        value = f"CASE {k} WHEN 'device' THEN {_sorted_object(f'({j} -> {k})', '1')} WHEN 'items' THEN {items} ELSE {value} END"
    return f"('{{' || array_to_string(list_transform(list_sort(json_keys({j})), lambda {k}: '\"' || {k} || '\":' || {value}), ',') || '}}')"


@query(
    f"""WITH d AS (SELECT click_id, CASE WHEN json_valid(props) THEN props::JSON END AS p, to_json({{'client_id': client_id, 'k': kind}}) AS f FROM clicks),
m AS (SELECT click_id, p, CASE WHEN json_type(p) = 'OBJECT' THEN ('{{' || array_to_string(list_concat(list_transform(list_filter(json_keys(p), lambda x: x NOT IN ('client_id', 'k')),
lambda x: '"' || x || '":' || CAST(p -> x AS VARCHAR)), ['"client_id":' || CAST(f -> 'client_id' AS VARCHAR), '"k":' || CAST(f -> 'k' AS VARCHAR)]), ',') || '}}')::JSON END AS j FROM d),
c AS (SELECT click_id, CASE WHEN json_type(p) = 'OBJECT' THEN {_sorted_object("p")} END AS own, CASE WHEN j IS NOT NULL THEN {_sorted_object("j")} END AS document FROM m)
SELECT click_id, document, sha256(document) AS sha256, sha256(own) AS own_sha256 FROM c"""
)
def click_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of all clicks as VARIANT documents, with the client and, for their `k`, the kind; canonical texts and digests."""
    c = t(spark, sf_dir, "clicks").select("click_id", "client_id", "kind", documents.document(F.col("props")).alias("doc"))
    more = documents.with_fields(F.col("doc"), client_id=F.col("client_id"), k=F.col("kind"))
    own = F.when(documents.fields(F.col("doc")).isNotNull(), documents.digest(F.col("doc")))
    return c.select("click_id", documents.canonical(more).alias("document"), documents.digest(more).alias("sha256"), own.alias("own_sha256"))
