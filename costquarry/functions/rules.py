"""Classification by ordered rules: the first rule that holds gives the label.

The rules are data; they become one CASE expression inside code generation, without Python.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.functions.scalars import clean, clean_or_empty, normalize_text


def _alternatives(pattern: str) -> list[str]:
    """What stands between the bars of a pattern, those within brackets aside."""
    out, depth = [""], 0
    for ch in pattern:
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and not depth:
            out.append("")
        else:
            out[-1] += ch
    return out


def holds(text: Column, pattern: str) -> Column:
    """Whether a pattern is in a text: alternatives of letters, digits, blanks and hyphens as plain words, which is far faster, the others as one pattern."""
    if re.search(r"[\[\]]|\\[QE]|\\[|()]", re.sub(r"\[[- ]+\]", "", pattern)):
        return text.rlike(pattern)
    every = _alternatives(pattern)
    words = [a for a in every if re.fullmatch(r"[\w -]+", a)]
    rest = [a for a in every if a not in words]
    parts = [F.contains(text, F.lit(w)) for w in dict.fromkeys(words)] + ([text.rlike("|".join(rest))] if rest else [])
    return reduce(lambda a, b: a | b, parts)


def first_match(text: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """rules: (label, pattern), the pattern for lower-case text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for label, pattern in rules:
        out = F.when(holds(low, pattern), label) if out is None else out.when(holds(low, pattern), label)
    return out.otherwise(default)


def keyword_pattern(words: Iterable[str]) -> str:
    """A pattern that holds if any of the words is in the text."""
    return "|".join("\\Q" + w.lower() + "\\E" for w in words)


def keywords_in(text: Column, words: Iterable[str], ordered: bool = True) -> Column:
    """The words that the text holds, sorted or in the list's order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in (sorted(set(words)) if ordered else words))))
    return found


# Labels, keywords and patterns of the procurement domain.
UNCLASSIFIED = "기타·미분류"
FACILITIES = (
    ("병원", ("병원", "의료원", "보건소", "health center", "hospital", "clinic")),
    ("학교·교육시설", ("학교", "교실", "교육센터", "school", "classroom", "training center")),
    ("실험실·연구시설", ("실험실", "연구소", "laboratory", "lab ")),
    ("정부·행정시설", ("청사", "경찰", "행정", "government", "police")),
    ("농업시설", ("농장", "농업", "관개", "farm", "agricultur", "irrigation")),
    ("상하수·환경시설", ("정수", "하수", "폐기물", "water treatment", "waste")),
    ("산업·직업훈련시설", ("직업훈련", "기술교육", "산업", "vocational", "technical center")),
)
WORKS = (
    ("리모델링·개보수", ("리모델링", "개보수", "보수", "renovation", "rehabilitation")),
    ("증축", ("증축", "extension", "expansion")),
    ("신축", ("신축", "건립", "new construction", "construction of")),
)
FAMILIES = (
    ("보건·의료시설", "병원|의료|보건|의과|간호|진료|병동|hospital|medical|health|clinic|matern"),
    ("교육·훈련시설", "학교|교육|훈련|대학|직업|tvet|school|education|training|university|college"),
    ("농업·생산시설", "농업|농촌|영농|축산|수산|가공|저장|agri|farm"),
    ("연구·실험시설", "연구|실험|laborator|research"),
    ("행정·공공시설", "정부|행정|공공|청사|government|administr"),
    ("환경·기반시설", "상하수|환경|위생|폐기물|water|sanitation|environment"),
)
FAMILY_ALIASES = {
    "보건·의료시설": "병원 의료 보건 보건의료 의료인프라 모자보건 병동 진료",
    "교육·훈련시설": "학교 교육 훈련 대학 직업교육 TVET",
    "농업·생산시설": "농업 농촌 생산 가공 저장",
    "연구·실험시설": "연구 실험 실험실 연구소",
    "행정·공공시설": "정부 행정 공공 청사",
    "환경·기반시설": "상하수 환경 위생 기반시설",
    UNCLASSIFIED: "",
}
TRADES_BY_SHEET = (("가설·일반조건", "preliminar"), ("전기·전력인입", "33kv"), ("소방", "fire"), ("급배수·빗물이용", "rainwater"), ("외부공사", "external works"))
TRADES = (
    ("소방", r"fire|extinguisher|suppression"),
    ("전기·전력인입", r"electrical|wiring|light(?:ing)?|socket|cable|breaker|switch|consumer unit|photocell|pole|transformer|33\s*kv"),
    ("급배수·위생", r"sanitary|plumb|water closet|\bwc\b|wash basin|pipe|drain|sewer|septic|manhole|tap|shower|toilet"),
    ("지붕", r"roof|truss|purlin|rafter|fascia|facia|gutter|downpipe|rainwater disposal"),
    ("창호·철물", r"door|window|glaz|ironmongery|lock|hinge"),
    ("마감", r"finish|plaster|render|paint|screed|tile|ceiling|roughcast|terrazzo|vinyl"),
    ("조적", r"brick|block|walling|mortar|masonry|damp proof course"),
    ("콘크리트·철근·거푸집", r"concrete|reinforcement|reinforced|steel bar|mesh|formwork|ringbeam|column|beam|slab"),
    ("토공·기초", r"excavat|earthwork|top\s*soil|hard\s*core|hardcore|marrum|anti[- ]termite|foundation|substructure|fill and ram"),
    ("외부공사", r"fenc|gate|external works|road|parking|landscap|paving|walkway"),
    ("설비·장비", r"mill(?:ing)?|machine|equipment|mechanical|ventilat|air condition"),
    ("가설·일반조건", r"preliminar|insurance|site office|security|progress photograph|setting[- ]out|scaffold|signboard|health and safety"),
)
STRONG_BUILDING = ("건축공사", "신축", "증축", "개축", "재건축", "리모델링", "리노베이션", "보수공사", "건립", "공간계획", "space program", "building construction", "renovation")
WEAK_CONSTRUCTION = ("시공", "공사", "토목공사", "구조공사", "전기공사", "기계공사", "construction")
BUILDING_ASSETS = (
    "건물", "청사", "센터", "연수원", "훈련원", "교육원", "학교", "대학", "병원", "보건소", "실험실", "연구소", "연구센터", "기숙사",
    "강의동", "사무동", "도서관", "복지관", "공장", "공항", "시설", "laboratory", "hospital", "school", "building",
)
BUILDING_SERVICES = ("기본설계", "실시설계", "설계", "감리", "건설사업관리", "cm용역", "cm 용역", "설계검토", "architectural", "supervision")
BOQ_FILE = r"(?i)(\bboq\b|bill.{0,8}(?:quantit|price)|schedule.{0,8}(?:price|quantit)|priced|unpriced|blank.{0,5}bill|내역서|물량|수량|견적|단가|공사비)"
BLANK_BOQ_FILE = r"(?i)(blank|unpriced|not.?priced|공내역)"
WORKS_TITLE = r"(?i)(construction|civil.?works|renovation|공사|시공|신축|개보수|리모델링)"
OTHER_TITLE = r"(?i)(design|supervision|consult|supply|procurement|설계|감리|PMC|기자재|물품|가구|차량|구매|공급)"
SERVICE_TITLE = r"(?i)(설계.*(?:용역|입찰|업체|사\s*선정)|감리|설계감리|시공감리|저작권감리|control\s+office|design\s+(?:and\s+)?supervision|consult(?:ant|ing)|supervision\s+service)"
CONTRACTOR_TITLE = r"(?i)(시공업체|시공사|신축공사|건축\s*공사|리모델링\s*공사|보수\s*공사|마감공사|공사입찰|설계\s*[·및/]?\s*시공|construction\s+works|civil\s+works|renovation\s+works|contractor)"
CONSTRUCTION_KEYWORDS = (
    "건축", "건립", "신축", "증축", "개축", "개보수", "보수공사", "환경개선", "리모델링", "리노베이션", "시공", "공사", "설계", "감리", "시설물", "토목",
    "epc", "construction", "building", "renovation", "remodeling", "architect", "supervision",
)
COUNTRIES = {
    "가나": "Ghana", "과테말라": "Guatemala", "네팔": "Nepal", "도미니카": "Dominican Republic", "라오스": "Laos", "르완다": "Rwanda", "모로코": "Morocco", "몽골": "Mongolia",
    "미얀마": "Myanmar", "방글라데시": "Bangladesh", "베트남": "Vietnam", "볼리비아": "Bolivia", "세네갈": "Senegal", "스리랑카": "Sri Lanka", "알제리": "Algeria",
    "에콰도르": "Ecuador", "에티오피아": "Ethiopia", "엘살바도르": "El Salvador", "요르단": "Jordan", "우간다": "Uganda", "우즈베키스탄": "Uzbekistan", "이라크": "Iraq",
    "인도네시아": "Indonesia", "잠비아": "Zambia", "캄보디아": "Cambodia", "케냐": "Kenya", "콜롬비아": "Colombia", "키르기즈": "Kyrgyzstan", "타지키스탄": "Tajikistan",
    "탄자니아": "Tanzania", "튀니지": "Tunisia", "파라과이": "Paraguay", "파키스탄": "Pakistan", "팔레스타인": "Palestine", "페루": "Peru", "필리핀": "Philippines",
    "온두라스": "Honduras", "코트디부아르": "Côte d’Ivoire", "카메룬": "Cameroon", "모잠비크": "Mozambique", "말라위": "Malawi", "짐바브웨": "Zimbabwe",
    "동티모르": "Timor-Leste", "피지": "Fiji", "솔로몬": "Solomon Islands", "부탄": "Bhutan", "조지아": "Georgia",
}
COUNTRY_ALIASES = {"우즈벡": ("우즈베키스탄", "Uzbekistan")}
COUNTRY_PREFIXES = (
    "가나", "과테말라", "나이지리아", "네팔", "도미니카", "동티모르", "라오스", "모잠비크", "몽골", "미얀마", "방글라데시", "베트남", "볼리비아", "세네갈", "스리랑카",
    "알제리", "에콰도르", "에티오피아", "엘살바도르", "요르단", "우간다", "우즈베키스탄", "우크라이나", "이라크", "이집트", "인도네시아", "카메룬", "캄보디아", "케냐",
    "코트디부아르", "키르기스스탄", "키르기즈", "타지키스탄", "탄자니아", "튀니지", "투르크메니스탄", "파라과이", "파키스탄", "페루", "피지", "필리핀",
)
UNKNOWN_COUNTRY = "미상"
#: Order in which evidence of the categories is shown; others come last.
CATEGORY_ORDER = ("공사비", "설계비", "감리·CM비", "연면적·면적", "총사업비·예산", "부가세·예비비", "기간")
AMOUNT_STAGES = {
    "NOTICE_EXECUTION_CEILING": "집행한도",
    "NOTICE_EXECUTION_CEILING_RAW": "공고 집행한도(미검토)",
    "ADVERTISED_BUDGET_CAP": "광고예산 기준",
    "ADVERTISED_ESTIMATED_BUDGET": "광고 추정예산",
    "CONSTRUCTION_BUDGET": "공사예산",
    "DESIGN_ESTIMATE": "설계 추정금액",
    "BASIC_ESTIMATED_PRICE": "기초 추정가격",
    "BID_LIMIT": "입찰한도",
    "SERVICE_OR_GOODS_CEILING": "용역·물품 한도",
}
DOCUMENT_TYPES = (("BOQ", ("boq", "bill of quantities", "내역서", "물량")), ("도면", ("drawing", "도면", ".dwg")), ("시방서", ("specification", "시방")),
    ("가격·견적", ("price", "견적", "단가")))


def facility(text: Column) -> Column:
    return first_match(text, ((label, keyword_pattern(words)) for label, words in FACILITIES), UNCLASSIFIED)


def work(text: Column) -> Column:
    """Renovation before extension before new building."""
    return first_match(text, ((label, keyword_pattern(words)) for label, words in WORKS), "미분류")


def facility_family(*texts: Column) -> Column:
    return first_match(F.concat_ws(" ", *map(clean, texts)), FAMILIES, UNCLASSIFIED)


def family_aliases(family: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in FAMILY_ALIASES.items() for x in pair)), family)


def relation(title: Column, contract: Column) -> Column:
    """Supervision before project management before design before the contract type."""
    t, c = F.lower(clean_or_empty(title)), clean_or_empty(contract)
    return (
        F.when(t.rlike("감리|supervision"), "SUPERVISION")
        .when(t.rlike(r"사업관리|\bpmc?\b"), "PROJECT_MANAGEMENT")
        .when(t.rlike("설계|design"), "DESIGN")
        .when(c == "공사", "CONSTRUCTION_PACKAGE")
        .when(c == "물품", "GOODS")
        .when(c == "용역", "SERVICE")
        .otherwise("RELATED_PROCUREMENT")
    )


def construction_candidate(title: Column, contract: Column) -> Column:
    """A works contract, or a title with one of the construction keywords."""
    return F.coalesce(contract == "공사", F.lit(False)) | F.lower(F.coalesce(title, F.lit(""))).rlike(keyword_pattern(CONSTRUCTION_KEYWORDS))


def select_scope(bids: DataFrame, scope: str, flag: str = "construction_candidate") -> DataFrame:
    """The bids of a scope: none, construction (those with the flag) or any other for all."""
    return bids.limit(0) if scope == "none" else bids.where(flag) if scope == "construction" else bids


def category_rank(category: Column) -> Column:
    """Place of an evidence category, from 1; 99 for others."""
    place = F.array_position(F.array(*map(F.lit, CATEGORY_ORDER)), F.coalesce(category, F.lit(""))).cast("int")
    return F.when(place > 0, place).otherwise(99)


def _dictionary(rows: list[dict[str, str]], fields: str) -> Column:
    """Rows as one constant array of structs, whatever their number."""
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), f"array<struct<{fields}>>")


def find_country(text: Column) -> Column:
    """Struct (ko, en) of the country whose longest name is in the text; of equals the first of the table, then of the aliases; none: nulls."""
    named = [(ko, en, ko, en.lower()) for ko, en in COUNTRIES.items()] + [(ko, en, alias, alias) for alias, (ko, en) in COUNTRY_ALIASES.items()]
    # Every name by itself, the longest first: of each country its longest name that is there decides.
    names = sorted({(-len(n), place, n, ko, en, n != own) for place, (ko, en, own, other) in enumerate(named) for n in (own, other)})
    known = _dictionary([{"name": n, "ko": ko, "en": en, "folded": str(folded)} for _, _, n, ko, en, folded in names],
        "name string, ko string, en string, folded string")
    low = F.lower(text)
    hit = F.try_element_at(F.filter(known, lambda x: F.contains(F.when(x["folded"] == "True", low).otherwise(text), x["name"])), F.lit(1))
    return F.struct(hit["ko"].alias("ko"), hit["en"].alias("en"))


def country_by_name(country: Column, project_name: Column) -> Column:
    """The country that is given, else the longest country name with which the project's begins, else unknown."""
    name = normalize_text(project_name)
    begins = F.regexp_extract(name, "^(" + "|".join(sorted(COUNTRY_PREFIXES, key=len, reverse=True)) + ")", 1)
    return F.coalesce(F.nullif(normalize_text(country), F.lit("")), F.nullif(begins, F.lit("")), F.lit(UNKNOWN_COUNTRY))


def construction_relation(text: Column, category: Column) -> Column:
    """Struct of related (bool), reasons and keywords (arrays): strong words, or an asset with a service, weak word or works category."""
    strong, weak = keywords_in(text, STRONG_BUILDING), keywords_in(text, WEAK_CONSTRUCTION)
    asset, service = keywords_in(text, BUILDING_ASSETS), keywords_in(text, BUILDING_SERVICES)
    has = lambda a: F.size(a) > 0
    works = F.coalesce(F.trim(category) == "공사", F.lit(False))
    reasons = F.array_compact(
        F.array(F.when(works & has(asset), "입찰구분=공사+시설어"), F.when(has(strong), "강한건축어"), F.when(has(asset) & has(weak), "시설어+공사어"),
            F.when(has(asset) & has(service), "시설어+설계감리어"))
    )
    return F.struct((F.size(reasons) > 0).alias("related"), reasons.alias("reasons"), F.concat(strong, weak, asset, service).alias("keywords"))


def cost_relevant_title(contract: Column, title: Column) -> Column:
    """A works contract, or a title of works that isn't one of design, goods or supervision."""
    return (clean_or_empty(contract) == "공사") | (clean_or_empty(title).rlike(WORKS_TITLE) & ~clean_or_empty(title).rlike(OTHER_TITLE))


def scope_role(contract: Column, title: Column, override: Column | None = None) -> Column:
    """What an amount of a notice pays for; an override (null: none) goes first."""
    t, c = F.coalesce(title, F.lit("")), F.coalesce(contract, F.lit(""))
    service, works = t.rlike(SERVICE_TITLE), t.rlike(CONTRACTOR_TITLE)
    role = (
        F.when(c == "물품", "GOODS")
        .when((c == "공사") & service & ~works, "DESIGN_OR_SUPERVISION_SERVICE")
        .when((c == "공사") & t.rlike(r"설계\s*[·및/]?\s*시공"), "DESIGN_BUILD_WORKS")
        .when((c == "공사") | (works & ~service), "WORKS")
        .when(service, "DESIGN_OR_SUPERVISION_SERVICE")
        .otherwise("OTHER_SERVICE")
    )
    return role if override is None else F.coalesce(override, role)


def cost_stage(text: Column) -> Column:
    t = clean_or_empty(text)
    any_of = lambda *words: t.rlike("|".join(words))
    return (
        F.when(any_of("입찰 집행한도"), "NOTICE_EXECUTION_CEILING")
        .when(any_of("Construction Budget", "Project Budget"), "CONSTRUCTION_BUDGET")
        .when(any_of("추정공사비", "공사비 예산", "설계입찰 단계", "예비조사", "심층기획", "ToR"), "DESIGN_ESTIMATE")
        .when(any_of("추정예산"), "ADVERTISED_ESTIMATED_BUDGET")
        .when(any_of("직접 제시 계획단가"), "DIRECT_UNIT_RATE_ONLY")
        .otherwise("OTHER_PLANNING_AMOUNT")
    )


def stage_label(code: Column) -> Column:
    """Label of an amount stage; unknown codes as they are."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in AMOUNT_STAGES.items() for x in pair)), code), code)


def trade(sheet: Column, element: Column, heading: Column, description: Column) -> Column:
    """Trade of a bill row: rules on the sheet's name first, then on the sheet, its headings and the description."""
    low = F.lower(F.coalesce(sheet, F.lit("")))
    by_sheet = None
    for label, part in TRADES_BY_SHEET:
        by_sheet = F.when(F.contains(low, F.lit(part)), label) if by_sheet is None else by_sheet.when(F.contains(low, F.lit(part)), label)
    return F.coalesce(by_sheet, first_match(F.concat_ws(" ", sheet, element, heading, description), TRADES, "기타"))


def row_kind(description: Column, code: Column, unit: Column, quantity: Column, formula: Column, preliminaries: Column) -> Column:
    """total, item, item_unquantified or heading of a bill row."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    total = description.rlike(r"(?i)\b(?:sub\s*total|subtotal|grand\s+total|total|carried\s+to|brought\s+forward|collection)\b")
    return (
        F.when(total, "total")
        .when(filled(unit) & (quantity.isNotNull() | filled(formula)), "item")
        .when(filled(code) & filled(description) & (preliminaries | filled(unit)), "item_unquantified")
        .otherwise("heading")
    )


def document_types(path: Column) -> Column:
    """Labels of a file by its path, in the fixed order."""
    low = F.lower(path)
    return F.array_compact(F.array(*(F.when(low.rlike(keyword_pattern(words)), label) for label, words in DOCUMENT_TYPES)))


def compact_grade(grade: Column, unknown: str | None = None) -> Column:
    """A, B, C?, C, U or X by how the grade begins; C? is told from C first."""
    g = clean(grade)
    out = F.when(g.startswith("A"), "A").when(g.startswith("B"), "B").when(g.startswith("C?"), "C?").when(g.startswith("C"),
        "C").when(g.startswith("U"), "U").when(g.startswith("X"), "X")
    return out.otherwise(F.lit(unknown))


def grade_rank(grade: Column) -> Column:
    """A 6, B 5, C 4, C? 3, U 2, others 1; a C with a question mark anywhere isn't a plain C."""
    return (
        F.when(grade.startswith("A"), 6)
        .when(grade.startswith("B"), 5)
        .when(grade.startswith("C") & ~F.contains(grade, F.lit("?")), 4)
        .when(grade.startswith("C?"), 3)
        .when(grade.startswith("U"), 2)
        .otherwise(1)
    )
