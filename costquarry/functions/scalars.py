"""String, number, date, hash and JSON functions over columns.

Blank and null are told apart: clean() folds blank to null, clean_or_empty() folds null to blank.
Rounding is half away from zero. All casts are tries, so malformed input gives null, never an error.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"(?U)\s+"


def clean(x: Column) -> Column:
    """Runs of white space (no-break and wide spaces too) as one space, trimmed; blank: null."""
    return F.nullif(F.trim(F.regexp_replace(x.cast("string"), SPACE, " ")), F.lit(""))


def clean_or_empty(x: Column) -> Column:
    return F.coalesce(clean(x), F.lit(""))


def _normal(form: str):
    @F.pandas_udf(T.StringType())
    def normal(x: pd.Series) -> pd.Series:
        return x.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize(form, s))

    return normal


nfc = _normal("NFC")
nfkc = _normal("NFKC")


def clean_nfc(x: Column) -> Column:
    """clean_or_empty() of canonical composition with NUL as a space."""
    return clean_or_empty(F.translate(nfc(x), "\0", " "))


def normalize_text(x: Column) -> Column:
    """Compatibility composition with white space folded; null: empty."""
    return clean_or_empty(nfkc(x))


def compact_text(x: Column) -> Column:
    """Lower-case letters, digits and Hangul syllables of the normalized text."""
    return F.lower(F.regexp_replace(normalize_text(x), "[^0-9A-Za-z가-힣]+", ""))


def normalize_title(x: Column) -> Column:
    """Comparable form of a title: no budget bracket, nothing after two dots, letters and digits only."""
    t = F.lower(nfkc(F.coalesce(x, F.lit(""))))
    t = F.regexp_replace(t, "…", "...")
    t = F.regexp_replace(t, r"[\(\[][^)\]]*(?:만불|백만불|억불|usd|달러)[^)\]]*[\)\]]?", " ")
    t = F.regexp_replace(t, r"(?s)\.{2,}.*$", " ")
    return F.regexp_replace(t, "[^0-9a-z가-힣]+", "")


def join_notes(*xs: Column, sep: str = " | ") -> Column:
    """Distinct non-blank notes in their order, joined; none: null."""
    notes = F.array_distinct(F.array_compact(F.array(*map(clean, xs))))
    return F.nullif(F.array_join(notes, sep), F.lit(""))


def label_list(*xs: Column, sep: str = "·", default: str) -> Column:
    """Non-null labels joined; none: the default."""
    return F.coalesce(F.nullif(F.concat_ws(sep, *xs), F.lit("")), F.lit(default))


def contains_ci(whole: Column, part: Column) -> Column:
    return F.instr(F.lower(F.coalesce(whole, F.lit(""))), F.lower(part)) > 0


def either_contains(a: Column, b: Column) -> Column:
    """One holds the other, whatever the case; false if `a` is null."""
    return F.coalesce(contains_ci(a, b) | F.when(a.isNotNull(), F.contains(F.lower(b), F.lower(a))), F.lit(False))


def safe_file_name(x: Column, most: int = 220) -> Column:
    return F.substring(F.trim(F.regexp_replace(x, r'[\x00-\x1f/\\:*?"<>|]+', "_")), 1, most)


def glob(x: Column, pattern: str) -> Column:
    """Whether the whole text fits a pattern with * (any run), ? (one character) and [...] (a set; ^ negates)."""
    out, at = [], 0
    while at < len(pattern):
        ch = pattern[at]
        close = pattern.find("]", at + 2) if ch == "[" else -1
        if close > 0:
            negated, inside = pattern[at + 1] == "^", pattern[at + 1 : close].lstrip("^")
            out.append("[" + "^" * negated + re.sub(r"([\\\[&^])", r"\\\1", inside) + "]")
            at = close
        else:
            out.append({"*": ".*", "?": "."}.get(ch, "\\Q" + ch + "\\E"))
        at += 1
    return x.rlike("(?s)^" + "".join(out) + "$")


def portable_path(path: Column, root: str, markers: tuple[str, ...]) -> Column:
    """Path below the root, else from the last marker folder on, else as it is; with forward slashes."""
    p = F.regexp_replace(path, r"\\", "/")
    base = root.rstrip("/") + "/"
    tails = [F.nullif(F.regexp_extract(p, rf"(?:^|/)({m}/.*)$", 1), F.lit("")) for m in markers]
    return F.coalesce(F.when(F.startswith(p, F.lit(base)), F.substr(p, F.lit(len(base) + 1))), *tails, p)


def safe_member_path(x: Column) -> Column:
    """Archive member path with forward slashes; null if empty, absolute or with a parent step."""
    p = F.regexp_replace(nfc(x), r"\\", "/")
    return F.when((p != "") & ~p.startswith("/") & ~p.rlike(r"(^|/)\.\.(/|$)"), p)


def excel_column(index: Column) -> Column:
    """0 -> A, 25 -> Z, 26 -> AA, up to three letters."""
    n = index.cast("int")
    letter = lambda k: F.char(k + 65)
    one, two, three = n % 26, F.floor(n / 26).cast("int"), F.floor((n - 26) / 676).cast("int")
    return F.when(n < 26, letter(one)).when(n < 702, F.concat(letter(two - 1), letter(one))).otherwise(F.concat(letter(three - 1),
        letter(F.floor((n - 702) / 26).cast("int") % 26), letter(one)))


# Numbers


def to_double(x: Column) -> Column:
    return F.nullif(F.trim(x.cast("string")), F.lit("")).try_cast("double")


def to_long(x: Column) -> Column:
    return F.nullif(F.trim(x.cast("string")), F.lit("")).try_cast("long")


def money(x: Column) -> Column:
    """Rounded to two places."""
    return F.round(to_double(x), 2)


def _number(x: Column) -> Column:
    return F.nullif(F.regexp_replace(x, ",", ""), F.lit("")).try_cast("double")


def usd_ceiling(x: Column) -> Column:
    """First amount that is marked as US dollars; amounts in other currencies are never converted."""
    got = F.regexp_extract(clean(x), r"(?i)(?:US\s*\$|USD|\$)\s*([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?)", 1)
    return F.round(_number(got), 2)


def amount(x: Column) -> Column:
    """First amount marked as US dollars, else the first number."""
    t = clean(x)
    marked = F.coalesce(F.nullif(F.regexp_extract(t, r"(?i)(?:(?:US\s*)?\$|USD)\s*([\d,]+(?:\.\d+)?)", 1), F.lit("")),
        F.regexp_extract(t, r"[-+]?\d[\d,]*(?:\.\d+)?", 0))
    return _number(marked)


def first_number(x: Column) -> Column:
    return _number(F.regexp_extract(x, r"\d[\d,]*(?:\.\d+)?", 0))


def area_number(x: Column) -> Column:
    """A number with ambiguous separators: several commas, or a comma and a dot, group thousands; one comma before one or two last digits is a decimal point. Not positive: null."""
    t = F.btrim(F.regexp_replace(x, SPACE, ""), F.lit(".,"))
    commas = F.length(t) - F.length(F.replace(t, F.lit(","), F.lit("")))
    plain = F.replace(t, F.lit(","), F.lit(""))
    decimal = (commas == 1) & ~F.contains(t, F.lit(".")) & F.length(F.substring_index(t, ",", -1)).isin(1, 2)
    value = F.when(decimal, F.replace(t, F.lit(","), F.lit("."))).otherwise(plain).try_cast("double")
    return F.when((value > 0) & (value < float("inf")), value)


def strict_number(x: Column) -> Column:
    """A whole cell that is a plain decimal number once commas are dropped."""
    t = F.replace(F.trim(x), F.lit(","), F.lit(""))
    return F.when(t.rlike(r"^[-+]?\d+(?:\.\d+)?$"), t.try_cast("double"))


def digits_to_long(x: Column) -> Column:
    return F.nullif(F.regexp_replace(x, r"[^\d-]", ""), F.lit("")).try_cast("long")


def program_budget_usd(title: Column) -> Column:
    """Budget in a title in units of 10^4, 10^6 or 10^8 dollars, looked for in that order."""
    t = F.replace(nfkc(title), F.lit(" "), F.lit(""))
    units = (("만불", 10_000), ("백만불", 1_000_000), ("억불", 100_000_000))
    return F.coalesce(*(F.round(_number(F.regexp_extract(t, rf"([\d,]+(?:\.\d+)?){u}", 1)) * m).cast("long") for u, m in units))


def ratio(a: Column, b: Column) -> Column:
    """a / b where both are there and not zero."""
    return F.when((a != 0) & (b != 0), F.try_divide(a, b))


def gap_percent(ceiling: Column, cost: Column, applies: Column) -> Column:
    return F.when(applies, (ratio(ceiling, cost) - 1) * 100)


def area_closeness(area: Column, target: float, points: float = 5.0) -> Column:
    """Points for an area near the target, rounded to two places; null area: 0."""
    a, t = area.cast("decimal(20,4)"), F.lit(target).cast("decimal(20,4)")
    near = F.greatest(F.lit(0).cast("decimal(20,4)"), 1 - F.abs(a - t) / t)
    return F.coalesce(F.round(F.lit(points).cast("decimal(4,1)") * near, 2), F.lit(0)).cast("decimal(10,2)")


def number_in_text(value: Column, text: Column) -> Column:
    """The whole number stands in the text, plain or with thousands separated."""
    n = value.cast("long")
    return F.contains(text, n.cast("string")) | F.contains(text, F.format_number(n, 0))


# Dates


def decimal_year(day: Column) -> Column:
    d = day.cast("date")
    begin = F.trunc(d, "year")
    return F.year(d) + (F.dayofyear(d) - 1) / F.datediff(F.add_months(begin, 12), begin)


def period_key(day: Column, frequency: Column) -> Column:
    """YYYY, YYYY-Qn or YYYY-MM of a date for annual, quarterly and monthly series; null otherwise."""
    d = day.cast("date")
    return (
        F.when(frequency == "annual", F.date_format(d, "yyyy"))
        .when(frequency == "quarterly", F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string")))
        .when(frequency == "monthly", F.date_format(d, "yyyy-MM"))
    )


def valid_partial_date(x: Column) -> Column:
    """YYYY-MM or YYYY-MM-DD with a month of 1 to 12 and a day of 1 to 31."""
    return x.rlike(r"^\d{4}-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?$")


def stamp_to_iso(x: Column) -> Column:
    """yyyyMMddHHmmss as ISO text; other texts as they are."""
    return F.regexp_replace(x, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6")


def has_zone(x: Column) -> Column:
    """ISO 8601 date and time with a zone."""
    return x.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$") & F.try_to_timestamp(x).isNotNull()


# Hashes and JSON


def is_sha256(x: Column) -> Column:
    return x.rlike("^[0-9a-f]{64}$")


def valid_json(x: Column) -> Column:
    """One whole JSON value. The parser stops behind a value, so it is read within brackets and within braces."""
    one = F.json_array_length(F.concat(F.lit("["), x, F.lit("]"))) == 1
    return F.coalesce(one & F.try_parse_json(F.concat(F.lit("["), x, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"x":'), x,
        F.lit("}"))).isNotNull(), F.lit(False))


def merge_fields(x: Column, **fields: Column) -> Column:
    """A struct with further fields; those that are there already are replaced."""
    for name, value in fields.items():
        x = x.withField(name, value)
    return x


def array_problem(x: Column, name: str, most: int, least: int = 0) -> Column:
    """What is wrong about a text that has to be a JSON array of least to most elements; null: nothing."""
    n = F.when(F.ltrim(x).startswith("["), F.json_array_length(x))
    few = F.lit(f"{name} must be a non-empty JSON array" if least else f"{name} must be a JSON array")
    return F.when(n.isNull() | (n < least), few).when(n > most, F.lit(f"{name} exceeds the {most} row safety limit"))


def to_json_with_nulls(x: Column) -> Column:
    return F.to_json(x, {"ignoreNullFields": "false"})


# Identifiers, lists, units


def project_no(x: Column) -> Column:
    return F.regexp_extract(F.upper(nfkc(F.coalesce(x, F.lit("")))), r"(?<![A-Z0-9])((?:19|20)\d{2}-\d{5})(?!\d)", 1)


def bid_no(x: Column) -> Column:
    return F.regexp_extract(F.upper(nfkc(F.coalesce(x, F.lit("")))), r"(?<![A-Z0-9])(L(?:19|20)\d{2}-\d{5}(?:-\d+)?)(?!\d)", 1)


def bid_base(x: Column) -> Column:
    """A notice number without its third part, which counts re-announcements."""
    return F.regexp_replace(x, r"^([^-]*-[^-]*)-\d+$", "$1")


def work_code(x: Column) -> Column:
    """Digits of a work code, padded to six."""
    return F.lpad(F.regexp_replace(F.regexp_replace(x.cast("string"), r"\.0$", ""), r"\D", ""), 6, "0")


def country_tokens(x: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"[,/·ㆍ]|\s+및\s+"), lambda t: F.trim(t)), lambda t: t != "")


# Measuring units and their short forms.
UNITS = {
    "SM": "m²", "SQM": "m²", "M2": "m²", "M²": "m²",
    "CM": "m³", "CUM": "m³", "M3": "m³", "M³": "m³",
    "LM": "m", "L.M": "m", "L/M": "m", "METRE": "m", "METRES": "m", "METER": "m", "METERS": "m",
    "KG": "kg", "KGS": "kg",
    "TON": "t", "TONNE": "t",
    "NO": "no.", "NO.": "no.", "NR": "no.", "EACH": "no.", "EA": "no.", "PCS": "no.", "PIECE": "no.", "PIECES": "no.", "PC": "no.",
    "SET": "set", "SETS": "set",
    "PKT": "pkt", "PKTS": "pkt",
    "ITEM": "item", "SUM": "item", "LS": "item", "LOT": "item",
    "L": "L", "LTR": "L", "LITRE": "L", "LITRES": "L",
}


def normalize_unit(x: Column) -> Column:
    """Short form of a unit; unknown ones as they are, null: empty."""
    key = F.replace(F.upper(clean_or_empty(x)), F.lit(" "), F.lit(""))
    known = F.create_map(*(F.lit(v) for pair in UNITS.items() for v in pair))
    return F.coalesce(F.try_element_at(known, key), clean_or_empty(x))
