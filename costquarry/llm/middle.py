"""Fill-in-middle transformation by big-integer bit-parallelism.

A text's bytes become one integer a class: bytes.translate maps each byte to 0 or 1, and the whole is read as a
binary number whose bit i is byte i. A shift of the class of newlines marks where units end, bit_count says how
many there are, and the place of the j-th mark is found by halving the number again and again. No loop runs over
a text's characters or lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.llm import runtime

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM = 7, 100, 50


def _class(of: bytes) -> bytes:
    """A table for bytes.translate: 1 for the bytes of a class, 0 for others."""
    return bytes(48 + (b in of) for b in range(256))


NEWLINE = _class(b"\n")
FIRST = _class(bytes(b for b in range(256) if b & 0xC0 != 0x80))  # bytes that begin a code point


def mask(data: bytes, table: bytes) -> int:
    """Bit i is set where byte i is of the class."""
    return int(data[::-1].translate(table), 2) if data else 0


def line_ends(data: bytes) -> int:
    """Bit i is set where a line ends before byte i: after each newline, and after the last byte."""
    return mask(data, NEWLINE) << 1 | 1 << len(data) if data else 0


def char_ends(data: bytes) -> int:
    """Bit i is set where a code point ends before byte i."""
    return mask(data, FIRST) & ~1 | 1 << len(data) if data else 0


UNITS = {"lines": line_ends, "chars": char_ends}


def ranked(bits: int, j: int) -> int:
    """Place of the j-th set bit, counted from 1 (0 for j = 0), by halves: the lower half says by its count which half has it."""
    if j == 0:
        return 0
    at, width = 0, bits.bit_length()
    while width > 1:
        half = width // 2
        low = bits & (1 << half) - 1
        n = low.bit_count()
        if j <= n:
            bits, width = low, half
        else:
            bits, width, at, j = bits >> half, width - half, at + half, j - n
    return at


def cut(data: bytes, doc_id: object, unit: str = "lines", rate: int = RATE, spm: int = SPM, seed: int = SEED) -> tuple:
    """(units, form, code points of prefix and of middle, output) of one text."""
    ends = UNITS[unit](data)
    n = ends.bit_count()
    hashed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hashed[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not data or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return n, "plain", None, None, data
    a, b = (ranked(ends, j) for j in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    chars = mask(data, FIRST)
    first, second = ((chars & (1 << k) - 1).bit_count() for k in (a, b))
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h[3] % 100 < spm:
        return n, "spm", first, second - first, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", first, second - first, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text: str = "text", unit: str = "lines", rate: int = RATE, spm: int = SPM,
        seed: int = SEED) -> DataFrame:
    """One row per input row: id, n (units of the text), form, prefix_chars, middle_chars, output.

    unit: lines, or chars for code points. rate and spm: percent of documents that are cut, and of those that get
    the suffix first. Where a text is cut follows from its id and the seed alone. A text that is empty, null (as
    empty) or holds a mark is plain: its output is the text, prefix_chars and middle_chars are null. A null id counts
    as no digits. Repeated rows are kept and cut alike; an empty table gives no rows; other columns are not read.
    A text is one row, however long, and is held in memory a few times.
    """
    runtime.ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runtime.slices(batches, "_t"):
            ids = b.column("_i")
            got = [cut(t or b"", i, unit, rate, spm, seed) for i, t in zip(ids.to_pylist(), b.column("_t").to_pylist())]
            n, form, prefix, middle, output = (list(c) for c in zip(*got))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()), pa.array(output, pa.binary())], ["_i", "n", "form", "prefix_chars", "middle_chars", "output"])
        runtime.tidy()

    src = df.select(df[id_col].alias("_i"), df[text].cast("binary").alias("_t"))
    out = src.mapInArrow(run, f"_i {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.select(F.col("_i").alias(id_col), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The marks stand where they come first, as no part holds one."""
    at = F.position(F.when(form == "psm", F.lit("<S>")).otherwise(F.lit("<P>")), output)
    last = F.position(F.lit("<M>"), output)
    one, two = F.substring(output, F.lit(4), at - 4), F.substring(output, at + 3, last - at - 3)
    middle = F.substring(output, last + 3, F.char_length(output))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))


def digests(rows: DataFrame) -> DataFrame:
    """Outputs as the SHA-256 of themselves and of the texts restored from them."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    kept = [c for c in rows.columns if c != "output"]
    return rows.select(*kept, sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
        sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS hash FROM documents),
h AS (SELECT doc_id, text, lines, len(lines) AS n, ('0x' || hash[1:8])::BIGINT AS h1, ('0x' || hash[9:16])::BIGINT AS h2,
        ('0x' || hash[17:24])::BIGINT AS h3, ('0x' || hash[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
            WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""
