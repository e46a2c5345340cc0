"""Text chunks (locator, text) and sheets from office files, by the standard library's ZIP and XML readers.

Formats whose readers are not there (PDF, legacy binary files) give no chunks; their text can be joined in
as a chunk table made elsewhere.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame

from costquarry.sources.batches import each_file

CHUNKS = "path string, pos int, locator string, text string, error string"
SECTIONS = "path string, pos int, text string, error string"
SHEETS = "path string, sheet string, sheet_state string, cells array<array<string>>, error string"
MOST_ROWS, MOST_COLUMNS = 5000, 80


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def column_name(at: int) -> str:
    """A, B, ..., Z, AA, ... of a column's place from 0."""
    name, k = "", at + 1
    while k:
        k, rest = divmod(k - 1, 26)
        name = chr(65 + rest) + name
    return name


def _all_text(node: ET.Element, tag: str = "t") -> str:
    return " ".join("".join(e.text or "" for e in node.iter() if _local(e.tag) == tag).split())


def docx(raw: bytes) -> Iterator[tuple[str, str]]:
    """Paragraphs outside tables, then table rows with cells joined by bars."""
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml"))[0]
    paragraphs = [e for e in body if _local(e.tag) == "p"]
    for i, p in enumerate(paragraphs, 1):
        if text := _all_text(p):
            yield f"문단 {i}", text
    for t, table in enumerate((e for e in body.iter() if _local(e.tag) == "tbl"), 1):
        for r, row in enumerate((e for e in table if _local(e.tag) == "tr"), 1):
            cells = [_all_text(c) for c in row if _local(c.tag) == "tc"]
            if any(cells):
                yield f"표 {t} 행 {r}", " | ".join(cells)


def pptx(raw: bytes) -> Iterator[tuple[str, str]]:
    """Slides in the order of their numbers."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    slides = sorted((int(m[1]), n) for n in z.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
    for i, name in slides:
        if text := " ".join(t for e in ET.fromstring(z.read(name)).iter() if _local(e.tag) == "t" and (t := (e.text or "").strip())):
            yield f"슬라이드 {i}", text


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def sheets(raw: bytes) -> Iterator[tuple[str, str, list[list[str]], dict[str, str]]]:
    """(name, state, matrix, formulas by cell) of each worksheet, at most 5,000 by 80 cells."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    names = set(z.namelist())
    shared = [_all_text(e) for e in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    rels = {e.get("Id"): e.get("Target") for e in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    for s in (e for e in ET.fromstring(z.read("xl/workbook.xml")).iter() if _local(e.tag) == "sheet"):
        target = rels[next(v for k, v in s.attrib.items() if _local(k) == "id")]
        target = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        matrix: list[list[str]] = []
        formulas: dict[str, str] = {}
        for c in (e for e in ET.fromstring(z.read(target)).iter() if _local(e.tag) == "c"):
            ref = c.get("r", "")
            row, col = int(re.search(r"\d+", ref)[0]) - 1, _column(ref)
            if row >= MOST_ROWS or col >= MOST_COLUMNS:
                continue
            value = next((e.text or "" for e in c if _local(e.tag) == "v"), "")
            if c.get("t") == "s" and value:
                value = shared[int(value)]
            elif c.get("t") == "inlineStr":
                value = _all_text(c)
            formula = next((e.text for e in c if _local(e.tag) == "f"), None)
            if formula:
                formulas[ref] = "=" + formula
            while len(matrix) <= row:
                matrix.append([])
            while len(matrix[row]) <= col:
                matrix[row].append("")
            matrix[row][col] = value
        yield s.get("name", ""), s.get("state", "visible"), matrix, formulas


def xlsx(raw: bytes) -> Iterator[tuple[str, str]]:
    """Rows as `A1=value | B1=value`, formulas in place of their values."""
    for name, _, matrix, formulas in sheets(raw):
        for r, row in enumerate(matrix, 1):
            cells = []
            for c, value in enumerate(row):
                ref = f"{column_name(c)}{r}"
                if shown := formulas.get(ref) or " ".join(value.split()):
                    cells.append(f"{ref}={shown}")
            if cells:
                yield f"{name}!{r}", " | ".join(cells)


def hwp_section(stream: bytes) -> Iterator[str]:
    """Paragraph texts of a raw-deflated HWP body section: records of tag 67."""
    data, at = zlib.decompress(stream, -15), 0
    while at + 4 <= len(data):
        (head,) = struct.unpack_from("<I", data, at)
        tag, size, at = head & 0x3FF, head >> 20, at + 4
        if size == 0xFFF:
            (size,) = struct.unpack_from("<I", data, at)
            at += 4
        if tag == 67:
            text = data[at : at + size].decode("utf-16-le", "ignore")
            if text := " ".join(re.sub(r"[\x00-\x1f]", " ", text).split()):
                yield text
        at += size


def plain(raw: bytes) -> Iterator[tuple[str, str]]:
    from costquarry.sources.tables import decode

    if text := " ".join(re.sub(r"<[^>]+>", " ", decode(raw)[0]).split()):
        yield "본문", text


READERS = {"docx": docx, "pptx": pptx, "xlsx": xlsx, "xlsm": xlsx, "txt": plain, "csv": plain, "xml": plain, "html": plain, "htm": plain}


def extract_chunks(files: DataFrame) -> DataFrame:
    """Files (path, content) to chunks by their suffix; unknown suffixes give none, broken files an error row."""

    def rows(path: str, raw: bytes) -> list[tuple]:
        reader = READERS.get(path.rsplit(".", 1)[-1].lower())
        try:
            return [(path, i, where, text, None) for i, (where, text) in enumerate(reader(raw))] if reader else []
        except Exception as x:  # a broken file is reported and the run goes on
            return [(path, 0, None, None, f"{type(x).__name__}: {x}")]

    return each_file(files, rows, CHUNKS)


def extract_sections(files: DataFrame) -> DataFrame:
    """HWP body sections (path, content) to their paragraphs; a broken section is an error row, without those paragraphs that were read."""

    def rows(path: str, raw: bytes) -> list[tuple]:
        try:
            return [(path, i, text, None) for i, text in enumerate(hwp_section(raw))]
        except (zlib.error, struct.error) as x:
            return [(path, 0, None, f"{type(x).__name__}: {x}")]

    return each_file(files, rows, SECTIONS)


def extract_sheets(files: DataFrame) -> DataFrame:
    """Workbooks (path, content) to bounded matrices, hidden sheets included; a broken workbook is an error row."""

    def rows(path: str, raw: bytes) -> list[tuple]:
        try:
            return [(path, name, state, matrix, None) for name, state, matrix, _ in sheets(raw)]
        except Exception as x:  # a broken file is reported and the run goes on
            return [(path, None, None, None, f"{type(x).__name__}: {x}")]

    return each_file(files, rows, SHEETS)


def write_xlsx(tables: dict[str, list[list[object]]]) -> bytes:
    """A workbook with a sheet for each table; texts that begin with an equals sign are formulas, numbers stay numbers."""
    from xml.sax.saxutils import escape, quoteattr

    def cell(r: int, c: int, v: object) -> str:
        ref = f"{column_name(c)}{r}"
        if v is None:
            return ""
        if isinstance(v, str) and v.startswith("="):
            return f'<c r="{ref}"><f>{escape(v[1:])}</f></c>'
        if isinstance(v, int | float) and not isinstance(v, bool):
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    names = list(tables)
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="{kinds}.worksheet+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>",
    }
    for i, rows in enumerate(tables.values(), 1):
        body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
        parts[f"xl/worksheets/sheet{i}.xml"] = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text)
    return out.getvalue()
