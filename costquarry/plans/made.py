"""Files that tasks make of a table's rows; nothing here needs a session, as executors import it."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from costquarry.sources import office
from costquarry.sources.batches import batched
from costquarry.spread import dealt


def zipped(members: dict[str, bytes | str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return out.getvalue()


FILES = "path string, content binary"


def made_files(rows: DataFrame, make: Callable[..., Iterator[tuple[str, bytes]]]) -> DataFrame:
    """Files (path, content) that tasks make of rows: `make` is called with a row's values."""
    schema = to_arrow_schema(StructType.fromDDL(FILES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((x for b in batches for row in zip(*(c.to_pylist() for c in b.columns)) for x in make(*row)), schema)

    return dealt(rows).mapInArrow(run, FILES)


def office_file(key: int, name: str, segment: str) -> Iterator[tuple[str, bytes]]:
    kind = key % 6
    if kind == 0:
        cells = "".join(f"<w:tc><w:p><w:r><w:t>{x}</w:t></w:r></w:p></w:tc>" for x in (segment, key))
        body = f"<w:p><w:r><w:t>{name}</w:t></w:r></w:p><w:tbl><w:tr>{cells}</w:tr></w:tbl>"
        yield f"{key}.docx", zipped({"word/document.xml": f'<w:document xmlns:w="w"><w:body>{body}</w:body></w:document>'})
    elif kind == 1:
        yield f"{key}.pptx", zipped({f"ppt/slides/slide{i}.xml": f'<s xmlns:a="a"><a:t>{x}</a:t><a:t>x</a:t></s>' for i, x in ((2, name), (10, segment))})
    elif kind == 2:
        yield f"{key}.xlsx", office.write_xlsx({"One": [["Name", "Key"], [name, key]], "Two": [["=1+2", None, 'q"<']]})
    elif kind == 3:
        yield f"{key}.html", f"<p>가나 <b>{name}</b></p>".encode("cp949")
    elif kind == 4:
        yield f"{key}.xlsx", b"not a workbook"
    else:
        yield f"{key}.bin", b"x"


def hwp_file(key: int, name: str, segment: str) -> Iterator[tuple[str, bytes]]:
    """A body section with two paragraphs, one of them with the long form of a size, and a record of another tag; every seventh is broken."""
    one, two = (f"{x}\n 본문 ".encode("utf-16-le") for x in (name, segment))
    body = struct.pack("<I", 66 | 4 << 20) + b"skip" + struct.pack("<I", 67 | len(one) << 20) + one + struct.pack("<II", 67 | 0xFFF << 20, len(two)) + two
    packer = zlib.compressobj(wbits=-15)
    whole = packer.compress(body) + packer.flush()
    yield f"{key}/Section0", b"\xff" + whole if key % 7 == 6 else whole


def archive_file(key: int, name: str, segment: str) -> Iterator[tuple[str, bytes]]:
    kind = key % 5
    if kind == 0:
        yield f"{key}.zip", zipped({"n.txt": name, "in.zip": zipped({"s.txt": segment})})
    elif kind == 1:
        yield f"{key}.txt", name.encode()
    elif kind == 2:
        yield f"{key}.zip", b"no archive"
    elif kind == 3:
        yield f"{key}.zip", zipped({"../up.txt": "no", "s.txt": segment})
    else:
        yield f"{key}.zip", zipped({"a/n.txt": name, "a\\s.txt": segment})
