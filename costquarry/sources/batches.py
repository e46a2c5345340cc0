"""Rows that tasks make of rows in Python, handed on in batches of a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MOST_ROWS, MOST_BYTES = 10_000, 16 << 20


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as record batches: a batch is full at MOST_ROWS rows, or as soon as its texts and contents have MOST_BYTES."""
    held: list[tuple] = []
    size = 0

    def full() -> pa.RecordBatch:
        columns = zip(*held) if held else ([] for _ in schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r if isinstance(v, (str, bytes)))
        if len(held) >= MOST_ROWS or size >= MOST_BYTES:
            yield full()
            held, size = [], 0
    if held:
        yield full()


def each_file(files: DataFrame, rows: Callable[[str, bytes], Iterator[tuple]], ddl: str) -> DataFrame:
    """Files (path, content) to the rows that `rows` gives of each."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = ((p.as_py(), c.as_py()) for b in batches for p, c in zip(b.column("path"), b.column("content")))
        yield from batched((r for path, raw in each for r in rows(path, raw)), schema)

    return files.select("path", "content").mapInArrow(run, ddl)
