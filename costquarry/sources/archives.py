"""Archives within archives: members of nested ZIP files, within stated limits."""

from __future__ import annotations

import io
import zipfile
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from costquarry.sources.batches import each_file

MEMBERS = "root string, path string, depth int, bytes long, content binary, error string"


@dataclass(frozen=True)
class Limits:
    members: int = 5_000
    archive_bytes: int = 2_000_000_000
    tree_bytes: int = 2_000_000_000
    depth: int = 8
    archives: int = 1_000


def safe(name: str) -> str | None:
    """Member path with forward slashes; None for empty, absolute and climbing paths."""
    import unicodedata

    path = unicodedata.normalize("NFC", name.replace("\\", "/"))
    return None if not path or path.startswith("/") or ".." in path.split("/") else path


def unpack(root: str, raw: bytes, limits: Limits = Limits()) -> Iterator[tuple[str, int, bytes, str]]:
    """(path, depth, content, error) of all files in an archive, breadth first; what breaks a limit is an error row, not a crash."""
    queue, total, opened = deque([("", raw, 0)]), 0, 0
    while queue:
        prefix, data, depth = queue.popleft()
        opened += 1
        if opened > limits.archives:
            yield prefix, depth, b"", "too many archives"
            return
        try:
            archive = zipfile.ZipFile(io.BytesIO(data))
            entries = [e for e in archive.infolist() if not e.is_dir()]
            if len(entries) > limits.members or sum(e.file_size for e in entries) > limits.archive_bytes:
                raise ValueError("archive exceeds a limit")
            for e in entries:
                name = safe(e.filename)
                if name is None:
                    yield prefix + e.filename, depth, b"", "unsafe path"
                    continue
                total += e.file_size
                if total > limits.tree_bytes:
                    raise ValueError("archives exceed a limit")
                content = archive.read(e)
                yield prefix + name, depth, content, ""
                if name.lower().endswith(".zip"):
                    if depth + 1 < limits.depth:
                        queue.append((f"{prefix}{name}!/", content, depth + 1))
                    else:
                        yield prefix + name, depth, b"", "too deep"
        except (zipfile.BadZipFile, ValueError, RuntimeError, NotImplementedError) as x:
            yield prefix or root, depth, b"", f"{type(x).__name__}: {x}"


def unpack_archives(files: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows (path, content) of archives to rows of their members; other files pass as their only member."""

    def rows(path: str, raw: bytes) -> Iterator[tuple]:
        if path.lower().endswith((".zip", ".hwpx")):
            return ((path, p, d, len(c), c, e or None) for p, d, c, e in unpack(path, raw, limits))
        return iter([(path, path.rsplit("/", 1)[-1], 0, len(raw), raw, None)])

    return each_file(files, rows, MEMBERS)
