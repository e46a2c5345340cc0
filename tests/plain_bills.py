"""Bills of one sheet by a loop over its rows, to compare the relational version with."""

import re
from collections import Counter
from dataclasses import dataclass, field
from typing import NamedTuple

from costquarry.operators.boq import BLANK_RUN, BODY_ROWS, COLUMNS, HEADER_ROWS, HEADERS, LEAST_ROWS, TOTAL


class Row(NamedTuple):
    """Texts of a sheet's row, and the places of its cells that hold a positive number."""

    cells: list[str]
    positive: set[int]

    def under(self, columns: list[int]) -> list[str]:
        return [self.cells[c] for c in columns if c < len(self.cells)]


def read_row(values: list[object]) -> Row:
    cells = ["" if v is None else " ".join(str(v).split()) for v in values]
    plain = ((i, c.replace(",", "")) for i, c in enumerate(cells))
    return Row(cells, {i for i, c in plain if re.fullmatch(r"[-+]?\d+(?:\.\d+)?", c) and float(c) > 0})


def header(rows: list[Row], width: int) -> dict[str, list[int]] | None:
    """Columns by what they hold if these rows, joined, head a bill: a quantity, and a description, or a unit with a price."""
    heads = [" ".join(x for r in rows for x in r.under([c]) if x) for c in range(width)]
    found = {what: [c for c, h in enumerate(heads) if re.search(pattern, h, re.I)] for what, pattern in HEADERS.items()}
    priced = found["unit"] and (found["rate"] or found["amount"])
    return found if found["quantity"] and (found["description"] or priced) else None


@dataclass
class Table:
    """A table that may have begun at row `top`, as far as it has been read."""

    top: int
    columns: dict[str, list[int]]
    rows: Counter = field(default_factory=Counter)
    blank: int = 0
    last: int = 0

    def item(self, row: Row) -> bool:
        """A positive quantity with a description that names no total; left of the quantities if there is no such column."""
        if row.positive.isdisjoint(self.columns["quantity"]):
            return False
        words = " ".join(row.under(self.columns["description"])) or " ".join(filter(None, row.cells[: min(self.columns["quantity"])]))
        return bool(words) and not re.search(TOTAL, words, re.I)

    def read(self, at: int, row: Row) -> bool:
        """Take the row in; whether the table may go on behind it."""
        if self.item(row):
            priced = [k for k in ("rate", "amount") if not row.positive.isdisjoint(self.columns[k])]
            self.rows.update(["quantity", *priced, *["priced"] * bool(priced)])
            self.blank, self.last = 0, at
        else:
            self.blank = 0 if any(row.cells) else self.blank + 1
        ended = self.blank >= BLANK_RUN and self.rows["quantity"] >= LEAST_ROWS
        return not ended and at < self.top + BODY_ROWS


def letters(columns: list[int]) -> str:
    """Names of columns: A to Z, AA, AB, ..."""
    return ";".join((chr(64 + c // 26) if c >= 26 else "") + chr(65 + c % 26) for c in columns)


def table_signals(matrix: list[list[object]]) -> list[dict]:
    """Bill-like tables of one sheet, in one pass over its rows.

    Each row that heads a bill (joined with the two behind it) opens a table, and all open tables read each
    row. Of those with enough items the first counts, then the next that begins behind its last item.
    """
    rows = [read_row(r) for r in matrix]
    width = min(COLUMNS, max((len(r.cells) for r in rows), default=0))
    tables: list[Table] = []
    going: list[Table] = []
    for at, row in enumerate(rows):
        going = [t for t in going if t.read(at, row)]
        if at < HEADER_ROWS and (columns := header(rows[at : at + 3], width)):
            tables.append(Table(at, columns))
            going.append(tables[-1])
    out, end = [], -1
    for t in tables:
        if t.top > end and t.rows["quantity"] >= LEAST_ROWS:
            end = t.last
            named = {f"{k}_columns": letters(t.columns[k]) for k in ("description", "quantity", "rate", "amount")}
            counted = {f"{k}_rows": t.rows[k] for k in ("quantity", "rate", "amount", "priced")}
            out.append({"header_row": t.top + 1, **counted, "priced_ratio": t.rows["priced"] / t.rows["quantity"], **named})
    return out
