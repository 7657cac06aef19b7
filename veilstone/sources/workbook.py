"""Sink: DataFrames as sheets of one xlsx file, written row by row with the standard library.

A workbook is a driver-side file by nature; rows stream through a local iterator, one partition at a time, and a
sheet over the format's limit of rows is refused. Widths need a look at all values first, so each DataFrame is read
twice: persist what is costly to compute.

Nothing is lost: characters that XML doesn't know are written in the format's own way (_x0007_), and what exceeds the
format's limit of a cell goes to a last sheet, OVERFLOW, with sheet, row, column and number of the part.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 1_048_575
MAX_CELL = 32_767  # UTF-16 units
OVERFLOW = "Overflow"
MAX_WIDTH, EMPTY_WIDTH, MARGIN = 60, 10, 4
HEADER, MARKED, LANGUAGE, EVEN = 1, 2, 3, 4  # cell styles
UNMARKED = {"None", "N/A", "OCR Failed", "Load Failed", "All PII types detected", ""}
_FILLS = ["1F4E79", "FFE0E0", "FFF3CD", "EBF3FB"]
_STYLES = (
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts>'
    '<fills count="6"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>'
    + "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{c}"/></patternFill></fill>' for c in _FILLS)
    + '</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="5"><xf/>'
    '<xf fillId="2" fontId="1" applyFill="1" applyFont="1" applyAlignment="1"><alignment wrapText="1"/></xf>'
    + "".join(f'<xf fillId="{i}" applyFill="1" applyAlignment="1"><alignment wrapText="1"/></xf>' for i in (3, 4, 5))
    + "</cellXfs></styleSheet>"
)


def _name(i: int) -> str:
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ud800-\udfff\ufffe\uffff]")
_LIKE_ODD = re.compile("_(?=x[0-9A-Fa-f]{4}_)")


def _written(text: str) -> str:
    """Text in the format's way: characters XML can't hold as _xHHHH_, and '_' before what looks like one as well."""
    return _ODD.sub(lambda m: f"_x{ord(m.group()):04X}_", _LIKE_ODD.sub("_x005F_", text)).replace("\r", "_x000D_")


def parts(text: str) -> list[str]:
    """The text in pieces of one cell each."""
    if 2 * len(text) <= MAX_CELL:
        return [text]
    out, at, size = [], 0, 0
    for i, c in enumerate(text):
        units = 2 if c > "\uffff" else 1
        if size + units > MAX_CELL:
            out.append(text[at:i])
            at, size = i, 0
        size += units
    return [*out, text[at:]]


def _cell(at: str, value, style: int) -> str:
    s = f' s="{style}"' if style else ""
    if isinstance(value, bool) or value is None or not isinstance(value, (int, float)):
        return f'<c r="{at}"{s} t="inlineStr"><is><t xml:space="preserve">{escape(_written("" if value is None else str(value)))}</t></is></c>'
    return f'<c r="{at}"{s}><v>{value}</v></c>'


def _style(column: str, value, row: int) -> int:
    low = column.lower()
    if any(w in low for w in ("pii", "detected", "anonymized")) and str(value) not in UNMARKED and value is not None:
        return MARKED
    if low == "language":
        return LANGUAGE
    return EVEN if row % 2 == 0 else 0


def column_widths(df: DataFrame) -> list[int]:
    """Width of each column: its longest value or name and a margin, within bounds."""
    if not df.columns:
        return []
    longest = df.agg(*[F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(f"w{i}") for i, c in enumerate(df.columns)]).first()
    return [min(max(longest[i] or 0, len(c), 0 if c else EMPTY_WIDTH) + MARGIN, MAX_WIDTH) for i, c in enumerate(df.columns)]


def _sheet(name: str, columns: list[str], widths: list[int], rows: Iterator, over: list[tuple], styled: bool = True) -> Iterator[str]:
    """The sheet's XML; what doesn't fit into a cell is appended to over."""
    yield '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
    if widths:
        yield "<cols>" + "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1)) + "</cols>"
    yield '<sheetData><row r="1" ht="28" customHeight="1">' + "".join(_cell(f"{_name(c)}1", col, HEADER) for c, col in enumerate(columns)) + "</row>"
    for r, row in enumerate(rows, 2):
        if r - 1 > MAX_ROWS:
            raise ValueError("a sheet holds no more than a million rows; write parquet instead")
        cells = []
        for c, v in enumerate(row):
            if isinstance(v, str):
                v, *more = parts(v)
                over += [(name, r, columns[c], k, x) for k, x in enumerate(more, 2)]
            cells.append(_cell(f"{_name(c)}{r}", v, _style(columns[c], v, r) if styled else 0))
        yield f'<row r="{r}">' + "".join(cells) + "</row>"
    yield "</sheetData></worksheet>"


def write_workbook(path: str, sheets: dict[str, DataFrame]) -> None:
    """Write the DataFrames under their names; the first row of each sheet is frozen."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names, over = list(sheets), []

        def write(n: int, lines: Iterator[str]) -> None:
            with z.open(f"xl/worksheets/sheet{n}.xml", "w") as out:
                for line in lines:
                    out.write(line.encode())

        for i, (name, df) in enumerate(sheets.items(), 1):
            write(i, _sheet(name, df.columns, column_widths(df), df.toLocalIterator(), over))
        if over:
            names.append(OVERFLOW)
            write(len(names), _sheet(OVERFLOW, ["sheet", "row", "column", "part", "text"], [], iter(over), [], styled=False))
        numbers = range(1, len(names) + 1)
        z.writestr(
            "[Content_Types].xml",
            f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>'
            + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in numbers)
            + "</Types>",
        )
        z.writestr("_rels/.rels", f'<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(s)}" sheetId="{i}" r:id="r{i}"/>' for i, s in zip(numbers, names)) + "</sheets></workbook>")
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{pack}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers) + f'<Relationship Id="r{len(names) + 1}" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        )
        z.writestr("xl/styles.xml", _STYLES)
