"""Workbook (xlsx) scan.

A folder of workbooks is read with the ``binaryFile`` source - one row per
file.  The work is then split in two, so that one big workbook does not end
up in one task:

1. *Cut* (one task per workbook, as a zip member is one deflate stream): the
   sheet XML is inflated and cut at row ends into chunks of about 1 MB.  Each
   chunk is a self-contained XML fragment carrying the row number before it,
   the shared strings its cells may refer to, and the date styles.  This step
   only runs C-level regular expressions over the text - far cheaper than
   parsing.
2. *Parse* (spread): the chunks are rebalanced over the cluster (AQE sizes
   the partitions) and each is parsed into rows of
   ``(workbook, sheet, row_no, cells)`` by parser callbacks, with no element
   tree.

Typed tables per sheet follow: the header row names the columns (blanks become
underscores), the other rows are typed with the one-pass inference of
``quayside.functions.types``.
"""

from __future__ import annotations

import datetime as dt
import functools
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.names import sheet_table_name, underscore_names
from quayside.functions.types import apply_types, infer_types
from quayside.session import run_concurrently, ship_package

CELL_SCHEMA = "workbook string, sheet string, row_no int, cells array<string>"
BATCH_ROWS = 4096

_NS_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_NS_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_NS_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# Number formats built into the file format that show dates
# (14-17, 22 and 45-47 with a date, 18-21 time only).
_BUILTIN_DATE_FORMATS = {14, 15, 16, 17, 22, 45, 46, 47}
_BUILTIN_TIME_FORMATS = {18, 19, 20, 21}
_EPOCH = dt.datetime(1899, 12, 30)

_DIGITS = "0123456789"


@functools.lru_cache(maxsize=4096)
def _letters_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    name = "xl/sharedStrings.xml"
    if name not in zf.namelist():
        return []
    out = []
    with zf.open(name) as fh:
        for _, el in ET.iterparse(fh):
            if el.tag == f"{_NS_MAIN}si":
                out.append("".join(t.text or "" for t in el.iter(f"{_NS_MAIN}t")))
                el.clear()
    return out


def _date_styles(zf: zipfile.ZipFile) -> dict[int, str]:
    """Style index -> 'date' / 'datetime' / 'time' for date-showing styles."""
    name = "xl/styles.xml"
    if name not in zf.namelist():
        return {}
    root = ET.fromstring(zf.read(name))
    custom = {}
    fmts = root.find(f"{_NS_MAIN}numFmts")
    if fmts is not None:
        for f in fmts:
            code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower()
            has_date = any(ch in code for ch in "dy") or ("m" in code and "h" not in code and "s" not in code)
            has_time = any(ch in code for ch in "hs")
            if has_date or has_time:
                kind = "datetime" if has_date and has_time else ("date" if has_date else "time")
                custom[int(f.get("numFmtId"))] = kind
    out = {}
    xfs = root.find(f"{_NS_MAIN}cellXfs")
    if xfs is None:
        return out
    for i, xf in enumerate(xfs):
        fid = int(xf.get("numFmtId", "0"))
        if fid in custom:
            out[i] = custom[fid]
        elif fid == 22:
            out[i] = "datetime"
        elif fid in _BUILTIN_DATE_FORMATS:
            out[i] = "date"
        elif fid in _BUILTIN_TIME_FORMATS:
            out[i] = "time"
    return out


def _sheet_paths(zf: zipfile.ZipFile) -> list[tuple[str, str]]:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.iter(f"{_NS_PKG_REL}Relationship")}
    out = []
    for sheet in wb.iter(f"{_NS_MAIN}sheet"):
        t = target[sheet.get(f"{_NS_REL}id")]
        path = t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join("xl", t))
        out.append((sheet.get("name"), path))
    return out


def _serial_text(value: str, kind: str) -> str:
    moment = _EPOCH + dt.timedelta(days=float(value))
    moment = moment.replace(microsecond=round(moment.microsecond / 1000) * 1000 % 1_000_000)
    if kind == "date" and moment.time() == dt.time(0):
        return moment.date().isoformat()
    if kind == "time":
        return moment.time().isoformat()
    return moment.isoformat(sep=" ")


_TAG_ROW = f"{_NS_MAIN}row"
_TAG_CELL = f"{_NS_MAIN}c"
_TAG_VALUE = f"{_NS_MAIN}v"
_TAG_INLINE = f"{_NS_MAIN}is"
_TAG_TEXT = f"{_NS_MAIN}t"


class _SheetRows:
    """Parser target: turns a sheet's XML into (row_no, cells) as it is fed.

    The parser calls ``start`` / ``data`` / ``end`` per element; rows are built
    straight from those calls, with no element tree, and handed out after
    every fed chunk - memory holds one chunk of rows.
    """

    def __init__(self, strings: list[str], date_styles: dict[int, str]):
        self.strings = strings
        self.date_styles = date_styles
        self.done: list[tuple[int, list]] = []
        self.row_no = 0
        self.cells: list | None = None
        self.kind = "n"
        self.ref = None
        self.style = None
        self.text: list[str] | None = None   # text of the open <v> / inline <t>
        self.value: str | None = None
        self.inline: list[str] | None = None

    def start(self, tag, attrib):
        # Most frequent tags first: one <c> and one <v> per cell.
        if tag == _TAG_CELL:
            self.ref = attrib.get("r")
            self.kind = attrib.get("t", "n")
            self.style = attrib.get("s")
            self.value = None
            self.inline = None
        elif tag == _TAG_VALUE:
            self.text = []
        elif tag == _TAG_ROW:
            r = attrib.get("r")
            self.row_no = int(r) if r else self.row_no + 1
            self.cells = []
        elif tag == _TAG_INLINE:
            self.inline = []
        elif tag == _TAG_TEXT and self.inline is not None:
            self.text = []

    def data(self, text):
        if self.text is not None:
            self.text.append(text)

    def end(self, tag):
        if tag == _TAG_VALUE:
            self.value = "".join(self.text)
            self.text = None
        elif tag == _TAG_CELL:
            cells = self.cells
            ref = self.ref
            if ref:
                idx = _letters_index(ref.rstrip(_DIGITS))
                if len(cells) < idx:
                    cells.extend([None] * (idx - len(cells)))
            kind = self.kind
            v = self.value
            if kind == "n":
                # A cell without a style attribute has style 0.
                if v is not None and self.date_styles:
                    style = self.date_styles.get(int(self.style) if self.style else 0)
                    if style:
                        v = _serial_text(v, style)
            elif kind == "s":
                v = None if v is None else self.strings[int(v)]
            elif kind == "inlineStr":
                v = None if self.inline is None else "".join(self.inline)
            elif kind == "b":
                v = None if v is None else ("true" if v == "1" else "false")
            cells.append(v)
        elif tag == _TAG_ROW:
            self.done.append((self.row_no, self.cells))
            self.cells = None
        elif tag == _TAG_TEXT and self.inline is not None and self.text is not None:
            self.inline.append("".join(self.text))
            self.text = None

    def close(self):
        return None


CHUNK_SCHEMA = (
    "workbook string, sheet string, seq long, row_before long, xml binary, "
    "string_ids array<int>, string_texts array<string>, "
    "style_ids array<int>, style_kinds array<string>"
)
CHUNK_BYTES = 1 << 20
# Chunks handed to Spark at a time by the cutting task.
_CHUNKS_PER_BATCH = 8

# Sheet XML structure, prefix-tolerant (``<x:row>`` as well as ``<row>``).
_SHEETDATA_OPEN = re.compile(rb"<(?:[\w.-]+:)?sheetData\b[^>]*>")
_SHEETDATA_CLOSE = re.compile(rb"</(?:[\w.-]+:)?sheetData\s*>")
_NS_DECL = re.compile(rb"""\s(xmlns(?::[\w.-]+)?)\s*=\s*("[^"]*"|'[^']*')""")
_ROW_OPEN = re.compile(rb"<(?:[\w.-]+:)?row\b([^>]*)>")
_ROW_NUMBER = re.compile(rb"""\sr\s*=\s*["'](\d+)["']""")
_ROW_CLOSE = re.compile(rb"</(?:[\w.-]+:)?row\s*>")
# Every whole-number cell value; shared-string references are among them.
_INT_VALUE = re.compile(rb"<(?:[\w.-]+:)?v\s*>\s*(\d+)\s*</")


def _sheet_chunks(fh, chunk_bytes: int) -> Iterator[tuple[bytes, bytes]]:
    """(wrapper open tag, rows) pieces of one sheet's XML, cut after a row end."""
    head, data = b"", b"."
    match = None
    while match is None and data:
        data = fh.read(chunk_bytes)
        head += data
        match = _SHEETDATA_OPEN.search(head)
    if match is None or head[match.end() - 2:match.end()] == b"/>":
        return  # no rows
    # Namespace declarations in scope at <sheetData> make each piece parse alone.
    decls: dict[bytes, bytes] = {}
    for name, value in _NS_DECL.findall(head[:match.end()]):
        decls[name] = value
    opener = b"<chunk" + b"".join(b" " + k + b"=" + v for k, v in decls.items()) + b">"
    buf, eof = head[match.end():], False
    while True:
        close = _SHEETDATA_CLOSE.search(buf)
        if close is None and not eof and len(buf) < chunk_bytes:
            data = fh.read(chunk_bytes)
            eof, buf = not data, buf + data
            continue
        if close is not None:
            body, buf, final = buf[:close.start()], b"", True
        else:
            last = None
            for last in _ROW_CLOSE.finditer(buf):
                pass
            if last is None and not eof:  # one row longer than a chunk: read on
                data = fh.read(chunk_bytes)
                eof, buf = not data, buf + data
                continue
            if last is None:
                body, buf, final = buf, b"", True
            else:
                body, buf, final = buf[:last.end()], buf[last.end():], False
        if body.strip():
            yield opener, body
        if final:
            return


def iter_sheet_chunks(
    name: str, content: bytes, chunk_bytes: int = CHUNK_BYTES
) -> Iterator[tuple]:
    """Chunks of every sheet of one workbook, in ``CHUNK_SCHEMA`` order."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        strings = _shared_strings(zf)
        styles = _date_styles(zf)
        style_ids, style_kinds = list(styles), list(styles.values())
        for sheet, path in _sheet_paths(zf):
            row_before = 0
            with zf.open(path) as fh:
                for seq, (opener, body) in enumerate(_sheet_chunks(fh, chunk_bytes)):
                    ids = sorted(i for i in {int(v) for v in set(_INT_VALUE.findall(body))}
                                 if i < len(strings))
                    yield (name, sheet, seq, row_before, opener + body + b"</chunk>",
                           ids, [strings[i] for i in ids], style_ids, style_kinds)
                    for m in _ROW_OPEN.finditer(body):
                        r = _ROW_NUMBER.search(m.group(1))
                        row_before = int(r.group(1)) if r else row_before + 1


def parse_chunk(xml: bytes, row_before: int, strings: dict, date_styles: dict) -> list:
    """(row_no, cells) of every row in one chunk."""
    target = _SheetRows(strings, date_styles)
    target.row_no = row_before
    parser = ET.XMLParser(target=target)
    parser.feed(xml)
    parser.close()
    return target.done


def iter_workbook_rows(name: str, content: bytes, chunk_bytes: int = CHUNK_BYTES
                       ) -> Iterator[tuple[str, str, int, list]]:
    """Rows of every sheet of one workbook, read in one place: (workbook, sheet, row_no, cells)."""
    for _, sheet, _, row_before, xml, ids, texts, sids, kinds in iter_sheet_chunks(
        name, content, chunk_bytes
    ):
        for row_no, cells in parse_chunk(xml, row_before, dict(zip(ids, texts)),
                                         dict(zip(sids, kinds))):
            yield name, sheet, row_no, cells


_CHUNK_COLUMNS = ["workbook", "sheet", "seq", "row_before", "xml", "string_ids",
                  "string_texts", "style_ids", "style_kinds"]
_CELL_COLUMNS = ["workbook", "sheet", "row_no", "cells"]


def _cut_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            out = []
            for chunk in iter_sheet_chunks(path, bytes(content)):
                out.append(chunk)
                if len(out) >= _CHUNKS_PER_BATCH:
                    yield pd.DataFrame(out, columns=_CHUNK_COLUMNS)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=_CHUNK_COLUMNS)


def _parse_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for rec in pdf.itertuples(index=False):
            strings = dict(zip(rec.string_ids, rec.string_texts))
            styles = dict(zip(rec.style_ids, rec.style_kinds))
            for row_no, cells in parse_chunk(bytes(rec.xml), rec.row_before, strings, styles):
                rows.append((rec.workbook, rec.sheet, row_no, cells))
                if len(rows) >= BATCH_ROWS:
                    yield pd.DataFrame(rows, columns=_CELL_COLUMNS)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=_CELL_COLUMNS)


def read_workbook_cells(spark: SparkSession, path: str | list[str], glob: str = "*.xlsx") -> DataFrame:
    """(workbook, sheet, row_no, cells) for every row of every sheet."""
    ship_package(spark)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
    chunks = files.mapInPandas(_cut_chunks, CHUNK_SCHEMA)
    # Spread the chunks: hash on their small key columns (no sort of the XML),
    # and AQE splits or merges partitions to its advisory size, which also
    # bounds what one parsing task receives.
    spread = chunks.hint("rebalance", "workbook", "sheet", "seq")
    return spread.mapInPandas(_parse_chunks, CELL_SCHEMA)


def sheet_names(cells: DataFrame) -> list[str]:
    """Distinct sheet names (one small aggregate)."""
    return sorted(r[0] for r in cells.select("sheet").distinct().collect())


def sheet_headers(cells: DataFrame) -> dict[str, list]:
    """Header row of every sheet - row 1 of the first workbook (by name) that
    has the sheet - from one job; one row per sheet reaches the driver."""
    rows = (
        cells.filter(F.col("row_no") == 1)
        .groupBy("sheet")
        .agg(F.min_by("cells", "workbook").alias("cells"))
        .collect()
    )
    return {r["sheet"]: list(r["cells"]) for r in rows}


def _header_names(header: list) -> list[str]:
    names = underscore_names([h if h is not None else "" for h in header])
    return [n if n else f"col_{i}" for i, n in enumerate(names)]


def _untyped_sheet(cells: DataFrame, sheet: str, header: list) -> DataFrame:
    data = cells.filter((F.col("sheet") == sheet) & (F.col("row_no") > 1))
    return data.select(
        *[F.try_element_at(F.col("cells"), F.lit(i + 1)).alias(n)
          for i, n in enumerate(_header_names(header))]
    )


def _inferred(table: DataFrame) -> dict[str, str]:
    return {r["column_name"]: r["inferred_type"] for r in infer_types(table).collect()}


def sheet_frame(cells: DataFrame, sheet: str, typed: bool = True) -> DataFrame:
    """The table of one sheet across all workbooks that contain it.

    Row 1 of each workbook's sheet is its header; the header of the first
    workbook (by name) names the columns.  With ``typed`` the columns get the
    inferred types (one extra aggregate job).
    """
    header = (
        cells.filter((F.col("sheet") == sheet) & (F.col("row_no") == 1))
        .orderBy("workbook").select("cells").first()
    )
    if header is None:
        raise ValueError(f"sheet {sheet!r} has no header row")
    table = _untyped_sheet(cells, sheet, list(header["cells"]))
    return apply_types(table, _inferred(table)) if typed else table


def sheet_tables(cells: DataFrame, typed: bool = True) -> dict[str, DataFrame]:
    """Every sheet as a table named after it (blanks -> underscores).

    All headers come from one job; the sheets' type inferences are
    independent jobs and run at the same time.
    """
    names = sheet_names(cells)
    headers = sheet_headers(cells)
    missing = [s for s in names if s not in headers]
    if missing:
        raise ValueError(f"sheets without a header row: {missing}")
    tables = {s: _untyped_sheet(cells, s, headers[s]) for s in names}
    if typed:
        types = run_concurrently(
            cells.sparkSession, {s: (lambda t=t: _inferred(t)) for s, t in tables.items()}
        )
        for s, got in types.items():
            if isinstance(got, Exception):
                raise got
        tables = {s: apply_types(t, types[s]) for s, t in tables.items()}
    return {sheet_table_name(s): t for s, t in tables.items()}


def stage_cells(cells: DataFrame, path: str) -> DataFrame:
    """Parse once: write the cell rows partitioned by sheet and read them back.

    Every later per-sheet step (header, inference, typed table) then reads
    only its sheet's partition instead of parsing all workbooks again.
    """
    cells.write.mode("overwrite").partitionBy("sheet").parquet(path)
    return cells.sparkSession.read.parquet(path)
