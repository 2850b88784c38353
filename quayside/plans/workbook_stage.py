"""Stage tables as workbooks, so the workbook scan runs on data derived from
the test tables.

Each partition of a DataFrame becomes one ``.xlsx`` file holding one sheet,
written by the task that owns the partition (``mapInPandas``), so staging is
as parallel as the data.  Text goes to the shared-string table, dates and
timestamps are stored as serial numbers with a date style - the three cell
kinds the reader has to handle.  Paths must be on a file system mounted on
every worker (the shared scratch folder).
"""

from __future__ import annotations

import datetime as dt
import itertools
import math
import os
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quayside.session import local_dir_of, ship_package

_EPOCH = dt.datetime(1899, 12, 30)

_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
    '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
    "</Types>"
)
_ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
    "</Relationships>"
)
_WB_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
    '<Relationship Id="rId3" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>'
    "</Relationships>"
)
# Style 1 shows a date (format 14), style 2 a date and time (format 22).
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
    '<borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf numFmtId="0"/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/>'
    '<xf numFmtId="22" applyNumberFormat="1"/></cellXfs>'
    "</styleSheet>"
)


def _col_letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _serial(value) -> float:
    if isinstance(value, dt.datetime):
        delta = value.replace(tzinfo=None) - _EPOCH
    else:
        delta = dt.datetime.combine(value, dt.time()) - _EPOCH
    return delta.days + delta.seconds / 86400 + delta.microseconds / 86_400_000_000


_ONE_DAY = pd.Timedelta(days=1)


class _SharedStrings:
    """The workbook's shared-string table: text -> index, in first-use order."""

    def __init__(self):
        self.index: dict[str, int] = {}

    def ref(self, text: str) -> int:
        if text not in self.index:
            self.index[text] = len(self.index)
        return self.index[text]

    def refs(self, values: pd.Series) -> pd.Series:
        codes, uniques = pd.factorize(values)
        ids = pd.Series([self.ref(u) for u in uniques], dtype="int64").to_numpy()
        return pd.Series(ids[codes], index=values.index).astype(str)


def _cell_value(v, ref: str, strings: _SharedStrings) -> str:
    """One cell of any Python value (the slow path for mixed columns)."""
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return f'<c r="{ref}" s="2"><v>{_serial(pd.Timestamp(v).to_pydatetime())!r}</v></c>'
    if isinstance(v, dt.date):
        return f'<c r="{ref}" s="1"><v>{_serial(v)!r}</v></c>'
    if hasattr(v, "item") and not isinstance(v, str):  # numpy scalar
        v = v.item()
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    if isinstance(v, str):
        return f'<c r="{ref}" t="s"><v>{strings.ref(v)}</v></c>'
    return f'<c r="{ref}" t="s"><v>{strings.ref(str(v))}</v></c>'


def _column_cells(values: pd.Series, letters: str, rows: pd.Series,
                  strings: _SharedStrings) -> pd.Series:
    """XML of one column's cells for a batch of rows ('' where the value is null).

    Whole columns are formatted at once by kind: numbers, booleans, text (as
    shared-string references), dates and timestamps (as serial numbers with a
    date style).  Columns of mixed Python values take the per-value path.
    """
    refs = f'<c r="{letters}' + rows
    present = values.notna()
    out = pd.Series("", index=values.index, dtype=object)
    if not present.any():
        return out
    v = values[present]
    r = refs[present]
    kind = values.dtype.kind
    if kind == "b":
        out[present] = r + '" t="b"><v>' + v.astype("int64").astype(str) + "</v></c>"
    elif kind in "iu":
        out[present] = r + '"><v>' + v.astype(str) + "</v></c>"
    elif kind == "f":
        out[present] = r + '"><v>' + v.map(repr) + "</v></c>"
    elif kind == "M":
        stamps = v.dt.tz_localize(None) if v.dt.tz is not None else v
        serial = (stamps - pd.Timestamp(_EPOCH)) / _ONE_DAY
        out[present] = r + '" s="2"><v>' + serial.map(repr) + "</v></c>"
    else:
        kinds = set(map(type, v))
        if kinds == {str}:
            out[present] = r + '" t="s"><v>' + strings.refs(v) + "</v></c>"
        elif kinds == {dt.date}:
            serial = (pd.to_datetime(v) - pd.Timestamp(_EPOCH)) / _ONE_DAY
            out[present] = r + '" s="1"><v>' + serial.map(repr) + "</v></c>"
        else:
            out[present] = [
                _cell_value(x, f"{letters}{n}", strings) for x, n in zip(v, rows[present])
            ]
    return out


def write_workbook_batches(path: str, sheet: str, columns: list[str],
                           batches: Iterator[pd.DataFrame]) -> int:
    """Write one workbook with one sheet from pandas batches; returns data rows.

    Rows are formatted and written a batch at a time, so memory holds one
    batch plus the shared-string table, not the whole sheet.
    """
    strings = _SharedStrings()
    letters = [_col_letters(i) for i in range(len(columns))]
    n = 0
    # Fastest deflate level: staging speed matters more than file size here.
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
        with zf.open("xl/worksheets/sheet1.xml", "w") as fh:
            fh.write(
                b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
            )
            header = "".join(
                f'<c r="{letters[i]}1" t="s"><v>{strings.ref(c)}</v></c>' for i, c in enumerate(columns)
            )
            fh.write(f'<row r="1">{header}</row>'.encode())
            for pdf in batches:
                if pdf.empty:
                    continue
                pdf = pdf.reset_index(drop=True)
                rows = pd.Series(range(n + 2, n + 2 + len(pdf)), dtype="int64").astype(str)
                xml = '<row r="' + rows + '">'
                for i in range(len(columns)):
                    xml = xml + _column_cells(pdf.iloc[:, i], letters[i], rows, strings)
                xml = xml + "</row>"
                fh.write("".join(xml).encode())
                n += len(pdf)
            fh.write(b"</sheetData></worksheet>")
        zf.writestr("[Content_Types].xml", _CONTENT_TYPES)
        zf.writestr("_rels/.rels", _ROOT_RELS)
        zf.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        zf.writestr("xl/styles.xml", _STYLES)
        zf.writestr(
            "xl/workbook.xml",
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            f'<sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        sst = "".join(f"<si><t xml:space=\"preserve\">{escape(t)}</t></si>" for t in strings.index)
        zf.writestr(
            "xl/sharedStrings.xml",
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" count="{len(strings.index)}" '
            f'uniqueCount="{len(strings.index)}">{sst}</sst>',
        )
    return n


def write_workbook(path: str, sheet: str, columns: list[str], rows: Iterator[tuple],
                   batch_rows: int = 4096) -> int:
    """Write one workbook with one sheet from row tuples; returns data rows."""

    def batches():
        chunk = []
        for row in rows:
            chunk.append(tuple(row))
            if len(chunk) >= batch_rows:
                yield pd.DataFrame.from_records(chunk, columns=columns)
                chunk = []
        if chunk:
            yield pd.DataFrame.from_records(chunk, columns=columns)

    return write_workbook_batches(path, sheet, columns, batches())


def stage_workbooks(df: DataFrame, folder: str, sheet: str) -> DataFrame:
    """Write every partition of ``df`` as one workbook in ``folder``.

    Returns a DataFrame of (path, rows); evaluating it performs the writes.
    """
    target = local_dir_of(folder)
    if target is None:
        raise ValueError(f"workbooks can only be staged on a mounted path, not {folder}")
    columns = df.columns
    ship_package(df.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # An empty partition writes no file.
        batches = (b for b in batches if not b.empty)
        first = next(batches, None)
        if first is None:
            return
        os.makedirs(target, exist_ok=True)
        # One name per partition, written under a temporary name and renamed
        # at the end: a retried task (lost executor) replaces its file instead
        # of adding a second copy of the rows.
        path = os.path.join(target, f"part-{TaskContext.get().partitionId():05d}.xlsx")
        scratch = f"{path}.{uuid.uuid4().hex}.tmp"
        n = write_workbook_batches(scratch, sheet, columns, itertools.chain([first], batches))
        os.replace(scratch, path)
        yield pd.DataFrame({"path": [path], "rows": [n]})

    return df.mapInPandas(write, "path string, rows long")
