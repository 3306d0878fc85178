"""Workbook feeds.

``.xlsx`` files are zip archives that need random access, so one task parses
one workbook: ``binaryFile`` → ``mapInPandas`` (standard-library zip + XML,
streaming each sheet's rows) emits one row per non-blank sheet row with its
cells as ``array<string>`` and a parallel ``array<string>`` of cell kinds.
Everything after that is DataFrame work:

* header row per sheet (A4): among the first 10 rows, the first with more
  than two non-empty cells that are all strings, else row 0 — a filter plus a
  ``min`` aggregate;
* header labels and width per sheet (metadata, one row per sheet) → sheets are
  grouped by label signature on the driver;
* per signature one projection ``get(cells, pos)`` over the parsed rows joined
  to its (file, sheet, header row) table; empty sheets simply produce no rows
  (A6); unnamed columns are never projected (A5).

The parsed rows are checkpointed to the shared checkpoint folder, so every
workbook is unzipped once however many layouts it feeds, and a lost executor
does not re-parse.
"""

from __future__ import annotations

import io
import re
import zipfile
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Iterator, Sequence
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import NA_TOKENS, na_to_null
from ..operators.enrich import broadcast_threshold
from ..session import scratch_path
from .csv import header_names, kept_positions

CELLS_SCHEMA = ("source_file string, sheet string, sheet_pos int, row_idx bigint, "
                "cells array<string>, kinds array<string>, error string")
PREVIEW_ROWS = 10   # header search window (fixed by the job's reader)

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_DATE_IDS = set(range(14, 23)) | {45, 46, 47}
_EPOCH = datetime(1899, 12, 30)


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _number(text: str) -> str:
    v = float(text)
    if v.is_integer() and abs(v) < 2 ** 53:
        return str(int(v))
    return repr(v)


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()
    return bool(re.search(r"[dmyhs]", code)) and "general" not in code


def _date(text: str) -> str:
    v = float(text)
    ts = _EPOCH + timedelta(days=v)
    ts = ts.replace(microsecond=round(ts.microsecond / 1000) * 1000 % 1000000)
    return ts.strftime("%Y-%m-%d %H:%M:%S")


def _si_text(node) -> str:
    """Text of a string item: its own ``t`` plus rich-text runs ``r/t``;
    phonetic hints (``rPh``) are not part of the value."""
    parts = []
    for child in node:
        if child.tag == _NS + "t":
            parts.append(child.text or "")
        elif child.tag == _NS + "r":
            parts.extend(t.text or "" for t in child.iter(_NS + "t"))
    return "".join(parts)


class _Book:
    def __init__(self, data: bytes):
        self.z = zipfile.ZipFile(io.BytesIO(data))
        names = set(self.z.namelist())
        self.strings: list[str] = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(self.z.read("xl/sharedStrings.xml"))
            for si in root.iter(_NS + "si"):
                self.strings.append(_si_text(si))
        self.date_styles: set[int] = set()
        if "xl/styles.xml" in names:
            root = ET.fromstring(self.z.read("xl/styles.xml"))
            custom = {}
            fmts = root.find(_NS + "numFmts")
            if fmts is not None:
                for f in fmts:
                    custom[int(f.get("numFmtId"))] = f.get("formatCode", "")
            xfs = root.find(_NS + "cellXfs")
            if xfs is not None:
                for i, xf in enumerate(xfs):
                    fid = int(xf.get("numFmtId", "0"))
                    if fid in _DATE_IDS or (fid in custom and _is_date_format(custom[fid])):
                        self.date_styles.add(i)
        rels = {}
        for rel in ET.fromstring(self.z.read("xl/_rels/workbook.xml.rels")).iter(_PKG + "Relationship"):
            rels[rel.get("Id")] = rel.get("Target")
        self.sheets = []
        for sh in ET.fromstring(self.z.read("xl/workbook.xml")).iter(_NS + "sheet"):
            target = rels.get(sh.get(_REL + "id"), "")
            target = target.lstrip("/")
            path = target if target.startswith("xl/") else "xl/" + target
            self.sheets.append((sh.get("name"), path))

    def rows(self, path: str) -> Iterator[tuple[list, list]]:
        """Rows of one sheet up to its last filled one: (cells, kinds), trimmed
        after the last non-empty cell. A row without filled cells, in the file
        or left out of it, is a row too. Empty strings count as missing, like
        the job's reader."""
        done = place = 0   # rows given out; number of the row at hand
        with self.z.open(path) as fh:
            for _, el in ET.iterparse(fh, events=("end",)):
                if el.tag != _NS + "row":
                    continue
                cells: dict[int, tuple[str, str]] = {}
                place = int(el.get("r") or place + 1)
                pos = 0
                for cnode in el.iter(_NS + "c"):
                    ref = cnode.get("r")
                    idx = _col_index(ref) if ref else pos
                    pos = idx + 1
                    t = cnode.get("t", "n")
                    v = cnode.find(_NS + "v")
                    if t == "inlineStr":
                        isn = cnode.find(_NS + "is")
                        val = _si_text(isn) if isn is not None else None
                        kind = "string"
                    elif v is None or v.text is None:
                        continue
                    elif t == "s":
                        val, kind = self.strings[int(v.text)], "string"
                    elif t in ("str", "e"):
                        val, kind = v.text, "string"
                    elif t == "b":
                        val, kind = ("True" if v.text.strip() == "1" else "False"), "bool"
                    elif t == "d":
                        val, kind = v.text.replace("T", " "), "date"
                    elif int(cnode.get("s", "0")) in self.date_styles:
                        val, kind = _date(v.text), "date"
                    else:
                        val, kind = _number(v.text), "number"
                    if val is None or (kind == "string" and val == ""):
                        continue
                    cells[idx] = (val, kind)
                el.clear()
                if not cells:
                    continue
                for _ in range(done + 1, place):
                    yield [], []
                done = place
                width = max(cells) + 1
                yield ([cells[i][0] if i in cells else None for i in range(width)],
                       [cells[i][1] if i in cells else None for i in range(width)])


def parse_workbooks(batches, chunk: int = 20000):
    """mapInPandas body: (path, content) rows in, parsed sheet rows out."""
    import pandas as pd

    cols = ["source_file", "sheet", "sheet_pos", "row_idx", "cells", "kinds", "error"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                book = _Book(bytes(content))
                buf = []
                for sheet_pos, (name, spath) in enumerate(book.sheets):
                    for i, (cells, kinds) in enumerate(book.rows(spath)):
                        buf.append((path, name, sheet_pos, i, cells, kinds, None))
                        if len(buf) >= chunk:
                            yield pd.DataFrame(buf, columns=cols)
                            buf = []
                if buf:
                    yield pd.DataFrame(buf, columns=cols)
            except Exception as e:  # noqa: BLE001 - becomes a 'failed' report row
                yield pd.DataFrame([(path, None, None, None, None, None, f"unreadable workbook: {type(e).__name__}")],
                                   columns=cols)


def workbook_cells(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parsed rows of all workbooks (A3); workbooks that fail to parse give one
    row with ``error`` set."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInPandas(parse_workbooks, CELLS_SCHEMA)


def sheet_table(cells: DataFrame) -> DataFrame:
    """One row per sheet that has rows: position, width, header row, its cells
    and the number of rows after it. One aggregation, of which the shuffle
    carries the first :data:`PREVIEW_ROWS` rows of a sheet and two numbers."""
    seen = F.when(F.col("row_idx") < PREVIEW_ROWS, F.struct("row_idx", "cells", "kinds"))
    sheets = cells.filter(F.col("error").isNull()).groupBy("source_file", "sheet").agg(
        F.first("sheet_pos").alias("sheet_pos"), F.max(F.size("cells")).alias("width"),
        F.max("row_idx").alias("last_row"), F.sort_array(F.collect_list(seen)).alias("preview"))
    filled = lambda r: F.filter(r["kinds"], lambda k: k.isNotNull())
    heads = F.filter("preview", lambda r: (F.size(filled(r)) > 2) & F.forall(filled(r), lambda k: k == "string"))
    sheets = sheets.withColumn("header_row", F.coalesce(F.get(heads, F.lit(0))["row_idx"], F.lit(0)).cast("bigint"))
    return sheets.select(
        "source_file", "sheet", "sheet_pos", "width", "header_row",
        F.get(F.filter("preview", lambda r: r["row_idx"] == F.col("header_row")), F.lit(0))["cells"].alias("header"),
        (F.col("last_row") - F.col("header_row")).alias("data_rows"))


def header_rows(cells: DataFrame) -> DataFrame:
    """Header row per sheet (A4): first of the first 10 rows with > 2 non-empty
    cells, all strings; 0 when none. One row per sheet that has rows."""
    return sheet_table(cells).select("source_file", "sheet", "sheet_pos", "width", "header_row")


def sheet_layouts(cells: DataFrame) -> DataFrame:
    """``(source_file, sheet, header_row, names, kept)`` of every sheet with
    data rows: its labels and the positions kept, worked out in tasks."""
    def label(batches):
        import pandas as pd
        for pdf in batches:
            raw = [["" if v is None else v for v in (h if h is not None else [])] + [""] * (w - (len(h) if h is not None else 0))
                   for h, w in zip(pdf["header"], pdf["width"])]
            names = [header_names(r) for r in raw]
            yield pd.DataFrame({"source_file": pdf["source_file"], "sheet": pdf["sheet"], "header_row": pdf["header_row"],
                                "names": names, "kept": [kept_positions(n) for n in names]})
    rows = sheet_table(cells).where("data_rows > 0").select("source_file", "sheet", "header_row", "header", "width")
    return rows.mapInPandas(label, "source_file string, sheet string, header_row bigint, names array<string>, kept array<int>")


@dataclass
class SheetLayout:
    names: tuple[str, ...]
    kept: tuple[int, ...]
    sheets: list[tuple[str, str, int]] = field(default_factory=list)   # (file, sheet, header_row)
    frame: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return [self.names[i] for i in self.kept]

    @property
    def paths(self) -> list[str]:
        return [s[0] for s in self.sheets]


@dataclass
class Workbooks:
    cells: DataFrame
    layouts: list[SheetLayout]
    failures: list[tuple[str, str]]
    empty_sheets: list[tuple[str, str]]


def read_workbooks(spark: SparkSession, paths: Sequence[str], *, na_tokens: Sequence[str] = NA_TOKENS,
                   file_col: str = "source_file", sheet_col: str = "sheet",
                   place_cols: tuple[str, str] | None = None) -> Workbooks:
    """Parse workbooks once and split their sheets into layouts.

    Each layout's ``frame`` has its kept labels (strings, NA tokens -> NULL)
    plus ``file_col`` and ``sheet_col``, and, where named, two columns with
    each row's place (sheet, row)."""
    path = scratch_path(spark, "cells")
    workbook_cells(spark, paths).write.parquet(path)   # parsed once
    cells = spark.read.schema(CELLS_SCHEMA).parquet(path)
    failures = [(r["source_file"], r["error"]) for r in
                cells.filter(F.col("error").isNotNull()).select("source_file", "error").collect()]
    meta = sheet_table(cells).collect()   # one row per sheet
    groups: dict[tuple[str, ...], SheetLayout] = {}
    empty = []
    seen_files = {p for p, _ in failures}
    for r in sorted(meta, key=lambda r: (r["source_file"], r["sheet_pos"])):
        seen_files.add(r["source_file"])
        if not r["data_rows"]:
            empty.append((r["source_file"], r["sheet"]))
            continue
        raw = list(r["header"] or [])
        raw = [("" if v is None else v) for v in raw] + [""] * (r["width"] - len(raw))
        names = tuple(header_names(raw))
        lay = groups.get(names)
        if lay is None:
            lay = groups[names] = SheetLayout(names, tuple(kept_positions(names)))
        lay.sheets.append((r["source_file"], r["sheet"], r["header_row"]))
    for p in paths:
        if p not in seen_files:   # no sheet has any row: nothing to enrich (R19)
            failures.append((p, "no non-empty sheet"))
    tokens = list(na_tokens)
    for lay in groups.values():
        table = spark.createDataFrame(lay.sheets, "source_file string, sheet string, header_row bigint")
        if len(lay.sheets) * 512 <= broadcast_threshold(spark):
            table = F.broadcast(table)
        rows = cells.join(table, ["source_file", "sheet"]).filter(F.col("row_idx") > F.col("header_row"))
        lay.frame = rows.select(
            *[na_to_null(F.get(F.col("cells"), i), tokens).alias(lay.names[i]) for i in lay.kept],
            F.col("source_file").alias(file_col), F.col("sheet").alias(sheet_col),
            *([F.col("sheet_pos").cast("long").alias(place_cols[0]), F.col("row_idx").alias(place_cols[1])] if place_cols else []))
    return Workbooks(cells, list(groups.values()), failures, empty)


# ---------------------------------------------------------------------------
# writer (fixtures): a minimal standard-library .xlsx writer
# ---------------------------------------------------------------------------

def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _col_ref(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: Sequence[tuple[str, Sequence[Sequence]]]) -> bytes:
    """Workbook with the given (name, rows) sheets; str cells become inline
    strings, numbers stay numbers, None leaves the cell out."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        ct = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>',
              '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">',
              '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>',
              '<Default Extension="xml" ContentType="application/xml"/>',
              '<Override PartName="/xl/workbook.xml" '
              'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>']
        for i in range(len(sheets)):
            ct.append(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" '
                      'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
        ct.append("</Types>")
        z.writestr("[Content_Types].xml", "".join(ct))
        z.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
                   'relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        wb = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
              '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
              'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>']
        rels = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">']
        for i, (name, rows) in enumerate(sheets):
            wb.append(f'<sheet name="{_esc(name)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>')
            rels.append(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/'
                        f'2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>')
            body = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                    '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
            for r, row in enumerate(rows):
                body.append(f'<row r="{r + 1}">')
                for cidx, v in enumerate(row):
                    ref = f"{_col_ref(cidx)}{r + 1}"
                    if v is None:
                        continue
                    if isinstance(v, str):
                        body.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_esc(v)}</t></is></c>')
                    elif isinstance(v, bool):
                        body.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                    else:
                        body.append(f'<c r="{ref}"><v>{v}</v></c>')
                body.append("</row>")
            body.append("</sheetData></worksheet>")
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", "".join(body))
        wb.append("</sheets></workbook>")
        rels.append("</Relationships>")
        z.writestr("xl/workbook.xml", "".join(wb))
        z.writestr("xl/_rels/workbook.xml.rels", "".join(rels))
    return buf.getvalue()
