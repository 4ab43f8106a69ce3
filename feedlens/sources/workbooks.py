"""Excel workbooks (.xlsx) as a distributed source: one task per workbook.

``binaryFile`` lists the folder and ships each file's bytes to an executor;
``mapInPandas`` unzips it with the standard library and reads the sheet XML
(shared strings + inline strings + numbers).  No driver-side parsing, no
third-party package.  ``write_feedback_workbooks`` is the matching sink (one
minimal workbook per partition), used for round trips.
"""
from __future__ import annotations

import io
import uuid
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import re

from ..session import cut_lineage
from .feedback import PANDAS_NA_VALUES, MissingColumnError, na_to_null, to_feedback

# Characters XML 1.0 cannot carry are stored as _xHHHH_ (and a literal
# "_xHHHH_" in the data has its underscore stored as _x005F_).
_CTRL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_ESC = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _encode_cell(s: str) -> str:
    s = _ESC.sub(lambda m: "_x005F_" + m.group(0)[1:], s)
    return _CTRL.sub(lambda m: f"_x{ord(m.group(0)):04X}_", s)


def _decode_cell(s: str) -> str:
    return _ESC.sub(lambda m: chr(int(m.group(1), 16)), s)

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _cell_text(c, shared) -> str | None:
    t = c.get("t")
    if t == "inlineStr":
        return _decode_cell("".join(x.text or "" for x in c.iter(f"{{{NS['m']}}}t")))
    v = c.find("m:v", NS)
    if v is None or v.text is None:
        return None
    if t == "s":
        return shared[int(v.text)]
    if t == "b":
        return "True" if v.text == "1" else "False"
    return v.text


def read_sheet(data: bytes, sheet=0) -> list[list[str | None]]:
    """Rows of one sheet (by index or name) as lists of cell strings."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        root = ET.fromstring(z.read("xl/sharedStrings.xml"))
        for si in root.findall("m:si", NS):
            shared.append(_decode_cell("".join(x.text or "" for x in si.iter(f"{{{NS['m']}}}t"))))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.findall("m:sheets/m:sheet", NS)
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall(f"{{{REL_NS}}}Relationship")}
    chosen = sheets[sheet] if isinstance(sheet, int) else next(s for s in sheets if s.get("name") == sheet)
    path = target[chosen.get(f"{{{NS['r']}}}id")].lstrip("/")
    path = path if path.startswith("xl/") else "xl/" + path
    root = ET.fromstring(z.read(path))
    rows = []
    for row in root.iter(f"{{{NS['m']}}}row"):
        cells = {}
        for i, c in enumerate(row.findall("m:c", NS)):
            ref = c.get("r")
            cells[_col_index(ref) if ref else i] = _cell_text(c, shared)
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(i) for i in range(width)])
    return rows


def read_feedback_workbooks(spark: SparkSession, path_glob: str, text_column: str, sheet=0,
                            id_column: str | None = None, na_values=PANDAS_NA_VALUES) -> DataFrame:
    """(doc_id, text) from every workbook matching ``path_glob``; header row first.
    pandas-style missing markers become ""."""
    files = spark.read.format("binaryFile").load(path_glob).select("path", "content")
    cols = [text_column] + ([id_column] if id_column else [])

    def parse(batches):
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):  # one workbook's rows at a time
                rows = read_sheet(bytes(content), sheet)
                if not rows:
                    continue
                header = [h or "" for h in rows[0]]
                missing = [c for c in cols if c not in header]
                if missing:
                    raise MissingColumnError(f"{p} has no column {missing[0]!r} in its first row")
                idx = [header.index(c) for c in cols]
                yield pd.DataFrame([[r[i] if i < len(r) else None for i in idx] for r in rows[1:]], columns=cols, dtype=object)

    schema = ", ".join(f"`{c}` string" for c in cols)
    return to_feedback(na_to_null(files.mapInPandas(parse, schema), text_column, na_values), text_column, id_column)


def _xml_escape(s: str) -> str:
    s = _encode_cell(s)
    return (s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
             .replace("\r", "&#13;"))


def _workbook_bytes(header: list[str], rows) -> bytes:
    def col_ref(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    def row_xml(n, values):
        cells = []
        for i, v in enumerate(values):
            if v is None:
                continue
            cells.append(f'<c r="{col_ref(i)}{n}" t="inlineStr"><is><t xml:space="preserve">{_xml_escape(str(v))}</t></is></c>')
        return f'<row r="{n}">{"".join(cells)}</row>'

    body = [row_xml(1, header)] + [row_xml(i + 2, r) for i, r in enumerate(rows)]
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             f'<worksheet xmlns="{NS["m"]}"><sheetData>{"".join(body)}</sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                   '</Types>')
        z.writestr("_rels/.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{REL_NS}">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
                   '</Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}">'
                   '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{REL_NS}">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
                   '</Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


SHEET_ROWS = 1_048_575  # of a sheet, besides its header
SHEET_CHARS = 8 << 20    # of a workbook's cells, but for its last row: one workbook at a time is held in memory


def write_feedback_workbooks(df: DataFrame, folder: str) -> None:
    """Workbooks ``part-<partition>-<n>.xlsx`` under ``folder`` (inline strings), written by executors.

    ``folder`` must be new and on storage every executor can reach.  Rows are
    written once to the checkpoint folder first and file names follow the
    partition, so a task that runs again puts the same rows in the same files;
    a file takes its name when it is whole.  A sheet holds SHEET_ROWS rows and
    about SHEET_CHARS characters.
    """
    header = df.columns
    uri = folder if "://" in folder else folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") else folder

    def write(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        filesystem, base = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        filesystem.create_dir(base, recursive=True)
        part, held, files, total, chars = TaskContext.get().partitionId(), [], 0, 0, 0

        def save():
            name = f"{base}/part-{part:05d}-{files:03d}.xlsx"
            unfinished = f"{base}/_{uuid.uuid4().hex}"
            with filesystem.open_output_stream(unfinished) as f:
                f.write(_workbook_bytes(header, held))
            filesystem.move(unfinished, name)

        for pdf in batches:
            for row in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None):
                if len(held) >= SHEET_ROWS or chars >= SHEET_CHARS:
                    save()
                    held, files, chars = [], files + 1, 0
                held.append(row)
                chars += sum(len(v) for v in row if v is not None)
            total += len(pdf)
        if held:
            save()
        yield pd.DataFrame({"n": [total]})

    rows = cut_lineage(df.select(*[F.col(c).cast("string") for c in header]))
    rows.mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()
