"""Workbook (.xlsx) input, read on the executors.

A workbook is a zip of XML parts and cannot be split, so parallelism is
across files: ``binaryFile`` lists the workbooks without their content, and
``mapInPandas`` opens each one in the shared store from its task, seeks the
parts it needs and streams the first sheet's rows out in bounded batches.  A
task holds a row at a time and the workbook's shared strings, packed.  Only
where tasks cannot open the store by themselves does Spark hand them whole
files.  Parsing uses the standard library alone (``zipfile`` and
``xml.etree``).

Cells become text: shared and inline strings as written, numbers without a
trailing ``.0`` when integral, booleans as ``TRUE``/``FALSE``; an empty or
absent cell is null.  The first row is the header; sheet columns are matched
to the requested schema by name, absent ones are null and others dropped.
"""

from __future__ import annotations

import io
import posixpath
import sys
import zipfile
from array import array
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from salesmart.sources.store import open_store, tasks_can_open

# The task functions below are shipped by value, so executors need only the
# standard library and pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The XML namespaces of the workbook format.
MAIN_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
DOC_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG_REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"

_BATCH_ROWS = 10_000


def _q(tag: str) -> str:
    return f"{{{MAIN_NS}}}{tag}"


def _first_sheet_part(zf: zipfile.ZipFile) -> str:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    sheet = wb.find(f"{_q('sheets')}/{_q('sheet')}")
    rel_id = sheet.get(f"{{{DOC_REL_NS}}}id")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iter(f"{{{PKG_REL_NS}}}Relationship"):
        if rel.get("Id") == rel_id:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(
                posixpath.join("xl", target))
    raise ValueError(f"sheet relationship {rel_id} not found")


class PackedStrings:
    """A read-only list of strings, held as their UTF-8 bytes one after the other."""

    def __init__(self) -> None:
        self._bytes, self._ends = bytearray(), array("Q", [0])

    def append(self, text: str) -> None:
        self._bytes += text.encode("utf-8", "surrogatepass")
        self._ends.append(len(self._bytes))

    def __len__(self) -> int:
        return len(self._ends) - 1

    def __getitem__(self, at: int) -> str:
        if not 0 <= at < len(self):
            raise IndexError(f"shared string {at} of {len(self)}")
        return self._bytes[self._ends[at]:self._ends[at + 1]].decode("utf-8", "surrogatepass")


def _elements(file: BinaryIO, tag: str) -> Iterator[ET.Element]:
    """Each element of that name once it is complete; it and all before it are dropped after use."""
    parents: list[ET.Element] = []
    for event, elem in ET.iterparse(file, events=("start", "end")):
        if event == "start":
            parents.append(elem)
            continue
        parents.pop()
        if elem.tag == tag:
            yield elem
            elem.clear()
            if parents:
                parents[-1].clear()


def _shared_strings(zf: zipfile.ZipFile) -> PackedStrings:
    strings = PackedStrings()
    if "xl/sharedStrings.xml" not in zf.namelist():
        return strings
    with zf.open("xl/sharedStrings.xml") as part:
        for si in _elements(part, _q("si")):
            # Plain text, or the text of each rich-text run; phonetic runs (rPh)
            # are not part of the value.
            nodes = [si.find(_q("t"))] + [r.find(_q("t")) for r in si.findall(_q("r"))]
            strings.append("".join(n.text or "" for n in nodes if n is not None))
    return strings


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _number_text(v: str) -> str:
    x = float(v)
    return str(int(x)) if x.is_integer() and abs(x) < 2**53 else repr(x)


def _cell_text(cell: ET.Element, shared: PackedStrings) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        node = cell.find(_q("is"))
        return None if node is None else "".join(t.text or "" for t in node.iter(_q("t")))
    v = cell.find(_q("v"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "TRUE" if v.text.strip() == "1" else "FALSE"
    if kind == "n":
        return _number_text(v.text)
    return v.text  # str (formula result), e (error), d (ISO date)


def iter_sheet_rows(workbook: bytes | BinaryIO) -> Iterator[list[str | None]]:
    """Rows of the first sheet as lists of cell texts (gaps filled with None), from the bytes or a seekable file."""
    with zipfile.ZipFile(io.BytesIO(workbook) if isinstance(workbook, bytes) else workbook) as zf:
        shared = _shared_strings(zf)
        with zf.open(_first_sheet_part(zf)) as part:
            for row in _elements(part, _q("row")):
                values: dict[int, str | None] = {}
                pos = 0
                for cell in row.iter(_q("c")):
                    ref = cell.get("r")
                    pos = _col_index(ref) if ref else pos
                    values[pos] = _cell_text(cell, shared)
                    pos += 1
                width = max(values) + 1 if values else 0
                yield [values.get(i) for i in range(width)]


def _opened(path: str) -> BinaryIO:
    store, name = open_store(path)
    return store.open_input_file(name)


def _columns(header: list[str | None], names: list[str], aliases: dict[str, tuple[str, ...]],
             required: tuple[str, ...]) -> dict[str, int]:
    """Position of each wanted column: of its own name, else of the last of its aliases."""
    where = {str(h).strip(): i for i, h in enumerate(header) if h is not None}
    for name in names:
        if name not in where:
            hits = [i for h, i in where.items() if h.lower() in aliases.get(name, ())]
            if hits:
                where[name] = max(hits)
    missing = [name for name in required if name not in where]
    if missing:
        raise ValueError(f"a workbook has no column for {missing}; its header is {header}")
    return where


def _parse_batches(schema: StructType, aliases: dict[str, tuple[str, ...]], required: tuple[str, ...]):
    names = schema.fieldNames()

    def one(workbook: bytes | BinaryIO) -> Iterator[pd.DataFrame]:
        rows = iter_sheet_rows(workbook)
        header = next(rows, None)
        if header is None:
            return
        where = _columns(header, names, aliases, required)
        chunk: list[list[str | None]] = []
        for row in rows:
            if all(v is None for v in row):
                continue
            chunk.append([row[where[n]] if n in where and where[n] < len(row) else None for n in names])
            if len(chunk) >= _BATCH_ROWS:
                yield pd.DataFrame(chunk, columns=names, dtype=object)
                chunk = []
        if chunk:
            yield pd.DataFrame(chunk, columns=names, dtype=object)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if "content" in pdf:
                for content in pdf["content"]:
                    yield from one(bytes(content))
            else:
                for path in pdf["path"]:
                    with _opened(path) as file:
                        yield from one(file)

    return parse


def read_workbooks(spark: SparkSession, path: str, schema: StructType,
                   aliases: dict[str, tuple[str, ...]] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """All workbooks under ``path`` (a file, folder or glob), first sheet
    each, as text columns named by ``schema`` (all fields must be strings).

    A column absent under its name is looked for under its lower-case
    ``aliases``; a workbook without a ``required`` column raises."""
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.[xX][lL][sS][xX]")
             .load(path))
    files = files.select("path" if tasks_can_open(files) else "content")
    return files.mapInPandas(_parse_batches(schema, aliases or {}, required), schema)


# ---------------------------------------------------------------------------
# Writing, for fixtures and round-trip checks: one workbook per partition.
# ---------------------------------------------------------------------------

def _col_name(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _cell_xml(ref: str, value) -> str:
    if value is None or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def workbook_bytes(header: list[str], rows) -> bytes:
    """A minimal one-sheet workbook with inline strings."""
    lines = []
    for r, row in enumerate([header, *rows], start=1):
        cells = "".join(_cell_xml(f"{_col_name(c)}{r}", v) for c, v in enumerate(row))
        lines.append(f'<row r="{r}">{cells}</row>')
    sheet = (f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             f'<worksheet xmlns="{MAIN_NS}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    workbook = (f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                f'<workbook xmlns="{MAIN_NS}" xmlns:r="{DOC_REL_NS}"><sheets>'
                f'<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
    wb_rels = (f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
               f'<Relationships xmlns="{PKG_REL_NS}"><Relationship Id="rId1" '
               f'Type="{DOC_REL_NS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
    root_rels = (f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<Relationships xmlns="{PKG_REL_NS}"><Relationship Id="rId1" '
                 f'Type="{DOC_REL_NS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    types = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
             '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
             '<Default Extension="xml" ContentType="application/xml"/>'
             '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
             '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
             '</Types>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("[Content_Types].xml", types)
        zf.writestr("_rels/.rels", root_rels)
        zf.writestr("xl/workbook.xml", workbook)
        zf.writestr("xl/_rels/workbook.xml.rels", wb_rels)
        zf.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


def write_workbooks(df: DataFrame, folder: str, rows_per_workbook: int = 100_000) -> DataFrame:
    """Write each partition of ``df`` as workbooks of at most
    ``rows_per_workbook`` rows (a sheet holds about a million rows at most),
    named ``part-<partition>-<n>.xlsx`` under ``folder`` (a path the executors
    mount), and return the lazy (file, rows) list.

    Names depend only on the partition and the row position, and each file is
    written under a temporary name and renamed, so a retried task rewrites the
    same files.  A task holds one workbook's rows at a time.
    """
    header = df.columns
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, out = open_store(folder)
        store.create_dir(out, recursive=True)
        files, counts, chunk = [], [], []

        def flush():
            target = f"{out}/part-{part:05d}-{len(files):04d}.xlsx"
            tmp = f"{target}.tmp-{attempt}"  # unique over all hosts
            with store.open_output_stream(tmp) as fh:
                fh.write(workbook_bytes(header, chunk))
            store.move(tmp, target)
            files.append(target)
            counts.append(len(chunk))

        for pdf in batches:
            for row in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None):
                chunk.append(row)
                if len(chunk) >= rows_per_workbook:
                    flush()
                    chunk = []
        if chunk or not files:
            flush()
        yield pd.DataFrame({"file": files, "rows": counts})

    return df.mapInPandas(write, "file string, rows long")


def write_workbook_table(df: DataFrame, folder: str, rows_per_workbook: int = 100_000) -> None:
    """Run ``write_workbooks`` to completion (one job, nothing collected)."""
    write_workbooks(df, folder, rows_per_workbook).write.format("noop").mode("overwrite").save()


__all__ = ["read_workbooks", "write_workbooks", "write_workbook_table", "workbook_bytes",
           "iter_sheet_rows"]
