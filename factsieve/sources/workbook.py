"""XLSX workbooks as a Spark data source and a writer, with the standard library only."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
MAX_CELL = 32767


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n


def read_cells(content: bytes) -> Iterator[tuple[str, int, str, str, str]]:
    """(sheet, row_no, cell, field, value) of every filled cell below the header row of every sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", _NS):
            path = targets[sheet.get(_REL)].lstrip("/")
            root = ElementTree.fromstring(z.read(path if path.startswith("xl/") else f"xl/{path}"))
            header: dict[int, str] = {}
            for row in root.findall("m:sheetData/m:row", _NS):
                number = int(row.get("r"))
                for c in row.findall("m:c", _NS):
                    kind, v, inline = c.get("t"), c.find("m:v", _NS), c.find("m:is", _NS)
                    value = "".join(t.text or "" for t in inline.iter(f"{{{_NS['m']}}}t")) if inline is not None else None if v is None else shared[int(v.text)] if kind == "s" else v.text
                    if value in (None, ""):
                        continue
                    at = _column(c.get("r"))
                    if number == 1:
                        header[at] = value
                    elif at in header:
                        yield sheet.get("name"), number, c.get("r"), header[at], value


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[_File]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            for row in read_cells(f.read()):
                yield (partition.path, *row)


class WorkbookSource(DataSource):
    """spark.read.format("workbook").option("paths", "a.xlsx,b.xlsx"): one task a file, on a path all executors see."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "path string, sheet string, row_no int, cell string, field string, value string"

    def reader(self, schema) -> _Reader:
        return _Reader([p for p in self.options["paths"].split(",") if p])


def read_workbooks(spark: SparkSession, paths: str) -> DataFrame:
    """Cells of all workbooks a path pattern names, through any file system Spark reads; one row a filled cell."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = [(p, *r) for p, c in zip(batch["path"], batch["content"]) for r in read_cells(c)]
            yield pd.DataFrame(rows, columns=["path", "sheet", "row_no", "cell", "field", "value"])

    return files.mapInPandas(run, "path string, sheet string, row_no int, cell string, field string, value string")


def cell_text(col, kind: str):
    """What a cell holds: lists as JSON, booleans as Y or N, no control characters, at most MAX_CELL characters, and an
    apostrophe before text that a spreadsheet would take for a formula."""
    if kind == "boolean":
        return F.when(col, "Y").otherwise(F.when(~col, "N"))
    text = F.to_json(col) if kind in ("array", "map", "struct") else col.cast("string")
    text = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    if kind == "string":
        text = F.when(text.rlike(r"^[=+\-@]") & text.try_cast("double").isNull(), F.concat(F.lit("'"), text)).otherwise(text)
    return F.substring(text, 1, MAX_CELL)


def workbook_bytes(sheets: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """A workbook of sheets, each a header and rows of text."""

    def ref(x: int, y: int) -> str:
        out = ""
        while x:
            x, r = divmod(x - 1, 26)
            out = chr(65 + r) + out
        return f"{out}{y}"

    def sheet(header: list[str], rows: list[tuple]) -> str:
        body = []
        for y, row in enumerate([header, *rows], 1):
            cells = "".join(f'<c r="{ref(x, y)}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' for x, v in enumerate(row, 1) if v not in (None, ""))
            body.append(f'<row r="{y}">{cells}</row>')
        return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(body)}</sheetData></worksheet>'

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>')
        z.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, (header, rows) in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", sheet(header, rows))
    return buffer.getvalue()


def write_workbooks(sheets: dict[str, DataFrame], document: str, folder: str) -> None:
    """One workbook a document, written by the task that holds the document's rows; ``folder`` is shared by all executors."""
    out = None
    order = {name: [c for c in df.columns if c != document] for name, df in sheets.items()}
    for name, df in sheets.items():
        cells = df.select(F.col(document).alias("doc"), F.lit(name).alias("sheet"), F.monotonically_increasing_id().alias("n"), F.array(*[cell_text(F.col(c), df.schema[c].dataType.typeName()) for c in order[name]]).alias("cells"))
        out = cells if out is None else out.unionByName(cells)

    def save(rows):
        import os

        import pandas as pd

        doc = str(rows["doc"].iloc[0])
        content = {name: (order[name], [tuple(r) for r in rows[rows["sheet"] == name].sort_values("n")["cells"]]) for name in order}
        target = os.path.join(folder, f"{re.sub(r'[^0-9A-Za-z가-힣_-]', '_', doc)}.xlsx")
        with open(target + ".part", "wb") as f:
            f.write(workbook_bytes(content))
        os.replace(target + ".part", target)
        return pd.DataFrame({"path": [target]})

    out.groupBy("doc").applyInPandas(save, "path string").write.format("noop").mode("overwrite").save()
