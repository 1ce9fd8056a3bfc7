"""First sheet of .xlsx workbooks as rows of text cells.

A workbook is a zip archive that can only be opened whole, and its format ends at 1,048,576 rows, so
each one is decoded by one task. Many workbooks spread over many tasks.
"""

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 10_000
_ROW_SCHEMA = "linha long, celulas array<string>"
_SHAPE_SCHEMA = "caminho string, celulas array<string>, largura int, linhas long, erro string"


@dataclass(frozen=True)
class WorkbookShape:
    """First row, cells of the widest row, rows with a value below the first, and why the workbook cannot be read."""

    head: tuple[str | None, ...]
    width: int
    rows: int
    fault: str | None

# Built-in number formats that show a date or a time, and the day number 0.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
DAY_ZERO = datetime(1899, 12, 30)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column_index(reference: str) -> int:
    letters = re.match(r"[A-Z]+", reference).group(0)
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _texts(element: ElementTree.Element) -> str:
    """All text runs of a string item, without phonetic hints."""
    return "".join(
        t.text or "" for part in element if _local(part.tag) != "rPh" for t in part.iter() if _local(t.tag) == "t"
    )


def _first_sheet(archive: zipfile.ZipFile) -> str:
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    sheet = next(e for e in book.iter() if _local(e.tag) == "sheet")
    wanted = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
    relations = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    target = next(r.attrib["Target"] for r in relations if r.attrib["Id"] == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    root = ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))
    return [_texts(item) for item in root]


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    dates = set(DATE_FORMATS)
    for element in root.iter():
        if _local(element.tag) == "numFmt":
            shown = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", element.attrib["formatCode"]).lower()
            if re.search(r"[dy]|h+|m{1,5}", shown) and "general" not in shown:
                dates.add(int(element.attrib["numFmtId"]))
    formats = next((e for e in root.iter() if _local(e.tag) == "cellXfs"), ())
    return {i for i, style in enumerate(formats) if int(style.attrib.get("numFmtId", 0)) in dates}


def _date_text(serial: str) -> str:
    moment = DAY_ZERO + timedelta(seconds=round(float(serial) * 86_400))
    return moment.strftime("%Y-%m-%d") if moment.time() == datetime.min.time() else moment.strftime("%Y-%m-%d %H:%M:%S")


def _cell_text(cell: ElementTree.Element, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.attrib.get("t", "n")
    parts = {_local(child.tag): child for child in cell}
    if kind == "inlineStr":
        return _texts(parts["is"]) if "is" in parts else None
    raw = parts["v"].text if "v" in parts else None
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return {"1": "True", "0": "False"}[raw]
    if kind == "n" and int(cell.attrib.get("s", 0)) in dates:
        return _date_text(raw)
    return raw


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, gaps filled with None."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared, dates = _shared_strings(archive), _date_styles(archive)
        with archive.open(_first_sheet(archive)) as sheet:
            for _, element in ElementTree.iterparse(sheet):
                if _local(element.tag) != "row":
                    continue
                cells: list[str | None] = []
                for cell in element:
                    at = _column_index(cell.attrib["r"]) if "r" in cell.attrib else len(cells)
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = _cell_text(cell, shared, dates)
                yield cells
                element.clear()


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            chunk: list[tuple[int, list[str | None]]] = []
            for number, cells in enumerate(sheet_rows(content)):
                chunk.append((number, cells))
                if len(chunk) == BATCH_ROWS:
                    yield pd.DataFrame(chunk, columns=["linha", "celulas"])
                    chunk = []
            if chunk:
                yield pd.DataFrame(chunk, columns=["linha", "celulas"])


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            head, width, rows, fault = None, 0, 0, None
            try:
                for cells in sheet_rows(content):
                    rows += head is not None and any(c is not None for c in cells)
                    head = cells if head is None else head
                    width = max(width, len(cells))
            except Exception as error:  # the verdict on this workbook; the others of the job go on
                fault = f"{type(error).__name__}: {error}"
            yield pd.DataFrame([(path, head or [], width, rows, fault)], columns=["caminho", "celulas", "largura", "linhas", "erro"])


def inspect_workbooks(spark: SparkSession, paths: Sequence[str]) -> dict[str, WorkbookShape]:
    """Shape and soundness of every workbook, by path as Spark writes it; one job reads all of them as a whole."""
    found = spark.read.format("binaryFile").load(list(paths)).select("path", "content").mapInPandas(_shapes, _SHAPE_SCHEMA)
    return {
        r["caminho"]: WorkbookShape(tuple(r["celulas"]), r["largura"], r["linhas"], r["erro"])
        for r in found.toLocalIterator()
    }


def read_workbook(spark: SparkSession, path: str, shape: WorkbookShape | None = None) -> DataFrame:
    """Text columns named by the first row, as many as the widest row has; rows without any value are left out.

    Without its ``shape`` the workbook is inspected first; one that cannot be read is an error then.
    """
    if shape is None:
        shape = next(iter(inspect_workbooks(spark, [path]).values()))
    if shape.fault is not None:
        raise ValueError(f"{path}: {shape.fault}")
    if not shape.width:
        raise ValueError(f"empty workbook: {path}")
    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(_decode, _ROW_SCHEMA)
    # Fields by position; names are made unique by the caller.
    body = rows.filter((F.col("linha") > 0) & F.exists("celulas", lambda c: c.isNotNull()))
    numbered = body.select(*[F.get("celulas", F.lit(i)).alias(f"c{i}") for i in range(shape.width)])
    labels = [*shape.head, *[None] * (shape.width - len(shape.head))]
    names = [f"Unnamed: {i}" if name is None else name for i, name in enumerate(labels)]
    return numbered.toDF(*names)
