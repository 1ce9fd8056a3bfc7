"""Raw extract files: listing, delimiter and encoding detection, readers by suffix."""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.functions.names import normalize_name, unique_names, with_clean_names
from stalewatch.sources.workbook import WorkbookShape, inspect_workbooks, read_workbook

CSV, XLSX = ".csv", ".xlsx"
SUFFIXES = (CSV, XLSX)
DELIMITERS = (",", ";", "\t", "|")
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"

# Texts a CSV field may hold for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SOURCE = "__source"


@dataclass(frozen=True)
class Dialect:
    """How a CSV file is to be read; files of one dialect can be read together."""

    names: tuple[str, ...]
    delimiter: str
    encoding: str
    spans_lines: bool


def list_files(spark: SparkSession, folder: str, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Files below a folder with a wanted suffix in any case: path, length.

    Only names and sizes are read; the content column is pruned. Files of zero bytes are not listed.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    name = F.lower("path")
    return found.filter(reduce(lambda a, b: a | b, [name.endswith(s) for s in suffixes]))


def pick_delimiter(header: str, delimiters: Sequence[str] = DELIMITERS) -> str:
    """The delimiter that occurs most often outside quotes; a comma when none occurs."""
    outside = "".join(header.split('"')[::2])
    best = max(delimiters, key=lambda d: (outside.count(d), -delimiters.index(d)))
    return best if best in outside else ","


def _same_file(path: str) -> str:
    """Path without scheme and authority, which Spark may add or write in several ways."""
    return re.sub(r"^\w[\w+.-]*:(//[^/]*)?", "", path)


@dataclass(frozen=True)
class Inspection:
    """What a full read of a CSV file has shown: dialect, data records, and why it cannot be used (None: it can)."""

    dialect: Dialect
    rows: int
    fault: str | None


_READER = {"quote": '"', "escape": '"'}
#: A field put behind every record; the place where it comes out tells how many fields the record has.
_END = "stalewatch-end"
BINARY, OPEN_QUOTE = "null bytes in a text file", "a quoted field has no end"


def _occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))).cast("int")


def _unpaired(line: Column, delimiter: str) -> Column:
    """Whether quotes remain in a line without its complete quoted fields; only a reader of records can tell then."""
    d = re.escape(delimiter)
    complete = f'(?:^|(?<={d}))"(?:[^"]++|"")*+"(?={d}|$)'
    return F.when(line.contains('"'), F.regexp_replace(line, complete, "").contains('"')).otherwise(False)


def _fields(record: Column, delimiter: str, width: int) -> Column:
    """The fields of a record as an array, by the parser that reads the files."""
    schema = ", ".join(f"f{i} string" for i in range(width))
    parsed = F.from_csv(record, schema, {**_READER, "sep": delimiter, "maxColumns": str(width + 1)})
    return F.transform(F.array(parsed), lambda r: F.array(*[r.getField(f"f{i}") for i in range(width)]))[0]


def _whole_records(spark: SparkSession, paths: Sequence[str], dialect: Sequence) -> DataFrame:
    """Text of every record of files of one delimiter, encoding and line rule, and the file.

    A record of other than one whole number is malformed for a reader of one such column, which then hands on its text.
    """
    delimiter, encoding, spans_lines = dialect
    if not spans_lines:
        lines = spark.read.text(list(paths)).filter(F.trim("value") != "")
        return lines.select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("file"))
    reader = spark.read.options(
        **_READER, sep=delimiter, encoding=encoding, multiLine=True, columnNameOfCorruptRecord="whole"
    )
    rows = reader.schema("only int, whole string").csv(list(paths))
    record = F.coalesce("whole", F.col("only").cast("string"), F.lit(""))
    return rows.select(record.alias("record"), F.col("_metadata.file_path").alias("file"))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.union(b), frames)


def _by_file(frame: DataFrame) -> dict[str, Row]:
    return {_same_file(unquote(r["file"])): r for r in frame.toLocalIterator()}


def _line_facts(spark: SparkSession, paths: Sequence[str]) -> dict[str, Row]:
    """Of every file: its first line, whether all lines are valid UTF-8, and by delimiter what a line holds at most."""
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    line = F.col("value")
    facts = lines.groupBy("file").agg(
        F.bool_and(F.is_valid_utf8(line)).alias("utf8"),
        F.bool_or(line.contains("\0")).alias("binary"),
        F.count_if(F.trim(line) != "").alias("records"),
        *[F.max(_occurrences(line, d)).alias(f"most{i}") for i, d in enumerate(DELIMITERS)],
        *[F.bool_or(_unpaired(line, d)).alias(f"unpaired{i}") for i, d in enumerate(DELIMITERS)],
    )
    heads = (
        lines.filter((F.col("start") == 0) & (F.trim(line) != ""))
        .withColumn("at", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("head"))
    )
    latin = F.decode(F.col("head").cast("binary"), LATIN1)
    return _by_file(facts.join(heads, "file").withColumn("head", F.when(F.col("utf8"), F.col("head")).otherwise(latin)))


def _record_facts(spark: SparkSession, files: dict[tuple, list[str]]) -> dict[str, Row]:
    """First record, number of records and most delimiters in a record of files whose quotes may span lines."""
    parts = []
    for dialect, paths in files.items():
        most = _occurrences(F.col("record"), dialect[0]).alias("most")
        # A file is one partition, in order.
        numbered = _whole_records(spark, paths, dialect).withColumn("at", F.monotonically_increasing_id())
        parts.append(numbered.select("record", "file", "at", most))
    found = _union(parts).groupBy("file").agg(
        F.min_by("record", "at").alias("head"), F.count(F.lit(1)).alias("records"), F.max("most").alias("most")
    )
    return _by_file(found)


def _widths(spark: SparkSession, files: dict[tuple, list[tuple[str, int]]]) -> dict[str, Row]:
    """Most fields of a record, and whether a record ends inside quotes; ``files`` has each file with a bound of its fields."""
    parts = []
    for dialect, bounded in files.items():
        records = _whole_records(spark, [path for path, _ in bounded], dialect)
        ended = F.concat("record", F.lit(dialect[0] + _END))
        fields = _fields(ended, dialect[0], max(bound for _, bound in bounded) + 1)
        places = F.transform(fields, lambda f, i: F.when(f.isNotNull(), i + 1))
        parts.append(records.select("file", fields.alias("fields"), F.array_max(places).alias("last")))
    closed = F.element_at("fields", F.col("last")) == _END
    found = _union(parts).select("file", closed.alias("closed"), (F.col("last") - F.when(closed, 1).otherwise(0)).alias("width"))
    return _by_file(found.groupBy("file").agg(F.max("width").alias("width"), F.bool_and("closed").alias("closed")))


def _headers(spark: SparkSession, heads: dict[str, tuple[str, str, int]]) -> dict[str, list[str | None]]:
    """Fields of the first record of each file: path -> (record, delimiter, bound of the fields)."""
    parts = []
    for delimiter in sorted({d for _, d, _ in heads.values()}):
        rows = [(path, head) for path, (head, d, _) in heads.items() if d == delimiter]
        bound = max(b for _, d, b in heads.values() if d == delimiter)
        frame = spark.createDataFrame(rows, "file string, record string")
        ended = F.concat("record", F.lit(delimiter + _END))
        parts.append(frame.select("file", _fields(ended, delimiter, bound + 1).alias("fields")))
    labels = {}
    for row in _union(parts).toLocalIterator():
        last = max(i for i, f in enumerate(row["fields"]) if f is not None)
        labels[row["file"]] = row["fields"][: last if row["fields"][last] == _END else last + 1]
    return labels


def inspect_csv(spark: SparkSession, paths: Sequence[str]) -> dict[str, Inspection]:
    """Dialect and soundness of every non-empty file, each read as a whole.

    One job looks at the lines of all files. Files with quotes that a single line does not pair are read once
    more, record by record, as are files with a line of more delimiters than the header: the number of their
    fields is what the parser makes of each record. The same parser reads headers and values, so no field of
    a record beyond the header is lost; it gets a column ``Unnamed: n``. One short row per file comes back.
    """
    listed = {_same_file(p): p for p in paths}
    lines = {listed[f]: r for f, r in _line_facts(spark, paths).items()}
    known: dict[str, tuple] = {}
    spanning: dict[tuple, list[str]] = {}
    for path, row in lines.items():
        at = DELIMITERS.index(pick_delimiter(row["head"]))
        known[path] = (DELIMITERS[at], UTF8 if row["utf8"] else LATIN1, row[f"unpaired{at}"])
        if row[f"unpaired{at}"]:
            spanning.setdefault(known[path], []).append(path)
    records = {listed[f]: r for f, r in _record_facts(spark, spanning).items()} if spanning else {}

    heads = {}
    for path, (delimiter, _, _) in known.items():
        row = records.get(path)
        most = row["most"] if row else lines[path][f"most{DELIMITERS.index(delimiter)}"]
        heads[path] = (row["head"] if row else lines[path]["head"], delimiter, most + 1)
    labels = _headers(spark, heads) if heads else {}
    uncertain: dict[tuple, list[tuple[str, int]]] = {}
    for path, (_, _, bound) in heads.items():
        if path in records or bound > len(labels[path]):
            uncertain.setdefault(known[path], []).append((path, bound))
    widths = {listed[f]: r for f, r in _widths(spark, uncertain).items()} if uncertain else {}

    found = {}
    for path, (delimiter, encoding, spans_lines) in known.items():
        width = max(len(labels[path]), widths[path]["width"] if path in widths else 0)
        names = [name or f"Unnamed: {i}" for i, name in enumerate([*labels[path], *[None] * (width - len(labels[path]))])]
        clean = tuple(unique_names(normalize_name(name) for name in names))
        closed = path not in widths or widths[path]["closed"]
        fault = BINARY if lines[path]["binary"] else None if closed else OPEN_QUOTE
        count = (records if path in records else lines)[path]["records"] - 1
        found[path] = Inspection(Dialect(clean, delimiter, encoding, spans_lines), count, fault)
    return found


def csv_dialects(spark: SparkSession, paths: Sequence[str]) -> dict[str, Dialect]:
    """Dialect of every non-empty file; see :func:`inspect_csv`."""
    return {path: found.dialect for path, found in inspect_csv(spark, paths).items()}


def read_csv_files(
    spark: SparkSession, paths: Sequence[str], dialect: Dialect, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """Text columns of files of one dialect, and the file each row comes from.

    Files stay splittable unless some line leaves a quote open.
    """
    fields = [T.StructField(name, T.StringType()) for name in dialect.names]
    rows = spark.read.options(
        **_READER,
        header=True,
        sep=dialect.delimiter,
        encoding=dialect.encoding,
        multiLine=dialect.spans_lines,
        maxColumns=max(len(fields) + 1, 20480),
    )
    frame = rows.schema(T.StructType(fields)).csv(list(paths))
    values = [F.when(~F.trim(F.col(f"`{c}`")).isin(*null_tokens), F.col(f"`{c}`")).alias(c) for c in dialect.names]
    return frame.select(*values, F.col("_metadata.file_path").alias(SOURCE))


def inspect_books(spark: SparkSession, paths: Sequence[str]) -> dict[str, WorkbookShape]:
    """Shape and soundness of every workbook, by the given paths."""
    listed = {_same_file(p): p for p in paths}
    return {listed[_same_file(p)]: shape for p, shape in inspect_workbooks(spark, paths).items()}


def read_book(spark: SparkSession, path: str, shape: WorkbookShape | None = None) -> DataFrame:
    """Rows of a workbook with clean names, and the file."""
    return with_clean_names(read_workbook(spark, path, shape)).withColumn(SOURCE, F.lit(path))


def read_with_source(spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Reader by file suffix; text columns with clean, unique names, and the source file."""
    name = path.lower()
    if name.endswith(CSV):
        dialect = csv_dialects(spark, [path]).get(path)
        if dialect is None:
            raise ValueError(f"empty file: {path}")
        return read_csv_files(spark, [path], dialect, null_tokens)
    if name.endswith(XLSX):
        return read_book(spark, path)
    raise ValueError(f"unsupported file format: {path}")


def read_file(spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Text columns of a CSV or XLSX file."""
    return read_with_source(spark, path, null_tokens).drop(SOURCE)


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of several files; columns a file lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
