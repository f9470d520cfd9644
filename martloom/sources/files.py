"""Drop folders: file classification, multi-file reads and path attributes."""

from __future__ import annotations

import codecs
import csv
import sys
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.sets import union_all
from martloom.sources.headers import align_by_modal_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

# Leading bytes of file containers. Fixed values.
ZIP_MAGIC = "504B0304"
OLE2_MAGIC = "D0CF11E0A1B11AE1"


PROBE = 1 << 16  # bytes read of each file at first; more only while its first line goes on
FOUND = "path string, length long, format string, header array<string>"


def first_line(read, length: int, probe: int = PROBE) -> bytes:
    """The first line that isn't blank, from `read(start, size)`; parts are read until it ends."""
    held, at = b"", 0
    while True:
        if at < length:
            part = read(at, min(probe, length - at))
            held, at = held + part, length if not part else at + len(part)
        held = held.removeprefix(codecs.BOM_UTF8).lstrip(b" \t\r\n")
        ends = [e for e in (held.find(b"\n"), held.find(b"\r")) if e >= 0]
        if ends:
            return held[: min(ends)]
        if at >= length:
            return held


def header_names(line: bytes) -> list[str]:
    """Column names of a CSV header: quoted commas belong to the name, unnamed and repeated ones get their place."""
    names = [n.strip() for n in next(csv.reader([line.decode("utf-8", "replace")]), [])]
    folded = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if folded.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _uri(path: str) -> str:
    """A listed path, whose names are written plainly, as an escaped URI."""
    scheme, _, rest = path.rpartition(":/")
    return f"{scheme or 'file'}:/{'' if rest.startswith('/') else '//' if (scheme or 'file') == 'file' else ''}{quote(rest, safe='/@=,+:')}"


def probe_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, format and header of every file below a folder, on executors.

    Names and lengths come from the listing; of each file only the first kilobytes are read, however large
    it is. xlsx, xls or csv by the leading bytes, whatever the file is called; spreadsheets and blank files have no
    header. Files without a single byte are not listed, as in any Spark source.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")

    def step(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, place = fs.FileSystem.from_uri(_uri(path))
                with system.open_input_file(place) as file:
                    magic = file.read_at(min(8, length), 0).hex().upper() if length else ""
                    kind = "xlsx" if magic.startswith(ZIP_MAGIC) else "xls" if magic == OLE2_MAGIC else "csv"
                    line = first_line(lambda at, size, f=file: f.read_at(size, at), length) if kind == "csv" else b""
                found.append({"path": path, "length": length, "format": kind, "header": header_names(line) if line else None})
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("path", pa.string()), ("length", pa.int64()), ("format", pa.string()), ("header", pa.list_(pa.string()))]))

    return listed.mapInArrow(step, FOUND)


def detect_format(spark: SparkSession, folder: str) -> DataFrame:
    """xlsx, xls or csv by the leading bytes, whatever the file is called."""
    return probe_files(spark, folder).select("path", "format")


def drop_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of a drop folder with what becomes of it: read, spreadsheet, empty or unwanted name."""
    fate = (
        F.when(~wanted(F.col("path")), "unwanted name")
        .when(F.col("format") != "csv", "spreadsheet not read")
        .when(F.col("header").isNull(), "empty")
        .otherwise("read")
    )
    return probe_files(spark, folder).withColumn("status", fate)


def wanted(path: Column) -> Column:
    """Spreadsheet or CSV names and names without extension; hidden files are not wanted."""
    name = F.element_at(F.split(path, "/"), -1)
    return ~name.startswith(".") & ~name.startswith("_") & (name.rlike(r"(?i)\.(csv|xls|xlsx)$") | ~name.contains("."))


def read_drop(spark: SparkSession, folder: str) -> DataFrame:
    """All text files of a drop folder by column name, each row tagged with its file.

    Files with the same header are read by one scan, so the plan grows with the number of
    layouts and not with the number of files. `drop_listing` names the files left out.
    """
    return union_all(*[_scan(spark, list(header), paths) for header, paths in sorted(layouts(spark, folder).items())])


def layouts(spark: SparkSession, folder: str) -> dict[tuple[str, ...], list[str]]:
    """Paths of the text files by header. File names and headers are metadata and small."""
    found: dict[tuple[str, ...], list[str]] = {}
    for row in drop_listing(spark, folder).filter("status = 'read'").select("path", "header").orderBy("path").collect():
        found.setdefault(tuple(row["header"]), []).append(row["path"])
    if not found:
        raise FileNotFoundError(folder)
    return found


def _scan(spark: SparkSession, header: list[str], paths: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # a quote inside a quoted value is doubled, as in the header
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(sorted(paths)).withColumn("path", F.input_file_name())


def read_monthly(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Monthly files aligned on the header most of them have, one scan per header; second value lists files left out."""
    found = layouts(spark, folder)
    frames = {header: _scan(spark, list(header), paths).drop("path") for header, paths in found.items()}
    aligned, dropped = align_by_modal_schema(frames, weights={header: len(paths) for header, paths in found.items()})
    return aligned, sorted(path for header in dropped for path in found[header])


def from_path(path: Column, pattern: str, group: int = 1) -> Column:
    """Attribute in a file path, null when the pattern is absent."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def line_from_path(path: Column, lines: list[str], pattern: str = r"reviews/0*(\d+)") -> Column:
    """Numbered drop folder -> entry of the product-line list."""
    return F.try_element_at(F.array(*[F.lit(x) for x in lines]), from_path(path, pattern).cast("int"))


def parent_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)
