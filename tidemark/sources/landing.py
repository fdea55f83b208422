"""Landing files: discovery, and reads that keep every value as text."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.combine import union_drifting

SOURCE = "_source_file"
# Fixed value: the schema of Spark's file listing source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# Names that every bronze row has from its load, and the name under which Spark keeps malformed text.
LINEAGE = ("_ingested_at", "_source_file", "_batch_id")
CORRUPT = "_corrupt_record"


def is_missing(error: AnalysisException) -> bool:
    """Is this Spark's answer to a path without data?"""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _named(fmt: str) -> str:
    """The names of a feed's files: with its extension, compressed or not."""
    return f"*.{{{fmt},{fmt}.gz}}"


def landing_files(spark: SparkSession, folder: str, fmt: str) -> list[str]:
    """The files of one feed, sorted; a missing folder has none (A1)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", _named(fmt)).option("recursiveFileLookup", True)
    try:
        return sorted(r.path for r in reader.load(folder).select("path").collect())
    except AnalysisException as error:
        if is_missing(error):
            return []
        raise


def landing_stream(spark: SparkSession, folder: str, fmt: str, max_files: int) -> DataFrame:
    """New landing files as a stream of paths. The contents are not read here: only ``path`` is selected."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", _named(fmt))
    return reader.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).load(folder).select("path")


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line with text of each file, in one distributed read whatever the number of files.

    Only lines of a file's first block are looked at, and each task keeps one per file. The result is as long as the list of
    paths.
    """
    block, path = F.col("_metadata.file_block_start"), F.col("_metadata.file_path")
    lines = spark.read.text(list(paths)).select("value", path.alias(SOURCE), block.alias("_block"), F.monotonically_increasing_id().alias("_place"))
    firsts = lines.where("_block = 0 AND trim(value) <> ''").groupBy(SOURCE).agg(F.min_by("value", "_place").alias("header"))
    return {r[SOURCE]: r.header for r in firsts.collect()}


def stored_names(sent: Sequence[str], known: Mapping[str, str]) -> list[str]:
    """The column each sent name is kept under, all different.

    ``known`` maps names in lower case to columns seen before: a name in another case is the same column. A blank name becomes
    ``_c`` and its place, a name that a header repeats gets its place appended, and one that lineage columns use gets ``_sent``.
    """
    low = [name.lower() for name in sent]
    names: list[str] = []
    for place, name in enumerate(sent):
        if not name.strip():
            name = f"_c{place}"
        elif low.count(name.lower()) > 1:
            name = f"{name}{place}"
        if name.lower() in LINEAGE:
            name = f"{name}_sent"
        name = known.get(name.lower(), name)
        while name.lower() in {n.lower() for n in names}:
            name += "_"
        names.append(name)
    return names


def by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files of the same header line, under that line; files without text have none."""
    groups: dict[str, list[str]] = defaultdict(list)
    for path, header in sorted(first_lines(spark, paths).items()):
        groups[header].append(path)
    return dict(sorted(groups.items(), key=lambda group: group[1]))


def read_csv(spark: SparkSession, paths: Sequence[str], known: Mapping[str, str]) -> Landed | None:
    """CSV files with headers, all text (A2): one scan per distinct header, whatever the number of files."""
    frames, pairs, known = [], [], dict(known)
    for header, members in by_header(spark, paths).items():
        sent = next(csv.reader([header]))
        names = stored_names(sent, known)
        pairs += zip(sent, names)
        known |= {name.lower(): name for name in names}
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        reader = spark.read.schema(schema).option("header", True)  # the header was read above: its line is skipped
        frames.append(reader.csv(members).select("*", F.col("_metadata.file_path").alias(SOURCE)))
    return Landed(union_drifting(frames), list(dict.fromkeys(pairs))) if frames else None


def fields_of(lines: DataFrame) -> DataFrame:
    """``_source_file, line, fields``: one row per JSON object; ``fields`` is null where a line is no JSON object (A3).

    A line may hold an array of objects. All values are text, numbers as they were written. Blank lines are left out.
    """
    one, many = (F.from_json("line", kind) for kind in ("map<string,string>", "array<map<string,string>>"))
    found = F.when(F.ltrim("line").startswith("["), many).otherwise(F.array(one))
    none = F.array(F.lit(None).cast("map<string,string>"))
    return lines.where("trim(line) <> ''").select(SOURCE, "line", F.explode(F.coalesce(found, none)).alias("fields"))


def read_json(spark: SparkSession, paths: Sequence[str], known: Mapping[str, str]) -> Landed | None:
    """JSON lines, all values as text, read as text (A3)."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias(SOURCE), F.col("value").alias("line"))
    return landed_json(fields_of(lines), known, paths)


def landed_json(rows: DataFrame, known: Mapping[str, str], paths: Sequence[str] = ()) -> Landed | None:
    """JSON objects as columns; what is no JSON object is kept whole in ``_corrupt_record``.

    The names that occur are collected by an aggregate that starts in each task, so the driver gets as many rows as there will be
    columns. Names that differ in case only are one column. Nested values stay JSON where no files are named. The lines are read
    once for the names and once for the rows: kept parsed, they would take several times the files' size.
    """
    corrupt = F.array(F.struct(F.lit(CORRUPT).alias("key"), F.lit("").alias("value")))
    pairs = rows.select(F.inline(F.coalesce(F.map_entries("fields"), corrupt)))
    found = pairs.groupBy("key").agg(F.max(F.col("value").rlike(r"^[{\[]")).alias("nested")).orderBy("key").collect()
    if not found:
        return None
    nested = _nested_types(rows.sparkSession, paths, [r.key for r in found if r.nested]) if paths else {}
    names: list[tuple[str, str]] = []
    known = dict(known)
    for sent in (r.key for r in found):
        (column,) = stored_names([sent], known)
        known[column.lower()] = column
        names.append((sent, column))
    columns = []
    for column in dict.fromkeys(c for _, c in names):
        values = [_value(sent, nested.get(sent)) for sent, c in names if c == column]
        if column == CORRUPT:
            values.insert(0, F.when(F.col("fields").isNull(), F.col("line")))
        columns.append(F.coalesce(*values).alias(column))
    return Landed(rows.select(*columns, SOURCE), names)


def _value(name: str, kind: T.DataType | None) -> Column:
    text = F.try_element_at("fields", F.lit(name))
    return text if kind is None else F.from_json(text, kind).cast("string")


def _nested_types(spark: SparkSession, paths: Sequence[str], names: Sequence[str]) -> dict[str, T.DataType]:
    """Types of the fields that hold objects or lists throughout; only feeds that have some are read again for them."""
    if not names:
        return {}
    try:
        schema = spark.read.option("primitivesAsString", True).json(list(paths)).schema
    except AnalysisException:  # names that differ in case only: their values stay JSON
        return {}
    return {f.name: f.dataType for f in schema.fields if f.name in names and not isinstance(f.dataType, T.StringType)}


@dataclass(frozen=True)
class Landed:
    """Rows of landing files, and each sent name with the column it is kept under."""

    rows: DataFrame
    names: list[tuple[str, str]]


READERS = {"csv": read_csv, "json": read_json}


def land(spark: SparkSession, paths: Sequence[str], fmt: str, known: Mapping[str, str] | None = None) -> Landed | None:
    """The rows of some landing files with their file names; ``None`` when the files hold no rows and no names."""
    return READERS[fmt](spark, paths, known or {})


def read_landing(spark: SparkSession, paths: Sequence[str], fmt: str) -> DataFrame | None:
    found = land(spark, paths, fmt)
    return None if found is None else found.rows


def with_lineage(df: DataFrame, batch_id: int) -> DataFrame:
    """Add load time and batch to rows that carry their file name (A4)."""
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_batch_id": F.lit(batch_id).cast("long")})
