"""Raw CSV landing: all-string read, missing-value tokens to null, read failures as a report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.parse import MISSING_TOKENS
from vigil.session import cut_lineage

CORRUPT = "_corrupt_record"


@dataclass
class CsvRead:
    df: DataFrame | None
    header: list[str] = field(default_factory=list)
    error: str | None = None


def read_header(spark: SparkSession, path: str, multiline: bool = False) -> list[str]:
    """The header's names as written, repeats kept, quotes understood: the first record of the first file."""
    first = spark.read.option("header", False).option("multiLine", multiline).csv(path).limit(1).collect()
    return ["" if v is None else v.strip() for v in first[0]] if first else []


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> CsvRead:
    """Read a headered CSV (one file or a folder of them) with every column as string.

    The header of every file must name the same columns in the same order, else the read fails. Missing-value
    spellings become null; a row with fewer fields than the header is padded with nulls; one with more is a read
    failure, as a strict parser would raise on it. ``multiline``: quoted fields may hold line breaks (a file is then
    read by one task).
    """
    try:
        header = read_header(spark, path, multiline)
    except AnalysisException as exc:
        return CsvRead(None, [], f"Failed to read CSV file: {exc.getMessage() if hasattr(exc, 'getMessage') else exc}")
    if not header:
        return CsvRead(None, [], "Failed to read CSV file: No columns to parse from file")
    repeated = {h for h in header if header.count(h) > 1}
    names = [f"{h}{i}" if h in repeated else h for i, h in enumerate(header)]  # repeated names get a position suffix, as Spark does
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", multiline)
          .option("columnNameOfCorruptRecord", CORRUPT).option("nullValue", None)
          .option("enforceSchema", bool(repeated)).schema(schema).csv(path))
    cleaned = df.select(*[F.when(~F.col(f"`{n}`").isin(*MISSING_TOKENS), F.col(f"`{n}`")).alias(n) for n in names], CORRUPT)
    # of the rows that do not fit the header, those with a field too many: parsed again with one column more
    wide = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    extra = F.from_csv(CORRUPT, F.lit(wide), {"mode": "PERMISSIVE"})[f"c{len(names)}"]
    try:
        bad = cleaned.filter(F.col(CORRUPT).isNotNull()).select(extra.alias("x"), "*").filter("x is not null").limit(1).collect()
        headers = _headers_differ(spark, path, header) if repeated else None
    except Exception as exc:  # a header that does not fit surfaces when its file is read
        if "header" not in str(exc).lower():
            raise
        headers = "CSV header does not conform to the first file's"
        bad = []
    if headers:
        return CsvRead(None, header, f"Failed to read CSV file: {headers}")
    if bad:
        return CsvRead(None, header, "Failed to read CSV file: a row has a different number of fields than the header")
    return CsvRead(cleaned.drop(CORRUPT), header, None)


def _headers_differ(spark: SparkSession, path: str, header: list[str]) -> str | None:
    """For repeated names, which Spark's own header check cannot compare: the header records of all files against the first."""
    files = spark.read.option("header", False).csv(path)
    first = files.withColumn("_f", F.input_file_name()).withColumn("_i", F.monotonically_increasing_id())
    row = F.struct(*[F.trim(c) for c in files.columns])
    kinds = first.groupBy("_f").agg(F.min_by(row, "_i").alias("h")).select("h").distinct().count()
    return "the files have different headers" if kinds > 1 else None


def landing_check(spark: SparkSession, path_glob: str) -> DataFrame:
    """One row: n_files (with content), n_bytes, is_empty, passed. Spark's listing leaves out files without content, so a
    landing of empty bodies has no file here and fails the check."""
    files = spark.read.format("binaryFile").load(path_glob).select("length")
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")).select(
        "n_files", "n_bytes", (F.col("n_files") == 0).alias("is_empty"), (F.col("n_files") > 0).alias("passed"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): every line of every text file under ``path`` with its number in its file, from 1, in parallel.

    A file is read in splits that know where they begin (``_metadata.file_block_start``). The lines of a split are numbered by
    their place in the task that read it; the lines of the splits before are added from one count per split. The lines
    are written once, so both steps see the same places. Line breaks inside quotes end a line here."""
    at = F.col("_metadata")
    lines = cut_lineage(spark.read.text(path).select("value", at["file_path"].alias("file"), at["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("place")))
    splits = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))  # a row for each split of a file
    offsets = splits.select(F.col("file").alias("_f"), F.col("start").alias("_s"), "first", F.coalesce(before, F.lit(0)).alias("before"))
    joined = lines.join(offsets, (F.col("file") == F.col("_f")) & (F.col("start") == F.col("_s")))
    return joined.select("file", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line"), "value")


def rejected_lines(spark: SparkSession, path: str, n_columns: int) -> DataFrame:
    """(file, line, reason, value) of the data lines that a strict landing refuses, with their place: more fields than the header
    (``n_columns``), or nothing but empty fields and missing-value spellings (a fully empty row). Short rows are padded, so they pass."""
    wide = ", ".join(f"c{i} string" for i in range(n_columns + 1))
    cells = F.from_csv("value", F.lit(wide), {"mode": "PERMISSIVE"})
    parsed = numbered_lines(spark, path).filter("line > 1").withColumn("cells", cells)
    missing = lambda c: F.col(f"cells.{c}").isNull() | F.col(f"cells.{c}").isin("", *MISSING_TOKENS)
    empty = F.lit(True)
    for i in range(n_columns):
        empty = empty & missing(f"c{i}")
    # a field beyond the one too many is dropped by the reader, so the last column says that there is at least one
    long = F.col(f"cells.c{n_columns}").isNotNull() | (F.size(F.split("value", ",")) > n_columns) & ~F.col("value").contains('"')
    reason = F.when(long, "too many fields").when(empty, "fully empty row")
    return parsed.select("file", "line", reason.alias("reason"), "value").filter("reason IS NOT NULL")
