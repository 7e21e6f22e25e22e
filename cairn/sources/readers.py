"""Sources (S1-S12): file scans with declared schemas, lineage and load
reports, file listing, inline rows and generated rows.

Every reader returns a lazy DataFrame: the scan runs on the executors, split
by ``spark.sql.files.maxPartitionBytes``, with column pruning and filter
pushdown reaching the file format where it supports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.session import read_table  # noqa: F401  (S1, re-exported)
from cairn.sources import files

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             mode: str = "PERMISSIVE", **options) -> DataFrame:
    """CSV with a declared schema; header skipped; fields optionally
    enclosed in double quotes, doubled quotes inside; empty unquoted field is
    NULL. ``mode='FAILFAST'`` aborts the load on the first bad record."""
    r = (spark.read.schema(schema).option("header", header).option("quote", '"')
         .option("escape", '"').option("mode", mode))
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def read_json_variant(spark: SparkSession, path: str, col: str = "v") -> DataFrame:
    """S3: JSON lines, one VARIANT per document (schema on read)."""
    return spark.read.option("singleVariantColumn", col).json(path)


def read_parquet_by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Load parquet into a declared schema, matching columns by name
    case-insensitively; source columns not in the schema are ignored, schema
    columns missing in the source are NULL. Values are cast to the declared
    types (ANSI: an impossible cast fails the load)."""
    src = spark.read.parquet(path)
    by_lower = {c.lower(): c for c in src.columns}
    cols = []
    for f in schema.fields:
        name = by_lower.get(f.name.lower())
        c = F.col(f"`{name}`") if name is not None else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return src.select(*cols)


def with_lineage(df: DataFrame, file_col: str = "source_file", loaded_col: str = "loaded_at",
                 full_path: bool = False) -> DataFrame:
    """Add the source file of each row and the load time (a column
    default filled at load)."""
    meta = F.col("_metadata.file_path") if full_path else F.col("_metadata.file_name")
    return df.select("*", meta.alias(file_col), F.current_timestamp().alias(loaded_col))


def read_with_report(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                     **options) -> tuple[DataFrame, DataFrame]:
    """A PERMISSIVE load that keeps malformed rows aside, plus a load
    report per file: rows parsed, rows loaded, errors, status. Returns
    (loaded rows, report)."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    r = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        r = r.option("header", True).option("quote", '"').option("escape", '"')
    for k, v in options.items():
        r = r.option(k, v)
    raw = r.format(fmt).load(path).select("*", F.col("_metadata.file_name").alias("_file"))
    raw = files.staged(raw, "load")  # parsed once; Spark forbids querying only the corrupt column of a raw scan
    bad = F.col(CORRUPT).isNotNull()
    report = raw.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count(F.when(~bad, 1)).alias("rows_loaded"),
        F.count(F.when(bad, 1)).alias("errors_seen"))
    report = report.withColumn("status", F.when(F.col("errors_seen") == 0, "LOADED")
                               .when(F.col("rows_loaded") > 0, "PARTIALLY_LOADED").otherwise("LOAD_FAILED"))
    good = raw.filter(~bad).drop(CORRUPT, "_file")
    return good, report


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files under a prefix with size and modification time (the content
    column is pruned, so files are not read)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(path).select(F.col("path"), F.col("length").alias("size"),
                               F.col("modificationTime").alias("last_modified"))


def inline_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """VALUES as a DataFrame (small, fixed literal tables only)."""
    return spark.createDataFrame(rows, schema)


def generate_rows(spark: SparkSession, n: int, seed: int = 42, payload_len: int = 80,
                  id_max: int = 1_000_000_000_000) -> DataFrame:
    """``n`` generated rows with a scattered random id and a random
    payload, produced in parallel by ``spark.range`` (no driver data). The
    seeded generators draw a new value per row; the sequence is fixed for a
    given seed and partitioning."""
    return spark.range(n).select(
        F.expr(f"uniform(1L, {id_max}L, {seed})").cast("bigint").alias("event_id"),
        F.expr(f"randstr({payload_len}, {seed})").alias("payload"))


def load_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   **options) -> DataFrame:
    """A CSV file to a table, read by the executors (no client upload
    through the driver). Without a schema, inference is used (not for
    production: it costs an extra pass)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)
