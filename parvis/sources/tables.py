"""Reading and writing the engine's tables (CSV or Parquet)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructType

from ..session import cut_lineage
from . import schemas


def _kind(path: str) -> str:
    return "csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet"


def _typed(name: str, kind) -> Column:
    """Cast that yields null for text that does not fit, and null for NaN."""
    if isinstance(kind, StringType):
        return F.col(name).cast(kind)
    if isinstance(kind, DateType):
        return F.try_to_date(F.substring(F.col(name).cast("string"), 1, 10), "yyyy-MM-dd")
    number = F.col(name).try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if isinstance(kind, DoubleType) else F.coalesce(F.col(name).try_cast(kind), number.try_cast(kind))


def _conform(df: DataFrame, schema: StructType, optional: set[str]) -> DataFrame:
    missing = [f.name for f in schema if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"input lacks the columns {missing}")
    known = [f for f in schema if f.name in df.columns]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*[_typed(f.name, f.dataType).alias(f.name) for f in known], *extra)


def _scan(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``multi_line`` reads CSV whose quoted texts hold line breaks; each file is then one task."""
    if _kind(path) == "csv":
        return spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"').csv(path)
    return spark.read.parquet(path)


def read_listings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Listings with the columns of ``schemas.LISTINGS``.

    Listing order decides ties, so the input must carry ``row_idx``; use
    ``number_rows`` once, at ingest, for files that lack it.
    """
    return _conform(_scan(spark, path, multi_line), schemas.LISTINGS, {"pricing_bias", "property_type"})


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sale records with the columns of ``schemas.SALES``; unreadable dates become null."""
    optional = {"id_mutation", "nombre_pieces_principales", "prix_m2"}
    return _conform(_scan(spark, path), schemas.SALES, optional)


def read_answers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Model answers produced elsewhere; ``answered_at`` and ``model`` may come with them."""
    return _conform(_scan(spark, path, multi_line), schemas.ANSWERS, set())


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that ``write_table`` has written, with the types of ``schema``."""
    multi_line = _kind(path) == "csv"
    return _conform(_scan(spark, path, multi_line), schema, set()).select(*schema.fieldNames())


def read_removals(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.REMOVALS)


def rejects(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """(file, reasons, record) of the rows in which a filled field could not be read as its type.

    Such fields are null in the tables that ``read_listings`` and ``read_sales`` return; the
    record is kept here as JSON text. Empty fields and NaN are missing, not unreadable.
    """
    raw = _scan(spark, path, multi_line)
    reasons = []
    for field in schema:
        if field.name in raw.columns and not isinstance(field.dataType, StringType):
            text = F.trim(F.col(field.name).cast("string"))
            filled = F.coalesce((text != "") & (F.lower(text) != "nan"), F.lit(False))
            unread = filled & _typed(field.name, field.dataType).isNull()
            reasons.append(F.when(unread, F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), text)))
    found = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))
    return raw.select(F.col("_metadata.file_path").alias("file"), found.alias("reasons"), record.alias("record")).filter("reasons <> ''")


def number_rows(spark: SparkSession, path: str, numbered_path: str, multi_line: bool = False) -> DataFrame:
    """Store the listings of ``path`` with a ``row_idx`` and return the stored table.

    Rows count from 0 in the order of file paths and of rows in a file, however the files are
    split: a task numbers the rows of a block, and running sums over the blocks, one row each,
    give every block its start.
    """
    block = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    rows = cut_lineage(_scan(spark, path, multi_line).select("*", *block, F.monotonically_increasing_id().alias("_at")))
    blocks = rows.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = (F.col("_start") + F.col("_at") - F.col("_first")).alias("row_idx")
    kept = [c for c in rows.columns if c not in ("_file", "_block", "_at")]
    numbered = rows.join(starts, ["_file", "_block"]).select(*[F.col(f"`{c}`") for c in kept if c != "row_idx"], number)
    numbered.write.mode("overwrite").parquet(numbered_path)
    return read_listings(spark, numbered_path)


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Changes with the names, sizes and times of the files below ``paths``; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    marks = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.bit_xor(marks).alias("marks")).first()
    return f"{row['n']}-{row['size']}-{row['marks']}"


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite ``path`` with ``df``; the ending picks CSV (with header) or Parquet."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if _kind(path) == "csv":
        # Quotes inside a field are doubled, as other CSV readers expect; blanks around it stay.
        blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, quote='"', escape='"', **blanks).csv(path)
    else:
        writer.parquet(path)
