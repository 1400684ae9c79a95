"""Which files a reader that skips unreadable ones has passed over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.schemas import AGGREGATE
from kerbstream.sources.missing import empty_if_missing

MANIFEST = T.StructType([
    T.StructField("file_path", T.StringType()), T.StructField("bytes", T.LongType())])


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path`` that a reader of the table lists, with its size. Only the listing
    is read, no content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return empty_if_missing(
        spark, MANIFEST, lambda: reader.load(path).select(
            F.col("path").alias("file_path"), F.col("length").alias("bytes")))


def _rows_per_file(spark: SparkSession, path: str, schema: T.StructType, name: str,
                   decode: bool) -> DataFrame:
    """Without ``decode`` no column is read, so the rows are those the files' footers tell."""
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
    counted = T.StructType(
        [T.StructField("file_path", T.StringType()), T.StructField(name, T.LongType())])
    number = F.count("*")
    if decode:
        # A count alone needs no column, and Spark would read none.
        number = number + F.bit_xor("decoded") * F.lit(0)

    def load() -> DataFrame:
        rows = reader.parquet(path).select(
            F.col("_metadata.file_path").alias("file_path"),
            F.xxhash64(*schema.names).alias("decoded"))
        return rows.groupBy("file_path").agg(number.alias(name))

    return empty_if_missing(spark, counted, load)


def skipped_files(spark: SparkSession, path: str, schema: T.StructType = AGGREGATE) -> DataFrame:
    """What ``read_aggregates(skip_corrupt=True)`` leaves out: (file_path, bytes, rows_promised,
    rows_read) of each file that gives fewer rows than its footer tells, or has no footer.

    A file that breaks off in the middle gives the rows before that, so the rows are counted with
    all columns decoded; this reads the table once. A whole file without any row is named too:
    partitioned writes make none.
    """
    promised = _rows_per_file(spark, path, schema, "rows_promised", decode=False)
    read = _rows_per_file(spark, path, schema, "rows_read", decode=True)
    found = file_manifest(spark, path).join(promised, "file_path", "left").join(
        read, "file_path", "left").fillna(0, ["rows_promised", "rows_read"])
    return found.filter((F.col("rows_promised") == 0)
                        | (F.col("rows_read") < F.col("rows_promised")))
