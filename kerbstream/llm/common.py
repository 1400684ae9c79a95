"""What several of these operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast models must stay below this many bytes; they are files or rules of fixed size.
MODEL_BYTES = 64 << 20

# Texts are handed to Python functions in parts of about this many bytes, and go to Python
# workers in Arrow batches of that size: a batch exists several times on its way.
SLICE_BYTES = BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_SHIPPED: dict[str, tuple[str, ...]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_bytes(path: str) -> bytes:
    """A vocabulary file, to be broadcast: executors need no copy of their own."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes; at most {MODEL_BYTES} are broadcast")
    return data


def whole_row(docs: DataFrame, names: list[str] | None = None) -> Column:
    """All columns, or ``names``, as one struct, whatever their names are."""
    chosen = docs.columns if names is None else names
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in chosen])


def map_texts(df: DataFrame, keep: list[str], text: str, schema: str,
              function: Callable[[list[str]], list], load: Callable[[], object] | None = None,
              binary: bool = False) -> DataFrame:
    """Columns ``keep`` beside what ``function`` makes of each batch of texts.

    ``function`` takes the batch's texts (``None`` for null; bytes if ``binary``), after
    what ``load`` returns if given, and returns one list or Arrow array for each column of
    ``schema``. Texts stay in their task, so nothing is shuffled.
    """
    chosen = df.select(*keep, F.col(text).cast("binary" if binary else "string").alias("_text"))
    result = T.StructType(chosen.schema.fields[:-1] + T.StructType.fromDDL(schema).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [load()] if load else []
        for batch in (part for whole in batches for part in sliced(whole)):
            made = function(*first, batch.column(batch.num_columns - 1).to_pylist())
            arrays = [a if isinstance(a, pa.Array) else pa.array(a) for a in made]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + arrays, names=result.names)

    return chosen.mapInArrow(run, result)


def sliced(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in parts whose last column has about ``limit`` bytes, so that what
    Python makes of them stays small. A row is never cut."""
    if not batch.num_rows:
        yield batch
        return
    last = batch.column(batch.num_columns - 1)
    size = pc.list_value_length(last) if pa.types.is_list(last.type) else pc.binary_length(last)
    ends = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def prepare(spark: SparkSession) -> None:
    """What a session needs for these operators."""
    ship_package(spark)
    if int(spark.conf.get(BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, as ``--py-files`` would, also where the driver
    only has it on its own path. Once per application; Spark hands the archive out."""
    context = spark.sparkContext
    name = __name__.split(".")[0]
    if name in context.getConf().get("spark.submit.pyFiles", "") or name in _SHIPPED.get(
            context.applicationId, ()):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name), "zip",
        os.path.dirname(package), name)
    context.addPyFile(archive)
    _SHIPPED[context.applicationId] = (name,)
