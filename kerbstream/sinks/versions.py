"""Tables and reports that are replaced whole, while others read them.

Each version is a folder of its own, ``version=<number>``. Spark's writers put ``_SUCCESS`` into a
folder when all its files are in place, and that file is what makes a version count: readers take
the highest version that has it, so they see the one before until the new one is whole. No
file is ever moved or changed, which holds on object stores too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from kerbstream.session import remove

PREFIX = "version="
KEPT = 2  # the newest version, and the one that readers may have begun with
Format = Callable[[DataFrameWriter], None]


def _folders(spark: SparkSession, root: str) -> list[tuple[int, str, bool]]:
    """(version, path, whether it is committed), in order."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = []
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(PREFIX) and name[len(PREFIX):].isdigit():
            done = system.exists(hadoop.Path(status.getPath(), "_SUCCESS"))
            found.append((int(name[len(PREFIX):]), status.getPath().toString(), done))
    return sorted(found)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{PREFIX}{version}"


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and path of the newest whole version; None if there is none."""
    done = [(number, path) for number, path, whole in _folders(spark, root) if whole]
    return done[-1] if done else None


def begun_version(spark: SparkSession, root: str, version: int) -> int | None:
    """The newest whole version, for a micro-batch that writes ``version``: the one before, or its
    own if it is run again. A later one was left by another checkpoint, whose numbers mean other
    micro-batches; that is an error, as nothing would be right that is merged into it."""
    newest = current_version(spark, root)
    if newest and newest[0] > version:
        raise ValueError(f"{root} has version {newest[0]} of another checkpoint; this one is at {version}")
    return newest[0] if newest else None


def has_versions(spark: SparkSession, root: str) -> bool:
    return bool(_folders(spark, root))


def write_version(df: DataFrame, root: str, version: int, write: str = "parquet",
                  **options) -> str:
    """Write one version, also over what a run that did not finish left of it."""
    path = version_path(root, version)
    df.write.mode("overwrite").format(write).options(**options).save(path)
    return path


def publish(df: DataFrame, root: str, write: str = "parquet", keep: int = KEPT,
            **options) -> str:
    """Write the next version and then remove all but the newest ``keep``. ``df`` may read the
    version before. For one writer at a time."""
    spark = df.sparkSession
    newest = current_version(spark, root)
    path = write_version(df, root, newest[0] + 1 if newest else 0, write, **options)
    prune(spark, root, keep)
    return path


def prune(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Remove old versions; ``keep`` whole ones stay, and whatever is newer than these."""
    whole = [number for number, _, done in _folders(spark, root) if done]
    for number, path, _ in _folders(spark, root):
        if len(whole) > keep and number < whole[-keep]:
            remove(spark, path)
