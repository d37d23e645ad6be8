"""What the operators share: session settings, free column names, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.session import configure, scratch_folder

# Texts differ in length by a factor of ten thousand, so a batch that goes to Python is
# bounded by bytes as well as by rows.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()

COLLECTS_AFTER = gc.get_threshold()  # an operator may raise it for its own tasks

T = TypeVar("T")
_held: dict[str, object] = {}  # of a Python worker: what the operator that ran last remembers


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, unless they are started with its path."""
    context = spark.sparkContext
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(PACKAGE.parent) in on_path or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="predial-code-")) / "predial.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))  # the driver serves it to the executors
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    ship_code(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keep(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, survives executors."""
    path = f"{scratch_folder(df.sparkSession, label)}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*kept: DataFrame) -> None:
    """Remove tables that `keep` wrote and that nothing will read any more."""
    for df in kept:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.sparkSession._jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Larger Arrow batches, for narrow rows, in queries that run inside the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def smallest_hashes(df: DataFrame, key: str, rows: int, ties: Iterable[str] = ()) -> DataFrame:
    """At most `rows` rows, those whose key has the smallest hash: the same in any order.

    Rows of equal keys go by `ties`. With keys that differ, only about four times as many
    rows as wanted reach the final ordering, however large `df` is; the others are filtered
    by their hash where they are read. Where many rows share keys (or have none) and too
    few pass, the filter is widened until enough do.
    """
    total, share = df.count(), 4 * rows
    while 0 < share < total:
        near = df.filter(F.xxhash64(key) < F.lit(2**64 * share // total - 2**63))
        if near.count() >= rows:
            df = near
            break
        share *= 8
    return df.orderBy(F.xxhash64(key), key, *ties).limit(rows)


def full_text(text: str) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def crc_of_id(doc_id: str) -> Column:
    """crc32 of the id written as text; null where the id is null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


class Recent:
    """A bounded memory: the latest entries and those of the generation before."""

    def __init__(self, entries: int, longest: int):
        self.entries, self.longest = entries, longest
        self.young: dict = {}
        self.old: dict = {}

    def fill(self, keys: Iterable) -> tuple[dict, set]:
        """What is known of `keys`, and what is not."""
        young, old, known, unknown = self.young, self.old, {}, set()
        for key in keys:
            value = young.get(key) or old.get(key)
            if value is None:
                unknown.add(key)
            else:
                known[key] = value
        return known, unknown

    def add(self, found: dict) -> None:
        self.young.update((k, v) for k, v in found.items() if len(k) <= self.longest)
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young


def give_back() -> None:
    """Free what this worker remembers, and hand unused memory back to the system."""
    _held.clear()
    gc.set_threshold(*COLLECTS_AFTER)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library, which has no such call


def forget_others(owner: str) -> None:
    """Before a task of `owner`: what other operators left in this worker goes.

    Spark uses Python workers again for later jobs; without this each of them ends up with
    the memories of all operators of a session.
    """
    if _held and owner not in _held:
        give_back()


def remembered(owner: str, make: Callable[[], T]) -> T:
    """What a worker remembers from task to task for `owner`, until another one runs in it."""
    if owner not in _held:
        forget_others(owner)
        _held[owner] = make()
    return _held[owner]
