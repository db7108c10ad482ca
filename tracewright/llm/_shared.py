"""What the operators of this subpackage share: tables, scratch storage, pickling."""

from __future__ import annotations

import atexit
import ctypes
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def by_value(module: str) -> None:
    """Ship the functions of ``module`` with each task, so that executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_runs(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows whose texts in ``column`` add up to about ``most`` bytes, a longer text on its own at the end of one."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        size += n or 0
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield start, batch.num_rows


def sliced(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about ``most`` bytes of text, so that no batch is turned into Python objects as a whole."""
    for batch in batches:
        for s, e in byte_runs(batch, column, most):
            yield batch.slice(s, e - s)


def give_back() -> None:
    """Return what Arrow and the C library hold in reserve; an idle worker would keep it from the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a function for mapInArrow that gives memory back when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def scratch_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is set, one of our own, if all tasks run on this machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tracewright-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back: lineage ends there.

    A lost executor costs only the tasks it ran; what is stored is never recomputed.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _delete(entry: tuple[SparkSession, str]) -> None:
    context = entry[0].sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(entry[1])
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    _written.remove(entry)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the scratch tables written so far, but for the last ``keep``. Frames that read them are void then."""
    for entry in _written[: len(_written) - keep]:
        _delete(entry)


def mark() -> int:
    """A place among the scratch tables, for ``discard``."""
    return len(_written)


def discard(start: int, keep: int) -> None:
    """Delete the scratch tables written since ``start``, but for the last ``keep``."""
    for entry in _written[start : max(start, len(_written) - keep)]:
        _delete(entry)


@atexit.register
def _at_exit() -> None:
    for spark in {id(s): s for s, _ in _written}.values():
        try:
            release(spark)
        except Exception:  # the session is already gone; the folder's owner clears it
            return


by_value(__name__)
