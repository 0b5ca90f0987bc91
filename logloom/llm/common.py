"""What several operators share: shared-folder checkpoints, Arrow batch sizes, text folding."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows in an Arrow batch: whole texts are handed over, so batches are kept far below Spark's default of 10,000 rows.
BATCH_ROWS = 512


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of this session; long texts would otherwise fill a worker's memory.

    The bound is only ever lowered, to the same number by every operator, so frames that are built earlier and run later
    keep it. It is the one session setting that the operators touch.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows or int(spark.conf.get(name)) < 1:
        spark.conf.set(name, str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a temporary one only where that is unset and Spark is one local process."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "logloom-checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    held = df.checkpoint(eager=True)
    if time.monotonic() > _forgot[0] + SHORT:
        forget(df.sparkSession)
    return held


#: Seconds of steps for which no collection pays: one after each of many short steps is so much of the driver's time that its heap is enlarged.
SHORT = 4.0
_forgot = [-SHORT]


def forget(spark: SparkSession) -> None:
    """Let the driver collect what no frame refers to any more, so Spark removes the shuffles behind it now and not some time later."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _forgot[0] = time.monotonic()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage of a large table by writing it, compressed, to the shared folder and reading it again.

    Nothing needs the shuffles behind it any more; a collection on the driver lets Spark remove their files at once
    instead of some time later.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    _tables.append(path)
    df.write.option("compression", "zstd").parquet(path)
    forget(spark)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run: Callable) -> Callable:
    """``run`` over the batches of a task; what it has freed goes back to the system at its end, since workers stay for the next stage."""

    def inner(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return inner


#: Rows of two or three numbers that are sent to every task instead of shuffling the other side: some 10 MB at most.
FEW = 300_000


def small(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df``, to be broadcast if a count shows at most ``most`` rows; else joins shuffle both sides. Rows are a few numbers each."""
    return F.broadcast(df) if df.count() <= most else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, to be joined by shuffling and sorting both sides, however few its rows are: nothing of it goes through the driver, which keeps no thread for it."""
    return df.hint("merge")


#: Folders of ``written`` tables that nobody has dropped yet, oldest first.
_tables: list[str] = []


def drop_folder(path: str) -> None:
    """Remove a folder of tables whose results are stored elsewhere by now."""
    store, place = fs.FileSystem.from_uri(path)
    if store.get_file_info(place).type == fs.FileType.Directory:
        store.delete_dir(place)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Drop the tables that are written inside, at its end; what is wanted of them has to be stored by then.

    Operators hand out frames that still read their middle tables, so only the caller knows when these can go.
    """
    before = len(_tables)
    yield
    while len(_tables) > before:
        drop_folder(_tables.pop())


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character left alone."""
    return F.translate(column, UPPER, LOWER)
