"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: The characters of the class [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the cluster's shared folder.

    The folder is the session's ``spark.checkpoint.dir``.  Only a local session may leave that unset: it gets
    a temporary folder, recorded in the session.  A cluster without a shared folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.symcube.shared.dir", None)
    if not base:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="symcube-")
        spark.conf.set("spark.symcube.shared.dir", base)
    return f"{base.rstrip('/')}/symcube-{uuid.uuid4().hex}"


#: What a batch of rows on its way to a Python worker may hold: these bound the Arrow buffers of an executor.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's 10,000 rows, of whatever length, unless the application chose its own."""
    chosen = spark.sparkContext.getConf()
    for key, value in BATCH_SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is a cluster)."""
    return master == "local" or master.startswith("local[")


#: Rows of a file of a small table.
ROWS_A_FILE = 200_000


class Workspace:
    """The intermediate tables of one run of an operator, in one folder of the shared file system.

    Writing a table cuts the lineage: losing an executor afterwards costs nothing but the tasks it ran.
    ``clear`` deletes the tables that nothing reads any more, and takes broadcast values from the executors.
    """

    def __init__(self, spark: SparkSession):
        bound_batches(spark)
        self.spark, self.root = spark, shared_dir(spark)
        self.paths: dict[str, str] = {}
        self.sent: list = []
        self.count = 0

    def send(self, value):
        """Broadcast a value of bounded size that only tables written before ``clear`` need."""
        self.sent.append(self.spark.sparkContext.broadcast(value))
        return self.sent[-1]

    def put(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write ``df`` once and return a reader of it.

        ``rows``, an upper bound that is known beforehand, keeps a small table from many tiny files: its last stage runs in
        a task for each ``ROWS_A_FILE`` of them.
        """
        if rows is not None:
            df = df.coalesce(rows // ROWS_A_FILE + 1)
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path)
        self.paths[f"{self.count:03d}-{name}"] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, *keep: str) -> None:
        """Delete all tables but those of the given names, and all broadcast values."""
        while self.sent:
            self.sent.pop().destroy()
        for key in [k for k in self.paths if k[4:] not in keep]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(key))
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to a folder of its own and return a reader of it."""
    return Workspace(df.sparkSession).put(df, name)


def id_type(docs: DataFrame, column: str) -> tuple[str, pa.DataType]:
    """SQL and Arrow type of an identifier column.  Integers, decimals, strings and dates are accepted, others refused."""
    kind = docs.schema[column].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.DateType)):
        raise TypeError(f"identifier {column!r} is of type {kind.simpleString()}; use an integer, decimal, string or date")
    return kind.simpleString(), to_arrow_type(kind)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame, without running a job; 0 where it knows none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def partitions_for(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Partition count for an exchange of ``df``: the session's, or more if the input needs more."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-plan_bytes(df) // target_bytes))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id", modulus: int = 4, remainder: int = 2) -> Column:
    """Whether crc32 of the id, as decimal text, falls into the held-out fold (null id: not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: What Python workers keep between tasks, as functions that drop it.
CACHES: list[Callable[[], None]] = []


def release_memory() -> None:
    """Drop what other operators left in this Python worker and give free memory back to the system."""
    for forget in CACHES:
        forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def sliced(batches: Iterator[pa.RecordBatch], text: int, limit: int = 2_000_000, keep_caches: bool = False) -> Iterator[pa.RecordBatch]:
    """Record batches with at most ``limit`` bytes in the text column of that number, or a single row.

    Workers are shared by all operators of a job, so unless told to keep them, this first drops what
    another operator left in memory.
    """
    if not keep_caches:
        release_memory()
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
