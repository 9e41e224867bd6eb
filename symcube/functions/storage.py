"""Small files and scratch folders on whatever file system Spark uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old content or the new."""
    place, fs = _at(spark, path)
    fresh, _ = _at(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(place.toUri(), fs.getConf()).rename(fs.makeQualified(fresh), fs.makeQualified(place), how)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is none."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    place, fs = _at(spark, path)
    fs.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    place, fs = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()] if fs.exists(place) else []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares.

    That is ``spark.checkpoint.dir``.  Only a session whose driver is its only executor may leave it unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.symcube.shared.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="symcube-")
        spark.conf.set("spark.symcube.shared.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str, **how) -> DataFrame:
    """Write once and read back: later work does not repeat the lineage."""
    df.write.parquet(path, **how)
    return df.sparkSession.read.schema(df.schema).parquet(path)
