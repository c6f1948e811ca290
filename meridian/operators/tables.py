"""Stored intermediate tables for operators that go in rounds."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir, which the driver and all executors share.

    Where none is named and all runs in one process, as in tests, it is a temporary folder that goes when Python ends. On
    a cluster a folder has to be named, as each executor would write to its own disk.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        place = f"file://{tempfile.mkdtemp(prefix='meridian-')}"
        atexit.register(shutil.rmtree, place.removeprefix("file://"), True)
        spark.conf.set("spark.checkpoint.dir", place)
    return place


def stored(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the shared folder; lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, for what is read often: columns and sizes are known, as those of a checkpoint aren't.

    The table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/meridian/{uuid.uuid4().hex}"
    df.write.parquet(path)
    place, files, _ = _place(spark, path)
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """The path and its file system, whichever it is, and Hadoop's settings."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(conf), conf


def read_text(spark: SparkSession, path: str) -> str | None:
    """What a short file in the shared folder holds; None if there is none."""
    place, files, _ = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a short file beside its place and renames it over what is there: readers see the old text or the new one, whole."""
    place, files, conf = _place(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = files.create(part, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    gateway, rename = spark.sparkContext._gateway, getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(part, place, how)


def publish(spark: SparkSession, root: str, build: Callable[[str], None]) -> str:
    """Lets build(folder) write a new build beside the one in use, then switches readers to it by the file root/current.

    If build fails, what it wrote is removed and readers stay on the old build. The build that was in use until now
    stays for those who read it just now, and goes with the next switch. One writer at a time: of two, the later switch counts.
    """
    folder = f"build-{uuid.uuid4().hex}"
    place, files, _ = _place(spark, f"{root}/{folder}")
    try:
        build(f"{root}/{folder}")
    except BaseException:
        files.delete(place, True)
        raise
    before = read_text(spark, f"{root}/current")
    replace_text(spark, f"{root}/current", folder)
    for status in files.listStatus(place.getParent()):
        if status.getPath().getName().startswith("build-") and status.getPath().getName() not in (folder, before):
            files.delete(status.getPath(), True)
    return f"{root}/{folder}"


def current_build(spark: SparkSession, root: str) -> str | None:
    """The folder of the build in use; None before the first one."""
    folder = read_text(spark, f"{root}/current")
    return f"{root}/{folder}" if folder else None


def chain_ends(steps: DataFrame) -> DataFrame:
    """steps(node, to) with `to` the end of the chain that each node's steps lead along; an end steps to itself.

    The reach doubles with each round, so a chain of n steps takes about log2(n) of them.
    """
    while True:
        further = steps.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
        reach = stored(steps.join(further, F.col("to") == F.col("_node")).select("node", F.col("_to").alias("to"), (F.col("_to") != F.col("to")).alias("moved")))
        steps = reach.select("node", "to")
        if reach.filter("moved").isEmpty():
            return steps
