"""Session helpers: building a session with sane defaults and finding the
shared work folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Wide standardisation projections generate long methods; above the
    # JIT's 8000-bytecode limit HotSpot would interpret them, so let Spark
    # fall back to per-expression code for such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A write parted by few values (good and rejected rows, months) keeps one
    # open file per value instead of sorting each task's rows by it.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def get_spark(master: str | None = None, app: str = "sparkprep", **conf) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; ``conf`` overrides the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf missing on some builds
        v = None
    if v:
        return v
    return spark.sparkContext.getConf().get(key, None)


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by the driver and every executor.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset and Spark runs in one process (a ``local`` master) a fresh temporary
    folder is made; on a cluster an unset folder is an error, as files in
    a machine's own folder are not seen by the other machines."""
    root = _conf(spark, "spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="sparkprep-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique=True`` appends a fresh id so
    two runs never write into each other's output."""
    segs = [shared_dir(spark), "sparkprep", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(s.strip("/") if i else s for i, s in enumerate(segs))


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted: one directory listing, through
    the file system that the path belongs to. A missing folder is empty."""
    fs, place = _place(spark, path)
    if not fs.exists(place):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(place))


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def rename_folder(spark: SparkSession, old: str, new: str) -> None:
    """One rename of a folder to a new path; its parent is made if need be."""
    fs, source = _place(spark, old)
    target = _place(spark, new)[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"could not rename {old} to {new}")


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def modified(spark: SparkSession, path: str) -> float | None:
    """When the file or folder was last changed (seconds since 1970); None if it isn't there."""
    fs, place = _place(spark, path)
    return fs.getFileStatus(place).getModificationTime() / 1000 if fs.exists(place) else None


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small text file in place, whole or not at all: it is written
    beside its place and then renamed over what is there."""
    aside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    fs, place = _place(spark, aside)
    out = fs.create(place, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm, target = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(place, target, how)


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if it isn't there."""
    fs, place = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def materialize(df):
    """Write ``df`` once as a parquet table in the shared folder and return
    it read back: later plans start from the files, so they neither
    recompute ``df`` nor depend on its lineage (the files survive the loss
    of any executor). One job, unlike an uncached ``checkpoint()``."""
    path = work_path(df.sparkSession, "side", unique=True)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
