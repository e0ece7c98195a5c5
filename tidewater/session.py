"""Session defaults and the shared scratch location.

Every job in this package runs on whatever SparkSession the caller hands
in. Two things are read from that session rather than assumed:

* ``spark.checkpoint.dir`` names the shared folder (HDFS/S3/...) where
  staged tables, lineage cuts and intermediate writes go. We only pick a
  folder of our own when the setting is missing *and* the master is local
  (tests, the single-node bench); on a cluster a missing setting is an
  error, because a machine-local temp folder is invisible to executors and
  dies with them.
* the session time zone; date semantics throughout assume UTC.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, scratch: str | None = None) -> SparkSession:
    """Session with the settings the package is tuned for. ``scratch`` is the
    shared folder for staged data (``spark.checkpoint.dir``); a master that is
    not local needs one.

    AQE stays on so the runtime re-plans joins (broadcast only when the
    measured side is under ``autoBroadcastJoinThreshold``), coalesces small
    shuffle partitions and splits skewed ones.
    """
    spec = master[master.find("[") + 1:master.find("]")] if "[" in master else "*"
    cores = (os.cpu_count() or 8) if spec == "*" else int(spec.split(",")[0])
    n = shuffle_partitions or max(8, 2 * cores)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(n))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g")))
    if scratch:
        b = b.config(_CKPT_KEY, scratch)
    elif not master.startswith("local") and _CKPT_KEY not in (extra or {}):
        raise ValueError(f"{master} needs a shared scratch folder")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialize(df, name: str, how: str = "checkpoint"):
    """Cut lineage in the shared checkpoint folder: Spark's reliable
    ``checkpoint()`` (default), or a Parquet table written to a fresh folder
    and read back (``how="parquet"``).

    Either way a lost executor costs a re-read, not a recompute of the
    lineage. The checkpoint writes rows as they are (fast for rows carrying
    token arrays); Parquet is compressed and columnar, so readers that need
    a few columns skip the rest. ``how="zstd"`` is the same with that codec, for
    text that takes too much room otherwise.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        checkpoint_root(spark)
        return df.checkpoint(eager=True)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression="zstd" if how == "zstd" else None)
    return spark.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs. It does so once the
    driver has collected what refers to them, which a large heap puts off until
    the disk of a long job holds the shuffles of all its steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged data; set one only on a local master."""
    sc = spark.sparkContext
    root = sc.getConf().get(_CKPT_KEY, None) or spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set; point it at a shared folder the executors can reach")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-", dir="/tmp")
        spark.conf.set(_CKPT_KEY, root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders handed out so far in this process, once no
    frame that reads them is needed any more. Returns their number."""
    n = len(_SCRATCH)
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
    return n


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem for ``path`` (works for file:, hdfs:, s3a: ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def rename_path(spark: SparkSession, src: str, dst: str, fs=None) -> None:
    """Rename a folder or file; the parent of ``dst`` is made. With the file
    system given (:func:`hadoop_fs`), the parent must be there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    d = path(dst)
    if fs is None:
        fs, s = hadoop_fs(spark, src)
        fs.mkdirs(d.getParent())
    else:
        s = path(src)
    if not fs.rename(s, d):
        raise RuntimeError(f"rename failed: {src} -> {dst}")


def make_dirs(spark: SparkSession, path: str, fs=None) -> None:
    fs = fs or hadoop_fs(spark, path)[0]
    fs.mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written beside and renamed."""
    fs, p = hadoop_fs(spark, path + ".part")
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename_path(spark, path + ".part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def list_partition_dirs(spark: SparkSession, root: str, keys: list[str]) -> list[str]:
    """Relative ``k1=v1/k2=v2/...`` folders under ``root`` (one glob, no data read)."""
    fs, p = hadoop_fs(spark, root)
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/" + "/".join(f"{k}=*" for k in keys))
    stats = fs.globStatus(pattern) or []
    base = str(fs.makeQualified(p).toString()).rstrip("/")
    out = []
    for st in stats:
        if st.isDirectory():
            full = str(st.getPath().toString())
            out.append(full[len(base) + 1:] if full.startswith(base) else
                       "/".join(full.rstrip("/").split("/")[-len(keys):]))
    return out
