"""Session, shared storage and size-checked planning."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table may be broadcast by hint only if its files hold fewer bytes than this.
BROADCAST_BYTES = 8 << 20


def session(app: str = "folium", master: str = "local[8]", **conf: str) -> SparkSession:
    """A session with the settings that the operators are tested under; a cluster's own settings win where given."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    b = SparkSession.builder.appName(app).master(master)
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only where it is unset (tests, one machine) one is made and set."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="folium-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        given = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", given)
        sc.setCheckpointDir(given)
    return given.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders written while a result is being built (innermost last), so that they can go once it stands; and all that are still there.
_BUILDING: list[list[str]] = []
_WRITTEN: set[str] = set()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several steps read to the shared folder and read it again.

    The plan is cut there, the file survives the loss of executors, and the
    planner knows the size: it broadcasts a small one and shuffles a large one.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.add(path)
    if _BUILDING:
        _BUILDING[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """materialize() what `build` gives, then delete whatever was written to build it: the result reads none of that any more."""
    _BUILDING.append([])
    try:
        out = build()
    finally:
        scratch = _BUILDING.pop()
    out = materialize(out, name)
    delete(spark, scratch)
    return out


def release(*frames: DataFrame) -> None:
    """Delete the folders of frames made by materialize() that nothing reads any more."""
    for df in frames:
        files = df.inputFiles()
        delete(df.sparkSession, {f.rsplit("/", 1)[0] for f in files})


def delete(spark: SparkSession, paths) -> None:
    jvm = spark.sparkContext._jvm
    for path in list(paths):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _WRITTEN.discard(path)


def clean(spark: SparkSession) -> None:
    """Delete all intermediate folders of this session; results that still read them must have been written."""
    delete(spark, _WRITTEN)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a frame made by materialize()."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    total = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen()
    return total


def small_side(stored: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if the stored files are below the limit; otherwise the frame as it is, which Spark joins by a shuffle."""
    return F.broadcast(stored) if stored_bytes(stored) <= limit else stored
