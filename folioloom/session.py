"""Session helpers: local sessions for tests and benches, and shared intermediate tables.

A job that reads one intermediate result more than once writes it as Parquet under
the folder that the session names in ``spark.checkpoint.dir``. All executors share
that folder, so a lost executor costs nothing but a retry. Only where the setting is
absent (tests, a laptop) a folder of our own is used.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "folioloom", cpus: int | str = "*", memory: str = "16g") -> SparkSession:
    """A ``local[cpus]`` session with the settings that the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the session's own, else a temporary one on a local master."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share (master {master})")
    folder = tempfile.mkdtemp(prefix="folioloom-")
    spark.sparkContext.setCheckpointDir("file://" + folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new name under the shared folder, removed when the driver's JVM ends or by ``drop_intermediates``."""
    path = f"{shared_folder(spark)}/folioloom-{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    _WRITTEN.append((spark.sparkContext.applicationId, path))
    return path


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there.

    The table is removed when the driver's JVM ends, or by ``drop_intermediates``.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[tuple[str, str]] = []


def drop_intermediates(spark: SparkSession) -> int:
    """Removes the intermediate tables written so far and tells how many.

    For long sessions, between queries: frames that still read such a table can't be used afterwards.
    """
    context = spark.sparkContext
    own = [entry for entry in _WRITTEN if entry[0] == context.applicationId]
    for entry in own:
        target = context._jvm.org.apache.hadoop.fs.Path(entry[1])
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
        _WRITTEN.remove(entry)
    return len(own)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="folioloom-")) / "folioloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
