"""Session helper and the shared-folder materialisation used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tarnlake", cpus: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster supplies its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session has none (local tests) a temporary folder is set;
    in local mode driver and executors are one process, so it is shared too.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tarnlake.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("tarnlake.shared.dir", found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read, never a recomputation of
    the plan above. Each call has a folder of its own, so nothing is reused
    by accident; the folder's owner clears it as it clears checkpoints.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tarnlake/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_to = path
    return written


def release(*written: DataFrame) -> None:
    """Remove what ``materialize`` wrote for these frames.

    Only for frames whose readers have all been written themselves: a lost
    executor must find everything that its tasks read.
    """
    for df in written:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(conf).delete(path, True)


_SHIPPED: set[str] = set()


#: Rows in an Arrow batch; Spark's default of 10,000 makes batches of long texts
#: that fill an executor's memory outside its heap.
ARROW_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, and
    bound Arrow batches unless the session sets a bound of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{here.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
