"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings a user of the toolkit is advised to run with. They are ordinary Spark
# options: adaptive execution re-plans joins on the sizes it measures, so no
# operator needs to force a broadcast, and skewed join partitions are split.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column expression slows down plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int = 8, app: str = "linenet", **options: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**ADVISED, **options}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is ever reused or cleared."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def local_rows(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    """A small table made on the driver.

    It goes in as an Arrow table, so that Spark knows its size and joins it as what it is.
    """
    fields = {name: pa.array(values, types[name]) for name, values in columns.items()}
    return spark.createDataFrame(pa.table(fields))


def work_units(spark: SparkSession) -> int:
    """How many buckets to cut an ordered or hashed job into."""
    return max(8, min(1024, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def ship(spark: SparkSession, *packages: str) -> None:
    """Send the package to the Python workers, once per application.

    Needed where the package is not installed on the executors; the few Python kernels
    import it by name.
    """
    sc = spark.sparkContext
    if getattr(sc, "_linenet_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="linenet-zip-")) / "linenet_pkg.zip"
    with zipfile.ZipFile(target, "w") as z:
        for package in ("linenet", *packages):
            for file in sorted((root / package).rglob("*.py")):
                z.write(file, file.relative_to(root))
    sc.addPyFile(str(target))
    sc._linenet_shipped = True
