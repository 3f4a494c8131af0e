"""Session, table access and lineage helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, partitions: int = 200, app: str = "lodestar") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ``partitions`` is an upper bound: AQE joins small ones.  AQE stays on so shuffle partition counts and skewed join partitions are
    re-planned at run time; the UI is off (no server is opened).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied Parquet tables; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, so that they need not see the folder it was started from.

    The zip is made once a session in the driver's temporary folder and served to the executors by Spark.
    """
    sc = spark.sparkContext
    if _shipped.get("app") == sc.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="lodestar-package-"), "lodestar_package.zip")
    with zipfile.ZipFile(made, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(made)
    _shipped["app"] = sc.applicationId


_shipped: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage, named by ``spark.checkpoint.dir``.

    Only a local master (tests) may leave it unset; it then gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="lodestar-checkpoint-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written below ``path``, through Spark's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path, on any file system that Spark reads, is a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def domain(df: DataFrame, column: str, most: int = 1000) -> list:
    """The sorted distinct values of a column that is written into a plan; more than ``most`` are an error."""
    found = [r[0] for r in df.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; give the list, or join instead")
    return found
