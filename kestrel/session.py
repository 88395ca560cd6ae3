"""Session construction and cluster-safe lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast only when the measured side is small), splits
# skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "kestrel", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``.  Where it is unset a
    local session gets a scratch folder of its own; on a cluster that is an error, as
    a folder of one machine is not seen by the others."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    local = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written as Parquet to the shared checkpoint folder and read again; the
    table goes when the scope ends, so what is derived from it must be materialised inside."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


class Latest:
    """Stores one table after another (``stored``) and drops each as soon as the next is there, so
    that a loop keeps the files of one round."""

    def __init__(self) -> None:
        self._scope = ExitStack()

    def put(self, df: DataFrame) -> DataFrame:
        fresh = ExitStack()
        table = fresh.enter_context(stored(df))
        self._scope.close()
        self._scope = fresh
        return table

    def __enter__(self) -> Latest:
        return self

    def __exit__(self, *_) -> None:
        self._scope.close()


#: shuffle files go when the job that wrote them ends, instead of when the driver collects garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Loops over shuffles of the size of the data: the files of a round do not outlive its job."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Spark's file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``kestrel`` importable in Python workers (grouped pandas functions
    reference its modules): zip the package once per driver process and add it
    with ``addPyFile``, which distributes it to every executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions ship code differently
        return
    key = id(sc._jsc) if sc._jsc is not None else id(sc)
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="kestrel-pkg-", dir="/tmp"), "kestrel.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
