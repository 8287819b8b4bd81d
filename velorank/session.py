"""Session helpers: a local session for tests/bench, UTC pinning and the
shared checkpoint / scratch folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared, reliable file system).  A machine-local temporary folder is only
chosen when the session runs in local mode and nothing was configured.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CKPT: dict[str, str] = {}
_SCRATCH: list[list[str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "velorank") -> SparkSession:
    """A local session configured the way the operators expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # files of checkpoint() go once their DataFrame is garbage-collected; scratch tables: scratch_tables()
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Reference timestamps are UTC wall-clock strings ('...Z'); parsing and
    formatting them must not depend on the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Reads ``SparkContext.getCheckpointDir()`` / ``spark.checkpoint.dir``; only
    a local-mode session without either gets a private temp folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — a remote session has no context handle
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    master = sc.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: velorank needs a shared, reliable "
            "folder for checkpoints and intermediate tables on a cluster")
    key = sc.applicationId
    if key not in _LOCAL_CKPT:
        _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="velorank-ckpt-")
    sc.setCheckpointDir(_LOCAL_CKPT[key])
    return sc.getCheckpointDir() or _LOCAL_CKPT[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/velorank-tables/{name}-{uuid.uuid4().hex[:12]}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its (Hadoop) file system?  A failing file system raises: an error must
    never read as "nothing there"."""
    fs, hpath = _file_system(spark, path)
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table this engine wrote under its own scratch folder."""
    if "/velorank-tables/" not in path:
        raise ValueError(f"not a scratch table: {path}")
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath  # noqa: SLF001


@contextlib.contextmanager
def scratch_tables(spark: SparkSession):
    """Scratch tables written inside are removed at the end, whether the work succeeds or fails; what
    leaves must be collected or written by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove_path(spark, path)


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage with a table written to the shared checkpoint folder.

    Reliable like ``checkpoint()`` (survives executor loss; never a local
    checkpoint), but columnar: later passes read only the columns they use
    and the copy is compressed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
