"""Session helpers.

Library code never creates a session on its own; these helpers are for tests,
the benchmark and command-line jobs.  On a cluster the session comes from the
launcher and only :func:`checkpoint_root` is used, which reads the shared
folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | None = None, app: str = "docsift", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (never used on a cluster)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    # one BLAS thread per Python worker: Spark already runs one worker per core
    for var in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(var, "1")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DOCSIFT_DRIVER_MEMORY", "16g"))
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        # checkpoint files of results nobody references any more are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    (local tests) a fresh folder under the system temp dir is created and
    registered, so cluster jobs always use the folder the cluster names.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="docsift-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local = threading.local()


@contextmanager
def spent_shuffles(spark: SparkSession):
    """Queries started inside remove their shuffle files when they end: of a
    table that is written, nobody reads them again, and else they stay until
    the driver's next garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_CONF) if before is None else spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


@contextmanager
def spent_cuts(spark: SparkSession):
    """The tables that :func:`cut` makes inside are removed at the end; nothing
    that still reads them may leave the block."""
    paths: list[str] = []
    outer, _local.paths = getattr(_local, "paths", None), paths
    try:
        yield
    finally:
        _local.paths = outer
        for path in paths:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` computed once, as a compressed Parquet table below the shared
    folder: for wide rows, of which a checkpoint would keep every byte.
    ``keep``: the table outlives a block of :func:`spent_cuts`."""
    path = scratch_path(df.sparkSession, name)
    if not keep and getattr(_local, "paths", None) is not None:
        _local.paths.append(path)
    with spent_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _package_zip() -> bytes:
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, base))
    return buf.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make ``docsift`` importable in every Python worker.

    UDFs and ``mapInPandas`` functions are pickled by module reference, so
    workers must import the package.  It is zipped once per SparkContext into
    the shared checkpoint folder and added with ``addPyFile``.
    """
    sc = spark.sparkContext
    if getattr(sc, "_docsift_shipped", False):
        return
    dest = f"{checkpoint_root(spark).rstrip('/')}/pyfiles/docsift-{uuid.uuid4().hex[:12]}.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(dest)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(_package_zip()))
    finally:
        out.close()
    sc.addPyFile(dest)
    sc._docsift_shipped = True
