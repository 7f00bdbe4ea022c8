"""Session helpers: building a session for tests/bench and cutting lineage safely.

On a cluster the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant path).  We only set our own
folder when the session has none, which is the case in tests and local bench
runs.
"""

from __future__ import annotations

import contextlib
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
OPEN_BUCKETS = 4  # of a table being written, in one task; rows of further buckets are sorted


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "gleaner") -> SparkSession:
    """Session used by tests and ``bench.py``; clusters bring their own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset.

    ``spark.checkpoint.dir`` is a static setting read when the context starts; we
    only read it.  When a session has none (tests, local bench) a scratch folder is
    registered with ``setCheckpointDir``; off local mode an unset folder is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never ``localCheckpoint``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a small input over the cluster's cores: one that is read from fewer files than
    there are cores.  Used before CPU-heavy per-row stages (HTML parsing, whole-text regex).  Only the
    scans' file lists are looked at, nothing of the plan runs; an input of many files, or of no file, is
    left as it is."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if 0 < len(df.inputFiles()) < target else df


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: what it holds, partition
    numbers included, is then fixed however often and with whichever columns it is read."""
    import uuid

    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, key: str, buckets: int | None = None, tag: str = "table",
                   partitioned: bool = False) -> DataFrame:
    """Materialise ``df`` as a table bucketed by ``key`` in the shared checkpoint folder and
    return it read back.  Reads of a bucketed table carry their hash partitioning, so later
    aggregates and joins on (key, ...) run without a shuffle (with
    ``spark.sql.requireAllClusterKeysForCoPartition=false``, see ``co_partition_by_prefix``).
    ``partitioned=True`` says ``df`` is already hash-partitioned on ``key`` into ``buckets``
    partitions, so each task writes exactly one bucket file."""
    import uuid

    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"gleaner_{tag}_{uuid.uuid4().hex[:12]}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    src = df if partitioned else df.repartition(n, key)
    # a task keeps the files of its few buckets open side by side, where it would else sort all its rows by bucket first
    with with_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_BUCKETS)}):
        src.write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(name)
    return spark.table(name)


@contextlib.contextmanager
def with_conf(spark: SparkSession, wanted: dict):
    """Session settings that hold inside the block and are given back on exit."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextlib.contextmanager
def co_partition_by_prefix(spark: SparkSession):
    """While active, joins on (page_id, x) reuse a page_id hash partitioning instead of
    reshuffling both sides on (page_id, x).  A physical-planning requirement only (results do
    not change); restored on exit so unrelated later joins keep Spark's default, which
    protects them from reusing a low-cardinality partial partitioning."""
    # rows of a page arrive sorted from joins and windows: a sort aggregate takes them as they come
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.execution.useObjectHashAggregateExec": "false"}
    with with_conf(spark, wanted):
        yield


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``gleaner`` importable on the executors' Python workers (the HTML parse and the
    Arrow running sums run there): zip the package once per SparkContext and register it
    with ``addPyFile``, the same mechanism as ``--py-files``."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="gleaner-pyfiles-"), "gleaner.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
