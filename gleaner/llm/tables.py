"""Shared helpers: written intermediate tables, folds, byte-level text helpers, components."""

from __future__ import annotations

import contextlib
import math
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import checkpoint_dir


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder for written tables, under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that outlive executors.  The table stays until
    ``drop_scratch`` or the end of the cluster's checkpoint folder."""
    return materialise_at(df, tag)[0]


def materialise_at(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """As ``materialise``, with the table's path for ``discard``."""
    path = f"{scratch_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialise_bucketed(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """Write ``df`` as a table bucketed by ``keys`` in the shared folder and read it back: joins on just these keys move the
    other side only.  A ``df`` that an aggregate or join on ``keys`` has dealt out already isn't moved once more."""
    return bucketed_at(df, keys, tag)[0]


def bucketed_at(df: DataFrame, keys: list[str], tag: str) -> tuple[DataFrame, str]:
    """As ``materialise_bucketed``, with the table's path for ``discard``."""
    spark = df.sparkSession
    name = f"llm_{tag}_{uuid.uuid4().hex[:12]}"
    path = f"{scratch_dir(spark)}/{name}"
    (df.write.format("parquet").option("compression", "zstd").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
     .option("path", path).saveAsTable(name))
    return spark.table(name), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that no later step reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """While active, the shuffle files of a query go as soon as it has been written; results do not depend on it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


ARROW_ROWS = 1_000  # rows of texts sent to a Python worker together; Spark's own default is 10,000
ARROW_BYTES = 64 << 20  # about so many bytes of texts are sent together at most
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``ARROW_ROWS`` rows and ``ARROW_BYTES`` bytes, so that a worker's memory follows
    a thousand texts and no more than some tens of megabytes of them.  Every operator calls it, as the plans it returns run
    later; results do not depend on it."""
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= ARROW_ROWS:
        spark.conf.set(_BATCH_ROWS, str(ARROW_ROWS))
    if _bytes(spark.conf.get(_BATCH_BYTES, None)) > ARROW_BYTES:
        spark.conf.set(_BATCH_BYTES, str(ARROW_BYTES))


def _bytes(setting: str | None) -> float:
    """A size setting in bytes; unlimited when it is unset or not positive."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", (setting or "-1").lower()).groups()
    return int(number) * 1024 ** "bkmgtp".index((unit or "b")[0]) if int(number) > 0 else math.inf


def with_text(docs: DataFrame, keep: list[str], text_col: str) -> tuple[list[Column], list[str]]:
    """What a Python stage gets of ``docs``: a struct ``row`` of the columns ``keep``, and ``text`` beside it unless it lies in one of
    them (a dotted name), so that no text is sent twice; and where ``read_text`` finds the text."""
    row = F.struct(*[F.col(c) for c in keep]).alias("row")
    path = text_col.split(".")
    if len(path) > 1 and path[0] in keep:
        return [row], ["row", *path]
    return [row, F.col(text_col).cast("string").alias("text")], ["text"]


def read_text(batch: pa.RecordBatch, path: list[str]) -> pa.Array:
    column = batch.column(path[0])
    for name in path[1:]:
        column = column.field(name)
    return column


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 256):
    """While active, Python stages that run get batches of few rows; for rows that hold whole sets.  Results do
    not depend on it."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


BROADCAST_ROWS = 1_000_000  # rows of ids (some 24 MB) that may be broadcast


def few(ids: DataFrame) -> DataFrame:
    """``ids`` (a written table of some longs a row), marked for broadcast if it has at most ``BROADCAST_ROWS`` rows;
    a larger one is joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table this application has written with ``materialise``; call it once the
    results built on them have been written."""
    discard(spark, scratch_dir(spark))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True when the id's fold is the held-out one; a null id is never held out."""
    return F.coalesce(fold(id_col, modulus) == remainder, F.lit(False))


def total_bytes(df: DataFrame, col: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0


FOREST_NODES = 500_000  # nodes a task holds while it contracts edges


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars: each node with the smallest node the task knows it to be connected with.
    At most about ``FOREST_NODES`` nodes are held; then the stars so far are emitted and the next begin."""
    up: dict[int, int] = {}

    def root(i: int) -> int:
        while (j := up.setdefault(i, i)) != i:
            up[i] = up[j]
            i = j
        return i

    def stars() -> pa.RecordBatch:
        edges = [(i, r) for i in list(up) if (r := root(i)) != i]
        up.clear()
        return pa.record_batch({"u": pa.array([i for i, _ in edges], pa.int64()), "v": pa.array([r for _, r in edges], pa.int64())})

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            u, v = root(u), root(v)
            if u != v:
                up[max(u, v)] = min(u, v)
        if len(up) > FOREST_NODES:
            yield stars()
    if up:
        yield stars()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected edge table (longs): (node, component), the
    component being its smallest node.  Nodes without an edge do not appear.

    Every round contracts the edges of each task among themselves, where they are read, and is done when these stars
    agree (a node has one centre, which has none).  Else it takes a large-star and a small-star step (each a
    min-aggregate and a join on the node), which converge in a logarithmic number of rounds.  Every round
    is a written table, and the driver sees only whether one disagrees."""
    e = materialise(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
                    .mapInArrow(_contract, "u long, v long"), "edges")
    while True:
        # of each node: its smallest and largest centre, and whether it is one itself
        ends = (e.select(F.col("u").alias("node"), "v", F.lit(0).alias("centre")).union(e.select("v", F.lit(None).cast("long"), F.lit(1)))
                .groupBy("node").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.max("centre").alias("centre")))
        ends = materialise(ends, "ends")
        if ends.where("lo <> hi or (lo is not null and centre = 1)").isEmpty():
            return ends.select("node", F.coalesce("lo", "node").alias("component"))
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = materialise(materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).where("u <> v"), "edges")
            .mapInArrow(_contract, "u long, v long"), "edges")
