"""Approximate nearest neighbours by an adaptive scan of dimensions.

Vectors are normalised, rotated by one random orthogonal matrix and dealt to the lists of a coarse
index (spherical k-means, fitted on a bounded sample; every vector is indexed).  A query probes its
nearest lists.  Inside a list the rotated vectors lie in column blocks: after each block the partial
squared distance, scaled to all dimensions, is tested against the fifth-best distance so far, and a
candidate whose distance would be larger at the chosen confidence is abandoned (on rotated vectors the
scaled partial distance concentrates around the true one).  What is left is scored exactly, in
double precision, on the original vectors.

Lists are split into blocks of about ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES`` queries by a hash of the
id, so a list that holds a third of all rows is many tasks; each task returns at most k rows a query.

Defined cases: vectors that are null, empty, zero, of another length than the most common one or hold
null or non-finite components take no part; fewer candidates than k give them all; equal scores go to the
smaller id; repeated ids are repeated candidates, but a query never finds its own id; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleaner.llm.tables import bound_batches, materialise

SAMPLE_ROWS = 8_192  # vectors the coarse index is fitted on
LISTS = 64
PROBE_SHARE = 0.65  # share of the lists a query probes
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 1_024
COLUMN_BLOCK = 8
CONFIDENCE = 2.1  # larger: fewer wrong rejections
SEED = 20


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_lists(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = SEED) -> np.ndarray:
    """Unit centres of spherical k-means on the sample's unit vectors."""
    rng = np.random.default_rng(seed)
    x = _unit(sample)
    centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return centres


def scan_block(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, turn: np.ndarray, k: int) -> list[tuple]:
    """(query id, id, cosine) of at most k neighbours of each query in one block; original vectors in."""
    unit, asked = _unit(vectors), _unit(queries)
    blocks, wanted = unit @ turn, asked @ turn
    dim = blocks.shape[1]
    columns = [np.ascontiguousarray(blocks[:, lo:lo + COLUMN_BLOCK]) for lo in range(0, dim, COLUMN_BLOCK)]
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    found = []
    for q in range(len(asked)):
        others = np.flatnonzero(ids != query_ids[q])
        if not len(others):
            continue
        # the first candidates set the threshold, later ones must beat it
        head, left = others[:4 * k], others[4 * k:]
        first = ((blocks[head] - wanted[q]) ** 2).sum(axis=1)
        limit = np.partition(first, k - 1)[k - 1] if len(first) >= k else np.inf
        partial = np.zeros(len(left))
        seen = 0
        for c, column in enumerate(columns):
            if not len(left):
                break
            lo = c * COLUMN_BLOCK
            partial += ((column[left] - wanted[q, lo:lo + column.shape[1]]) ** 2).sum(axis=1)
            seen = lo + column.shape[1]
            if seen < dim:
                stay = partial * (dim / seen) <= limit * (1 + CONFIDENCE / np.sqrt(seen)) ** 2 + 1e-12
                if c == 1 and len(left) > 8 * k:  # tighten the threshold with the most promising ones
                    best = left[np.argpartition(partial, 2 * k)[:2 * k]]
                    full = np.concatenate([first, ((blocks[best] - wanted[q]) ** 2).sum(axis=1)])
                    limit = min(limit, np.partition(full, k - 1)[k - 1] if len(full) >= k else np.inf)
                    stay &= partial * (dim / seen) <= limit * (1 + CONFIDENCE / np.sqrt(seen)) ** 2 + 1e-12
                left, partial = left[stay], partial[stay]
        kept = np.concatenate([head, left])
        qv = queries[q]
        cosine = (vectors[kept] * qv).sum(axis=1) / (norms[kept] * np.sqrt((qv * qv).sum()))
        order = np.lexsort((ids[kept], -cosine))[:k]
        found += [(int(query_ids[q]), int(ids[kept[i]]), float(cosine[i])) for i in order]
    return found


def _assign(batches, centres: np.ndarray, probes: int):
    """Adds to each row the list it belongs to, and to a query all lists it probes, nearest first."""
    dim = centres.shape[1]
    for b in batches:
        close = _unit(_matrix(b.column("v"), dim)) @ centres.T
        own = close.argmax(axis=1).astype(np.int32)
        probed = np.argsort(-close, axis=1, kind="stable")[:, :probes].astype(np.int32)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(list(probed), pa.list_(pa.int32()))], names=[*b.schema.names, "list", "probed"])


def _scan(key, vectors: pa.Table, queries: pa.Table, turn: np.ndarray, k: int) -> pa.Table:
    dim = turn.shape[0]
    found = []
    if vectors.num_rows and queries.num_rows:
        found = scan_block(_matrix(vectors.column("v"), dim), vectors.column("vec_id").to_numpy(),
                           _matrix(queries.column("v"), dim), queries.column("vec_id").to_numpy(), turn, k)
    return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()),
                     "score": pa.array([f[2] for f in found], pa.float64())})


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))


def search(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           lists: int = LISTS, probe_share: float = PROBE_SHARE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for every row where ``is_query`` (a column over ``vec_id``), its k nearest found."""
    spark = vectors.sparkSession
    bound_batches(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id_col, vec_col)
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return empty
    dim = common[0]
    rows = rows.where(F.size("v") == dim)
    sample = rows.select("v", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(sample_rows).select("v").toArrow()
    centres = fit_lists(_matrix(sample.column("v"), dim), lists)
    probes = max(1, int(np.ceil(probe_share * len(centres))))
    indexed = materialise(rows.withColumn("ask", is_query).mapInArrow(
        lambda it: _assign(it, centres, probes), "vec_id long, v array<double>, ask boolean, list int, probed array<int>"), "vectors")

    # sizes of at most `lists` lists and of their probes decide how finely each is split
    n_rows = {r[0]: r[1] for r in indexed.groupBy("list").count().collect()}
    n_asked = {r[0]: r[1] for r in indexed.where("ask").select(F.explode("probed").alias("list")).groupBy("list").count().collect()}
    if not n_asked:
        return empty
    row_parts = F.element_at(F.lit([1 + n_rows.get(i, 0) // BLOCK_ROWS for i in range(len(centres))]), F.col("list") + 1)
    query_parts = F.element_at(F.lit([1 + n_asked.get(i, 0) // BLOCK_QUERIES for i in range(len(centres))]), F.col("list") + 1)
    left = indexed.select("vec_id", "v", "list", F.pmod(F.xxhash64("vec_id"), row_parts).alias("part"),
                          F.explode(F.sequence(F.lit(0), query_parts - 1)).alias("ask_part"))
    right = (indexed.where("ask").select("vec_id", "v", F.explode("probed").alias("list"))
             .select("vec_id", "v", "list", F.pmod(F.xxhash64("vec_id", F.lit(1)), query_parts).cast("int").alias("ask_part"),
                     F.explode(F.sequence(F.lit(0), row_parts - 1)).alias("part")).withColumn("part", F.col("part").cast("long")))
    left = left.withColumn("part", F.col("part").cast("long"))
    turn = rotation(dim)
    key = ["list", "part", "ask_part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda _, a, b: _scan(_, a, b, turn, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
