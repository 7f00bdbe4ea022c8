"""Vector code compression: product codes whose nearest entries are found by Orchard search.

Components become the integers floor(1024 x), so every distance, sum and comparison below is exact.  A vector is cut
into ``PARTS`` equal consecutive parts, and each part position has a codebook of up to ``ENTRIES`` entries, which starts
as that part of the vectors of the smallest ids.  Each round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and moves every entry to the componentwise floor of its parts' mean; entries without
parts stay.  A last assignment gives the codes.

Orchard search: every entry has the list of all entries by their distance from it.  From some entry the search walks down
that entry's list; on finding a better entry it jumps to the better one's list; entries it has met are marked and not
measured again; it stops where the list is farther off than twice the current distance, as by the triangle inequality
nothing behind that can be nearer (at just twice it could be as near, so that is still looked at: ties are exact).
The walks of a batch go on side by side, one numpy step moving each walk that is not over by one place.

Scale: the quantised vectors are written once; a round reads them, sends the codebooks to the tasks (a bounded table of
``PARTS`` times ``ENTRIES`` entries) and adds up, per task, one sum for each entry; these are the only rows shuffled, and the
driver holds no more than the codebooks.  A lost executor costs its tasks only.  Labels are summed in the tasks before they
are shuffled, and joined back as one row a label, so that a label that a third of all rows bear is no group in one task.

Defined cases: vectors that are null, or hold null or non-finite components, take no part.  Nor do those that cannot be cut
like the others: the length is that of the kept vector with the smallest id (then the longest), and components beyond
+-2**50 are as good as infinite.  A length that ``PARTS`` does not divide raises.  Rows without an id are coded, and are last
in the order of ids; repeated ids and rows are coded each, and among equal ids the order of vectors decides which comes first.
With fewer rows than entries the codebooks are shorter.  An empty table gives no rows.  Long sums that pass a long are null.
Other columns are ignored, and names of the table's other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import materialise

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
EXACT = 1 << 22  # components up to here keep four times a squared distance within a long
LARGEST = float(1 << 60)
WALKS = 8_192  # walks that go on side by side


class Book:
    """A codebook with the distance-sorted neighbour list of every entry."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = squared(entries[:, None, :], entries[None, :, :])
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        # where walks begin: the entry whose sum of components is nearest
        sums = entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def start(self, parts: np.ndarray) -> np.ndarray:
        return self.by_sum[np.minimum(np.searchsorted(self.sums, parts.sum(axis=1)), len(self.by_sum) - 1)]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each part the nearest entry (ties to the lower index) and the squared distance; and how many distances the
        walks took."""
        n = len(parts)
        at = self.start(parts)
        best = squared(parts, self.entries[at])
        met = np.zeros((n, len(self.entries)), bool)
        met[np.arange(n), at] = True
        place = np.zeros(n, np.int64)
        on, measured = np.arange(n), n
        while True:
            on = on[place[on] < len(self.entries)]
            on = on[self.apart[at[on], place[on]] <= 4 * best[on]]
            if not len(on):
                return at, best, measured
            found = self.near[at[on], place[on]]
            place[on] += 1
            new = ~met[on, found]
            who, found = on[new], found[new]
            met[who, found] = True
            far = squared(parts[who], self.entries[found])
            measured += len(who)
            better = (far < best[who]) | ((far == best[who]) & (found < at[who]))
            who, found = who[better], found[better]
            at[who], best[who], place[who] = found, far[better], 0


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def exact(values: np.ndarray) -> np.ndarray:
    """Integers as longs, or as Python's integers where distances could pass a long."""
    return values if values.dtype == object or not values.size or np.abs(values).max() <= EXACT else values.astype(object)


def _matrix(column: pa.Array) -> np.ndarray:
    return exact(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1))


def _books(entries: list) -> list[Book]:
    """Codebooks from nested lists of integers; all of one kind of integer."""
    arrays = [exact(np.array(e, dtype=object)) for e in entries]
    small = all(abs(x) <= EXACT for e in entries for row in e for x in row)
    return [Book(a.astype(np.int64) if small else a) for a in arrays]


def _assigned(matrix: np.ndarray, books: list[Book]) -> Iterator[tuple[slice, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, part position, parts, nearest entries and squared distances, some rows at a time."""
    width = matrix.shape[1] // len(books)
    for lo in range(0, len(matrix), WALKS):
        rows = slice(lo, min(lo + WALKS, len(matrix)))
        for j, book in enumerate(books):
            parts = matrix[rows, j * width:(j + 1) * width]
            if book.entries.dtype == object:
                parts = parts.astype(object)
            at, far, _ = book.nearest(parts)
            yield rows, j, parts, at, far


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))])


def _sums(batches: Iterator[pa.RecordBatch], entries: list) -> Iterator[pa.RecordBatch]:
    """Of one task: for each entry the number of its parts and the sum of each of their components."""
    books, totals = _books(entries), {}
    for batch in batches:
        for _, j, parts, at, _ in _assigned(_matrix(batch.column(0)), books):
            order = np.argsort(at, kind="stable")
            found, first, n = np.unique(at[order], return_index=True, return_counts=True)
            for e, k, s in zip(found.tolist(), n.tolist(), np.add.reduceat(parts[order], first, axis=0).tolist(), strict=True):
                old = totals.get((j, e))
                totals[j, e] = (k, s) if old is None else (old[0] + k, [x + y for x, y in zip(old[1], s, strict=True)])
    rows = [(j, e, k, i, x) for (j, e), (k, s) in totals.items() for i, x in enumerate(s)]
    if rows:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SUMS.types, strict=True)], schema=_SUMS)


def _codes(batches: Iterator[pa.RecordBatch], entries: list) -> Iterator[pa.RecordBatch]:
    books = _books(entries)
    for batch in batches:
        matrix = _matrix(batch["vector"])
        codes = np.zeros((len(matrix), len(books)), np.uint8)
        error = np.zeros(len(matrix), object)
        for rows, j, _, at, far in _assigned(matrix, books):
            codes[rows, j] = at
            error[rows] += far.astype(object)
        yield pa.record_batch({
            "vec_id": batch["vec_id"], "label": batch["label"],
            "code": pa.array([c.tobytes().hex() for c in codes], pa.string()),
            "error": pa.array([int(x) if x < 1 << 63 else None for x in error], pa.int64())})


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and vector (longs) of the rows that take part, as a written table."""
    x = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vector"))
    x = x.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST / SCALE)))
    x = materialise(x.withColumn("vector", F.transform("vector", lambda c: F.floor(c * SCALE).cast("long"))), "quantised")
    length = x.groupBy(F.size("vector").alias("length")).agg(F.min("vec_id").alias("first"))
    length = length.orderBy(F.col("first").asc_nulls_last(), F.desc("length")).limit(1).collect()
    if not length:
        return x
    if length[0]["length"] % PARTS:
        raise ValueError(f"vectors of {length[0]['length']} components cannot be cut into {PARTS} equal parts")
    return x.where(F.size("vector") == length[0]["length"])


def _cut(row: list[int]) -> list[list[int]]:
    width = len(row) // PARTS
    return [row[j * width:(j + 1) * width] for j in range(PARTS)]


def train(x: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """The codebooks of quantised vectors: by part position, entry and place within the part."""
    seeds = x.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    books = [list(b) for b in zip(*[_cut(r["vector"]) for r in seeds], strict=True)]
    for _ in range(rounds if books else 0):
        sums = x.select("vector").mapInArrow(lambda batches, books=books: _sums(batches, books), "part int, entry int, n long, place int, total decimal(38,0)")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        # at most a row for each component of the codebooks
        for r in sums.collect():
            books[r["part"]][r["entry"]] = list(books[r["part"]][r["entry"]])
            books[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
    return books


def encode(x: DataFrame, books: list) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances summed over the parts)."""
    if not books:
        return x.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    kinds = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    return x.mapInArrow(lambda batches: _codes(batches, books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def digest(books: list) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together) and codebooks_sha256."""
    x = quantised(vectors, id_col, vec_col, label_col)
    books = train(x)
    coded = materialise(encode(x, books), "codes")
    # a row a label on the one side; null labels meet
    of_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of")
    out = coded.join(of_label, F.col("label").eqNullSafe(F.col("of")), "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
