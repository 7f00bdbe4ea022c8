"""Removal of repeated strings by sorting positions on rank pairs of doubling length.

A string of ``LENGTH`` bytes (200) that starts at more than one position, in one text or several, is a repeat; all bytes that
repeats cover are removed.  A full suffix array by doubling sorts a row for every byte in every round.  Here the same sorts are
made over far fewer rows, without losing a repeat:

* *Texts once.*  Equal texts are one row of a written table with their number; a text that occurs twice is a repeat as a
  whole, and one copy of it stands for all as partner of other texts.
* *Anchors.*  Of the strings of half the length that lie in a position's 200 bytes, the one of the smallest hash (the
  leftmost of equals) is the position's anchor.  It depends on these 200 bytes alone, so equal strings have equal anchors at equal distance.
  Neighbouring positions share anchors: a run is the positions of one anchor, some 50 on average.
* *Round one*, half the length: Spark sorts the runs by the pair (rank of the 100 bytes at the anchor, name of all bytes that
  the run's positions reach), over ranges of pair and place, so that a pair that a third of all rows share lies in many tasks.
  Runs whose first component is unique are done: their positions are unique.  Runs that share both components are past the
  threshold with all their positions.  What is left are runs that share the anchor but not all around it: the edges of repeats.
* *Round two*, the whole length: the left runs, and one run of each pair to compare them with, are dealt out by the
  anchor's rank, and their positions are sorted by the pair (rank of the first 100 bytes, rank of the next 100 bytes).  Positions with
  a partner are past the threshold, the others unique.  An anchor of more than ``GROUP_RUNS`` such runs is not sorted in one task:
  its positions become rows of their own, and the pairs are counted by an aggregate.

Ranks are named by hashes (a prefix sum of a polynomial gives that of any stretch), two of 64 bits for every decision that something
is a repeat; so no round has to join ranks back to positions.

Scale: texts are shuffled once, by their digest, and stay in their buckets; later joins bring places and spans to them.  An
anchor has about a row in 50 bytes.  Nothing is collected to the driver or broadcast but whether an aggregate has rows.  Tables are
written to the shared folder after each round, so that a lost executor costs its tasks.

Defined cases: null text is the empty text; texts shorter than 200 bytes are kept whole; matches never cross texts; ids do not
matter (null and repeated ids, repeated rows: a row each); overlapping repeats (a character 201 times) count; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import bound_batches, discard, freed_shuffles, materialise, materialise_at, materialise_bucketed

LENGTH = 200
HALF = LENGTH // 2
GROUP_RUNS = 1_000  # runs of one anchor whose positions are compared in one task
CHUNK_BYTES = 1 << 18  # bytes hashed together
PIECE_BYTES = 1 << 20  # longer texts are hashed in overlapping pieces
CHUNK_RUNS = 10_000  # runs whose positions are sorted together
HELD_ROWS = 500_000  # sorted rows of one anchor that a task holds

_U = np.uint64


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BASE = 0x9E3779B97F4A7C15
_OF_BYTE = _scrambled(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of them at least."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, _U)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


class Names:
    """Hashes of any stretch of some bytes, equal for equal stretches wherever they lie."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_OF_BYTE[data] * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _scrambled((self.sums[end] - self.sums[start]) * self.down[start])

    def all_of(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _scrambled((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each ``width`` neighbouring values, the leftmost of equals."""
    at, least, reach = np.arange(len(values), dtype=np.int32), values, 1
    while reach < width:
        step = min(reach, width - reach)
        left = least[:-step] <= least[step:]
        at, least = np.where(left, at[:-step], at[step:]), np.where(left, least[:-step], least[step:])
        reach += step
    return at


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of texts laid one after another, which end at ``ends``: first and last position, anchor, the anchor's
    rank, and the name of all that the run's positions reach, with where the anchor stands in it."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    names = Names(data)
    ranks = names.all_of(HALF)
    anchor = _leftmost_least(ranks, LENGTH - HALF + 1).astype(np.int64)
    inside = np.ones(len(anchor), bool)  # positions whose bytes lie in one text
    for e in ends[:-1]:
        inside[max(0, e - LENGTH + 1):e] = False
    at = np.flatnonzero(inside)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    first, last, anchor = at[first], at[last], anchor[at[first]]
    around = names.of(first, last + LENGTH)
    around = _scrambled(around + (anchor - first).astype(_U) * _U(_BASE))
    return first, last, anchor, ranks[anchor], around


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, memoryview]]:
    """(row, offset, bytes) of a batch's texts; long ones in pieces that overlap by a string less a byte."""
    for row, text in enumerate(batch["text"]):
        view = memoryview(text.as_buffer())
        for lo in range(0, max(1, len(view) - LENGTH + 1), PIECE_BYTES):
            yield row, lo, view[lo:lo + PIECE_BYTES + LENGTH - 1]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank, name, text and place of every run.  A place holds the anchor and how far before it the run's first and last
    positions lie."""
    for batch in batches:
        hi, lo = (batch[c].to_numpy() for c in ("hi", "lo"))
        held: list[tuple[int, int, memoryview]] = []
        size = 0
        for piece in _pieces(batch):
            held.append(piece)
            size += len(piece[2])
            if size >= CHUNK_BYTES:
                yield _anchor_rows(held, hi, lo)
                held, size = [], 0
        if held:
            yield _anchor_rows(held, hi, lo)


def _anchor_rows(held: list, hi: np.ndarray, lo: np.ndarray) -> pa.RecordBatch:
    rows, offsets = (np.array(x, np.int64) for x in zip(*[(r, o) for r, o, _ in held], strict=True))
    ends = np.cumsum([len(v) for _, _, v in held])
    first, last, anchor, rank, around = runs(np.frombuffer(b"".join(v for _, _, v in held), np.uint8), ends)
    piece = np.searchsorted(ends, first, side="right")
    start = np.concatenate([[0], ends[:-1]])[piece] - offsets[piece]
    place = ((anchor - start) << 16) | ((anchor - first) << 8) | (anchor - last)
    return pa.record_batch({"rank": rank.view(np.int64), "around": around.view(np.int64), "hi": hi[rows[piece]], "lo": lo[rows[piece]], "place": place})


REPEATED, COMPARED, OPEN = 1, 2, 4  # of a run: all positions are repeats; takes part in round two; has positions to decide there


def _judged(table: pa.Table, whole: bool) -> pa.Table:
    """Sorted rows of some anchors with what is known of them.  Unless ``whole``, other tasks may hold rows of these anchors."""
    rank, around = (table[c].to_numpy() for c in ("rank", "around"))
    new_rank = np.append(True, rank[1:] != rank[:-1])
    new_pair = new_rank | np.append(True, around[1:] != around[:-1])
    pair, group = np.cumsum(new_pair) - 1, np.cumsum(new_rank) - 1
    alone = np.bincount(pair)[pair] == 1
    mixed = np.bincount(group, weights=alone)[group] > 0 if whole else np.ones(len(rank), bool)
    shared = np.bincount(group)[group] > 1 if whole else np.ones(len(rank), bool)
    state = np.where(alone, COMPARED | OPEN, REPEATED | np.where(new_pair & mixed, COMPARED, 0)).astype(np.int8)
    return table.drop_columns(["around"]).append_column("state", pa.array(state)).filter(pa.array(shared))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round one on a task's sorted rows, whole anchors at a time.  The first and the last anchor of a task may go on in
    others, and of an anchor that fills ``HELD_ROWS`` only a part is held: these rows stay open unless they show a repeat themselves,
    and round two decides."""
    held, size, first = [], 0, True

    def told(table: pa.Table, whole: bool) -> list[pa.RecordBatch]:
        return _judged(table, whole).combine_chunks().to_batches() if table.num_rows else []

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < 65_536:
            continue
        table = pa.Table.from_batches(held)
        rank = table["rank"].to_numpy()
        last = int(np.flatnonzero(rank != rank[-1])[-1]) + 1 if rank[0] != rank[-1] else 0
        if not last and table.num_rows < HELD_ROWS:
            continue
        if not last:
            yield from told(table, False)
            held, size, first = [], 0, True
            continue
        begin = int(np.flatnonzero(rank != rank[0])[0]) if first else 0
        yield from told(table.slice(0, begin), False)
        yield from told(table.slice(begin, last - begin), True)
        held, size, first = table.slice(last).to_batches(), table.num_rows - last, False
    if held:
        table = pa.Table.from_batches(held)
        rank = table["rank"].to_numpy()
        last = int(np.flatnonzero(rank != rank[-1])[-1]) + 1 if rank[0] != rank[-1] else 0
        begin = min(last, int(np.flatnonzero(rank != rank[0])[0])) if first and last else 0
        yield from told(table.slice(0, begin), False)
        yield from told(table.slice(begin, last - begin), True)
        yield from told(table.slice(last), False)


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each listed run with the bytes that its positions reach."""
    for batch in batches:
        lists = batch["runs"]
        flat, parent = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        place = flat.field("place").to_numpy()
        texts = [memoryview(t.as_buffer()) for t in batch["text"]]
        anchor, back = place >> 16, (place >> 8) & 255
        start, end = anchor - back, anchor - (place & 255) + LENGTH
        for at in range(0, len(place), 100_000):
            some = slice(at, at + 100_000)
            reached = [bytes(texts[t][s:e]) for t, s, e in zip(parent[some].tolist(), start[some].tolist(), end[some].tolist(), strict=True)]
            keys = {c: batch[c].to_numpy()[parent[some]] for c in ("hi", "lo")}
            yield pa.record_batch({"rank": flat.field("rank").slice(at, 100_000), **keys, "place": place[some],
                                   "state": flat.field("state").slice(at, 100_000), "reached": pa.array(reached, pa.binary())})


def _positions(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Of the positions of some runs: the run, the place in it, and the ranks of the first and of the second half."""
    reached = table["reached"].combine_chunks()
    data = np.frombuffer(b"".join(memoryview(x.as_buffer()) for x in reached), np.uint8)
    size = np.array([len(x.as_buffer()) for x in reached], np.int64)
    n = size - LENGTH + 1
    run = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(size) - size, n) + within
    ranks = Names(data).all_of(HALF)
    return run, within, ranks[at], ranks[at + HALF]


def _spans(table: pa.Table, run: np.ndarray, within: np.ndarray) -> pa.RecordBatch:
    """Byte spans of repeated positions (in order of run and place), neighbours together."""
    new = np.append(True, (run[1:] != run[:-1]) | (within[1:] != within[:-1] + 1)) if len(run) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(run)) - 1 if len(first) else first
    place = table["place"].to_numpy()[run[first]]
    start = (place >> 16) - ((place >> 8) & 255)
    keys = {c: table[c].to_numpy()[run[first]] for c in ("hi", "lo")}
    return pa.record_batch({**keys, "start": start + within[first], "end": start + within[last] + LENGTH})


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round two on runs in order of their anchors' ranks, whole anchors at a time."""

    def told(table: pa.Table) -> pa.RecordBatch:
        run, within, one, two = _positions(table)
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        repeated = np.zeros(len(order), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        repeated &= (table["state"].to_numpy()[run] & OPEN) > 0
        return _spans(table, run[repeated], within[repeated])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK_RUNS:
            continue
        table = pa.Table.from_batches(held)
        rank = table["rank"].to_numpy()
        if rank[0] != rank[-1]:
            last = int(np.flatnonzero(rank != rank[-1])[-1]) + 1
            yield told(table.slice(0, last))
            held, size = table.slice(last).to_batches(), table.num_rows - last
    if held:
        yield told(pa.Table.from_batches(held))


def _position_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round two of frequent anchors: a row for each position."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            table = pa.Table.from_batches([batch.slice(at, 1_000)])
            run, within, one, two = _positions(table)
            place = table["place"].to_numpy()[run]
            yield pa.record_batch({"one": one.view(np.int64), "two": two.view(np.int64), "hi": table["hi"].to_numpy()[run], "lo": table["lo"].to_numpy()[run],
                                   "start": (place >> 16) - ((place >> 8) & 255) + within, "open": (table["state"].to_numpy()[run] & OPEN) > 0})


def _digest(hexes, part: int):
    """60 bits of a hex digest as a long."""
    return F.conv(F.substring(hexes, 1 + 15 * part, 15), 16, 10).cast("long")


def _keyed(docs: DataFrame, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    sha = F.sha2(text, 256)
    return docs.select(*more, text.alias("text"), sha.alias("sha"), _digest(sha, 0).alias("hi"), _digest(sha, 1).alias("lo"))


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """hi, lo (120 bits of the SHA-256), copies and text of each distinct text that can hold a repeat, in buckets by hi and lo.
    Copies become one in the tasks that read them, before any is moved."""
    texts = _keyed(docs, text_col).where(F.octet_length("text") >= LENGTH)
    return materialise_bucketed(texts.groupBy("hi", "lo").agg(F.count("*").alias("copies"), F.first("text").alias("text")), ["hi", "lo"], "texts")


def repeats(texts: DataFrame) -> DataFrame:
    """hi, lo, start and end of byte spans that cover every repeat of the distinct texts ``texts``, none longer than needed;
    they may overlap.  Repeats that show only in copies of a whole text are not among them."""
    spark = texts.sparkSession
    order = ["rank", "around", "hi", "lo", "place"]
    rows, path = materialise_at(texts.select("hi", "lo", "text").mapInArrow(_anchors, "rank long, around long, hi long, lo long, place long"), "anchors")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    judged = materialise(ranged.mapInArrow(_judge, "rank long, hi long, lo long, place long, state byte"), "judged")
    discard(spark, path)

    # round two, with the bytes around
    left = judged.where(F.col("state").bitwiseAND(COMPARED) > 0)
    listed = left.groupBy("hi", "lo").agg(F.collect_list(F.struct("rank", "place", "state")).alias("runs"))  # of one text
    reached = texts.select("hi", "lo", "text").join(listed, ["hi", "lo"])
    reached = materialise(reached.mapInArrow(_reached, "rank long, hi long, lo long, place long, state byte, reached binary"), "reached")
    frequent = materialise(reached.groupBy("rank").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_RUNS).select("rank"), "frequent")
    spans = "hi long, lo long, start long, end long"
    found = judged.where(F.col("state").bitwiseAND(REPEATED) > 0).select(
        "hi", "lo", F.expr("(place >> 16) - ((place >> 8) & 255)").alias("start"), F.expr(f"(place >> 16) - (place & 255) + {LENGTH}").alias("end"))
    rare, often = reached, None
    if not frequent.isEmpty():
        rare = reached.join(frequent, "rank", "left_anti")
        often = materialise(reached.join(frequent, "rank", "left_semi").select(*reached.columns).mapInArrow(
            _position_rows, "one long, two long, hi long, lo long, start long, open boolean"), "positions")
    found = found.union(rare.repartition("rank").sortWithinPartitions("rank").select(*reached.columns).mapInArrow(_compare, spans))
    if often is not None:
        twice = often.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
        found = found.union(often.where("open").join(twice, ["one", "two"], "left_semi").select("hi", "lo", "start", (F.col("start") + LENGTH).alias("end")))
    return found


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of covered bytes of (start, end) rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


_KEPT = "hi long, lo long, spans array<struct<start:long,end:long>>, kept binary"


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged spans and kept bytes of texts with their found spans."""
    for batch in batches:
        for r in range(batch.num_rows):
            text = memoryview(batch["text"][r].as_buffer())
            found = batch["found"][r].values
            spans = merged(np.stack([found.field("start").to_numpy(), found.field("end").to_numpy()], axis=1))
            edges = [0, *spans.ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            pairs = pa.StructArray.from_arrays([pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["start", "end"])
            yield pa.record_batch({"hi": batch["hi"].slice(r, 1), "lo": batch["lo"].slice(r, 1),
                                   "spans": pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs), "kept": pa.array([kept], pa.binary())})


def removed(texts: DataFrame, found: DataFrame) -> DataFrame:
    """hi, lo, spans (maximal removed byte runs) and kept (the other bytes) of each distinct text that loses bytes."""
    listed = found.groupBy("hi", "lo").agg(F.collect_list(F.struct("start", "end")).alias("found"))  # of one text
    some = texts.where("copies = 1").select("hi", "lo", "text").join(listed, ["hi", "lo"]).mapInArrow(_keep, _KEPT)
    whole = texts.where("copies > 1").select(
        "hi", "lo", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end"))).alias("spans"), F.lit(b"").alias("kept"))
    return some.union(whole)


def remove(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """hi, lo, spans and kept of each distinct text of ``docs`` that loses bytes; hi and lo are 120 bits of its SHA-256."""
    bound_batches(docs.sparkSession)
    with freed_shuffles(docs.sparkSession):
        texts = distinct_texts(docs, text_col)
        return removed(texts, materialise(repeats(texts), "spans"))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    kept = remove(docs, text_col)
    kept = kept.select("hi", "lo", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    with freed_shuffles(docs.sparkSession):
        kept = materialise(kept, "kept")
    rows = _keyed(docs, text_col, F.col(id_col).alias("doc_id")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "sha", "hi", "lo")
    return rows.join(kept, ["hi", "lo"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
