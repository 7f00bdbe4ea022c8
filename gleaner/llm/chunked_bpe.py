"""Byte-level BPE encoding by overlapping chunks, and decoding.

Texts of at most ``chunk`` characters are encoded where they are read.  Longer ones are cut into
overlapping windows that Spark deals out: every window is pre-tokenised on its own, starting
wherever it happens to start; two neighbours are stitched at the first pre-token boundary that both
found inside their overlap (from a shared boundary on, both see the same text and so the same
pre-tokens), and the pieces between the stitches are encoded.  Only boundaries after a plain letter or
digit and before a blank count as stitches: there the end of a piece and the true end of a pre-token
agree whatever follows.  A text with an overlap that holds no shared boundary (one unbroken run longer
than the overlap) is encoded whole, so the ids always equal those of the library.

Defined cases: null text is the empty text (no ids); repeated rows stay separate; extra columns are
ignored; decoding an unknown id raises.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleaner.llm.tables import bound_batches

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
TAIL_CHARS = 4  # boundaries so near a window's end may still change with what follows
IDS_PER_BATCH = 4_000_000


@functools.lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


@functools.lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@functools.lru_cache(maxsize=4)
def _bytes_of(path: str) -> list[bytes | None]:
    ranks = _ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _id_batches(rows: Iterator[tuple[int | None, list[int]]]) -> Iterator[pa.RecordBatch]:
    keys: list = []
    lists: list = []
    held = 0

    def batch():
        return pa.record_batch({"doc_id": pa.array(keys, pa.int64()), "ids": pa.array(lists, pa.list_(pa.int32()))})

    for key, ids in rows:
        keys.append(key)
        lists.append(ids)
        held += len(ids)
        if held >= IDS_PER_BATCH:
            yield batch()
            keys, lists, held = [], [], 0
    if keys:
        yield batch()


def _encode_whole(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encode = _encoder(path, pattern).encode_ordinary
    yield from _id_batches((k.as_py(), encode(t.as_py() or "")) for b in batches for k, t in zip(b.column(0), b.column(1), strict=True))


def boundaries(window: str, pattern: str, starts_text: bool, ends_text: bool) -> list[int]:
    """Offsets in ``window`` where a pre-token found by scanning it from its start ends on a plain letter or
    digit and a blank follows; those too near a cut end are left out."""
    import regex

    last = len(window) if ends_text else len(window) - TAIL_CHARS
    out = []
    for m in regex.compile(pattern).finditer(window):
        e = m.end()
        if e >= last:
            break
        if window[e] == " " and window[e - 1].isascii() and window[e - 1].isalnum():
            out.append(e)
    return out


def _marks(batches: Iterator[pa.RecordBatch], pattern: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Adds to every window its boundaries near its two seams, as offsets in the text."""
    for b in batches:
        heads, tails = [], []
        for k, n, w in zip(b.column("k"), b.column("n"), b.column("window"), strict=True):
            k, n, w = k.as_py(), n.as_py(), w.as_py()
            base = max(0, k * chunk - overlap)
            found = [base + x for x in boundaries(w, pattern, k == 0, k == n - 1)]
            lo, hi = k * chunk, (k + 1) * chunk
            heads.append([x for x in found if lo <= x < lo + overlap] if k else [])
            tails.append([x for x in found if hi <= x < hi + overlap] if k < n - 1 else [])
        marks = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heads, marks), pa.array(tails, marks)], names=[*b.schema.names, "head", "tail"])


def _encode_pieces(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (row, k), a text's pieces one after the other in one task."""
    encode = _encoder(path, pattern).encode_ordinary

    def rows():
        row, key, ids = None, None, None
        for b in batches:
            for r, d, piece in zip(b.column("row"), b.column("doc_id"), b.column("piece"), strict=True):
                r = r.as_py()
                if r != row:
                    if ids is not None:
                        yield key, ids
                    row, key, ids = r, d.as_py(), []
                ids += encode(piece.as_py())
        if ids is not None:
            yield key, ids

    yield from _id_batches(rows())


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, ids array<int>), a row for every row of ``docs``."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and at most a chunk")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    schema = "doc_id long, ids array<int>"
    whole = rows.where(~is_long).mapInArrow(lambda it: _encode_whole(it, ranks_path, pattern), schema)

    n = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    windows = (
        rows.where(is_long).withColumn("row", F.monotonically_increasing_id()).withColumn("n", n)
        .select("row", "doc_id", "n", "text", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
        .withColumn("base", F.greatest(F.lit(0), F.col("k") * chunk - overlap))
        .select("row", "doc_id", "n", "k", F.expr(f"substring(text, base + 1, (k + 1) * {chunk} + {overlap} - base)").alias("window"))
    )
    marked = windows.mapInArrow(lambda it: _marks(it, pattern, chunk, overlap),
                                "row long, doc_id long, n int, k int, window string, head array<long>, tail array<long>")
    by_row = W.partitionBy("row").orderBy("k")
    cut = (
        marked.withColumn("lo", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(by_row)))))
        .withColumn("hi", F.lead("lo").over(by_row))
        .withColumn("stitched", F.min(F.col("lo").isNotNull()).over(W.partitionBy("row")))
        .withColumn("base", F.greatest(F.lit(0), F.col("k") * chunk - overlap))
    )
    # an unstitched text gives its plain cuts instead, joined again before they are encoded
    pieces = cut.select("row", "doc_id", "k", "stitched", F.when(
        F.col("stitched"), F.expr("substring(window, lo - base + 1, coalesce(hi - lo, length(window)))")
    ).otherwise(F.expr(f"substring(window, k * {chunk} - base + 1, {chunk})")).alias("piece"))
    stitched = (pieces.where("stitched").select("row", "doc_id", "k", "piece").sortWithinPartitions("row", "k")
                .mapInArrow(lambda it: _encode_pieces(it, ranks_path, pattern), schema))
    joined = (pieces.where("not stitched").groupBy("row")
              .agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("k", "piece"))).alias("p"))
              .select("doc_id", F.array_join(F.col("p.piece"), "").alias("text"))
              .mapInArrow(lambda it: _encode_whole(it, ranks_path, pattern), schema))
    return whole.union(stitched).union(joined)


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = _bytes_of(path)
    for b in batches:
        out = [b"".join([table[i] for i in ids.as_py() or []]) for ids in b.column(1)]
        yield pa.record_batch({"doc_id": b.column(0), "bytes": pa.array(out, pa.binary())})


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes binary): the tokens' bytes, one after the other."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(lambda it: _decode(it, ranks_path), "doc_id long, bytes binary")


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = _bytes_of(path)
    names = [str(i) for i in range(len(table))]
    for b in batches:
        n, ids_sha, bytes_sha = [], [], []
        for ids in b.column(1):
            ids = ids.values.to_pylist()
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
            bytes_sha.append(hashlib.sha256(b"".join([table[i] for i in ids])).hexdigest())
        yield pa.record_batch({"doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                               "decoded_sha256": pa.array(bytes_sha, pa.string())})


def digests(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Digest of every list of ids and of the bytes it decodes to."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _digests(it, ranks_path),
                                                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
