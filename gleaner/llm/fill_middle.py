"""Fill-in-the-middle rewriting of texts as a ``pyarrow.compute`` pipeline over Arrow batches.

Texts are cut into units (a word with the white space before it; the white space that ends a text is a unit of its
own), a prefix, a middle and a suffix of whole units are drawn by digests of the id, and half of the texts come out as

* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle,
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle,

the others plain.  A batch is handled by whole-column steps: a separator is put behind each unit and the texts are split
there into list arrays; the lists are flattened with the indices of their parents; a unit's ordinal is its place less
its list's first place; each role's units are filtered out, put back into lists by their counts and joined; the pieces
are joined element-wise.  No step loops over rows or units.

Every row is worked on where it is read (no shuffle), so an executor that is lost costs its tasks only, and a hot id or
source costs nothing.  Memory follows ``SLICE_BYTES`` of text or one text, whichever is more.

Defined cases: a null text is the empty text, and empty texts are plain; so are texts that hold a sentinel, which could
not be restored; a null id is the empty text in the digest; repeated rows and ids give a row each; an empty table gives
no rows; columns that are not kept are ignored, and kept ones travel in a struct, so their names cannot clash; bytes that
are no UTF-8 are kept in the output (``restore``, being SQL, reads them as U+FFFD).  Ties of the two cuts leave the middle
empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import bound_batches

SENTINELS = ("<P>", "<S>", "<M>")
SALT = "42"
FIM_PERCENT = 50
SPM_PERCENT = 80
SLICE_BYTES = 32 << 20  # text worked on together

#: A unit that ends in a word; what is left of a text behind its last word is white space.
WORD = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"


def separator(texts: pa.Array) -> str:
    """A string that none of ``texts`` holds.  Its first character comes only first, so it overlaps neither itself nor a
    text that it follows."""
    mark = "\x00"
    while pc.any(pc.match_substring(texts, mark)).as_py():
        mark += "\x01"
    return mark


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The units of all texts one after another, and with each the index of its text."""
    mark = separator(texts)
    lists = pc.split_pattern(pc.replace_substring_regex(texts, WORD, r"\1" + mark), mark)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)  # behind the last separator there may be nothing
    return pc.filter(flat, full), pc.filter(parent, full)


def ordinals(parent: pa.Array, counts: pa.Array) -> pa.Array:
    """Of each unit its place in its text, from 0."""
    first = pc.subtract(pc.cumulative_sum(counts), counts)
    return pc.subtract(pa.array(np.arange(len(parent))), pc.take(first, parent))


def joined(flat: pa.Array, chosen: pa.Array, counts: pa.Array) -> pa.Array:
    """The chosen units as one piece a text, which has ``counts`` of them."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, pc.filter(flat, chosen)), pa.scalar(b"", pa.large_binary()))


def _rewritten(batch: pa.RecordBatch) -> pa.RecordBatch:
    """row, n, form and output of rows (row, text, h1 .. h4)."""
    texts = pc.fill_null(batch["text"].cast(pa.large_binary()), b"")
    flat, parent = units(texts)
    n = pa.array(np.bincount(parent.to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int64))
    cuts = [_modulo(batch[h], pc.add(n, 1)) for h in ("h1", "h2")]
    first, second = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)

    place = ordinals(parent, n)
    in_prefix = pc.less(place, pc.take(first, parent))
    in_suffix = pc.greater_equal(place, pc.take(second, parent))
    prefix = joined(flat, in_prefix, first)
    middle = joined(flat, pc.invert(pc.or_(in_prefix, in_suffix)), pc.subtract(second, first))
    suffix = joined(flat, in_suffix, pc.subtract(n, second))

    marked = pc.equal(n, 0)
    for mark in SENTINELS:
        marked = pc.or_(marked, pc.match_substring(texts, mark))
    plain = pc.or_(marked, pc.greater_equal(_modulo(batch["h3"], 100), FIM_PERCENT))
    form = pc.if_else(plain, "plain", pc.if_else(pc.less(_modulo(batch["h4"], 100), SPM_PERCENT), "spm", "psm"))
    p, s, m, nothing = (pa.scalar(x.encode(), pa.large_binary()) for x in (*SENTINELS, ""))
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
    output = pc.if_else(plain, texts, pc.if_else(pc.equal(form, "spm"), spm, psm))
    return pa.record_batch({"row": batch["row"], "n": n, "form": form, "output": output.cast(pa.binary())})


def _modulo(x: pa.Array, by) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            yield _rewritten(batch.slice(at, upto - at))
            at = upto


def draw(id_col: str, group: int, salt: str = SALT) -> Column:
    """The ``group``-th (from 1) group of 8 hex digits of the digest of an id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a struct of the columns ``keep``), n (units), form (plain, psm or spm) and output (the rewritten text)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).cast("binary").alias("text"),
                       *[draw(id_col, g).alias(f"h{g}") for g in (1, 2, 3, 4)])
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_rewrite, f"row {kind}, n long, form string, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def pieces(output: str = "output", form: str = "form") -> Column:
    """A rewritten text's prefix, middle and suffix as a struct; null for a plain one.  Only the sentinels put in by
    ``transform`` are found, as texts that hold one come out plain, and none can arise where pieces meet."""
    # a one-element transform binds the split once
    split = F.split(F.col(output), "|".join(SENTINELS), -1)
    told = F.transform(F.array(split), lambda x: F.struct(
        F.when(F.col(form) == "psm", x[1]).otherwise(x[2]).alias("prefix"), x[3].alias("middle"),
        F.when(F.col(form) == "psm", x[2]).otherwise(x[1]).alias("suffix")))[0]
    return F.when(F.col(form) != "plain", told)


def restore(output: str = "output", form: str = "form", parts: str | None = None) -> Column:
    """The text that was rewritten, from output and form alone (``parts``: a column that holds ``pieces`` already)."""
    p = F.col(parts) if parts else pieces(output, form)
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(p["prefix"], p["middle"], p["suffix"]))


def digests(rewritten: DataFrame) -> DataFrame:
    """The kept columns, n, form, the lengths of prefix and middle in code points (null if plain) and the SHA-256 of the
    output and of the text restored from it."""
    told = rewritten.withColumn("parts", pieces())
    return told.select(
        "row.*", "n", "form", F.length("parts.prefix").cast("long").alias("prefix_chars"), F.length("parts.middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(parts="parts").cast("binary"), 256).alias("restored_sha256"))
