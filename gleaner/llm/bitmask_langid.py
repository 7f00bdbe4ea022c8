"""Language identification with bit-sliced Bloom filters of character n-grams.

Training counts every byte 4-gram of letters and word edges in all training texts by language.  A
gram belongs to the languages in which its rate is at least ``KEEP_RATIO`` of its highest rate in any
language.  One array of ``SLOTS`` words holds all the Bloom filters side by side, one bit column per
language: looking a gram up ANDs the words of its ``HASHES`` slots and so returns every language
that contains it.  The filter is built by an aggregate in Spark; the driver receives at most ``SLOTS``
words for every 62 languages, whatever the size of the corpus.

A text's score for a language is its number of grams with that bit, less what the filter's
false-positive rate explains: (hits - n * p) / (1 - p).  The largest wins, ties go to the language with
more training texts, then to the smaller name; ``score`` is the winner's share of all corrected counts.

Defined cases: null text or no letter gives ``und`` with score 0, as does an empty training set; a text whose
grams no language has gets the language with the most training texts, score 0; empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleaner.llm.tables import bound_batches, materialise, read_text, with_text

SLOTS = 1 << 20
HASHES = 3
KEEP_RATIO = 0.3
MIN_COUNT = 2
WORD_BITS = 62  # language bits in one word of the filter
FLUSH_BYTES = 4_000_000

SLICE_GRAMS = 1_000_000  # grams of a text looked up at once

#: odd multipliers of the slot hashes, below 2^31, so that their products with a gram fit a long
MULTIPLIERS = (0x61C88647, 0x27D4EB2F, 0x165667B1)


@functools.lru_cache(maxsize=1)
def _letters() -> bytes:
    """ASCII letters to lower case, bytes of other characters as they are, all else to blanks."""
    return bytes(c | 32 if chr(c).isalpha() and c < 128 else c if c >= 128 else 32 for c in range(256))


def _prepared(text: str) -> bytes:
    return b" " + b" ".join(text.encode().translate(_letters()).split()) + b" "


def _grams(data: bytes) -> np.ndarray:
    """All byte 4-grams of ``data``."""
    if len(data) < 4:
        data = data.ljust(4)
    return np.ndarray((len(data) - 3,), "<u4", data, strides=(1,))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _language_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush(lang: str) -> None:
        g, n = np.unique(np.concatenate([_grams(x) for x in held.pop(lang)]), return_counts=True)
        if lang in found:
            old_g, old_n = found[lang]
            both = np.concatenate([old_g, g])
            g, at = np.unique(both, return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([old_n, n])).astype(np.int64)
        found[lang] = g, n
        sizes[lang] = 0

    for b in batches:
        for lang, text in zip(b.column(0), b.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py()
            if not has_letter(text):
                continue
            data = _prepared(text)
            held.setdefault(lang, []).append(data)
            sizes[lang] = sizes.get(lang, 0) + len(data)
            if sizes[lang] > FLUSH_BYTES:
                flush(lang)
    for lang in list(held):
        flush(lang)
    for lang, (g, n) in found.items():
        yield pa.record_batch({"lang": pa.array([lang] * len(g), pa.string()), "gram": pa.array(g.astype(np.int64)), "n": pa.array(n.astype(np.int64))})


class Filter:
    """The side-by-side Bloom filters; small enough to send to every worker."""

    def __init__(self, langs: list[str], words: np.ndarray):
        self.langs = langs
        self.words = words  # (word group, slot)
        fill = np.array([((words[i // WORD_BITS] >> np.uint64(i % WORD_BITS)) & np.uint64(1)).mean() for i in range(len(langs))])
        self.false_rate = np.minimum(fill ** HASHES, 0.999)

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Corrected number of grams found, by language."""
        hits = np.zeros(len(self.langs))
        for lo in range(0, len(grams), SLICE_GRAMS):
            slots = [slots_of(grams[lo:lo + SLICE_GRAMS], k) for k in range(HASHES)]
            for group in range(self.words.shape[0]):
                w = self.words[group]
                mask = w[slots[0]]
                for s in slots[1:]:
                    mask = mask & w[s]
                masks, n = np.unique(mask, return_counts=True)
                for i in range(group * WORD_BITS, min(len(self.langs), (group + 1) * WORD_BITS)):
                    hits[i] += n[(masks >> np.uint64(i % WORD_BITS)) & np.uint64(1) == 1].sum()
        return np.maximum(hits - len(grams) * self.false_rate, 0) / (1 - self.false_rate)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        got = self.counts(_grams(_prepared(text)))
        best = int(got.argmax())
        total = got.sum()
        return self.langs[best], float(got[best] / total) if total > 0 else 0.0


_SLOT_SHIFT = 32 - SLOTS.bit_length() + 1


def slots_of(grams: np.ndarray, k: int) -> np.ndarray:
    """The k-th slot of each gram: the top bits of its 32-bit product."""
    return (grams.astype(np.uint32) * np.uint32(MULTIPLIERS[k])) >> np.uint32(_SLOT_SHIFT)


def _slot_column(k: int):
    """``slots_of`` as a column."""
    return F.shiftright((F.col("gram") * F.lit(MULTIPLIERS[k])).bitwiseAND(0xFFFFFFFF), _SLOT_SHIFT)


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Filter:
    """The filter of all ``rows`` with a language; every such text is read whole."""
    bound_batches(rows.sparkSession)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    langs = [r[0] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    if not langs:
        return Filter([], np.zeros((0, SLOTS), np.uint64))
    number = F.create_map(*[x for i, name in enumerate(langs) for x in (F.lit(name), F.lit(i))])
    grams = materialise(rows.mapInArrow(_language_grams, "lang string, gram long, n long")
                        .groupBy("gram", "lang").agg(F.sum("n").alias("n")), "language-grams")
    totals = {r[0]: r[1] for r in grams.groupBy("lang").agg(F.sum("n")).collect()}
    if not totals:
        return Filter(langs, np.zeros((-(-len(langs) // WORD_BITS), SLOTS), np.uint64))
    total = F.create_map(*[x for name, n in totals.items() for x in (F.lit(name), F.lit(float(n)))])
    rated = (grams.withColumn("rate", F.col("n") / total[F.col("lang")]).withColumn("i", number[F.col("lang")])
             .withColumn("top", F.max("rate").over(W.partitionBy("gram"))))
    masks = (rated.where((F.col("rate") >= KEEP_RATIO * F.col("top")) & (F.col("n") >= MIN_COUNT))
             .groupBy("gram", F.floor(F.col("i") / WORD_BITS).cast("int").alias("word"))
             .agg(F.expr(f"bit_or(shiftleft(1L, i % {WORD_BITS}))").alias("mask")))
    filled = (masks.select("word", "mask", F.explode(F.array(*[_slot_column(k) for k in range(HASHES)])).alias("slot"))
              .groupBy("word", "slot").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    words = np.zeros((-(-len(langs) // WORD_BITS), SLOTS), np.uint64)
    words[filled.column("word").to_numpy(), filled.column("slot").to_numpy()] = filled.column("mask").to_numpy().astype(np.uint64)
    return Filter(langs, words)


def _predictions(batches: Iterator[pa.RecordBatch], shared, path: list[str]) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for b in batches:
        got = [model.predict(t.as_py()) for t in read_text(b, path)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                                         names=["row", "lang_pred", "score"])


def predict(docs: DataFrame, model: Filter, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with lang_pred and score; one narrow pass."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    sent, path = with_text(docs, keep, text_col)
    kinds = docs.select(sent[0]).schema["row"].dataType.simpleString()
    out = docs.select(*sent).mapInArrow(lambda it: _predictions(it, shared, path), f"row {kinds}, lang_pred string, score double")
    return out.select("row.*", "lang_pred", "score")
