"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A document leaks an item if it holds the whole of it, or a stretch of half of it but ``LEAST`` bytes at least, each within
``RATE`` of its length in edits, case of A-Z and runs of white space aside.  The rule is one at every length.  A stretch
within k edits of a text of m characters shares at least m + 1 - q - k * q of its q-grams, on diagonals that differ by at
most k.  So each document's q-grams are
looked up in the items' q-grams, the hits are counted in overlapping bands of diagonals, bands that
reach a bound are kept, and the region of each is aligned inside its band, with the whole item only where the whole item's bound is
reached.

The same bound holds for the stretch itself, on the diagonals of the item, so items are looked up whole and no stretch
of an item is missed wherever it begins.  A stretch found is extended while it pays; ``share`` is the part of the item
that it covers in the end.  The index is broadcast in slices of at most ``SLICE_BYTES`` of items, whatever the size of the benchmark: a larger one takes
several narrow passes over the documents.  Documents are never shuffled.

Defined cases: null and empty texts leak nothing; items that are null or shorter than q bytes (after
folding) are too short to be evidence and match nothing; items that occur twice are reported under
both ids; repeated rows stay separate; empty tables give no leaks; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import bound_batches, read_text, with_text

Q = 8  # a q-gram is one 64-bit word
RATE = 0.08  # edits for each character of an item
LEAST = 40  # bytes of an item in a stretch that is evidence at least; of items of over 80, half of it
SLICE_BYTES = 1_000_000
WINDOW_BYTES = 4_000_000  # of a long document looked at together
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LEAKS = "array<struct<item_id: bigint, start: bigint, end: bigint, edits: int, share: double>>"


def folded(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case and white space as single blanks."""
    return b" ".join((text or "").encode().lower().split())


def banded(pattern: np.ndarray, text: np.ndarray, width: int, free: bool) -> tuple[int, int]:
    """(edits, end) of the best alignment of the whole pattern with a stretch of ``text`` that starts in the
    band's ``width`` first places (``free``) or at 0; cell (i, d) aligns i characters of the pattern with text up to i + d."""
    big = len(pattern) + len(text) + 1
    d = np.arange(width)
    row = np.zeros(width, np.int64) if free else d.copy()
    padded = np.full(len(pattern) + width, 256, np.int64)
    padded[:min(len(text), len(padded))] = text[:len(padded)]
    for i, c in enumerate(pattern):
        step = row + (padded[i:i + width] != c)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        step = np.minimum.accumulate(step - d) + d
        step[i + 1 + d > len(text)] = big
        row = step
    at = int(row.argmin())
    return int(row[at]), min(len(text), len(pattern) + at)


def stretches(pattern: np.ndarray, size: int, starts: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of the best alignment of each ``pattern[a:a + size]``, a in ``starts``, that starts in ``text`` at a + low or
    one of the next places, ``width`` in all; ends may lie outside the text."""
    d = np.arange(width)
    pad = max(0, -low)
    padded = np.full(pad + max(len(text), len(pattern) + max(0, low) + width), 256, np.int64)
    padded[pad:pad + len(text)] = text
    row = np.zeros((len(starts), width), np.int64)
    at = starts[:, None] + (low + pad) + d
    for i in range(size):
        step = row + (padded[at + i] != pattern[starts + i][:, None])
        step[:, :-1] = np.minimum(step[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(step - d, axis=1) + d
    best = row.argmin(axis=1)
    return row[np.arange(len(starts)), best], starts + size + low + best


def grown(pattern: np.ndarray, text: np.ndarray, used: int, done: int, rate: float) -> tuple[int, int, int]:
    """(characters of the pattern, of the text, edits) by which an alignment of ``done`` characters with ``used`` edits is
    extended: while it stays within ``rate``, and an edit gains at least four characters."""
    w = max(1, int(rate * (done + len(pattern))) - used)
    big = done + len(pattern) + len(text) + w
    d = np.arange(-w, w + 1)
    row = np.where(d < 0, big, d)
    padded = np.full(len(pattern) + 2 * w + 1, 256, np.int64)  # place j of the text at j + w
    n = min(len(text), len(pattern) + w + 1)
    padded[w:w + n] = text[:n]
    best, gain = (0, 0, 0), 0
    for i, c in enumerate(pattern):
        step = row + (padded[i:i + 2 * w + 1] != c)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        step = np.minimum.accumulate(step - d) + d
        step[(i + 1 + d > len(text)) | (i + 1 + d < 0)] = big
        row = step
        at = int(row.argmin())
        edits = int(row[at])
        if used + edits > rate * (done + len(pattern)):
            break
        if used + edits <= rate * (done + i + 1) and i + 1 - 4 * edits > gain:
            best, gain = (i + 1, i + 1 + at - w, edits), i + 1 - 4 * edits
    return best


class Index:
    """The q-grams of a slice of items: sorted distinct codes with their (item, position) postings."""

    def __init__(self, items: list[tuple[int, str | None]], rate: float = RATE):
        self.item: list[int] = []
        self.piece: list[bytes] = []
        for item, text in items:
            data = folded(text)
            if len(data) < Q:
                continue
            self.item.append(item)
            self.piece.append(data)
        self.rate = rate
        m = np.array([len(p) for p in self.piece], np.int64)
        self.size = np.minimum(m, np.maximum(LEAST, (m + 1) // 2))
        # the largest edit budgets, of a stretch and of the item, for which the lemma still asks for a shared q-gram
        self.budget = np.minimum((rate * self.size).astype(np.int64), (self.size - Q) // Q)
        self.k = np.minimum((rate * m).astype(np.int64), (m - Q) // Q)
        self.stretch_need = self.size - Q + 1 - self.budget * Q
        self.whole_need = m - Q + 1 - self.k * Q
        self.need = np.minimum(self.stretch_need, self.whole_need)
        self.longest = int(m.max()) if len(m) else 0
        self.least = int(self.need.min()) if len(m) else 0
        codes = [self._codes(p) for p in self.piece]
        piece = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.codes, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat)).astype(np.int64)
        self.post_piece, self.post_place = piece[order].astype(np.int64), place[order].astype(np.int64)
        bits = max(16, int(np.ceil(np.log2(max(1, 32 * len(self.codes))))))
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[(self.codes * _MULTIPLIER) >> self.shift] = True

    @staticmethod
    def _codes(data: bytes) -> np.ndarray:
        return np.ndarray((len(data) - Q + 1,), "<u8", data, strides=(1,))

    def bands(self, data: bytes) -> list[tuple[int, int, int, int]]:
        """(piece, lowest and one past the highest diagonal, shared q-grams) of the bands that reach a bound of the lemma's."""
        codes = self._codes(data)
        at = np.flatnonzero(self.filter[(codes * _MULTIPLIER) >> self.shift])
        if len(at) < self.least:
            return []
        c = codes[at]
        slot = np.minimum(np.searchsorted(self.codes, c), len(self.codes) - 1)
        ok = self.codes[slot] == c
        at, slot = at[ok], slot[ok]
        n = self.starts[slot + 1] - self.starts[slot]
        post = np.repeat(self.starts[slot] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        piece = self.post_piece[post]
        enough = np.bincount(piece, minlength=len(self.piece))[piece] >= self.need[piece]
        piece = piece[enough]
        if not len(piece):
            return []
        diagonal = (np.repeat(at, n) - self.post_place[post])[enough] + self.longest  # not negative
        step = self.k[piece] + 1
        band = diagonal // step
        # band j covers diagonals [j * step, (j + 2) * step): any k + 1 neighbouring diagonals lie in one of them
        keys, count = np.unique(np.concatenate([(piece << 40) + band + 1, (piece << 40) + band]), return_counts=True)
        found = []
        for key, hits in zip(keys.tolist(), count.tolist(), strict=True):
            p, j = key >> 40, (key & ((1 << 40) - 1)) - 1
            if hits >= self.need[p]:
                w = int(self.k[p]) + 1
                found.append((p, j * w - self.longest, (j + 2) * w - self.longest, hits))
        return found

    def verify(self, data: bytes, piece: int, low: int, high: int, hits: int) -> tuple[int, int, int, float] | None:
        """(start, end, edits, share) in ``data`` of the item's best alignment in a band, or else of a stretch of it, if
        it is within the budget.  Each is aligned only where the band's q-grams reach its own bound."""
        p, k = self.piece[piece], int(self.k[piece])
        lo, hi = max(0, low - k), min(len(data), high + len(p) + k)
        exact = data.find(p, lo, hi)
        if exact >= 0:
            return exact, exact + len(p), 0, 1.0
        region, pattern = np.frombuffer(data[lo:hi], np.uint8).astype(np.int64), np.frombuffer(p, np.uint8)
        if hits >= self.whole_need[piece]:
            edits, end = banded(pattern, region, high - low + 2 * k + 1, True)
            if edits <= k:
                _, back = banded(pattern[::-1], region[:end][::-1], 2 * k + 1, False)
                return lo + end - back, lo + end, edits, 1.0
        if hits < self.stretch_need[piece]:
            return None
        return self._stretch(piece, pattern, data[lo:hi], region, lo, low - k - lo, high - low + 2 * k + 1)

    def _stretch(self, piece: int, pattern: np.ndarray, part: bytes, region: np.ndarray, lo: int, low: int, width: int) -> tuple[int, int, int, float] | None:
        size, budget = int(self.size[piece]), int(self.budget[piece])
        if size >= len(pattern) or len(part) < Q:
            return None
        # stretches that share enough q-grams with the region, those of the most first
        held = np.concatenate([[0], np.cumsum(np.isin(self._codes(self.piece[piece]), self._codes(part)))])
        shared = held[size - Q + 1:] - held[:len(held) - (size - Q + 1)]
        starts = np.argsort(-shared, kind="stable")
        starts = starts[:int((shared >= self.stretch_need[piece]).sum())]
        at, step = 0, 8
        while at < len(starts):
            some = starts[at:at + step]
            edits, ends = stretches(pattern, size, some, region, low, width)
            best = int(edits.argmin())
            if edits[best] <= budget:
                break
            at, step = at + step, 64
        else:
            return None
        a, used, end = int(some[best]), int(edits[best]), min(len(region), int(ends[best]))
        # where it begins: the same alignment backwards
        back = grown(pattern[a:a + size][::-1], region[:end][::-1], 0, 0, 1.0)
        begin, done = end - back[1], size
        more, j, e = grown(pattern[a + size:], region[end:], used, done, self.rate)
        end, done, used = end + j, done + more, used + e
        more, j, e = grown(pattern[:a][::-1], region[:begin][::-1], used, done, self.rate)
        begin, done, used = begin - j, done + more, used + e
        return lo + begin, lo + end, used, done / len(pattern)

    def leaks(self, text: str | None) -> list[dict]:
        """Leaks in one text, with code points of the text, by item and start."""
        data = folded(text)
        found: dict[int, list[tuple[int, int, int, float]]] = {}
        margin = 2 * self.longest + 4 * Q
        for at in range(0, max(1, len(data)), WINDOW_BYTES):
            part = data[at:at + WINDOW_BYTES + margin]
            if len(part) < Q or not self.piece:
                continue
            for piece, low, high, hits in self.bands(part):
                hit = self.verify(part, piece, low, high, hits)
                if hit is not None:
                    found.setdefault(piece, []).append((hit[0] + at, hit[1] + at, *hit[2:]))
        if not found:
            return []
        place = self._places(text)
        out = set()
        for piece, hits in found.items():
            last = None
            for hit in sorted(set(hits)):
                if last is not None and hit[0] < last[1]:  # the same stretch from two bands
                    last = min(last, hit, key=lambda h: (-h[3], h[2], h[0]))
                    continue
                if last is not None:
                    out.add((self.item[piece], *place(last[0], last[1]), *last[2:]))
                last = hit
            out.add((self.item[piece], *place(last[0], last[1]), *last[2:]))
        return [dict(zip(("item_id", "start", "end", "edits", "share"), x, strict=True)) for x in sorted(out)]

    @staticmethod
    def _places(text: str):
        raw = text.encode()
        spans = [m.span() for m in _WORD.finditer(raw)]
        starts = np.array([s for s, _ in spans], np.int64)
        lengths = np.array([e - s for s, e in spans], np.int64)
        inside = np.concatenate([[0], np.cumsum(lengths + 1)])

        def original(x: int) -> int:
            i = min(int(np.searchsorted(inside, x, side="right")) - 1, len(starts) - 1)
            return int(starts[i] + min(x - inside[i], lengths[i]))

        def place(start: int, end: int) -> tuple[int, int]:
            lo, hi = original(start), original(end - 1) + 1
            return len(raw[:lo].decode(errors="ignore")), len(raw[:hi].decode(errors="ignore"))

        return place


def _leak_rows(batches: Iterator[pa.RecordBatch], shared, path: list[str]) -> Iterator[pa.RecordBatch]:
    index = shared.value
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("share", pa.float64())]))
    for b in batches:
        found = [index.leaks(t.as_py()) for t in read_text(b, path)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["row", "leaks"])


def slices(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> Iterator[list]:
    """The items in lists of about ``slice_bytes``; the driver holds one list at a time."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= slice_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", rate: float = RATE,
               slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` of every row and ``leaks``: array of (item_id, start, end, edits, share)."""
    bound_batches(docs.sparkSession)
    sent, path = with_text(docs, keep, text_col)
    out = docs.select(F.struct(*sent).alias("doc"))
    kinds, arrays = out.schema["doc"].dataType.simpleString(), []
    for n, part in enumerate(slices(benchmark, slice_bytes=slice_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(Index(part, rate))
        before = f"struct<doc: {kinds}" + "".join(f", l{i}: {LEAKS}" for i in range(n)) + ">"
        packed = out.select(F.struct("*").alias("row"))
        out = packed.mapInArrow(lambda it, s=shared: _leak_rows(it, s, ["row", "doc", *path]), f"row {before}, leaks {LEAKS}").select("row.*", F.col("leaks").alias(f"l{n}"))
        arrays.append(f"l{n}")
    leaks = F.concat(*arrays) if arrays else F.expr(f"cast(array() as {LEAKS})")
    return out.select("doc.row.*", leaks.alias("leaks"))
