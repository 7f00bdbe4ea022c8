"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a tree of contexts made of the 0 to ``DEPTH``
preceding bytes.  Every node holds the Krichevsky-Trofimov estimate of its zeros and ones in the
training texts, and mixes it, half and half, with the product of its children:

    Pw(s) = 1/2 KT(s) + 1/2 prod Pw(children),   Pw = KT at full depth

so every depth takes part in each prediction with the weight the training data give it.  The counts
of (context, byte) grams are summed over the corpus.  The tree is cut at ``CUT`` context bytes: what lies below
is dealt out by those bytes, whole subtrees together, and folded to the cut with numpy (log KT in closed form from
the counts); what lies above is folded to the root by Spark aggregates.  The mixture is then handed down from the root
to the cut by joins, and below it to full depth in the subtrees' tasks, which gives each bit's probability.

No model is broadcast, since it grows with the corpus.  Texts are dealt into batches of about
``BATCH_BYTES``; a batch asks once for each distinct gram (and each distinct token of the base
model) it holds, and gets the answers back by its number, so memory depends on the batch alone and what
crosses the network on the number of batches.

The bytes scored are the text's UTF-8 bytes with A-Z in lower case and one end byte (0); contexts before
the start are zeros.  ``base_score`` is the smoothed unigram score named in the contract.

Defined cases: null text is empty and scores its end alone; a context never seen in training
predicts 1/2 for each bit, by the formula itself; with no training text at all every bit has
probability 1/2; a null id is a training row; repeated rows count as often as they occur; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleaner.llm.tables import bound_batches, materialise, total_bytes

DEPTH = 5  # context bytes; a gram of DEPTH + 1 bytes must fit a long
CUT = 3  # context bytes by which subtrees are dealt out
BUCKET_GRAMS = 250_000  # distinct grams, about, of the subtrees that are folded together
BATCH_BYTES = 40_000_000
SLICE_BYTES = 1_000_000  # bytes whose grams are sorted at once
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
END = b""  # the base model's end token


def _lowered(column: pa.ChunkedArray) -> Iterator[bytes]:
    """The texts of a column as bytes, one at a time, so that no second copy of a batch is held."""
    for text in column:
        yield (text.as_py() or "").encode().lower()


def _grams(data: bytes, depth: int) -> np.ndarray:
    """The (context, byte) grams of one prepared text, end byte included: the context from its last byte
    to its first, the last one in the highest bits, and the byte in the lowest."""
    padded = np.frombuffer(bytes(depth) + data + b"\0", np.uint8).astype(np.uint64)
    n = len(padded) - depth
    out = np.zeros(n, np.uint64)
    for i in [*range(depth - 1, -1, -1), depth]:
        out = (out << np.uint64(8)) | padded[i:i + n]
    return out


def _distinct_grams(texts: Iterable[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams of all texts and their counts."""
    uniq, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held: list[np.ndarray] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return _merged(uniq, count, *np.unique(np.concatenate(held), return_counts=True)) if held else (uniq, count)

    for data in texts:
        held.append(_grams(data, depth))
        size += len(held[-1])
        if size >= SLICE_BYTES:
            uniq, count = merged()
            held, size = [], 0
    return merged()


def _merged(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of distinct grams and their counts as one."""
    at = np.minimum(np.searchsorted(a, b), max(0, len(a) - 1))
    known = a[at] == b if len(a) else np.zeros(len(b), bool)
    n = n.copy()
    n[at[known]] += m[known]
    both = np.concatenate([a, b[~known]])
    order = np.argsort(both, kind="stable")
    return both[order], np.concatenate([n, m[~known]])[order]


class _Lookup:
    """Position of grams in a sorted list that holds them all: one hashed slot first, binary search for the rest."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        bits = max(8, int(np.ceil(np.log2(4 * len(grams) + 1))))
        self.shift = np.uint64(64 - bits)
        self.slot = np.zeros(1 << bits, np.int32)
        self.slot[(grams * _MULTIPLIER) >> self.shift] = np.arange(len(grams), dtype=np.int32)

    def __call__(self, g: np.ndarray) -> np.ndarray:
        at = self.slot[(g * _MULTIPLIER) >> self.shift]
        miss = np.flatnonzero(self.grams[at] != g)
        at[miss] = np.searchsorted(self.grams, g[miss])
        return at


def _requests(table: pa.Table, depth: int) -> pa.Table:
    """What one batch holds: its distinct tokens (sorted) and grams (sorted), with their training counts."""
    text = table.column("text")
    train = [not h for h in table.column("held_out").to_pylist()]
    tokens: Counter = Counter()
    for data, w in zip(_lowered(text), train, strict=True):
        words = data.split()
        words.append(END)
        if w:
            tokens.update(words)
        else:
            for x in words:
                tokens.setdefault(x, 0)
    names = sorted(tokens)
    grams, n = _distinct_grams((t for t, w in zip(_lowered(text), train, strict=True) if w), depth)
    other, none = _distinct_grams((t for t, w in zip(_lowered(text), train, strict=True) if not w), depth)
    grams, n = _merged(grams, n, other, np.zeros_like(none))
    batch = table.column("batch")[0].as_py()
    size = len(names) + len(grams)
    return pa.table({
        "batch": pa.array(np.full(size, batch, np.int32)),
        "at": pa.array(np.concatenate([np.arange(len(names)), np.arange(len(grams))]).astype(np.int32)),
        "token": pa.array(names + [None] * len(grams), pa.binary()),
        "gram": pa.concat_arrays([pa.nulls(len(names), pa.int64()), pa.array(grams.astype(np.int64))]),
        "n": pa.array(np.concatenate([np.fromiter((tokens[x] for x in names), np.int64, len(names)), n])),
    })


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: Stirling's series at x + 8 less the logarithm of the eight factors."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5)))
    factors = F.log(x)
    for i in range(1, 8):
        factors = factors + F.log(x + i)
    return series - factors


def _log_kt(a: Column, b: Column) -> Column:
    """ln of the KT probability of a zeros and b ones in some order."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1.0)


def _ln_gamma(x: np.ndarray) -> np.ndarray:
    """``_log_gamma`` of an array."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    product = x.copy()
    for i in range(1, 8):
        product *= x + i
    return series - np.log(product)


@functools.lru_cache(maxsize=1)
def _small_gammas() -> tuple[np.ndarray, np.ndarray]:
    """ln Gamma(n + 1/2) and ln Gamma(n + 1) for small n."""
    n = np.arange(1 << 16, dtype=np.float64)
    return _ln_gamma(n + 0.5), _ln_gamma(n + 1.0)


def _ln_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_log_kt`` of arrays of counts."""
    half, whole = _small_gammas()
    total = a + b
    last = len(half) - 1
    out = half[np.minimum(a, last)] + half[np.minimum(b, last)] - whole[np.minimum(total, last)] - math.log(math.pi)
    big = np.flatnonzero(total > last)
    if len(big):
        x, y = a[big].astype(np.float64), b[big].astype(np.float64)
        out[big] = _ln_gamma(x + 0.5) + _ln_gamma(y + 0.5) - math.log(math.pi) - _ln_gamma(x + y + 1.0)
    return out


class _Level:
    """The nodes of one bit at one depth: runs of equal prefixes in the depth's sorted grams."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, i: int):
        prefix = grams >> (8 - i)
        new = np.ones(len(grams), bool)
        new[1:] = prefix[1:] != prefix[:-1]
        self.start = np.flatnonzero(new)
        self.run = np.cumsum(new) - 1  # node of each gram
        self.b = np.add.reduceat(n * ((grams >> (7 - i)) & 1), self.start)
        self.a = np.add.reduceat(n, self.start) - self.b
        self.lpe = _ln_kt(self.a, self.b)
        self.lpw, self.w, self.up = self.lpe, np.ones(len(self.lpe)), None
        self.kt = (self.b + 0.5) / (self.a + self.b + 1.0)

    def fold(self, below: _Level, row_up: np.ndarray) -> None:
        """Mixes in the nodes one byte deeper; ``row_up``: the gram here that each gram there shortens to."""
        below.up = self.run[row_up[below.start]]
        product = np.bincount(below.up, below.lpw, len(self.lpe))
        self.lpw = math.log(0.5) + np.logaddexp(self.lpe, product)
        self.w = np.exp(math.log(0.5) + self.lpe - self.lpw)


class _Subtrees:
    """The subtrees below ``cut`` context bytes of some distinct grams of ``depth`` bytes of context, bit by bit."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int, cut: int):
        order = np.argsort(grams, kind="stable")
        self.grams, self.counts, self.row_up = [grams[order]], [n[order]], []
        for _ in range(depth - cut):  # each time without the context's first byte, the one above the predicted byte
            g = self.grams[-1]
            short, up = np.unique(((g >> 16) << 8) | (g & 255), return_inverse=True)
            self.grams.append(short)
            self.counts.append(np.bincount(up, self.counts[-1], len(short)).astype(np.int64))
            self.row_up.append(up)

    def bit(self, i: int) -> list[_Level]:
        """The folded levels of one bit, from full depth to the cut."""
        levels = [_Level(g, n, i) for g, n in zip(self.grams, self.counts, strict=True)]
        for below, level, row_up in zip(levels, levels[1:], self.row_up, strict=False):
            level.fold(below, row_up)
        return levels

    def nodes(self, top: _Level, i: int) -> np.ndarray:
        """Names of the nodes at the cut: the context, then the bits of the byte so far behind a 1."""
        g = self.grams[-1][top.start]
        return ((g >> 8) << 8) | (1 << i) | ((g & 255) >> (8 - i))


_ROOTS = "node long, a long, b long, lpw double"


def _fold_subtrees(table: pa.Table, depth: int, cut: int) -> pa.Table:
    """(gram, n) of whole subtrees to their nodes at the cut."""
    trees = _Subtrees(table.column("gram").to_numpy(), table.column("n").to_numpy(), depth, cut)
    parts = []
    for i in range(8):
        top = trees.bit(i)[-1]
        parts.append(pa.table({"node": trees.nodes(top, i), "a": top.a, "b": top.b, "lpw": top.lpw}))
    return pa.concat_tables(parts)


def _descend(table: pa.Table, above: pa.Table, depth: int, cut: int) -> pa.Table:
    """(gram, n) of whole subtrees, and what their nodes at the cut get from above (p: the mixture so far, r: the
    weight left), to (gram, lp): log10 of the probability of each gram's byte after its context."""
    trees = _Subtrees(table.column("gram").to_numpy(), table.column("n").to_numpy(), depth, cut)
    order = np.argsort(above.column("node").to_numpy())
    names = above.column("node").to_numpy()[order]
    p_above, r_above = above.column("p").to_numpy()[order], above.column("r").to_numpy()[order]
    grams = trees.grams[0]
    lp = np.zeros(len(grams))
    for i in range(8):
        levels = trees.bit(i)
        at = np.searchsorted(names, trees.nodes(levels[-1], i))
        p, r = p_above[at], r_above[at]
        for level in reversed(levels):
            if level.up is not None:
                p, r = p[level.up], r[level.up]
            p, r = p + r * level.w * level.kt, r * (1 - level.w)
        p = p[levels[0].run]
        lp += np.log10(np.where((grams >> (7 - i)) & 1 == 1, p, 1 - p))
    return pa.table({"gram": grams, "lp": lp})


def _shorter() -> Column:
    """The node one context byte above ``node``."""
    return F.shiftleft(F.shiftright("node", 16), 8).bitwiseOR(F.col("node").bitwiseAND(255))


def from_above(roots: DataFrame, cut: int) -> DataFrame:
    """(node, p, r): what each node at the cut gets from the levels above it; ``roots``: the folded nodes there."""
    half = math.log(0.5)
    levels = [roots]
    for d in range(cut - 1, -1, -1):
        up = (levels[0].groupBy(_shorter().alias("node")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("lpw").alias("below"))
              .withColumn("lpe", _log_kt(F.col("a"), F.col("b"))))
        high, low = F.greatest("lpe", "below"), F.least("lpe", "below")
        up = up.withColumn("lpw", half + high + F.log1p(F.exp(low - high))).withColumn("w", F.exp(half + F.col("lpe") - F.col("lpw")))
        levels.insert(0, materialise(up.select("node", "a", "b", "lpw", "w"), f"ctw-{d}"))
    kt = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1.0)
    down = levels[0].select("node", (F.col("w") * kt).alias("p"), (1 - F.col("w")).alias("r"))
    for level in levels[1:-1]:
        here = level.select("node", "w", kt.alias("kt"), _shorter().alias("up"))
        down = (here.join(down.select(F.col("node").alias("up"), "p", "r"), "up")
                .select("node", (F.col("p") + F.col("r") * F.col("w") * F.col("kt")).alias("p"), (F.col("r") * (1 - F.col("w"))).alias("r")))
    return (roots.select("node", _shorter().alias("up")).join(down.select(F.col("node").alias("up"), "p", "r"), "up")
            .select("node", "p", "r"))


def gram_log10(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, lp): log10 of the probability of each gram's byte after its context.  ``grams``: a written table of
    (gram, n), with every gram that is asked for; n may be 0."""
    cut = min(CUT, depth)
    buckets = 1 + grams.count() // BUCKET_GRAMS

    def dealt(context: Column) -> Column:
        return F.pmod(F.xxhash64(context), F.lit(buckets)).alias("bucket")

    trees = grams.select("gram", "n", dealt(F.shiftright("gram", 8 * (depth - cut + 1)))).groupBy("bucket")
    roots = materialise(trees.applyInArrow(lambda t: _fold_subtrees(t, depth, cut), _ROOTS), "ctw-roots")
    above = from_above(roots, cut).select("node", "p", "r", dealt(F.shiftright("node", 8)))
    return trees.cogroup(above.groupBy("bucket")).applyInArrow(lambda t, u: _descend(t, u, depth, cut), "gram long, lp double")


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, n_bytes long, score double"


def _scores(table: pa.Table, answers: pa.Table, depth: int, n_train: int, n_distinct: int) -> pa.Table:
    """Scores of one batch: the answers come by position in its sorted distinct tokens and grams."""
    text = table.column("text")
    words = sorted({w for data in _lowered(text) for w in data.split()} | {END}) if len(text) else []
    grams, _ = _distinct_grams(_lowered(text), depth)
    token = answers.column("is_token").to_numpy(zero_copy_only=False)
    at, value = answers.column("at").to_numpy(), answers.column("value").to_numpy()
    c = np.zeros(len(words))
    c[at[token]] = value[token]
    lp = np.zeros(len(grams))
    lp[at[~token]] = value[~token]
    count = dict(zip(words, c.tolist(), strict=True))
    find = _Lookup(grams)
    total = math.log10(n_train + 0.5 * (n_distinct + 1))
    n_tokens, n_known, n_bytes, base, score = [], [], [], [], []
    for data in _lowered(text):
        own = data.split()
        own.append(END)
        found = np.fromiter(map(count.__getitem__, own), np.float64, len(own))
        n_bytes.append(len(data))
        n_tokens.append(len(own))
        n_known.append(int((found > 0).sum()))
        base.append(float(np.log10(found + 0.5).sum() - total * len(own)))
        score.append(float(lp[find(_grams(data, depth))].sum()))
    return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": pa.array(n_tokens, pa.int64()),
                     "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([n_train] * len(text), pa.int64()),
                     "base_score": pa.array(base, pa.float64()), "n_bytes": pa.array(n_bytes, pa.int64()), "score": pa.array(score, pa.float64())})


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Scores of every row of ``docs``; ``held_out``: a boolean column, true for rows not to learn from.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, n_bytes, score, bits_per_byte (code length of
    the model, the end byte included)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    n_batches = 1 + total_bytes(rows, "text") // batch_bytes
    batched = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).cast("int"))
    asked = materialise(batched.groupBy("batch").applyInArrow(lambda t: _requests(t, depth), "batch int, at int, token binary, gram long, n long"), "ctw-asked")

    by_token = W.partitionBy("token")
    tokens = materialise(asked.where("token is not null").select(
        "batch", "at", F.sum("n").over(by_token).alias("c"),
        (F.col("batch") == F.min("batch").over(by_token)).alias("first"), "n"), "ctw-tokens")
    n_train, n_distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("first") & (F.col("c") > 0), 1))).first()

    requests = asked.where("gram is not null").select("batch", "at", "gram", "n")
    grams = materialise(requests.groupBy("gram").agg(F.sum("n").alias("n")), "ctw-grams")
    lp = gram_log10(grams, depth)
    answers = (tokens.select("batch", "at", F.lit(True).alias("is_token"), F.col("c").cast("double").alias("value"))
               .union(requests.join(lp, "gram").select("batch", "at", F.lit(False), "lp")))
    scored = batched.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lambda t, a: _scores(t, a, depth, n_train, n_distinct), _SCORED)
    return scored.withColumn("bits_per_byte", -F.col("score") * math.log2(10) / (F.col("n_bytes") + 1))
