"""Token counts by a map-side two-tier lookup.

Tier one is a compact table {pre-token: number of tokens} of the corpus's frequent pre-tokens,
broadcast to every worker.  It is fitted on one row in ``SAMPLE``, chosen by a hash of the id at every size alike: each
scan task summarises the pre-tokens of its chosen rows into a bounded
list of its heaviest ones, these lists are added up (the only exchange; its size is bounded by
``SUMMARY_SIZE`` rows a task and holds no document data), and the ``TABLE_SIZE`` heaviest
overall are encoded once.  Tier two is a bounded cache inside each Python worker for the rest.
Both tiers are about speed only: a pre-token in neither is encoded by the library, so the counts
never depend on what the tables hold.

No pre-token reaches from other characters into white space, so every step from the one to the other ends a
pre-token.  Texts are cut there first, into words with the white space before them, and only
distinct words are split into pre-tokens, unless they are ASCII letters behind at most one blank, which are one
pre-token; a worker also remembers the sums of the words it has met.  A pre-token met as a word is split into itself, so
one cache holds both.

Defined cases: null text is the empty text (0 bytes, 0 tokens); special strings inside a text
count as the library counts them by default (one special token); texts that hold a character
the installed regex and tokenizer libraries may classify differently go whole through the
tokenizer; repeated rows are counted separately; extra columns are ignored.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import bound_batches

TABLE_SIZE = 32_768  # entries of the broadcast table
SAMPLE = 16  # one row in so many is summarised for the table; counts do not depend on it
SUMMARY_SIZE = 8_192  # heaviest pre-tokens each task reports
COUNTER_SIZE = 400_000  # distinct words a task holds before it splits them, and pre-tokens before it forgets its rarest
CACHE_SIZE = 1_000_000  # entries of a worker's cache, pre-tokens and words
CACHED_CHARS = 64  # longer pre-tokens are encoded but not kept
SLICE_CHARS = 1_000_000  # texts handled together

#: Fixed value: the split pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: A word with the white space before it; the white space at the end of a text.
WORD = re.compile(r"\s*\S+|\s+")

#: A word that is one pre-token by the first alternative for letters.
SINGLE = re.compile(r" ?[A-Za-z]+").fullmatch


class ByteLevelCounter:
    """The tokenizer of one worker with its cache, the special strings and the split pattern."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("the two-tier lookup needs a plain byte-level pre-tokenizer without prefix space")
        added = spec.get("added_tokens") or []
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("added tokens that strip their surroundings are not supported")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.pieces = regex.compile(PATTERN).findall
        # code points that Unicode versions may class differently: unassigned or private ones, and the
        # ASCII separators that some engines count as white space
        self.doubtful = regex.compile(r"[\p{Cn}\p{Co}\x1c-\x1f\x85᠎]|[^\x00-\U0001ffff]")
        self.plain: set[str] = set()

    def words(self, text: str) -> tuple[list[str], int] | None:
        """Words of the text and the number of special tokens; None: encode it whole."""
        for c in set(text) - self.plain:  # each character is looked at once in a worker's life
            if self.doubtful.match(c):
                return None
            self.plain.add(c)
        if self.specials is None or not self.specials.search(text):
            return WORD.findall(text), 0
        parts = self.specials.split(text)
        return [w for part in parts for w in WORD.findall(part)], len(parts) - 1

    def split(self, word: str) -> list[str]:
        """The pre-tokens of a word."""
        return [word] if SINGLE(word) else self.pieces(word)

    def lengths(self, pieces: list[str]) -> list[int]:
        return list(map(len, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)))


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> ByteLevelCounter:
    return ByteLevelCounter(path)


@contextlib.contextmanager
def _no_cycle_search():
    """Lists of words form no cycles; searching them for some took a sixth of the time."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts, about ``SLICE_CHARS`` characters together."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS or i == len(texts) - 1:
            yield texts[lo:i + 1]
            lo, size = i + 1, 0


def _summaries(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter, words, found = _counter(path), Counter(), Counter()

    def split_words() -> None:
        nonlocal found
        for word, n in words.items():
            for p in counter.split(word):
                found[p] += n
        words.clear()
        if len(found) > COUNTER_SIZE:
            found = Counter(dict(found.most_common(COUNTER_SIZE // 2)))

    for batch in batches:
        with _no_cycle_search():
            for text in batch.column(0):
                got = counter.words(text.as_py() or "")
                if got is not None:
                    words.update(got[0])
                if len(words) > COUNTER_SIZE:
                    split_words()
    split_words()
    top = [(p, n) for p, n in found.most_common(SUMMARY_SIZE) if len(p) <= CACHED_CHARS]
    yield pa.record_batch({"piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})


def frequent_pieces(docs: DataFrame, text: str, path: str) -> dict[str, int]:
    """The broadcast tier, from the chosen rows of ``docs``: at most ``TABLE_SIZE`` pre-tokens of at most ``CACHED_CHARS`` characters."""
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    heavy = (chosen.select(F.col(text)).where(F.col(text).isNotNull())
             .mapInArrow(lambda it: _summaries(it, path), "piece string, n long")
             .groupBy("piece").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "piece").limit(TABLE_SIZE).select("piece").toArrow())
    pieces = heavy.column("piece").to_pylist()
    return dict(zip(pieces, _counter(path).lengths(pieces), strict=True))


_CACHES: dict[str, dict[str, int]] = {}  # by tokenizer file: a worker's lengths of pre-tokens (tier one and since) and words


def _count_slice(texts: list[str], path: str, table: dict[str, int]) -> list[int]:
    counter = _counter(path)
    cache = _CACHES.get(path)
    if cache is None or len(cache) > TABLE_SIZE + CACHE_SIZE:
        cache = _CACHES[path] = dict(table)
    found = [counter.words(t) for t in texts]
    new = {w for f in found if f is not None for w in f[0]} - cache.keys()
    several = {w: counter.pieces(w) for w in new if not SINGLE(w)}
    missing = list((new - several.keys()).union(*several.values()) - cache.keys())
    cache.update(zip(missing, counter.lengths(missing), strict=True))
    for w, pieces in several.items():
        cache[w] = sum([cache[p] for p in pieces])
    out = [len(counter.tokenizer.encode(t, add_special_tokens=False).ids) if f is None else f[1] + sum(map(cache.__getitem__, f[0]))
           for t, f in zip(texts, found, strict=True)]
    for key in {k for k in (*missing, *several) if len(k) > CACHED_CHARS}:  # long ones are not kept
        del cache[key]
    return out


def _counts(batches: Iterator[pa.RecordBatch], path: str, shared) -> Iterator[pa.RecordBatch]:
    table = shared.value
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column(1)]
        with _no_cycle_search():
            counts = [n for part in _slices(texts) for n in _count_slice(part, path, table)]
        yield pa.record_batch({"doc_id": batch.column(0), "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                               "n_tokens": pa.array(counts, pa.int64())})


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``; two scans, of which the first works on a sample, no exchange of texts or
    of their pre-tokens.  ``tokenizer_path`` must exist on every executor."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(rows, "text", tokenizer_path))
    counted = rows.mapInArrow(lambda it: _counts(it, tokenizer_path, table), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
