"""Secret scan with multipart credential linking, in SQL functions only.

Base findings are the three patterns of the contract.  The method adds what is too weak alone: access
identifiers (``ident``), unlabelled secrets (``weak``) and endpoints (``endpoint``).  Each text gives the spans of
all kinds; spans are then interval-joined inside a scope of ``SCOPE`` code points of the same text:

* an identifier (or a base access key) and a secret (weak, or a base assignment or hex run) in one
  scope link; both sides are then reported,
* an endpoint is reported when it lies in the scope of either side of a link.

The join runs on (text, bin): a span is entered in every bin of ``SCOPE`` code points it touches, so
partners meet in one bin and a bin holds a bounded number of spans, however long the text.

Positions come from splitting the text at a pattern: the pieces and matches before a match add up to its
start, as a running sum over the exploded rows.

Defined cases: null text is empty (counts 0, the digest of nothing, no spans); repeated rows give the same
result each; a null id is kept; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleaner.llm.tables import materialise

SCOPE = 200  # code points between parts of one credential

#: The patterns of the base findings, and the least lengths of what they match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_VALUE = 6

#: Parts that count only in company.
IDENT = r"""(?i)\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
WEAK = r"""(?i)\b(?:pwd|passphrase|auth|credentials?|private_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|(?<![A-Za-z0-9+/=])(?=[A-Za-z+/]*[0-9])(?=[0-9+/]*[A-Za-z])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=])"""
ENDPOINT = r"""https?://[^\s"'<>]+"""

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")


def _found(kind: str, pattern: str, guard: Column, value_group: int = 0) -> Column:
    """array<struct<kind, i, gap, size, value>> of a pattern's matches: the text before each one since the last, its
    size and its value's size, in code points.  ``guard``: cheap test that a match is possible."""
    text = F.when(guard, F.col("text"))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"))
    rows = F.transform(zipped, lambda x, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
                                                     F.length(x["match"]).alias("size"), F.length(x["value"]).alias("value")))
    return F.coalesce(F.filter(rows, lambda x: x["size"].isNotNull()), F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,value:int>>"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and two hashes that name a row's id and text; equal rows share them."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64("text", F.lit(1), "doc_id"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, kind, start, end) of the base findings and of all candidate parts."""
    rows = _keyed(docs, id_col, text_col)
    low = F.lower("text")
    word = F.lit(False)
    for w in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        word = word | F.contains(low, F.lit(w))
    t = F.col("text")
    found = F.concat(
        _found("assign", ASSIGN, word, 2),
        _found("access", ACCESS, F.contains(t, F.lit("AKIA"))),
        _found("hex", HEX, t.rlike(r"[0-9a-f]{24}")),
        _found("ident", IDENT, t.rlike(r"[:=]") & low.rlike(r"user|login|account|client|access")),
        _found("weak", WEAK, t.rlike(r"[A-Za-z0-9+/]{32}") | t.rlike(r"[:=]") & low.rlike(r"pwd|pass|auth|cred|private")),
        _found("endpoint", ENDPOINT, F.contains(t, F.lit("://"))),
    )
    parts = rows.select("k1", "k2", F.explode(found).alias("x")).select("k1", "k2", "x.*")
    # equal rows give equal parts; one copy is enough
    parts = parts.repartition("k1").dropDuplicates(["k1", "k2", "kind", "i"])
    before = W.partitionBy("k1", "k2", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(before)
    placed = parts.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    return placed.where(f"kind <> 0 or value >= {ASSIGN_VALUE}").select("k1", "k2", "kind", "start", "end")


def _binned(spans: DataFrame, reach: int, prefix: str) -> DataFrame:
    bins = F.sequence(F.floor((F.col("start") - reach) / SCOPE), F.floor((F.col("end") + reach) / SCOPE))
    return spans.select("k1", "k2", F.explode(bins).alias("bin"), *[F.col(c).alias(prefix + c) for c in ("kind", "start", "end")])


def link_parts(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The candidate parts that complementary parts support: (k1, k2, kind, start, end), each once."""
    near = F.greatest("a_start", "b_start") - F.least("a_end", "b_end") <= scope
    apart = (F.col("a_end") <= F.col("b_start")) | (F.col("b_end") <= F.col("a_start"))
    ident = _binned(spans.where("kind in (1, 3)"), scope, "a_")
    secret = _binned(spans.where("kind in (0, 2, 4)"), 0, "b_")
    links = ident.join(secret, ["k1", "k2", "bin"]).where(near & apart)
    sides = (links.select("k1", "k2", F.col("a_kind").alias("kind"), F.col("a_start").alias("start"), F.col("a_end").alias("end"))
             .union(links.select("k1", "k2", "b_kind", "b_start", "b_end")).distinct())
    endpoints = _binned(spans.where("kind = 5"), scope, "a_").join(_binned(sides, 0, "b_"), ["k1", "k2", "bin"]).where(near)
    return (sides.where("kind > 2")
            .union(endpoints.select("k1", "k2", F.col("a_kind"), F.col("a_start"), F.col("a_end")).distinct()))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(k1, k2, base, added): the reported spans of every row with any, as arrays of (start, kind, end)."""
    spans = materialise(find_spans(docs, id_col, text_col), "spans")
    reported = spans.where("kind < 3").union(link_parts(spans, scope))
    span = F.struct("start", "kind", "end")
    return reported.groupBy("k1", "k2").agg(F.collect_list(F.when(F.col("kind") < 3, span)).alias("base"), F.collect_list(F.when(F.col("kind") >= 3, span)).alias("added"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``docs``."""
    found = scan(docs, id_col, text_col)
    rows = _keyed(docs, id_col, text_col).select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    base, added = F.coalesce("base", none), F.coalesce("added", none)

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return rows.select("doc_id", count(0), count(1), count(2), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.concat(base, added)).alias("spans"))


def redact(docs: DataFrame, mark: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every reported span (overlapping ones as one) replaced by ``mark``; columns unchanged otherwise."""
    doc = F.struct(*[F.col(c) for c in docs.columns]).alias("doc")
    rows = docs.select(doc, F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("k1"),
                       F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(1), F.col(id_col).cast("long")).alias("k2"))
    found = scan(docs, id_col, text_col).select("k1", "k2", F.array_sort(F.concat("base", "added")).alias("spans"))
    joined = rows.join(found, ["k1", "k2"], "left")
    text = F.col(f"doc.{text_col}")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, x: Column) -> Column:
        plain = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int"))
        out = F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], plain, F.lit(mark)))
        return F.struct(out.alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    clean = F.when(F.col("spans").isNull(), text).otherwise(F.aggregate("spans", start, step, finish))
    return joined.select(F.col("doc").withField(text_col, clean).alias("doc")).select("doc.*")
