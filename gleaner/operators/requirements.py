"""Admission-exam requirements: EXM1-EXM8.

The section is a token sequence (text nodes at even positions).  Markers split it:
an AND marker closes a *block*; a block's first token selects its stage (single
choice, group choice, or all mandatory); inside a group-choice block an OR
marker starts a new group.  Everything is running counts over the token order
of one page's section, in windows that Spark sorts and spills.

Flat outputs:
  optional  (keys..., conjunct_no, group_no, pos, code, name)   AND of ORs of AND-groups
  mandatory (keys..., pos, code, name)

``mode="intended"`` keeps every optional exam; ``mode="as_written"`` keeps only the last
optional exam of each page, which is what the original loop produces because its
append branch is never reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import parse_exam
from gleaner.presets import ExamPreset


def mark_tokens(tokens: DataFrame, text_col: str = "text", preset: ExamPreset = ExamPreset()) -> DataFrame:
    """EXM2: exact marker texts -> flags."""
    return tokens.withColumn("is_and", F.col(text_col) == F.lit(preset.and_marker)).withColumn(
        "is_or", F.col(text_col) == F.lit(preset.or_marker)
    )


def requirement_blocks(tokens: DataFrame, keys, order_col: str, text_col: str = "text", preset: ExamPreset = ExamPreset()) -> DataFrame:
    """EXM2-EXM5: per token its block, stage, whether it is an exam, and its group key."""
    keys = list(keys)
    t = mark_tokens(tokens, text_col, preset)
    w = Window.partitionBy(*keys).orderBy(order_col)
    t = t.withColumn(
        "block",
        F.coalesce(F.sum(F.col("is_and").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    wb = Window.partitionBy(*keys, "block").orderBy(order_col)
    first_text = F.first(F.col(text_col)).over(wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    t = t.withColumn(
        "stage",
        F.when(first_text == F.lit(preset.single_choice), F.lit("single"))
        .when(first_text == F.lit(preset.group_choice), F.lit("group"))
        .otherwise(F.lit("mandatory")),
    ).withColumn("first_in_block", F.row_number().over(wb) == 1)
    is_header = F.col("first_in_block") & (F.col("stage") != "mandatory")
    t = t.withColumn("is_exam", ~F.col("is_and") & ~F.col("is_or") & ~is_header)
    t = t.withColumn("or_count", F.sum(F.col("is_or").cast("int")).over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn(
        "group_key",
        F.when(F.col("stage") == "single", F.col(order_col).cast("long")).otherwise(F.col("or_count").cast("long")),
    )
    return t.withColumn("exam", F.when(F.col("is_exam"), parse_exam(F.col(text_col))))


def _windowed(t: DataFrame, keys, order_col: str, text_col: str, mode: str, preset: ExamPreset):
    """Per-document path: window functions over one page's (conversation's) tokens."""
    t = requirement_blocks(t, keys, order_col, text_col, preset).filter(F.col("exam").isNotNull())
    mand = t.filter(F.col("stage") == "mandatory").select(
        *keys,
        (F.row_number().over(Window.partitionBy(*keys).orderBy(order_col)) - 1).alias("pos"),
        F.col("exam.code").alias("code"),
        F.col("exam.name").alias("name"),
    )
    opt = t.filter(F.col("stage") != "mandatory")
    if mode == "as_written":
        return _as_written(opt, keys, order_col), mand
    opt = opt.select(
        *keys,
        (F.dense_rank().over(Window.partitionBy(*keys).orderBy("block")) - 1).alias("conjunct_no"),
        (F.dense_rank().over(Window.partitionBy(*keys, "block").orderBy("group_key")) - 1).alias("group_no"),
        (F.row_number().over(Window.partitionBy(*keys, "block", "group_key").orderBy(order_col)) - 1).alias("pos"),
        F.col("exam.code").alias("code"),
        F.col("exam.name").alias("name"),
    )
    return opt, mand


def _as_written(opt: DataFrame, keys, order_col: str) -> DataFrame:
    last = opt.groupBy(*keys).agg(F.max_by(F.col("exam"), F.col(order_col)).alias("exam"))
    return last.select(
        *keys, F.lit(0).alias("conjunct_no"), F.lit(0).alias("group_no"), F.lit(0).alias("pos"),
        F.col("exam.code").alias("code"), F.col("exam.name").alias("name"),
    )


def exam_requirements(tokens: DataFrame, keys, order_col: str, text_col: str = "text", mode: str = "intended",
                      preset: ExamPreset = ExamPreset()) -> tuple[DataFrame, DataFrame]:
    """EXM6/EXM7: (optional_flat, mandatory_flat); empty groups and conjuncts vanish.

    Windows over one key's tokens: a key is a page's exam section, which Spark sorts and spills
    like any window partition."""
    if mode not in ("intended", "as_written"):
        raise ValueError(f"unknown mode {mode!r}")
    return _windowed(tokens, list(keys), order_col, text_col, mode, preset)


def nest_optional(optional_flat: DataFrame, keys) -> DataFrame:
    """Flat optional rows -> ARRAY<ARRAY<ARRAY<STRUCT<code,name>>>> per key (per page, bounded)."""
    keys = list(keys)
    e = F.struct("code", "name")
    groups = optional_flat.groupBy(*keys, "conjunct_no", "group_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("o"), e.alias("v")))), lambda x: x["v"]).alias("g")
    )
    conj = groups.groupBy(*keys, "conjunct_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("group_no").alias("o"), F.col("g").alias("v")))), lambda x: x["v"]).alias("c")
    )
    return conj.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("conjunct_no").alias("o"), F.col("c").alias("v")))), lambda x: x["v"]).alias("optional")
    )


def flatten_optional(nested: DataFrame, keys, col: str = "optional") -> DataFrame:
    """EXM7: nested optional exams -> exam rows (conjunct, group, pos)."""
    keys = list(keys)
    c = nested.select(*keys, F.posexplode(col).alias("conjunct_no", "c"))
    g = c.select(*keys, "conjunct_no", F.posexplode("c").alias("group_no", "g"))
    e = g.select(*keys, "conjunct_no", "group_no", F.posexplode("g").alias("pos", "e"))
    return e.select(*keys, "conjunct_no", "group_no", "pos", F.col("e.code").alias("code"), F.col("e.name").alias("name"))
