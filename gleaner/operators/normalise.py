"""Filters, gates and normalisation into the catalogue tables: FLT1-FLT5, NRM1-NRM10.

"Insert or get, first wins" becomes one aggregation per table:
``groupBy(key).agg(min_by(row, order))`` with a total order; the aggregate is
partial (map-side), so a key repeated on a third of all pages costs no more
than any other key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.lists import join_list
from gleaner.operators.ordering import global_ordinal
from gleaner.session import written


def drop_failed(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """FLT1: (ok rows, quarantined rows) split on an error column."""
    if error_col not in df.columns:
        return df, df.limit(0)
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())


def require(df: DataFrame, cols) -> DataFrame:
    """FLT2/FLT4: keep rows whose every listed column is present."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def lookup(df: DataFrame, col: str, value) -> DataFrame:
    """FLT5: point lookup, first row by equality (the set form of this is a join)."""
    return df.filter(F.col(col) == F.lit(value)).limit(1)


def first_wins(df: DataFrame, keys, order_cols, value_cols=None) -> DataFrame:
    """NRM1: one row per key: the row that comes first in ``order_cols`` (make it total).
    Existing rows are never updated by later ones."""
    keys = list(keys)
    order_cols = list(order_cols)
    value_cols = [c for c in (value_cols or df.columns) if c not in keys]
    row = F.struct(*[F.col(c).alias(c) for c in value_cols])
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.min_by(row, order).alias("_row"))
    return agg.select(*keys, *[F.col("_row." + c).alias(c) for c in value_cols])


def with_rowid(df: DataFrame, order_cols, out_col: str = "rowid") -> DataFrame:
    """NRM10: 1-based surrogate key by first appearance (skew-safe global ordinal)."""
    return global_ordinal(df, order_cols, out_col)


WON_COLUMNS = ("institution_code", "course_code", "course_name", "ects", "duration_unit", "duration_amount", "cnaef_code", "cnaef_name",
               "degree", "education_type", "contest")
ENTRY_INSTITUTION_REQUIRED = ("institution_code", "institution_name", "address", "phone_numbers", "email_addresses")


def build_catalogue(entries: DataFrame, optional: DataFrame, mandatory: DataFrame, order_cols=("seq", "page_id"),
                    existing_facts: DataFrame | None = None) -> dict:
    """NRM2-NRM9: entries (one row per page) + flat exam rows -> the catalogue tables.

    Order per page follows the loader: institution, fact, duration unit, duration, CNAEF,
    optional exams, mandatory exams.  A page whose fact pair already exists loses all
    its dependants (NRM3) but its institution still counted (NRM2).  ``existing_facts``
    (incremental runs) are pairs stored by earlier batches: they win over this batch.
    """
    order_cols = list(order_cols)
    passing = require(entries, ENTRY_INSTITUTION_REQUIRED)

    institutions = first_wins(
        passing.select(
            F.col("institution_code").alias("code"),
            F.col("institution_name").alias("name"),
            join_list("address").alias("address"),
            join_list("phone_numbers").alias("phone_numbers"),
            join_list("email_addresses").alias("email_addresses"),
            *order_cols,
        ),
        ["code"], order_cols, ["name", "address", "phone_numbers", "email_addresses"],
    )

    with_ects = passing.filter(F.col("ects").isNotNull())
    winners = first_wins(
        with_ects.select("institution_code", "course_code", "page_id", *[c for c in order_cols if c != "page_id"]),
        ["institution_code", "course_code"], order_cols, ["page_id"],
    )
    if existing_facts is not None:
        stored = existing_facts.select(F.col("institution").alias("institution_code"), F.col("course").alias("course_code"))
        winners = winners.join(stored, ["institution_code", "course_code"], "left_anti")
    # nine tables read it
    won = written(with_ects.select("page_id", *[c for c in order_cols if c != "page_id"], *WON_COLUMNS).join(winners.select("page_id"), "page_id", "left_semi"), "won")

    course_institution = won.select(
        F.col("ects").cast("int").alias("ects"),
        F.col("institution_code").alias("institution"),
        F.col("course_code").alias("course"),
    )
    duration_units = won.filter(F.col("duration_unit").isNotNull()).select(F.col("duration_unit").alias("name")).distinct()
    durations = require(won, ["duration_unit", "duration_amount"]).select(
        F.col("institution_code").alias("institution"),
        F.col("course_code").alias("course"),
        F.col("duration_unit").alias("unit"),
        F.col("duration_amount").cast("int").alias("ammount"),
    )
    cnaef_areas = first_wins(
        require(won, ["cnaef_code", "cnaef_name"]).select(
            F.col("cnaef_code").alias("code"), F.col("cnaef_name").alias("name"), *order_cols
        ),
        ["code"], order_cols, ["name"],
    )

    page_order = won.select("page_id", *[c for c in order_cols if c != "page_id"], "institution_code", "course_code")
    opt = optional.join(page_order, "page_id", "inner").select(
        "code", "name", *order_cols, F.lit(0).alias("src"), "conjunct_no", "group_no", "pos"
    )
    man = mandatory.join(page_order, "page_id", "inner")
    exams = first_wins(
        opt.unionByName(
            man.select("code", "name", *order_cols, F.lit(1).alias("src"), F.lit(0).alias("conjunct_no"),
                       F.lit(0).alias("group_no"), "pos")
        ),
        ["code"], order_cols + ["src", "conjunct_no", "group_no", "pos"], ["name"],
    )
    mandatory_exams = man.select(
        F.col("code").alias("exam"), F.col("institution_code").alias("institution"), F.col("course_code").alias("course")
    ).distinct()

    courses = first_wins(
        won.select(F.col("course_code").alias("code"), F.col("course_name").alias("name"), *order_cols),
        ["code"], order_cols, ["name"],
    )
    degrees = won.filter(F.col("degree").isNotNull()).select(F.col("degree").alias("name")).distinct()
    education_types = won.filter(F.col("education_type").isNotNull()).select(F.col("education_type").alias("name")).distinct()
    contests = won.filter(F.col("contest").isNotNull()).select(F.col("contest").alias("name")).distinct()

    return {
        "institutions": institutions,
        "course_institution": course_institution,
        "duration_units": duration_units,
        "durations": durations,
        "cnaef_areas": cnaef_areas,
        "exams": exams,
        "mandatory_exams": mandatory_exams,
        "courses": courses,
        "degrees": degrees,
        "education_types": education_types,
        "contests": contests,
    }
