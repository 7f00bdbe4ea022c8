"""Joins and the expanded view: JON1-JON3, PRJ1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equi_join(left: DataFrame, right: DataFrame, left_cols, right_cols=None, how: str = "inner") -> DataFrame:
    """JON1/JON2: equi-join on one or more columns compared part by part, so a null in
    any key part never matches (row-value semantics, not struct equality)."""
    left_cols = list(left_cols)
    right_cols = list(right_cols or left_cols)
    cond = None
    for lc, rc in zip(left_cols, right_cols):
        e = left[lc] == right[rc]
        cond = e if cond is None else cond & e
    return left.join(right, cond, how)


def expanded_course_institution(tables: dict) -> DataFrame:
    """JON3 + PRJ1: fact -> institutions -> courses -> durations -> duration_units.

    Join strategy is left to the optimizer: with AQE on, a side whose measured size is
    under the broadcast threshold is broadcast, otherwise sort-merge on the key."""
    ci = tables["course_institution"].alias("ci")
    ins = tables["institutions"].alias("i")
    co = tables["courses"].alias("c")
    du = tables["durations"].alias("d")
    un = tables["duration_units"].alias("u")
    j = (
        ci.join(ins, F.col("ci.institution") == F.col("i.code"), "inner")
        .join(co, F.col("ci.course") == F.col("c.code"), "inner")
        .join(du, (F.col("d.institution") == F.col("ci.institution")) & (F.col("d.course") == F.col("ci.course")), "inner")
        .join(un, F.col("d.unit") == F.col("u.name"), "inner")
    )
    return j.select(
        F.col("ci.ects").alias("ects"),
        F.col("i.code").alias("institution_code"),
        F.col("i.name").alias("institution_name"),
        F.col("c.code").alias("course_code"),
        F.col("c.name").alias("course_name"),
        F.col("d.ammount").alias("duration_ammount"),
        F.col("u.name").alias("duration_unit"),
    )
