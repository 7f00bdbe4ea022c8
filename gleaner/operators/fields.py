"""Section parsers: characteristics (CHR1-CHR9) and contacts (CON1-CON6).

Input is the section-node table of ``dom.section_nodes`` (one header per page and
section after ``dom.last_sections``), output one row per page.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import (
    parse_code,
    parse_code_name,
    parse_quantity,
    parse_uint,
    split_kv,
    split_list,
    strip_prefix,
    strip_ws,
    utrim,
)
from gleaner.functions.lists import non_empty
from gleaner.operators.dom import take_page_tokens, with_stop
from gleaner.presets import ContactPreset, FieldPreset


@dataclass(frozen=True)
class FieldSpec:
    """One pivoted field: output name, exact label, parser over the value column, and
    whether a later *failed* parse keeps the earlier good value (else it overwrites)."""

    name: str
    label: str
    parse: object  # Callable[[Column], Column]
    keep_on_failure: bool


def pivot_fields(df: DataFrame, keys, label_col: str, value_col: str, order_col: str, specs: Iterable[FieldSpec]) -> DataFrame:
    """CHR2: one column per field; repeats: last wins, subject to ``keep_on_failure``.

    ``max_by(value, order)`` ignores rows whose order is null, so the condition goes in
    the order argument; it is a partial aggregate (map-side combine), safe for hot keys."""
    aggs = []
    for s in specs:
        is_f = F.col(label_col) == F.lit(s.label)
        parsed = s.parse(F.col(value_col))
        cond = is_f & parsed.isNotNull() if s.keep_on_failure else is_f
        aggs.append(F.max_by(F.when(is_f, parsed), F.when(cond, F.col(order_col))).alias(s.name))
    return df.groupBy(*keys).agg(*aggs)


def characteristic_specs(p: FieldPreset = FieldPreset()) -> list[FieldSpec]:
    return [
        FieldSpec("code", p.code, parse_code, True),
        FieldSpec("degree", p.degree, lambda v: v, False),
        FieldSpec("cnaef", p.cnaef, parse_code_name, True),
        FieldSpec("duration", p.duration, lambda v: parse_quantity(v, 255), True),
        FieldSpec("ects", p.ects, lambda v: parse_uint(v, 65535), False),
        FieldSpec("education_type", p.education_type, lambda v: v, False),
        FieldSpec("contest", p.contest, lambda v: v, False),
    ]


def kv_tokens(section: DataFrame, sep: str = ": ") -> DataFrame:
    """CHR1 + DOM6: leading run of ``label: value`` text tokens of each section."""
    keep = (F.col("kind") == "text") & F.col("text").contains(sep)
    toks = take_page_tokens(section, ["page_id", "header_id"], "pos", keep)
    kv = split_kv("text", sep)
    return toks.select("page_id", "header_id", "token_no", kv["key"].alias("field"), kv["value"].alias("value"))


def characteristics(section: DataFrame, preset: FieldPreset = FieldPreset()) -> DataFrame:
    """Characteristics section -> one row per page with parsed, widened fields."""
    kv = kv_tokens(section, preset.separator)
    p = pivot_fields(kv, ["page_id"], "field", "value", "token_no", characteristic_specs(preset))
    return p.select(
        "page_id",
        F.col("code.institution").alias("institution_code"),
        F.col("code.course").alias("course_code"),
        "degree",
        F.col("cnaef.code").alias("cnaef_code"),
        F.col("cnaef.name").alias("cnaef_name"),
        F.col("duration.amount").cast("int").alias("duration_amount"),
        F.col("duration.unit").alias("duration_unit"),
        F.col("ects").cast("int").alias("ects"),
        "education_type",
        "contest",
    )


def unknown_fields(section: DataFrame, preset: FieldPreset = FieldPreset()) -> DataFrame:
    """DOM7 for fields: labels of the characteristics run that are not known."""
    kv = kv_tokens(section, preset.separator)
    return kv.filter(~F.col("field").isin(preset.labels())).select("page_id", "token_no", "field", "value")


def _ordered_flatten(items: Column, order: Column) -> Column:
    """Aggregate: concatenate per-row arrays in ``order``; rows where ``items`` is null are
    skipped (the group is one section of one page)."""
    ordered = F.array_sort(F.collect_list(F.when(items.isNotNull(), F.struct(order.alias("o"), items.alias("v")))))
    return non_empty(F.flatten(F.transform(ordered, lambda x: x["v"])))


def contacts(section: DataFrame, preset: ContactPreset = ContactPreset()) -> DataFrame:
    """CON1-CON4: address lines (leading text run, trimmed), then from the node after the
    address-ending node to the end of the parent: ``Tel:`` lines -> phone numbers (whitespace
    removed), ``Fax:`` lines recognised and dropped, ``mailto:`` anchors -> e-mail addresses.

    A window over the section finds where the address run stops, and one grouped aggregate in the
    same order builds the three lists (absent, never empty)."""
    keys = ["page_id", "header_id"]
    is_text = F.col("kind") == "text"
    j = with_stop(section, keys, "pos", is_text)
    stop, pos = F.col("stop_pos"), F.col("pos")
    in_address = ((pos % 2) == 0) & (stop.isNull() | (pos < stop))
    after_address = stop.isNotNull() & (pos > stop)

    tel = strip_prefix("text", preset.phone_prefix)
    is_fax = F.col("text").startswith(preset.fax_prefix)
    phone_items = F.transform(split_list(tel, preset.phone_separator), lambda x: utrim(strip_ws(x)))
    mail = strip_prefix(F.col("attrs")["href"], preset.mail_prefix)
    mail_items = F.transform(split_list(mail, preset.mail_separator), lambda x: utrim(x))
    is_mail_link = (F.col("kind") == "element") & (F.col("name") == "a") & mail.isNotNull()

    return j.groupBy(*keys).agg(
        _ordered_flatten(F.when(in_address, F.array(utrim("text"))), pos).alias("address"),
        _ordered_flatten(F.when(after_address & is_text & tel.isNotNull() & ~is_fax, phone_items), pos).alias("phone_numbers"),
        _ordered_flatten(F.when(after_address & is_mail_link, mail_items), pos).alias("email_addresses"),
    ).drop("header_id")
