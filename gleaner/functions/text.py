"""String scalars as Column expressions (JVM side, whole-stage codegen friendly).

All splits are literal (``\\Q..\\E`` quoted) and happen at the *first*
occurrence; all whitespace handling is Unicode-aware (``(?U)``), so NBSP
counts as whitespace like the page parser expects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNICODE_TRIM = r"(?U)^\s+|\s+\z"
_UNICODE_WS = r"(?U)\s"
_STRICT_UINT = r"^\+?[0-9]+\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (a one-element
    ``transform``).  Without this the optimizer inlines a nested parse into every
    CASE branch that mentions it, evaluating the same split/regex many times."""
    return F.transform(F.array(value), body)[0]


def split_once(c, sep: str) -> Column:
    """Array of 1 or 2 items: split at the first literal ``sep``."""
    return F.split(_col(c), "\\Q" + sep + "\\E", 2)


def _split2(c, sep: str, build) -> Column:
    """``build(head, tail)`` over one split at the first ``sep``; tail is null when absent."""
    return _let(split_once(c, sep), lambda p: build(p[0], F.try_element_at(p, F.lit(2))))


def head_tail(c, sep: str) -> tuple[Column, Column]:
    """(head, tail) of a split at the first ``sep``; both null when absent."""
    parts = split_once(c, sep)
    tail = F.try_element_at(parts, F.lit(2))
    return F.when(tail.isNotNull(), parts[0]), tail


def utrim(c) -> Column:
    """Trim Unicode White_Space on both ends (SQL trim leaves NBSP)."""
    return F.regexp_replace(_col(c), _UNICODE_TRIM, "")


def strip_ws(c) -> Column:
    """Remove every Unicode whitespace character."""
    return F.regexp_replace(_col(c), _UNICODE_WS, "")


def parse_uint(c, max_value: int) -> Column:
    """Strict unsigned parse: optional '+', ASCII digits only, value <= max_value; else null.
    (A bare cast would accept ``'6 '`` and ``'-0'``, which a strict unsigned parse rejects.)"""
    c = _col(c)
    as_dec = F.when(c.rlike(_STRICT_UINT), c).try_cast("decimal(38,0)")
    return _let(as_dec, lambda d: F.when(d <= F.lit(max_value), d.cast("int")))


def split_kv(c, sep: str = ": ") -> Column:
    """struct(key, value) split at the first ``sep``; null when ``sep`` is absent."""
    return _split2(c, sep, lambda h, t: F.when(t.isNotNull(), F.struct(h.alias("key"), t.alias("value"))))


def parse_code(c, sep: str = "/") -> Column:
    """``inst/course`` -> struct(institution, course); null when there is no ``sep``."""
    return _split2(c, sep, lambda h, t: F.when(t.isNotNull(), F.struct(h.alias("institution"), t.alias("course"))))


def parse_code_name(c, sep: str = " ") -> Column:
    """``code name`` split at the first space, no trim -> struct(code, name) or null."""
    return _split2(c, sep, lambda h, t: F.when(t.isNotNull(), F.struct(h.alias("code"), t.alias("name"))))


def parse_quantity(c, max_amount: int = 255, sep: str = " ") -> Column:
    """``n unit`` with n a strict unsigned <= max_amount -> struct(amount, unit); any failure -> null."""
    return _split2(
        c, sep,
        lambda h, t: _let(
            parse_uint(h, max_amount),
            lambda a: F.when(t.isNotNull() & a.isNotNull(), F.struct(a.alias("amount"), t.alias("unit"))),
        ),
    )


def parse_exam(c) -> Column:
    """``code name`` split at the first space, both Unicode-trimmed; no space -> null."""
    return _split2(c, " ", lambda h, t: F.when(t.isNotNull(), F.struct(utrim(h).alias("code"), utrim(t).alias("name"))))


def strip_prefix(c, prefix: str) -> Column:
    """Rest of the string after an exact prefix; null when it does not start with it."""
    c = _col(c)
    return F.when(c.startswith(prefix), F.substring(c, F.lit(len(prefix) + 1), F.length(c)))


def split_list(c, sep: str) -> Column:
    """Split on every literal ``sep``."""
    return F.split(_col(c), "\\Q" + sep + "\\E", -1)
