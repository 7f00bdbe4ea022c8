"""Array scalars: list-to-text and the non-empty guarantee."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_list(c) -> Column:
    """Each item prefixed by one space, concatenated: [a, b] -> ' a b', [] -> ''; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.concat_ws("", F.transform(c, lambda x: F.concat(F.lit(" "), x))))


def non_empty(c) -> Column:
    """Absent instead of empty: an empty array becomes null."""
    c = _col(c)
    return F.when(F.size(c) > 0, c)


def last_item(c) -> Column:
    """Last element of a non-empty array (null for null/empty)."""
    c = _col(c)
    return F.when(F.size(c) > 0, F.element_at(c, -1))
