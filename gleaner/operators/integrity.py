"""Constraint checks: INT1-INT3 (run after all tables exist, so circular FKs are fine)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """INT1: keys occurring more than once, with their count (partial aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_keys(df: DataFrame, cols) -> DataFrame:
    """INT2: rows where any NOT NULL column is null."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def orphans(child: DataFrame, parent: DataFrame, child_cols, parent_cols=None) -> DataFrame:
    """INT3: child rows whose (non-null) foreign key has no parent row.  A null in any FK
    part passes, as in SQL.  Composite keys compare part by part (no row-value equality)."""
    child_cols = list(child_cols)
    parent_cols = list(parent_cols or child_cols)
    p = parent.select(*[F.col(pc).alias(f"_p{i}") for i, pc in enumerate(parent_cols)]).distinct()
    cond = None
    for i, cc in enumerate(child_cols):
        e = child[cc] == p[f"_p{i}"]
        cond = e if cond is None else cond & e
    nonnull = F.lit(True)
    for cc in child_cols:
        nonnull = nonnull & F.col(cc).isNotNull()
    return child.filter(nonnull).join(p, cond, "left_anti")


# FIXED VALUES: declared constraints of the catalogue (table -> primary key, not-null cols, foreign keys)
CONSTRAINTS = {
    "exams": {"pk": ["code"], "not_null": ["code"], "fk": []},
    "cnaef_areas": {"pk": ["code"], "not_null": ["code"], "fk": []},
    "degrees": {"pk": ["name"], "not_null": ["name"], "fk": []},
    "education_types": {"pk": ["name"], "not_null": ["name"], "fk": []},
    "contests": {"pk": ["name"], "not_null": ["name"], "fk": []},
    "duration_units": {"pk": ["name"], "not_null": ["name"], "fk": []},
    "durations": {
        "pk": ["institution", "course"],
        "not_null": ["institution", "course"],
        "fk": [(["institution", "course"], "course_institution", ["institution", "course"]), (["unit"], "duration_units", ["name"])],
    },
    "institutions": {"pk": ["code"], "not_null": ["code"], "fk": []},
    "mandatory_exams": {
        "pk": ["exam", "institution", "course"],
        "not_null": ["exam", "institution", "course"],
        "fk": [(["exam"], "exams", ["code"]), (["institution", "course"], "course_institution", ["institution", "course"])],
    },
    "courses": {"pk": ["code"], "not_null": ["code"], "fk": []},
    "course_institution": {
        "pk": ["institution", "course"],
        "not_null": ["institution", "course"],
        "fk": [
            (["institution"], "institutions", ["code"]),
            (["course"], "courses", ["code"]),
            (["institution", "course"], "durations", ["institution", "course"]),
        ],
    },
}


@dataclass(frozen=True)
class Role:
    """What one table does in a key domain: ``pk`` (its primary key) or ``fk`` (its rows refer to the domain)."""

    table: str
    kind: str
    cols: tuple
    domain: str


def key_roles(constraints: dict, present) -> list[Role]:
    """The roles that the present tables play; a domain is named after the table whose primary key it is."""
    roles = [Role(t, "pk", tuple(c["pk"]), t) for t, c in constraints.items() if t in present]
    for t, c in constraints.items():
        for cols, parent, pcols in c["fk"] if t in present else []:
            if parent in present:
                if list(pcols) != list(constraints[parent]["pk"]):
                    raise ValueError(f"{t}{cols}: a foreign key must refer to the primary key of {parent}")
                roles.append(Role(t, "fk", tuple(cols), parent))
    return roles


def _separate_nulls(constraints: dict, present) -> list[tuple[str, tuple]]:
    """Tables with NOT NULL columns outside their primary key; these nulls do not show in the keys."""
    return [(t, tuple(c["not_null"])) for t, c in constraints.items() if t in present and not set(c["not_null"]) <= set(c["pk"])]


def key_table(tables: dict, constraints: dict) -> tuple[DataFrame, list[Role]]:
    """Every key of every table, tagged with its domain and role: one row each, ``domain, k0 .. kn, role``."""
    roles = key_roles(constraints, tables)
    width = max(len(r.cols) for r in roles)
    rows = None
    for i, r in enumerate(roles):
        keys = [F.col(c).cast("string") for c in r.cols] + [F.lit("")] * (width - len(r.cols))
        part = tables[r.table].select(F.lit(r.domain).alias("domain"), *[k.alias(f"k{j}") for j, k in enumerate(keys)], F.lit(i).alias("role"))
        rows = part if rows is None else rows.unionByName(part)
    return rows, roles


def check_catalogue(tables: dict, constraints: dict = CONSTRAINTS) -> DataFrame:
    """INT1-INT3: all violations as one table (table, check, detail, n) - empty when clean.

    The keys of all tables are unioned with the role they play and aggregated once per key: a key's counts by role
    say at a time whether it is a duplicate (its primary-key role more than once), holds a null, or is an orphan (a
    referring role without the primary-key role; a null in any part passes), for circular pairs of tables too.  So the
    tables are read once and their keys shuffled once, combined in the tasks before, where a join for each constraint would
    shuffle both its sides; a second exchange adds up one row a task."""
    spark = next(iter(tables.values())).sparkSession
    present = [t for t in constraints if t in tables]
    if not present:
        return spark.createDataFrame([], "table string, check string, detail string, n long")
    rows, roles = key_table({t: tables[t] for t in present}, constraints)
    keys = [c for c in rows.columns if c != "role"]
    n = [F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(len(roles))]
    per_key = rows.groupBy(*keys).agg(*n)
    has_null = F.lit(False)
    for k in keys[1:]:
        has_null = has_null | F.col(k).isNull()

    sums, labels = [], []
    for i, r in enumerate(roles):
        count = F.col(f"n{i}")
        if r.kind == "pk":
            sums += [F.count_if(count > 1), F.sum(F.when(has_null, count))]
            labels += [(r.table, "duplicate_key", ",".join(r.cols)), (r.table, "null_key", ",".join(constraints[r.table]["not_null"]))]
        else:
            parent = F.col(f"n{next(j for j, p in enumerate(roles) if p.kind == 'pk' and p.table == r.domain)}")
            sums.append(F.sum(F.when((parent == 0) & ~has_null, count)))
            labels.append((r.table, "orphan", ",".join(r.cols) + "->" + r.domain))
    totals = per_key.agg(*[F.coalesce(s, F.lit(0).cast("long")).alias(f"v{i}") for i, s in enumerate(sums)])
    listed = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(c).alias("check"), F.lit(d).alias("detail"), F.col(f"v{i}").alias("n"))
                       for i, (t, c, d) in enumerate(labels)])
    out = totals.select(F.explode(listed).alias("v")).select("v.*")
    for t, cols in _separate_nulls(constraints, present):
        extra = null_keys(tables[t], cols).agg(F.count(F.lit(1)).alias("n"))
        out = out.filter((F.col("table") != t) | (F.col("check") != "null_key")).unionByName(
            extra.select(F.lit(t).alias("table"), F.lit("null_key").alias("check"), F.lit(",".join(cols)).alias("detail"), "n"))
    return out.filter(F.col("n") > 0)
