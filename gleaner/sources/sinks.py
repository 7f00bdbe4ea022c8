"""Catalogue schemas and sinks: SNK1-SNK3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I = T.StringType(), T.IntegerType()


def _t(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# FIXED VALUES: the catalogue's tables as declared
CATALOGUE_SCHEMAS = {
    "exams": _t(("code", S, False), ("name", S, True)),
    "cnaef_areas": _t(("code", S, False), ("name", S, True)),
    "degrees": _t(("name", S, False)),
    "education_types": _t(("name", S, False)),
    "contests": _t(("name", S, False)),
    "duration_units": _t(("name", S, False)),
    "durations": _t(("institution", S, False), ("course", S, False), ("unit", S, True), ("ammount", I, True)),
    "institutions": _t(("code", S, False), ("name", S, True), ("address", S, True), ("phone_numbers", S, True),
                       ("email_addresses", S, True)),
    "mandatory_exams": _t(("exam", S, False), ("institution", S, False), ("course", S, False)),
    "courses": _t(("code", S, False), ("name", S, True)),
    "course_institution": _t(("ects", I, True), ("institution", S, False), ("course", S, False)),
}

# write parents before children (foreign keys point at earlier tables)
WRITE_ORDER = (
    "exams", "cnaef_areas", "degrees", "education_types", "contests", "duration_units", "institutions",
    "courses", "course_institution", "durations", "mandatory_exams",
)


def _relaxed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def conform(df: DataFrame, table: str) -> DataFrame:
    """SNK3: declared columns, order and types (``DataFrame.to`` casts and reorders, and
    fails on a missing column); a null in a NOT NULL column fails the write at run time."""
    schema = CATALOGUE_SCHEMAS[table]
    out = df.to(_relaxed(schema))
    for f in schema.fields:
        if not f.nullable:
            c = F.col(f.name)
            out = out.withColumn(
                f.name, F.when(c.isNull(), F.raise_error(F.lit(f"NOT NULL violated: {table}.{f.name}")).cast(f.dataType)).otherwise(c)
            )
    return out


def write_catalogue(tables: dict, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """SNK1/SNK2: one folder per table; ``overwrite`` is the full refresh of a run."""
    for name in WRITE_ORDER:
        if name in tables:
            conform(tables[name], name).write.mode(mode).format(fmt).save(f"{path}/{name}")


def read_catalogue(spark: SparkSession, path: str, fmt: str = "parquet") -> dict:
    out = {}
    for name in WRITE_ORDER:
        schema = CATALOGUE_SCHEMAS[name]
        out[name] = spark.read.schema(schema).format(fmt).load(f"{path}/{name}").select(*schema.names)  # no partition columns
    return out
