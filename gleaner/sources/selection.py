"""Selection CSV: SRC1/SRC2.

Columns are bound by header *name* (order free, extra columns ignored), all values
are strings (leading zeros kept), an empty cell is ``""`` not null, and one bad
record fails the read.  No user schema is given on purpose: Spark binds a user
schema by position, which would silently swap reordered columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SELECTION_COLUMNS = ("institution_code", "course_code")


def read_selection(spark: SparkSession, path: str, cols=SELECTION_COLUMNS) -> DataFrame:
    df = (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("inferSchema", False)
        .option("enforceSchema", False)
        # every column is parsed, or a record with too many or too few cells would pass unseen
        .option("columnPruning", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"selection CSV lacks columns {missing}; has {df.columns}")
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])
