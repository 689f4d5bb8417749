"""Schema-evolving append: column diff, positional sheet pairing, evolved frame and report.

Semantics (fixed by the reference behaviour):
* column match is case-insensitive; matched columns keep the source spelling and
  source order, new columns keep source order, missing columns keep target order;
* every new column is added as STRING, old rows read NULL there;
* values are inserted by name and cast to the *target* type; one bad value fails the
  whole append (ANSI cast), missing columns become NULL;
* the i-th sheet goes to the i-th table; surplus tables are skipped with a reason,
  surplus sheets are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType([
    T.StructField("tableName", T.StringType()),
    T.StructField("rowsBefore", T.LongType()),
    T.StructField("rowsAppended", T.LongType()),
    T.StructField("rowsAfter", T.LongType()),
    T.StructField("newColumns", T.ArrayType(T.StringType())),
    T.StructField("matchedColumns", T.ArrayType(T.StringType())),
    T.StructField("missingColumns", T.ArrayType(T.StringType())),
    T.StructField("skipped", T.BooleanType()),
    T.StructField("skipReason", T.StringType()),
])


@dataclass
class ColumnDiff:
    new: list[str] = field(default_factory=list)
    matched: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)


def column_diff(source: Sequence[str], target: Sequence[str]) -> ColumnDiff:
    """Diff of two header lists (column lists are table metadata, so this runs on the driver)."""
    tl = {c.lower() for c in target}
    sl = {c.lower() for c in source}
    return ColumnDiff(new=[c for c in source if c.lower() not in tl],
                      matched=[c for c in source if c.lower() in tl],
                      missing=[c for c in target if c.lower() not in sl])


def evolve(source: DataFrame, target_schema: T.StructType) -> tuple[DataFrame, ColumnDiff]:
    """Rows of ``source`` shaped as the evolved target: target columns in target order (cast to
    the target type, NULL when missing) followed by new columns as STRING."""
    diff = column_diff(source.columns, target_schema.names)
    by_lower = {c.lower(): c for c in source.columns}
    sel = []
    for f in target_schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            sel.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            sel.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    sel += [F.col(f"`{c}`").cast("string").alias(c) for c in diff.new]
    return source.select(*sel), diff
