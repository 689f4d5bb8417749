"""Relational helpers for syntax Spark SQL lacks: QUALIFY, DISTINCT ON, DuckDB-style NULL
order, deterministic row sampling and GROUPS window frames."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qualify(df: DataFrame, condition: Column | str) -> DataFrame:
    """``QUALIFY cond``: filter on a window expression (evaluated as a column, then dropped)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumn("__qualify", cond).where(F.col("__qualify")).drop("__qualify")


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """``SELECT DISTINCT ON (keys) * ... ORDER BY keys, order``: the first row of each key.

    ``order`` is ``[(column, ascending), ...]``. Written as an aggregate picking the row with
    the smallest (``min_by``) or largest (``max_by``) struct sort key, so partial aggregation
    collapses a hot key map-side before the shuffle instead of sorting the whole key in one
    task. Columns that run against the chosen direction are negated (numbers, dates, times);
    only when a text column runs against it does this fall back to a ``row_number`` window.
    """
    types = dict(df.dtypes)

    def negatable(t: str) -> bool:
        return t in ("int", "bigint", "smallint", "tinyint", "double", "float", "date") or \
            t.startswith("decimal") or t.startswith("timestamp")

    text_dirs = {asc for name, asc in order if not negatable(types[name])}
    if len(text_dirs) > 1:
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(n).asc_nulls_last() if a else F.col(n).desc_nulls_last() for n, a in order])
        return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    ascending = text_dirs.pop() if text_dirs else True
    parts = []
    for name, asc in order:
        c = F.col(name)
        parts.append(c.isNull() if ascending else c.isNotNull())  # NULLs last in either direction
        if asc != ascending:
            t = types[name]
            c = -F.unix_micros(c.cast("timestamp")) if (t == "date" or t.startswith("timestamp")) else -c
        parts.append(c)
    sort_key = F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])
    row = F.struct(*[F.col(c) for c in df.columns])
    pick = F.min_by if ascending else F.max_by
    picked = df.groupBy(*keys).agg(pick(row, sort_key).alias("__row"))
    return picked.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns])


def order_nulls_last(df: DataFrame, *cols: Column | str, ascending: bool | Sequence[bool] = True) -> DataFrame:
    """ORDER BY with DuckDB's default NULL placement (NULLS LAST both ways)."""
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    keys = [(_col(c).asc_nulls_last() if a else _col(c).desc_nulls_last()) for c, a in zip(cols, asc)]
    return df.orderBy(*keys)


def limit_percent(df: DataFrame, percent: float, order: Sequence[Column | str]) -> DataFrame:
    """``ORDER BY order LIMIT percent%``: the first ``floor(percent% of all rows)`` rows, told apart by their place in a
    range-partitioned sort, so that a share of a large table never goes through one task or the driver."""
    from reportlake.plans.pages import PageIndex

    index = PageIndex(df, order)
    return index.numbered("__place").where(F.col("__place") < int(index.total * percent / 100)).drop("__place")


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    """``COLUMNS('pattern')``: the columns whose name contains a match of a regular expression, in table order."""
    found = [c for c in df.columns if re.search(pattern, c)]
    if not found:
        raise ValueError(f"no column matches {pattern}")
    return df.select(*[F.col(f"`{c}`") for c in found])


def sample_key(seed: int, *cols: Column | str) -> Column:
    """Stable per-row sort key: md5 of seed and key columns (same value in any SQL engine)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in cols]))


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Fixed-size deterministic sample: the ``n`` rows with the smallest hash of (seed, key).

    Planned as TakeOrderedAndProject: every task keeps its own top ``n``, the driver merges
    ``tasks * n`` rows at most. The limit is the feature here.
    """
    return df.withColumn("__h", sample_key(seed, *key)).orderBy("__h", *key).limit(n).drop("__h")


def sample_fraction(df: DataFrame, percent: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Bernoulli-style deterministic sample of about ``percent``% of rows, decided per row
    from the hash of its key (no shuffle, same rows on every run)."""
    bucket = F.conv(F.substring(sample_key(seed, *key), 1, 8), 16, 10).cast("bigint") % 10000
    return df.where(bucket < F.lit(int(round(percent * 100))))


_FRAME_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def with_groups_frame(df: DataFrame, partition: Sequence[str], order: str, value: str,
                      preceding: int, following: int, name: str, fn: str = "sum") -> DataFrame:
    """``fn(value) OVER (PARTITION BY p ORDER BY o GROUPS BETWEEN preceding AND following)``
    for ``fn`` in sum / count / min / max.

    Rows of one peer group share the frame, so each (partition, order value) group is first
    reduced to one partial (a hash aggregate: a hot key collapses map-side); peer groups are
    numbered with ``dense_rank`` on that reduced table, a RANGE frame over the number combines
    the partials, and the result is joined back on (partition, order value).
    """
    agg = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[fn]
    parts = df.groupBy(*partition, order).agg(agg(value).alias("__part"))
    ranked = parts.withColumn("__grp", F.dense_rank().over(Window.partitionBy(*partition).orderBy(order)))
    w = Window.partitionBy(*partition).orderBy("__grp").rangeBetween(-preceding, following)
    keys = [*partition, order]
    framed = ranked.select(*[F.col(k).alias(f"__j{i}") for i, k in enumerate(keys)],
                           _FRAME_COMBINE[fn]("__part").over(w).alias(name))
    cond = [df[k].eqNullSafe(framed[f"__j{i}"]) for i, k in enumerate(keys)]  # NULL is a peer group too
    return df.join(framed, cond).drop(*[f"__j{i}" for i in range(len(keys))])


def ordinal_within(df: DataFrame, keys: Sequence[Column | str], order: str, name: str,
                   bucket_width: int = 1 << 16) -> DataFrame:
    """1-based position of each row among rows with equal ``keys`` by numeric ``order``
    (``row_number() OVER (PARTITION BY keys ORDER BY order)``) without sending a hot key
    to one task: rows are numbered inside (key, order bucket) and shifted by the row count
    of the key's earlier buckets, taken from a per-(key, bucket) count table."""
    kexprs = [_col(k) for k in keys]
    kcols = [f"__k{i}" for i in range(len(kexprs))]
    b = df.select("*", *[e.alias(k) for e, k in zip(kexprs, kcols)],
                  F.floor(F.col(order) / F.lit(bucket_width)).cast("bigint").alias("__b"))
    inner = b.withColumn("__i", F.row_number().over(Window.partitionBy(*kcols, "__b").orderBy(order)))
    counts = b.groupBy(*kcols, "__b").agg(F.count("*").alias("__n"))
    before = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.partitionBy(*kcols).orderBy("__b")
                                              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (inner.join(before.select(*kcols, "__b", "__off"), kcols + ["__b"])
            .withColumn(name, (F.col("__off") + F.col("__i")).cast("bigint"))
            .drop(*kcols, "__b", "__i", "__off"))
