"""Joins Spark SQL has no syntax for: as-of, range (band) and positional.

All three are DataFrame rewrites into equi-joins, unions and windows so that
Catalyst plans them; none emits all pairs of a key and none sends a whole key
to one task: the as-of and range joins split every key by a time/value bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.session import checkpoint_root


def _cols(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _is_time(df: DataFrame, name: str) -> bool:
    dtype = dict(df.dtypes)[name]
    return dtype == "date" or dtype.startswith("timestamp")


def _bucket(col: Column, width: float, time: bool) -> Column:
    """Bucket number of a value (``width`` in seconds for times, which are microseconds here)."""
    return F.floor(col / F.lit(width * 1_000_000 if time else width)).cast("bigint")


def _as_number(df: DataFrame, name: str) -> Column:
    """A value to compare by: whole microseconds for times, other types as they are (a long stays exact)."""
    c = F.col(name)
    if not _is_time(df, name):
        return c
    if dict(df.dtypes)[name] == "date":
        return F.unix_date(c).cast("bigint") * 86_400_000_000
    return F.unix_micros(c.cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], left_ts: str, right_ts: str,
              right_cols: Sequence[str] | None = None, bucket_seconds: float = 86400.0,
              prefix: str = "") -> DataFrame:
    """ASOF LEFT JOIN: each left row gets the latest right row with the same ``on`` keys and
    ``right_ts <= left_ts`` (NULLs when there is none). Left rows are never dropped or duplicated.
    A NULL key or time matches nothing.

    Plan: both sides are unioned and split by (keys, time bucket). Inside a bucket the match
    is ``last(right, ignorenulls)`` over the time order (right rows sort before left rows at the
    same instant). The last right row of every earlier bucket comes from a small
    (keys, bucket) table — one row per key and bucket, pre-aggregated map-side — carried
    forward by a window and equi-joined back. A hot key is spread over its buckets.
    """
    keys = _cols(on)
    rcols = list(right_cols) if right_cols is not None else [c for c in right.columns if c not in keys]
    payload = F.struct(*[F.col(c).alias(c) for c in [right_ts] + [c for c in rcols if c != right_ts]])

    for c in [*keys, right_ts]:
        right = right.where(F.col(c).isNotNull())
    lnum = _as_number(left, left_ts)
    rnum = _as_number(right, right_ts)
    L = left.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        lnum.alias("__t"), F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__left"),
        F.lit(None).cast(payload_type(right, right_ts, rcols)).alias("__right"),
    )
    R = right.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        rnum.alias("__t"), F.lit(0).alias("__side"),
        F.lit(None).cast(L.schema["__left"].dataType).alias("__left"),
        payload.alias("__right"),
    )
    kcols = [f"__k{i}" for i in range(len(keys))]
    U = L.unionByName(R)
    comparable = F.col("__t").isNotNull()
    for k in kcols:
        comparable = comparable & F.col(k).isNotNull()
    # rows that can't match are dealt over many buckets, so they don't meet in one task
    U = U.withColumn("__ok", comparable).withColumn("__b", F.when(
        F.col("__ok"), _bucket(F.col("__t"), bucket_seconds, _is_time(left, left_ts))).otherwise(
            F.pmod(F.xxhash64("__left"), F.lit(1024))))

    # match inside the bucket
    w_in = (Window.partitionBy(*kcols, "__b").orderBy("__t", "__side", "__right")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (U.withColumn("__m", F.last("__right", ignorenulls=True).over(w_in))
              .where(F.col("__side") == 1))

    # last right row of each earlier bucket: per (key, bucket) table, carried forward. This
    # branch reads only keys, times and the right payload (column pruning) and aggregates
    # map-side; sharing the window's shuffle instead would need a second sort of both sides.
    per_bucket = (U.groupBy(*kcols, "__b")
                  .agg(F.max(F.when(F.col("__side") == 0, F.struct("__t", "__right"))).alias("__last")))
    w_prev = (Window.partitionBy(*kcols).orderBy("__b")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (per_bucket.withColumn("__prev", F.last("__last", ignorenulls=True).over(w_prev))
             .select(*kcols, "__b", F.col("__prev.__right").alias("__prev")))

    out = (inside.join(carry, kcols + ["__b"], "left")
           .withColumn("__hit", F.when(F.col("__ok"), F.coalesce("__m", "__prev"))))
    sel = [F.col(f"__left.{c}").alias(c) for c in left.columns]
    sel += [F.col(f"__hit.{c}").alias(prefix + c) for c in [right_ts] + [c for c in rcols if c != right_ts]]
    return out.select(*sel)


def payload_type(right: DataFrame, right_ts: str, rcols: Sequence[str]) -> str:
    fields = [right_ts] + [c for c in rcols if c != right_ts]
    types = dict(right.dtypes)
    return "struct<" + ",".join(f"`{c}`:{types[c]}" for c in fields) + ">"


def range_join(left: DataFrame, right: DataFrame, start: str, end: str, point: str,
               bucket_width: float, on: str | Sequence[str] | None = None,
               closed: str = "left", totals: dict[str, str | None] | None = None) -> DataFrame:
    """Band join: right rows whose ``point`` lies in the left row's ``[start, end)``
    (``closed='both'`` for ``[start, end]``), optionally also equal on ``on`` keys.

    With ``totals`` (``{name: right column}``, None counts rows) every left row with a match comes out once, with the
    sums of its matches (NULL values don't count) instead of the matches. The work then grows with the two tables, not
    with the pairs, see ``_range_totals``. Columns to sum are whole numbers or decimals.

    Each interval is exploded into the buckets it touches and each point lands in
    exactly one bucket, so the equi-join on (keys, bucket) emits every match once and
    never compares rows of distant buckets. Choose ``bucket_width`` near the typical
    interval length (seconds for timestamps). Right columns whose name a left column has come out with
    the suffix ``_right``; the ``on`` keys come out once.
    """
    keys = _cols(on)
    if totals is not None:
        return _range_totals(left, right, start, end, point, keys, closed, totals)
    lb = left.withColumn("__s", _as_number(left, start)).withColumn("__e", _as_number(left, end))
    time = _is_time(left, start)
    lb = lb.withColumn("__b", F.explode(F.sequence(_bucket(F.col("__s"), bucket_width, time),
                                                   _bucket(F.col("__e"), bucket_width, time))))
    rb = right.withColumn("__p", _as_number(right, point))
    rb = rb.withColumn("__b", _bucket(F.col("__p"), bucket_width, time))
    rk = [F.col(f"r.{k}") == F.col(f"l.{k}") for k in keys]
    upper = (F.col("r.__p") < F.col("l.__e")) if closed == "left" else (F.col("r.__p") <= F.col("l.__e"))
    cond = [F.col("l.__b") == F.col("r.__b")] + rk + [F.col("r.__p") >= F.col("l.__s"), upper]
    j = lb.alias("l").join(rb.alias("r"), cond)
    lcols = [F.col(f"l.{c}").alias(c) for c in left.columns]
    rcols = [F.col(f"r.{c}").alias(f"{c}_right" if c in left.columns else c) for c in right.columns if c not in keys]
    return j.select(*lcols, *rcols)


def _range_totals(left: DataFrame, right: DataFrame, start: str, end: str, point: str, keys: list[str], closed: str,
                  totals: dict[str, str | None]) -> DataFrame:
    """Left rows with a match and the sums of their matches: what the points before the end come to, less what the
    points before the start come to. Points and both bounds of every left row go into one order, in which running
    sums are taken over blocks, so neither a key nor a stretch of time with many rows is one task's."""
    from reportlake.operators.spread import Running, spread_windows

    types = dict(right.dtypes)
    for c in totals.values():
        if c is not None and not types[c].startswith(("decimal", "tinyint", "smallint", "int", "bigint")):
            raise ValueError(f"sums of {types[c]} can't be subtracted exactly: {c}")
    named = [c for c in totals.values() if c is not None]
    sums = list(dict.fromkeys(named))
    wide = {c: f"decimal({min(38, int(types[c][8:].split(',')[0]) + 10)},{types[c].rstrip(')').split(',')[1]})"
            if types[c].startswith("decimal") else "bigint" for c in sums}
    s, e, p = _as_number(left, start), _as_number(left, end), _as_number(right, point)
    valid = (s <= e) if closed == "both" else (s < e)
    for k in keys:
        valid, p = valid & F.col(k).isNotNull(), F.when(F.col(k).isNotNull(), p)
    # at one place bounds go before points, the upper bound of a closed interval after them
    bounds = F.array(F.struct(s.alias("at"), F.lit(0).alias("side"), F.lit(-1).alias("sign")),
                     F.struct(e.alias("at"), F.lit(2 if closed == "both" else 0).alias("side"), F.lit(1).alias("sign")))
    lrows = (left.filter(valid).withColumn("__row", F.monotonically_increasing_id())
             .select(F.struct(*left.columns).alias("__l"), "__row", *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                     F.explode(bounds).alias("__b"))
             .select(F.when(F.col("__b.sign") == 1, F.col("__l")).alias("__l"), "__row", *[f"__k{i}" for i in range(len(keys))],
                     F.col("__b.at").alias("__at"), F.col("__b.side").alias("__side"), F.col("__b.sign").alias("__sign")))
    rrows = (right.withColumn("__at", p).filter("__at IS NOT NULL")
             .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__at", F.lit(1).alias("__side"),
                     F.lit(1).cast("bigint").alias("__n"), *[F.col(c).cast(wide[c]).alias(f"__v{i}") for i, c in enumerate(sums)],
                     *[F.col(c).isNotNull().cast("bigint").alias(f"__h{i}") for i, c in enumerate(sums)]))
    parts = ["__n"] + [f"__{x}{i}" for i in range(len(sums)) for x in "vh"]
    both = lrows.unionByName(rrows, allowMissingColumns=True)
    run = spread_windows(both, [f"__k{i}" for i in range(len(keys))], [("__at", True), ("__side", True)],
                         {f"__upto{x}": Running("sum", x) for x in parts}).filter("__sign IS NOT NULL")
    per = run.groupBy("__row").agg(F.max_by("__l", "__sign").alias("__l"), *[
        F.sum(F.col("__sign") * F.coalesce(f"__upto{x}", F.lit(0))).alias(x) for x in parts]).filter("__n > 0")
    out = [F.col("__n").alias(n) if c is None else
           F.when(F.col(f"__h{sums.index(c)}") > 0, F.col(f"__v{sums.index(c)}")).alias(n) for n, c in totals.items()]
    return per.select(*[F.col(f"__l.{c}").alias(c) for c in left.columns], *out)


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_idx",
              partitions: int | None = None) -> DataFrame:
    """Dense 0-based position of every row in a total ``order``, computed without a
    single-partition window: range-partition and sort, freeze that layout with a reliable
    checkpoint, number rows inside each partition, then add per-partition offsets computed
    from one count per partition (bounded by the partition count) and broadcast back.
    """
    checkpoint_root(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the partition number above bit 33 and the row's place in it below
    laid = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("__id", F.monotonically_increasing_id())).checkpoint(eager=True)
    local = (laid.withColumn("__pid", F.shiftright("__id", 33).cast("int"))
             .withColumn("__local", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))))
    # one count per partition (bounded by the partition count) → running offsets
    counts = sorted((r["__pid"], r["__n"]) for r in local.groupBy("__pid").agg(F.count("*").alias("__n")).collect())
    offsets, run = [], 0
    for pid, cnt in counts:
        offsets.append((pid, run))
        run += cnt
    off_df = df.sparkSession.createDataFrame(offsets, "__pid int, __off long")
    return (local.join(F.broadcast(off_df), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__local")).cast("bigint"))
            .drop("__id", "__pid", "__local", "__off"))


def positional_join(left: DataFrame, right: DataFrame, left_order: Sequence[Column | str],
                    right_order: Sequence[Column | str]) -> DataFrame:
    """POSITIONAL JOIN: the i-th row of each side (by an explicit total order) side by side;
    the shorter side is padded with NULLs."""
    li = row_index(left, left_order, "__pos")
    ri = row_index(right, right_order, "__pos")
    j = li.join(ri, "__pos", "full_outer")
    return j.orderBy("__pos").drop("__pos")
