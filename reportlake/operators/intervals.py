"""Range join for intervals of any mix of lengths.

An interval is cut into cells (whole multiples of ``unit * 2**level``, levels ``BITS`` apart), at most 14 of each level, so a second and
a century cost about the same; a point belongs to one cell of each level that any interval uses, and is copied once for each. Interval
and point meet in exactly one cell by an equi-join; inside a cell all pairs are matches but for the rounding of the interval's ends, which the exact bounds then settle. So a cell
that many intervals and points share is as large as its result, and AQE may split it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.operators.joins import _as_number, _cols, _is_time

LEVELS = 62

#: Bits between two levels of cells in a join: points, of which there are many, are copied once a level.
BITS = 3


def wide_cells(start: Column, stop: Column, bits: int = BITS) -> Column:
    """The cells ``(level, cell)`` that make up ``[start, stop)`` of whole units, at levels ``bits`` apart (0, bits, 2 bits, ...)."""
    size = F.lit(1 << bits).cast("long")

    def cells(level, lo, hi):
        some = F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(some, lambda c: F.struct((level * bits).alias("level"), c.alias("cell")))

    def step(acc, level):
        lo, hi = acc["lo"], acc["hi"]
        # what lies outside whole cells of the next level is taken off at both ends
        lo2 = F.least(hi, lo + F.pmod(-lo, size))
        hi2 = F.greatest(lo2, hi - F.pmod(hi, size))
        return F.struct(F.shiftright(lo2, bits).alias("lo"), F.shiftright(hi2, bits).alias("hi"),
                        F.concat(acc["out"], cells(level, lo, lo2), cells(level, hi2, hi)).alias("out"))

    zero = F.struct(start.alias("lo"), F.greatest(start, stop).alias("hi"), F.array().cast("array<struct<level:int,cell:bigint>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(-(-LEVELS // bits))), zero, step, lambda a: a["out"])


def dyadic_cells(start: Column, stop: Column) -> Column:
    """The cells ``(level, cell)`` that make up ``[start, stop)`` of whole units."""
    def step(acc, level):
        lo, hi, out = acc["lo"], acc["hi"], acc["out"]
        # lo and hi are counted in cells of this level: an odd end takes one of them off
        left = (lo < hi) & (F.pmod(lo, F.lit(2)) == 1)
        lo2 = F.when(left, lo + 1).otherwise(lo)
        right = (lo2 < hi) & (F.pmod(hi, F.lit(2)) == 1)
        hi2 = F.when(right, hi - 1).otherwise(hi)
        own = F.array_compact(F.array(F.when(left, F.struct(level.alias("level"), lo.alias("cell"))),
                                      F.when(right, F.struct(level.alias("level"), hi2.alias("cell")))))
        return F.struct(F.shiftright(lo2, 1).alias("lo"), F.shiftright(hi2, 1).alias("hi"), F.concat(out, own).alias("out"))

    zero = F.struct(start.alias("lo"), stop.alias("hi"), F.array().cast("array<struct<level:int,cell:bigint>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), zero, step, lambda a: a["out"])


def interval_join(left: DataFrame, right: DataFrame, start: str, end: str, point: str, on: str | Sequence[str] | None = None,
                  unit: float = 1.0, closed: str = "left") -> DataFrame:
    """Right rows whose ``point`` lies in the left row's ``[start, end)`` (``closed='both'``: ``[start, end]``), equal on the ``on`` keys.

    ``unit`` is the smallest cell (seconds for times); it decides how many cells there are, never the result. NULL keys, bounds or points match
    nothing. Right columns whose name a left column has come out with the suffix ``_right``; the ``on`` keys come out once."""
    keys = _cols(on)
    width = unit * (1_000_000 if _is_time(left, start) else 1)
    s, e = _as_number(left, start), _as_number(left, end)
    valid = (s <= e) if closed == "both" else (s < e)
    cells = wide_cells(F.floor(s / F.lit(width)).cast("long"), (F.floor(e / F.lit(width)) + 1).cast("long"))
    lrows = (left.filter(valid).select(F.struct(*left.columns).alias("__l"), s.alias("__s"), e.alias("__e"),
                                       *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.explode(cells).alias("__c"))
             .select("*", F.col("__c.level").alias("__level"), F.col("__c.cell").alias("__cell")).drop("__c"))
    used = sorted(r[0] for r in lrows.select("__level").distinct().collect())  # at most LEVELS + 1 numbers
    p = _as_number(right, point)
    base = F.floor(p / F.lit(width)).cast("long")
    others = [c for c in right.columns if c not in keys]
    rrows = (right.filter(p.isNotNull()).select(F.struct(*(others or [F.lit(0)])).alias("__r"), p.alias("__p"),
                                                *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], base.alias("__base"))
             .withColumn("__level", F.explode(F.array(*[F.lit(x) for x in used]).cast("array<int>")))
             .withColumn("__cell", F.expr("shiftright(__base, __level)")))
    upper = (F.col("__p") < F.col("__e")) if closed == "left" else (F.col("__p") <= F.col("__e"))
    hit = lrows.join(rrows, [f"__k{i}" for i in range(len(keys))] + ["__level", "__cell"]).filter((F.col("__p") >= F.col("__s")) & upper)
    return hit.select(*[F.col(f"__l.{c}").alias(c) for c in left.columns],
                      *[F.col(f"__r.{c}").alias(f"{c}_right" if c in left.columns else c) for c in others])
