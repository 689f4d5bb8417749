"""As-of joins in both directions and to the nearest row, with or without keys.

Both sides are put in one order (key, time) and cut into blocks (``operators/spread.py``); the match of a left row is the last right row
before it in that order, from its own block or carried from an earlier one. No key, and no table without keys, lies in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.operators.joins import _as_number, _cols
from reportlake.operators.spread import Running, spread_windows


def asof(left: DataFrame, right: DataFrame, on: str | Sequence[str] | None, left_ts: str, right_ts: str, direction: str = "backward",
         right_cols: Sequence[str] | None = None, prefix: str = "", block: int | None = None) -> DataFrame:
    """Each left row with the right row of the same ``on`` keys whose time is the latest not after (``backward``), the earliest not
    before (``forward``) or the closest (``nearest``; of two equally close ones the earlier).

    Left rows are never dropped or repeated; a NULL key or time matches nothing. Of right rows with equal keys and time
    the one that is greatest in the columns asked for is taken."""
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction}")
    keys = _cols(on)
    taken = [right_ts] + [c for c in (right_cols if right_cols is not None else right.columns) if c != right_ts and c not in keys]
    names = [f"__asof_k{i}" for i in range(len(keys))]
    lrows = left.select(F.struct(*left.columns).alias("__asof_l"), *[F.col(k).alias(n) for k, n in zip(keys, names)],
                        _as_number(left, left_ts).alias("__asof_t"), F.lit(1).alias("__asof_side"))
    rrows = right.select(F.struct(*taken).alias("__asof_r"), *[F.col(k).alias(n) for k, n in zip(keys, names)],
                         _as_number(right, right_ts).alias("__asof_t"), F.lit(0).alias("__asof_side"))
    able = F.col("__asof_t").isNotNull()
    for n in names:
        able = able & F.col(n).isNotNull()
    out = lrows.filter(able).unionByName(rrows.filter(able).withColumn("__asof_rt", F.col("__asof_t")), allowMissingColumns=True)
    out = out.withColumn("__asof_s", F.when(F.col("__asof_side") == 0, F.struct("__asof_rt", "__asof_r")))
    for way, earlier in (("b", True), ("f", False)):
        if direction in ("nearest", "backward" if earlier else "forward"):
            out = spread_windows(out, names, [("__asof_t", earlier), ("__asof_side", True), ("__asof_r", True)],
                                 {f"__asof_{way}": Running("last", "__asof_s")}, block)
    out = out.filter("__asof_side = 1")
    if direction == "nearest":
        after, before = (F.col(f"__asof_{w}.__asof_rt") for w in "fb")
        closer = after - F.col("__asof_t") < F.col("__asof_t") - before
        out = out.withColumn("__asof_hit", F.when(F.col("__asof_b").isNull() | closer, F.col("__asof_f")).otherwise(F.col("__asof_b")))
    else:
        out = out.withColumn("__asof_hit", F.col(f"__asof_{direction[0]}"))
    out = out.select("__asof_l", F.col("__asof_hit.__asof_r").alias("__asof_r"))
    rest = lrows.filter(~F.coalesce(able, F.lit(False))).select("__asof_l")
    out = out.unionByName(rest, allowMissingColumns=True)
    return out.select(*[F.col(f"__asof_l.{c}").alias(c) for c in left.columns],
                      *[F.col(f"__asof_r.{c}").alias(prefix + c) for c in taken])
