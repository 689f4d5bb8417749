"""Pages of large ordered results: an index built once, after which any page reads the one or two parts it lies in."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.plans.gateway import DEFAULT_PAGE_SIZE, clamp
from reportlake.session import scratch_dir

PART, PLACE = "__page_part", "__page_place"


class PageIndex:
    """The rows of ``df`` in a total ``order``, range-partitioned and written one folder a part in the shared scratch folder, with
    the number of rows of every part. ``OFFSET`` would keep offset + size rows of every task and merge them for each page;
    here page ``p`` is a filter on part and place, whatever ``p`` is."""

    def __init__(self, df: DataFrame, order: Sequence[Column | str], parts: int | None = None):
        spark = df.sparkSession
        self.columns = df.columns
        self.order = list(order)
        n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        laid = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("__page_id", F.monotonically_increasing_id())
                .withColumn(PART, F.shiftright("__page_id", 33).cast("int"))
                .withColumn(PLACE, F.col("__page_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__page_id"))
        path = f"{scratch_dir(spark, 'pages')}/t"
        laid.write.partitionBy(PART).parquet(path)
        self.rows = spark.read.schema(laid.schema).parquet(path)
        counts = {r[0]: r[1] for r in self.rows.groupBy(PART).agg(F.count("*")).collect()}  # one row per part
        self.starts, self.total = [], 0
        for part in range(max(counts, default=-1) + 1):
            self.starts.append(self.total)
            self.total += counts.get(part, 0)

    def parts_of(self, page: int, size: int) -> tuple[int, int]:
        """First and last part of a page's rows."""
        lo = page * size
        return bisect_right(self.starts, lo) - 1, bisect_right(self.starts, lo + size - 1) - 1

    def page(self, page: int = 0, size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
        page, size = clamp(page, size)
        if page * size >= self.total:
            return self.rows.select(*self.columns).limit(0)
        first, last = self.parts_of(page, size)
        start = F.element_at(F.array(*[F.lit(s) for s in self.starts[first:last + 1]]), F.col(PART) - F.lit(first) + 1)
        at = start + F.col(PLACE)
        found = self.rows.where(F.col(PART).between(first, last)).where((at >= page * size) & (at < (page + 1) * size))
        return found.orderBy(PART, PLACE).select(*self.columns)

    def numbered(self, name: str) -> DataFrame:
        """All rows with their place in the order, from 0."""
        starts = self.rows.sparkSession.createDataFrame(list(enumerate(self.starts)), f"{PART} int, __page_start long")
        return (self.rows.join(F.broadcast(starts), PART)  # one row per part
                .select(*self.columns, (F.col("__page_start") + F.col(PLACE)).alias(name)))

    def last_page(self, size: int = DEFAULT_PAGE_SIZE) -> int:
        return max(0, -(-self.total // max(1, size)) - 1)
