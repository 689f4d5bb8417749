"""Exact top-k by inner product: a Voronoi join with bounds per query group.

Vectors become whole numbers, floor(256 x). A bounded set of pivots divides them into Voronoi cells; a cell's
summary holds its pivot and the objects nearest to it. Every query's k-th best score among the summaries'
objects is a floor that its answer can't fall under. Since q·y <= q·p + |q| |y - p|, an object y of cell p can
matter to a group of queries only if |y - p| is at least the smallest (floor - q·p) / |q| of the group: that
table, groups by cells, decides which objects are replicated to which group. Groups are solved locally in
blocks of the data and the blocks' answers merged.

Nulls and ties: vectors that are null or hold a null or non-finite component take no part, nor do rows with a
null id; shorter vectors count as padded with zeros; equal scores go to the smaller id; a query given twice
with one vector gives one answer; rows that repeat a query's id are never its candidates; with fewer than k
candidates, all are returned; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import grouped, ready, stored
from reportlake.llm.vectors import finite, matrix

#: Pivots (the bound tables have their square at most), objects of a cell's summary, queries of a group,
#: rows of a data block.
PIVOTS, SUMMARY, GROUP_QUERIES, BLOCK = 64, 24, 512, 16384


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best inner products of every query over all other rows."""
    spark = ready(vectors.sparkSession)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("raw"),
                       F.coalesce(is_query, F.lit(False)).alias("query"))
    v = v.filter(F.col("vec_id").isNotNull() & finite("raw")).select(
        "vec_id", "query", F.transform("raw", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))
    size = v.agg(F.max(F.size("v")).alias("d"), F.count("*").alias("n"), F.count_if("query").alias("q"),
                 F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))).alias("top")).first()
    if not size["q"]:
        return empty
    d, n = max(1, size["d"]), size["n"]
    # products and sums below 2^53 are exact in double arithmetic; beyond that, whole numbers of any size
    exact = np.float64 if d * size["top"] ** 2 < 2**53 else object

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(exact) @ b.astype(exact).T

    chosen = v.select("vec_id", "v").orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(pivots).collect()
    centre = np.zeros((len(chosen), d))
    for i, r in enumerate(chosen):
        centre[i, :len(r["v"])] = r["v"]
    norms = (centre ** 2).sum(1)

    def assign(batches):
        for b in batches:
            m = matrix(b.column(2), d, np.float64)
            cell = np.argmin(norms - 2 * (m @ centre.T), axis=1)
            far = np.sqrt(((m - centre[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(cell.astype(np.int32)), pa.array(far)],
                names=["vec_id", "query", "v", "cell", "far"])

    cells = stored(v.mapInArrow(assign, "vec_id long, query boolean, v array<long>, cell int, far double"), "cells")
    near = Window.partitionBy("cell").orderBy("far", "vec_id")
    summary = (cells.withColumn("r", F.row_number().over(near)).filter(F.col("r") <= SUMMARY)
               .select("vec_id", "v").collect())  # pivots * SUMMARY rows at most
    known = np.zeros((len(summary), d), np.int64)
    for i, r in enumerate(summary):
        known[i, :len(r["v"])] = r["v"]
    known_ids = np.array([r["vec_id"] for r in summary], np.int64)

    groups = int(min(len(chosen), max(1, -(-size["q"] // GROUP_QUERIES))))
    queries = cells.filter("query").select("vec_id", "v", "cell").distinct()
    queries = queries.withColumn("grp", F.floor(F.col("cell") * groups / len(chosen)).cast("int"))

    def bounds(batches):
        """Per batch, group and cell: the least distance from its pivot at which an object can matter."""
        for b in batches:
            q = matrix(b.column(1), d, np.int64)
            ids, grp = b.column(0).to_numpy(), b.column(2).to_numpy()
            if not len(ids):
                continue
            s = score(q, known).astype(np.float64)
            s[ids[:, None] == known_ids[None, :]] = -np.inf
            floor = np.sort(s, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(ids), -np.inf)
            qf = q.astype(np.float64)
            size_q = np.sqrt((qf ** 2).sum(1))
            with np.errstate(divide="ignore", invalid="ignore"):
                least = (floor[:, None] - qf @ centre.T) / size_q[:, None]
            least = np.where(size_q[:, None] == 0, -np.inf, least)
            least = least - 1e-6 * (1 + np.abs(least))
            for g in np.unique(grp):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(centre), g, np.int32)), pa.array(np.arange(len(centre), dtype=np.int32)),
                     pa.array(least[grp == g].min(0))], names=["grp", "cell", "least"])

    table = (queries.select("vec_id", "v", "grp").mapInArrow(bounds, "grp int, cell int, least double")
             .groupBy("grp", "cell").agg(F.min("least").alias("least")).collect())  # pivots squared at most
    least = np.full((groups, len(centre)), np.inf)
    for r in table:
        least[r["grp"], r["cell"]] = r["least"]

    blocks = max(1, -(-n // BLOCK))

    def replicate(batches):
        for b in batches:
            cell, far = b.column(2).to_numpy(), b.column(3).to_numpy()
            row, grp = np.nonzero(far[:, None] >= least[:, cell].T)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grp.astype(np.int32)), b.column(0).take(at), b.column(1).take(at)],
                names=["grp", "vec_id", "v"])

    data = (cells.select("vec_id", "v", "cell", "far").mapInArrow(replicate, "grp int, vec_id long, v array<long>")
            .select("grp", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).alias("block"), F.lit(False).alias("asks"),
                    "vec_id", "v"))
    asks = queries.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                          F.lit(True).alias("asks"), "vec_id", "v")

    def solve(g):
        ask = [i for i, a in enumerate(g["asks"]) if a]
        have = [i for i, a in enumerate(g["asks"]) if not a]
        if not ask or not have:
            return None

        def block(rows):
            out = np.zeros((len(rows), d), np.int64)
            for i, r in enumerate(rows):
                out[i, :len(g["v"][r])] = g["v"][r]
            return out

        ids = np.array([g["vec_id"][i] for i in have], np.int64)
        y = block(have).astype(exact)
        out = {"query_id": [], "q": [], "vec_id": [], "score": []}
        for lo in range(0, len(ask), 64):
            part = ask[lo: lo + 64]
            s = block(part).astype(exact) @ y.T
            for i, row in zip(part, s):
                own = g["vec_id"][i]
                pick = np.flatnonzero(ids != own)
                if len(pick) > k:
                    limit = np.partition(row[pick], len(pick) - k)[len(pick) - k]
                    pick = pick[row[pick] >= limit]
                for j in sorted(pick, key=lambda j: (-row[j], ids[j]))[:k]:
                    out["query_id"].append(own)
                    out["q"].append(g["v"][i])
                    out["vec_id"].append(int(ids[j]))
                    out["score"].append(int(row[j]))
        return out

    found = grouped(data.unionByName(asks), ["grp", "block"], solve,
                    [("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("vec_id", pa.int64()), ("score", pa.int64())],
                    "query_id long, q array<long>, vec_id long, score long")
    best = Window.partitionBy("query_id", F.xxhash64("q")).orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
