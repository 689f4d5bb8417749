"""Embedding near-duplicates by NN-descent.

Equal vectors of a label are one class with a weight. A neighbour graph over the classes starts from random
hyperplane cells and is refined by neighbours-of-neighbours joins: all that share a neighbour are compared
with each other, and each keeps its best. A list whose members all reach the threshold is saturated and
doubles; each round adds fresh hyperplane cells. Labels of any size go through the graph. Its recall is audited per
label: a random block of the label's vectors is held against all of the label, then more blocks until they show
``LINKS`` links (so the audit sees all of a label that has fewer). Rounds go on until the audited links lie inside
the graph's components and no list is saturated, unless the audit saw all of the label; labels for which they
don't after the last round are compared whole, block by block. What the audit found is kept. The graph uses
vectors rounded to bytes; the links that are returned are decided in double precision by comparing each component
in blocks, which also counts the links of dense groups whatever their size, without writing down their pairs.

Nulls and ties: vectors that are null, empty, zero or hold a null or non-finite component, rows with a null
label and rows with a null id link with nothing; vectors of different length are compared as if padded with
zeros; repeated rows count as vectors of their own; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import grouped, ready, stored
from reportlake.llm.components import components
from reportlake.llm.vectors import finite, matrix

#: Neighbours of a list at first, hyperplane cells a vector starts in, rows compared at once.
NEIGHBOURS, TABLES, CELL = 10, 4, 128
#: Rounds before a label is compared whole, audited links of a label (or all it has), recall that ends the
#: rounds, slack of the rounded cosine and of the single-precision one.
ROUNDS, LINKS, RECALL, SLACK, FLOAT_SLACK = 6, 300, 0.999, 0.02, 1e-4
#: Vectors of a block of the audit and of the comparison of whole labels: at least and at most; between them a
#: label has BLOCKS blocks.
BLOCK, LARGE_BLOCK, BLOCKS = 1024, 4096, 16


def _unpack(rows: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(rows), np.int8).reshape(len(rows), -1).astype(np.float32)
    return m / np.maximum(np.sqrt((m * m).sum(1)), 1e-9)[:, None]


_GRAPH = [("key", pa.int64()), ("u", pa.int64()), ("v", pa.int64()), ("cos", pa.float32())]


def _best_pairs(keep: int):
    """Each member's best partners in a cell that beat the worst of its present list."""
    def run(g):
        if len(g["id"]) < 2:
            return None
        ids = np.array(g["id"], np.int64)
        ids, first = np.unique(ids, return_index=True)
        if len(ids) < 2:
            return None
        m = _unpack([g["bytes"][i] for i in first])
        worst = np.array([g["worst"][i] for i in first], np.float32)
        cos = m @ m.T
        np.fill_diagonal(cos, -2)
        k = min(keep, len(ids) - 1)
        top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(cos, top, 1)
        i, j = np.nonzero(value > worst[:, None])
        return {"key": [g["key"][0]] * len(i), "u": ids[i].tolist(), "v": ids[top[i, j]].tolist(), "cos": value[i, j].tolist()}

    return run


def _merge(graph: DataFrame, limit: float, neighbours: int) -> DataFrame:
    """Each class's best neighbours, best first (``r``); a list that is all links is saturated and may be twice as long.
    ``worst`` is what a new neighbour must beat, ``full`` says that the list was saturated before its room was doubled.
    One shuffle by ``u`` serves the distinct pairs and the windows."""
    best = Window.partitionBy("u").orderBy(F.desc("cos"), "v")
    own = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = (graph.repartition("u").groupBy("key", "u", "v")
         .agg(F.max("cos").alias("cos"), F.max("room").alias("room"))
         .withColumn("room", F.coalesce(F.max("room").over(own), F.lit(neighbours)))
         .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= F.col("room")))
    g = (g.withColumn("links", F.sum((F.col("cos") >= limit).cast("int")).over(own))
         .withColumn("held", F.count("*").over(own)).withColumn("low", F.min("cos").over(own))
         .withColumn("room", F.when(F.col("links") >= F.col("room"), F.col("room") * 2).otherwise(F.col("room"))))
    return g.select("key", "u", "v", "cos", "room", "r",
                    F.when(F.col("held") < F.col("room"), F.lit(-2.0)).otherwise(F.col("low")).cast("float").alias("worst"),
                    ((F.col("low") >= limit) & (2 * F.col("held") == F.col("room"))).alias("full"))


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", neighbours: int = NEIGHBOURS, audit: dict | None = None) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of one label link when their cosine is at least ``threshold``. ``audit``, if given, receives
    ``recall`` (the graph's own recall of the audited links of the labels refined in each round, None without such
    links), ``audited_whole`` (labels the audit saw all of) and ``compared_whole`` (labels that the rounds didn't
    settle).
    """
    spark = ready(vectors.sparkSession)
    all_rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                              F.col(vector_col).cast("array<double>").alias("x"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("x")
                        & F.exists("x", lambda a: a != 0), F.lit(False))
    rows = all_rows.filter(usable)
    classes = (rows.groupBy("label", "x").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")))
    d = max(1, rows.agg(F.max(F.size("x")).alias("d")).first()["d"] or 1)

    def rounded(batches):
        for b in batches:
            m = matrix(b.column(2), d, np.float64)
            q = np.rint(m * (127 / np.abs(m).max(1))[:, None]).astype(np.int8) if len(m) else m.astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), pa.array([r.tobytes() for r in q], pa.binary())],
                names=["label", "id", "x", "weight", "bytes"])

    label_type = all_rows.schema["label"].dataType.simpleString()
    base = stored(classes.select("label", "id", "x", "weight").mapInArrow(
        rounded, f"label {label_type}, id long, x array<double>, weight long, bytes binary")
        .withColumn("key", F.xxhash64("label")), "vectors")
    limit = threshold - SLACK
    truth, plan = _audit(base, threshold, d)
    links = truth.select("a", "b")
    open_labels = stored(plan.filter("label_n > 1").select("key", "label_n", "blocks", "done"), "open")
    graph = None
    for step in range(ROUNDS + 1):
        if open_labels.isEmpty():
            break
        if step == ROUNDS:
            links = links.union(_compared(base, open_labels.withColumn("upto", F.col("blocks")), threshold, d)
                                .select("a", "b"))
            break
        graph = _refine(base.join(open_labels.select("key", "label_n"), "key"), graph, step, limit, d, neighbours)
        open_labels = _unsettled(graph, truth, open_labels, limit, audit)
    if audit is not None:
        audit.setdefault("recall", [])
        audit["audited_whole"] = plan.filter("done = blocks").count()
        audit["compared_whole"] = open_labels.count()
    if graph is not None:
        links = links.union(graph.filter(F.col("cos") >= limit).select("u", "v"))
    comp = components(links)
    exact = stored(_exact(base, comp, threshold, d), "cosines")
    linked = components(exact.filter("b IS NOT NULL").select("a", "b"))
    counts = exact.filter("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    result = (base.select("label", "x", "id", "weight").join(counts, "id", "left").join(linked, "id", "left")
              .select("label", "x", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "id").alias("component_id")))
    out = (all_rows.withColumn("usable", usable).withColumn("label", F.when(F.col("usable"), F.col("label")))
           .join(result, ["label", "x"], "left"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _start(rows: DataFrame, step: int, d: int) -> DataFrame:
    """Cells of random hyperplanes, other ones each round, about half a CELL each; a fuller one is dealt into several."""
    def codes(batches):
        planes = np.random.RandomState(7 + step).randn(TABLES * 24, d)
        for b in batches:
            m = _unpack(b.column(2).to_pylist()) if b.num_rows else np.zeros((0, d), np.float32)
            bits = (m @ planes.T) > 0
            n = b.column(3).to_numpy()
            width = np.clip(np.ceil(np.log2(np.maximum(1, n / (CELL / 2)))), 0, 24).astype(np.int64)
            out = []
            for t in range(TABLES):
                code = bits[:, 24 * t: 24 * t + 24] @ (1 << np.arange(24, dtype=np.int64))
                out.append(code & ((np.int64(1) << width) - 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([list(c) for c in np.array(out).T], pa.list_(pa.int64()))],
                names=["key", "id", "bytes", "codes"])

    return (rows.select("key", "id", "bytes", "label_n")
            .mapInArrow(codes, "key long, id long, bytes binary, codes array<long>")
            .select("key", "id", "bytes", F.posexplode("codes").alias("tab", "code")))


def _refine(rows: DataFrame, graph: DataFrame | None, step: int, limit: float, d: int, neighbours: int) -> DataFrame:
    """The graph after a round on ``rows``: fresh hyperplane cells and, from the second round on, all that share
    a neighbour. All cells are dealt and solved together."""
    members = _start(rows, step, d).select("key", F.xxhash64("key", "tab", "code").alias("at"), "id",
                                           F.lit(-2.0).cast("float").alias("worst"), "bytes")
    sizes = members.groupBy("key", "at").agg(F.count("*").alias("size"))
    if graph is not None:
        lists = graph.filter("r = 1").select(F.col("u").alias("id"), "worst")
        both = (graph.select("key", F.col("v").alias("id"), F.col("u").alias("hub"))
                .union(graph.select("key", F.col("u").alias("id"), F.col("v").alias("hub"))).repartition("id").distinct())
        near = both.join(rows.select("id", "bytes"), "id").join(lists, "id")
        # both ways, so a class has as many hubs as it has members as a hub
        sizes = sizes.union(both.groupBy("key", "id").agg(F.count("*").alias("size"))
                            .select("key", F.xxhash64("id").alias("at"), "size"))
        members = members.union(near.select("key", F.xxhash64("hub").alias("at"), "id", "worst", "bytes"))
    fresh = (grouped(_cells(members, sizes, step), ["key", "at", "cell"], _best_pairs(neighbours), _GRAPH,
                     "key long, u long, v long, cos float").withColumn("room", F.lit(None).cast("int")))
    if graph is not None:
        fresh = graph.select(*fresh.columns).union(fresh)
    return stored(_merge(fresh, limit, neighbours), "graph")


def _unsettled(graph: DataFrame, truth: DataFrame, labels: DataFrame, limit: float, audit: dict | None) -> DataFrame:
    """Those of ``labels`` with a saturated list, where the audit hasn't seen the whole label, or with too few audited
    links inside the graph's components. What a saturated list keeps open is not audited unless ``audit`` asks for it."""
    # a list that was full of links has twice the room since
    full = graph.filter("r = 1 AND full").select("key").distinct().withColumn("full", F.lit(True))
    state = stored(labels.join(full, "key", "left").select(
        *labels.columns, (F.coalesce("full", F.lit(False)) & (F.col("done") < F.col("blocks"))).alias("open")), "open")
    asked = (state if audit is not None else state.filter("NOT open")).select("key")
    if asked.isEmpty():
        return state.select(*labels.columns)
    comp = components(graph.filter(F.col("cos") >= limit).join(asked, "key", "left_semi")
                      .select(F.col("u").alias("a"), F.col("v").alias("b")))
    ca = comp.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    cb = comp.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    found = (truth.join(asked, "key").join(ca, "a", "left").join(cb, "b", "left")
             .groupBy("key").agg(F.sum((F.coalesce("ca", "a") == F.coalesce("cb", "b")).cast("long")).alias("hit"),
                                 F.count("*").alias("asked")))
    found = stored(found, "recall")
    if audit is not None:
        hit, total = found.agg(F.sum("hit"), F.sum("asked")).first()
        audit.setdefault("recall", []).append(hit / total if total else None)
    return stored(state.join(found, "key", "left")
                  .filter(F.col("open") | F.coalesce(F.col("hit") < RECALL * F.col("asked"), F.lit(False)))
                  .select(*labels.columns), "open")


def _cells(members: DataFrame, sizes: DataFrame, salt: int = 0) -> DataFrame:
    """Members of a place dealt at random into cells of about CELL rows; nothing is left out but lone members."""
    cell = F.pmod(F.xxhash64("id", F.lit(salt)), F.ceil(F.col("size") / CELL).cast("long"))
    return members.join(sizes.filter("size > 1"), ["key", "at"]).select("key", "at", cell.alias("cell"), "id", "worst", "bytes")


def _unit(column: pa.Array, d: int) -> np.ndarray:
    m = matrix(column, d, np.float64)
    return m / np.sqrt((m * m).sum(1))[:, None]


def _unit_rows(rows: list[list[float]], d: int) -> np.ndarray:
    m = np.zeros((len(rows), d))
    for i, r in enumerate(rows):
        m[i, :len(r)] = r
    m /= np.abs(m).max(1)[:, None]  # squares neither vanish nor overflow
    return m / np.sqrt((m * m).sum(1))[:, None]


def _audit(base: DataFrame, threshold: float, d: int) -> tuple[DataFrame, DataFrame]:
    """True links ``(key, a, b)`` of random blocks of each label, and the labels with their number of blocks and of
    those that are done: more are taken until they show LINKS links or the label is compared whole."""
    plan = (base.groupBy("key").agg(F.count("*").alias("label_n"))
            .withColumn("rows", F.greatest(F.lit(BLOCK), F.least(F.lit(LARGE_BLOCK), F.ceil(F.col("label_n") / BLOCKS))))
            .select("key", "label_n", F.ceil(F.col("label_n") / F.col("rows")).cast("long").alias("blocks"),
                    F.lit(0).cast("long").alias("done"), F.lit(1).cast("long").alias("upto")))
    plan, truth = stored(plan, "plan"), None
    while True:
        found = stored(_compared(base, plan, threshold, d), "truth")
        truth = found if truth is None else truth.union(found)
        seen = truth.groupBy("key").agg(F.count("*").alias("seen"))
        few = F.coalesce("seen", F.lit(0)) < LINKS
        plan = stored(plan.join(seen, "key", "left").select(
            "key", "label_n", "blocks", F.col("upto").alias("done"),
            F.when(few, F.least(4 * F.col("upto"), "blocks")).otherwise(F.col("upto")).alias("upto")), "plan")
        if plan.filter("upto > done").isEmpty():
            return truth, plan


def _compared(base: DataFrame, plan: DataFrame, threshold: float, d: int) -> DataFrame:
    """Links ``(key, a, b)`` that span what the blocks ``done`` to ``upto`` of each label have among themselves
    and with all later blocks: cells of two blocks, each a spanning forest."""
    def units(batches):
        for b in batches:
            m = matrix(b.column(2), d, np.float64)
            m = m / np.abs(m).max(1, initial=0)[:, None]  # squares neither vanish nor overflow
            m = (m / np.sqrt((m * m).sum(1))[:, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in m], pa.binary())],
                                             names=["key", "id", "unit"])

    rows = base.select("key", "id", "x").mapInArrow(units, "key long, id long, unit binary")
    placed = (rows.join(plan.filter("upto > done").select("key", "blocks", "done", "upto"), "key")
              .withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks"))).filter("block >= done")
              .withColumn("other", F.explode(F.sequence(F.col("done"), F.when(
                  F.col("block") < F.col("upto"), F.col("blocks")).otherwise(F.col("upto")) - 1))))
    cells = placed.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                          "id", "unit")

    def solve(g):
        n = len(g["id"])
        if n < 2:
            return None
        m = np.frombuffer(b"".join(g["unit"]), np.float32).reshape(n, -1)
        ok = m @ m.T >= threshold - FLOAT_SLACK
        np.fill_diagonal(ok, False)
        if g["i"][0] != g["j"][0]:
            block = np.array(g["block"])
            ok &= block[:, None] != block[None, :]
        out = {"key": [], "a": [], "b": []}
        left = ok.any(1)
        for first in np.flatnonzero(left):
            if not left[first]:
                continue
            left[first] = False
            edge = [first]
            while edge:  # each class is reached once, from one that is linked to it
                p = edge.pop()
                new = np.flatnonzero(ok[p] & left)
                left[new] = False
                edge.extend(new)
                out["key"].extend([g["key"][0]] * len(new))
                out["a"].extend([g["id"][p]] * len(new))
                out["b"].extend(g["id"][q] for q in new)
        return out

    return grouped(cells, ["key", "i", "j"], solve, [("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())],
                   "key long, a long, b long")


def _exact(base: DataFrame, comp: DataFrame, threshold: float, d: int) -> DataFrame:
    """Double-precision links inside components, in cells of two blocks: (a, null, number) counts a class's
    links, (a, b, 0) are edges that span what is linked."""
    inside = comp.select("id", "component").union(comp.select(F.col("component").alias("id"), "component").distinct())
    sizes = inside.groupBy("component").agg(F.ceil(F.count("*") / CELL).cast("long").alias("blocks"))
    placed = (inside.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("id", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block"))
    cells = placed.join(base.select("id", "x", "weight"), "id")

    def solve(g):
        n = len(g["id"])
        if n < 2:
            return None
        m, w = _unit_rows(g["x"], d), np.array(g["weight"], np.int64)
        ok = m @ m.T >= threshold
        np.fill_diagonal(ok, False)
        if g["i"][0] != g["j"][0]:
            block = np.array(g["block"])
            ok &= block[:, None] != block[None, :]
        links = ok @ w
        root = list(range(n))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = {"a": [], "b": [], "n": []}
        for p in np.flatnonzero(links):
            out["a"].append(g["id"][p])
            out["b"].append(None)
            out["n"].append(int(links[p]))
        for p, q in zip(*np.nonzero(np.triu(ok))):
            x, y = find(p), find(q)
            if x != y:
                root[x] = y
                out["a"].append(g["id"][p])
                out["b"].append(g["id"][q])
                out["n"].append(0)
        return out

    return grouped(cells, ["component", "i", "j"], solve,
                   [("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())], "a long, b long, n long")
