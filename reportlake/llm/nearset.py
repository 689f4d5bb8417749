"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set holds its distinct word shingles (64-bit hashes). Equal sets are one class, so exact
copies of any number cost one row each. Classes then branch down independent trees: at every level a
class follows two minwise tokens of its set into two child nodes. Which two is a hash of the node, among the
tokens of the tree that the node's path has not used; trees have tokens of their own. A pair of similarity s
follows at least one common path of a tree with the probability p = 1 - (1 - s*p')^2, whose fixed point at 0.8
is 0.94, were all tokens fresh: four trees miss a pair at the threshold once in 65,000. With 32 tokens a tree,
simulated, they miss it 2 times in 100,000 after 4 levels, 3 after 6 and 6 after 8 and after 12. Nodes of one class vanish; small nodes are
compared exhaustively by the sizes of the sets and on sketches of 128 minwise bytes (a pair at the threshold
agrees in too few of them, fewer than 79 for 0.8, less than once in a million); a node that hardly shrinks any more
holds texts that are alike, and is taken whole.
What these comparisons connect is one candidate group, whichever and however many nodes found it. Groups are
chains, so a passage of very many documents makes a large one of texts that are not near each other. Links
are confirmed exactly on full sets: groups of up to 64 classes whole, larger ones in random blocks, each with the
group's pivot. Where several components are left, the classes outside the largest one meet all classes of the group of
a size that allows a link, on sketches only; full sets travel to the blocks in which a sketch has found a partner.
Nothing else is dropped, and no pairs are written down but those that join two components.

Nulls and ties: a null text or one without words has the empty set (0 shingles) and links with nothing; a
null id keeps its row, with a null component; rows that share an id count as one document; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import documents, grouped, ready, stored
from reportlake.llm.components import components

#: Independent trees, levels of a tree at most, paths chosen at a node, minwise tokens of a class for a tree
#: (more than levels) and in all; a sketch takes a byte of each.
TREES, LEVELS, PATHS, POOL = 4, 12, 2, 32
COORDINATES = TREES * POOL
#: Classes compared exhaustively, random passes over larger groups, classes of a block in the exact rest and
#: of one of sketches, tasks that share the rows of a group.
SMALL, PASSES, BLOCK, SKETCHES, SALTS = 64, 2, 256, 4096, 16
#: Share of pairs at the threshold whose sketches may agree too seldom.
MISSED = 1e-6

_M = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.RandomState(20240501)
_MUL = (_RNG.randint(0, 2**32, COORDINATES // 2).astype(np.uint64) << np.uint64(32)
        | _RNG.randint(0, 2**32, COORDINATES // 2).astype(np.uint64) | np.uint64(1))
_ADD = (_RNG.randint(0, 2**32, COORDINATES // 2).astype(np.uint64) << np.uint64(32)
        | _RNG.randint(0, 2**32, COORDINATES // 2).astype(np.uint64))


class _WordHash(dict):
    """Word → 64-bit hash, kept for repeated words; emptied when large (the hash never changes)."""

    def __missing__(self, word):
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int, seen: dict) -> np.ndarray:
    """Sorted distinct shingle hashes; words are runs between ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    k = min(width, len(w))
    h = w[: len(w) - k + 1].copy()
    for i in range(1, k):
        h = h * _M + w[i: len(w) - k + 1 + i]
    return np.unique(_mix(h + np.uint64(k)))


def _agree(percent: int) -> int:
    """Least number of equal sketch bytes of a candidate pair: the binomial tail below it is ``MISSED`` at most."""
    p, below = min(max(percent / 100, 0.0), 1.0), 0.0
    for k in range(COORDINATES):
        below += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if below > MISSED:
            return k
    return COORDINATES


def _summaries(width: int):
    fields = [("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("sig", pa.list_(pa.int32())),
              ("sketch", pa.binary())]

    def run(batches):
        seen = _WordHash()
        for b in batches:
            texts = b.column(1)
            for i in range(0, b.num_rows, 250):
                sets = [shingles(t, width, seen) for t in texts.slice(i, 250).to_pylist()]
                n = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                sig = np.empty((len(full), COORDINATES), np.uint32)
                if full:
                    flat = np.concatenate(full)
                    starts = np.concatenate(([0], np.cumsum(n[n > 0])[:-1]))
                    for c in range(COORDINATES // 2):  # a hash gives two tokens
                        halves = _mix(flat * _MUL[c] + _ADD[c]).view(np.uint32)
                        sig[:, c] = np.minimum.reduceat(halves[::2], starts)
                        sig[:, c + COORDINATES // 2] = np.minimum.reduceat(halves[1::2], starts)
                rows, sketches = iter(sig.view(np.int32)), iter(sig.astype(np.uint8))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, 250), pa.array(n),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32())),
                    pa.array([next(sketches).tobytes() if len(s) else None for s in sets], pa.binary())],
                    schema=pa.schema(fields))

    return run, "doc_id long, n long, key binary, sig array<int>, sketch binary"


def _full_sets(width: int):
    names = ["rep", "grp", "size", "pivot", "members"]

    def run(batches):
        seen = _WordHash()
        for b in batches:
            for i in range(0, b.num_rows, 250):
                sets = [shingles(t, width, seen) for t in b.column(4).slice(i, 250).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, 250) for c in range(4)), pa.array([x.tobytes() for x in sets], pa.binary())],
                    names=names)

    return run, "rep long, grp long, size long, pivot long, members binary"


def _choices(depth: int):
    """PATHS tokens of a node, hashed from it, out of those of its tree that ``used`` does not mark: each level
    has marked one."""
    left = POOL - depth
    first = F.pmod(F.xxhash64("tree", "node"), F.lit(left))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", "tree", F.lit(1)), F.lit(left - 1)), F.lit(left))
    free = F.filter(F.sequence(F.lit(0), F.lit(POOL - 1)),
                    lambda c: F.col("used").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), c)) == 0)
    return F.transform(F.array(first, second), lambda k: F.get(free, k.cast("int")))


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between classes that a node has together; they connect every candidate group."""
    level, found, small = None, [], []
    sigs = classes.select("rep", "sig")
    for depth in range(LEVELS):
        if depth == 0:
            roots = F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree")
            level = sigs.select("rep", "sig", roots, F.lit(0).cast("long").alias("node"),
                                   F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("size"))
        else:
            if depth == 1:  # deeper levels hold no other classes
                sigs = stored(sigs.join(level.select("rep").distinct(), "rep", "left_semi"), "sigs")
            level = level.join(sigs, "rep")
        token = F.get("sig", F.col("tree") * POOL + F.col("c"))
        paths = (level.withColumn("c", F.explode(_choices(depth)))
                 .select("rep", F.col("size").alias("above"), "tree", F.xxhash64("node", "tree", "c", token).alias("node"),
                         F.col("used").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("c"))).alias("used")))
        sizes = (paths.groupBy("tree", "node").agg(F.count("*").alias("size"), F.min("rep").alias("pivot"))
                 .filter("size > 1"))
        nodes = stored(paths.join(sizes, ["tree", "node"]), "paths")
        small.append(nodes.filter(F.col("size") <= SMALL).select("tree", "node", "rep"))
        large = nodes.filter(F.col("size") > SMALL)
        if depth == LEVELS - 1:
            dense = F.lit(True)
        elif depth == 0:
            dense = F.lit(False)
        else:  # a child with half of its parent's classes or more
            dense = 2 * F.col("size") >= F.col("above")
        found.append(large.filter(dense & (F.col("rep") != F.col("pivot")))
                     .select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
        level = large.filter(~dense).select("rep", "tree", "node", "used", "size")
        if depth == LEVELS - 1 or level.isEmpty():
            break
    nodes = reduce(DataFrame.union, small).join(classes.select("rep", "n", "sketch"), "rep")
    pairs = grouped(nodes.select("tree", "node", "rep", "n", "sketch"), ["tree", "node"], _alike(percent), _EDGE, "a long, b long")
    return reduce(DataFrame.union, found, stored(pairs.distinct(), "alike"))


def _alike(percent: int):
    """Classes of one node whose sizes and sketches allow a link, as a spanning forest."""
    least = _agree(percent)

    def run(g):
        reps = g["rep"]
        if len(reps) < 2:
            return None
        grid, n = _sketches(g["sketch"]), np.array(g["n"], np.int64)
        if len(reps) == 2:  # most nodes
            near = 100 * n.min() >= percent * n.max() and np.count_nonzero(grid[0] == grid[1]) >= least
            return {"a": [reps[1]], "b": [reps[0]]} if near and reps[0] != reps[1] else None
        return _forest(_near(grid, n, grid, n, percent, least), reps, reps)

    return run


def _sketches(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), COORDINATES)


def _near(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, percent: int, least: int) -> np.ndarray:
    """Which sketches of ``x`` agree with which of ``y`` in ``least`` bytes or more, their sets being of sizes that allow a link."""
    if len(x) * len(y) <= SMALL * SMALL:
        equal = (x[:, None, :] == y[None, :, :]).sum(2)
    else:
        equal, columns = np.zeros((len(x), len(y)), np.uint8), np.ascontiguousarray(y.T)
        for c in range(COORDINATES):
            equal += x[:, c, None] == columns[c]
    low, high = np.minimum(nx[:, None], ny), np.maximum(nx[:, None], ny)
    return (equal >= least) & (100 * low >= percent * high)


def _forest(ok: np.ndarray, reps: list, comps: list) -> dict:
    """Pairs of ``ok`` that join two components."""
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    a, b = [], []
    for i, j in zip(*np.nonzero(np.triu(ok, 1))):
        x, y = find(comps[i]), find(comps[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            a.append(reps[i])
            b.append(reps[j])
    return {"a": a, "b": b}


def _linker(percent: int):
    """Links inside one block, as a spanning forest; pairs of one component are not compared again."""

    def run(g):
        reps, comps = g["rep"], g["comp"]
        m = len(reps)
        if m < 2 or len(set(comps)) < 2:
            return None
        sets = [np.frombuffer(x, np.uint64) for x in g["members"]]
        n = np.array([len(s) for s in sets], np.int64)
        if m <= 4:
            inter = np.zeros((m, m), np.int64)
            for i in range(m):
                for j in range(i + 1, m):
                    inter[i, j] = inter[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        else:
            inter = _intersections(sets, n)
        ok = 100 * inter >= percent * (n[:, None] + n[None, :] - inter)
        return _forest(ok, reps, comps)

    return run


def _intersections(sets: list[np.ndarray], n: np.ndarray) -> np.ndarray:
    """Sizes of all pairwise intersections, over the shingles that two sets or more hold."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    inter = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int(shared.sum()), 8192):
        part = (column >= lo) & (column < lo + 8192)
        grid = np.zeros((len(sets), 8192), np.float32)
        grid[owner[part], column[part] - lo] = 1
        inter += grid @ grid.T
    return inter.astype(np.int64)


_EDGE = [("a", pa.int64()), ("b", pa.int64())]


def _with_components(members: DataFrame, comp: DataFrame) -> DataFrame:
    return (members.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .withColumn("comp", F.coalesce("component", "rep")).drop("component"))


def _told(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with what holds for their keys; those of one key are dealt over ``SALTS`` tasks."""
    facts = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("rep"), F.lit(SALTS))).join(facts, [*keys, "salt"]).drop("salt")


def _open_groups(members: DataFrame) -> DataFrame:
    """Members of groups that still hold two components or more; their sets don't meet by group."""
    facts = members.select("grp", "rep", "comp")
    still = facts.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    return members.join(_told(facts, still.select("grp"), ["grp"]).select("rep"), "rep", "left_semi")


def _compare(members: DataFrame, percent: int, salt: int) -> DataFrame:
    """One pass over groups: small ones whole, large ones in random blocks that each also hold the pivot."""
    blocks = F.ceil(F.col("size") / SMALL).cast("long")
    own = F.when(F.col("size") <= SMALL, F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("rep", F.lit(salt)), blocks))
    placed = members.withColumn("block", F.when(
        (F.col("size") > SMALL) & (F.col("rep") == F.col("pivot")),
        F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(own)))
    rows = placed.select("grp", F.explode("block").alias("block"), "rep", "comp", "members")
    return grouped(rows, ["grp", "block"], _linker(percent), _EDGE, "a long, b long")


def _compare_rest(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """All pairs across components of a group that sizes and sketches allow: the classes outside its largest
    component and their partners meet in blocks of the partners."""
    facts = _open_groups(members.drop("members"))
    by = facts.groupBy("grp", "comp").agg(F.count("*").alias("k"))
    main = by.groupBy("grp").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"))
    parts = F.ceil(F.col("size") / BLOCK).cast("long")
    m = (_told(facts, main, ["grp"]).join(classes.select("rep", "n", "sketch"), "rep")
         .select("grp", "rep", "comp", "n", "sketch", (F.col("comp") != F.col("main")).alias("minor"),
                 F.pmod(F.xxhash64("rep", F.lit(11)), parts).alias("part"), _band(percent).alias("band")))
    hits = stored(_meet(stored(m, "sketches"), percent).distinct(), "hits")
    blocks = (hits.filter("minor").groupBy("grp", "part").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("rows")))
    hits = hits.join(blocks, ["grp", "part"])
    row = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("rows"))
    placed = (hits.withColumn("row", F.explode(F.when(F.col("minor"), F.array(row)).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))).select("grp", "part", "row", "rep").distinct())
    rows = placed.join(members.select("rep", "comp", "members"), "rep")
    return grouped(rows.select("grp", "part", "row", "rep", "comp", "members"), ["grp", "part", "row"], _linker(percent), _EDGE,
                   "a long, b long")


def _band(percent: int):
    """Sizes in bands so wide that two sets which can link are in the same or in neighbouring ones."""
    return F.floor(F.log("n") / math.log(max(100 / max(percent, 1), 1.05)) * 0.999999)


def _meet(m: DataFrame, percent: int) -> DataFrame:
    """``grp, part, minor, rep``: a minor class with each part that holds a partner of it, and those partners."""
    near = F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])).alias("band")
    minors = m.filter("minor").select("grp", "rep", "comp", "n", "sketch", near)
    bands = (m.groupBy("grp", "band").agg(F.ceil(F.count("*") / SKETCHES).cast("long").alias("cols"))
             .join(minors.groupBy("grp", "band").agg(F.ceil(F.count("*") / SKETCHES).cast("long").alias("rows")), ["grp", "band"]))
    zero = F.lit(0).cast("long")
    left = (_told(minors, bands, ["grp", "band"]).withColumn("row", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("rows")))
            .withColumn("col", F.explode(F.sequence(zero, F.col("cols") - 1))).withColumn("part", F.lit(None).cast("long")))
    right = (_told(m, bands, ["grp", "band"]).withColumn("col", F.pmod(F.xxhash64("rep", F.lit(13)), F.col("cols")))
             .withColumn("row", F.explode(F.sequence(zero, F.col("rows") - 1))))
    names = ["grp", "band", "row", "col", "rep", "comp", "n", "sketch", "part"]
    return grouped(left.select(*names).union(right.select(*names)), ["grp", "band", "row", "col"], _partners(percent),
                   [("grp", pa.int64()), ("part", pa.int64()), ("minor", pa.bool_()), ("rep", pa.int64())],
                   "grp long, part long, minor boolean, rep long")


def _partners(percent: int):
    least = _agree(percent)

    def run(g):
        reps, comps, n = (np.array(g[k], np.int64) for k in ("rep", "comp", "n"))
        minor = np.array([p is None for p in g["part"]], bool)
        y = np.nonzero(~minor)[0]
        part, grid = np.array([g["part"][i] for i in y], np.int64), _sketches(g["sketch"])
        found, partner = set(), np.zeros(len(y), bool)
        for i in np.array_split(np.nonzero(minor)[0], max(1, int(minor.sum()) // 256)):
            ok = _near(grid[i], n[i], grid[y], n[y], percent, least) & (comps[i][:, None] != comps[y])
            partner |= ok.any(0)
            a, b = np.nonzero(ok)
            found.update(zip(reps[i][a].tolist(), part[b].tolist()))
        rows = [(p, True, r) for r, p in found] + [(p, False, r) for r, p in zip(reps[y][partner].tolist(), part[partner].tolist())]
        return {"grp": [g["grp"][0]] * len(rows), "part": [r[0] for r in rows], "minor": [r[1] for r in rows],
                "rep": [r[2] for r in rows]}

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents link when ``100 * |A ∩ B| >= percent * |A ∪ B|`` on their full sets of ``width``-word
    shingles; ``component_id`` is the smallest id reachable over links and ``kept`` marks that document.
    """
    ready(docs.sparkSession)
    docs = documents(docs, id_col, text_col)
    run, schema = _summaries(width)
    rows = stored(docs.mapInArrow(run, schema), "shingles")
    linked = rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(linked.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"),
                                               F.first("sketch").alias("sketch")), "classes")
    # rows that share an id are one document: their classes meet at it
    shared = (linked.groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
              .filter("lo <> hi").select("doc_id"))
    same_id = stored(linked.join(shared, "doc_id", "left_semi").join(classes.select("rep", "key"), "key")
                     .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), "same-id")

    group = components(_candidates(classes.select("rep", "n", "sig", "sketch"), percent))
    group = group.union(group.select(F.col("component").alias("id"), "component").distinct())
    sizes = group.groupBy("component").agg(F.count("*").alias("size"))
    group = group.join(sizes, "component").select(
        F.col("id").alias("doc_id"), F.col("component").alias("grp"), "size", F.col("component").alias("pivot"))
    run, schema = _full_sets(width)
    # the candidates grow with the corpus, so they are never broadcast: the join has one plan at every size
    sets = stored(docs.join(stored(group, "candidates").hint("merge"), "doc_id").select("doc_id", "grp", "size", "pivot", "text")
                  .mapInArrow(run, schema), "sets")
    edges = stored(same_id.union(_compare(sets.withColumn("comp", F.col("rep")), percent, 1)), "links")
    comp = components(edges)
    large = sets.filter(F.col("size") > SMALL)
    if not large.isEmpty():
        for salt in range(2, PASSES + 1):
            edges = stored(edges.union(_compare(_open_groups(_with_components(large, comp)), percent, salt)), "links")
            comp = components(edges)
        comp = components(edges.union(_compare_rest(_with_components(large, comp), classes, percent)))

    of_class = (_with_components(classes.select("rep", "key"), comp)
                .select("key", F.col("comp").alias("component_id")))
    out = rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    out = out.join(of_class, "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"))
