"""Vector and page operators against their SQL and brute force; the pipeline; queries against DuckDB."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from awkward_tables import awkward  # noqa: F401
from conftest import SF
from reportlake.llm import nearset, nndescent, queries, topk, warc
from reportlake.llm.common import stored
from reportlake.session import scratch_dir


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[key](spark, SF)
    names = sorted(df.columns)
    res = con.execute(queries.ORACLE_SQL[key])
    order = [c[0] for c in res.description]
    want = sorted((tuple(r[order.index(c)] for c in names) for r in res.fetchall()), key=repr)
    assert sorted(order) == names and sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == want


def test_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(E.queries())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell int, block long, query string")


AWKWARD = [(1, [1.0, 0.0], 1, 1, 1, "q"), (1, [1.0, 0.0], 1, 1, 1, "q"), (2, [1.0, 0.01], 1, None, None, None), (3, None, 1, 1, 1, "q"),
           (4, [float("nan"), 1.0], 1, 1, 1, "q"), (5, [None, 1.0], 1, 1, 1, "q"), (6, [0.0, 0.0], 1, 1, 1, "q"),
           (None, [1.0, 0.0], 1, 1, 1, "q"), (7, [1.0, 0.0], None, 1, 1, "q"), (8, [1.0], 1, 1, 1, "q"), (9, [float("inf"), 0.0], 1, 1, 1, "q"),
           (10, [], 2, 1, 1, "q"), (50, [1.0, 0.0], 2, 1, 1, "q")]


def test_top_k_awkward(spark):
    got = topk.top_k(vectors(spark, AWKWARD), F.col("vec_id") % 50 == 0, 5).orderBy("rank").collect()
    # candidates of query 50: 1, 1, 2, 6, 7, 8, 10 with scores 65536 (four times), 2 has 65536 too
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [
        (50, 1, 1, 65536), (50, 2, 1, 65536), (50, 3, 2, 65536), (50, 4, 7, 65536), (50, 5, 8, 65536)]
    assert topk.top_k(vectors(spark, []), F.lit(True)).count() == 0
    assert topk.top_k(vectors(spark, AWKWARD[:1]), F.lit(True)).count() == 0  # no candidates


def test_top_k_large_numbers_and_many_groups(spark, monkeypatch):
    rng = np.random.RandomState(1)
    x = (rng.randn(300, 3) * 1e6).astype(np.float32)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 7)
    monkeypatch.setattr(topk, "BLOCK", 50)
    d = vectors(spark, [(i, r.tolist(), 0, 0, 0, "") for i, r in enumerate(x)])
    y = np.floor(x.astype(np.float64) * 256).astype(np.int64).astype(object)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(d, F.col("vec_id") % 5 == 0, 4).collect())
    want = [(i, k + 1, j, s) for i in range(0, 300, 5)
            for k, (s, j) in enumerate(sorted(((int(y[i] @ y[j]), j) for j in range(300) if j != i), key=lambda p: (-p[0], p[1]))[:4])]
    assert got == want


def test_near_vectors_awkward(spark):
    got = {r["vec_id"]: r for r in nndescent.near_vectors(vectors(spark, AWKWARD)).collect()}
    assert len(got) == 12 and got[2]["component_id"] == 1 and got[2]["n_links"] == 3 and not got[2]["kept"]
    assert got[1]["n_links"] == 3 and got[8]["component_id"] == 1  # each other copy of 1, 2 and 8
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in (3, 4, 5, 6, 7, 9, 10, 50))
    assert nndescent.near_vectors(vectors(spark, [])).count() == 0


def test_near_vectors_recall_with_a_dense_group(spark):
    rng = np.random.RandomState(2)
    centres = rng.randn(150, 32)
    x = np.concatenate([rng.randn(900, 32), centres, centres + 0.15 * rng.randn(150, 32),
                        rng.randn(32) + 0.15 * rng.randn(300, 32)]).astype(np.float32)
    label = rng.randint(0, 2, len(x))
    label[900:1050] = label[1050:1200]
    label[1200:] = 1
    audit = {}
    d = vectors(spark, [(i, r.tolist(), int(k), 0, 0, "") for i, (r, k) in enumerate(zip(x, label))]).repartition(6)
    got = {r["vec_id"]: r["n_links"] for r in nndescent.near_vectors(d, 0.93, audit=audit).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    true = ((u @ u.T >= 0.93) & (label[:, None] == label[None, :])).sum(1) - 1
    assert all(got[i] <= true[i] for i in got) and sum(got.values()) >= 0.99 * true.sum() and audit["recall"][-1] >= 0.99


@pytest.mark.parametrize("links,rounds", [(300, 6), (20, 6), (20, 1)])
def test_near_vectors_finds_every_lone_pair(spark, monkeypatch, links, rounds):
    """Few pairs just over the threshold in a large label: by the graph with an audit of all of the label, by the graph
    with a sample as audit, by the last resort."""
    for name, value in (("CELL", 16), ("BLOCK", 64), ("LARGE_BLOCK", 64), ("LINKS", links), ("ROUNDS", rounds)):
        monkeypatch.setattr(nndescent, name, value)
    rng = np.random.RandomState(4)
    x = rng.randn(2000, 64)
    side = rng.randn(40, 64)
    for i in range(40):
        side[i] -= side[i] @ x[i] / (x[i] @ x[i]) * x[i]
        x[1000 + i] = x[i] / np.linalg.norm(x[i]) + 0.39 * side[i] / np.linalg.norm(side[i])
    u = x.astype(np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = u @ u.T >= 0.93
    audit = {}
    d = vectors(spark, [(i, r.tolist(), 1, 0, 0, "") for i, r in enumerate(x)]).repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nndescent.near_vectors(d, 0.93, audit=audit).collect()}
    assert near.sum() == 2000 + 2 * 40 and got == {i: (int(near[i].sum()) - 1, int(np.flatnonzero(near[i])[0])) for i in got}
    assert len(audit["recall"]) >= 1 and audit["audited_whole"] == int(links == 300)
    assert rounds == 6 or audit["compared_whole"] == 1


def test_near_vectors_takes_few_jobs_while_lists_are_saturated(spark, monkeypatch):
    """What every job leaves behind adds up in the driver; a group of near copies keeps its label open to the last round."""
    for name, value in (("CELL", 16), ("BLOCK", 64), ("LARGE_BLOCK", 64), ("LINKS", 20)):
        monkeypatch.setattr(nndescent, name, value)
    rng = np.random.RandomState(5)
    x = np.concatenate([rng.randn(400, 32), rng.randn(32) + 0.1 * rng.randn(300, 32)]).astype(np.float32)
    d = vectors(spark, [(i, r.tolist(), 1, 0, 0, "") for i, r in enumerate(x)]).repartition(4)
    sc = spark.sparkContext
    sc.setJobGroup("saturated", "near_vectors")
    try:
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nndescent.near_vectors(d, 0.93).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert got == {i: (299, 400) if i >= 400 else (0, i) for i in range(700)}
    assert len(sc.statusTracker().getJobIdsForGroup("saturated")) <= 180


def test_near_vectors_of_the_table_come_through_the_graph(spark):
    """Every label of the given table is refined, whatever its size, and the graph alone finds the audited links."""
    audit = {}
    nndescent.near_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"), 0.93, audit=audit)
    assert audit["recall"] and audit["compared_whole"] == 0
    assert all(r is None or r >= 0.999 for r in audit["recall"][-1:])


def test_warc_round_trip(spark):
    big = "é<html>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "z" * 1200
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (None, "n", big),
            (2, "http://b", big), (6, "u", "")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("bytes", F.lit("x"))
    path = f"{scratch_dir(spark, 'warc-test')}/a"
    warc.write(d, path)
    got = warc.read(spark, path, with_payload=True).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] in (1, None):
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", 2, None)
        else:
            assert r["record_type"] == "response" and r["refers_to"] is None
    assert {bytes(r["payload"]).decode() for r in got if r["page_id"] == 2} == {big}
    assert {r["payload_bytes"] for r in got if r["page_id"] in (1, 2, None)} == {len(big.encode())}
    warc.write(d.limit(0), path + "-empty")
    assert warc.read(spark, path + "-empty").count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stored(stage(spark, docs, SF), "test-stage")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= before.count()
        if name == "near duplicates":
            groups = nearset.near_duplicates(before, 5, 80).filter("kept").select("doc_id").distinct()
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(r[0] for r in groups.collect())
        if name == "personal data":
            assert docs.count() == before.count()
            assert docs.filter(F.col("text").rlike(r"[a-z]@[a-z0-9]+\.")).isEmpty()
    assert docs.select("doc_id").distinct().count() == before.count()


def test_pipeline_keeps_rows_with_nulls(spark, awkward):
    d = awkward.select("doc_id", "text", F.col("grp").alias("lang"), F.col("rep").alias("source"), F.col("size").cast("long").alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stored(stage(spark, d, SF), "test-null")
    assert sorted(r[0] or 0 for r in d.select("doc_id").collect()) == [0, 1, 3, 4, 5, 6, 7]
