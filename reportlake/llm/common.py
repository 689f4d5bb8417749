"""Helpers shared by the operators: shared scratch tables and grouped maps over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.session import configure, scratch_dir

#: Rows of one Arrow batch handed to Python; documents are long, so batches are short.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on (package shipped to workers, short Arrow batches)."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends at files that
    every executor can read, so a lost executor costs only its running tasks."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def arrow_schema(ddl_fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema(ddl_fields)


def grouped(df: DataFrame, keys: list[str], fn: Callable[[dict[str, list]], dict[str, list] | None],
            fields: list[tuple[str, pa.DataType]], schema: str, order: list[str] | None = None) -> DataFrame:
    """``fn`` once per key group, given the group's columns as lists; rows of one key must fit a task.

    Callers bound the groups (by salting or splitting) before they come here. Many small groups
    share one Arrow batch, which a pandas group map would pay for one by one.
    """
    names = df.columns
    at = [names.index(k) for k in keys]
    out_schema = pa.schema(fields)

    def run(batches):
        held: list[list] = [[] for _ in names]
        current = None
        ready_rows: list[dict[str, list]] = []
        n_ready = 0

        def flush():
            nonlocal ready_rows, n_ready
            cols = {f[0]: [] for f in fields}
            for r in ready_rows:
                for k, v in r.items():
                    cols[k].extend(v)
            ready_rows, n_ready = [], 0
            return pa.RecordBatch.from_arrays([pa.array(cols[f[0]], f[1]) for f in fields], schema=out_schema)

        def close():
            nonlocal n_ready
            got = fn(dict(zip(names, held)))
            if got and len(got[fields[0][0]]):
                ready_rows.append(got)
                n_ready += len(got[fields[0][0]])

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            n = b.num_rows
            key_rows = list(zip(*(cols[i] for i in at)))
            i = 0
            while i < n:
                k = key_rows[i]
                j = i + 1
                while j < n and key_rows[j] == k:
                    j += 1
                if current is not None and k != current:
                    close()
                    held = [[] for _ in names]
                    if n_ready >= 2000:
                        yield flush()
                current = k
                for h, c in zip(held, cols):
                    h.extend(c[i:j])
                i = j
        if current is not None:
            close()
        if ready_rows:
            yield flush()

    return (df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))
            .mapInArrow(run, schema))


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
