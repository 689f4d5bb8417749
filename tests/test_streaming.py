import os

import pytest

from reportlake.plans.lake import Lake
from reportlake.streaming.dropfolder import append_stream, batch_name
from samples import write


def test_drop_folder_append(spark, lake, workdir):
    base = lake.ingest_file(write(workdir, "base.csv", "id,v\n1,a\n"), "csv")[0]
    drop, ckpt = f"{workdir}/drop", f"{workdir}/ckpt"
    os.makedirs(drop)
    write(drop, "f1.csv", "id,v\n2,b\n")
    write(drop, "f2.csv", "v,id,extra\nc,3,x\n")
    reports = []
    append_stream(lake, base["source_id"], drop, ckpt, reports=reports).awaitTermination()
    t = lake.table(base["physical_name"])
    assert t.count() == 3 and t.columns == ["id", "v", "extra"]
    assert [r[0]["rowsAppended"] for r in reports] == [1, 1]
    write(drop, "f3.csv", "id\n4\n")
    append_stream(lake, base["source_id"], drop, ckpt).awaitTermination()  # only the new file
    append_stream(lake, base["source_id"], drop, ckpt).awaitTermination()  # nothing new
    assert lake.table(base["physical_name"]).count() == 4


def test_replayed_micro_batch_leaves_one_copy(spark, lake, workdir, monkeypatch):
    """The writer dies between the inserts and the commit, then right after the commit; the stream starts again both times."""
    base = lake.ingest_file(write(workdir, "base.csv", "id\n1\n"), "csv")[0]
    drop, ckpt = f"{workdir}/drop", f"{workdir}/ckpt"
    os.makedirs(drop)
    write(drop, "f1.csv", "id,note\n2,x\n")
    write(drop, "f2.csv", "id,note\n3,y\n")
    real, calls = type(lake)._commit, []

    def dies(self, source_id, batch, new_columns):
        calls.append(batch)
        if len(calls) == 2:
            raise SystemError("killed before the commit")
        real(self, source_id, batch, new_columns)
        if len(calls) == 3:
            raise SystemError("killed after the commit")

    monkeypatch.setattr(type(lake), "_commit", dies)
    for _ in range(2):
        with pytest.raises(Exception):
            append_stream(lake, base["source_id"], drop, ckpt).awaitTermination()
    assert calls[1] == calls[2] == batch_name(ckpt, 0, 1)
    monkeypatch.setattr(type(lake), "_commit", real)
    again = Lake(spark, lake.db)
    append_stream(again, base["source_id"], drop, ckpt).awaitTermination()
    t = again.table(base["physical_name"])
    assert sorted((r["id"], r["note"]) for r in t.collect()) == [(1, None), (2, "x"), (3, "y")]
