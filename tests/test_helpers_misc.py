import os
import shutil

from flowmart.operators import dim
from flowmart.sources.jdbc import snake_to_camel
from flowmart.streaming import sinks


def test_snake_to_camel():
    assert snake_to_camel("sink_table") == "sinkTable"
    assert snake_to_camel("id") == "id"


def test_a_table_is_created_once(spark, tmp):
    path = "file://" + os.path.join(tmp, "dim_t")  # a URI, as on a shared store
    sinks.create_wide(spark, path, "id,name", None)
    df = sinks.read_wide(spark, path)
    assert df.columns == ["id", "name"] and df.count() == 0
    sinks.create_wide(spark, path, "id,name,more", None)  # exists: untouched
    assert sinks.read_wide(spark, path).columns == ["id", "name"]


CELLS = "pk string, column string, value string"


def test_wide_upserts_keep_what_a_batch_does_not_name(spark, tmp):
    path = os.path.join(tmp, "t")

    def put(batch_id, rows, columns="id,name,v"):
        sinks.upsert_wide(spark.createDataFrame(rows, CELLS), path, columns, None, batch_id, buckets=4)

    def table():
        return sorted(map(tuple, sinks.read_wide(spark, path).collect()), key=repr)

    put(0, [(str(i), c, f"{c}{i}") for i in range(20) for c in ("name", "v")] + [(str(i), "id", str(i)) for i in range(20)])
    assert len(table()) == 20
    put(1, [("3", "id", "3"), ("3", "v", "new"), ("x", "id", "x"), ("x", "name", "y")])
    put(1, [("3", "id", "3"), ("3", "v", "new"), ("x", "id", "x"), ("x", "name", "y")])  # replayed
    got = {r[0]: r[1:] for r in table()}
    assert len(got) == 21 and got["3"] == ("name3", "new") and got["x"] == ("y", None) and got["4"] == ("name4", "v4")
    put(2, [("4", "id", "4"), ("4", "w", "wide")], "id,w")  # a rule that names a new column
    got = {r["id"]: r for r in sinks.read_wide(spark, path).collect()}
    assert got["4"].w == "wide" and got["4"].v == "v4" and got["3"].w is None
    put(3, [])
    assert len(table()) == 21


def test_a_stopped_upsert_is_finished_by_its_replay(spark, tmp):
    """The batch's buckets were written beside the table, one was lost on the way into it."""
    path = os.path.join(tmp, "t")
    rows = [(str(i), "id", str(i)) for i in range(30)] + [(str(i), "v", "a") for i in range(30)]
    sinks.upsert_wide(spark.createDataFrame(rows, CELLS), path, "id,v", None, 0, buckets=3)
    new = spark.createDataFrame([(str(i), "v", "b") for i in range(10)], CELLS)
    sinks.upsert_wide(new, path, "id,v", None, 1, buckets=3)
    want = sorted(map(tuple, sinks.read_wide(spark, path).collect()))
    shutil.rmtree(os.path.join(path, "bucket=1"))
    sinks.upsert_wide(new, path, "id,v", None, 1, buckets=3)
    assert sorted(map(tuple, sinks.read_wide(spark, path).collect())) == want
    assert os.path.exists(f"{path}.next/batch_id=1") and not os.path.exists(f"{path}.next/batch_id=0")


def test_merge_into(spark):
    current = spark.createDataFrame([("1", "old", "keep"), ("3", "c", "z")], "id string, name string, v string")
    new_cells = spark.createDataFrame([("1", "name", "new"), ("4", "name", "d")],
                                      "pk string, column string, value string")
    merged = dim.merge_into(current, new_cells, ["id", "name", "v"])
    got = sorted(tuple(r) for r in merged.collect())
    # new values win per cell; untouched cells keep the current value
    assert got == [("1", "new", "keep"), ("3", "c", "z"), ("4", "d", None)]
    # the key is the configured one, whether or not there is an id
    by_code = spark.createDataFrame([("x", "7")], "code string, id string")
    cells = spark.createDataFrame([("x", "id", "8"), ("y", "id", "9")], "pk string, column string, value string")
    merged = dim.merge_into(by_code, cells, ["code", "id"], "code")
    assert sorted(tuple(r) for r in merged.collect()) == [("x", "8"), ("y", "9")]
