import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import compact as C
from tidewater.operators.evolve import AddColumn, DropColumn, RenameColumn, WidenColumn
from tidewater.sources import evolving as EV
from tidewater.sources import published as P

FIRST = "id bigint, a int, b string, p string"


def three_generations(spark, path):
    EV.create(spark, path, T._parse_datatype_string(FIRST), ["p"])
    EV.append(spark.createDataFrame([(1, 10, "old", "x"), (2, 20, None, "y")], FIRST), path)
    EV.alter(spark, path, [RenameColumn("a", "c"), DropColumn("b"), AddColumn("b", "int")])
    EV.append(spark.createDataFrame([("x", 3, 30, 7)], "p string, id bigint, c int, b int"), path)
    EV.alter(spark, path, [RenameColumn("b", "a"), WidenColumn("c", "bigint"), AddColumn("b", "string", first=True)])
    EV.append(spark.createDataFrame([("new", 4, 40, "y", 8)], "b string, id bigint, c bigint, p string, a int"), path)
    return EV.read(spark, path)


ROWS = [(None, 1, 10, "x", None), (None, 2, 20, "y", None), (None, 3, 30, "x", 7), ("new", 4, 40, "y", 8)]


def test_rename_drop_and_a_name_used_again(spark, tmp_dir):
    df = three_generations(spark, tmp_dir + "/t")
    assert df.columns == ["b", "id", "c", "p", "a"] and dict(df.dtypes)["c"] == "bigint"
    assert sorted((tuple(r) for r in df.collect()), key=lambda r: r[1]) == ROWS
    # filters are pushed to each generation under its own names
    for cond, keep in (("a = 7", [3]), ("b = 'old'", []), ("b IS NULL", [1, 2, 3]), ("c >= 20 AND c < 40", [2, 3]), ("a IS NULL AND c > 10", [2]),
                       ("p = 'y' AND c > 5", [2, 4])):
        assert sorted(r.id for r in df.filter(cond).collect()) == keep, cond
    plan = df.filter("c >= 20")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(c,20)" in plan and "a#" in plan
    old = EV.read(spark, tmp_dir + "/t", 4)
    assert sorted(tuple(r) for r in old.select("id", "c", "b").collect()) == [(1, 10, None), (2, 20, None), (3, 30, 7)]
    assert sorted(r.b for r in EV.read(spark, tmp_dir + "/t", 2).collect() if r.b) == ["old"]


def test_compaction_brings_files_to_the_present_schema(spark, tmp_dir):
    path = tmp_dir + "/t"
    three_generations(spark, path)
    made = C.compact_table(spark, path, min_input_files=2)
    assert made.files == 2
    assert sorted((tuple(r) for r in EV.read(spark, path).collect()), key=lambda r: r[1]) == ROWS
    EV.alter(spark, path, [RenameColumn("c", "b2"), DropColumn("a"), AddColumn("c", "string")])
    assert sorted((r.id, r.b2, r.c) for r in EV.read(spark, path).collect()) == [(1, 10, None), (2, 20, None), (3, 30, None), (4, 40, None)]
    P.vacuum(spark, path)
    assert EV.read(spark, path).count() == 4


def test_faults(spark, tmp_dir):
    path = tmp_dir + "/t"
    EV.create(spark, path, T._parse_datatype_string(FIRST), ["p"])
    assert EV.read(spark, path).count() == 0 and EV.read(spark, path).columns == ["id", "a", "b", "p"]
    for changes, kind in (([DropColumn("p")], ValueError), ([RenameColumn("zz", "y")], ValueError), ([RenameColumn("a", "b")], ValueError),
                          ([AddColumn("a", "int")], ValueError), ([AddColumn("n", "int", after="zz")], ValueError), ([WidenColumn("a", "string")], TypeError)):
        with pytest.raises(kind):
            EV.alter(spark, path, changes)
    with pytest.raises(ValueError, match="columns differ"):
        EV.append(spark.range(1), path)
    assert P.version_numbers(spark, path) == [1]


def test_numbers_are_in_the_files(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    path = tmp_dir + "/t"
    EV.create(spark, path, T._parse_datatype_string("a int, b string"))
    EV.alter(spark, path, [DropColumn("a"), AddColumn("a", "int")])
    EV.append(spark.createDataFrame([("x", 1)], "b string, a int"), path)
    file = glob.glob(f"{path.removeprefix('file:')}/data/gen=000003*/*.parquet")[0]
    assert {f.name: f.metadata[b"PARQUET:field_id"] for f in pq.read_schema(file)} == {"b": b"2", "a": b"3"}
