import random

import pytest
from pyspark.sql import functions as F

from carrel.sources import tables
from carrel.sources.csvrecords import csv_records

SCHEMA = "id string, a string, b string"


def drawn(seed, n):
    draw = random.Random(seed)
    parts = ["word", '"', "\n", ",", "\n\n", '""', "é", " ", "x" * 40, "💡", "end\n", '"\n"']
    text = lambda: "".join(draw.choice(parts) for _ in range(draw.randrange(0, 7)))
    return [(str(i), text(), text()) for i in range(n)]


def multiline(spark, path):
    """The reader that takes a file as a whole."""
    return spark.read.schema(SCHEMA).options(**tables.CSV_OPTIONS, multiLine="true").csv(path).na.fill("")


@pytest.mark.parametrize("seed", range(3))
def test_any_cut_gives_the_rows_of_the_whole_file(spark, tmp_path, small_splits, seed):
    path = str(tmp_path / "t")
    rows = drawn(seed, 300)
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.options(**tables.CSV_OPTIONS).csv(path)
    got = tables.read_csv(spark, path, SCHEMA)
    assert sorted(map(tuple, got.collect())) == sorted(rows) == sorted(map(tuple, multiline(spark, path).collect()))
    assert csv_records(spark, path).where("block > 0").count() > 100


def test_a_field_over_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    body = "line, with a comma\nand \"\"quotes\"\"\n" * 200
    path.write_text(f'id,a,b\n1,"{body}",x\n\n2,,"y\nz"\r\n3,"tail",""')
    got = sorted(map(tuple, tables.read_csv(spark, str(path), SCHEMA).collect()))
    assert got == [("1", body.replace('""', '"'), "x"), ("2", "", "y\nz"), ("3", "tail", "")]


def test_records_keep_their_order(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_text("id,a,b\n" + "".join(f'{i},"one\ntwo {i}",\n' for i in range(200)))
    rows = csv_records(spark, str(path)).orderBy("file", "block", "ord").collect()
    assert [r.text.split(",")[0] for r in rows] == ["id", *map(str, range(200))]
    assert csv_records(spark, str(path)).select(F.spark_partition_id()).distinct().count() > 5


def test_empty_and_broken_files(spark, tmp_path):
    for name, text, rows in (("none", "", []), ("head", "id,a,b\n", []), ("open", 'id,a,b\n1,"x\ny', 1), ("short", "id,a,b\n1\n", [("1", "", "")])):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        got = tables.read_csv(spark, str(path), SCHEMA).collect()
        assert len(got) == rows if isinstance(rows, int) else [tuple(r) for r in got] == rows
