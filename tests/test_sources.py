"""CSV records cut at every byte range, and stages that are found again."""

import random
import time

import pytest
from pyspark.sql import functions as F

from letterloom.operators.store import COMMIT, StageStore
from letterloom.sources import logs, multiline


def csv_text(seed=1, n=40):
    rng = random.Random(seed)
    pieces = ["a", "b,c", "line\nbreak", 'say ""x""', "\n\n", "é ü", '""', "end\r\nof", ""]
    rows = ["mid,date,body,recipients"]
    for k in range(n):
        body = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 5)))
        rows.append(f'{k},2001-01-01,"{body}",x@y' if rng.random() < 0.7 else f"{k},2001-01-02,plain {k},z@y")
    return "\n".join(rows) + "\n"


def spark_rows(spark, path):
    reader = spark.read.schema(logs.INFO_SCHEMA).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return sorted(map(str, reader.csv(path).collect()))


@pytest.mark.parametrize("size", [5, 13, 64, 1 << 20])
def test_records_at_every_range_border(spark, tmp_path, size):
    folder = tmp_path / "csv"
    folder.mkdir()
    for k in range(2):
        (folder / f"{k}.csv").write_bytes(csv_text(k).encode())
    (folder / "empty.csv").write_bytes(b"")
    want = spark_rows(spark, str(folder))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, (str(size), str(size), "1")):
            spark.conf.set(name, value)
        read = multiline.read_multiline_csv(spark, str(folder), logs.INFO_SCHEMA)
        lines = multiline._lines(spark, str(folder))
        assert size > 100 or lines.select("file", "block").distinct().count() > 20
        assert sorted(map(str, read.collect())) == want
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_malformed_records_are_counted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(multiline, "MAX_LINES", 3)
    (tmp_path / "x.csv").write_text('mid,date,body,recipients\n1,d,b,r\nnot a number,d,b,r\n2,d,"a\nb",r\n3,d,"open\n4\n5\n6\n7')
    got = multiline.parse_records(multiline.read_records(spark, str(tmp_path / "x.csv")), logs.INFO_SCHEMA)
    assert sorted((r.record, r.mid, r.malformed) for r in got.collect()) == [(2, 1, False), (3, None, True), (4, 2, False), (5, None, True)]


def test_stage_is_reused_and_renewed(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(50).write.parquet(source)
    table = lambda: spark.read.parquet(source).withColumn("x", F.col("id") * 2)
    store = StageStore(spark, str(tmp_path / "store"))
    first = store.get(table(), "double", p=1)
    again = StageStore(spark, str(tmp_path / "store"))
    assert again.get(table(), "double", p=1).inputFiles() == first.inputFiles() and (store.written, again.written) == (1, 0)
    assert sorted(r.x for r in again.get(table(), "double", p=1).collect()) == list(range(0, 100, 2))
    again.get(table(), "double", p=2)
    again.get(table().where("id > 3"), "double", p=1)
    assert again.written == 2
    spark.range(50, 60).write.mode("append").parquet(source)
    assert again.get(table(), "double", p=1).count() == 60 and again.written == 3
    with pytest.raises(ValueError):
        again.get(spark.range(3), "range")


def test_uncommitted_stage_is_not_read(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    table = lambda: spark.read.parquet(source)
    store = StageStore(spark, str(tmp_path / "store"))
    home = tmp_path / "store" / "s" / store.key(table(), {"p": 1})
    spark.range(99).write.parquet(str(home / "data-killed"))  # a writer that got no further
    assert store.get(table(), "s", p=1).count() == 5 and store.written == 1
    data = store.get(table(), "s", p=1).inputFiles()[0].removeprefix("file://")
    open(data, "wb").close()  # a part that is no longer whole
    assert store.get(table(), "s", p=1).count() == 5 and store.written == 2
    assert (home / COMMIT).exists()
    assert store.collect(3600) == 0
    time.sleep(0.01)
    assert store.collect(0) == 1 and not home.exists()
