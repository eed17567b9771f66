"""Quoted CSV in many splits against Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.sources import listings, quoted_csv


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, n, newline, seed=1):
    r = random.Random(seed)
    pieces = ["Stan", "5 soba, lux", 'tzv. "salonac"', "red\nnovi red", "é š ž", "", " ", '""', "a\n\nb", "x" * 300, "\n"]

    def field(x):
        return '"' + x.replace('"', '""') + '"' if any(c in x for c in ',"\n') or r.random() < 0.2 else x

    rows = [["title", "description", "price"]] + [
        [str(i), " ".join(r.choice(pieces) for _ in range(r.randint(0, 6))), str(r.randint(1, 9**9))] for i in range(n)]
    text = newline.join(",".join(field(x) for x in row) for row in rows) + (newline if seed % 2 else "")
    path.write_bytes(text.encode())


def plain(spark, path):
    return spark.read.option("header", True).options(**quoted_csv.OPTIONS).csv(str(path))


@pytest.mark.parametrize("newline,seed", [("\n", 1), ("\n", 2), ("\r\n", 3)])
def test_equals_the_one_task_reader(small_splits, tmp_path, newline, seed):
    write(tmp_path / "a.csv", 400, newline, seed)
    write(tmp_path / "b.csv", 37, newline, seed + 2)
    got = quoted_csv.read(small_splits, str(tmp_path))
    want = plain(small_splits, tmp_path)
    assert got.drop("_ord").columns == want.columns
    rows = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert rows(got.drop("_ord")) == rows(want) and len(rows(want)) == 437
    lines = quoted_csv._lines(small_splits, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    assert got.select("_ord.block").distinct().count() > 20  # records come from many splits
    first = got.where("title = '0'").select("_ord").first()[0]
    assert got.groupBy("_ord").count().where("count > 1").count() == 0 and first["block"] == 0


def test_order_is_that_of_the_file(small_splits, tmp_path):
    write(tmp_path / "a.csv", 300, "\n")
    got = quoted_csv.read(small_splits, str(tmp_path)).orderBy("_ord").select(F.col("title").cast("int")).collect()
    assert [r[0] for r in got] == list(range(300))


def test_a_record_is_parsed_once_and_pieces_are_cut_apart(small_splits, tmp_path):
    write(tmp_path / "a.csv", 100, "\r\n")
    plan = quoted_csv.read(small_splits, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1
    (tmp_path / "b.csv").write_bytes(b"title,description,price\r\n1,a,2\r\n\r\n\r\n" + b"3,b\r,4\r\n" * 60 + b'5,"x\ny",6\r\n')
    found = [(r["pos"], r["record"]) for r in quoted_csv.records(small_splits, str(tmp_path / "b.csv")).where("block = 0").collect()]
    found.sort()
    assert found[:4] == [(0, "title,description,price"), (1, "1,a,2"), (2, "3,b\r,4"), (3, "3,b\r,4")]
    assert [p for p, _ in found] == list(range(len(found)))


def test_a_number_is_stripped_once(spark, tmp_path):
    columns = ",".join(S.RAW_COLUMNS)
    (tmp_path / "a.csv").write_text(columns + "\n" + "a,b,\u00a0 7.5,NaN,c,d,e,f,x,g,h,n/a,u\n")
    df = listings.typed(listings.read_raw(spark, str(tmp_path)))
    assert df._jdf.queryExecution().executedPlan().toString().count("regexp_replace(area_m2") == 1
    row = df.first()
    assert (row["area_m2"], row["price_eur"], row["rooms"], row["year_built"]) == (7.5, None, None, None)


def test_one_record_over_many_splits(small_splits, tmp_path):
    long = "\n".join(f"line {i}" for i in range(900))
    (tmp_path / "a.csv").write_text(f'title,description,price\n1,"{long}",2\n3,"{long}\n",4\n\n5,six,7\n')
    got = {r["title"]: (r["description"], r["price"]) for r in quoted_csv.read(small_splits, str(tmp_path)).collect()}
    assert got == {"1": (long, "2"), "3": (long + "\n", "4"), "5": ("six", "7")}


def test_unpaired_quotes_are_read_by_one_task(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('title,description,price\n1,5" pipe,2\n3,x,4\n')
    with pytest.raises(quoted_csv.UnpairedQuotes):
        quoted_csv.records(small_splits, str(tmp_path))
    assert quoted_csv.read(small_splits, str(tmp_path)).count() == plain(small_splits, tmp_path).count()


def test_header_alone_and_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,description,price\n")
    assert quoted_csv.read(spark, str(tmp_path)).count() == 0
