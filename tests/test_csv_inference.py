"""CSV headers by file in one scan, inferred types, and what the sink must not lose."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from quaylake.sources import csv_io
from quaylake.sources.csv_io import csv_schema, infer_csv_types, read_csv, read_csv_inferred, split_csv, write_csv

PAIR = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def files(folder, texts):
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/part-{i:05d}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def scans(df, kind):
    return df._jdf.queryExecution().executedPlan().toString().count(f"FileScan {kind}")


def test_ten_thousand_files_with_two_header_orders(spark, tmp_dir):
    texts = [f"id,name\n{i},a{i}\n" if i % 3 else f"name,id\na{i},{i}\n" for i in range(10_000)]
    df = read_csv(spark, files(f"{tmp_dir}/many", texts), PAIR)
    rows = df.collect()
    assert len(rows) == 10_000 and all(r["name"] == f"a{r['id']}" for r in rows)


def test_one_text_scan_with_the_same_header(spark, tmp_dir):
    path = files(f"{tmp_dir}/same", ["name,id\nx,1\n", "name,id\ny,2\nz,3\n"])
    df = read_csv(spark, path, PAIR, headers="same")
    assert scans(df, "csv") == 1 and scans(df, "text") == 0
    assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, "y"), (3, "z")]
    other = read_csv(spark, files(f"{tmp_dir}/other", ["name,id\nx,1\n", "id,name\n2,y\n"]), PAIR, headers="same")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        other.collect()
    with pytest.raises(ValueError):
        read_csv(spark, path, PAIR, headers="none")


def test_by_file_reads_the_text_once(spark, tmp_dir, monkeypatch):
    seen = []
    whole = csv_io._text_reader
    monkeypatch.setattr(csv_io, "_text_reader", lambda *a: seen.append(1) or whole(*a))
    path = files(f"{tmp_dir}/by_file", ["name,id\nx,1\n", "id,name\n2,y\n"])
    df = read_csv(spark, path, PAIR)
    assert len(seen) == 1 and scans(df, "csv") == 0 and scans(df, "text") == 0
    assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, "y")]


def test_blocks_without_a_header_take_that_of_their_file(spark, tmp_dir):
    head = ["id,name\n", "name,id\n"]
    lines = [[f"{i},{'n' * 40}{i}\n" if k == 0 else f"{'n' * 40}{i},{i}\n" for i in range(k, 6000, 2)] for k in (0, 1)]
    path = files(f"{tmp_dir}/blocks", [head[k] + "".join(lines[k]) for k in (0, 1)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_csv(spark, path, PAIR)
        assert sorted(r["id"] for r in df.collect()) == list(range(6000))
        assert df.where("name = concat(repeat('n', 40), id)").count() == 6000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_row_like_the_header_is_data(spark, tmp_dir):
    text = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])
    path = files(f"{tmp_dir}/like", ["b,a\nb,a\na,b\n", "a,b\n"])
    assert sorted(map(tuple, read_csv(spark, path, text).collect())) == [("a", "b"), ("b", "a")]


def test_wrong_headers_and_bad_records(spark, tmp_dir):
    for head in ("id,nom", "id", "id,name,more"):
        with pytest.raises(ValueError):
            read_csv(spark, files(f"{tmp_dir}/{head}", ["id,name\n1,x\n", f"{head}\n1,x\n"]), PAIR)
    path = files(f"{tmp_dir}/bad", ["name,id\nx,1\ny\nz,q\nw,2,3\n", "id,name\n7,\"\"\n"])
    good, aside = split_csv(read_csv(spark, path, PAIR, with_corrupt=True))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "x"), (7, "")]
    assert sorted(r["_corrupt_record"] for r in aside.collect()) == ["q,z", "w,2,3", "y"]


def test_real_nul_text_and_small_files_survive(spark, tmp_dir):
    df = spark.createDataFrame([("\u0000", 1), ("", 2), (None, 3), ("é\u0000", 4)], "t string, n int")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1")
    try:
        write_csv(df.coalesce(1), f"{tmp_dir}/nul")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    for headers in ("by_file", "same"):
        back = read_csv(spark, f"{tmp_dir}/nul", df.schema, headers=headers)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_types_from_all_rows(spark, tmp_dir):
    lines = ["i,d,b,t,s,n,big,mixed,late"]
    lines += [f"{k},{k}.5,{'True' if k % 2 else 'false'},2024-02-{1 + k % 28:02d},x{k},NA,{10**19 + k},{'NaN' if k % 2 else k},{k}" for k in range(500)]
    lines.append("-3,1e5,NULL,2024-02-29,1,,5,1.5,2024-02-30")
    path = files(f"{tmp_dir}/types", ["\n".join(lines) + "\n"])
    got = {r["name"]: r.asDict() for r in infer_csv_types(spark, path).collect()}
    assert {n: r["type"] for n, r in got.items()} == {
        "i": "bigint", "d": "double", "b": "boolean", "t": "date", "s": "string", "n": "string", "big": "double",
        "mixed": "double", "late": "string",
    }
    assert all(r["n_rows"] == 501 for r in got.values())
    assert got["n"]["n_missing"] == 501 and got["b"]["n_missing"] == 1 and got["mixed"]["n_missing"] == 250
    assert got["late"]["n_integer"] == 500 and got["late"]["n_date"] == 0 and got["big"]["n_integer"] == 1
    df = read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == [got[c]["type"] for c in df.columns]
    assert df.agg({"i": "sum"}).first()[0] == sum(range(500)) - 3


def test_inference_without_rows(spark, tmp_dir):
    path = files(f"{tmp_dir}/heads", ["a,b\n", "b,a\n"])
    assert [(r["name"], r["type"], r["n_rows"]) for r in infer_csv_types(spark, path).collect()] == [("a", "string", 0), ("b", "string", 0)]
    empty = files(f"{tmp_dir}/nothing", [""])
    assert infer_csv_types(spark, empty).count() == 0 and csv_schema(infer_csv_types(spark, empty)) == T.StructType()
    bare = files(f"{tmp_dir}/bare", ["1,x\n2,y\n"])
    assert [r["type"] for r in infer_csv_types(spark, bare, names=["n", "t"], header=False).collect()] == ["bigint", "string"]


def test_inferred_rows_read_the_files_once(spark, tmp_dir, monkeypatch):
    seen = []
    whole = csv_io._text_reader
    monkeypatch.setattr(csv_io, "_text_reader", lambda *a: seen.append(1) or whole(*a))
    path = files(f"{tmp_dir}/once", ["name,id\nx,1\n", "id,name\n2,\"\"\n"])
    df = read_csv_inferred(spark, path)
    assert sorted(map(tuple, df.select("id", "name").collect())) == [(1, "x"), (2, "")]
    assert len(seen) == 1


def test_a_record_is_tested_once(spark, tmp_dir):
    """The filter on bad records lies above the values, not written out once more below."""
    names = [f"c{i}" for i in range(8)]
    path = files(f"{tmp_dir}/wide", [",".join(names) + "\n" + ",".join("12345678") + "\n"])
    df = read_csv_inferred(spark, path)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("raise_error") == 1 and plan.count("concat_ws") == 1
    assert [tuple(r) for r in df.collect()] == [tuple(range(1, 9))]
    wrong = files(f"{tmp_dir}/wrong", ["id,name\nseven,x\n"])
    with pytest.raises(Exception, match="bad CSV record: seven,x"):
        read_csv(spark, wrong, PAIR).select("name").collect()
