"""Delimited files: each by its own header, and lines with too many or too few fields."""

import gzip

import pytest
from pyspark.sql import functions as F

from rowgate.operators.duplicates import tag_duplicates
from rowgate.sources import read_csv
from rowgate.sources.headers import names_in


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    path = write(tmp_path, a="id,gender,age\n1,m,40\n", b="gender,age,id\nf,20,2\n", c="ID,extra,Gender\n3,e,x\n", d="")
    df = read_csv(spark, path)
    assert df.columns == ["id", "gender", "age", "extra"]
    assert rows(df) == [("1", "m", "40", None), ("2", "f", "20", None), ("3", "x", None, "e")]
    with pytest.raises(ValueError, match="no column"):
        read_csv(spark, path, absent="raise")
    assert rows(read_csv(spark, [f"{path}/a.csv", f"{path}/b.csv"], absent="raise")) == [("1", "m", "40"), ("2", "f", "20")]


def test_case_is_kept_apart_where_the_session_wants_it(spark, tmp_path):
    path = write(tmp_path, a="id,v\n1,a\n", b="ID,v\n2,b\n")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert rows(read_csv(spark, path)) == [("1", "a", None), (None, "b", "2")]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_headers_are_read_like_spark_reads_them(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿\"a b\";\"c;d\";;e;E\n1;2;3;4;5\n".encode())
    df = read_csv(spark, str(tmp_path), sep=";")
    assert df.columns == spark.read.csv(str(tmp_path), sep=";", header=True).columns == ["a b", "c;d", "_c2", "e3", "E4"]
    assert rows(df) == [("1", "2", "3", "4", "5")]
    assert names_in("a|'b|c'|d", {"sep": "|", "quote": "'"}) == ("a", "b|c", "d")
    assert names_in("a\tb", {"sep": "\\t"}) == ("a", "b")


def test_compressed_files_have_headers_too(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"x,y\n1,2\n"))
    write(tmp_path, b="y,x\n4,3\n")
    assert rows(read_csv(spark, str(tmp_path))) == [("1", "2"), ("3", "4")]


def test_malformed_lines_are_marked(spark, tmp_path):
    path = write(tmp_path, a="id,v\n1,a\n2,b,c\n", b="v,id\nx\ny,4\n\n,\n")
    df = read_csv(spark, path, malformed="mark")
    found = {(r.id, r.v): r["_malformed"] and r["_malformed"]["line"] for r in df.collect()}
    assert found == {("1", "a"): None, ("2", "b"): "2,b,c", (None, "x"): "x", ("4", "y"): None, (None, None): None}
    assert rows(read_csv(spark, path)) == rows(df.drop("_malformed"))


def test_without_a_header_columns_are_places(spark, tmp_path):
    path = write(tmp_path, a="1,a\n", b="2,b\n")
    assert rows(read_csv(spark, path, header=False)) == [("1", "a"), ("2", "b")]
    assert read_csv(spark, path, header=False, malformed="mark", positions=True).columns == ["_c0", "_c1", "_malformed", "_position"]


def test_first_copies_are_those_of_the_first_file_whatever_its_header(spark, tmp_path):
    path = write(tmp_path, a="id,v\n" + "".join(f"{i},a\n" for i in range(50)), b="v,id\n" + "".join(f"b,{i}\n" for i in range(90)))
    tagged = tag_duplicates(read_csv(spark, path, positions=True), "id")
    kept = tagged.where(F.col("rejection_reason").isNull())
    assert kept.count() == 90 and kept.where("v = 'a'").count() == 50


def test_only_needed_columns_are_read(spark, tmp_path):
    path = write(tmp_path, a="id,v,w\n1,a,b\n", b="w,v,id\n1,a,b\n")
    text = read_csv(spark, path).select("v")._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReadSchema: struct<v:string>") == 2
