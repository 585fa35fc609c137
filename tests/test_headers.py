import pytest

from smoglake.sources import delimited as D


def _files(folder, **texts):
    for name, text in texts.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_are_found_by_name_in_each_file(spark, tmp_dir):
    _files(tmp_dir,
           a="Date;Time;T;CO(GT)\n10/03/2004;18.00.00;14,1;2,6\n",
           b="Date;Time;CO(GT);T\n10/03/2004;19.00.00;2;13,3\nDate;Time;CO(GT);T\n11/03/2004;19.00.00;2,5;13,5\n",
           c="﻿CO(GT);Date;Time;;\n1;12/03/2004;20.00.00;;\n",
           d="", e="Date;Time;T;CO(GT)\n", f="Time;Date;T;RH\r\n01.00.00;13/03/2004;9;48,9\r\n")
    out = D.read_sensor_csv(spark, tmp_dir, columns=["Date", "Time", "COGT", "T"])
    assert _rows(out) == [("10/03/2004", "18.00.00", 2.6, 14.1), ("10/03/2004", "19.00.00", 2.0, 13.3),
                          ("11/03/2004", "19.00.00", 2.5, 13.5), ("12/03/2004", "20.00.00", 1.0, None),
                          ("13/03/2004", "01.00.00", None, 9.0)]
    assert D.read_sensor_csv(spark, tmp_dir).columns == ["Date", "Time", "T", "COGT", "RH"]


def test_one_header_for_all_raises_on_another(spark, tmp_dir):
    _files(tmp_dir, a="Date;Time;T;CO(GT)\n10/03/2004;18.00.00;14,1;2,6\n", b="Date;Time;CO(GT);T\n10/03/2004;19.00.00;2;13,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        D.read_delimited(spark, tmp_dir).collect()


def test_headers_that_collide_or_never_end_raise(spark, tmp_dir):
    _files(tmp_dir, a="T;T.\n1;2\n")
    with pytest.raises(ValueError, match="collide"):
        D.read_by_header(spark, tmp_dir)
    with pytest.raises(ValueError, match="different headers"):
        _files(tmp_dir, **{f"f{i}": f"{i};x\n" for i in range(6)})
        D.read_by_header(spark, tmp_dir, columns=None) if D.header_layouts(spark, tmp_dir, most=3) else None


def test_empty_folder_and_quoted_names(spark, tmp_dir):
    _files(tmp_dir, a="")
    assert D.read_by_header(spark, tmp_dir, columns=["T"]).count() == 0
    _files(tmp_dir, **{"b c%20 [1]": '"Da;te";T\n"x;y";3\n'})
    assert _rows(D.read_by_header(spark, tmp_dir)) == [("x;y", "3")]


def test_large_file_in_many_splits_has_one_header(spark, tmp_dir):
    _files(tmp_dir, a="k;v\n" + "".join(f"{i};{i % 7}\n" for i in range(20_000)), b="v;k\n" + "".join(f"{i % 7};{i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        out = D.read_by_header(spark, tmp_dir, columns=["k", "v"])
        assert out.rdd.getNumPartitions() > 8
        assert out.selectExpr("count(*)", "sum(int(k))", "count_if(int(k) % 7 = int(v))").first() == (40_000, 2 * sum(range(20_000)), 40_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
