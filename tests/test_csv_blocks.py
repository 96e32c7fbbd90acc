"""Quoted CSV by byte blocks, against Python's csv module."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from vitalmart.session import scoped_conf
from vitalmart.sources.csv_blocks import cells, numbered_lines, read_quoted_csv, records

SMALL = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1",
         "spark.sql.files.minPartitionNum": "1"}


def content(seed, n, long=0):
    rnd = random.Random(seed)
    texts = ["plain", "a,b", 'say "hi"', "two\nlines", "\n", '"', ",", 'x"\n"y', "é\nß", "trail ", " lead", "0" * 60, "three\n\n\nmore", '""']
    rows = [[str(i), rnd.choice(texts), rnd.choice([None, "z", rnd.choice(texts)])] for i in range(n)]
    if long:  # one record over many blocks, marks and line breaks inside
        rows[n // 2][1] = "\n".join(f'line {k} with "marks", and more' for k in range(long))
    return rows


def write(path, rows, header, end="\n"):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)


@pytest.mark.parametrize("seed,long,end", [(1, 0, "\n"), (2, 200, "\n"), (3, 40, "\r\n")])
def test_blocks_of_a_quoted_file(spark, tmp_path, seed, long, end):
    rows = content(seed, 400, long)
    write(f"{tmp_path}/a.csv", rows, ["", "te xt", "b"], end)
    with scoped_conf(spark, SMALL):
        df = read_quoted_csv(spark, f"{tmp_path}/a.csv")
        tasks = spark.read.text(f"{tmp_path}/a.csv").rdd.getNumPartitions()
        got = df.collect()
    assert tasks > 10 and df.columns == ["_c0", "te xt", "b"]
    # an empty cell without marks is NULL, as None is written
    assert sorted(map(tuple, got), key=str) == sorted(((a, b, c) for a, b, c in rows), key=str)


def test_numbers_of_records_and_lines(spark, tmp_path):
    os.makedirs(f"{tmp_path}/d")
    for k in range(3):
        write(f"{tmp_path}/d/{k}.csv", content(k, 100, 30 * k), ["n", "t", "u"])
    with scoped_conf(spark, SMALL):
        got = records(spark, f"{tmp_path}/d").select(
            F.regexp_extract("file", r"(\d)\.csv$", 1).alias("k"), "record", F.get(cells("text"), F.lit(0)).alias("n")).collect()
        numbered = numbered_lines(spark, f"{tmp_path}/d").select(F.regexp_extract("file", r"(\d)\.csv$", 1).alias("k"), "line", "value").collect()
    assert sorted((r.k, r.record, r.n) for r in got) == sorted(
        (str(k), i, n) for k in range(3) for i, n in enumerate(["n", *map(str, range(100))]))
    for k in range(3):
        with open(f"{tmp_path}/d/{k}.csv", newline="") as f:
            assert [r.value for r in sorted((r for r in numbered if r.k == str(k)), key=lambda r: r.line)] == f.read().split("\n")[:-1]


def test_blank_lines_and_empty_files(spark, tmp_path):
    with open(f"{tmp_path}/a.csv", "w") as f:
        f.write('a,b\n\n1,"x\n\ny"\n  \n2,""\n,\n"",z')
    with open(f"{tmp_path}/b.csv", "w") as f:
        f.write("a,b\n")
    assert sorted(map(tuple, read_quoted_csv(spark, f"{tmp_path}/a.csv").collect()), key=str) == sorted(
        [("1", "x\n\ny"), ("2", ""), (None, None), ("", "z")], key=str)
    none = read_quoted_csv(spark, f"{tmp_path}/b.csv")
    assert none.columns == ["a", "b"] and none.collect() == []


def test_blocks_are_combined_by_one_row_each(spark, tmp_path):
    write(f"{tmp_path}/a.csv", content(5, 50), ["n", "t", "u"])
    plan = records(spark, f"{tmp_path}/a.csv")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Python" not in plan
