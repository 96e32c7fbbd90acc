import os

from pyspark.sql import functions as F

from vitalmart import schemas
from vitalmart.operators.keys import with_position
from vitalmart.operators.reshape import header_from_first_row
from vitalmart.sources.tables import (file_stem, read_csv, read_csv_files, read_export, read_grid,
                                      table)
from vitalmart.sources.writers import append_table, create_empty, write_csv, write_table
from tests.conftest import SF001


def test_csv_round_trip_with_schema(spark, tmpdir_path):
    n = table(spark, SF001, "nation")
    path = os.path.join(tmpdir_path, "Country")
    write_csv(n, path)
    back = read_csv(spark, path, schema=n.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, n.collect()))


def test_folder_of_files_gives_names(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "WHO")
    os.makedirs(folder)
    for name in ["Malaria", "Measles"]:
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write("name,2000\nX,1.5\nY,2.5\n")
    df = read_csv_files(spark, folder, schema="name string, `2000` double")
    got = sorted((r.cause, r.name) for r in df.select(file_stem("file_name").alias("cause"), "name").collect())
    assert got == [("Malaria", "X"), ("Malaria", "Y"), ("Measles", "X"), ("Measles", "Y")]
    # a fixed list of files reads the same
    two = read_csv_files(spark, [os.path.join(folder, "Malaria.csv")], schema="name string, `2000` double")
    assert two.count() == 2


def test_grid_without_header(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sheet.csv")
    with open(path, "w") as f:
        f.write("Data for calendar year :,1990,1991\nLow income (L),<= 480,<= 500\n")
    g = read_grid(spark, path)
    assert g.columns == ["_c0", "_c1", "_c2"]
    # position from file order (single small file), then the first row becomes the header
    g = with_position(g.withColumn("_row", F.monotonically_increasing_id()), ["_row"], "pos").drop("_row")
    h = header_from_first_row(g, "pos")
    assert h.columns == ["pos", "Data for calendar year :", "1990", "1991"]
    assert h.count() == 1


def test_semicolon_export(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "dim_date.csv")
    with open(path, "w") as f:
        f.write('date_year;date_string;date_tens\n-1;"NO DATE AVAILABLE";"NO DATE AVAILABLE"\n1960;"1960";"1960"\n')
    df = read_export(spark, path, schemas.DIM_DATE_EXPORT)
    assert [tuple(r) for r in df.collect()] == [(-1, "NO DATE AVAILABLE", "NO DATE AVAILABLE"),
                                                (1960, "1960", "1960")]


def test_empty_star_tables_and_append(spark, tmpdir_path):
    for name, schema in schemas.STAR.items():
        df = create_empty(spark, schema, os.path.join(tmpdir_path, name))
        assert df.count() == 0 and [f.name for f in df.schema] == [f.name for f in schema]
    p = os.path.join(tmpdir_path, "dim_date")
    row = spark.createDataFrame([(1960, "1960", "1960")], schemas.DIM_DATE)
    append_table(row, p)
    append_table(row, p)
    assert spark.read.parquet(p).count() == 2
    write_table(row, p)
    assert spark.read.parquet(p).count() == 1


def test_scan_prunes_columns_and_pushes_filters(spark):
    o = table(spark, SF001, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    plan = o._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan


def test_export_round_trip(spark, tmpdir_path):
    from vitalmart.sources.writers import write_export
    rows = [(-1, "NO DATE AVAILABLE", "NO DATE AVAILABLE"), (1960, "1960", "1960"), (1999, 'say "x"', None)]
    df = spark.createDataFrame(rows, schemas.DIM_DATE_EXPORT)
    path = os.path.join(tmpdir_path, "dim_date_export")
    write_export(df, path)
    parts = [open(os.path.join(path, f)).read().splitlines() for f in os.listdir(path) if f.endswith(".csv")]
    assert all(lines[0] == "date_year;date_string;date_tens" for lines in parts)  # a headed file per task
    assert sorted(line for lines in parts for line in lines[1:]) == [
        '-1;"NO DATE AVAILABLE";"NO DATE AVAILABLE"', '1960;"1960";"1960"', '1999;"say ""x""";']
    back = read_export(spark, path, schemas.DIM_DATE_EXPORT).withColumn(
        "date_tens", F.when(F.col("date_tens") == "", None).otherwise(F.col("date_tens")))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
