"""The raw country listing to the landing sheets, on hand-made rows."""

from vitalmart.plans.raw import landing_lists

SCHEMA = "position int, id string, iso2Code string, name string, region string, incomeLevel string"


def test_landing_lists(spark):
    rows = [(0, "AFE", "ZH", "Group one", "Aggregates", "Aggregates"),
            (1, "ABW", "AW", "Aruba", "Islands", "High"),
            (2, "AFG", "AF", "Afghanistan", "Asia", "Low"),
            (3, "WLD", "1W", "World", "Aggregates", "Low"),
            (4, "XXX", None, "Nowhere", None, None),
            (5, "AGO", "AO", "Angola", "Asia", "High"),
            (6, "ATG", "AG", "Antigua", "Islands", None)]
    got = landing_lists(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), "Aggregates")
    assert sorted(map(tuple, got["Region"].collect())) == [
        (0, 1, "Aggregates"), (1, 2, "Islands"), (2, 3, "Asia"), (3, 4, None)]
    assert sorted(map(tuple, got["Income_group"].collect())) == [(0, 1, "High"), (1, 2, "Low"), (2, 3, None)]
    assert sorted((r._row, r.index_country, r.iso3Code, r.index_region, r.index_income)
                  for r in got["Country"].collect()) == [
        (0, 1, "ABW", 2, 1), (1, 2, "AFG", 3, 2), (2, 3, "XXX", 4, 3), (3, 4, "AGO", 3, 1), (4, 5, "ATG", 2, 3)]


def test_empty_listing(spark):
    got = landing_lists(spark.createDataFrame([], SCHEMA), "Aggregates")
    assert all(sheet.count() == 0 for sheet in got.values())


def test_mart_frees_positions(spark):
    """What the mart's tables are numbered with is gone once they are stored."""
    from pathlib import Path

    from vitalmart.operators.keys import with_position
    from vitalmart.plans.star import mart
    from vitalmart.session import warehouse_path
    folder = Path(warehouse_path(spark, "positions").removeprefix("file:"))

    def left():
        return sorted(p.name for p in folder.glob("*"))

    before = left()
    m = mart(spark, "/root/testdata/sf0.001")
    name = "test_numbered"
    df = spark.createDataFrame([(2,), (1,)], "k int")
    got = m.stored(name, lambda: with_position(df, ["k"]))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 2)] and left() == before
