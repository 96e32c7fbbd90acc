"""Landing files in the modelled layout -> staging -> star, on a tiny fixture
whose expected values are worked out by hand."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitalmart.constants import GNI, MORTALITY
from vitalmart.plans.landing_files import staging_from_landing, star_from_staging

FILES = {
    "WDI/Region.csv": ",index_region,region\n0,1,South Asia\n1,2,Aggregates\n"
                      "2,3,Europe & Central Asia \n",
    "WDI/Income_group.csv": ",index_income,incomeLevel\n0,1,High income\n1,2,Low income\n"
                            "2,3,Lower middle income\n3,4,Upper middle income\n",
    "WDI/Country.csv": ",name,iso2Code,iso3Code,index_region\n0,India,IN,IND,1\n"
                       "1,France,FR,FRA,3\n2,Czech Republic,CZ,CZE,3\n",
    "WDI/Indicator.csv": f",id,name,sourceOrganization,sourceNote\n0,SH.DYN.MORT,\"{MORTALITY}\",o,n\n"
                         f"1,NY.GNP.PCAP.CD,\"{GNI}\",o,n\n",
    "WDI/Under5_per_country.csv": ",value,year,indicator,index_country,name\n"
                                  "0,40.5,2017,1,1,India\n1,3.9,2017,1,2,France\n"
                                  "2,41.0,2016,1,1,India\n3,2.9,2017,1,3,Czech Republic\n",
    "WDI/Gni_per_country.csv": ",value,year,indicator,index_country\n0,2000,2017,2,1\n"
                               "1,38000,2017,2,2\n2,20000,2017,2,3\n",
    "WDI/Income_boundaries.csv": ",income,year,lower_bound,upper_bound\n"
                                 "0,Low income (L),2017,0,995\n1,High income (H),2017,12056,1000000\n"
                                 "2,Lower middle income (LM),2017,996,3895\n",
    "WHO/Malaria.csv": ",2017,2017,2017,2016,2016,2016\nsub,a,b,c,a,b,c\nsub,,,,,,\nsub,,,,,,\n"
                       "India,1,2,3.5,1,2,3.7\nFrance,1,2,0.1,1,2,\n",
    "WHO/Measles.csv": ",2017,2017,2017,2016,2016,2016\nsub,a,b,c,a,b,c\nsub,,,,,,\nsub,,,,,,\n"
                       "India,1,2,1.25,1,2,1.5\nCzechia,1,2,0.5,1,2,0.25\n",
}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    for rel, text in FILES.items():
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as f:
            f.write(text)
    return root


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_staging_from_landing(spark, landing):
    s = staging_from_landing(spark, landing)
    assert rows(s["region"], "region_id", "region_name")[2] == (3, "Europe & Central Asia")
    # under-5 rows first in file order, then GNI rows
    assert rows(s["indicator_per_country"], "indicator_per_country_id", "indicator_id",
                "country_id", "year", "value") == [
        (1, 1, 1, 2017, Decimal("40.50")), (2, 1, 2, 2017, Decimal("3.90")),
        (3, 1, 1, 2016, Decimal("41.00")), (4, 1, 3, 2017, Decimal("2.90")),
        (5, 2, 1, 2017, Decimal("2000.00")), (6, 2, 2, 2017, Decimal("38000.00")),
        (7, 2, 3, 2017, Decimal("20000.00"))]
    assert rows(s["death_reason"], "death_reason_id", "reason_name") == [
        (1, "Malaria"), (2, "Measles")]
    # France 2016 has no under-5 row (dropped by the inner join); 'Czechia' is
    # mapped to 'Czech Republic' before joining
    assert rows(s["indicator_per_country_per_reason"], "reason_id", "indicator_per_country_id",
                "value_per_reason") == [
        (1, 1, Decimal("3.50")), (1, 2, Decimal("0.10")), (1, 3, Decimal("3.70")),
        (2, 1, Decimal("1.25")), (2, 3, Decimal("1.50")), (2, 4, Decimal("0.50"))]
    # GNI into the band of its year: India LM (3), France and Czech Republic High (2)
    assert rows(s["income_group_country"], "country_id", "income_group_year_id") == [
        (1, 3), (2, 2), (3, 2)]


def test_star_from_landing(spark, landing):
    star = star_from_staging(spark, staging_from_landing(spark, landing))
    assert rows(star["dim_country"], "country_name", "date_year", "income_name") == [
        ("Czech Republic", 2017, "High income"), ("France", 2017, "High income"),
        ("India", 2016, "NO INCOME AVAILABLE"), ("India", 2017, "Lower middle income")]
    assert rows(star["dim_reason"], "reason_key", "reason_id", "reason_desc", "date_year") == [
        (1, "1", "Malaria", 2017), (2, "1", "Malaria", 2016),
        (3, "2", "Measles", 2017), (4, "2", "Measles", 2016)]
    fm, fr = star["fact_metrics"], star["fact_metric_death_reasons"]
    assert fm.count() == 7 and fr.count() == 6
    # V1 = metrics without reasons + reason rows; V2 keeps mortality rows with reasons
    v1, v2 = star["v1"], star["v2"]
    with_reasons = fr.select("metric_id").distinct().count()
    assert v1.count() == fm.count() - with_reasons + fr.count()
    assert v2.count() == fr.count()
    # a worksheet mean over the star: mean cause rate per region (V2)
    got = {r.region_name: r.m for r in v2.groupBy("region_name").agg(
        (F.sum("death_reason_metric").cast("double") / F.count("death_reason_metric")).alias("m")
    ).collect()}
    assert got == {"South Asia": (3.5 + 3.7 + 1.25 + 1.5) / 4,
                   "Europe & Central Asia": (0.1 + 0.5) / 2}


def test_cli_load(spark, landing, tmp_path, capsys):
    from vitalmart.__main__ import main
    out = str(tmp_path / "warehouse")
    assert main(["load", "--landing", landing, "--out", out]) == 0
    assert "mart/fact_metric_death_reasons" in capsys.readouterr().out
    assert spark.read.parquet(f"{out}/mart/fact_metrics").count() == 7
    assert spark.read.parquet(f"{out}/mart/v1").count() == 7 - 4 + 6


def test_worksheets_run_on_a_landing_root(spark, landing):
    from vitalmart.plans.catalogue import QUERIES
    from vitalmart.plans.star import mart
    m = mart(spark, landing).build()
    assert m.landing and m.table("fact_metrics").count() == 7
    ranks = {r.region_name: r.rank for r in QUERIES["q_ws_region_rank"](spark, landing).collect()}
    # mean under-5 rate over V2 rows: South Asia (India) above Europe & Central Asia
    assert ranks == {"South Asia": 1, "Europe & Central Asia": 2}
    assert all(r.n_violations == 0 for r in QUERIES["q_fk_violations"](spark, landing).collect())
    reasons = {r.reason_desc for r in QUERIES["q_ws_reasons_over_time"](spark, landing).collect()}
    assert reasons == {"Malaria", "Measles", None}


def write(root, files):
    for rel, text in files.items():
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as f:
            f.write(text)
    return root


def cause_rows(spark, root):
    from vitalmart.plans.landing_files import _cause_values
    return sorted(((r.reason_name, r["name"], r.year, r.value_per_reason)
                   for r in _cause_values(spark, root).collect()), key=str)


SUB = "sub\nsub\nsub\n"


def test_every_cause_file_has_its_own_header(spark, tmp_path):
    # other year order, a third year, a row-number column, blocks already
    # numbered, an empty unnamed column, a quoted line break and comma
    root = write(str(tmp_path), {
        "WHO/Malaria.csv": ",2017,2017,2017,2016,2016,2016\n" + SUB + "India,1,2,3.5,1,2,3.7\n",
        "WHO/Measles.csv": ",2016,2016,2016,2017,2017,2017,2015,2015,2015\n" + SUB +
                           "Czechia,1,2,0.25,1,2,0.5,1,2,0.75\n",
        "WHO/Mumps.csv": ",Country,2017,2017.1,2017.2,\n" + SUB +
                         '3,"Korea,\nSouth",1,2,0.1,\n4,India,1,2,,\n'})
    assert cause_rows(spark, root) == sorted([
        ("Malaria", "India", 2017, Decimal("3.50")), ("Malaria", "India", 2016, Decimal("3.70")),
        ("Measles", "Czechia", 2016, Decimal("0.25")), ("Measles", "Czechia", 2017, Decimal("0.50")),
        ("Measles", "Czechia", 2015, Decimal("0.75")),
        ("Mumps", "Korea,\nSouth", 2017, Decimal("0.10")), ("Mumps", "India", 2017, None)], key=str)


@pytest.mark.parametrize("text", [
    ",2017,2017,2017,\n" + SUB + "India,1,2,3.5,9\n",          # a value without a year
    "a,b,c,2017,2017,2017\n" + SUB + "0,x,India,1,2,3.5\n"])   # no one country column
def test_cause_files_of_another_layout_fail(spark, tmp_path, text):
    with pytest.raises(Exception, match="Mumps"):
        cause_rows(spark, write(str(tmp_path), {"WHO/Mumps.csv": text}))


def test_notes_with_line_breaks_and_quotes(spark, tmp_path):
    root = write(str(tmp_path), FILES | {
        "WDI/Indicator.csv": ',id,name,sourceOrganization,sourceNote\n0,A,a,o,"two\nlines, ""quoted"""\n'
                             "1,B,b,o,n\n"})
    got = rows(staging_from_landing(spark, root)["indicator"], "indicator_id", "source_note")
    assert got == [(1, 'two\nlines, "quoted"'), (2, "n")]


def test_a_changed_input_is_seen(spark, tmp_path):
    from vitalmart.plans.star import mart
    root = write(str(tmp_path), FILES)
    before = mart(spark, root).table("indicator_per_country").count()
    write(root, {"WDI/Gni_per_country.csv": FILES["WDI/Gni_per_country.csv"] + "3,2100,2016,2,1\n"})
    assert mart(spark, root).table("indicator_per_country").count() == before + 1


def test_remote_folders_are_fingerprinted(spark, tmp_path):
    from vitalmart.plans.star import _inputs_tag
    root = write(str(tmp_path), FILES)
    first = _inputs_tag(spark, f"file://{root}", True)
    assert first == _inputs_tag(spark, f"file://{root}", True)
    write(root, {"WHO/Malaria.csv": FILES["WHO/Malaria.csv"] + "Peru,1,2,9.5,1,2,9.7\n"})
    assert first != _inputs_tag(spark, f"file://{root}", True)
