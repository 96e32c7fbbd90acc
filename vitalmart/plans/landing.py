"""Landing-side operators (ingest, cleaning, reshape, keys, sets) as queries.

Each reads the driver's tables (or data Spark derives from them) whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.constants import SHEET_HEADER
from vitalmart.functions.dates import trunc_year, year_part, year_to_date
from vitalmart.functions.stats import MONEY, mean
from vitalmart.functions.text import (clean_name, contains_keyword, income_code, key_to_name,
                                      map_names, nan_to_null, year_from_label)
from vitalmart.operators.constraints import key_violations
from vitalmart.operators.joins import fk_violation_counts, natural_join
from vitalmart.operators.keys import name_ids, slice_by_ranges, with_position
from vitalmart.operators.reshape import (dedupe_headers, header_from_first_row, melt, stack,
                                         strip_suffix)
from vitalmart.plans import staging as st
from vitalmart.plans.star import mart
from vitalmart.schemas import KEYS
from vitalmart.sources.csv_blocks import cells, numbered_lines
from vitalmart.sources.tables import read_grid, table
from vitalmart.sources.writers import write_csv

TPCH = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _t(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# --- sources, countries, series ------------------------------------------

def country_dim_src(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    return st.stg_country(st.nations(spark, sf_dir), m.table("region"), st.AGGREGATE_REGION)


def first_seen(spark, sf_dir) -> DataFrame:
    return mart(spark, sf_dir).table("region")


def series(spark, sf_dir, indicator_id: int = 2) -> DataFrame:
    m = mart(spark, sf_dir)
    ipc = m.table("indicator_per_country").where(F.col("indicator_id") == indicator_id)
    c = m.table("country")
    return (ipc.join(c, "country_id")
            .select(F.col("country_name").alias("name"), "year", "value"))


# J2 + W3 + P5: both series x countries by name, then a 1-based row id
def row_ids(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    s = m.table("indicator_per_country").select("country_id", "indicator_id", "year", "value")
    names = m.table("country").select("country_id", F.col("country_name").alias("name"))
    j = s.join(names, "country_id").drop("country_id")
    return m.stored("series_row_ids", lambda: with_position(
        j, ["indicator_id", "name", "year"], "row_id").select(
        "row_id", "indicator_id", "name", "year", "value"))


def stg_indicator(spark, sf_dir) -> DataFrame:
    return mart(spark, sf_dir).table("indicator_per_country")


def stg_reason_values(spark, sf_dir) -> DataFrame:
    return mart(spark, sf_dir).table("indicator_per_country_per_reason")


# Ids of the cause names in listing (binary) order
def file_ids(spark, sf_dir) -> DataFrame:
    pr = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("reason_name"))
    return mart(spark, sf_dir).stored("priority_ids", lambda: name_ids(
        pr, "reason_name", "death_reason_id").select(
        F.col("death_reason_id").cast("int"), "reason_name"))


# --- catalogue (part) --------------------------------------------------------

def keyword_search(spark, sf_dir, keyword: str = "red") -> DataFrame:
    p = _t(spark, sf_dir, "part")
    return p.where(contains_keyword("p_name", keyword)).select(
        "p_partkey", "p_name", "p_type", "p_brand")


def union_indicators(spark, sf_dir, first: str = "widget", second: str = "bolt") -> DataFrame:
    return keyword_search(spark, sf_dir, first).unionByName(keyword_search(spark, sf_dir, second))


def group_size(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(
        F.count(F.lit(1)).alias("n_rows"))


def distinct_rows(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "part").select("p_type", "p_brand", "p_size").distinct()


# O3: first n rows along the unique key (TakeOrderedAndProject)
def head(spark, sf_dir, n: int = 5) -> DataFrame:
    return _t(spark, sf_dir, "part").orderBy("p_partkey").limit(n).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size")


def _yearly_price(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"),
                                            F.col("o_totalprice").cast(MONEY).alias("price"))
    return o.groupBy("year").agg(mean("price").alias("avg_totalprice"))


# A2: mean per year, NULLs skipped
def mean_by_year(spark, sf_dir) -> DataFrame:
    return _yearly_price(spark, sf_dir).orderBy("year")


# Last n rows of a year-ordered result
def tail(spark, sf_dir, n: int = 5) -> DataFrame:
    return _yearly_price(spark, sf_dir).orderBy(F.col("year").desc()).limit(n).orderBy("year")


# lower bound compared as text
def trend_since(spark, sf_dir, since: str = "1997") -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("year"),
        F.col("o_totalprice").cast(MONEY).alias("price"))
    return (o.where(F.col("year") >= since).groupBy("year")
            .agg(mean("price").alias("avg_totalprice")).orderBy("year"))


# C12..C14 on the years present in orders
def year_parts(spark, sf_dir) -> DataFrame:
    y = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    d = year_to_date("year")
    return y.select("year", d.alias("year_date"), year_part(d).alias("year_of_date"),
                    trunc_year(d).alias("year_start"))


# (rows, columns) of each table
def shape(spark, sf_dir) -> DataFrame:
    parts = []
    for name in TPCH:
        t = _t(spark, sf_dir, name)
        parts.append(t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len(t.columns)).alias("n_columns")))
    return reduce(DataFrame.unionByName, parts)


# Rows [start, stop) by position along the unique key (0-based, like iloc)
def position_slice(df: DataFrame, order, start: int, stop: int) -> DataFrame:
    (key,) = order
    return slice_by_ranges(df, key, start, stop)


def row_slice(spark, sf_dir, start: int = 4, stop: int = 9) -> DataFrame:
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return position_slice(p, ["p_partkey"], start, stop)


# both measures present after an outer join
def drop_incomplete(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = (_t(spark, sf_dir, "orders")
         .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                   mean(F.col("o_totalprice").cast(MONEY)).alias("avg_totalprice")))
    j = c.join(o, c["c_custkey"] == o["o_custkey"], "left").drop("o_custkey")
    return j.na.drop(subset=["n_orders", "avg_totalprice"])


# --- text cleaning -------------------------------------------------------

def band_texts(spark, sf_dir) -> DataFrame:
    years = (_t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
             .distinct())
    return st.band_texts(years)


# The band history as the sheet has it: a headerless grid of the label column
# and one column per year, whose rows are known by their place alone.
def write_income_sheet(spark, sf_dir) -> str:
    m = mart(spark, sf_dir)
    path = m.path("landing_income_sheet")
    if not m.exists("landing_income_sheet"):
        texts = band_texts(spark, sf_dir).withColumn("code", income_code("income"))
        # one header per year: the year list is bounded and fixes the columns
        years = sorted(r[0] for r in texts.select("year").distinct().collect())
        wide = (texts.groupBy("income", "code").pivot("year", years).agg(F.max("value"))
                .select((F.pmod(F.col("code") - 2, F.lit(4)) + 1).alias("_row"), "income",
                        *[F.col(str(y)) for y in years]))
        header = spark.createDataFrame([tuple([0, SHEET_HEADER] + [str(y) for y in years])],
                                       wide.columns)
        # five rows, in the sheet's order
        sheet = header.unionByName(wide).coalesce(1).sortWithinPartitions("_row").drop("_row")
        m.publish("landing_income_sheet", lambda p: write_csv(sheet, p, header=False))
    return path


# S4 + P12 + P11 + R1 + P2 + F4 + C1..C4 + P3: sheet -> (income, year, bounds)
def income_bounds(spark, sf_dir) -> DataFrame:
    path = write_income_sheet(spark, sf_dir)
    width = len(read_grid(spark, path).columns)
    rows = numbered_lines(spark, path).where(F.col("line").between(0, 4))      # row slice
    grid = rows.select(F.col("line").alias("pos"),
                       *[F.get(cells("value"), F.lit(i)).alias(f"_c{i}") for i in range(width)])
    sheet = (header_from_first_row(grid, "pos").drop("pos")
             .withColumnsRenamed({SHEET_HEADER: "income"}))
    years = [c for c in sheet.columns if c != "income"]
    long = melt(sheet, ["income"], years, "year", "value")
    long = (long.where(F.col("income") != SHEET_HEADER)
            .withColumn("year", F.col("year").cast("int")))
    return st.income_bounds(long)


def income_codes(spark, sf_dir) -> DataFrame:
    return income_bounds(spark, sf_dir).withColumn("income_group_id", income_code("income"))


def income_group_country(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    igc, igy = m.table("income_group_country"), m.table("income_group_year")
    return igc.join(igy, "income_group_year_id").select(
        "country_id", "year", "income_group_name", "lower_bound", "upper_bound")


# The derived income table inside the country dimension load
def income_by_year(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    igc, igy, ing = (m.table("income_group_country"), m.table("income_group_year"),
                     m.table("income_group"))
    return (igc.join(igy, "income_group_year_id")
            .join(ing, "income_group_id")
            .select("country_id", "income_name", "year"))


def _reason_values(spark, sf_dir) -> DataFrame:
    return st.reason_values(mart(spark, sf_dir).table("cells"), st.nations(spark, sf_dir))


# C5 + C17: cause-side spellings and what the dictionary makes of them
def name_map(spark, sf_dir) -> DataFrame:
    names = _reason_values(spark, sf_dir).select(F.col("name").alias("source_name")).distinct()
    return names.select("source_name", map_names("source_name").alias("mapped_name"))


def clean_names(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", clean_name("url").alias("clean_url"))


# NaN (square root of a negative balance) -> NULL
def nan_to_null_q(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", nan_to_null(F.sqrt("c_acctbal")).alias("sqrt_acctbal"))


# F6 + C7: object keys under one prefix -> names
def key_prefix(spark, sf_dir, prefix: str = "src1") -> DataFrame:
    d = _t(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"),
                           F.lit(".csv")).alias("object_key"))
    return d.select("doc_id", "object_key", key_to_name("object_key", prefix).alias("name")
                    ).where(F.col("name").isNotNull())


# For every item below a ul, at any depth, the href of the first a below
# it (0 links -> no row). The tags of a page pass in order through a fold that
# keeps the stack of open lists and of open items; an a answers all open items
# that still wait, so an outer item takes the link of an inner one as well.
NO_MARKUP = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
ANY_TAG = r"""(?s)</?[A-Za-z][^\s/>]*+(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"
HREF = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}
NUMBERED = "(?i)&#(?:x[0-9a-f]{1,6}|[0-9]{1,7});"
_LINKS_START = ("named_struct('lists', CAST(array() AS ARRAY<STRING>), 'items', 0, "
                "'open', CAST(array() AS ARRAY<STRUCT<at: INT, item: INT, waits: BOOLEAN>>), "
                "'links', CAST(array() AS ARRAY<STRUCT<item: INT, href: STRING>>))")


def _link_fold(state, tag):
    name = F.lower(F.regexp_extract(tag, TAG_NAME, 1))
    ends = tag.startswith("</")
    lists, items, open_, links = state["lists"], state["items"], state["open"], state["links"]
    depth = F.size(lists)
    is_list = name.isin("ul", "ol")
    # an end takes all lists off that were opened after its own; an ol counts within a ul only
    back = F.array_position(F.reverse(lists), name).cast("int")
    new_lists = (F.when(is_list & ends & (back > 0), F.slice(lists, F.lit(1), depth - back))
                 .when(is_list & ~ends & ((name == "ul") | (depth > 0)), F.concat(lists, F.array(name))).otherwise(lists))
    item, link = (name == "li") & (depth > 0), (name == "a") & ~ends
    shut = F.filter(open_, lambda o: o["at"] < depth)       # the item of this list ends
    new = F.struct(depth.alias("at"), items.alias("item"), F.lit(True).alias("waits"))
    new_open = (F.when(is_list & ends, F.filter(open_, lambda o: o["at"] <= F.size(new_lists)))
                .when(item & ends, shut).when(item, F.concat(shut, F.array(new)))
                .when(link, F.transform(open_, lambda o: F.struct(o["at"].alias("at"), o["item"].alias("item"),
                                                                  F.lit(False).alias("waits")))).otherwise(open_))
    href = F.regexp_extract(tag, HREF, 1)
    hits = F.transform(F.filter(open_, lambda o: o["waits"]), lambda o: F.struct(o["item"].alias("item"), href.alias("href")))
    return F.struct(new_lists.alias("lists"), (items + (item & ~ends).cast("int")).alias("items"), new_open.alias("open"),
                    F.when(link & (href != ""), F.concat(links, hits)).otherwise(links).alias("links"))


def _numbered_char(entity) -> Column:
    """The character of '&#47;' or '&#x2F;'; an ampersand stays written out,
    as named entities are decoded later; no character: U+FFFD."""
    hexed = F.regexp_extract(entity, "(?i)x([0-9a-f]+)", 1)
    code = F.when(hexed != "", hexed).otherwise(F.conv(F.regexp_extract(entity, "([0-9]+)", 1), 10, 16))
    number = F.conv(code, 16, 10).cast("bigint")
    sound = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return (F.when(number == 38, F.lit("&amp;"))
            .when(sound, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd")))


def item_links(html) -> Column:
    """Array of the first link of every list item that has one, in the order
    of the items; tags and attributes in any case, either quote or none, basic
    and numbered entities decoded."""
    tags = F.regexp_extract_all(F.regexp_replace(html, NO_MARKUP, ""), F.lit(ANY_TAG), F.lit(0))
    tags = F.filter(tags, lambda t: F.lower(F.regexp_extract(t, TAG_NAME, 1)).isin("ul", "ol", "li", "a"))
    links = F.array_sort(F.aggregate(tags, F.expr(_LINKS_START), _link_fold)["links"])

    def text(link):
        href = F.regexp_replace(link["href"], r"""^["']|["']$""", "")
        found = F.array_distinct(F.regexp_extract_all(href, F.lit(NUMBERED), F.lit(0)))
        href = F.aggregate(found, href, lambda h, e: F.replace(h, e, _numbered_char(e)))
        for entity, char in ENTITIES.items():
            href = F.replace(href, F.lit(entity), F.lit(char))
        return href
    return F.transform(links, text)


def page_links(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", F.explode(item_links("html")).alias("href"))


# --- reshape of the cause tables ------------------------------------------

def cause_measures(spark, sf_dir) -> DataFrame:
    """The three measures per (cause, country, year)."""
    rv = _reason_values(spark, sf_dir)
    per = mart(spark, sf_dir).table("cells")
    other = per.join(st.nations(spark, sf_dir).select("n_nationkey", "n_name"),
                     per["nationkey"] == F.col("n_nationkey")).select(
        st.cause_side_name(F.col("nationkey"), F.col("n_name")).alias("name"),
        F.col("year").cast("int").alias("year"), F.col("priority").alias("reason_name"),
        F.col("n_orders"), F.col("n_lines"))
    return rv.join(other, ["name", "year", "reason_name"])


def cause_files(spark, sf_dir) -> DataFrame:
    """Wide cause tables, one row per (cause, country), three blocks per year.

    Block ``Y.2`` holds the used value; ``Y`` and ``Y.1`` hold other measures.
    The header names repeat per year and are de-duplicated pandas-style.
    """
    long = cause_measures(spark, sf_dir)
    # the year list is bounded (one header per year); it fixes the pivot columns
    years = sorted(r[0] for r in long.select("year").distinct().collect())
    wide = (long.groupBy("reason_name", "name").pivot("year", years)
            .agg(F.max("n_orders").alias("a"), F.max("n_lines").alias("b"),
                 F.max("value_per_reason").alias("c")))
    headers = dedupe_headers([str(y) for y in years for _ in range(3)])
    src = [f"{y}_{s}" for y in years for s in ("a", "b", "c")]
    return wide.select("reason_name", "name",
                       *[F.col(s).alias(h) for s, h in zip(src, headers)])


def landed_cause_files(spark, sf_dir) -> DataFrame:
    """All landed cause files in one scan (cause name = folder partition value)."""
    return spark.read.option("header", True).csv(write_cause_files(spark, sf_dir))


def _block(files: DataFrame) -> list:
    # Of the three blocks per year keep the '.2' one (ages 0-4)
    return [c for c in files.columns if c.endswith(".2")]


# P13 + R1 + P9: keep the '.2' block, melt (NULL kept), year from the label,
# names through the dictionary
def melt_causes(spark, sf_dir) -> DataFrame:
    w = landed_cause_files(spark, sf_dir)
    block = _block(w)
    long = melt(w.select("reason_name", "name", *[F.col(f"`{c}`") for c in block]),
                ["reason_name", "name"], [F.col(f"`{c}`") for c in block], "year_label",
                "value_text")
    return long.select("reason_name", map_names("name").alias("name"),
                       year_from_label("year_label").alias("year"),
                       F.col("value_text").try_cast("decimal(10,2)").alias("value_per_reason"))


# P14 + R2 + R3: strip the block suffix, stack (NULL dropped)
def stack_causes(spark, sf_dir) -> DataFrame:
    w = landed_cause_files(spark, sf_dir)
    block = _block(w)
    w = strip_suffix(w.select("reason_name", "name", *[F.col(f"`{c}`") for c in block]), ".2")
    years = [c[:-2] for c in block]
    long = stack(w, ["reason_name", "name"], years, "year_label", "value_text")
    return long.select("reason_name", "name", F.col("year_label").cast("int").alias("year"),
                       F.col("value_text").try_cast("decimal(10,2)").alias("value_per_reason"))


# S12 + S2 + U3 + W4 + R1: the cause tables land as CSV, one folder per
# cause; all of them come back in ONE scan (the cause name is the folder's
# partition value, the file path is kept from the scan's metadata), cause ids
# follow the listing (name) order, and the '.2' block is melted. No per-file
# loop: the union of the files is the scan itself.
def write_cause_files(spark, sf_dir) -> str:
    m = mart(spark, sf_dir)
    path = m.path("landing_cause_files")
    if not m.exists("landing_cause_files"):
        w = cause_files(spark, sf_dir)
        m.publish("landing_cause_files",
                  lambda p: w.write.partitionBy("reason_name").option("header", True).csv(p))
    return path


def cause_file_union(spark, sf_dir) -> DataFrame:
    files = landed_cause_files(spark, sf_dir)
    block = _block(files)
    long = melt(files.select("reason_name", "name", *[F.col(f"`{c}`") for c in block]),
                ["reason_name", "name"], [F.col(f"`{c}`") for c in block], "year_label",
                "value_text")
    ids = name_ids(files.select("reason_name"), "reason_name", "reason_id")
    return long.join(ids, "reason_name").select(
        F.col("reason_id").cast("int"), "reason_name", map_names("name").alias("name"),
        year_from_label("year_label").alias("year"),
        F.col("value_text").try_cast("decimal(10,2)").alias("value_per_reason"))


# Natural join on every common column (here: name, year), NULL-safe
def natural_join_q(spark, sf_dir) -> DataFrame:
    rv = _reason_values(spark, sf_dir).withColumn("name", map_names("name"))
    u5 = series(spark, sf_dir, indicator_id=1).withColumnRenamed("value", "under5_value")
    return natural_join(rv, u5)


# Append frames with different columns; the missing side is NULL. The
# first cause keeps its year column, every other cause brings it as level_1.
def union_missing(spark, sf_dir, first: str = "1-URGENT") -> DataFrame:
    rv = _reason_values(spark, sf_dir)
    a = rv.where(F.col("reason_name") == first).select("name", "year", "value_per_reason")
    b = rv.where(~F.col("reason_name").eqNullSafe(first)).select(
        "name", F.col("year").alias("level_1"), "value_per_reason")
    return a.unionByName(b, allowMissingColumns=True)


# --- star tables and checks ------------------------------------------------

def star_table(name: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart(spark, sf_dir).table(name)
    q.__name__ = f"star_{name}"
    return q


FOREIGN_KEYS = [
    ("dim_country.date_year", "dim_country", ["date_year"], "dim_date", ["date_year"]),
    ("dim_reason.date_year", "dim_reason", ["date_year"], "dim_date", ["date_year"]),
    ("fact_metrics.country_key", "fact_metrics", ["country_key"], "dim_country", ["country_key"]),
    ("fact_metrics.date_year", "fact_metrics", ["date_year"], "dim_date", ["date_year"]),
    ("fact_metric_death_reasons.metric_id", "fact_metric_death_reasons", ["metric_id"],
     "fact_metrics", ["metric_id"]),
    ("fact_metric_death_reasons.reason_key", "fact_metric_death_reasons", ["reason_key"],
     "dim_reason", ["reason_key"]),
    ("fact_metric_death_reasons.date_year", "fact_metric_death_reasons", ["date_year"],
     "dim_date", ["date_year"]),
]


# Known gaps of the loads, counted rather than hidden
def quality_checks(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    checks = [
        ("dim_date.date_tens is null", m.table("dim_date").where(F.col("date_tens").isNull())),
        ("fact_metrics.country_key is null",
         m.table("fact_metrics").where(F.col("country_key").isNull())),
        ("dim_country.date_year is null",
         m.table("dim_country").where(F.col("date_year").isNull())),
    ]
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("check_name"), "n_rows")
        for name, df in checks])


# Violations of each declared key and NOT NULL column (0 expected)
def key_check(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        key_violations(m.table(name), *keys).select(F.lit(name).alias("table_name"), "constraint_name", "n_violations")
        for name, keys in KEYS.items()])


# Violations per foreign key (0 expected), all keys of a child in one pass
def fk_check(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    children: dict[str, list] = {}
    for fk, child, ck, parent, pk in FOREIGN_KEYS:
        children.setdefault(child, []).append((fk, ck, m.table(parent), pk))
    return reduce(DataFrame.unionByName, [fk_violation_counts(m.table(c), keys) for c, keys in children.items()])
