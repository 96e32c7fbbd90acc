"""From the raw country listing to the landing sheets that the load reads.

The listing has one row per country or aggregate: position, id, iso2Code,
name, region, incomeLevel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.operators.joins import natural_join
from vitalmart.operators.keys import first_seen_ids, with_position


def landing_lists(listing: DataFrame, aggregate: str) -> dict[str, DataFrame]:
    """The sheets Region, Income_group and Country, with a leading row number.

    Regions are numbered by first appearance in the whole listing, income
    levels by first appearance among the countries (rows of another region
    than ``aggregate``), countries by their order. NULL is a region and a
    level like any other. An empty listing gives empty sheets.
    """
    countries = listing.where(~F.col("region").eqNullSafe(aggregate))
    regions = first_seen_ids(listing, "region", "position", "index_region")
    levels = first_seen_ids(countries, "incomeLevel", "position", "index_income")
    numbered = with_position(natural_join(natural_join(countries, regions), levels),
                             ["position"], "index_country")

    def sheet(df: DataFrame, index: str, *cols: str) -> DataFrame:
        return df.select((F.col(index) - 1).alias("_row"), index, *cols)

    return {"Region": sheet(regions, "index_region", "region"),
            "Income_group": sheet(levels, "index_income", "incomeLevel"),
            "Country": sheet(numbered.withColumnRenamed("id", "iso3Code"), "index_country",
                             "iso3Code", "iso2Code", "name", "region", "incomeLevel",
                             "index_region", "index_income")}
