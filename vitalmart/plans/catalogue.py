"""Query catalogue: name -> Spark callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalmart.plans import exchange as X
from vitalmart.plans import landing as L
from vitalmart.plans import questions as Q
from vitalmart.plans import worksheets as W

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    # worksheets (V2 = inner star, V1 = all-left view)
    "q_ws_region_rank": W.ws_region_rank,
    "q_ws_income": W.ws_income,
    "q_ws_country_map": W.ws_country_map,
    "q_ws_trend": W.ws_trend,
    "q_ws_reason_rank": W.ws_reason_rank,
    "q_ws_country_decade": W.ws_country_decade,
    "q_ws_region_decade": W.ws_region_decade,
    "q_ws_country_reason_decade": W.ws_country_reason_decade,
    "q_ws_reasons_ci": W.ws_reasons_ci,
    "q_ws_reasons_over_time": W.ws_reasons_over_time,
    "q_ws_year_map": W.ws_year_map,
    "q_ws_income_groups": W.ws_income_groups,
    "q_ws_country_map_v1": W.ws_country_map_v1,
    "q_ws_income_trend": W.ws_income_trend,
    "q_ws_region_gni": W.ws_region_gni,
    "q_ws_region_mortality": W.ws_region_mortality,
    "q_ws_region_mortality_unfanned": W.ws_region_mortality_unfanned,
    "q_ws_calc_fields": W.ws_calc_fields,
    "q_ws_manual_order": W.ws_manual_order,
    "q_ws_param_filters": W.ws_param_filters,
    "q_ws_reason_range": W.ws_reason_range,
    "q_ws_reason_star": W.ws_reason_star,
    "q_measure_menu": W.measure_menu,
    "q_region_decade_grid": W.region_decade_grid,
    "q_extract": W.extract,
    # stated questions
    "q_above_threshold": Q.above_threshold,
    "q_biggest_decrease": Q.biggest_decrease,
    "q_top_causes_by_year": Q.top_causes_by_year,
    "q_corr_income": Q.corr_income,
    # star, staging, checks
    "q_dim_date": L.star_table("dim_date"),
    "q_dim_country": L.star_table("dim_country"),
    "q_dim_reason": L.star_table("dim_reason"),
    "q_fact_metrics": L.star_table("fact_metrics"),
    "q_fact_reasons": L.star_table("fact_metric_death_reasons"),
    "q_fk_violations": L.fk_check,
    "q_key_violations": L.key_check,
    "q_quality_checks": L.quality_checks,
    "q_stg_indicator": L.stg_indicator,
    "q_stg_reason_values": L.stg_reason_values,
    "q_stg_country": L.star_table("country"),
    "q_stg_income_group_year": L.star_table("income_group_year"),
    "q_income_group_country": L.income_group_country,
    "q_income_by_year": L.income_by_year,
    "q_first_seen_ids": L.first_seen,
    "q_country_dim_src": L.country_dim_src,
    "q_series": L.series,
    "q_row_ids": L.row_ids,
    "q_name_map": L.name_map,
    "q_melt_causes": L.melt_causes,
    "q_stack_causes": L.stack_causes,
    "q_cause_file_union": L.cause_file_union,
    "q_natural_join": L.natural_join_q,
    "q_union_missing": L.union_missing,
    # tables through the file formats of the loads
    "q_country_csv": X.country_csv,
    "q_reason_export": X.reason_export,
    "q_appended_series": X.appended_series,
    "q_declared_fact": X.declared_fact,
    "q_quoted_documents": X.quoted_documents,
    "q_unlike_cause_files": X.unlike_cause_files,
    "q_retyped_year_join": X.retyped_year_join,
    # landing operators over the raw tables
    "q_file_ids": L.file_ids,
    "q_raw_countries": X.raw_countries,
    "q_keyword_search": L.keyword_search,
    "q_union_indicators": L.union_indicators,
    "q_group_size": L.group_size,
    "q_distinct_rows": L.distinct_rows,
    "q_head": L.head,
    "q_mean_by_year": L.mean_by_year,
    "q_tail": L.tail,
    "q_trend_since": L.trend_since,
    "q_year_parts": L.year_parts,
    "q_shape": L.shape,
    "q_row_slice": L.row_slice,
    "q_drop_incomplete": L.drop_incomplete,
    "q_income_bounds": L.income_bounds,
    "q_income_code": L.income_codes,
    "q_clean_names": L.clean_names,
    "q_nan_to_null": L.nan_to_null_q,
    "q_key_prefix": L.key_prefix,
    "q_page_links": L.page_links,
}


# The eight stated research questions: the query answering each and the
# worksheet parameter to set where the default selection is not the one asked.
QUESTIONS: dict[int, tuple[str, str]] = {
    1: ("q_ws_country_map_v1", "year: the year asked for"),
    2: ("q_ws_income_trend", ""),
    3: ("q_top_causes_by_year", "years: the two years compared"),
    4: ("q_ws_region_mortality", ""),
    5: ("q_above_threshold", "reason, x: the cause and the rate"),
    6: ("q_biggest_decrease", "span: the number of years"),
    7: ("q_ws_region_rank", ""),
    8: ("q_corr_income", ""),
}
