"""Page-path and page-analytics plans over the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import OPEN_END, day
from tallyflow.operators.history import history_compare
from tallyflow.plans import page_analytics as pa
from tallyflow.plans import page_path as pp
from tallyflow.sources.page_standins import PageAnalytics, PagePath
from tallyflow.sources.standins import EVENTS_AS_OF as AS_OF


class PathWarehouse(PagePath):
    def history(self, table: DataFrame, key: str, tracked: dict[str, Column]) -> DataFrame:
        """History of a dimension whose tracked columns change on the report day as given."""
        held = table.select(key, *tracked).withColumn("start_date", day("2024-01-01")).withColumn("end_date", day(OPEN_END)).withColumn("is_current", F.lit(1))
        return history_compare(held, table.withColumns(tracked).select(key, *tracked), key, list(tracked), AS_OF)

    @cached_property
    def visits(self) -> DataFrame:
        return pp.visits(self.visit_log, self.page_info)

    @cached_property
    def session(self) -> DataFrame:
        return pp.sessions(self.visits)

    @cached_property
    def conversion(self) -> DataFrame:
        return pp.conversions(self.session, self.shop_orders)

    @cached_property
    def outcome(self) -> DataFrame:
        return pp.converted_sessions(self.session, self.conversion)

    @cached_property
    def steps(self) -> DataFrame:
        return pp.jumps(self.visits)

    @cached_property
    def page_nd(self) -> DataFrame:
        return pp.page_stats(self.visits, self.outcome, AS_OF)

    @cached_property
    def flow_nd(self) -> DataFrame:
        return pp.path_flow(self.steps, self.page_nd, AS_OF)


PATH_QUERIES = {
    "path_user_history": lambda w: w.history(
        w.raw("customer"), "c_custkey", {"c_mktsegment": F.when(F.col("c_custkey") % 4 == 0, F.lit("NEW")).otherwise(F.col("c_mktsegment")), "c_nationkey": F.col("c_nationkey")}),
    "path_product_history": lambda w: w.history(
        w.raw("part"), "p_partkey", {"p_retailprice": F.when(F.col("p_partkey") % 5 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")), "p_type": F.nullif("p_type", F.lit("PROMO"))}),
    "path_page_history": lambda w: w.history(
        w.page_info, "page_id", {"page_type": F.when(F.col("page_type") == "home", "start").otherwise(F.col("page_type")), "page_name": F.col("page_name")}),
    "path_visit_fact": lambda w: w.visits,
    "session_path": lambda w: w.session,
    "path_jump_fact": lambda w: pp.jump_counts(w.steps),
    "session_conversion": lambda w: w.conversion,
    "path_device_horizons": lambda w: pp.device_stats(w.outcome, AS_OF),
    "path_page_horizons": lambda w: w.page_nd,
    "path_entry_horizons": lambda w: pp.entry_stats(w.outcome, AS_OF),
    "path_flow_horizons": lambda w: w.flow_nd,
    "entry_page_map": lambda w: pp.user_paths(w.outcome, AS_OF),
    "path_page_type_horizons": lambda w: pp.page_type_summary(w.visits, w.outcome, AS_OF),
    "path_device_report": lambda w: pp.report(pp.device_stats(w.outcome, AS_OF).where("device_type is not null")),
    "path_page_report": lambda w: pp.report(w.page_nd),
    "path_entry_report": lambda w: pp.report(pp.entry_stats(w.outcome, AS_OF)),
    "path_flow_report": lambda w: pp.report(w.flow_nd),
}


class AnalyticsWarehouse(PageAnalytics):
    @cached_property
    def blocks(self) -> DataFrame:
        return pa.block_agg(pa.block_fact(self.block_click), AS_OF)

    @cached_property
    def guides(self) -> DataFrame:
        return pa.guide_agg(pa.guide_fact(self.guide_product), AS_OF)

    @cached_property
    def modules(self) -> DataFrame:
        return pa.module_agg(pa.module_fact(self.module_detail), AS_OF)

    @cached_property
    def trend(self) -> DataFrame:
        return pa.trend_fact(self.data_trend, AS_OF)

    @cached_property
    def hours(self) -> DataFrame:
        return pa.visit_agg(pa.visit_fact(self.visit_base), AS_OF)


ANALYTICS_QUERIES = {
    "page_info_dim": lambda w: pa.latest_dim(w.visit_base, "page_id", "visit_time", ["page_name", "page_type"], AS_OF),
    "page_block_dim": lambda w: pa.latest_dim(w.block_click, "block_id", "collect_time", ["block_name", "page_id"], AS_OF),
    "page_module_dim": lambda w: pa.latest_dim(
        w.module_detail, "module_id", "stat_time", ["module_name", "module_type", "page_id"], AS_OF, pa.F.col("expose_pv") > 0),
    "page_product_dim": lambda w: pa.products(w.guide_product, AS_OF),
    "page_visit_fact": lambda w: pa.visit_fact(w.visit_base),
    "page_block_fact": lambda w: pa.block_fact(w.block_click),
    "page_trend_fact": lambda w: w.trend,
    "page_guide_fact": lambda w: pa.guide_fact(w.guide_product),
    "page_module_fact": lambda w: pa.module_fact(w.module_detail),
    "page_visit_horizons": lambda w: w.hours,
    "page_block_horizons": lambda w: w.blocks,
    "page_trend_horizons": lambda w: pa.trend_agg(w.trend, AS_OF),
    "page_guide_horizons": lambda w: w.guides,
    "page_module_horizons": lambda w: w.modules,
    "page_overview_report": lambda w: pa.overview(w.hours, w.blocks, w.modules),
    "page_block_report": lambda w: pa.block_performance(w.blocks, w.guides),
    "page_trend_report": lambda w: pa.trend_report(w.trend, pa.trend_agg(w.trend, AS_OF), AS_OF),
    "page_guide_report": lambda w: pa.guide_report(w.guides, pa.products(w.guide_product, AS_OF)),
    "page_module_report": lambda w: pa.module_report(pa.module_fact(w.module_detail), w.modules, AS_OF, growth_days=14),
}
