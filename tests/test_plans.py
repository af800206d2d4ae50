"""Plans that must hold at scale."""

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_business_date_reaches_the_scan(spark):
    p = plan(entry.queries()["order_detail_fact_daily"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-31" in p and "o_totalprice" not in p


def test_horizon_filter_reaches_the_scan(spark):
    p = plan(entry.queries()["user_behavior_horizons"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(" in p and "ThanOrEqual(ts,2" in p


def test_page_log_is_pruned_before_it_is_parsed(spark):
    for name in ("page_path_edges", "traffic_by_channel"):
        assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2" in plan(entry.queries()[name](spark, SF_DIR)), name


def test_recent_parcels_are_pruned_by_their_load_day(spark):
    for name in ("parcel_dispatch_nd", "parcel_express_org_stats"):
        p = plan(entry.queries()[name](spark, SF_DIR))
        assert "GreaterThanOrEqual(o_orderdate,2001-06" in p, name


def test_express_report_shuffles_little(spark):
    p = plan(entry.queries()["parcel_express_org_stats"](spark, SF_DIR))
    assert p.count("Exchange hashpartitioning") < 15 and p.count("lineitem.parquet") <= 3
    assert "GreaterThanOrEqual(l_shipdate,2001-06" in p


def test_log_rows_are_shuffled_once_for_distincts(spark):
    p = plan(entry.queries()["user_behavior_horizons"](spark, SF_DIR))
    assert "Expand" not in p and p.count("FileScan") == 1


def test_parcels_are_not_dealt_by_their_few_codes(spark):
    p = plan(entry.queries()["parcel_cargo_type_1d"](spark, SF_DIR))
    assert "hashpartitioning(order_id" in p and "hashpartitioning(cargo_type" not in p


def test_window_rows_meet_names_once(spark, monkeypatch):
    """Product, brand and category names are looked up on the goods, not on the windows."""
    from tallyflow.catalog import streams

    monkeypatch.setattr(streams, "drain", lambda stream, name: stream)
    p = streams.sku_window(streams.StreamWarehouse(spark, SF_DIR))._jdf.queryExecution().analyzed().toString()
    assert p[: p.index("Aggregate [")].count("Join LeftOuter") == 1 and p.count("Join LeftOuter") >= 6
