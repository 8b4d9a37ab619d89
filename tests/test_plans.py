"""What the physical plans must look like for the operators to hold at scale."""

import re

import pytest

from checks import frames as fx
from checks import queries as cq
from ordermill.operators import forecast as fc
from ordermill.operators import marts, silver
from ordermill.plans import dashboards as db


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver_tables(spark, sf_dir, tmp_path_factory):
    """Order and review facts as files, the way the marts find them."""
    base = tmp_path_factory.mktemp("silver")

    def stored(name, df):
        df.write.parquet(str(base / name))
        return spark.read.parquet(str(base / name))

    return {
        "orders": stored("orders", fx.fact_orders(spark, sf_dir)),
        "reviews": stored("reviews", fx.fact_review(spark, sf_dir)),
        "items": stored("items", fx.fact_order_items(spark, sf_dir)),
        "venues": stored("venues", silver.dim_restaurant(fx.venues_raw(spark, sf_dir))),
        "menu": stored("menu", silver.dim_menu_item(fx.menu_raw(spark, sf_dir))),
    }


def test_filter_and_columns_reach_the_scan(silver_tables):
    plan = plan_of(marts.daily_sales_summary(silver_tables["orders"], sketch=False))
    assert "PushedFilters: [In(order_status, [completed,delivered])]" in plan
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert set(re.findall(r"(\w+)#", read)) == {
        "order_id", "order_date", "restaurant_id", "order_type", "total_amount", "order_status"}


def test_marts_do_not_expand_rows_for_distinct_counts(silver_tables):
    t = silver_tables
    for df in (
        marts.restaurant_360(t["venues"], t["orders"], t["reviews"], fx.AS_OF, unique_ids=True),
        marts.daily_restaurant_performance(t["orders"], t["reviews"], t["venues"], fx.AS_OF, unique_ids=True),
        marts.restaurant_reviews(t["reviews"], t["venues"], unique_ids=True),
        marts.customer_restaurant_preference(t["orders"], t["reviews"], fx.AS_OF, unique_ids=True),
    ):
        assert "Expand" not in plan_of(df)


def test_venue_profile_reads_orders_once(silver_tables):
    t = silver_tables
    plan = plan_of(marts.restaurant_360(t["venues"], t["orders"], t["reviews"], fx.AS_OF, unique_ids=True))
    assert len(re.findall(r"FileScan parquet \[order_id", plan)) == 1


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are for sides too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", re.sub(r"#\d+L?", "", plan_of(df)))


def test_preference_windows_share_one_exchange(silver_tables, no_broadcast):
    found = exchanges(
        marts.customer_restaurant_preference(
            silver_tables["orders"], silver_tables["reviews"], fx.AS_OF, unique_ids=True))
    # orders and reviews by pair, then the pairs by customer; the join moves nothing
    assert sorted(found) == ["customer_id", "customer_id, restaurant_id", "customer_id, restaurant_id"]


def test_item_popularity_adds_no_exchange_for_the_distinct_count(silver_tables, no_broadcast):
    t = silver_tables
    found = exchanges(marts.daily_item_popularity(t["items"], t["orders"], t["menu"]))
    # items and orders by order, the aggregate by its keys, then both sides of the menu join
    assert len(found) == 5 and not any("order_id" in keys and "item_id" in keys for keys in found)


def test_item_popularity_keeps_one_table_of_groups_per_task(silver_tables, no_broadcast):
    t = silver_tables
    plan = re.sub(r"#\d+L?", "", plan_of(marts.daily_item_popularity(t["items"], t["orders"], t["menu"])))
    # A task of the join holds its two sorts and the map-side groups, no second and third table by order.
    assert re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan) == ["order_date, restaurant_id, item_id"] * 2
    # Each side is sorted once, for its marks and the join alike.
    assert len(re.findall(r"Sort \[order_id ASC", plan)) == 2
    # A range of days still reaches the headers before they are dealt.
    days = marts.daily_item_popularity(t["items"], t["orders"], t["menu"]).filter("order_date >= DATE'1996-01-01'")
    plan = re.sub(r"#\d+L?", "", plan_of(days))
    assert "order_date >= 1996-01-01" in plan[plan.rindex("REPARTITION_BY_COL"):]


def test_dedup_combines_copies_before_the_one_exchange(spark, sf_dir, tmp_path):
    cq.fx.historical_orders_raw(spark, sf_dir).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    plan = plan_of(silver.unify_orders([("a", orders), ("b", orders)]))
    # A hot id leaves each task as one row; rows without id are in a branch that moves nothing.
    assert plan.count("Exchange") == 1 and "partial_min" in plan[plan.index("Exchange"):]
    assert "IsNull(order_id)" in plan and "Window" not in plan


def test_sketches_do_not_move_per_venue(silver_tables):
    plan = re.sub(r"#\d+L?", "", plan_of(marts.daily_sales_summary(silver_tables["orders"])))
    moved = [line for line in plan.splitlines() if "hll" in line or "Exchange" in line]
    for k, line in enumerate(moved):
        if "partial_hll_sketch_agg" in line:
            assert "hashpartitioning(order_date, " in moved[k - 1] or "hashpartitioning(order_date, " in moved[k - 2]
    assert not any("hll" in line and "restaurant_id" in line for line in moved)


def scans(df, column):
    """File scans in the plan that really ran."""
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    return len(re.findall(rf"FileScan parquet \[[^\]]*{column}", final))


def test_single_reads(spark, silver_tables):
    t = silver_tables
    sales = t["orders"].selectExpr("restaurant_id", "order_date AS activity_date", "total_amount AS daily_revenue")
    assert scans(fc.forecast(sales, as_of=fx.AS_OF), "total_amount") == 1
    assert scans(fc.calendar_features(fc.regular_series(sales)), "total_amount") == 1
    performance = marts.daily_restaurant_performance(t["orders"], t["reviews"], t["venues"], fx.AS_OF, unique_ids=True)
    # The calendar's first days come from the sales, whose exchange serves both.
    final = plan_of(performance).split("== Initial Plan ==")[0]
    assert "Expand" not in final
    performance.collect()
    final = plan_of(performance).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[order_id", final)) - final.count("ReusedExchange") <= 1


@pytest.mark.parametrize("name", ["star_breakdown", "sentiment_distribution"])
def test_unpivots_read_their_table_once(silver_tables, name):
    per_venue = marts.restaurant_reviews(silver_tables["reviews"], silver_tables["venues"])
    plan = plan_of(getattr(db, name)(per_venue, silver_tables["venues"]))
    assert len(re.findall(r"FileScan parquet \[restaurant_id#\d+,(rating|sentiment)#", plan)) == 1


def test_no_cross_join_in_any_dashboard(spark, sf_dir):
    for name in (n for n in cq.QUERIES if n.startswith("db_")):
        plan = plan_of(cq.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_forced_broadcast_anywhere():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    parts = ("functions", "operators", "plans", "sources", "streaming")
    for path in [*(p for part in parts for p in root.glob(f"ordermill/{part}/*.py")), *root.glob("checks/*.py")]:
        source = path.read_text()
        assert "broadcast(" not in source and "localCheckpoint" not in source and "crossJoin" not in source, path


def test_forecast_work_runs_in_as_many_tasks_as_asked(silver_tables):
    t = silver_tables
    performance = marts.daily_restaurant_performance(t["orders"], t["reviews"], t["venues"], fx.AS_OF)
    plan = plan_of(fc.forecast(performance, fc.ForecastPlan(fit_tasks=17), fx.AS_OF))
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(restaurant_id" in plan and ", 17)" in plan
    assert "Pandas" not in plan and "Python" not in plan
