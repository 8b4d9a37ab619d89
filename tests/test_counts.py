import time

from pyspark.sql import functions as F

from checks import frames as fx
from checks.queries import unified
from ordermill.operators import quality, silver
from ordermill.plans import layers
from ordermill.sources import batch, sinks
from ordermill.streaming import flows
from ordermill.streaming.counts import RuleCountLog
from tests.test_streaming import done


def test_counts_of_all_batches_add_up_to_those_of_one_run(spark, sf_dir, database, tmp_path):
    path, log = str(tmp_path / "orders"), f"{database}.log"
    orders = unified(spark, sf_dir)
    orders.repartition(3).write.parquet(path)
    listener = RuleCountLog(spark, log, ["silver.fact_orders"])
    spark.streams.addListener(listener)

    def run():
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(path)
        headers = silver.fact_orders(stream, metrics="silver.fact_orders")
        done(sinks.stream_to_table(headers, f"{database}.facts", str(tmp_path / "c")))

    want = {r.rule: r.row_count for r in quality.violation_counts(silver.order_headers(orders), silver.header_rules()).collect()}
    kept = want.pop("rows_kept")

    def logged():
        if not spark.catalog.tableExists(log):
            return {}
        return {r.measure: r.value for r in spark.table(log).groupBy("measure").agg(F.sum("value").alias("value")).collect()}

    try:
        run()
        until = time.time() + 60
        while logged() != want and time.time() < until:
            time.sleep(1)
        run()
        time.sleep(2)
        assert logged() == want and not listener.problems
        assert spark.table(log).select("run").distinct().count() == 3
        assert spark.table(f"{database}.facts").count() == kept
    finally:
        spark.streams.removeListener(listener)


def test_a_clean_build_clears_the_rejects_of_the_last(spark, database, monkeypatch):
    monkeypatch.setattr(layers, "QUARANTINE", f"{database}.quarantine")
    rows = spark.createDataFrame([(1, None), (2, -1.0), (3, 1.0)], "id int, amount double")
    rules = {"valid_amount": "amount > 0"}
    layers._set_aside(quality.quarantine(rows, rules), "silver.one")
    layers._set_aside(quality.quarantine(rows.where("id = 2"), rules), "silver.two")
    assert spark.table(layers.QUARANTINE).groupBy("table_name").count().orderBy("table_name").collect() == [("silver.one", 2), ("silver.two", 1)]
    layers._set_aside(quality.quarantine(rows.where("id = 3"), rules), "silver.one")
    assert [r.table_name for r in spark.table(layers.QUARANTINE).collect()] == ["silver.two"]


def test_every_ruled_table_has_its_rejects(spark, sf_dir):
    sources = {
        "bronze.restaurants_raw": fx.venues_raw(spark, sf_dir), "bronze.customers_raw": fx.customers_raw(spark, sf_dir),
        "bronze.menu_items_raw": fx.whole_menu_raw(spark, sf_dir),
    }
    for step in layers.build_steps(fx.AS_OF):
        assert (step.rejected is not None) == step.ruled
        if step.table.startswith("silver.dim_"):
            name = next(iter(set(sources) & {f"bronze.{step.table.removeprefix('silver.dim_')}s_raw"}))
            raw = sources[name].limit(5)
            spoiled = raw.withColumn("restaurant_id" if "restaurant_id" in raw.columns else "customer_id", F.lit(None).cast("string"))
            assert step.rejected(lambda _, spoiled=spoiled: spoiled).count() == 5


def test_a_batch_of_a_stream_table_is_read(spark, database):
    sinks.append_rows(spark.range(3).toDF("v"), f"{database}.t")
    sinks.append_rows(spark.range(2).toDF("v"), f"{database}.t")
    assert batch.read_table(spark, f"{database}.t").count() == 5 and callable(flows.bronze_stream)
