import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ordermill.functions.payload import count_items
from ordermill.session import discard, materialise, shared_folder
from ordermill.sources import batch, kafka, sinks


@pytest.fixture(scope="module")
def derby():
    return {"url": "jdbc:derby:memory:shop;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_load_counts_rows_and_reads_in_parallel(spark, derby, database):
    spark.range(100).selectExpr("id", "cast(id % 7 as int) AS seven").write.format("jdbc").options(
        **derby, dbtable="numbers").mode("overwrite").save()
    split = batch.JdbcSplit("id", 0, 100, 4)
    df = batch.read_jdbc(spark, "numbers", derby, split)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    loads = [batch.TableLoad("numbers", f"{database}.numbers_raw", split), batch.TableLoad("numbers", f"{database}.again", batch.SMALL)]
    assert batch.load_tables(spark, loads, derby) == {f"{database}.numbers_raw": 100, f"{database}.again": 100}
    assert spark.table(f"{database}.numbers_raw").agg(F.sum("id")).first()[0] == 4950


def test_jdbc_filters_reach_the_database(spark, derby):
    spark.range(10).selectExpr("id").write.format("jdbc").options(**derby, dbtable="few").mode("overwrite").save()
    plan = batch.read_jdbc(spark, "few", derby, batch.SMALL).filter("id > 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(id), *GreaterThan(id,7)]" in plan


def test_csv_keeps_text_and_commas_in_quotes(spark, tmp_path):
    path = tmp_path / "menu.csv"
    path.write_text(
        "restaurant_id,item_id,name,category,price,ingredients,is_vegetarian,spice_level\n"
        'V1,M1,Stew,Main Course,1200,"herbs, beans",False,None\n'
    )
    row = batch.read_csv(spark, str(path), batch.MENU_ITEMS_CSV).first()
    assert row.spice_level == "None" and row.ingredients == "herbs, beans" and row.price == 1200


def test_csv_is_published_and_a_missing_file_is_skipped(spark, derby, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("customer_id,name,email,phone,city,join_date\nC1,Ann,a@b,1,X,2024-01-01\n")
    assert batch.publish_csv(spark, str(path), batch.CUSTOMERS_CSV, "customers", derby)
    assert not batch.publish_csv(spark, str(tmp_path / "none.csv"), batch.CUSTOMERS_CSV, "customers", derby)
    assert batch.read_jdbc(spark, "customers", derby, batch.SMALL).count() == 1


def test_kafka_options():
    options = kafka.source_options("host:1", "orders", security=kafka.scram_security("u", "p", "/ca.pem", "Login"))
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    limited = kafka.source_options("host:1", "orders", 500, fail_on_data_loss=False)
    assert limited["maxOffsetsPerTrigger"] == "500" and limited["failOnDataLoss"] == "false"
    assert options["failOnDataLoss"] == "true" and options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.jaas.config"] == 'Login required username="u" password="p";'


def message(value):
    return (bytearray(b"V1"), bytearray(value.encode()), None, 0, 1)


def test_any_message_becomes_a_bronze_row(spark):
    items = [{"item_id": "a", "quantity": 1, "category": "Bread"}]
    good = json.dumps({"order_id": "O1", "items": items, "total_amount": 5.5, "extra": 1})
    values = [good, "{bad", "{}", "", json.dumps({"order_id": "O2", "total_amount": "much"})]
    df = spark.createDataFrame([message(v) for v in values], kafka.ENVELOPE)
    rows = {r.raw_json_payload: r for r in kafka.bronze_orders(df).withColumn("n", count_items(F.col("items"))).collect()}
    assert len(rows) == 5 and all(r.ingested_at for r in rows.values())
    assert rows[good].order_id == "O1" and rows[good].n == 1 and rows[good].total_amount == 5.5
    assert json.loads(rows[good]["items"]) == items
    assert rows["{bad"].order_id is None and rows[values[4]].total_amount is None


def test_messages_round_trip(spark):
    df = spark.createDataFrame([("V1", "O1", 2.5)], "restaurant_id string, order_id string, total_amount double")
    row = kafka.to_messages(df, "restaurant_id").first()
    assert row.key == "V1" and json.loads(row.value) == {"restaurant_id": "V1", "order_id": "O1", "total_amount": 2.5}


def test_overwrite_replaces_schema(spark, database):
    table = f"{database}.t"
    sinks.overwrite_table(spark.range(3), table)
    sinks.overwrite_table(spark.range(2).selectExpr("id AS other", "'x' AS more"), table)
    assert spark.table(table).columns == ["other", "more"] and spark.table(table).count() == 2


def test_partition_overwrite_touches_only_the_days_it_holds(spark, database):
    table = f"{database}.days"

    def days(*rows):
        return spark.createDataFrame(list(rows), "v int, order_date string")

    sinks.overwrite_partitions(days((1, "a"), (2, "b")), table, ["order_date"])
    sinks.overwrite_partitions(days((5, "b"), (6, "c")), table, ["order_date"])
    assert {(r.order_date, r.v) for r in spark.table(table).collect()} == {("a", 1), ("b", 5), ("c", 6)}
    plan = spark.table(table).filter("order_date = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan


def test_append_log_merges_schemas(spark, database):
    table = f"{database}.log"
    sinks.append_merged(spark.sql("SELECT 1 AS run, 'a' AS note"), table)
    sinks.append_merged(spark.sql("SELECT 2 AS run, 0.5D AS score"), table)
    sinks.append_merged(spark.sql("SELECT 'c' AS note, 3 AS run"), table)
    rows = {r.run: (r.note, r.score) for r in spark.table(table).collect()}
    assert rows == {1: ("a", None), 2: (None, 0.5), 3: ("c", None)}


def test_tags_and_comment(spark, database):
    sinks.overwrite_table(spark.range(1), f"{database}.t")
    sinks.tag_table(spark, f"{database}.t", {"quality": "gold"}, "it's ours")
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {database}.t").collect()}
    assert shown["quality"] == "gold"


def test_namespaces_are_created_once_and_again(spark):
    for _ in range(2):
        sinks.create_namespaces(spark, ["bronze_x"])
    assert spark.catalog.databaseExists("bronze_x")
    spark.sql("DROP DATABASE bronze_x")


def test_materialised_frames_live_in_the_shared_folder_until_discarded(spark):
    df = materialise(spark.range(5), "five")
    assert df.count() == 5 and shared_folder(spark) in df.inputFiles()[0]
    folder = Path(df.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists()
    discard(df)
    assert not folder.exists()


def test_scratch_goes_to_the_named_folder_or_the_warehouse():
    def session(master, **settings):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, *default: settings.get(key, *default)),
            sparkContext=SimpleNamespace(master=master, applicationId="app"),
        )

    for master in ("local[2]", "yarn"):
        unset = session(master, **{"spark.sql.warehouse.dir": "s3://lake/warehouse"})
        assert shared_folder(unset) == "s3://lake/warehouse/_scratch/app"
        named = session(master, **{"spark.checkpoint.dir": "hdfs:///scratch/"})
        assert shared_folder(named) == "hdfs:///scratch/app"


def test_a_repeated_run_replaces_its_own_log_rows(spark, database):
    table = f"{database}.runs"
    for value in (1, 2):
        sinks.append_merged(spark.sql(f"SELECT {value} AS v, 'a' AS run"), table, run="run")
    sinks.append_merged(spark.sql("SELECT 3 AS v, 'new' AS note, 'b' AS run"), table, run="run")
    assert {(r.run, r.v, r.note) for r in spark.table(table).collect()} == {("a", 2, None), ("b", 3, "new")}


@pytest.mark.parametrize("hashed", ["hash({c})", "crc32({c})", "length({c})"])
def test_hash_predicates_part_a_table(spark, hashed):
    keys = spark.range(1000).selectExpr("CASE WHEN id % 50 > 0 THEN concat('key ', id * 7919) END AS k")
    parts = [keys.where(p) for p in batch.HashSplit("k", 4, hashed).predicates()]
    counts = [p.count() for p in parts]
    assert sum(counts) == 1000 and parts[0].where("k IS NULL").count() == 20 and parts[1].where("k IS NULL").count() == 0
    assert sum(c > 0 for c in counts) >= 2 and parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]).exceptAll(keys).isEmpty()


def test_splits_by_kind_of_column():
    assert batch.split_for("string", "k", "a", "z", 10_000, 3_000, "hashtext({c})", 16) == batch.HashSplit("k", 4, "hashtext({c})")
    assert batch.split_for("bigint", "id", 1, 99, 10_000, 100, None, 16) == batch.JdbcSplit("id", "1", "99", 16)
    assert batch.split_for("date", "d", "2024-01-01", "2024-02-01", 10, 5, None, 16).partitions == 2
    assert batch.split_for("string", "k", "a", "z", 10, 100, None, 16) is batch.SMALL
    assert batch.split_for("int", "k", None, None, 1000, 100, None, 16) is batch.SMALL
    with pytest.raises(ValueError, match="hash"):
        batch.split_for("varchar(9)", "k", "a", "z", 1000, 100, None, 16)
    assert "MIN(k)" in batch.bounds_query("t", "k")
