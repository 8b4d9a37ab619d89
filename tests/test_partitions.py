import datetime as dt

import pytest

from ordermill.sources import partitions, sinks


def frame(spark, *rows):
    return spark.createDataFrame([(v, None if d is None else dt.date(2024, 1, d)) for v, d in rows], "v int, day date")


def day(d):
    return (None if d is None else dt.date(2024, 1, d),)


def held(spark, table):
    return sorted((r.v, None if r.day is None else r.day.day) for r in spark.table(table).collect())


def test_partitions_are_replaced_and_cleared(spark, database):
    table = f"{database}.t"
    partitions.replace_partitions(frame(spark, (1, 1), (2, 2), (3, None)), table, ["day"], [day(1), day(2), day(None)])
    partitions.replace_partitions(frame(spark, (5, 2), (6, 4)), table, ["day"], [day(2), day(4), day(9)])
    assert held(spark, table) == [(1, 1), (3, None), (5, 2), (6, 4)]
    partitions.replace_partitions(frame(spark, (7, None)), table, ["day"], [day(None), day(2)])
    assert held(spark, table) == [(1, 1), (6, 4), (7, None)]
    sinks.append_rows(frame(spark, (8, 4), (9, 2)), table, ["day"])
    assert held(spark, table) == [(1, 1), (6, 4), (7, None), (8, 4), (9, 2)]


def test_rows_of_other_partitions_change_nothing(spark, database):
    table = f"{database}.t"
    partitions.replace_partitions(frame(spark, (1, 1)), table, ["day"], [day(1)])
    with pytest.raises(ValueError, match="not to be replaced"):
        partitions.replace_partitions(frame(spark, (2, 1), (3, 2)), table, ["day"], [day(1)])
    assert held(spark, table) == [(1, 1)]


def test_two_partition_columns(spark, database):
    table, by = f"{database}.t", ["name", "n"]
    rows = spark.createDataFrame([(1, "a.b", 1), (2, "a.b", 2), (3, "c", 1)], "v int, name string, n long")
    partitions.replace_partitions(rows, table, by, [("a.b", 1), ("a.b", 2), ("c", 1)])
    partitions.replace_partitions(rows.where("v = 1").selectExpr("v * 10 AS v", "name", "n"), table, by, [("a.b", 1), ("c", 1)])
    assert sorted(r.v for r in spark.table(table).collect()) == [2, 10]


def test_a_day_of_many_batches_is_compacted_under_readers(spark, database):
    table = f"{database}.t"
    for n in range(50):
        sinks.append_rows(frame(spark, (n, 1), (100 + n, 2)).coalesce(1), table, ["day"])
    before = held(spark, table)
    files = partitions.partition_files(spark, table, ["day"], [day(1), day(2)])
    assert files[day(1)][0] == 50
    # A reader that has listed the files before the swap still reads all of them after it.
    reader = spark.table(table).where("day = DATE'2024-01-01'")
    reader.inputFiles()
    target = 17 * (files[day(1)][1] // 50) + 100  # 17 files fit
    assert partitions.compact_partitions(spark, table, ["day"], [day(1)], target_bytes=target) == {day(1): (50, 3)}
    assert reader.count() == 50 and held(spark, table) == before
    assert partitions.compact_partitions(spark, table, ["day"], [day(1)]) == {day(1): (3, 1)}
    assert partitions.compact_partitions(spark, table, ["day"], [day(1)]) == {}
    assert partitions.partition_files(spark, table, ["day"], [day(1), day(2)])[day(2)][0] == 50
    assert partitions.vacuum(spark, table, 3600) == 0
    assert partitions.vacuum(spark, table, -5) == 53
    assert held(spark, table) == before and partitions.vacuum(spark, table, -5) == 0


def test_odd_partition_values_are_refused(spark, database):
    rows = spark.createDataFrame([(1, "a/b")], "v int, name string")
    partitions.replace_partitions(rows, f"{database}.t", ["name"], [("a/b",)])
    with pytest.raises(ValueError, match="plain"):
        partitions.replace_partitions(rows, f"{database}.t", ["name"], [("a/b",)])
