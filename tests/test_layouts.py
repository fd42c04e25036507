"""Layouts on disk: which folders are read, joins without an exchange, replaced tables, bad CSV."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voltscape.functions.calendar import DayWindow
from voltscape.sources import layouts, tables

MARCH = DayWindow(date(2024, 3, 5), date(2024, 3, 20))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "usage")
    hours = spark.sql("select explode(sequence(timestamp'2024-01-01', timestamp'2024-06-30 23:00:00', interval 7 hours)) as hour")
    usage = hours.crossJoin(spark.range(40)).selectExpr("id", "hour", "cast(id as double) as charging_duration")
    layouts.write_usage(usage, path)
    return usage, path


def scanned(df):
    """(folders, files) the scan has read, after the query has run."""
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            return tuple(node.metrics().apply(metric).value() for metric in ("numPartitions", "numFiles"))
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in name else None
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())] + ([inner] if inner else [])
    raise AssertionError("no scan")


def test_a_window_reads_its_months_only(spark, stored):
    usage, path = stored
    found = layouts.read_usage(spark, path, MARCH)
    assert "PartitionFilters: [isnotnull(month" in found._jdf.queryExecution().executedPlan().toString()
    folders, files = scanned(found)
    # one of six months
    assert folders <= layouts.STATION_GROUPS and files * 6 == len(found.inputFiles())
    assert found.where(MARCH.contains(F.col("hour"))).exceptAll(usage.where(MARCH.contains(F.col("hour")))).count() == 0
    assert found.where(MARCH.contains(F.col("hour"))).count() == usage.where(MARCH.contains(F.col("hour"))).count()


def test_a_local_window_reads_a_day_more(spark, stored):
    assert layouts.months(DayWindow(date(2024, 3, 1), date(2024, 3, 31))) == (date(2024, 3, 1), date(2024, 3, 1))
    local = DayWindow(date(2024, 3, 1), date(2024, 3, 31), "Europe/Oslo")
    assert layouts.months(local) == (date(2024, 2, 1), date(2024, 4, 1))


def test_stations_prune_their_groups(spark, stored):
    usage, path = stored
    few = spark.createDataFrame([(3, "x"), (7, "y")], "id bigint, title string").where("title <> ''")
    found = layouts.read_usage(spark, path, MARCH, few)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    folders, _ = scanned(found)
    assert folders <= 2
    wanted = usage.where("id in (3, 7)").where("trunc(hour, 'MM') = date'2024-03-01'")
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_saved_tables_are_joined_where_they_lie(spark):
    daily = spark.range(500).selectExpr("id % 50 as id", "id as minutes")
    one = layouts.save_bucketed(daily, "daily_minutes", "id", 4)
    two = layouts.save_bucketed(spark.range(60).selectExpr("id", "'s' || id as title"), "daily_known", "id", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = two.join(one.groupBy("id").agg(F.sum("minutes").alias("m")), "id")
        assert joined.count() == 50
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # at most one file per bucket, and saved again it is replaced
    assert len(one.inputFiles()) <= 4
    assert layouts.save_bucketed(daily.limit(10), "daily_minutes", "id", 4).count() == 10


def test_a_table_is_replaced_by_rows_of_its_own(spark):
    tables.replace_table(spark.range(5), "own_rows")
    found = tables.replace_table(spark.table("own_rows").where("id > 2").withColumn("x", F.lit(1)), "own_rows")
    assert sorted(tuple(r) for r in found.collect()) == [(3, 1), (4, 1)]
    spark.sql("create database if not exists other")
    assert tables.replace_table(spark.range(2), "other.own_rows").count() == 2
    assert tables.replace_table(spark.table("other.own_rows").limit(1), "other.own_rows").count() == 1
    left = [t.name for t in spark.catalog.listTables()] + [t.name for t in spark.catalog.listTables("other")]
    assert not [name for name in left if "__new_" in name or "__old_" in name]


def test_a_failed_replacement_leaves_the_old_rows(spark):
    tables.replace_table(spark.range(5), "kept_rows")
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('no'), id) as id")
    with pytest.raises(PySparkException):
        tables.replace_table(broken, "kept_rows")
    assert spark.table("kept_rows").count() == 5
    assert not [t.name for t in spark.catalog.listTables() if "kept_rows__" in t.name]


CSV = '''id,day,note
1,2024-01-02,"two
lines"
2,2024-01-33,bad day
x,2024-01-02,bad id
3,2024-01-02
4,2024-01-02,a,b
,2024-01-02,no id
5,,"say ""yes"""
'''


def test_csv_that_fits_and_quarantine(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    schema = "id bigint, day date, note string"
    good, bad = tables.read_csv_checked(spark, str(path), schema, multi_line=True, required=["id"])
    assert sorted(tuple(r) for r in good.collect()) == [(1, date(2024, 1, 2), "two\nlines"), (5, None, 'say "yes"')]
    records = sorted(r.record for r in bad.collect())
    assert records == [",2024-01-02,no id", "2,2024-01-33,bad day", "3,2024-01-02", "4,2024-01-02,a,b", "x,2024-01-02,bad id"]
    assert all(r.file.endswith("in.csv") for r in bad.collect())
    # line by line, an open quote ends with its line, and the rest is a record that doesn't fit
    good, bad = tables.read_csv_checked(spark, str(path), schema)
    assert [r.id for r in good.orderBy("id").collect()] == [None, 1, 5] and bad.count() == 5


def test_csv_without_rows(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,day\n")
    good, bad = tables.read_csv_checked(spark, str(tmp_path / "in.csv"), "id bigint, day date")
    assert good.count() == 0 and bad.count() == 0 and good.columns == ["id", "day"]
