from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.functions import parse_dmy_date, parse_dmy_timestamp
from retailmart.plans.ecommerce import UNKNOWN_CAMPAIGN, clean_campaigns
from retailmart.sources.files import (
    REPLACE_PARTITIONS,
    ConversionError,
    add_unknown_member,
    csv_ingest,
    csv_ingest_traced,
    register_views,
    scratch_path,
    staged_types,
    type_staging,
    with_losses,
    write_table,
)

SCHEMA = "id int, amount decimal(10,2), day date, note string"


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_csv_rows_and_rejects(spark, rows, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "id,amount,day,note\n"
        '1,2.50,2023-01-31,"a,b"\n'
        "2,,,\n"
        "3,1.00,2023-01-31\n"
        "4,n/a,2023-01-31,x\n"
        "5,1.00,31/01/2023,x\n",
    )
    good, rejects = csv_ingest(spark, path, SCHEMA)
    assert rows(good) == [
        (1, Decimal("2.50"), dt.date(2023, 1, 31), "a,b"),
        (2, None, None, None),
    ]
    assert rows(rejects) == [
        ("3,1.00,2023-01-31",),
        ("4,n/a,2023-01-31,x",),
        ("5,1.00,31/01/2023,x",),
    ]


def test_csv_rejects_whatever_is_selected(spark, rows, tmp_path):
    path = write(tmp_path / "a.csv", "id,amount,day,note\n1,x,,\n2,1,,\n")
    good, rejects = csv_ingest(spark, path, SCHEMA)
    assert good.count() == 1
    assert rejects.count() == 1
    assert rows(good, "id") == [(2,)]


def test_csv_rejects_can_be_traced(spark, rows, tmp_path):
    write(tmp_path / "a.csv", 'id,amount,day,note\n1,2.50,2023-01-31,"a,b"\n2,n/a,2023-01-31,x\n3,1.00\n')
    write(tmp_path / "b.csv", "id,amount,day,note\n4,,,\nx,1.00,31/01/2023,y\n5,1.00,2023-01-01,x,more\n")
    got = csv_ingest_traced(spark, str(tmp_path / "*.csv"), SCHEMA)
    assert rows(got.rows) == [(1, Decimal("2.50"), dt.date(2023, 1, 31), "a,b"), (4, None, None, None)]
    found = [(line, file.rsplit("/", 1)[-1], start, reason) for line, file, start, reason in rows(got.rejects)]
    assert found == [
        ("2,n/a,2023-01-31,x", "a.csv", 0, "amount: n/a"),
        ("3,1.00", "a.csv", 0, "number of fields"),
        ("5,1.00,2023-01-01,x,more", "b.csv", 0, "number of fields"),
        ("x,1.00,31/01/2023,y", "b.csv", 0, "id: x; day: 31/01/2023"),
    ]
    good, rejects = csv_ingest(spark, str(tmp_path / "*.csv"), SCHEMA)
    assert rows(good) == rows(got.rows) and rows(rejects) == rows(got.rejects, "line")


def test_traced_ingest_reads_the_files_once(spark, rows, tmp_path):
    """What was parsed is kept: rows and rejects stay after the files are gone."""
    path = tmp_path / "a.csv"
    write(path, "1;2\nx;4\n")
    got = csv_ingest_traced(spark, str(path), "a int, b int", sep=";", header=False, store=str(tmp_path / "kept"))
    path.unlink()
    assert rows(got.rows) == [(1, 2)]
    assert rows(got.rejects, "line", "reason") == [("x;4", "a: x")]


def test_csv_with_crlf(spark, rows, tmp_path):
    path = write(tmp_path / "a.csv", "id,amount,day,note\r\n1,1.00,,first\r\n2,2.00,,last\r\n")
    good, rejects = csv_ingest(spark, path, SCHEMA)
    assert rows(good, "id", "note") == [(1, "first"), (2, "last")]
    assert rejects.count() == 0


def test_csv_without_header_and_other_separator(spark, rows, tmp_path):
    path = write(tmp_path / "a.csv", "1;2\n3;4\n")
    good, _ = csv_ingest(spark, path, "a int, b int", sep=";", header=False)
    assert rows(good) == [(1, 2), (3, 4)]


def test_type_staging(spark, rows):
    df = spark.createDataFrame(
        [("31/12/2023", 0.153, "7"), ("bad", None, "x")], "d string, u double, n string"
    )
    got = type_staging(df, {"d": parse_dmy_date, "u": "decimal(5,2)", "n": "int"})
    assert rows(got) == [(dt.date(2023, 12, 31), Decimal("0.15"), 7), (None, None, None)]


def test_written_table_reads_back_by_month(spark, rows, tmp_path):
    df = spark.range(100).select(
        F.col("id"), F.expr("add_months(date'2023-01-01', cast(id % 3 as int))").alias("month")
    )
    path = write_table(df, str(tmp_path / "t"), ["month"])
    back = spark.read.parquet(path)
    assert rows(back, "id", "month") == rows(df)
    one = back.filter(F.col("month") == dt.date(2023, 2, 1))
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().toString()


RULES = {"d": parse_dmy_date, "u": "decimal(5,2)", "n": "int"}
STAGED = [
    (1, "31/12/2023", 0.153, "7", None),
    (2, "bad", None, "x", "kept"),
    (3, None, 12345.0, "8", None),
    (4, "1/2/2023", 1.0, "", None),
    (5, None, None, None, None),
]


def test_no_value_is_lost_unseen(spark, rows):
    df = spark.createDataFrame(STAGED, "k int, d string, u double, n string, _staging_d string")
    got = staged_types(df, RULES)
    assert got.lost == {"d": 1, "u": 1, "n": 2}
    assert rows(got.counts()) == [("d", 1), ("n", 2), ("u", 1)]
    assert rows(got.typed, "k", "d", "u", "n") == [
        (1, dt.date(2023, 12, 31), Decimal("0.15"), 7),
        (5, None, None, None),
    ]
    assert rows(got.rejects) == [
        (2, "bad", None, "x", "kept", ["d", "n"]),
        (3, None, 12345.0, "8", None, ["u"]),
        (4, "1/2/2023", 1.0, "", None, ["n"]),
    ]
    assert got.typed.schema == type_staging(df, RULES).schema
    assert got.rejects.schema[:-1] == df.schema


def test_the_source_is_read_once(spark):
    """Rows, rejects and counts come from one run of the input."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(STAGED, "k int, d string, u double, n string, s string").mapInArrow(
        counted, "k int, d string, u double, n string, s string"
    )
    got = staged_types(df, RULES)
    assert (got.typed.count(), got.rejects.count(), sum(got.lost.values())) == (2, 3, 4)
    assert seen.value == len(STAGED)


def test_each_conversion_stands_in_the_plan_once(spark):
    df = spark.createDataFrame([("1/2/2023 10:00", "7")], "t string, n string")
    marked = with_losses(df, {"t": parse_dmy_timestamp, "n": "int"}, "f_").withColumn("r", F.size("f_") > 0)
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_strict_typing_stops(spark):
    df = spark.createDataFrame(STAGED, "k int, d string, u double, n string, s string")
    with pytest.raises(ConversionError, match="'n': 2"):
        staged_types(df, RULES, strict=True)
    assert staged_types(df.filter("k in (1, 5)"), RULES, strict=True).typed.count() == 2
    assert staged_types(df.limit(0), RULES, strict=True).lost == {"d": 0, "u": 0, "n": 0}
    with pytest.raises(ValueError, match="no such columns"):
        staged_types(df, {"x": "int"})


def monthly(spark, rows_of):
    return spark.createDataFrame(rows_of, "id int, month date")


def test_a_load_can_be_run_again(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    jan, feb, mar = (dt.date(2023, m, 1) for m in (1, 2, 3))
    load = monthly(spark, [(1, jan), (2, feb), (3, feb), (4, None)])
    for _ in range(2):
        write_table(load, path, ["month"], mode=REPLACE_PARTITIONS)
        assert rows(spark.read.parquet(path), "id", "month") == rows(load)
    write_table(monthly(spark, [(5, feb), (6, mar), (7, None)]), path, ["month"], mode=REPLACE_PARTITIONS)
    back = spark.read.parquet(path)
    assert rows(back, "id", "month") == [(1, jan), (5, feb), (6, mar), (7, None)]
    write_table(load.limit(0), path, ["month"], mode=REPLACE_PARTITIONS)
    assert rows(spark.read.parquet(path)) == rows(back)
    with pytest.raises(ValueError, match="partition_by"):
        write_table(load, path, mode=REPLACE_PARTITIONS)


def test_a_failed_load_leaves_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    load = monthly(spark, [(k, dt.date(2023, 1 + k % 3, 1)) for k in range(30)])
    write_table(load, path, ["month"], mode=REPLACE_PARTITIONS)
    broken = load.withColumn("id", F.when(F.col("id") == 29, F.raise_error(F.lit("stop")).cast("int")).otherwise(-1))
    with pytest.raises(Exception, match="stop"):
        write_table(broken, path, ["month"], mode=REPLACE_PARTITIONS)
    assert rows(spark.read.parquet(path), "id", "month") == rows(load)


def test_bucketed_tables_join_without_a_shuffle(spark, rows, tmp_path):
    fact = spark.range(0, 3000, 1, 4).selectExpr("if(id % 3 = 0, 7L, id % 50) as k", "id as v")
    dim = spark.range(50).selectExpr("id as k", "concat('n', id) as name")
    for frame, name in ((fact, "bucketed_fact"), (dim, "bucketed_dim")):
        write_table(frame, str(tmp_path / name), bucket_by=["k"], buckets=4, name=name)
    spend = spark.table("bucketed_fact").groupBy("k").agg(F.sum("v").alias("v"))
    joined = spend.hint("merge").join(spark.table("bucketed_dim"), "k")
    joined.collect()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(fact.groupBy("k").agg(F.sum("v").alias("v")).join(dim, "k"))
    for name in ("bucketed_fact", "bucketed_dim"):
        spark.sql(f"drop table {name}")
    with pytest.raises(ValueError, match="name"):
        write_table(fact, str(tmp_path / "x"), bucket_by=["k"], buckets=4)


def test_views(spark):
    register_views({"some_numbers": spark.range(4)})
    assert spark.sql("select sum(id) from some_numbers").first()[0] == 6


def test_unknown_member_is_added_once(spark, rows):
    typed = spark.createDataFrame(
        [(1, "Email", "Retention", dt.date(2023, 1, 1), dt.date(2023, 1, 9), "All", Decimal("0.15"))],
        "campaign_id int, channel string, objective string, start_date date, end_date date,"
        " target_segment string, expected_uplift decimal(5,2)",
    )
    once = clean_campaigns(typed)
    twice = add_unknown_member(once, "campaign_id", UNKNOWN_CAMPAIGN)
    assert rows(once) == rows(twice)
    assert rows(once, "campaign_id", "channel", "expected_uplift_pct", "campaigns_duration_days") == [
        (0, "Unknown", Decimal("0.00"), 0),
        (1, "Email", Decimal("15.00"), 8),
    ]
    assert once.schema == twice.schema


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


def test_a_header_in_another_order_raises(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text("b,a\n1,2\n")
    good, _ = csv_ingest(spark, str(tmp_path / "swapped.csv"), "a int, b int")
    with pytest.raises(Exception, match="CSV header does not conform|INVALID|header"):
        good.collect()
