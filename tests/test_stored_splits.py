"""What the split queries store and move: only the columns they read, and no array per level."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from breachline.operators import joins as J
from breachline.operators import statistics as S
from breachline.plans import fixture
from breachline.sources.lookup import inline_lookup

AGENCIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables in which rows come twice, tie in their leading fields, and hold nulls."""
    at, first = str(tmp_path_factory.mktemp("tables")), datetime(2020, 1, 1)
    orders = [(o, first + timedelta(days=o), AGENCIES[o % 6]) for o in range(1, 241)]
    items = [
        (o, 1 + o * 7 % 40, 1 + o * n % 13, n, float(o % 5), float(100 - o), 0.1, 0.05, "N", "O", first + timedelta(days=o + 500 * n - 400))
        for o in range(1, 241) for n in (1, 2)
    ]
    items += [(*row[:4], row[4] - 1, row[5], None, 0.0, *row[8:]) for row in items[::3]]
    items += [(*row[:10], None) for row in items[::5]] + items[::7]
    parts = [(p, f"Brand#{p % 4}", f"TYPE {p % 6}") for p in range(1, 41)]
    tables = {
        "orders": (orders, "o_orderkey bigint, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "part": (parts, "p_partkey bigint, p_brand string, p_type string"),
        "supplier": ([(s, s % 3) for s in range(1, 14)], "s_suppkey bigint, s_nationkey int"),
        "nation": ([(n, n % 2) for n in range(3)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def whole(df, columns):
    return sorted(map(repr, df.select(*columns, "split").collect()))


@pytest.mark.parametrize("columns", [
    ["request_key"], ["agency", "borough", "target"], ["request_key", "incident_zip", "sla_days"],
    ["request_key", "penalty_charged", "quantity"], ["request_key", "tax", "discount", "returnflag", "latitude"],
])
def test_columns_asked_for_are_those_of_all(spark, folder, columns):
    some, every = fixture.splits(spark, folder, columns), fixture.splits(spark, folder)
    assert set(some.columns) == {"created_ts", *columns, "split"}
    assert whole(some, columns) == whole(every, columns) != []


def test_stored_silver_is_silver(spark, folder):
    some, every = fixture.stored_silver(spark, folder, ["agency"]), fixture.silver(spark, folder)
    assert some.columns == fixture.FIELDS[:11]
    got, want = (sorted(map(repr, df.select(some.columns).collect())) for df in (some, every))
    assert got == want != []


def test_lookups_of_unknown_size_are_stored_and_broadcast(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 100, "DOT").alias("agency"))
    joined = J.lookup_join(df, inline_lookup(spark), "agency")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan
    assert joined.where("sla_days = 5").count() == 100


def test_global_stats_stand_beside_each_other_without_a_join(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (-1.0,)], "d double")
    stats = S.global_stats(df, "d")
    assert "NestedLoop" not in stats._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in stats.select("global_avg", "global_p75").collect()] == [(2.0, 3.0)]


def test_places_of_ones_are_read_from_sparse_vectors(spark, folder):
    df = entry.queries()["one_hot_vectors"](spark, folder)
    assert "array_position" not in df._jdf.queryExecution().executedPlan().toString()
    every = fixture.splits(spark, folder).select("request_key", F.col("incident_zip").cast("string").alias("zip"), "split").collect()
    levels = sorted({r.zip for r in every if r.split == "train"})
    want = [(r.request_key, levels.index(r.zip) - 1 if r.zip in levels[1:] else None, len(levels) - 1) for r in every if r.split == "val"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str) != []
