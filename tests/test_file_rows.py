"""Queries over the feed folder show what the scan of each file finds."""

import datetime

import pytest

import __spark_entry__ as E

# orders of three layouts in five files; keys of 200,000 share a file
ORDERS = ([(k, 1, "F", 1.5, "1-URGENT") for k in range(1, 8)] + [(k, 1, "F", 1.5, "1-URGENT") for k in (200001, 200002)]
          + [(k, 2, "O", 2.5, "5-LOW") for k in range(11, 16)] + [(k, 2, "O", 2.5, "2-HIGH") for k in (21,)]
          + [(k, 3, "P", 3.5, "2-HIGH") for k in range(31, 34)])
ROWS = {"orders_F_1-URGENT_0.csv": 7, "orders_F_1-URGENT_1.csv": 2, "orders_O_5-LOW_0.csv": 5, "orders_O_2-HIGH_0.csv": 1,
        "orders_P_2-HIGH_0.csv": 3, "header_only.csv": 0}
NO_FEEDS = {"empty.csv": 0, "missing.csv": 0, "archive": 0}


@pytest.mark.parametrize("query, more", [("feed_validation", NO_FEEDS), ("csv_layouts", {}), ("key_combo_detect", {}), ("layout_resolution", {})])
def test_every_data_row_is_counted(spark, scratch, query, more):
    rows = [(k, c, s, p, d, datetime.date(2024, 1, 1)) for k, c, s, p, d in ORDERS]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                "o_orderpriority string, o_orderdate date").write.parquet(f"{scratch}/orders.parquet")
    got = {r["name"]: r["rows"] for r in E.queries()[query](spark, scratch).collect()}
    assert got == {**ROWS, **more}
