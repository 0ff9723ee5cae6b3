"""Demo events dealt over tasks by the number of lines: equal rows, and no more lines a task than bounded."""

import datetime as dt
import re

import pytest

from lookback.sources import demo


def _tables(spark, root, n_orders=60):
    """Orders of 1-7 lines; some keys null, repeated or without partner, a brand null, a part key twice."""
    day = dt.datetime(1995, 1, 1)
    orders = [(k, k % 9, day + dt.timedelta(days=40 * k), "1-URGENT") for k in range(n_orders)] + [(None, 1, day, None)]
    orders.append(orders[3])
    lines = [(k, n % 5 if k % 4 else 0, (k * 3 + n) % 13) for k in range(n_orders) for n in range(1 + k % 7)]
    lines += [(None, 1, 1), (5, None, 2), (6, 1, None), (n_orders + 9, 1, 1), (3, 1, 4), (3, 1, 4)]
    part = [(k, f"Brand#{k % 6}") for k in range(12)] + [(4, "Brand#0"), (11, None), (None, "Brand#1")]
    for name, rows, kind in (("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
                             ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long"), ("part", part, "p_partkey long, p_brand string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{root}/{name}.parquet")
    return len(lines)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sent", [64 << 20, 0])
@pytest.mark.parametrize("years", [None, [1996, 1997]])
def test_lines_are_dealt_over_tasks_by_their_number(spark, tmp_dir, monkeypatch, sent, years):
    n = _tables(spark, tmp_dir)
    plain = _rows(demo.demo_event_codes(spark, tmp_dir, years=years))
    monkeypatch.setattr(demo, "RANKED_LINES", 7)
    monkeypatch.setattr(demo, "PART_BROADCAST", sent)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of size
    try:
        df = demo.demo_event_codes(spark, tmp_dir, years=years)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = _rows(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plain) > 10 and got == plain
    dealt = {int(x) for x in re.findall(r"hashpartitioning\(l_orderkey#\d+L, (\d+)\)", plan)}
    assert dealt == {-(-n // 7)}
    assert ("BroadcastHashJoin" in plan) == (sent > 0)
