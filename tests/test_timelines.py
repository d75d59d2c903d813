"""Dimension history, time joins and streams with state."""

from __future__ import annotations

import itertools
import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import timeline_queries
from tallyloom.operators.history import interval_faults, merge_history, versions
from tallyloom.operators.timejoin import as_of_join, interval_join
from tallyloom.session import stage
from tallyloom.streaming import stateful, windows

DAY = date(2020, 1, 1)
SEEN = "id string, plan string, city string, day date, seq int"


def day(n):
    return None if n is None else DAY + timedelta(days=n)


def seen(spark, rows):
    return spark.createDataFrame([(i, p, c, day(d), s) for i, p, c, d, s in rows], SEEN)


def history_of(spark, *batches, **more):
    out = None
    for rows in batches:
        out = merge_history(out, seen(spark, rows), ["id"], ["plan", "city"], "day", order="seq", **more)
    return out


def brute_versions(rows):
    known = {}
    for i, p, c, d, s in rows:
        if i is not None and d is not None and (i, d) not in known or (i, d) in known and s > known[i, d][0]:
            known[i, d] = (s, p, c)
    out = []
    for i, group in itertools.groupby(sorted(known), key=lambda k: k[0]):
        last = open_ = None
        mine = []
        for key in group:
            if known[key][1:] != last or open_ is None:
                last = open_ = known[key][1:]
                mine.append((i, *last, day(key[1])))
        ends = [m[-1] for m in mine[1:]] + [None]
        out += [(*m, e, n, e is None) for n, (m, e) in enumerate(zip(mine, ends, strict=True), 1)]
    return sorted(out, key=repr)


COLUMNS = ("id", "plan", "city", "valid_from", "valid_to", "version", "is_current")


def test_versions_open_and_close(spark):
    first = [("a", "x", "p", 0, 1), ("b", "x", None, 0, 1), (None, "x", "p", 0, 1), ("c", "x", "p", None, 1)]
    second = [("a", "x", "p", 5, 1), ("a", "y", "p", 9, 1), ("b", "x", "", 3, 1), ("d", None, None, 4, 1)]
    got = rows_of(versions(history_of(spark, first, second), ["id"]), *COLUMNS)
    assert got == sorted(
        [
            ("a", "x", "p", day(0), day(9), 1, False), ("a", "y", "p", day(9), None, 2, True),
            ("b", "x", None, day(0), day(3), 1, False), ("b", "x", "", day(3), None, 2, True),
            ("d", None, None, day(4), None, 1, True),
        ],
        key=repr,
    )


def test_any_order_of_batches_gives_the_same_history(spark):
    rng = random.Random(3)
    rows = {}
    for s in range(160):
        i, d = rng.choice("abcde"), rng.randint(0, 40)
        rows[i, d] = (i, rng.choice("xy"), rng.choice("pq"), d, s)
    rows = list(rows.values())
    want = brute_versions(rows)
    for parts in (1, 3):
        rng.shuffle(rows)
        batches = [rows[k::parts] for k in range(parts)]
        got = versions(history_of(spark, *batches), ["id"])
        assert rows_of(got, *COLUMNS) == want
        assert interval_faults(got, ["id"]).isEmpty()


def test_late_row_between_equal_ones_splits_a_version(spark):
    early = [("a", "x", "p", 0, 1), ("a", "x", "p", 9, 1)]
    got = rows_of(versions(history_of(spark, early, [("a", "y", "p", 4, 1)]), ["id"]), "plan", "valid_from", "valid_to")
    assert got == sorted([("x", day(0), day(4)), ("y", day(4), day(9)), ("x", day(9), None)], key=repr)


def test_repeated_and_corrected_rows(spark):
    rows = [("a", "x", "p", 0, 1), ("a", "y", "p", 0, 2), ("a", "y", "p", 0, 2)]
    once = history_of(spark, rows)
    assert rows_of(once, "plan", "valid_from", "opens") == [("y", day(0), True)]
    again = history_of(spark, rows, rows, [("a", "z", "p", 0, 1)])
    assert rows_of(again, "plan", "valid_from", "opens") == [("z", day(0), True)]
    assert rows_of(history_of(spark, rows, []), "plan") == [("y",)]


def test_forgetting_keeps_the_versions(spark):
    rows = [("a", "x", "p", d, 1) for d in range(10)]
    kept = history_of(spark, rows, forget_before=F.lit(day(8)))
    assert rows_of(kept, "valid_from", "opens") == sorted(
        [(day(0), True), (day(8), False), (day(9), False)], key=repr
    )


def test_only_named_members_are_rebuilt(spark):
    history = stage(history_of(spark, [(f"m{k}", "x", "p", 0, 1) for k in range(50)]), "history")
    merged = merge_history(history, seen(spark, [("m1", "y", "p", 3, 1)]), ["id"], ["plan", "city"], "day")
    assert merged.count() == 51
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    rebuilt, rest = plan.split("\n+- ", 1)
    assert "Window [" in rebuilt and "Window [" not in rest and "LeftAnti" in rest


def test_faults_are_named(spark):
    rows = [("a", day(0), day(5)), ("a", day(4), day(4)), ("a", day(6), None), ("a", day(9), None), ("b", day(0), None)]
    table = spark.createDataFrame(rows, "id string, valid_from date, valid_to date")
    assert rows_of(interval_faults(table, ["id"]), "valid_from", "fault") == sorted(
        [(day(0), "overlap"), (day(4), "empty"), (day(6), "overlap")], key=repr
    )


# --- time joins ----------------------------------------------------------------------------


def no_pairs(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("bin_days", [1, 7, 400])
def test_as_of_join(spark, bin_days):
    rng = random.Random(bin_days)
    left = [(k, rng.choice(["a", "b", "c", None]), day(rng.choice([None, *range(60)]))) for k in range(300)]
    right = [(rng.choice(["a", "b", None]), day(rng.choice([None, *range(10, 60, 3)])), rng.randint(0, 9)) for _ in range(40)]
    want = []
    for k, who, when in left:
        fits = [(s, v) for w, s, v in right if w is not None and w == who and s and when and s <= when]
        want.append((k, who, when, max(fits)[1] if fits else None))
    a = spark.createDataFrame(left, "k int, who string, at date")
    b = spark.createDataFrame(right, "who string, since date, price int")
    joined = as_of_join(a, b, ["who"], "at", "since", ["price"], bin_days)
    assert rows_of(joined, "k", "who", "at", "price") == sorted(want, key=repr)
    assert no_pairs(joined)


def test_as_of_join_on_timestamps_and_one_hot_key(spark):
    start = datetime(2020, 1, 1)
    left = spark.range(20_000).select(
        F.lit("hot").alias("who"), (F.lit(start) + F.make_dt_interval(hours=F.col("id"))).alias("at"), "id"
    )
    right = spark.range(0, 20_000, 50).select(
        F.lit("hot").alias("who"), (F.lit(start) + F.make_dt_interval(hours=F.col("id"))).alias("since"), F.col("id").alias("version")
    )
    joined = as_of_join(left, right, ["who"], "at", "since", ["version"], bin_days=30)
    assert joined.filter("version <> id - id % 50 OR version IS NULL").isEmpty() and joined.count() == 20_000
    # the rows of the key are dealt by time: no window holds more than a bin of them
    assert joined.groupBy(F.floor(F.unix_date(F.to_date("at")) / 30)).count().agg(F.max("count")).first()[0] <= 720


def test_as_of_join_of_empty_sides(spark):
    a = spark.createDataFrame([], "k int, who string, at date")
    b = spark.createDataFrame([], "who string, since date, price int")
    assert as_of_join(a, b, ["who"], "at", "since", ["price"]).collect() == []
    one = spark.createDataFrame([(1, "a", day(0))], a.schema)
    assert rows_of(as_of_join(one, b, ["who"], "at", "since", ["price"]), "k", "price") == [(1, None)]


@pytest.mark.parametrize("bin_days", [1, 10, 365])
def test_interval_join(spark, bin_days):
    rng = random.Random(bin_days)
    left = [(k, rng.choice(["a", "b", None]), day(rng.choice([None, *range(60)]))) for k in range(150)]
    right = []
    for n in range(60):
        since = rng.choice([None, *range(60)])
        until = None if since is None or rng.random() < 0.2 else since + rng.randint(-1, 30)
        right.append((n, rng.choice(["a", "b", None]), day(since), day(until)))
    want = [
        (k, n)
        for (k, who, at), (n, whose, since, until) in itertools.product(left, right)
        if who and who == whose and at and since and since <= at and (until is None or at < until)
    ]
    a = spark.createDataFrame(left, "k int, who string, at date")
    b = spark.createDataFrame(right, "n int, who string, since date, until date")
    joined = interval_join(a, b, ["who"], "at", "since", "until", bin_days)
    assert rows_of(joined, "k", "n") == sorted(want, key=repr)
    assert no_pairs(joined)
    assert interval_join(a.limit(0), b, ["who"], "at", "since", "until").collect() == []


# --- streams -------------------------------------------------------------------------------

EVENTS = "order_id string, event_time timestamp, position long, shipping_cost double"


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def test_last_event_survives_a_restart(spark, tmp_path):
    batches = [
        [("a", at(1), 1, 5.0), ("b", at(1), 7, 2.0), ("a", at(2), 3, 6.0), (None, at(1), 1, 1.0)],
        [("a", at(3), 2, 9.0), ("b", at(2), 8, 3.5), ("c", at(5), 1, 1.5), ("c", at(5), None, 8.0)],
        [("a", at(4), 4, 7.25), ("c", at(1), 0, 4.0)],
    ]
    for k, rows in enumerate(batches):
        events = spark.createDataFrame(rows, EVENTS)
        events = events.withColumn("shipping_cost", F.col("shipping_cost").cast("decimal(18,2)"))
        events.write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in/*")
        changes = stateful.last_costs(stream, delay="100 days")
        stateful.keep_updates(changes, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    latest = stateful.latest_updates(spark, f"{tmp_path}/out", ["order_id"])
    got = [(r["order_id"], r["position"], float(r["shipping_cost"])) for r in latest.collect()]
    assert sorted(got) == [("a", 4, 7.25), ("b", 8, 3.5), ("c", 1, 1.5)]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2 + 2 + 1  # only what changed


def test_state_of_old_orders_is_forgotten(spark, tmp_path):
    rows = [[("a", at(0), 5, 1.0)], [("b", at(24 * 30), 1, 1.0)], [("b", at(24 * 31), 2, 2.0)]]
    for k, some in enumerate(rows):
        events = spark.createDataFrame(some, EVENTS)
        events = events.withColumn("shipping_cost", F.col("shipping_cost").cast("decimal(18,2)"))
        events.write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in/*")
        query = stateful.keep_updates(
            stateful.last_costs(stream, delay="1 day", forget_days=3), f"{tmp_path}/out", f"{tmp_path}/checkpoint"
        )
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_a_bucket_of_orders_is_one_call_and_keeps_them_apart(spark, tmp_path):
    days = [
        [(f"o{k}", at(0), 5, float(k)) for k in range(300)],
        [("o1", at(24 * 30), 4, 9.0), ("o2", at(24 * 30), 6, None), ("o2", at(24 * 29), 2, 8.0)],
        [("o3", at(24 * 31), 1, 7.0)],  # forgotten by now, so its event is news
    ]
    for k, rows in enumerate(days):
        events = spark.createDataFrame(rows, EVENTS)
        events = events.withColumn("shipping_cost", F.col("shipping_cost").cast("decimal(18,2)"))
        events.write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in/*")
        changes = stateful.last_costs(stream, delay="1 day", forget_days=3, buckets=2)
        query = stateful.keep_updates(changes, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    got = rows_of(spark.read.parquet(f"{tmp_path}/out"), "order_id", "position", "shipping_cost")
    want = {(f"o{k}", 5, float(k)) for k in range(300)} | {("o2", 6, None), ("o3", 1, 7.0)}
    assert {(o, p, c if c is None else float(c)) for o, p, c in got} == want and len(got) == len(want)


def test_orders_with_returns_on_tables(spark):
    orders = spark.createDataFrame([("a", at(0)), ("b", at(0)), ("c", at(0))], "order_id string, order_time timestamp")
    returns = spark.createDataFrame(
        [("a", at(5)), ("b", at(24 * 30)), ("c", at(-1)), ("d", at(1))], "order_id string, return_time timestamp"
    )
    got = stateful.orders_with_returns(orders, returns)
    assert rows_of(got, "order_id", "return_time") == [("a", at(5)), ("b", None), ("c", None)]


LINE = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)
ORDER = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def test_streamed_orders_are_held_on_disk(spark, tmp_path, monkeypatch):
    """The first micro-batch holds nearly all orders, which don't fit in the executors' memory."""
    placed = {1: at(0), 2: at(24), 20: at(48), 3: at(24 * 500)}
    orders = [(k, 7, "F", 9.0, t, "1") for k, t in placed.items()]
    lines = [
        (1, 5, 6, 1, 2.0, 20.0, 0.0, 0.1, "R", "F", at(24 * 3)), (2, 5, 6, 1, 2.0, 20.0, 0.0, 0.1, "R", "F", at(24 * 60)),
        (20, 5, 6, 1, 2.0, 20.0, 0.0, 0.1, "R", "F", at(24 * 4)), (3, 5, 6, 1, 2.0, 20.0, 0.0, 0.1, "N", "F", at(24 * 501)),
        (3, 5, 6, 2, 2.0, 20.0, 0.0, 0.1, "R", "F", at(24 * 505)),
    ]
    spark.createDataFrame(lines, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, ORDER).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(timeline_queries, "_FIRST_LATE", "2024-06-01")
    monkeypatch.setattr(timeline_queries, "_place", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    got = timeline_queries.streamed_order_returns(spark, str(tmp_path))
    want = [("1-1", at(0), at(24 * 3)), ("2-1", at(24), None), ("3-1", at(24 * 500), None), ("3-2", at(24 * 500), at(24 * 505))]
    assert rows_of(got, "order_id", "order_time", "return_time") == want
    assert list(tmp_path.glob("return-stream-*/checkpoint/state/**/*.zip"))
    assert not list(tmp_path.glob("return-stream-*/checkpoint/state/**/*.delta"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "as before") == "as before"


def test_sessions_end_at_a_pause(spark):
    rows = [(1, at(0)), (1, at(0.25)), (1, at(0.75)), (1, at(1.3)), (2, at(0.1)), (None, at(0)), (3, None), (1, at(0.25))]
    events = spark.createDataFrame(rows, "user_id long, ts timestamp")
    got = rows_of(windows.sessions(events, "user_id", "ts"), "user_id", "first_at", "last_at", "events")
    assert got == [(1, at(0), at(0.75), 4), (1, at(1.3), at(1.3), 1), (2, at(0.1), at(0.1), 1)]


def test_an_event_is_in_all_windows_that_hold_it(spark):
    events = spark.createDataFrame([("v", at(1), 2.5), ("v", at(1.3), 1.0), (None, at(9), 1.0)], "event_type string, ts timestamp, value double")
    got = windows.sliding_counts(events, "event_type", "ts")
    begins = sorted(r["begins_at"] for r in got.filter("event_type = 'v'").collect())
    assert begins == [at(k / 4) for k in range(1, 6)]
    assert got.filter("event_type IS NULL").count() == 4
    assert float(got.filter("event_type = 'v'").agg(F.max("value")).first()[0]) == 3.5
