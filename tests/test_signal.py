import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sigspark.operators import signal
from sigspark.operators.asof import asof_join

DAY0 = dt.date(2024, 1, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def random_sides(seed, n_left, n_right):
    rng = random.Random(seed)
    left = [(i, rng.choice("AB"), day(rng.randrange(40))) for i in range(n_left)]
    dates = {(t, d) for t in "AB" for d in rng.sample(range(40), n_right)}
    right = [(t, day(d), None if rng.random() < 0.2 else float(d)) for t, d in sorted(dates)]
    return left, right


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof_equals_search(spark, direction, exact, tolerance):
    left, right = random_sides(7, 60, 9)
    got = asof_join(
        spark.createDataFrame(left, "i int, ticker string, d date"),
        spark.createDataFrame(right, "ticker string, q date, v double"),
        "ticker", "d", "q", ["v"], direction=direction, exact=exact,
        tolerance_days=tolerance, matched_day="m",
    ).collect()
    assert len(got) == len(left)
    for row in got:
        back = direction == "backward"
        fits = [
            (q, v) for t, q, v in right
            if t == row["ticker"]
            and ((q < row["d"] if back else q > row["d"]) or (exact and q == row["d"]))
            and (tolerance is None or abs((q - row["d"]).days) <= tolerance)
        ]
        want = (max if back else min)(fits, key=lambda x: x[0]) if fits else (None, None)
        # A matched row's null value stays null instead of an older value.
        assert (row["m"], row["v"]) == want


def test_tolerance_edge(spark):
    left = spark.createDataFrame([("A", day(3)), ("A", day(4))], "ticker string, d date")
    right = spark.createDataFrame([("A", day(0), 1.0)], "ticker string, q date, v double")
    out = asof_join(left, right, "ticker", "d", "q", ["v"], tolerance_days=3, left_unique=True)
    assert {r["d"]: r["v"] for r in out.collect()} == {day(3): 1.0, day(4): None}


def test_plan_has_no_cartesian(spark):
    left, right = random_sides(1, 5, 5)
    out = asof_join(
        spark.createDataFrame(left, "i int, ticker string, d date"),
        spark.createDataFrame(right, "ticker string, q date, v double"),
        "ticker", "d", "q", ["v"],
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def price_frame(spark, closes, ticker="A"):
    rows = [(ticker, day(i), c) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, date date, adjusted_close double")


def test_forward_returns(spark):
    prices = price_frame(spark, [10.0, 11.0, None, 12.0, 0.0, 5.0, 6.0])
    probes = spark.createDataFrame([("A", day(i)) for i in range(-2, 7)], "ticker string, published_date date")
    out = signal.forward_returns(probes, prices, 2)
    got = {(r["published_date"] - DAY0).days: r["next_day_return"] for r in out.collect()}
    # Before the first price the entry is the first price; its exit (index 2) is missing.
    assert got[-2] is None and got[-1] is None
    assert math.isclose(got[0], (12.0 - 11.0) / 11.0)
    assert got[1] is None  # entry missing
    assert math.isclose(got[2], (5.0 - 12.0) / 12.0)
    assert got[3] is None  # entry price zero
    assert got[4] is None and got[5] is None and got[6] is None  # past the end
    assert all(
        r["next_day_return"] is None for r in signal.forward_returns(probes, prices, 0).collect()
    )


def test_price_features(spark):
    closes = [10.0 + (i * 7 % 5) for i in range(14)]
    closes[4] = None
    rows = signal.price_features(price_frame(spark, closes)).orderBy("date").collect()
    returns = [None] + [
        (b - a) / a if a is not None and b is not None else None for a, b in zip(closes, closes[1:])
    ]
    for i, r in enumerate(rows):
        assert (r["daily_return"] is None) == (returns[i] is None)
        assert r["lag_return_3"] == (rows[i - 3]["daily_return"] if i >= 3 else None)
        window = returns[max(0, i - 4) : i + 1]
        if len(window) == 5 and None not in window:
            assert math.isclose(r["rolling_return_mean_5"], statistics.mean(window), abs_tol=1e-12)
            assert math.isclose(r["rolling_vol_5"], statistics.stdev(window), abs_tol=1e-12)
        else:
            assert r["rolling_return_mean_5"] is None and r["rolling_vol_5"] is None


ARTICLES = [
    ("A", "2024-01-01 08:00:00", 0.5),
    ("A", "2024-01-01 23:59:59", -1.0),
    ("A", "2024-01-01 10:00:00", 0.1),
    ("A", "2024-01-02 00:00:00", 0.4),
    ("A", "2024-01-03 00:00:00", None),
    ("B", "2024-01-06 00:00:00", 0.2),
]


def test_daily_aggregate(spark):
    articles = spark.createDataFrame(ARTICLES, "ticker string, t string, sentiment_score double")
    articles = articles.withColumn("published_time", F.col("t").cast("timestamp"))
    rows = signal.daily_aggregate(articles).collect()
    got = {(r["ticker"], r["published_date"]): r for r in rows}
    first = got["A", DAY0]
    assert (first["sentiment_score"], first["max_abs_sentiment"], first["article_count"]) == (0.1, 1.0, 3)
    assert math.isclose(first["sentiment_std"], statistics.stdev([0.5, -1.0, 0.1]))
    assert got["A", day(1)]["sentiment_std"] == 0.0
    assert got["A", day(2)]["sentiment_score"] is None and got["A", day(2)]["article_count"] == 1
    features = signal.daily_features(signal.daily_aggregate(articles)).collect()
    assert {r["published_date"]: r["day_of_week"] for r in features}[day(5)] == 5


def test_excess_returns_without_and_with_benchmark(spark):
    daily = spark.createDataFrame([("A", day(0)), ("B", day(0))], "ticker string, published_date date")
    prices = price_frame(spark, [1.0, 2.0, 3.0, 4.0]).union(price_frame(spark, [1.0, 4.0, 4.0, 5.0], "B"))
    market = price_frame(spark, [1.0, 10.0, 10.0, 11.0]).drop("ticker")
    assert "excess_return" not in signal.attach_forward_returns(daily, prices).columns
    out = signal.attach_forward_returns(daily, prices, market).collect()
    got = {r["ticker"]: r["excess_return"] for r in out}
    assert math.isclose(got["A"], 1.0 - 0.1) and math.isclose(got["B"], 0.25 - 0.1)


def test_benchmark_calendar_edges(spark):
    # Days long before the first benchmark price, on it, on the last one and long after.
    offsets = [-400, -1, 0, 1, 2, 3, 400]
    daily = spark.createDataFrame([("A", day(i)) for i in offsets], "ticker string, published_date date")
    market = price_frame(spark, [1.0, 2.0, 4.0, 5.0]).drop("ticker")
    prices = price_frame(spark, [1.0, 1.0])
    out = signal.attach_forward_returns(daily, prices, market, 1).collect()
    got = {(r["published_date"] - DAY0).days: r["benchmark_return"] for r in out}
    assert got == {-400: 1.0, -1: 1.0, 0: 1.0, 1: 0.25, 2: None, 3: None, 400: None}
    none = signal.attach_forward_returns(daily, prices, market.filter("date IS NULL"), 1).collect()
    assert len(none) == 7 and all(r["benchmark_return"] is None for r in none)


def test_required_columns(spark):
    with pytest.raises(ValueError):
        signal.require_columns(spark.range(1), ["id", "nope"])
    assert signal.present_columns(spark.range(1), ["id", "nope"]) == ["id"]
