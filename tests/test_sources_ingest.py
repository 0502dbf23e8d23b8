import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sigspark import schemas
from sigspark.operators import articles as ar
from sigspark.operators import ingest as ig
from sigspark.sources import corpus, feeds, prices, sinks
from sigspark.streaming.feed_stream import ingest_feed, read_ingested


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(path)


CSV = "date,open,high,low,close,adjusted_close,volume\n2024-01-03,1,1,1,3,3,9\n2024-01-02,1,1,1,2,2,9\n"
SERIES = {
    "Time Series (Daily)": {
        "2024-01-02": {"1. open": "1", "2. high": "2", "3. low": "x", "4. close": "4.5"},
        "2024-01-03": {"4. close": "5", "5. volume": "7"},
    }
}


def test_prices_csv_before_json(spark, tmp_path):
    write(tmp_path / "prices_AAA.csv", CSV)
    write(tmp_path / "prices_AAA.json", SERIES)
    write(tmp_path / "prices_BBB.json", SERIES)
    got = prices.read_prices(spark, str(tmp_path), ["aaa", "BBB"]).orderBy("ticker", "date").collect()
    assert [(r["ticker"], str(r["date"]), r["adjusted_close"]) for r in got] == [
        ("AAA", "2024-01-02", 2.0), ("AAA", "2024-01-03", 3.0),
        ("BBB", "2024-01-02", 4.5), ("BBB", "2024-01-03", 5.0),
    ]
    assert got[2]["low"] is None and got[2]["volume"] is None and got[3]["volume"] == 7.0
    with pytest.raises(FileNotFoundError, match="CCC"):
        prices.read_prices(spark, str(tmp_path), ["AAA", "CCC"])
    assert prices.read_benchmark(spark, str(tmp_path), "SPY") is None
    assert prices.read_benchmark(spark, str(tmp_path), "aaa").count() == 2


def test_price_json_without_series(spark, tmp_path):
    write(tmp_path / "prices_BAD.json", {"Note": "later"})
    with pytest.raises(PySparkException):
        prices.read_prices(spark, str(tmp_path), ["BAD"]).collect()


def test_price_slice_and_write(spark, tmp_path):
    raw = spark.createDataFrame(
        [("aa", "2024-01-02T00:00:00+0000", 1.0), ("AA", "2024-01-01T00:00:00+0000", 2.0),
         ("", "2024-01-01T00:00:00+0000", 3.0), (None, "2024-01-01T00:00:00+0000", 3.0)],
        "symbol string, date string, close double",
    ).withColumns({c: F.col("close") for c in ("open", "high", "low", "volume")})
    table = prices.normalise_prices(raw.withColumn("date", F.to_date(F.substring("date", 1, 10))))
    prices.write_prices(table, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["ticker"], str(r["date"]), r["adjusted_close"]) for r in back) == [
        ("AA", "2024-01-01", 2.0), ("AA", "2024-01-02", 1.0)
    ]
    assert prices.slice_dates(table, "2024-01-02", "2024-01-02").count() == 1
    assert prices.slice_dates(table, None, None).count() == 2


def test_tickers(spark, tmp_path):
    path = write(tmp_path / "t.txt", " aapl \n\nMSFT\nmsft\n")
    assert sorted(r[0] for r in corpus.read_tickers(spark, path).collect()) == ["AAPL", "MSFT"]
    with pytest.raises(ValueError):
        corpus.read_tickers(spark, write(tmp_path / "e.txt", "\n \n"))


def test_labelled_and_split_cache(spark, tmp_path):
    rows = [(i, f"s{i % 2}", "text", i % 3) for i in range(12)]
    df = spark.createDataFrame(rows, schemas.LABELLED_SENTENCE)
    df.write.partitionBy("subset").parquet(str(tmp_path / "c"))
    assert corpus.read_labelled(spark, str(tmp_path / "c"), "s1").count() == 6
    path = str(tmp_path / "split")
    key = {"subset": "s1", "seed": 1, "test_size": 0.2}
    assert corpus.read_split(spark, path, **key) is None
    corpus.write_split(df.withColumn("part", F.lit("train")), path, **key)
    assert corpus.read_split(spark, path, **key).count() == 12
    assert corpus.read_split(spark, path, **{**key, "seed": 2}) is None
    # Another subset does not replace this one.
    corpus.write_split(df.limit(3).withColumn("part", F.lit("test")), path, **{**key, "subset": "x"})
    assert corpus.read_split(spark, path, **key).count() == 12
    corpus.write_label_names(spark, ["a", "b"], str(tmp_path / "names"))
    assert corpus.read_label_names(spark, str(tmp_path / "names")).count() == 2
    assert corpus.read_label_names(spark, str(tmp_path / "none")) is None


def test_metric_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "n int, mae double")
    sinks.write_metrics(df, str(tmp_path / "m.json"))
    sinks.write_metrics(df, str(tmp_path / "m.csv"))
    assert spark.read.json(str(tmp_path / "m.json")).first()["mae"] == 0.5
    assert spark.read.option("header", True).csv(str(tmp_path / "m.csv")).first()["n"] == "1"
    with pytest.raises(ValueError):
        sinks.write_metrics(df, str(tmp_path / "m.txt"))


def headline(ticker="AAPL", title="Apple up", url="u", seen="20240101000000"):
    return {"ticker": ticker, "title": title, "url": url, "seendate": seen}


def test_feed_to_articles(spark, tmp_path):
    feed = [
        headline(), headline(ticker="aapl", seen="20240102T010203Z"), headline(seen=""),
        headline(title="pineapple"), headline(title="unrelated"), headline(ticker="ZZZ", title="zzz"),
        {"ticker": "JPM", "title": "Chase bank", "seendate": "20240101000000"},
    ]
    path = write(tmp_path / "news.json", {"items": "99", "feed": feed})
    rows = feeds.read_headline_feed(spark, path)
    assert [r["pos"] for r in rows.orderBy("pos").collect()] == list(range(7))
    got = ar.to_articles(rows, ["aapl", "JPM"]).collect()
    assert len(got) == 4 and {r["ticker"] for r in got} == {"AAPL", "JPM"}
    assert [r["url"] for r in got if r["ticker"] == "JPM"] == [""]
    whole = ar.to_articles(rows, ["AAPL"], word_boundary=True).collect()
    assert len(whole) == 2
    table = spark.createDataFrame([("AAPL", ["unrelated"])], "ticker string, aliases array<string>")
    assert ar.to_articles(rows, ["AAPL"], aliases=table).count() == 1
    names = spark.createDataFrame([("jpm",)], "ticker string")
    assert ar.to_articles(rows, names).count() == 1
    bad = spark.createDataFrame([headline(seen="yesterday")], schemas.HEADLINE)
    assert ar.unreadable_times(bad).count() == 1
    with pytest.raises(PySparkException):
        ar.to_articles(bad, ["AAPL"]).collect()
    assert ar.to_articles(bad, ["AAPL"], on_error="null").first()["published_time"] is None


def test_payload_gate(spark, tmp_path):
    write(tmp_path / "a.json", {"feed": [{"url": "u", "time_published": "t"}], "sentiment_score_definition": "d"})
    write(tmp_path / "b.json", {"Note": "slow"})
    write(tmp_path / "c.json", {"items": "0"})
    write(tmp_path / "d.json", {"feed": []})
    good, bad = feeds.split_payloads(feeds.read_api_documents(spark, str(tmp_path / "*.json")))
    assert good.count() == 2 and feeds.api_articles(good).count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["Note: slow", "missing feed"]
    assert tuple(feeds.feed_metadata(good, "origin").first()) == ("d", "")


def test_search_predicate(spark):
    df = spark.createDataFrame([([" Apple ", "JP Morgan", " "],)], "t array<string>")
    assert df.select(ig.search_predicate("t")).first()[0] == '(Apple OR "JP Morgan")'
    with pytest.raises(PySparkException):
        spark.createDataFrame([([" "],)], "t array<string>").select(ig.search_predicate("t")).collect()
    own = spark.createDataFrame([("xyz",)], "ticker string").select(ig.default_terms("ticker"))
    assert own.first()[0] == ["XYZ"]


def test_plans_and_estimates(spark):
    span = spark.sql("SELECT DATE'2024-01-01' AS start_date, DATE'2024-01-16' AS end_date")
    plan = ig.window_plan(span, 7).orderBy("window_start").collect()
    assert [(str(r["window_start"]), str(r["window_end"])) for r in plan] == [
        ("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-14"), ("2024-01-15", "2024-01-16")
    ]
    assert plan[2]["time_to"] == "20240116T2359" and plan[0]["start_arg"] == "20240101000000"
    with pytest.raises(ValueError):
        ig.window_plan(span, 0)
    a, b = F.col("start_date"), F.col("end_date")
    assert span.select(ig.business_days(a, b)).first()[0] == 12
    assert span.select(ig.estimate_news_calls(a, b, F.lit(2), 7)).first()[0] == 5
    assert span.select(ig.estimate_price_calls(a, b, F.lit(2), 10)).first()[0] == 6
    for column in (ig.estimate_news_calls(a, b, F.lit(2), 7, cap=4), ig.estimate_news_calls(b, a, F.lit(2), 7)):
        with pytest.raises(PySparkException):
            span.select(column).collect()


def test_keep_first_and_merge(spark):
    rows = [(2, "u", None, "b"), (1, "u", "", "a"), (3, None, "t", "c"), (4, "u", "t", "d")]
    df = spark.createDataFrame(rows, "pos int, url string, seendate string, x string")
    assert sorted(r["x"] for r in ig.keep_first(df, ig.HEADLINE_KEY, ["pos"]).collect()) == ["a", "c", "d"]
    newer = spark.createDataFrame([(0, "u", "t", "new"), (0, "v", "t", "v")], df.schema)
    merged = ig.merge_feeds(df, newer, ig.HEADLINE_KEY, ["pos"])
    assert sorted(r["x"] for r in merged.collect()) == ["a", "c", "d", "v"]
    one, two = [
        spark.createDataFrame([v], "sentiment_score_definition string, relevance_score_definition string")
        for v in (("", "r"), ("s", "other"))
    ]
    assert tuple(ig.merge_definitions(one, two).first()) == ("s", "r")


def land(folder, name, rows):
    write(folder / name, "\n".join(json.dumps(r) for r in rows))


def run(spark, root, **options):
    ingest_feed(
        spark, str(root / "landing"), str(root / "table"), str(root / "progress"), **options
    ).awaitTermination()
    rows = read_ingested(spark, str(root / "table")).collect()
    return sorted((r["url"], r["seendate"], r["title"]) for r in rows)


def test_stream_restart_and_replay(spark, tmp_path):
    landing = tmp_path / "landing"
    t1, t2 = "20240101000000", "20240102T000000Z"
    land(landing, "a.json", [
        {"pos": 0, **headline(url="u1", seen=t1)}, {"pos": 1, **headline(url="u1", seen=t1, title="Apple copy")},
        {"pos": 2, **headline(title="no match", url="x")}, {"Note": "limit"},
    ])
    first = run(spark, tmp_path)
    assert first == [("u1", t1, "Apple up")]
    assert run(spark, tmp_path) == first  # nothing new
    land(landing, "b.json", [
        {"pos": 3, **headline(url="u1", seen=t1, title="Apple late")}, {"pos": 4, **headline(url="u2", seen=t2)},
        {"pos": 5, **headline(url="u3", seen="")},
    ])
    want = [("u1", t1, "Apple up"), ("u2", t2, "Apple up"), ("u3", "", "Apple up")]
    assert run(spark, tmp_path) == want
    # The second batch was written but its commit was lost: it is played again, without copies.
    (tmp_path / "progress" / "commits" / "1").unlink()
    crc = tmp_path / "progress" / "commits" / ".1.crc"
    if crc.exists():
        crc.unlink()
    assert run(spark, tmp_path) == want
    quarantined = spark.read.parquet(str(tmp_path / "table_quarantine"))
    assert quarantined.filter("Note = 'limit'").count() == 1


def test_stream_small_batches(spark, tmp_path):
    for i in range(4):
        land(tmp_path / "landing", f"{i}.json", [
            {"pos": 10 * i + j, **headline(url=f"u{j}", seen=f"2024010{1 + j}000000")} for j in range(3)
        ])
    got = run(spark, tmp_path, max_files_per_batch=1)
    assert [g[0] for g in got] == ["u0", "u1", "u2"]


def test_stream_orders_files_of_one_batch(spark, tmp_path):
    """Of copies in one batch the earliest file's stays, whatever its place in it."""
    seen = "20240101000000"
    for name, pos, title in (("c.json", 0, "Apple c"), ("a.json", 9, "Apple a"), ("b.json", 4, "Apple b")):
        land(tmp_path / "landing", name, [{"pos": pos, **headline(url="u", seen=seen, title=title)}])
    assert run(spark, tmp_path) == [("u", seen, "Apple a")]
    land(tmp_path / "landing", "0.json", [{"pos": 0, **headline(url="u", seen=seen, title="Apple late")}])
    assert run(spark, tmp_path) == [("u", seen, "Apple a")]
