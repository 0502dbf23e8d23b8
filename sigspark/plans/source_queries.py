"""File sources and sinks: written from the driver tables, read back through the public readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import metrics as me
from ..operators.ingest import HEADLINE_KEY, keep_first
from ..session import checkpoint_folder
from ..sources import corpus, feeds, prices, results, sinks
from ..streaming.feed_stream import ingest_feed, read_ingested
from . import inputs
from .ingest_queries import TERM_MATCH
from .registry import day_text, query, rounded

TICKERS = [f"T{i}" for i in range(inputs.TICKERS)]


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _name_file(spark: SparkSession, folder: str, target: str) -> None:
    """Give the one part file in ``folder`` the name ``target``, as a vendor would deliver it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = fs.globStatus(path(f"{folder}/part-*"))[0].getPath()
    fs.mkdirs(path(target).getParent())
    fs.rename(part, path(target))


@query(
    "read_labelled",
    "SELECT doc_id, label, md5(text) AS digest FROM labelled JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) "
    "WHERE lang = 'en'",
    needs="labelled",
)
def read_labelled(spark, folder):
    """Labelled sentences in one folder per subset; one subset read back."""
    path = _scratch(spark, "labelled")
    lang = inputs.table(spark, folder, "documents").select("doc_id", F.col("lang").alias("subset"))
    rows = inputs.labelled(spark, folder).join(lang, "doc_id")
    sinks.write_dataset(rows, path, partition_by=["subset"])
    return corpus.read_labelled(spark, path, "en").select("doc_id", "label", F.md5("text").alias("digest"))


PRICE_ROWS = (
    "SELECT ticker, strftime(date, '%Y-%m-%d') AS date, round(adjusted_close, 6) AS adjusted_close FROM prices"
)


def _written_prices(spark, folder) -> str:
    """Price CSV files for all tickers but T1, which has a JSON document, and T0 in both forms."""
    root = _scratch(spark, "prices")
    rows = inputs.prices(spark, folder)
    full = rows.select(
        "ticker", "date", *[F.col("adjusted_close").alias(c) for c in ("open", "high", "low", "close", "adjusted_close")],
        F.lit(1.0).alias("volume"),
    ).persist()
    try:
        for ticker in TICKERS:
            own = full.filter(F.col("ticker") == ticker).drop("ticker")
            if ticker != "T1":
                own.coalesce(1).write.option("header", True).csv(f"{root}/csv-{ticker}")
                _name_file(spark, f"{root}/csv-{ticker}", f"{root}/files/prices_{ticker}.csv")
            if ticker in ("T0", "T1"):
                price = F.lit(2.0 if ticker == "T0" else 1.0) * F.col("close")  # the CSV of T0 wins
                names = schemas.PRICE_SERIES_FIELDS
                values = F.create_map(*[x for n in names for x in (F.lit(n), price.cast("string"))])
                # One document has one ticker's trading days, which the calendar bounds.
                series = F.map_from_entries(F.collect_list(F.struct(day_text("date"), values)))
                own.agg(F.to_json(F.struct(series.alias(schemas.PRICE_SERIES_KEY))).alias("value")).write.text(f"{root}/json-{ticker}")
                _name_file(spark, f"{root}/json-{ticker}", f"{root}/files/prices_{ticker}.json")
    finally:
        full.unpersist()
    return f"{root}/files"


def _show(df: DataFrame) -> DataFrame:
    return df.select("ticker", day_text("date").alias("date"), rounded("adjusted_close").alias("adjusted_close"))


@query("read_price_csv", PRICE_ROWS + " WHERE ticker <> 'T1'", needs="prices")
def read_price_csv(spark, folder):
    return _show(prices.read_price_csv(spark, f"{_written_prices(spark, folder)}/prices_*.csv"))


@query("read_prices", PRICE_ROWS, needs="prices")
def read_prices(spark, folder):
    """CSV where there is one, else JSON."""
    return _show(prices.read_prices(spark, _written_prices(spark, folder), [t.lower() for t in TICKERS]))


@query("write_prices", PRICE_ROWS, needs="prices")
def write_prices(spark, folder):
    """One folder per ticker, a ticker spread over two files."""
    path = _scratch(spark, "price-table")
    prices.write_prices(inputs.prices(spark, folder), path, salts=2)
    return _show(spark.read.parquet(path))


@query("read_tickers", "SELECT DISTINCT upper(source) AS ticker FROM documents")
def read_tickers(spark, folder):
    """A list with repeats, blanks and mixed case."""
    path = _scratch(spark, "tickers")
    source = inputs.table(spark, folder, "documents").select("source")
    lines = source.select(F.concat(F.lit("  "), "source")).union(source.select(F.upper("source"))).union(source.select(F.lit(" ")))
    lines.toDF("value").write.text(path)
    return corpus.read_tickers(spark, path)


WINDOW = "CASE WHEN pos % 7 = 0 THEN 0 WHEN pos % 7 < 3 THEN 1 ELSE 2 END"
ARRIVAL = (
    f"SELECT pos, upper(ticker) AS ticker, url, seendate FROM (SELECT *, row_number() OVER (PARTITION BY "
    f"coalesce(url, ''), coalesce(seendate, '') ORDER BY {WINDOW}, pos) AS turn FROM feed) WHERE turn = 1"
)


def _landed_windows(spark, folder) -> str:
    """A feed landed in three windows of different sizes that share keys: a folder for each, any number of files in it."""
    root = _scratch(spark, "windows")
    feed = inputs.headline_feed(spark, folder).withColumn("window", F.expr(WINDOW))
    feed.write.partitionBy("window").json(f"{root}/landing")
    return f"{root}/landing"


def _landed_window():
    return F.regexp_extract(F.col("_metadata.file_path"), r"/window=(\d+)/", 1)


@query("feed_arrival_order", ARRIVAL, needs="feed")
def feed_arrival_order(spark, folder):
    """Keep-first over several windows: by window, then place."""
    rows = feeds.read_headline_feed(spark, _landed_windows(spark, folder), lines=True)
    return keep_first(rows, HEADLINE_KEY, ["window", "pos"]).select("pos", F.upper("ticker").alias("ticker"), "url", "seendate")


STREAMED = (
    f"SELECT pos, upper(ticker) AS ticker, url, seendate FROM (SELECT *, row_number() OVER (PARTITION BY "
    f"coalesce(url, ''), coalesce(seendate, '') ORDER BY {WINDOW}, pos) AS turn FROM feed WHERE {TERM_MATCH}) "
    "WHERE turn = 1"
)


@query("feed_stream_batches", STREAMED, needs="feed")
def feed_stream_batches(spark, folder):
    """Three windows land one after the other, with copies across them; each run takes what is new."""
    landed = _landed_windows(spark, folder)
    root = _scratch(spark, "stream")
    for window in range(3):
        # A run reads the landing folder as it is by then.
        spark.read.text(f"{landed}/window={window}").write.text(f"{root}/landing/window={window}")
        ingest_feed(
            spark, f"{root}/landing/*", f"{root}/table", f"{root}/progress", quarantine=f"{root}/bad", origin=_landed_window()
        ).awaitTermination()
    return read_ingested(spark, f"{root}/table").select("pos", "ticker", "url", "seendate")


@query("feed_stream_one_batch", STREAMED, needs="feed")
def feed_stream_one_batch(spark, folder):
    """All windows in one batch: of copies, the one of the earliest window stays, whatever its place."""
    landed = _landed_windows(spark, folder)
    root = _scratch(spark, "stream")
    ingest_feed(
        spark, f"{landed}/*", f"{root}/table", f"{root}/progress", quarantine=f"{root}/bad", origin=_landed_window()
    ).awaitTermination()
    return read_ingested(spark, f"{root}/table").select("pos", "ticker", "url", "seendate")


@query(
    "write_metrics",
    "SELECT 'csv' AS kind, count(*) AS n, round(avg(abs(l_quantity - 25)), 6) AS mae FROM lineitem "
    "UNION ALL SELECT 'json', count(*), round(avg(abs(l_quantity - 25)), 6) FROM lineitem",
)
def write_metrics(spark, folder):
    """One metrics row as JSON and as CSV."""
    rows = inputs.table(spark, folder, "lineitem").withColumn("guess", F.lit(25.0))
    record = me.regression_metrics(rows, "l_quantity", "guess").select("n", "mae")
    out = []
    for kind in ("json", "csv"):
        path = f"{_scratch(spark, 'metrics')}.{kind}"
        sinks.write_metrics(record, path)
        reader = spark.read.schema("n long, mae double").option("header", True)
        out.append(reader.format(kind).load(path).select(F.lit(kind).alias("kind"), "n", rounded("mae").alias("mae")))
    return out[0].unionByName(out[1])


@query(
    "write_dataset",
    "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS price FROM orders",
)
def write_dataset(spark, folder):
    """A CSV table in one folder per status."""
    path = _scratch(spark, "dataset")
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"))
    sinks.write_dataset(orders, path, partition_by=["o_orderstatus"], fmt="csv")
    return spark.read.schema("o_orderkey long, price double, o_orderstatus string").option("header", True).csv(path)


@query(
    "read_results",
    "SELECT 'sentences_' || lang AS subset, CAST(count(*) AS DOUBLE) AS accuracy FROM documents GROUP BY lang",
)
def read_results(spark, folder):
    """One results.json per subset folder."""
    root = _scratch(spark, "results")
    counts = inputs.table(spark, folder, "documents").groupBy("lang").agg(F.count(F.lit(1)).cast("double").alias("accuracy"))
    for row in counts.collect():  # one row per language
        document = '{"dataset": "d", "models": [{"name": "m", "metrics": {"accuracy": %r}}]}' % row["accuracy"]
        target = f"{root}/sentences_{row['lang']}"
        spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(f"{root}-parts/{row['lang']}")
        _name_file(spark, f"{root}-parts/{row['lang']}", f"{target}/results.json")
    read = results.read_results(spark, root)
    return read.select("subset", F.explode("models").alias("m")).select("subset", F.col("m.metrics.accuracy").alias("accuracy"))


@query("saved_split", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS part FROM labs", needs="labs")
def saved_split(spark, folder):
    """A split saved under its settings; another seed's split in the same place stays apart."""
    path = _scratch(spark, "splits")
    part = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")
    split = inputs.labels(spark, folder).select("doc_id", part.alias("part"))
    corpus.write_split(split, path, subset="s", seed=1, test_size=0.2)
    corpus.write_split(split.withColumn("part", F.lit("test")), path, subset="s", seed=2, test_size=0.2)
    return corpus.read_split(spark, path, subset="s", seed=1, test_size=0.2).select("doc_id", "part")
