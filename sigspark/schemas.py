"""Explicit schemas of the inputs; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


LABELLED_SENTENCE = _struct(
    doc_id=LongType(), subset=StringType(), text=StringType(), label=IntegerType()
)

PRICE_COLUMNS = ("date", "open", "high", "low", "close", "adjusted_close", "volume")

PRICE = StructType(
    [StructField("date", DateType(), True)]
    + [StructField(name, DoubleType(), True) for name in PRICE_COLUMNS[1:]]
)

# Fixed names: keys of the date-keyed daily price document.
PRICE_SERIES_KEY = "Time Series (Daily)"
PRICE_SERIES_FIELDS = ("1. open", "2. high", "3. low", "4. close", "5. volume")

PRICE_DOCUMENT = StructType(
    [
        StructField(
            PRICE_SERIES_KEY, MapType(StringType(), _strings(*PRICE_SERIES_FIELDS)), True
        )
    ]
)

# Fixed names: keys whose presence marks a payload as an error or rate-limit notice.
ERROR_KEYS = ("Error Message", "Note", "Information")

HEADLINE = _strings(
    "ticker", "title", "url", "seendate", "domain", "language", "sourcecountry", "socialimage"
)
HEADLINE_FEED = _struct(items=StringType(), feed=ArrayType(HEADLINE))

API_ARTICLE = _strings("url", "time_published", "title")
API_FEED = StructType(
    [
        StructField("items", StringType(), True),
        StructField("sentiment_score_definition", StringType(), True),
        StructField("relevance_score_definition", StringType(), True),
        StructField("feed", ArrayType(API_ARTICLE), True),
    ]
    + [StructField(key, StringType(), True) for key in ERROR_KEYS]
)

_REPORT_ROW = StructType(
    [
        StructField("precision", DoubleType(), True),
        StructField("recall", DoubleType(), True),
        StructField("f1-score", DoubleType(), True),
        StructField("support", DoubleType(), True),
    ]
)
REPORT_AS_STRINGS = MapType(StringType(), StringType())
REPORT_ROW = _REPORT_ROW

METRICS = _struct(
    accuracy=DoubleType(),
    precision=DoubleType(),
    recall=DoubleType(),
    macro_precision=DoubleType(),
    macro_recall=DoubleType(),
    macro_f1=DoubleType(),
    roc_auc_ovr=DoubleType(),
    per_class=_struct(
        precision=ArrayType(DoubleType()),
        recall=ArrayType(DoubleType()),
        f1=ArrayType(DoubleType()),
    ),
    confusion_matrix=ArrayType(ArrayType(LongType())),
    # The report mixes a scalar entry with structs, so each entry is kept as JSON text.
    classification_report=REPORT_AS_STRINGS,
)

MODEL_ENTRY = _struct(
    name=StringType(),
    best_params=MapType(StringType(), StringType()),
    cv_macro_f1=DoubleType(),
    metrics=METRICS,
)

RESULTS = _struct(dataset=StringType(), models=ArrayType(MODEL_ENTRY))
