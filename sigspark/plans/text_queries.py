"""Text cleaning, features, profiles and TF-IDF over the document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import text as tx
from ..functions.times import parse_seen_time
from ..operators import profile as pf
from ..operators import tfidf as ti
from . import inputs
from .registry import TOKEN, day_text, query, rounded, sql_list, sql_text

STOP_WORDS = ("the", "a", "an", "and", "of", "to", "in", "is", "it", "for", "on", "was", "this",
              "that", "with", "la", "le", "der", "die", "el")
STOP = sql_list(STOP_WORDS)
KEYWORDS = ("growth", "Board", "MILLION")
NUMBER, PERCENT = sql_text(lx.NUMBER), sql_text(lx.PERCENT)
WS = sql_text(tx.WHITESPACE)

LOWERED = "regexp_replace(lower(text), 'n''t\\b', ' not', 'g')"
JOINED = f"array_to_string(regexp_extract_all({LOWERED}, {TOKEN}), ' ')"
MARKED = f"regexp_replace({JOINED}, '(^| )(?:no|not|nor|never) (\\S+)', '\\1not_\\2', 'g')"
KEPT = (
    f"list_filter(string_split({MARKED}, ' '), lambda w: w <> '' AND NOT list_contains({STOP}, w))"
)


@query(
    "tokenize",
    f"SELECT doc_id, array_to_string(tok, '|') AS tokens, CAST(len(tok) AS BIGINT) AS n FROM "
    f"(SELECT doc_id, regexp_extract_all(text, {TOKEN}) AS tok FROM texts)",
    needs="texts",
)
def tokenize(spark, folder):
    t = inputs.texts(spark, folder).select("doc_id", tx.tokenize("text").alias("t"))
    return t.select(
        "doc_id", F.array_join("t", "|").alias("tokens"), F.size("t").cast("long").alias("n")
    )


@query("contraction_lower", f"SELECT doc_id, {LOWERED} AS text FROM texts", needs="texts")
def contraction_lower(spark, folder):
    return inputs.texts(spark, folder).select("doc_id", tx.lower_expand("text").alias("text"))


@query("negation_mark", f"SELECT doc_id, {MARKED} AS marked FROM texts", needs="texts")
def negation_mark(spark, folder):
    marked = tx.mark_negation(tx.tokenize(tx.lower_expand("text")))
    return inputs.texts(spark, folder).select(
        "doc_id", F.array_join(marked, " ").alias("marked")
    )


@query(
    "preprocess_text",
    f"SELECT doc_id, array_to_string({KEPT}, ' ') AS clean FROM texts",
    needs="texts",
)
def preprocess_text(spark, folder):
    return inputs.texts(spark, folder).select(
        "doc_id", tx.preprocess("text", stop_words=STOP_WORDS).alias("clean")
    )


@query(
    "preprocess_conversations",
    f"SELECT conv_id, turn, array_to_string({KEPT}, ' ') AS clean FROM conversations",
)
def preprocess_conversations(spark, folder):
    return inputs.table(spark, folder, "conversations").select(
        "conv_id", "turn", tx.preprocess("text", stop_words=STOP_WORDS).alias("clean")
    )


@query(
    "preprocess_retokenized",
    f"SELECT doc_id, array_to_string(regexp_extract_all(array_to_string({KEPT}, ' '), {TOKEN}), ' ') "
    "AS clean FROM texts",
    needs="texts",
)
def preprocess_retokenized(spark, folder):
    return inputs.texts(spark, folder).select(
        "doc_id", tx.preprocess("text", stop_words=STOP_WORDS, retokenize=True).alias("clean")
    )


@query(
    "lemmatise",
    "SELECT doc_id, array_to_string([CASE w WHEN 'sales' THEN 'sale' WHEN 'units' THEN 'unit' "
    f"WHEN 'fell' THEN 'fall' ELSE w END FOR w IN {KEPT}], ' ') AS clean FROM texts",
    needs="texts",
)
def lemmatise(spark, folder):
    lemmas = F.create_map(*[F.lit(x) for x in ("sales", "sale", "units", "unit", "fell", "fall")])
    return inputs.texts(spark, folder).select(
        "doc_id", tx.preprocess("text", stop_words=STOP_WORDS, lemmas=lemmas).alias("clean")
    )


@query(
    "lemmatise_table",
    "SELECT doc_id, array_to_string([CASE w WHEN 'sales' THEN 'sale' WHEN 'units' THEN 'unit' "
    f"WHEN 'fell' THEN 'fall' ELSE w END FOR w IN {KEPT}], ' ') AS clean FROM "
    "(SELECT doc_id, text FROM texts UNION ALL SELECT doc_id, text FROM texts WHERE doc_id % 3 = 0)",
    needs="texts",
)
def lemmatise_table(spark, folder):
    """A table with repeated tokens, over texts whose ids repeat."""
    pairs = "('sales', 'sale'), ('units', 'unit'), ('units', 'units'), ('fell', 'fall'), ('fell', 'fell')"
    table = spark.sql(f"SELECT * FROM VALUES {pairs} AS t(token, lemma)")  # of known size, so it can be broadcast
    texts = inputs.texts(spark, folder)
    twice = texts.unionByName(texts.filter(F.col("doc_id") % 3 == 0))
    tokens = twice.select("doc_id", tx.preprocess_tokens("text", stop_words=STOP_WORDS).alias("t"))
    out = tx.lemmatise_with_table(tokens, "t", table)
    return out.select("doc_id", F.array_join("t", " ").alias("clean"))


@query(
    "ngrams",
    f"SELECT doc_id, array_to_string(list_concat(t, [t[i] || ' ' || t[i + 1] FOR i IN "
    f"range(1, len(t))]), '|') AS grams FROM (SELECT doc_id, {KEPT} AS t FROM texts)",
    needs="texts",
)
def ngrams(spark, folder):
    t = inputs.texts(spark, folder).select(
        "doc_id", tx.preprocess_tokens("text", stop_words=STOP_WORDS).alias("t")
    )
    return t.select("doc_id", F.array_join(tx.ngrams("t", 1, 2), "|").alias("grams"))


def _hits(words) -> str:
    return f"CAST(len(list_intersect(list_distinct(tok), {sql_list(words)})) AS DOUBLE)"


@query(
    "lexicon_features",
    f"""SELECT doc_id, CAST(len(tok) AS DOUBLE) AS sentence_length,
    {_hits(lx.FINANCIAL)} AS financial_kw_count, {_hits(lx.POSITIVE)} AS positive_kw_count,
    {_hits(lx.NEGATIVE)} AS negative_kw_count,
    CASE WHEN regexp_matches(text, {NUMBER}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_number,
    CASE WHEN regexp_matches(text, {PERCENT}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_percentage,
    CAST(len(regexp_extract_all(text, {NUMBER})) AS DOUBLE) AS number_count,
    {_hits(lx.NEGATION)} AS negation_count
    FROM (SELECT *, regexp_extract_all(lower(text), {TOKEN}) AS tok FROM texts)""",
    needs="texts",
)
def lexicon_features(spark, folder):
    return tx.with_lexicon_features(inputs.texts(spark, folder)).select(
        "doc_id", *tx.LEXICON_FEATURES
    )


@query(
    "word_char_counts",
    f"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, {WS}), lambda w: w <> '')) "
    "AS BIGINT) AS words, CAST(length(text) AS BIGINT) AS chars FROM texts",
    needs="texts",
)
def word_char_counts(spark, folder):
    return inputs.texts(spark, folder).select(
        "doc_id",
        tx.word_count("text").cast("long").alias("words"),
        tx.char_count("text").cast("long").alias("chars"),
    )


@query(
    "keyword_filter",
    "SELECT doc_id FROM texts WHERE contains(lower(text), 'growth') OR "
    "contains(lower(text), 'board') OR contains(lower(text), 'million')",
    needs="texts",
)
def keyword_filter(spark, folder):
    return inputs.texts(spark, folder).filter(tx.contains_any("text", KEYWORDS)).select("doc_id")


@query(
    "parse_two_formats",
    "SELECT pos, strftime(coalesce(try_strptime(seendate, '%Y%m%d%H%M%S'), "
    "try_strptime(seendate, '%Y%m%dT%H%M%SZ')), '%Y-%m-%d %H:%M:%S') AS seen FROM feed",
    needs="feed",
)
def parse_two_formats(spark, folder):
    return inputs.headline_feed(spark, folder).select(
        "pos", F.date_format(parse_seen_time("seendate"), "yyyy-MM-dd HH:mm:ss").alias("seen")
    )


# --- profiles ---------------------------------------------------------------------------------


@query(
    "class_distribution",
    "SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct "
    "FROM labs GROUP BY label",
    needs="labs",
)
def class_distribution(spark, folder):
    return pf.class_distribution(inputs.labels(spark, folder)).withColumn("pct", rounded("pct"))


@query(
    "class_names",
    "SELECT CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE '2' END AS label_name, "
    "count(*) AS n FROM labs GROUP BY 1",
    needs="labs",
)
def class_names(spark, folder):
    # Two names for three classes: the third shows its number.
    named = pf.with_label_names(inputs.labels(spark, folder), lx.LABEL_NAMES[:2])
    return named.groupBy("label_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "length_stats",
    f"""SELECT label, round(avg(n), 6) AS avg_len, list_sort(list(n))[count(*) // 2 + 1] AS median_len,
    min(n) AS min_len, max(n) AS max_len
    FROM (SELECT label, CAST(len(regexp_extract_all(text, {TOKEN})) AS BIGINT) AS n FROM labelled)
    GROUP BY label""",
    needs="labelled",
)
def length_stats(spark, folder):
    return pf.length_stats(inputs.labelled(spark, folder)).withColumn("avg_len", rounded("avg_len"))


@query(
    "mean_length",
    f"SELECT label, round(avg(len(regexp_extract_all(text, {TOKEN}))), 6) AS avg_len "
    "FROM labelled GROUP BY label",
    needs="labelled",
)
def mean_length(spark, folder):
    return pf.mean_length(inputs.labelled(spark, folder)).withColumn("avg_len", rounded("avg_len"))


@query(
    "length_profile",
    f"""SELECT lang, count(*) AS n, round(avg(w), 6) AS mean_words, round(stddev_pop(w), 6) AS std_words,
    CAST(min(w) AS DOUBLE) AS min_words, round(quantile_cont(w, 0.5), 6) AS p50_words,
    round(quantile_cont(w, 0.9), 6) AS p90_words, CAST(max(w) AS DOUBLE) AS max_words,
    round(avg(c), 6) AS mean_chars, round(stddev_pop(c), 6) AS std_chars
    FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, {WS}), lambda w: w <> ''))::DOUBLE AS w,
    length(text) AS c FROM documents) GROUP BY lang""",
)
def length_profile(spark, folder):
    out = pf.length_profile(inputs.documents(spark, folder, "lang"), ["lang"])
    return out.select("lang", "n", *[rounded(c).alias(c) for c in out.columns[2:]])


@query(
    "top_words",
    f"""SELECT label, token, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY label
    ORDER BY n DESC, token) AS rank FROM (SELECT label, token, count(*) AS n FROM
    (SELECT label, unnest(regexp_extract_all(lower(text), {TOKEN})) AS token FROM labelled)
    GROUP BY 1, 2)) WHERE rank <= 15""",
    needs="labelled",
)
def top_words(spark, folder):
    return pf.top_words(inputs.labelled(spark, folder)).withColumn("rank", F.col("rank").cast("long"))


@query(
    "keyword_doc_freq",
    f"""SELECT label, keyword, n, class_total, round(100.0 * n / class_total, 6) AS pct, rank FROM
    (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, keyword) AS rank FROM
    (SELECT label, keyword, count(*) AS n FROM (SELECT label, unnest(list_intersect(list_distinct(
    regexp_extract_all(lower(text), {TOKEN})), {sql_list(lx.FINANCIAL)})) AS keyword FROM labelled)
    GROUP BY 1, 2) JOIN (SELECT label, count(*) AS class_total FROM labelled GROUP BY 1) USING (label))
    WHERE rank <= 10""",
    needs="labelled",
)
def keyword_doc_freq(spark, folder):
    return (
        pf.keyword_document_frequency(inputs.labelled(spark, folder))
        .withColumn("pct", rounded("pct"))
        .withColumn("rank", F.col("rank").cast("long"))
    )


@query(
    "number_presence",
    f"""SELECT lang, n, has_number, has_percent, round(100.0 * has_number / n, 6) AS number_pct,
    round(100.0 * has_percent / n, 6) AS percent_pct FROM (SELECT lang, count(*) AS n,
    count(*) FILTER (regexp_matches(text, {NUMBER})) AS has_number,
    count(*) FILTER (regexp_matches(text, {PERCENT})) AS has_percent FROM documents GROUP BY lang)""",
)
def number_presence(spark, folder):
    out = pf.number_presence(inputs.documents(spark, folder, "lang"), label="lang")
    return out.withColumn("number_pct", rounded("number_pct")).withColumn(
        "percent_pct", rounded("percent_pct")
    )


@query(
    "class_sample",
    "SELECT label, sample_no, doc_id, text FROM (SELECT *, row_number() OVER "
    "(PARTITION BY label ORDER BY doc_id) AS sample_no FROM labelled) WHERE sample_no <= 3",
    needs="labelled",
)
def class_sample(spark, folder):
    return pf.class_sample(inputs.labelled(spark, folder), "doc_id").select(
        "label", F.col("sample_no").cast("long").alias("sample_no"), "doc_id", "text"
    )


@query(
    "rows_per_ticker",
    "SELECT ticker, count(*) AS n FROM articles GROUP BY ticker",
    needs="articles",
)
def rows_per_ticker(spark, folder):
    return pf.rows_per_ticker(inputs.articles(spark, folder))


@query("distinct_sorted", "SELECT DISTINCT source FROM documents")
def distinct_sorted(spark, folder):
    return pf.distinct_sorted(inputs.table(spark, folder, "documents"), "source")


@query(
    "label_encoding",
    "SELECT doc_id, dense_rank() OVER (ORDER BY source) - 1 AS label_id FROM documents",
)
def label_encoding(spark, folder):
    documents = inputs.table(spark, folder, "documents").select("doc_id", "source")
    return pf.encode_labels(documents, "source").select(
        "doc_id", F.col("label_id").cast("long").alias("label_id")
    )


@query(
    "conversation_lengths",
    f"""SELECT role, round(avg(n), 6) AS avg_len, list_sort(list(n))[count(*) // 2 + 1] AS median_len,
    min(n) AS min_len, max(n) AS max_len
    FROM (SELECT role, CAST(len(regexp_extract_all(text, {TOKEN})) AS BIGINT) AS n FROM conversations)
    GROUP BY role""",
)
def conversation_lengths(spark, folder):
    out = pf.length_stats(inputs.table(spark, folder, "conversations"), label="role")
    return out.withColumn("avg_len", rounded("avg_len"))


# --- TF-IDF -----------------------------------------------------------------------------------

TERMS = (
    "grams AS (SELECT doc_id, unnest(list_concat(t, [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))])) "
    f"AS term FROM (SELECT doc_id, {KEPT} AS t FROM texts)), "
    "tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY 1, 2), "
    "docs AS (SELECT count(*) AS nd FROM texts), "
    "idf AS (SELECT term, count(*) AS df, sum(tf) AS total_tf, "
    "ln((1 + any_value(nd)) / (1.0 + count(*))) + 1 AS idf FROM tf, docs GROUP BY term)"
)
LONG = (
    f"WITH {TERMS}, w AS (SELECT doc_id, term, tf, df, tf * idf AS w FROM tf JOIN idf USING (term)) "
    "SELECT doc_id, term, tf, df, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w"
)


def _with_grams(texts):
    tokens = texts.withColumn("t", tx.preprocess_tokens("text", stop_words=STOP_WORDS)).drop("text")
    return tokens.withColumn("grams", tx.ngrams("t", 1, 2)).drop("t")


@query("tfidf_long", LONG, needs="texts")
def tfidf_long(spark, folder):
    out = ti.tfidf_long(inputs.texts(spark, folder), "doc_id", "grams", derive=_with_grams)
    return out.withColumn("tfidf", rounded("tfidf"))


@query(
    "idf_table",
    f"WITH {TERMS} SELECT term, df, round(idf, 6) AS idf FROM idf",
    needs="texts",
)
def idf_table(spark, folder):
    texts = inputs.texts(spark, folder)
    vocab = ti.vocabulary(ti.term_frequencies(texts, "doc_id", "grams", _with_grams))
    return ti.idf_table(vocab, texts).withColumn("idf", rounded("idf"))


@query(
    "vocabulary_topk",
    f"WITH {TERMS} SELECT term, df, CAST(total_tf AS BIGINT) AS total_tf FROM idf "
    "ORDER BY total_tf DESC, term LIMIT 500",
    needs="texts",
)
def vocabulary_topk(spark, folder):
    frequencies = ti.term_frequencies(inputs.texts(spark, folder), "doc_id", "grams", _with_grams)
    return ti.vocabulary(frequencies, max_features=500)


@query(
    "tfidf_vectors",
    f"WITH {TERMS}, w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)) "
    "SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w",
    needs="texts",
)
def tfidf_vectors(spark, folder):
    """The vector form, unfolded to rows again; it has to equal the long form."""
    texts = inputs.texts(spark, folder)
    model = ti.TfidfVectors("grams", "tfidf", id_column="doc_id", derive=_with_grams).fit(texts)
    entries = ti.vector_entries(model.transform(texts), "doc_id", "tfidf")
    return entries.join(model.vocabulary, "pos").select("doc_id", "term", rounded("value").alias("tfidf"))
