"""Text cleaning and text features as Column expressions; no Python UDF is involved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicons as lx

# White space as str.split() understands it, wider than Java's \s.
WHITESPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _words(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def tokenize(text: Column | str) -> Column:
    """All tokens, left to right: words with one apostrophe part, numbers, and $ % + -."""
    return F.regexp_extract_all(_col(text), F.lit(lx.TOKEN), F.lit(0))


def lower_expand(text: Column | str) -> Column:
    """Lower case, then every n't that ends a word becomes " not"."""
    return F.regexp_replace(F.lower(_col(text)), lx.CONTRACTION, " not")


def mark_negation(tokens: Column | str) -> Column:
    """Join a negator with the token after it as ``not_<token>``; a last negator stays.

    Works on the joined tokens with one linear regex pass: tokens hold no blank, so matching
    "negator blank token" from the left consumes pairs exactly as a token scan would.
    """
    joined = F.array_join(_col(tokens), " ")
    marked = F.regexp_replace(
        joined, "(^| )(?:" + "|".join(lx.NEGATORS) + r") (\S+)", "$1not_$2"
    )
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(marked, " "))


def default_stop_words() -> list[str]:
    """Spark's English list without the negators. Pass another list to match other tools."""
    keep = set(lx.NEGATORS)
    return [w for w in StopWordsRemover.loadDefaultStopWords("english") if w not in keep]


def drop_stop_words(tokens: Column | str, stop_words: Sequence[str]) -> Column:
    # isin over literals is planned as a hash-set probe.
    words = list(stop_words)
    return F.filter(_col(tokens), lambda t: ~t.isin(*words)) if words else _col(tokens)


def lemmatise(tokens: Column | str, lemmas: Column) -> Column:
    """Replace tokens found in the ``map<string,string>`` column ``lemmas``."""
    return F.transform(_col(tokens), lambda t: F.coalesce(F.try_element_at(lemmas, t), t))


def preprocess_tokens(
    text: Column | str,
    *,
    negation: bool = True,
    stop_words: Sequence[str] | None = None,
    lemmas: Column | None = None,
    retokenize: bool = False,
) -> Column:
    """Lower, expand, tokenise, mark negation, drop stop words, lemmatise.

    ``retokenize`` splits the result by the token pattern again, which takes ``not_x`` apart into
    ``not`` and ``x`` the way a vectoriser with the same token pattern does.
    """
    tokens = tokenize(lower_expand(text))
    if negation:
        tokens = mark_negation(tokens)
    tokens = drop_stop_words(tokens, default_stop_words() if stop_words is None else stop_words)
    if lemmas is not None:
        tokens = lemmatise(tokens, lemmas)
    if retokenize:
        tokens = tokenize(F.array_join(tokens, " "))
    return tokens


def preprocess(text: Column | str, **options) -> Column:
    """``preprocess_tokens`` joined by single blanks."""
    return F.array_join(preprocess_tokens(text, **options), " ")


def lemmatise_with_table(df: DataFrame, tokens: str, lemma_table: DataFrame) -> DataFrame:
    """Lemmatise array column ``tokens`` from a (token, lemma) table of any size.

    Only the distinct tokens of a list that the table has travel, under a digest of the list, and come back to
    the rows as one small map; the rows themselves move once, and need no key of their own. Of several lemmas
    of a token the smallest counts. Null lists stay null.
    """
    table = lemma_table.filter("token is not null").groupBy("token").agg(F.min("lemma").alias("_lemma")).filter("_lemma is not null")
    # Tokens with their lengths before them, so that different lists have different texts.
    spelt = F.transform(tokens, lambda t: F.concat(F.char_length(t).cast("string"), F.lit(":"), t))
    # A key that is never null: a filter on it would build the lists once more.
    keyed = df.withColumn("_key", F.coalesce(F.sha2(F.array_join(spelt, ""), 256), F.lit("")))
    each = keyed.select("_key", F.explode_outer(F.array_distinct(tokens)).alias("token"))
    found = each.join(table, "token").groupBy("_key").agg(F.collect_set(F.struct("token", "_lemma")).alias("_pairs"))
    joined = keyed.join(found.select("_key", F.map_from_entries("_pairs").alias("_lemmas")), "_key", "left")
    changed = F.when(F.col("_lemmas").isNull(), F.col(tokens)).otherwise(lemmatise(tokens, F.col("_lemmas")))
    return joined.withColumn(tokens, changed).select(*df.columns)


def ngrams(tokens: Column | str, low: int = 1, high: int = 2) -> Column:
    """All n-grams of ``low`` to ``high`` tokens, shorter ones first, joined by blanks."""
    if not 1 <= low <= high:
        raise ValueError(f"bad n-gram range: {low}, {high}")
    tokens = _col(tokens)
    # Each n extends the (n-1)-grams by the token n-1 places further on: linear in the text.
    grams, parts = tokens, []
    for n in range(1, high + 1):
        if n > 1:
            rest = F.slice(tokens, F.lit(n), F.greatest(F.size(tokens), F.lit(1)))
            # Past the end the shorter list is padded with null, and concat makes the gram null.
            grams = F.zip_with(grams, rest, lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= low:
            parts.append(grams if n == 1 else F.filter(grams, lambda g: g.isNotNull()))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def has_number(text: Column | str) -> Column:
    return _col(text).rlike(lx.NUMBER)


def has_percent(text: Column | str) -> Column:
    return _col(text).rlike(lx.PERCENT)


def number_count(text: Column | str) -> Column:
    return F.size(F.regexp_extract_all(_col(text), F.lit(lx.NUMBER), F.lit(0)))


LEXICON_FEATURES = (
    "sentence_length",
    "financial_kw_count",
    "positive_kw_count",
    "negative_kw_count",
    "has_number",
    "has_percentage",
    "number_count",
    "negation_count",
)


def with_lexicon_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the eight lexicon features of ``text`` as double columns.

    Keyword counts are counts of distinct tokens. The token list is made once in its own
    projection and shared by the five features that need it.
    """
    tokens = F.col("_tokens")

    def hits(words):
        return F.size(F.array_intersect(tokens, _words(words)))

    features = {
        "sentence_length": F.size(tokens),
        "financial_kw_count": hits(lx.FINANCIAL),
        "positive_kw_count": hits(lx.POSITIVE),
        "negative_kw_count": hits(lx.NEGATIVE),
        "has_number": has_number(text),
        "has_percentage": has_percent(text),
        "number_count": number_count(text),
        "negation_count": hits(lx.NEGATION),
    }
    return (
        df.withColumn("_tokens", tokenize(F.lower(text)))
        .withColumns({k: v.cast("double") for k, v in features.items()})
        .drop("_tokens")
    )


def word_count(text: Column | str) -> Column:
    """Number of runs of non-blank characters."""
    return F.size(F.filter(F.split(_col(text), WHITESPACE), lambda w: w != ""))


def char_count(text: Column | str) -> Column:
    return F.char_length(_col(text))


def contains_any(text: Column | str, words: Sequence[str]) -> Column:
    """True when any word occurs in the text, ignoring case; an empty list passes everything."""
    if not words:
        return F.lit(True)
    lowered = F.lower(_col(text))
    found = F.lit(False)
    for word in words:
        found = found | lowered.contains(word.lower())
    return found
