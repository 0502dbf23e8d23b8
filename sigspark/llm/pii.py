"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built-in functions only. ``split`` and ``regexp_extract_all`` with one pattern give the texts
between and of its matches; a running sum of their lengths, in code points, gives the places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CONTEXT_CHARS = 48
# What a proposal keeps of the text on its sides: the context, and the rest of an account number.
KEPT_CHARS = CONTEXT_CHARS + 72
# Matches of a kind that can lie within KEPT_CHARS on one side of another.
NEIGHBOURS = 40
ACCEPT = 0.5
BOOST = 0.35


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number, blanks ignored, leaves 1 modulo 97 (letters count from 10)."""
    plain = F.regexp_replace(code, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        symbol = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(symbol < 65, (rest * 10 + symbol - 48) % 97).otherwise((rest * 100 + symbol - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _length_of(hit: Column, low: int, high: int) -> Column:
    return F.length(_digits(hit)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``confirm`` decides, ``words`` near a span raise its score by BOOST.

    A match takes up the first ``head`` characters of its span, or all; another may begin after them.
    ``maybe`` is a cheap test that every text with a match passes. Patterns that could start inside
    a run of their own characters say where a match may begin: the first character of the run or
    the end of the last match, which is where the leftmost match begins anyway."""

    name: str
    pattern: str
    maybe: str
    score: float
    words: str
    head: int | None = None

    def confirm(self, hit: Column) -> Column:
        if self.name == "ip":
            part = "0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]|(?=[.]|$))"
            return hit.rlike(rf"^{part}(\.{part}){{3}}$")
        if self.name == "card":
            return F.when(_length_of(hit, 14, 19), luhn(_digits(hit))).otherwise(False)
        if self.name == "phone":
            return _length_of(hit, 10, 15)
        if self.name == "iban":
            return mod97(hit)
        return F.lit(True)


# The base patterns are those of the query's contract, with possessive repeats.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.8,
        "mail|contact|kontakt|write|correo",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        0.6,
        r"\bip\b|address|server|host|login",
    ),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "[0-9]", 0.7, "card|visa|credit|karte|carte|tarjeta|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobile|fax|anruf"),
)
# Countries by the length of their account numbers.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
ADDED = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])(?=((?:%s)(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}"
        % "|".join(
            rf"(?:{'|'.join(of.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, of in IBAN_LENGTHS.items()
        ),
        "[A-Z]{2}[0-9]{2}",
        0.7,
        "iban|account|konto|bank|cuenta|compte",
        4,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "[0-9]-[0-9]{2}-[0-9]",
        0.3,
        r"\bssn\b|social security|tax id",
    ),
)
KINDS = BASE + ADDED


PROPOSAL = "struct<kind:int,gap:bigint,used:bigint,hit:string,before:string,after:string>"


def _proposals(kind: Kind, order: int) -> Column:
    """Matches of a kind in a text with the ends of the texts before and after each; empty if the cheap
    test fails."""
    text = F.col("_text")
    maybe = F.contains(text, F.lit("@")) if kind.maybe == "@" else text.rlike(kind.maybe)
    between = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.head else 0))
    after = F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0)))

    def proposal(gap: Column, pair: Column) -> Column:
        hit = pair["hit"]
        return F.struct(
            F.lit(order).alias("kind"),
            F.length(gap).cast("long").alias("gap"),
            (F.lit(kind.head) if kind.head else F.length(hit)).cast("long").alias("used"),
            hit.alias("hit"),
            F.right(gap, F.lit(KEPT_CHARS)).alias("before"),
            F.left(pair["after"], F.lit(KEPT_CHARS)).alias("after"),
        )

    # The last gap follows the last match and has no hit of its own.
    pairs = F.zip_with(hits, after, lambda h, t: F.struct(h.alias("hit"), t.alias("after")))
    every = F.filter(F.zip_with(between, pairs, proposal), lambda p: p["hit"].isNotNull())
    return F.when(maybe, every).otherwise(F.array().cast(f"array<{PROPOSAL}>"))


def _case(values: list, otherwise) -> Column:
    out = F.lit(otherwise)
    for i, value in enumerate(values):
        out = F.when(F.col("kind") == i, value).otherwise(out)
    return out


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): personal data of each row, by start and kind.

    A span has kind (name), start and end in code points (end exclusive), text, score and whether it
    is one of the base kinds. Base kinds need their checks only; the added ones (account numbers
    that pass mod 97, social security numbers) need a score of ACCEPT, which nearby words raise:
    words in the CONTEXT_CHARS of the text on either side, or near another match of the kind in the
    same list (no letter between neighbours).
    Spans of different kinds may overlap. A null or empty text has no spans; rows that repeat are
    answered each; a null id stays null. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
        F.monotonically_increasing_id().alias("row"),
    )
    proposals = F.concat(*[_proposals(k, i) for i, k in enumerate(KINDS)])
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        rows.select("row", "doc_id", F.posexplode_outer(proposals).alias("i", "p"))
        .select("row", "doc_id", "i", "p.*")
        .repartition(partitions, "row")
    )
    each = Window.partitionBy("row", "kind").orderBy("i")
    done = each.rowsBetween(Window.unboundedPreceding, 0)
    used_end = F.sum(F.col("gap") + F.col("used")).over(done)
    hit = F.col("hit")
    # The text on both sides, whatever matches lie in it.
    head = F.left("hit", F.col("used").cast("int"))
    earlier = F.collect_list(F.right(F.concat("before", head), F.lit(KEPT_CHARS))).over(each.rowsBetween(-NEIGHBOURS, -1))
    later = F.collect_list(F.left(F.concat(head, "after"), F.lit(KEPT_CHARS))).over(each.rowsBetween(1, NEIGHBOURS))
    left = F.right(F.concat(F.array_join(earlier, ""), "before"), F.lit(CONTEXT_CHARS))
    right = F.substring(
        F.concat("after", F.array_join(later, "")), (F.length("hit") - F.col("used") + 1).cast("int"), F.lit(CONTEXT_CHARS)
    )
    near = _case([F.lower("left").rlike(k.words) | F.lower("right").rlike(k.words) for k in KINDS], False)
    apart = (F.col("gap") > CONTEXT_CHARS) | F.col("before").rlike(r"\p{L}")
    checked = (
        found.withColumn("used_end", used_end)
        .withColumn("start", F.col("used_end") - F.col("used"))
        .withColumn("end", F.col("start") + F.length("hit"))
        .withColumn("left", left)
        .withColumn("right", right)
        .withColumn("list", F.sum(F.when(apart, 1).otherwise(0)).over(done))
        .withColumn("near", F.max(near).over(Window.partitionBy("row", "kind", "list")))
        .withColumn("valid", _case([k.confirm(hit) for k in KINDS], False))
        .withColumn("score", _case([F.lit(k.score) for k in KINDS], 0.0) + F.when(F.col("near"), BOOST).otherwise(0.0))
        .withColumn("base", F.col("kind") < len(BASE))
    )
    span = F.struct(
        "start",
        "kind",
        _case([F.lit(k.name) for k in KINDS], "").alias("name"),
        "end",
        hit.alias("text"),
        F.least("score", F.lit(1.0)).alias("score"),
        "base",
    )
    good = F.col("valid") & (F.col("base") | (F.col("score") >= ACCEPT))
    spans = F.sort_array(F.collect_list(F.when(good, span)))
    return checked.groupBy("row").agg(F.first("doc_id").alias("doc_id"), spans.alias("spans")).select(
        "doc_id",
        F.transform(
            "spans",
            lambda s: F.struct(
                s["name"].alias("kind"), s["start"], s["end"], s["text"], s["score"], s["base"]
            ),
        ).alias("spans"),
    )


def notation(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
