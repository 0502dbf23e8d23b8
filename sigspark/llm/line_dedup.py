"""Line dedup by overlapping windows of consecutive lines; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

WINDOW_LINES = 3
BLANK = " \t\r"


def _lines(text: str = "text") -> Column:
    return F.split(text, "\n", -1)


def windows(rows: DataFrame, lines: int = WINDOW_LINES) -> DataFrame:
    """(did, th, at, digest): each run of ``lines`` consecutive non-blank lines of a document.

    ``at`` has the indexes of its lines among all lines; lines are compared without the blanks
    around them, by a 128-bit digest."""
    trimmed = F.transform(_lines(), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(BLANK)).alias("x")))
    full = F.filter(trimmed, lambda s: s["x"] != "")
    several = rows.select("did", "th", full.alias("l")).filter(F.size("l") >= lines)
    starts = F.sequence(F.lit(0), F.size("l") - F.lit(lines))
    parts = F.transform(
        starts,
        lambda i: F.struct(
            F.transform(F.slice("l", i + 1, F.lit(lines)), lambda s: s["i"]).alias("at"),
            F.unhex(
                F.md5(F.array_join(F.transform(F.slice("l", i + 1, F.lit(lines)), lambda s: s["x"]), "\n"))
            ).alias("digest"),
        ),
    )
    return several.select("did", "th", F.explode(parts).alias("w")).select("did", "th", "w.at", "w.digest")


def remove_repeated_lines(docs: DataFrame, lines: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with lines of repeated windows removed from ``text``, and ``n_lines``, ``n_removed``.

    A window is three (``lines``) consecutive non-blank lines. Of equal windows the first stays, by
    document id (null first), then text hash and place; the lines that any later one covers are
    removed. Blank lines stay. Texts without a removed line are unchanged; a text that loses all its
    lines is empty. A null text stays null and has no lines, an empty one has one line. Rows that
    repeat an id and text count as one document, so both keep or lose the same lines. Columns of
    ``docs`` other than doc_id and text pass through, except ones named n_lines, n_removed or _gone,
    which are replaced; an empty table gives no rows.
    """
    did, th = c.row_key()
    rows = docs.drop("n_lines", "n_removed", "_gone", "_did", "_th").withColumns({"_did": did, "_th": th})
    found = c.store(windows(rows.select(F.col("_did").alias("did"), F.col("_th").alias("th"), "text").filter("text is not null"), lines))
    place = F.struct("did", "th", "at")
    first = (
        found.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("digest", "first")
    )
    gone = (
        found.join(first, "digest")
        .filter(place != F.col("first"))
        .groupBy(F.col("did").alias("_did"), F.col("th").alias("_th"))
        .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("_gone"))
    )
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines()))
    places = F.sequence(F.lit(0), F.size(_lines()) - 1)
    # The lines and the places that stay are one struct, so that a text is split once and not once a line.
    both = F.array(F.struct(_lines().alias("lines"), F.array_except(places, "_gone").alias("stay")))
    joined = F.transform(both, lambda s: F.array_join(F.transform(s["stay"], lambda i: F.get(s["lines"], i)), "\n"))
    kept = F.get(joined, F.lit(0))
    out = rows.join(gone, ["_did", "_th"], "left").withColumns(
        {
            "n_lines": count.cast("long"),
            "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
            "text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept),
        }
    )
    return out.select(*[k for k in rows.columns if k not in ("_did", "_th")], "n_lines", "n_removed")


SQL = """
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {docs}),
full_lines AS (SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13)) AS x FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
three AS (SELECT doc_id, i, lead(i) OVER w AS j, lead(i, 2) OVER w AS k,
    x || chr(10) || lead(x) OVER w || chr(10) || lead(x, 2) OVER w AS win FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS turn FROM three WHERE k IS NOT NULL) WHERE turn > 1),
gone AS (SELECT DISTINCT doc_id, unnest([i, j, k]) AS i FROM later),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
    coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '') AS text
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, k.text AS text
FROM {docs} d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
