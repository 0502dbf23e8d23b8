"""As-of joins on dates: union both sides and carry the last quote along each key's calendar.

One window pass per key, linear in days plus probes; no range or cartesian join. Probes are
distinct (key, date) pairs, so a key's window is bounded by the calendar even when the left side
holds most of its rows under one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_PROBE, _QUOTE, _DAY = "_probe", "_quote", "_day"


def _carry(
    probes: DataFrame,
    quotes: DataFrame,
    by: Sequence[str],
    probe_day: str,
    quote_day: str,
    payload: Sequence[str],
    *,
    forward: bool,
    exact: bool,
) -> DataFrame:
    """Every probe row with the struct of its quote (null when there is none).

    The keys stay columns of their own next to the probe struct: rows leave partitioned by them,
    so a following window or as-of join on the same keys needs no shuffle.
    """
    quote_struct = F.struct(F.col(quote_day).alias(_DAY), *payload)
    none_probe = F.lit(None).cast(probes.select(F.struct("*")).schema[0].dataType)
    none_quote = F.lit(None).cast(quotes.select(quote_struct).schema[0].dataType)
    # On equal dates the side sorted first is the one the other can, or cannot, see.
    probe_side, quote_side = (1, 0) if exact else (0, 1)
    left = probes.select(
        *by, F.col(probe_day).alias(_DAY), F.lit(probe_side).alias("_side"),
        F.struct("*").alias(_PROBE), none_quote.alias(_QUOTE),
    )
    right = quotes.filter(F.col(quote_day).isNotNull()).select(
        *by, F.col(quote_day).alias(_DAY), F.lit(quote_side).alias("_side"),
        none_probe.alias(_PROBE), quote_struct.alias(_QUOTE),
    )
    day = F.col(_DAY).desc() if forward else F.col(_DAY).asc()
    frame = (
        Window.partitionBy(*by)
        .orderBy(day, "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        left.unionByName(right)
        .withColumn(_QUOTE, F.last(_QUOTE, ignorenulls=True).over(frame))
        .filter(F.col(_PROBE).isNotNull())
        .select(*by, _PROBE, _QUOTE)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_day: str,
    right_day: str,
    payload: Sequence[str],
    *,
    direction: str = "backward",
    exact: bool = True,
    tolerance_days: int | None = None,
    matched_day: str | None = None,
    left_unique: bool = False,
) -> DataFrame:
    """``left`` plus the ``payload`` columns of the nearest ``right`` row of the same key.

    backward: latest right date before (``exact``: or on) the left date; forward: earliest after.
    Beyond ``tolerance_days`` the payload is null. All left rows are kept. ``left_unique`` says
    that (key, date) is already unique on the left, which saves joining the matches back.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction!r}")
    by = [by] if isinstance(by, str) else list(by)
    payload = list(payload)
    if left_unique:
        probes = left
    else:
        probes = left.select(*by, left_day).filter(F.col(left_day).isNotNull()).distinct()
    carried = _carry(
        probes, right, by, left_day, right_day, payload,
        forward=direction == "forward", exact=exact,
    )
    found = F.col(_QUOTE)[_DAY]
    usable = F.col(f"{_PROBE}.{left_day}").isNotNull()
    if tolerance_days is not None:
        gap = F.abs(F.datediff(F.col(f"{_PROBE}.{left_day}"), found))
        usable = usable & (gap <= tolerance_days)
    outputs = [F.when(usable, F.col(_QUOTE)[c]).alias(c) for c in payload]
    if matched_day is not None:
        outputs.append(F.when(usable, found).alias(matched_day))
    kept = [c if c in by else F.col(_PROBE)[c].alias(c) for c in probes.columns]
    matches = carried.select(*kept, *outputs)
    return matches if left_unique else left.join(matches, [*by, left_day], "left")
