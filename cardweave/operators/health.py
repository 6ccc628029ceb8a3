"""Rolling failure rate over a log of service calls."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from cardweave.storage import stage

# The window in calls and the failure rate that flags a service.
WINDOW_CALLS = 10
FAILURE_THRESHOLD = 0.5


def call_health(
    calls: DataFrame,
    service: Column,
    order: list[str],
    failed: Column,
    window_calls: int = WINDOW_CALLS,
    threshold: float = FAILURE_THRESHOLD,
    slices: int | None = None,
) -> DataFrame:
    """Failure rate of the last ``window_calls`` calls of each service, at every call.

    A service may own any share of the log, so it is not windowed as one group. The
    calls are cut into slices at quantiles of the first of ``order`` (a number, date or time), and where one value of it
    fills a slice or more, at quantiles of the next among the calls with that value. They are
    windowed slice by slice, after one exchange. Only the first ``window_calls - 1`` calls of a slice look further
    back; they are windowed again among the first and last calls of all slices, which
    are ``2 * (window_calls - 1)`` rows per slice, however long the log. ``order`` must
    be unique within a service. ``flagged`` needs a full window.
    """
    rows = calls.select(service.alias("service"), *order, failed.cast("int").alias("_failed"))
    windowed, edges = _windowed(rows, order, window_calls, slices)
    whole = windowed.filter("NOT _first").unionByName(edges.filter("_first"))
    return _judged(whole, order, window_calls, threshold)


def continued_health(
    tail: DataFrame,
    calls: DataFrame,
    service: Column,
    order: list[str],
    failed: Column,
    window_calls: int = WINDOW_CALLS,
    threshold: float = FAILURE_THRESHOLD,
    slices: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`call_health` of the calls that follow a ``tail``, and the tail for those that follow them.

    A tail (service, the columns of ``order``, _failed) holds the last ``window_calls - 1`` calls of each
    service; an empty one starts a log. No call may come before the last of an earlier part.
    """
    reach = window_calls - 1
    new = calls.select(service.alias("service"), *order, failed.cast("int").alias("_failed"), F.lit(True).alias("_new"))
    rows = new.unionByName(tail.withColumn("_new", F.lit(False)))
    windowed, edges = _windowed(rows, order, window_calls, slices)
    whole = windowed.filter("NOT _first").unionByName(edges.filter("_first"))
    back = Window.partitionBy("service").orderBy(F.desc("_slice"), *[F.desc(c) for c in order])
    last = edges.filter("_last").withColumn("_back", F.row_number().over(back)).filter(F.col("_back") <= reach)
    return _judged(whole.filter("_new"), order, window_calls, threshold), last.select("service", *order, "_failed")


def _windowed(rows: DataFrame, order: list[str], window_calls: int, slices: int | None) -> tuple[DataFrame, DataFrame]:
    """All calls windowed within their slices, and the first and last calls of slices windowed across."""
    reach = window_calls - 1
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("_slice", _slice(rows, order, slices))
    in_slice = Window.partitionBy("service", "_slice").orderBy(*order)
    windowed = stage(
        ranged.withColumns(
            {
                **_recent(in_slice.rowsBetween(-reach, 0)),
                "_first": F.row_number().over(in_slice) <= reach,
                "_last": F.lead(F.lit(1), reach).over(in_slice).isNull(),
            }
        ),
        "calls",
    )
    across = Window.partitionBy("service").orderBy("_slice", *order).rowsBetween(-reach, 0)
    return windowed, windowed.filter("_first OR _last").withColumns(_recent(across))


def _slice(rows: DataFrame, order: list[str], slices: int) -> Column:
    """Which slice a call is in: a number for each column of ``order``, so that slices follow each other as calls do."""
    parts, tied = [], [((), slices)]
    for depth in range(len(order)):
        if slices < 2 or not tied:
            break
        part, tied = _cut(rows, order[:depth], order[depth], tied, slices)
        parts.append(part)
    return F.struct(*[p.alias(f"s{i}") for i, p in enumerate(parts)] or [F.lit(0).alias("s0")])


def _cut(rows: DataFrame, before: list[str], column: str, tied: list[tuple], slices: int) -> tuple[Column, list[tuple]]:
    """The slice among calls with equal values ``before``, for those ``tied`` (values, number of slices), and what is still tied."""
    kinds = dict(rows.dtypes)
    if kinds[column] in ("string", "binary", "boolean"):
        return F.lit(0), []  # no quantiles
    # A collected time without a zone keeps none.
    literal = lambda c, v: F.lit(str(v)).cast(kinds[c]) if kinds[c] == "timestamp_ntz" and v is not None else F.lit(v)
    same = lambda values: reduce(and_, [F.col(c).eqNullSafe(literal(c, v)) for c, v in zip(before, values)], F.lit(True))
    own = rows.filter(reduce(or_, [same(values) for values, _ in tied]))
    quantiles = F.percentile_approx(column, [k / slices for k in range(1, slices)], 100 * slices)
    found = own.groupBy(*before).agg(quantiles.alias("_cuts"), F.count_if(F.col(column).isNull()).alias("_nulls"), F.count("*").alias("_rows"))
    by_values = {tuple(r[c] for c in before): r for r in found.collect()}  # at most as many rows as there are slices
    number, still = F.lit(0), []
    for values, share in tied:
        row = by_values.get(values)
        if row is None:
            continue
        step = max(1, slices // share)
        cuts = sorted((row["_cuts"] or [])[step - 1 :: step])
        # A value that is a quantile twice fills a slice: it gets slices of its own.
        heavy = [v for v, n in Counter(cuts).items() if n > 1]
        tests = [F.col(column) > literal(column, v) for v in sorted(set(cuts))] + [F.col(column) >= literal(column, v) for v in heavy]
        # Nulls come first in the order.
        tests = [F.coalesce(t, F.lit(False)).cast("int") for t in [F.col(column).isNotNull(), *tests]]
        number = F.when(same(values), F.aggregate(F.array(*tests), F.lit(0), lambda a, x: a + x)).otherwise(number)
        still += [((*values, v), cuts.count(v) + 1) for v in heavy]
        nulls = row["_nulls"] * share // max(1, row["_rows"])
        still += [((*values, None), nulls + 1)] if nulls else []
    return number, still


def _judged(windowed: DataFrame, order: list[str], window_calls: int, threshold: float) -> DataFrame:
    full = F.col("window_size") == window_calls
    return windowed.select(
        "service",
        *order,
        "window_size",
        "failures",
        (F.col("failures") / F.col("window_size")).alias("failure_rate"),
        (full & (F.col("failures") >= threshold * F.col("window_size"))).alias("flagged"),
    )


def _recent(window: WindowSpec) -> dict[str, Column]:
    return {"failures": F.sum("_failed").over(window), "window_size": F.count("*").over(window)}
