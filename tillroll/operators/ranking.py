"""Rank selection: quantiles and ``ntile`` buckets without a sort.

A quartile needs a handful of cut points, not a total order. Each wanted rank
starts with the whole range of its column. One grouped count splits every open
range into ``BINS`` equal parts; the part that holds the rank, cut down to the
smallest and largest value found in it, is the next range. A range is done when
it holds a single value. Rows that share a cut value are told apart in the same
way by a unique text key, split by the two characters after the prefix common
to the range.

Every round is one aggregate with map-side combine over a table written once.
Its result has at most ``BINS`` rows (for texts, the square of the alphabet)
for each wanted rank, however large the input or its ties; only these counts
reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Hashable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tillroll.session import materialize, scratch_scope

BINS = 1024


@dataclass(frozen=True)
class Span:
    """Rows whose ``column`` lies in ``[low, high]``, after ``below`` smaller
    ones; with ``tied`` only rows where that column has that value."""

    column: str
    low: float | str
    high: float | str
    below: int
    rows: int
    tied: tuple[str, float] | None = None

    def holds(self) -> Column:
        inside = F.col(self.column).between(self.low, self.high)
        return inside & (F.col(self.tied[0]) == self.tied[1]) if self.tied else inside

    def part(self) -> Column:
        """Key of the part a value lies in; grows with the value, and differs
        between ``low`` and ``high``."""
        value = F.col(self.column)
        if isinstance(self.low, str):
            return F.substring(value, 1, len(commonprefix([self.low, self.high])) + 2)
        share = (value - self.low) / (self.high - self.low)
        return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("string")


def bounded_rows(df: DataFrame) -> list[Row]:
    """Rows of an aggregate whose size is bounded as the module describes."""
    return df.collect()


def _parts(df: DataFrame, spans: Sequence[Span]) -> dict[int, list[Row]]:
    """For each span its parts that hold rows, in ascending order."""
    members = [
        F.when(
            s.holds(),
            F.struct(F.lit(k).alias("span"), s.part().alias("part"), F.col(s.column).alias("v")),
        )
        for k, s in enumerate(spans)
    ]
    hits = df.where(reduce(or_, [s.holds() for s in spans])).select(
        F.inline(F.array_compact(F.array(*members)))
    )
    counted = hits.groupBy("span", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    found: dict[int, list[Row]] = {k: [] for k in range(len(spans))}
    for row in sorted(bounded_rows(counted), key=lambda r: r.low):
        found[row.span].append(row)
    return found


def _narrow(
    df: DataFrame, wanted: Mapping[Hashable, tuple[int, Span]], rank_error: int = 0
) -> dict[Hashable, Span]:
    """The span of one value (or of at most ``rank_error`` rows) at each wanted
    1-based rank of its starting span."""
    ranks = {target: rank for target, (rank, _) in wanted.items()}
    spans = {target: span for target, (_, span) in wanted.items()}
    while True:
        open_ = list({s for s in spans.values() if s.low < s.high and s.rows > rank_error})
        if not open_:
            return spans
        found = _parts(df, open_)
        for target, span in spans.items():
            if span not in open_:
                continue
            below = span.below
            for part in found[open_.index(span)]:
                if ranks[target] <= below + part.n:
                    spans[target] = Span(
                        span.column, part.low, part.high, below, part.n, span.tied
                    )
                    break
                below += part.n


def select_ranks(
    df: DataFrame,
    columns: Sequence[str],
    ranks: Callable[[int], Sequence[int]],
    rank_error: float = 0.0,
) -> tuple[int, dict[tuple[str, int], Span]]:
    """Row count n of ``df`` and, for every column and each of ``ranks(n)``, the
    span of the value at that 1-based ascending rank.

    The columns are doubles, finite and not null. ``df`` is read once a round,
    so it should be a written table. With ``rank_error`` a span may hold
    several values, but at most that share of the rows.
    """
    head = bounded_rows(
        df.agg(
            F.count(F.lit(1)).alias("n"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)],
        )
    )[0]
    n = head["n"]
    wanted = {}
    for c in columns if n else ():
        low, high = head[f"min_{c}"], head[f"max_{c}"]
        if not (math.isfinite(low) and math.isfinite(high)):
            raise ValueError(f"{c} holds values that are not finite")
        wanted |= {(c, r): (r, Span(c, low, high, 0, n)) for r in ranks(n)}
    return n, _narrow(df, wanted, math.floor(rank_error * n))


def with_ntiles(
    df: DataFrame,
    tiles: Mapping[str, tuple[str, bool]],
    tiebreak: str,
    buckets: int = 4,
) -> DataFrame:
    """Add, for each ``name: (column, descending)``, column ``name`` =
    ``ntile(buckets)`` over that order of the column and then ``tiebreak``
    ascending, a unique text. The first ``n % buckets`` buckets hold one row more.

    One written table, the selection rounds, and one map over the table against
    the cut points; ties at a cut, of any number, are counted and never sorted.
    """
    if not tiles:
        return df
    keys = {name: f"_key{i}" for i, name in enumerate(tiles)}
    table = materialize(
        df.withColumns(
            {
                keys[name]: F.col(c).cast("double") * (-1.0 if descending else 1.0)
                for name, (c, descending) in tiles.items()
            }
        ),
        "ntile-input",
    )

    def last_of_buckets(n: int) -> list[int]:
        ends = [k * (n // buckets) + min(k, n % buckets) for k in range(1, buckets)]
        return sorted({e for e in ends if e < n})

    _, cuts = select_ranks(table, list(keys.values()), last_of_buckets)
    texts = _tied_texts(table, tiebreak, cuts)
    added = {}
    for name, key in keys.items():
        after = F.lit(1)
        for (column, rank), span in cuts.items():
            if column == key:
                beyond = F.col(key) > span.low
                if (column, rank) in texts:
                    same = F.col(key) == span.low
                    beyond = beyond | (same & (F.col(tiebreak) > texts[column, rank]))
                after = after + F.when(beyond, 1).otherwise(0)
        added[name] = after.cast("int")
    return table.withColumns(added).drop(*keys.values())


def _tied_texts(
    table: DataFrame, tiebreak: str, cuts: Mapping[tuple[str, int], Span]
) -> dict[tuple[str, int], str]:
    """For each cut that falls inside a run of equal values, the last text before it."""
    inside = {t: s for t, s in cuts.items() if t[1] < s.below + s.rows}
    if not inside:
        return {}
    ends = bounded_rows(table.agg(F.min(tiebreak).alias("low"), F.max(tiebreak).alias("high")))[0]
    wanted = {
        t: (t[1] - s.below, Span(tiebreak, ends.low, ends.high, 0, s.rows, (s.column, s.low)))
        for t, s in inside.items()
    }
    return {t: s.high for t, s in _narrow(table, wanted).items()}


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    rank_error: float = 0.0,
) -> DataFrame:
    """Quantiles of ``value`` as rows ``(metric, value)`` in ``probs`` order.

    With ``rank_error`` 0 they are exact, interpolated between the two nearest
    rows (``quantile_cont``). Otherwise each is a value whose rank is off from
    ``ceil(p * n)`` by at most ``rank_error * n``. NULL values are ignored; an
    empty input gives NULL values. The written table is deleted on return.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])

    def positions(n: int, p: float) -> tuple[int, int]:
        if rank_error:
            return (max(1, math.ceil(p * n)),) * 2
        at = float(n - 1) * float(p)
        return math.floor(at) + 1, math.ceil(at) + 1

    with scratch_scope(df.sparkSession):
        table = materialize(
            df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL"),
            "quantile-input",
        )
        n, spans = select_ranks(
            table, ["v"], lambda n: sorted({r for p in probs for r in positions(n, p)}), rank_error
        )
    found = []
    for p in probs if n else ():
        low, high = (spans["v", r].low for r in positions(n, p))
        at = float(n - 1) * float(p)
        found.append(low + (high - low) * (at - math.floor(at)))
    found = found or [None] * len(names)
    row = df.sparkSession.range(1).select(
        *[F.lit(v).cast("double").alias(name) for name, v in zip(names, found)]
    )
    return row.unpivot([], names, "metric", "value")
