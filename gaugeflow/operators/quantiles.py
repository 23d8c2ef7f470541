"""Exact quantiles of many columns, per group, with one algorithm at every size.

1. One wide aggregate takes a KLL sketch of every column, its count and its ends. The sketch brackets each wanted rank by
   two values.
2. One wide aggregate counts, for each bracket, the rows below it, at its lower end and up to its upper end, and sketches
   the values strictly inside. Brackets are narrowed until few values are left inside. Small tables skip this step.
3. One wide aggregate counts the same and gathers the few values inside, among which the rank is looked up.

Steps 2 and 3 count all rows in compiled code, and sketch or gather only the rows inside a bracket.

Rows are never multiplied: a column is an expression of the aggregate, brackets are literals or, per group, columns of a
joined table. Sketches merge, so each aggregate is partial before its shuffle and no task holds a column or a hot group.
The ends of a bracket are counted apart, so a value shared by a third of all rows is an end, never a crowd inside.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.scalars import quoted
from gaugeflow.storage import materialise, pin_small

#: Size of the sketches, for whole tables and per group, and their rank error at 99 % confidence.
SKETCH, GROUP_SKETCH = 4096, 1024
#: Values strictly inside a bracket that may be gathered.
INSIDE_VALUES = 8192
#: Steps of the grid that reads a sketch of inner values.
GRID = 1000
APPROX_ACCURACY = 20_000


def rank_error(size: int) -> float:
    return 2.3 / size**0.9


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    mode: str = "exact",
    inside_values: int = INSIDE_VALUES,
    sketch: int | None = None,
) -> tuple[DataFrame, bool]:
    """One row per group with ``columns`` holding arrays of the quantiles at ``probs`` (null if no value).

    Ranks are interpolated linearly between the two neighbours. Nulls and NaN are no values. ``mode="approx"`` takes one
    pass with a bounded error. The second result tells whether the table was checked to be small enough to broadcast.
    """
    if mode == "approx":
        aggs = [
            F.percentile_approx(quoted(c).cast("double"), list(probs), APPROX_ACCURACY).alias(c) for c in columns
        ]
        return pin_small(df.groupBy(*[quoted(b) for b in by]).agg(*aggs))
    keys = [f"k{i}" for i in range(len(by))]
    values = df.select(*[quoted(b).alias(k) for b, k in zip(by, keys)], *[
        F.nanvl(quoted(c).cast("double") + F.lit(0.0), F.lit(None)).alias(f"v{i}") for i, c in enumerate(columns)  # -0.0 is 0.0
    ])
    search = _Search(values, keys, len(columns), probs, inside_values, sketch or (GROUP_SKETCH if by else SKETCH))
    found = search.run()
    return pin_small(found.select(
        *[F.col(k).alias(b) for k, b in zip(keys, by)], *[F.col(f"q{i}").alias(c) for i, c in enumerate(columns)]
    ))


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], mode: str = "exact"
) -> dict[str, list[float] | None]:
    """Ungrouped quantiles as plain numbers: a result of fixed size, used as literals in projections."""
    if not columns:
        return {}
    row = quantiles(df, columns, probs, mode=mode)[0].first()
    return {c: row[c] for c in columns}


class _Search:
    """Brackets of every column and probability: a table with one row per group and columns ``l{i}_{j}``, ``h{i}_{j}``."""

    def __init__(self, values: DataFrame, keys: list[str], columns: int, probs: Sequence[float], limit: int, size: int):
        self.values, self.keys, self.limit, self.size = values, keys, limit, size
        self.columns, self.probs = range(columns), list(probs)
        self.inner = [j for j, p in enumerate(probs) if 0.0 < p < 1.0]  # the ends need no search
        self.spots = [(i, j) for i in self.columns for j in self.inner]
        self.error = 2 * rank_error(size)

    def rank(self, i: int, j: int) -> Column:
        return (F.col(f"n{i}") - 1) * F.lit(float(self.probs[j]))

    def started(self) -> DataFrame:
        aggs = [
            agg.alias(f"{name}{i}") for i in self.columns for name, agg in (
                ("n", F.count(f"v{i}")), ("a", F.min(f"v{i}")), ("z", F.max(f"v{i}")),
                *((("s", F.kll_sketch_agg_double(f"v{i}", F.lit(self.size))),) if self.inner else ()),
            )
        ]
        wide = self.values.groupBy(*self.keys).agg(*aggs)
        kept = [*self.keys, *[f"{x}{i}" for i in self.columns for x in "naz"]]
        if not self.inner:
            return materialise(wide.select(*kept), "quantile-brackets")
        ranks = [max(0.0, self.probs[j] - self.error) for j in self.inner]
        ranks += [min(1.0, self.probs[j] + self.error) for j in self.inner]
        read = wide.select(*kept, *[
            F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, ranks)))).alias(f"e{i}")
            for i in self.columns
        ])
        ends = []
        for i in self.columns:
            for at, j in enumerate(self.inner):
                low, high = F.col(f"e{i}")[at], F.col(f"e{i}")[len(self.inner) + at]
                few = F.col(f"n{i}") * self.error < 1  # a rank next to an end
                ends += [F.when(few | F.lit(ranks[at] <= 0), F.col(f"a{i}")).otherwise(low).alias(f"l{i}_{j}"),
                         F.when(few | F.lit(ranks[len(self.inner) + at] >= 1), F.col(f"z{i}")).otherwise(high).alias(f"h{i}_{j}")]
        return materialise(read.select(*kept, *ends), "quantile-brackets")

    def measured(self, brackets: DataFrame, gather: bool) -> DataFrame:
        """Brackets with the rows below each (b), at its lower end (t), strictly inside (w) and up to its upper end (u).

        And the inner values: all of a column together if they are gathered (x), else one sketch (s) per bracket.
        """
        ends = [f"{x}{i}_{j}" for i, j in self.spots for x in "lh"]
        if self.keys:
            kept, small = pin_small(brackets.select(*self.keys, *ends), "quantile-brackets")
            side = kept.toDF(*[f"o_{k}" for k in self.keys], *ends)
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"o_{k}"))
            rows, end = self.values.join(F.broadcast(side) if small else side, same), F.col
        else:
            numbers = brackets.select(*ends).first()
            rows, end = self.values, lambda name: F.lit(numbers[name]).cast("double")
        counts, gathered, anywhere = [], [], F.lit(False)
        for i in self.columns:
            v, any_inside = F.col(f"v{i}"), F.lit(False)
            for j in self.inner:
                low, high = end(f"l{i}_{j}"), end(f"h{i}_{j}")
                inside = (v > low) & (v < high)
                any_inside = any_inside | inside
                counts += [F.count_if(v < low).alias(f"b{i}_{j}"), F.count_if(v == low).alias(f"t{i}_{j}"),
                           F.count_if(inside).alias(f"w{i}_{j}"), F.count_if(v <= high).alias(f"u{i}_{j}")]
                if not gather:
                    gathered.append(F.kll_sketch_agg_double(F.when(inside, v), F.lit(self.size)).alias(f"s{i}_{j}"))
            if gather:
                gathered.append(F.collect_list(F.when(any_inside, v)).alias(f"x{i}"))
            anywhere = anywhere | F.coalesce(any_inside, F.lit(False))
        # Counting all rows is compiled code; sketches and lists are not, so they get the few rows inside alone.
        counted, inner = rows.groupBy(*self.keys).agg(*counts), rows.where(anywhere).groupBy(*self.keys).agg(*gathered)
        if not self.keys:
            one = brackets.first().asDict()
            return counted.crossJoin(inner).select(
                "*", *[F.lit(one[c]).cast(brackets.schema[c].dataType).alias(c) for c in brackets.columns]
            )
        found = self.beside(counted, inner, "left")
        if gather:  # a group without a value inside has an empty list
            found = found.withColumns({
                f"x{i}": F.coalesce(F.col(f"x{i}"), F.array().cast("array<double>")) for i in self.columns
            })
        return self.beside(found, brackets, "inner")

    def beside(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Two tables with one row per group, joined on the group; a missing key is a group, too."""
        other = right.toDF(*[f"o_{c}" if c in self.keys else c for c in right.columns])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"o_{k}"))
        return left.join(other, same, how).drop(*[f"o_{k}" for k in self.keys])

    def holds(self, i: int, j: int) -> Column:
        """True where both neighbours of the rank are known to lie within the bracket."""
        rank = self.rank(i, j)
        inside = (F.col(f"b{i}_{j}") <= F.floor(rank)) & (F.ceil(rank) < F.col(f"u{i}_{j}"))
        return (F.col(f"n{i}") == 0) | inside

    def narrowed(self, measured: DataFrame, error: float) -> DataFrame:
        grid = F.array(*[F.lit(g / GRID) for g in range(GRID + 1)])
        ends = []
        for i, j in self.spots:
            rank, inner = self.rank(i, j), F.col(f"w{i}_{j}")
            before = F.col(f"b{i}_{j}") + F.col(f"t{i}_{j}")
            first = F.floor(((F.floor(rank) - before) / inner - error) * GRID).cast("int")
            last = F.ceil(((F.ceil(rank) - before + 1) / inner + error) * GRID).cast("int")
            read = F.kll_sketch_get_quantile_double(f"s{i}_{j}", grid)
            wide = inner > self.limit
            low, high = F.col(f"l{i}_{j}"), F.col(f"h{i}_{j}")
            ends += [
                F.when(~self.holds(i, j), F.col(f"a{i}")).when(wide & (first > 0), read[F.least(first, F.lit(GRID))])
                .otherwise(low).alias(f"l{i}_{j}"),
                F.when(~self.holds(i, j), F.col(f"z{i}")).when(wide & (last < GRID), read[F.greatest(last, F.lit(0))])
                .otherwise(high).alias(f"h{i}_{j}"),
            ]
        kept = [*self.keys, *[f"{x}{i}" for i in self.columns for x in "naz"]]
        return materialise(measured.select(*kept, *ends), "quantile-brackets")

    def run(self) -> DataFrame:
        brackets = self.started()
        if not self.spots:
            return self.looked_up(brackets)
        most = brackets.agg(F.max(F.greatest(F.lit(0), *[F.col(f"n{i}") for i in self.columns]))).first()[0] or 0
        crowd, error = 2 * self.error * most, self.error  # rows that may lie inside a bracket
        before = math.inf
        while True:
            if crowd <= self.limit:
                measured = materialise(self.measured(brackets, True), "quantiles")
                if not measured.where(~self.all_of(self.holds)).limit(1).count():
                    return self.looked_up(measured)
                error *= 2
            measured = materialise(self.measured(brackets, False), "quantile-counts")
            held = measured.agg(
                F.max(F.greatest(F.lit(0), *[F.col(f"w{i}_{j}") for i, j in self.spots])),
                F.count_if(~self.all_of(self.holds)),
            ).first()
            crowd = held[0] or 0
            if not held[1] and crowd >= before:  # as narrow as the sketches can make it
                self.limit = max(self.limit, crowd)
            before = math.inf if held[1] else crowd
            if held[1]:  # a sketch that was off: once more with more room
                error, crowd = error * 2, self.limit + 1
            if crowd > self.limit:
                brackets = self.narrowed(measured, error)
                crowd = 0 if not held[1] and crowd * (2 * error + 3 / GRID) <= self.limit / 2 else self.limit + 1

    def all_of(self, test) -> Column:
        whole = F.lit(True)
        for i, j in self.spots:
            whole = whole & test(i, j)
        return whole

    def looked_up(self, measured: DataFrame) -> DataFrame:
        """Arrays of quantiles: the ends of a bracket, or the inner value at the rank."""
        def value_at(i: int, j: int, rank: Column) -> Column:
            low, high, before = F.col(f"l{i}_{j}"), F.col(f"h{i}_{j}"), F.col(f"b{i}_{j}") + F.col(f"t{i}_{j}")
            inner = F.array_sort(F.filter(f"x{i}", lambda x: (x > low) & (x < high)))
            return F.when(rank < before, low).when(rank >= before + F.col(f"w{i}_{j}"), high).otherwise(
                F.try_element_at(inner, (rank - before + 1).cast("int"))
            )

        columns = []
        for i in self.columns:
            parts = []
            for j, p in enumerate(self.probs):
                if j not in self.inner:
                    parts.append(F.col(f"a{i}" if p <= 0 else f"z{i}"))
                    continue
                rank = self.rank(i, j)
                left, right = value_at(i, j, F.floor(rank)), value_at(i, j, F.ceil(rank))
                # Equal neighbours are returned as they are, so infinities do not turn into NaN.
                parts.append(F.when((F.floor(rank) == F.ceil(rank)) | (left == right), left).otherwise(
                    (F.ceil(rank) - rank) * left + (rank - F.floor(rank)) * right
                ))
            columns.append(F.when(F.col(f"n{i}") > 0, F.array(*parts)).alias(f"q{i}"))
        return measured.select(*self.keys, *columns)
