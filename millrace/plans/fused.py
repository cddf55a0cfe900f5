"""One fit for imputing, capping and encoding: what the steps need is read off the raw columns together.

A median fill puts its copies between two neighbouring ranks of a column, so the quartiles of the filled column are order
statistics of the raw one at shifted ranks: medians and fences come out of one search. Missing counts and the sketch
that opens the search are one aggregation, modes and classes one count of texts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, missing, present
from millrace.operators.encoding import NULL_CLASS, LabelEncoder, encoder_of
from millrace.operators.fitted import Fitted
from millrace.operators.impute import UNKNOWN, Imputer
from millrace.plans.quantiles import ACCURACY, GATHER_LIMIT, SMALL_FACTOR, Bracket, search
from millrace.plans.scratch import materialize

#: Points of the opening sketch; neighbours are as far apart as the sketch may err, four times over.
POINTS = ACCURACY // 4


@dataclass(frozen=True)
class FusedFit:
    imputer: Imputer
    fences: Fitted
    encoder: LabelEncoder | None
    n_missing: Mapping[str, int]


def _median_ranks(n: int) -> tuple[int, int]:
    return math.floor((n - 1) / 2) + 1, math.ceil((n - 1) / 2) + 1


def _raw_rank(k: int, middle: int, m: int) -> int | None:
    """Rank in the raw column of rank `k` of the filled one; None is one of the `m` fills behind rank `middle`."""
    if k <= middle:
        return k
    return None if k <= middle + m else k - m


def _interpolated(low: float, high: float, place: float) -> float:
    return low if low == high else low + (high - low) * (place - math.floor(place))


def _order_statistics(rows: DataFrame, wanted: Mapping[str, set[int]], sizes: Mapping[str, int], grids: Mapping[str, Sequence[float]], gather_limit: int) -> dict[str, dict[int, float]]:
    """Values at 1-based ranks: one pass for columns whose values one task may hold, a bracket search for the others."""
    found: dict[str, dict[int, float]] = {x: {} for x in wanted}
    small = {x: sorted(ks) for x, ks in wanted.items() if ks and sizes[x] <= SMALL_FACTOR * gather_limit}
    if small:
        lists = rows.agg(*[F.sort_array(F.collect_list(x)).alias(x) for x in small])
        got = lists.select(*[F.array(*[F.get(x, k - 1) for k in ks]).alias(x) for x, ks in small.items()]).first()
        found |= {x: dict(zip(ks, got[x])) for x, ks in small.items()}
    brackets = []
    for x, ks in wanted.items():
        if x in small:
            continue
        for k in sorted(ks):
            share = (k - 1) / max(1, sizes[x] - 1)
            down, up = math.floor(share * POINTS) - 1, math.ceil(share * POINTS) + 1
            low = float("-inf") if down <= 0 else grids[x][down]
            high = float("inf") if up >= POINTS else grids[x][up]
            brackets.append(Bracket(x, share, sizes[x], k, k, low, high))
    search(rows, brackets, ACCURACY, gather_limit)
    for b in brackets:
        found[b.x][b.first] = b.found[b.first]
    return found


def fit_together(
    df: DataFrame,
    numbers: Sequence[str],
    texts: Sequence[str],
    fenced: Sequence[str],
    encoded: Sequence[str],
    counted: Sequence[str] = (),
    multiplier: float = 1.5,
    for_new_rows: bool = False,
    gather_limit: int = GATHER_LIMIT,
) -> FusedFit:
    """Median fills for `numbers`, modes for `texts`, fences of the filled `fenced` columns, classes of the filled `encoded`
    ones (which must be strings); missing values of `counted` columns are counted too.

    Reads the source once for counts and sketches, once for the order statistics (more often where a column has more
    values than one task may hold), once for the texts. A column without values is not filled and has no fences.
    """
    ranked = list(dict.fromkeys([*numbers, *fenced]))
    slot = {c: f"_x{i}" for i, c in enumerate(ranked)}
    rows = df.select(*[present(df, c).cast("double").alias(x) for c, x in slot.items()])
    every = list(dict.fromkeys([*ranked, *texts, *encoded, *counted]))
    points = [i / POINTS for i in range(POINTS + 1)]
    seen = df.select(*[missing(df, c).alias(f"_m{i}") for i, c in enumerate(every)], *[present(df, c).cast("double").alias(x) for c, x in slot.items()]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"_m{i}").alias(f"m{i}") for i in range(len(every))],
        *[F.count(x).alias(f"n{x}") for x in slot.values()],
        *[F.percentile_approx(x, points, ACCURACY).alias(f"q{x}") for x in slot.values()],
    ).first()
    lost = {c: seen[f"m{i}"] for i, c in enumerate(every)}
    sizes = {x: seen[f"n{x}"] for x in slot.values()}

    filled = {c for c in numbers if for_new_rows or lost[c]}
    wanted: dict[str, set[int]] = {x: set() for x in slot.values()}
    for c, x in slot.items():
        n, m = sizes[x], lost[c] if c in filled else 0
        if not n:
            continue
        middle = _median_ranks(n)
        if c in filled:
            wanted[x] |= set(middle)
        if c in fenced:
            places = [p * (n + m - 1) for p in (0.25, 0.75)]
            wanted[x] |= {_raw_rank(k, middle[0], m) for at in places for k in (math.floor(at) + 1, math.ceil(at) + 1)} - {None}
    got = _order_statistics(rows, wanted, sizes, {x: seen[f"q{x}"] for x in slot.values()}, gather_limit)

    fills: dict[str, dict] = {}
    fences: dict[str, dict] = {}
    for c, x in slot.items():
        n, m = sizes[x], lost[c] if c in filled else 0
        low, high = _median_ranks(n) if n else (0, 0)
        fill = None
        if c in filled:
            fill = _interpolated(got[x][low], got[x][high], (n - 1) / 2) if n else None
            fills[c] = {"fill": fill}
        if c in fenced:
            if not n:
                fences[c] = {"lower": None, "upper": None}
                continue
            if fill is not None and isinstance(df.schema[c].dataType, T.FloatType):
                fill = float(np.float32(fill))  # as the filled column holds it
            quartiles = []
            for p in (0.25, 0.75):
                at = p * (n + m - 1)
                ends = [_raw_rank(k, low, m) for k in (math.floor(at) + 1, math.ceil(at) + 1)]
                quartiles.append(_interpolated(*[fill if k is None else got[x][k] for k in ends], at))
            spread = quartiles[1] - quartiles[0]
            fences[c] = {"lower": quartiles[0] - multiplier * spread, "upper": quartiles[1] + multiplier * spread}

    chosen, encoder = _texts(df, texts, encoded, lost, for_new_rows)
    number_model = Fitted("impute", ("fill",), tuple(c for c in numbers if c in filled), values={c: fills[c] for c in numbers if c in filled})
    text_model = Fitted("impute", ("fill",), tuple(chosen), values={c: {"fill": v} for c, v in chosen.items()})
    holes = {c: lost[c] for c in [*numbers, *texts] if lost[c]}
    fence_model = Fitted("fences", ("lower", "upper"), tuple(fenced), values=fences)
    return FusedFit(Imputer(number_model, text_model, holes), fence_model, encoder, lost)


def _texts(df: DataFrame, texts: Sequence[str], encoded: Sequence[str], lost: Mapping[str, int], for_new_rows: bool) -> tuple[dict[str, str], LabelEncoder | None]:
    """Fill values, and the classes that the filled columns have, from one count of texts."""
    filled = [c for c in texts if for_new_rows or lost[c]]
    names = list(dict.fromkeys([*filled, *encoded]))
    if not names:
        return {}, None
    spark = df.sparkSession
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("value")) for c in names])).alias("cell")).select("cell.*")
    counts = materialize(cells.where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "text-counts")
    fills = dict.fromkeys(filled, UNKNOWN)
    if filled:
        best = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
        fills |= {r["column"]: r["value"] for r in best.select("column", "best.value").collect() if r["column"] in fills}
    if not encoded:
        return fills, None
    more = [(c, fills[c] if c in fills else NULL_CLASS) for c in encoded if lost[c]]
    values = counts.where(F.col("column").isin(list(encoded))).select("column", "value")
    values = values.unionAll(spark.createDataFrame(more, "column string, value string")).distinct()
    return fills, encoder_of(materialize(values, "classes"), encoded)
