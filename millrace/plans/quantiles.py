"""Exact order statistics in a few bounded aggregation passes.

The built-in exact percentile keeps every distinct value of a group in one task. Here a first
pass takes a sketch of fixed size and derives from its error bound a bracket that must hold the
wanted ranks; later passes count what lies below the bracket and narrow it. Only when the rows
strictly inside are few enough are they gathered and the ranks read off. Rows equal to a bracket
end are counted, never gathered, so a value shared by a third of all rows costs nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, present
from millrace.plans.scratch import materialize

ACCURACY = 2_500
GATHER_LIMIT = 50_000
SMALL_FACTOR = 5
GRID = 512
BROADCAST_GROUPS = 100_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 10_000


@dataclass(frozen=True)
class Rank:
    """Ranks `first` and `last` (1-based, functions of the group's row count) of a column."""

    column: str
    share: float
    first: Callable[[Column], Column]
    last: Callable[[Column], Column]


def quantile_rank(column: str, p: float) -> Rank:
    """The two ranks that linear interpolation at `p` needs."""
    return Rank(
        column,
        p,
        lambda n: F.floor(F.lit(p) * (n - 1)) + 1,
        lambda n: F.ceil(F.lit(p) * (n - 1)) + 1,
    )


def _numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    slot = {c: f"_x{i}" for i, c in enumerate(columns)}
    return df.select(*[col(b) for b in by], *[present(df, c).cast("double").alias(slot[c]) for c in columns]), slot


def _slack(accuracy: int) -> float:
    return 4.0 / accuracy


def _attach(
    rows: DataFrame, state: DataFrame, by: Sequence[str], names: Sequence[str], size: Row
) -> DataFrame:
    """Give every row the bracket of its group.

    The brackets are broadcast while they are few and their keys short. Beyond that
    only the groups with more than 1/`HOT_SHARE` of all rows are, which can be no more than
    `HOT_SHARE` per column; all other groups are too small to skew a shuffled join.
    """
    renamed = [f"_key_{i}" for i in range(len(by))]
    keys = state.select(*[col(b).alias(k) for b, k in zip(by, renamed)], *names)
    same = reduce(lambda a, b: a & b, [col(b).eqNullSafe(F.col(k)) for b, k in zip(by, renamed)])
    if size["groups"] <= BROADCAST_GROUPS and (size["bytes"] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(keys), same).drop(*renamed)
    counts = [n for n in names if n.startswith("n_")]
    is_hot = F.greatest(*[F.col(n) for n in counts], F.lit(0)) > (size["rows"] or 0) / HOT_SHARE
    hot = F.broadcast(keys.where(is_hot))
    held = rows.join(hot, same).unionByName(
        rows.join(hot.select(*renamed), same, "left_anti").join(keys.where(~is_hot), same)
    )
    return held.drop(*renamed)


def order_statistics(
    df: DataFrame,
    ranks: Sequence[Rank],
    by: Sequence[str],
    accuracy: int = ACCURACY,
    gather_limit: int = GATHER_LIMIT,
) -> DataFrame:
    """One row per group: `by`, then per rank t the columns `n_t`, `first_t`, `last_t`."""
    columns = list(dict.fromkeys(r.column for r in ranks))
    rows, slot = _numbers(df, columns, by)
    slack = _slack(accuracy)

    sketches = []
    for c in columns:
        x = F.col(slot[c])
        points = [
            q
            for r in ranks
            if r.column == c
            for q in (max(r.share - slack, 0.0), min(r.share + slack, 1.0))
        ]
        sketches += [
            F.count(x).alias(f"_n{slot[c]}"),
            F.percentile_approx(x, points, accuracy).alias(f"_q{slot[c]}"),
        ]
    sketched = rows.groupBy(*[col(b) for b in by]).agg(*sketches)

    opened = []
    seen: dict[str, int] = {}
    for t, r in enumerate(ranks):
        n, q = F.col(f"_n{slot[r.column]}"), F.col(f"_q{slot[r.column]}")
        at = seen.get(r.column, 0)
        seen[r.column] = at + 2
        small = n <= gather_limit
        opened += [
            n.alias(f"n_{t}"),
            F.when(small | F.lit(r.share <= slack), F.lit(float("-inf"))).otherwise(q[at]).alias(f"lo_{t}"),
            F.when(small | F.lit(r.share >= 1 - slack), F.lit(float("inf"))).otherwise(q[at + 1]).alias(f"hi_{t}"),
            F.when(small, n).otherwise(F.ceil(n * (2 * slack + 2.0 / accuracy)) + 2).alias(f"room_{t}"),
        ]
    state = materialize(sketched.select(*[col(b) for b in by], *opened), "brackets")

    every = range(len(ranks))
    kept = [f"{k}_{t}" for t in every for k in ("n", "lo", "hi")]
    while True:
        size = state.agg(
            F.max(F.greatest(*[F.col(f"room_{t}") for t in every], F.lit(0))).alias("room"),
            F.count(F.lit(1)).alias("groups"),
            F.sum(F.greatest(*[F.col(f"n_{t}") for t in every], F.lit(0))).alias("rows"),
            _text_bytes(by).alias("bytes"),
        ).first()
        last_pass = (size["room"] or 0) <= gather_limit
        held = _attach(rows, state, by, kept, size)
        parts = []
        for t, r in enumerate(ranks):
            x, lo, hi = F.col(slot[r.column]), F.col(f"lo_{t}"), F.col(f"hi_{t}")
            inside = F.when((x > lo) & (x < hi), x)
            parts += [
                F.coalesce(F.first(f"n_{t}"), F.lit(0)).alias(f"n_{t}"),
                F.first(lo).alias(f"lo_{t}"),
                F.first(hi).alias(f"hi_{t}"),
                F.count_if(x < lo).alias(f"lt_{t}"),
                F.count_if(x <= lo).alias(f"le_{t}"),
                F.count(inside).alias(f"in_{t}"),
                F.count_if(x == hi).alias(f"eq_{t}"),
                (
                    F.collect_list(inside)
                    if last_pass
                    else F.percentile_approx(inside, [g / GRID for g in range(GRID + 1)], accuracy)
                ).alias(f"got_{t}"),
            ]
        counted = held.groupBy(*[col(b) for b in by]).agg(*parts)
        if last_pass:
            return _read_off(counted, ranks, by)
        state = materialize(_narrow(counted, ranks, by, accuracy), "brackets")


def _margin(accuracy: int) -> int:
    """Grid steps that cover the sketch's rank error."""
    return math.ceil(GRID / accuracy) + 1


def _narrow(counted: DataFrame, ranks: Sequence[Rank], by: Sequence[str], accuracy: int) -> DataFrame:
    """Next brackets: the grid points just outside the wanted ranks."""
    margin, out = _margin(accuracy), []
    for t, r in enumerate(ranks):
        n, le, inside = F.col(f"n_{t}"), F.col(f"le_{t}"), F.col(f"in_{t}")
        lo, hi, grid = F.col(f"lo_{t}"), F.col(f"hi_{t}"), F.col(f"got_{t}")
        first, last = r.first(n) - le, r.last(n) - le
        down = (F.floor((first - 1) / inside * GRID) - margin).cast("int")
        up = (F.ceil(last / inside * GRID) + margin).cast("int")
        settled = (last <= 0) | (first > inside) | (inside == 0)
        new_lo = F.when(settled | (down < 0), lo).otherwise(F.get(grid, down))
        new_hi = F.when(settled | (up > GRID), hi).otherwise(F.get(grid, up))
        # A settled rank equals a bracket end: shut the bracket so that nothing is inside.
        out += [
            n.alias(f"n_{t}"),
            F.when(settled & (first > inside), hi).otherwise(new_lo).alias(f"lo_{t}"),
            F.when(settled & (last <= 0), lo).otherwise(new_hi).alias(f"hi_{t}"),
            F.when(settled, F.lit(0))
            .otherwise(F.ceil(inside * ((up - down) / F.lit(float(GRID)) + 2.0 / accuracy)) + 2)
            .cast("long")
            .alias(f"room_{t}"),
        ]
    return counted.select(*[col(b) for b in by], *out)


def _read_off(counted: DataFrame, ranks: Sequence[Rank], by: Sequence[str]) -> DataFrame:
    listed = counted.select(
        *[col(b) for b in by],
        *[F.col(f"{k}_{t}") for t in range(len(ranks)) for k in ("n", "lo", "hi", "lt", "le", "in", "eq")],
        *[F.array_sort(f"got_{t}").alias(f"got_{t}") for t in range(len(ranks))],
    )
    out = []
    for t, r in enumerate(ranks):
        n, lo, hi = F.col(f"n_{t}"), F.col(f"lo_{t}"), F.col(f"hi_{t}")
        lt, le, inside, eq = (F.col(f"{k}_{t}") for k in ("lt", "le", "in", "eq"))

        def at(k: Column) -> Column:
            return (
                F.when((n == 0) | (k < 1), F.lit(None).cast("double"))
                .when((k > lt) & (k <= le), lo)
                .when((k > le) & (k <= le + inside), F.get(F.col(f"got_{t}"), (k - le - 1).cast("int")))
                .when((k > le + inside) & (k <= le + inside + eq), hi)
                .otherwise(F.raise_error(F.lit("rank outside its bracket")).cast("double"))
            )

        out += [n.alias(f"n_{t}"), at(r.first(n)).alias(f"first_{t}"), at(r.last(n)).alias(f"last_{t}")]
    return listed.select(*[col(b) for b in by], *out)


@dataclass
class Bracket:
    """Search for two neighbouring ranks of one column of a whole table."""

    x: str
    share: float
    n: int
    first: int
    last: int
    lo: float
    hi: float
    below: int = 0
    inside: int = 0
    found: dict[int, float] | None = None


def _count(rows: DataFrame, open_ones: Sequence[Bracket]) -> None:
    """Place the wanted ranks relative to the bracket ends, in one code-generated aggregation."""
    counts = rows.agg(
        *[
            F.count_if(test).alias(f"{k}{i}")
            for i, b in enumerate(open_ones)
            for k, test in (
                ("lt", F.col(b.x) < b.lo),
                ("le", F.col(b.x) <= b.lo),
                ("ltu", F.col(b.x) < b.hi),
                ("leu", F.col(b.x) <= b.hi),
            )
        ]
    ).first()
    for i, b in enumerate(open_ones):
        lt, le, ltu, leu = (counts[f"{k}{i}"] for k in ("lt", "le", "ltu", "leu"))
        if not lt < b.first <= b.last <= leu:
            raise RuntimeError("rank outside its bracket")
        b.below, b.inside, b.found = le, ltu - le, {}
        for k in {b.first, b.last}:
            if k <= le:
                b.found[k] = b.lo
            elif k > ltu:
                b.found[k] = b.hi


def _settled(b: Bracket) -> bool:
    return b.found is not None and {b.first, b.last} <= set(b.found)


def _strictly_inside(b: Bracket) -> Column:
    return (F.col(b.x) > b.lo) & (F.col(b.x) < b.hi)


def _refine(rows: DataFrame, wide: Sequence[Bracket], accuracy: int) -> None:
    grids = rows.agg(
        *[
            F.percentile_approx(F.when(_strictly_inside(b), F.col(b.x)), [g / GRID for g in range(GRID + 1)], accuracy).alias(f"g{i}")
            for i, b in enumerate(wide)
        ]
    ).first()
    for i, b in enumerate(wide):
        down = math.floor((b.first - b.below - 1) / b.inside * GRID) - _margin(accuracy)
        up = math.ceil((b.last - b.below) / b.inside * GRID) + _margin(accuracy)
        # A rank that already equals an end stays reachable: that end is kept.
        if b.first > b.below and down >= 0:
            b.lo = grids[f"g{i}"][down]
        if b.last <= b.below + b.inside and up <= GRID:
            b.hi = grids[f"g{i}"][up]


def _gather(rows: DataFrame, narrow: Sequence[Bracket]) -> None:
    """Read the ranks off the few values inside each bracket."""
    near = rows.where(reduce(lambda a, b: a | b, [_strictly_inside(b) for b in narrow]))
    cells = near.select(
        F.explode(
            F.array(*[F.when(_strictly_inside(b), F.struct(F.lit(i).alias("t"), F.col(b.x).alias("x"))) for i, b in enumerate(narrow)])
        ).alias("cell")
    )
    held = cells.where(F.col("cell").isNotNull()).groupBy("cell.t").agg(F.sort_array(F.collect_list("cell.x")).alias("xs"))
    places = F.create_map(
        *[
            e
            for i, b in enumerate(narrow)
            for e in (F.lit(i), F.array(F.lit(b.first - b.below - 1), F.lit(b.last - b.below - 1)))
        ]
    )[F.col("t")]
    for r in held.select("t", F.transform(places, lambda p: F.get("xs", p)).alias("values")).collect():
        b = narrow[r["t"]]
        for k, v in zip((b.first, b.last), r["values"]):
            b.found.setdefault(k, v)


def search(rows: DataFrame, searching: Sequence[Bracket], accuracy: int = ACCURACY, gather_limit: int = GATHER_LIMIT) -> None:
    """Find every bracket's ranks; brackets that hold few values are read off, the others cut closer."""
    while searching:
        _count(rows, searching)
        searching = [b for b in searching if not _settled(b)]
        narrow = [b for b in searching if b.inside <= gather_limit]
        if narrow:
            _gather(rows, narrow)
        searching = [b for b in searching if b.inside > gather_limit]
        if searching:
            _refine(rows, searching, accuracy)


def _table_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int, gather_limit: int
) -> DataFrame:
    rows, slot = _numbers(df, columns)
    slack = _slack(accuracy)
    points = [q for p in probabilities for q in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = rows.agg(
        *[F.count(slot[c]).alias(f"n{slot[c]}") for c in columns],
        *[F.percentile_approx(slot[c], points, accuracy).alias(f"q{slot[c]}") for c in columns],
    ).first()

    small = [c for c in columns if sketch[f"n{slot[c]}"] <= SMALL_FACTOR * gather_limit]
    searches: dict[str, list[Bracket]] = {}
    for c in columns:
        if c in small:
            continue
        n, q = sketch[f"n{slot[c]}"], sketch[f"q{slot[c]}"]
        searches[c] = []
        for j, p in enumerate(probabilities):
            place = p * (n - 1)
            lo = float("-inf") if p <= slack else q[2 * j]
            hi = float("inf") if p >= 1 - slack else q[2 * j + 1]
            searches[c].append(Bracket(slot[c], p, n, math.floor(place) + 1, math.ceil(place) + 1, lo, hi))
    search(rows, [b for bs in searches.values() for b in bs], accuracy, gather_limit)

    values = {}
    if small:
        # So few values per column bound what the built-in exact percentile holds.
        exact = rows.agg(*[F.percentile(slot[c], list(probabilities)).alias(slot[c]) for c in small]).first()
        values = {c: exact[slot[c]] or [None] * len(probabilities) for c in small}
    for c, brackets in searches.items():
        values[c] = []
        for b in brackets:
            low, high, place = b.found[b.first], b.found[b.last], b.share * (b.n - 1)
            values[c].append(low if low == high else low + (high - low) * (place - math.floor(place)))
    schema = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in columns])
    return df.sparkSession.createDataFrame([tuple(values[c] for c in columns)], schema)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    gather_limit: int = GATHER_LIMIT,
) -> DataFrame:
    """Linear-interpolation quantiles: `by`, then one array of doubles per column."""
    if not by:
        return _table_quantiles(df, columns, probabilities, accuracy, gather_limit)
    keys = [col(b) for b in by]
    bound = SMALL_FACTOR * gather_limit
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound)
    size = large.agg(F.count(F.lit(1)).alias("groups"), _text_bytes(by).alias("bytes")).first()
    if not size["groups"]:
        return _small_groups(df, columns, probabilities, by)
    if size["groups"] > BROADCAST_GROUPS or (size["bytes"] or 0) > BROADCAST_BYTES:
        return _large_groups(df, columns, probabilities, by, accuracy, gather_limit)
    known = materialize(large.select(*[k.alias(f"_key_{i}") for i, k in enumerate(keys)]), "groups")
    same = reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    few = df.join(F.broadcast(known), same, "left_anti")
    many = df.join(F.broadcast(known), same, "left_semi")
    return _small_groups(few, columns, probabilities, by).unionByName(
        _large_groups(many, columns, probabilities, by, accuracy, gather_limit)
    )


def _text_bytes(by: Sequence[str]) -> Column:
    return F.sum(F.octet_length(F.concat_ws("", *[col(b).cast("string") for b in by])))


def _small_groups(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str]
) -> DataFrame:
    """Sort inside each group and take the wanted positions, for groups that one task may hold.

    One shuffle serves all columns; the aggregation that follows reuses its partitioning.
    """
    rows, slot = _numbers(df, columns, by)
    keys = [col(b) for b in by]
    whole = Window.partitionBy(*keys)
    placed = rows.select(
        "*",
        *[F.count(x).over(whole).alias(f"n{x}") for x in slot.values()],
        *[F.row_number().over(whole.orderBy(F.asc_nulls_last(x))).alias(f"at{x}") for x in slot.values()],
    )
    picks = []
    for c in columns:
        x, n, at = slot[c], F.col(f"n{slot[c]}"), F.col(f"at{slot[c]}")
        picks.append(F.max(n).alias(f"n{x}"))
        for j, p in enumerate(probabilities):
            r = quantile_rank(c, p)
            picks.append(F.max(F.when(at == r.first(n), F.col(x))).alias(f"low{x}_{j}"))
            picks.append(F.max(F.when(at == r.last(n), F.col(x))).alias(f"high{x}_{j}"))
    picked = placed.groupBy(*keys).agg(*picks)
    return picked.select(
        *keys,
        *[
            F.array(
                *[
                    _between(F.col(f"low{slot[c]}_{j}"), F.col(f"high{slot[c]}_{j}"), F.col(f"n{slot[c]}"), p)
                    for j, p in enumerate(probabilities)
                ]
            ).alias(c)
            for c in columns
        ],
    )


def _between(low: Column, high: Column, n: Column, p: float) -> Column:
    """Linear interpolation between the values at two neighbouring ranks."""
    place = F.lit(p) * (n - 1)
    return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))


def _large_groups(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str],
    accuracy: int,
    gather_limit: int,
) -> DataFrame:
    ranks = [quantile_rank(c, p) for c in columns for p in probabilities]
    found = order_statistics(df, ranks, by, accuracy, gather_limit)

    def value(t: int) -> Column:
        return _between(F.col(f"first_{t}"), F.col(f"last_{t}"), F.col(f"n_{t}"), ranks[t].share)

    width = len(probabilities)
    return found.select(
        *[col(b) for b in by],
        *[
            F.array(*[value(i * width + j) for j in range(width)]).alias(c)
            for i, c in enumerate(columns)
        ],
    )


def approx_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Single-pass sketch with rank error 1/accuracy, in the same shape."""
    return df.groupBy(*[col(b) for b in by]).agg(
        *[
            F.percentile_approx(present(df, c).cast("double"), list(probabilities), accuracy).alias(c)
            for c in columns
        ]
    )
