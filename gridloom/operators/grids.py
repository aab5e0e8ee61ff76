"""Time grids, bucket means and gap filling on a regular grid."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import timeops
from gridloom.functions.numeric import known
from gridloom.operators.reshape import pivot_values

# Points of one series that a single window task may order. A longer (or unknown)
# time span is split into chunks of CHUNK_STEPS grid steps that exchange only
# their outermost points.
ROWS_PER_SERIES = 200_000
CHUNK_STEPS = 16_384

# Grid points that a task of ``refill_gaps`` holds at once, unless one series has more.
REFILL_POINTS = 200_000

# Grid steps of the stretch of a series that one task of a spline holds.
SPLINE_STEPS = 4096


def time_grid(spark: SparkSession, start: datetime, end: datetime, minutes: int) -> DataFrame:
    """One row per grid point from ``start`` to ``end``; both are floored and included."""
    first = int(timeops.floor_value(start, minutes).timestamp())
    size = max(timeops.grid_size(start, end, minutes), 0)
    return spark.range(size).select(
        F.timestamp_seconds(F.lit(first) + F.col("id") * F.lit(minutes * 60)).alias("datetime")
    )


def key_grid(keys: DataFrame, start: datetime, end: datetime, minutes: int) -> DataFrame:
    """The grid for every row of ``keys``.

    Days are expanded first and spread over the tasks, then the points of each day:
    a short key table would otherwise be expanded by the one task that read it.
    """
    first = int(timeops.floor_value(start, minutes).timestamp())
    last = int(timeops.floor_value(end, minutes).timestamp())
    step = minutes * 60
    block = step * max(1, 86_400 // step)
    blocks = keys.withColumn("__block", F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(block))))
    blocks = blocks.repartition(*keys.columns, "__block")
    stop = F.least(F.col("__block") + F.lit(block - step), F.lit(last))
    points = blocks.withColumn("__point", F.explode(F.sequence(F.col("__block"), stop, F.lit(step))))
    return points.withColumn("datetime", F.timestamp_seconds("__point")).drop("__block", "__point")


def bucket_mean(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    minutes: int | str,
    time: str = "time",
) -> DataFrame:
    """Mean of ``values`` per key and left-labelled bucket; empty buckets give no row.

    ``minutes`` is a width, or the name of a column that holds it.
    """
    width = F.col(minutes) if isinstance(minutes, str) else minutes
    return (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, timeops.bucket(F.col(time), width).alias("datetime"))
        .agg(*[F.avg(known(F.col(v))).alias(v) for v in values])
    )


def bucket_any(values: Sequence[str]) -> Column:
    """At least one of the values is present."""
    return F.coalesce(*[F.col(v) for v in values]).isNotNull()


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _neighbours(points: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """Per row: the next row's step, and per column the known points at or before and after it.

    A point is a (step, value) pair. All expressions share one partitioning and one
    order, so they need one sort.
    """
    over = (f"PARTITION BY {_quoted(keys)} " if keys else "") + "ORDER BY `__i`"
    upto = f"({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    added = {"__next": F.expr(f"lead(`__i`) OVER ({over})")}
    for n, c in enumerate(columns):
        point = f"CASE WHEN `{c}` IS NOT NULL THEN named_struct('i', `__i`, 'v', `{c}`) END"
        added[f"__p{n}"] = F.expr(f"last_value({point}) IGNORE NULLS OVER {upto}")
        added[f"__n{n}"] = F.expr(f"lead({point}) IGNORE NULLS OVER ({over})")
    return points.withColumns(added)


def _chunked_neighbours(points: DataFrame, series: list[str], columns: Sequence[str], chunk: int) -> DataFrame:
    """The same, for series too long for one task.

    Each chunk of a series is ordered on its own. What a chunk needs from outside is
    the closest known point on either side per column; these come from a table with
    one row per series and chunk.
    """
    points = points.withColumn("__c", F.floor(F.col("__i") / F.lit(chunk)))
    edges = [F.min("__i").alias("__first")]
    for n, c in enumerate(columns):
        point = F.when(F.col(c).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(c).alias("v")))
        edges += [F.min(point).alias(f"__f{n}"), F.max(point).alias(f"__l{n}")]
    over = (f"PARTITION BY {_quoted(series)} " if series else "") + "ORDER BY `__c`"
    outside = [F.expr(f"lead(`__first`) OVER ({over})").alias("__xnext")]
    for n in range(len(columns)):
        outside += [
            F.expr(f"lag(`__l{n}`) IGNORE NULLS OVER ({over})").alias(f"__xp{n}"),
            F.expr(f"lead(`__f{n}`) IGNORE NULLS OVER ({over})").alias(f"__xn{n}"),
        ]
    keys = [*series, "__c"]
    carried = points.groupBy(*keys).agg(*edges).select(*keys, *outside)
    inside = _neighbours(points, keys, columns).join(carried, keys)
    names = ["next"] + [f"{side}{n}" for n in range(len(columns)) for side in "pn"]
    merged = {f"__{name}": F.coalesce(f"__{name}", f"__x{name}") for name in names}
    return inside.withColumns(merged).drop("__c", *[f"__x{name}" for name in names])


def fill_gaps(
    points: DataFrame,
    series: Sequence[str],
    columns: Sequence[str],
    minutes: int,
    limit: int | None = None,
    method: str = "linear",
    tail: bool = True,
    span: tuple[datetime, datetime] | None = None,
    rows_per_series: int = ROWS_PER_SERIES,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Complete each series to its grid and fill gaps, column by column.

    ``points`` holds one row per series and on-grid ``datetime``. The grid of a series
    runs from its first to its last row. ``linear`` interpolates between the known
    neighbours, ``ffill`` repeats the earlier one. Of every gap only the first ``limit``
    steps are filled; the rest stays null, as do steps before the first known value.
    After the last known value that value is repeated when ``tail`` is set.

    No grid is joined: each row looks up its known neighbours first and then expands
    to the steps up to the next row, so that only the given rows are shuffled and sorted.
    """
    if method not in ("linear", "ffill"):
        raise ValueError(f"unknown method {method!r}")
    series, columns = list(series), list(columns)
    step = minutes * 60
    points = (
        points.dropna(how="any", subset=[*series, "datetime"])
        .withColumn("__i", F.floor(F.unix_seconds("datetime") / F.lit(step)))
        .select(*series, *columns, "__i")
    )
    if series and span and timeops.grid_size(*span, minutes) <= rows_per_series:
        placed = _neighbours(points, series, columns)
    else:
        placed = _chunked_neighbours(points, series, columns, chunk_steps)
    grid = placed.withColumn(
        "__g", F.explode(F.sequence(F.col("__i"), F.coalesce(F.col("__next") - 1, F.col("__i"))))
    )
    filled = []
    for n, c in enumerate(columns):
        before, after = F.col(f"__p{n}.v"), F.col(f"__n{n}.v")
        distance = F.col("__g") - F.col(f"__p{n}.i")
        # A known neighbour ahead is at least one step away, so the width is never 0.
        width = F.col(f"__n{n}.i") - F.col(f"__p{n}.i")
        if method == "linear":
            between = before + (after - before) * distance / width
        else:
            between = before
        value = F.when(after.isNotNull(), between)
        value = value.otherwise(before) if tail else value
        if limit is not None:
            value = F.when(distance <= limit, value)
        filled.append(F.when(distance == 0, before).otherwise(value).alias(c))
    return grid.select(*series, F.timestamp_seconds(F.col("__g") * F.lit(step)).alias("datetime"), *filled)


def fill_columns(
    points: DataFrame,
    columns: Sequence[str],
    minutes: int,
    limit: int | None = None,
    span: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """``fill_gaps`` for one series with many columns.

    The columns become series of their own: a single series would leave all the work to
    one task, and many columns would make many window expressions.
    """
    long = points.unpivot(["datetime"], list(columns), "__field", "__value")
    filled = fill_gaps(long, ["__field"], ["__value"], minutes, limit, span=span)
    return pivot_values(filled, ["datetime"], "__field", {c: c for c in columns}, "__value")


# A column of a task: its values, and which of them are known.
Cells = tuple[np.ndarray, np.ndarray]


def _first_of_each(series: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(series, prepend=-1))


def _filled(
    series: np.ndarray, at: np.ndarray, columns: list[Cells], limit: int | None
) -> tuple[np.ndarray, np.ndarray, list[Cells]]:
    """``fill_gaps``, linear and with a tail, for whole series that a task holds.

    ``series`` numbers them from 0, ``at`` holds their steps in order. Returned are series, steps
    and columns of all grid points.
    """
    cuts = _first_of_each(series)
    sizes = at[np.append(cuts[1:], len(at)) - 1] - at[cuts] + 1
    shift = np.cumsum(sizes) - sizes - at[cuts]
    of_point = np.repeat(np.arange(len(cuts)), sizes)
    point = np.arange(len(of_point))
    place = at + shift[series]
    filled = []
    for value, known in columns:
        # Known points between two that belong to no series.
        spot = np.concatenate([[-1], place[known], [-1]])
        owner = np.concatenate([[-1], series[known], [-1]])
        v = np.concatenate([[0.0], value[known], [0.0]])
        marks = np.zeros(len(point), np.int64)
        marks[place[known]] = 1
        before = np.cumsum(marks)
        behind = before + 1
        low, distance = v[before], point - spot[before]
        with np.errstate(all="ignore"):
            between = low + (v[behind] - low) * distance / (spot[behind] - spot[before])
        inside = (owner[behind] == of_point) & (distance > 0)
        near = owner[before] == of_point
        filled.append((np.where(inside, between, low), near if limit is None else near & (distance <= limit)))
    return of_point, point - shift[of_point], filled


def _means_of_wider(
    series: np.ndarray, bucket: np.ndarray, columns: list[Cells]
) -> tuple[np.ndarray, np.ndarray, list[Cells]]:
    """``bucket_mean`` of the points of a task, in order of series and bucket."""
    first = np.flatnonzero((np.diff(series, prepend=-1) != 0) | (np.diff(bucket, prepend=bucket[0] - 1) != 0))
    means = []
    for value, known in columns:
        known = known & ~np.isnan(value)
        count = np.add.reduceat(known.astype(np.int64), first)
        with np.errstate(all="ignore"):
            means.append((np.add.reduceat(np.where(known, value, 0.0), first) / count, count > 0))
    return series[first], bucket[first], means


def refill_gaps(
    points: DataFrame,
    series: Sequence[str],
    columns: Sequence[str],
    minutes: int,
    wider: int,
    limit: int | None,
    span: tuple[datetime, datetime],
    rows_per_series: int = ROWS_PER_SERIES,
) -> DataFrame:
    """``fill_gaps``, then means of buckets of ``wider`` minutes, then ``fill_gaps`` on their grid.

    The grids have far more rows than ``points``. So those are dealt by series (texts or whole
    numbers) and sorted, and a task brings some series at a time, with all their columns, through
    the three steps in arrays; only the answer becomes rows. Where a series may be too long for
    that, the steps follow each other as queries. Columns are doubles.
    """
    series, columns = list(series), list(columns)
    if timeops.grid_size(*span, min(minutes, wider)) > rows_per_series:
        fine = fill_gaps(points, series, columns, minutes, limit, span=span, rows_per_series=rows_per_series)
        means = bucket_mean(fine, series, columns, wider, time="datetime")
        return fill_gaps(means, series, columns, wider, limit, span=span, rows_per_series=rows_per_series)
    step, wide = minutes * 60, wider * 60

    def numbered(rows: pa.Table) -> np.ndarray:
        changed = np.zeros(rows.num_rows, bool)
        for s in series:
            changed[1:] |= pc.not_equal(rows[s].slice(1), rows[s].slice(0, rows.num_rows - 1)).to_numpy()
        return np.cumsum(changed)

    def answer(rows: pa.Table, number: np.ndarray) -> pa.RecordBatch:
        number = number - number[0]
        cells = [(rows[c].to_numpy(), rows[c].is_valid().to_numpy()) for c in columns]
        of_point, at, cells = _filled(number, rows["__i"].to_numpy(), cells, limit)
        of_point, at, cells = _filled(*_means_of_wider(of_point, at * step // wide, cells), limit)
        keys = rows.select(series).take(pa.array(_first_of_each(number)[of_point])).combine_chunks()
        arrays = [keys[s].combine_chunks() for s in series]
        arrays += [pa.array(at), *[pa.array(value, mask=~known) for value, known in cells]]
        return pa.RecordBatch.from_arrays(arrays, names=[*series, "__i", *columns])

    def answers(rows: pa.Table, number: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        cuts = np.append(_first_of_each(number - number[0]), rows.num_rows)
        at = rows["__i"].to_numpy()
        total = np.cumsum(at[cuts[1:] - 1] - at[cuts[:-1]] + 1)
        done, first = 0, 0
        while first < len(total):
            last = max(int(np.searchsorted(total, done + REFILL_POINTS, side="right")), first + 1)
            yield answer(rows.slice(cuts[first], cuts[last] - cuts[first]), number[cuts[first] : cuts[last]])
            done, first = total[last - 1], last

    def refill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
                number = numbered(rows)
                # The last series may go on in the next batch.
                cut = int(np.searchsorted(number, number[-1]))
                held = rows.slice(cut)
                yield from answers(rows.slice(0, cut), number[:cut])
        if held is not None:
            yield from answers(held, numbered(held))

    points = (
        points.dropna(how="any", subset=[*series, "datetime"])
        .withColumn("__i", F.floor(F.unix_seconds("datetime") / F.lit(step)))
        .select(*series, "__i", *columns)
    )
    # A number of its own: the few bytes of the points say little of the work.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = points.repartition(parts, *series).sortWithinPartitions(*series, "__i")
    filled = dealt.mapInArrow(refill, points.schema)
    return filled.select(*series, F.timestamp_seconds(F.col("__i") * F.lit(wide)).alias("datetime"), *columns)


def interpolate_inside(points: DataFrame, series: Sequence[str], columns: Sequence[str], minutes: int, **kw) -> DataFrame:
    """Linear, without limit, nothing outside the first and last known value."""
    return fill_gaps(points, series, columns, minutes, limit=None, tail=False, **kw)


def forward_fill(points: DataFrame, series: Sequence[str], columns: Sequence[str], minutes: int, **kw) -> DataFrame:
    """Repeat the last known value on the finer grid."""
    return fill_gaps(points, series, columns, minutes, limit=None, method="ffill", **kw)


def resample_mean(
    df: DataFrame,
    series: Sequence[str],
    values: Sequence[str],
    minutes: int,
    time: str = "time",
    span: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Bucket means with null rows for empty buckets between the first and the last."""
    means = bucket_mean(df, series, values, minutes, time)
    return fill_gaps(means, series, values, minutes, limit=0, span=span)


def resample_interpolate(
    df: DataFrame,
    series: Sequence[str],
    values: Sequence[str],
    minutes: int,
    limit: int | None,
    time: str = "time",
    span: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Bucket means, then linear filling of gaps up to ``limit`` steps."""
    means = bucket_mean(df, series, values, minutes, time)
    return fill_gaps(means, series, values, minutes, limit=limit, span=span)


def _eliminated(x: np.ndarray, y: np.ndarray, first: int, total: int) -> tuple[int, np.ndarray]:
    """Second derivatives at the knots of a piece, as sums of those beside it.

    ``x`` and ``y`` hold the piece's knots and the one before and the one behind them, where there
    are; ``first`` is the number of x[0] in its series of ``total`` knots. The not-a-knot ends are
    put into the rows beside them, so that the unknowns are those of the knots 1 to total - 2, and
    each row outweighs its neighbours. Returns the place of the first unknown in x, and a row for
    each: the constant, the part of the unknown before the piece and of the one behind it.
    """
    h = np.diff(x)
    slope = np.diff(y) / h
    number = first + np.arange(1, len(x) - 1)
    left, right = h[:-1], h[1:]
    lower, upper, middle = left.copy(), right.copy(), 2.0 * (left + right)
    start, end = number == 1, number == total - 2
    middle[start] += left[start] * (left[start] + right[start]) / right[start]
    upper[start] -= left[start] ** 2 / right[start]
    middle[end] += right[end] * (left[end] + right[end]) / left[end]
    lower[end] -= right[end] ** 2 / left[end]
    lower[start], upper[end] = 0.0, 0.0
    known = np.zeros((len(number), 3))
    known[:, 0] = 6.0 * np.diff(slope)
    if len(number):
        known[0, 1], known[-1, 2] = -lower[0], -upper[-1]
    # Forward and back once through the rows; three right sides at a time.
    rows, ups = known.tolist(), upper.tolist()
    for i, (a, b) in enumerate(zip(lower.tolist(), middle.tolist(), strict=True)):
        if i:
            before = rows[i - 1]
            b -= a * ups[i - 1]
            rows[i] = [v - a * w for v, w in zip(rows[i], before, strict=True)]
        ups[i] = ups[i] / b if i + 1 < len(rows) else 0.0
        rows[i] = [v / b for v in rows[i]]
    for i in range(len(rows) - 2, -1, -1):
        rows[i] = [v - ups[i] * w for v, w in zip(rows[i], rows[i + 1], strict=True)]
    return 1, np.array(rows).reshape(-1, 3)


def _cubic(x: np.ndarray, y: np.ndarray, m: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The cubic pieces with second derivatives ``m`` at the knots."""
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, len(x) - 2)
    h = x[k + 1] - x[k]
    left, right = (x[k + 1] - at) / h, (at - x[k]) / h
    return left * y[k] + right * y[k + 1] + ((left**3 - left) * m[k] + (right**3 - right) * m[k + 1]) * h * h / 6.0


# What a piece tells of itself: its knots, those beside it, and what its elimination leaves.
_PIECE = (
    "__chunk long, __first long, __total long, __own long, __x array<double>, __y array<double>, "
    "__rows array<array<double>>"
)
_BOUNDS = "__chunk long, __total long, __before array<double>, __behind array<double>, __short array<double>"
_NUMBERS = pa.list_(pa.float64())
_PIECE_TYPES = dict.fromkeys(["__chunk", "__first", "__total", "__own"], pa.int64()) | {
    "__x": _NUMBERS, "__y": _NUMBERS, "__rows": pa.list_(_NUMBERS),
}
_BOUND_TYPES = dict.fromkeys(["__chunk", "__total"], pa.int64()) | dict.fromkeys(["__before", "__behind", "__short"], _NUMBERS)


def _with_neighbours(piece: dict, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The knots of a piece between the one before and the one behind it, and the number of the first."""
    first = piece["__from"]
    if piece["__last_before"]:
        x, y, first = np.insert(x, 0, piece["__last_before"]["__i"]), np.insert(y, 0, piece["__last_before"]["__v"]), first - 1
    if piece["__first_behind"]:
        x, y = np.append(x, piece["__first_behind"]["__i"]), np.append(y, piece["__first_behind"]["__v"])
    return x, y, first


def _sorted_knots(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = rows["__i"].to_numpy().astype("float64")
    order = np.argsort(at, kind="stable")
    value = rows["__v"].to_numpy(zero_copy_only=False).astype("float64")[order]
    return order, at[order], value, ~np.isnan(value)


def _reduced(pieces: list[dict]) -> list[dict]:
    """Second derivatives at the knots beside each piece of a series, from what the eliminations left.

    Pieces come in order. Each row says that an unknown is a constant, a part of the last unknown
    before the piece and a part of the first one behind it; the pieces are gone through once
    forward and once back. Where a series has too few knots for a spline, all of them go to each piece.
    """
    total = pieces[0]["__total"]
    knots = {}  # number: x, y; the first and last three of each piece
    for p in pieces:
        for j, (x, y) in enumerate(zip(p["__x"], p["__y"], strict=True)):
            knots[p["__first"] + (j if j < 3 else p["__own"] - len(p["__x"]) + j)] = (x, y)
    if total < 4:
        short = [v for k in sorted(knots) for v in knots[k]]
        return [{"before": None, "behind": None, "short": short} for _ in pieces]
    solved = [p for p in pieces if p["__rows"]]
    forward, u, v = [], 0.0, 0.0
    for p in solved:
        head, tail = p["__rows"][0], p["__rows"][-1]
        scale = 1.0 - head[1] * v
        f0, f1 = (head[0] + head[1] * u) / scale, head[2] / scale
        forward.append((f0, f1))
        u, v = tail[0] + tail[1] * (u + v * f0), tail[1] * v * f1 + tail[2]
    m: dict[int, float] = {}
    behind = 0.0
    ends = []
    for p, (f0, f1) in zip(reversed(solved), reversed(forward), strict=True):
        first = f0 + f1 * behind
        ends.append((p, first, behind))
        behind = first
    ends.reverse()
    before = 0.0
    for p, _, behind in ends:
        low = max(p["__first"], 1)
        count = min(p["__first"] + p["__own"] - 1, total - 2) - low + 1
        for j, row in enumerate(p["__rows"]):
            place = j if j < 3 else count - len(p["__rows"]) + j
            m[low + place] = row[0] + row[1] * before + row[2] * behind
        before = m[low + count - 1]
    x = lambda k: knots[k][0]
    h = x(1) - x(0), x(2) - x(1)
    m[0] = ((h[0] + h[1]) * m[1] - h[0] * m[2]) / h[1]
    n = total - 1
    h = x(n) - x(n - 1), x(n - 1) - x(n - 2)
    m[n] = ((h[0] + h[1]) * m[n - 1] - h[0] * m[n - 2]) / h[1]
    found = []
    for p in pieces:
        one, other = p["__first"] - 1, p["__first"] + p["__own"]
        found.append(
            {
                "before": [*knots[one], m[one]] if one in m else None,
                "behind": [*knots[other], m[other]] if other in m else None,
                "short": [m[0], m[n]],
            }
        )
    return found


def interpolate_cubic(
    points: DataFrame,
    series: Sequence[str],
    column: str,
    minutes: int,
    steps: int = SPLINE_STEPS,
) -> DataFrame:
    """Fill the gaps of one column by a not-a-knot cubic spline per series, inside its known values.

    The spline is that of the whole series, whatever its length. A series is cut into stretches of
    ``steps`` grid steps. Their counts and outermost knots say which knots each holds and which lie
    beside it; each stretch eliminates its own unknowns, which leaves a few rows of it; those of a
    series, two unknowns a stretch, are solved in one go, and each stretch fills its gaps. A task
    holds one stretch, or the few rows of all stretches of a series. Fewer than four known values
    give the polynomial through them. Rows without a series or a time go.
    """
    series = list(series)
    grid = (
        points.dropna(how="any", subset=[*series, "datetime"])
        .withColumn("__i", F.floor(F.unix_seconds("datetime") / F.lit(minutes * 60)))
        .select(*series, "__i", F.nanvl(F.col(column).cast("double"), F.lit(None)).alias("__v"))
        .withColumn("__chunk", F.floor(F.col("__i") / F.lit(steps)))
    )
    key = [*series, "__chunk"]
    knot = F.when(F.col("__v").isNotNull(), F.struct("__i", "__v"))
    counted = grid.groupBy(*key).agg(F.count("__v").alias("__own"), F.min(knot).alias("__head"), F.max(knot).alias("__tail"))
    # One row per stretch.
    along = Window.partitionBy(*series).orderBy("__chunk")
    before, behind = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    pieces = counted.select(
        *key, "__own",
        F.coalesce(F.sum("__own").over(before), F.lit(0)).alias("__from"),
        F.sum("__own").over(Window.partitionBy(*series)).alias("__total"),
        F.last("__tail", ignorenulls=True).over(before).alias("__last_before"),
        F.first("__head", ignorenulls=True).over(behind).alias("__first_behind"),
    )
    fields = {f.name: f for f in grid.schema.fields}
    parts = [fields[s] for s in series]

    def schema(text: str) -> T.StructType:
        return T.StructType([*parts, *T.StructType.fromDDL(text).fields])

    def eliminate(rows: pa.Table, piece: pa.Table) -> pa.Table:
        (info,) = piece.to_pylist()
        _, at, value, known = _sorted_knots(rows)
        own_x, own_y = at[known], value[known]
        x, y, first = _with_neighbours(info, own_x, own_y)
        kept = []
        if info["__total"] >= 4 and len(x) >= 3:
            kept = _eliminated(x, y, first, info["__total"])[1]
            kept = (kept if len(kept) <= 6 else np.concatenate([kept[:3], kept[-3:]])).tolist()
        ends = np.arange(len(own_x)) if len(own_x) <= 6 else np.r_[0:3, len(own_x) - 3 : len(own_x)]
        return pa.Table.from_pylist(
            [
                {s: info[s] for s in key}
                | {
                    "__first": info["__from"], "__total": info["__total"], "__own": info["__own"],
                    "__x": own_x[ends].tolist(), "__y": own_y[ends].tolist(), "__rows": kept,
                }
            ],
            schema=typed(piece, _PIECE_TYPES),
        )

    def reduce(of_series: pa.Table) -> pa.Table:
        listed = sorted(of_series.to_pylist(), key=lambda p: p["__chunk"])
        return pa.Table.from_pylist(
            [
                {s: p[s] for s in key}
                | {"__total": p["__total"], "__before": b["before"], "__behind": b["behind"], "__short": b["short"]}
                for p, b in zip(listed, _reduced(listed), strict=True)
            ],
            schema=typed(of_series, _BOUND_TYPES),
        )

    def fill(rows: pa.Table, piece: pa.Table, bounds: pa.Table) -> pa.Table:
        (info,), (ends,) = piece.to_pylist(), bounds.to_pylist()
        order, at, value, known = _sorted_knots(rows)
        x, y, first = _with_neighbours(info, at[known], value[known])
        total = info["__total"]
        inside = ~known
        if total < 4:
            whole = np.array(ends["__short"]).reshape(-1, 2)
            inside &= (at >= whole[0, 0]) & (at <= whole[-1, 0]) if total > 1 else False
            if inside.any():
                shift = whole[0, 0]
                value[inside] = np.polynomial.Polynomial.fit(whole[:, 0] - shift, whole[:, 1], total - 1)(at[inside] - shift)
        elif len(x) > 1:
            inside &= (at >= x[0]) & (at <= x[-1])
            if inside.any():
                m = np.empty(len(x))
                low = int(info["__last_before"] is not None)
                if ends["__before"]:
                    m[0] = ends["__before"][2]
                if ends["__behind"]:
                    m[-1] = ends["__behind"][2]
                if len(x) >= 3:
                    rows_ = _eliminated(x, y, first, total)[1]
                    beside = np.array([1.0, m[0] if low else 0.0, m[-1] if info["__first_behind"] else 0.0])
                    # The knots at the ends of the series are no unknowns of a row.
                    beside[1] = 0.0 if first == 0 else beside[1]
                    beside[2] = 0.0 if first + len(x) == total else beside[2]
                    m[1:-1] = rows_ @ beside
                if first == 0:
                    m[0] = ends["__short"][0]
                if first + len(x) == total:
                    m[-1] = ends["__short"][1]
                value[inside] = _cubic(x, y, m, at[inside])
        back = rows.select([*series, "__i"]).take(pa.array(order))
        return back.append_column("__v", pa.array(value, pa.float64(), from_pandas=True))

    def typed(table: pa.Table, types: dict) -> pa.Schema:
        return pa.schema([*[table.schema.field(s) for s in series], *types.items()])

    pieces = pieces.where("__total > 0")
    pieces = pieces.toDF(*pieces.columns)  # columns of their own beside those of the grid
    left = grid.groupBy(*key).cogroup(pieces.groupBy(*key)).applyInArrow(
        lambda rows, piece: eliminate(rows, piece) if piece.num_rows else typed(rows, _PIECE_TYPES).empty_table(), schema(_PIECE)
    )
    bounds = left.groupBy(*series).applyInArrow(reduce, schema(_BOUNDS))
    told = pieces.join(bounds.drop("__total"), key)
    told = told.toDF(*told.columns)

    def fill_or_leave(rows: pa.Table, piece: pa.Table) -> pa.Table:
        if not piece.num_rows:  # nothing is known of the series
            return rows.select([*series, "__i", "__v"])
        return fill(rows, piece, piece)

    filled = grid.groupBy(*key).cogroup(told.groupBy(*key)).applyInArrow(fill_or_leave, schema("__i long, __v double"))
    return filled.select(
        *series,
        F.timestamp_seconds(F.col("__i") * F.lit(minutes * 60)).alias("datetime"),
        F.col("__v").alias(column),
    )
