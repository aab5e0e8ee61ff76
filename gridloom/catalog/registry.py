"""Registration of queries, and helpers that write their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import apply_settings
from gridloom.sources.bindings import Tables, check_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# The time spans of the test tables.
EVENTS = (datetime(2024, 1, 1), datetime(2024, 1, 30, 23, 45))
ORDERS = (datetime(1995, 1, 1), datetime(2002, 1, 1))
EVENT_TYPES = ["purchase", "click", "signup", "view", "error"]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its check SQL."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(apply_settings(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = check_sql(sql)
        return fn

    return wrap


# Engines add in different orders, so computed doubles are compared to 6 decimals. The
# cut lies off the half: means of short decimals fall on halves, and would flip.
def rounded(df: DataFrame, *columns: str, scale: float = 1e6) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(c) * F.lit(scale) + F.lit(0.4871)) / F.lit(scale) for c in columns})


def r6(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.4871e0) / 1e6"


# The arc cosine is only good to a decimetre near 0, so these distances are compared in metres.
def r3(expression: str) -> str:
    return f"floor(({expression}) * 1e3 + 0.4871e0) / 1e3"


def sql_bucket(time: str, minutes: int) -> str:
    return f"time_bucket(interval '{minutes} minutes', {time}, timestamp '1970-01-01')"


def sql_span(start: datetime, end: datetime, time: str = "time") -> str:
    return f"{time} >= timestamp '{start}' and {time} < timestamp '{end}'"


def sql_means(source: str, keys: Sequence[str], columns: Sequence[str], minutes: int, time: str = "time", where: str = "true") -> str:
    """Bucket means of a relation."""
    listed = "".join(f"{k}, " for k in keys)
    cells = ", ".join(f"avg({c}) as {c}" for c in columns)
    return f"""(select {listed}{sql_bucket(time, minutes)} as datetime, {cells} from {source}
        where {where} group by {listed}{sql_bucket(time, minutes)})"""


def sql_present(columns: Sequence[str]) -> str:
    return "(" + " or ".join(f"{c} is not null" for c in columns) + ")"


def sql_fill(
    source: str,
    keys: Sequence[str],
    columns: Sequence[str],
    minutes: int,
    limit: int | None = None,
    tail: bool = True,
    ffill: bool = False,
) -> str:
    """Gap filling by a materialised grid and window functions over it: another route than the library's."""
    listed = "".join(f"{k}, " for k in keys)
    part = f"partition by {', '.join(keys)} " if keys else ""
    group = f"group by {', '.join(keys)}" if keys else ""
    marks, cells = [], []
    for c in columns:
        pos = f"case when {c} is not null then pos end"
        marks.append(
            f"last_value({pos} ignore nulls) over upto as pi_{c}, last_value({c} ignore nulls) over upto as pv_{c}, "
            f"first_value({pos} ignore nulls) over ahead as ni_{c}, first_value({c} ignore nulls) over ahead as nv_{c}"
        )
        cut = f"when pos - pi_{c} > {limit} then null" if limit is not None else ""
        last = f"pv_{c}" if tail else "null"
        between = f"pv_{c}" if ffill else f"pv_{c} + (nv_{c} - pv_{c}) * (pos - pi_{c}) / (ni_{c} - pi_{c})"
        cells.append(
            f"case when pi_{c} is null then null when pos = pi_{c} then pv_{c} {cut} "
            f"when ni_{c} is null then {last} else {between} end as {c}"
        )
    return f"""(
        with given as (select * from {source}),
        ends as (select {listed}min(datetime) as low, max(datetime) as high from given {group}),
        steps as (select {listed}unnest(generate_series(low, high, interval '{minutes} minutes')) as datetime from ends),
        placed as (select {listed}datetime, cast(epoch(datetime) as bigint) // {minutes * 60} as pos, {', '.join(columns)}
            from steps left join given using ({listed}datetime)),
        marked as (select {listed}datetime, pos, {', '.join(marks)} from placed
            window upto as ({part}order by pos rows between unbounded preceding and current row),
                ahead as ({part}order by pos rows between 1 following and unbounded following))
        select {listed}datetime, {', '.join(cells)} from marked)"""


def sql_blend(source: str, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> str:
    """Source blending by ranking the sources that have a value, column by column."""
    listed = ", ".join(keys)
    rank = "case " + " ".join(f"when source = '{s}' then {i}" for i, s in enumerate(order)) + " end"
    inside = ", ".join(f"'{s}'" for s in order)
    cells = ", ".join(f"arg_min({c}, {rank}) filter (where {c} is not null) as {c}" for c in columns)
    return f"(select {listed}, {cells} from {source} where source in ({inside}) group by {listed})"


def sql_geodesic(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The same closed-form distance, spelled in SQL with nested selects avoided."""
    f, g = f"(radians({lat1} + {lat2}) / 2.0e0)", f"(radians({lat1} - {lat2}) / 2.0e0)"
    h = f"(radians({lon1} - {lon2}) / 2.0e0)"
    s = f"(pow(sin({g}), 2) * pow(cos({h}), 2) + pow(cos({f}), 2) * pow(sin({h}), 2))"
    c = f"(pow(cos({g}), 2) * pow(cos({h}), 2) + pow(sin({f}), 2) * pow(sin({h}), 2))"
    w = f"atan2(sqrt({s}), sqrt({c}))"
    r = f"(sqrt({s} * {c}) / {w})"
    shape = (
        f"1.0e0 + (1.0e0 / 298.257223563e0) * ((3.0e0 * {r} - 1.0e0) / (2.0e0 * {c}) * pow(sin({f}), 2) * pow(cos({g}), 2)"
        f" - (3.0e0 * {r} + 1.0e0) / (2.0e0 * {s}) * pow(cos({f}), 2) * pow(sin({g}), 2))"
    )
    return f"case when {s} < 1e-24 then 0.0e0 else 2.0e0 * 6378.137e0 * {w} * ({shape}) end"


def sql_great_circle(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371.0e0 * acos(least(1.0e0, greatest(-1.0e0, cos(radians({lat1})) * cos(radians({lat2})) * "
        f"cos(radians({lon2}) - radians({lon1})) + sin(radians({lat1})) * sin(radians({lat2})))))"
    )


def sql_nearest(sites: str, number: int) -> str:
    """Nearest locations by comparing all pairs."""
    distance = sql_geodesic("s.lat", "s.lon", "l.lat", "l.lon")
    return f"""(select s.site, n.input_city, n.distance, n."rank",
        case when n.input_city is not null then false when s.lat is not null and s.lon is not null then true end as out_of_range
        from {sites} s left join (select site, input_city, distance, "rank" from (select site, input_city, distance,
                row_number() over (partition by site order by distance, input_city) as "rank",
                min(distance) over (partition by site) as closest
            from (select s.site, l.city as input_city, round({distance}, 1) as distance
                from {sites} s, nl_locations l)) where "rank" <= {number} and closest < 150) n on n.site = s.site)"""


def sql_cubic(source: str, key: str, column: str, minutes: int) -> str:
    """Not-a-knot splines inside the known values of a relation on its grid.

    The tridiagonal system of all series at once: forward elimination and back substitution are
    two recursions along the numbers of the knots.
    """
    return f"""(
        with recursive given as (select {key}, datetime, {column} as y, cast(epoch(datetime) as bigint) // {minutes * 60} as x from {source}),
        knots as (
            select {key}, cast(x as double) as x, y, row_number() over along - 1 as i, count(*) over (partition by {key}) as n,
                cast(x - lag(x) over along as double) as hl, cast(lead(x) over along - x as double) as hr,
                lag(y) over along as yl, lead(y) over along as yr
            from given where y is not null window along as (partition by {key} order by x)),
        system as (
            select {key}, i, n,
                case when i = 1 then 0e0 when i = n - 2 then hl - hr * hr / hl else hl end as a,
                2e0 * (hl + hr) + case when i = 1 then hl * (hl + hr) / hr else 0e0 end
                    + case when i = n - 2 then hr * (hl + hr) / hl else 0e0 end as b,
                case when i = n - 2 then 0e0 when i = 1 then hr - hl * hl / hr else hr end as c,
                6e0 * ((yr - y) / hr - (y - yl) / hl) as d
            from knots where n >= 4 and i between 1 and n - 2),
        forward as (
            select {key}, i, n, c / b as cp, d / b as dp from system where i = 1
            union all
            select s.{key}, s.i, s.n, s.c / (s.b - s.a * f.cp), (s.d - s.a * f.dp) / (s.b - s.a * f.cp)
            from forward f join system s on s.{key} = f.{key} and s.i = f.i + 1),
        back as (
            select {key}, i, dp as m from forward where i = n - 2
            union all
            select f.{key}, f.i, f.dp - f.cp * b.m from back b join forward f on f.{key} = b.{key} and f.i = b.i - 1),
        steps as (
            select k.{key}, k.i, k.n, k.hl, k.hr, b.m, lag(b.m) over along as ml, lead(b.m) over along as mr
            from knots k left join back b on b.{key} = k.{key} and b.i = k.i where n >= 4
            window along as (partition by k.{key} order by k.i)),
        bends as (
            select {key}, i, m from steps where i between 1 and n - 2
            union all select {key}, 0, ((hl + hr) * m - hl * mr) / hr from steps where i = 1
            union all select {key}, n - 1, ((hl + hr) * m - hr * ml) / hl from steps where i = n - 2),
        pieces as (
            select k.{key}, k.i, k.n, k.x, k.y, k.hr, k.yr, b.m, lead(b.m) over along as mr,
                first_value(k.x) over whole as x0, first_value(k.y) over whole as y0,
                nth_value(k.x, 2) over whole as x1, nth_value(k.y, 2) over whole as y1,
                nth_value(k.x, 3) over whole as x2, nth_value(k.y, 3) over whole as y2
            from knots k left join bends b on b.{key} = k.{key} and b.i = k.i
            window along as (partition by k.{key} order by k.i),
                whole as (partition by k.{key} order by k.i rows between unbounded preceding and unbounded following))
        select g.{key}, g.datetime, case
            when g.y is not null then g.y
            when p.hr is null then null
            when p.n = 2 then p.y + (p.yr - p.y) * (g.x - p.x) / p.hr
            when p.n = 3 then y0 * (g.x - x1) * (g.x - x2) / ((x0 - x1) * (x0 - x2))
                + y1 * (g.x - x0) * (g.x - x2) / ((x1 - x0) * (x1 - x2)) + y2 * (g.x - x0) * (g.x - x1) / ((x2 - x0) * (x2 - x1))
            else p.y * (p.x + p.hr - g.x) / p.hr + p.yr * (g.x - p.x) / p.hr
                + ((power((p.x + p.hr - g.x) / p.hr, 3) - (p.x + p.hr - g.x) / p.hr) * p.m
                + (power((g.x - p.x) / p.hr, 3) - (g.x - p.x) / p.hr) * p.mr) * p.hr * p.hr / 6e0 end as {column}
        from given g asof left join pieces p on p.{key} = g.{key} and p.x <= g.x)"""
