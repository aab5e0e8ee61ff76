"""The domain tables as views over the test tables, stated once in plain SQL.

The same text is a view in Spark and a common table expression in the check queries, so
both sides start from equal rows. Where the engines spell a function differently the
second text gives the other spelling.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from gridloom.constants import PROFILE_FIELDS

# Declared types: timestamps read as instants, and no job is spent on inference.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}


def _sid(key: str) -> str:
    prefix = f"case when {key} % 3 = 0 then 'pv_' when {key} % 3 = 1 then 'pvx' else 'sys_' end"
    return f"({prefix} || cast({key} as string))"


def _place(key: str) -> str:
    return f"('Supplier#' || lpad(cast({key} as string), 9, '0'))"


_PROFILE_CELLS = ", ".join(
    f"case when user_id % {len(PROFILE_FIELDS)} = {i} then value end as {name}" for i, name in enumerate(PROFILE_FIELDS)
)
_PROFILE_NAME = (
    "case "
    + " ".join(f"when user_id % {len(PROFILE_FIELDS)} = {i} then '{name}'" for i, name in enumerate(PROFILE_FIELDS))
    + " end"
)
# Every profile has a value in each row, so that a batch passes the check for missing ones.
_BATCH_PROFILES = ", ".join(
    f"value + {i} * cast(regexp_extract(props, '([0-9]+)', 1) as double) as {name}" for i, name in enumerate(PROFILE_FIELDS)
)
_LAT = "50 + ({k} * 37 % 350) / 100.0e0"
_LON = "3 + ({k} * 53 % 400) / 100.0e0"
_FORECAST = """
    l_suppkey as pid,
    case when l_returnflag = 'R' then 'est_wind' when l_linenumber = 7 then null else 'demand' end as type,
    l_linestatus as customer,
    l_quantity as forecast, l_discount as stdev, l_extendedprice as forecast_other, l_tax as forecast_solar,
    l_quantity * 0.5e0 as forecast_wind_on_shore
"""
_BATCH = """
    user_id % 97 as pid, 'demand' as type, event_type as customer, date_trunc('hour', ts) as datetimeFC,
    value as forecast, cast(regexp_extract(props, '([0-9]+)', 1) as double) as stdev,
    case when event_id % 3 = 0 then 'substituted' when event_id % 3 = 1 then 'actual' end as quality
"""

BINDINGS: dict[str, str | tuple[str, str]] = {
    "power": f"""select {_sid('user_id')} as system, event_type as type, ts as time, value as output,
        event_id as created from events""",
    "systems": f"""select {_sid('c_custkey')} as sid,
        case when c_custkey % 11 = 0 then null else {_LAT.format(k='c_custkey')} end as lat,
        {_LON.format(k='c_custkey')} as lon,
        'R' || cast(c_nationkey as string) as region, (c_custkey % 100) / 100.0e0 as qual,
        c_custkey % 4 * 5 as freq, (c_custkey % 50) / 2.0e0 as lag, (c_custkey % 60) / 2.0e0 as lagSystems,
        c_custkey % 2 as autoupdate,
        case when c_custkey % 9 = 0 then null else c_nationkey + 3 end as measurements_customer_api_key_id,
        case when c_acctbal < 0 then -1 when c_custkey % 13 = 0 then 0 else 1 end as polarity from customer""",
    "predictions_systems": f"""select c_custkey % 97 as prediction_id, {_sid('c_custkey')} as system_id,
        (c_custkey % 5) / 2.0e0 as factor from customer""",
    "predictions": """select s_suppkey as id,
        case when s_suppkey % 6 = 5 then null else 'ean_' || cast(s_suppkey as string) end as ean,
        case when s_suppkey % 4 = 0 then 'ATO_' || s_name when s_suppkey % 4 = 1 then 'ATO_HS_' || s_name
            else s_name end as name,
        case when s_suppkey % 19 = 18 then null when s_suppkey % 3 = 0 then 'wind' when s_suppkey % 3 = 1 then 'solar'
            else 'demand' end as forecast_type,
        case when s_suppkey % 2 = 0 then 'xgb' else 'lgb' end as model, 2880 as horizon_minutes,
        case when s_suppkey % 17 = 16 then 'not json' when s_suppkey % 4 = 0 then '[15, 2880]'
            when s_suppkey % 4 = 1 then '' when s_suppkey % 4 = 2 then null else '[15, 2880, 15000]'
            end as train_horizons_minutes,
        case when s_suppkey % 2 = 0 then 15 else 60 end as resolution_minutes, 1 as train_components,
        case when s_suppkey % 5 = 0 then 0 else 1 end as active from supplier""",
    "customers": "select n_nationkey as id, n_name as name from nation",
    "customers_predictions": "select s_nationkey as customer_id, s_suppkey as prediction_id from supplier",
    "customersApiKeys": """select n_nationkey + 2 as cid, 'key_' || cast(n_nationkey % 10 as string) as apiKey
        from nation""",
    "systemsApiKeys": "select n_nationkey as id, 'skey_' || cast(n_nationkey as string) as apiKey from nation",
    "quantile_sets": """select r_regionkey as id, case when r_regionkey % 3 = 0 then '[0.9, 0.1, 0.5]'
        when r_regionkey % 3 = 1 then '[0.5, 0.05]' else '[0.95]' end as quantiles from region""",
    "predictions_quantile_sets": """select s_suppkey as prediction_id, s_nationkey % 5 as quantile_set_id from supplier
        union all select s_suppkey, cast(s_suppkey % 7 as int) from supplier""",
    "windspecs": f"""select s_suppkey as pid, {_LAT.format(k='s_suppkey')} as lat, {_LON.format(k='s_suppkey')} as lon,
        'turbine_' || cast(s_suppkey * 3 as string) as turbine_type, s_nationkey as n_turbines,
        80 + s_nationkey as hub_height from supplier""",
    "solarspecs": f"""select s_suppkey as pid, {_LAT.format(k='s_suppkey')} as lat, {_LON.format(k='s_suppkey')} as lon,
        s_nationkey / 2.0e0 as radius, s_acctbal as peak_power from supplier""",
    "genericpowercurves": """select 'turbine_' || cast(p_partkey as string) as name, p_size as cut_in, p_brand as kind,
        cast(p_retailprice as string) as rated_power, cast(p_size as string) as slope_center,
        cast(p_partkey as string) as steepness from part""",
    "weatherforecastlocations": f"""select s_name as input_city, {_LAT.format(k='s_suppkey')} as lat,
        {_LON.format(k='s_suppkey')} as lon, case when s_suppkey % 10 = 9 then 'BE' else 'NL' end as country,
        case when s_suppkey % 7 = 6 then 0 else 1 end as active from supplier""",
    "NameToLatLon": """select n_name as regionInput, 50 + n_nationkey / 10.0e0 as lat, 4 + n_regionkey / 10.0e0 as lon
        from nation where n_regionkey <> 3""",
    "weather": f"""select {_place('user_id')} as input_city, event_type as source, date_trunc('hour', ts) as time,
        value as temp, cast(regexp_extract(props, '([0-9]+)', 1) as double) as clouds, value * 3.0e0 as radiation,
        case when user_id % 7 = 3 then null else value / 10.0e0 end as windspeed_100m, value / 20.0e0 as windspeed,
        (event_id % 360) * 1.0e0 as winddeg, 1000 + value as pressure, (user_id % 100) / 100.0e0 as humidity,
        case when event_id % 5 = 0 then null else value / 50.0e0 end as rain, value * 0.5e0 as mxlD,
        (user_id % 3) * 1.0e0 as snowDepth, value * 7.0e0 as clearSky_ulf, value * 9.0e0 as clearSky_dlf,
        value / 3.0e0 as ssrunoff, event_id as source_run
        from events""",
    "weather_daily": f"""select {_place('l_suppkey')} as input_city, l_returnflag || l_linestatus as source,
        l_shipdate as time, l_quantity as temp, case when l_linenumber = 3 then null else l_discount end as clouds,
        case when l_returnflag = 'A' then null else l_tax end as rain from lineitem""",
    "weather_tAhead": f"""select {_place('(l_suppkey % 10)')} as input_city, l_returnflag as source, l_shipdate as time,
        (l_linenumber % 4) * 24.0e0 as tAhead, l_quantity as temp,
        case when l_linestatus = 'F' then null else l_discount end as clouds from lineitem""",
    "prediction": f"""select {_FORECAST}, l_shipdate as time,
        l_quantity * 0.8e0 as quantile_P10, l_quantity * 1.0e0 as quantile_P50, l_quantity * 1.2e0 as quantile_P90,
        case when l_linenumber % 3 = 0 then 'substituted' when l_linenumber % 3 = 1 then 'actual' end as quality
        from lineitem""",
    "prediction_tAheads": f"""select {_FORECAST}, l_shipdate as time,
        case when l_linenumber % 4 = 0 then 1.0e0 when l_linenumber % 4 = 1 then 4.0e0
            when l_linenumber % 4 = 2 then 24.0e0 else 47.0e0 end as tAhead from lineitem""",
    # Forecasts with their moment of creation: what a writer receives.
    "forecast_batches": (
        f"""select {_BATCH}, unix_seconds(date_trunc('day', ts)) - user_id % 5 * 86400 as created from events""",
        f"""select {_BATCH}, cast(epoch(date_trunc('day', ts)) as bigint) - user_id % 5 * 86400 as created from events""",
    ),
    "weather_batches": (
        f"""select {_place('user_id')} as input_city, event_type as source, date_trunc('hour', ts) as datetime,
        value as temp, value / 10.0e0 as windspeed,
        unix_seconds(date_trunc('day', ts)) - user_id % 5 * 86400 as created from events""",
        f"""select {_place('user_id')} as input_city, event_type as source, date_trunc('hour', ts) as datetime,
        value as temp, value / 10.0e0 as windspeed,
        cast(epoch(date_trunc('day', ts)) as bigint) - user_id % 5 * 86400 as created from events""",
    ),
    "measurement_texts": (
        """select event_id, value as output, case when event_id % 7 = 0 then cast(date_trunc('hour', ts) as string)
            when event_id % 7 = 1 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
            when event_id % 7 = 2 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || 'Z' when event_id % 7 = 3 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || '+02:00'
            else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || '+0100' end as datetime from events""",
        """select event_id, value as output, case when event_id % 7 = 0 then cast(date_trunc('hour', ts) as string)
            when event_id % 7 = 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
            when event_id % 7 = 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' when event_id % 7 = 3 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
            else strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0100' end as datetime from events""",
    ),
    "kpis": """select user_id % 97 as pid, cast(((event_id % 5) * 1.5e0) as string) || 'h' as horizon,
        date_trunc('day', ts) as date,
        case when event_type = 'click' then 'rMAE' when event_type = 'view' then 'bias' else 'skill' end as kpi,
        case when event_id % 50 = 0 then cast('Infinity' as double)
            when event_id % 50 = 1 then cast('-Infinity' as double)
            when event_id % 50 = 2 then null when event_id % 50 = 3 then cast('NaN' as double)
            else value end as value from events""",
    "marketprices": "select o_orderpriority as Name, o_orderdate as time, o_totalprice as Price from orders",
    "marketprices_hourly": """select case when event_type = 'purchase' then 'NL' else event_type end as Name,
        date_trunc('hour', ts) as time, value as Price from events""",
    "profile_points": f"""select ts as time, 'y' || cast(user_id % 2 as string) as year_created,
        {_PROFILE_NAME} as field, value from events""",
    "sjv": f"select ts as time, 'y2024' as year_created, {_PROFILE_CELLS} from events",
    "profile_batch": f"""select ts as time, 'y' || cast(user_id % 2 as string) as year_created, {_BATCH_PROFILES}
        from events""",
    # A feed with corrections: every third reading is sent again later with another value.
    "power_feed": """select time, system, type, output, created from power union all
        select time, system, type, output * 2.0e0 + 1.0e0 as output, created + 1000000000 as created from power
        where created % 3 = 0""",
    "energy_split_coefs": """select l_suppkey as pid, l_linestatus as coef_name, l_shipdate as created,
        l_discount as coef_value from lineitem""",
    # Positions of the forecasting jobs, as (site, lat, lon).
    "sites": f"""select prediction_id as site, min(lat) as lat, min(lon) as lon
        from predictions_systems join systems on system_id = sid where lat is not null group by prediction_id""",
    "customer_sites": f"""select c_custkey as site, {_LAT.format(k='c_custkey')} as lat, {_LON.format(k='c_custkey')} as lon
        from customer""",
    "nl_locations": """select input_city as city, lat, lon from weatherforecastlocations
        where country = 'NL' and active = 1""",
}


def _names_in(text: str, names) -> list[str]:
    words = set(re.findall(r"\b\w+\b", re.sub(r"'[^']*'", "", text)))
    return [n for n in names if n in words]


class Tables:
    """The domain tables of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._seen = spark, folder.rstrip("/"), {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BINDINGS:
            raise AttributeError(name)
        if name not in self._seen:
            text = BINDINGS[name]
            text = text if isinstance(text, str) else text[0]
            views = {n: self.raw(n) for n in _names_in(text, RAW_SCHEMAS)}
            views |= {n: getattr(self, n) for n in _names_in(text, BINDINGS) if n != name}
            for n in views:
                text = re.sub(rf"\b(from|join) {n}\b", rf"\1 {{{n}}}", text)
            views = {n: v for n, v in views.items() if f"{{{n}}}" in text}
            self._seen[name] = self.spark.sql(text, **views)
        return self._seen[name]


def check_sql(text: str) -> str:
    """A check query with the bindings it names put in front as common table expressions."""
    wanted: list[str] = []

    def visit(body: str) -> None:
        for name in re.findall(r"(?:\bfrom|\bjoin|,)\s+(\w+)\b", body):
            if name in BINDINGS and name not in wanted:
                other = BINDINGS[name]
                visit(other if isinstance(other, str) else other[1])
                if name not in wanted:
                    wanted.append(name)

    visit(text)
    parts = []
    for name in wanted:
        body = BINDINGS[name]
        parts.append(f"{name} as ({body if isinstance(body, str) else body[1]})")
    lead = "with " + ",\n".join(parts) if parts else ""
    text = text.strip()
    if parts and text.startswith("with "):
        return f"{lead},\n{text[5:]}"
    return f"{lead}\n{text}"
