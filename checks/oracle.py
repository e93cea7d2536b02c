"""Independent SQL for the registered queries, on the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def fx(value: str, scale: int = 10_000) -> str:
    return f"cast(floor({value} * {scale}.0 + 0.5) as bigint)"


def shown(value: str, digits: int) -> str:
    """``value`` rounded once; the factor keeps exact halves from falling either way."""
    return f"round({value} * 1.000000000001::double, {digits})"


def mean(value: str) -> str:
    """The plain mean, rounded once: the last digits of a sum depend on its order."""
    return shown(f"avg({value})", 6)


def rnd(value: str, digits: int) -> str:
    return f"(cast({fx(value, 10**digits)} as double) / {10**digits}.0)"


# ---- bindings -------------------------------------------------------------

ZONES = """zones as (
    select n_nationkey + 1 as "LocationID", r_name as "Borough", n_name as "Zone"
    from nation join region on n_regionkey = r_regionkey)"""

TRIP_NULLS = """cast(null as double) as passenger_count"""

FREIGHT_RAW = f"""freight_raw as (
    select 'freight_' || l_returnflag as vehicle_type, o_orderdate as pickup_ts,
        l_shipdate as dropoff_ts, c_nationkey + 1 as pu_location_id,
        s_nationkey + 1 as do_location_id, l_quantity as trip_distance,
        l_extendedprice as fare_amount,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) as total_amount,
        l_linenumber as payment_type, cast(null as double) as passenger_count,
        cast(null as integer) as trip_duration_sec, cast(null as varchar) as shared_match_flag,
        strftime(o_orderdate, '%Y-%m') as year_month, l_shipdate as ingestion_ts,
        'lineitem' as source_file, l_orderkey, l_linenumber
    from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey)"""

APP_RAW = """app_raw as (
    select 'app_' || event_type as vehicle_type, ts as pickup_ts,
        cast(null as timestamp) as dropoff_ts, cast(user_id % 25 + 1 as integer) as pu_location_id,
        cast(event_id % 25 + 1 as integer) as do_location_id, cast(null as double) as trip_distance,
        value as fare_amount, value as total_amount, cast(null as integer) as payment_type,
        cast(null as double) as passenger_count,
        cast(floor(value * 60) as integer) as trip_duration_sec,
        case when event_id % 3 = 0 then 'Y' else 'N' end as shared_match_flag,
        strftime(ts, '%Y-%m') as year_month, ts as ingestion_ts, 'events' as source_file, event_id
    from events)"""

TRIP = (
    "vehicle_type, pickup_ts, dropoff_ts, pu_location_id, do_location_id, trip_distance, "
    "fare_amount, total_amount, payment_type, passenger_count, trip_duration_sec, "
    "shared_match_flag, year_month, ingestion_ts, source_file"
).split(", ")


def valid(max_fare: float) -> str:
    return (
        "(pickup_ts is not null and pu_location_id is not null and do_location_id is not null "
        "and pu_location_id between 1 and 24 and do_location_id between 1 and 24 "
        f"and (fare_amount is null or fare_amount between 0 and {max_fare}))"
    )


FREIGHT_VALID, APP_VALID = valid(100000), valid(500)


def latest(source: str, keys: list[str], where: str = "true", columns: list[str] = TRIP) -> str:
    ties = [c for c in TRIP if c not in keys and c != "ingestion_ts"]
    order = ["ingestion_ts desc nulls last", *[f"{c} asc nulls last" for c in ties]]
    return (
        f"select {', '.join(columns)} from {source} where {where} qualify row_number() over "
        f"(partition by {', '.join(keys)} order by {', '.join(order)}) = 1"
    )


FREIGHT_KEYS = ["vehicle_type", "l_orderkey", "l_linenumber"]
SILVER = f"""{ZONES}, {FREIGHT_RAW}, {APP_RAW},
    freight as ({latest('freight_raw', FREIGHT_KEYS, FREIGHT_VALID)}),
    app as ({latest('app_raw', ['vehicle_type', 'event_id'], APP_VALID)}),
    trips as (select * from freight union all select * from app),
    silver as (
        select trips.*, p."Borough" as pu_borough, p."Zone" as pu_zone_name,
            d."Borough" as do_borough, d."Zone" as do_zone_name,
            cast(hour(pickup_ts) as integer) as pickup_hour,
            cast(dayofweek(pickup_ts) + 1 as integer) as pickup_dow,
            cast(pickup_ts as date) as trip_date
        from trips left join zones p on pu_location_id = p."LocationID"
            left join zones d on do_location_id = d."LocationID")"""

WEATHER = f"""weather as (
    select cast(o_orderdate as date) as date, max(o_totalprice) as temp_max,
        min(o_totalprice) as temp_min,
        cast(sum({fx('o_totalprice', 100)}) as double) / 100.0 as precipitation_sum,
        cast(count(*) as integer) as weather_code
    from orders group by 1)"""

INCIDENTS = f"""{ZONES}, incidents as (
    select upper(r_name) as borough, c.crash_date, c.number_of_persons_injured, c.collision_id,
        try_cast(c.crash_date as timestamp) as crash_ts,
        strftime(try_cast(c.crash_date as timestamp), '%Y-%m') as crash_month
    from (select o_custkey,
            case when o_totalprice < 5000 then 'n/a'
                else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') end as crash_date,
            substr(o_orderstatus, 1, 1) as number_of_persons_injured,
            cast(o_orderkey as varchar) as collision_id
        from orders where o_orderpriority = '1-URGENT') c
        join customer on c.o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

STEPS = """steps as (
    select event_type as layer, 'op_' || cast(user_id % 10 as varchar) as operation,
        case when event_id % 7 = 0 then 'error' else 'success' end as status,
        user_id as rows_read, event_id % 5 as rows_written, value as duration_ms,
        (event_id % 4) / 4.0 as null_rate, event_id % 3 as duplicates_removed,
        user_id % 2 as invalid_records, ts as timestamp, event_id as sequence
    from events)"""


def on_silver(body: str) -> str:
    return f"with {SILVER} {body}"


# ---- sources and sinks ----------------------------------------------------

LANDED = """
    select 'freight_' || l_returnflag as feed, o_orderdate, l_shipdate,
        c_nationkey + 1 as from_zone, s_nationkey + 1 as to_zone, l_quantity, l_extendedprice,
        l_orderkey, l_linenumber,
        case when o_orderdate < timestamp '1999-01-01'
            then l_extendedprice * (1 - l_discount) * (1 + l_tax) end as charge,
        case when o_orderdate >= timestamp '1999-01-01' then l_shipdate > o_orderdate end as late,
        'source=freight_' || strftime(o_orderdate, '%Y-%m') as _source_file,
        'freight' as _source_type, strftime(o_orderdate, '%Y-%m') as year_month
    from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey"""
ORACLE["land_feed"] = LANDED
ORACLE["land_stream"] = LANDED
# The chosen year has no file with the added column.
ORACLE["land_selected_months"] = (
    f"select * exclude (late) from ({LANDED}) where year_month like '1998-%'"
)

_PLAIN = f"with {FREIGHT_RAW} select * exclude (ingestion_ts, source_file) from freight_raw"
_PERIOD_COLUMNS = "l_orderkey"
ORACLE["select_months"] = f"{_PLAIN} where year_month = '1997-03'"
ORACLE["select_year"] = f"{_PLAIN} where year_month like '1999-%'"
ORACLE["select_first_n_months"] = f"""{_PLAIN} where year_month in
    (select distinct year_month from freight_raw order by 1 limit 2)"""
ORACLE["period_from_name"] = r"""
    with names as (
        select 'freight_' || strftime(o_orderdate, '%Y-%m') || '_' || o_orderstatus || '.parquet'
            as name from orders
        union all select url from pages)
    select name, case when regexp_matches(name, '\d{4}-\d{2}')
        then regexp_extract(name, '\d{4}-\d{2}') else 'unknown' end as period from names"""
ORACLE["lineage"] = """
    select l_orderkey, l_linenumber, 'lineitem.parquet' as _source_file,
        'freight' as _source_type, 'unknown' as year_month, true as has_time from lineitem"""
ORACLE["partition_overwrite"] = f"""with {FREIGHT_RAW}
    select vehicle_type, year_month, l_orderkey, l_linenumber,
        case when year_month = (select min(year_month) from freight_raw)
            then trip_distance + 1 else trip_distance end as trip_distance
    from freight_raw"""
ORACLE["csv_dimension"] = f"""with {ZONES}
    select "LocationID", "Borough", "Zone", lower("Borough") as service_zone from zones"""
ORACLE["daily_arrays_to_rows"] = f"with {WEATHER} select * from weather"
_RANGE = """range as (
    select cast(date_trunc('month', min(o_orderdate)) as date) as start_date,
        last_day(max(o_orderdate)) as end_date from orders)"""
ORACLE["covering_range"] = f"with {_RANGE} select * from range"
ORACLE["calendar_default"] = f"""with {WEATHER}, {_RANGE}, days as (
        select cast(unnest(generate_series(cast(start_date as timestamp),
            cast(end_date as timestamp), interval 1 day)) as date) as date from range)
    select days.date, coalesce(temp_max, 22.0::double) as temp_max,
        coalesce(temp_min, 12.0::double) as temp_min,
        coalesce(precipitation_sum, 0.0::double) as precipitation_sum,
        cast(coalesce(weather_code, 0) as integer) as weather_code
    from days left join weather on days.date = weather.date"""
ORACLE["clean_incidents"] = f"with {INCIDENTS} select * from incidents"
ORACLE["incident_default"] = """
    select upper(r_name) as borough, '2025-04-01T00:00:00.000' as crash_date,
        '1' as number_of_persons_injured, timestamp '2025-04-01 00:00:00' as crash_ts,
        '2025-04' as crash_month
    from region where r_regionkey in (select n_regionkey from nation)"""
ORACLE["silver_roundtrip"] = on_silver("select * from silver")
_CARRIED = [*TRIP, "l_orderkey", "l_linenumber"]
_DELIVERIES = f"""{FREIGHT_RAW},
    first_delivery as (select {', '.join(_CARRIED)} from freight_raw
        where {FREIGHT_VALID} and not (year_month like '1995-%' and l_linenumber = 7)),
    both_deliveries as (select * from first_delivery union all
        select * replace (trip_distance + 1 as trip_distance, 'late' as source_file,
            case when l_linenumber < 6 then ingestion_ts - interval 1 day
                else ingestion_ts + interval 1 day end as ingestion_ts,
            case when l_linenumber = 6 and l_orderkey % 8 = 1 then '1996-01'
                else year_month end as year_month)
        from (select {', '.join(_CARRIED)} from freight_raw)
        where {FREIGHT_VALID} and year_month like '1995-%' and l_linenumber > 4)"""
ORACLE["silver_merged"] = f"""with {_DELIVERIES}
    {latest('both_deliveries', FREIGHT_KEYS, columns=_CARRIED)}"""
ORACLE["snapshot_read"] = f"""with {_DELIVERIES},
    one as ({latest('first_delivery', FREIGHT_KEYS, columns=_CARRIED)}),
    two as ({latest('both_deliveries', FREIGHT_KEYS, columns=_CARRIED)})
    select *, 1 as version from one union all select *, 2 as version from two"""


def _counts(source: str, where: str, keys: list[str]) -> str:
    return f"""select vehicle_type, count(*) as rows_read,
        {rnd('sum(case when pickup_ts is null then 1 else 0 end) / greatest(count(*), 1)', 4)}
            as null_rate,
        count(*) filter (where not {where}) as invalid_records,
        count(*) filter (where {where}) - count(distinct ({', '.join(keys)}))
            filter (where {where}) as duplicates_removed,
        count(distinct ({', '.join(keys)})) filter (where {where}) as rows_kept
    from {source} group by 1"""


_REPORT = f"""with {FREIGHT_RAW}, {APP_RAW}, report as (
    {_counts('freight_raw', FREIGHT_VALID, FREIGHT_KEYS)} union all
    {_counts('app_raw', APP_VALID, ['vehicle_type', 'event_id'])})"""
ORACLE["quality_report"] = f"{_REPORT} select * from report"
ORACLE["quality_report_of_tables"] = ORACLE["quality_report"]
ORACLE["rejected_trips"] = f"""with {FREIGHT_RAW}, {APP_RAW}
    select vehicle_type, pickup_ts, pu_location_id, do_location_id, fare_amount, trip_distance
    from freight_raw where coalesce(not ({FREIGHT_VALID}), true) union all
    select vehicle_type, pickup_ts, pu_location_id, do_location_id, fare_amount, trip_distance
    from app_raw where coalesce(not ({APP_VALID}), true)"""
ORACLE["reject_counts"] = f"""{_REPORT}
    select vehicle_type, rows_read, invalid_records, duplicates_removed from report"""

# ---- conform, filter, deduplicate, enrich ---------------------------------

ORACLE["conform_feed"] = f"with {FREIGHT_RAW} select * from freight_raw"
ORACLE["conform_sparse_feed"] = f"with {APP_RAW} select * from app_raw"
ORACLE["conform_derived_duration"] = f"""with {FREIGHT_RAW}
    select l_orderkey, l_linenumber, pickup_ts, dropoff_ts,
        cast(date_diff('second', pickup_ts, dropoff_ts) as integer) as trip_duration_sec
    from freight_raw"""
ORACLE["quality_filter"] = f"with {FREIGHT_RAW} select * from freight_raw where {FREIGHT_VALID}"
ORACLE["profile_feed"] = f"""with {FREIGHT_RAW}
    select vehicle_type, count(*) as rows_read,
        count(*) filter (where pickup_ts > dropoff_ts) as null_pickup,
        {rnd('count(*) filter (where pickup_ts > dropoff_ts) / count(*)', 4)} as null_rate
    from freight_raw group by 1"""
ORACLE["dedup_latest"] = f"with {FREIGHT_RAW} {latest('freight_raw', FREIGHT_KEYS)}"
_IDENTITY = TRIP[:5] + ["fare_amount"]
ORACLE["dedup_redelivered"] = f"""with {APP_RAW}, both_deliveries as (
        select {', '.join(TRIP)} from app_raw union all
        select * replace (ingestion_ts + interval 1 day as ingestion_ts,
            total_amount + 1 as total_amount, 'events_again' as source_file)
        from (select {', '.join(TRIP)} from app_raw))
    {latest('both_deliveries', _IDENTITY)}"""
ORACLE["enrich_zones"] = f"""with {ZONES}, {FREIGHT_RAW}
    select freight_raw.* exclude (ingestion_ts, source_file),
        p."Borough" as pu_borough, p."Zone" as pu_zone_name,
        d."Borough" as do_borough, d."Zone" as do_zone_name
    from freight_raw left join zones p on pu_location_id = p."LocationID"
        left join zones d on do_location_id = d."LocationID" """
ORACLE["enrich_zones_repeated"] = ORACLE["enrich_zones"]
_LABELLED = f"""labelled as (
    select * replace (case vehicle_type when 'freight_R' then 'freight' else vehicle_type end
        as vehicle_type) from freight_raw),
    landed as (select * from labelled union all select * from labelled where l_linenumber = 1)"""
ORACLE["silver_all_labels"] = f"""with {FREIGHT_RAW}, {_LABELLED}
    {_counts('landed', FREIGHT_VALID, FREIGHT_KEYS)}"""
ORACLE["time_parts"] = """
    select event_id, ts, cast(hour(ts) as integer) as pickup_hour,
        cast(dayofweek(ts) + 1 as integer) as pickup_dow, cast(ts as date) as trip_date
    from events"""
ORACLE["union_feeds"] = f"""with {FREIGHT_RAW}, {APP_RAW}
    select vehicle_type as feed, pickup_ts as o_orderdate,
        cast(pu_location_id as bigint) as from_zone, cast(do_location_id as bigint) as to_zone,
        trip_distance as l_quantity, fare_amount as l_extendedprice, total_amount as charge,
        l_orderkey, year_month, source_file as _source_file, cast(null as timestamp) as ts,
        cast(null as double) as base_passenger_fare, cast(null as integer) as trip_time,
        cast(null as varchar) as shared_match_flag, cast(null as bigint) as event_id
    from freight_raw
    union all
    select vehicle_type, null, pu_location_id, do_location_id, null, null, null, null, year_month,
        source_file, pickup_ts, fare_amount, trip_duration_sec, shared_match_flag, event_id
    from app_raw"""
ORACLE["feed_subset"] = on_silver(
    "select * from silver where vehicle_type in ('freight_A', 'app_view')"
)

# ---- KPIs -----------------------------------------------------------------

PU = "pu_location_id, pu_borough, pu_zone_name"
DO = "do_location_id, do_borough, do_zone_name"
FARE, TOTAL, DISTANCE = mean("fare_amount"), mean("total_amount"), mean("trip_distance")
DURATION = mean("trip_duration_sec")
N = "count(*) as trip_count"

KPIS = {
    "trips_by_zone_hour": f"select {PU}, pickup_hour, {N} from silver group by all",
    "trips_by_zone_day": f"select {PU}, pickup_dow, {N} from silver group by all",
    "avg_fare_by_feed": f"""select vehicle_type, {FARE} as avg_fare, {TOTAL} as avg_total, {N}
        from silver group by 1""",
    "avg_fare_by_hour": f"""select vehicle_type, pickup_hour, {FARE} as avg_fare, {N}
        from silver group by 1, 2""",
    "avg_distance": f"""select vehicle_type, pu_location_id, pu_zone_name,
        {DISTANCE} as avg_distance, {N} from silver where trip_distance is not null
        group by 1, 2, 3""",
    "monthly_trend": f"""select vehicle_type, year_month, {N}, {FARE} as avg_fare
        from silver group by 1, 2""",
    "top_pickup": f"""select {PU}, {N} from silver group by all
        order by trip_count desc, {PU} limit 10""",
    "top_dropoff": f"""select {DO}, {N} from silver group by all
        order by trip_count desc, {DO} limit 10""",
    "payment_distribution": f"""select vehicle_type, payment_type, {N} from silver
        where payment_type is not null group by 1, 2""",
    "avg_duration": f"""select vehicle_type, {DURATION} as avg_duration_sec, {N} from silver
        where trip_duration_sec is not null group by 1""",
    "shared_rate": """select vehicle_type, count(*) as total_trips,
        count(*) filter (where shared_match_flag = 'Y') as shared_trips,
        count(*) filter (where shared_match_flag = 'Y') / count(*) as shared_rate
        from silver where vehicle_type like 'app_%' group by 1""",
}
for _name, _sql in KPIS.items():
    ORACLE[_name] = on_silver(_sql)
ORACLE["weather_daily"] = f"""with {SILVER}, {WEATHER}
    select date, temp_max, temp_min, precipitation_sum, weather_code, {N}
    from silver join weather on trip_date = date group by 1, 2, 3, 4, 5"""


def _sum(value: str, whole: bool = False) -> str:
    return f"cast(sum({value}) as bigint)" if whole else shown(f"sum({value})", 4)


ORACLE["trip_rollup"] = on_silver(f"""
    select vehicle_type, year_month, trip_date, {PU}, pickup_hour, {N},
        {_sum('fare_amount')} as fare_sum, count(fare_amount) as fare_n,
        {_sum('total_amount')} as total_sum, count(total_amount) as total_n,
        {_sum('trip_distance')} as distance_sum, count(trip_distance) as distance_n,
        {_sum('trip_duration_sec', True)} as duration_sum, count(trip_duration_sec) as duration_n
    from silver group by all""")

ORACLE["trip_side_rollup"] = on_silver(f"""
    select vehicle_type, payment_type, shared_match_flag, {DO}, {N} from silver group by all""")


def _keyed(kpi: str, keys: str, value: str = "cast(null as double)") -> str:
    return f"""select '{kpi}' as kpi, concat_ws('|', {keys}) as group_key, trip_count,
        {value} as mean from ({KPIS[kpi]})"""


ORACLE["kpis_from_rollup"] = on_silver(
    " union all ".join(
        [
            _keyed("trips_by_zone_hour", f"{PU}, pickup_hour"),
            _keyed("trips_by_zone_day", f"{PU}, pickup_dow"),
            _keyed("avg_fare_by_feed", "vehicle_type", "avg_fare"),
            _keyed("avg_fare_by_hour", "vehicle_type, pickup_hour", "avg_fare"),
            _keyed("avg_distance", "vehicle_type, pu_location_id, pu_zone_name", "avg_distance"),
            _keyed("monthly_trend", "vehicle_type, year_month", "avg_fare"),
            _keyed("top_pickup", PU),
            _keyed("avg_duration", "vehicle_type", "avg_duration_sec"),
            _keyed("top_dropoff", DO),
            _keyed("payment_distribution", "vehicle_type, payment_type"),
        ]
    )
)
ORACLE["serving_snapshot"] = ORACLE["trips_by_zone_hour"]

_DAYS = f"""select date, temp_max, temp_min, precipitation_sum, weather_code, {N}
    from silver join weather on trip_date = date group by 1, 2, 3, 4, 5"""


def _numbers(kpi: str, keys: str, *measures: str) -> str:
    """Every number of a KPI as a row of its own."""
    return " union all ".join(
        f"""select '{kpi}' as kpi, concat_ws('|', {keys}) as group_key, '{m}' as measure,
            cast({m} as double) as value from ({_DAYS if kpi == 'weather_daily' else KPIS[kpi]})"""
        for m in measures
    )


ORACLE["all_kpis"] = f"with {SILVER}, {WEATHER} " + " union all ".join(
    [
        _numbers("trips_by_zone_hour", f"{PU}, pickup_hour", "trip_count"),
        _numbers("trips_by_zone_day", f"{PU}, pickup_dow", "trip_count"),
        _numbers("avg_fare_by_feed", "vehicle_type", "trip_count", "avg_fare", "avg_total"),
        _numbers("avg_fare_by_hour", "vehicle_type, pickup_hour", "trip_count", "avg_fare"),
        _numbers(
            "avg_distance", "vehicle_type, pu_location_id, pu_zone_name", "trip_count", "avg_distance"
        ),
        _numbers("monthly_trend", "vehicle_type, year_month", "trip_count", "avg_fare"),
        _numbers("top_pickup", PU, "trip_count"),
        _numbers("avg_duration", "vehicle_type", "trip_count", "avg_duration_sec"),
        _numbers("top_dropoff", DO, "trip_count"),
        _numbers("payment_distribution", "vehicle_type, payment_type", "trip_count"),
        _numbers("shared_rate", "vehicle_type", "total_trips", "shared_trips", "shared_rate"),
        _numbers(
            "weather_daily",
            "date",
            "trip_count",
            "temp_max",
            "temp_min",
            "precipitation_sum",
            "weather_code",
        ),
    ]
)
ORACLE["file_manifest"] = """
    select 'map_' || n_nationkey as file, strlen(n_name || ' ' || n_regionkey) + 1 as file_size_bytes,
        md5(n_name || ' ' || n_regionkey || chr(10)) as content_hash, 'text/plain' as media_type
    from nation"""

# ---- lake -----------------------------------------------------------------

KEY_TEXT = (
    "vehicle_type, epoch_us(pickup_ts) // 1000000, epoch_us(dropoff_ts) // 1000000, "
    f"pu_location_id, do_location_id, {fx('fare_amount')}"
)
SAMPLE_HASH = f"substr(md5(concat_ws('|', {KEY_TEXT})), 1, 8)"
SPLIT_HASH = f"substr(md5(concat_ws('|', {KEY_TEXT})), 9, 8)"


def _below(fraction: float) -> str:
    return f"{round(fraction * 2**32):08x}"


ORACLE["hash_sample"] = on_silver(
    f"select * from silver where {SAMPLE_HASH} < '{_below(0.05)}'"
)
AVERAGES = f"{N}, {FARE} as avg_fare, {DISTANCE} as avg_distance"
OD = f"select vehicle_type, {PU}, {DO}, pickup_hour, {AVERAGES} from silver group by all"
HEAT = f"select vehicle_type, {PU}, pickup_hour, {AVERAGES} from silver group by all"
ORACLE["od_flows"] = on_silver(OD)
ORACLE["zone_heatmap"] = on_silver(HEAT)
ORACLE["serving_capped"] = on_silver(f"""{HEAT}
    order by pu_location_id, pickup_hour, vehicle_type, pu_borough, pu_zone_name, trip_count
    limit 500""")
ROUTES = f"""select vehicle_type, pu_zone_name, pu_borough, do_zone_name, do_borough,
        trip_count, avg_fare, avg_distance
    from ({OD}) order by trip_count desc, vehicle_type, {PU}, {DO}, pickup_hour limit 50"""
ORACLE["top_routes"] = on_silver(ROUTES)

ORACLE["serving_sorted"] = on_silver(
    f"select count(*) as row_count, cast(0 as bigint) as overlapping_files from ({HEAT})"
)

STATS = """select vehicle_type, avg(fare_amount) as mean_fare, stddev_samp(fare_amount) as std_fare,
    avg(trip_distance) as mean_distance, stddev_samp(trip_distance) as std_distance
    from silver group by 1"""
ORACLE["feed_stats"] = on_silver(f"""select vehicle_type, {shown('mean_fare', 4)} as mean_fare,
    {shown('std_fare', 4)} as std_fare, {shown('mean_distance', 4)} as mean_distance,
    {shown('std_distance', 4)} as std_distance from ({STATS})""")
ORACLE["feed_stats_of_rollup"] = ORACLE["feed_stats"]
ORACLE["od_flows_of_rollup"] = ORACLE["od_flows"]
ORACLE["zone_heatmap_of_rollup"] = ORACLE["zone_heatmap"]
ORACLE["feed_stats_narrow"] = """
    with n as (
        select l_returnflag as vehicle_type, 1e6::double + l_partkey::double * 0.001::double as fare,
            1e9::double + l_suppkey::double * 0.5::double as distance
        from lineitem)
    select vehicle_type, format('{:.8e}', avg(fare)) as mean_fare,
        format('{:.8e}', stddev_samp(fare - 1e6::double)) as std_fare,
        format('{:.8e}', avg(distance)) as mean_distance,
        format('{:.8e}', stddev_samp(distance - 1e9::double)) as std_distance
    from n group by vehicle_type"""
SCORED = f"""scored as (
    select silver.*,
        case when std_fare > 0 then abs((fare_amount - mean_fare) / std_fare) else 0.0 end
            as fare_z,
        case when std_distance > 0 then abs((trip_distance - mean_distance) / std_distance)
            else 0.0 end as distance_z
    from silver left join ({STATS}) s on silver.vehicle_type = s.vehicle_type)"""
ORACLE["zscores"] = f"""with {SILVER}, {SCORED}
    select vehicle_type, pickup_ts, pu_location_id, do_location_id, fare_amount, trip_distance,
        {shown('fare_z', 4)} as fare_zscore, {shown('distance_z', 4)} as distance_zscore from scored"""
ORACLE["zscores_any_feed"] = ORACLE["zscores"]


def _tagged(threshold: float) -> str:
    return f"""with {SILVER}, {SCORED}, tagged as (
        select vehicle_type, pickup_ts, dropoff_ts, pu_location_id, pu_zone_name, do_location_id,
            do_zone_name, fare_amount, trip_distance, fare_z, distance_z,
            concat_ws(',', case when fare_z > {threshold} then 'fare_outlier' end,
                case when distance_z > {threshold} then 'distance_outlier' end,
                case when pickup_ts > dropoff_ts then 'time_inversion' end,
                case when pu_location_id = do_location_id then 'same_zone' end) as anomaly_reason,
            source_file
        from scored where fare_z > {threshold} or distance_z > {threshold}),
    anomalies as (select * exclude (fare_z, distance_z), {shown('fare_z', 4)} as fare_zscore,
        {shown('distance_z', 4)} as distance_zscore, fare_z, distance_z from tagged)"""


_OUT = "select * exclude (fare_z, distance_z) from anomalies"
ORACLE["anomalies"] = f"{_tagged(3.0)} {_OUT}"
ORACLE["anomalies_low_threshold"] = f"{_tagged(1.5)} {_OUT}"
ORACLE["anomalies_capped"] = f"""{_tagged(1.5)} {_OUT}
    order by greatest(fare_z, distance_z) desc, vehicle_type, pickup_ts, dropoff_ts nulls last,
        pu_location_id, pu_zone_name, do_location_id, do_zone_name, fare_amount,
        trip_distance nulls last limit 2000"""

MODEL_COLUMNS = (
    "vehicle_type, pickup_hour, pickup_dow, pu_location_id, trip_distance, trip_duration_sec, "
    "split_hash"
)
MODEL_ROWS = f"""model_rows as (
    select *, {SAMPLE_HASH} as sample_hash, {SPLIT_HASH} as split_hash from silver
    where trip_duration_sec > 0)"""
ORACLE["ml_input"] = f"""with {SILVER}, {MODEL_ROWS} select {MODEL_COLUMNS} from model_rows
    where sample_hash < '{_below(0.5)}' and vehicle_type like 'app_%'
    order by sample_hash, vehicle_type, pickup_hour, pickup_dow, pu_location_id,
        trip_duration_sec, split_hash limit 2000"""
ORACLE["ml_features"] = f"""with {SILVER}, {MODEL_ROWS}
    select cast(pickup_hour as double) as pickup_hour, cast(pickup_dow as double) as pickup_dow,
        cast(pu_location_id as double) as pu_location_id,
        coalesce(trip_distance, 0.0::double) as trip_distance,
        coalesce(vehicle_type, 'unknown') as vehicle_type,
        cast(trip_duration_sec as double) as trip_duration_sec, split_hash from model_rows"""
ORACLE["ml_split"] = f"""with {SILVER}, {MODEL_ROWS}
    select {MODEL_COLUMNS}, split_hash < '{_below(0.2)}' as is_test from model_rows"""
ORACLE["model_gradients"] = f"""with {SILVER}, {MODEL_ROWS},
    train as (select * from model_rows where not split_hash < '{_below(0.2)}'),
    features as (
        select unnest(['pickup_hour', 'pickup_dow', 'pu_location_id', 'trip_distance', 'intercept'])
            as feature
        union all select distinct vehicle_type from train)
    select model, feature, (select count(*) from train) as train_rows, 0.0::double as gradient
    from features, (select unnest(['LinearRegression', 'Ridge']) as model)"""
REPORT = f"""{MODEL_ROWS},
    split as (select *, split_hash < '{_below(0.2)}' as is_test from model_rows),
    means as (select vehicle_type, pickup_hour,
            cast(sum(trip_duration_sec) as double) / count(trip_duration_sec) as prediction
        from split where not is_test group by 1, 2),
    predicted as (select split.*, prediction from split left join means
        on split.vehicle_type = means.vehicle_type and split.pickup_hour = means.pickup_hour),
    report as (
        select {rnd('avg(abs(trip_duration_sec - prediction)) filter (where is_test)', 2)}
                as mae_seconds,
            {rnd('''(1 - sum((trip_duration_sec - prediction) * (trip_duration_sec - prediction))
                    filter (where is_test) / (count(prediction) filter (where is_test)
                    * var_pop(trip_duration_sec) filter (where is_test and prediction is not null)))
                 ''', 4)} as r2_score,
            count(*) filter (where not is_test) as train_rows,
            count(*) filter (where is_test) as test_rows
        from predicted)"""
ORACLE["regression_metrics"] = f"with {SILVER}, {REPORT} select * from report"

BY_AREA = """select borough, crash_month, count(*) as collision_count from incidents
    where borough is not null group by 1, 2"""
ORACLE["incidents_by_area_month"] = f"with {INCIDENTS} {BY_AREA}"
ORACLE["incident_trip_join"] = f"""with {SILVER}, {INCIDENTS.replace(ZONES + ',', '')},
    by_area as ({BY_AREA}),
    by_trip as (select upper(pu_borough) as borough, year_month as crash_month,
            count(*) as taxi_trip_count
        from silver where pu_borough is not null group by 1, 2)
    select borough, crash_month, collision_count, taxi_trip_count
    from by_area join by_trip using (borough, crash_month)"""

# What each layout of the raw files is known to hold, next to the months it covers.
_LAYOUT = """months as (
        select distinct strftime(o_orderdate, '%Y-%m') as month, case
            when o_orderdate < timestamp '1997-01-01' then 'declared'
            when o_orderdate < timestamp '1999-01-01' then 'wide' else 'grown' end as layout
        from orders where o_orderkey in (select l_orderkey from lineitem)),
    declared(position, name, type) as (values (0, 'feed', 'string'),
        (1, 'o_orderdate', 'timestamp_ntz'), (2, 'l_shipdate', 'timestamp_ntz'),
        (3, 'from_zone', 'int'), (4, 'to_zone', 'int'), (5, 'l_quantity', 'double'),
        (6, 'l_extendedprice', 'double'), (7, 'charge', 'double'), (8, 'l_orderkey', 'bigint'),
        (9, 'l_linenumber', 'int')),
    layouts as (
        select 'declared' as layout, position, name, type from declared
        union all select 'wide', case name when 'from_zone' then 20 when 'l_linenumber' then 21
                when 'o_orderdate' then 22 else position end,
            case name when 'o_orderdate' then 'O_OrderDate' else name end,
            case when name in ('from_zone', 'l_linenumber') then 'bigint' else type end
        from declared
        union all select 'grown', position, name, type from declared where name <> 'charge'
        union all select 'grown', 30, 'late', 'boolean'),
    columns as (select 'freight' as feed, 'source=freight_' || month as file, layouts.*
        from months join layouts using (layout))"""
ORACLE["schema_files"] = f"""with {_LAYOUT}
    select feed, file, string_agg(name, ',' order by position) as columns,
        count(*) as column_count from columns group by feed, file"""
ORACLE["schema_union"] = f"""with {_LAYOUT}
    select feed, string_agg(distinct name, ',' order by name) as union_columns,
        count(distinct file) as files_analyzed from columns group by feed"""
ORACLE["schema_drift"] = f"""with {_LAYOUT}, per_column as (
        select feed, lower(name) as column_name, count(distinct file) as files_with_column,
            string_agg(distinct type, ',' order by type) as types,
            string_agg(distinct name, ',' order by name) as spellings
        from columns group by feed, lower(name))
    select *, files_with_column <> files_analyzed or contains(types, ',')
            or contains(spellings, ',') as drifts
    from (select *, (select count(distinct file) from columns) as files_analyzed
        from per_column)"""

# ---- run metrics ----------------------------------------------------------

ORACLE["run_metrics"] = """
    select 'silver' as layer, 'count_lineitem' as operation, 'success' as status,
        count(*) as rows_read from lineitem
    union all select 'silver', 'missing_column', 'error', 0"""

STEP_COLUMNS = (
    "layer, operation, status, rows_read, rows_written, duration_ms, null_rate, "
    "duplicates_removed, invalid_records, timestamp, sequence"
)
LATEST = f"""latest as (select {STEP_COLUMNS} from steps qualify row_number() over
    (partition by layer, operation order by timestamp desc, sequence desc) = 1)"""
ORACLE["latest_step"] = f"with {STEPS}, {LATEST} select * from latest"
ORACLE["last_steps"] = f"""with {STEPS} select {STEP_COLUMNS} from steps
    order by timestamp desc, sequence desc limit 8"""
GAUGES = (
    "rows_read rows_written duration_ms null_rate duplicates_removed invalid_records".split()
)


def _samples(source: str) -> str:
    return " union all ".join(
        f"""select 'pipeline_{g}' as name, layer, 'layer="' || layer || '",operation="' ||
            operation || '",status="' || status || '"' as labels, cast({g} as double) as value
            from {source}"""
        for g in GAUGES
    )


ORACLE["metric_samples"] = f"with {STEPS}, {LATEST} {_samples('latest')}"
ORACLE["nonzero_steps"] = f"""with {STEPS}, samples as ({_samples('steps')})
    select * from samples where value > 0 and (name = 'pipeline_rows_written' or
        (layer = 'purchase' and name in ('pipeline_null_rate', 'pipeline_duplicates_removed',
            'pipeline_invalid_records')))"""
ORACLE["duration_rollup"] = f"""with {STEPS}
    select layer, operation, cast(sum({fx('duration_ms')}) as double) / 10000.0 as duration_ms,
        count(*) as steps from steps group by rollup (layer, operation)"""


def _gauge(kpi: str, name: str, labels: dict[str, str], value: str, where: str = "true") -> str:
    text = " || ',' || ".join(
        f"""'{k}="' || replace(cast({v} as varchar), '"', '''') || '"'""" for k, v in labels.items()
    )
    return f"""select '{name}' as name, {text} as labels, cast({value} as double) as value
        from ({KPIS[kpi]}) where {where}"""


_FEED = {"vehicle_type": "vehicle_type"}
_MONTH = {**_FEED, "year_month": "year_month"}
_APP_ONLY = "vehicle_type like 'app_%'"
ORACLE["kpi_samples"] = on_silver(
    " union all ".join(
        [
            _gauge("avg_fare_by_feed", "taxi_avg_fare", _FEED, rnd("avg_fare", 4)),
            _gauge("avg_fare_by_feed", "taxi_trips_total", _FEED, "trip_count"),
            _gauge("monthly_trend", "taxi_monthly_trips", _MONTH, "trip_count"),
            _gauge("monthly_trend", "taxi_monthly_avg_fare", _MONTH, rnd("avg_fare", 4)),
            _gauge(
                "payment_distribution",
                "taxi_payment_trips",
                {**_FEED, "payment_type": "payment_type"},
                "trip_count",
            ),
            _gauge(
                "avg_duration", "taxi_avg_duration_sec", _FEED, rnd("avg_duration_sec", 2), _APP_ONLY
            ),
            _gauge("shared_rate", "taxi_shared_ride_rate", _FEED, rnd("shared_rate", 4), _APP_ONLY),
        ]
    )
)


def _ranked(source: str, name: str, labels: dict[str, str], order: str, n: int) -> str:
    text = " || ',' || ".join(f"""'{k}="' || {v} || '"'""" for k, v in labels.items())
    return f"""select '{name}' as name, 'rank="' || place || '",' || {text} as labels,
        cast(trip_count as double) as value from (
            select *, row_number() over (order by trip_count desc, {order}) as place
            from ({source})) where place <= {n}"""


ORACLE["ranked_samples"] = on_silver(
    " union all ".join(
        [
            _ranked(
                KPIS["top_pickup"],
                "taxi_top_pickup",
                {"zone": "pu_zone_name", "borough": "pu_borough"},
                PU,
                10,
            ),
            _ranked(
                KPIS["top_dropoff"],
                "taxi_top_dropoff",
                {"zone": "do_zone_name", "borough": "do_borough"},
                DO,
                10,
            ),
            _ranked(
                ROUTES,
                "lake_top_route",
                {"from_zone": "pu_zone_name", "to_zone": "do_zone_name"},
                "vehicle_type, pu_zone_name, pu_borough, do_zone_name, do_borough, avg_fare, "
                "avg_distance nulls last",
                15,
            ),
        ]
    )
)
# The twelve KPI tables but that of the shared rides, each counted if it has a row.
_filled = " + ".join(
    f"(select (count(*) > 0)::int from ({sql}))"
    for sql in [*(v for k, v in KPIS.items() if k != "shared_rate"), _DAYS]
)
ORACLE["lake_samples"] = f"""{_tagged(3.0)}, {REPORT}, {WEATHER}
    select 'lake_anomaly_trips_total' as name, '' as labels, cast(count(*) as double) as value
        from tagged
    union all select 'serving_kpi_tables', '', cast({_filled} as double)
    union all select 'serving_lake_tables', '', cast(
        (select count(*) > 0 from tagged)::int + (select count(*) > 0 from silver)::int as double)
    union all select 'lake_ml_mae_seconds', '', {rnd('mae_seconds', 2)} from report
    union all select 'lake_ml_r2_score', '', {rnd('r2_score', 4)} from report"""

TABLES = {
    "fact_lineitem": "lineitem",
    "fact_orders": "orders",
    "fact_events": "events",
    "dim_customer": "customer",
    "dim_supplier": "supplier",
    "dim_part": "part",
    "dim_nation": "nation",
    "dim_region": "region",
    "text_documents": "documents",
    "text_pages": "pages",
    "text_benchmark": "benchmark",
    "text_labels": "labels",
    "text_conversations": "conversations",
    "vector_embeddings": "embeddings",
}
ORACLE["table_inventory"] = (
    "with counts as ("
    + " union all ".join(
        f"select '{k.split('_')[0]}' as prefix, '{k}' as table_name, count(*) as n from {v}"
        for k, v in TABLES.items()
    )
    + """) select prefix, table_name, cast(sum(n) as bigint) as row_count, count(*) as tables
    from counts group by rollup (prefix, table_name)"""
)

ORACLE["serving_reports"] = f"""with {SILVER}, {REPORT}, {_LAYOUT}, per_column as (
        select feed, lower(name) as column_name, count(distinct file) as files_with_column,
            (select count(distinct file) from columns) as files_analyzed
        from columns group by feed, lower(name))
    """ + " union all ".join(
    [
        *(
            f"""select 'duration_model' as report, 'means' as group_key, '{m}' as measure,
                cast({m} as double) as value from report"""
            for m in ("mae_seconds", "r2_score", "train_rows", "test_rows")
        ),
        *(
            f"""select 'schema_drift', feed || '|' || column_name, '{m}', cast({m} as double)
                from per_column"""
            for m in ("files_with_column", "files_analyzed")
        ),
    ]
)
