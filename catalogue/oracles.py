"""DuckDB SQL that gives the same result as each registered query, from the given tables."""

from catalogue.inputs import (
    AS_OF,
    EID_RISE,
    FIRST_CUT,
    FIRST_LOAD,
    LOADED_AT,
    RELOAD_CUT,
    SECOND_CUT,
    SECOND_LOAD,
)

TOTAL = "total_fare_bdt"
FIELDS = """airline, source_code, source_name, destination_code, destination_name, departure_datetime,
 arrival_datetime, duration_hrs, stopovers, aircraft_type, travel_class, booking_source, base_fare_bdt,
 tax_surcharge_bdt, total_fare_bdt, seasonality, days_before_departure"""


def r(expression, digits=2):
    return f"CAST(round(TRY_CAST({expression} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def initcap(e):
    words = f"regexp_extract_all(lower({e}), '[a-z0-9]+|[^a-z0-9]+')"
    return f"array_to_string([upper(w[1]) || w[2:] FOR w IN {words}], '')"


def percentile(value, p, where=""):
    return f"quantile_cont({value}, {p}) {where}"


BOOKINGS = f"""
SELECT *, {r('base_fare_bdt + tax_surcharge_bdt')} AS total_fare_bdt FROM (
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS id,
 p_brand AS airline,
 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS source_code, 'NATION_' || s_nationkey AS source_name,
 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS destination_code, 'NATION_' || c_nationkey AS destination_name,
 l_shipdate AS departure_datetime, l_shipdate + to_hours(CAST(l_quantity AS BIGINT)) AS arrival_datetime,
 l_quantity AS duration_hrs,
 CASE WHEN l_linenumber <= 3 THEN 'Direct' WHEN l_linenumber <= 5 THEN '1 Stop' ELSE '2 Stops' END AS stopovers,
 p_type AS aircraft_type,
 CASE left(o_orderpriority, 1) WHEN '1' THEN 'First Class' WHEN '2' THEN 'biz' WHEN '3' THEN 'Premium'
  WHEN '4' THEN 'economy' ELSE ' coach ' END AS travel_class,
 CASE l_returnflag WHEN 'A' THEN 'Direct Booking' WHEN 'N' THEN 'Travel Agency' ELSE 'Online Website' END AS booking_source,
 l_extendedprice AS base_fare_bdt, {r('l_extendedprice * l_tax')} AS tax_surcharge_bdt,
 CASE month(l_shipdate) WHEN 12 THEN 'Winter Holidays' WHEN 1 THEN 'Winter Holidays' WHEN 4 THEN 'Eid'
  WHEN 6 THEN 'Hajj' ELSE 'Regular' END AS seasonality,
 CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days_before_departure
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
 JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)"""


def blank(c):
    return f"({c} IS NULL OR trim({c}) = '')"


ERRORS = f"""nullif(concat_ws('; ',
 CASE WHEN {blank('airline')} THEN 'airline is required' END,
 CASE WHEN {blank('source_code')} THEN 'source_code is required' END,
 CASE WHEN {blank('destination_code')} THEN 'destination_code is required' END,
 CASE WHEN base_fare_bdt IS NULL OR base_fare_bdt <= 0 THEN 'base_fare_bdt must be positive' END,
 CASE WHEN total_fare_bdt IS NULL OR total_fare_bdt <= 0 THEN 'total_fare_bdt must be positive' END,
 CASE WHEN tax_surcharge_bdt IS NULL OR tax_surcharge_bdt < 0 THEN 'tax_surcharge_bdt cannot be negative' END,
 CASE WHEN length(coalesce(source_code, 'None')) <> 3 THEN 'source_code must be 3 characters' END,
 CASE WHEN length(coalesce(destination_code, 'None')) <> 3 THEN 'destination_code must be 3 characters' END,
 CASE WHEN duration_hrs IS NULL OR duration_hrs <= 0 THEN 'duration_hrs must be positive' END,
 CASE WHEN days_before_departure IS NULL OR days_before_departure < 1
  THEN 'days_before_departure must be at least 1' END), '')"""


def text2(c):
    return f"coalesce(CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR), 'None')"


HASH = f"""md5(concat_ws('|', coalesce(airline, 'None'), coalesce(source_code, 'None'),
 coalesce(destination_code, 'None'), coalesce(strftime(departure_datetime, '%Y-%m-%d %H:%M:%S'), 'None'),
 {text2('base_fare_bdt')}, {text2('total_fare_bdt')}, coalesce(travel_class, 'None'), coalesce(booking_source, 'None')))"""


def class_name(c):
    u = f"upper(trim({c}))"
    return f"""CASE WHEN {u} IN ('FIRST CLASS', 'FIRST', '1ST CLASS', '1ST') THEN 'First'
 WHEN {u} IN ('BUSINESS CLASS', 'BUSINESS', 'BIZ') THEN 'Business'
 WHEN {u} IN ('ECONOMY CLASS', 'ECONOMY', 'COACH') THEN 'Economy'
 WHEN {u} IN ('PREMIUM ECONOMY', 'PREMIUM', 'PREMIUM ECO') THEN 'Premium Economy'
 ELSE {initcap(f'trim({c})')} END"""


def any_like(c, words):
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def peak(c):
    words = ["EID", "HAJJ", "RAMADAN", "DIWALI", "PUJA", "CHRISTMAS", "EASTER", "HOLI", "DURGA", "NAVRATRI",
             "DUSSEHRA", "THANKSGIVING", "NEW YEAR", "FESTIVAL", "PEAK", "HIGH SEASON", "VACATION", "BREAK",
             "WINTER"]
    return f"CASE WHEN {any_like(f'upper({c})', words)} THEN TRUE ELSE FALSE END"


def season_category(c):
    u = f"upper({c})"
    return f"""CASE WHEN {u} = 'REGULAR' THEN 'Regular'
 WHEN {any_like(u, ['EID', 'HAJJ', 'CHRISTMAS', 'EASTER', 'PUJA', 'DIWALI'])} THEN 'Religious'
 WHEN {any_like(u, ['WINTER', 'SUMMER'])} THEN 'Seasonal' WHEN contains({u}, 'HOLIDAY') THEN 'Holiday'
 WHEN contains({u}, 'FESTIVAL') THEN 'Festival' WHEN contains({u}, 'VACATION') THEN 'Vacation' ELSE 'Other' END"""


def stops(c):
    return f"CASE WHEN {c} = 'Direct' THEN 0 WHEN {c} LIKE '%1%' THEN 1 WHEN {c} LIKE '%2%' THEN 2 END"


def band(c):
    return f"CASE WHEN {c} < 10000 THEN 'Budget' WHEN {c} < 50000 THEN 'Mid-Range' WHEN {c} < 100000 THEN 'Premium' ELSE 'Luxury' END"


def window(c):
    return f"CASE WHEN {c} <= 7 THEN 'Last Minute' WHEN {c} <= 14 THEN 'Short Notice' WHEN {c} <= 30 THEN 'Advance' ELSE 'Early Bird' END"


def weekpart(ts):
    return f"CASE WHEN dayofweek({ts}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END"


DOMESTIC = "('N00','N01','N02','N03','N04','N05','N06','N07')"


def kind(s, d="destination_code"):
    return f"CASE WHEN {s} IN {DOMESTIC} AND {d} IN {DOMESTIC} THEN 'Domestic' ELSE 'International' END"


def silver_of(source):
    return f"""SELECT id, {initcap('trim(airline)')} AS airline, upper(trim(source_code)) AS source_code,
 {initcap('trim(source_name)')} AS source_name, upper(trim(destination_code)) AS destination_code,
 {initcap('trim(destination_name)')} AS destination_name,
 upper(trim(source_code)) || '-' || upper(trim(destination_code)) AS route, departure_datetime, arrival_datetime,
 duration_hrs, CAST(year(departure_datetime) AS INTEGER) AS departure_year,
 CAST(month(departure_datetime) AS INTEGER) AS departure_month,
 CAST(dayofweek(departure_datetime) AS INTEGER) AS departure_day_of_week,
 {weekpart('departure_datetime')} AS departure_day_type, stopovers,
 CAST({stops('stopovers')} AS INTEGER) AS num_stops, aircraft_type, {class_name('travel_class')} AS travel_class,
 booking_source, base_fare_bdt, tax_surcharge_bdt, total_fare_bdt,
 {r('tax_surcharge_bdt / nullif(base_fare_bdt, 0) * 100')} AS tax_percentage, {band('total_fare_bdt')} AS fare_category,
 seasonality, {peak('seasonality')} AS is_peak_season, {season_category('seasonality')} AS season_category,
 days_before_departure, {window('days_before_departure')} AS booking_window, {kind('source_code')} AS route_type,
 {HASH} AS record_hash
FROM {source}"""


RISE = f"CASE WHEN seasonality = 'Eid' THEN {EID_RISE} ELSE 0 END"
REPRICED = f"SELECT * REPLACE (base_fare_bdt + {RISE} AS base_fare_bdt, total_fare_bdt + {RISE} AS total_fare_bdt)"

PARTS = {
    "bookings": BOOKINGS,
    "validated": f"SELECT *, validation_errors IS NULL AS is_valid FROM (SELECT *, {ERRORS} AS validation_errors FROM bookings)",
    "valid": "SELECT * FROM validated WHERE is_valid",
    "silver": silver_of("valid"),
    "first_extract": f"SELECT *, {HASH} AS record_hash FROM valid WHERE departure_datetime < TIMESTAMP '{FIRST_CUT}'",
    "second_extract": f"SELECT *, {HASH} AS record_hash FROM ({REPRICED} FROM valid WHERE departure_datetime >= TIMESTAMP '{SECOND_CUT}')",
    "reload_extract": f"SELECT *, {HASH} AS record_hash FROM ({REPRICED} FROM valid WHERE departure_datetime >= TIMESTAMP '{RELOAD_CUT}')",
    "load_log": f"""SELECT date_trunc('month', departure_datetime)::TIMESTAMP AS load_timestamp,
 count(*) FILTER (WHERE is_valid) AS records_inserted,
 count(*) FILTER (WHERE seasonality = 'Regular' AND NOT is_valid) AS records_deleted,
 count(*) FILTER (WHERE seasonality <> 'Regular' AND NOT is_valid) AS records_unchanged,
 {r('100.0::DOUBLE * count(*) FILTER (WHERE is_valid) / count(*)')} AS change_percentage,
 CAST(sum(duration_hrs) AS BIGINT) AS execution_time_seconds,
 CASE WHEN {r('100.0::DOUBLE * count(*) FILTER (WHERE is_valid) / count(*)')} > 50 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type
 FROM validated GROUP BY 1""",
    "model_history": f"""SELECT date_trunc('month', departure_datetime)::TIMESTAMP AS training_timestamp,
 count(*) AS training_records, {r('corr(total_fare_bdt, base_fare_bdt) * corr(total_fare_bdt, base_fare_bdt)', 4)} AS test_r2,
 {r('avg(total_fare_bdt - base_fare_bdt)', 4)} AS test_mae, min(airline) AS model_type,
 'model_' || strftime(date_trunc('month', departure_datetime), '%Y%m') AS model_name,
 month(date_trunc('month', departure_datetime)) <> 12 AS is_production
 FROM valid GROUP BY date_trunc('month', departure_datetime)""",
    "last_load": "SELECT * FROM load_log ORDER BY load_timestamp DESC LIMIT 1",
    "last_model": "SELECT * FROM model_history WHERE is_production ORDER BY training_timestamp DESC LIMIT 1",
    "audit": """SELECT event_id AS id, 'events' AS dag_id, CAST(user_id AS VARCHAR) AS dag_run_id, event_type AS task_id,
 CASE WHEN value < 10 THEN 'started' WHEN value < 90 THEN 'completed' ELSE 'failed' END AS status,
 CASE WHEN value < 10 THEN ts END AS started_at, CASE WHEN value >= 10 THEN ts END AS completed_at,
 CAST(floor(value) AS BIGINT) AS rows_processed, CASE WHEN value >= 90 THEN props END AS error_message FROM events""",
}
NEEDS = {
    "bookings": [], "validated": ["bookings"], "valid": ["validated"], "silver": ["valid"],
    "first_extract": ["valid"], "second_extract": ["valid"], "reload_extract": ["valid"],
    "load_log": ["validated"], "model_history": ["valid"], "last_load": ["load_log"],
    "last_model": ["model_history"], "audit": [],
}


def with_(names, sql, **more):
    """SQL behind the WITH clause that holds the named parts and what they need."""
    order = []

    def visit(name):
        for n in NEEDS.get(name, []):
            visit(n)
        if name not in order:
            order.append(name)

    for name in names.split():
        visit(name)
    parts = [f"{n} AS ({PARTS[n]})" for n in order] + [f"{n} AS ({s})" for n, s in more.items()]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def col_or(c, cond, value="NULL"):
    return f"CASE WHEN {cond} THEN {value} ELSE {c} END"


DIRTY = f"""SELECT id,
 CASE WHEN duration_hrs = 1 THEN '  ' WHEN duration_hrs = 2 THEN NULL ELSE airline END AS airline,
 CASE WHEN duration_hrs = 3 THEN ' ' || source_code WHEN duration_hrs = 4 THEN NULL ELSE source_code END AS source_code,
 source_name, destination_code, destination_name, departure_datetime, arrival_datetime,
 CASE WHEN duration_hrs = 9 THEN 0.0 WHEN duration_hrs = 10 THEN NULL ELSE duration_hrs END AS duration_hrs,
 stopovers, aircraft_type, travel_class, booking_source,
 CASE WHEN duration_hrs = 5 THEN 0.0 ELSE base_fare_bdt END AS base_fare_bdt,
 CASE WHEN duration_hrs = 7 THEN -1.0 WHEN duration_hrs = 8 THEN NULL ELSE tax_surcharge_bdt END AS tax_surcharge_bdt,
 CASE WHEN duration_hrs = 6 THEN NULL ELSE total_fare_bdt END AS total_fare_bdt, seasonality,
 CASE WHEN duration_hrs = 11 THEN NULL ELSE days_before_departure END AS days_before_departure
FROM bookings"""

SEASONS = """SELECT * REPLACE (CASE WHEN aircraft_type = 'ECONOMY' THEN seasonality || ' break'
 WHEN duration_hrs = 1 THEN 'Ramadan' WHEN duration_hrs = 2 THEN 'Summer Holiday' WHEN duration_hrs = 3 THEN 'summer'
 WHEN duration_hrs = 4 THEN ' Regular' WHEN duration_hrs = 5 THEN 'Wine Festival'
 WHEN duration_hrs = 6 THEN 'School vacation' WHEN duration_hrs = 7 THEN 'Spring Holidays'
 WHEN duration_hrs = 8 THEN 'Off-Peak' WHEN duration_hrs = 10 THEN 'Winter' WHEN duration_hrs = 9 THEN NULL
 ELSE seasonality END AS seasonality) FROM validated"""

GAPS = """SELECT id, CASE WHEN seasonality <> 'Hajj' THEN total_fare_bdt END AS total_fare_bdt,
 CASE WHEN duration_hrs <= 40 THEN duration_hrs END AS duration_hrs, base_fare_bdt,
 CASE WHEN booking_source <> 'Online Website' THEN travel_class END AS travel_class FROM validated"""

PK, OFF = "FILTER (WHERE is_peak_season)", "FILTER (WHERE NOT is_peak_season)"
PREMIUM = r(f"(avg({TOTAL}) {PK} - avg({TOTAL}) {OFF}) / nullif(avg({TOTAL}) {OFF}, 0) * 100")


def cnt(where):
    return f"count(*) FILTER (WHERE {where})"


def avg(c, where=None):
    return r(f"avg({c})" + (f" FILTER (WHERE {where})" if where else ""))


BY_AIRLINE = f"""SELECT airline, count(*) AS total_bookings, {avg('base_fare_bdt')} AS avg_base_fare,
 {avg('tax_surcharge_bdt')} AS avg_tax_surcharge, {avg(TOTAL)} AS avg_total_fare, {r(f'min({TOTAL})')} AS min_fare,
 {r(f'max({TOTAL})')} AS max_fare, {r(f'stddev_samp({TOTAL})')} AS fare_std_dev,
 {r(percentile(TOTAL, .5))} AS median_fare, {r(percentile(TOTAL, .25))} AS fare_25th_percentile,
 {r(percentile(TOTAL, .75))} AS fare_75th_percentile,
 {cnt("travel_class = 'Economy'")} AS economy_bookings, {cnt("travel_class = 'Business'")} AS business_bookings,
 {cnt("travel_class = 'First'")} AS first_class_bookings,
 {cnt("travel_class = 'Premium Economy'")} AS premium_economy_bookings,
 {cnt("travel_class NOT IN ('Economy', 'Business', 'First', 'Premium Economy')")} AS other_class_bookings,
 {cnt("route_type = 'Domestic'")} AS domestic_bookings, {cnt("route_type = 'International'")} AS international_bookings,
 {cnt('is_peak_season')} AS peak_season_bookings, {cnt('NOT is_peak_season')} AS off_peak_bookings,
 {avg(TOTAL, 'is_peak_season')} AS avg_peak_fare, {avg(TOTAL, 'NOT is_peak_season')} AS avg_off_peak_fare,
 {PREMIUM} AS peak_premium_pct, {avg('duration_hrs')} AS avg_duration_hrs,
 {r('count(*)::DOUBLE / sum(count(*)) OVER () * 100')} AS market_share_pct
FROM silver GROUP BY airline"""

BOOKING_COUNT = f"""SELECT airline, count(*) AS total_bookings,
 {cnt("booking_source = 'Direct Booking'")} AS direct_bookings, {cnt("booking_source = 'Travel Agency'")} AS agency_bookings,
 {cnt("booking_source = 'Online Website'")} AS online_bookings, {cnt("booking_window = 'Last Minute'")} AS last_minute_bookings,
 {cnt("booking_window = 'Short Notice'")} AS short_notice_bookings, {cnt("booking_window = 'Advance'")} AS advance_bookings,
 {cnt("booking_window = 'Early Bird'")} AS early_bird_bookings, {cnt('is_peak_season')} AS peak_season_bookings,
 {cnt('NOT is_peak_season')} AS off_peak_bookings, {cnt("season_category = 'Regular'")} AS regular_bookings,
 {cnt("season_category = 'Religious'")} AS religious_holiday_bookings,
 {cnt("season_category = 'Seasonal'")} AS seasonal_holiday_bookings,
 {cnt("season_category = 'Holiday'")} AS general_holiday_bookings, {cnt("season_category = 'Other'")} AS other_season_bookings,
 {cnt("departure_day_type = 'Weekday'")} AS weekday_bookings, {cnt("departure_day_type = 'Weekend'")} AS weekend_bookings,
 {r('avg(days_before_departure)', 1)} AS avg_days_before_departure,
 {r(f"{cnt('is_peak_season')}::DOUBLE / count(*) * 100")} AS peak_season_pct,
 {r('count(*)::DOUBLE / sum(count(*)) OVER () * 100')} AS market_share_pct
FROM silver GROUP BY airline"""

BY_CLASS = f"""SELECT travel_class, count(*) AS total_bookings, {avg('base_fare_bdt')} AS avg_base_fare,
 {avg('tax_surcharge_bdt')} AS avg_tax, {avg(TOTAL)} AS avg_total_fare, {r(f'min({TOTAL})')} AS min_fare,
 {r(f'max({TOTAL})')} AS max_fare, {r(percentile(TOTAL, .5))} AS median_fare,
 {avg(TOTAL, "route_type = 'Domestic'")} AS avg_domestic_fare,
 {avg(TOTAL, "route_type = 'International'")} AS avg_international_fare,
 {cnt("route_type = 'Domestic'")} AS domestic_bookings, {cnt("route_type = 'International'")} AS international_bookings,
 {avg(TOTAL, 'is_peak_season')} AS avg_peak_season_fare, {avg(TOTAL, 'NOT is_peak_season')} AS avg_regular_fare,
 {cnt('is_peak_season')} AS peak_season_bookings, {cnt('NOT is_peak_season')} AS off_peak_bookings,
 {PREMIUM} AS peak_premium_pct, {avg('duration_hrs')} AS avg_duration_hrs,
 {r('count(*)::DOUBLE / sum(count(*)) OVER () * 100')} AS class_share_pct
FROM silver GROUP BY travel_class"""

ROUTES = f"""SELECT route, source_code, max(source_name) AS source_name, destination_code,
 max(destination_name) AS destination_name, route_type, count(*) AS total_bookings, {avg(TOTAL)} AS avg_fare,
 {r(f'min({TOTAL})')} AS min_fare, {r(f'max({TOTAL})')} AS max_fare, {r(percentile(TOTAL, .5))} AS median_fare,
 {avg('duration_hrs')} AS avg_duration_hrs, {cnt('num_stops = 0')} AS direct_flights, {cnt('num_stops = 1')} AS one_stop_flights,
 {cnt('num_stops = 2')} AS two_stop_flights, {cnt("travel_class = 'Economy'")} AS economy_bookings,
 {cnt("travel_class = 'Business'")} AS business_bookings, {cnt("travel_class = 'First'")} AS first_class_bookings,
 {cnt("travel_class NOT IN ('Economy', 'Business', 'First')")} AS other_class_bookings,
 {cnt('is_peak_season')} AS peak_season_bookings, {cnt('NOT is_peak_season')} AS off_peak_bookings,
 {avg(TOTAL, 'is_peak_season')} AS avg_peak_fare, {avg(TOTAL, 'NOT is_peak_season')} AS avg_off_peak_fare,
 {PREMIUM} AS peak_premium_pct, mode() WITHIN GROUP (ORDER BY airline) AS most_common_airline,
 rank() OVER (ORDER BY count(*) DESC) AS popularity_rank
FROM silver GROUP BY route, source_code, destination_code, route_type"""

SEASONAL = f"""SELECT seasonality, season_category, is_peak_season, total_bookings, avg_fare, min_fare, max_fare, median_fare,
 avg_domestic_fare, avg_international_fare, avg_economy_fare, avg_business_fare, avg_first_class_fare,
 {r("(avg_fare - regular) / nullif(regular, 0) * 100")} AS pct_diff_from_regular,
 {r('total_bookings::DOUBLE / sum(total_bookings) OVER () * 100')} AS booking_share_pct
FROM (SELECT seasonality, season_category, is_peak_season, count(*) AS total_bookings, {avg(TOTAL)} AS avg_fare,
 {r(f'min({TOTAL})')} AS min_fare, {r(f'max({TOTAL})')} AS max_fare, {r(percentile(TOTAL, .5))} AS median_fare,
 {avg(TOTAL, "route_type = 'Domestic'")} AS avg_domestic_fare, {avg(TOTAL, "route_type = 'International'")} AS avg_international_fare,
 {avg(TOTAL, "travel_class = 'Economy'")} AS avg_economy_fare, {avg(TOTAL, "travel_class = 'Business'")} AS avg_business_fare,
 {avg(TOTAL, "travel_class = 'First'")} AS avg_first_class_fare FROM silver GROUP BY ALL) s
CROSS JOIN (SELECT {avg(TOTAL)} AS regular FROM silver WHERE seasonality = 'Regular') q"""

REPORT = """SELECT 'seasonality' AS field_name, seasonality AS field_value, season_category AS category,
 CASE WHEN is_peak_season THEN 'Yes' ELSE 'No' END AS is_peak, count(*) AS record_count FROM silver GROUP BY ALL
UNION ALL SELECT 'travel_class', travel_class, 'N/A', 'N/A', count(*) FROM silver GROUP BY ALL
UNION ALL SELECT 'booking_source', booking_source, 'N/A', 'N/A', count(*) FROM silver GROUP BY ALL
UNION ALL SELECT 'stopovers', stopovers, 'N/A', 'N/A', count(*) FROM silver GROUP BY ALL"""


def fare_summary(source):
    return f"""SELECT airline || '|' || route || '|' || travel_class || '|' || seasonality AS fare_key, airline, route,
 source_code, destination_code, travel_class, seasonality, route_type, count(*) AS booking_count,
 {avg('base_fare_bdt')} AS avg_base_fare, {avg(TOTAL)} AS avg_total_fare, {r(f'min({TOTAL})')} AS min_fare,
 {r(f'max({TOTAL})')} AS max_fare, {avg('duration_hrs')} AS avg_duration_hrs FROM {source} GROUP BY ALL"""


def route_summary(source):
    return f"""SELECT route || '|' || route_type AS route_key, route, source_code, source_name, destination_code,
 destination_name, route_type, count(*) AS total_bookings, {avg(TOTAL)} AS avg_fare, {r(f'min({TOTAL})')} AS min_fare,
 {r(f'max({TOTAL})')} AS max_fare, {avg('duration_hrs')} AS avg_duration,
 {r(f"{cnt('num_stops = 0')}::DOUBLE / count(*) * 100")} AS direct_flight_pct,
 {cnt("travel_class = 'Economy'")} AS economy_bookings, {cnt("travel_class = 'Business'")} AS business_bookings,
 {cnt("travel_class = 'First'")} AS first_bookings FROM {source} GROUP BY ALL"""


def merge_sql(key, checks, hard_deletes):
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in checks)
    first, second = f"TIMESTAMP '{FIRST_LOAD}'", f"TIMESTAMP '{SECOND_LOAD}'"
    gone = f"n.{key} IS NULL" if hard_deletes else "FALSE"
    closes = f"({gone} OR (n.{key} IS NOT NULL AND ({differs})))"
    return f"""SELECT o.*, {first} AS valid_from, CASE WHEN {closes} THEN {second} END AS valid_to,
 md5(o.{key} || '|{FIRST_LOAD}') AS scd_id, CASE WHEN {closes} THEN {second} ELSE {first} END AS updated_at
 FROM old_rows o LEFT JOIN new_rows n ON o.{key} = n.{key}
 UNION ALL SELECT n.*, {second}, NULL, md5(n.{key} || '|{SECOND_LOAD}'), {second}
 FROM new_rows n LEFT JOIN old_rows o ON o.{key} = n.{key} WHERE o.{key} IS NULL OR {differs}"""


def fare_sql(final):
    return with_(
        "first_extract second_extract", final, s1=silver_of("first_extract"), s2=silver_of("second_extract"),
        old_rows=fare_summary("s1"), new_rows=fare_summary("s2"),
        versions=merge_sql("fare_key", ["avg_base_fare", "avg_total_fare", "booking_count"], True),
    )


def route_sql(final):
    return with_(
        "first_extract second_extract", final, s1=silver_of("first_extract"), s2=silver_of("second_extract"),
        old_rows=route_summary("s1"), new_rows=route_summary("s2"),
        versions=merge_sql("route_key", ["avg_fare", "total_bookings", "direct_flight_pct"], False),
    )


DAYS = f"CAST(date_sub('day', valid_from, coalesce(valid_to, TIMESTAMP '{AS_OF}')) AS INTEGER)"
STATUS = """valid_to IS NULL AS is_current, CASE WHEN valid_to IS NULL THEN 'Current' ELSE 'Historical' END AS record_status"""


def number(key):
    return f"CAST(row_number() OVER (PARTITION BY {key} ORDER BY valid_from) AS INTEGER) AS version_number"


CHANGES = """SELECT coalesce(n.record_hash, o.record_hash) AS record_hash,
 CASE WHEN o.record_hash IS NULL THEN 'new' WHEN n.record_hash IS NULL THEN 'deleted' ELSE 'unchanged' END AS status,
 coalesce(n.c, 0) AS incoming_rows, coalesce(o.c, 0) AS existing_rows
 FROM (SELECT record_hash, count(*) AS c FROM {second} GROUP BY 1) n
 FULL JOIN (SELECT record_hash, count(*) AS c FROM first_extract GROUP BY 1) o ON n.record_hash = o.record_hash"""

STATS = f"""SELECT *, CASE WHEN change_percentage > 50 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type FROM (
 SELECT *, 100.0::DOUBLE * (records_inserted + records_deleted) / incoming_rows AS change_percentage FROM (
 SELECT CAST(coalesce(sum(incoming_rows) FILTER (WHERE status = 'new'), 0) AS BIGINT) AS records_inserted,
 CAST(coalesce(sum(existing_rows) FILTER (WHERE status = 'deleted'), 0) AS BIGINT) AS records_deleted,
 CAST(coalesce(sum(incoming_rows) FILTER (WHERE status = 'unchanged'), 0) AS BIGINT) AS records_unchanged,
 CAST(sum(incoming_rows) AS BIGINT) AS incoming_rows, CAST(sum(existing_rows) AS BIGINT) AS existing_rows FROM {{changes}}))"""


def changes_sql(final):
    return with_(
        "first_extract second_extract reload_extract", final,
        c2=CHANGES.format(second="second_extract"), c3=CHANGES.format(second="reload_extract"),
        stats2=STATS.format(changes="c2"), stats3=STATS.format(changes="c3"),
    )


def topn_cells(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY 2" for c in columns
    )


def per_column(columns, template, glue=" UNION ALL "):
    return glue.join(template.replace("{c}", c) for c in columns)


NUMBERS = ["duration_hrs", "base_fare_bdt", "tax_surcharge_bdt", TOTAL, "days_before_departure"]
TEXTS = ["airline", "source_code", "destination_code", "stopovers", "aircraft_type", "travel_class",
         "booking_source", "seasonality"]
ALL_FIELDS = [c.strip() for c in FIELDS.replace("\n", " ").split(",")]
NOT_NULL = ["id", "airline", "source_code", "destination_code", "total_fare_bdt", "travel_class",
            "seasonality", "is_peak_season", "season_category"]


def nulls(table, source, columns):
    return per_column(
        columns,
        f"SELECT '{table}' AS table_name, '{{c}}' AS column_name, 'not_null' AS test, "
        f"count(*) FILTER (WHERE {{c}} IS NULL) AS failures FROM {source}",
    )


def unique(table, source, c):
    return (f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'unique' AS test, count(*) AS failures FROM "
            f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


def accepted(table, source, c, values):
    return (f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'accepted_values' AS test, count(DISTINCT {c}) AS failures "
            f"FROM {source} WHERE {c} NOT IN {values}")


GOLDS = {"gold_avg_fare_by_airline": ("airline", ["airline", "total_bookings"]),
         "gold_seasonal_fare_analysis": ("seasonality", ["seasonality"]),
         "gold_booking_count_by_airline": ("airline", ["airline"]),
         "gold_popular_routes": ("route", ["route"]),
         "gold_fare_by_class": ("travel_class", ["travel_class"])}
GOLD_SQL = {"gold_avg_fare_by_airline": BY_AIRLINE, "gold_seasonal_fare_analysis": SEASONAL,
            "gold_booking_count_by_airline": BOOKING_COUNT, "gold_popular_routes": ROUTES,
            "gold_fare_by_class": BY_CLASS}
SHORT = "('Peak Season')"
PEAK_LABEL = f"""CASE WHEN {any_like('lower(seasonality)', ['peak', 'eid', 'hajj', 'holiday', 'festival', 'winter'])}
 THEN 'Peak Season' ELSE 'Off-Peak' END"""


def extremes(key):
    groups = f"(SELECT {key} AS g, {avg(TOTAL)} AS mean, count({TOTAL}) AS n FROM silver WHERE {key} IS NOT NULL GROUP BY 1)"
    return " UNION ALL ".join(
        f"(SELECT '{key}' AS group_name, '{name}' AS extreme, CAST(g AS VARCHAR) AS group_value, "
        f"CAST({measure} AS DOUBLE) AS measure FROM {groups} ORDER BY {measure} {way}, g LIMIT 1)"
        for name, measure, way in (("highest_mean", "mean", "DESC"), ("lowest_mean", "mean", "ASC"), ("most_rows", "n", "DESC"))
    )


def box(q):
    return f"quantile_cont(rate, {q})"


RATE = f"SELECT airline, {r(f'{TOTAL} / duration_hrs')} AS rate FROM valid"
PAIRS = [(a, b) for a in NUMBERS for b in NUMBERS if a != b]


def lead_reason(n):
    return f"format('{{:,}}', {n})"


def money(c):
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


def _hash_of(columns):
    import hashlib

    return hashlib.sha256(",".join(sorted(columns)).encode()).hexdigest()


TABLE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}
SCHEMA_HASHES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, sha256((SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (DESCRIBE {t}))) AS schema_hash, "
    f"(SELECT count(*) FROM {t}) AS row_count"
    for t in TABLE_COLUMNS
)
CSV_HEADERS = ["Airline", "Source", "Source Name", "Destination", "Destination Name", "Departure Date & Time",
               "Arrival Date & Time", "Duration (hrs)", "Stopovers", "Aircraft Type", "Class", "Booking Source",
               "Base Fare (BDT)", "Tax & Surcharge (BDT)", "Total Fare (BDT)", "Seasonality", "Days Before Departure"]
SCD_COLUMNS = "valid_from, valid_to, scd_id, updated_at"

_CLASS_MEAN = f"""SELECT id, {TOTAL} AS y, p FROM silver s JOIN
 (SELECT travel_class AS k, {avg(TOTAL)} AS p FROM silver GROUP BY 1) ON travel_class = k"""
# two-feature normal equations, with the penalty on the diagonal
_LINEAR = f"""SELECT feature, weight FROM (SELECT {r('w1', 4)} AS w1, {r('w2', 4)} AS w2, {r('my - w1 * m1 - w2 * m2', 4)} AS b FROM
 (SELECT (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS w1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS w2, m1, m2, my FROM
 (SELECT var_pop(duration_hrs) * count(*) + {{penalty}} AS v1, var_pop(days_before_departure) * count(*) + {{penalty}} AS v2,
 covar_pop(duration_hrs, days_before_departure) * count(*) AS v12, covar_pop(duration_hrs, {TOTAL}) * count(*) AS c1,
 covar_pop(days_before_departure, {TOTAL}) * count(*) AS c2, avg(duration_hrs) AS m1, avg(days_before_departure) AS m2,
 avg({TOTAL}) AS my FROM silver))) CROSS JOIN LATERAL (SELECT 'duration_hrs' AS feature, w1 AS weight
 UNION ALL SELECT 'days_before_departure', w2 UNION ALL SELECT 'intercept', b)"""

ORACLES = {
    # sources and sinks
    "scan_csv": with_("bookings", "SELECT airline, travel_class, stopovers, strftime(departure_datetime, '%Y-%m-%d %H:%M:%S') AS departed FROM bookings"),
    "rename_columns": with_("bookings", "SELECT source_code, destination_code, booking_source, count(*) AS n FROM bookings GROUP BY ALL"),
    "rename_snake": with_("bookings", """SELECT source_code AS source_city, airline, travel_class, seasonality, count(*) AS n,
 count(*) AS fares, count(*) AS bases, count(*) AS taxes FROM bookings GROUP BY ALL"""),
    "coerce_types": with_("bookings", f"SELECT {FIELDS} FROM bookings"),
    "null_row_count": with_("bookings", """SELECT count(*) FILTER (WHERE seasonality = 'Hajj' OR NOT tax_surcharge_bdt > 0) AS rows_with_nulls,
 count(*) AS total_rows FROM bookings"""),
    "scan_table": with_("silver", f"SELECT id, airline, route, {TOTAL} FROM silver WHERE {TOTAL} >= 100000"),
    "sink_append": with_("first_extract second_extract", f"""SELECT airline, count(*) AS n, {r(f'sum({TOTAL})')} AS total FROM
 (SELECT airline, {TOTAL} FROM first_extract UNION ALL SELECT airline, {TOTAL} FROM second_extract) GROUP BY 1"""),
    "sink_overwrite": with_("first_extract", f"""SELECT airline, count(*) AS n, {r(f'sum({TOTAL})')} AS total FROM first_extract
 WHERE {TOTAL} >= 50000 GROUP BY 1"""),
    "dataset_metadata": f"""SELECT CAST(i AS BIGINT) AS id, 'bookings.csv' AS file_name,
 CASE i WHEN 1 THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END AS download_timestamp,
 (SELECT count(*) FROM lineitem) AS row_count, 17 AS column_count,
 '{_hash_of(CSV_HEADERS)}' AS schema_hash, i = 2 AS schema_changed,
 CASE i WHEN 2 THEN 'loyalty_tier' END AS new_columns_added, CASE i WHEN 2 THEN CAST(1 AS BIGINT) END AS previous_metadata_id
 FROM range(1, 3) t(i)""",
    "schema_hash": SCHEMA_HASHES,
    "schema_evolve": with_("first_extract second_extract", f"""SELECT airline, count(*) AS n, CAST(sum(lead) AS BIGINT) AS lead_days,
 CAST(sum(tax) AS DOUBLE) AS surcharge, count(stops) AS stops,
 'lead_days BIGINT, surcharge DECIMAL(12, 2), stops_text VARCHAR(255)' AS added FROM
 (SELECT airline, NULL AS lead, NULL AS tax, NULL AS stops FROM first_extract UNION ALL
 SELECT airline, days_before_departure, CAST(tax_surcharge_bdt AS DECIMAL(12,2)), stopovers FROM second_extract) GROUP BY 1"""),
    # validation
    "validate_rows": with_("bookings", f"SELECT id, validation_errors IS NULL AS is_valid, validation_errors FROM (SELECT *, {ERRORS} AS validation_errors FROM dirty)", dirty=DIRTY),
    "validation_summary": with_("validated", f"""SELECT count(*) AS total_rows, {cnt('is_valid')} AS valid_rows, {cnt('NOT is_valid')} AS invalid_rows,
 {r(f"100.0::DOUBLE * {cnt('is_valid')} / count(*)")} AS validation_rate FROM validated"""),
    "soft_rules": with_("valid", """SELECT id, nullif(concat_ws('; ',
 CASE WHEN seasonality NOT IN ('Regular', 'Eid', 'Hajj', 'Winter', 'Winter Holidays') THEN 'seasonality has an unexpected value' END,
 CASE WHEN travel_class NOT IN ('Economy', 'Business', 'First', 'First Class', 'Premium Economy') THEN 'travel_class has an unexpected value' END,
 CASE WHEN stopovers NOT IN ('Direct', '1 Stop', '2 Stops') THEN 'stopovers has an unexpected value' END,
 CASE WHEN booking_source NOT IN ('Direct Booking', 'Travel Agency', 'Online Website') THEN 'booking_source has an unexpected value' END,
 CASE WHEN days_before_departure > 365 THEN 'days_before_departure is above 365' END), '') AS validation_warnings FROM valid"""),
    "layer_counts": with_("silver", """SELECT 'bronze.validated_flights' AS table_name, count(*) AS rows FROM valid
 UNION ALL SELECT 'silver.silver_cleaned_flights', count(*) FROM silver
 UNION ALL SELECT 'gold.gold_avg_fare_by_airline', count(DISTINCT airline) FROM silver"""),
    "pass_rate": with_("validated", f"""SELECT count(*) AS total, {cnt('is_valid')} AS valid,
 {r(f"{cnt('is_valid')}::DOUBLE / count(*) * 100")} AS pass_rate FROM validated"""),
    "dq_not_null": with_("bookings", nulls("bookings", "dirty", ["airline", "source_code", TOTAL, "tax_surcharge_bdt"]), dirty=DIRTY),
    "dq_unique": with_("silver", unique("silver_cleaned_flights", "silver", "id") + " UNION ALL " + unique("lineitem", "lines", "line"),
                       lines="SELECT l_orderkey || '-' || l_linenumber AS line FROM lineitem"),
    "dq_accepted_values": with_("silver", accepted("silver_cleaned_flights", "silver", "route_type", "('Domestic', 'International')")
                                + " UNION ALL " + accepted("silver_cleaned_flights", "silver", "travel_class", "('Economy', 'First')")),
    "dq_silver": with_("silver", " UNION ALL ".join([nulls("silver_cleaned_flights", "silver", NOT_NULL),
                       unique("silver_cleaned_flights", "silver", "id"),
                       accepted("silver_cleaned_flights", "silver", "route_type", "('Domestic', 'International')")])),
    "dq_gold": with_("silver", " UNION ALL ".join(f"{nulls(t, t, cols)} UNION ALL {unique(t, t, key)}" for t, (key, cols) in GOLDS.items()), **GOLD_SQL),
    "dq_report": with_("silver", REPORT),
    "dq_totals": with_("validated", f"""SELECT 'record_count' AS metric, count(*) AS metric_value FROM validated
 UNION ALL SELECT 'valid_record_count', {cnt('is_valid')} FROM validated
 UNION ALL SELECT 'invalid_record_count', {cnt('NOT is_valid')} FROM validated
 UNION ALL SELECT 'null_airline', {cnt('airline IS NULL')} FROM validated
 UNION ALL SELECT 'null_arrival_datetime', {cnt('arrival_datetime IS NULL')} FROM validated
 UNION ALL SELECT 'null_total_fare_bdt', {cnt('total_fare_bdt IS NULL')} FROM validated
 UNION ALL SELECT 'unique_airline_count', count(DISTINCT airline) FROM validated
 UNION ALL SELECT 'unique_route_count', count(DISTINCT source_code || '-' || destination_code) FROM validated"""),
    # joins
    "staging_join": with_("valid", f"SELECT id AS raw_id, airline, {TOTAL}, departure_datetime AS loaded_at FROM valid"),
    "join_new": with_("first_extract second_extract", f"SELECT id, record_hash, {TOTAL} FROM second_extract WHERE record_hash NOT IN (SELECT record_hash FROM first_extract)"),
    "join_deleted": with_("first_extract second_extract", f"SELECT id, record_hash, {TOTAL} FROM first_extract WHERE record_hash NOT IN (SELECT record_hash FROM second_extract)"),
    "join_unchanged": with_("first_extract second_extract", f"SELECT id, record_hash, {TOTAL} FROM second_extract WHERE record_hash IN (SELECT record_hash FROM first_extract)"),
    "join_scalar_cross": with_("silver", f"SELECT id, airline, {TOTAL}, mean_fare FROM silver CROSS JOIN (SELECT {avg(TOTAL)} AS mean_fare FROM silver) WHERE {TOTAL} > mean_fare * 1.9"),
    "enrich_left": with_("silver", """SELECT id, s.airline, a.avg_total_fare, a.market_share_pct, p.popularity_rank, p.most_common_airline,
 q.pct_diff_from_regular, c.class_share_pct, a.total_bookings FROM silver s LEFT JOIN gold_avg_fare_by_airline a ON s.airline = a.airline
 LEFT JOIN gold_popular_routes p ON s.route = p.route LEFT JOIN gold_seasonal_fare_analysis q ON s.seasonality = q.seasonality
 LEFT JOIN gold_fare_by_class c ON s.travel_class = c.travel_class""", **GOLD_SQL),
    "value_map": with_("silver", """SELECT id, s.route, coalesce(route_count, 1) AS route_count FROM silver s LEFT JOIN
 (SELECT route, count(*) AS route_count FROM silver GROUP BY 1 HAVING count(*) >= 40) m ON s.route = m.route"""),
    "skewed_lookup": with_("silver", f"""SELECT id, s.seasonality, {TOTAL}, mean_fare FROM silver s JOIN
 (SELECT seasonality, {avg(TOTAL)} AS mean_fare FROM silver GROUP BY 1) m ON s.seasonality = m.seasonality"""),
    # silver
    "silver_clean": with_("silver", "SELECT * FROM silver"),
    "silver_filter": with_("valid", """SELECT id, travel_class, booking_source FROM valid
 WHERE travel_class <> 'biz' AND booking_source <> 'Online Website'"""),
    "std_text": with_("bookings", f"""SELECT id, {initcap("trim(concat_ws('''', lower(airline), source_name, aircraft_type, booking_source))")} AS name,
 source_code AS code FROM bookings"""),
    "route_key": with_("bookings", "SELECT id, source_code || '-' || CASE WHEN seasonality <> 'Hajj' THEN destination_code END AS route FROM bookings"),
    "time_parts": with_("bookings", f"""SELECT id, CAST(year(ts) AS INTEGER) AS departure_year, CAST(month(ts) AS INTEGER) AS departure_month,
 CAST(dayofweek(ts) AS INTEGER) AS departure_day_of_week, {weekpart('ts')} AS departure_day_type
 FROM (SELECT id, CASE WHEN seasonality <> 'Hajj' THEN departure_datetime END AS ts FROM bookings)"""),
    "num_stops": with_("bookings", f"""SELECT id, s AS stopovers, CAST({stops('s')} AS INTEGER) AS num_stops FROM
 (SELECT id, CASE WHEN seasonality = 'Hajj' THEN '1' || stopovers ELSE stopovers END AS s FROM bookings)"""),
    "class_norm": with_("bookings", f"SELECT id, {class_name('travel_class')} AS travel_class, {class_name('aircraft_type')} AS unknown_class FROM bookings"),
    "tax_pct": with_("bookings", f"SELECT id, {r('tax_surcharge_bdt / nullif(CASE WHEN duration_hrs = 5 THEN 0.0 ELSE base_fare_bdt END, 0) * 100')} AS tax_percentage FROM bookings"),
    "fare_band": with_("bookings", f"SELECT id, {band('(CASE WHEN duration_hrs <> 5 THEN total_fare_bdt END)')} AS fare_category FROM bookings"),
    "peak_flag": with_("validated", f"SELECT id, seasonality, {peak('seasonality')} AS is_peak_season FROM seasons", seasons=SEASONS),
    "season_cat": with_("validated", f"SELECT id, seasonality, {season_category('seasonality')} AS season_category FROM seasons", seasons=SEASONS),
    "booking_window": with_("bookings", f"SELECT id, {window('(CASE WHEN duration_hrs <> 5 THEN days_before_departure END)')} AS booking_window FROM bookings"),
    "route_type": with_("bookings", f"""SELECT id, {kind('(CASE WHEN duration_hrs = 5 THEN lower(source_code) WHEN duration_hrs <> 6 THEN source_code END)')} AS route_type FROM bookings"""),
    "lineage_cols": with_("silver", f"""SELECT s.id, s.id AS raw_id, 'v' || s.id AS validated_id, s.departure_datetime AS loaded_at, record_hash,
 TIMESTAMP '{LOADED_AT}' AS ingestion_timestamp, TIMESTAMP '{AS_OF}' AS silver_loaded_at FROM silver s"""),
    "season_map": with_("validated", """SELECT id, CASE WHEN seasonality IN ('Peak', 'Eid', 'Summer') THEN 'Peak' WHEN seasonality = 'Off-Peak' THEN 'Off-Peak'
 ELSE 'Regular' END AS season_category FROM seasons""", seasons=SEASONS),
    "peak_keywords": with_("validated", f"SELECT id, CASE WHEN {PEAK_LABEL} = 'Peak Season' THEN 1 ELSE 0 END AS is_peak_season FROM seasons", seasons=SEASONS),
    "total_from_parts": with_("bookings", f"SELECT id, {r('coalesce(CASE WHEN duration_hrs <> 5 THEN total_fare_bdt END, base_fare_bdt + tax_surcharge_bdt)')} AS total_fare_bdt FROM bookings"),
    "bin_cut": with_("bookings", """SELECT id, CASE WHEN t > 0 AND t <= 10000 THEN 'Budget (<10K)' WHEN t > 0 AND t <= 30000 THEN 'Economy (10-30K)'
 WHEN t > 0 AND t <= 60000 THEN 'Standard (30-60K)' WHEN t > 0 AND t <= 100000 THEN 'Premium (60-100K)' WHEN t > 100000 THEN 'Luxury (>100K)' END AS fare_category
 FROM (SELECT id, CASE WHEN duration_hrs = 5 THEN 0.0 WHEN duration_hrs = 6 THEN 30000.0 ELSE total_fare_bdt END AS t FROM bookings)"""),
    # aggregations
    **{name: with_("silver", sql) for name, sql in GOLD_SQL.items()},
    "agg_filtered": with_("silver", f"""SELECT source_code, departure_year, {cnt("travel_class = 'Economy'")} AS economy, {cnt("departure_day_type = 'Weekend'")} AS weekend,
 {avg(TOTAL, 'days_before_departure <= 30')} AS avg_short_notice FROM silver GROUP BY 1, 2"""),
    "agg_percentile": with_("silver", f"""SELECT source_code, travel_class, {r(percentile(TOTAL, .01))} AS p01, {r(percentile(TOTAL, .25))} AS p25, {r(percentile(TOTAL, .5))} AS p50,
 {r(percentile(TOTAL, .75))} AS p75, {r(percentile(TOTAL, .99))} AS p99 FROM silver GROUP BY 1, 2"""),
    "agg_stddev": with_("silver", f"SELECT route, airline, {r(f'stddev_samp({TOTAL})')} AS fare_std_dev FROM silver GROUP BY 1, 2"),
    "agg_mode": with_("silver", "SELECT route, mode() WITHIN GROUP (ORDER BY airline) AS most_common_airline FROM silver GROUP BY 1"),
    "peak_premium": with_("silver", f"SELECT source_code, booking_window, {PREMIUM} AS peak_premium_pct FROM silver GROUP BY 1, 2"),
    "share_of_total": with_("silver", f"SELECT aircraft_type, booking_source, count(*) AS n, {r('count(*)::DOUBLE / sum(count(*)) OVER () * 100')} AS share_pct FROM silver GROUP BY 1, 2"),
    "group_stats": with_("silver", per_column(["airline", "route", "seasonality", "travel_class"],
        f"SELECT '{{c}}' AS group_name, {{c}} AS group_value, {avg(TOTAL)} AS avg_fare, min({TOTAL}) AS min_fare, max({TOTAL}) AS max_fare, "
        f"count({TOTAL}) AS booking_count, {r(percentile(TOTAL, .5))} AS median_fare FROM silver GROUP BY {{c}}")),
    "peak_stats": with_("silver", f"""SELECT {PEAK_LABEL} AS peak_label, {avg(TOTAL)} AS avg_fare, min({TOTAL}) AS min_fare, max({TOTAL}) AS max_fare,
 count({TOTAL}) AS booking_count, {r(percentile(TOTAL, .5))} AS median_fare FROM silver GROUP BY 1"""),
    "pivot_premium": with_("silver", f"""SELECT airline, {r('o')} AS off_peak, {r('p')} AS peak_season, {r('(p - o) / nullif(o, 0) * 100')} AS premium_pct FROM
 (SELECT airline, avg({TOTAL}) FILTER (WHERE {PEAK_LABEL} = 'Off-Peak') AS o, avg({TOTAL}) FILTER (WHERE {PEAK_LABEL} = 'Peak Season') AS p FROM silver GROUP BY 1)"""),
    "value_counts_topn": with_("silver", f"""SELECT * FROM (SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS place
 FROM ({topn_cells([*TEXTS, 'route'], 'silver')}) WHERE value IS NOT NULL) WHERE place <= 10"""),
    "argmax_group": with_("silver", extremes("route")),
    "metadata_count": with_("silver last_load", """SELECT 'silver' AS layer, (SELECT count(*) FROM silver) AS total_records, records_inserted AS new_records,
 change_percentage, load_timestamp AS latest_update, (SELECT count(*) FROM silver) > 0 AS has_changes FROM last_load"""),
    "revenue_metrics": with_("silver", f"""SELECT airline, count(*) AS total_bookings, {r(f'sum({TOTAL})')} AS total_revenue, {avg(TOTAL)} AS avg_booking_value,
 {r(f'sum({TOTAL}) / sum(sum({TOTAL})) OVER () * 100')} AS revenue_share_pct,
 (SELECT '{{' || string_agg('"' || k || '":' || c, ',' ORDER BY k) || '}}' FROM (SELECT travel_class AS k, count(*) AS c FROM silver i WHERE i.airline = o.airline GROUP BY 1)) AS booking_by_class,
 (SELECT '{{' || string_agg('"' || k || '":' || c, ',' ORDER BY k) || '}}' FROM (SELECT booking_window AS k, count(*) AS c FROM silver i WHERE i.airline = o.airline GROUP BY 1)) AS booking_by_window
 FROM silver o GROUP BY airline"""),
    # windows
    "win_row_number": fare_sql(f"SELECT fare_key, valid_from, {number('fare_key')} FROM versions"),
    "win_count": fare_sql("SELECT fare_key, valid_from, count(*) OVER (PARTITION BY fare_key) AS total_versions FROM versions"),
    "win_rank": with_("silver", "SELECT route, airline, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS popularity_rank FROM silver GROUP BY 1, 2"),
    "win_total": with_("silver", "SELECT route, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS all_bookings FROM silver GROUP BY 1"),
    "rank_avg": with_("silver", """SELECT id, tax_percentage, rank() OVER (ORDER BY tax_percentage DESC) +
 (count(*) OVER (PARTITION BY tax_percentage) - 1) / 2.0::DOUBLE AS tax_rank FROM silver"""),
    # incremental load and history
    "record_hash": with_("bookings", f"SELECT id, {HASH} AS record_hash FROM bookings"),
    "detect_changes": changes_sql("""SELECT status, count(*) AS hashes, CAST(sum(incoming_rows) AS BIGINT) AS incoming_rows,
 CAST(sum(existing_rows) AS BIGINT) AS existing_rows FROM c2 GROUP BY 1"""),
    "change_pct": changes_sql(f"SELECT * REPLACE ({r('change_percentage', 4)} AS change_percentage) FROM stats2"),
    "load_mode": changes_sql(f"""SELECT 'second' AS extract, {r('change_percentage', 4)} AS change_percentage, load_type FROM stats2
 UNION ALL SELECT 'reload', {r('change_percentage', 4)}, load_type FROM stats3"""),
    "apply_incremental": with_("first_extract second_extract", f"""SELECT id, record_hash, {TOTAL},
 record_hash IN (SELECT record_hash FROM second_extract) AS is_active,
 CASE WHEN record_hash IN (SELECT record_hash FROM second_extract) THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END AS ingestion_timestamp
 FROM first_extract UNION ALL SELECT id, record_hash, {TOTAL}, TRUE, TIMESTAMP '{SECOND_LOAD}' FROM second_extract
 WHERE record_hash NOT IN (SELECT record_hash FROM first_extract)"""),
    "apply_full": with_("reload_extract", f"SELECT id, record_hash, {TOTAL}, TRUE AS is_active, TIMESTAMP '{SECOND_LOAD}' AS ingestion_timestamp FROM reload_extract"),
    "load_log": changes_sql("""SELECT CAST(i AS BIGINT) AS load_id, loaded AS load_timestamp, 'bookings.csv' AS source_file, records_inserted,
 CAST(0 AS BIGINT) AS records_updated, records_deleted, records_unchanged, load_type, """ + r("change_percentage") + f""" AS change_percentage,
 CAST(0 AS BIGINT) AS execution_time_seconds FROM (SELECT 1 AS i, TIMESTAMP '{FIRST_LOAD}' AS loaded, * FROM stats2
 UNION ALL SELECT 2, TIMESTAMP '{SECOND_LOAD}', * FROM stats3)"""),
    "load_stats": with_("load_log", f"""SELECT load_timestamp, load_type, records_inserted, records_deleted, records_unchanged, change_percentage, execution_time_seconds
 FROM load_log WHERE load_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY ORDER BY load_timestamp DESC LIMIT 10"""),
    "process_gate": with_("last_load", f"""SELECT load_type, change_percentage,
 load_type = 'FULL' OR change_percentage >= 0.1 OR records_inserted + records_deleted > 0 AS should_process,
 CASE WHEN load_type = 'FULL' THEN 'Full data reload detected' WHEN change_percentage >= 0.1 THEN 'Data changed by ' || {money('change_percentage')} || '%'
 WHEN records_inserted + records_deleted > 0 THEN {lead_reason('records_inserted + records_deleted')} || ' records changed' ELSE 'No data changes detected' END AS reason FROM last_load"""),
    "retrain_gate": with_("last_load last_model", f"""SELECT CASE WHEN reasons <> '' THEN 'retrain' ELSE 'skip' END AS decision, reasons FROM (SELECT concat_ws('; ',
 CASE WHEN change_percentage >= 5 THEN 'Data changed by ' || {money('change_percentage')} || '%' END,
 CASE WHEN records_inserted >= 1000 THEN {lead_reason('records_inserted')} || ' new records' END,
 CASE WHEN date_sub('day', training_timestamp, TIMESTAMP '{AS_OF}') >= 30 THEN 'Model is ' || date_sub('day', training_timestamp, TIMESTAMP '{AS_OF}') || ' days old' END,
 CASE WHEN load_type = 'FULL' THEN 'Full data reload' END) AS reasons FROM last_load CROSS JOIN (SELECT training_timestamp FROM last_model))"""),
    "scd_fare_summary": with_("silver", fare_summary("silver")),
    "scd_route_summary": with_("silver", route_summary("silver")),
    "scd2_merge": fare_sql("SELECT * FROM versions"),
    "scd2_merge_route": route_sql("SELECT * FROM versions"),
    "fare_history": fare_sql(f"""SELECT * EXCLUDE (avg_duration_hrs, scd_id, updated_at), {STATUS}, {DAYS} AS days_active, {number('fare_key')},
 count(*) OVER (PARTITION BY fare_key) AS total_versions FROM versions"""),
    "route_history": route_sql(f"SELECT * EXCLUDE (scd_id, updated_at), {STATUS}, {number('route_key')} FROM versions"),
    "history_change": route_sql(f"""SELECT route_key, current_value, previous_value, valid_from, valid_to,
 {r('(current_value - previous_value) / nullif(previous_value, 0) * 100')} AS change_pct FROM (SELECT route_key, avg_fare AS current_value,
 lag(avg_fare) OVER (PARTITION BY route_key ORDER BY valid_from) AS previous_value, valid_from, valid_to FROM versions)"""),
    # sorts, limits, set operations
    "sort_output": with_("silver", BOOKING_COUNT),
    "latest_row": with_("last_model", "SELECT * FROM last_model"),
    "topk_groups": with_("silver", f"""(SELECT route, {avg(TOTAL)} AS avg_fare, count({TOTAL}) AS booking_count, 'dearest' AS list FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
 UNION ALL (SELECT route, {avg(TOTAL)} AS avg_fare, count({TOTAL}) AS booking_count, 'busiest' AS list FROM silver GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10)"""),
    "union_all": with_("silver", per_column(["travel_class", "booking_source", "stopovers", "seasonality"],
        "SELECT {c} AS field_value, count(*) AS n, '{c}' AS field FROM silver GROUP BY 1")),
    "set_difference": with_("first_extract second_extract", "SELECT record_hash FROM second_extract EXCEPT SELECT record_hash FROM first_extract"),
    "set_intersection": with_("first_extract second_extract", "SELECT record_hash FROM second_extract INTERSECT SELECT record_hash FROM first_extract"),
    # profiling
    "profile_columns": with_("bookings", per_column(["id", *ALL_FIELDS],
        f"SELECT '{{c}}' AS column_name, {cnt('{c} IS NULL')} AS null_count, {r(cnt('{c} IS NULL') + '::DOUBLE / count(*) * 100')} AS null_pct, "
        "count(DISTINCT {c}) AS unique_values FROM dirty"), dirty=DIRTY),
    "profile_increments": with_("validated", per_column(NUMBERS,
        f"SELECT '{{c}}' AS column_name, count(*) AS row_count, {cnt('{c} IS NULL')} AS null_count, {r(cnt('{c} IS NULL') + '::DOUBLE / count(*) * 100')} AS null_pct, "
        f"{r('min({c})')} AS least, {r('max({c})')} AS greatest, TRUE AS distinct_within_bound, TRUE AS median_within_bound FROM validated")),
    "train_test_split": with_("silver", """SELECT ('0x' || substr(md5('42:' || id), 1, 13))::BIGINT % 100 < 20 AS is_test, count(*) AS n FROM silver GROUP BY 1"""),
    "describe": with_("bookings", per_column(NUMBERS,
        f"SELECT '{{c}}' AS column_name, count({{c}}) AS count, {r('avg({c})')} AS mean, {r('stddev_samp({c})')} AS std, CAST(min({{c}}) AS DOUBLE) AS min, "
        f"CAST(max({{c}}) AS DOUBLE) AS max, {r('quantile_cont({c}, .25)')} AS q25, {r('quantile_cont({c}, .5)')} AS q50, {r('quantile_cont({c}, .75)')} AS q75 FROM bookings")),
    "positive_filter": with_("bookings", "SELECT id, base_fare_bdt FROM dirty WHERE base_fare_bdt > 0", dirty=DIRTY),
    "impute_median": with_("validated", f"""SELECT id, {r('coalesce(total_fare_bdt, mt)')} AS total_fare_bdt, {r('coalesce(duration_hrs, md)')} AS duration_hrs,
 {r('base_fare_bdt')} AS base_fare_bdt, 0.0::DOUBLE AS empty_number FROM gaps CROSS JOIN
 (SELECT median(total_fare_bdt) AS mt, median(duration_hrs) AS md FROM gaps)""", gaps=GAPS),
    "impute_mode": with_("validated", """SELECT id, coalesce(travel_class, m) AS travel_class, 'Unknown' AS empty_text FROM gaps CROSS JOIN
 (SELECT mode() WITHIN GROUP (ORDER BY travel_class) AS m FROM gaps)""", gaps=GAPS),
    "iqr_outliers": with_("valid", f"""SELECT {r('max(lo)')} AS lower_bound, {r('max(hi)')} AS upper_bound, {cnt('rate < lo OR rate > hi')} AS outliers,
 {r(cnt('rate < lo OR rate > hi') + '::DOUBLE / count(*) * 100')} AS outlier_pct FROM rates CROSS JOIN
 (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM (SELECT {box(.25)} AS q1, {box(.75)} AS q3 FROM rates))""", rates=RATE),
    "histogram": with_("valid", f"""SELECT CAST(bin AS INTEGER) AS bin, {r('lo + bin * w')} AS bin_start, {r('lo + (bin + 1) * w')} AS bin_end, coalesce(n, 0) AS n FROM
 (SELECT lo, (hi - lo) / 50 AS w, unnest(range(50)) AS bin FROM bounds) LEFT JOIN
 (SELECT least(49, floor(({TOTAL} - lo) / ((hi - lo) / 50))) AS b, count(*) AS n FROM valid CROSS JOIN bounds GROUP BY 1) ON bin = b""",
        bounds=f"SELECT min({TOTAL}) AS lo, max({TOTAL}) AS hi FROM valid"),
    "box_stats": with_("valid", f"""SELECT airline, count(*) AS n, min(rate) AS minimum, {r('max(q1)')} AS q25, {r('max(q2)')} AS q50, {r('max(q3)')} AS q75, max(rate) AS maximum,
 min(rate) FILTER (WHERE rate >= q1 - 1.5 * (q3 - q1) AND rate <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
 max(rate) FILTER (WHERE rate >= q1 - 1.5 * (q3 - q1) AND rate <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
 {cnt('NOT (rate >= q1 - 1.5 * (q3 - q1) AND rate <= q3 + 1.5 * (q3 - q1))')} AS outliers
 FROM rates JOIN (SELECT airline AS a, {box(.25)} AS q1, {box(.5)} AS q2, {box(.75)} AS q3 FROM rates GROUP BY 1) ON airline = a GROUP BY airline""", rates=RATE),
    "corr_matrix": with_("valid", " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})', 4)} AS r FROM valid" for a, b in PAIRS)),
    "target_correlation": with_("valid", per_column([c for c in NUMBERS if c != TOTAL], f"SELECT '{{c}}' AS feature, {r('corr({c}, ' + TOTAL + ')', 4)} AS r FROM valid")),
    "insights": with_("silver", " UNION ALL ".join(extremes(k) for k in ("airline", "route", "seasonality", "travel_class")) +
        f" UNION ALL SELECT 'is_peak_season', 'premium_pct', 'peak over off-peak', {PREMIUM} FROM silver"),
    # audit
    "audit_log": with_("audit", "SELECT id, dag_id, dag_run_id, task_id, status, started_at, completed_at, rows_processed, error_message FROM audit"),
    "audit_recent": with_("audit", "SELECT id, task_id, status, rows_processed, started_at FROM audit ORDER BY id DESC LIMIT 10"),
    "audit_failed": with_("audit", "SELECT id, task_id, error_message, completed_at FROM audit WHERE status = 'failed'"),
    "audit_avg_duration": with_("audit", f"""SELECT task_id, count(*) AS runs, {r("avg(date_sub('second', s, c))")} AS avg_seconds FROM
 (SELECT dag_id, dag_run_id, task_id, max(started_at) AS s, max(completed_at) FILTER (WHERE status = 'completed') AS c FROM audit GROUP BY ALL)
 WHERE c >= s GROUP BY 1"""),
    "change_level": with_("load_log", """SELECT load_timestamp, change_percentage, CASE WHEN change_percentage = 0 THEN 'No Changes Detected'
 WHEN change_percentage < 5 THEN 'Minor Updates Detected' WHEN change_percentage < 50 THEN 'Moderate Changes Detected'
 ELSE 'Major Changes Detected' END AS change_level FROM load_log"""),
    # features and models
    "rank_merge": with_("valid", f"""SELECT feature, rf_rank, mi_rank, (rf_rank + mi_rank) / 2 AS avg_rank FROM (SELECT feature,
 rank() OVER (ORDER BY a DESC) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS rf_rank,
 rank() OVER (ORDER BY b DESC) + (count(*) OVER (PARTITION BY b) - 1) / 2.0::DOUBLE AS mi_rank FROM ({per_column(NUMBERS[:3],
 "SELECT '{c}' AS feature, abs(" + r('corr({c}, ' + TOTAL + ')', 4) + ") AS a, abs(" + r('corr({c}, days_before_departure)', 4) + ") AS b FROM valid")}))"""),
    "route_popularity": with_("silver", f"""SELECT id, s.route, route_popularity, {r('ln(1 + route_popularity)', 6)} AS route_popularity_log FROM silver s JOIN
 (SELECT route, count(*) AS route_popularity FROM silver GROUP BY 1) p ON s.route = p.route"""),
    "peak_numeric": with_("silver", """SELECT id, p AS is_peak_season, coalesce(CAST(p AS INTEGER), 0) AS is_peak_season_numeric FROM
 (SELECT id, CASE WHEN travel_class <> 'First' THEN is_peak_season END AS p FROM silver)"""),
    "label_encode": with_("silver", """SELECT id, airline, route, is_peak_season, CAST(dense_rank() OVER (ORDER BY airline) - 1 AS INTEGER) AS airline_encoded,
 CAST(dense_rank() OVER (ORDER BY route) - 1 AS INTEGER) AS route_encoded, CAST(dense_rank() OVER (ORDER BY is_peak_season) - 1 AS INTEGER) AS is_peak_season_encoded
 FROM (SELECT id, CASE WHEN airline <> 'Brand#7' THEN airline ELSE 'missing' END AS airline, route,
 CASE WHEN is_peak_season THEN 'True' ELSE 'False' END AS is_peak_season FROM silver)"""),
    "scale_std": with_("silver", f"""SELECT id, {r('(duration_hrs - dm) / ds', 6)} AS duration_hrs, {r('(base_fare_bdt - bm) / bs', 6)} AS base_fare_bdt, 0.0::DOUBLE AS constant
 FROM silver CROSS JOIN (SELECT avg(duration_hrs) AS dm, stddev_pop(duration_hrs) AS ds, avg(base_fare_bdt) AS bm, stddev_pop(base_fare_bdt) AS bs FROM silver)"""),
    "final_fill": with_("validated", """SELECT id, total_fare_bdt, coalesce(duration_hrs, (SELECT median(duration_hrs) FROM gaps)) AS duration_hrs,
 base_fare_bdt, 0.0::DOUBLE AS empty_number FROM gaps""", gaps=GAPS),
    "feature_matrix": with_("silver", f"""SELECT id, total_fare_bdt, {r('(pop - avg(pop) OVER ()) / stddev_pop(pop) OVER ()', 6)} AS route_popularity,
 {r('(ln(1 + pop) - avg(ln(1 + pop)) OVER ()) / stddev_pop(ln(1 + pop)) OVER ()', 6)} AS route_popularity_log,
 {r('(pk - avg(pk) OVER ()) / stddev_pop(pk) OVER ()', 6)} AS is_peak_season_numeric, """ + ", ".join(
     f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_encoded" for c in
     ["airline", "source_code", "destination_code", "travel_class", "seasonality", "is_peak_season", "season_category", "route_type", "route"]
 ) + """ FROM (SELECT *, CAST(count(*) OVER (PARTITION BY route) AS DOUBLE) AS pop, CAST(is_peak_season AS INTEGER) AS pk FROM silver)"""),
    "feature_importance_mi": with_("silver", f"""SELECT feature, {r('greatest(sum(n::DOUBLE / t * ln(n::DOUBLE * t / (nx::DOUBLE * ny))), 0)', 6)} AS importance FROM
 (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny FROM
 (SELECT feature, x, y, count(*) AS n FROM ({per_column(["duration_hrs", "base_fare_bdt", "days_before_departure", "num_stops"],
 "SELECT '{c}' AS feature, least(31, floor(({c} - min({c}) OVER ())::DOUBLE * 32 / (max({c}) OVER () - min({c}) OVER ()))) AS x, "
 f"least(31, floor(({TOTAL} - min({TOTAL}) OVER ()) * 32 / (max({TOTAL}) OVER () - min({TOTAL}) OVER ()))) AS y FROM silver")}) GROUP BY ALL)) GROUP BY 1"""),
    "train_linear": with_("silver", _LINEAR.format(penalty="0.0")),
    "train_ridge": with_("silver", _LINEAR.format(penalty="1000000.0")),
    "train_lasso": with_("silver", f"""SELECT feature, weight FROM (SELECT {r('w', 4)} AS w, {r('my - w * mx', 4)} AS b FROM
 (SELECT sign(c) * greatest(abs(c) - 100000.0, 0) / v AS w, mx, my FROM (SELECT covar_pop(duration_hrs, {TOTAL}) AS c, var_pop(duration_hrs) AS v,
 avg(duration_hrs) AS mx, avg({TOTAL}) AS my FROM silver))) CROSS JOIN LATERAL (SELECT 'duration_hrs' AS feature, w AS weight UNION ALL SELECT 'intercept', b)"""),
    "reg_metrics": with_("silver", f"""SELECT {r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} AS r2, {r('avg(abs(y - p))')} AS mae,
 {r('sqrt(avg((y - p) * (y - p)))')} AS rmse, {r('avg(abs((y - p) / y)) * 100')} AS mape FROM ({_CLASS_MEAN})"""),
    "residuals": with_("silver", f"SELECT id, y AS label, p AS prediction, {r('y - p')} AS residual FROM ({_CLASS_MEAN})"),
    "model_status": with_("last_model", """SELECT TRUE AS model_loaded, model_name, '1.0' AS model_version,
 strftime(training_timestamp, '%Y-%m-%d %H:%M:%S') AS last_training_date, test_r2, test_mae FROM last_model"""),
    "score_interval": with_("silver", f"""SELECT id, {r('p')} AS predicted_fare_bdt, {r('greatest(0, p - 1.96 * 31000)')} AS interval_lower,
 {r('p + 1.96 * 31000')} AS interval_upper FROM ({_CLASS_MEAN})"""),
    # streams
    "stream_ingest": with_("first_extract second_extract", f"""SELECT record_hash, {TOTAL},
 record_hash IN (SELECT record_hash FROM second_extract) AS is_active,
 CASE WHEN record_hash IN (SELECT record_hash FROM second_extract) THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END AS ingestion_timestamp
 FROM first_extract UNION ALL SELECT record_hash, {TOTAL}, TRUE, TIMESTAMP '{SECOND_LOAD}' FROM second_extract
 WHERE record_hash NOT IN (SELECT record_hash FROM first_extract)"""),
}
