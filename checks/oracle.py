"""SQL that recomputes each query on the test tables in another engine.

Ratios are rounded with whole numbers here (`half_up`), not with decimals as in the
library, and modes and dense keys are ranked by windows, not by minima and offsets.
"""

from __future__ import annotations

import re

_YEARS = "range(1995, 2002)"


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """Non-negative quotient rounded half up, as a double; NULL for denominator zero."""
    n = f"(({numerator})::HUGEINT * {2 * 10**scale})"
    d = f"nullif(({denominator})::HUGEINT, 0)"
    return f"((({n} + {d}) // (2 * {d}))::DOUBLE / {10**scale})"


def divided_first(numerator: str, denominator: str, scale: int, times: int) -> str:
    """A quotient rounded to `scale` decimals, times a whole number, rounded to two."""
    n = f"(({numerator})::HUGEINT * {2 * 10**scale})"
    d = f"nullif(({denominator})::HUGEINT, 0)"
    whole = f"((({n} + {d}) // (2 * {d})) * {times})"
    unit = 10 ** (scale - 2)
    return f"((({whole} * 2 + {unit}) // {2 * unit})::DOUBLE / 100)"


def scaled(column: str, scale: int) -> str:
    """A decimal as a whole number of its last digit."""
    return f"({column} * {10**scale})::HUGEINT"


def mode(key: str, value: str, source: str) -> str:
    return (
        f"SELECT {key}, {value} FROM (SELECT {key}, {value}, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS place "
        f"FROM {source} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) WHERE place = 1"
    )


# Named relations.  A query gets those it mentions, and those that they mention.
RELATIONS: dict[str, str] = {
    "r_stations": """
        SELECT p_partkey AS k, p_partkey::VARCHAR AS id, p_name AS station_name, p_type,
            CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS ev_network,
            CASE WHEN p_partkey % 3 = 0 THEN 'city ' || (p_partkey % 60) || ' '
                 ELSE 'CITY ' || (p_partkey % 60) END AS city,
            (10000 + p_partkey % 230)::VARCHAR AS zip,
            CASE WHEN p_partkey % 13 <> 0 THEN (p_size % 3)::BIGINT END AS l1,
            CASE WHEN p_partkey % 17 <> 0 THEN (p_size % 9)::BIGINT END AS l2,
            (p_size % 5)::BIGINT AS l3,
            '40.' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS latitude,
            '-73.' || lpad((p_partkey % 997)::VARCHAR, 3, '0') AS longitude,
            p_partkey % 10 <> 0 AS is_active,
            p_partkey % 6 <> 0 AS electric,
            CASE WHEN p_partkey % 29 <> 0
                 THEN DATE '1994-01-01' + (p_partkey * 37 % 2900)::INTEGER END AS open_date
        FROM part""",
    "r_registrations": """
        SELECT o_orderkey AS o, 'CITY ' || (c_custkey % 60) AS city,
            CASE WHEN o_orderkey % 19 = 0 THEN 'NJ' ELSE 'NY' END AS state,
            (10000 + c_custkey % 200)::VARCHAR
                || CASE WHEN o_orderkey % 11 = 0 THEN '-1234' ELSE '' END AS zip,
            CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE upper(n_name) END AS county,
            CASE WHEN o_orderkey % 41 <> 0 THEN year(o_orderdate)::INTEGER END AS model_year,
            c_mktsegment AS make, o_orderstatus <> 'P' AS electric,
            o_orderdate::DATE AS valid_date
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "r_census": """
        SELECT z::VARCHAR AS zip, (100 + z * 37 % 5000)::BIGINT AS population,
            CASE WHEN z % 9 <> 0 AND z % 31 <> 0 THEN (30000 + z * 71 % 90000)::BIGINT END AS income
        FROM r_zips WHERE z % 23 <> 0""",
    "r_zips": "SELECT DISTINCT 10000 + c_custkey % 200 AS z FROM customer",
    "r_sessions": """
        SELECT l_orderkey AS o, l_linenumber AS line, l_partkey AS station,
            l_orderkey || '-' || l_linenumber AS session_id,
            CASE WHEN l_orderkey % 101 <> 0 THEN l_shipdate::DATE END AS session_date,
            CASE WHEN l_orderkey % 97 <> 0 THEN l_quantity::DECIMAL(10,2) END AS kwh,
            (l_quantity::INTEGER * l_linenumber * 4)::INTEGER AS minutes,
            l_extendedprice::DECIMAL(12,2) AS revenue
        FROM lineitem""",
    "big_sessions": """
        SELECT o, line, station, session_id, session_date,
            CASE WHEN o % 97 = 0 THEN NULL WHEN o % 31 = 0 THEN 12345678.5 ELSE kwh END::DECIMAL(18,2) AS kwh,
            CASE WHEN o % 37 = 0 THEN 3000000000 ELSE minutes END::BIGINT AS minutes,
            CASE WHEN o % 41 = 0 THEN 123456789 ELSE revenue END::DECIMAL(18,2) AS revenue
        FROM r_sessions""",
    "zips": "SELECT zip, county FROM (" + mode(
        "zip", "county", "(SELECT zip, county FROM r_registrations WHERE county <> '')"
    ) + ")",
    "census_county": f"""
        SELECT county, sum(population)::BIGINT AS population,
            {half_up("sum(population * income)",
                     "sum(population) FILTER (WHERE income IS NOT NULL)", 2)} AS median_income
        FROM r_census JOIN zips USING (zip) GROUP BY county""",
    "counties": """
        SELECT row_number() OVER (ORDER BY county) AS location_key, county AS county_name,
            CASE WHEN county IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3') THEN 'North'
                 WHEN county IN ('NATION_4', 'NATION_5', 'NATION_6') THEN 'East'
                 WHEN county IN ('NATION_10', 'NATION_11', 'NATION_12', 'NATION_13', 'NATION_14')
                 THEN 'South' ELSE 'Other NY' END AS region,
            population, median_income
        FROM census_county""",
    "stations_m": """
        SELECT row_number() OVER (ORDER BY k) AS station_key, id AS station_id, k,
            station_name, coalesce(ev_network, 'Non-Networked') AS ev_network, city, s.zip,
            county, location_key, l1, l2, l3,
            coalesce(l1, 0) + coalesce(l2, 0) + coalesce(l3, 0) AS ports,
            open_date, latitude, longitude, is_active
        FROM r_stations s LEFT JOIN zips ON s.zip = zips.zip
        LEFT JOIN counties ON county = county_name WHERE electric""",
    "listed": """
        SELECT station_key, zip FROM stations_b
        UNION ALL SELECT station_key, (zip::INTEGER + 1)::VARCHAR FROM stations_b WHERE station_key % 3 = 0""",
    "new_evs": """
        SELECT county, model_year AS year, count(*) AS n FROM r_registrations
        WHERE electric AND valid_date >= DATE '1996-07-01' AND model_year BETWEEN 1995 AND 2001
        GROUP BY county, model_year""",
    "openings": """
        SELECT county, year(open_date)::INTEGER AS year, count(*) AS n
        FROM r_stations JOIN zips USING (zip) WHERE electric AND open_date IS NOT NULL
        GROUP BY ALL""",
    "demand": f"""
        SELECT location_key, county_name, region, population, median_income, year,
            (SELECT coalesce(sum(n), 0) FROM new_evs e
             WHERE e.county = county_name AND e.year = y.year)::BIGINT AS evs,
            (SELECT coalesce(sum(n), 0) FROM new_evs e
             WHERE e.county = county_name AND e.year BETWEEN 1995 AND y.year)::BIGINT AS evs_cum,
            (SELECT coalesce(sum(n), 0) FROM openings e
             WHERE e.county = county_name AND e.year = y.year)::BIGINT AS opened,
            (SELECT coalesce(sum(n), 0) FROM openings e
             WHERE e.county = county_name AND e.year BETWEEN 1995 AND y.year)::BIGINT AS opened_cum
        FROM counties, (SELECT unnest({_YEARS})::INTEGER AS year) y""",
    "matched": f"""
        SELECT session_id, station_key, location_key, session_date, minutes, kwh, revenue, ports,
            strftime(session_date, '%Y%m%d')::INTEGER AS date_key,
            CASE WHEN kwh > 0 THEN
                ({half_up(scaled("revenue", 2), scaled("kwh", 2), 3)} * 1000)::BIGINT END AS price
        FROM r_sessions JOIN stations_m ON station = k WHERE session_date IS NOT NULL""",
    "snapshot": f"""
        SELECT station_key, date_key, location_key, count(*) AS n, sum(kwh) AS kwh,
            sum(revenue) AS revenue,
            {half_up("sum(minutes)", "count(minutes)", 2)} AS avg_minutes,
            {half_up(scaled("sum(revenue)", 2), "count(revenue) * 100", 2)} AS avg_revenue,
            CASE WHEN max(ports) > 0 THEN
                {divided_first("sum(minutes)", "max(ports) * 1440", 6, 100)} END AS rate
        FROM matched GROUP BY station_key, date_key, location_key""",
    "cleaned": """
        SELECT o::VARCHAR AS vin_suffix, city, state, left(zip, 5) AS zip, county, model_year,
            make, electric, valid_date FROM r_registrations WHERE state = 'NY'""",
    "stations_b": """
        SELECT row_number() OVER (ORDER BY k) AS station_key, k AS station_id, station_name,
            ev_network AS network, zip, upper(trim(city)) AS city, l1, l2, l3, latitude,
            longitude, is_active, open_date FROM r_stations""",
    "variants": """
        SELECT zip, city, 'NY' AS state, NULL::VARCHAR AS county FROM stations_b
        UNION SELECT zip, city, state, county FROM cleaned""",
    "places": """
        SELECT row_number() OVER (ORDER BY zip, city) AS location_key, zip, city,
            max(state) AS state, max(county) AS county FROM variants GROUP BY zip, city""",
    "markets": f"""
        SELECT row_number() OVER (ORDER BY t.zip) AS market_key, t.zip, c.city, y.county,
            t.total, t.makes, k.make
        FROM (SELECT zip, count(*) AS total, count(DISTINCT make) AS makes
              FROM cleaned GROUP BY zip) t
        LEFT JOIN ({mode("zip", "make", "cleaned")}) k ON k.zip = t.zip
        LEFT JOIN ({mode("zip", "city", "cleaned")}) c ON c.zip = t.zip
        LEFT JOIN ({mode("zip", "county", "cleaned")}) y ON y.zip = t.zip""",
    "bridged": """
        SELECT o * 10 + line AS session_id, s.station_key, location_key, market_key, kwh, minutes,
            revenue, session_date,
            CASE WHEN session_date >= DATE '1996-01-01' AND session_date <= DATE '2001-12-31'
                 THEN strftime(session_date, '%Y%m%d')::INTEGER END AS date_key
        FROM (SELECT *, (station - 1) % (SELECT count(*) FROM stations_b) + 1 AS wrapped
              FROM r_sessions)
        JOIN stations_b s ON s.station_key = wrapped
        LEFT JOIN places USING (zip, city) LEFT JOIN markets m ON m.zip = s.zip
        WHERE session_date IS NOT NULL""",
    "year_span": """
        SELECT min(year(session_date)) AS low, max(year(session_date)) AS high FROM r_sessions""",
    "days": """
        SELECT unnest(generate_series(make_date(low, 1, 1), make_date(high, 12, 31),
            INTERVAL 1 DAY))::DATE AS d FROM year_span""",
    "ragged": """
        SELECT *, o * 10 + line AS number,
            (o * 10 + line) % 89 = 0 OR (o * 10 + line) % 83 = 0 AS malformed FROM r_sessions""",
}

_YEAR_ROWS = """
    SELECT (y * 10000 + 101)::INTEGER AS date_key, y::INTEGER AS year, y || '-01-01' AS full_date
    FROM (SELECT unnest(range(low, high + 1)) AS y FROM year_span)"""

_DEMAND = f"""
    SELECT (location_key - 1) * 7 + year - 1994 AS market_key,
        (year * 10000 + 101)::INTEGER AS date_key, location_key,
        evs_cum AS ev_registrations_cum, evs AS new_ev_registrations,
        opened_cum AS station_count_cum, opened AS new_stations,
        {half_up("evs_cum", "opened_cum", 2)} AS ev_per_station, population, median_income
    FROM demand"""

# Bounds and labels of the tiers.
_TIER = """CASE WHEN rate < 20 THEN '0-20% (low)' WHEN rate < 40 THEN '20-40%'
    WHEN rate < 60 THEN '40-60% (healthy)' WHEN rate < 80 THEN '60-80% (high)'
    ELSE '80%+ (saturated)' END"""
RELATIONS["big_matched"] = RELATIONS["matched"].replace("r_sessions", "big_sessions")

QUERIES: dict[str, str] = {
    "clean_registrations": """
        SELECT NULL::VARCHAR AS record_type, vin_suffix, NULL::VARCHAR AS registration_class, city,
            state, zip, county, model_year, make, NULL::VARCHAR AS body_type,
            CASE WHEN electric THEN 'ELECTRIC' ELSE 'GAS' END AS fuel_type,
            NULL::VARCHAR AS unladen_weight, NULL::VARCHAR AS max_gross_weight,
            NULL::VARCHAR AS passengers, strftime(valid_date, '%m/%d/%Y') AS reg_valid_date,
            NULL::VARCHAR AS reg_expiry_date, NULL::VARCHAR AS color FROM cleaned""",
    "zip_to_county": "SELECT zip, county FROM zips",
    "calendar_year": _YEAR_ROWS,
    "calendar_day": """
        SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d::VARCHAR AS full_date,
            year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
            strftime(d, '%b') AS month_name, day(d)::INTEGER AS day,
            dayofweek(d)::INTEGER AS day_of_week, strftime(d, '%a') AS day_name,
            dayofweek(d) IN (0, 6) AS is_weekend FROM days""",
    "calendar_bounds": """
        SELECT count(*) AS total_rows, min(d)::VARCHAR AS min_value, max(d)::VARCHAR AS max_value
        FROM days""",
    "calendar_slice": """
        SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d::VARCHAR AS full_date,
            strftime(d, '%a') AS day_name, (dayofweek(d) IN (0, 6))::INTEGER AS is_weekend
        FROM days WHERE d BETWEEN DATE '1998-06-01' AND DATE '1998-06-07'""",
    "census_weighted_income": "SELECT county, population, median_income FROM census_county",
    "dim_location_county": """
        SELECT location_key, county_name, 'NY' AS state_code, region, population, median_income
        FROM counties""",
    "dim_location_zip_city": "SELECT location_key, zip, city, state, county FROM places",
    "location_variants": "SELECT zip, city, state, county FROM variants",
    "dim_station_matched": """
        SELECT station_key, station_id, station_name, ev_network, city, zip, county,
            location_key, l1 AS level1_count, l2 AS level2_count, l3 AS dc_fast_count,
            ports AS total_port_count, NULL::VARCHAR AS connector_types,
            NULL::VARCHAR AS access_code, NULL::VARCHAR AS facility_type,
            open_date::VARCHAR AS open_date, latitude::DOUBLE AS latitude,
            longitude::DOUBLE AS longitude, is_active FROM stations_m""",
    "dim_station_bridged": """
        SELECT station_key, station_id, station_name, network, zip, city,
            'NY' AS state, l1 AS level1_ports, l2 AS level2_ports, l3 AS dc_fast_ports,
            latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude,
            CASE WHEN is_active THEN 'E' ELSE 'P' END AS status_code,
            open_date::VARCHAR AS open_date FROM stations_b""",
    "dim_ev_market": """
        SELECT market_key, zip, city, county, total AS total_ev_registrations,
            makes AS unique_makes, make AS most_common_make FROM markets""",
    "surrogate_keys": """
        SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_rank, o_orderkey
        FROM orders""",
    "identity_keys": """
        SELECT count(*) AS row_count, count(*) AS distinct_keys, 0::BIGINT AS missing_keys FROM matched""",
    "new_registrations_by_county_year": "SELECT county, year, n AS new_evs FROM new_evs",
    "station_openings_by_county_year": """
        SELECT county, year, n AS new_stations FROM openings""",
    "cumulative_registrations": """
        SELECT location_key, county_name AS county, year, evs AS new_evs, evs_cum AS new_evs_cum
        FROM demand""",
    "cumulative_stations": """
        SELECT location_key, county_name AS county, year, opened AS new_stations,
            opened_cum AS new_stations_cum FROM demand""",
    "market_demand": _DEMAND,
    "underserved_markets": f"""
        SELECT county_name, region, evs_cum AS ev_registrations_cum,
            opened_cum AS station_count_cum,
            floor({half_up("evs_cum", "opened_cum", 2)} * 10 + 0.5) / 10 AS ev_per_station,
            median_income, '$' || format('{{:,}}', floor(median_income + 0.5)::BIGINT)
                AS median_income_text
        FROM demand WHERE year = 2000 AND opened_cum > 5 AND evs_cum > 100
        ORDER BY {half_up("evs_cum", "opened_cum", 2)} DESC, county_name LIMIT 10""",
    "regional_growth": """
        SELECT region, year, sum(evs)::BIGINT AS new_evs_added,
            sum(opened)::BIGINT AS new_stations_added
        FROM demand WHERE year BETWEEN 1997 AND 2000 GROUP BY region, year""",
    "largest_locations": """
        SELECT location_key, county_name, 'NY' AS state_code, region, population, median_income
        FROM counties ORDER BY population DESC NULLS FIRST, county_name LIMIT 10""",
    "session_fact_matched": """
        SELECT session_id, station_key, date_key, location_key, kwh::DOUBLE AS kwh_delivered,
            minutes AS duration_minutes, revenue::DOUBLE AS revenue_usd,
            price / 1000.0::DOUBLE AS revenue_per_kwh, session_date::VARCHAR AS session_date
        FROM big_matched""",
    "session_fact_whole_numbers": f"""
        SELECT session_id, station_key, date_key, round(kwh)::DOUBLE AS kwh_delivered,
            round(revenue)::DOUBLE AS revenue_usd,
            CASE WHEN round(kwh) > 0 THEN
                {half_up("round(revenue)", "round(kwh)", 3)} END AS revenue_per_kwh
        FROM matched""",
    "orphan_sessions": """
        SELECT session_id, station::VARCHAR AS station_id,
            coalesce(session_date::VARCHAR, 'bad') AS session_date,
            coalesce(kwh::VARCHAR, '') AS kwh_delivered, minutes::VARCHAR AS duration_minutes,
            revenue::VARCHAR AS revenue_usd
        FROM r_sessions WHERE station NOT IN (SELECT k FROM stations_m)""",
    "load_reconciliation": """
        SELECT r AS raw_rows, l AS loaded_rows, r - l AS dropped_rows
        FROM (SELECT count(*) AS r FROM r_sessions), (SELECT count(*) AS l FROM matched)""",
    "station_daily_snapshot": """
        SELECT station_key, date_key, location_key, n AS total_sessions,
            kwh::DOUBLE AS total_kwh, revenue::DOUBLE AS total_revenue,
            avg_minutes AS avg_session_duration, avg_revenue AS avg_revenue_per_session,
            rate AS utilization_rate_pct FROM snapshot""",
    "session_fact_bridged": f"""
        SELECT session_id, station_key, date_key, location_key, market_key,
            kwh::DOUBLE AS kwh_delivered, minutes AS duration_minutes,
            revenue::DOUBLE AS revenue_usd,
            {half_up(scaled("revenue", 2), scaled("kwh", 2), 2)} AS revenue_per_kwh,
            {divided_first(scaled("kwh", 2), "minutes * 100", 8, 60)} AS avg_kw_rate
        FROM bridged""",
    "revenue_by_network": f"""
        SELECT ev_network, count(*) AS session_count, sum(kwh)::DOUBLE AS total_kwh,
            sum(revenue)::DOUBLE AS total_revenue,
            {half_up("sum(price)", "count(price) * 1000", 6)} AS avg_price_per_kwh
        FROM matched JOIN stations_m USING (station_key) GROUP BY ev_network
        ORDER BY sum(revenue) DESC NULLS FIRST, ev_network LIMIT 10""",
    "top_networks": """
        SELECT ev_network, count(*) AS station_count FROM stations_m GROUP BY ev_network
        ORDER BY count(*) DESC, ev_network LIMIT 10""",
    "port_totals": """
        SELECT sum(l1)::BIGINT AS total_level1, sum(l2)::BIGINT AS total_level2,
            sum(l3)::BIGINT AS total_dc_fast, sum(ports)::BIGINT AS total_ports
        FROM stations_m""",
    "county_ports": """
        SELECT county_name, count(*) AS station_count, sum(ports)::BIGINT AS total_ports
        FROM stations_m JOIN counties USING (location_key) GROUP BY county_name
        ORDER BY count(*) DESC, county_name LIMIT 10""",
    "utilization_tiers": f"""
        SELECT {_TIER} AS utilization_tier, count(*) AS snapshot_count FROM snapshot GROUP BY 1""",
    "utilization_tiers_known": f"""
        SELECT CASE WHEN rate IS NULL THEN 'unknown' ELSE {_TIER} END AS utilization_tier,
            count(*) AS snapshot_count FROM snapshot GROUP BY 1""",
    "top_stations_lifetime": f"""
        SELECT station_name, city, count(*) AS active_days,
            sum(n)::BIGINT AS lifetime_sessions, sum(revenue)::DOUBLE AS lifetime_revenue,
            {half_up("sum(round(rate * 100)::BIGINT)", "count(rate) * 100", 6)} AS avg_utilization
        FROM snapshot JOIN stations_m USING (station_key) GROUP BY station_name, city
        ORDER BY sum(revenue) DESC NULLS FIRST, station_name, city LIMIT 10""",
    "top_stations_revenue": """
        SELECT station_name, network, city, count(*) AS total_sessions,
            sum(revenue)::DOUBLE AS total_revenue, sum(kwh)::DOUBLE AS total_kwh
        FROM bridged JOIN (SELECT station_key, station_name, network, city FROM stations_b)
            USING (station_key)
        GROUP BY station_name, network, city
        ORDER BY sum(revenue) DESC NULLS FIRST, station_name, network, city LIMIT 10""",
    "monthly_revenue": f"""
        SELECT (date_key // 100 % 100)::INTEGER AS month,
            strftime(make_date(2000, (date_key // 100 % 100)::INTEGER, 1), '%b') AS month_name,
            count(*) AS session_count, sum(revenue)::DOUBLE AS monthly_revenue,
            {half_up(scaled("sum(revenue)", 2), "count(revenue) * 100", 2)} AS avg_session_revenue
        FROM bridged WHERE date_key IS NOT NULL GROUP BY 1, 2""",
    "evs_per_station": f"""
        SELECT m.city, m.county, total AS total_ev_registrations,
            count(DISTINCT station_key) AS station_count,
            {half_up("total", "count(DISTINCT station_key)", 2)} AS evs_per_station
        FROM markets m LEFT JOIN stations_b s ON m.zip = s.zip
        GROUP BY m.city, m.county, total HAVING count(DISTINCT station_key) > 0
        ORDER BY total DESC, m.city, m.county LIMIT 10""",
    "evs_per_station_listed": f"""
        SELECT m.city, m.county, total AS total_ev_registrations,
            count(DISTINCT station_key) AS station_count,
            {half_up("total", "count(DISTINCT station_key)", 2)} AS evs_per_station
        FROM markets m LEFT JOIN listed s ON m.zip = s.zip
        GROUP BY m.city, m.county, total HAVING count(DISTINCT station_key) > 0
        ORDER BY total DESC, m.city, m.county LIMIT 10""",
    "county_stations_listed": """
        SELECT m.county, count(DISTINCT station_key) AS station_count
        FROM markets m JOIN listed s ON m.zip = s.zip GROUP BY m.county""",
    "row_counts": """
        SELECT 'raw_ev_stations' AS table_name, count(*) AS row_count FROM r_stations
        UNION ALL SELECT 'raw_ev_registrations', count(*) FROM r_registrations
        UNION ALL SELECT 'raw_sessions', count(*) FROM r_sessions
        UNION ALL SELECT 'dim_location', count(*) FROM places
        UNION ALL SELECT 'dim_ev_market', count(*) FROM markets
        UNION ALL SELECT 'fact_charging_session', count(*) FROM bridged""",
    "duplicate_keys": """
        SELECT session_id, count(*) AS dup_count FROM r_sessions GROUP BY 1 HAVING count(*) > 1""",
    "duplicate_zip_city": """
        SELECT zip, city, count(*) AS dup_count FROM cleaned GROUP BY 1, 2 HAVING count(*) > 1""",
    "dimension_duplicates": """
        SELECT zip, city, count(*) AS dup_count FROM places GROUP BY 1, 2 HAVING count(*) > 1""",
    "fk_fill_rates": """
        SELECT count(*) AS total_sessions, count(station_key) AS has_station,
            count(date_key) AS has_date, count(location_key) AS has_location,
            count(market_key) AS has_market FROM bridged""",
    "missing_dates": """
        SELECT DISTINCT date_key FROM matched
        WHERE date_key NOT BETWEEN 19960101 AND 20011231""",
    "placeholder_counts": """
        SELECT count(*) FILTER (WHERE county = '') AS blank_counties,
            count(*) FILTER (WHERE zip = '00000') AS placeholder_zips,
            count(*) FILTER (WHERE model_year IS NULL) AS unknown_years FROM cleaned""",
    "overflow_counts": """
        SELECT count(*) FILTER (WHERE kwh >= 10000000) AS kwh_delivered,
            count(*) FILTER (WHERE revenue >= 100000000) AS revenue_usd,
            count(*) FILTER (WHERE minutes >= 2147483648) AS duration_minutes FROM big_sessions""",
    "overflow_ratios": """
        SELECT count(*) FILTER (WHERE price >= 1000000) AS revenue_per_kwh FROM big_matched""",
    "market_duplicates": """
        SELECT zip, count(*) AS dup_count FROM markets GROUP BY zip HAVING count(*) > 1""",
    "session_sample": """
        SELECT 'sample' AS rows_of, least(5, count(*)) AS row_count FROM r_sessions
        UNION ALL SELECT 'known', least(5, count(*)) FROM r_sessions""",
    "snapshot_identity_keys": """
        SELECT count(*) AS row_count, count(*) AS distinct_keys, 0::BIGINT AS missing_keys FROM snapshot""",
    "csv_station_feed_mixed": """
        SELECT id AS ID, station_name AS STATIONNAME, CASE WHEN k % 3 <> 2 THEN zip END AS ZIP,
            trim(city) AS CITY FROM r_stations""",
    "csv_stations": """
        SELECT id, station_name || ', ' || p_type || ' "model"' AS station_name, ev_network, city,
            zip, CASE WHEN l2 IS NULL THEN 'n/a' ELSE l2::VARCHAR END AS ev_level2_evse_num,
            coalesce(open_date::VARCHAR, 'unknown') AS open_date FROM r_stations""",
    "csv_stations_line_breaks": """
        SELECT id, CASE WHEN k % 3 = 0 THEN station_name || chr(10) || '"second, line",' || chr(10) || id
            ELSE station_name END AS station_name, zip,
            coalesce(open_date::VARCHAR, 'unknown') AS open_date FROM r_stations""",
    "csv_station_feed": """
        SELECT id AS ID, station_name AS STATIONNAME, ev_network AS EVNETWORK, zip AS ZIP,
            trim(city) AS CITY, NULL::VARCHAR AS STATE,
            coalesce(open_date::VARCHAR, 'unknown') AS OPENDATE FROM r_stations""",
    "csv_sessions_loaded": """
        SELECT number AS session_id, station AS station_id, session_date::VARCHAR AS session_date,
            kwh::DOUBLE AS kwh_delivered, minutes AS duration_minutes,
            revenue::DOUBLE AS revenue_usd
        FROM ragged WHERE NOT malformed AND session_date IS NOT NULL""",
    "csv_sessions_rejected": """
        SELECT CASE WHEN malformed THEN 'malformed row' ELSE 'bad session_date' END AS reason,
            count(*) AS row_count, count(DISTINCT number) AS session_ids
        FROM ragged WHERE malformed OR session_date IS NULL GROUP BY 1""",
    "typed_sessions_rejected": """
        SELECT CASE WHEN session_date IS NULL THEN 'bad session_id, session_date'
            ELSE 'bad session_id' END AS reason, count(*) AS row_count
        FROM r_sessions GROUP BY 1""",
    "inserted_locations": """
        SELECT row_number() OVER (ORDER BY region <> 'North', county_name) AS location_key,
            county_name, NULL::VARCHAR AS state_code, region, population, median_income FROM counties""",
    "inserted_calendar": _YEAR_ROWS,
    "loaded_raw_counts": """
        SELECT 'stations' AS tbl, count(*) AS row_count FROM r_stations
        UNION ALL SELECT 'registrations', count(*) FROM r_registrations
        UNION ALL SELECT 'census_population', count(*) FROM r_zips
        UNION ALL SELECT 'census_income', count(*) FILTER (WHERE z % 9 <> 0) FROM r_zips
        UNION ALL SELECT 'sessions', count(*) FROM r_sessions""",
    "csv_source_counts": """
        SELECT 'stations' AS tbl, count(*) AS row_count FROM r_stations
        UNION ALL SELECT 'station_feed', count(*) FROM r_stations
        UNION ALL SELECT 'registrations', count(*) FROM r_registrations
        UNION ALL SELECT 'census_population', count(*) FROM r_zips
        UNION ALL SELECT 'census_income', count(*) FILTER (WHERE z % 9 <> 0) FROM r_zips
        UNION ALL SELECT 'sessions', count(*) FROM r_sessions
        UNION ALL SELECT 'typed_sessions', count(session_date) FROM r_sessions
        UNION ALL SELECT 'stations skipped', 0
        UNION ALL SELECT 'registrations skipped', 0
        UNION ALL SELECT 'census_population skipped', 0
        UNION ALL SELECT 'census_income skipped', 0
        UNION ALL SELECT 'sessions skipped', 0
        UNION ALL SELECT 'typed_sessions skipped', count(*) - count(session_date)
            FROM r_sessions""",
    "rebuilt_layers": """
        SELECT 'zip_to_county' AS tbl, count(*) AS row_count FROM zips
        UNION ALL SELECT 'dim_date', 2557
        UNION ALL SELECT 'dim_date_bridged', 2192
        UNION ALL SELECT 'dim_location_county', count(*) FROM counties
        UNION ALL SELECT 'dim_station_matched', count(*) FROM stations_m
        UNION ALL SELECT 'fact_market_demand', count(*) FROM demand
        UNION ALL SELECT 'fact_session_matched', count(*) FROM matched
        UNION ALL SELECT 'fact_station_daily_snapshot', count(*) FROM snapshot
        UNION ALL SELECT 'registrations_clean', count(*) FROM cleaned
        UNION ALL SELECT 'dim_station_bridged', count(*) FROM stations_b
        UNION ALL SELECT 'dim_location_zip_city', count(*) FROM places
        UNION ALL SELECT 'dim_ev_market', count(*) FROM markets
        UNION ALL SELECT 'fact_session_bridged', count(*) FROM bridged""",
}

# The same results from stored tables.
QUERIES |= {
    "stored_row_counts": QUERIES["row_counts"],
    "stored_fk_fill_rates": QUERIES["fk_fill_rates"],
    "stored_load_reconciliation": QUERIES["load_reconciliation"],
    "stored_stations_lifetime": QUERIES["top_stations_lifetime"],
    "stored_monthly_revenue": QUERIES["monthly_revenue"].replace(
        "date_key IS NOT NULL", "date_key // 10000 = 1998"
    ),
}


def _needs(sql: str) -> list[str]:
    """Relations a statement mentions, each after those it is built on."""
    found: list[str] = []
    for name in RELATIONS:
        if re.search(rf"\b{name}\b", sql):
            for inner in _needs(RELATIONS[name]):
                if inner not in found:
                    found.append(inner)
            if name not in found:
                found.append(name)
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for query, sql in QUERIES.items():
        shared = ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in _needs(sql))
        statements[query] = f"WITH {shared}\n{sql}" if shared else sql
    return statements
