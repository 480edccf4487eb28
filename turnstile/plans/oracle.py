"""Independent DuckDB SQL for each registered key (the correctness oracle).

Written directly against the driver tables, with the period bounds of each
key spelled out as literals (the period algebra itself is checked by the
``period_bounds_grid`` key, whose SQL recomputes it with calendar
arithmetic).  Column names equal the Spark output.
"""

from __future__ import annotations

# Literal period bounds used by the registered keys.
ORD_SI = ("1995-01-01 00:00:00", "2000-05-15 12:00:00")
ORD_PQ = ("2000-01-01 00:00:00", "2000-03-31 23:59:59.999999")
ORD_PY = ("1999-01-01 00:00:00", "1999-12-31 23:59:59.999999")
ORD_PM = ("2000-04-01 00:00:00", "2000-04-30 23:59:59.999999")
ORD_YTD = ("2000-01-01 00:00:00", "2000-05-15 12:00:00")
EV_P90 = ("2023-10-26 00:00:00", "2024-01-24 23:59:59.999999")
EV_PW = ("2024-01-14 00:00:00", "2024-01-20 23:59:59.999999")
EV_YTD = ("2024-01-01 00:00:00", "2024-01-24 15:30:00")
EV_SI = ("1995-01-01 00:00:00", "2024-01-24 15:30:00")

# Label sets of the driver data used as pivot columns.
CATEGORIES = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NATIONS = sorted(f"NATION_{i}" for i in range(25))


# Tab names and descriptions of both bundles.
POPULATION_TABS = [
    ("Outline", "tab names and descriptions"),
    ("Summary", "summary totals for the report period"),
    ("Distinct Clients", "a count of individuals served by sub-period within the period."),
    ("Services", "breakdown by service type and sub-period within the period."),
    ("Housing", "breakdown by housing conditions and sub-period within the period."),
    ("Housing by City", "breakdown by city and sub-period within the period."),
    ("Unsheltered_by_Name", "clients reporting unsheltered housing in the period."),
    ("Incarcerations", "clients reporting incarceration in the report period."),
    ("Gender", "breakdown by gender and sub-period within the period."),
    ("Ethnicity", "breakdown by ethnicity and sub-period within the period."),
    ("Veterans", "breakdown by veteran status and sub-period within the period."),
    ("New Clients", "a list of clients with first visit occurring in the report period."),
]
PERSON_TABS = [
    ("Outline", "tab names and descriptions"),
    ("Summary", "visit, service and housing totals"),
    ("Client Information", "client information"),
    ("Visit Counts Sub-period", "number of visits by sub-period"),
    ("Services Delivered Sub-period", "services delivered by sub-period"),
    ("Housing by Sub-Period", "housing by sub-period"),
    ("Suspensions", "suspension history"),
    ("Incarcerations", "incarceration history"),
]


def between(col: str, b: tuple) -> str:
    return f"{col} BETWEEN TIMESTAMP '{b[0]}' AND TIMESTAMP '{b[1]}'"


def week(ts: str) -> str:
    return f"lpad(CAST((dayofyear({ts}) - 1) // 7 + 1 AS VARCHAR), 2, '0')"


def bucket(ts: str, fmt: str) -> str:
    if fmt == "YYYY-MM":
        return f"strftime({ts}, '%Y-%m')"
    if fmt == "YYYY-MM/DD DY":
        return f"(strftime({ts}, '%Y-%m/%d ') || upper(strftime({ts}, '%a')))"
    if fmt == "YYYY-MM/DD WW":
        return f"(strftime({ts}, '%Y-%m/%d ') || {week(ts)})"
    if fmt == "YYYY-MM WW":
        return f"(strftime({ts}, '%Y-%m ') || {week(ts)})"
    if fmt == "HH24":
        return f"strftime({ts}, '%H')"
    raise ValueError(fmt)


def prefix(col: str, delim: str = " ") -> str:
    # DuckDB's left(s, -1) drops the last character, as Postgres does.
    return f"left({col}, strpos({col}, '{delim}') - 1)"


def filter_cols(agg: str, label: str, values, rename: dict | None = None) -> str:
    cols = []
    for v in values:
        name = (rename or {}).get(v, v)
        cols.append(f"CAST(COALESCE({agg} FILTER (WHERE {label} = '{v}'), 0) AS BIGINT) AS \"{name}\"")
    return ", ".join(cols)


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
STATUS = ("CASE WHEN c_acctbal < 0 THEN 'No' WHEN c_acctbal < 5000 THEN 'Unknown' "
          "WHEN c_acctbal IS NOT NULL THEN 'Yes' END")


def _population() -> dict[str, str]:
    q = {}
    q["distinct_clients_total"] = f"""
        SELECT min(o_orderdate) AS start, max(o_orderdate) AS "end",
               CAST(count(DISTINCT o_custkey) AS BIGINT) AS clients
        FROM orders WHERE {between('o_orderdate', ORD_SI)}"""
    q["distinct_clients_by_period"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM/DD WW')} AS period,
               CAST(count(DISTINCT c_custkey) AS BIGINT) AS clients
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE {between('o_orderdate', ORD_PQ)} GROUP BY 1"""
    svc = f"""
        SELECT o_orderdate, {prefix('p_name')} AS cat
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
        WHERE {between('o_orderdate', ORD_PY)} AND p_size - 25 <= 0"""
    q["services_total"] = f"SELECT cat AS servicename, count(*) AS total FROM ({svc}) GROUP BY 1"
    q["services_pivot"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM')} AS period, {filter_cols('count(*)', 'cat', CATEGORIES)}
        FROM ({svc}) GROUP BY 1"""
    q["services_by_period"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM')} AS period, cat AS label, count(*) AS total FROM ({svc}) GROUP BY 1, 2"""
    housing = f"""
        SELECT ts, {prefix('p_name')} AS lab FROM events JOIN part ON p_partkey = {K}
        WHERE event_type = 'view' AND {between('ts', EV_P90)}"""
    q["housing_total"] = f"SELECT lab AS hresponse, count(*) AS total FROM ({housing}) GROUP BY 1"
    q["housing_pivot"] = f"""
        SELECT {bucket('ts', 'YYYY-MM WW')} AS period, {filter_cols('count(*)', 'lab', CATEGORIES)}
        FROM ({housing}) GROUP BY 1"""
    q["housing_by_period"] = f"""
        SELECT {bucket('ts', 'YYYY-MM WW')} AS period, lab AS label, count(*) AS total FROM ({housing}) GROUP BY 1, 2"""
    city = f"""
        SELECT ts, n_name AS lab FROM events JOIN nation ON n_nationkey = {K}
        WHERE event_type = 'click' AND {between('ts', EV_PW)}"""
    q["city_total"] = f"SELECT lab AS cresponse, count(*) AS total FROM ({city}) GROUP BY 1"
    q["city_pivot"] = f"""
        SELECT {bucket('ts', 'YYYY-MM/DD DY')} AS period, {filter_cols('count(*)', 'lab', NATIONS)}
        FROM ({city}) GROUP BY 1"""
    q["flagged_people"] = f"""
        SELECT c_mktsegment AS firstname, c_name AS lastname, CAST(NULL AS VARCHAR) AS aliasname,
               count(*) AS unsheltered_nights
        FROM events JOIN customer ON c_custkey = user_id
        WHERE event_type = 'view' AND {K} = 5 AND {between('ts', EV_P90)}
          AND EXISTS (SELECT 1 FROM part WHERE p_partkey = 5)
        GROUP BY c_custkey, c_mktsegment, c_name"""
    q["reported_people"] = f"""
        SELECT DISTINCT c_custkey AS idperson, c_mktsegment AS firstname, c_name AS lastname
        FROM events JOIN customer ON c_custkey = user_id
        WHERE event_type = 'signup' AND {K} = 2 AND {between('ts', EV_YTD)}"""
    seg = f"""
        SELECT o_orderdate, c_custkey, c_mktsegment AS lab FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE {between('o_orderdate', ORD_PQ)}"""
    q["category_total"] = f"""
        SELECT lab AS response, CAST(count(DISTINCT c_custkey) AS BIGINT) AS total FROM ({seg}) GROUP BY 1"""
    q["category_pivot"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM/DD WW')} AS period,
               {filter_cols('count(DISTINCT c_custkey)', 'lab', SEGMENTS)}
        FROM ({seg}) GROUP BY 1"""
    q["category_by_period"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM/DD WW')} AS period, lab AS label,
               CAST(count(DISTINCT c_custkey) AS BIGINT) AS total FROM ({seg}) GROUP BY 1, 2"""
    nat = f"""
        SELECT o_orderdate, c_custkey, n_name AS lab FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey WHERE {between('o_orderdate', ORD_PM)}"""
    q["category2_total"] = f"""
        SELECT lab AS response, CAST(count(DISTINCT c_custkey) AS BIGINT) AS total FROM ({nat}) GROUP BY 1"""
    q["category2_pivot"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM/DD DY')} AS period,
               {filter_cols('count(DISTINCT c_custkey)', 'lab', NATIONS)}
        FROM ({nat}) GROUP BY 1"""
    st = f"""
        SELECT o_orderdate, c_custkey, {STATUS} AS lab FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE {between('o_orderdate', ORD_YTD)}"""
    q["status_total"] = f"""
        SELECT lab AS response,
               CASE lab WHEN 'Yes' THEN 'Veterans' WHEN 'No' THEN 'Non-veterans'
                        ELSE 'Veteran status Unknown' END AS name,
               CAST(count(DISTINCT c_custkey) AS BIGINT) AS total
        FROM ({st}) WHERE lab IS NOT NULL GROUP BY 1"""
    q["status_pivot"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM')} AS period,
               {filter_cols('count(DISTINCT c_custkey)', 'lab', ['No', 'Unknown', 'Yes'],
                            {'No': 'non-veteran', 'Unknown': 'unknown', 'Yes': 'veteran'})}
        FROM ({st}) WHERE lab IS NOT NULL GROUP BY 1"""
    q["total_and_breakdown"] = f"""
        SELECT {bucket('o_orderdate', 'YYYY-MM/DD WW')} AS period, lab AS response,
               CAST(count(DISTINCT c_custkey) AS BIGINT) AS total,
               CAST(grouping({bucket('o_orderdate', 'YYYY-MM/DD WW')}) AS INTEGER) AS is_total
        FROM ({seg}) GROUP BY GROUPING SETS ((1, 2), (2))"""
    q["new_people"] = f"""
        SELECT c_mktsegment AS firstname, c_name AS lastname, CAST(NULL AS VARCHAR) AS aliasname,
               CAST(fs AS DATE) AS startdate
        FROM (SELECT o_custkey, min(o_orderdate) AS fs FROM orders GROUP BY 1) f
        JOIN customer ON c_custkey = o_custkey WHERE {between('fs', ORD_PY)}"""
    rank = f"""
        SELECT c_custkey AS idperson, c_mktsegment AS firstname, c_name AS lastname,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS clientvisits
        FROM customer JOIN orders ON c_custkey = o_custkey
        WHERE {between('o_orderdate', ORD_SI)} GROUP BY 1, 2, 3"""
    q["visit_ranking"] = rank
    q["visit_topk"] = f"SELECT * FROM ({rank}) ORDER BY clientvisits DESC, idperson LIMIT 10"
    flagged = f"""
        SELECT c_custkey, c_name, count(*) AS n FROM events JOIN customer ON c_custkey = user_id
        WHERE event_type = 'view' AND {K} = 5 AND {between('ts', EV_P90)} AND EXISTS (SELECT 1 FROM part WHERE p_partkey = 5) GROUP BY 1, 2"""
    firsts = f"""
        SELECT c_custkey, c_name, fs FROM (SELECT o_custkey, min(o_orderdate) AS fs FROM orders GROUP BY 1) f
        JOIN customer ON c_custkey = o_custkey WHERE {between('fs', ORD_PY)}"""
    twins = """
        SELECT p_partkey, p_type, p_name FROM part
        WHERE (p_type, p_name) IN (SELECT p_type, p_name FROM part GROUP BY 1, 2 HAVING count(*) > 1)"""
    q["report_order"] = " UNION ALL ".join(
        f"SELECT '{report}' AS report, row_number() OVER (ORDER BY {order}) AS row_no, CAST({name} AS VARCHAR) AS name FROM ({sql})"
        for report, name, order, sql in (
            ("services_total", "servicename", "total DESC NULLS FIRST, servicename NULLS FIRST", q["services_total"]),
            ("city_total", "cresponse", "total DESC NULLS FIRST, cresponse NULLS FIRST", q["city_total"]),
            ("flagged_people", "c_name", "n DESC, c_custkey", flagged),
            ("reported_people", "idperson", "idperson", q["reported_people"]),
            ("status_total", "response", "response DESC NULLS FIRST", q["status_total"]),
            ("new_people", "c_name", "fs, c_custkey", firsts),
            ("visit_ranking", "idperson", "clientvisits DESC, idperson", rank),
            ("exact_duplicates", "p_partkey", "p_name, p_type, p_partkey", twins)))
    return q


# --------------------------------------------------------------- calendar

RELATIVE = ["PD", "PW", "PM", "PQ", "PY", "YTD", "WTD", "TODAY", "P90", "SI"]
DAY_RE = r"^\d{1,2}/\d{1,2}/\d{4}$"
MONTH_RE = r"^YYYYMM\d{6}$"


def bounds_sql(code: str, as_of: str, inception: str = "1995-01-01 00:00:00") -> tuple[str, str, str]:
    """(start, end, bucket) SQL for a period code, by calendar arithmetic."""
    dd = f"CAST({as_of} AS DATE)"
    w = f"({dd} - CAST(dayofweek({as_of}) AS INTEGER))"
    day = f"try_strptime({code}, '%m/%d/%Y')"
    month = f"try_strptime(substr({code}, 7, 6) || '01', '%Y%m%d')"
    is_day = f"(regexp_matches({code}, '{DAY_RE}') AND {day} IS NOT NULL)"
    is_month = f"(regexp_matches({code}, '{MONTH_RE}') AND {month} IS NOT NULL)"
    us = "INTERVAL 1 MICROSECOND"
    start = f"""CASE
      WHEN {code} = 'PD' THEN CAST({dd} - 1 AS TIMESTAMP)
      WHEN {code} = 'PW' THEN CAST({w} - 7 AS TIMESTAMP)
      WHEN {code} = 'PM' THEN CAST(date_trunc('month', {dd}) - INTERVAL 1 MONTH AS TIMESTAMP)
      WHEN {code} = 'PQ' THEN CAST(date_trunc('quarter', {dd}) - INTERVAL 3 MONTH AS TIMESTAMP)
      WHEN {code} = 'PY' THEN CAST(date_trunc('year', {dd}) - INTERVAL 1 YEAR AS TIMESTAMP)
      WHEN {code} = 'YTD' THEN CAST(date_trunc('year', {dd}) AS TIMESTAMP)
      WHEN {code} = 'WTD' THEN CAST({w} AS TIMESTAMP)
      WHEN {code} = 'TODAY' THEN CAST({dd} AS TIMESTAMP)
      WHEN {code} = 'P90' THEN CAST({dd} - 90 AS TIMESTAMP)
      WHEN {code} = 'SI' THEN TIMESTAMP '{inception}'
      WHEN {is_day} THEN CAST({day} AS TIMESTAMP)
      WHEN {is_month} THEN CAST({month} AS TIMESTAMP) END"""
    end = f"""CASE
      WHEN {code} = 'PD' THEN CAST({dd} AS TIMESTAMP) - {us}
      WHEN {code} = 'PW' THEN CAST({w} AS TIMESTAMP) - {us}
      WHEN {code} = 'PM' THEN CAST(date_trunc('month', {dd}) AS TIMESTAMP) - {us}
      WHEN {code} = 'PQ' THEN CAST(date_trunc('quarter', {dd}) AS TIMESTAMP) - {us}
      WHEN {code} = 'PY' THEN CAST(date_trunc('year', {dd}) AS TIMESTAMP) - {us}
      WHEN {code} IN ('YTD', 'WTD', 'TODAY', 'SI') THEN CAST({as_of} AS TIMESTAMP)
      WHEN {code} = 'P90' THEN CAST({dd} + 1 AS TIMESTAMP) - {us}
      WHEN {is_day} THEN CAST({day} AS TIMESTAMP) + INTERVAL 1 DAY - {us}
      WHEN {is_month} THEN CAST({month} AS TIMESTAMP) + INTERVAL 1 MONTH - {us} END"""
    bucket_ = f"""CASE
      WHEN {code} IN ('PD', 'TODAY') THEN 'HH24'
      WHEN {code} IN ('PW', 'PM', 'WTD') THEN 'YYYY-MM/DD DY'
      WHEN {code} = 'PQ' THEN 'YYYY-MM/DD WW'
      WHEN {code} = 'P90' THEN 'YYYY-MM WW'
      WHEN {code} IN ('PY', 'YTD', 'SI') THEN 'YYYY-MM'
      WHEN {is_day} THEN 'HH24'
      WHEN {is_month} THEN 'YYYY-MM' END"""
    return start, end, bucket_


FRIENDLY_SQL = ("CASE code WHEN 'PD' THEN 'Prior Day' WHEN 'PW' THEN 'Prior Week' WHEN 'PM' THEN 'Prior Month' "
                "WHEN 'PQ' THEN 'Prior Quarter' WHEN 'PY' THEN 'Prior Year' WHEN 'YTD' THEN 'Year to Date' "
                "WHEN 'WTD' THEN 'Week to Date' WHEN 'TODAY' THEN 'Today' WHEN 'P90' THEN 'Previous 90 days' "
                "WHEN 'SI' THEN 'all dates' ELSE 'Unknown Period' END")


def _calendar() -> dict[str, str]:
    q = {}
    codes = ", ".join(f"'{c}'" for c in RELATIVE)
    grid_codes = f"""
        SELECT as_of, unnest([{codes}, strftime(as_of, '%-m/%-d/%Y'), 'YYYYMM' || strftime(as_of, '%Y%m')]) AS code
        FROM (SELECT DISTINCT o_orderdate AS as_of FROM orders)"""
    s, e, bk = bounds_sql("code", "as_of")
    q["period_bounds_grid"] = f"SELECT as_of, code, {s} AS start, {e} AS \"end\", {bk} AS bucket FROM ({grid_codes})"
    q["period_labels"] = f"SELECT DISTINCT code, {FRIENDLY_SQL} AS label FROM ({grid_codes})"
    for key, fmt, tbl, ts in [("bucket_month", "YYYY-MM", "orders", "o_orderdate"),
                              ("bucket_day_dy", "YYYY-MM/DD DY", "orders", "o_orderdate"),
                              ("bucket_day_ww", "YYYY-MM/DD WW", "orders", "o_orderdate"),
                              ("bucket_month_ww", "YYYY-MM WW", "orders", "o_orderdate"),
                              ("bucket_hour", "HH24", "events", "ts")]:
        q[key] = f"SELECT {bucket(ts, fmt)} AS period, count(*) AS visits FROM {tbl} GROUP BY 1"
    grid = q["period_bounds_grid"]
    q["grid_figures"] = f"""
        WITH grid AS ({grid}), f AS (
          SELECT g.start, g."end", count(o_orderkey) AS visits, count(DISTINCT o_custkey) AS clients
          FROM (SELECT DISTINCT start, "end" FROM grid) g LEFT JOIN orders ON o_orderdate BETWEEN g.start AND g."end" GROUP BY 1, 2)
        SELECT as_of, code, grid.start, grid."end", CAST(visits AS BIGINT) AS visits, CAST(clients AS BIGINT) AS clients
        FROM grid JOIN f ON f.start = grid.start AND f."end" = grid."end\""""
    days = "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL"
    clock = f"""
        SELECT CAST(day AS TIMESTAMP) + to_seconds((datediff('day', DATE '1970-01-01', day) * 7919) % 86399 + 1) AS as_of,
               unnest([{codes}, strftime(day, '%-m/%-d/%Y'), 'YYYYMM' || strftime(day, '%Y%m')]) AS code FROM ({days})"""
    q["clock_figures"] = f"""
        WITH g AS (SELECT as_of, code, {s} AS start, {e} AS "end" FROM ({clock}))
        SELECT as_of, code, start, "end", CAST(count(event_id) AS BIGINT) AS visits, CAST(count(DISTINCT user_id) AS BIGINT) AS clients
        FROM g LEFT JOIN events ON ts BETWEEN start AND "end" GROUP BY 1, 2, 3, 4"""
    q["cube_period_clients"] = f"""
        SELECT g.start, g."end", CAST(count(o_orderkey) AS BIGINT) AS visits, CAST(count(DISTINCT o_custkey) AS BIGINT) AS clients
        FROM (SELECT DISTINCT start, "end" FROM ({grid})) g LEFT JOIN orders ON o_orderdate BETWEEN g.start AND g."end" GROUP BY 1, 2"""
    q["cube_category_clients"] = f"""
        SELECT g.start, g."end", c_mktsegment AS response, CAST(count(*) AS BIGINT) AS visits,
               CAST(count(DISTINCT o_custkey) AS BIGINT) AS clients
        FROM (SELECT DISTINCT start, "end" FROM ({grid}) WHERE code IN ('PM', 'PQ', 'PY') OR code LIKE 'YYYYMM%') g
        JOIN orders ON o_orderdate BETWEEN g.start AND g."end" JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3"""
    reqs = ", ".join(f"({i + 1}, '{c}')" for i, c in enumerate(RELATIVE)) + \
        ", (11, '3/15/2000'), (12, 'YYYYMM199902'), (13, 'SOON')"
    s, e, _ = bounds_sql("interval", "TIMESTAMP '2000-05-15 12:00:00'")
    q["requests_x_periods"] = f"""
        WITH r AS (SELECT request_id, interval, {s} AS start, {e} AS "end"
                   FROM (VALUES {reqs}) t(request_id, interval)),
             ok AS (SELECT * FROM r WHERE start IS NOT NULL)
        SELECT CAST(ok.request_id AS BIGINT) AS request_id, ok.interval, ok.start, ok."end",
               CAST(count(o_orderkey) AS BIGINT) AS visits,
               CAST(count(DISTINCT o_custkey) AS BIGINT) AS clients
        FROM ok LEFT JOIN orders ON o_orderdate BETWEEN ok.start AND ok."end"
        GROUP BY 1, 2, 3, 4"""
    return q


# --------------------------------------------------------- summary, bundle

YTD_ORD, YTD_EV = ORD_YTD, EV_YTD


def _summary_sql() -> str:
    o, ev = YTD_ORD, YTD_EV
    parts = [
        f"SELECT 1 AS section, 'Total distinct clients in report period' AS name, "
        f"CAST(count(DISTINCT o_custkey) AS BIGINT) AS count FROM orders WHERE {between('o_orderdate', o)}",
        f"""SELECT 2, coalesce(cat, 'Unknown') || ' services delivered.', count(*) FROM (
            SELECT {prefix('p_name')} AS cat FROM orders JOIN lineitem ON l_orderkey = o_orderkey
            JOIN part ON p_partkey = l_partkey WHERE {between('o_orderdate', o)} AND p_size - 25 <= 0) GROUP BY cat""",
        f"""SELECT 3, ' Days spent in ' || coalesce(lab, 'Unknown'), count(*) FROM (
            SELECT {prefix('p_name')} AS lab FROM events JOIN part ON p_partkey = {K}
            WHERE event_type = 'view' AND {between('ts', ev)}) GROUP BY lab""",
        f"""SELECT 4, ' Nights spent in ' || coalesce(n_name, 'Unknown'), count(*) FROM events
            JOIN nation ON n_nationkey = {K} WHERE event_type = 'click' AND {between('ts', ev)} GROUP BY n_name""",
        f"""SELECT 5, 'Gender -' || coalesce(c_mktsegment, 'Unknown'), count(DISTINCT c_custkey) FROM orders
            JOIN customer ON c_custkey = o_custkey WHERE {between('o_orderdate', o)} GROUP BY c_mktsegment""",
        f"""SELECT 6, 'Ethnicity -' || coalesce(n_name, 'Unknown'), count(DISTINCT c_custkey) FROM orders
            JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
            WHERE {between('o_orderdate', o)} GROUP BY n_name""",
        f"""SELECT 7, CASE lab WHEN 'Yes' THEN 'Veterans' WHEN 'No' THEN 'Non-veterans'
                   ELSE 'Veteran status Unknown' END, count(DISTINCT c_custkey) FROM (
            SELECT c_custkey, {STATUS} AS lab FROM orders JOIN customer ON c_custkey = o_custkey
            WHERE {between('o_orderdate', o)}) WHERE lab IS NOT NULL GROUP BY lab""",
    ]
    return "SELECT section, name, CAST(count AS BIGINT) AS count FROM (" + " UNION ALL ".join(parts) + ")"


def _manifest_sql() -> str:
    o, ev = YTD_ORD, YTD_EV
    counts = [
        f"SELECT {len(POPULATION_TABS)}",
        f"SELECT count(*) FROM ({_summary_sql()})",
        f"SELECT count(DISTINCT {bucket('o_orderdate', 'YYYY-MM')}) FROM orders JOIN customer ON c_custkey = o_custkey "
        f"WHERE {between('o_orderdate', o)}",
        f"SELECT count(DISTINCT {bucket('o_orderdate', 'YYYY-MM')}) FROM orders JOIN lineitem ON l_orderkey = o_orderkey "
        f"JOIN part ON p_partkey = l_partkey WHERE {between('o_orderdate', o)} AND p_size - 25 <= 0",
        f"SELECT count(DISTINCT {bucket('ts', 'YYYY-MM')}) FROM events JOIN part ON p_partkey = {K} "
        f"WHERE event_type = 'view' AND {between('ts', ev)}",
        f"SELECT count(DISTINCT {bucket('ts', 'YYYY-MM')}) FROM events JOIN nation ON n_nationkey = {K} "
        f"WHERE event_type = 'click' AND {between('ts', ev)}",
        f"SELECT count(DISTINCT user_id) FROM events JOIN customer ON c_custkey = user_id "
        f"WHERE event_type = 'view' AND {K} = 5 AND {between('ts', ev)} AND EXISTS (SELECT 1 FROM part WHERE p_partkey = 5)",
        f"SELECT count(DISTINCT user_id) FROM events JOIN customer ON c_custkey = user_id "
        f"WHERE event_type = 'signup' AND {K} = 2 AND {between('ts', ev)}",
        f"SELECT count(DISTINCT {bucket('o_orderdate', 'YYYY-MM')}) FROM orders JOIN customer ON c_custkey = o_custkey "
        f"WHERE {between('o_orderdate', o)}",
        f"SELECT count(DISTINCT {bucket('o_orderdate', 'YYYY-MM')}) FROM orders JOIN customer ON c_custkey = o_custkey "
        f"JOIN nation ON n_nationkey = c_nationkey WHERE {between('o_orderdate', o)}",
        f"SELECT count(DISTINCT {bucket('o_orderdate', 'YYYY-MM')}) FROM orders JOIN customer ON c_custkey = o_custkey "
        f"WHERE {between('o_orderdate', o)} AND {STATUS} IS NOT NULL",
        f"SELECT count(*) FROM (SELECT o_custkey, min(o_orderdate) AS fs FROM orders GROUP BY 1) "
        f"JOIN customer ON c_custkey = o_custkey WHERE {between('fs', o)}",
    ]
    rows = []
    for i, ((tab, desc), cnt) in enumerate(zip(POPULATION_TABS, counts)):
        d = desc.replace("'", "''")
        rows.append(f"SELECT {i} AS ordinal, '{tab}' AS tab, '{d}' AS description, CAST(({cnt}) AS BIGINT) AS rows")
    return " UNION ALL ".join(rows)


def _assembly() -> dict[str, str]:
    return {"summary": _summary_sql(), "bundle_manifest": _manifest_sql()}


# ----------------------------------------------------------------- person

ASOF_ORD = "TIMESTAMP '2000-05-15 12:00:00'"


def _person() -> dict[str, str]:
    o, ev = ORD_YTD, EV_YTD
    q = {}

    def txt(c):
        return (f"strftime({c}, '%m/%d/%Y') || ' (' || CAST(CAST(floor((epoch_us({ASOF_ORD}) - epoch_us({c})) "
                f"/ 86400000000) AS BIGINT) AS VARCHAR) || ' days ago)'")
    q["person_header"] = f"""
        WITH span AS (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l FROM orders GROUP BY 1),
        p AS (SELECT c.*, n_name, f, l FROM customer c LEFT JOIN nation ON n_nationkey = c_nationkey
              LEFT JOIN span ON o_custkey = c_custkey)
        SELECT c_custkey AS idperson, attr_ord, "Attribute", "Value" FROM (
          SELECT c_custkey, 1 AS attr_ord, 'Name' AS "Attribute", concat_ws(' ', c_mktsegment, c_name) AS "Value" FROM p
          UNION ALL SELECT c_custkey, 2, 'Client ID', CAST(c_custkey AS VARCHAR) FROM p
          UNION ALL SELECT c_custkey, 3, 'Ethnicity', n_name FROM p
          UNION ALL SELECT c_custkey, 4, 'Gender', c_mktsegment FROM p
          UNION ALL SELECT c_custkey, 5, 'Language', CAST(NULL AS VARCHAR) FROM p
          UNION ALL SELECT c_custkey, 6, 'Veteran', {STATUS} FROM p
          UNION ALL SELECT c_custkey, 7, 'First visit', {txt('f')} FROM p
          UNION ALL SELECT c_custkey, 8, 'Last visit', {txt('l')} FROM p
          UNION ALL SELECT c_custkey, 9, 'Credits', CAST(c_acctbal AS VARCHAR) FROM p)"""
    q["person_visits"] = f"""
        SELECT c_custkey AS idperson, min(o_orderdate) AS earliest_visit, max(o_orderdate) AS latest_visit,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS total_visits
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND {between('o_orderdate', o)} GROUP BY 1"""
    q["person_visits_by_period"] = f"""
        SELECT o_custkey AS idperson, {bucket('o_orderdate', 'YYYY-MM')} AS period,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS visits
        FROM orders WHERE {between('o_orderdate', o)} AND o_custkey IN (SELECT c_custkey FROM customer)
        GROUP BY 1, 2"""
    svc = f"""
        SELECT o_custkey, o_orderdate, {prefix('p_name')} AS cat
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
        WHERE {between('o_orderdate', o)} AND p_size - 25 <= 0
          AND o_custkey IN (SELECT c_custkey FROM customer)"""
    q["person_services"] = f"""
        SELECT o_custkey AS idperson, cat AS servicename, count(*) AS total FROM ({svc}) GROUP BY 1, 2"""
    q["person_services_pivot"] = f"""
        SELECT o_custkey AS idperson, {bucket('o_orderdate', 'YYYY-MM')} AS period,
               {filter_cols('count(*)', 'cat', CATEGORIES)} FROM ({svc}) GROUP BY 1, 2"""
    hous = f"""
        SELECT user_id, ts, {prefix('p_name')} AS lab FROM events JOIN part ON p_partkey = {K}
        WHERE event_type = 'view' AND {between('ts', ev)} AND user_id IN (SELECT c_custkey FROM customer)"""
    q["person_housing"] = f"""
        SELECT user_id AS idperson, lab AS housing_type, count(*) AS nights_spent FROM ({hous}) GROUP BY 1, 2"""
    q["person_housing_pivot"] = f"""
        SELECT user_id AS idperson, {bucket('ts', 'YYYY-MM')} AS period,
               {filter_cols('count(*)', 'lab', CATEGORIES)} FROM ({hous}) GROUP BY 1, 2"""
    q["person_suspensions"] = f"""
        SELECT o_custkey AS idperson, o_orderdate AS suspension_starttime,
               CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000) AS BIGINT) AS days,
               CAST((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000 AS BIGINT) AS seconds,
               s_name AS reason
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
        WHERE l_shipdate > o_orderdate AND {between('o_orderdate', o)}
          AND o_custkey IN (SELECT c_custkey FROM customer)"""
    q["person_reported"] = f"""
        SELECT c_custkey AS idperson, CAST(count(DISTINCT event_id) AS BIGINT) AS incarcerations
        FROM customer LEFT JOIN events ON user_id = c_custkey AND event_type = 'signup' AND {K} = 2
             AND {between('ts', ev)} GROUP BY 1"""
    q["person_summary"] = f"""
        SELECT c_custkey AS idperson, 1 AS section, 'Total client visits in report period' AS name,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS count
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND {between('o_orderdate', o)} GROUP BY 1
        UNION ALL
        SELECT o_custkey, 2, coalesce(cat, 'Unknown') || ' services delivered.', count(*) FROM ({svc}) GROUP BY o_custkey, cat
        UNION ALL
        SELECT user_id, 3, ' Days spent in ' || coalesce(lab, 'Unknown'), count(*) FROM ({hous}) GROUP BY user_id, lab"""
    q["person_profile"] = f"""
        SELECT c_custkey AS idperson, c_mktsegment AS firstname, c_name AS lastname,
               CAST(NULL AS VARCHAR) AS alias, CAST(NULL AS INTEGER) AS sexoffender, {STATUS} AS veteran,
               c_acctbal AS credits, fs AS timelinestart,
               c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                             WHERE l_shipdate > o_orderdate AND l_shipdate > TIMESTAMP '2001-07-01 00:00:00')
                 AS currentlysuspended
        FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS fs FROM orders GROUP BY 1) f
             ON o_custkey = c_custkey"""
    said = lambda code, labels: f"CASE {code} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels) + " END"
    q["person_code_labels"] = f"""
        SELECT c_custkey AS idperson,
               {said('c_nationkey + 1', enumerate(["Unknown", "Asian", "Black", "Hispanic", "Native American", "White"], 1))} AS ethnicity,
               {said('n_regionkey + 1', enumerate(["Unknown", "Male", "Female"], 1))} AS gender, CAST(NULL AS VARCHAR) AS language,
               {said("CASE WHEN c_acctbal < 0 THEN 3 WHEN c_acctbal < 5000 THEN 1 WHEN c_acctbal IS NOT NULL THEN 2 END",
                     enumerate(["Veteran status is unknown", "Is a veteran of the US Armed Forces", "Is not a veteran of the US Armed Forces"], 1))} AS veteran
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""
    return q


# ------------------------------------------------- linkage, state, features

def _linkage_and_state() -> dict[str, str]:
    q = {}
    pairs = """
        SELECT a.c_custkey AS id, a.c_mktsegment AS firstname, a.c_name AS lastname,
               b.c_custkey AS dup_id, b.c_mktsegment AS dup_firstname, b.c_name AS dup_lastname
        FROM customer a JOIN customer b ON a.c_custkey <> b.c_custkey
         AND levenshtein(a.c_name, b.c_name) <= 2 AND levenshtein(a.c_mktsegment, b.c_mktsegment) <= 2
        WHERE a.c_name IS NOT NULL AND a.c_mktsegment IS NOT NULL
          AND b.c_name IS NOT NULL AND b.c_mktsegment IS NOT NULL"""
    q["near_duplicates"] = pairs
    q["near_duplicate_counts"] = f"""
        SELECT id, firstname, lastname, CAST(count(*) AS BIGINT) AS dups FROM ({pairs}) GROUP BY 1, 2, 3"""
    classes = """
        WITH RECURSIVE c AS (
          SELECT min(c_custkey) AS class_id, c_mktsegment AS firstname, c_name AS lastname, CAST(count(*) AS BIGINT) AS heads
          FROM customer WHERE c_mktsegment IS NOT NULL AND c_name IS NOT NULL GROUP BY 2, 3),
        e AS (
          SELECT a.class_id AS x, b.class_id AS y, b.heads FROM c a JOIN c b ON a.class_id <> b.class_id
            AND levenshtein(a.firstname, b.firstname) <= 2 AND levenshtein(a.lastname, b.lastname) <= 2),
        reach AS (SELECT class_id AS x, class_id AS y FROM c UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x),
        g AS (SELECT x AS class_id, min(y) AS group_id FROM reach GROUP BY 1),
        n AS (SELECT x AS class_id, count(*) AS near_classes, sum(heads) AS near_heads FROM e GROUP BY 1)"""
    q["duplicate_classes"] = f"""{classes}
        SELECT c.class_id, firstname, lastname, heads, CAST(coalesce(near_classes, 0) AS BIGINT) AS near_classes,
               CAST(coalesce(near_heads, 0) AS BIGINT) AS near_heads, group_id
        FROM c JOIN g ON g.class_id = c.class_id LEFT JOIN n ON n.class_id = c.class_id"""
    q["duplicate_groups"] = f"""{classes}
        SELECT c_custkey AS idperson, c.class_id, g.group_id,
               CAST(sum(1) OVER (PARTITION BY g.group_id) AS BIGINT) AS group_heads
        FROM customer JOIN c ON c.firstname = c_mktsegment AND c.lastname = c_name JOIN g ON g.class_id = c.class_id"""
    q["exact_duplicates"] = """
        SELECT p_partkey AS idperson, p_type AS firstname, p_name AS lastname FROM part
        WHERE (p_type, p_name) IN (SELECT p_type, p_name FROM part GROUP BY 1, 2 HAVING count(*) > 1)"""
    q["suspension_flags"] = """
        SELECT c_custkey AS idperson,
               c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                             WHERE l_shipdate > o_orderdate AND l_shipdate > TIMESTAMP '2001-07-01 00:00:00')
                 AS iscurrentlysuspended
        FROM customer"""
    active = "SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate AND l_shipdate > TIMESTAMP '{}'"
    q["suspension_publishes"] = f"""
        SELECT c_custkey AS idperson, c_custkey IN ({active.format('1998-07-01 00:00:00')}) AS flag_first,
               c_custkey IN ({active.format('2001-07-01 00:00:00')}) AS flag_second FROM customer"""
    walk = """
        SELECT t.as_of, o_custkey AS idperson, CAST(count(*) AS BIGINT) AS open
        FROM (SELECT unnest([TIMESTAMP '1995-06-01 00:00:00', TIMESTAMP '1997-03-15 12:00:00', TIMESTAMP '1997-03-16 00:00:00',
                             TIMESTAMP '1999-12-31 23:59:59', TIMESTAMP '2001-07-01 00:00:00']) AS as_of) t
        JOIN (SELECT o_custkey, o_orderdate, l_shipdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)
          ON l_shipdate > t.as_of {} WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1, 2"""
    q["suspension_walk"] = walk.format("")
    q["suspension_walk_started"] = walk.format("AND o_orderdate <= t.as_of")
    q["feature_table"] = _features_sql()
    cents = [
        [0.2, 0.2, 0.2, 2.0, 300.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
        [0.6, 0.5, 0.5, 4.0, 500.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
        [1.0, 0.9, 0.8, 6.0, 900.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    ]
    rates = ["genderrate", "ethnicityrate", "veteranrate", "servicerate", "creditrate", "unknownrate",
             "stablerate", "unstablerate", "shelteredrate", "unshelteredrate", "jailrate"]

    def dist(c):
        terms = [f"(coalesce({r}, 0.0) - CAST({v!r} AS DOUBLE)) * (coalesce({r}, 0.0) - CAST({v!r} AS DOUBLE))"
                 for r, v in zip(rates, c)]
        return "(" + " + ".join(terms) + ")"
    d0, d1, d2 = (dist(c) for c in cents)
    q["cluster_assign"] = f"""
        SELECT idperson, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS prediction
        FROM (SELECT idperson, {d0} AS d0, {d1} AS d1, {d2} AS d2 FROM ({q['feature_table']}))"""
    means = ", ".join(f"round(avg(coalesce({r}, 0.0)), 6) AS {r}" for r in rates)
    q["cluster_centroids"] = f"""
        SELECT prediction AS cluster, {means}
        FROM ({q['cluster_assign']}) JOIN ({q['feature_table']}) USING (idperson) GROUP BY 1"""
    q["cluster_fit"] = f"""
        SELECT count(*) AS people, CAST(3 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced, true AS converged
        FROM ({q['feature_table']})"""
    q["suspension_state"] = f"""
        SELECT c_custkey AS idperson, customer.* EXCLUDE (c_custkey), f.iscurrentlysuspended
        FROM customer JOIN ({q['suspension_flags']}) f ON f.idperson = c_custkey"""
    return q


def _features_sql() -> str:
    si = EV_SI
    return f"""
        WITH v AS (SELECT o_orderkey, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey
                   WHERE {between('o_orderdate', si)}),
        visits AS (SELECT o_custkey AS idperson, count(o_orderkey) AS visits FROM v GROUP BY 1),
        persons AS (SELECT c_custkey AS idperson, n_regionkey + 1 AS gender_id, c_nationkey + 1 AS ethnicity_id,
                           CASE WHEN c_acctbal < 0 THEN 3 WHEN c_acctbal < 5000 THEN 1
                                WHEN c_acctbal IS NOT NULL THEN 2 END AS veteran_id, c_acctbal AS credits
                    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
                    WHERE c_custkey IN (SELECT o_custkey FROM v)),
        services AS (SELECT o_custkey AS idperson, count(l_partkey) AS services
                      FROM v JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
        housing AS (SELECT user_id AS idperson,
                           count(*) FILTER (WHERE event_type = 'view' AND {K} = 1) AS unknown,
                           count(*) FILTER (WHERE event_type = 'view' AND {K} = 2) AS stable,
                           count(*) FILTER (WHERE event_type = 'view' AND {K} = 3) AS unstable,
                           count(*) FILTER (WHERE event_type = 'view' AND {K} = 4) AS sheltered,
                           count(*) FILTER (WHERE event_type = 'view' AND {K} = 5) AS unsheltered,
                           count(*) FILTER (WHERE event_type = 'view' AND {K} = 6) AS jail
                    FROM events WHERE {between('ts', si)} AND user_id IN (SELECT c_custkey FROM customer)
                    GROUP BY 1),
        j AS (SELECT visits.idperson,
                     CAST(coalesce(visits, 0) AS DOUBLE) AS visits,
                     CAST(coalesce(gender_id, 0) AS DOUBLE) AS gender_id,
                     CAST(coalesce(ethnicity_id, 0) AS DOUBLE) AS ethnicity_id,
                     CAST(coalesce(veteran_id, 0) AS DOUBLE) AS veteran_id,
                     CAST(coalesce(credits, 0) AS DOUBLE) AS credits,
                     CAST(coalesce(services, 0) AS DOUBLE) AS services,
                     CAST(coalesce(unknown, 0) AS DOUBLE) AS unknown,
                     CAST(coalesce(stable, 0) AS DOUBLE) AS stable,
                     CAST(coalesce(unstable, 0) AS DOUBLE) AS unstable,
                     CAST(coalesce(sheltered, 0) AS DOUBLE) AS sheltered,
                     CAST(coalesce(unsheltered, 0) AS DOUBLE) AS unsheltered,
                     CAST(coalesce(jail, 0) AS DOUBLE) AS jail
              FROM visits LEFT JOIN persons USING (idperson) LEFT JOIN services USING (idperson)
                   LEFT JOIN housing USING (idperson)),
        m AS (SELECT max(gender_id) AS g FROM j)
        SELECT idperson,
               gender_id / nullif(g, 0) AS genderrate, ethnicity_id / nullif(g, 0) AS ethnicityrate,
               veteran_id / nullif(g, 0) AS veteranrate,
               services / nullif(visits, 0) AS servicerate, credits / nullif(visits, 0) AS creditrate,
               unknown / nullif(visits, 0) AS unknownrate, stable / nullif(visits, 0) AS stablerate,
               unstable / nullif(visits, 0) AS unstablerate, sheltered / nullif(visits, 0) AS shelteredrate,
               unsheltered / nullif(visits, 0) AS unshelteredrate, jail / nullif(visits, 0) AS jailrate
        FROM j, m"""


def _stream_sql() -> str:
    """Requests derived from the app-user table (rotating type and code), each
    twice, and a profile request for every app user, each answered over the
    orders in its period."""
    codes = ", ".join(f"'{c}'" for c in RELATIVE)
    base = f"""
        SELECT CASE s_suppkey % 3 WHEN 0 THEN 'ALL' WHEN 1 THEN 'IND' ELSE 'PROFILE' END AS kind,
               CASE WHEN s_suppkey % 3 = 2 THEN 'PW' ELSE [{codes}][s_suppkey % 10 + 1] END AS interval,
               CASE WHEN s_suppkey % 3 <> 2 THEN s_suppkey END AS appuser,
               CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END AS client
        FROM supplier"""
    profiles = f"SELECT 'PROFILE', [{codes}][s_suppkey % 10 + 1], NULL, s_suppkey FROM supplier"
    s, e, _ = bounds_sql("interval", ASOF_ORD)
    return f"""
        WITH r AS (SELECT *, row_number() OVER () AS line, {s} AS start, {e} AS "end",
                          {FRIENDLY_SQL.replace('code', 'interval')} AS label
                   FROM ({base} UNION ALL {base} UNION ALL {profiles}))
        SELECT kind, interval, label, start, "end", appuser, email, client, visits, clients FROM (
            SELECT r.line, r.kind, r.interval, r.label, r.start, r."end", r.appuser, u.s_name AS email, r.client,
                   CAST(count(o.o_orderkey) AS BIGINT) AS visits,
                   CAST(count(DISTINCT o.o_custkey) AS BIGINT) AS clients
            FROM r LEFT JOIN supplier u ON u.s_suppkey = r.appuser
            LEFT JOIN orders o ON o.o_orderdate BETWEEN r.start AND r."end"
                 AND (r.kind = 'ALL' OR o.o_custkey = r.client)
            GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9)"""


REJECTS_SQL = """
    SELECT CAST(NULL AS VARCHAR) AS type, CAST(NULL AS VARCHAR) AS interval,
           '{not json ' || CAST(s_suppkey AS VARCHAR) AS corrupt_record FROM supplier
    UNION ALL SELECT 'ZZZ', 'PQ', NULL FROM supplier
    UNION ALL SELECT 'ALL', 'SOON', NULL FROM supplier"""


def _feature_parts_sql() -> dict[str, str]:
    """FEA1-FEA4 as the CTEs of the feature-table oracle."""
    full = _features_sql()
    head = full[:full.index("j AS (")].rstrip().rstrip(",")
    return {
        "feature_people": f"{head} SELECT idperson, gender_id, ethnicity_id, veteran_id, credits FROM persons",
        "feature_visits": f"{head} SELECT idperson, CAST(visits AS BIGINT) AS visits FROM visits",
        "feature_services": f"{head} SELECT idperson, CAST(services AS BIGINT) AS services FROM services",
        "feature_housing": f"{head} SELECT idperson, CAST(unknown AS BIGINT) AS unknown, "
                           "CAST(stable AS BIGINT) AS stable, CAST(unstable AS BIGINT) AS unstable, "
                           "CAST(sheltered AS BIGINT) AS sheltered, CAST(unsheltered AS BIGINT) AS unsheltered, "
                           "CAST(jail AS BIGINT) AS jail FROM housing",
    }


def _person_manifest_sql() -> str:
    q = _person()
    keys = [None, "person_summary", "person_header", "person_visits_by_period", "person_services_pivot",
            "person_housing_pivot", "person_suspensions", "person_reported"]
    rows = []
    for i, ((tab, desc), key) in enumerate(zip(PERSON_TABS, keys)):
        cnt = f"SELECT {len(PERSON_TABS)}" if key is None else f"SELECT count(*) FROM ({q[key]})"
        d = desc.replace("'", "''")
        rows.append(f"SELECT {i} AS ordinal, '{tab}' AS tab, '{d}' AS description, CAST(({cnt}) AS BIGINT) AS rows")
    return " UNION ALL ".join(rows)


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (_calendar(), _population(), _assembly(), _person(), _linkage_and_state(), _feature_parts_sql()):
        out.update(part)
    out["person_bundle_manifest"] = _person_manifest_sql()
    out["request_stream"] = _stream_sql()
    out["request_rejects"] = REJECTS_SQL
    out["request_reports"] = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, 'YTD-2000-05-15_120000' AS report, ordinal, tab, rows FROM ({out[key]})"
        for kind, key in (("ALL", "bundle_manifest"), ("IND", "person_bundle_manifest"))
    ) + " UNION ALL SELECT 'PROFILE', 'profile-2000-05-15_120000', 0, 'Profile', 0"
    return {k: " ".join(v.split()) for k, v in out.items()}
