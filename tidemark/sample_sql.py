"""The same queries as ANSI SQL over the same tables, to check results against."""

from __future__ import annotations

COUNTS = ("confirmed", "deaths")
TOTALS = ("us_confirmed", "us_deaths", "global_confirmed", "global_deaths")
SCORES = ("dowjones_score", "nasdaq100_score", "sp500_score")

VIEWS = {
    "v1": """
        SELECT c_custkey AS uid, n_name AS state, r_name AS country, CAST(o_orderdate AS DATE) AS date,
               CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS confirmed,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS deaths
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        GROUP BY c_custkey, n_name, r_name, CAST(o_orderdate AS DATE)""",
    "state_day": """
        SELECT state, country, date, CAST(SUM(confirmed) AS BIGINT) AS confirmed,
               CAST(SUM(deaths) AS BIGINT) AS deaths
        FROM v1 GROUP BY state, country, date""",
    "state_cum": """
        SELECT state, country, date,
               CAST(SUM(confirmed) OVER (PARTITION BY state ORDER BY date) AS BIGINT) AS confirmed,
               CAST(SUM(deaths) OVER (PARTITION BY state ORDER BY date) AS BIGINT) AS deaths
        FROM state_day""",
    "country_day": """
        SELECT country, date, CAST(SUM(confirmed) AS BIGINT) AS confirmed, CAST(SUM(deaths) AS BIGINT) AS deaths
        FROM v1 GROUP BY country, date""",
    "country_cum": """
        SELECT country, date,
               CAST(SUM(confirmed) OVER (PARTITION BY country ORDER BY date) AS BIGINT) AS confirmed,
               CAST(SUM(deaths) OVER (PARTITION BY country ORDER BY date) AS BIGINT) AS deaths
        FROM country_day""",
    "us_day": """
        SELECT date, CAST(SUM(confirmed) AS BIGINT) AS us_confirmed, CAST(SUM(deaths) AS BIGINT) AS us_deaths
        FROM v1 WHERE country = 'AMERICA' GROUP BY date""",
    "world_day": """
        SELECT date, CAST(SUM(confirmed) AS BIGINT) AS global_confirmed,
               CAST(SUM(deaths) AS BIGINT) AS global_deaths
        FROM v1 GROUP BY date""",
    "both_day": "SELECT u.*, global_confirmed, global_deaths FROM us_day u JOIN world_day w ON u.date = w.date",
    "idx": """
        SELECT CAST(o_orderdate AS DATE) AS date,
               MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS dowjones_score,
               MAX(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END) AS nasdaq100_score,
               MAX(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END) AS sp500_score
        FROM orders WHERE isodow(o_orderdate) <= 5 GROUP BY CAST(o_orderdate AS DATE)""",
    "price": """
        SELECT p_brand AS stock_ticker, CAST(l_shipdate AS DATE) AS date, MAX(l_extendedprice) AS High,
               MIN(l_extendedprice) AS Low, MAX(l_quantity) AS Open, MIN(l_quantity) AS Close,
               SUM(l_quantity) AS Volume, MAX(l_tax) AS adj_close
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, CAST(l_shipdate AS DATE)""",
    "series": """
        SELECT concat(l_returnflag, '-', l_linestatus) AS series_id,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS date, SUM(l_quantity) AS value
        FROM lineitem GROUP BY ALL""",
}


def iso(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {alias or column.split('.')[-1]}"


def dateid(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS BIGINT) AS dateid"


def with_views(names: str, body: str) -> str:
    """``body`` after the named views and the views they need, in declared order."""
    needed = set(names.split())
    for name in reversed(VIEWS):
        if name in needed:
            needed |= {v for v in VIEWS if v != name and f" {v} " in f" {VIEWS[name]} ".replace("\n", " ")}
    chosen = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed]
    joiner = ",\n" if body.lstrip().startswith(",") else "\n"
    return "WITH " + ",\n".join(chosen) + (joiner + body.lstrip().lstrip(",") if joiner == ",\n" else "\n" + body)


def diffs(measures, partition: str = "", order: str = "date") -> str:
    window = f"OVER ({f'PARTITION BY {partition} ' if partition else ''}ORDER BY {order})"
    parts = []
    for m in measures:
        before = f"COALESCE(LAG({m}) {window}, 0)"
        parts.append(f"CAST({m} - {before} AS BIGINT) AS {m}_inc")
        parts.append(
            f"ROUND(COALESCE(({m} - {before}) * CAST(100 AS DOUBLE) / NULLIF({before}, 0), 0), 5) AS {m}_inc_pct"
        )
    return ", ".join(parts)


def fills(columns, alias_suffix: str = "", initial: str | None = None) -> str:
    parts = []
    for c in columns:
        last = f"LAST_VALUE({c} IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        parts.append(f"{f'COALESCE({last}, {initial})' if initial else last} AS {c}{alias_suffix}")
    return ", ".join(parts)


def month_keys(date: str = "date") -> str:
    return (
        f"CAST(year({date}) * 10000 + month({date}) * 100 + 1 AS BIGINT) AS dateid, "
        f"CAST(year({date}) AS INTEGER) AS year, CAST(month({date}) AS INTEGER) AS month, "
        f"strftime({date}, '%B') AS month_name"
    )


TOTALS_DAILY = f"SELECT {dateid('date')}, {iso('date')}, {', '.join(TOTALS)}, {diffs(TOTALS)} FROM both_day"

CASES_INDEX = f""", joined AS (
    SELECT b.*, {', '.join(SCORES)} FROM (SELECT date, {', '.join(TOTALS)}, {diffs(TOTALS)} FROM both_day) b
    LEFT JOIN idx ON b.date = idx.date),
daily AS (SELECT * REPLACE ({fills(SCORES)}) FROM joined)"""

MONTHLY = f""", month_end AS (
    SELECT CAST(date_trunc('month', date) AS DATE) AS date,
           {', '.join(f'MAX({t}) AS {t}' for t in TOTALS)}, {', '.join(f'AVG({s}) AS {s}' for s in SCORES)}
    FROM daily GROUP BY 1),
monthly AS (SELECT date, {', '.join(TOTALS)}, {diffs(TOTALS)}, {', '.join(SCORES)} FROM month_end)"""

MEASURES = [*TOTALS, *(f"{t}_{s}" for t in TOTALS for s in ("inc", "inc_pct")), *SCORES]


def shown(column: str, digits: int = 7) -> str:
    return f"ROUND({column}, {digits}) AS {column}" if column in SCORES else column


SERIES_CASES = f""", labour AS (
    SELECT s.date, s.series_id, s.value, {', '.join(f'm.{c}' for c in MEASURES)}
    FROM series s LEFT JOIN monthly m ON s.date = m.date)"""


def _entity_daily(view: str, entity: str) -> str:
    return with_views(
        view, f"SELECT {dateid('date')}, {entity}, {iso('date')}, confirmed, deaths, {diffs(COUNTS, entity)} FROM {view}"
    )


def _entity_monthly(view: str, entity: str) -> str:
    return with_views(
        view,
        f""", m AS (SELECT {entity}, CAST(date_trunc('month', date) AS DATE) AS date, MAX(confirmed) AS confirmed,
                    MAX(deaths) AS deaths FROM {view} GROUP BY 1, 2)
        SELECT {entity}, {iso('date')}, {month_keys()}, confirmed, deaths, {diffs(COUNTS, entity)} FROM m""",
    )


_FULL_STATE_DAILY = _entity_daily("state_day", "state")
_STATE_MONTHLY = _entity_monthly("state_cum", "state")
_UNPIVOT = with_views(
    "idx",
    " UNION ALL ".join(f"SELECT {iso('date')}, '{s}' AS series, {s} AS score FROM idx" for s in SCORES),
)
_FFILL = with_views("idx", f"SELECT {iso('date')}, {fills(SCORES)} FROM idx")
_TOTALS = with_views("both_day", TOTALS_DAILY)

def _month_grid(place: str) -> str:
    """Month-end counts of every place in every month, 20 years later: what the landed wide files hold."""
    return f""", {place}_m AS (SELECT {place}, CAST(date_trunc('month', date) + INTERVAL 20 YEAR AS DATE) AS date,
                    MAX(confirmed) AS confirmed, MAX(deaths) AS deaths FROM {place}_cum GROUP BY 1, 2),
        {place}_months AS (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 MONTH)) AS DATE) AS date
                           FROM {place}_m),
        {place}_grid AS (SELECT g.{place}, g.date, COALESCE(m.confirmed, 0) AS confirmed, COALESCE(m.deaths, 0) AS deaths
                 FROM (SELECT DISTINCT {place}, {place}_months.date FROM {place}_m CROSS JOIN {place}_months) g
                 LEFT JOIN {place}_m m ON m.{place} = g.{place} AND m.date = g.date
                 WHERE g.date <= DATE '2020-10-31')"""


def _grid_totals(place: str, prefix: str) -> str:
    sums = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {prefix}_{c}" for c in COUNTS)
    return f"{prefix}_month AS (SELECT date, {sums} FROM {place}_grid GROUP BY date)"


SQL: dict[str, str] = {
    "q2_topk_state": with_views(
        "state_cum",
        """SELECT state, confirmed, deaths FROM state_cum
        WHERE date = LEAST(DATE '2000-06-30', (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders))
        ORDER BY confirmed DESC, state LIMIT 10""",
    ),
    "q3_topk_country": with_views(
        "country_cum",
        """SELECT country, confirmed, deaths FROM country_cum
        WHERE date = LEAST(DATE '2030-01-01', (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders))
        ORDER BY confirmed DESC, country LIMIT 3""",
    ),
    "state_daily_fact": _FULL_STATE_DAILY,
    "state_totals_sql": with_views(
        "v1",
        """SELECT state, CAST(year(date) AS INTEGER) AS year, CAST(SUM(confirmed) AS BIGINT) AS confirmed,
        CAST(SUM(deaths) AS BIGINT) AS deaths FROM v1 GROUP BY ALL""",
    ),
    "country_daily_fact": _entity_daily("country_cum", "country"),
    "state_monthly_fact": _STATE_MONTHLY,
    "country_monthly_fact": _entity_monthly("country_cum", "country"),
    "totals_daily": _TOTALS,
    "totals_daily_bucketed": _TOTALS,
    "totals_monthly": with_views(
        "both_day",
        f""", m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date,
                    {', '.join(f'MAX({t}) AS {t}' for t in TOTALS)} FROM both_day GROUP BY 1)
        SELECT {iso('date')}, {month_keys()}, {', '.join(TOTALS)}, {diffs(TOTALS)} FROM m""",
    ),
    "totals_join": f"""
        WITH u AS (SELECT CAST(o_orderdate AS DATE) AS date,
                          CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS us_confirmed,
                          COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS us_deaths FROM orders GROUP BY 1),
        g AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(SUM(l_quantity) AS BIGINT) AS global_confirmed,
                     COUNT(*) FILTER (WHERE l_returnflag = 'R') AS global_deaths FROM lineitem GROUP BY 1),
        both_day AS (SELECT u.*, global_confirmed, global_deaths FROM u JOIN g ON u.date = g.date)
        {TOTALS_DAILY}""",
    "counts_join": f"""
        WITH c AS (SELECT c_nationkey AS uid, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS confirmed
                   FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
        d AS (SELECT s_nationkey AS uid, CAST(l_shipdate AS DATE) AS date, CAST(SUM(l_quantity) AS BIGINT) AS deaths
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
        SELECT d.uid, {iso('d.date')}, confirmed, deaths FROM d JOIN c ON d.uid = c.uid AND d.date = c.date""",
    "index_daily_ffill": _FFILL,
    "index_daily_ffill_bucketed": _FFILL,
    "index_daily_ffill0": with_views(
        "idx", f"SELECT {dateid('date')}, {iso('date')}, {fills(SCORES, initial='0')} FROM idx"
    ),
    "index_monthly_avg": with_views(
        "idx",
        f""", m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date,
                    {', '.join(f'ROUND(AVG({s}), 7) AS {s}' for s in SCORES)} FROM idx GROUP BY 1)
        SELECT {iso('date')}, {month_keys()}, {', '.join(SCORES)} FROM m""",
    ),
    "price_merge": with_views(
        "price",
        f"""SELECT replace(stock_ticker, '#', '') AS stock_ticker, {iso('date')}, High, Low, Open, Close, Volume, adj_close
        FROM price WHERE date BETWEEN DATE '1998-01-15' AND DATE '1998-03-10'""",
    ),
    "late_ticker_equals_full": with_views(
        "price",
        f""", m AS (SELECT replace(stock_ticker, '#', '') AS stock_ticker, CAST(date_trunc('month', date) AS DATE) AS date,
                    {', '.join(f'ROUND(AVG({c}), 7) AS {c}' for c in ('High', 'Low', 'Open', 'Close', 'adj_close'))},
                    SUM(Volume) AS Volume FROM price
                    WHERE date BETWEEN DATE '1998-01-15' AND DATE '1998-03-10' GROUP BY 1, 2)
        SELECT stock_ticker, {iso('date')}, High, Low, Open, Close, Volume, adj_close FROM m""",
    ),
    "price_quarantine": with_views(
        "price",
        """, lines AS (SELECT replace(stock_ticker, '#', '') AS stock_ticker, date,
                    day(date) IN (7, 9) AND CAST(substr(replace(stock_ticker, '#', ''), 6) AS INTEGER) % 3 <> 0 AS broken
                    FROM price)
        SELECT stock_ticker,
            count(*) FILTER (NOT broken AND date BETWEEN DATE '1998-01-15' AND DATE '1998-02-10') AS n_stored,
            count(*) FILTER (broken) AS n_broken, min(strftime(date, '%Y-%m-%d')) FILTER (broken) AS first,
            max(strftime(date, '%Y-%m-%d')) FILTER (broken) AS last
        FROM lines GROUP BY stock_ticker
        HAVING n_stored > 0""",
    ),
    "price_fact": with_views(
        "price", f"SELECT {dateid('date')}, stock_ticker, {iso('date')}, High, Low, Open, Close, Volume, adj_close FROM price"
    ),
    "price_monthly": with_views(
        "price",
        f""", m AS (SELECT stock_ticker, CAST(date_trunc('month', date) AS DATE) AS date,
                    {', '.join(f'ROUND(AVG({c}), 7) AS {c}' for c in ('High', 'Low', 'Open', 'Close', 'adj_close'))},
                    SUM(Volume) AS Volume FROM price GROUP BY 1, 2)
        SELECT stock_ticker, {iso('date')}, {month_keys()}, High, Low, Open, Close, Volume, adj_close FROM m""",
    ),
    "cases_index_daily": with_views(
        "both_day idx",
        CASES_INDEX + f" SELECT {dateid('date')}, * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM daily "
        "WHERE date > DATE '1996-01-01'",
    ),
    "cases_index_monthly": with_views(
        "both_day idx",
        CASES_INDEX + MONTHLY + f" SELECT {iso('date')}, {month_keys()}, {', '.join(map(shown, MEASURES))} FROM monthly",
    ),
    "cases_index_series_monthly": with_views(
        "both_day idx series",
        CASES_INDEX
        + MONTHLY
        + SERIES_CASES
        + f""" SELECT {iso('date')}, {month_keys()}, series_id AS bol_series_id,
              COALESCE(value, 0) AS bol_series_value, value AS bol_series_value_raw,
              {', '.join(f'ROUND(COALESCE({c}, 0), 7) AS {c}' if shown(c) != c else f'COALESCE({c}, 0) AS {c}'
                         for c in MEASURES)} FROM labour""",
    ),
    "unpivot_index": _UNPIVOT,
    "explode_struct_index": _UNPIVOT,
    "unpivot_series": with_views(
        "series",
        f""", ids AS (SELECT DISTINCT series_id FROM series), days AS (SELECT DISTINCT date FROM series)
        SELECT {iso('days.date')}, {dateid('days.date')}, ids.series_id, value FROM days CROSS JOIN ids
        LEFT JOIN series s ON s.date = days.date AND s.series_id = ids.series_id""",
    ),
    "wide_date_slice": with_views(
        "state_cum",
        """, m AS (SELECT state, date_trunc('month', date) + INTERVAL 20 YEAR AS date, MAX(confirmed) AS confirmed
                   FROM state_cum GROUP BY 1, 2)
        SELECT state, strftime(m.date, '%Y-%m-%d') AS date, confirmed FROM m
        WHERE m.date > DATE '2016-02-10' AND m.date <= DATE '2020-10-31'""",
    ),
    "wide_counts_join": with_views(
        "country_cum",
        """, m AS (SELECT country, date_trunc('month', date) + INTERVAL 20 YEAR AS date,
                   MAX(confirmed) AS confirmed, MAX(deaths) AS deaths FROM country_cum GROUP BY 1, 2)
        SELECT country, strftime(m.date, '%Y-%m-%d') AS date, confirmed, deaths FROM m""",
    ),
    "series_dedup": f"""
        SELECT {dateid('date')}, concat(l_returnflag, '-', l_linestatus) AS series_id, {iso('date')},
               MIN(l_quantity) AS value
        FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem)
        GROUP BY l_returnflag, l_linestatus, date""",
    "series_arrays": with_views(
        "series",
        """SELECT series_id AS bol_series_id,
               CAST(to_json(list(strftime(date, '%Y-%m-%d') ORDER BY date)) AS VARCHAR) AS dates,
               CAST(to_json(list(CAST(value AS BIGINT) ORDER BY date)) AS VARCHAR) AS numbers
        FROM series WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND value <> 0
          AND series_id IN ('A-F', 'N-O', 'R-F') GROUP BY series_id""",
    ),
    "distinct_cases_range": with_views(
        "both_day idx series",
        CASES_INDEX
        + MONTHLY
        + SERIES_CASES
        + f""" SELECT DISTINCT {iso('date')}, COALESCE(us_confirmed, 0) AS us_confirmed,
               COALESCE(us_deaths, 0) AS us_deaths, COALESCE(us_confirmed_inc, 0) AS us_confirmed_inc,
               COALESCE(us_deaths_inc, 0) AS us_deaths_inc
        FROM labour WHERE labour.date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    ),
    "daily_range": with_views(
        "both_day idx",
        CASES_INDEX
        + f""" SELECT {iso('date')}, us_confirmed, us_deaths, us_confirmed_inc, us_deaths_inc, global_confirmed,
               global_deaths, global_confirmed_inc, global_deaths_inc, sp500_score, nasdaq100_score, dowjones_score
        FROM daily WHERE daily.date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    ),
    "daily_range_arrays": with_views(
        "both_day idx",
        CASES_INDEX
        + """ SELECT CAST(to_json(list(strftime(date, '%Y-%m-%d') ORDER BY date)) AS VARCHAR) AS dates,
               CAST(to_json(list(us_confirmed ORDER BY date)) AS VARCHAR) AS us_confirmed,
               CAST(to_json(list(us_deaths_inc ORDER BY date)) AS VARCHAR) AS us_deaths_inc,
               CAST(to_json(list(global_confirmed_inc ORDER BY date)) AS VARCHAR) AS global_confirmed_inc
        FROM daily WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    ),
    "drilldown_day": with_views(
        "state_cum",
        f"SELECT state, country, {iso('date')}, confirmed, deaths FROM state_cum WHERE state_cum.date = DATE '1999-03-09'",
    ),
    "rows_json": with_views(
        "country_cum",
        f""", m AS (SELECT country, CAST(date_trunc('month', date) AS DATE) AS date, MAX(confirmed) AS confirmed,
                    MAX(deaths) AS deaths FROM country_cum GROUP BY 1, 2),
        d AS (SELECT country, strftime(date, '%Y-%m-%d') AS date, confirmed, {diffs(['deaths'], 'country')} FROM m)
        SELECT CAST(to_json(struct_pack(country := country, date := date, confirmed := confirmed,
               deaths_inc := deaths_inc)) AS VARCHAR) AS json FROM d""",
    ),
    "formatted_counts": with_views(
        "state_cum", f"SELECT state, {iso('date')}, format('{{:,}}', confirmed) AS confirmed FROM state_cum"
    ),
    "peak_month": with_views(
        "both_day idx series",
        CASES_INDEX
        + MONTHLY
        + """, peaks AS (SELECT series_id, date, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY value DESC, date) AS n
                         FROM series),
        top AS (SELECT date FROM monthly ORDER BY us_confirmed_inc DESC, date LIMIT 1)
        SELECT series_id, strftime(peaks.date, '%Y-%m-%d') AS series_peak, strftime(top.date, '%Y-%m-%d') AS cases_peak,
               peaks.date = top.date AS same_month FROM peaks CROSS JOIN top WHERE n = 1""",
    ),
    "series_dim_rank": with_views(
        "series",
        """, means AS (
            SELECT series_id, concat('flag ', series_id[1], ', status ', series_id[3]) AS subcat2,
                   AVG(value) AS mean_value
            FROM series WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND series_id[1] <> 'N'
            GROUP BY series_id)
        SELECT series_id, subcat2, ROUND(mean_value, 7) AS mean_value, side FROM (
            (SELECT *, 'highest' AS side FROM means ORDER BY mean_value DESC, series_id LIMIT 1) UNION ALL
            (SELECT *, 'lowest' AS side FROM means ORDER BY mean_value, series_id LIMIT 1))""",
    ),
    "pct_vs_base": with_views(
        "series",
        """, means AS (SELECT series_id, AVG(CASE WHEN date < DATE '1996-01-01' THEN value END) AS b,
                   AVG(CASE WHEN date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' THEN value END) AS p
                   FROM series GROUP BY series_id)
        SELECT series_id, ROUND(b, 7) AS base_mean, ROUND(p, 7) AS period_mean,
               ROUND((p - b) * CAST(100 AS DOUBLE) / NULLIF(b, 0), 5) AS change_pct FROM means""",
    ),
    "corr_by_series": with_views(
        "both_day idx series",
        CASES_INDEX
        + MONTHLY
        + f""" SELECT series_id, COUNT(value) AS n_months,
            {', '.join(f'ROUND(CORR(value, CAST({m} AS DOUBLE)), 6) AS corr_{m}'
                       for m in ('us_confirmed_inc', 'global_confirmed_inc', *SCORES))}
        FROM series JOIN monthly ON series.date = monthly.date GROUP BY series_id""",
    ),
    "country_enrich": """
        SELECT n_name AS "Country_Region", CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS confirmed,
               r_name AS "Continent"
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""",
    "null_filter": with_views(
        "idx",
        " UNION ALL ".join(
            f"SELECT '{s}' AS series, COUNT(*) AS n_rows, COUNT(*) - COUNT({s}) AS n_without, COUNT({s}) AS n_with FROM idx"
            for s in SCORES
        ),
    ),
    "days_without_level": with_views("idx", f"SELECT {iso('date')}, sp500_score FROM idx WHERE dowjones_score IS NULL"),
    "conditional_column": with_views(
        "idx",
        f"SELECT {iso('date')}, CASE WHEN dowjones_score IS NULL THEN -1.0::DOUBLE ELSE sp500_score END AS sp500_score FROM idx",
    ),
    "zero_fill": with_views(
        "idx",
        f"""SELECT {iso('date')}, COALESCE(dowjones_score, 0) AS dowjones_score, nasdaq100_score,
            COALESCE(sp500_score, 0) AS sp500_score FROM idx""",
    ),
    "latest_date": with_views("idx", "SELECT strftime(MAX(date), '%Y-%m-%d') AS date FROM idx"),
    "calendar_days": with_views(
        "idx",
        f""", span AS (SELECT MIN(date) AS a, MAX(date) AS b FROM idx),
        days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date, a FROM span)
        SELECT {iso('date')}, CAST(date_diff('day', a, days.date) AS INTEGER) AS day_no,
               date_trunc('month', days.date) = date_trunc('month', days.date + INTERVAL 7 DAY) AS week_in_month
        FROM days WHERE days.date NOT IN (SELECT date FROM idx)""",
    ),
    "date_keys": f"""
        WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
        SELECT {iso('day', 'date')}, strftime(day + INTERVAL 20 YEAR, '%-m/%-d/%y') AS label,
               strftime(day + INTERVAL 20 YEAR, '%Y-%m-%d') AS from_label, {dateid('day')},
               strftime(date_trunc('month', day), '%Y-%m-%d') AS month_start,
               CAST(year(day) * 10000 + month(day) * 100 + 1 AS BIGINT) AS month_dateid,
               strftime(day, '%B') AS month_name, strftime(date_trunc('month', day), '%Y-%m-%d') AS from_period,
               {iso('day', 'from_iso')}, CAST(date_diff('day', DATE '1995-01-01', day) AS INTEGER) AS day_no,
               strftime(day + INTERVAL 30 DAY, '%Y-%m-%d') AS in_30_days, TRUE AS same_day FROM d""",
    "parsed_values": """
        SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
               TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
               TRY_CAST(split_part(p_brand, '#', 2) || '.5' AS DOUBLE) AS brand_half,
               TRY_CAST(p_type AS INTEGER) AS no_number, p_name AS name FROM part""",
    "json_props": """
        SELECT event_type, CAST(props->>'k' AS INTEGER) AS k, COUNT(*) AS n FROM events GROUP BY 1, 2""",
    "json_nested_flatten": """
        WITH lines AS (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
                              generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)
        SELECT CAST(doc_id AS VARCHAR) AS series_id, CAST(2000 + i % 20 AS INTEGER) AS year,
               'M' || lpad(CAST(i % 13 + 1 AS VARCHAR), 2, '0') AS period, CAST(length(line) AS DOUBLE) AS value,
               concat_ws(',', source, lang) AS footnotes
        FROM lines WHERE i % 13 + 1 <= 12""",
    "html_rows": r"""
        WITH items AS (SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\s[^>]*)?>(.*?)</li>', 1) AS all_items FROM pages),
        one AS (SELECT page_id, unnest(all_items) AS item,
                       CAST(generate_subscripts(all_items, 1) - 1 AS INTEGER) AS pos FROM items)
        SELECT page_id, pos, split_part(split_part(substr(item, position('<a ' IN item)), 'href="', 2), '"', 1) AS href,
               rtrim(replace(replace(replace(replace(replace(replace(regexp_replace(item, '<[^>]*>', '', 'g'),
                   '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
                   chr(13) || chr(10)) AS label
        FROM one WHERE item LIKE '%<a %href="%'""",
    "html_tickers": """
        SELECT p_brand || '-' || p_partkey AS ticker, p_name AS name, p_type AS industry, 'a & b' AS subindustry,
               p_name AS hq_location, CAST(p_partkey AS VARCHAR) AS cik, CAST(p_size + 1900 AS INTEGER) AS founded_year
        FROM part
        UNION ALL
        SELECT 'X' || p_brand || '-' || p_partkey, p_name, p_type, 'a & b', p_name, CAST(p_partkey AS VARCHAR), NULL
        FROM part""",
    "incremental_equals_full": _FULL_STATE_DAILY,
    "month_upsert": _STATE_MONTHLY,
    "high_water_marks": """
        SELECT 'orders' AS table_name, '2002-02-02' AS latest UNION ALL SELECT 'country_dim', '2002-03-03'
        UNION ALL SELECT 'lineitem', strftime(MAX(l_shipdate), '%Y-%m-%d') FROM lineitem
        UNION ALL SELECT 'events', strftime(MAX(ts), '%Y-%m-%d') FROM events""",
    "stream_equals_batch": """
        SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, COUNT(*) AS n,
               CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2""",
    "stream_many_files": """
        SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, COUNT(*) AS n,
               CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2""",
    "county_files_loaded": with_views(
        "state_cum",
        f""", m AS (SELECT state, CAST(date_trunc('month', date) + INTERVAL 20 YEAR AS DATE) AS date,
                    MAX(confirmed) AS confirmed, MAX(deaths) AS deaths FROM state_cum GROUP BY 1, 2),
        span AS (SELECT MIN(date) AS a, MAX(date) AS b FROM m),
        months AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS date FROM span),
        grid AS (SELECT g.state, g.date, COALESCE(m.confirmed, 0) AS confirmed, COALESCE(m.deaths, 0) AS deaths
                 FROM (SELECT DISTINCT state, months.date FROM m CROSS JOIN months) g
                 LEFT JOIN m ON m.state = g.state AND m.date = g.date)
        SELECT {dateid('date')}, state AS "Province_State", {iso('date')}, confirmed, deaths, {diffs(COUNTS, 'state')}
        FROM grid WHERE grid.date <= DATE '2020-10-31'""",
    ),
    "global_files_loaded": with_views(
        "country_cum",
        _month_grid("country")
        + f""" SELECT country AS "Country_Region", {iso('date')}, {month_keys()}, confirmed, deaths, {diffs(COUNTS, 'country')}
        FROM country_grid""",
    ),
    "whole_run_resumed": with_views(
        "state_cum country_cum idx",
        _month_grid("state")
        + _month_grid("country")
        + f""", {_grid_totals('state', 'us')}, {_grid_totals('country', 'global')},
        days AS (SELECT *, {diffs(TOTALS)} FROM us_month JOIN global_month USING (date)),
        levels AS (SELECT CAST(date + INTERVAL 20 YEAR AS DATE) AS date, {fills(SCORES, initial='0')} FROM idx),
        joined AS (SELECT days.*, {', '.join(SCORES)} FROM days LEFT JOIN levels ON days.date = levels.date)
        SELECT {dateid('date')}, * REPLACE (strftime(date, '%Y-%m-%d') AS date, {fills(SCORES)}) FROM joined""",
    ),
    "country_file_loaded": """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, n_name AS "Name", r_name AS "Continent",
               n_nationkey * CAST(1.5 AS DOUBLE) AS "SurfaceArea", n_nationkey + 1900 AS "IndepYear",
               n_nationkey * 1000 AS "Population", n_nationkey AS "Capital"
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "series_file_loaded": with_views(
        "series",
        f""", ids AS (SELECT DISTINCT series_id FROM series WHERE series_id <> 'A-F'),
        days AS (SELECT DISTINCT date FROM series)
        SELECT {iso('days.date')}, {dateid('days.date')}, ids.series_id, value FROM days CROSS JOIN ids
        LEFT JOIN series s ON s.date = days.date AND s.series_id = ids.series_id""",
    ),
    "series_answers_loaded": f"""
        SELECT {dateid('date')}, concat(l_returnflag, '-', l_linestatus) AS series_id, {iso('date')},
               MIN(l_quantity) AS value
        FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem)
        GROUP BY l_returnflag, l_linestatus, date""",
    "text_list_round_trip": "SELECT DISTINCT p_brand AS ticker FROM part",
    "late_index_equals_full": with_views(
        "both_day idx",
        f""", levels AS (SELECT date, {fills(SCORES, initial='0')} FROM idx),
        days AS (SELECT date, {', '.join(TOTALS)}, {diffs(TOTALS)} FROM both_day),
        joined AS (SELECT days.*, {', '.join(SCORES)} FROM days LEFT JOIN levels ON days.date = levels.date)
        SELECT {dateid('date')}, * REPLACE (strftime(date, '%Y-%m-%d') AS date, {fills(SCORES)}) FROM joined
        WHERE joined.date <= DATE '2000-12-31'""",
    ),
    "late_series_equals_full": with_views(
        "both_day idx series",
        f""", levels AS (SELECT date, {fills(SCORES, initial='0')} FROM idx),
        days AS (SELECT date, {', '.join(TOTALS)}, {diffs(TOTALS)} FROM both_day WHERE date <= DATE '2000-12-31'),
        joined AS (SELECT days.*, {', '.join(SCORES)} FROM days LEFT JOIN levels ON days.date = levels.date),
        daily AS (SELECT * REPLACE ({fills(SCORES)}) FROM joined)"""
        + MONTHLY
        + SERIES_CASES
        + f""" SELECT {iso('date')}, series_id AS bol_series_id, COALESCE(value, 0) AS bol_series_value,
            COALESCE(us_confirmed, 0) AS us_confirmed, COALESCE(global_deaths_inc, 0) AS global_deaths_inc,
            ROUND(COALESCE(sp500_score, 0), 7) AS sp500_score
        FROM labour WHERE labour.date <= DATE '2000-12-31'""",
    ),
    "warehouse_marks": """
        SELECT 'covid19_us_raw' AS table_name, strftime(MAX(o_orderdate), '%Y-%m-%d') AS latest FROM orders
        UNION ALL SELECT 'covid19_us_fact', strftime(MAX(l_shipdate), '%Y-%m-%d') FROM lineitem
        UNION ALL SELECT 'covid19_us_dim', '1990-01-01' UNION ALL SELECT 'covid19_us_monthly_fact', '1990-01-01'""",
    "user_event_diff": """
        WITH w AS (SELECT event_id, user_id, value,
                          COALESCE(LAG(value) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS prev,
                          LAST_VALUE(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (
                              PARTITION BY user_id ORDER BY event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error FROM events)
        SELECT event_id, user_id, value, last_error, ROUND(value - prev, 5) AS value_inc,
               ROUND(COALESCE((value - prev) * CAST(100 AS DOUBLE) / NULLIF(prev, 0), 0), 5) AS value_inc_pct FROM w""",
    "pk_violations": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "fk_orphans": """
        SELECT user_id, COUNT(*) AS n_rows FROM events
        WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "missing_entities": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "column_report": with_views(
        "idx",
        f"""SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(date) AS null_date,
            {', '.join(f'COUNT(*) - COUNT({s}) AS null_{s}' for s in SCORES)},
            COUNT(*) FILTER (WHERE length(strftime(date, '%B')) > 6) AS long_month_name FROM idx""",
    ),
}
