"""The same results in plain SQL, worked out apart from the Spark code.

Money is counted in whole cents, rounding is done on integers (half away from
zero), and only the last step turns a figure into a double.
"""

from __future__ import annotations


def _half_up(num: str, den: str) -> str:
    """Integer division of ``num`` by a positive ``den``, half away from zero."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def _money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100.0"


def _cents(value: str) -> str:
    return f"CAST(round({value} * 100) AS BIGINT)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# -- feeds out of the events table ---------------------------------------

PRICE = f"""price AS (
  SELECT date_trunc('hour', ts) AS h, max({_cents('value')}) AS pool, min({_cents('value')}) AS fore
  FROM events WHERE event_type = 'purchase' GROUP BY 1)"""
LOAD = """load AS (
  SELECT date_trunc('hour', ts) AS h, count(*) AS ail, count(DISTINCT user_id) AS fail
  FROM events WHERE event_type = 'view' GROUP BY 1)"""
GRID = "grid AS (SELECT h, pool, fore, pool - fore AS roll, ail, fail FROM price FULL OUTER JOIN load USING (h))"

GRID_COLUMNS = f"""
  {_money('pool')} AS pool_price, {_money('fore')} AS forecast_pool_price, {_money('roll')} AS rolling_30day_avg,
  ail AS alberta_internal_load, fail AS forecast_alberta_internal_load"""

# -- daily figures -------------------------------------------------------

BASE_TIME = "TIMESTAMP '2024-02-01 02:00:00'"
BATCH_TIME = "TIMESTAMP '2024-02-02 02:00:00'"


def _daily(source: str, ts: str, cents: str, load: str, series: str = "", computed_at: str = BASE_TIME) -> str:
    lead = f"{series} AS market, " if series else ""
    group = "1, 2" if series else "1"
    return f"""
  SELECT {lead}CAST({ts} AS DATE) AS grid_date,
    {_half_up(f'sum({cents})', f'count({cents})')} AS avg_c,
    min({cents}) AS mn, max({cents}) AS mx,
    round(coalesce(stddev_samp({cents} / 100.0), 0), 2) AS sd,
    {_half_up(f'(100 * sum({load}))', f'count({load})')} AS load_c,
    count(*) AS hours, {computed_at} AS computed_at
  FROM {source} GROUP BY {group}"""


def _daily_out(source: str, market: bool = False) -> str:
    return f"""SELECT {'market, ' if market else ''}grid_date, {_money('avg_c')} AS avg_price,
  {_money('mn')} AS min_price, {_money('mx')} AS max_price, sd AS stddev_price,
  {_money('load_c')} AS avg_load, hours AS hours_reported, computed_at FROM {source}"""


EVENTS_DAILY = f"daily AS ({_daily('grid', 'h', 'pool', 'ail')})"
ORDERS_DAILY = f"daily AS ({_daily('orders', 'o_orderdate', _cents('o_totalprice'), 'o_custkey')})"
ORDERS_DAILY_MARKET = (
    f"daily AS ({_daily('orders', 'o_orderdate', _cents('o_totalprice'), 'o_custkey', 'o_orderpriority')})"
)
LINES_DAILY_MARKET = (
    f"daily AS ({_daily('lineitem', 'l_shipdate', _cents('l_extendedprice'), 'CAST(l_quantity AS BIGINT)', 'l_returnflag')})"
)
FROM_EVENTS = (PRICE, LOAD, GRID, EVENTS_DAILY)

# -- loss on discharge ---------------------------------------------------

DISCHARGE = """SELECT grid_date, mx / 100.0 AS max_price, mn / 100.0 AS min_price,
  CAST(10 * mn AS DOUBLE) / 100.0 AS charge_cost, CAST(9 * mx AS DOUBLE) / 100.0 AS discharge_revenue,
  CAST(9 * mx - 10 * mn AS DOUBLE) / 100.0 AS net_daily_profit FROM daily"""
PROFIT = "profit AS (SELECT *, 9 * mx - 10 * mn AS p FROM daily)"


def _running(market: bool) -> str:
    lead, part = ("market, ", "PARTITION BY market ") if market else ("", "")
    return f"""SELECT {lead}grid_date, {_money('p')} AS net_daily_profit,
  {_money(f'sum(p) OVER ({part}ORDER BY grid_date)')} AS total_profit_acc FROM profit"""


def _last10(market: bool) -> str:
    lead, part = ("market, ", "PARTITION BY market ") if market else ("", "")
    return f"""SELECT {lead}grid_date, {_money('p')} AS net_daily_profit,
  {_money(f'sum(p) OVER ({part})')} AS total_10_day_profit,
  {_money(f'sum(p) OVER ({part}ORDER BY grid_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)')} AS rolling_10d_sum
FROM (SELECT *, row_number() OVER ({part}ORDER BY grid_date DESC) AS rn FROM profit) WHERE rn <= 10"""


# -- loss on charge ------------------------------------------------------

EVENTS_RANGE = """ranges AS (
  SELECT CAST(h - INTERVAL 7 HOUR AS DATE) AS d, min(pool) AS mn, max(pool) AS mx FROM price GROUP BY 1)"""
ORDERS_RANGE = f"""ranges AS (
  SELECT CAST(o_orderdate AS DATE) AS d, min({_cents('o_totalprice')}) AS mn, max({_cents('o_totalprice')}) AS mx
  FROM orders GROUP BY 1)"""


def _market_range(source: str, market: str, ts: str, value: str) -> str:
    return f"""ranges AS (
  SELECT {market} AS market, CAST({ts} AS DATE) AS d, min({_cents(value)}) AS mn, max({_cents(value)}) AS mx
  FROM {source} GROUP BY 1, 2)"""


# Capacity in thousandths of a MWh, efficiency in hundred-thousandths.
COST = _half_up("(mn * cap * 100)", "rte")
REVENUE = _half_up("(mx * cap)", "1000")
NET = _half_up("(cap * (mx * rte - 100000 * mn))", "(1000 * rte)")


def _charge(specs: str) -> str:
    return f"""cash AS (SELECT ranges.*, cap, rte, {COST} AS cost, {REVENUE} AS rev, {NET} AS net
  FROM ranges CROSS JOIN (VALUES {specs}) AS spec(cap, rte))"""


ONE_BATTERY = _charge("(10000, 90000)")
SWEEP = _charge("(10000, 90000), (5000, 85000), (25000, 92500), (100000, 100000), (10125, 92555)")

CHARGE = f"""SELECT d AS trade_date_mpt, mn / 100.0 AS min_charge_price, mx / 100.0 AS max_discharge_price,
  cap / 1000.0 AS battery_capacity_mwh, rte / 100000.0 AS round_trip_efficiency,
  {_money('cost')} AS daily_charge_cost_cad, {_money('rev')} AS daily_discharge_revenue_cad,
  {_money('net')} AS daily_net_profit_cad FROM cash"""


def _rolled(market: bool) -> str:
    part = "PARTITION BY market " if market else ""
    frame = f"({part}ORDER BY d ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
    return f"rolled AS (SELECT *, sum(net) OVER {frame} AS s, count(*) OVER {frame} AS n FROM cash)"


def _rolling_out(market: bool, low: str, high: str) -> str:
    return f"""SELECT {'market, ' if market else ''}d AS trade_date_mpt, mn / 100.0 AS {low}, mx / 100.0 AS {high},
  {_money('cost')} AS daily_charge_cost_cad, {_money('rev')} AS daily_discharge_revenue_cad,
  {_money('net')} AS daily_net_profit_cad, {_money('s')} AS rolling_10d_cumulative_profit_cad,
  {_money(_half_up('s', 'n'))} AS rolling_10d_avg_daily_profit_cad FROM rolled"""


ROLLING = _rolling_out(False, "min_charge_price", "max_discharge_price")
LATEST = _rolling_out(False, "charge_price_per_mwh", "discharge_price_per_mwh") + " ORDER BY d DESC LIMIT 30"
LATEST_MARKET = (
    _rolling_out(True, "charge_price_per_mwh", "discharge_price_per_mwh")
    + " QUALIFY row_number() OVER (PARTITION BY market ORDER BY d DESC) <= 30"
)

# -- forecast errors -----------------------------------------------------

ERRORS = f"""errors AS (SELECT h, h - INTERVAL 7 HOUR AS mpt, pool, fore, ail, fail FROM price JOIN load USING (h))"""
TIED_ERRORS = """errors AS (
  SELECT h, h - INTERVAL 7 HOUR - to_hours(CAST(hour(h - INTERVAL 7 HOUR) % 2 AS BIGINT)) AS mpt, pool, fore, ail, fail
  FROM price JOIN load USING (h))"""
ERROR_COLUMNS = f"""mpt AS begin_datetime_mpt, {_money('pool')} AS pool_price, {_money('fore')} AS forecast_pool_price,
  {{ail}} AS alberta_internal_load, {{fail}} AS forecast_alberta_internal_load,
  {_money('pool - fore')} AS price_forecast_error, ail - fail AS load_forecast_error""".format(ail="ail", fail="fail")

# -- clock changes -------------------------------------------------------

# Sundays of the rule in force: until 2006 the first in April and the last in
# October, from 2007 on the second in March and the first in November.
CLOCK_CHANGES = """lengths AS (
  SELECT *, CAST(CASE
    WHEN dayofweek(grid_date) <> 0 THEN 24
    WHEN year(grid_date) < 2007 AND month(grid_date) = 4 AND day(grid_date) <= 7 THEN 23
    WHEN year(grid_date) < 2007 AND month(grid_date) = 10 AND day(grid_date) >= 25 THEN 25
    WHEN year(grid_date) >= 2007 AND month(grid_date) = 3 AND day(grid_date) BETWEEN 8 AND 14 THEN 23
    WHEN year(grid_date) >= 2007 AND month(grid_date) = 11 AND day(grid_date) <= 7 THEN 25
    ELSE 24 END AS BIGINT) AS n FROM daily)"""

# -- incremental maintenance ---------------------------------------------

BASE = "base AS (SELECT * FROM grid WHERE h < TIMESTAMP '2024-01-21')"
BATCH = """batch AS (
  SELECT h, CASE WHEN hour(h) % 5 <> 0 THEN pool + 100 END AS pool, fore, roll, ail, fail
  FROM grid WHERE h >= TIMESTAMP '2024-01-15')"""


def _newest(c: str) -> str:
    return f"CASE WHEN b.h IS NOT NULL THEN b.{c} ELSE a.{c} END AS {c}"


MERGED = f"""merged AS (
  SELECT coalesce(a.h, b.h) AS h, {', '.join(_newest(c) for c in ('pool', 'fore', 'roll', 'ail', 'fail'))},
    a.h IS NULL AS is_new, b.h IS NOT NULL AS in_batch
  FROM base a FULL OUTER JOIN batch b ON a.h = b.h)"""
TWO_LOADS = (PRICE, LOAD, GRID, BASE, BATCH, MERGED)

UPSERTED_HOURLY = (
    _with(*TWO_LOADS)
    + f"""SELECT h AS begin_datetime_mpt, {GRID_COLUMNS},
  CASE WHEN is_new THEN {BATCH_TIME} ELSE {BASE_TIME} END AS ingested_at,
  CASE WHEN is_new THEN 'run-correction' ELSE 'run-base' END AS source_run_id,
  CASE WHEN is_new THEN 'run-correction' ELSE 'run-base' END AS created_run_id,
  CASE WHEN in_batch THEN 'run-correction' ELSE 'run-base' END AS updated_run_id
FROM merged"""
)
REFRESHED_DAILY = _with(
    *TWO_LOADS,
    f"""daily AS ({_daily('merged', 'h', 'pool', 'ail',
        computed_at=f"CASE WHEN bool_or(in_batch) THEN {BATCH_TIME} ELSE {BASE_TIME} END")})""",
) + _daily_out("daily")


def _silver(feed: str, changed: str, columns: str) -> str:
    return (
        _with(
            feed,
            f"base AS (SELECT * FROM {changed} WHERE h < TIMESTAMP '2024-01-21')",
            f"batch AS (SELECT * FROM {changed} WHERE h >= TIMESTAMP '2024-01-15')",
            "hours AS (SELECT coalesce(a.h, b.h) AS h, b.h IS NOT NULL AS later, a.h IS NULL AS is_new "
            "FROM base a FULL OUTER JOIN batch b ON a.h = b.h)",
        )
        + f"""SELECT h AS begin_datetime_utc, h - INTERVAL 7 HOUR AS begin_datetime_mpt, {columns},
  CASE WHEN is_new THEN {BATCH_TIME} ELSE {BASE_TIME} END AS created_at,
  CASE WHEN later THEN {BATCH_TIME} ELSE {BASE_TIME} END AS updated_at
FROM hours JOIN {changed} USING (h)"""
    )


def _corrected(value: str, one: str) -> str:
    return f"CASE WHEN later THEN CASE WHEN hour(h) % 5 <> 0 THEN {value} + {one} END ELSE {value} END"


def _lines(per: str, start: str, name: str, more: str = "") -> str:
    return f"""SELECT l_shipdate, l_orderkey, l_linenumber, l_returnflag AS market, l_extendedprice AS price, {more}
  sum(CAST(round(l_extendedprice * 100) AS BIGINT)) OVER w / 100.0 AS {name}
FROM lineitem WINDOW w AS ({per} ORDER BY l_shipdate, l_orderkey, l_linenumber, l_returnflag, l_extendedprice ROWS BETWEEN {start} AND CURRENT ROW)"""


ORACLES: dict[str, str] = {
    "hourly_grid_full_outer": _with(PRICE, LOAD, GRID) + f"SELECT h AS begin_datetime_mpt, {GRID_COLUMNS} FROM grid",
    "hourly_grid_guarded": _with(PRICE, LOAD, GRID) + f"SELECT h AS begin_datetime_mpt, {GRID_COLUMNS} FROM grid",
    "hourly_grid_inner": _with(PRICE, LOAD, GRID)
    + f"SELECT h AS begin_datetime_mpt, {GRID_COLUMNS} FROM grid WHERE pool IS NOT NULL AND ail IS NOT NULL",
    "forecast_error": _with(PRICE, LOAD, ERRORS) + f"SELECT h AS begin_datetime_utc, {ERROR_COLUMNS} FROM errors",
    "latest_48_hours": _with(PRICE, LOAD, ERRORS)
    + f"SELECT {ERROR_COLUMNS} FROM errors ORDER BY mpt DESC LIMIT 48",
    "latest_48_tied_hours": _with(PRICE, LOAD, TIED_ERRORS)
    + f"SELECT {ERROR_COLUMNS} FROM errors ORDER BY mpt DESC, h DESC LIMIT 48",
    "demand_price_corr": _with(PRICE, LOAD, GRID)
    + "SELECT round(corr(pool / 100.0, ail), 6) AS demand_price_correlation FROM grid",
    "demand_price_corr_by_market": """SELECT l_returnflag AS market,
  round(corr(l_extendedprice, l_quantity), 6) AS demand_price_correlation FROM lineitem GROUP BY 1""",
    "daily_grid_agg": _with(*FROM_EVENTS) + _daily_out("daily"),
    "daily_grid_agg_orders": _with(ORDERS_DAILY) + _daily_out("daily"),
    "daily_grid_agg_by_market": _with(LINES_DAILY_MARKET) + _daily_out("daily", market=True),
    "daily_completeness": _with(*FROM_EVENTS)
    + """SELECT grid_date, hours AS hours_reported, CAST(24 AS BIGINT) AS expected_hours,
  24 - hours AS missing_hours, hours >= 24 AS is_complete FROM daily""",
    "daily_completeness_orders": _with(ORDERS_DAILY, CLOCK_CHANGES)
    + """SELECT grid_date, hours AS hours_reported, n AS expected_hours, n - hours AS missing_hours, hours >= n AS is_complete
FROM lengths""",
    "arb_loss_on_discharge": _with(*FROM_EVENTS) + DISCHARGE,
    "arb_loss_on_discharge_orders": _with(ORDERS_DAILY) + DISCHARGE,
    "arb_loss_on_charge": _with(PRICE, EVENTS_RANGE, ONE_BATTERY) + CHARGE,
    "arb_loss_on_charge_orders": _with(ORDERS_RANGE, ONE_BATTERY) + CHARGE,
    "arb_spec_sweep": _with(PRICE, EVENTS_RANGE, SWEEP) + CHARGE,
    "arb_spec_sweep_orders": _with(ORDERS_RANGE, SWEEP) + CHARGE,
    "running_profit": _with(*FROM_EVENTS, PROFIT) + _running(False),
    "running_profit_orders": _with(ORDERS_DAILY, PROFIT) + _running(False),
    "running_profit_by_market": _with(ORDERS_DAILY_MARKET, PROFIT) + _running(True),
    "last10_profit": _with(*FROM_EVENTS, PROFIT) + _last10(False),
    "last10_profit_orders": _with(ORDERS_DAILY, PROFIT) + _last10(False),
    "last10_profit_by_market": _with(ORDERS_DAILY_MARKET, PROFIT) + _last10(True),
    "rolling_10d": _with(PRICE, EVENTS_RANGE, ONE_BATTERY, _rolled(False)) + ROLLING,
    "rolling_10d_orders": _with(ORDERS_RANGE, ONE_BATTERY, _rolled(False)) + ROLLING,
    "rolling_10d_by_market": _with(
        _market_range("lineitem", "l_returnflag", "l_shipdate", "l_extendedprice"), ONE_BATTERY, _rolled(True)
    )
    + _rolling_out(True, "min_charge_price", "max_discharge_price"),
    "latest_30_days": _with(PRICE, EVENTS_RANGE, ONE_BATTERY, _rolled(False)) + LATEST,
    "latest_30_days_orders": _with(ORDERS_RANGE, ONE_BATTERY, _rolled(False)) + LATEST,
    "latest_30_days_by_market": _with(
        _market_range("orders", "o_orderpriority", "o_orderdate", "o_totalprice"), ONE_BATTERY, _rolled(True)
    )
    + LATEST_MARKET,
    "envelope_flatten": _with(PRICE)
    + """SELECT strftime(h, '%Y-%m-%d %H:%M') AS begin_datetime_utc,
  strftime(h - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M') AS begin_datetime_mpt,
  CAST(CAST(pool AS DECIMAL(12, 0)) / 100 AS DECIMAL(10, 2))::VARCHAR AS pool_price,
  CAST(CAST(fore AS DECIMAL(12, 0)) / 100 AS DECIMAL(10, 2))::VARCHAR AS forecast_pool_price,
  CAST(CAST(pool - fore AS DECIMAL(12, 0)) / 100 AS DECIMAL(10, 2))::VARCHAR AS rolling_30day_avg FROM price""",
    "envelope_shapes": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS begin_datetime_utc,
  CAST(NULL AS VARCHAR) AS begin_datetime_mpt, CAST(CAST(value AS DECIMAL(10, 2)) AS VARCHAR) AS pool_price
FROM events, LATERAL (SELECT unnest(range(CASE WHEN event_id % 10 IN (0, 1, 2, 4) THEN 1
  WHEN event_id % 10 = 7 THEN 2 ELSE 0 END)))""",
    "parse_timestamps": """SELECT event_id,
  CASE event_id % 9 WHEN 0 THEN date_trunc('minute', ts) WHEN 6 THEN TIMESTAMP '2026-03-08 02:30:00' END AS strict_ts,
  CASE event_id % 9 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('second', ts)
    WHEN 5 THEN date_trunc('day', ts)::TIMESTAMP WHEN 6 THEN TIMESTAMP '2026-03-08 02:30:00'
    WHEN 7 THEN date_trunc('minute', ts) + INTERVAL 7 HOUR END AS lenient_ts
FROM events""",
    "safe_cast": """SELECT event_id,
  CASE event_id % 10 WHEN 0 THEN value WHEN 4 THEN value WHEN 5 THEN 1000.0 WHEN 6 THEN event_id + 0.5
    WHEN 7 THEN -value WHEN 8 THEN 2147483648.0 END AS as_double,
  CAST(CASE event_id % 10 WHEN 0 THEN trunc(value) WHEN 4 THEN trunc(value) WHEN 6 THEN event_id
    WHEN 7 THEN -trunc(value) END AS BIGINT) AS as_int
FROM events""",
    "clean_and_dedup": """SELECT date_trunc('hour', ts) AS begin_datetime_utc,
  date_trunc('hour', ts) - INTERVAL 7 HOUR AS begin_datetime_mpt, value AS pool_price,
  CASE WHEN event_type <> 'click' THEN value END AS forecast_pool_price,
  CASE WHEN event_type <> 'view' THEN value END AS rolling_30day_avg
FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id DESC) = 1""",
    "duplicate_hours": """SELECT event_type, date_trunc('hour', ts) AS begin_datetime_mpt, count(*) AS n_rows
FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
    "numeric_coercion": f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  {_money(_half_up(f"({_cents('l_extendedprice')} * {_cents('l_discount')})", "100"))} AS discount_amount FROM lineitem""",
    "landing_date_scope": """SELECT CAST(ts AS DATE) AS landing_date, count(*) AS n_records FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' AND DATE '2024-01-30' GROUP BY 1""",
    "lookback_window": _with(PRICE)
    + f"""SELECT h AS begin_datetime_mpt, {_money('pool')} AS pool_price, {_money('fore')} AS forecast_pool_price,
  {_money('pool - fore')} AS rolling_30day_avg FROM price
WHERE CAST(h AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-30'""",
    "upsert_hourly": UPSERTED_HOURLY,
    "upsert_silver": _silver(
        PRICE,
        "price",
        f"{_money(_corrected('pool', '100'))} AS pool_price, {_money('fore')} AS forecast_pool_price, "
        f"{_money('pool - fore')} AS rolling_30day_avg",
    ),
    "upsert_silver_load": _silver(
        LOAD,
        "load",
        f"CAST({_corrected('ail', '1')} AS DOUBLE) AS alberta_internal_load, "
        "CAST(fail AS DOUBLE) AS forecast_alberta_internal_load",
    ),
    "batch_dates": _with(PRICE, LOAD, GRID, BATCH) + "SELECT DISTINCT CAST(h AS DATE) AS grid_date FROM batch",
    "incremental_daily_refresh": REFRESHED_DAILY,
    "load_verification": _with(*TWO_LOADS)
    + """SELECT count(*) FILTER (WHERE in_batch) AS loaded_count,
  (SELECT count(DISTINCT h) FROM batch) AS expected_count,
  count(*) FILTER (WHERE in_batch) = (SELECT count(DISTINCT h) FROM batch) AS verified FROM merged""",
    "constraint_report": """WITH batch AS (
  SELECT CASE WHEN event_type <> 'error' THEN event_type END AS m, date_trunc('hour', ts) AS h,
    CASE WHEN event_type <> 'signup' THEN user_id END AS u FROM events),
keyed AS (SELECT m, h, count(*) AS n FROM batch WHERE m IS NOT NULL GROUP BY 1, 2)
SELECT (SELECT count(*) FROM batch) AS n_rows, (SELECT count(*) FROM keyed) AS n_keys,
  (SELECT count(*) FROM batch WHERE m IS NULL) AS null_key_rows,
  (SELECT count(*) FROM keyed WHERE n > 1) AS repeated_keys,
  (SELECT count(*) FROM batch WHERE u IS NULL) AS null_required_rows""",
    "stored_hourly_grid": UPSERTED_HOURLY,
    "stored_daily_agg": REFRESHED_DAILY,
    "stateful_daily_refresh": REFRESHED_DAILY,
    "delta_hourly_grid": UPSERTED_HOURLY,
    "delta_daily_agg": REFRESHED_DAILY,
    "compacted_hourly_grid": UPSERTED_HOURLY,
    "live_hourly_grid": UPSERTED_HOURLY,
    "running_total_lines": _lines("", "UNBOUNDED PRECEDING", "running_price"),
    "running_total_lines_by_market": _lines("PARTITION BY l_returnflag", "UNBOUNDED PRECEDING", "running_price"),
    "rolling_10_lines": _lines("", "9 PRECEDING", "rolling_price", "count(*) OVER w AS rolling_rows,"),
    "rolling_10_lines_by_market": _lines("PARTITION BY l_returnflag", "9 PRECEDING", "rolling_price", "count(*) OVER w AS rolling_rows,"),
}
