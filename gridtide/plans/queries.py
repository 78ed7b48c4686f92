"""Every registered query, by name: (spark, folder of tables) to a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide import schemas
from gridtide.functions import casting
from gridtide.operators import arbitrage, clean, daily, daily_state, grid, ranges, refresh, upsert
from gridtide.plans import driver_tables as dtab
from gridtide.plans import views
from gridtide.session import shared_folder
from gridtide.sources import reports, tables

Query = Callable[[SparkSession, str], DataFrame]
MARKET = ["market"]
# The battery sizes and efficiencies the sweep compares.
BATTERIES = [("10", "0.90"), ("5", "0.85"), ("25", "0.925"), ("100", "1.00"), ("10.125", "0.92555")]

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    _REGISTRY[build.__name__] = lambda spark, sf_dir: dtab.stated(build(spark, sf_dir))
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- joins ---------------------------------------------------------------


@query
def hourly_grid_full_outer(spark, sf):
    return grid.join_feeds(dtab.price_feed(spark, sf), dtab.load_feed(spark, sf))


@query
def hourly_grid_guarded(spark, sf):
    return grid.merge_feeds(dtab.price_feed(spark, sf), dtab.load_feed(spark, sf))


@query
def hourly_grid_inner(spark, sf):
    return grid.merge_feeds(dtab.price_feed(spark, sf), dtab.load_feed(spark, sf), how="inner")


@query
def forecast_error(spark, sf):
    return grid.forecast_errors(dtab.silver_price(spark, sf), dtab.silver_load(spark, sf))


@query
def latest_48_hours(spark, sf):
    return views.latest_hours(dtab.silver_price(spark, sf), dtab.silver_load(spark, sf))


@query
def latest_48_tied_hours(spark, sf):
    """Two UTC hours share each local hour, as they do when clocks go back."""
    local = F.col(schemas.LOCAL_HOUR)
    tied = local - F.make_dt_interval(hours=F.hour(local) % 2)
    price = dtab.silver_price(spark, sf).withColumn(schemas.LOCAL_HOUR, tied)
    return views.latest_hours(price, dtab.silver_load(spark, sf))


@query
def demand_price_corr(spark, sf):
    corr = grid.demand_price_correlation(dtab.grid_feed(spark, sf))
    return corr.select(F.round("demand_price_correlation", 6).alias("demand_price_correlation"))


@query
def demand_price_corr_by_market(spark, sf):
    corr = grid.demand_price_correlation(dtab.shipment_prices(spark, sf), series=MARKET)
    return corr.select("market", F.round("demand_price_correlation", 6).alias("demand_price_correlation"))


# -- daily figures -------------------------------------------------------


def _daily(spark, sf) -> DataFrame:
    return daily.daily_aggregate(dtab.grid_feed(spark, sf), computed_at=dtab.BASE_TIME)


def _daily_cents(prices: DataFrame, series=()) -> DataFrame:
    """Daily figures of prices known to be in whole cents."""
    return daily.daily_aggregate(prices, series=series, computed_at=dtab.BASE_TIME, exact=schemas.MONEY_TYPE)


def _daily_orders(spark, sf, series=()) -> DataFrame:
    return _daily_cents(dtab.order_prices(spark, sf), series)


@query
def daily_grid_agg(spark, sf):
    return _daily(spark, sf)


@query
def daily_grid_agg_orders(spark, sf):
    return _daily_orders(spark, sf)


@query
def daily_grid_agg_by_market(spark, sf):
    return _daily_cents(dtab.shipment_prices(spark, sf), MARKET)


@query
def daily_completeness(spark, sf):
    return daily.completeness(_daily(spark, sf))


@query
def daily_completeness_orders(spark, sf):
    """Over years of days, those of 23 and 25 hours among them."""
    return daily.completeness(_daily_orders(spark, sf))


# -- arbitrage views -----------------------------------------------------


@query
def arb_loss_on_discharge(spark, sf):
    return views.daily_battery_arbitrage(_daily(spark, sf))


@query
def arb_loss_on_discharge_orders(spark, sf):
    return views.daily_battery_arbitrage(_daily_orders(spark, sf))


@query
def arb_loss_on_charge(spark, sf):
    return views.daily_battery_arbitrage_silver(dtab.silver_price(spark, sf))


@query
def arb_loss_on_charge_orders(spark, sf):
    return views.daily_battery_arbitrage_silver(dtab.order_prices(spark, sf))


@query
def arb_spec_sweep(spark, sf):
    return arbitrage.sweep(daily.price_range(dtab.silver_price(spark, sf)), BATTERIES)


@query
def arb_spec_sweep_orders(spark, sf):
    return arbitrage.sweep(daily.price_range(dtab.order_prices(spark, sf)), BATTERIES)


# -- running, rolling, latest --------------------------------------------


@query
def running_profit(spark, sf):
    return views.running_profit(_daily(spark, sf))


@query
def running_profit_orders(spark, sf):
    return views.running_profit(_daily_orders(spark, sf))


@query
def running_profit_by_market(spark, sf):
    return views.running_profit(_daily_orders(spark, sf, MARKET), MARKET)


@query
def last10_profit(spark, sf):
    return views.last_days_profit(_daily(spark, sf))


@query
def last10_profit_orders(spark, sf):
    return views.last_days_profit(_daily_orders(spark, sf))


@query
def last10_profit_by_market(spark, sf):
    return views.last_days_profit(_daily_orders(spark, sf, MARKET), MARKET)


@query
def rolling_10d(spark, sf):
    return views.battery_arbitrage_rolling(dtab.silver_price(spark, sf))


@query
def rolling_10d_orders(spark, sf):
    return views.battery_arbitrage_rolling(dtab.order_prices(spark, sf))


@query
def rolling_10d_by_market(spark, sf):
    return views.battery_arbitrage_rolling(dtab.shipment_prices(spark, sf), MARKET)


@query
def latest_30_days(spark, sf):
    return views.latest_days(dtab.silver_price(spark, sf))


@query
def latest_30_days_orders(spark, sf):
    return views.latest_days(dtab.order_prices(spark, sf))


@query
def latest_30_days_by_market(spark, sf):
    return views.latest_days(dtab.order_prices(spark, sf), MARKET)


# -- report documents ----------------------------------------------------


def _minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def _price_texts(price: DataFrame) -> list[Column]:
    hours = [_minute_text(F.col(h)).alias(h) for h in (schemas.UTC_HOUR, schemas.LOCAL_HOUR)]
    return hours + [F.col(m).cast("string").alias(m) for m in schemas.PRICE_METRICS]


@query
def envelope_flatten(spark, sf):
    """One report document per day, of at most a day's hours, read back."""
    price = dtab.silver_price(spark, sf)
    per_day = price.groupBy(F.to_date(schemas.UTC_HOUR).alias("day")).agg(
        F.collect_list(F.struct(*_price_texts(price))).alias(schemas.PRICE_REPORT)
    )
    docs = per_day.select(
        F.to_json(F.struct(F.struct(F.col(f"`{schemas.PRICE_REPORT}`")).alias(schemas.ENVELOPE))).alias("doc")
    )
    return reports.parse_documents(docs, "doc", schemas.PRICE_REPORT, schemas.PRICE_RECORD, strict=True)


@query
def envelope_shapes(spark, sf):
    """One document per event, in each accepted and each rejected shape."""
    events = dtab.table(spark, sf, "events").select(
        "event_id",
        F.to_json(
            F.struct(
                _minute_text(F.col("ts")).alias(schemas.UTC_HOUR),
                F.col("value").cast(schemas.MONEY_TYPE).cast("string").alias("pool_price"),
            )
        ).alias("rec"),
    )
    report = schemas.PRICE_REPORT
    shapes = [
        '{"return": {"%s": [REC]}}',
        '{"%s": [REC]}',
        " [REC]",
        '{"return": {}, "%s": [REC]}',
        '{"return": 5, "%s": [REC]}',
        '{"x": 1, "other": [REC]}',
        '{"return": {"%s": []}}',
        '{"return": {"%s": [REC, REC]}}',
        '{"return": [], "x": [REC]}',
        '{"return": {"%s": null}, "%s": [REC]}',
    ]
    template = F.array(*[F.lit(s.replace("%s", report)) for s in shapes])
    doc = F.replace(F.get(template, F.col("event_id") % len(shapes)), F.lit("REC"), F.col("rec"))
    parsed = reports.parse_documents(
        events.select("event_id", doc.alias("doc")), "doc", report, schemas.PRICE_RECORD, keep=["event_id"]
    )
    return parsed.select("event_id", schemas.UTC_HOUR, schemas.LOCAL_HOUR, "pool_price")


def _by_turns(*texts: Column) -> Column:
    """One of the texts per event, in turn."""
    turn = F.col("event_id") % len(texts)
    chosen = F.when(turn == 0, texts[0])
    for i, text in enumerate(texts[1:], 1):
        chosen = chosen.when(turn == i, text)
    return chosen


@query
def parse_timestamps(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    text = _by_turns(
        _minute_text(F.col("ts")),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit(""),
        F.lit("bad"),
        F.concat(day, F.lit(" 25:00")),
        day,
        F.lit("2026-03-08 02:30"),
        F.concat(_minute_text(F.col("ts")), F.lit(":00-07:00")),
        F.lit(None).cast("string"),
    )
    texts = dtab.table(spark, sf, "events").select("event_id", text.alias("text"))
    return texts.select(
        "event_id",
        casting.parse_minute("text").alias("strict_ts"),
        casting.parse_any("text").alias("lenient_ts"),
    )


@query
def safe_cast(spark, sf):
    cents = F.col("value").cast(schemas.MONEY_TYPE).cast("string")
    text = _by_turns(
        cents,
        F.lit(""),
        F.lit("  "),
        F.lit("abc"),
        F.concat(F.lit(" "), cents, F.lit(" ")),
        F.lit("1e3"),
        F.concat(F.col("event_id").cast("string"), F.lit(".5")),
        F.concat(F.lit("-"), cents),
        F.lit("2147483648"),
        F.lit(None).cast("string"),
    )
    texts = dtab.table(spark, sf, "events").select("event_id", text.alias("text"))
    return texts.select(
        "event_id", casting.to_double("text").alias("as_double"), casting.to_int("text").alias("as_int")
    )


@query
def clean_and_dedup(spark, sf):
    """Raw text rows, many per hour, errors without a readable key."""
    kind, value = F.col("event_type"), F.col("value").cast(schemas.MONEY_TYPE).cast("string")
    raw = dtab.table(spark, sf, "events").select(
        "event_id",
        F.when(kind != "error", _minute_text(dtab.hour_of())).otherwise("").alias(schemas.UTC_HOUR),
        _minute_text(dtab.hour_of() - F.expr(dtab.LOCAL_OFFSET)).alias(schemas.LOCAL_HOUR),
        value.alias("pool_price"),
        F.when(kind == "click", F.lit(" ")).otherwise(value).alias("forecast_pool_price"),
        F.when(kind == "view", F.lit("n/a")).otherwise(value).alias("rolling_30day_avg"),
    )
    return clean.price_by_utc_hour(raw, prefer=["event_id"])


@query
def duplicate_hours(spark, sf):
    hours = dtab.table(spark, sf, "events").select("event_type", dtab.hour_of().alias(schemas.LOCAL_HOUR))
    return clean.duplicate_keys(hours, ["event_type", schemas.LOCAL_HOUR])


@query
def numeric_coercion(spark, sf):
    line = dtab.table(spark, sf, "lineitem")
    exact = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")
    return line.select("l_orderkey", "l_linenumber", casting.to_money(exact, exact=True).alias("discount_amount"))


@query
def landing_date_scope(spark, sf):
    """Records per landing file in a date range, by the date in its name."""
    files = dtab.table(spark, sf, "events").select(
        F.concat(F.lit(f"{schemas.PRICE_PREFIX}_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".json")).alias("file")
    )
    landed = files.select(reports.landing_date("file").alias(reports.LANDED_ON))
    first, last = reports.window_bounds(dtab.AS_OF, 10)
    scoped = landed.filter(F.col(reports.LANDED_ON).between(F.lit(first), F.lit(last)))
    return scoped.groupBy(reports.LANDED_ON).agg(F.count("*").alias("n_records"))


@query
def lookback_window(spark, sf):
    first, last = reports.window_bounds(dtab.AS_OF)
    return dtab.price_feed(spark, sf, first, last)


# -- incremental maintenance ---------------------------------------------


def _hourly_pair(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The stored hourly table and a later batch overlapping it."""
    base = dtab.grid_feed(spark, sf, last=dtab.BASE_LAST_DAY)
    later = dtab.corrected(dtab.grid_feed(spark, sf, first=dtab.BATCH_FIRST_DAY), schemas.LOCAL_HOUR, "pool_price")
    return (
        upsert.hourly_batch(base, dtab.BASE_RUN, dtab.BASE_TIME),
        upsert.hourly_batch(later, dtab.BATCH_RUN, dtab.BATCH_TIME),
    )


@query
def upsert_hourly(spark, sf):
    return upsert.upsert_hourly(*_hourly_pair(spark, sf))


@query
def upsert_silver(spark, sf):
    layout = schemas.SILVER_PRICE
    base = dtab.silver_price(spark, sf, last=dtab.BASE_LAST_DAY)
    later = dtab.corrected(dtab.silver_price(spark, sf, first=dtab.BATCH_FIRST_DAY), schemas.UTC_HOUR, "pool_price")
    return upsert.upsert_silver(
        upsert.silver_batch(base, layout, dtab.BASE_TIME), upsert.silver_batch(later, layout, dtab.BATCH_TIME), layout
    )


@query
def upsert_silver_load(spark, sf):
    layout = schemas.SILVER_LOAD
    base = dtab.silver_load(spark, sf, last=dtab.BASE_LAST_DAY)
    later = dtab.corrected(
        dtab.silver_load(spark, sf, first=dtab.BATCH_FIRST_DAY), schemas.UTC_HOUR, "alberta_internal_load"
    )
    return upsert.upsert_silver(
        upsert.silver_batch(base, layout, dtab.BASE_TIME), upsert.silver_batch(later, layout, dtab.BATCH_TIME), layout
    )


@query
def batch_dates(spark, sf):
    return refresh.batch_dates(_hourly_pair(spark, sf)[1])


@query
def incremental_daily_refresh(spark, sf):
    base, batch = _hourly_pair(spark, sf)
    before = refresh.daily_rows(base, dtab.BASE_TIME)
    return refresh.refresh(before, upsert.upsert_hourly(base, batch), batch, dtab.BATCH_TIME)


@query
def load_verification(spark, sf):
    base, batch = _hourly_pair(spark, sf)
    return upsert.load_verification(upsert.upsert_hourly(base, batch), batch, dtab.BATCH_RUN)


@query
def constraint_report(spark, sf):
    """Events as a batch keyed on kind and hour: keys repeat, and errors have
    neither a key nor the required user."""
    kind = F.col("event_type")
    batch = dtab.table(spark, sf, "events").select(
        F.when(kind != "error", kind).alias("market"),
        dtab.hour_of().alias(schemas.UTC_HOUR),
        F.when(kind != "signup", F.col("user_id")).alias("user_id"),
    )
    return upsert.constraint_report(batch, ["market", schemas.UTC_HOUR], ["user_id"])


@query
def stateful_daily_refresh(spark, sf):
    """The daily table after a batch, from states that follow its corrections."""
    base, batch = _hourly_pair(spark, sf)
    state, keys = daily_state.daily_state(base), [schemas.LOCAL_HOUR]
    after = daily_state.follow(state, base.join(batch.select(*keys), keys, "left_semi"), batch, upsert.upsert_hourly(base, batch))
    changed = after.join(refresh.batch_dates(batch), daily.GRID_DATE, "left_semi")
    rest = [c for c in schemas.DAILY_GRID.names if c != daily.GRID_DATE]
    before = daily_state.figures(state, computed_at=dtab.BASE_TIME)
    return upsert.upsert(before, daily_state.figures(changed, computed_at=dtab.BATCH_TIME), [daily.GRID_DATE], rest)


def _base_and_later(spark, sf) -> tuple[DataFrame, DataFrame]:
    base = dtab.grid_feed(spark, sf, last=dtab.BASE_LAST_DAY)
    return base, dtab.corrected(dtab.grid_feed(spark, sf, first=dtab.BATCH_FIRST_DAY), schemas.LOCAL_HOUR, "pool_price")


def _two_loads(spark, sf, deltas: bool = False) -> tables.MarketStore:
    """A new store in the shared folder after the base and the later batch."""
    store = tables.MarketStore(spark, shared_folder(spark, f"gridtide-store-{uuid.uuid4()}"), deltas=deltas)
    base, later = _base_and_later(spark, sf)
    store.load_hourly(base, dtab.BASE_RUN, dtab.BASE_TIME)
    store.load_hourly(later, dtab.BATCH_RUN, dtab.BATCH_TIME)
    return store


@query
def stored_hourly_grid(spark, sf):
    return _two_loads(spark, sf).read(tables.HOURLY)


@query
def stored_daily_agg(spark, sf):
    return _two_loads(spark, sf).read(tables.DAILY)


@query
def delta_hourly_grid(spark, sf):
    return _two_loads(spark, sf, deltas=True).read(tables.HOURLY)


@query
def delta_daily_agg(spark, sf):
    return _two_loads(spark, sf, deltas=True).read(tables.DAILY)


@query
def compacted_hourly_grid(spark, sf):
    store = _two_loads(spark, sf, deltas=True)
    store.compact(tables.HOURLY)
    return store.read(tables.HOURLY)


@query
def live_hourly_grid(spark, sf):
    """Read through views that were registered before the later load."""
    store = tables.MarketStore(spark, shared_folder(spark, f"gridtide-store-{uuid.uuid4()}"), deltas=True)
    base, later = _base_and_later(spark, sf)
    store.load_hourly(base, dtab.BASE_RUN, dtab.BASE_TIME)
    shown = views.LiveViews(store)
    shown.refresh()
    store.load_hourly(later, dtab.BATCH_RUN, dtab.BATCH_TIME)
    return shown.sql(f"SELECT {', '.join(schemas.HOURLY_GRID.names)} FROM raw_hourly_grid")


# -- figures over rows, in ranges ------------------------------------------


def _lines(spark, sf) -> DataFrame:
    """Line items in the order of their shipment, as one long series."""
    line = dtab.table(spark, sf, "lineitem")
    return line.select(
        "l_shipdate", "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("market"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )


# Orders and lines repeat in the table; rows alike in all of these are the same row.
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "market", "price"]


@query
def running_total_lines(spark, sf):
    return ranges.running_total(_lines(spark, sf), "price", LINE_ORDER, "running_price")


@query
def running_total_lines_by_market(spark, sf):
    return ranges.running_total(_lines(spark, sf), "price", LINE_ORDER, "running_price", MARKET)


@query
def rolling_10_lines(spark, sf):
    return ranges.rolling(_lines(spark, sf), {"rolling_price": F.sum("price"), "rolling_rows": F.count("*")}, LINE_ORDER, schemas.ROLLING_ROWS)


@query
def rolling_10_lines_by_market(spark, sf):
    figures = {"rolling_price": F.sum("price"), "rolling_rows": F.count("*")}
    return ranges.rolling(_lines(spark, sf), figures, LINE_ORDER, schemas.ROLLING_ROWS, MARKET)
