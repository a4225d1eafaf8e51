"""Queries on web events: date lists, monthly arrays, growth, funnel, dashboard."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cohorts, cubes, datelist, growth, monthly, quality, sequences
from tidemark.plans.flat import flat_dates
from tidemark.sources import views
from tidemark.sources.schemas import (
    COHORT_DAYS,
    DEVICE_HITS_DASHBOARD,
    HOST_ACTIVITY_CALENDAR,
    HOST_DAYS,
    HOSTS_CUMULATED,
    USER_COHORTS,
    USER_DEVICES_CUMULATED,
    USERS_CUMULATED,
    USERS_GROWTH_ACCOUNTING,
)
from tidemark.sources.store import BucketedStore, SnapshotStore, new_folder, upsert_rows
from tidemark.sources.views import Reader

FIRST = date(2024, 1, 1)
STEP = date(2024, 1, 5)
MONTH_STEP = date(2024, 1, 3)
LAST = date(2024, 1, 30)
#: Days in the order they are written, with gaps, and the one written again.
WRITTEN = [date(2024, 1, n) for n in (1, 2, 3, 5, 11, 4, 9)]
REWRITTEN = date(2024, 1, 3)
#: Days that cohorts are stepped through after one pass, one of them made again.
COHORT_STEPS = [date(2024, 1, n) for n in (26, 27, 28, 28, 29, 30)]
LATE_HOSTS = ("host0", "host3")
LOGIN = "/api/v1/login"
SIGNUP = "/signup"

#: Buckets of the stored tables: a fact of the tables, whatever the session.
BUCKETS = 8

USER = ["user_id"]
USER_BROWSER = ["user_id", "browser_type"]
USER_HOST = ["user_id", "host"]


def _stepped(events: DataFrame, keys: list[str], dates: str) -> DataFrame:
    """Lists as of the day before by one pass, then one step."""
    past = datelist.active_days(events, keys, last=STEP - timedelta(days=1))
    prev = datelist.datelist_through(past, keys, dates, STEP - timedelta(days=1))
    today = datelist.active_days(events, keys, STEP, STEP)
    return flat_dates(datelist.datelist_step(prev, today, keys, dates))


def _through(events: DataFrame, keys: list[str], dates: str, day: date) -> DataFrame:
    active = datelist.active_days(events, keys, last=day)
    return datelist.datelist_through(active, keys, dates, day)


def _browsers(table: Reader, last: date) -> DataFrame:
    events = views.events_web(table).where(
        F.col("event_time") < F.lit(last + timedelta(days=1))
    )
    return datelist.browser_events(events, views.devices(table))


def users_cumulated(table: Reader) -> DataFrame:
    return _stepped(views.events_web(table), USER, "dates_active")


def user_devices_cumulated(table: Reader) -> DataFrame:
    return _stepped(_browsers(table, STEP), USER_BROWSER, "device_activity_datelist")


def hosts_cumulated(table: Reader) -> DataFrame:
    return _stepped(views.events_web(table), USER_HOST, "host_activity_datelist")


def _days(last: date) -> list[date]:
    return [FIRST + timedelta(days=n) for n in range((last - FIRST).days + 1)]


def users_cumulated_daily(table: Reader) -> DataFrame:
    """Lists of the month, by one stored step per day; each write cuts the lineage."""
    events = views.events_web(table)
    store = BucketedStore(events.sparkSession, new_folder(events.sparkSession), BUCKETS)
    for day in _days(LAST):
        prev = store.read(USERS_CUMULATED, day - timedelta(days=1))
        today = datelist.active_days(events, USER, day, day)
        step = datelist.datelist_step(prev, today, USER, "dates_active")
        store.replace(USERS_CUMULATED, step)
    return store.result(flat_dates(store.read(USERS_CUMULATED, LAST)), USERS_CUMULATED)


def user_devices_daily(table: Reader) -> DataFrame:
    """As user_devices_cumulated, by one stored step per day."""
    browsers = _browsers(table, STEP)
    store = BucketedStore(browsers.sparkSession, new_folder(browsers.sparkSession), BUCKETS)
    dates = "device_activity_datelist"
    for day in _days(STEP):
        prev = store.read(USER_DEVICES_CUMULATED, day - timedelta(days=1))
        today = datelist.active_days(browsers, USER_BROWSER, day, day)
        store.replace(
            USER_DEVICES_CUMULATED, datelist.datelist_step(prev, today, USER_BROWSER, dates)
        )
    found = flat_dates(store.read(USER_DEVICES_CUMULATED, STEP))
    return store.result(found, USER_DEVICES_CUMULATED)


def _months_stored(store: BucketedStore) -> DataFrame:
    """Arrays of the stored calendar; the store goes."""
    arrays = monthly.month_arrays(store.read(HOST_ACTIVITY_CALENDAR))
    return store.result(flat_dates(arrays), HOSTS_CUMULATED, HOST_ACTIVITY_CALENDAR, HOST_DAYS)


def _write_day(store: BucketedStore, counts: DataFrame, day: date) -> None:
    """Write or rewrite one day of the stored calendar."""
    month = day.year * 100 + day.month
    calendar = store.read(HOST_ACTIVITY_CALENDAR, month)
    changed = monthly.write_days(calendar, counts, [day])
    store.upsert(HOST_ACTIVITY_CALENDAR, changed, [month])


def host_activity_daily(table: Reader) -> DataFrame:
    """Monthly arrays of the month, by stored steps and an upsert per day.

    Events are scanned once, for the distinct users and hosts of each day.
    """
    events = views.events_web(table)
    store = BucketedStore(events.sparkSession, new_folder(events.sparkSession), BUCKETS)
    active = datelist.active_days(events, USER_HOST, FIRST, LAST)
    store.replace(HOST_DAYS, active.withColumnRenamed("date_active", "date"), gather=True)
    for day in _days(LAST):
        prev = store.read(HOSTS_CUMULATED, day - timedelta(days=1))
        today = store.read(HOST_DAYS, day).withColumnRenamed("date", "date_active")
        step = datelist.datelist_step(prev, today, USER_HOST, "host_activity_datelist")
        store.replace(HOSTS_CUMULATED, step)
        _write_day(store, monthly.host_day(store.read(HOSTS_CUMULATED, day), day), day)
    return _months_stored(store)


def host_activity_rewritten(table: Reader) -> DataFrame:
    """Days written out of order and past gaps; one again, once its late events came."""
    events = views.events_web(table)
    active = datelist.active_days(events, USER_HOST, last=max(WRITTEN))
    noon = F.col("event_time") < F.lit(REWRITTEN) + F.expr("INTERVAL 12 HOURS")
    late = (F.to_date("event_time") == F.lit(REWRITTEN)) & ~noon
    early = datelist.active_days(events.where(~late), USER_HOST, last=max(WRITTEN))
    store = BucketedStore(events.sparkSession, new_folder(events.sparkSession), BUCKETS)
    for day in WRITTEN:
        known = early if day == REWRITTEN else active
        past = known.where(F.col("date_active") <= F.lit(day))
        _write_day(store, monthly.host_days(past, [day]), day)
    past = active.where(F.col("date_active") <= F.lit(REWRITTEN))
    _write_day(store, monthly.host_days(past, [REWRITTEN]), REWRITTEN)
    return _months_stored(store)


def _bits(table: Reader, keep_today: bool) -> DataFrame:
    users = _through(views.events_web(table), USER, "dates_active", LAST)
    return datelist.activity_bits(
        users, USER, "dates_active", FIRST, LAST, keep_today=keep_today
    )


def activity_bits(table: Reader) -> DataFrame:
    return _bits(table, keep_today=False)


def activity_bits_corrected(table: Reader) -> DataFrame:
    return _bits(table, keep_today=True)


def _device_bits(table: Reader, combine: str) -> DataFrame:
    dates = "device_activity_datelist"
    users = _through(_browsers(table, LAST), USER_BROWSER, dates, LAST)
    bits = datelist.activity_bits(users, USER, dates, FIRST, LAST, combine)
    return bits.select("user_id", "activity_bits", "monthly_active")


def device_activity_bits(table: Reader) -> DataFrame:
    return _device_bits(table, "sum")


def device_activity_bits_or(table: Reader) -> DataFrame:
    return _device_bits(table, "or")


def _calendar_through(active: DataFrame, day: date) -> DataFrame:
    return monthly.calendar_through(active, day, FIRST)


def host_activity_reduced(table: Reader) -> DataFrame:
    """Monthly arrays after one step from those of the day before."""
    day, before = MONTH_STEP, MONTH_STEP - timedelta(days=1)
    active = datelist.active_days(views.events_web(table), USER_HOST, last=day)
    hosts = datelist.datelist_through(active, USER_HOST, "host_activity_datelist", day)
    changed = monthly.write_days(
        _calendar_through(active, before), monthly.host_day(hosts, day), [day]
    )
    return flat_dates(monthly.month_arrays(changed))


def upsert_month(table: Reader) -> DataFrame:
    """Late events of some hosts on an earlier day, upserted; other hosts' rows are kept."""
    day = MONTH_STEP - timedelta(days=1)
    events = views.events_web(table)
    late = (F.to_date("event_time") == F.lit(day)) & F.col("host").isin(*LATE_HOSTS)
    known = F.coalesce(~late, F.lit(True))
    early = datelist.active_days(events.where(known), USER_HOST, last=MONTH_STEP)
    active = datelist.active_days(events, USER_HOST, last=day)
    target = _calendar_through(early, MONTH_STEP)
    counts = monthly.host_days(active.where(F.col("host").isin(*LATE_HOSTS)), [day])
    changed = monthly.write_days(target, counts)
    merged = upsert_rows(target, changed, HOST_ACTIVITY_CALENDAR.key)
    return flat_dates(monthly.month_arrays(merged))


def _active(table: Reader) -> DataFrame:
    """Days on which users have any event; other days of a user are gaps."""
    return datelist.active_days(views.events_web(table), USER, last=LAST)


def growth_accounting(table: Reader) -> DataFrame:
    return flat_dates(growth.growth_backfill(_active(table), LAST))


def growth_accounting_corrected(table: Reader) -> DataFrame:
    return flat_dates(growth.growth_backfill(_active(table), LAST, corrected=True))


def growth_accounting_step(table: Reader) -> DataFrame:
    before = LAST - timedelta(days=1)
    active = _active(table)
    prev = growth.growth_as_of(active, before)
    today = active.where(F.col("date_active") == F.lit(LAST))
    return flat_dates(growth.growth_step(prev, today))


def growth_accounting_daily(table: Reader) -> DataFrame:
    """As growth_accounting, by one stored step per day."""
    events = views.events_web(table)
    store = BucketedStore(events.sparkSession, new_folder(events.sparkSession), BUCKETS)
    for day in _days(LAST):
        prev = store.read(USERS_GROWTH_ACCOUNTING, day - timedelta(days=1))
        today = datelist.active_days(events, USER, day, day)
        store.replace(USERS_GROWTH_ACCOUNTING, growth.growth_step(prev, today))
    return store.result(
        flat_dates(store.read(USERS_GROWTH_ACCOUNTING)), USERS_GROWTH_ACCOUNTING
    )


def growth_state_counts(table: Reader) -> DataFrame:
    return flat_dates(growth.state_counts(growth.growth_backfill(_active(table), LAST)))


def retention_curve(table: Reader) -> DataFrame:
    return flat_dates(
        growth.retention(growth.growth_backfill(_active(table), LAST)).orderBy(
            "date", "days_since_first_active"
        )
    )


def retention_curve_daily(table: Reader) -> DataFrame:
    """As retention_curve, from a stored matrix to which each of the last days adds."""
    active = _active(table).checkpoint()
    store = BucketedStore(active.sparkSession, new_folder(active.sparkSession), BUCKETS)
    firsts, matrix = cohorts.cohorts_through(active, COHORT_STEPS[0] - timedelta(days=1))
    store.replace(USER_COHORTS, firsts, gather=True)
    store.replace(COHORT_DAYS, matrix, gather=True)
    for day in COHORT_STEPS:
        before = store.read(COHORT_DAYS, day - timedelta(days=1))
        new, column = cohorts.cohort_step(store.read(USER_COHORTS), before, active, day)
        store.replace(COHORT_DAYS, column)
        store.replace(USER_COHORTS, new)
    curve = cohorts.cohort_curve(store.read(COHORT_DAYS))
    return store.result(flat_dates(curve), USER_COHORTS, COHORT_DAYS)


def user_activity_count(table: Reader) -> DataFrame:
    return growth.activity_count(growth.growth_as_of(_active(table), LAST), LAST)


def _funnel(table: Reader, corrected: bool) -> DataFrame:
    return sequences.funnel(views.events_web(table), [SIGNUP, LOGIN], LOGIN, corrected)


def funnel_conversion(table: Reader) -> DataFrame:
    return _funnel(table, corrected=False)


def funnel_conversion_corrected(table: Reader) -> DataFrame:
    return _funnel(table, corrected=True)


def device_hits_dashboard(table: Reader) -> DataFrame:
    return cubes.device_dashboard(views.events_web(table), views.devices(table))


def device_hits_dashboard_stored(table: Reader) -> DataFrame:
    """The dashboard stored by create-as, read back, and dropped."""
    hits = device_hits_dashboard(table)
    spark = hits.sparkSession
    store = SnapshotStore(spark, new_folder(spark))
    name = f"{DEVICE_HITS_DASHBOARD.name}_{uuid.uuid4().hex}"
    kept = store.result(store.create_as(name, hits))
    spark.sql(f"DROP TABLE {name}")
    return kept


def distinct_urls(table: Reader) -> DataFrame:
    return quality.distinct_values(views.events_web(table), "url")


QUERIES = {
    f.__name__: f
    for f in (
        users_cumulated,
        user_devices_cumulated,
        hosts_cumulated,
        users_cumulated_daily,
        user_devices_daily,
        host_activity_daily,
        host_activity_rewritten,
        activity_bits,
        activity_bits_corrected,
        device_activity_bits,
        device_activity_bits_or,
        host_activity_reduced,
        upsert_month,
        growth_accounting,
        growth_accounting_corrected,
        growth_accounting_step,
        growth_accounting_daily,
        growth_state_counts,
        retention_curve,
        retention_curve_daily,
        user_activity_count,
        funnel_conversion,
        funnel_conversion_corrected,
        device_hits_dashboard,
        device_hits_dashboard_stored,
        distinct_urls,
    )
}
