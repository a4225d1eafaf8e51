"""Statements for the web event queries, from distinct active days."""

from __future__ import annotations

from tidemark.oracle.inputs import with_inputs

Steps = list[tuple[str, str]]

STEP, MONTH_STEP, LAST = "DATE '2024-01-05'", "DATE '2024-01-03'", "DATE '2024-01-30'"
LOGIN, SIGNUP = "/api/v1/login", "/signup"

BROWSERS = (
    "browsers",
    "SELECT user_id, event_time, max(browser_type) AS browser_type "
    "FROM events_web JOIN devices USING (device_id) "
    "WHERE user_id IS NOT NULL GROUP BY user_id, event_time "
    "HAVING max(browser_type) IS NOT NULL",
)


def _visits(source: str, extra: str = "", where: str = "TRUE") -> tuple[str, str]:
    """Distinct users, further keys and days; null keys left out."""
    keys = f"CAST(user_id AS VARCHAR) AS user_id{', ' + extra if extra else ''}"
    known = f" AND {extra} IS NOT NULL" if extra else ""
    return (
        "visits",
        f"SELECT DISTINCT {keys}, CAST(event_time AS DATE) AS day FROM {source} "
        f"WHERE user_id IS NOT NULL{known} AND {where}",
    )


def _lists(inputs: list[str], steps: Steps, keys: str, dates: str, last: str = STEP) -> str:
    return with_inputs(
        inputs,
        steps,
        f"SELECT {keys}, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day DESC) AS {dates}, "
        f"CAST({last} AS VARCHAR) AS date FROM visits WHERE day <= {last} GROUP BY {keys}",
    )


def _bits(
    inputs: list[str], steps: Steps, top: int, merge: str = "sum", all_counts: bool = True
) -> str:
    """A day sets bit ``top`` minus its age; only 32 bits are kept."""
    narrower = (
        ", CAST(bit_count(word >> 25) AS INTEGER) AS weekly_active, "
        "CAST(word >> 31 AS INTEGER) AS daily_active"
        if all_counts
        else ""
    )
    return with_inputs(
        inputs,
        [
            *steps,
            (
                "words",
                f"SELECT user_id, CAST({merge}(CAST(1 AS BIGINT) << ({top} - "
                f"CAST({LAST} - day AS INTEGER))) AS BIGINT) & ((CAST(1 AS BIGINT) << 32) - 1) "
                f"AS word FROM visits WHERE day <= {LAST} GROUP BY user_id",
            ),
        ],
        "SELECT user_id, lpad(bin(word), 32, '0') AS activity_bits, "
        f"CAST(bit_count(word) AS INTEGER) AS monthly_active{narrower} FROM words",
    )


USERS = [_visits("events_web")]
HOSTS = [_visits("events_web", "host")]
USER_BROWSERS = [BROWSERS, _visits("browsers", "browser_type")]

def _reduced(last: str, written: str = "TRUE") -> str:
    """Slots of every day from a host's first on, or of those written."""
    return with_inputs(
        ["events_web"],
        [
            *HOSTS,
            (
                "slots",
                f"SELECT host, CAST(unnest(generate_series(min(day), {last}, "
                f"INTERVAL 1 DAY)) AS DATE) AS day FROM visits WHERE day <= {last} "
                "GROUP BY host",
            ),
            (
                "counts",
                "SELECT s.host, s.day, count(v.user_id) AS users FROM slots s "
                f"LEFT JOIN visits v ON v.host = s.host AND v.day = s.day WHERE {written} GROUP BY s.host, s.day",
            ),
        ],
        "SELECT CAST(month(day) AS INTEGER) AS month, host, "
        "string_agg(CAST(users AS VARCHAR), ',' ORDER BY day DESC) AS hit_array, "
        "string_agg(CAST(users AS VARCHAR), ',' ORDER BY day DESC) AS unique_visitors "
        "FROM counts GROUP BY month(day), host",
    )


REDUCED = _reduced(MONTH_STEP)


def _growth(corrected: bool = False) -> Steps:
    """Every user and day from the first event on, with the gap to the active day before."""
    if corrected:
        weekly = """CASE WHEN gap IS NULL THEN 'New'
                         WHEN gap > 7 THEN CASE WHEN active THEN 'Resurrected' ELSE 'Stale' END
                         WHEN active OR gap < 7 THEN 'Retained' ELSE 'Churned' END"""
    else:
        weekly = """CASE WHEN gap IS NULL THEN 'New' WHEN gap > 7 AND active THEN 'Resurrected'
                         WHEN gap > 8 THEN 'Stale' ELSE 'Retained' END"""
    return [
        _visits("events_web"),
        (
            "spine",
            "SELECT user_id, min(day) AS first_day, CAST(unnest(generate_series(min(day), "
            f"{LAST}, INTERVAL 1 DAY)) AS DATE) AS date FROM visits GROUP BY user_id",
        ),
        (
            "marked",
            """
            SELECT s.user_id, first_day, date, v.day IS NOT NULL AS active,
                   max(v.day) OVER (PARTITION BY s.user_id ORDER BY date) AS last_day,
                   date - max(v.day) OVER (
                       PARTITION BY s.user_id ORDER BY date
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap,
                   string_agg(CAST(v.day AS VARCHAR), ',') OVER (
                       PARTITION BY s.user_id ORDER BY date) AS days
            FROM spine s LEFT JOIN visits v ON v.user_id = s.user_id AND v.day = s.date
            """,
        ),
        (
            "growth",
            f"""
            SELECT user_id, CAST(first_day AS VARCHAR) AS first_active_date,
                   CAST(last_day AS VARCHAR) AS last_active_date,
                   CASE WHEN gap IS NULL THEN 'New'
                        WHEN gap = 1 THEN CASE WHEN active THEN 'Retained' ELSE 'Churned' END
                        WHEN active THEN 'Resurrected' ELSE 'Stale' END AS daily_active_state,
                   {weekly} AS weekly_active_state, days AS dates_active,
                   CAST(date AS VARCHAR) AS date
            FROM marked
            """,
        ),
    ]


def _growth_query(result: str, corrected: bool = False) -> str:
    return with_inputs(["events_web"], _growth(corrected), result)


STEPS = (
    "steps",
    "SELECT user_id, url, event_time, CAST(event_time AS DATE) AS day, "
    f"max(CASE WHEN url = '{LOGIN}' THEN event_time END) OVER (PARTITION BY user_id, "
    "CAST(event_time AS DATE)) AS last_login FROM events_web "
    f"WHERE user_id IS NOT NULL AND url IN ('{LOGIN}', '{SIGNUP}')",
)


def _funnel(hits: str, reached: str) -> str:
    return with_inputs(
        ["events_web"],
        [
            STEPS,
            ("counted", f"SELECT user_id, url, {hits} AS hits, {reached} AS ok FROM steps"),
            (
                "users",
                "SELECT user_id, url, sum(hits) AS hits, coalesce(bool_or(ok), false) AS ok "
                "FROM counted GROUP BY user_id, url",
            ),
        ],
        "SELECT url, count(*) AS user_count, sum(hits) AS total_hits, "
        "CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / count(*) AS pct_converted "
        "FROM users GROUP BY url",
    )


def _hits_by(level: str, *dims: str) -> str:
    every = ("os_type", "device_type", "browser_type")
    shown = ", ".join(d if d in dims else f"'(overall)' AS {d}" for d in every)
    return (
        f"SELECT '{level}' AS aggregation_level, {shown}, count(*) AS number_of_hits "
        f"FROM hits GROUP BY {', '.join(dims)}"
    )


ORACLES = {
    "users_cumulated": _lists(["events_web"], USERS, "user_id", "dates_active"),
    "user_devices_cumulated": _lists(
        ["events_web", "devices"],
        USER_BROWSERS,
        "user_id, browser_type",
        "device_activity_datelist",
    ),
    "hosts_cumulated": _lists(["events_web"], HOSTS, "user_id, host", "host_activity_datelist"),
    "activity_bits": _bits(["events_web"], USERS, 32),
    "activity_bits_corrected": _bits(["events_web"], USERS, 31),
    "device_activity_bits": _bits(
        ["events_web", "devices"], USER_BROWSERS, 32, all_counts=False
    ),
    "device_activity_bits_or": _bits(
        ["events_web", "devices"], USER_BROWSERS, 32, "bit_or", all_counts=False
    ),
    "host_activity_reduced": REDUCED,
    "upsert_month": REDUCED,
    "growth_accounting": _growth_query("SELECT * FROM growth"),
    "growth_accounting_corrected": _growth_query("SELECT * FROM growth", corrected=True),
    "growth_accounting_step": _growth_query(
        f"SELECT * FROM growth WHERE date = CAST({LAST} AS VARCHAR)"
    ),
    "growth_state_counts": _growth_query(
        "SELECT date, daily_active_state, count(*) AS users FROM growth "
        "GROUP BY date, daily_active_state"
    ),
    "retention_curve": _growth_query(
        "SELECT CAST(date AS VARCHAR) AS date, CAST(date - first_day AS INTEGER) "
        "AS days_since_first_active, count(*) FILTER (WHERE active) AS active_users, "
        "count(*) AS total_users, CAST(count(*) FILTER (WHERE active) AS DOUBLE) / count(*) "
        "* 100 AS pct_active FROM marked GROUP BY date, date - first_day"
    ),
    "user_activity_count": _growth_query(
        f"SELECT user_id, count(*) AS activity_count FROM marked WHERE date = {LAST} "
        "GROUP BY user_id"
    ),
    "funnel_conversion": _funnel(
        "count(*) OVER (PARTITION BY user_id, day ORDER BY event_time DESC "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "last_login >= event_time",
    ),
    "funnel_conversion_corrected": _funnel("1", "last_login > event_time"),
    "device_hits_dashboard": with_inputs(
        ["events_web", "devices"],
        [
            (
                "hits",
                "SELECT coalesce(os_type, 'unknown') AS os_type, "
                "coalesce(device_type, 'unknown') AS device_type, "
                "coalesce(browser_type, 'unknown') AS browser_type "
                "FROM events_web JOIN devices USING (device_id)",
            )
        ],
        " UNION ALL ".join(
            [
                _hits_by(
                    "os_type__device_type__browser", "os_type", "device_type", "browser_type"
                ),
                _hits_by("os_type", "os_type"),
                _hits_by("device_type", "device_type"),
                _hits_by("browser_type", "browser_type"),
            ]
        ),
    ),
    "distinct_urls": with_inputs(
        ["events_web"], [], "SELECT url FROM events_web GROUP BY url"
    ),
}

# The stored tables hold what the same steps give in one plan.
ORACLES["users_cumulated_daily"] = _lists(["events_web"], USERS, "user_id", "dates_active", LAST)
ORACLES["host_activity_daily"] = _reduced(LAST)
ORACLES["host_activity_rewritten"] = _reduced(
    "DATE '2024-01-11'", "day(s.day) IN (1, 2, 3, 4, 5, 9, 11)"
)
ORACLES["user_devices_daily"] = ORACLES["user_devices_cumulated"]
ORACLES["retention_curve_daily"] = ORACLES["retention_curve"]
ORACLES["growth_accounting_daily"] = ORACLES["growth_accounting"]
ORACLES["device_hits_dashboard_stored"] = ORACLES["device_hits_dashboard"]
