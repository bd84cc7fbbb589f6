"""Usage reports: dimensions by metrics, presets, active users, sessions, answers, profiles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.operators.timeseries import sessions, with_session_numbers

MOST_DIMENSIONS, MOST_METRICS = 9, 10


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


#: Metrics by name, over an events table; made when a report is built, as columns need a session.
METRICS: dict[str, Callable[[], Column]] = {
    "eventCount": lambda: F.count("*"),
    "activeUsers": lambda: F.countDistinct("user_id"),
    "eventValue": lambda: F.sum("value"),
    "averageValue": lambda: F.avg("value"),
    "eventsPerUser": lambda: _ratio(F.count("*"), F.countDistinct("user_id")),
    "purchases": lambda: F.count_if(F.col("event_type") == "purchase"),
    "purchaseRate": lambda: _ratio(F.count_if(F.col("event_type") == "purchase"), F.count("*")),
    "errors": lambda: F.count_if(F.col("event_type") == "error"),
    "newUsers": lambda: F.countDistinct(F.when(F.col("new_vs_returning") == "new", F.col("user_id"))),
    "sessions": lambda: F.countDistinct("session_id"),
    "engagedSessions": lambda: F.countDistinct(F.when(F.col("session_engaged"), F.col("session_id"))),
    "engagementRate": lambda: _ratio(METRICS["engagedSessions"](), METRICS["sessions"]()),
    "bounceRate": lambda: 1 - METRICS["engagementRate"](),
    "averageSessionDuration": lambda: F.avg(F.when(F.col("session_first"), F.col("session_seconds"))),
    "screenPageViews": lambda: F.count_if(F.col("event_type").isin("view", "page_view", "screen_view")),
    "keyEvents": lambda: F.count_if(F.col("event_type") == "purchase"),
    "totalRevenue": lambda: F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))),
    "itemsViewed": lambda: F.count_if(F.col("event_type").isin("view", "view_item")),
    "itemsAddedToCart": lambda: F.count_if(F.col("event_type") == "add_to_cart"),
    "itemsPurchased": lambda: F.count_if(F.col("event_type") == "purchase"),
    "itemRevenue": lambda: F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))),
    "itemsViewedInPromotion": lambda: F.count_if(F.col("event_type") == "view_promotion"),
    "itemsClickedInPromotion": lambda: F.count_if(F.col("event_type") == "select_promotion"),
    "advertiserAdCost": lambda: F.sum("ad_cost"),
}

# Parts that metrics are made of, by how they are counted: ``row`` sums over rows, ``user`` and ``session`` count users and sessions of which some row says yes.
_PARTS: dict[str, tuple[str, Callable[[], Column]]] = {
    "rows": ("row", lambda: F.count("*")),
    "purchases": ("row", lambda: F.count_if(F.col("event_type") == "purchase")),
    "errors": ("row", lambda: F.count_if(F.col("event_type") == "error")),
    "views": ("row", lambda: F.count_if(F.col("event_type").isin("view", "page_view", "screen_view"))),
    "revenue": ("row", lambda: F.sum(F.when(F.col("event_type") == "purchase", F.col("value")))),
    "value": ("row", lambda: F.sum("value")),
    "values": ("row", lambda: F.count("value")),
    "seconds": ("row", lambda: F.sum(F.when(F.col("session_first"), F.col("session_seconds")))),
    "firsts": ("row", lambda: F.count(F.when(F.col("session_first"), F.col("session_seconds")))),
    "users": ("user", lambda: F.max(F.col("user_id").isNotNull())),
    "new": ("user", lambda: F.max(F.coalesce((F.col("new_vs_returning") == "new") & F.col("user_id").isNotNull(), F.lit(False)))),
    "sessions": ("session", lambda: F.max(F.col("session_id").isNotNull())),
    "engaged": ("session", lambda: F.max(F.coalesce(F.col("session_engaged") & F.col("session_id").isNotNull(), F.lit(False)))),
}
_MADE: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "eventCount": (("rows",), lambda n: n),
    "activeUsers": (("users",), lambda n: n),
    "newUsers": (("new",), lambda n: n),
    "sessions": (("sessions",), lambda n: n),
    "engagedSessions": (("engaged",), lambda n: n),
    "engagementRate": (("engaged", "sessions"), _ratio),
    "bounceRate": (("engaged", "sessions"), lambda a, b: 1 - _ratio(a, b)),
    "averageSessionDuration": (("seconds", "firsts"), _ratio),
    "eventValue": (("value",), lambda v: v),
    "averageValue": (("value", "values"), _ratio),
    "eventsPerUser": (("rows", "users"), _ratio),
    "purchases": (("purchases",), lambda n: n),
    "purchaseRate": (("purchases", "rows"), _ratio),
    "errors": (("errors",), lambda n: n),
    "screenPageViews": (("views",), lambda n: n),
    "keyEvents": (("purchases",), lambda n: n),
    "totalRevenue": (("revenue",), lambda v: v),
}
_OWN = {name: METRICS[name] for name in _MADE}

#: Metrics that need the columns of ``with_sessions`` or of ``with_new_vs_returning``, which a report adds by itself.
SESSION_METRICS = {"sessions", "engagedSessions", "engagementRate", "bounceRate", "averageSessionDuration"}
NEWNESS = {"newUsers", "newVsReturning"}

#: Dimensions by name.
DIMENSIONS: dict[str, Callable[[], Column]] = {
    "date": lambda: F.to_date("ts"),
    "hour": lambda: F.hour("ts"),
    "eventName": lambda: F.col("event_type"),
    "userGroup": lambda: F.col("user_id") % 10,
    "newVsReturning": lambda: F.col("new_vs_returning"),
}

# Names, dimensions and metrics of the ready reports. Those over columns that a table lacks fail by naming the column.
PRESETS: dict[str, tuple[list[str], list[str]]] = {
    "traffic_by_country": (["date", "country"], ["activeUsers", "sessions", "screenPageViews"]),
    "user_acquisition": (["date", "sessionSource", "sessionMedium"], ["sessions", "activeUsers", "newUsers", "engagementRate"]),
    "events_summary": (["date", "eventName"], ["eventCount", "activeUsers"]),
    "page_performance": (["date", "pagePath", "pageTitle"], ["screenPageViews", "averageSessionDuration", "bounceRate"]),
    "device_breakdown": (["date", "deviceCategory", "browser"], ["activeUsers", "sessions", "engagementRate"]),
    "landing_page_performance": (["date", "landingPage"], ["sessions", "activeUsers", "newUsers", "keyEvents", "totalRevenue"]),
    "ecommerce_purchases": (["date", "itemName", "itemId"], ["itemsViewed", "itemsAddedToCart", "itemsPurchased", "itemRevenue"]),
    "purchase_journey": (["date", "eventName"], ["activeUsers", "eventCount"]),
    "checkout_journey": (["date", "eventName"], ["activeUsers", "eventCount"]),
    "promotions_performance": (["date", "itemPromotionName"], ["itemsViewedInPromotion", "itemsClickedInPromotion", "itemRevenue"]),
    "user_retention": (["date", "newVsReturning"], ["activeUsers", "sessions", "engagementRate"]),
    "demographic_details": (["date", "language", "country"], ["activeUsers", "newUsers", "engagedSessions"]),
    "audience_performance": (["date", "audienceName"], ["activeUsers", "sessions", "keyEvents"]),
    "tech_details": (["date", "browser", "operatingSystem"], ["activeUsers", "sessions", "engagementRate"]),
    "advertising_channels": (["date", "defaultChannelGroup"], ["keyEvents", "advertiserAdCost", "totalRevenue"]),
}


def register_metric(name: str, make: Callable[[], Column]) -> None:
    METRICS[name] = make


def register_dimension(name: str, make: Callable[[], Column]) -> None:
    DIMENSIONS[name] = make


def report(df: DataFrame, dimensions: list[str], metrics: list[str], date_range: tuple | None = None, where: Column | None = None, having: Column | None = None, ordered: bool = True) -> DataFrame:
    """Dimensions by metrics; at most 9 and from 1 to 10 of them, unknown names raise; ordered by date where there is one.

    ``where`` filters before the aggregation, ``having`` after it. The date range includes both days.
    """
    if len(dimensions) > MOST_DIMENSIONS or not 1 <= len(metrics) <= MOST_METRICS:
        raise ValueError(f"a report takes at most {MOST_DIMENSIONS} dimensions and 1 to {MOST_METRICS} metrics")
    known = lambda d: DIMENSIONS[d]() if d in DIMENSIONS else F.col(d) if d in df.columns else None
    unknown = [d for d in dimensions if known(d) is None] + [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown names: {', '.join(unknown)}")
    # before any filter: first days and sessions are those of the whole table
    if NEWNESS & {*dimensions, *metrics}:
        df = with_new_vs_returning(df)
    inside = "session_id" not in df.columns  # sessions made here lie inside users
    if SESSION_METRICS & set(metrics) and inside:
        df = with_sessions(df)
    if date_range:
        low, high = (F.lit(x).cast("date") for x in date_range)
        df = df.where((F.col("ts") >= low.cast("timestamp_ntz")) & (F.col("ts") < F.date_add(high, 1).cast("timestamp_ntz")))
    if where is not None:
        df = df.where(where)
    levels = {_PARTS[p][0] for m in metrics for p in _MADE.get(m, ((), None))[0]} - {"row"}
    counted = {p for m in metrics for p in _MADE.get(m, ((), None))[0] if _PARTS[p][0] != "row"}
    if len(counted) > 1 and all(METRICS[m] is _OWN.get(m) for m in metrics) and (inside or "session" not in levels):
        out = _by_levels(df, {d: known(d) for d in dimensions}, metrics, "session" in levels)
    else:
        out = df.groupBy(*(known(d).alias(d) for d in dimensions)).agg(*(METRICS[m]().alias(m) for m in metrics))
    out = out if having is None else out.where(having)
    return out.orderBy("date") if ordered and "date" in dimensions else out


def _by_levels(df: DataFrame, dimensions: dict[str, Column], metrics: list[str], sessions_too: bool) -> DataFrame:
    """Dimensions by metrics with several distinct counts: grouped by dimensions, user and session, then by dimensions and user, then by dimensions.

    Each step combines before it shuffles, and no row is multiplied by the number of distinct counts.
    """
    parts = dict.fromkeys(p for m in metrics for p in _MADE[m][0])
    df = df.withColumns({f"__d{i}": c for i, c in enumerate(dimensions.values())})
    dims = [f"__d{i}" for i in range(len(dimensions))]
    again = {"row": lambda p: F.sum(p), "user": lambda p: F.max(p), "session": lambda p: F.max(p)}
    steps = [[*dims, "user_id", "session_id"], [*dims, "user_id"], dims] if sessions_too else [[*dims, "user_id"], dims]
    out = df.groupBy(*steps[0]).agg(*(_PARTS[p][1]().alias(f"__p_{p}") for p in parts))
    for before, by in zip(steps, steps[1:], strict=False):
        ends = {"session": "session_id" in before and "session_id" not in by, "user": "user_id" in before and "user_id" not in by, "row": False}
        out = out.groupBy(*by).agg(*((F.sum(F.col(f"__p_{p}").cast("long")) if ends[_PARTS[p][0]] or _PARTS[p][0] == "session" and "session_id" not in before else again[_PARTS[p][0]](f"__p_{p}")).alias(f"__p_{p}") for p in parts))
    made = [_MADE[m][1](*(F.col(f"__p_{p}") for p in _MADE[m][0])).alias(m) for m in metrics]
    return out.select(*(F.col(f"__d{i}").alias(d) for i, d in enumerate(dimensions)), *made)


def preset(df: DataFrame, name: str, **how) -> DataFrame:
    dimensions, metrics = PRESETS[name]
    return report(df, dimensions, metrics, **how)


def with_new_vs_returning(events: DataFrame) -> DataFrame:
    """Adds ``new_vs_returning``: ``new`` on the user's first day over the whole table; null for events without a user, which stay."""
    first = events.where("user_id is not null").groupBy("user_id").agg(F.to_date(F.min("ts")).alias("__first"))
    mark = F.when(F.col("user_id").isNull(), F.lit(None)).when(F.to_date("ts") == F.col("__first"), "new").otherwise("returning")
    return events.join(first, "user_id", "left").withColumn("new_vs_returning", mark).drop("__first")


def with_sessions(events: DataFrame, gap_seconds: int = 1800, pieces: int = 1) -> DataFrame:
    """Adds ``session_id``, ``session_first`` (its first event), ``session_seconds`` and ``session_engaged`` (10 seconds or two events at least).

    A gap above ``gap_seconds`` starts a session. One shuffle and sort by user; with ``pieces`` ranges of time a user with most events is many tasks' work. Events without a user
    belong to no session.
    """
    order = ["ts", *[c for c in ("event_id",) if c in events.columns]]
    numbered = with_session_numbers(events, "user_id", order, gap_seconds, "session_first", "__n", pieces)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    s = Window.partitionBy("user_id", "__n")
    timed = numbered.withColumn("session_seconds", (F.max(at).over(s) - F.min(at).over(s)) / 1e6).withColumn("session_engaged", (F.col("session_seconds") >= 10) | (F.count("*").over(s) >= 2))
    known = F.col("user_id").isNotNull()
    timed = timed.withColumns({"session_first": known & F.col("session_first"), "session_engaged": known & F.col("session_engaged"), "session_seconds": F.when(known, F.col("session_seconds"))})
    return timed.withColumn("session_id", F.when(known, F.concat_ws("-", "user_id", "__n"))).drop("__n")


def active_users(events: DataFrame, segment: str | None = None, mode: str = "active") -> DataFrame:
    """``(date, segment, count)`` of distinct active or new users a day, by segment or as ``Totals``."""
    if mode not in ("active", "new"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "new":
        events = with_new_vs_returning(events).where("new_vs_returning = 'new'")  # none of those without a user
    by = F.col(segment).cast("string") if segment else F.lit("Totals")
    return events.groupBy(F.to_date("ts").alias("date"), by.alias("segment")).agg(F.countDistinct("user_id").alias("count"))


def _lengths(events: DataFrame) -> DataFrame:
    s = sessions(events)
    return s.withColumns({"date": F.to_date("start"), "seconds": (F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 1e6})


def average_session_length(events: DataFrame) -> DataFrame:
    """Mean session seconds by the day a session starts."""
    return _lengths(events).groupBy("date").agg(F.avg("seconds").alias("average_seconds"))


def session_length_distribution(events: DataFrame) -> DataFrame:
    """Sessions in each length bucket; lower bounds are inclusive."""
    s = F.col("seconds")
    bucket = F.when(s < 60, "0s-60s").when(s < 300, "60s-300s").when(s < 1800, "300s-1800s").otherwise("1800s+")
    return _lengths(events).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("sessions"))


def sessions_per_user(events: DataFrame) -> DataFrame:
    """Sessions that start on a day by the users who start one."""
    return _lengths(events).groupBy("date").agg(_ratio(F.count("*"), F.countDistinct("user_id")).alias("sessions_per_user"))


def engagement_rate(events: DataFrame) -> DataFrame:
    """Share of a day's sessions that last 10 seconds or have two events."""
    engaged = F.count_if((F.col("seconds") >= 10) | (F.col("events") >= 2))
    return _lengths(events).groupBy("date").agg(_ratio(engaged, F.count("*")).alias("engagement_rate"))


def answer_rollup(responses: DataFrame, survey: str, question: str) -> DataFrame:
    """Count of each answer and its share in the survey's answers."""
    counts = responses.groupBy(survey, question).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(survey)))


def max_date(inputs: list[DataFrame], column: str) -> DataFrame:
    """The newest date over several inputs."""
    return reduce(DataFrame.unionByName, (df.agg(F.max(column).alias("newest")) for df in inputs)).agg(F.max("newest").alias("newest"))


def table_profile(df: DataFrame, keys: list[str], cursor: str) -> DataFrame:
    """One row: rows, distinct keys, whether keys are unique, cursor range, nulls of each column (``nulls_<column>``)."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(cursor).alias("a"), F.max(cursor).alias("b"), *(F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns))
    return per_key.agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_keys"), F.min("a").alias("cursor_min"), F.max("b").alias("cursor_max"), *(F.sum(f"nulls_{c}").alias(f"nulls_{c}") for c in df.columns)).withColumn("unique", F.col("rows") == F.col("distinct_keys"))
