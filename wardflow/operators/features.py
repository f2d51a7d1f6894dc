"""Lag, rolling and calendar features over the hourly census.

Windows run over census rows: one per hour and facility, so a facility has at most
8 784 rows a year however many messages it sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.operators.census import calendar

HOUR = 3600

# Lag offsets (in rows) and rolling spans (in hours) of the features.
ARRIVAL_LAGS = (1, 2, 4, 6, 12, 24, 168)
DISCHARGE_LAGS = (1, 2, 6, 12, 24, 168)
NET_LAGS = (1, 6, 24)
ROLLING = {"6h": 6, "12h": 12, "24h": 24, "7d": 168}


# Hour in epoch seconds: every window sorts by this one column, so one sort serves
# them all.
AT = "__at"


def with_clock(df: DataFrame, order: str = "event_hour") -> DataFrame:
    return df.withColumn(AT, F.col(order).cast("long"))


def row_window(partition: list[str], ties: tuple[str, ...] = ()):
    return W.partitionBy(*partition).orderBy(AT, *ties)


def span_window(partition: list[str], hours: int):
    """The current hour and the ``hours`` before it: ``hours + 1`` slots."""
    return W.partitionBy(*partition).orderBy(AT).rangeBetween(-hours * HOUR, 0)


def lags(col: str, offsets, window, prefix: str | None = None) -> list[Column]:
    """Earlier values, counted in rows (census rows are sparse)."""
    return [
        F.lag(col, n).over(window).cast("long").alias(f"{prefix or col}_lag_{n}h") for n in offsets
    ]


def rolling(col: str, spans: dict[str, int], partition: list[str], fn=F.sum) -> dict[str, Column]:
    """``fn`` over each span, by span name."""
    return {n: fn(col).over(span_window(partition, h)) for n, h in spans.items()}


def cumulative(col: str, window) -> Column:
    return F.sum(F.col(col).cast("long")).over(
        window.rowsBetween(W.unboundedPreceding, W.currentRow)
    )


def calendar_features() -> dict[str, Column]:
    """Month, day, week, night shift and holiday window of ``event_hour``."""
    month, day = F.month("event_hour"), F.dayofmonth("event_hour")
    hour, weekday = F.hour("event_hour"), F.dayofweek("event_hour")
    holiday = (
        ((month == 12) & day.between(24, 31))
        | ((month == 1) & (day == 1))
        | ((month == 7) & (day == 4))
        | ((month == 11) & day.between(22, 28) & (weekday == 5))
    )
    return {
        "month": month,
        "day_of_month": day,
        "week_of_year": F.weekofyear("event_hour"),
        "is_night_shift": (hour.between(19, 23) | hour.between(0, 6)).cast("int"),
        "is_holiday_window": holiday.cast("int"),
    }


# Columns of the hourly census, which its features keep, and rows and hours that windows look back.
CENSUS = ("event_hour", "location_facility", "arrivals", "discharges", "net_change", "hour_of_day", "day_of_week", "is_weekend")
ROWS_BACK, HOURS_BACK = max(ARRIVAL_LAGS), max(ROLLING.values())
DAY_BACK = 24


def forecast_features(hourly: DataFrame, dept: str) -> DataFrame:
    """Feature vector per hour and facility from an hourly census.

    All windows share one partitioning and one leading sort key, so the whole
    table takes a single shuffle and a single sort. A column ``carried``, where there is one, is
    what the running census stood at before the row, and counts from the first row that has it.
    """
    by = ["location_facility"]
    rows = row_window(by, ties=("arrivals", "discharges"))
    base = with_clock(hourly).withColumns({c: F.col(c).cast("long") for c in ("arrivals", "discharges", "net_change")})
    stepped = base.select(
        "*",
        F.lit(dept).alias("department"),
        *[c.alias(n) for n, c in calendar_features().items()],
        *lags("arrivals", ARRIVAL_LAGS, rows),
        *lags("discharges", DISCHARGE_LAGS, rows),
        *lags("net_change", NET_LAGS, rows),
        (cumulative("net_change", rows) + _start_of(hourly, rows)).alias("__cumulative"),
    )
    arrivals = rolling("arrivals", ROLLING, by)
    discharges = rolling("discharges", ROLLING, by)
    day = span_window(by, 24)
    rolled = stepped.select(
        "*",
        *[c.alias(f"arrivals_rolling_{n}") for n, c in arrivals.items()],
        F.round(F.avg("arrivals").over(span_window(by, 6)), 2).alias("arrivals_avg_6h"),
        F.round(F.avg("arrivals").over(day), 2).alias("arrivals_avg_24h"),
        F.round(F.stddev("arrivals").over(day), 2).alias("arrivals_std_24h"),
        *[c.alias(f"discharges_rolling_{n}") for n, c in discharges.items()],
        F.round(F.avg("discharges").over(day), 2).alias("discharges_avg_24h"),
    )
    last_week = F.col("arrivals_lag_168h")
    return rolled.select(
        *[c for c in rolled.columns if not c.startswith("__") and c != "carried"],
        F.col("__cumulative").alias("cumulative_net_census"),
        F.when(last_week > 0, F.round(F.col("arrivals") / last_week, 2)).alias("arrivals_wow_ratio"),
    )


def _start_of(hourly: DataFrame, rows) -> Column:
    if "carried" not in hourly.columns:
        return F.lit(0)
    return F.coalesce(F.first("carried").over(rows.rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0))


def halo(before: DataFrame, by: list[str], start, rows_back: int, hours_back: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Of the rows before the hour ``start``, those that windows from ``start`` on can see.

    Per group the last ``rows_back`` rows, and those of the ``hours_back`` hours before. The rows come from
    a feature table and keep its columns.
    """
    earlier = with_clock(before.where(F.col("event_hour") < start))
    latest = W.partitionBy(*by).orderBy(*[F.col(c).desc() for c in (AT, *ties)])
    near = F.col(AT) >= F.lit(start).cast("timestamp").cast("long") - hours_back * HOUR
    ranked = earlier.withColumn("__back", F.row_number().over(latest))
    return ranked.where((F.col("__back") <= rows_back) | near).drop("__back", AT)


def with_history(hourly: DataFrame, before: DataFrame, start) -> DataFrame:
    """Census rows from ``start`` on behind the rows of the feature table that their windows reach back to."""
    past = halo(before, ["location_facility"], start, ROWS_BACK, HOURS_BACK, ("arrivals", "discharges"))
    carried = F.col("cumulative_net_census") - F.col("net_change")
    fresh = hourly.where(F.col("event_hour") >= start).select(*CENSUS, F.lit(None).cast("long").alias("carried"))
    return past.select(*CENSUS, carried.alias("carried")).unionByName(fresh)


def hour_totals(hourly: DataFrame, department: str) -> DataFrame:
    """A department's counts per hour over all its facilities, named after it."""
    counts = ("arrivals", "discharges", "net_change")
    return hourly.groupBy("event_hour").agg(*[F.sum(c).alias(f"{department}_{c}") for c in counts])


def _hour_totals(hourly: DataFrame, side: str) -> DataFrame:
    return hourly.select(
        "event_hour",
        *[
            (F.col(c) if side == own else F.lit(0)).cast("long").alias(f"{own}_{c}")
            for own in ("ed", "icu")
            for c in ("arrivals", "discharges", "net_change")
        ],
    )


def combined_features(ed: DataFrame, icu: DataFrame) -> DataFrame:
    """System-wide feature vector per hour from both departments.

    The two sides are stacked and summed once per hour, a missing side being 0.
    The windows then see one row per hour in all, 8 784 a year.
    """
    return system_features(system_hours(ed, icu))


def system_hours(ed: DataFrame, icu: DataFrame) -> DataFrame:
    """One row per hour with the counts of both departments."""
    stacked = _hour_totals(ed, "ed").unionByName(_hour_totals(icu, "icu"))
    sums = [c for c in stacked.columns if c != "event_hour"]
    return stacked.groupBy("event_hour").agg(*[F.sum(c).alias(c) for c in sums])


def system_features(hours: DataFrame) -> DataFrame:
    """The features of :func:`combined_features` from its hours."""
    hours = with_clock(hours)
    w = row_window([])
    base = hours.select(
        "*",
        *[c.alias(n) for n, c in calendar().items()],
        F.month("event_hour").alias("month"),
        (F.col("ed_arrivals") + F.col("icu_arrivals")).alias("total_arrivals"),
        (F.col("ed_discharges") + F.col("icu_discharges")).alias("total_discharges"),
    )
    day = span_window([], 24)
    return base.select(
        "*",
        *lags("ed_arrivals", (1, 24), w),
        *lags("icu_arrivals", (1, 24), w),
        *[
            F.sum(c).over(day).alias(f"{c}_rolling_24h")
            for c in ("ed_arrivals", "icu_arrivals", "ed_discharges", "icu_discharges")
        ],
        F.when(
            F.col("icu_arrivals") > 0, F.round(F.col("ed_arrivals") / F.col("icu_arrivals"), 2)
        ).alias("ed_to_icu_ratio"),
        (F.col("ed_net_change") + F.col("icu_net_change")).alias("net_system_pressure"),
    ).drop(AT)


def dedup_by_key(df: DataFrame, keys: list[str], order: str, ascending: bool = False) -> DataFrame:
    """One row per key: the latest (or earliest) by ``order``.

    Rows that are equal in it go by all other columns, so the result does not
    change from run to run. Spark keeps the first row per key within each task
    before the shuffle, so a key with very many rows does not land on one task
    whole.
    """
    by = F.col(order).asc() if ascending else F.col(order).desc()
    rest = [c for c, kind in df.dtypes if c not in (*keys, order) and "map<" not in kind]
    ranked = df.withColumn("__row", F.row_number().over(W.partitionBy(*keys).orderBy(by, *rest)))
    return ranked.where("__row = 1").drop("__row")


def cumulative_census(hourly: DataFrame) -> DataFrame:
    """Hourly totals over facilities with their running net change."""
    totals = hourly.groupBy("event_hour").agg(
        *[F.sum(c).alias(c) for c in ("arrivals", "discharges", "net_change")]
    )
    running = F.sum("net_change").over(
        W.orderBy("event_hour").rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    return totals.select("*", running.alias("cumulative_census")).orderBy("event_hour")


def running_net(hourly: DataFrame) -> DataFrame:
    """Running net change over census rows, by hour then facility.

    Facilities run within their hour, in parallel; only the hours' totals, at most
    8 784 a year, are run through in one task.
    """
    totals = hourly.groupBy(F.col("event_hour").alias("__hour")).agg(F.sum("net_change").alias("__net"))
    earlier = F.sum("__net").over(W.orderBy("__hour").rowsBetween(W.unboundedPreceding, -1))
    before = totals.select("__hour", F.coalesce(earlier, F.lit(0)).alias("__before"))
    w = W.partitionBy("event_hour").orderBy(F.col("location_facility").asc_nulls_first(), "arrivals", "discharges")
    within = F.sum("net_change").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = hourly.withColumn("__within", within)
    joined = placed.join(before, placed["event_hour"].eqNullSafe(before["__hour"]))
    return joined.select(*hourly.columns, (F.col("__before") + F.col("__within")).alias("running_net"))
