"""Time-series queries: calendar features, history features, gap filling, temporal split."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.operators import stats
from lumenframe.operators import timeseries as ts
from lumenframe.plans.listings import histogram_sql, shown
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.views import SERIES, series

LAGS = (1, 3, 6, 12, 24, 48, 72)
WINDOWS = (6, 12, 24, 48)
ORDER = ["ts", "event_id"]
OVER = "OVER (PARTITION BY series ORDER BY ts, event_id"


@query(
    "c6_cyclic_time",
    f"""WITH {SERIES} SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0 AS hour_sin,
      round(cos(2 * pi() * hour(ts) / 24), 6) + 0 AS hour_cos, round(sin(2 * pi() * month(ts) / 12), 6) + 0 AS month_sin,
      round(cos(2 * pi() * month(ts) / 12), 6) + 0 AS month_cos FROM series""",
)
def c6_cyclic_time(spark, sf):
    parts = fx.calendar_features("ts")
    return series(spark, sf).select(
        "event_id", *[F.round(parts[n], 6).alias(n) for n in ("hour_sin", "hour_cos", "month_sin", "month_cos")]
    )


@query(
    "c7_calendar_parts",
    f"""WITH {SERIES} SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
      CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(quarter(ts) AS INTEGER) AS quarter,
      CAST(hour(ts) AS INTEGER) AS hour FROM series""",
)
def c7_calendar_parts(spark, sf):
    parts = fx.calendar_features("ts")
    return series(spark, sf).select(
        "event_id",
        *[parts[n].alias(n) for n in ("day_of_week", "is_weekend", "quarter")],
        F.hour("ts").alias("hour"),
    )


@query(
    "c8_timestamp_from_parts",
    f"""WITH {SERIES} SELECT event_id,
      make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0) AS hour_ts FROM series""",
)
def c8_timestamp_from_parts(spark, sf):
    df = series(spark, sf).withColumns(
        {"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts"), "hour": F.hour("ts")}
    )
    return df.select("event_id", fx.timestamp_from_parts("year", "month", "day", "hour").alias("hour_ts"))


@query(
    "c9_parse_timestamp",
    f"""WITH {SERIES} SELECT event_id,
      strptime(strftime(ts, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS parsed FROM series""",
)
def c9_parse_timestamp(spark, sf):
    text = series(spark, sf).select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm").alias("text"))
    return text.select("event_id", F.to_timestamp_ntz("text", F.lit("dd/MM/yyyy HH:mm")).alias("parsed"))


def history(spark, sf, **kw):
    return ts.history_features(series(spark, sf), "value", ORDER, ["series"], **kw)


LAG_SQL = ", ".join(f"lag(value, {n}) {OVER}) AS lag_{n}" for n in LAGS)


@query("w1_lags", f"WITH {SERIES} SELECT series, event_id, value, {LAG_SQL} FROM series")
def w1_lags(spark, sf):
    df = history(spark, sf, windows=())
    return df.select("series", "event_id", "value", *[f"lag_{n}" for n in LAGS])


def roll_sql(fn: str, name: str) -> str:
    return ", ".join(
        f"CASE WHEN count(value) {OVER} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) = {w} THEN "
        f"round({fn}(value) {OVER} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 6) END AS {name}_{w}"
        for w in WINDOWS
    )


@query("w2_rolling_mean", f"WITH {SERIES} SELECT event_id, {roll_sql('avg', 'roll_mean')} FROM series")
def w2_rolling_mean(spark, sf):
    names = [f"roll_mean_{w}" for w in WINDOWS]
    return rounded(history(spark, sf, lags=()).select("event_id", *names), 6, *names)


@query("w3_rolling_std", f"WITH {SERIES} SELECT event_id, {roll_sql('stddev_samp', 'roll_std')} FROM series")
def w3_rolling_std(spark, sf):
    names = [f"roll_std_{w}" for w in WINDOWS]
    return rounded(history(spark, sf, lags=()).select("event_id", *names), 6, *names)


@query(
    "d8_drop_incomplete",
    f"""WITH {SERIES}, f AS (SELECT event_id, value, lag(value, 72) {OVER}) AS lag_72,
      {roll_sql('avg', 'roll_mean')} FROM series)
    SELECT event_id, value, lag_72, roll_mean_48 FROM f WHERE value IS NOT NULL AND lag_72 IS NOT NULL
      AND roll_mean_6 IS NOT NULL AND roll_mean_48 IS NOT NULL""",
)
def d8_drop_incomplete(spark, sf):
    df = history(spark, sf, lags=(72,), windows=(6, 48))
    df = df.dropna().select("event_id", "value", "lag_72", "roll_mean_48")
    return rounded(df, 6, "roll_mean_48")


INTERPOLATED = f"""{SERIES}, n AS (SELECT *, row_number() {OVER}) AS pos FROM series),
  k AS (SELECT *,
    last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
    last_value(value IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
    first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
    first_value(value IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1 FROM n),
  i AS (SELECT series, ts, event_id, value, CASE WHEN value IS NOT NULL THEN value WHEN p0 IS NULL THEN NULL
    WHEN p1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * ((pos - p0) / (p1 - p0)) END AS filled FROM k)"""


def interpolated(spark, sf):
    return ts.interpolate(series(spark, sf), "value", ORDER, ["series"])


@query("w4_interpolate", f"WITH {INTERPOLATED} SELECT series, event_id, round(filled, 6) AS filled FROM i")
def w4_interpolate(spark, sf):
    return rounded(interpolated(spark, sf).select("series", "event_id", "filled"), 6, "filled")


@query(
    "w5_fill_leading",
    f"""WITH {INTERPOLATED}, m AS (SELECT series, median(filled) AS med FROM i GROUP BY series)
    SELECT series, event_id, round(coalesce(filled, med), 6) AS filled FROM i JOIN m USING (series)""",
)
def w5_fill_leading(spark, sf):
    df = ts.fill_leading(interpolated(spark, sf), "filled", ["series"])
    return rounded(df.select("series", "event_id", "filled"), 6, "filled")


CUTOFF = "2024-01-21"


@query(
    "p5_temporal_split",
    f"""WITH {SERIES} SELECT event_id, CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS split
    FROM series""",
)
def p5_temporal_split(spark, sf):
    train, test = ts.temporal_split(series(spark, sf), "ts", CUTOFF)
    parts = [p.select("event_id", F.lit(n).alias("split")) for p, n in ((train, "train"), (test, "test"))]
    return parts[0].unionByName(parts[1])


@query("d7_time_cutoff", f"WITH {SERIES} SELECT event_id, ts FROM series WHERE ts >= TIMESTAMP '{CUTOFF}'")
def d7_time_cutoff(spark, sf):
    return ts.temporal_split(series(spark, sf), "ts", CUTOFF)[1].select("event_id", "ts")


PREDICTED = f"""{SERIES}, p AS (SELECT event_id, ts, value,
    lag(value, 1) {OVER}) AS predicted FROM series), e AS (
    SELECT * FROM p WHERE value IS NOT NULL AND predicted IS NOT NULL)"""


def predicted(spark, sf):
    """Persistence forecast: the value one row earlier."""
    df = history(spark, sf, lags=(1,), windows=()).withColumnRenamed("lag_1", "predicted")
    return df.select("event_id", "ts", "value", "predicted").dropna(subset=["value", "predicted"])


@query(
    "e7_seasonality",
    f"""WITH {PREDICTED} SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(value), 9) AS mean_value,
      round(avg(predicted), 9) AS mean_predicted FROM e GROUP BY 1""",
)
def e7_seasonality(spark, sf):
    df = ts.seasonality(predicted(spark, sf), F.hour("ts"), ["value", "predicted"], "hour")
    return rounded(df, 9, "mean_value", "mean_predicted")


@query(
    "e7_weekday_profile",
    f"""WITH {PREDICTED} SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, round(avg(value), 9) AS mean_value,
      round(avg(predicted), 9) AS mean_predicted FROM e GROUP BY 1""",
)
def e7_weekday_profile(spark, sf):
    df = ts.seasonality(predicted(spark, sf), F.weekday("ts"), ["value", "predicted"], "weekday")
    return rounded(df, 9, "mean_value", "mean_predicted")


@query("c17_residual", f"WITH {PREDICTED} SELECT event_id, round(value - predicted, 6) + 0 AS residual FROM e")
def c17_residual(spark, sf):
    return predicted(spark, sf).select("event_id", F.round(fx.residual("value", "predicted"), 6).alias("residual"))


def polynomial_sql(coefficients: tuple[float, ...], x: str) -> str:
    return " + ".join(f"{c!r}::DOUBLE * pow({x}, {k})" for k, c in enumerate(coefficients))


def ratio_sql(part: int, x: str) -> str:
    above, below = (polynomial_sql(c, x) for c in stats.AS241[part])
    return f"({above}) / ({below})"


@query(
    "e22_normal_qq",
    f"""WITH {PREDICTED}, r AS (SELECT event_id, round(value - predicted, 9) AS r FROM e WHERE value - predicted IS NOT NULL),
    o AS (SELECT event_id, r, row_number() OVER (ORDER BY r, event_id) AS i, count(*) OVER () AS n FROM r),
    m AS (SELECT event_id, r, CASE WHEN i = n THEN pow(0.5, 1 / n) WHEN i = 1 THEN 1 - pow(0.5, 1 / n)
      ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o),
    t AS (SELECT *, p - 0.5 AS q, sqrt(-ln(least(p, 1 - p))) AS t FROM m)
    SELECT event_id, round(CASE WHEN abs(q) <= 0.425 THEN q * {ratio_sql(0, '(0.180625 - q * q)')}
      WHEN t <= 5 THEN sign(q) * {ratio_sql(1, '(t - 1.6)')} ELSE sign(q) * {ratio_sql(2, '(t - 5)')} END, 6) + 0 AS theoretical,
      round(r, 6) + 0 AS observed FROM t""",
)
def e22_normal_qq(spark, sf):
    df = predicted(spark, sf).withColumn("residual", F.round(fx.residual("value", "predicted"), 9))
    return rounded(stats.normal_qq(df, "residual", "event_id"), 6, "theoretical", "observed")


@query(
    "e23_residual_moments",
    f"""WITH {PREDICTED} SELECT round(avg(value - predicted), 6) AS mean,
      round(stddev_pop(value - predicted), 6) AS std FROM e""",
)
def e23_residual_moments(spark, sf):
    df = predicted(spark, sf).withColumn("residual", fx.residual("value", "predicted"))
    return rounded(stats.spread(df, "residual"), 6, "mean", "std")


LEVELS = ["click", "error", "purchase", "signup", "view"]


@query(
    "f2_one_hot",
    f"""WITH {SERIES} SELECT event_id, """
    + ", ".join(f"CAST(series = '{v}' AS INTEGER) AS kind_{v}" for v in LEVELS)
    + " FROM series",
)
def f2_one_hot(spark, sf):
    df = series(spark, sf)
    return df.select("event_id", *[c.alias(n) for n, c in fx.one_hot("series", LEVELS, "kind").items()])


@query(
    "j6_columnwise_concat",
    f"""WITH {SERIES} SELECT event_id, ts, value, """
    + ", ".join(f"CAST(series = '{v}' AS INTEGER) AS kind_{v}" for v in LEVELS)
    + " FROM series",
)
def j6_columnwise_concat(spark, sf):
    return series(spark, sf).withColumns(fx.one_hot("series", LEVELS, "kind")).drop("series")


@query(
    "e18_box_stats",
    f"""WITH {SERIES}, q AS (SELECT series, quantile_cont(value, 0.25) AS q1, median(value) AS med,
      quantile_cont(value, 0.75) AS q3 FROM series GROUP BY series),
    w AS (SELECT s.series, value, q1, med, q3,
      value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM series s JOIN q ON s.series = q.series WHERE value IS NOT NULL)
    SELECT series, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
      min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high,
      count(*) FILTER (NOT inside) AS outliers FROM w GROUP BY ALL""",
)
def e18_box_stats(spark, sf):
    return rounded(stats.box_stats(series(spark, sf), "value", ["series"]), 6, "q1", "median", "q3")


@query("e17_histogram_by_class", f"WITH {SERIES}, {histogram_sql('series', 'value', 60, 'series').replace('count(*) AS c FROM series JOIN span USING (series)', 'count(*) AS c FROM series JOIN span USING (series) WHERE value IS NOT NULL')}")
def e17_histogram_by_class(spark, sf):
    return shown(stats.histogram(series(spark, sf), "value", 60, by="series"))
