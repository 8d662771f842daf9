"""Duplicates, sampling, data quality and cleaning queries (§2.7, 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumen.operators import quality as Q
from lumen.operators.chartprep import sample_by_key
from lumen.operators.joins import materialize_table
from lumen.plans import roles as R
from lumen.plans.oracle_roles import DIAMONDS, EVENTS, TRIPS, with_
from lumen.plans.registry import query

DEDUP_KEYS = ["year", "month", "day", "carrier", "flight"]
KEEP_ORDER = ["leg", "part_key", "dest", "fare"]

# The de-duplicated trips, in SQL: the first row per key under KEEP_ORDER.
DEDUP_CTE = (", dedup AS (SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY year, month, day, "
             "carrier, flight ORDER BY leg, part_key, dest, fare) AS rk FROM trips) WHERE rk = 1)")


def _dedup(spark, sf):
    t = R.trips(spark, sf)
    return Q.dedup_by_key(t, DEDUP_KEYS, [F.col(c) for c in KEEP_ORDER])


_TRIP_COLS = "year, month, day, flight_date, flight, dest, dep_delay, air_time, leg, part_key, fare, carrier, arr_delay"


@query("dedup_by_key", with_(TRIPS) + DEDUP_CTE + f" SELECT {_TRIP_COLS} FROM dedup")
def dedup_by_key(spark, sf):
    return _dedup(spark, sf).select(*[c.strip() for c in _TRIP_COLS.split(",")])


@query("dedup_report", with_(TRIPS) +
       ", k AS (SELECT DISTINCT year, month, day, carrier, flight FROM trips) SELECT (SELECT count(*) FROM trips) "
       "AS rows_before, (SELECT count(*) FROM k) AS rows_after, (SELECT count(*) FROM trips) - (SELECT count(*) "
       "FROM k) AS duplicates_removed")
def dedup_report(spark, sf):
    return Q.dedup_report(R.trips(spark, sf), DEDUP_KEYS)


@query("sample_hash", with_(DIAMONDS) +
       "SELECT * FROM diamonds WHERE CAST(('0x' || substring(md5(CAST(diamond_id AS VARCHAR)), 1, 4)) AS INTEGER) "
       "% 10 < 1")
def sample_hash(spark, sf):
    """A reproducible ~10 % sample (the reference samples 10 % for plotting)."""
    return sample_by_key(R.diamonds(spark, sf), "diamond_id", 1)


@query("missing_summary", with_(TRIPS) +
       "SELECT 100.0 * count_if(dep_delay IS NULL) / count(*) AS pct_missing_dep_delay, "
       "100.0 * count_if(arr_delay IS NULL) / count(*) AS pct_missing_arr_delay, "
       "100.0 * count_if(air_time IS NULL) / count(*) AS pct_missing_air_time FROM trips")
def missing_summary(spark, sf):
    return Q.missing_summary(R.trips(spark, sf), ["dep_delay", "arr_delay", "air_time"])


@query("mean_vs_median", with_(TRIPS) +
       "SELECT round(avg(arr_delay), 6) AS mean, round(quantile_cont(arr_delay, 0.5), 6) AS median FROM trips")
def mean_vs_median(spark, sf):
    r = Q.mean_vs_median(R.trips(spark, sf), "arr_delay")
    return r.select(F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


_IMPUTED = (with_(TRIPS) + DEDUP_CTE +
            ", med AS (SELECT quantile_cont(dep_delay, 0.5) AS m FROM dedup) "
            ", filled AS (SELECT d.* REPLACE (coalesce(d.dep_delay, CAST(trunc(med.m) AS INTEGER)) AS dep_delay) "
            "FROM dedup d, med)")


def _filled(spark, sf):
    """De-duplicated trips, written once (several statistics read them), with
    dep_delay NULLs filled by their median."""
    d = materialize_table(_dedup(spark, sf))
    return Q.impute_median(d, "dep_delay")


@query("impute_median", _IMPUTED + f" SELECT {_TRIP_COLS} FROM filled")
def impute_median(spark, sf):
    """dep_delay NULLs filled with the median of the de-duplicated trips."""
    return _filled(spark, sf).select(*[c.strip() for c in _TRIP_COLS.split(",")])


@query("iqr_bounds", with_(EVENTS) +
       ", q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ev) "
       "SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
       "round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound FROM q")
def iqr_bounds(spark, sf):
    b = Q.iqr_bounds(R.event_flights(spark, sf), "value")
    return b.select(*[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")])


_FLAGGED_SQL = (with_(EVENTS) +
                ", q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ev), "
                "f AS (SELECT ev.event_id, ev.carrier, ev.value, CASE WHEN ev.value < q1 - 1.5 * (q3 - q1) "
                "OR ev.value > q3 + 1.5 * (q3 - q1) THEN true ELSE false END AS is_outlier FROM ev, q) ")


def _flagged(spark, sf):
    e = R.event_flights(spark, sf)
    return Q.outlier_flag(e, "value", Q.iqr_bounds(e, "value")).select("event_id", "carrier", "value",
                                                                       "is_outlier")


@query("outlier_flag", _FLAGGED_SQL + "SELECT * FROM f")
def outlier_flag(spark, sf):
    return _flagged(spark, sf)


@query("outlier_count", _FLAGGED_SQL + "SELECT CAST(count_if(is_outlier) AS BIGINT) AS outlier_count FROM f")
def outlier_count(spark, sf):
    return Q.outlier_count(_flagged(spark, sf))


_CLEANED_SQL = (_IMPUTED +
                ", q AS (SELECT quantile_cont(arr_delay, 0.25) AS q1, quantile_cont(arr_delay, 0.75) AS q3 "
                "FROM filled), cleaned AS (SELECT filled.*, CASE WHEN arr_delay < q1 - 1.5 * (q3 - q1) OR "
                "arr_delay > q3 + 1.5 * (q3 - q1) THEN true ELSE false END AS is_outlier FROM filled, q) ")


def _cleaned(spark, sf):
    """De-duplicated trips, written once, with dep_delay filled and arr_delay
    flagged from statistics of both columns taken together."""
    return Q.clean_columns(materialize_table(_dedup(spark, sf)), "dep_delay", "arr_delay")


@query("validation_report", _CLEANED_SQL +
       ", s AS (SELECT count(*) AS r0, CAST(count_if(carrier IS NULL) AS BIGINT) AS n1, "
       "CAST(count_if(dep_delay IS NULL) AS BIGINT) AS n2, CAST(count_if(air_time < 0) AS BIGINT) AS g1 FROM cleaned) "
       "SELECT 'row count > 300000' AS rule, r0 AS observed, CASE WHEN r0 > 300000 THEN 'PASS' ELSE 'FAIL' END "
       "AS status FROM s UNION ALL SELECT 'no NULL carrier', n1, CASE WHEN n1 = 0 THEN 'PASS' ELSE 'FAIL' END FROM s "
       "UNION ALL SELECT 'no NULL dep_delay', n2, CASE WHEN n2 = 0 THEN 'PASS' ELSE 'FAIL' END FROM s "
       "UNION ALL SELECT 'no negative air_time', g1, CASE WHEN g1 = 0 THEN 'PASS' ELSE 'FAIL' END FROM s")
def validation_report(spark, sf):
    return Q.validation_report(_cleaned(spark, sf), 300000, ["carrier", "dep_delay"], ["air_time"])


@query("cleaned_trips", _CLEANED_SQL + "SELECT year, month, day, carrier, flight, leg, dep_delay, arr_delay, "
       "is_outlier FROM cleaned")
def cleaned_trips(spark, sf):
    """The whole cleaning flow in one plan: dedup → impute → flag."""
    return _cleaned(spark, sf).select("year", "month", "day", "carrier", "flight", "leg", "dep_delay",
                                      "arr_delay", "is_outlier")
