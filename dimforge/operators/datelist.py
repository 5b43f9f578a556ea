"""Datelists and bit-packed activity history.

A datelist row holds, newest first, one slot per day since the entity was
first seen: the date when it was active, NULL when not (the position is
"days ago").  Entities whose key is NULL never match a previous row, so each
(NULL key, day) is its own row, as with a SQL ``=`` join.

* ``datelist_step`` — yesterday's snapshot FULL OUTER JOIN today's activity.
* ``datelist_backfill`` — the snapshot(s) after running the step for every
  day ``lo..hi``: one exchange (the entity's set of active days, partially
  de-duplicated before the shuffle), then the padded array is built in
  linear time from the sorted days.
* ``datelist_bits`` / ``bits_direct`` — the last 31 days as an integer
  (bit 30 = the snapshot day), from a datelist or straight from events.
* ``bits_step`` — the integer of a day from that of the day before;
  ``recent_days`` counts the active ones of its last days.
* ``datelist_map`` / ``datelist_unmap`` / ``datelist_map_step`` — one row per
  user with ``MAP(browser -> dates)``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.functions.bits import HISTORY_WIDTH, bits_text, day_bit, popcount
from dimforge.functions.scalars import day_of
from dimforge.operators.joins import full_outer


def _date(d) -> Column:
    return F.lit(d).cast("date") if not isinstance(d, Column) else d


def check_width(lo, hi, width: int) -> None:
    """A history of ``width`` bits must hold every day of ``lo..hi``."""
    if not 1 <= width <= 63:
        raise ValueError(f"width must be 1 to 63, not {width}")
    days = (dt.date.fromisoformat(str(hi)) - dt.date.fromisoformat(str(lo))).days + 1
    if days > width:
        raise ValueError(f"{days} days ({lo} to {hi}) do not fit {width} bits")


def _null_key(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def active_days(events: DataFrame, *, keys: Sequence[str], ts_col: str, lo, hi) -> DataFrame:
    """(keys, day) of activity within ``lo..hi`` (the day filter is a range
    on the timestamp, pushed to the scan)."""
    day = day_of(ts_col)
    return events.where(day.between(_date(lo), _date(hi))).select(*keys, day.alias("_day"))


def datelist_step(prev: DataFrame | None, events: DataFrame, *, keys: Sequence[str], ts_col: str, day,
                  dates_col: str = "dates_active", snapshot_col: str = "curr_date") -> DataFrame:
    """Snapshot of ``day`` from the snapshot of the day before.

    ``prev`` should be a stored partition (or a ``checkpoint()``): the step
    reads it more than once, so chaining steps in memory grows the plan
    with every day."""
    d = _date(day)
    today = (events.where(day_of(ts_col) == d).select(*keys).distinct()
                   .withColumn("event_date", d))
    if prev is None:
        return today.select(*keys, F.array("event_date").alias(dates_col), d.alias(snapshot_col))
    def project(y, t):
        dates = (F.when(y(dates_col).isNotNull(), F.concat(F.array(t("event_date")), y(dates_col)))
                  .otherwise(F.array(t("event_date"))))
        return [*[F.coalesce(y(k), t(k)).alias(k) for k in keys], dates.alias(dates_col), d.alias(snapshot_col)]

    return full_outer(prev.select(*keys, dates_col), today, keys, project)


def pad_days(desc_days: Column, as_of: Column) -> Column:
    """Distinct days sorted newest first -> positional datelist ending at the
    earliest day: slot i holds ``as_of - i`` when active, else NULL.  Built
    from the gaps between consecutive days (linear in the array)."""
    n = F.size(desc_days)
    null_day = F.lit(None).cast("date")

    def piece(i):
        gap = F.coalesce(F.datediff(F.get(desc_days, i - 1), F.get(desc_days, i)) - 1,
                         F.datediff(as_of, F.get(desc_days, 0)))
        return F.concat(F.array_repeat(null_day, gap), F.array(F.get(desc_days, i)))

    return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), piece))


def datelist_backfill(events: DataFrame, *, keys: Sequence[str], ts_col: str, lo, hi,
                      snapshots: str = "last", pad_nulls: bool = True, null_keys: str = "keep",
                      dates_col: str = "dates_active", snapshot_col: str = "curr_date") -> DataFrame:
    """Datelist snapshot(s) after loading every day ``lo..hi`` from an empty table."""
    days = active_days(events, keys=keys, ts_col=ts_col, lo=lo, hi=hi)
    hi_d = _date(hi)
    if null_keys == "drop":
        days = days.where(~_null_key(keys))
    elif null_keys != "keep":
        raise ValueError("null_keys must be 'keep' or 'drop'")
    # One pass, one exchange: a row with a NULL key never matches, so each
    # (NULL key, day) is its own entity — grouped by the day as well.
    days = days.withColumn("_nk", F.when(_null_key(keys), F.col("_day")))
    known = days.groupBy(*keys, "_nk").agg(F.sort_array(F.collect_set("_day"), asc=False).alias("_ds"))

    # The positional array is built once per entity; every snapshot is a
    # suffix of it (slot i of snapshot s is day s - i).
    if pad_nulls:
        known = known.select(*keys, "_ds", pad_days(F.col("_ds"), hi_d).alias("_full"))
    if snapshots == "last":
        snap = known.withColumn("_s", hi_d)
    elif snapshots == "all":
        snap = known.withColumn("_s", F.explode(F.sequence(F.element_at("_ds", -1), hi_d)))
    else:
        raise ValueError("snapshots must be 'all' or 'last'")

    if pad_nulls:
        skip = F.datediff(hi_d, F.col("_s"))
        dates = F.slice("_full", skip + 1, F.size("_full") - skip)
    else:
        dates = F.filter("_ds", lambda x: x <= F.col("_s"))
    return snap.select(*keys, dates.alias(dates_col), F.col("_s").alias(snapshot_col))


def datelist_bits(dl: DataFrame, *, keys: Sequence[str] = ("user_id",), lo, hi,
                  dates_col: str = "dates_active", snapshot_col: str = "curr_date",
                  width: int = HISTORY_WIDTH) -> DataFrame:
    """Per key: Σ 2^(width-1 - days ago) over active days in ``lo..hi``.

    Computed per row from the array (no explode), then summed per key, so a
    key spread over several rows (NULL) is merged as in a GROUP BY."""
    check_width(lo, hi, width)
    lo_d, hi_d = _date(lo), _date(hi)
    in_window = F.array_distinct(F.filter(dates_col, lambda d: d.isNotNull() & d.between(lo_d, hi_d)))
    row_bits = F.aggregate(in_window, F.lit(0).cast("bigint"),
                           lambda acc, d: acc + day_bit(d, F.col(snapshot_col), width))
    g = dl.groupBy(*keys).agg(F.sum(row_bits).cast("bigint").alias("history_int"))
    return g.select(*keys, "history_int", bits_text(F.col("history_int")).alias("hist_in_binary"),
                    popcount(F.col("history_int"), width).alias("num_days_active"))


def bits_direct(events: DataFrame, *, keys: Sequence[str] = ("user_id",), ts_col: str, lo, hi,
                width: int = HISTORY_WIDTH) -> DataFrame:
    """The same integers straight from the events: ``bit_or`` of day bits,
    partially aggregated before the single exchange (hot keys are safe)."""
    check_width(lo, hi, width)
    days = active_days(events, keys=keys, ts_col=ts_col, lo=lo, hi=hi)
    g = days.groupBy(*keys).agg(F.bit_or(day_bit(F.col("_day"), _date(hi), width)).alias("history_int"))
    return g.select(*keys, "history_int", bits_text(F.col("history_int")).alias("hist_in_binary"),
                    popcount(F.col("history_int"), width).alias("num_days_active"))


def bits_step(prev: DataFrame | None, events: DataFrame, *, keys: Sequence[str] = ("user_id",), ts_col: str, day,
              width: int = HISTORY_WIDTH, keep_inactive: bool = False) -> DataFrame:
    """Bit history of ``day`` from that of the day before: every integer moves
    one day down, and users seen today get the top bit.  No date array is read
    or kept, so a row is a key and 8 bytes whatever the history.

    ``prev``: keys and ``history_int`` (a stored partition, bucketed or not);
    None on the first day.  As in a GROUP BY, the NULL key is one key.  Users
    whose last active day has left the window go, unless ``keep_inactive``."""
    check_width(day, day, width)
    top = F.lit(1 << (width - 1)).cast("bigint")
    today = active_days(events, keys=keys, ts_col=ts_col, lo=day, hi=day).select(*keys).distinct()
    if prev is None:
        out = today.withColumn("history_int", top)
    else:
        moved = prev.select(*keys, F.shiftright("history_int", 1).alias("history_int"))
        null = _null_key(keys)

        def project(p, t):
            seen = F.when(t("_today"), top).otherwise(F.lit(0).cast("bigint"))
            return [*[F.coalesce(p(k), t(k)).alias(k) for k in keys],
                    F.coalesce(p("history_int"), F.lit(0).cast("bigint")).bitwiseOR(seen).alias("history_int")]

        known = full_outer(moved.where(~null), today.where(~null).withColumn("_today", F.lit(True)), keys, project,
                           keys_not_null=True)
        rest = moved.where(null).unionByName(today.where(null).withColumn("history_int", top))
        out = known.unionByName(rest.groupBy(*keys).agg(F.bit_or("history_int").alias("history_int")))
    return out if keep_inactive else out.where(F.col("history_int") != 0)


def recent_days(col, days: int, width: int = HISTORY_WIDTH) -> Column:
    """Active days among the last ``days`` of a bit history."""
    if not 1 <= days <= width:
        raise ValueError(f"a history of {width} bits does not hold {days} days")
    mask = ((1 << days) - 1) << (width - days)
    return F.bit_count(col.bitwiseAND(F.lit(mask).cast("bigint"))).cast("bigint")


# --- MAP(browser -> dates) form -------------------------------------------
#
# A NULL map key is stored as '' (a map cannot hold it).  Rows with a NULL key
# follow the array form: ``null_keys='keep'`` gives each its own row (it never
# matches another), ``'drop'`` leaves them out.

NO_MAP_KEY = ""


def _keep(df: DataFrame, key: str, null_keys: str) -> DataFrame:
    if null_keys not in ("keep", "drop"):
        raise ValueError("null_keys must be 'keep' or 'drop'")
    return df if null_keys == "keep" else df.where(F.col(key).isNotNull())


def datelist_map(dl: DataFrame, *, key: str = "user_id", map_key: str = "browser_type",
                 dates_col: str = "dates_active", snapshot_col: str = "curr_date",
                 map_col: str = "dates_by_browser", null_keys: str = "keep") -> DataFrame:
    """One row per key with a map from ``map_key`` to its datelist."""
    rows = _keep(dl, key, null_keys).withColumn(
        "_own", F.when(F.col(key).isNull(), F.struct(map_key, dates_col)))
    entry = F.struct(F.coalesce(map_key, F.lit(NO_MAP_KEY)).alias(map_key), F.col(dates_col))
    return (rows.groupBy(key, snapshot_col, "_own").agg(F.map_from_entries(F.collect_list(entry)).alias(map_col))
                .select(key, snapshot_col, map_col))


def datelist_unmap(dm: DataFrame, *, key: str = "user_id", map_key: str = "browser_type",
                   dates_col: str = "dates_active", snapshot_col: str = "curr_date",
                   map_col: str = "dates_by_browser", keep: Sequence[Column] = ()) -> DataFrame:
    """Back to one row per (key, map key): ``explode`` of a map yields key and
    value.  ``keep``: further columns of the map row."""
    return dm.select(key, *keep, F.explode(map_col).alias(map_key, dates_col), snapshot_col)


def datelist_map_step(prev: DataFrame | None, events: DataFrame, *, key: str, map_key: str, ts_col: str,
                      day, snapshot_col: str = "curr_date", map_col: str = "dates_by_browser",
                      null_keys: str = "keep") -> DataFrame:
    """One day of the map form: every browser already in the map gets today's
    date or NULL prepended; a browser first seen today gets ``[today]``."""
    d = _date(day)
    today = (_keep(events.where(day_of(ts_col) == d), key, null_keys)
             .select(key, F.coalesce(map_key, F.lit(NO_MAP_KEY)).alias(map_key)).distinct()
             .withColumn("_own", F.when(F.col(key).isNull(), F.col(map_key)))
             .groupBy(key, "_own").agg(F.map_from_entries(F.collect_list(F.struct(map_key, d))).alias("_t"))
             .select(key, "_t"))
    if prev is None:
        return today.select(key, F.transform_values("_t", lambda k, v: F.array(v)).alias(map_col),
                            d.alias(snapshot_col))
    empty_prev = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<date>>"))
    empty_today = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<date>"))

    def project(p, t):
        merged = F.map_zip_with(F.coalesce(p(map_col), empty_prev), F.coalesce(t("_t"), empty_today),
                                lambda k, old, new: F.when(old.isNull(), F.array(new))
                                                     .otherwise(F.concat(F.array(new), old)))
        return [F.coalesce(p(key), t(key)).alias(key), merged.alias(map_col), d.alias(snapshot_col)]

    return full_outer(_keep(prev.select(key, map_col), key, null_keys), today, [key], project)
