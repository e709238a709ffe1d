"""Conformed facts and staging tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timing import day_text, hour_text, seconds_between, stamp_text
from ..functions.values import exact_sum, in_interval, net_of_pct
from ..operators.grouping import summarise
from ..operators.intervals import exclude_intervals
from ..operators.joins import enrich, keep_if_exists, lookup_chain, null_safe_join
from ..operators.quality import Gates, counted, publish
from ..operators.ranking import keep_latest
from ..operators.rowwise import normalise_keys, route
from ..operators.timeline import gap_sessions

# Names, order and types of the published columns.
APP_SESSION = (
    "session_id string, device_id string, platform string, session_date string, "
    "session_start_ts string, session_end_ts string, n_events bigint, duration_sec bigint"
)
DEVICE_HOUR = (
    "device_id string, reading_hour string, site_id string, n_readings bigint, "
    "avg_temp_c double, max_temp_c double"
)
STAGED_REQUEST = (
    "request_id string, store_code string, sku string, pack_code string, dc_code string, "
    "qty_units int, load_status string, reject_reason string"
)
TRIP_PAYOUT = (
    "trip_id string, driver_id string, fleet_id string, trip_date string, fare_cents bigint, "
    "driver_earning_cents bigint, first_seen_date string, load_status string"
)


def app_sessions(
    events: DataFrame, catalog: DataFrame, devices: DataFrame, gap: timedelta = timedelta(minutes=30)
) -> DataFrame:
    """One row per engagement session of a device.

    The session's own first event gives its id and date, so a run over midnight stays one session.
    """
    engaging = catalog.filter("is_engagement").select("event_name")
    engaged = keep_if_exists(events.select("device_id", "event_ts", "event_name"), engaging, "event_name")
    engaged, before = counted(engaged, {"rows": F.count(F.lit(1))})
    timed = engaged.select("device_id", F.col("event_ts").cast("timestamp_ntz").alias("_at"))
    sessions = gap_sessions(timed, ["device_id"], "_at", gap)
    named = enrich(sessions, devices, "device_id", {"platform": "UNKNOWN"})
    start = F.col("session_start")
    out = named.select(
        F.concat_ws("-", "device_id", F.date_format(start, "yyyyMMddHHmmss")).alias("session_id"),
        "device_id",
        "platform",
        day_text(start).alias("session_date"),
        stamp_text(start).alias("session_start_ts"),
        stamp_text("session_end").alias("session_end_ts"),
        "n_events",
        seconds_between(start, F.col("session_end")).alias("duration_sec"),
    )
    gates = Gates(
        unique=["session_id"],
        not_null=["session_id", "device_id", "platform", "session_date"],
        totals={"engagement events": (F.coalesce(F.sum("n_events"), F.lit(0)), lambda: before("rows"))},
        ddl=APP_SESSION,
    )
    return publish(out, gates, "app_session")


def device_hours(
    readings: DataFrame,
    registry: DataFrame,
    windows: DataFrame,
    width: timedelta = timedelta(days=1),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Hourly telemetry: resends collapsed, in-service devices only, maintenance time excluded.

    A resend is the same device and reading time under a new message id; the last one to arrive counts.
    """
    slim = readings.select("event_id", "device_id", "reading_ts", "temp_c", "ingest_ts")
    once = keep_latest(slim, ["device_id", "reading_ts"], ["ingest_ts", "event_id"])
    known = once.join(
        registry.select("device_id", "site_id", "installed_on", "decommissioned_on"), "device_id"
    )
    in_service = known.filter(
        in_interval(
            F.col("reading_ts").cast("date"),
            F.col("installed_on").cast("date"),
            F.col("decommissioned_on").cast("date"),
        )
    ).withColumn("_at", F.col("reading_ts").cast("timestamp_ntz"))
    closed = windows.select(
        "device_id",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
    )
    valid = exclude_intervals(in_service, closed, ["device_id"], "_at", "window_start", "window_end", width, hot=hot)
    hourly = {
        "n_readings": F.count(F.lit(1)),
        "avg_temp_c": exact_sum("temp_c") / F.count("temp_c"),
        "max_temp_c": F.max("temp_c"),
    }
    hour = hour_text(stamp_text("_at")).alias("reading_hour")
    out = summarise(valid, ["device_id", hour, "site_id"], hourly)
    gates = Gates(
        unique=["device_id", "reading_hour"],
        not_null=["device_id", "reading_hour", "site_id"],
        ddl=DEVICE_HOUR,
    )
    return publish(out, gates, "device_hour")


def staged_requests(
    requests: DataFrame, stores: DataFrame, skus: DataFrame, packs: DataFrame
) -> DataFrame:
    """Every landed request once, accepted with its payload or quarantined with one reason.

    Each rule reads the table that owns its fact; a NULL pack code is a pack code.
    """
    landed, before = counted(requests, {"rows": F.count(F.lit(1))})
    tidy = normalise_keys(landed, ["store_code", "sku", "pack_code"])
    looked_up = lookup_chain(
        tidy, [(stores, "store_code", ["dc_code"]), (skus, "sku", ["sku_status"])]
    ).withColumnRenamed("dc_code", "_dc")
    packed = null_safe_join(
        looked_up,
        packs.select("sku", "pack_code", "units_per_case"),
        ["sku", "pack_code"],
        ["pack_code"],
    )
    rules = [
        ("UNKNOWN_STORE", F.col("_dc").isNull()),
        ("UNKNOWN_SKU", F.col("sku_status").isNull()),
        ("DISCONTINUED_SKU", F.col("sku_status") == "DISCONTINUED"),
    ]
    payload = {"dc_code": F.col("_dc"), "qty_units": F.col("qty_cases") * F.col("units_per_case")}
    out = route(packed, rules, payload).select(
        "request_id",
        "store_code",
        "sku",
        "pack_code",
        "dc_code",
        "qty_units",
        "load_status",
        "reject_reason",
    )
    accepted = F.col("load_status") == "ACCEPTED"
    has_reason = F.col("reject_reason").isNotNull()
    dc, qty = F.col("dc_code"), F.col("qty_units")
    gates = Gates(
        unique=["request_id"],
        not_null=["request_id", "load_status"],
        violations={
            "accepted without payload or with a reason": accepted
            & (dc.isNull() | qty.isNull() | has_reason),
            "quarantined with payload or without a reason": ~accepted
            & (dc.isNotNull() | qty.isNotNull() | ~has_reason),
        },
        totals={"requests": (F.count(F.lit(1)), lambda: before("rows"))},
        ddl=STAGED_REQUEST,
    )
    return publish(out, gates, "staged_request")


def trip_candidates(landed: DataFrame, pending: DataFrame) -> DataFrame:
    """New trips and the ones held back earlier, each with the day it was first seen."""
    cols = ["trip_id", "driver_id", "completed_ts", "fare_cents"]
    return landed.select(*cols, F.col("landing_date").alias("first_seen_date")).unionByName(
        pending.select(*cols, "first_seen_date")
    )


def resolve_trips(
    candidates: DataFrame, drivers: DataFrame, commissions: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Publish what can be paid and park the rest; ``keep`` names further columns to carry along.

    Whether a trip can be paid is asked of the commission itself, the column the payout is computed
    from; a hit on the driver or on the fleet alone proves nothing.
    """
    priced = lookup_chain(
        candidates,
        [(drivers, "driver_id", ["fleet_id"]), (commissions, "fleet_id", ["commission_pct"])],
    )
    earning = net_of_pct(F.col("fare_cents"), F.col("commission_pct"))
    settled = route(
        priced,
        [("NO_COMMISSION", F.col("commission_pct").isNull())],
        {"driver_earning_cents": earning},
        passed="PUBLISHED",
        held="PENDING",
    )
    dated = settled.withColumn("trip_date", F.left(F.col("completed_ts").cast("string"), F.lit(10)))
    return dated.select(*[c.split()[0] for c in TRIP_PAYOUT.split(", ")], *keep)


def trip_payouts(
    landed: DataFrame, pending: DataFrame, drivers: DataFrame, commissions: DataFrame
) -> DataFrame:
    """Nightly payout resolution.  Empty inputs are a normal night."""
    offered, before = counted(trip_candidates(landed, pending), {"rows": F.count(F.lit(1))})
    out = resolve_trips(offered, drivers, commissions)
    published = F.col("load_status") == "PUBLISHED"
    earned = F.col("driver_earning_cents").isNotNull()
    gates = Gates(
        unique=["trip_id"],
        violations={"status against payout": published != earned},
        totals={"candidates": (F.count(F.lit(1)), lambda: before("rows"))},
        ddl=TRIP_PAYOUT,
    )
    return publish(out, gates, "trip_payout")
