"""Keyed state over streams: the same rules as the batch folds, one row of state for each key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from perigee.functions.clock import utc_text
from perigee.functions.status import mode_state, power_state
from perigee.operators.series import jump_reason, value_limits

def reject_jumps(packets: DataFrame, by: str, max_jump: float, rate: float = 1.0, minimum: float = 0.0) -> DataFrame:
    """A stream of packets (by, packet_time, time_source, received) with reject_reason.

    State of a key: time, receipt and source of the packet accepted last. Rows of a batch are judged in order of
    receipt.
    """

    def judge(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = tuple(state.get) if state.exists else None
        group = pd.concat(list(frames)).sort_values(["received", "packet_time"])
        reasons = []
        for time, source, received in zip(group["packet_time"], group["time_source"], group["received"], strict=True):
            reason = jump_reason(last, time, source, received, max_jump, rate, minimum)
            if reason is None:
                last = (time, received, source)
            reasons.append(reason)
        if last is not None:
            state.update(last)
        yield group.assign(reject_reason=reasons)

    schema = packets.schema.simpleString()[7:-1] + ",reject_reason:string"
    return packets.groupBy(by).applyInPandasWithState(judge, schema, "time double, received double, source string", "append", GroupStateTimeout.NoTimeout)


def field_history(points: DataFrame, keep: int = 300, threshold: float = 0.0, window: int = 50, least: int = 12, floor: float = 0.0, relative_floor: float = 0.0) -> DataFrame:
    """A stream of points (field, us, value) with rejected, n_history and latest value after each point.

    State of a field: its last `keep` accepted values. A threshold of 0 accepts all.
    """

    def judge(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        accepted = list(state.get[0]) if state.exists else []
        group = pd.concat(list(frames)).sort_values("us")
        rejected, sizes, newest = [], [], []
        for value in group["value"]:
            low, high = value_limits(accepted, threshold, window, least, floor, relative_floor)
            rejected.append(not low <= value <= high)
            if not rejected[-1]:
                accepted = [*accepted[-(keep - 1) :], value]
            sizes.append(len(accepted))
            newest.append(accepted[-1] if accepted else None)
        state.update((accepted,))
        yield group.assign(rejected=rejected, n_history=sizes, latest=newest)

    schema = points.schema.simpleString()[7:-1] + ",rejected:boolean,n_history:int,latest:double"
    return points.groupBy("field").applyInPandasWithState(judge, schema, "accepted array<double>", "append", GroupStateTimeout.NoTimeout)


def without_failed(packets: DataFrame, drop: bool = True) -> DataFrame:
    """packets without those whose checksum was looked at and failed, if these are to be dropped."""
    return packets.filter("checksum_status is null or checksum_status <> 'failed'") if drop else packets


def counters(packets: DataFrame) -> DataFrame:
    """Running counts of packets by name: seen, by status, with a failed checksum, and rejected for their time.

    The same function counts a table or a stream (in update or complete mode).
    """
    return packets.groupBy("packet_name").agg(
        F.count("*").alias("seen"),
        F.count_if(F.col("status") == "decoded").alias("decoded"),
        F.count_if(F.col("status") == "no_decoder").alias("no_decoder"),
        F.count_if(F.col("status") == "decode_failed").alias("failed"),
        F.count_if(F.col("checksum_status") == "failed").alias("checksum_failed"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("time_rejected"),
    )


def with_staleness(latest: DataFrame, now: object, after_seconds: float = 10.0) -> DataFrame:
    """Latest points (received in seconds) with age and stale at a moment."""
    age = F.lit(now) - F.col("received")
    return latest.withColumn("age", age).withColumn("stale", age > after_seconds)


# The labelled fields of the beacon that tell the state of the spacecraft.
BEACON_STATES = [
    ("CDH", "beac_mode_system_mode", "mode"),
    ("ADCS", "beac_eps_pwr_state_adcs", "power"),
    ("UHF", "beac_eps_pwr_state_uhf", "power"),
    ("X-Band", "beac_eps_pwr_state_xband", "power"),
    ("CSIE", "beac_eps_pwr_state_csie", "power"),
    ("DSPS", "beac_eps_pwr_state_dsps", "power"),
]


def beacon_states(packets: DataFrame) -> DataFrame:
    """label, field, value, state and received_time of the newest decoded beacon that has any of the state fields.

    packets: packet_name, status, fields (map of texts), received_time. No row if there is no such beacon.
    """
    has_any = F.exists(F.array(*[F.lit(f) for _, f, _ in BEACON_STATES]), lambda f: F.try_element_at("fields", f).isNotNull())
    beacons = packets.filter((F.lower("packet_name") == "beacon") & (F.col("status") == "decoded") & has_any)
    newest = beacons.agg(F.max_by(F.struct("fields", "received_time"), "received_time").alias("n")).filter("n is not null")
    each = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(a).alias("label"), F.lit(f).alias("field"), F.lit(k).alias("kind")) for i, (a, f, k) in enumerate(BEACON_STATES)])
    rows = newest.select("n.*", F.inline(each)).withColumn("value", F.try_element_at("fields", F.col("field")))
    state = F.when(F.col("kind") == "mode", mode_state(F.col("value"))["state"]).otherwise(power_state(F.col("value")))
    return rows.select("position", "label", "field", "value", state.alias("state"), "received_time")


def last_packet(packets: DataFrame, order: list[str], most_reasons: int = 5) -> DataFrame:
    """The record of the newest packet: its columns, whether its time was accepted, and its first filter reasons."""
    row = packets.agg(F.max_by(F.struct(*packets.columns), F.struct(*order)).alias("p")).select("p.*")
    row = row.withColumn("time_status", F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected"))
    return row.withColumn("filter_reasons", F.slice("filter_reasons", 1, most_reasons))


def onboard_clock(packets: DataFrame, order: list[str]) -> DataFrame:
    """UTC text of the accepted packet that came last."""
    accepted = packets.filter("reject_reason is null")
    return accepted.agg(F.max_by("packet_time", F.struct(*order)).alias("t")).select(utc_text(F.col("t")).alias("onboard_utc"))


def since_clear(points: DataFrame, clears: DataFrame, order: str) -> DataFrame:
    """The points that came after the last clearing (order): what latest values and histories are made of.

    Counters are made of all points, so a clearing leaves them as they are.
    """
    last = clears.agg(F.max(order).alias("_cleared"))
    return points.join(F.broadcast(last), F.col("_cleared").isNull() | (F.col(order) > F.col("_cleared"))).drop("_cleared")  # one row
