"""Points of telemetry over time: outliers, latest values, history and rejection of implausible ones."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.sources.scratch import FEW_ROWS, gathered, written


def present(points: DataFrame, time_col: str, value_col: str) -> DataFrame:
    """Rows that have a time and a value; NaN is no value."""
    return points.filter(F.col(time_col).isNotNull() & F.col(value_col).isNotNull() & ~F.isnan(value_col))


#: A sketch that brackets percentiles errs by one of so many parts of the rows.
SKETCH_PARTS = 100_000

#: How far a bracket reaches to both sides, as a part of the rows: the least that is four rows or more.
REACHES = (0.000_02, 0.000_2, 0.002, 0.02, 1.0)


def percentiles(points: DataFrame, by: str, value_col: str, shares: list[float]) -> DataFrame:
    """by and bounds: the exact percentiles of each group, linear between ranks, without holding a group in one task.

    The result has a hint to broadcast it if there are few groups. A sketch of bounded size brackets each percentile between two values. What lies below a bracket is only counted;
    the few values inside it are counted by value and added up to the wanted ranks.
    """
    edges = [x for p in shares for r in REACHES for x in (max(p - r, 0.0), min(p + r, 1.0))]
    sketched = points.groupBy(by).agg(F.count(value_col).alias("n"), F.percentile_approx(value_col, edges, SKETCH_PARTS).alias("e"))
    wide = F.coalesce(*[F.when(F.col("n") * r >= 4, 2 * k) for k, r in enumerate(REACHES)], F.lit(2 * len(REACHES) - 2))
    each = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), F.get("e", wide + 2 * len(REACHES) * i).alias("low"), F.get("e", wide + 2 * len(REACHES) * i + 1).alias("high"))
            for i, p in enumerate(shares)
        ]
    )
    brackets = written(sketched.filter("n > 0").select(F.col(by).alias("_by"), "n", F.inline(each)), "brackets")
    near = points.select(F.col(by).alias("_by"), F.col(value_col).alias("v")).filter("v is not null")
    few = brackets.count() <= FEW_ROWS
    near = near.join(F.broadcast(brackets) if few else brackets, "_by").filter("v <= high")
    folded = F.when(F.col("v") >= F.col("low"), F.col("v"))  # null: below the bracket
    counted = near.groupBy("_by", "i", "p", "n", folded.alias("v")).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("_by", "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    rank = F.col("p") * (F.col("n") - 1)
    ranked = counted.withColumn("upto", upto).filter("v is not null").groupBy("_by", "i", rank.alias("rank"))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("v")))
    found = ranked.agg(at(F.floor(rank)).alias("low"), at(F.ceil(rank)).alias("high"))
    above = F.col("rank") - F.floor("rank")
    value = F.when(above == 0, F.col("low")).otherwise((1 - above) * F.col("low") + above * F.col("high"))
    bounds = F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))), lambda x: x["v"])  # one for each share
    result = found.groupBy(F.col("_by").alias(by)).agg(bounds.alias("bounds"))
    return F.broadcast(result) if few else result


def clip_outliers(points: DataFrame, by: str, value_col: str, low: float = 0.005, high: float = 0.995) -> tuple[DataFrame, DataFrame]:
    """Points inside each group's percentiles (inclusive, linear between ranks), and a report of what was removed."""
    bounds = percentiles(points, by, value_col, [low, high])
    marked = points.join(bounds, by).withColumn("inside", F.col(value_col).between(F.col("bounds")[0], F.col("bounds")[1]))
    report = marked.groupBy(by).agg(
        F.count("*").alias("points"), F.count_if(~F.col("inside")).alias("removed"), (100 * F.count_if(~F.col("inside")) / F.count("*")).alias("removed_percent")
    )
    return marked.filter("inside").drop("bounds", "inside"), report


def latest(points: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The newest point of each group, without a sort."""
    rest = [c for c in points.columns if c not in by]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return points.groupBy(*by).agg(newest).select(*by, "newest.*")


def history(points: DataFrame, by: list[str], order: list[str], keep: int = 300) -> DataFrame:
    """The newest `keep` points of each group, with `age_rank` 1 for the newest."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order]))
    return points.withColumn("age_rank", rank).filter(F.col("age_rank") <= keep)


def rolling_sigma(points: DataFrame, by: list[str], order: list[str], value_col: str, window: int = 50, least: int = 12, floor: float = 1e-9) -> DataFrame:
    """Distance of each value from the mean of the raw values before it, in standard deviations; null with too few."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(-window, -1)
    mean, std = F.avg(value_col).over(before), F.greatest(F.stddev_pop(value_col).over(before), F.lit(floor))
    return points.withColumn("sigma", F.when(F.count(value_col).over(before) >= least, F.abs(F.col(value_col) - mean) / std))


#: The source of a packet time that a least time holds for.
HEADER = "ccsds_secondary_header"


def time_limits(last: tuple | None, source: str, received: float, max_jump: float, rate: float, minimum: float) -> tuple[float, float, float]:
    """The least time of a source, and the times around the packet (time, received, source) accepted last.

    Its surroundings grow with the time that has gone by since; a packet of another source has no limits of that kind.
    """
    least = max(minimum, 0.0) if source == HEADER else 0.0
    if last is None or last[2] != source or max_jump <= 0:
        return least, -math.inf, math.inf
    reach = max_jump + max(rate, 0.0) * max(received - last[1], 0.0)
    return least, last[0] - reach, last[0] + reach


def jump_reason(last: tuple | None, time: float, source: str, received: float, max_jump: float, rate: float, minimum: float) -> str | None:
    """Why a packet's time is rejected, given what was accepted last; None if it lies within its limits."""
    least, low, high = time_limits(last, source, received, max_jump, rate, minimum)
    if math.isfinite(time) and max(least, low) <= time <= high:
        return None
    broken = {"not_finite": not math.isfinite(time), "negative": time < 0, "below_minimum": time < least, "jump": True}
    return next(name for name, holds in broken.items() if holds)


def value_limits(accepted: list[float], threshold: float, window: int, least: int, floor: float, relative_floor: float) -> tuple[float, float]:
    """The values that are within threshold standard deviations of the last accepted ones; all, if these are too few."""
    recent = np.array(accepted[-max(1, window) :])
    if threshold <= 0 or len(recent) < max(1, least):
        return -math.inf, math.inf
    spread = threshold * max(float(recent.std()), floor, abs(float(recent.mean())) * relative_floor, 0.0)
    return (float(recent.mean()) - spread, float(recent.mean()) + spread) if spread > 0 else (-math.inf, math.inf)


def ordered_fold(rows: DataFrame, by: str, order: list[str], judge: Callable[[object, tuple], tuple[object, object]], added: str) -> DataFrame:
    """rows with a column `added` ("name type"): judge takes what it has made of a key's rows so far and the next row.

    A key's rows are sorted in their partition and stream by in batches, so only one key's state is held, however many
    rows it has.
    """
    name = added.split()[0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for frame in frames:
            results = []
            for own, row in zip(frame[by], frame.itertuples(index=False), strict=True):
                if own != key:
                    key, state = own, None
                state, result = judge(state, row)
                results.append(result)
            yield frame.assign(**{name: pd.Series(results, index=frame.index, dtype=object)})

    schema = f"{rows.schema.simpleString()[7:-1]},{added.replace(' ', ':')}"
    return gathered(rows, [by], order).mapInPandas(run, schema)


def reject_jumps(packets: DataFrame, by: str, max_jump: float, rate: float = 1.0, minimum: float = 0.0) -> DataFrame:
    """Packets (by, packet_time, time_source, received) with reject_reason, judged in order of receipt.

    What is accepted depends on what was accepted before, which no window expresses; so each key's rows are folded.
    """

    def judge(last: tuple | None, row: tuple) -> tuple[tuple | None, str | None]:
        reason = jump_reason(last, row.packet_time, row.time_source, row.received, max_jump, rate, minimum)
        return (last if reason else (row.packet_time, row.received, row.time_source)), reason

    return ordered_fold(packets, by, ["received", "packet_time"], judge, "reject_reason string")


def reject_outliers(points: DataFrame, by: str, order: str, value_col: str, threshold: float = 4.0, window: int = 50, least: int = 12, floor: float = 0.0, relative_floor: float = 0.0) -> DataFrame:
    """Points with `rejected`, each judged by the accepted ones before it, of which the last `window` are held."""

    def judge(accepted: list[float] | None, row: tuple) -> tuple[list[float], bool]:
        held, value = accepted or [], getattr(row, value_col)
        low, high = value_limits(held, threshold, window, least, floor, relative_floor)
        inside = low <= value <= high
        return ([*held[-(window - 1) :], value] if inside else held), not inside

    return ordered_fold(points, by, [order], judge, "rejected boolean")
