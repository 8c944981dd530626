"""As-of joins and interpolation, without one global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from perigee.operators.ordering import number_rows
from perigee.sources.scratch import estimated_bytes

#: Bytes of both sides' axes that share a bucket, about, and the most buckets that are cut. The planner knows the axis by its
#: share of compressed files, 3 or 4 bytes a row; a row that is sorted in its bucket takes some 150.
BUCKET_BYTES, MOST_BUCKETS = 2 << 20, 32_768

#: Rows of the axis that tell where to cut, about.
SAMPLED_ROWS = 4_000_000

DAY_MICROS = 86_400_000_000


def axis(time: Column, kind: DataType) -> Column:
    """What is cut into buckets: a number that never falls where the time rises, whatever the session's time zone.

    Times with a zone and without one become microseconds, decimals the nearest DOUBLE; other numbers are taken as they are.
    """
    name = kind.typeName()
    if name == "timestamp":
        return F.unix_micros(time)
    if name == "date":
        return F.datediff(time, F.lit("1970-01-01").cast("date")).cast("long") * DAY_MICROS
    if name == "timestamp_ntz":
        days = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        seconds = (F.hour(time) * 3600 + F.minute(time) * 60).cast("long")
        return days * DAY_MICROS + seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long")
    return time.cast("double") if name == "decimal" else time


def cuts_of(sides: list[DataFrame]) -> list:
    """Where the axis x of both sides is cut, so that buckets hold about equally many rows, however these lie.

    Sides that fit one bucket aren't looked at; of others a sample is read. At most MOST_BUCKETS - 1 values reach the
    driver. Cuts decide on the work of tasks only, never on results.
    """
    size = sum(16 * df.count() if (known := estimated_bytes(df)) is None else known for df in sides)
    wanted = min(size // BUCKET_BYTES + 1, MOST_BUCKETS)
    if wanted == 1:
        return []
    both = sides[0].unionAll(sides[1]).filter("x is not null")
    share = min(1.0, SAMPLED_ROWS * 16 / size)  # a row of the axis is 16 bytes or fewer
    shares = F.split(F.lit(" ".join(str(i / wanted) for i in range(1, wanted))), " ").cast("array<double>")  # one literal
    found = (both.sample(share, 1) if share < 1 else both).agg(F.percentile_approx("x", shares, 5 * wanted)).first()[0]
    return sorted(set(found)) if found else []


def bucket_of(x: Column, cuts: list) -> Column:
    """Number of cuts at or below x, by halving steps; -1 without x."""
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)] if cuts else []
    if not steps:
        return F.when(x.isNull(), -1).otherwise(0)
    kind = "array<bigint>" if isinstance(cuts[0], int) else "array<double>"
    table = F.split(F.lit(" ".join(str(c) for c in cuts)), " ").cast(kind)  # one literal
    found = F.aggregate(F.array(*[F.lit(i) for i in steps]), F.lit(0), lambda at, step: at + F.when(F.get(table, at + step - 1) <= x, step).otherwise(0))
    return F.when(x.isNull(), -1).otherwise(found)


def asof_join(
    primary: DataFrame,
    secondary: DataFrame,
    time_col: str,
    secondary_time_col: str | None = None,
    prefix: str = "secondary",
    by: list[str] | None = None,
    order: list[str] | None = None,
    tolerance: Column | None = None,
    keep_unmatched: bool = False,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Each primary row with the latest secondary row at or before it, by times (with or without a zone), dates or numbers.

    Keeps every primary column and adds the secondary ones as <prefix>_<name>. Secondary rows of equal time are told
    apart by `order` (the last wins). Secondary rows without a time never match; primary rows without one are kept
    unmatched. Time is cut into buckets of about equally many rows (or of bucket_seconds): a window runs inside each
    bucket, and the last secondary row of earlier buckets comes from a table of one row per bucket. A tolerance (an
    interval) drops rows that are unmatched or matched too far back, unless keep_unmatched, which then empties their
    secondary columns.
    """
    second_time = secondary_time_col or time_col
    keys, order = list(by or []), list(order or [])
    names = {c: f"{prefix}_{c}" for c in secondary.columns}
    secondary = secondary.filter(F.col(second_time).isNotNull())
    times = [(primary, F.col(time_col)), (secondary, F.col(second_time))]
    kind = primary.select(time_col).unionAll(secondary.select(second_time)).schema[0].dataType  # the one that both fit
    sides = [axis(time.cast(kind), kind) for _, time in times]
    if bucket_seconds is None:
        cuts = cuts_of([df.select(x.alias("x")) for (df, _), x in zip(times, sides, strict=True)])
        buckets = [bucket_of(x, cuts) for x in sides]
    else:
        cuts, buckets = None, [F.coalesce(F.floor(x / (bucket_seconds * 1_000_000)), F.lit(-(1 << 62))) for x in sides]
    key_cols = [f"_k{i}" for i in range(len(keys))]
    keyed = [F.col(k).alias(c) for k, c in zip(keys, key_cols, strict=True)]
    left = primary.select(F.struct(*primary.columns).alias("_p"), F.col(time_col).cast(kind).alias("_t"), buckets[0].cast("long").alias("_b"), *keyed)
    right = secondary.select(
        F.struct(*[F.col(c).alias(n) for c, n in names.items()]).alias("_s"),
        F.col(second_time).cast(kind).alias("_t"),
        buckets[1].cast("long").alias("_b"),
        *keyed,
        F.struct(F.col(second_time).cast(kind).alias("t"), *order).alias("_o"),
    )
    last = right.groupBy(*key_cols, "_b").agg(F.max_by("_s", "_o").alias("_last"))
    both = left.unionByName(right, allowMissingColumns=True)
    inside = Window.partitionBy(*key_cols, "_b").orderBy("_t", F.col("_p").isNotNull(), "_o").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_m", F.last("_s", ignorenulls=True).over(inside)).filter("_p is not null")
    # One row for each bucket: the last secondary row before it.
    few = cuts is not None and not keys  # then there are MOST_BUCKETS at most
    every = primary.sparkSession.range(len(cuts) + 1).select(F.col("id").alias("_b")) if few else left.select(*key_cols, "_b").distinct()
    earlier = Window.partitionBy(*key_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(last, [*key_cols, "_b"], "left" if few else "full_outer")
    carried = carried.select(*key_cols, "_b", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    match = F.when(F.col("_t").isNotNull(), F.coalesce("_m", "_carried"))
    joined = found.join(F.broadcast(carried) if few else carried, [*key_cols, "_b"], "left").withColumn("_match", match)
    if tolerance is not None:
        near = F.col("_t") - F.col("_match")[names[second_time]] <= tolerance
        joined = joined.withColumn("_match", F.when(near, F.col("_match"))) if keep_unmatched else joined.filter(near)
    return joined.select("_p.*", *[F.col("_match")[n].alias(n) for n in names.values()])


def interpolate(points: DataFrame, curve: DataFrame, x: str, y: str) -> DataFrame:
    """points with the value of a piecewise linear curve (x, y) at their x; 0 outside the curve's range.

    Knots are numbered in order and joined with the next one to segments; each point takes the segment that begins at
    or before it. Of knots at one x the last holds from there on.
    """
    knots = curve.select(F.col(x).cast("double").alias("x0"), F.col(y).cast("double").alias("y0")).filter("x0 is not null")
    knots = number_rows(knots, ["x0", "y0"], "knot")
    after = knots.select((F.col("knot") - 1).alias("knot"), F.col("x0").alias("x1"), F.col("y0").alias("y1"))
    segments = knots.join(after, "knot", "left")
    held = points.withColumn("_at", F.col(x).cast("double"))
    joined = asof_join(held, segments, "_at", "x0", prefix="_c", order=["knot"])
    at, x0, x1, y0, y1 = (F.col(c) for c in ("_at", "_c_x0", "_c_x1", "_c_y0", "_c_y1"))
    inside = F.coalesce((at < x1) | (x1.isNull() & (at == x0)), F.lit(False))
    value = F.when(inside, y0 + F.coalesce((y1 - y0) / (x1 - x0) * (at - x0), F.lit(0.0))).otherwise(0.0)
    return joined.select(*points.columns, value.alias(f"{y}_interpolated"))
