"""Limit rules on telemetry values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.status import band_state, general_format, number_or_null, rule_matches
from perigee.sources.scratch import small


def evaluate_limits(points: DataFrame, bands: DataFrame, rules: DataFrame) -> DataFrame:
    """points (field, value, …) with state and reason.

    A field's red and yellow band counts if it has one (item, rl, yl, yh, rh); else the first rule that matches, in
    order of ordinal (item, ordinal, op, expected, state); else the state is unknown. Both rule tables are broadcast.
    """
    band = bands.select("item", F.lit(True).alias("has_band"), "rl", "yl", "yh", "rh")
    each = rules.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("ordinal", "op", "expected", "state"))).alias("rules"))  # of one item
    joined = points.join(small(band), points.field == F.col("item"), "left").drop("item")
    joined = joined.join(small(each), points.field == F.col("item"), "left").drop("item")
    first = F.get(F.filter("rules", lambda r: rule_matches(F.col("value"), r["op"], r["expected"])), F.lit(0))
    joined = joined.withColumn("first", first).withColumn("banded", band_state(F.col("value"), *[F.col(c) for c in ("rl", "yl", "yh", "rh")]))
    state = F.when(F.col("has_band"), F.col("banded.state")).when(F.col("first").isNotNull(), F.col("first.state")).otherwise("unknown")
    reason = (
        F.when(F.col("has_band"), F.col("banded.reason"))
        .when(F.col("first").isNotNull(), F.concat_ws(" ", F.lit("value"), "first.op", general_format(F.col("first.expected"))))
        .when(F.col("rules").isNotNull(), "no value rule matched")
        .otherwise("no color limit configured")
    )
    return joined.select(*points.columns, state.alias("limit_state"), reason.alias("limit_reason"))


# States that a value rule may give.
STATES = ["green", "yellow", "red", "unknown"]


def limit_rules(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Red and yellow bands (item, rl, yl, yh, rh) and value rules (item, ordinal, op, expected, state) of XML files.

    Nodes that aren't enabled or have no item are left out, limits that are no numbers are null, value rules without a
    number are left out, and states that aren't known become unknown. Of several bands of an item the last counts.
    Value rules keep their order in the file.
    """

    def nodes(tag: str, names: list[str]) -> DataFrame:
        schema = ", ".join(f"_{n} string" for n in ["item", "enabled", *names])
        rows = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
        rows = rows.withColumn("ordinal", F.monotonically_increasing_id()).withColumn("item", F.trim("_item"))
        on = ~F.coalesce(F.lower(F.trim("_enabled")).isin("false", "0", "no"), F.lit(False))
        return rows.filter(on & (F.col("item") != ""))

    def number(name: str) -> Column:
        return number_or_null(F.col(f"_{name}")).alias(name)

    names = ["rl", "yl", "yh", "rh"]
    bands = nodes("monitorRedYellow", names).select("item", "ordinal", *[number(n) for n in names])
    bands = bands.groupBy("item").agg(F.max_by(F.struct(*names), "ordinal").alias("b")).select("item", "b.*")
    state = F.lower(F.trim(F.coalesce("_color", F.lit("unknown"))))
    rules = nodes("monitorValue", ["operator", "value", "color"]).select(
        "item",
        "ordinal",
        F.trim(F.coalesce("_operator", F.lit("=="))).alias("op"),
        number_or_null(F.col("_value")).alias("expected"),
        F.when(state.isin(STATES), state).otherwise("unknown").alias("state"),
    )
    return bands, rules.filter("expected is not null")
