"""Queries over telemetry points: events as fields (event_type) of packets (u0 to u6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions import clock, status
from perigee.operators import limits, series
from perigee.plans.base import query
from perigee.plans.fixtures import table

POINTS_SQL = """
points AS (
    SELECT event_id, event_type AS field, 'u' || user_id % 7 AS packet_name, ts, epoch_us(ts) AS us, value FROM events)"""
POINTS = "WITH " + POINTS_SQL.strip()


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point for each event."""
    name = F.concat(F.lit("u"), F.col("user_id") % 7)
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("field"), name.alias("packet_name"), "ts", F.unix_micros("ts").alias("us"), "value")


@query("p3_time_bounds", POINTS + " SELECT event_id, value FROM points WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-09 12:00:00'")
def p3_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from perigee.operators.store import bounded

    return bounded(points(spark, sf_dir), ["event_id", "value"], "ts", "2024-01-05", "2024-01-09 12:00:00")


@query("p9_packet_wildcards", POINTS + " SELECT event_id FROM points WHERE regexp_matches(packet_name, '^(u[1-3]|.4)$')")
def p9_packet_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).filter(status.packet_selected(F.col("packet_name"), ["U[1-3]", "?4"])).select("event_id")


@query("p10_field_wildcards", POINTS + " SELECT event_id, field FROM points WHERE (field LIKE '%e%' OR field LIKE 's%') AND field NOT LIKE '%err%'")
def p10_field_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).filter(status.field_selected(F.col("field"), ["*e*", "s*"], ["*ERR*"])).select("event_id", "field")


@query("p11_ignore_list", POINTS + " SELECT event_id FROM points WHERE NOT (event_id % 600 IN (7, 16) OR field LIKE 'click%')")
def p11_ignore_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    ignored = status.packet_ignored(F.col("event_id") % 600, F.col("field"), [7, 16], ["click*"])
    return points(spark, sf_dir).filter(~ignored).select("event_id")


CLIP = POINTS + """,
bounds AS (SELECT field, quantile_cont(value, 0.005) AS low, quantile_cont(value, 0.995) AS high FROM points GROUP BY field)"""


@query("p14_percentile_clip", CLIP + " SELECT event_id, field, value FROM points JOIN bounds USING (field) WHERE value BETWEEN low AND high")
def p14_percentile_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.present(points(spark, sf_dir), "ts", "value")
    return series.clip_outliers(rows, "field", "value")[0].select("event_id", "field", "value")


@query(
    "a20_outlier_report",
    CLIP + """
SELECT field, count(*) AS points, count(*) FILTER (value < low OR value > high) AS removed,
       round(100.0 * count(*) FILTER (value < low OR value > high) / count(*), 6)::DOUBLE AS removed_percent
FROM points JOIN bounds USING (field) GROUP BY field""",
)
def a20_outlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = series.clip_outliers(points(spark, sf_dir), "field", "value")[1]
    return report.withColumn("removed_percent", F.round("removed_percent", 6))


@query(
    "p15_number_coercion",
    """
SELECT event_id, CASE WHEN isfinite(n) THEN n END AS number
FROM (SELECT event_id, TRY_CAST(CASE event_id % 5 WHEN 0 THEN 'x' || value WHEN 1 THEN 'NaN' WHEN 2 THEN '' ELSE value::VARCHAR END AS DOUBLE) AS n FROM events)""",
)
def p15_number_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, text = F.col("event_id") % 5, F.col("value").cast("string")
    odd = F.when(at == 0, F.concat(F.lit("x"), text)).when(at == 1, "NaN").when(at == 2, "").otherwise(text)
    return points(spark, sf_dir).select("event_id", status.number_or_null(odd).alias("number"))


@query("w10_history", POINTS + " SELECT field, event_id, row_number() OVER (PARTITION BY field ORDER BY us DESC, event_id DESC)::INT AS age_rank FROM points QUALIFY age_rank <= 300")
def w10_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.history(points(spark, sf_dir), ["field"], ["us", "event_id"]).select("field", "event_id", "age_rank")


@query("w11_latest", POINTS + " SELECT field, event_id, packet_name, value FROM points QUALIFY row_number() OVER (PARTITION BY field ORDER BY us DESC, event_id DESC) = 1")
def w11_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.latest(points(spark, sf_dir), ["field"], ["us", "event_id"]).select("field", "event_id", "packet_name", "value")


@query(
    "w15_rolling_sigma",
    POINTS + """
SELECT event_id, round(CASE WHEN count(value) OVER w >= 12 THEN abs(value - avg(value) OVER w) / greatest(stddev_pop(value) OVER w, 1e-9) END, 6) AS sigma
FROM points WINDOW w AS (PARTITION BY field ORDER BY us, event_id ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""",
)
def w15_rolling_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rolling_sigma(points(spark, sf_dir), ["field"], ["us", "event_id"], "value").select("event_id", F.round("sigma", 6).alias("sigma"))


BANDS = [("view", 1.0, 5.0, 40.0, 90.0), ("error", None, 10.0, None, 60.0)]
RULES = [("click", 0, ">", 50.0, "red"), ("click", 1, "<=", 1.0, "yellow"), ("click", 2, "~", 5.0, "red"), ("signup", 0, "==", -1.0, "green")]


@query(
    "j7_limit_rules",
    POINTS + """
SELECT event_id, field, CASE
    WHEN field = 'view' THEN CASE WHEN value < 1 OR value > 90 THEN 'red' WHEN value < 5 OR value > 40 THEN 'yellow' ELSE 'green' END
    WHEN field = 'error' THEN CASE WHEN value > 60 THEN 'red' WHEN value < 10 THEN 'yellow' ELSE 'green' END
    WHEN field = 'click' AND value > 50 THEN 'red' WHEN field = 'click' AND value <= 1 THEN 'yellow' ELSE 'unknown' END AS limit_state,
  CASE WHEN field = 'view' THEN CASE WHEN value < 1 THEN 'value < red low (1)' WHEN value > 90 THEN 'value > red high (90)'
                WHEN value < 5 THEN 'value < yellow low (5)' WHEN value > 40 THEN 'value > yellow high (40)' ELSE 'within green range' END
       WHEN field = 'error' THEN CASE WHEN value > 60 THEN 'value > red high (60)' WHEN value < 10 THEN 'value < yellow low (10)' ELSE 'within green range' END
       WHEN field = 'click' AND value > 50 THEN 'value > 50' WHEN field = 'click' AND value <= 1 THEN 'value <= 1'
       WHEN field IN ('click', 'signup') THEN 'no value rule matched' ELSE 'no color limit configured' END AS limit_reason
FROM points""",
)
def j7_limit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = spark.createDataFrame(BANDS, "item string, rl double, yl double, yh double, rh double")
    rules = spark.createDataFrame(RULES, "item string, ordinal int, op string, expected double, state string")
    judged = limits.evaluate_limits(points(spark, sf_dir), bands, rules)
    return judged.select("event_id", "field", "limit_state", "limit_reason")


TIMES_SQL = """
WITH t AS (SELECT event_id, epoch_us(ts) // 1000000 - 946684800 - 300000000 * (event_id % 4) AS coarse, event_id % 1100 AS fine FROM events)"""


def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spacecraft times over many years, some with too many milliseconds."""
    coarse = F.expr("us div 1000000") - 946_684_800 - 300_000_000 * (F.col("event_id") % 4)
    return points(spark, sf_dir).select("event_id", coarse.alias("coarse"), (F.col("event_id") % 1100).alias("fine"), "us")


@query("f13_spacecraft_time", TIMES_SQL + " SELECT event_id, CASE WHEN coarse >= 0 AND fine <= 999 THEN coarse + fine / 1000 END AS seconds FROM t")
def f13_spacecraft_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times(spark, sf_dir).select("event_id", clock.combine_time(F.col("coarse"), F.col("fine")).alias("seconds"))


LEAPS = " + ".join(f"(946684800 + coarse + {k} >= epoch(DATE '{d}'))::INT" for k, d in enumerate(clock.LEAP_DAYS))


@query(
    "f14_utc_text",
    TIMES_SQL + f"""
SELECT event_id, strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S') || CASE WHEN fine > 0 THEN printf('.%03d', fine) ELSE '' END || 'Z' AS utc
FROM (SELECT event_id, fine, (946684800 + coarse + {LEAPS})::BIGINT AS s FROM t WHERE coarse >= 0 AND fine <= 999)""",
)
def f14_utc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = clock.combine_time(F.col("coarse"), F.col("fine"))
    return times(spark, sf_dir).filter(seconds.isNotNull()).select("event_id", clock.utc_text(seconds).alias("utc"))


@query(
    "f15_packet_time",
    TIMES_SQL + """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CASE WHEN coarse >= 0 AND fine <= 999 THEN coarse + fine / 1000 END
                      WHEN event_id % 3 = 1 THEN fine ELSE event_id END::DOUBLE AS seconds,
       CASE event_id % 3 WHEN 0 THEN 'ccsds_secondary_header' WHEN 1 THEN 'beac_time_since_boot' ELSE 'received_wall_time' END AS source
FROM t""",
)
def f15_packet_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 3
    seconds = clock.combine_time(F.col("coarse"), F.col("fine"))
    named = [("beac_time_mission_elapsed_time", F.lit(None).cast("double")), ("beac_time_since_boot", F.when(kind == 1, F.col("fine")))]
    chosen = times(spark, sf_dir).select("event_id", clock.packet_time(kind == 0, seconds, named, F.col("event_id")).alias("t"))
    return chosen.select("event_id", F.nullif(F.col("t.seconds"), F.lit(float("nan"))).alias("seconds"), "t.source")


@query(
    "f17_system_states",
    """
SELECT event_id, CASE m WHEN 0 THEN 'red' WHEN 1 THEN 'yellow' WHEN 2 THEN 'green' WHEN 3 THEN 'green' ELSE 'unknown' END AS mode_state,
       CASE m WHEN 0 THEN 'PHOENIX MODE' WHEN 1 THEN 'SAFE MODE' WHEN 2 THEN 'SCIENCE MODE' WHEN 3 THEN 'DOWNLINK MODE' ELSE m::VARCHAR END AS mode_label,
       CASE m WHEN 0 THEN 'off' WHEN 1 THEN 'on' ELSE 'unknown' END AS power
FROM (SELECT event_id, event_id % 6 AS m FROM events)""",
)
def f17_system_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (F.col("event_id") % 6).cast("string")
    mode = status.mode_state(raw)
    return points(spark, sf_dir).select("event_id", mode["state"].alias("mode_state"), mode["label"].alias("mode_label"), status.power_state(raw).alias("power"))


FIELD_NAMES = ["bat_temp", "bus_volt", "eps_cur", "wheel_power", "boot_time", "sun_angle", "cmd_count", "misc", "cell_v", "panel_i"]
NAME_SQL = "[" + ", ".join(f"'{n}'" for n in FIELD_NAMES) + "][event_id % 10 + 1]"


@query(
    "f20_units",
    f"""
SELECT event_id, name, CASE WHEN name LIKE '%temp%' THEN 'Celsius' WHEN regexp_matches(name, 'cur|_iin|_iout|_i$') THEN 'Amperes'
    WHEN regexp_matches(name, 'vcell|volt|vin|v_out|_v$') THEN 'Volts' WHEN regexp_matches(name, 'power|pwr') THEN 'Watts'
    WHEN regexp_matches(name, 'time|sec') THEN 'Seconds' WHEN regexp_matches(name, 'angle|deg') THEN 'Degrees'
    WHEN regexp_matches(name, 'count|cnt') THEN 'Count' END AS unit
FROM (SELECT event_id, {NAME_SQL} AS name FROM events)""",
)
def f20_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.get(F.array(*map(F.lit, FIELD_NAMES)), (F.col("event_id") % 10).cast("int"))
    return points(spark, sf_dir).select("event_id", name.alias("name")).withColumn("unit", status.unit_of(F.col("name")))


@query("f11_polynomial", "SELECT event_id, round(1.5 - 2 * value + 0.25 * value * value, 6)::DOUBLE AS engineering, NULL::DOUBLE AS gap FROM events")
def f11_polynomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    made = status.polynomial(F.lit("C0=1.5 C1=-2 C2=0.25"), value)
    return points(spark, sf_dir).select("event_id", F.round(made, 6).alias("engineering"), status.polynomial(F.lit("C0=1 C2=2"), value).alias("gap"))


@query(
    "f12_status_map",
    """
SELECT l_orderkey, l_linenumber, CASE l_quantity::INT % 4 WHEN 0 THEN l_returnflag WHEN 2 THEN l_linestatus || '/x' ELSE (l_quantity::INT % 4)::VARCHAR END AS label
FROM lineitem""",
)
def f12_status_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("0/"), "l_returnflag", F.lit("  2/"), "l_linestatus", F.lit("/x"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", status.status_label(text, F.col("l_quantity").cast("int") % 4).alias("label"))


@query(
    "f21_file_stems",
    """
SELECT p_partkey, coalesce(nullif(trim(regexp_replace(trim(name), '[^A-Za-z0-9_.-]+', '_', 'g'), '_'), ''), 'unknown') AS stem
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '._' || p_name || '.' WHEN 1 THEN ' ' || p_brand || '/' || p_type || '% ' WHEN 2 THEN '__!' ELSE p_type || '_' END AS name FROM part)""",
)
def f21_file_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("p_partkey") % 4
    name = F.when(at == 0, F.concat(F.lit("._"), "p_name", F.lit("."))).when(at == 1, F.concat(F.lit(" "), "p_brand", F.lit("/"), "p_type", F.lit("% "))).when(at == 2, "__!")
    return table(spark, sf_dir, "part").select("p_partkey", status.file_stem(name.otherwise(F.concat("p_type", F.lit("_")))).alias("stem"))


@query(
    "f36_flux",
    """
SELECT event_id, round(log10(pow(10, (value - 250) / 10)), 6) AS log_flux,
       CASE event_id % 41 WHEN 0 THEN 'not in Sun' WHEN 1 THEN 'filling history' WHEN 2 THEN 'not in flare' WHEN 4 THEN 'flare likely'
            WHEN 24 THEN 'in-flare decreasing' WHEN 40 THEN 'in-flare rising' END AS phase
FROM events""",
)
def f36_flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = status.flux(F.col("value") - 250)
    return points(spark, sf_dir).select("event_id", F.round(F.log10(made), 6).alias("log_flux"), status.flare_phase(F.col("event_id") % 41).alias("phase"))



JUMPS = """
WITH RECURSIVE p AS (
    SELECT event_id, 'u' || user_id % 7 AS packet_name, epoch_us(ts) / 1e6 - 946684800 + CASE WHEN event_id % 17 = 0 THEN 1e6 ELSE 0 END AS packet_time, epoch_us(ts) / 1e6 AS received,
           row_number() OVER (PARTITION BY user_id % 7 ORDER BY ts, event_id) AS n
    FROM events),
fold AS (
    SELECT event_id, packet_name, n, packet_time AS held, received AS at, NULL::VARCHAR AS reject_reason FROM p WHERE n = 1
    UNION ALL
    SELECT p.event_id, p.packet_name, p.n, CASE WHEN jumps THEN f.held ELSE p.packet_time END, CASE WHEN jumps THEN f.at ELSE p.received END, CASE WHEN jumps THEN 'jump' END
    FROM (SELECT fold.*, fold.n + 1 AS next FROM fold) f JOIN p ON p.packet_name = f.packet_name AND p.n = f.next, LATERAL (SELECT abs(p.packet_time - f.held) > 600 + p.received - f.at AS jumps))
SELECT event_id, packet_name, reject_reason FROM fold"""


@query("st4_jump_rejection_batch", JUMPS)
def st4_jump_rejection_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against a plain loop: what is accepted depends on what was accepted before."""
    wild = F.when(F.col("event_id") % 17 == 0, 1e6).otherwise(0.0)
    packets = points(spark, sf_dir).select("event_id", "packet_name", (F.col("us") / 1e6 - 946_684_800 + wild).alias("packet_time"), F.lit("ccsds_secondary_header").alias("time_source"), (F.col("us") / 1e6).alias("received"))
    return series.reject_jumps(packets, "packet_name", max_jump=600.0).select("event_id", "packet_name", "reject_reason")


SIGMA = """
WITH RECURSIVE p AS (
    SELECT event_id, event_type AS field, epoch_us(ts) AS us, value, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS n FROM events),
fold AS (
    SELECT event_id, field, us, value, n, [value] AS held, false AS rejected FROM p WHERE n = 1
    UNION ALL
    SELECT p.event_id, p.field, p.us, p.value, p.n, CASE WHEN far THEN f.held ELSE (f.held || [p.value])[-50:] END, far
    FROM (SELECT fold.*, fold.n + 1 AS next FROM fold) f JOIN p ON p.field = f.field AND p.n = f.next,
         LATERAL (SELECT len(f.held) >= 12 AND list_aggregate(f.held, 'stddev_pop') > 0
                     AND abs(p.value - list_avg(f.held)) > 4 * list_aggregate(f.held, 'stddev_pop') AS far))
SELECT event_id, field, us, value, rejected FROM fold"""


@query("st5_sigma_filter_batch", SIGMA)
def st5_sigma_filter_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against a plain loop."""
    return series.reject_outliers(points(spark, sf_dir).select("event_id", "field", "us", "value"), "field", "us", "value")


