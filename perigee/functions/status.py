"""Names, numbers, limits and states of telemetry values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields that are shown if nothing else is asked for.
DEFAULT_FIELDS = ["*temp*", "*temperature*", "csie_det0_therm", "csie_det1_therm", "*bat*v*", "*batt*v*", "*battery*v*", "*bus*v*", "*bus*volt*", "*volt*", "*_v", "*curr*", "*current*", "*_i"]

# States and their colours.
MODES = ["PHOENIX", "SAFE", "SCIENCE", "DOWNLINK"]
MODE_STATES = {"PHOENIX": "red", "SAFE": "yellow", "SCIENCE": "green", "DOWNLINK": "green"}

# Patterns of a name and the unit that they mean, in order.
UNITS = [
    ("temp", "Celsius"),
    ("cur|_iin|_iout|_i$", "Amperes"),
    ("vcell|volt|vin|v_out|_v$", "Volts"),
    ("power|pwr", "Watts"),
    ("time|sec", "Seconds"),
    ("angle|deg", "Degrees"),
    ("count|cnt", "Count"),
]


def glob_regex(pattern: str) -> str:
    """Regular expression of a pattern with *, ? and [] that must match all of a name, in lower case."""
    out, i = "", 0
    pattern = pattern.lower()
    while i < len(pattern):
        letter = pattern[i]
        close = pattern.find("]", i + 2) if letter == "[" else -1
        if letter == "*":
            out += ".*"
        elif letter == "?":
            out += "."
        elif close > 0:
            inner = pattern[i + 1 : close].replace("\\", "\\\\")
            out += "[" + ("^" + inner[1:] if inner.startswith("!") else inner) + "]"
            i = close
        else:
            out += "\\" + letter if letter in r"\.^$+{}()|[]" else letter
        i += 1
    return f"(?s)^{out}$"


def any_glob(name: Column, patterns: list[str]) -> Column:
    """Whether a name matches any pattern, in any case."""
    return reduce(lambda a, b: a | b, [F.lower(name).rlike(glob_regex(p)) for p in patterns], F.lit(False))


def packet_selected(name: Column, patterns: list[str]) -> Column:
    """Whether a packet's name is wanted; no patterns want all."""
    return any_glob(name, patterns) if patterns else F.lit(True)


def field_selected(name: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Whether a field is wanted; exclusion goes first."""
    return any_glob(name, include or DEFAULT_FIELDS) & ~any_glob(name, exclude or [])


def packet_ignored(apid: Column, name: Column, apids: list[int], patterns: list[str]) -> Column:
    """Whether a packet is left out by APID or name."""
    return apid.isin(apids) | any_glob(name, patterns)


def number_or_null(text: Column) -> Column:
    """A finite number of a text, else null."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def unit_of(name: Column) -> Column:
    """Unit that a field's name suggests, null if none."""
    return reduce(lambda c, u: c.when(F.lower(name).rlike(u[0]), u[1]), UNITS[1:], F.when(F.lower(name).rlike(UNITS[0][0]), UNITS[0][1]))


def general_format(number: Column) -> Column:
    """A number with six significant digits at most and no zeros at the end, as in `1`, `0.5` or `1e+06`."""
    digits = F.regexp_replace(F.format_string("%.6g", number), r"(\.\d*?)0+(e|$)", "$1$2")
    return F.regexp_replace(digits, r"\.(e|$)", "$1")


def band_state(value: Column, rl: Column, yl: Column, yh: Column, rh: Column) -> Column:
    """STRUCT(state, reason) of red and yellow limits; red counts before yellow, and limits that are null don't."""

    def says(state: str, text: str, limit: Column) -> Column:
        return F.struct(F.lit(state).alias("state"), F.concat(F.lit(f"value {text} ("), general_format(limit), F.lit(")")).alias("reason"))

    green = F.struct(F.lit("green").alias("state"), F.lit("within green range").alias("reason"))
    return (
        F.when(value < rl, says("red", "< red low", rl))
        .when(value > rh, says("red", "> red high", rh))
        .when(value < yl, says("yellow", "< yellow low", yl))
        .when(value > yh, says("yellow", "> yellow high", yh))
        .otherwise(green)
    )


def rule_matches(value: Column, op: Column, expected: Column) -> Column:
    """Whether a value rule holds; an unknown operator never does."""
    return (
        F.when(op == "==", value == expected)
        .when(op == "!=", value != expected)
        .when(op == ">", value > expected)
        .when(op == ">=", value >= expected)
        .when(op == "<", value < expected)
        .when(op == "<=", value <= expected)
        .otherwise(F.lit(False))
    )


def mode_state(value: Column) -> Column:
    """STRUCT(state, label) of a system mode given as name or number in a text."""
    name, number = F.upper(F.trim(value)), number_or_null(value)
    mode = F.when(name.isin(MODES), name).when((number >= 0) & (number < len(MODES)) & (number == F.floor(number)), F.get(F.array(*map(F.lit, MODES)), number.cast("int")))
    state = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MODE_STATES.items() for x in kv]), mode), F.lit("unknown"))
    label = F.when(mode.isNotNull(), F.concat(mode, F.lit(" MODE"))).when(value.isNull() | (name == ""), "?").otherwise(name)
    return F.struct(F.when(mode.isNull(), "unknown").otherwise(state).alias("state"), label.alias("label"))


def power_state(value: Column) -> Column:
    """on, off or unknown of a power state given as text or number in a text."""
    name, number = F.lower(F.trim(value)), number_or_null(value)
    return F.when((name == "on") | (number == 1), "on").when((name == "off") | (number == 0), "off").otherwise("unknown")


def file_stem(name: Column) -> Column:
    """A name that is safe in file names: runs of other letters become _, and none is left at the ends."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(name), r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")
    return F.when(F.coalesce(clean, F.lit("")) == "", "unknown").otherwise(clean)


def first_number(*values: Column) -> Column:
    """The first of some texts that is a whole number."""
    return F.coalesce(*[v.try_cast("long") for v in values])


def polynomial(text: Column, raw: Column) -> Column:
    """Value of raw under coefficients written as `C0=… C1=…`; null unless the degrees run from 0 without a gap."""
    degrees = F.regexp_extract_all(text, F.lit(r"C(\d+)\s*=\s*(\S+)"), 1)
    numbers = F.regexp_extract_all(text, F.lit(r"C(\d+)\s*=\s*(\S+)"), 2)
    contiguous = degrees == F.transform(F.sequence(F.lit(0), F.size(degrees) - 1), lambda i: i.cast("string"))
    value = F.aggregate(F.reverse(numbers), F.lit(0.0), lambda s, c: s * raw + c.try_cast("double"))
    return F.when((F.size(degrees) > 0) & contiguous, value)


def status_label(text: Column, raw: Column) -> Column:
    """Label of raw in a map written as `0/OFF 1/ON`; raw itself if it has none."""
    pairs = F.filter(F.split(F.trim(text), r"\s+"), lambda x: x.contains("/"))
    labels = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "/", 1), F.regexp_replace(x, "^[^/]*/", ""))))
    return F.coalesce(F.try_element_at(labels, raw.cast("string")), raw.cast("string"))


def flux(raw: Column) -> Column:
    """Flux of a magnitude in tenths of a decade."""
    return F.pow(F.lit(10.0), raw / 10)


# Phases of a flare by their flags.
FLARE_PHASES = {0: "not in Sun", 1: "filling history", 2: "not in flare", 4: "flare likely", 24: "in-flare decreasing", 40: "in-flare rising"}


def flare_phase(raw: Column) -> Column:
    """Text of a flare phase, null for flags that are none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in FLARE_PHASES.items() for x in kv]), raw.cast("int"))


def cell_text(value: Column, kind: str) -> Column:
    """A value as it stands in a text table: bytes in hexadecimal, times in ISO form, nested values as JSON."""
    if kind == "binary":
        return F.lower(F.hex(value))
    if kind.startswith("timestamp"):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if kind.startswith(("array", "map", "struct")):
        return F.to_json(value)
    return value.cast("string")
