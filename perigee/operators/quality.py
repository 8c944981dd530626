"""Dictionaries, metadata and provenance: checks and differences between tables."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.sources.scratch import small

# Names that are kept out of the published dictionary.
UNPUBLISHED_NAMES = ["VERSION", "TYPE", "SEC_HDR_FLAG", "PKT_APID", "SEQ_FLGS", "SEQ_CTR", "PKT_LEN"]
UNPUBLISHED_PREFIXES = ["ccsds", "des_", "REUSABLE_", "mem_dump", "fp_test", "xband_adc", "uhf_pass_", "pl_data", "log_", "mem_", "ver_"]
UNPUBLISHED_PARTS = "dbg|debug|cmd_bytes|checksum|task_state|wp_state|xband_virt_|version|chksm|opcode|unused"
SENSITIVE = "password|passwd|secret|token|api_key|access_key|private_key|credential"


def publishable(name: Column) -> Column:
    """Whether a field may be in the published dictionary."""
    by_prefix = F.lit(False)
    for prefix in UNPUBLISHED_PREFIXES:
        by_prefix = by_prefix | name.startswith(prefix)
    return ~name.isin(UNPUBLISHED_NAMES) & ~by_prefix & ~name.rlike(f"(?i){UNPUBLISHED_PARTS}")


def triage(pattern: str, *texts: Column) -> Column:
    """OMIT if a name or description matches a pattern, else REVIEW."""
    return F.when(F.concat_ws(" ", *texts).rlike(f"(?i){pattern}"), "OMIT").otherwise("REVIEW")


def missing_required(present: DataFrame, required: DataFrame, by: str) -> DataFrame:
    """Per group, the required names (name, level) of its level or below that it lacks, sorted. Both lists are by name.

    present has (by, level, name); groups lack nothing or several names of the small required table.
    """
    groups = present.select(by, "level").distinct()
    wanted = groups.join(small(required.select("name", F.col("level").alias("needed_from"))), F.col("needed_from") <= F.col("level"))
    lacking = wanted.join(present.select(by, "name"), [by, "name"], "left_anti")
    found = lacking.groupBy(by).agg(F.array_sort(F.collect_list("name")).alias("missing"))
    return groups.join(found, by, "left").select(by, "level", F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))


def listing_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files (path, size, mtime) that are created, modified or deleted between two listings."""
    a, b = before.select("path", F.struct("size", "mtime").alias("was")), after.select("path", F.struct("size", "mtime").alias("is"))
    change = F.when(F.col("was").isNull(), "created").when(F.col("is").isNull(), "deleted").when(F.col("was") != F.col("is"), "modified")
    return a.join(b, "path", "full_outer").withColumn("change", change).filter("change is not null").select("path", "change")


def verify_checksums(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """Recorded files (name, sha256) with status missing, mismatch or ok against those that are there."""
    joined = recorded.join(actual.select("name", F.col("sha256").alias("actual")), "name", "left")
    status = F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("sha256"), "mismatch").otherwise("ok")
    return joined.select("name", status.alias("status"))


def grouped_definitions(definitions: DataFrame) -> DataFrame:
    """Rows of a definition file (ordinal, field, description) with the group of the COMMENT row before them.

    A group's text loses the word COMMENT and dashes. The file is a small table, read in its own order.
    """
    along = Window.orderBy("ordinal")
    comment = F.col("field") == "COMMENT"
    text = F.trim(F.regexp_replace("description", "COMMENT|-", ""))
    marked = definitions.withColumn("group", F.last(F.when(comment, text), ignorenulls=True).over(along))
    return marked.filter(~comment)


def schema_report(fields: DataFrame) -> DataFrame:
    """Problems of a public schema (packet, ordinal, name, byte_offset, bit_in_byte, bit_offset, bit_length, data_type)."""
    along = Window.partitionBy("packet").orderBy("ordinal")
    end = F.max(F.col("bit_offset") + F.col("bit_length")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    width = F.regexp_extract("data_type", r"(\d+)$", 1).cast("int")
    checks = F.array(
        F.when(F.col("bit_offset") < end, "overlap"),
        F.when(F.col("bit_offset") != 8 * F.col("byte_offset") + F.col("bit_in_byte"), "position"),
        F.when(F.count("*").over(Window.partitionBy("packet", "name")) > 1, "name"),
        F.when(width != F.col("bit_length"), "width"),
    )
    return fields.withColumn("problems", F.array_join(F.array_compact(checks), ",")).filter("problems <> ''")


def carry_over(cards: DataFrame, definitions: DataFrame, reserved: DataFrame) -> DataFrame:
    """Per file, known keywords that are not reserved, under their internal names; later values win."""
    known = cards.join(small(definitions), "keyword").join(small(reserved), "keyword", "left_anti")
    return known.groupBy("file", "internal_name").agg(F.max_by("value", "ordinal").alias("value"))


def redacted(values: Column) -> Column:
    """A map without the values of sensitive keys."""
    sensitive = lambda k: F.lower(F.regexp_replace(k, "-", "_")).rlike(SENSITIVE)
    return F.transform_values(values, lambda k, v: F.when(sensitive(k), "<redacted>").otherwise(v))


def header_rows(groups: DataFrame, values: DataFrame, start: int = 7) -> DataFrame:
    """Rows of an image's header in order: image, position, keyword, value, comment.

    groups: variable, ordinal, grp, keyword, description, units; values: image, variable, value. A group that has
    values begins with a COMMENT of its name centred in 72 dashes; its variables follow in order of definition, with
    their units behind the description.
    """
    comment = with_units(F.col("description"), F.col("units"))
    held = values.join(small(groups), "variable").select("image", "grp", "ordinal", "keyword", "value", comment.alias("comment"))  # a definition file
    left = F.floor((72 - F.length("grp")) / 2)
    title = F.rpad(F.concat(F.repeat(F.lit("-"), F.greatest(left, F.lit(0)).cast("int")), F.col("grp")), 72, "-")
    heads = held.groupBy("image", "grp").agg((F.min("ordinal") - 0.5).alias("ordinal"))
    heads = heads.select("image", "grp", "ordinal", F.lit("COMMENT").alias("keyword"), title.alias("value"), F.lit(None).cast("string").alias("comment"))
    firsts = groups.groupBy("grp").agg(F.min("ordinal").alias("group_first"))
    every = heads.unionByName(held).join(small(firsts), "grp")
    place = F.row_number().over(Window.partitionBy("image").orderBy("group_first", "ordinal")) - 1 + start
    return every.select("image", place.alias("position"), "keyword", "value", "comment")


def definition_problems(variables: DataFrame, required: DataFrame, obsolete: dict[str, str], by: str) -> DataFrame:
    """Per definition file (by, variable): the required variables that it lacks, sorted, and obsolete ones with their successor."""
    present = variables.select(by, F.lit(0).alias("level"), F.col("variable").alias("name"))
    missing = missing_required(present, required.select("name", F.lit(0).alias("level")), by).drop("level")
    old = F.create_map(*[F.lit(x) for kv in obsolete.items() for x in kv])
    stale = variables.filter(F.col("variable").isin(list(obsolete))).select(by, F.concat("variable", F.lit(" -> "), F.element_at(old, F.col("variable"))).alias("stale"))
    stale = stale.groupBy(by).agg(F.array_sort(F.collect_set("stale")).alias("obsolete"))  # of the obsolete names
    return missing.join(stale, by, "full_outer")


def run_manifest(before: DataFrame, after: DataFrame, inputs: DataFrame, settings: DataFrame, started: float, ended: float, error: str | None = None) -> DataFrame:
    """One JSON line of a run: its inputs with size and checksum, outputs that changed, settings without secrets, status.

    before and after: listings (path, size, mtime); inputs: path, size, sha256; settings: name, value. A manifest
    names the files of one run, so they meet in one row.
    """
    changed = listing_changes(before, after).filter("change <> 'deleted'")
    one = inputs.agg(F.array_sort(F.collect_list(F.struct("path", "size", "sha256"))).alias("inputs"))
    outputs = changed.agg(F.array_sort(F.collect_list(F.struct("path", "change"))).alias("outputs"))
    held = settings.agg(redacted(F.map_from_entries(F.collect_list(F.struct("name", "value")))).alias("settings"))
    row = one.crossJoin(outputs).crossJoin(held)  # one row each
    facts = {"status": F.lit("failed" if error else "completed"), "error": F.lit(error), "duration_seconds": F.lit(float(ended - started))}
    return row.select(F.to_json(F.struct("inputs", "outputs", "settings", *[v.alias(k) for k, v in facts.items()])).alias("manifest"))


def with_units(description: Column, units: Column) -> Column:
    """A description with its units behind it, if it has any."""
    return F.when(F.coalesce(units, F.lit("")) != "", F.concat(description, F.lit(" ("), units, F.lit(")"))).otherwise(description)


def matching_fields(fields: DataFrame, keywords: list[str]) -> DataFrame:
    """field and position of the temperature fields that a keyword names, in order of keyword and field, each once.

    A field matches a keyword that it contains beside `temp`, in any case; for adcs it must have `motor` and `1` too.
    """
    name = F.lower("field")
    needs = lambda word: ["adcs", "motor", "1"] if word == "adcs" else [word]
    hits = [F.when(functools.reduce(Column.__and__, [name.contains(x) for x in [*needs(k.lower()), "temp"]]), i) for i, k in enumerate(keywords)]
    found = fields.withColumn("_first", F.coalesce(*hits)).filter("_first is not null")
    place = F.row_number().over(Window.orderBy("_first", "field")) - 1  # names of fields, a small table
    return found.select("field", place.alias("position"))
