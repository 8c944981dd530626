"""The telemetry store: a catalog, one Parquet table per packet type, bounded scans, idempotent append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HIDDEN = "_"


def visible(columns: list[str]) -> list[str]:
    """Names that discovery shows; those that start with _ are for the store itself."""
    return [c for c in columns if not c.startswith(HIDDEN)]


def bounded(table: DataFrame, fields: list[str], time_field: str | None = None, start: object = None, stop: object = None, order_by: str | None = None) -> DataFrame:
    """Chosen fields of a table between inclusive bounds of a time field, in order of order_by, else of the time field.

    Bounds need a time field; fields and time fields must exist. All of it stays lazy, and bounds reach the scan.
    """
    missing = [c for c in [*fields, time_field, order_by] if c is not None and c not in table.columns]
    if missing:
        raise KeyError(f"unknown fields: {', '.join(sorted(set(missing)))}")
    if time_field is None and (start is not None or stop is not None):
        raise ValueError("bounds need a time field")
    kind = table.schema[time_field].dataType if time_field else None
    if start is not None:
        table = table.filter(F.col(time_field) >= F.lit(start).cast(kind))
    if stop is not None:
        table = table.filter(F.col(time_field) <= F.lit(stop).cast(kind))
    by = order_by or time_field
    ordered = table.orderBy(by) if by else table
    return ordered.select(*fields)


def resolve(catalog: DataFrame, packet_type: int | str) -> DataFrame:
    """The catalog's rows of a packet type: by APID if it is a number, else by name in any case."""
    text = str(packet_type)
    return catalog.filter(F.col("apid") == int(text)) if text.isdigit() else catalog.filter(F.lower("packet_name") == text.lower())


def field_names(catalog_fields: DataFrame) -> DataFrame:
    """All visible field names of the store, once each and sorted. Needs (apid, field)."""
    return catalog_fields.filter(~F.col("field").startswith(HIDDEN)).select("field").distinct().orderBy("field")


def fields_containing(catalog_fields: DataFrame, part: str, match_case: bool = False) -> DataFrame:
    """Fields whose name contains a text."""
    field = F.col("field") if match_case else F.lower("field")
    return catalog_fields.filter(F.instr(field, part if match_case else part.lower()) > 0)


def owners(catalog_fields: DataFrame) -> DataFrame:
    """Each visible field with the number of packet types that have it, and its only owner if there is just one."""
    owned = catalog_fields.filter(~F.col("field").startswith(HIDDEN)).groupBy("field")
    return owned.agg(F.count("*").alias("owners"), F.when(F.count("*") == 1, F.min("apid")).alias("apid"))


def upsert_catalog(catalog: DataFrame, incoming: DataFrame) -> DataFrame:
    """catalog with the rows of incoming, which replace those of the same APID; the last arrival counts."""
    both = catalog.withColumn("arrival", F.lit(-1).cast("long")).unionByName(incoming)
    newest = both.groupBy("apid").agg(F.max_by(F.struct("packet_name", "table_name"), "arrival").alias("row"))
    return newest.select("apid", "row.*")


def only_new(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files (with sha256) whose content the ledger doesn't have; of equal ones the first by path."""
    first = files.groupBy("sha256").agg(F.min("path").alias("path"))
    return files.join(first, ["sha256", "path"]).join(ledger.select("sha256"), "sha256", "left_anti")


def widen(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Bag union by name: missing columns are null, new ones are added, types of the stored table hold.

    A whole-number column that gets fractions becomes DOUBLE rather than being rounded; text that doesn't fit fails.
    """
    kinds = dict(stored.dtypes)
    for name, kind in incoming.dtypes:
        if name in kinds and kind != kinds[name]:
            if {kind, kinds[name]} <= {"tinyint", "smallint", "int", "bigint", "float", "double"}:
                stored, incoming = (df.withColumn(name, F.col(name).cast("double")) for df in (stored, incoming))
            else:
                incoming = incoming.withColumn(name, F.col(name).cast(kinds[name]))
    return stored.unionByName(incoming, allowMissingColumns=True)


class TypeRefused(ValueError):
    """A file whose values don't fit the types that its table has."""


def settled(data: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, list[Column]]:
    """data with the types that a table has already, and for each changed column a count of values that don't fit.

    A value fits if it is the same when cast back; texts are compared as numbers where the column is one.
    """
    columns, misfits = [], []
    for name, kind in data.dtypes:
        wanted = kinds.get(name, kind)
        value = F.col(f"`{name}`")
        if wanted == kind:
            columns.append(value)
            continue
        cast = value.try_cast(wanted)
        columns.append(cast.alias(name))
        back = cast.cast("double") == value.try_cast("double") if kind == "string" and wanted != "string" else cast.try_cast(kind) == value
        back = F.lit(True) if kind == "string" and not wanted.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")) else back
        misfits.append(F.count_if(value.isNotNull() & (cast.isNull() | ~F.coalesce(back, F.lit(False)))).alias(name))
    return data.select(*columns), misfits


class TelemetryStore:
    """A folder with one Parquet table per APID, a catalog, the fields with their types, and a ledger of what was taken in.

    Data of a file is written under its own checksum before the ledger names it, and readers take only what the ledger
    names; so a write that broke off is invisible, and repeating it replaces its own data.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    @property
    def ledger(self) -> DataFrame:
        """What was taken in: one row for each content."""
        return self._read("ledger", "sha256 string, source_path string, apid int, rows long, ingested timestamp")

    @property
    def catalog(self) -> DataFrame:
        """APIDs with name and table, the newest entry of each."""
        rows = self._read("catalog", "apid int, packet_name string, table_name string, at timestamp")
        newest = rows.groupBy("apid").agg(F.max_by(F.struct("packet_name", "table_name"), "at").alias("row"))
        return newest.select("apid", "row.*")

    @property
    def fields(self) -> DataFrame:
        """apid, field, position and type of all columns, as the first file that had them settled them."""
        rows = self._read("fields", "apid int, field string, position int, type string, at timestamp")
        return rows.groupBy("apid", "field").agg(F.min_by(F.struct("position", "type"), F.struct("at", "position")).alias("f")).select("apid", "field", "f.*")

    def _kinds(self, apid: int) -> dict[str, str]:
        """The columns of one table in order, with their types."""
        return {r["field"]: r["type"] for r in self.fields.filter(F.col("apid") == apid).orderBy("position", "field").collect()}  # of one table

    def append(self, apid: int, packet_name: str, source_path: str, sha256: str, data: DataFrame) -> bool:
        """Take in one file's rows; False if its content is there already.

        Types that the table has hold: the file's values are cast to them, and a file with a value that doesn't fit is
        refused alone (TypeRefused). New columns get the file's types. So readers never meet two types.
        """
        if self.ledger.filter(F.col("sha256") == sha256).limit(1).count():
            return False
        kinds = self._kinds(apid)
        fitted, misfits = settled(data, kinds)
        wrong = {k: n for k, n in data.agg(*misfits).first().asDict().items() if n} if misfits else {}
        if wrong:
            raise TypeRefused(f"{source_path}: " + ", ".join(f"{n} values of {k} are no {kinds[k]}" for k, n in sorted(wrong.items())))
        target = f"{self.path}/apid_{apid}/source_sha256={sha256}"
        fitted.write.mode("overwrite").parquet(target)
        rows = self.spark.read.schema(fitted.schema).parquet(target).count()
        now = F.current_timestamp()
        one = self.spark.range(1)
        fresh = [(name, len(kinds) + i, kind) for i, (name, kind) in enumerate(x for x in fitted.dtypes if x[0] not in kinds)]
        if fresh:
            each = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(p).alias("position"), F.lit(k).alias("type")) for n, p, k in fresh])
            one.select(F.lit(apid).alias("apid"), F.inline(each)).withColumn("at", now).write.mode("append").parquet(f"{self.path}/fields")
        one.select(F.lit(apid).alias("apid"), F.lit(packet_name).alias("packet_name"), F.lit(f"apid_{apid}").alias("table_name"), now.alias("at")).write.mode("append").parquet(f"{self.path}/catalog")
        done = one.select(F.lit(sha256).alias("sha256"), F.lit(source_path).alias("source_path"), F.lit(apid).alias("apid"), F.lit(rows).cast("long").alias("rows"), now.alias("ingested"))
        done.write.mode("append").parquet(f"{self.path}/ledger")
        return True

    def table(self, packet_type: int | str) -> DataFrame:
        """All rows of a packet type, with the columns and types that the store has settled; unknown types are a KeyError."""
        found = resolve(self.catalog, packet_type).collect()
        if not found:
            raise KeyError(packet_type)
        apid = found[0]["apid"]
        schema = ", ".join(f"`{name}` {kind}" for name, kind in self._kinds(apid).items())
        rows = self.spark.read.schema(f"{schema}, source_sha256 string").parquet(f"{self.path}/apid_{apid}")
        known = self.ledger.select(F.col("sha256").alias("source_sha256"))
        return rows.join(known, "source_sha256", "left_semi").drop("source_sha256")

    def fetch(self, field: str, packet_type: int | str | None = None, order_by: str | None = None) -> DataFrame:
        """One field of all rows of a packet type; without one, of the only type that has the field.

        A KeyError tells an unknown field, and the types to choose from if several have it.
        """
        if packet_type is None:
            having = sorted(r["apid"] for r in self.fields.filter(F.col("field") == field).select("apid").collect())  # packet types
            if len(having) != 1:
                raise KeyError(f"{field} is in packet types {having}" if having else f"unknown field: {field}")
            packet_type = having[0]
        return bounded(self.table(packet_type), [field], order_by=order_by)

    def summary(self) -> DataFrame:
        """Rows of each table."""
        return self.ledger.groupBy("apid").agg(F.sum("rows").alias("rows")).join(self.catalog, "apid").orderBy("apid")


def time_vector(table: DataFrame, time_field: str) -> DataFrame:
    """A table's times in order."""
    return table.select(time_field).orderBy(time_field)


def sha256_of(content: Column) -> Column:
    """Checksum of a file's content."""
    return F.sha2(content, 256)
