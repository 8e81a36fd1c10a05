"""Raw JSON lines without losing columns or lines.

A line is parsed once into a VARIANT. ``classify`` names what is wrong with a line, ``quarantine`` keeps
bad lines by reason and ``replay`` takes them in again once mended. ``reconcile`` decides the columns a
table is read with: declared types win, other fields are inferred from every record and widened along a
type lattice, and fields whose records disagree become text. ``drift_report`` counts, per vintage
(folder) and field, what was found and how many values the chosen type cannot hold.

Everything is an expression over the parsed record or a partial aggregate of few groups (vintage,
field, type); only the list of distinct fields reaches the driver, and it is refused beyond ``MAX_FIELDS``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: More distinct top-level fields than this are keys of data, not columns.
MAX_FIELDS = 2000
_NUMBERS = ["bigint", "decimal(38,0)", "double"]


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row: the optimizer copies a projected expression into every
    filter and column that uses it, but not one that comes out of a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(line, vintage, record): the text of each line, the name of its folder, and the line as a variant
    (NULL if it is no JSON)."""
    df = spark.read.text(path)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return _once(df.select(F.col("value").alias("line"), folder.alias("vintage")), record=parsed("line"))


def parsed(line: str) -> Column:
    """The line as a variant. A line that opens an object and closes none is no JSON: it is told without the
    parser, whose failure is dear."""
    text = F.col(line)
    return F.when(~(text.startswith("{") & ~text.contains("}")), F.try_parse_json(line))


def fields_map(record: Column | str = "record") -> Column:
    """The record's fields as a map of variants; NULL unless the record is an object."""
    return F.try_variant_get(F.col(record) if isinstance(record, str) else record, "$", "map<string,variant>")


def typed(value: Column, ddl: str) -> Column:
    """A variant as ``ddl``; NULL where it cannot be. Objects and lists become JSON text as ``string``."""
    return value if ddl == "variant" else F.try_variant_get(value, "$", ddl)


def field(name: str, ddl: str, record: str = "record") -> Column:
    """A field of the record as ``ddl``; NULL where it is absent or cannot be. Read in place: a map of all fields
    copies each of them."""
    quote = next((q for q in "'\"" if q not in name), None)
    if quote is None or not name:
        return typed(F.element_at(fields_map(record), F.lit(name)), ddl)
    return F.try_variant_get(F.col(record), f"$[{quote}{name}{quote}]", ddl)


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


# --- bad lines ------------------------------------------------------------------------

def classify(lines: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """Adds ``reason``: NULL for a good line, else ``blank``, ``cut_short``, ``malformed``,
    ``not_an_object``, ``missing:<field>`` or ``wrong_type:<field>`` (first that holds, fields in the given order).

    ``required``: field -> type for the fields a record must hold.
    """
    text = F.trim(F.regexp_replace("line", r"[\s\u0000]+$", ""))
    broken = (F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "blank")
              .when(text.startswith("{") & ~text.endswith("}"), "cut_short").otherwise("malformed"))
    # JSON is an object if it begins like one
    reason = (F.when(F.col("record").isNull(), broken)
              .when(~F.startswith(F.ltrim("line", F.lit(" \t\r\n")), F.lit("{")), "not_an_object"))
    for name, ddl in required.items():
        found = _present(field(name, "variant"))
        fits = found if ddl == "variant" else field(name, ddl).isNotNull()
        reason = reason.when(~fits, F.when(found, f"wrong_type:{name}").otherwise(f"missing:{name}"))
    return _once(lines, reason=reason)


def split_lines(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good lines, quarantined lines: line, vintage, reason)."""
    good = classified.filter(F.col("reason").isNull()).drop("reason")
    return good, classified.filter(F.col("reason").isNotNull()).select("line", "vintage", "reason")


def quarantine(bad: DataFrame, path: str, batch: str) -> None:
    """Keeps bad lines under ``path``, by reason and batch; loading a batch again replaces its lines."""
    kind = F.split("reason", ":")[0]
    (bad.withColumns({"batch": F.lit(batch), "kind": kind}).hint("rebalance", "batch", "kind")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "kind").parquet(path))


def replay(spark: SparkSession, path: str, mend, required: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Lines of the quarantine at ``path``, mended by ``mend`` (a Column function of line and reason),
    classified anew: (good lines, lines that are still bad)."""
    kept = spark.read.parquet(path)
    lines = kept.select(mend(F.col("line"), F.col("reason")).alias("line"), "vintage")
    return split_lines(classify(_once(lines, record=parsed("line")), required))


# --- schema reconciliation ------------------------------------------------------------

def found_type(value: Column) -> Column:
    """The lattice's name for a variant's type: void, boolean, bigint, decimal(38,0), double, string, array, object."""
    t = F.schema_of_variant(value)
    return (F.when(t.startswith("ARRAY"), "array").when(t.startswith("OBJECT"), "object")
            # whole numbers beyond a long; shorter ones without places were written like 1.0
            .when(t.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), "decimal(38,0)").when(t.startswith("DECIMAL"), "double")
            .otherwise(F.lower(t)))


def widen(a: str, b: str) -> str:
    """The least type that holds both: numbers widen, ``void`` holds nothing, all else meets in text."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    if a in _NUMBERS and b in _NUMBERS:
        return _NUMBERS[max(_NUMBERS.index(a), _NUMBERS.index(b))]
    return "string"


@dataclass(frozen=True)
class Field:
    name: str
    ddl: str          # the type it is read as
    origin: str       # declared, inferred or conflict


def observed(lines: DataFrame) -> DataFrame:
    """(field, found, n): every top-level field of the good records, its types and their counts."""
    x = lines.select(F.explode(fields_map()).alias("field", "value"))
    return x.groupBy("field", found_type(F.col("value")).alias("found")).agg(F.count("*").alias("n"))


def reconcile(lines: DataFrame, declared: T.StructType) -> list[Field]:
    """The columns to read ``lines`` with: the declared ones in order, then the others by name."""
    seen = observed(lines).select("field", "found").limit(8 * MAX_FIELDS + 1).collect()
    types: dict[str, str] = {}
    conflict = set()
    for r in seen:
        old = types.get(r["field"], "void")
        types[r["field"]] = widen(old, r["found"])
    for r in seen:                                   # text that not every record holds as text
        if types[r["field"]] == "string" and r["found"] not in ("string", "void"):
            conflict.add(r["field"])
    if len(types) > MAX_FIELDS:
        raise ValueError(f"{len(types)} distinct fields: read the records as variants instead")
    known = {f.name: f.dataType.simpleString() for f in declared.fields}
    fields = [Field(n, ddl, "declared") for n, ddl in known.items()]
    for n in sorted(set(types) - set(known)):
        ddl = {"void": "string", "array": "variant", "object": "variant"}.get(types[n], types[n])
        fields.append(Field(n, ddl, "conflict" if n in conflict else "inferred"))
    return fields


def read_reconciled(lines: DataFrame, fields: list[Field]) -> DataFrame:
    """One typed column per field; absent fields and values a type cannot hold are NULL."""
    return lines.select(*[field(f.name, f.ddl).alias(f.name) for f in fields])


def drift_report(lines: DataFrame, fields: list[Field]) -> DataFrame:
    """(vintage, field, found, n, reads_as, origin, lost) per vintage, field and found type.

    ``found`` is ``absent`` for records without the field; ``lost`` counts values that are NULL when
    read as ``reads_as``.
    """
    known = F.array(*[F.struct(F.lit(f.name).alias("field"), F.lit(f.ddl).alias("reads_as"), F.lit(f.origin).alias("origin")) for f in fields])
    x = _once(lines.select("vintage", "record"), __m=fields_map()).filter(F.col("__m").isNotNull())
    x = x.select("vintage", "__m", F.explode(known).alias("f"))
    value = F.element_at("__m", F.col("f.field"))
    read = F.lit(None).cast("boolean")
    for ddl in sorted({f.ddl for f in fields}):
        read = F.when(F.col("f.reads_as") == ddl, typed(value, ddl).isNotNull()).otherwise(read)
    found = F.when(value.isNull(), "absent").otherwise(found_type(value))
    x = x.select("vintage", "f.field", "f.reads_as", "f.origin", found.alias("found"), (_present(value) & ~read).alias("gone"))
    return (x.groupBy("vintage", "field", "found", "reads_as", "origin")
            .agg(F.count("*").alias("n"), F.count(F.when(F.col("gone"), 1)).alias("lost"))
            .select("vintage", "field", "found", "n", "reads_as", "origin", "lost"))
