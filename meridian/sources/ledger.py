"""Repeatable appends: a table of batches and the ledger of what was loaded.

A table is a folder of batches, each written once and entered once::

    root/batch-<id>/…parquet      rows of one try to load a batch
    root/_ledger/<name>.json      the entry of a batch: its folder, row count and content hash

An entry is created after its rows are written, which the file system does for one writer only. A reader
takes the folders that entries name, so a try that stopped half-way is not seen, and a batch
loaded again adds nothing. The content hash does not depend on the order or the split of rows; the same batch
with other rows is refused instead of being lost or doubled.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.sources.sinks import write_observed
from meridian.sources.versions import _create, _fs, _text


class BatchChanged(ValueError):
    """A batch of this id was loaded with other rows."""


@dataclass(frozen=True)
class Entry:
    batch: str
    folder: str
    rows: int
    content: str


def content_hash(df: DataFrame) -> F.Column:
    """Aggregate: equal for equal rows in any order, repeated rows counted; column names and types take part."""
    cols = sorted(df.columns)
    kinds = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in cols)
    # a null hashes to the seed, so the pattern of nulls is hashed too
    row = F.xxhash64(F.lit(kinds), *cols, F.concat(*[F.col(c).isNull().cast("string") for c in cols]))
    return F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string")


def entries(spark: SparkSession, root: str) -> dict[str, Entry]:
    """The ledger: what each batch holds (one small file per batch; unfilled ones are passed over)."""
    fs, p = _fs(spark, f"{root}/_ledger")
    if not fs.exists(p):
        return {}
    texts = [_text(spark, s.getPath().toString()) for s in fs.listStatus(p)]
    found = [Entry(**json.loads(t)) for t in texts if t.endswith("}")]
    return {e.batch: e for e in found}


def append_batch(df: DataFrame, root: str, batch: str) -> Entry:
    """Loads ``df`` as ``batch`` once, and returns its ledger entry.

    A batch that is there with equal content is left alone; with other content, :class:`BatchChanged` is raised.
    Rows, count and hash come from one pass: the hash is taken while the rows are written.
    """
    spark = df.sparkSession
    path = f"{root}/_ledger/{quote(batch, safe='')}.json"
    folder = f"batch-{uuid.uuid4().hex}"
    seen = write_observed(df, f"{root}/{folder}", {"rows": F.count(F.lit(1)), "content": content_hash(df)})
    new = Entry(batch, folder, int(seen["rows"]), seen["content"])
    if _create(spark, path, json.dumps(new.__dict__)):
        return new
    old = entries(spark, root).get(batch)
    if old is None:                      # a writer stopped between creating and filling the entry
        _fs(spark, path)[0].delete(_fs(spark, path)[1], False)
        if _create(spark, path, json.dumps(new.__dict__)):
            return new
        old = entries(spark, root)[batch]
    if (old.rows, old.content) != (new.rows, new.content):
        raise BatchChanged(f"{root}: batch {batch!r} was loaded with {old.rows} other rows, now {new.rows}")
    return old


def read_batches(spark: SparkSession, root: str, schema: T.StructType, batches=None) -> DataFrame:
    """Rows of all (or the given) entered batches, with the column ``batch``."""
    out = spark.createDataFrame([], schema).withColumn("batch", F.lit("").cast("string"))
    found = [e for b, e in sorted(entries(spark, root).items()) if batches is None or b in batches]
    if not found:
        return out
    names = F.create_map(*[F.lit(x) for e in found for x in (e.folder, e.batch)])
    rows = spark.read.schema(schema).parquet(*[f"{root}/{e.folder}" for e in found])
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"(batch-[0-9a-f]{32})/[^/]*$", 1)
    return rows.select(*schema.fieldNames(), names[folder].alias("batch"))
