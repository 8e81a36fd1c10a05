"""Packing into length buckets with optimal boundaries.

Lengths are word counts; a text longer than ``max_len`` is cut into pieces of at most that
many tokens, so nothing is dropped. A global histogram (at most ``max_len`` rows) goes to a
dynamic program that chooses the ``buckets`` upper bounds with the least padding when every piece
is padded to its bucket's bound. Inside a bucket, pieces are numbered and
``floor(token_budget / bound)`` of them (at least one) form a batch.

Numbering is distributed: each bucket is cut into slices by a hash (about ``SLICE`` pieces
each), slices are numbered on their own, and running totals of the slice sizes shift them. So a
bucket may hold most of the corpus and still no task sees more than a slice. Copies of a row that is
repeated over ``COPIES`` times are dealt over slices by their row number in the written table.

Defined results: null or blank text has length 0 and one row without bucket, batch or
place; ties in the program take the smaller bound; repeated rows are packed one by one; with
fewer distinct lengths than buckets, every length is its own bound; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import small, written

MAX_LEN = 2048
BUCKETS = 16
TOKEN_BUDGET = 65_536
SLICE = 50_000
COPIES = 1_000


def count_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def optimal_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds (ascending; the last is the largest length) with the least total padding."""
    order = np.argsort(lengths, kind="stable")
    x, c = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(x)
    if n <= buckets:
        return x.tolist()
    # cost of one bucket over x[i..j]: x[j] * rows - tokens; prefix sums make it O(1)
    rows, tokens = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * x)])
    best = x * rows[1:] - tokens[1:]
    choice = np.zeros((buckets, n), np.int64)
    for k in range(1, buckets):
        nxt = best.copy()
        for j in range(k, n):
            i = np.arange(k, j + 1)                  # the last bucket starts at x[i]
            cost = best[i - 1] + x[j] * (rows[j + 1] - rows[i]) - (tokens[j + 1] - tokens[i])
            at = int(np.argmin(cost))
            nxt[j], choice[k, j] = cost[at], i[at]
        best = nxt
    out, j = [], n - 1
    for k in range(buckets - 1, -1, -1):
        out.append(int(x[j]))
        j = int(choice[k, j]) - 1
        if j < 0:
            break
    return sorted(out)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_len: int = MAX_LEN, buckets: int = BUCKETS,
         token_budget: int = TOKEN_BUDGET, length: Column | None = None) -> DataFrame:
    """One row per piece: id, piece, first_token, n_tokens, bucket, batch, slot, padding.

    ``batch`` counts from 0 inside a bucket (named by its bound); ``length`` is another token
    count, if given.
    """
    size = count_words(F.col(text_col).cast("string")) if length is None else length
    docs = written(df.select(F.col(id_col).alias("id"), size.cast("long").alias("n"), F.xxhash64(F.col(text_col).cast("string")).alias("th"),
                             F.monotonically_increasing_id().alias("row")), "lengths")
    # rows repeated whole: at most rows / COPIES keys
    often = written(docs.filter("n > 0").groupBy("id", "th").agg(F.count("*").alias("c")).filter(F.col("c") > COPIES)
                    .select(F.col("id").alias("o_id"), F.col("th").alias("o_th"), "c"), "often")
    dealt_by = (docs.filter("n > 0").join(small(often, 40 * often.count()), F.col("id").eqNullSafe(F.col("o_id")) & (F.col("th") == F.col("o_th")), "left")
                .select("id", "n", "th", F.when(F.col("c").isNotNull(), F.pmod(F.xxhash64("row"), F.ceil(F.col("c") / COPIES))).otherwise(0).alias("part")))
    pieces = (dealt_by.select("id", "n", "th", "part", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / max_len).cast("int"))).alias("piece"))
              .withColumn("first", F.col("piece").cast("long") * max_len)
              .withColumn("len", F.least(F.lit(max_len), F.col("n") - F.col("first")).cast("int")))
    hist = pieces.groupBy("len").agg(F.count("*").alias("c")).orderBy("len").collect()      # at most max_len rows
    bounds = optimal_bounds([r["len"] for r in hist], [r["c"] for r in hist], buckets)
    none = docs.filter("n = 0").select(
        F.col("id").alias(id_col), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("first_token"), F.lit(0).alias("n_tokens"),
        *(F.lit(None).cast(k).alias(c) for c, k in (("bucket", "int"), ("batch", "long"), ("slot", "int"), ("padding", "int"))))
    if not bounds:
        return none
    per = {b: sum(r["c"] for r in hist if r["len"] <= b) for b in bounds}
    rows_in = {b: per[b] - (per[bounds[i - 1]] if i else 0) for i, b in enumerate(bounds)}
    bucket, cut = F.lit(bounds[-1]), F.lit(max(1, -(-rows_in[bounds[-1]] // SLICE)))
    for b in reversed(bounds[:-1]):
        bucket = F.when(F.col("len") <= b, F.lit(b)).otherwise(bucket)
        cut = F.when(F.col("len") <= b, F.lit(max(1, -(-rows_in[b] // SLICE)))).otherwise(cut)
    dealt = pieces.select("id", "th", "part", "piece", "first", "len", bucket.alias("bucket"),
                          F.pmod(F.xxhash64("id", "th", "piece", "part"), cut).cast("int").alias("slice"))
    # where each slice starts in its bucket; slices number total rows / SLICE
    ahead = (dealt.groupBy("bucket", "slice").agg(F.count("*").alias("c"))
             .withColumn("ahead", F.sum("c").over(Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)))
             .select("bucket", "slice", F.coalesce("ahead", F.lit(0)).alias("ahead")))
    place = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("id", "piece", "th")) - 1
    cap = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket")))
    return (dealt.withColumn("place", place).join(ahead, ["bucket", "slice"])
            .withColumn("place", F.col("place") + F.col("ahead")).withColumn("cap", cap)
            .select(F.col("id").alias(id_col), "piece", F.col("first").alias("first_token"), F.col("len").alias("n_tokens"), "bucket",
                    F.floor(F.col("place") / F.col("cap")).cast("long").alias("batch"),
                    (F.col("place") % F.col("cap")).cast("int").alias("slot"), (F.col("bucket") - F.col("len")).alias("padding"))
            .unionByName(none))
