"""Document fingerprints by SpotSigs, with DataFrame functions only.

A text is lower-cased and cut into words of letters and digits. Common words of four
languages are *anchors*; the two content words after a run of anchors (anchors in between
skipped) form one spot signature. The fingerprint is the sorted set of the signatures' 32-bit
hashes, written as eight hex digits each. A text without spots takes every pair of
neighbouring words instead; a single word, or a text without any, is its own signature.

The likeness of two fingerprints is the Jaccard index of their sets.
:func:`near_duplicates` compares whole collections: sets are partitioned by length so that
only neighbouring partitions can hold a pair over the threshold, each set is posted under a
prefix of its rarest signatures, and pairs are pruned by length before the sets are met.

Comparing each document with its successor needs one global order without one global task:
documents are dealt into ranges of the id at sampled bounds, each range is sorted on its own,
and the head of every range is sent to the range before it as well.

Defined results: null text counts as empty; an empty text has an empty fingerprint; two
empty fingerprints have likeness 1, an empty and another 0; rows with one id follow each other
in the order of their text hashes; null ids come last; the only document of a table is its own
successor; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import shuffle_partitions, written

#: Anchors: common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he in is it its not of on or that the this to was were which with "
    "au aux avec ce ces dans de des du elle en est et il la le les leur ne ou par pas pour que qui se son sur un une "
    "als auch auf aus das dem den der die ein eine einem einen einer es für ich im ist mit nicht sich sie und von zu zum zur "
    "al como con del el era esta la las lo los más no para pero por su sus y"
).split()
CHAIN = 2
#: Ranges of the id: about so many per shuffle partition, and at most so many in all.
RANGES_PER_PARTITION, MOST_RANGES = 4, 8192


def _trie_pattern(words) -> str:
    """A regular expression for a word list that shares common beginnings."""
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def build(node):
        options = [c + build(rest) for c, rest in sorted(node.items()) if c]
        if not options:
            return ""
        body = options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")"
        return f"(?:{body})?" if "" in node else body
    return build(tree)


#: No repeated groups: Java's matcher would recurse once per repetition on a long run of anchors.
_ANCHOR = r"(?<= )" + _trie_pattern(sorted(set(ANCHORS))) + " "
_SPOT = "~(?=([^ ~]+" + r" ~*[^ ~]+" * (CHAIN - 1) + ") )"
_PAIR = "(?<= )(?=([^ ]+ [^ ]+) )"


def _hashes(strings: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(strings, lambda x: F.hash(F.translate(x, "~", "")))))


def signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sorted set of spot signatures (array<int>) of a text column."""
    plain, spots = f"{out}__p", f"{out}__s"
    df = df.withColumn(plain, F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " ")), F.lit(" ")))
    df = df.withColumn(spots, F.regexp_extract_all(F.regexp_replace(F.col(plain), _ANCHOR, "~"), F.lit(_SPOT), F.lit(1)))
    rest = F.when(F.size(spots) > 0, F.col(spots)).otherwise(F.regexp_extract_all(plain, F.lit(_PAIR), F.lit(1)))
    df = df.withColumn(spots, rest)
    alone = F.when(F.trim(F.col(plain)) != "", F.array(F.trim(F.col(plain)))).when(F.length(text) > 0, F.array(F.col(text))).otherwise(F.array().cast("array<string>"))
    return df.withColumn(out, _hashes(F.when(F.size(spots) > 0, F.col(spots)).otherwise(alone))).drop(plain, spots)


def fingerprint_text(sigs: Column) -> Column:
    """The fingerprint as a string: eight hex digits for each signature."""
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(
        both / (F.size(a) + F.size(b) - both))


def _in_ranges(src: DataFrame) -> DataFrame:
    """Rows with ``part`` (their id range) and ``extra``: heads repeated for the range before.

    Descending by id, the row after a range's last row is the head of the next range (after
    the last range: of the first).
    """
    spark = src.sparkSession
    n = min(MOST_RANGES, max(2, RANGES_PER_PARTITION * shuffle_partitions(spark)))
    cuts = sorted(set(src.approxQuantile("id", [i / n for i in range(1, n)], 0.1 / n)))
    part = F.size(F.filter(F.array(*(F.lit(int(c)) for c in cuts)), lambda c: c <= F.col("id"))) if cuts else F.lit(0)
    src = src.withColumn("part", F.when(F.col("id").isNull(), F.lit(-1)).otherwise(part))
    heads = sorted(((r["part"], r["head"]) for r in src.groupBy("part").agg(F.max("id").alias("head")).collect()), reverse=True)
    to = F.lit(None).cast("int")                                    # at most MOST_RANGES + 1 heads
    if heads:
        before = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}     # of the first: the last
        pairs = F.create_map(*(F.lit(x) for p, h in heads for x in (p, before[p])))
        tops = F.create_map(*(x for p, h in heads for x in (F.lit(p), F.lit(h).cast("long"))))
        to = F.when(F.col("id").eqNullSafe(tops[F.col("part")]), pairs[F.col("part")])
    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("extra"))
    there = F.struct(to.alias("part"), F.lit(True).alias("extra"))
    return (src.withColumn("to", F.explode(F.when(to.isNotNull(), F.array(here, there)).otherwise(F.array(here))))
            .select("id", "text", "th", F.col("to.part").alias("part"), F.col("to.extra").alias("extra")))


def fingerprint_with_edit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next one's are.

    The edited text replaces the last floor(n / 3) code points by the first as many of
    the next document's (all of them, if it has fewer), descending by id, the first after the last.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("th", F.xxhash64("text"))
    order = Window.partitionBy("part").orderBy("extra", F.col("id").desc_nulls_last(), "th")
    rows = _in_ranges(src).withColumn("n", F.char_length("text")).withColumn("k", F.floor(F.col("n") / 3).cast("int"))
    rows = rows.withColumn("next", F.lead("text").over(order))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("k")), F.substring(F.coalesce("next", F.lit("")), F.lit(1), F.col("k")))).drop("next")
    rows = signatures(signatures(rows, "text", "sig"), "edited", "sig_edited")
    rows = rows.select("id", "th", "part", "extra", "n", F.sha2("edited", 256).alias("edited_sha256"), "sig", "sig_edited")
    rows = rows.withColumn("sig_next", F.lead("sig").over(order)).filter("not extra")
    return rows.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
                       fingerprint_text(F.col("sig")).alias("fingerprint"), fingerprint_text(F.col("sig_edited")).alias("edited_fingerprint"),
                       likeness(F.col("sig"), F.col("sig_edited")).alias("near_edited"),
                       likeness(F.col("sig"), F.col("sig_next")).alias("near_next"))


def near_duplicates(df: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): class of every document, and the alike pairs of classes.

    ``members`` (id, rep): documents with equal fingerprints share a class, named by its smallest id.
    ``pairs`` (a, b, likeness): classes a < b whose sets reach the threshold. Empty sets pair with none.
    """
    sigs = written(signatures(df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")), "text", "sig")
                   .select("id", "sig", F.sha2(fingerprint_text(F.col("sig")), 256).alias("key")), "spots")
    reps = sigs.groupBy("key").agg(F.min("id").alias("rep"))
    members = sigs.select("id", "key").join(reps, "key").select("id", "rep")
    sets = written(sigs.join(reps, "key").filter((F.col("id") == F.col("rep")) & (F.size("sig") > 0)).dropDuplicates(["key"])
                   .select("rep", "sig", F.size("sig").alias("n")), "spot-sets")
    # length partitions grow by 1 / threshold: a pair over it lies in one or in two neighbours
    step = -F.log(F.lit(threshold))
    cell = F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    posts = sets.select("rep", "n", F.explode("sig").alias("s"))
    often = posts.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    rank = F.row_number().over(Window.partitionBy("rep").orderBy(F.coalesce("df", F.lit(1)), "s"))
    prefix = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    posts = (posts.join(often, "s", "left").withColumn("r", rank).filter(F.col("r") <= prefix).filter("df is not null")
             .withColumn("cell", cell).select("rep", "n", "s", "cell"))
    left = posts.select(F.col("rep").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell"))
    right = posts.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "s", "cell")
    meet = (left.join(right, ["cell", "s"])
            .filter((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
            .filter(F.col("na") >= F.lit(threshold) * F.col("nb") - 1e-9).select("a", "b").distinct())
    one, two = (sets.select(F.col("rep").alias(x), F.col("sig").alias(f"s{x}")) for x in ("a", "b"))
    pairs = meet.join(one, "a").join(two, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).filter(F.col("likeness") >= threshold)
    return members, pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
