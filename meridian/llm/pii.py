"""Personal data: fixed base patterns, and identifiers found by bootstrapped contexts.

Base spans (email, ip, card, phone) come from fixed patterns; they are the seeds. The words
around a seed are lexical patterns (two words before; word before and word after). All
other identifier-like tokens (six or more characters with three or more digits, or with an
``@``), and runs of neighbouring numbers (with spaces, dots, hyphens and brackets) as a whole, are
candidate instances of the same patterns; the words of a run give way to the run if it is accepted. Spark scores the pattern-instance
graph in rounds: a pattern's confidence for a kind is the share of its instances that are
known to be of that kind (smoothed), an instance's is the noisy-or of its good patterns;
instances above ``accept`` join the seeds of the next round. In the end, candidates that are
accepted become spans of kind ``ctx_<kind>``. Base spans are never changed.

Edges are pre-aggregated per (pattern, instance), sums per pattern and instance are partial
aggregates, and each round is a written table, so a frequent word pair or a repeated number
does not gather rows.

Defined results: null text counts as empty and has no spans; a row without spans has an
empty string and the hash of the empty string; repeated rows get equal results; spans of
added kinds never overlap base spans; null ids are kept; other columns are ignored; an
empty table gives an empty result. Offsets are code points of the whole text, end exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import slices, small, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: A pattern counts from this confidence, an instance is accepted from that one.
GOOD_PATTERN, ACCEPT = 0.7, 0.85

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@]")
_RUN = re.compile(r"[0-9](?:(?:\)[.-]|\x20?[()-]\x20?|\)\x20\(|[.\x20]|\x20\x20)?[0-9])++")
_EDGE = "\"'()[]{}<>,;:!?.%$#*&="


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(t):
    done, at = 0, t.find("@")
    while at >= 0:
        i = at
        while i > done and t[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(t, at + 1) if i < at else None
        if m:
            yield i, 0, m.end()
            done = m.end()
        at = t.find("@", max(at + 1, done))


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, by start, then kind."""
    out = list(_emails(t)) if "@" in t else []
    if _DIGIT.search(t):
        if "." in t:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(t)
                    if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 14:
                d = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(d) <= 19 and _luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in t:
            for m in _PHONE.finditer(t):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _h(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) - (1 << 63)


def _patterns(t, start, end):
    left = [w.strip(_EDGE).lower() for w in t[max(0, start - 200):start].split()[-2:]]
    right = [w.strip(_EDGE).lower() for w in t[end:end + 100].split()[:1]]
    out = []
    if len(left) == 2 and all(left):
        out.append(_h(f"L {left[0]} {left[1]}"))
    if left and right and left[-1] and right[0]:
        out.append(_h(f"M {left[-1]} | {right[0]}"))
    return out


def _runs(t, taken):
    """(start, end) of neighbouring numbers of more than one token between the base spans."""
    pos = 0
    for lo, hi in [*taken, (len(t), len(t))]:
        for m in _RUN.finditer(t, pos, max(pos, lo)):
            a, z = m.span()
            if a and not (t[a - 1].isspace() or t[a - 1] in _EDGE or t[a - 1] in "+-"):     # glued to a word
                a = next((i + 1 for i in range(a, z) if t[i] == " "), z)
            if z < len(t) and not (t[z].isspace() or t[z] in _EDGE or t[z] == "-"):
                z = next((i for i in range(z - 1, a, -1) if t[i] == " "), a)
            while a < z and not "0" <= t[a] <= "9":
                a += 1
            while z > a and not "0" <= t[z - 1] <= "9":
                z -= 1
            x = t[a:z]
            if len(x) < 6 or " " not in x or sum("0" <= c <= "9" for c in x) < 3:
                continue
            if x.count(")") > x.count("(") and a > pos and t[a - 1] == "(":
                a -= 1
            if a > pos and t[a - 1] == "+":
                a -= 1
            yield a, z
        pos = max(pos, hi)


def _candidates(t, spans):
    """(start, end, text, start of the run or else its own) of identifier-like tokens and runs outside the base spans."""
    pos, n, taken = 0, len(t), sorted((a, z) for a, _, z in spans)
    runs = list(_runs(t, taken))
    for a, z in runs:
        yield a, z, t[a:z], a
    at = 0
    while (m := _SIGN.search(t, pos)) is not None:
        a = z = m.start()
        while a > pos and not t[a - 1].isspace():
            a -= 1
        while z < n and not t[z].isspace():
            z += 1
        pos = z
        while a < z and t[a] in _EDGE:
            a += 1
        while z > a and t[z - 1] in _EDGE:
            z -= 1
        token = t[a:z]
        if len(token) >= 6 and ("@" in token or sum("0" <= c <= "9" for c in token) >= 3) and not any(x < z and a < y for x, y in taken):
            while at < len(runs) and runs[at][1] <= a:
                at += 1
            yield a, z, token, runs[at][0] if at < len(runs) and runs[at][0] < z else a


_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
_SEED = pa.struct([("rank", pa.int32()), ("inst", pa.int64()), ("pats", pa.list_(pa.int64()))])
_CAND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("run", pa.int32()), ("inst", pa.int64()), ("pats", pa.list_(pa.int64()))])


def _scan(schema):
    def run(batches):
        for b in slices(batches, "text"):
            base, seeds, cands = [], [], []
            for t in b.column("text").to_pylist():
                if not t or not _SIGN.search(t):
                    base.append([])
                    seeds.append([])
                    cands.append([])
                    continue
                found = base_spans(t)
                base.append([{"start": a, "rank": k, "end": z} for a, k, z in found])
                seeds.append([{"rank": k, "inst": _h(t[a:z]), "pats": _patterns(t, a, z)} for a, k, z in found])
                cands.append([{"start": a, "end": z, "run": r, "inst": _h(x), "pats": _patterns(t, a, z)} for a, z, x, r in _candidates(t, found)])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(base, pa.list_(_SPAN)), pa.array(seeds, pa.list_(_SEED)), pa.array(cands, pa.list_(_CAND))],
                schema=schema)
    return run


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, base, seeds, cands) of every row, as a written table."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                    F.xxhash64(F.col(text_col).cast("string")).alias("th"))
    kind = src.schema["id"].dataType
    sch = pa.schema([("id", to_arrow_type(kind)), ("th", pa.int64()), ("base", pa.list_(_SPAN)), ("seeds", pa.list_(_SEED)), ("cands", pa.list_(_CAND))])
    return written(src.mapInArrow(_scan(sch), f"id {kind.simpleString()}, th long, "
                   "base array<struct<start:int,rank:int,end:int>>, seeds array<struct<rank:int,inst:long,pats:array<long>>>, "
                   "cands array<struct<start:int,end:int,run:int,inst:long,pats:array<long>>>"), "pii-scan")


def score(scanned: DataFrame, *, rounds: int = ROUNDS, good: float = GOOD_PATTERN, accept: float = ACCEPT) -> DataFrame:
    """(inst, rank): candidate instances accepted as identifiers of a kind."""
    seeds = scanned.select(F.explode("seeds").alias("s")).select("s.rank", "s.inst", F.explode("s.pats").alias("pat"))
    cands = scanned.select(F.explode("cands").alias("c")).select("c.inst", F.explode("c.pats").alias("pat"))
    useful = seeds.select("pat").distinct()
    edges = written(seeds.select("pat", "inst").unionByName(cands.join(useful, "pat", "left_semi").select("pat", "inst"))
                    .groupBy("pat", "inst").agg(F.count("*").alias("n"))
                    .withColumn("w", F.log2(F.col("n") + 1)), "pii-edges")     # a repeated pair counts less than new ones
    known = written(seeds.groupBy("inst").agg(F.min("rank").alias("rank")).withColumn("conf", F.lit(1.0)), "pii-known")
    fresh = edges.select("inst").distinct().join(known.select("inst"), "inst", "left_anti")
    total = edges.groupBy("pat").agg(F.sum("w").alias("all"))
    for _ in range(rounds):
        hits = edges.join(known, "inst").groupBy("pat", "rank").agg(F.sum(F.col("w") * F.col("conf")).alias("hit"), F.count("*").alias("support"))
        conf = (hits.join(total, "pat").withColumn("conf", F.col("hit") / (F.col("all") + 1))
                .filter((F.col("support") >= 2) & (F.col("conf") >= good)))
        best = (edges.join(fresh, "inst").join(conf.select("pat", "rank", F.col("conf").alias("p")), "pat")
                .groupBy("inst", "rank").agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("p"), F.lit(0.999)))))).alias("conf"))
                .filter(F.col("conf") >= accept)
                .groupBy("inst").agg(F.max(F.struct("conf", (-F.col("rank")).alias("r"))).alias("b"))
                .select("inst", (-F.col("b.r")).alias("rank"), "b.conf"))
        known = written(seeds.groupBy("inst").agg(F.min("rank").alias("rank")).withColumn("conf", F.lit(1.0)).unionByName(best), "pii-known")
    return known.join(fresh, "inst").select("inst", "rank")


def added_spans(scanned: DataFrame, accepted: DataFrame) -> DataFrame:
    """(id, th, added): spans of accepted candidates, one row per distinct (id, text). An accepted run replaces its tokens."""
    one = scanned.select("id", "th", F.explode("cands").alias("c")).select("id", "th", "c.start", "c.end", "c.run", "c.inst")
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("rank") + len(KINDS)).alias("rank"), "end")))
    widest = F.aggregate("s", F.lit(0), lambda z, x: F.greatest(z, x["end"]))
    kept = F.filter("s", lambda x: (x["end"] == F.col("last")) & (x["start"] == F.col("run")))
    return (one.join(accepted, "inst").groupBy("id", "th", "run").agg(spans.alias("s")).withColumn("last", widest)
            .withColumn("s", F.when(F.size(kept) > 0, kept).otherwise(F.col("s")))
            .select("id", "th", F.explode("s").alias("s"))
            .groupBy("id", "th").agg(F.collect_set("s").alias("added")))


_NAMES = (*KINDS, *(f"ctx_{k}" for k in KINDS))


def _join_spans(col: str):
    name = F.array(*(F.lit(x) for x in _NAMES))
    return F.array_join(F.transform(F.array_sort(col), lambda s: F.concat_ws(
        ":", F.element_at(name, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base, spans (arrays of start, rank, end; see ``KINDS``)."""
    scanned = scan(df, id_col, text_col)
    extra = written(added_spans(scanned, score(scanned)), "pii-added").withColumnsRenamed({"id": "a_id", "th": "a_th"})
    n = extra.agg(F.coalesce(F.sum(F.size("added") * 16 + 48), F.lit(0)).alias("n")).first()["n"]
    return (scanned.join(small(extra, n), F.col("id").eqNullSafe(F.col("a_id")) & F.col("th").eqNullSafe(F.col("a_th")), "left")
            .select(F.col("id").alias(id_col), "base",
                    F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added")).alias("spans")))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")      # (a second parameter would be the index)
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(_join_spans("base"), 256).alias("base_sha256"), _join_spans("spans").alias("spans"))


def _redact(schema, at):
    def run(batches):
        for b in slices(batches, "__text"):
            out = []
            for t, extra in zip(b.column("__text").to_pylist(), b.column("__added").to_pylist()):
                spans = base_spans(t) if t and _SIGN.search(t) else []
                spans = sorted([*spans, *((s["start"], s["rank"], s["end"]) for s in extra or ())])
                if not spans:
                    out.append(t)
                    continue
                parts, pos = [], 0
                for a, k, z in spans:                # overlapping spans: one mark covers them
                    if a >= pos:
                        parts += [t[pos:a], f"[{_NAMES[k].removeprefix('ctx_').upper()}]"]
                    pos = max(pos, z)
                out.append("".join([*parts, t[pos:]]))
            cols = [b.column(c) for c in schema.names]
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, schema=schema)
    return run


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``df`` with every span of the text replaced by ``[KIND]``."""
    scanned = scan(df, id_col, text_col)
    extra = written(added_spans(scanned, score(scanned)), "pii-added")
    n = extra.agg(F.coalesce(F.sum(F.size("added") * 16 + 48), F.lit(0)).alias("n")).first()["n"]
    names = [f"c{i}" for i in range(len(df.columns))]
    at = df.columns.index(text_col)
    plain = df.select(*(F.col(c).alias(n) for c, n in zip(df.columns, names)))
    extra = extra.withColumnsRenamed({"id": "__id", "th": "__th", "added": "__added"})
    rows = (plain.withColumn("__text", F.col(names[at]).cast("string"))
            .join(small(extra, n), F.col(names[df.columns.index(id_col)]).eqNullSafe(F.col("__id"))
                  & F.xxhash64("__text").eqNullSafe(F.col("__th")), "left").select(*names, "__text", "__added"))
    kinds = rows.select(*names).schema
    kinds[at].dataType = rows.schema["__text"].dataType
    sch = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kinds])
    return rows.mapInArrow(_redact(sch, at), kinds).toDF(*df.columns)
