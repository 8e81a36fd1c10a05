"""Benchmark decontamination by latent semantic retrieval.

1. *TF-IDF.* Every document is cut into passages of ``PASSAGE`` words; document frequencies of
   hashed terms are counted over all passages of all documents.
2. *Distributed randomised SVD.* With A (passages x terms) and a fixed Gaussian sketch S, one pass
   sums G = Y'Y and Z = A'Y for Y = A S; with the Cholesky factor R of G, Q = Y R^-1 is an
   orthonormal basis of the sketched range and Z R^-1 = A'Q. Its small SVD gives the right
   singular vectors and values. Only sums of (terms x sketch) size leave a task, and they are
   added in two levels.
3. *Candidate search.* Words become chunks of ``CHUNK`` words in latent space (scaled by the
   singular values); running sums give every window of chunks. A window just long enough to
   hold an item at any offset is compared with it by cosine; pairs from ``cosine`` on are candidates.
4. *Checks.* Most of the item's rarest words (its answer terms) must occur in the window, and the
   longest common subsequence of their words must reach ``lcs`` of the item.

The answer check is pushed below the search: a window with fewer answer terms of any item than the
least any item needs can't pass, so only the other windows are projected and compared.

Words in more than ``STOP_SHARE`` of the passages carry no weight, unless an item uses them. An item
whose vector is so small that the words around a copy could hide it skips the cosine: all
windows that hold enough of its answer terms go to the subsequence check.

All items are compared with all windows, in blocks of items. Defined results: null, empty
or blank texts and items match nothing; an item of fewer than eight words must occur whole
(in order); of a document's several places of one item the best is returned (ties: the first);
rows with one id and different texts give one row each; null ids are kept; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import LOWER, NON_WORD, fresh_names, slices, small, text_buffer, word_table, written

TERMS = 1 << 15
PASSAGE, CHUNK = 32, 8
SKETCH, RANK = 48, 40
COSINE, LCS = 0.35, 0.6
#: Terms in more than this share of the passages carry no weight, unless an item uses them.
STOP_SHARE = 0.1
#: Least weight of an item's term; cosine with a copy among average words from which an item is searched by it.
IDF_FLOOR, CLEAR = 0.1, 0.8
#: Answer terms of an item, and the share of them that must occur.
ANSWER_TERMS, ANSWER_SHARE = 8, 0.5
#: Items compared in one pass over the documents; more items take more passes.
ITEM_BLOCK = 20_000
_BLOCK = 1024
_BYTES = 512 << 10
SEED = 4


def _terms(batch):
    """Word hashes, their terms and the first word of each text."""
    _, _, h, first = word_table(*text_buffer(batch.column("text")), NON_WORD, LOWER)
    return h, (h & np.uint64(TERMS - 1)).astype(np.uint16), first


def _starts(first: np.ndarray, size: int) -> np.ndarray:
    """First word of every piece of ``size`` words; pieces don't cross texts."""
    n = -(-np.diff(first) // size)
    base = np.repeat(first[:-1], n)
    return base + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * size


def _segments(values: np.ndarray, ids: np.ndarray, live: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[ids]`` over the live words from each start to the next, a bounded block at a time."""
    out = np.zeros((len(starts), values.shape[1]), np.float32)
    at = np.append(np.searchsorted(live, starts), len(live))
    some = np.flatnonzero(at[1:] > at[:-1])
    for i in range(0, len(some), 2048):
        s = some[i:i + 2048]
        lo = at[s[0]]
        out[s] = np.add.reduceat(values[ids[live[lo:at[s[-1] + 1]]]], at[s] - lo, axis=0)
    return out


@lru_cache(maxsize=1)
def _sketch() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TERMS, SKETCH)).astype(np.float32)


def _out(parts: dict[int, np.ndarray], level: int):
    """Blocks of a (terms x n) sum as rows (block, salt, ids, values); only terms that occur."""
    part = TaskContext.get().partitionId() // 32 if level == 0 else 0
    for block, m in sorted(parts.items()):
        ids = np.flatnonzero(m.any(1)).astype(np.uint16)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([m[ids].tobytes()], pa.binary())],
            ["block", "salt", "ids", "vals"])


_DDL = "block int, salt int, ids binary, vals binary"


def _total(width: int, level: int):
    def run(batches):
        parts: dict[int, np.ndarray] = {}
        at = None
        for b in batches:
            for block, salt, ids, vals in zip(*(b.column(c).to_pylist() for c in ("block", "salt", "ids", "vals"))):
                if at is not None and at != (block, salt):
                    yield from _out(parts, level)
                    parts = {}
                at = (block, salt)
                m = parts.setdefault(block, np.zeros((_BLOCK, width), np.float64 if level else np.float32))
                kind = np.float32 if level < 2 else np.float64
                m[np.frombuffer(ids, np.uint16)] += np.frombuffer(vals, kind).reshape(-1, width)
        if parts:
            yield from _out(parts, level)
    return run


def _summed(rows: DataFrame, width: int) -> np.ndarray:
    """The (terms + extra blocks) x width sum of per-task blocks, added in two levels."""
    one = (rows.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(_total(width, 1), _DDL))
    two = one.repartition("block").sortWithinPartitions("block").mapInArrow(_total(width, 2), _DDL)
    got = two.select("block", "ids", "vals").collect()           # at most TERMS x width numbers
    out = np.zeros((TERMS + _BLOCK, width))
    for r in got:
        out[r["block"] * _BLOCK + np.frombuffer(r["ids"], np.uint16).astype(np.int64)] += np.frombuffer(r["vals"], np.float64).reshape(-1, width)
    return out


def _as_blocks(m: np.ndarray) -> dict[int, np.ndarray]:
    return {i: m[i * _BLOCK:(i + 1) * _BLOCK] for i in range(len(m) // _BLOCK) if m[i * _BLOCK:(i + 1) * _BLOCK].any()}


def _count_terms(batches):
    df = np.zeros((TERMS + _BLOCK, 1), np.float32)
    exact = np.zeros(TERMS + 1, np.int64)
    for b in slices(batches, "text", _BYTES):
        _, ids, first = _terms(b)
        starts = _starts(first, PASSAGE)
        if not len(ids):
            continue
        passage = np.zeros(len(ids), np.uint32 if len(starts) < 1 << 17 else np.uint64)
        passage[starts[1:]] = TERMS
        pair = np.sort(np.cumsum(passage, dtype=passage.dtype) + ids)
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        exact[:TERMS] += np.bincount((pair[new] & passage.dtype.type(TERMS - 1)).astype(np.int64), minlength=TERMS)
        exact[TERMS] += len(starts)
    df[:TERMS + 1, 0] = exact
    yield from _out(_as_blocks(df), 0)


def _idf(counts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Weights of the terms; ``own`` marks those of the items."""
    df, n = counts[:TERMS, 0], counts[TERMS, 0]
    idf = np.where(df > 0, np.log((n + 1) / (df + 1)) + 1e-3, 0)
    often = df > max(STOP_SHARE * n, 10)
    return np.where(often, np.where(own, np.maximum(idf, IDF_FLOOR), 0), idf).astype(np.float32)


def _sketch_sums(idf_b):
    def run(batches):
        idf = idf_b.value
        s = _sketch() * idf[:, None]
        z = np.zeros((TERMS + _BLOCK, SKETCH), np.float32)
        for b in slices(batches, "text", _BYTES):
            _, ids, first = _terms(b)
            starts = _starts(first, PASSAGE)
            if not len(starts):
                continue
            w = idf[ids]
            live = np.flatnonzero(w)
            y = _segments(s, ids, live, starts)
            norm = np.sqrt(np.add.reduceat(w * w, starts))
            y /= np.maximum(norm, 1e-6)[:, None]
            z[TERMS:TERMS + SKETCH] += y.T @ y
            y /= np.maximum(norm, 1e-6)[:, None]
            passage = np.zeros(len(ids), np.int64)
            passage[starts[1:]] = 1
            passage = np.cumsum(passage)
            for i in range(0, len(live), 1 << 17):
                part = live[i:i + (1 << 17)]
                part = part[np.argsort(ids[part], kind="stable")]
                t = ids[part]
                cut = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                z[t[cut]] += np.add.reduceat(y[passage[part]], cut, axis=0)
        z[:TERMS] *= idf[:, None]
        yield from _out(_as_blocks(z), 0)
    return run


def latent_space(docs: DataFrame, items: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(idf, projection, clear): weights of the terms, the terms x RANK map into latent space,
    and the length from which an item's vector stands out among the words beside a copy."""
    sc = docs.sparkSession.sparkContext
    counts = _summed(docs.mapInArrow(_count_terms, _DDL), 1)
    idf = _idf(counts, _summed(items.mapInArrow(_count_terms, _DDL), 1)[:TERMS, 0] > 0)
    sums = _summed(docs.mapInArrow(_sketch_sums(sc.broadcast(idf)), _DDL), SKETCH)
    g, z = sums[TERMS:TERMS + SKETCH], sums[:TERMS]
    scale = max(float(np.trace(g)) / SKETCH, 1e-12)
    r = np.linalg.cholesky(g + 1e-6 * scale * np.eye(SKETCH)).T
    b = np.linalg.solve(r.T, z.T).T                              # Z R^-1 = A'Q
    val, vec = np.linalg.eigh(b.T @ b)
    val, vec = np.maximum(val[::-1][:RANK], 1e-12), vec[:, ::-1][:, :RANK]
    v = b @ (vec / np.sqrt(val))                                 # right singular vectors
    projection = (idf[:, None] * v / np.sqrt(val / val[0])).astype(np.float32)
    # squared length of the sum of the words beside a copy, drawn as they occur
    share = counts[:TERMS, 0] / max(counts[:TERMS, 0].sum(), 1)
    beside = 2 * (CHUNK - 1)
    noise = beside * float(share @ (projection.astype(np.float64) ** 2).sum(1)) + beside * (beside - 1) * float(((share @ projection) ** 2).sum())
    return idf, projection, float(CLEAR * np.sqrt(noise / (1 - CLEAR ** 2)))


class _Items:
    """The items of one block, with their window sizes and checks."""

    def __init__(self, rows, idf, projection, clear):
        self.weak: list[bool] = []
        self.ids, self.words, self.need, self.masks, self.answer, vectors, self.span = [], [], [], [], [], [], []
        for item, text in rows:
            buf = np.frombuffer((text or "").encode(), np.uint8)
            h = word_table(buf, np.array([0, len(buf)]), NON_WORD, LOWER)[2]
            if not len(h):
                continue
            t = (h & np.uint64(TERMS - 1)).astype(np.int64)
            v = projection[t].sum(0)
            norm = float(np.linalg.norm(v))
            mask: dict[int, int] = {}
            for i, x in enumerate(h.tolist()):
                mask[x] = mask.get(x, 0) | 1 << i
            rare = sorted(mask, key=lambda x: (-float(idf[x & (TERMS - 1)]), x))[:ANSWER_TERMS]
            self.ids.append(item)
            self.words.append(len(h))
            self.need.append(max(int(np.ceil(LCS * len(h) - 1e-9)), min(len(h), 8)))
            self.masks.append(mask)
            self.answer.append(frozenset(rare))
            vectors.append(v / norm if norm > 0 else v)
            self.weak.append(not norm > clear)
            self.span.append(-(-(len(h) - 1) // CHUNK) + 1)
        self.span, self.weak = np.array(self.span, np.int64), np.array(self.weak, bool)
        self.least = [int(np.ceil(ANSWER_SHARE * len(a) - 1e-9)) for a in self.answer]
        self.vectors = np.array(vectors, np.float32).reshape(-1, RANK)


def lcs_length(mask: dict[int, int], n: int, words: list[int]) -> int:
    """Longest common subsequence of an item (positions per word as bit masks) and a word list."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = mask.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _search(idf_b, proj_b, rows_b, clear, cosine, schema):
    def run(batches):
        idf, proj = idf_b.value, proj_b.value
        items = _Items(rows_b.value, idf, proj, clear)
        groups = [(int(s), np.flatnonzero(items.span == s)) for s in np.unique(items.span)]
        if not groups:
            return
        vocab = np.array(sorted({x for a in items.answer for x in a}), np.uint64)
        maybe = np.zeros(1 << 16, bool)
        maybe[vocab & np.uint64(0xFFFF)] = True
        least = {s: min(items.least[j] for j in which) for s, which in groups}
        pairs = sorted((x, j) for j in np.flatnonzero(items.weak).tolist() for x in items.answer[j])
        weak_word, weak_item = np.array([x for x, _ in pairs], np.uint64), np.array([j for _, j in pairs], np.int64)
        for b in slices(batches, "text", _BYTES):
            h, ids, first = _terms(b)
            starts = _starts(first, CHUNK)
            if not len(starts):
                continue
            at = np.flatnonzero(maybe[h & np.uint64(0xFFFF)])
            at = at[np.isin(h[at], vocab)]
            hits = np.searchsorted(at, np.append(starts, len(h)))       # answer terms before each chunk
            doc = np.searchsorted(first, starts, "right") - 1
            last = np.searchsorted(starts, first[doc + 1], "left")      # chunks of the document end here
            stops = {s: np.minimum(np.arange(len(starts)) + s, last) for s, _ in groups}
            able = {s: np.flatnonzero(hits[stops[s]] - hits[:-1] >= least[s]) for s, _ in groups}
            used = np.zeros(len(starts) + 1, np.int64)
            for s, rows in able.items():
                np.add.at(used, rows, 1)
                np.add.at(used, stops[s][rows], -1)
            used = np.cumsum(used[:-1]) > 0
            if not used.any():
                continue
            chunk = np.zeros(len(h), bool)
            chunk[idf[ids] > 0] = True
            live = np.flatnonzero(chunk & np.repeat(used, np.diff(np.append(starts, len(h)))))
            run_sum = np.zeros((len(starts) + 1, RANK), np.float64)
            np.cumsum(_segments(proj, ids, live, starts), axis=0, dtype=np.float64, out=run_sum[1:])
            best: dict[tuple[int, int], tuple] = {}
            direct = weak_hits(weak_word, weak_item, h[at], np.searchsorted(starts, at, "right") - 1)
            for span, which in groups:
                stop, rows = stops[span], able[span]
                win = (run_sum[stop[rows]] - run_sum[rows]).astype(np.float32)
                win /= np.maximum(np.sqrt((win * win).sum(1)), 1e-9)[:, None]
                for j in which[items.weak[which]].tolist():
                    if j not in direct:
                        continue
                    c = direct[j]                              # chunks of the item's answer terms
                    near = np.unique(np.maximum(np.unique(c)[:, None] - np.arange(span), 0))
                    near = near[np.searchsorted(c, stop[near]) - np.searchsorted(c, near) >= items.least[j]]
                    for c, k in zip(near.tolist(), np.searchsorted(rows, near).tolist()):
                        check(best, items, h, starts, stop, doc, first, c, j, float(win[k] @ items.vectors[j]))
                which = which[~items.weak[which]]
                for i in range(0, len(win), 8192):
                    for k in range(0, len(which), 1024):
                        part = which[k:k + 1024]
                        cos = win[i:i + 8192] @ items.vectors[part].T
                        for c, j in zip(*(x.tolist() for x in np.nonzero(cos >= cosine))):
                            check(best, items, h, starts, stop, doc, first, int(rows[i + c]), int(part[j]), float(cos[c, j]))
            if best:
                keys = sorted(best)
                pick = pa.array([k[0] for k in keys])
                vals = [best[k] for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pick), b.column("th").take(pick), pa.array([items.ids[k[1]] for k in keys], schema.field("item").type),
                     pa.array([v[2] for v in vals], pa.float64()), pa.array([v[0] for v in vals], pa.float64()),
                     pa.array([-v[1] for v in vals], pa.int64()), pa.array([v[3] for v in vals], pa.int64())], schema=schema)

    def weak_hits(word, item, found, chunk):
        """Chunks, in order, that hold an answer term, for each of the weak items."""
        lo, hi = np.searchsorted(word, found, "left"), np.searchsorted(word, found, "right")
        n = hi - lo
        if not n.any():
            return {}
        of = item[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        order = np.argsort(of, kind="stable")
        of, chunk = of[order], np.repeat(chunk, n)[order]
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
        return {int(of[a]): chunk[a:z] for a, z in zip(cut[:-1], cut[1:])}

    def check(best, items, h, starts, stop, doc, first, c, j, cos):
        lo = int(starts[c])
        hi = int(starts[stop[c]]) if stop[c] < len(starts) else int(first[-1])
        words = h[lo:hi].tolist()
        answer = items.answer[j]
        if len(answer.intersection(words)) < ANSWER_SHARE * len(answer):
            return
        n = lcs_length(items.masks[j], items.words[j], words)
        if n < items.need[j]:
            return
        d = int(doc[c])
        found = (n / items.words[j], -(lo - int(first[d])), cos, hi - int(first[d]))
        if best.get((d, j), (0,)) < found:
            best[d, j] = found
    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, cosine: float) -> DataFrame:
    """(id, th, item, cosine, lcs, first_word, end_word); ``th`` is the hash of the document's text."""
    sc = docs.sparkSession.sparkContext
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"))
    sch = pa.schema([("id", to_arrow_type(src.schema["id"].dataType)), ("th", pa.int64()), ("item", to_arrow_type(items.schema["item"].dataType)),
                     ("cosine", pa.float64()), ("lcs", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    ddl = f"id {src.schema['id'].dataType.simpleString()}, th long, item {items.schema['item'].dataType.simpleString()}, cosine double, lcs double, first_word long, end_word long"
    idf, proj, clear = latent_space(src.select("text"), items.select("text"))
    idf_b, proj_b = sc.broadcast(idf), sc.broadcast(proj)
    blocks = -(-items.agg(F.count("*").alias("n")).first()["n"] // ITEM_BLOCK)
    found = None
    for i in range(max(1, blocks)):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(max(1, blocks))) == i)
        rows_b = sc.broadcast(sorted(((r["item"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, () if x[0] is None else (x[0],), x[1] or "")))
        one = src.mapInArrow(_search(idf_b, proj_b, rows_b, clear, cosine, sch), ddl)
        found = one if found is None else found.unionByName(one)
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", *, cosine: float = COSINE) -> DataFrame:
    """(id, item, cosine, lcs, first_word, end_word): documents that hold a benchmark item."""
    return (_leaks(docs, benchmark, id_col, text_col, item_col, item_text, cosine)
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "cosine", "lcs", "first_word", "end_word"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; other rows of the same id, or without one, stay."""
    bad = written(_leaks(docs, benchmark, id_col, text_col, "item_id", "text", COSINE).select("id", "th").distinct(), "leaks")
    n = bad.agg(F.count("*").alias("n")).first()["n"]
    bad = fresh_names(bad, docs.columns)
    return docs.join(small(bad, 32 * n), docs[id_col].eqNullSafe(bad[bad.columns[0]])
                     & F.xxhash64(docs[text_col].cast("string")).eqNullSafe(bad[bad.columns[1]]), "left_anti")
