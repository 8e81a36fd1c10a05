"""Toxicity by a classifier chain.

The label columns are predicted one after the other, each by a linear (logistic) model over
the distinct hashed words and word beginnings of a text (inflected and compound words share
these), a few measures of its form, and the log-odds that the
earlier models of the chain give. While training, those earlier log-odds are out of fold:
each training row gets them from a model that has not seen it, so a later model learns how far
earlier predictions can be trusted on new texts. The final decision threshold has the best F1 on
the out-of-fold probabilities of the last label.

Training uses a bounded sample of the labelled rows (``max_train``, drawn by a hash of
the key); the driver gets hashed words only. Prediction reads every text whole in one pass.

Defined results: null text counts as empty and gets the base rate; a row with a null label
is left out for that label; several labels of one key: the largest; without two classes in
the sample a label's probability is its constant rate (0 without rows); repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import LOWER, NON_WORD, mix, slices, text_buffer, word_table

BUCKETS = 1 << 18
MAX_TRAIN = 12_000
FOLDS, FEATURES, STEPS, PENALTY = 5, 4096, 250, 1e-4
#: Word beginnings of so many bytes are features too.
BEGINNINGS = (6, 7, 8)
#: A word counts as a feature from so many training texts.
MIN_TEXTS = 4
SEED = 8

_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_MARK = np.array([int(c < 128 and not chr(c).isalnum() and not chr(c).isspace()) for c in range(256)], np.int32)


def _features(batch):
    """(text number, feature bucket) pairs and the form measures of each text."""
    data, offs = text_buffer(batch.column("text"))
    start, end, h, first = word_table(data, offs, NON_WORD, LOWER)
    n = len(offs) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    rows, ids = [doc], [(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
    long = np.flatnonzero(end - start > BEGINNINGS[0])
    head = np.zeros(len(long), np.uint64)
    for j in range(BEGINNINGS[-1]):
        at = np.minimum(start[long] + j, len(data) - 1)
        head |= LOWER[data[at]].astype(np.uint64) << np.uint64(8 * j)
    for k in BEGINNINGS:
        fit = np.flatnonzero((end - start)[long] > k)
        part = head[fit] & np.uint64((1 << 8 * k) - 1)
        rows.append(doc[long[fit]])
        ids.append((mix(part ^ np.uint64(0x9E3779B97F4A7C15 * k & 0xFFFFFFFFFFFFFFFF)) & np.uint64(BUCKETS - 1)).astype(np.int64))
    rep = np.zeros(len(h), np.int64)
    rep[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])

    def share(table):
        c = np.concatenate([[0], np.cumsum(table[data[offs[0]:offs[-1]]], dtype=np.int64)])
        return (c[offs[1:] - offs[0]] - c[offs[:-1] - offs[0]]) / np.maximum(np.diff(offs), 1)
    words = np.diff(first)
    form = np.stack([np.log1p(words), share(_UPPER), share(_MARK),
                     np.bincount(doc, weights=rep, minlength=n) / np.maximum(words, 1)], 1)
    return np.concatenate(rows), np.concatenate(ids), form


FORM = 4


def _training_rows(cols):
    def run(batches):
        for b in slices(batches, "text"):
            doc, ids, form = _features(b)
            pair = np.unique(doc * BUCKETS + ids)
            at = np.searchsorted(pair, np.arange(b.num_rows + 1) * BUCKETS)
            words = (pair % BUCKETS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array([words[a:z].tobytes() for a, z in zip(at, at[1:])], pa.binary()),
                 pa.array([f.tobytes() for f in form], pa.binary())], [*cols, "words", "form"])
    return run


@dataclass
class Linear:
    ids: np.ndarray            # chosen buckets, ascending
    weights: np.ndarray
    dense: np.ndarray          # form measures, then earlier log-odds
    bias: float


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _fit(row, ids, dense, y, rows) -> Linear:
    """Logistic regression on the most telling words of the given rows (full-batch Adam)."""
    none = np.zeros(0)
    rate = float(y[rows].mean()) if len(rows) else 0.0
    if not 0 < rate < 1:
        return Linear(none.astype(np.int64), none, np.zeros(dense.shape[1]), float(_logit(np.array(rate))) if len(rows) else -30.0)
    new = np.full(len(y), -1)
    new[rows] = np.arange(len(rows))
    keep = new[row] >= 0
    r, w, t = new[row[keep]], ids[keep], y[rows]
    n1 = np.bincount(w, weights=t[r], minlength=BUCKETS)
    n = np.bincount(w, minlength=BUCKETS)
    odds = np.abs(n1 - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate), 1e-9)) * (n >= MIN_TEXTS)
    chosen = np.sort(np.argsort(-odds, kind="stable")[:FEATURES])
    chosen = chosen[odds[chosen] > 0]
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[w] >= 0
    r, f = r[keep], place[w[keep]]
    x = dense[rows]
    theta, m, v = np.zeros(len(chosen) + x.shape[1] + 1), 0.0, 0.0
    theta[-1] = _logit(np.array(rate))
    k = len(chosen)
    for step in range(1, STEPS + 1):
        z = np.bincount(r, weights=theta[f], minlength=len(rows)) + x @ theta[k:-1] + theta[-1]
        e = (_sigmoid(z) - t) / len(rows)
        g = np.concatenate([np.bincount(f, weights=e[r], minlength=k), x.T @ e, [e.sum()]])
        g[:-1] += PENALTY * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    return Linear(chosen, theta[:k], theta[k:-1], float(theta[-1]))


def _apply(model: Linear, row, ids, dense, n):
    z = dense @ model.dense + model.bias
    if len(model.ids):
        at = np.minimum(np.searchsorted(model.ids, ids), len(model.ids) - 1)
        hit = model.ids[at] == ids
        z = z + np.bincount(row[hit], weights=model.weights[at[hit]], minlength=n)
    return z


@dataclass
class ToxicityChain:
    labels: list[str]
    models: list[Linear]
    mean: np.ndarray
    scale: np.ndarray
    threshold: float


def train(df: DataFrame, labels: DataFrame, chain: list[str], id_col: str = "doc_id", text_col: str = "text", *,
          max_train: int = MAX_TRAIN) -> ToxicityChain:
    """Fit the chain on at most about ``max_train`` labelled rows."""
    marks = labels.groupBy(F.col(id_col).alias("__id")).agg(*(F.max(F.col(c).cast("int")).alias(f"y{i}") for i, c in enumerate(chain)))
    total = marks.agg(F.count("*").alias("n")).first()["n"]
    drawn = marks.filter(F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit("train")), F.lit(1_000_000)) / 1e6
                         < min(1.0, max_train / max(total, 1)))       # about max_train short rows: bounded
    cols = [f"y{i}" for i in range(len(chain))]
    rows = (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(drawn), F.col("id") == F.col("__id")).select(*cols, "text")
            .mapInArrow(_training_rows(cols), ", ".join(f"{c} int" for c in cols) + ", words binary, form binary").collect())
    rows.sort(key=lambda r: (bytes(r["words"]), bytes(r["form"]), [-1 if r[c] is None else r[c] for c in cols]))
    words = [np.frombuffer(r["words"], np.int32) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(w) for w in words])
    ids = np.concatenate(words).astype(np.int64) if rows else np.zeros(0, np.int64)
    form = np.array([np.frombuffer(r["form"], np.float64) for r in rows]).reshape(-1, FORM)
    mean, scale = (form.mean(0), form.std(0) + 1e-9) if rows else (np.zeros(FORM), np.ones(FORM))
    dense = (form - mean) / scale
    # equal texts share a fold: a copy must not vouch for its twin
    fold = np.zeros(len(rows), np.int64)
    rng, last = np.random.default_rng(SEED), None
    for i, r in enumerate(rows):
        fold[i] = fold[i - 1] if last == bytes(r["words"]) else rng.integers(FOLDS)
        last = bytes(r["words"])
    models, oof, y = [], None, np.zeros(0)
    for c in cols:
        have = np.array([r[c] is not None for r in rows], bool)
        y = np.array([r[c] or 0 for r in rows], np.float64)
        oof = np.zeros(len(rows))
        for k in range(FOLDS):
            part = _fit(row, ids, dense, y, np.flatnonzero(have & (fold != k)))
            z = _apply(part, row, ids, dense, len(rows))
            oof[fold == k] = z[fold == k]
        models.append(_fit(row, ids, dense, y, np.flatnonzero(have)))
        dense = np.column_stack([dense, np.clip(oof, -10, 10)])
        last_have = have
    threshold = 0.5
    if rows and 0 < y[last_have].sum() < last_have.sum():
        p, t = _sigmoid(oof[last_have]), y[last_have]
        order = np.argsort(-p, kind="stable")
        hit = np.cumsum(t[order])
        f1 = 2 * hit / (np.arange(1, len(t) + 1) + t.sum())
        at = int(np.argmax(f1))
        after = p[order][at + 1] if at + 1 < len(t) else 0.0
        threshold = float((p[order][at] + after) / 2)
    return ToxicityChain(list(chain), models, mean, scale, threshold)


def _predict(chain_b, schema):
    def run(batches):
        chain = chain_b.value
        known = np.zeros(BUCKETS, bool)
        for m in chain.models:
            known[m.ids] = True
        for b in slices(batches, "text"):
            doc, ids, form = _features(b)
            hit = known[ids]
            pair = np.unique(doc[hit] * BUCKETS + ids[hit])
            row, word = pair // BUCKETS, pair % BUCKETS
            dense, probs = (form - chain.mean) / chain.scale, []
            for m in chain.models:
                z = _apply(m, row, word, dense, b.num_rows)
                probs.append(pa.array(_sigmoid(z)))
                dense = np.column_stack([dense, np.clip(z, -10, 10)])
            yield pa.RecordBatch.from_arrays([b.column("id"), *probs], schema=schema)
    return run


def predict(df: DataFrame, chain: ToxicityChain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<label> for each label of the chain, flagged): ``flagged`` from the last label."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = [f"p_{c}" for c in chain.labels]
    sch = pa.schema([("id", to_arrow_type(src.schema["id"].dataType)), *((n, pa.float64()) for n in names)])
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(_predict(df.sparkSession.sparkContext.broadcast(chain), sch), f"id {kind}, " + ", ".join(f"{n} double" for n in names))
            .withColumn("flagged", F.col(names[-1]) >= chain.threshold).withColumnRenamed("id", id_col))
