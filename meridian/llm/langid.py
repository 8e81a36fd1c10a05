"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the byte 2-, 3- and 4-grams of lower-cased words (letters; a border counts as a
space), hashed into ``BUCKETS`` rows of an embedding table. A text is the average of its
subwords' embeddings, followed by a linear layer and a softmax. Both layers are trained by
minibatch stochastic gradient descent in numpy on a bounded sample of labelled rows; as the
model is linear behind the average, prediction needs only one (buckets x languages) table.

Part of the sample is set aside for calibration: a temperature is fitted to it, and a
prediction is *rejected* when its calibrated probability is under a threshold that at most
``reject_share`` of the correct calibration rows fall short of (never above 0.5).

Defined results: null text or a text without any letter is ``und`` with score 0 and rejected;
with no labelled rows every text is; rows with null labels are not learned from; repeated rows
are predicted alike; ties go to the language first in alphabetical order; other columns
are never read; an empty table gives an empty result. Texts of any length are read whole, in
segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import slices, text_buffer

BUCKETS = 1 << 14
DIM = 16
GRAMS = (2, 3, 4)
#: Labelled rows that are learned from: about so many of each language.
SAMPLE_PER_LANGUAGE = 1000
EPOCHS, BATCH, RATE = 12, 32, 0.05
#: A text's average counts so many neutral subwords more, so that very short texts stay unsure.
NEUTRAL = 8
SEED = 20
_STEP = 1 << 21

_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _grams(data: np.ndarray, offs: np.ndarray):
    """For each gram length an array of bucket numbers per byte (``BUCKETS``: not a subword)."""
    n = len(data)
    letter = _LETTER[data]
    c = np.where(letter, data, np.uint8(32)).astype(np.uint32)
    for g in GRAMS:
        if n < g:
            continue
        m = n - g + 1
        h = c[:m].copy()
        ok = letter[:m] | letter[g - 1:g - 1 + m]
        for j in range(1, g):
            h *= np.uint32(0x01000193)
            h ^= c[j:m + j]
            if j < g - 1:
                ok &= letter[j:m + j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
        idx = np.full(n, BUCKETS, np.int32)
        idx[:m] = np.where(ok, (h & np.uint32(BUCKETS - 1)).astype(np.int32), BUCKETS)
        for j in range(1, g):                        # grams that run into the next text
            at = offs[1:-1] - j
            idx[at[at >= 0]] = BUCKETS
        yield idx


def _pieces(batches):
    """(batch piece, bytes, offsets), the offsets from 0."""
    for b in slices(batches, "text", _STEP):
        data, offs = text_buffer(b.column("text"))
        yield b, data[offs[0]:offs[-1]], offs - offs[0]


def _feature_rows(batches):
    for b, data, offs in _pieces(batches):
        grams = list(_grams(data, offs))
        ids, counts = [], []
        for a, z in zip(offs[:-1].tolist(), offs[1:].tolist()):
            n = np.zeros(BUCKETS + 1, np.int64)
            for g in grams:
                n += np.bincount(g[a:z], minlength=BUCKETS + 1)
            at = np.flatnonzero(n[:-1])
            ids.append(at.astype(np.uint16).tobytes())
            counts.append(n[at].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), b.column("aside")],
                                         ["lang", "ids", "counts", "aside"])


@dataclass
class LanguageModel:
    """``table``: buckets x languages, the logits a subword adds to the average."""
    languages: list[str]
    table: np.ndarray = field(repr=False)
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0
    threshold: float = 0.0


def _softmax(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _train(x_ids, x_counts, y, aside, languages, reject_share):
    rng = np.random.default_rng(SEED)
    k = len(languages)
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    out = np.zeros((DIM, k), np.float32)
    bias = np.zeros(k, np.float32)

    def dense(rows):
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows):
            x[i, x_ids[r]] = x_counts[r] / (x_counts[r].sum() + NEUTRAL)
        return x

    fit = np.flatnonzero(~aside)
    seen = np.zeros(BUCKETS, bool)
    for r in fit:
        seen[x_ids[r]] = True
    steps = max(1, EPOCHS * -(-len(fit) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for i in range(0, len(fit), BATCH):
            rows = fit[i:i + BATCH]
            x = dense(rows)
            h = x @ emb
            p = _softmax(h @ out + bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            rate = RATE * (1 - done / steps)
            back = p @ out.T
            out -= rate * 10 * (h.T @ p)
            bias -= rate * p.mean(0)
            used = np.unique(np.concatenate([x_ids[r] for r in rows])) if len(rows) else fit[:0]
            emb[used] -= rate * 100 * (x[:, used].T @ back)
            done += 1
    table = emb @ out
    table[~seen] = 0                                 # subwords never seen say nothing
    check = np.flatnonzero(aside)
    temperature, threshold = 1.0, 0.0
    if len(check):
        z = np.concatenate([dense(check[i:i + BATCH]) @ table for i in range(0, len(check), BATCH)]) + bias
        grid = np.exp(np.linspace(np.log(0.02), np.log(20), 60))
        # smoothed targets: rows that are all right don't prove certainty
        target = np.full(z.shape, 1 / (len(check) + 2) / max(1, k - 1))
        target[np.arange(len(check)), y[check]] = 1 - 1 / (len(check) + 2)
        loss = [-(target * np.log(np.maximum(_softmax(z / t), 1e-12))).sum(1).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(z / temperature)
        right = p.argmax(1) == y[check]
        if right.any():
            threshold = min(0.5, float(np.quantile(p.max(1)[right], reject_share)))
    return LanguageModel(languages, table, bias, temperature, threshold)


def train(df: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", *,
          per_language: int = SAMPLE_PER_LANGUAGE, reject_share: float = 0.001) -> LanguageModel:
    """Model learned from rows where ``learn`` holds and the label is not null.

    The sample is drawn by a hash of the key at a rate per language, so that about
    ``per_language`` rows of each are used at any input size; the driver gets their hashed
    subword counts (bounded by the bucket number), never texts.
    """
    src = df.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in src.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    lang = F.col(lang_col).cast("string")
    key = F.col(key_col).cast("string")
    cut = F.lit(0.0)
    for name, n in counts.items():
        cut = F.when(lang == name, F.lit(min(1.0, per_language / n))).otherwise(cut)
    rows = (src.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000)) / 1e6 < cut)
            .select(F.lower(F.col(text_col).cast("string")).alias("text"), lang.alias("lang"),
                    (F.pmod(F.xxhash64(key, F.lit("aside")), F.lit(5)) == 0).alias("aside"), F.coalesce(key, F.lit("")).alias("key"))
            .select("text", "lang", "aside")
            .mapInArrow(_feature_rows, "lang string, ids binary, counts binary, aside boolean").collect())
    rows.sort(key=lambda r: (r["lang"], bytes(r["ids"]), bytes(r["counts"])))
    number = {x: i for i, x in enumerate(languages)}
    return _train([np.frombuffer(r["ids"], np.uint16) for r in rows], [np.frombuffer(r["counts"], np.float32) for r in rows],
                  np.array([number[r["lang"]] for r in rows], np.int64), np.array([r["aside"] for r in rows], bool), languages, reject_share)


def _predict(model: LanguageModel, schema):
    tables = [np.append(model.table[:, i], 0).astype(np.float32) for i in range(len(model.languages))]

    def run(batches):
        for b, data, offs in _pieces(batches):
            n = len(offs) - 1
            full = np.flatnonzero(np.diff(offs))
            total, hits = np.zeros((n, len(tables))), np.zeros(n)
            at = offs[full]
            for idx in _grams(data, offs):
                hits[full] += np.add.reduceat((idx < BUCKETS).astype(np.int32), at)
                for i, t in enumerate(tables):
                    total[full, i] += np.add.reduceat(t[idx], at)
            p = _softmax((total / (hits + NEUTRAL)[:, None] + model.bias) / model.temperature)
            best = p.argmax(1)
            score = p[np.arange(n), best]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in schema.names[:-3]), pa.array([model.languages[i] for i in best.tolist()]),
                 pa.array(score), pa.array(score < model.threshold)], schema=schema)
    return run


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and lang_pred, lang_score, lang_rejected of every row."""
    keep = df.columns if keep is None else keep
    und = F.col("__text").isNull() | ~F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False))
    named = df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.col(text_col).cast("string").alias("__text"))
    cols = [f"c{i}" for i in range(len(keep))]
    src = named.select(*cols, F.lower("__text").alias("text"), und.alias("und"))
    if not model.languages:
        out = src.select(*cols, "und", F.lit("und").alias("p"), F.lit(0.0).alias("s"), F.lit(True).alias("r"))
    else:
        sch = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in src.select(*cols, "und").schema),
                         ("p", pa.string()), ("s", pa.float64()), ("r", pa.bool_())])
        ddl = src.select(*cols, "und").schema.add("p", "string").add("s", "double").add("r", "boolean")
        out = src.mapInArrow(_predict(model, sch), ddl)
    return out.select(*(F.col(c).alias(name) for c, name in zip(cols, keep)),
                      F.when(F.col("und"), "und").otherwise(F.col("p")).alias("lang_pred"),
                      F.when(F.col("und"), 0.0).otherwise(F.col("s")).alias("lang_score"),
                      (F.col("und") | F.col("r")).alias("lang_rejected"))


def held_out(key_col: str = "doc_id") -> Column:
    """The rows that are never learned from: crc32 of the key as text, modulo 4, is 2 (null key: of '')."""
    return F.crc32(F.coalesce(F.col(key_col).cast("string"), F.lit(""))) % 4 == 2
