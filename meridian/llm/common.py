"""Shared helpers of the training-data operators: table access, scratch tables,
checked broadcasts, and vectorised word tables over Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest estimated size of a side that may be broadcast; beyond it joins shuffle.
BROADCAST_BYTES = 32 << 20
#: Text bytes that one vectorised step handles (a longer text is cut at white space).
SEGMENT = 512 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; set here only when unset and local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile
    root = tempfile.mkdtemp(prefix="llm-checkpoint-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps reread it instead of its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    Its cleaner acts when the driver's JVM collects the plans that refer to them; a job of many
    written steps would otherwise keep them all until the driver's heap happens to fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, est_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its checked size is bounded, else as it is (shuffle join)."""
    return F.broadcast(df) if est_bytes <= BROADCAST_BYTES else df


def fresh_names(df: DataFrame, taken: list[str]) -> DataFrame:
    """``df`` with columns renamed where needed so that none is among ``taken`` (case ignored)."""
    used, names = {c.lower() for c in taken}, []
    for c in df.columns:
        while c.lower() in used:
            c = f"_{c}"
        used.add(c.lower())
        names.append(c)
    return df.toDF(*names)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- word tables -----------------------------------------------------------------

def byte_class(*, ascii_space: bool) -> np.ndarray:
    """Boolean table of the 256 byte values: which of them separate words.

    ``ascii_space``: only 0x20 and 0x09-0x0D do. Otherwise every ASCII byte that is
    neither a letter nor a digit does (bytes of multi-byte characters never do).
    """
    t = np.zeros(256, bool)
    if ascii_space:
        t[[0x20, *range(0x09, 0x0E)]] = True
    else:
        t[:128] = [not chr(c).isalnum() for c in range(128)]
    return t


SPACE = byte_class(ascii_space=True)
NON_WORD = byte_class(ascii_space=False)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = SEGMENT + 1
    up = np.full(n, _P, np.uint64)
    down = np.full(n, pow(_P, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hash_text_words(words: list[bytes]) -> np.ndarray:
    """Hashes of single words, equal to those of :func:`word_table`."""
    buf = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    return word_table(buf, np.array([0, len(buf)]), SPACE)[2]


def word_table(data: np.ndarray, offs: np.ndarray, sep: np.ndarray, fold: np.ndarray | None = None):
    """Words of the texts ``data[offs[i]:offs[i+1]]``.

    Returns (start, end, hash, first): byte positions and 64-bit hash of every word, and
    for each text the index of its first word (with one entry more for the end). Works in
    segments of bounded size; a segment ends at a word's end, so texts of any length pass.
    """
    starts, ends, hashes = [], [], []
    lo, last = int(offs[0]), int(offs[-1])
    while lo < last:
        hi = min(lo + SEGMENT, last)
        if hi < last and not sep[data[hi - 1]]:
            cut = np.flatnonzero(sep[data[lo:hi]])
            j = int(np.searchsorted(offs, hi, "right")) - 1
            bound = max(lo + int(cut[-1]) + 1 if len(cut) else lo, int(offs[j]))
            if bound > lo:
                hi = bound
            else:                        # one word longer than a segment: take it whole
                nxt, stop = hi, min(int(offs[j + 1]), last)
                while nxt < stop and not sep[data[nxt]]:
                    nxt += 1
                hi = nxt
        seg = data[lo:hi]
        s, e, h = _segment(seg, offs[(offs > lo) & (offs < hi)] - lo, sep, fold)
        starts.append(s + lo)
        ends.append(e + lo)
        hashes.append(h)
        lo = hi
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return start, end, h, np.searchsorted(start, offs)


def _segment(seg, inner, sep, fold):
    word = ~sep[seg]
    edge = np.empty(len(seg) + 1, bool)
    edge[0] = word[0]
    edge[-1] = word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    cut = inner[(inner > 0) & (inner < len(seg))]
    joint = cut[word[cut] & word[cut - 1]] if len(cut) else cut   # texts that touch inside a word
    at = np.flatnonzero(edge)
    if len(joint):
        at = np.sort(np.concatenate([at, joint, joint]))
    s, e = at[0::2].astype(np.int64), at[1::2].astype(np.int64)
    b = (fold[seg] if fold is not None else seg).astype(np.uint64) + np.uint64(1)
    if len(seg) <= SEGMENT:
        up, down = _powers()
        c = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(b * up[:len(seg)], dtype=np.uint64, out=c[1:])
        return s, e, mix((c[e] - c[s]) * down[s])
    h = np.zeros(len(s), np.uint64)      # a single huge word: plain loop over blocks
    up, _ = _powers()
    for i, (a, z) in enumerate(zip(s.tolist(), e.tolist())):
        total, scale = 0, 1
        for j in range(a, z, SEGMENT):
            part = b[j:min(z, j + SEGMENT)]
            total = (total + scale * int((part * up[:len(part)]).sum(dtype=np.uint64))) & _MASK
            scale = scale * pow(_P, len(part), 1 << 64) & _MASK
        h[i] = total
    return s, e, mix(h)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, o, d = col.buffers()
    offs = np.frombuffer(o, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(d, np.uint8) if d is not None and d.size else np.zeros(0, np.uint8)
    return data, offs


def slices(batches, text: str, limit: int = SEGMENT):
    """Arrow batches cut by rows so that the texts of each piece hold about ``limit`` bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        _, offs = text_buffer(b.column(text))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
            yield b.slice(i, j - i)
            i = j
    trim()


def trim() -> None:
    """Give memory that a finished task freed back to the system: workers live on and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):            # not this C library
        pass
