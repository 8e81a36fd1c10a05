"""Alignment of two tokenizers by merge-path partitioning.

Tokenizer A (byte-level BPE) encodes space + text, tokenizer B (pieces with byte fallback, adding the space itself)
encodes the text. Both token lists have ascending byte ends, so aligning them is one merge:

1. *Encode.* Every text is tokenized once. Long texts are read in chunks cut before a single space between word
   characters: there a token of A always begins, and no piece of B goes on (checked for B's vocabulary), so the
   tokens are those of the whole text.
2. *Partition.* Binary searches on evenly spaced diagonals of the merge (A before B where ends are equal) cut it into
   pieces of equal work. A piece is a row of its own: its token ids, its byte places, and A's token just before it.
   Pieces are written as a table, so tasks share them evenly, whatever the texts' lengths.
3. *Overlaps.* Each piece alone yields its shared ends, links (the A and B tokens that end there) and groups. Id pairs
   are counted over the corpus, first inside each task.
4. *Stitch.* A second pass looks the pair counts up and hashes the groups. Groups that cross a border of pieces are
   put together from the pieces' open ends, streamed in order.

Pair counts are sent to the tasks in blocks of ``BLOCK_PAIRS``; one more block is one more pass, so memory
is bounded and no link is shuffled. Defined results: null or empty texts, and texts that the tokens of A or B do
not spell back, have no tokens: zeros and an empty string; rows are told apart by a row number, so repeated rows and
null ids give a row each; other columns are ignored, so clashing names are harmless; an empty table gives
an empty result. No token of either vocabulary is empty (checked), so ends ascend strictly and each shared end is one link.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import slices, written

#: Folder of the tokenizers' files, and the two files.
TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Id pairs in one pass (24 bytes each).
BLOCK_PAIRS = 1 << 21


class Sizes(NamedTuple):
    """How much is handled at a time; results do not depend on it."""
    piece: int = 1 << 16        # most merge steps (tokens of A and B) in a piece
    chunk: int = 1 << 16        # characters after which a text is cut at the next safe place
    batch: int = 128 << 10      # bytes of text encoded in one call
    step: int = 1 << 16         # tokens whose overlaps are found together


#: How byte-level BPE cuts a text before its merges (a fixed value of the format).
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs so long that the encoder whose time does not grow with their square is used.
_LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
_SAFE = re.compile(r"(?<=\w) (?=\w)")
_BITS = 32
_loaded: dict[bytes, "Pair"] = {}


def tokenizer_files(folder: str = TOKENIZERS) -> tuple[bytes, bytes]:
    """The two files' bytes (about 3 MB), read by the driver and sent to the tasks."""
    with open(f"{folder}/{A_FILE}", "rb") as a, open(f"{folder}/{B_FILE}", "rb") as b:
        return a.read(), b.read()


def _byte_chars() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return chars | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, files: tuple[bytes, bytes]):
        import sentencepiece
        import tiktoken
        self._a_file = files[0]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
        chars = _byte_chars()
        spec = json.loads(files[0])
        entries = dict(spec["model"]["vocab"])
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            self.a_bytes[i] = bytes(chars[c] for c in token)
        for t in spec["added_tokens"]:
            self.a_bytes += [b""] * (t["id"] + 1 - len(self.a_bytes))
            self.a_bytes[t["id"]] = t["content"].encode()
        self.a_fast = None
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        if [entries[m] for m in made] == list(range(256, 256 + len(made))):     # merges rank as ids do: a faster encoder of the same file
            self.a_fast = tiktoken.Encoding("a", pat_str=_WORDS, special_tokens={},
                                            mergeable_ranks={self.a_bytes[i]: i for i in entries.values()})
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cut_long = not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        if not (self.a_len.all() and self.b_len.all()):
            raise ValueError("a token of the vocabularies is empty")

    @cached_property
    def a(self):
        """Tokenizer A itself (some 60 MB, so loaded only by the tasks that need it)."""
        from tokenizers import Tokenizer
        a = Tokenizer.from_buffer(self._a_file)
        a.encode_special_tokens = True
        return a

    def chunks(self, text: str, size: int):
        """Pieces of space + text that both tokenizers encode independently; each begins with a space."""
        whole, at = " " + text, 0
        while self.cut_long and len(whole) - at > size:
            cut = _SAFE.search(whole, at + size)
            if not cut:
                break
            yield whole[at:cut.start()]
            at = cut.start()
        yield whole[at:]

    def _encode_a(self, chunk: str) -> list[int]:
        if self.a_fast and not _LONG_RUN.search(chunk):
            return self.a_fast.encode_ordinary(chunk)
        return self.a.encode(chunk, add_special_tokens=False).ids

    def encode(self, chunks: list[str]):
        """For each chunk its ids by A and B, or None if they do not spell it."""
        a = [self._encode_a(c) for c in chunks]
        b = self.b.encode([c[1:] for c in chunks], num_threads=1)
        out = []
        for c, x, y in zip(chunks, a, b):
            raw = c.encode("utf-8")
            same = b"".join(map(self.a_bytes.__getitem__, x)) == raw and b"".join(map(self.b_bytes.__getitem__, y)) == raw
            out.append((x, y) if same else None)
        return out


def pair_of(files: tuple[bytes, bytes]) -> Pair:
    """The tokenizers of these files, loaded once in a process."""
    key = hashlib.sha256(files[0] + files[1]).digest()
    if key not in _loaded:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[key] = Pair(files)
    return _loaded[key]


# ---- merge path ------------------------------------------------------------------

def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal, how many of its first steps of the merge of ``a`` and ``b`` come from ``a``.

    Both are sorted; equal values of ``a`` come first. All binary searches advance together.
    """
    lo = np.maximum(0, diagonals - len(b))
    hi = np.minimum(diagonals, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        take = np.zeros(len(lo), bool)
        m = mid[open_]
        take[open_] = a[m] <= b[diagonals[open_] - m - 1]   # a[mid] is merged before this step of b
        lo = np.where(open_ & take, mid + 1, lo)
        hi = np.where(open_ & ~take, mid, hi)
    return lo


def partition(a_ids, b_ids, a_len: np.ndarray, b_len: np.ndarray, limit: int):
    """Equal pieces of the merge of two token lists: (a ids, b ids, a start, b start, previous a id) each."""
    a, b = np.asarray(a_ids, np.int32), np.asarray(b_ids, np.int32)
    work = len(a) + len(b)
    if work <= limit:
        return [(a, b, 0, 0, -1)]
    ae, be = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    n = math.ceil(work / limit)
    diagonals = np.arange(n + 1) * work // n
    i = merge_path(ae, be, diagonals)
    j = diagonals - i
    out = []
    for k in range(n):
        x, y = int(i[k]), int(j[k])
        out.append((a[x:i[k + 1]], b[y:j[k + 1]], int(ae[x - 1]) if x else 0, int(be[y - 1]) if y else 0, int(a[x - 1]) if x else -1))
    return out


# ---- encode ----------------------------------------------------------------------

_PIECES = "rid long, id {kind}, piece int, last boolean, ok boolean, a array<int>, b array<int>, a_start long, b_start long, prev_a int"


def _encode(files, sizes, schema):
    def table(rows):
        cols = list(zip(*rows))
        arrays = [pa.array(c, f.type) for c, f in zip(cols, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches):
        pair = pair_of(files.value)
        rid = TaskContext.get().partitionId() << 33
        nothing = (np.zeros(0, np.int32), np.zeros(0, np.int32), 0, 0, -1)
        for batch in slices(batches, "text", sizes.batch):
            texts, ids = batch.column("text").to_pylist(), batch.column("id").to_pylist()
            rows, waiting = [], []                    # chunks of several texts are encoded in one call
            done = [0] * len(texts)                   # pieces of each text so far
            held = 0

            def flush():
                nonlocal waiting, held
                got = pair.encode([c for _, c, _ in waiting])
                parts: dict[int, list] = {}
                for (i, _, end), x in zip(waiting, got):
                    parts.setdefault(i, []).append((x, end))
                for i, xs in parts.items():
                    ok = all(x is not None for x, _ in xs)
                    a, b = ([t for x, _ in xs for t in x[k]] if len(xs) > 1 else xs[0][0][k] for k in (0, 1)) if ok else ([], [])
                    cut = partition(a, b, pair.a_len, pair.b_len, sizes.piece)
                    for k, piece in enumerate(cut):
                        rows.append((rid + i, ids[i], done[i], xs[-1][1] and k == len(cut) - 1, ok, *piece))
                        done[i] += 1
                waiting, held = [], 0

            for i, text in enumerate(texts):
                if not text:
                    rows.append((rid + i, ids[i], 0, True, True, *nothing))
                    continue
                chunks = pair.chunks(text, sizes.chunk)
                c = next(chunks)
                while c is not None:
                    after = next(chunks, None)
                    waiting.append((i, c, after is None))
                    held += len(c)
                    c = after
                    if held >= sizes.batch:
                        flush()
                        if rows:
                            yield table(rows)
                            rows.clear()
            if waiting:
                flush()
            if rows:
                yield table(rows)
            rid += len(texts)
    return run


def encode_pieces(docs: DataFrame, id_col: str, text_col: str, files, sizes: Sizes) -> DataFrame:
    """The written table of pieces; texts that do not spell back have none with tokens."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType
    ints = pa.list_(pa.int32())
    sch = pa.schema([("rid", pa.int64()), ("id", to_arrow_type(kind)), ("piece", pa.int32()), ("last", pa.bool_()), ("ok", pa.bool_()),
                     ("a", ints), ("b", ints), ("a_start", pa.int64()), ("b_start", pa.int64()), ("prev_a", pa.int32())])
    pieces = written(src.mapInArrow(_encode(files, sizes, sch), _PIECES.format(kind=kind.simpleString())), "token-pieces")
    # a long text of which a later chunk does not spell back: its other pieces lose their tokens too
    bad = pieces.filter("NOT ok").select("rid").distinct()
    split = pieces.filter("NOT ok AND NOT (piece = 0 AND last)").limit(1).count()
    if split:
        bare = F.array().cast("array<int>")
        marked = pieces.join(bad.withColumnRenamed("rid", "bad"), F.col("rid") == F.col("bad"), "left")
        pieces = written(marked.select("rid", "id", "piece", "last", F.col("bad").isNull().alias("ok"),
                                       *[F.when(F.col("bad").isNull(), F.col(c)).otherwise(bare).alias(c) for c in "ab"],
                                       "a_start", "b_start", F.when(F.col("bad").isNull(), F.col("prev_a")).otherwise(-1).alias("prev_a")), "token-pieces")
    return pieces


# ---- overlaps --------------------------------------------------------------------

def _steps(batches, size: int):
    """Batches of pieces cut so that each holds about ``size`` tokens."""
    for b in batches:
        if not b.num_rows:
            continue
        tokens = np.cumsum([0, *(np.diff(_offsets(b.column("a"))) + np.diff(_offsets(b.column("b"))))])
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(tokens, tokens[i] + size, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


def _offsets(col) -> np.ndarray:
    return np.asarray(col.offsets, np.int64)


class Overlaps:
    """Shared ends of the pieces of a batch, all pieces at once.

    ``a``/``b``: flat ids; ``ao``/``bo``: first token of each piece (one entry more); ``ae``/``be``: byte ends,
    offset per piece so that they ascend over the whole batch; ``la``/``lb``: ids of each link's tokens;
    ``cut``: ends of the links; ``cuts``: first link of each piece.
    """

    def __init__(self, batch, pair: Pair):
        self.ao, self.bo = (_offsets(batch.column(c)) for c in "ab")
        self.a, self.b = (batch.column(c).values.to_numpy()[o[0]:o[-1]] for c, o in (("a", self.ao), ("b", self.bo)))
        self.ao, self.bo = self.ao - self.ao[0], self.bo - self.bo[0]
        start_a, start_b = (batch.column(c).to_numpy() for c in ("a_start", "b_start"))
        prev = batch.column("prev_a").to_numpy()
        n = batch.num_rows
        la, lb = pair.a_len[self.a], pair.b_len[self.b]
        ca, cb = np.concatenate([[0], np.cumsum(la)]), np.concatenate([[0], np.cumsum(lb)])
        span = np.maximum(start_a + ca[self.ao[1:]] - ca[self.ao[:-1]], start_b + cb[self.bo[1:]] - cb[self.bo[:-1]]) + 1
        base = np.concatenate([[0], np.cumsum(span)])[:-1]
        place = lambda c, o, s: c[1:] + np.repeat(base + s - c[o[:-1]], np.diff(o))
        self.ae, self.be = place(ca, self.ao, start_a), place(cb, self.bo, start_b)
        # A's token before a piece may share its end with the piece's first token of B
        halo = np.flatnonzero(prev >= 0)
        ends = np.insert(self.ae, self.ao[halo], (base + start_a)[halo])
        ids = np.insert(self.a, self.ao[halo], prev[halo])
        at = np.searchsorted(ends, self.be)
        hit = np.flatnonzero(ends[np.minimum(at, len(ends) - 1)] == self.be) if len(ends) else np.zeros(0, np.int64)
        self.cut, self.la, self.lb = self.be[hit], ids[at[hit]] if len(hit) else hit, self.b[hit]
        self.cuts = np.searchsorted(hit, self.bo)
        self.key = self.la.astype(np.int64) << _BITS | self.lb.astype(np.int64)
        self.n = n


def _count_pairs(files, sizes):
    def out(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    def merged(parts):
        keys = np.concatenate([k for k, _ in parts])
        u, inv = np.unique(keys, return_inverse=True)
        return u, np.bincount(inv, weights=np.concatenate([c for _, c in parts]), minlength=len(u)).astype(np.int64)

    def run(batches):
        pair = pair_of(files.value)
        parts, held = [], 0
        for b in _steps(batches, sizes.step):
            k, c = np.unique(Overlaps(b, pair).key, return_counts=True)
            parts.append((k, c.astype(np.int64)))
            held += len(k)
            if held > 1 << 20:                      # combine; beyond that many distinct pairs send them on
                u, c = merged(parts)
                if len(u) > 1 << 19:
                    yield out(u, c)
                    parts, held = [], 0
                else:
                    parts, held = [(u, c)], len(u)
        if held:
            yield out(*merged(parts))
    return run


def pair_counts(pieces: DataFrame, files, sizes: Sizes) -> DataFrame:
    """(key, n, best): links of every id pair in the corpus, and whether no pair of its B id has more."""
    counted = pieces.select("a", "b", "a_start", "b_start", "prev_a").mapInArrow(_count_pairs(files, sizes), "key long, n long")
    counted = written(counted.groupBy("key").agg(F.sum("n").alias("n")), "token-pairs")
    b = F.col("key").bitwiseAND(F.lit((1 << _BITS) - 1))
    top = counted.groupBy(b.alias("b")).agg(F.max("n").alias("top"))        # at most one row per id of B
    return counted.join(top, b == F.col("b")).select("key", "n", (F.col("n") == F.col("top")).alias("best"))


def _blocks(pairs: DataFrame, size: int):
    """Sorted (keys, counts, best) arrays of at most about ``size`` pairs each."""
    pairs = written(pairs, "token-best")
    n = max(1, math.ceil(pairs.count() / size))
    for k in range(n):
        part = pairs.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == k) if n > 1 else pairs
        t = part.toArrow()
        keys = t.column("key").to_numpy()
        order = np.argsort(keys)
        yield keys[order], t.column("n").to_numpy()[order], t.column("best").to_numpy()[order]


# ---- groups ----------------------------------------------------------------------

def _decimal(n: int):
    """Decimal digits of the numbers below ``n`` (left-aligned) and how many each has."""
    size = max(1, len(str(max(n - 1, 0))))
    text = np.char.ljust(np.arange(n).astype(f"S{size}"), size)
    return text.view(np.uint8).reshape(n, size), np.char.str_len(np.arange(n).astype(f"S{size}")).astype(np.int64)


def group_text(o: Overlaps, decimal) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens in group order, each followed by its separator; first byte of each token; group of each.

    Groups are numbered over the batch; the last group of a piece is open if tokens follow its last link.
    """
    digits, size = decimal
    piece_a, piece_b = np.repeat(np.arange(o.n), np.diff(o.ao)), np.repeat(np.arange(o.n), np.diff(o.bo))
    ga = np.searchsorted(o.cut, o.ae) + piece_a              # an open group of one piece is not the next one's first
    gb = np.searchsorted(o.cut, o.be) + piece_b
    da = np.arange(len(ga)) + np.searchsorted(gb, ga, "left")
    db = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")
    total = len(ga) + len(gb)
    ids, group, side = np.empty(total, np.int64), np.empty(total, np.int64), np.zeros(total, np.int8)
    ids[da], ids[db], group[da], group[db] = o.a, o.b, ga, gb
    side[db] = 1
    sep = np.full(total, ord(","), np.uint8)
    if total:
        new = np.append(group[1:] != group[:-1], True)
        sep[new] = ord(";")
        sep[:-1][~new[:-1] & (side[1:] != side[:-1])] = ord("|")
    length = size[ids] + 1
    start = np.concatenate([[0], np.cumsum(length)])
    out = np.empty(int(start[-1]), np.uint8)
    for k in range(digits.shape[1]):
        more = np.flatnonzero(length > k + 1)
        out[start[more] + k] = digits[ids[more], k]
    out[start[1:] - 1] = sep
    return out, start, group


_SCORES = ("rid long, id {kind}, piece int, last boolean, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "sha string, head_a string, head_b string, head_closed boolean, middle string, tail_a string, tail_b string")


def _score(files, sizes, block, schema):
    def looked_up(o: Overlaps):
        keys, counts, best = block.value
        if not len(keys):
            return np.zeros(len(o.key), np.int64), np.zeros(len(o.key), np.int64)
        at = np.minimum(np.searchsorted(keys, o.key), len(keys) - 1)
        found = keys[at] == o.key
        return np.where(found, counts[at], 0), (found & best[at]).astype(np.int64)

    def sums(values, o):
        c = np.concatenate([[0], np.cumsum(values)])
        return c[o.cuts[1:]] - c[o.cuts[:-1]]

    def run(batches):
        pair = pair_of(files.value)
        decimal = _decimal(max(len(pair.a_bytes), len(pair.b_bytes)))
        for b in _steps(batches, sizes.step):
            o = Overlaps(b, pair)
            n, best = looked_up(o)
            text, start, group = group_text(o, decimal)
            first = o.ao + o.bo                              # tokens of a piece stand together
            piece, last = b.column("piece").to_numpy(), b.column("last").to_numpy(zero_copy_only=False)
            sha, open_ends = [], []
            for i in range(b.num_rows):
                lo, hi = int(first[i]), int(first[i + 1])
                if piece[i] == 0 and last[i]:
                    whole = text[start[lo]:start[hi] - 1].tobytes() if hi > lo else b""
                    sha.append(hashlib.sha256(whole).hexdigest() if hi > lo else "")
                    open_ends.append((None,) * 6)
                else:
                    sha.append(None)
                    links = int(o.cuts[i + 1] - o.cuts[i])
                    open_ends.append(_open_ends(o, text, start, group, i, lo, hi, links))
            links = np.diff(o.cuts).astype(np.int64)
            cols = [b.column(c) for c in ("rid", "id", "piece", "last")]
            cols += [pa.array(x) for x in (np.diff(o.ao), np.diff(o.bo), links, links, sums(best, o), sums(n, o))]
            cols += [pa.array(sha, pa.string())]
            cols += [pa.array(c, pa.bool_() if k == 2 else pa.string()) for k, c in enumerate(zip(*open_ends))]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)
    return run


def _open_ends(o, text, start, group, i, lo, hi, links):
    """(head a, head b, head closed, middle, tail a, tail b) of a piece that is part of a longer text."""
    if hi == lo:
        return "", "", False, "", "", ""
    g = group[lo:hi] - int(group[lo])
    # a piece that begins with B's token at the end of A's last one has that link in its first group
    base = int(o.cuts[i]) + i
    number = group[lo:hi] - base
    head = int(np.searchsorted(g, 0, "right"))
    tail = int(np.searchsorted(number, links))               # tokens after the last link
    ids = lambda x, y: _sides(o, i, x - lo, y - lo, text, start, lo)
    if links == 0:
        a, z = ids(lo, hi)
        return a, z, False, "", "", ""
    a, z = ids(lo, lo + head)
    middle = text[start[lo + head]:start[lo + tail]].tobytes().decode() if tail > head else ""
    ta, tb = ids(lo + tail, hi) if tail < hi - lo else ("", "")
    return a, z, True, middle.rstrip(";"), ta, tb


def _sides(o, i, x, y, text, start, lo):
    """The A and B ids, comma-joined, of the tokens x..y of a piece, which belong to one group."""
    raw = text[start[lo + x]:start[lo + y]].tobytes().decode()[:-1] if y > x else ""
    if "|" in raw:
        a, _, b = raw.partition("|")
        return a, b
    only_b = y > x and bool(_side_b(o, i, x, y))
    return ("", raw) if only_b else (raw, "")


def _side_b(o, i, x, y):
    """Whether the tokens x..y (of one side) of piece i are B's: no token of A lies in their group."""
    group = np.searchsorted(o.cut, o.ae[o.ao[i]:o.ao[i + 1]])
    order = np.searchsorted(o.cut, o.be[o.bo[i]:o.bo[i + 1]])
    da = np.arange(len(group)) + np.searchsorted(order, group, "left")
    return not ((da >= x) & (da < y)).any()


def _stitch(schema):
    """Scored pieces sorted by (rid, piece) -> one row per text."""
    def run(batches):
        row = sha = pend = None
        some = False

        def close():
            nonlocal some
            sha.update((b";" if some else b"") + f"{pend[0]}|{pend[1]}".encode())
            some = True

        def joined(x, y):
            return f"{x},{y}" if x and y else x or y

        def done():
            v = [*row, sha.hexdigest() if some else ""]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(v, schema)], schema=schema)
        names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
        for b in batches:
            for r in b.to_pylist():
                if row is None or row[0] != r["rid"]:
                    if row is not None:
                        yield done()
                    row, sha, pend, some = [r["rid"], r["id"], *([0] * len(names))], hashlib.sha256(), ("", ""), False
                row[2:] = [x + r[c] for x, c in zip(row[2:], names)]
                pend = (joined(pend[0], r["head_a"]), joined(pend[1], r["head_b"]))
                if r["head_closed"]:
                    close()
                    if r["middle"]:
                        sha.update(b";" + r["middle"].encode())
                    pend = (r["tail_a"], r["tail_b"])
        if row is not None:
            yield done()
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, folder: str = TOKENIZERS,
          block_pairs: int = BLOCK_PAIRS, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast(tokenizer_files(folder))
    pieces = encode_pieces(docs, id_col, text_col, files, sizes)
    kind = pieces.schema["id"].dataType
    ddl = _SCORES.format(kind=kind.simpleString())
    strings = [(c, pa.string()) for c in ("head_a", "head_b")], [(c, pa.string()) for c in ("middle", "tail_a", "tail_b")]
    numbers = [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    head = [("rid", pa.int64()), ("id", to_arrow_type(kind))]
    sch = pa.schema([*head, ("piece", pa.int32()), ("last", pa.bool_()), *numbers, ("sha", pa.string()),
                     *strings[0], ("head_closed", pa.bool_()), *strings[1]])
    scored, more = None, []
    for block in _blocks(pair_counts(pieces, files, sizes), block_pairs):
        got = pieces.mapInArrow(_score(files, sizes, spark.sparkContext.broadcast(block), sch), ddl)
        if scored is None:
            scored = written(got, "token-scores")
        else:
            more.append(written(got.select("rid", "n_best", "count_sum"), "token-scores"))
    whole = (F.col("piece") == 0) & F.col("last")
    names = [c for c, _ in numbers]
    out = pa.schema([*head, *numbers, ("groups_sha256", pa.string())])
    stitched = (scored.filter(~whole).repartition("rid").sortWithinPartitions("rid", "piece")
                .mapInArrow(_stitch(out), f"rid long, id {kind.simpleString()}, {', '.join(f'{c} long' for c in names)}, groups_sha256 string"))
    result = scored.filter(whole).select("rid", "id", *names, F.col("sha").alias("groups_sha256")).unionByName(stitched)
    if more:
        extra = more[0]
        for m in more[1:]:
            extra = extra.unionByName(m)
        extra = extra.groupBy(F.col("rid").alias("r")).agg(F.sum("n_best").alias("nb"), F.sum("count_sum").alias("cs"))
        result = (result.join(extra, F.col("rid") == F.col("r"), "left")
                  .withColumns({"n_best": F.col("n_best") + F.coalesce("nb", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("cs", F.lit(0))}))
    return result.select(F.col("id").alias(id_col), *names, "groups_sha256")
