"""Conversation trie, tokenizer alignment and WARC archives against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from meridian.llm import token_merge, turn_trie, warc
from meridian.llm.common import written
from meridian.llm.queries import ORACLE, QUERIES
from meridian.plans.checking import compare
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["op11_turn_trie", "op13_warc"])
def test_query_matches_sql(spark, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, exact=True)
    assert res["cols_match"] and res["values_match"], res


# --- 11: conversation prefix trie ---------------------------------------------------------

def brute_trie(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            conv[c].append(((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest()), (r, x)))
    conv = {c: [v for _, v in sorted(k)] for c, k in conv.items()}
    built = {}
    for c, k in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = conv.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + k[h:]
    members = defaultdict(list)
    for c, k in built.items():
        for d in range(len(k) + 1):
            members[tuple(k[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not kids[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def found_trie(df, width):
    got = turn_trie.trie(turn_trie.rebuild(turn_trie.turns_of(df)), width).collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def talks(spark):
    rnd = random.Random(1)
    rows = [(c, rnd.choice([None, t, t, t]), rnd.choice(["u", "u", "u", None]), rnd.choice(["a", "a", "a", "a", "é b", None, ""]), 1)
            for c in [None, -5, 0, 1, 2, 3, 7, 50, 99, 100, 101, 150, 203, 305, 306, 400] for t in range(rnd.choice([1, 2, 5, 9, 17, 30]))]
    return written(spark.createDataFrame(rows + rows[-1:] * 3, "conv_id long, turn long, role string, text string, pos int"), "talks")


@pytest.mark.parametrize("width,chapter", [(8, 8192), (2, 4), (8, 16)])
def test_trie_matches_brute_force(talks, monkeypatch, width, chapter):
    monkeypatch.setattr(turn_trie, "CHAPTER", chapter)
    want = brute_trie([(r.conv_id, r.turn, r.role, r.text) for r in talks.collect()])
    assert found_trie(talks, width) == want


def test_trie_with_hot_parents_and_copies(spark):
    """A common first turn, a conversation repeated many times, and one much longer than the others."""
    rows = [(1000 * c + 1, t, "u", "hello" if t == 0 else f"{c % 40 if c < 80 else 0} {t}") for c in range(120) for t in range(3)]
    rows += [(999_000, t, "u", f"long {t}") for t in range(500)]
    df = written(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "talks")
    assert found_trie(df, 8) == brute_trie(rows)


def test_trie_of_nothing(talks):
    assert found_trie(talks.limit(0), 8) == []


# --- 12: cross-tokenizer alignment ----------------------------------------------------------

@pytest.fixture(scope="module")
def pair():
    return token_merge.pair_of(token_merge.tokenizer_files())


def brute_align(rows, pair):
    found, count = [], Counter()
    for i, text in rows:
        a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(pair.a_bytes[x] for x in a) != raw or b"".join(pair.b_bytes[x] for x in b) != raw:
            found.append((i, None))
            continue
        ends, p = {}, 0
        for k, x in enumerate(a):
            p += len(pair.a_bytes[x])
            ends[p] = k
        groups, links, la, lb, p = [], [], 0, 0, 0
        for k, x in enumerate(b):
            p += len(pair.b_bytes[x])
            if p in ends:
                groups.append(",".join(map(str, a[la:ends[p] + 1])) + "|" + ",".join(map(str, b[lb:k + 1])))
                links.append((a[ends[p]], x))
                la, lb = ends[p] + 1, k + 1
        count.update(links)
        found.append((i, (len(a), len(b), groups, links)))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, x[0], x[1], len(x[2]), len(x[3]), sum(count[k] == top[k[1]] for k in x[3]), sum(count[k] for k in x[3]),
                        hashlib.sha256(";".join(x[2]).encode()).hexdigest()))
    return sorted(out, key=str)


def found_align(df, **options):
    return sorted((tuple(r) for r in token_merge.align(df, **options).collect()), key=str)


def test_align_matches_brute_force(spark, pair):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert found_align(df) == brute_align([(r.doc_id, r.text) for r in df.collect()], pair)


@pytest.mark.parametrize("sizes,block", [((64, 500, 2000, 300), 1 << 21), ((7, 100_000, 20_000, 90), 1500)])
def test_align_pieces_chunks_and_blocks(spark, pair, sizes, block):
    """Texts cut into many pieces, chunks and passes; null, empty, odd, repeated and unspellable texts."""
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect()]
    rows = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (None, "héllo 漢字 \x00 <|endoftext|>"), (None, None), (5, "x" * 3000),
            (6, "  \n\n  a  b \t c"), (7, " ".join(texts[:20])), (8, " ".join(texts[:9]) + " ▁ " + " ".join(texts[:9])),
            (9, "it's don't 'll  's s"), (10, "漢字" * 900), (11, "\n".join(texts[5:20]))]
    df = written(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "rid": F.lit(2), "a": F.lit("b")}), "odd")
    assert found_align(df, sizes=token_merge.Sizes(*sizes), block_pairs=block) == brute_align(rows, pair)
    assert found_align(df.limit(0)) == []


def test_both_encoders_of_a_agree(spark, pair):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if r.text]
    texts += ["  a  b\n\n \t c", "<|endoftext|> it's 12ab 漢字\u3000x \u00a0y \x1c z\u0301 ½ ²", " " * 50 + "x", "\r\n\r\n end "]
    assert pair.a_fast is not None
    for t in texts:
        assert pair.a_fast.encode_ordinary(" " + t) == pair.a.encode(" " + t, add_special_tokens=False).ids


def test_merge_path_splits_like_a_merge():
    import numpy as np
    rnd = random.Random(2)
    for _ in range(200):
        a, b = (np.array(sorted(rnd.sample(range(40), rnd.randrange(1, 30)))) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        got = token_merge.merge_path(a, b, np.arange(len(merged) + 1))
        assert got.tolist() == [sum(1 for _, s in merged[:d] if s == 0) for d in range(len(merged) + 1)]


# --- 13: WARC archives ----------------------------------------------------------------------

PAGES = [(1, "u", "<p>a</p>"), (2, "u2", "<p>a</p>"), (2, "u2", "<p>a</p>"), (None, None, "<p>a</p>"), (5, "http://x/é", None), (6, "k", ""),
         (None, "x y\r\nWARC-Type: response", "qé"), (None, "x", "qé"), (7, "k", "x" * 3_000_000), (8, "z", "\r\n\r\nWARC/1.1\r\n\r\n")]


@pytest.fixture(scope="module")
def pages(spark):
    return written(spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"id": F.lit(3), "k": F.lit("x"), "rid": F.lit(0)}), "pages")


def test_archives_round_trip(spark, pages):
    got = warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark)), keep_payload=True).collect()
    assert len(got) == len(PAGES)
    by_payload = defaultdict(list)
    for i, _, html in PAGES:
        by_payload[(html or "").encode()].append(i)
    for payload, ids in by_payload.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        mine = [r for r in got if r.payload_digest == digest]
        best = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r.id) for r in mine) == sorted(map(str, ids))
        assert {r.payload_bytes for r in mine} == {len(payload)}
        response = [r for r in mine if r.record_type == "response"]
        assert [(r.id, r.refers_to, bytes(r.payload)) for r in response] == [(best, None, payload)]
        assert all(r.refers_to == best and r.payload is None for r in mine if r.record_type == "revisit")
    assert {r.url for r in got if r.id == 5} == {"http://x/é"}


def test_short_payloads_are_responses_and_files_roll(spark, pages):
    m = warc.write_archives(pages, warc.archive_folder(spark), min_bytes=5, archive_bytes=500)
    got = warc.read_archives(m).collect()
    assert sorted((r.record_type, r.payload_bytes) for r in got if r.payload_bytes < 5) == [("response", 0), ("response", 0), ("response", 3), ("response", 3)]
    assert sum(r.record_type == "revisit" for r in got) == 3
    assert m.select("path").distinct().count() > 3


def test_archives_are_plain_frames_with_a_leading_dictionary(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    m = warc.write_archives(df, warc.archive_folder(spark))
    for path in {r.path for r in m.collect()}:
        data = open(path.removeprefix("file://"), "rb").read()
        assert data[:4] == b"\x5d\x2a\x4d\x18"
        at = warc.frame_end(data, 0)
        zd = zstandard.ZstdCompressionDict(data[8:at])
        kinds = []
        while at < len(data):
            end = warc.frame_end(data, at)
            fields, _ = warc.parse_record(zstandard.ZstdDecompressor(dict_data=zd).decompress(data[at:end]))
            kinds.append(fields["WARC-Type"])
            at = end
        assert kinds[0] == "warcinfo" and set(kinds[1:]) <= {"response", "revisit"}
        assert len(list(warc.read_range(path, 0, None, chunk=100))) == len(kinds)


def test_damaged_archive_is_refused(spark, pages):
    m = warc.write_archives(pages.filter("page_id = 5"), warc.archive_folder(spark))
    record = warc.page_record("5", "u", b"body", None, "")
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"body", b"bodi"))
    with pytest.raises(ValueError):
        list(warc.read_range(m.first().path, 0, m.first().size - 1))


def test_shuffled_groups_give_the_same_records(spark, pages, monkeypatch):
    """Beyond the broadcast limit: hot groups by broadcast, the rest by shuffle."""
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(warc, "HOT_SHARE", 0.3)
    got = warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark))).collect()
    assert len(got) == len(PAGES) and sum(r.record_type == "revisit" for r in got) == 5


def test_no_pages(spark, pages):
    assert warc.read_archives(warc.write_archives(pages.limit(0), warc.archive_folder(spark))).collect() == []
