"""Each training-data operator against brute force, on edge cases and on a small table."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from meridian.llm import (decontam, html_main, langid, licenses, ngram_join, packing, pii, spotsigs,
                          superkmer, toxicity)
from tests.conftest import SF_CHECK, SF_SMALL

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(6000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text and clashing column names."""
    text = "one two three four five six seven eight nine ten " * 3
    data = [(1, None, "en", 1), (2, "", "en", 2), (3, " \t\n", None, 3), (4, "a b", "fr", 4), (4, "a b", "fr", 4), (5, text, "en", 5),
            (6, text + "eleven", "en", 6), (None, text, "de", 7), (7, LONG, "en", 8), (8, PASSAGE + " tail one", "en", 9),
            (9, "head two " + PASSAGE, None, 10), (10, "ééé ñ ünï +1 (555) 123-4567", "es", 11), (11, "!!! 123 ###", "en", 12)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, key long").withColumn("id", F.lit("x")).withColumn("th", F.lit(1))


def collected(df):
    return [r.asDict() for r in df.collect()]


# --- 3: n-gram Jaccard join --------------------------------------------------------------

def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x])
        for x in s:
            where[x].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return Counter((d, len(s), min(low[find(i)], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("wide", [False, True])
def test_ngram_components_equal_brute_force(spark, docs, odd, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(ngram_join, "FAMILY_BLOCKS", 0)
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
        monkeypatch.setattr(ngram_join, "FEW_EDGES", 0)
    df = docs.select("doc_id", "text").unionByName(odd.select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(df).collect())
    assert got == brute_components([tuple(r) for r in df.collect()])


def test_prefix_tree_finds_every_link():
    import numpy as np
    rnd = random.Random(4)
    base = [rnd.sample(range(400), 40) for _ in range(6)]
    sets = [np.unique(np.array([x if rnd.random() > 0.12 else rnd.randrange(400) for x in rnd.choice(base)])) for _ in range(120)]
    tree = ngram_join.PrefixTree(sets)
    for q in sets:
        want = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 75 * len(np.union1d(q, s))}
        assert set(tree.links(q, 75, lambda p: False)) == want


def test_border_elements_of_range_partitions_join(spark, monkeypatch):
    """A frequent element spread over many partitions still shows all its classes."""
    rows = [(f"common element of all texts number {i} " + " ".join(f"u{i}_{j}" for j in range(3))) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(rows + rows[:5])), "doc_id long, text string").repartition(7)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(df).collect())
    assert got == brute_components([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_shared_elements_do_not_depend_on_batch_borders(monkeypatch, size):
    """Repeated (h, key) rows at the border of two batches leave every row with its own element."""
    import pyarrow as pa

    class Task:
        def partitionId(self):
            return 0
    monkeypatch.setattr(ngram_join, "TaskContext", type("Context", (), {"get": staticmethod(Task)}))
    rnd = random.Random(size)
    for _ in range(60):
        rows = sorted((rnd.randrange(6), rnd.randrange(4)) for _ in range(rnd.randint(1, 40)))

        def found(step):
            parts = [rows[i:i + step] for i in range(0, len(rows), step)]
            batches = [pa.RecordBatch.from_arrays([pa.array([x[c] for x in p], pa.int64()) for c in (0, 1)], ["h", "key"]) for p in parts]
            return sorted(tuple(r.values()) for b in ngram_join._scan_shared(batches) for r in b.to_pylist())
        want = found(len(rows))
        assert {(h, k) for h, k, *_ in want} <= set(rows) and found(size) == want


def test_sets_that_can_link_share_a_banded_element(spark):
    """A set of n and the smallest that can link with it have an element in common; far sizes do not."""
    n = spark.range(1, 4000).select(F.lit(7).cast("long").alias("h"), F.col("id").alias("n"))
    big = ngram_join._banded(n, 75)
    low = ngram_join._banded(n.select("h", F.ceil(F.col("n") * 3 / 4).alias("n"), F.col("n").alias("of")), 75)
    assert big.join(low, (big.h == low.h) & (big.n == low.of)).select("of").distinct().count() == 3999
    far = ngram_join._banded(n.select("h", (F.col("n") * 2).alias("n"), F.col("n").alias("of")), 75)
    assert big.join(far, (big.h == far.h) & (big.n == far.of)).count() == 0


def test_keep_one_of_each_component(spark, odd):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 5, 7, 8, 10, 11], key=str)       # 6, null and 9 are near copies; 4 stays once


# --- 10: passages that repeat --------------------------------------------------------------

def test_rows_without_ids_join_their_own_texts_only(spark, monkeypatch):
    """Near-copy pairs whose rows have no id, or one id for all: the text step grows with the rows."""
    inner = ngram_join._emit_keyed_sets
    acc = spark.sparkContext.accumulator(0)

    def counted(n):
        run = inner(n)

        def wrapped(batches):
            def through():
                for b in batches:
                    acc.add(b.num_rows)
                    yield b
            yield from run(through())
        return wrapped
    monkeypatch.setattr(ngram_join, "_emit_keyed_sets", counted)
    rows = []
    for i in range(40):
        base = " ".join(f"p{i}w{j}" for j in range(60))
        rows += [(None if i % 2 else 7, base), (None if i % 2 else 7, base + " tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collected(ngram_join.ngram_components(df))
    assert len(got) == 80 and acc.value <= 160


def test_clashing_names_in_filtering_stages(spark):
    text = " ".join(f"w{i}" for i in range(40))
    data = [(1, text, "a", 1, "x", 1, 1), (1, text, "a", 1, "x", 1, 1), (2, text + " z", "b", 2, "y", 2, 2), (3, None, None, None, None, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, __k_id string, __k_th int, id string, th int, __copies int")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    left = decontam.drop_leaks(df, spark.createDataFrame([(None, None), (1, text)], "item_id long, text string"))
    assert left.columns == df.columns and [r["doc_id"] for r in left.collect()] == [3]


def test_empty_tables_give_empty_results(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    items = spark.createDataFrame([("", "a b c d e f g h")], "item_id string, text string")
    for got in (ngram_join.ngram_components(none), ngram_join.keep_one(none), decontam.find_leaks(none, items), decontam.drop_leaks(none, items),
                packing.pack(none)):
        assert got.count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_main.extract(pages).count() == 0


def brute_repeats(rows, k):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = Counter()
    for (d, _), w in zip(rows, words):
        gone = {x for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for x in range(i, i + k)}
        out[d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [2, 20_000])
def test_repeats_equal_brute_force(docs, odd, hot):
    for df in (docs.select("doc_id", "text"), odd.select("doc_id", "text"), odd):
        got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in superkmer.remove_repeats(df, hot=hot).collect())
        assert got == brute_repeats([(r["doc_id"], r["text"]) for r in df.collect()], 35)


def test_periodic_text_repeats_itself(spark):
    df = spark.createDataFrame([(1, "x y z " * 30), (2, "a " * 36), (3, "a " * 35)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in superkmer.remove_repeats(df).collect()}
    assert got == {1: 90, 2: 36, 3: 35}


def test_superkmer_places_of_a_frequent_window_do_not_meet():
    """300 rows of one passage: a range for each, dealt over as many keys; not a row for each of its 26 windows under 26 keys."""
    import numpy as np
    import pyarrow as pa
    from types import SimpleNamespace as held
    text = " ".join(f"w{i}" for i in range(60))
    b = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([text] * 300), pa.array([7] * 300, pa.int64())], ["id", "text", "th"])
    hot = {int(x) for c in superkmer._count_minimisers(35, 4)([b]) for x in c.column("key").to_pylist()}
    schema = pa.schema([("key", pa.int64()), ("own", pa.bool_()), ("text", pa.binary()), ("id", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
    marks = held(value=np.zeros(superkmer.SEEN_BITS // 8, np.uint8).tobytes())
    out = pa.Table.from_batches(superkmer._deal(35, 4, held(value=sorted(hot)), marks, held(value=None), schema)([b])).to_pylist()
    ranges = [r for r in out if r["text"] is None]
    assert sorted((r["id"], r["start"], r["n"]) for r in ranges) == [(i, 0, 26) for i in range(300)]
    assert len({r["key"] for r in ranges}) == 300 and len(out) == 326


# --- 6: personal data ----------------------------------------------------------------------

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(t):
    out = []
    for k, (name, rx) in enumerate(PATTERNS):
        for m in re.finditer(rx, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            even = sum(int(c) for c in d[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
            if (name == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (name == "phone" and not 10 <= len(d) <= 15) \
                    or (name == "card" and (not 14 <= len(d) <= 19 or even % 10)):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(6)
    parts = ["a@b.c", "x.y+z@q-1.example.com", "@", "a@@b.c.d", "1.2.3.4", "1.2.3.4.5", "300.1.1.1", "001.002.003.004", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "4111111111111112", "+1 (555) 123-4567", "+12", "+1 555 123 4567 ", "é", " ", "-", ".", "7", "x@1.2.3.4"]
    for _ in range(2000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_pii_digest_and_edge_cases(odd, docs):
    got = collected(pii.digest(pii.find_private(odd)))
    assert len(got) == odd.count()
    for df in (odd, docs):
        texts = defaultdict(set)
        for r in df.select("doc_id", "text").collect():
            base = ",".join(f"{PATTERNS[k][0]}:{a}:{z}" for a, k, z in plain_spans(r["text"]))
            texts[r["doc_id"]].add(hashlib.sha256(base.encode()).hexdigest())
        for r in collected(pii.digest(pii.find_private(df))):
            assert r["base_sha256"] in texts[r["doc_id"]]


def test_pii_counts_of_several_spans_of_a_kind(spark):
    data = [(1, "a@b.org and c@d.org and e@f.org"), (2, "1.2.3.4 x@y.net 5.6.7.8 +1 555 123 4567 q@r.net"), (3, "call +1 555 123 4567"),
            (None, "9.9.9.9, 4111 1111 1111 1111"), (4, "none"), (5, None)]
    got = {r["doc_id"]: [r[f"n_{k}"] for k in pii.KINDS] for r in collected(pii.digest(pii.find_private(spark.createDataFrame(data, "doc_id long, text string"))))}
    assert got == {1: [3, 0, 0, 0], 2: [2, 2, 0, 1], 3: [0, 0, 0, 1], None: [0, 1, 1, 0], 4: [0] * 4, 5: [0] * 4}


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please call office line +1 (555) 010-{1000 + i} today") for i in range(30)]
    rows += [(100, "please call office line 555-020-7777 today"), (101, "the code AB12345678 is unrelated")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find_private(df)).collect()}
    assert got[100] == "ctx_phone:24:36" and got[101] == "" and got[3].startswith("phone:24:")
    out = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert out[100] == "please call office line [PHONE] today" and out[0] == "please call office line [PHONE] today"


def test_contexts_discover_numbers_written_with_spaces(spark):
    rows = [(i, f"please call office line +1 (555) 010-{1000 + i} today") for i in range(30)]
    rows += [(100, "please call office line 555 020 7777 today"), (101, "please call office line (555) 123-4567 today"),
             (102, "please call office line 555 - 020 - 7777 today"), (103, "rows 555 020 8888 of the table"),
             (104, "in 2019. please call office line 20 7946 0958, today"), (105, "please call office line 555 020 4444 x9 today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find_private(df)).collect()}
    assert got[100] == "ctx_phone:24:36" and got[101] == "ctx_phone:24:38" and got[102] == "ctx_phone:24:40" and got[103] == ""
    out = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert {out[i] for i in (100, 101, 102)} == {"please call office line [PHONE] today"}
    assert out[104] == "in 2019. please call office line [PHONE], today" and out[105] == "please call office line [PHONE] x9 today"
    assert out[103] == rows[33][1]
    cands = [t for _, _, t, _ in pii._candidates("a1 555 020 7777, AB12345678 id 12 345 678 90x", [])]
    assert cands == ["555 020 7777", "12 345 678", "AB12345678"]


# --- 2: language -----------------------------------------------------------------------------

def test_language_held_out_accuracy(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, ~langid.held_out())
    got = langid.identify(docs, model).withColumn("ho", langid.held_out()).filter("ho").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert sum(r["lang_rejected"] for r in got) <= 0.01 * len(got)
    edge = {(r["doc_id"], r["text"]): r for r in langid.identify(odd, model).collect()}
    for k in ((1, None), (2, ""), (3, " \t\n"), (11, "!!! 123 ###")):
        assert edge[k]["lang_pred"] == "und" and edge[k]["lang_score"] == 0 and edge[k]["lang_rejected"]
    assert all(0 <= r["lang_score"] <= 1 for r in edge.values()) and set(odd.columns) < set(got[0].asDict()) | {"key", "id", "th"}
    none = langid.train(odd.filter("false"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(odd, none).collect()} == {"und"}


# --- 9: packing ------------------------------------------------------------------------------

def test_bounds_are_optimal():
    rnd = random.Random(3)
    for _ in range(80):
        x = rnd.sample(range(1, 40), rnd.randint(1, 9))
        c = [rnd.randint(1, 9) for _ in x]
        k = rnd.randint(1, 5)

        def padding(bounds):
            return sum(n * (min(b for b in bounds if b >= v) - v) for v, n in zip(x, c))
        got = packing.optimal_bounds(x, c, k)
        assert len(got) <= k and padding(got) == min(padding((*b, max(x))) for b in itertools.combinations(x, min(k, len(x)) - 1))


def test_packing_keeps_every_token(odd, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 3)
    got = collected(packing.pack(odd, max_len=100, buckets=4, token_budget=300))
    assert sum(r["n_tokens"] for r in got) == sum(len((r["text"] or "").encode().split()) for r in odd.collect())
    batches = defaultdict(list)
    for r in got:
        if r["n_tokens"]:
            assert r["padding"] == r["bucket"] - r["n_tokens"] >= 0
            batches[r["bucket"], r["batch"]].append(r["slot"])
    for (bucket, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bucket <= max(300, bucket)
    last = Counter(b for b, _ in batches)
    assert all(len(batches[b, i]) == max(1, 300 // b) for b in last for i in range(last[b] - 1))     # only the last is open


def test_repeated_rows_are_dealt_over_slices(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    monkeypatch.setattr(packing, "COPIES", 20)
    df = spark.createDataFrame([(None, "same words here")] * 600 + [(7, "three more words")] * 300 + [(i, "a b c") for i in range(100)], "doc_id long, text string")
    got = collected(packing.pack(df, token_budget=30))
    assert len(got) == 1000 and Counter(r["doc_id"] for r in got)[None] == 600
    places = Counter((r["batch"], r["slot"]) for r in got)
    assert set(places.values()) == {1} and {b for b, _ in places} == set(range(100))        # ten a batch, none open


# --- 1: licenses -----------------------------------------------------------------------------

def test_license_scan(spark, odd):
    mit = licenses.TEMPLATES[2][1]
    rows = [(1, "intro words " + mit.replace("free of charge", "at no cost") + " more"), (2, None), (3, ""), (4, "licensed mit"),
            (5, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0. All rights reserved."), (6, "all the rights of the reserved seats")]
    got = {r["doc_id"]: [(m["license"], m["first_word"]) for m in r["matches"]]
           for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [("MIT", 2)], 2: [], 3: [], 4: [], 6: [], 5: [("CC-BY-NC-4.0", 0), ("CC-BY-NC-4.0", 7), ("All-Rights-Reserved", 14)]}
    assert licenses.find_licenses(odd).count() == odd.count()


def scanned(text):
    import numpy as np
    from meridian.llm.common import LOWER, NON_WORD, word_table
    made = [licenses._Template(*t) for t in licenses.TEMPLATES]
    buf = np.frombuffer(text.encode(), np.uint8)
    words = word_table(buf, np.array([0, len(buf)]), NON_WORD, LOWER)[2].tolist()
    where = defaultdict(list)
    for i, x in enumerate(words):
        if any(x in t.telling for t in made):
            where[x].append(i)
    return [(n, a) for a, _, n, _ in licenses.scan_words(words, where, made)]


def test_a_copy_without_the_rarest_words_is_found():
    """Words that an edited copy lacks are the rarest of a text with a clean copy too."""
    mit, gap = licenses.TEMPLATES[2][1], " ".join(f"x{i}" for i in range(100))
    words = re.findall(r"[A-Za-z]+", mit)
    for gone in (("charge", "merge", "sell"), ("granted", "documentation", "sublicense", "furnished", "conditions"), ("deal", "obtaining", "publish")):
        edited = " ".join("qq" if w in gone else w for w in words)
        other = " ".join("qq" if w in ("hereby", "files", "restriction") else w for w in words)
        for text in (f"{mit} {gap} {edited}", f"{edited} {gap} {mit}", f"{edited} {gap} {other}", f"{edited} {gap} {' '.join(gone)}"):
            second = [] if text.endswith(" ".join(gone)) else [("MIT", len(words) + 100)]
            assert scanned(text) == [("MIT", 0), *second]
    assert scanned("Licensed under CC BY-SA 4.0") == [("CC-BY-SA-4.0", 0)]


def test_patience_alignment_is_a_common_subsequence():
    rnd = random.Random(2)
    for _ in range(300):
        v = [rnd.randint(0, 20) for _ in range(rnd.randint(0, 14))]
        best = [1] * len(v)
        for i, j in itertools.product(range(len(v)), repeat=2):
            if j < i and v[j] < v[i]:
                best[i] = max(best[i], best[j] + 1)
        assert len(licenses.longest_increasing(v)) == max(best, default=0)
        a, b = ([rnd.randint(0, 9) for _ in range(12)] for _ in range(2))
        p = licenses.patience_align(a, b)
        assert all(a[i] == b[j] for i, j in p) and all(x < y and q < z for (x, q), (y, z) in zip(p, p[1:]))


# --- 4: decontamination ----------------------------------------------------------------------

def test_lcs_length_equals_the_table():
    rnd = random.Random(9)
    for _ in range(200):
        a, b = ([rnd.randint(0, 6) for _ in range(rnd.randint(1, 15))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        mask = {x: sum(1 << i for i, y in enumerate(a) if y == x) for x in a}
        assert decontam.lcs_length(mask, len(a), b) == t[-1][-1]


def test_leaks_are_found_and_clean_documents_left(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    flat = {r["item_id"]: " ".join(r["text"].split()) for r in items.collect()}
    truth = {(r["doc_id"], k) for r in docs.collect() for k, t in flat.items() if t in " ".join((r["text"] or "").split())}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, items).collect()}
    assert truth and truth <= got and len(got - truth) <= 2
    left = decontam.drop_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in got})
    assert decontam.find_leaks(odd, items).count() == 0 and decontam.find_leaks(odd.limit(0), items.limit(0)).count() == 0


@pytest.mark.parametrize("every", [12, 4, 1])
def test_items_of_frequent_words_are_found(spark, every):
    """An item that stands in a large share of the passages is found wherever it stands."""
    rnd = random.Random(every)
    item = "please rate the answer on a scale from one to ten before you move over again"
    rows = []
    for i in range(240):
        words = [f"u{rnd.randrange(4000)}" for _ in range(rnd.randint(30, 60))]
        at = rnd.randint(0, len(words))
        rows.append((i, " ".join(words[:at] + (item.split() if i % every == 0 else []) + words[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, " ".join(f"z{i}" for i in range(20)))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, items).collect()}
    assert got == {(i, 7) for i in range(0, 240, every)}


def test_only_the_leaking_rows_of_an_id_go(spark):
    """Rows without an id, and rows that share a leaking row's id, are judged by their own text."""
    item = " ".join(f"item{i}" for i in range(20))
    clean = [" ".join(f"c{k}x{i}" for i in range(40)) for k in range(3)]
    rows = [(None, f"{clean[0]} {item}"), (None, clean[1]), (None, None), (5, f"{item} {clean[2]}"), (5, clean[2]), (5, clean[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = Counter(tuple(r) for r in decontam.drop_leaks(df, items).collect())
    assert left == Counter([(None, clean[1]), (None, None), (5, clean[2]), (5, clean[2])])


def test_paraphrased_items_are_found(spark):
    """Two copies of each item inside documents; words are lost at random, half of them replaced."""
    rnd = random.Random(8)
    bench = spark.read.parquet(f"{SF_CHECK}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.orderBy("item_id").limit(40).collect()]
    texts = [r["text"] for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").orderBy("doc_id").limit(600).collect() if r["text"]]
    vocab = " ".join(texts[:200]).split()
    rows = list(enumerate(texts))
    already = {r["doc_id"] for r in decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert len(already) < 0.1 * len(rows)
    least, planted = {0.0: 1.0, 0.1: 0.95, 0.2: 0.9}, {}
    for lost in least:
        for k in range(80):
            item, out = items[k % len(items)], []
            for w in item[1].split():
                if rnd.random() >= lost:
                    out.append(w)
                elif rnd.random() < 0.5:
                    out.append(rnd.choice(vocab))
            body = texts[k].split()
            at = rnd.randrange(len(body) + 1)
            planted[len(rows), item[0]] = lost
            rows.append((len(rows), " ".join(body[:at] + out + body[at:])))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    for lost, share in least.items():
        want = {p for p, x in planted.items() if x == lost}
        assert len(got & want) >= share * len(want), (lost, len(got & want))
    assert {k for k, _ in got if k < len(texts)} == already            # no clean document more


# --- 5: main text ----------------------------------------------------------------------------

def test_main_text_of_the_pages(spark):
    import html
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert html_main.main_text(r["html"]) == " ".join(x for x in want if x)


def test_inline_boilerplate_goes():
    long = "The fox is a friend of the dog and it was with us for a long time in the garden; we were happy to see that they play."
    for bad in ("<button>Share</button>", "<label>Share</label>", "<span class=ad>Share</span>", "<a class='share' href=x>Share</a>",
                "<span hidden>Share</span>", "<b class=sponsored><i>Share</i></b>"):
        for page in (f"<article><p>{long}</p>{bad}<p>{long}</article>", f"<article><p>{long} {bad} {long}</article>",
                     f"<p>{long}</p>{bad}<p>{long}</p>", f"<p>{long} {bad} {long}"):
            assert html_main.main_text(page) == f"{long} {long}", page


def test_main_text_edge_cases(spark):
    long = "The fox is a friend of the dog and it was with us for a long time in the garden; we were happy to see that they play. " * 3
    page = (f"<header><h1>Site</h1></header><div class='cookie-notice'>{long}</div><h2>A title</h2><p>{long}<p>Short one."
            f"<ul><li><a href=x>Home</a></ul><section class=comments><p>{long}</section><form>{long}</form><footer>c</footer>")
    assert html_main.main_text(page) == f"A title {' '.join(long.split())} Short one."
    assert html_main.main_text("<article><p>One &lt;b&gt;&nbsp; two<!-- x --><script>a<b</script><p>tail &am") == "One <b> two tail &am"
    df = spark.createDataFrame([(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "<p", "t")], "page_id long, url string, html string, text string")
    assert [(r["text"], r["n_chars"]) for r in html_main.extract(df).collect()] == [("", 0)] * 3


@pytest.mark.parametrize("page, text", [
    ("<article><header><h1>A title</h1><div>By X</div></header><p>body</p></article>", "A title body"),
    ("<article><div class='section-header'><h2>Part</h2></div><p class='reader'>body</p></article>", "Part body"),
    ("<article><table class=toolbar><tr><td>cell</td></tr></table><p>tail</article>", "cell tail"),
    ("<p>before<video src=x><p>after<object data=y>end", "before after end"),
    ("<div><p>one short</p><p>two short</p></div><nav>menu</nav>", "one short two short"),
    ("plain text without tags", "plain text without tags"),
    ("<header><h1>Site</h1></header><article><p>body</article>", "body"),
    ("<article><p>body</p><aside><header><h2>Ad</h2></header></aside></article>", "body")])
def test_main_text_keeps_titles_and_short_pages(page, text):
    assert html_main.main_text(page) == text


@pytest.mark.parametrize("mark", ["<a ", "<div>", "<div></span>", "<head>", "<video>x", "<!", "<p>word", "<article><header>"])
def test_broken_markup_is_read_in_linear_time(mark):
    import time

    def took(n):
        t = time.process_time()
        html_main.main_text(mark * n)
        return time.process_time() - t
    took(1000)
    assert took(80_000) < 8 * max(took(20_000), 0.02)         # quadratic: 16 times


# --- 7: fingerprints -------------------------------------------------------------------------

def test_fingerprints_and_edits(spark, docs, odd):
    got = collected(spotsigs.fingerprint_with_edit(docs))
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    want = {}
    for i, (d, t) in enumerate(rows):
        nxt, k = rows[(i + 1) % len(rows)][1], len(t) // 3
        want[d] = (len(t), hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest())
    assert all(want[r["doc_id"]] == (r["n_chars"], r["edited_sha256"]) for r in got) and len(got) == len(rows)
    text = dict(rows)
    marks = defaultdict(set)
    for r in got:
        marks[text[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        a, b = (set(re.findall("." * 8, r[c])) for c in ("fingerprint", "edited_fingerprint"))
        assert r["near_edited"] == (len(a & b) / len(a | b) if a | b else 1.0)
    assert all(len(m) == 1 for m in marks.values())
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.9 * len(got)
    edge = collected(spotsigs.fingerprint_with_edit(odd))
    assert len(edge) == odd.count() and {r["fingerprint"] for r in edge if not r["n_chars"]} == {""}
    assert spotsigs.fingerprint_with_edit(odd.limit(0)).count() == 0


def test_near_duplicates_equal_all_pairs(docs):
    members, pairs = spotsigs.near_duplicates(docs.filter("doc_id < 120"), 0.5)
    sigs = {r["doc_id"]: set(r["s"]) for r in spotsigs.signatures(docs.filter("doc_id < 120"), "text", "s").collect()}
    reps = {r["id"]: r["rep"] for r in members.collect()}
    assert all(sigs[d] == sigs[r] for d, r in reps.items())
    heads = sorted(set(reps.values()))
    want = {(a, b) for a, b in itertools.combinations(heads, 2) if sigs[a] and len(sigs[a] & sigs[b]) >= 0.5 * len(sigs[a] | sigs[b])}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want


# --- 8: toxicity -----------------------------------------------------------------------------

def test_chain_on_held_out_rows(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.col("doc_id") % 2 == 0
    chain = toxicity.train(docs, labels.filter(half), ["quality", "toxic"])
    got = toxicity.predict(docs, chain).join(labels.filter(~half), "doc_id").collect()
    hit = sum(r["flagged"] and r["toxic"] == 1 for r in got)
    assert hit >= 0.8 * sum(r["toxic"] == 1 for r in got) and hit >= 0.9 * sum(r["flagged"] for r in got)
    assert toxicity.predict(odd, chain).count() == odd.count()
    none = toxicity.train(odd, labels.limit(0), ["toxic"])
    assert {r["flagged"] for r in toxicity.predict(odd, none).collect()} == {False}
