"""Registered queries of the training-data operators (keys ``opN_<name>``).

Each query applies its operator with production parameters to the whole table and derives
the digest columns its contract names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import table
from meridian.llm import decontam, html_main, langid, licenses, packing, pii, spotsigs, token_merge, toxicity, turn_trie, warc
from meridian.llm.ngram_join import ngram_components
from meridian.llm.superkmer import remove_repeats


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named or quoted in every document, with their places in words."""
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["first_word"].cast("string"), m["end_word"].cast("string")))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
                        F.array_join(spans, ",").alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~langid.held_out())
    return (langid.identify(docs, model, keep=["doc_id"])
            .select("doc_id", langid.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
                    F.col("lang_rejected").alias("rejected")))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have Jaccard 0.75 or more."""
    return (ngram_components(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id", "class_size"))


def op4_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: one row per document and item."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_main.extract(table(spark, sf_dir, "pages"))


def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base patterns and identifiers found by their contexts."""
    return pii.digest(pii.find_private(table(spark, sf_dir, "documents")))


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, compared with its own and the next one's."""
    return spotsigs.fingerprint_with_edit(table(spark, sf_dir, "documents"))


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document; ``toxic`` is the decision of the chain's last model."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return toxicity.predict(docs, chain).withColumnRenamed("flagged", "toxic")


def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in optimal length buckets and token-budget batches."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by 35-word windows that occur more than once are removed."""
    return (remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return turn_trie.trie(turn_trie.rebuild(turn_trie.turns_of(table(spark, sf_dir, "conversations"))))


def op12_token_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizations of every document, aligned by byte ends."""
    return token_merge.align(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to dictionary-compressed WARC archives and read back."""
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return (warc.read_archives(manifest)
            .select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_latent_decontamination": op4_latent_decontamination,
    "op5_main_text": op5_main_text,
    "op6_bootstrapped_pii": op6_bootstrapped_pii,
    "op7_spotsigs": op7_spotsigs,
    "op8_toxicity_chain": op8_toxicity_chain,
    "op9_length_buckets": op9_length_buckets,
    "op10_superkmer_dedup": op10_superkmer_dedup,
    "op11_turn_trie": op11_turn_trie,
    "op12_token_merge": op12_token_merge,
    "op13_warc": op13_warc,
}

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    "op3_ngram_jaccard": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM w
), sizes AS (SELECT doc_id, len(sh) AS n, hash(list_sort(sh)) AS k FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT sizes.doc_id, CAST(n AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = sizes.doc_id) AS component_id,
  CASE WHEN n = 0 THEN 1 ELSE count(*) OVER (PARTITION BY k) END AS class_size
FROM sizes
""",
    "op10_superkmer_dedup": f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format("text")} AS ws FROM documents),
win AS (
  SELECT r, unnest(range(1, len(ws) - 33)) AS i, unnest([array_to_string(ws[j:j + 34], ' ') FOR j IN range(1, len(ws) - 33)]) AS t
  FROM w WHERE len(ws) >= 35
), hit AS (SELECT r, i FROM win WHERE t IN (SELECT t FROM win GROUP BY t HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + d AS i FROM hit, range(0, 35) AS o(d)),
words AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
kept AS (
  SELECT words.r, count(*) AS n, string_agg(word, ' ' ORDER BY words.i) AS t
  FROM words LEFT JOIN gone ON gone.r = words.r AND gone.i = words.i WHERE gone.r IS NULL GROUP BY words.r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.r = w.r
""",
    "op11_turn_trie": r"""
WITH src AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
pos AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS p FROM src),
conv AS (SELECT c, list({'r': r, 'x': x} ORDER BY p) AS ts FROM pos GROUP BY c),
crc AS (  -- CRC-32 of the decimal id, a byte and a bit at a time
  SELECT c, xor(list_reduce([ascii(substr(CAST(c AS VARCHAR), CAST(i AS BIGINT), 1)) FOR i IN range(1, length(CAST(c AS VARCHAR)) + 1)],
    lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(a, CAST(b AS BIGINT))),
    CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 6 AS h FROM conv
),
built AS (
  SELECT a.c, list_concat(coalesce(b.ts[1:crc.h], []), coalesce(a.ts[crc.h + 1:], [])) AS ts
  FROM conv a JOIN crc ON crc.c = a.c LEFT JOIN conv b ON b.c = a.c - a.c % 100
),
pre AS (SELECT c, len(ts) AS n, unnest([ts[1:d] FOR d IN range(0, len(ts) + 1)]) AS p FROM built),
node AS (
  SELECT p, len(p) AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = len(p)), '')) AS ends_sha256
  FROM pre GROUP BY p
),
child AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT up.p, sum((up.n_convs - 1) * up.len) AS saved, count(*) FILTER (up.leaf) AS leaves
  FROM (SELECT unnest([v.p[1:d] FOR d IN range(0, v.depth + 1)]) AS p, v.n_convs, child.p IS NULL AS leaf,
          CASE WHEN v.depth = 0 THEN 0 ELSE length(v.p[v.depth].x) END AS len
        FROM node v LEFT JOIN child ON child.p = v.p) up
  GROUP BY up.p
)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, CAST(coalesce(child.n, 0) AS BIGINT) AS n_children,
  CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM node v JOIN below ON below.p = v.p LEFT JOIN child ON child.p = v.p
LEFT JOIN node q ON v.depth > 0 AND q.p = v.p[1:v.depth - 1]
""",
    "op13_warc": r"""
WITH page AS (SELECT page_id, coalesce(html, '') AS t, upper(sha1(coalesce(html, ''))) AS x,
  row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
  first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS best FROM pages),
code AS (  -- base32: five hexadecimal digits give four letters
  SELECT *, list_transform(range(0, 32), lambda i: CAST('0x' || substr(x, CAST(1 + i // 4 * 5 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT) & 31) AS b FROM page
)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(b, lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(k + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN best END AS refers_to
FROM code
""",
}
