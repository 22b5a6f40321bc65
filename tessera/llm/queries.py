"""The registered queries of this subpackage: each operator over its whole
table, with the parameters it is meant to run with, and the SQL that checks
it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, byte_bpe, dac, feistel, html_extract, katz, langid, merkle, mih, mixing, phrases, simhash, variants
from tessera.llm.common import crc32_text, materialize, table, utf8_size


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_extract.extract_table(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    found = mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    out = merkle.compare_neighbours(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256")
    return out.select("doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         strlen(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS solid,
         strlen(regexp_replace(coalesce(text, ''), '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS letters,
         ('0x' || substr(md5(concat_ws('|', '7', CAST(doc_id AS VARCHAR), text)), 1, 13))::BIGINT AS draw
  FROM documents),
k AS (
  SELECT *, CASE WHEN solid > 0 THEN greatest(0.05, (letters * 1024 // solid) / 1024.0) ELSE 1.0 END::DOUBLE AS quality FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
r AS (  -- sources that reach their cap first come first; the scale is the first one that the next source's cap bears
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(w) OVER (ORDER BY 2 * source_size / w::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s),
z AS (
  SELECT min_by(scale, 2 * source_size / w::DOUBLE) AS scale
  FROM (SELECT *, (1.5 * (SELECT sum(source_size) FROM s) - fixed)::DOUBLE / free AS scale FROM r)
  WHERE scale * w <= cap),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(scale * w, cap)::DOUBLE) AS target FROM r, z),
m AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY -ln((draw + 0.5) / 4503599627370496.0) / quality, k.doc_id, k.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN target - epochs * source_size > 0
                                   AND upto - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM m
"""


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a model of four fifths of them."""
    return katz.scores(table(spark, sf_dir, "documents"), katz.held_out("doc_id"))


def op7_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return dac.document_digests(dac.write_tokens(table(spark, sf_dir, "documents")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and decoded text."""
    return bpe.digests(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        (utf8_size(F.col("text")) + 1).alias("size"),
        crc32_text(F.col("text")).alias("text_crc32"),
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("hash"),
    )
    dealt = feistel.deal(materialize(rows, "shard-rows"), "doc_id", "hash")
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS size FROM starts),
f AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS a
  FROM grams GROUP BY ALL HAVING count(*) >= 100),
inner_parts AS (  -- every shorter phrase of two words and more inside a longer one
  SELECT lang, a, phrase AS longer, string_split(phrase, ' ') AS w, size,
         unnest(range(2, size)) AS part FROM f WHERE size > 2),
inside AS (
  SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS i FROM inner_parts) GROUP BY ALL),
kept AS (
  SELECT f.* FROM f LEFT JOIN inside USING (lang, phrase)
  WHERE f.size > 1 AND (inside.longer IS NULL OR 100 * inside.longer < 100 * f.a)),
cuts AS (
  SELECT lang, phrase, a, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, k,
         CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
              JOIN total ON total.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some of which have
    lost a letter."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"), misspell_every=199)


OP12_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
each AS (
  SELECT run, count(*) AS times, hex(encode(concat(doc_id, ':', run))) AS bytes
  FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
nibbles AS (  -- the low half of each byte first
  SELECT run, times, list_transform(range(0, len(bytes)), lambda k: (position(substr(bytes, CAST(k + 2 - 2 * (k % 2) AS BIGINT), 1) IN '0123456789ABCDEF') - 1)::BIGINT) AS x
  FROM each),
steps AS (  -- what four steps of the reversed CRC-32 polynomial make of a half byte
  SELECT list(list_reduce([0, 0, 0, 0]::BIGINT[], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS t
  FROM range(16) r(i)),
hashed AS (
  SELECT run, times, xor(list_reduce(x, lambda c, v: xor(c >> 4, t[1 + (xor(c, v) & 15)]), 4294967295::BIGINT), 4294967295) AS h
  FROM nibbles, steps),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
places AS (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM v),
skipped AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM places WHERE i < length(word)),
met AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 1) AS b FROM places),
near AS (
  SELECT x.word, y.word AS other, y.n FROM skipped x JOIN skipped y USING (a, b) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM skipped x JOIN met y USING (a, b)
  UNION SELECT y.word, x.word, x.n FROM skipped x JOIN met y USING (a, b)),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS form_n FROM near GROUP BY word),
forms AS (SELECT v.word, best.other AS form, form_n FROM v JOIN best USING (word) WHERE form_n >= 5 * v.n),
lead AS (
  SELECT word, form AS root FROM forms
  UNION ALL SELECT lead.word, forms.form FROM lead JOIN forms ON forms.word = lead.root),
last AS (SELECT word, root FROM lead WHERE root NOT IN (SELECT word FROM forms))
SELECT v.word, forms.form, coalesce(last.root, v.word) AS root, v.n, coalesce(best.n_near, 0)::BIGINT AS n_near, forms.form_n
FROM v LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN last USING (word)
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's byte-level ids and decoded bytes."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_html": op2_html,
    "op3_mih": op3_mih,
    "op4_merkle": op4_merkle,
    "op5_mixing": op5_mixing,
    "op6_katz": op6_katz,
    "op7_dac": op7_dac,
    "op8_bpe": op8_bpe,
    "op9_langid": op9_langid,
    "op10_feistel": op10_feistel,
    "op11_phrases": op11_phrases,
    "op12_variants": op12_variants,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {"op5_mixing": OP5_SQL, "op11_phrases": OP11_SQL, "op12_variants": OP12_SQL}
