"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table
from .decontaminate import find_leaks
from .language import held_out, identify, train
from .line_dedup import dedup_lines
from .matroska import packets, read_payload, store_texts
from .near_dedup import near_duplicates
from .piece_bpe import encode_decode
from .pseudonyms import KINDS, pseudonymize
from .revisits import resolve_revisits
from .substring_dedup import remove_repeats
from .token_store import read_tokens, write_tokens


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM lines),
hot AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE h.k IS NOT NULL))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE h.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot h ON keyed.k = h.k GROUP BY doc_id
"""


#: For the registered query alone, so that its results can be compared; real keys are given by the caller and kept out of code.
TEST_KEY = "not a secret"


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymize(read_table(spark, sf_dir, "documents").select("doc_id", "text"), key=TEST_KEY)
    is_kind = lambda k: lambda x: x["kind"] == k
    counts = [F.size(F.filter("found", is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    pairs = F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["pseudonym"]))
    return out.select("doc_id", "text", *counts, F.array_join(pairs, "|").alias("pseudonyms"))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is; the folder is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def digest_pieces(out: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_pieces(encode_decode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model")))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = write_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(shards).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(store_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True), "media")
    back = read_payload(stored)
    feature = F.format_string("packets=%d;clusters=%d;cues=%s;ns=%d;table=%d", "n_packets", "n_clusters", F.col("cues_ok").cast("string"), "duration_ns", "table_crc32")
    payload, size = F.col("payload"), F.octet_length("payload")
    return back.select(
        "doc_id",
        "n_bytes",
        size.cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substr(payload, size - 63, F.lit(64))).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )


def media_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packet table of the stored media, a row for each packet."""
    stored = materialize(store_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True), "media")
    return packets(stored).drop("n_bytes")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_leaks(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("leaks").alias("x"))
    return out.select("doc_id", "x.item_id", F.round("x.score", 6).alias("score"), F.round("x.question", 6).alias("question"), F.round("x.answer", 6).alias("answer"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"), size=2, threshold=0.8)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: Captures of each page, as SQL that both engines read: a first response (not of every fifth page), for every third page a
#: later one of other content, a revisit after both, and one before.  Some know only tags, some only
#: dates, some neither; some URLs are null or spelled in another way.
RECORDS_SQL = r"""
p AS (SELECT page_id, url, length(html) AS n, md5(coalesce(html, '')) AS tag,
             CASE WHEN page_id % 4 = 1 THEN 'day ' || CAST(page_id % 50 AS STRING) END AS day FROM pages),
r AS (
  SELECT page_id * 4 AS record_id, 'response' AS kind, url, page_id AS ts, CASE WHEN page_id % 13 = 0 THEN 404 ELSE 200 END AS status,
         CASE WHEN page_id % 4 <> 1 THEN 'W/' || tag END AS etag, day AS last_modified, n FROM p WHERE page_id % 5 <> 0
  UNION ALL
  SELECT page_id * 4 + 1, 'response', url || '#later', page_id + 200000, 200, md5(tag || '2'), NULL, n + 1 FROM p WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 4 + 2, 'revisit', CASE WHEN page_id % 11 <> 0 THEN url || '#again' END, page_id + 400000, 304,
         CASE WHEN page_id % 4 <> 1 AND page_id % 7 <> 0 THEN tag END, CASE WHEN page_id % 8 = 1 THEN 'another day' ELSE day END, 0 FROM p
  UNION ALL
  SELECT page_id * 4 + 3, 'revisit', url, page_id - 100000, 304, tag, NULL, 0 FROM p WHERE page_id % 2 = 0)"""


def page_records(pages: DataFrame) -> DataFrame:
    header = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    rows = pages.sparkSession.sql(f"WITH {RECORDS_SQL.replace('FROM pages', 'FROM {pages}')} SELECT * FROM r", pages=pages)
    full = [header("content-type", F.lit("text/html")), header("content-length", F.col("n")), header("date", F.col("ts"))]
    short = [header("content-length", F.lit(0)), header("date", F.col("ts")), header("age", F.lit(0))]
    return rows.withColumn("headers", F.when(F.col("kind") == "response", F.array(*full)).otherwise(F.array(*short)))


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(page_records(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    text = F.array_join(F.array_sort(F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), h["value"]))), ";")
    return out.select("record_id", "url", "outcome", "target_id", text.alias("headers"))


OP3_SQL = f"""
WITH {RECORDS_SQL},
s AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM r),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www[0-9]*\\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'),
                   lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref)(=|$)'))) AS params FROM s),
u AS (SELECT * EXCLUDE (url), host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url FROM c),
m AS (
  SELECT v.record_id, arg_max(f.record_id, f.ts::HUGEINT * 100000000000 + f.record_id) AS target_id
  FROM u v LEFT JOIN u f ON f.kind = 'response' AND f.status = 200 AND f.url = v.url AND f.ts < v.ts
  WHERE v.kind = 'revisit' GROUP BY ALL),
o AS (
  SELECT v.record_id, v.url, v.ts, m.target_id, f.n,
         CASE WHEN m.target_id IS NULL THEN 'none'
              WHEN v.etag IS NOT NULL AND f.etag IS NOT NULL THEN CASE WHEN v.etag = replace(f.etag, 'W/', '') THEN 'resolved' ELSE 'changed' END
              WHEN v.last_modified IS NOT NULL AND f.last_modified IS NOT NULL THEN CASE WHEN v.last_modified = f.last_modified THEN 'resolved' ELSE 'changed' END
              ELSE 'unchecked' END AS outcome
  FROM m JOIN u v ON v.record_id = m.record_id LEFT JOIN u f ON f.record_id = m.target_id)
SELECT record_id, url, outcome, target_id,
       CASE WHEN outcome = 'resolved' THEN 'age=0;content-length=' || n || ';content-type=text/html;date=' || ts END AS headers
FROM o
"""

QUERIES = {"op1_line_dedup": op1_line_dedup, "op10_pseudonyms": op10_pseudonyms, "op8_piece_bpe": op8_piece_bpe, "op2_token_store": op2_token_store, "op6_matroska": op6_matroska, "media_packets": media_packets, "op5_language": op5_language, "op9_decontaminate": op9_decontaminate, "op4_near_dedup": op4_near_dedup, "op7_substring_dedup": op7_substring_dedup, "op3_revisits": op3_revisits}
ORACLES = {"op1_line_dedup": OP1_SQL, "op3_revisits": OP3_SQL}
