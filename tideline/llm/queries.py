"""The training-data queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, decontamination, fixity, licenses, near_dup, packing, periodic_runs, quality, spelling, substring_dedup, token_counts, topk, unit_dedup
from tideline.llm.common import materialize, read_table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), path=public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op3_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its place and whether an audit against a decayed copy of the archive finds it.

    The copy is derived from the pages: records of ids = 5 mod 101 have a byte changed, those = 7 mod 211 are lost.
    """
    held = fixity.archive(read_table(spark, sf_dir, "pages"))
    index = held.select("record_id", "file", "offset", "length")
    flipped = F.encode(F.concat(F.decode("content", "utf-8"), F.lit("!")), "utf-8")
    copy = held.where(F.col("record_id") % 211 != 7).select("record_id", F.when(F.col("record_id") % 101 == 5, flipped).otherwise(F.col("content")).alias("content"))
    found = fixity.audit(index, held.select("record_id", "content"), copy)
    return index.join(found.select("record_id", "status"), "record_id", "left").select("record_id", "file", "offset", "length", F.coalesce("status", F.lit("same")).alias("status"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels")
    model = quality.train(docs, quality.graded(labels), levels=3)
    return quality.score(docs, model, at_least=2).drop("text")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents")).drop("detections")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept", "spans")


def _units_removed(out: DataFrame) -> DataFrame:
    removed = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", F.col("kept_text").alias("text"), "n_units", F.size("spans").cast("long").alias("n_removed"), removed.alias("removed"))


def op7_whole_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units_removed(unit_dedup.remove_repeated_units(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), path=public_tokenizers.path("piece_bpe_32k.model"))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(read_table(spark, sf_dir, "documents"), path=public_tokenizers.path("byte_bpe_50k.json"), decoded="decoded")
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def looped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A tenth of the texts by their id, from some word on as a loop of some of their own words; others as they are."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for k, i in enumerate(batch.column("doc_id").to_pylist()):
            h = 1 if i is None else zlib.crc32(str(i).encode())
            words = (texts[k] or "").encode().split() if h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                texts[k] = b" ".join([*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]).decode()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, of which a tenth are given loops by a rule on their id, with their runs and what is left of them."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    found = periodic_runs.periodic_runs(docs.mapInArrow(looped, "doc_id long, text string"), shortest=12)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    out = found.withColumns({"longest": longest, "length": -F.col("longest.less")})
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), "length", F.col("longest.period").alias("period"),
        F.expr("1000 * length div longest.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def misspelt(doc_id: int | None, run: bytes) -> bytes:
    """One in 199 runs of a text loses a code point, by a rule on the text's id and the run."""
    h = zlib.crc32(b"%s:%s" % (b"" if doc_id is None else b"%d" % doc_id, run if run.isascii() else run.decode("latin-1").encode()))
    k = h % len(run)
    return run if h % 199 else run[:k] + run[k + 1 :]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(read_table(spark, sf_dir, "documents"), misspelt, shortest=6)
    return spelling.variant_groups(materialize(counts.where("n >= 5"))).select("word", "n", "n_near", "form", "form_n", "root")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_duplicates, op2_packing, op3_fixity_audit, op4_quality_classifier, op5_license_scan, op6_suffix_dedup, op7_whole_line_dedup, op8_top_k, op9_decontamination, op10_token_counts, op11_bpe_codec, op12_periodic_runs, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return SQL


SQL: dict[str, str] = {
    "op1_near_duplicates": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
reps AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
parts AS (SELECT rep, n, unnest(s) AS x FROM reps),
pairs AS (SELECT p.rep AS a, q.rep AS b, count(*) AS c, any_value(p.n) AS na, any_value(q.n) AS nb FROM parts p JOIN parts q ON p.x = q.x AND p.rep < q.rep GROUP BY p.rep, q.rep),
edges AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach(node, far) AS (SELECT rep, rep FROM reps UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.far = e.a),
roots AS (SELECT node, min(far) AS root FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(o.root, d.doc_id) AS component_id, coalesce(o.root, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN reps r ON list_sort(d.s) = r.s LEFT JOIN roots o ON o.node = r.rep""",
}
SQL["op9_decontamination"] = """
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM dw WHERE len(w) >= 5),
it AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM iw WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item FROM it GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM ds JOIN it USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n_item)"""

SQL["op6_suffix_dedup"] = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, (length(h) // 2)::BIGINT AS n_bytes FROM b),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS x FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 49)) AS i FROM n)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS least FROM w),
lost AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(range(0, 50)) AS k FROM m WHERE doc_id > least)),
bytes AS (SELECT doc_id, unnest(range(0, n_bytes)) AS i, h FROM n),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) AS h FROM bytes ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id),
spans AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR i > before + 1) AS n_spans
          FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM lost) GROUP BY doc_id)
SELECT n.doc_id, n.n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM n LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)"""

SQL["op7_whole_line_dedup"] = r"""
WITH u AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(replace(coalesce(text, ''), chr(10), chr(10) || chr(1)), '([.!?] )', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS us FROM documents),
e AS (SELECT doc_id, unnest(us) AS unit, unnest(range(1, len(us) + 1)) AS k FROM u),
o AS (SELECT doc_id, k, unit, coalesce(sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
             coalesce(count(*) FILTER (WHERE ends_with(unit, chr(10))) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line,
             regexp_extract_all(lower(unit), '[\p{L}\p{N}_]+') AS w FROM e),
l AS (SELECT doc_id, line, words <> '' AND row_number() OVER (PARTITION BY words ORDER BY doc_id, line) > 1 AS gone
      FROM (SELECT doc_id, line, coalesce(string_agg(array_to_string(w, ' '), ' ' ORDER BY k) FILTER (WHERE len(w) > 0), '') AS words FROM o GROUP BY doc_id, line)),
r AS (SELECT doc_id, k, unit, start, gone OR (len(w) >= 5 AND row_number() OVER (PARTITION BY array_to_string(w, ' ') ORDER BY doc_id, k) > 1) AS lost FROM o JOIN l USING (doc_id, line)),
a AS (SELECT doc_id, string_agg(unit, '' ORDER BY k) FILTER (WHERE NOT lost) AS kept, count(*) FILTER (WHERE lost) AS n_removed,
             string_agg(start || '-' || (start + length(unit)), ',' ORDER BY k) FILTER (WHERE lost) AS removed FROM r GROUP BY doc_id)
SELECT u.doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, len(us)::BIGINT AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM u LEFT JOIN a USING (doc_id)"""

SQL["op8_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5"""

SQL["op3_fixity_audit"] = """
WITH r AS (SELECT page_id AS record_id, page_id // 4096 AS file,
  strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS length FROM pages)
SELECT record_id, file, coalesce(sum(length) OVER (PARTITION BY file ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset", length,
  CASE WHEN record_id % 211 = 7 THEN 'missing_second' WHEN record_id % 101 = 5 THEN 'changed' ELSE 'same' END AS status FROM r"""

#: The unsigned crc32 of a string, bit by bit.
CRC = """list_reduce([4294967295::BIGINT] || flatten(list_transform(range(0, octet_length(encode({x}))), lambda i: list_transform(range(0, 8), lambda k:
  ((('0x' || substr(hex(encode({x})), 2 * i::INT + 1, 2))::BIGINT >> k) & 1)))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))"""

# Runs as stretches of equal windows of six words at one distance, which is independent of suffix classes.
SQL["op12_periodic_runs"] = """
WITH w0 AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
h0 AS (SELECT doc_id, w, len(w) AS n, xor(CRC, 4294967295) AS h FROM w0),
g0 AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM h0),
words AS (SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x FROM (SELECT *, unnest(range(0, n)) AS i FROM g0)),
six AS (SELECT doc_id, i, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS s FROM words),
named AS (SELECT doc_id, i, array_to_string(s, ' ') AS s FROM six WHERE len(s) = 6),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM named a JOIN named b ON a.doc_id = b.doc_id AND a.s = b.s AND a.i < b.i),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + 5 AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs) GROUP BY doc_id, q, k),
runs AS (SELECT doc_id, s, l + q AS length, min(q) AS q FROM stretches WHERE l >= q AND l + q >= 12 GROUP BY doc_id, s, l + q),
best AS (SELECT doc_id, s, length, q FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, s, q) AS k FROM runs) WHERE k = 1),
digest AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
lost AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, length, q AS period, 1000 * length // q AS exponent_milli,
  sha256(coalesce(g.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN digest g USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)""".replace("CRC", CRC.format(x="doc_id::VARCHAR"))

# Near words by what is left of them without one code point.
SQL["op13_spelling_variants"] = """
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents),
c AS (SELECT run, n, xor(CRC, 4294967295) AS h FROM (SELECT run, count(*) AS n, doc_id || ':' || run AS z FROM r WHERE length(run) >= 6 GROUP BY doc_id, run)),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM c)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
del AS (SELECT word, k, substr(word, 1, k::INT - 1) || substr(word, k::INT + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM v)),
near AS (SELECT DISTINCT a.word, b.word AS other FROM del a JOIN del b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT d.word, v.word FROM del d JOIN v ON d.rest = v.word UNION SELECT v.word, d.word FROM del d JOIN v ON d.rest = v.word),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS k, count(*) OVER (PARTITION BY word) AS n_near
         FROM (SELECT near.word, other, v.n AS other_n FROM near JOIN v ON near.other = v.word)),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form, CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best ON v.word = best.word AND k = 1),
path(word, far) AS (SELECT word, word FROM f UNION ALL SELECT p.word, f.form FROM path p JOIN f ON p.far = f.word WHERE f.form IS NOT NULL)
SELECT f.word, n, n_near, form, form_n, p.far AS root FROM f JOIN path p ON f.word = p.word WHERE p.far NOT IN (SELECT word FROM f WHERE form IS NOT NULL)""".replace("CRC", CRC.format(x="z"))
