"""The registered queries of this subpackage and the DuckDB SQL that they are held against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm import decontam, hmm_lm, html_extract, langid, license_scan, linededup, ngram_join, resample, spelling, sptok, substring_dedup, topk, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learnt from the documents that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.identify(docs, model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


#: The vocabulary file of the box; any other SentencePiece model works as well.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and what they decode to, as digests."""
    return sptok.encode(_table(spark, sf_dir, "documents"), PIECE_MODEL, digests=True)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat in at least three documents stay in the largest doc_id only."""
    kept = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence that a document states."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back by its index row."""
    folder, index = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_records(folder, index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0, k=5)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of documents whose four-word shingles link at a Jaccard similarity of 0.85."""
    return ngram_join.link_components(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage like a benchmark item, with the item."""
    return decontam.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole text under the unigram base and under the hidden Markov model."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(~hmm_lm.held_out(F.col("doc_id")))
    counts = hmm_lm.count_words(train)
    scored = hmm_lm.score(docs, counts, hmm_lm.fit(train, counts))
    return scored.select("doc_id", hmm_lm.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated word with its near words counted, the frequent form that it stands for, and where the forms lead."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that a document with a smaller id holds too are removed."""
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn by how much their words and word pairs are those of the benchmark."""
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_warc": op5_warc,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_decontamination": op8_decontamination,
    "op9_hmm_scoring": op9_hmm_scoring,
    "op10_html_extraction": op10_html_extraction,
    "op6_exact_topk": op6_exact_topk,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_importance_resampling": op13_importance_resampling,
}


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8, bit by bit: bytes enter the sum, each followed by eight shifts."""
    steps = f"flatten(list_transform(range(octet_length(encode({text}))), lambda j: [('0x' || hex(array_slice(encode({text}), j + 1, j + 1)))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {step}), 4294967295)"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Words and shingles as strings: the exact search that the fingerprints only speed up.
_SHINGLES = r"""
dw AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark WHERE text IS NOT NULL),
dg AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END AS g FROM dw WHERE w[1] <> ''),
ig AS (SELECT item_id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END AS g FROM iw WHERE w[1] <> '')"""

ORACLES = {
    # near words by what is left when one letter goes: the same rest at the same place is a replacement, a word that is
    # another one's rest an insertion
    "op11_spelling_variants": rf"""
WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
u AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM t WHERE length(run) >= 7 GROUP BY ALL),
h AS MATERIALIZED (SELECT run, n, {_crc32("concat(doc_id, ':', run)")} AS h FROM u),
c AS (SELECT CASE WHEN h % 31 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
d AS MATERIALIZED (SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM w, unnest(range(length(word))) AS r(i)),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, a.n, b.word, b.n FROM d a JOIN w b ON a.rest = b.word UNION SELECT b.word, b.n, a.word, a.n FROM d a JOIN w b ON a.rest = b.word),
f AS MATERIALIZED (SELECT word, any_value(n) AS n, count(*) AS n_near, max(other_n) FILTER (WHERE other_n >= 10 * n) AS form_n FROM p GROUP BY 1),
g AS MATERIALIZED (SELECT f.word, f.n_near, f.form_n, min(p.other) AS form FROM f LEFT JOIN p ON p.word = f.word AND p.other_n = f.form_n GROUP BY ALL),
r(word, here, steps) AS (SELECT word, form, 1 FROM g WHERE form IS NOT NULL UNION ALL SELECT r.word, g.form, steps + 1 FROM r JOIN g ON g.word = r.here WHERE g.form IS NOT NULL),
e AS (SELECT DISTINCT ON (word) word, here FROM r ORDER BY word, steps DESC)
SELECT w.word, g.form, coalesce(e.here, w.word) AS root, w.n, coalesce(g.n_near, 0) AS n_near, g.form_n FROM w LEFT JOIN g ON g.word = w.word LEFT JOIN e ON e.word = w.word
""",
    "op12_substring_dedup": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
p AS MATERIALIZED (SELECT row, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS r(i)),
f AS MATERIALIZED (SELECT g, min(doc_id) AS least FROM p GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
m AS MATERIALIZED (SELECT DISTINCT row, i + o AS pos FROM p JOIN f USING (g), unnest(range(13)) AS k(o) WHERE least < doc_id),
x AS MATERIALIZED (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
k AS (SELECT row, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept FROM x ANTI JOIN m USING (row, pos) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (row)
""",
    "op13_importance_resampling": rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS MATERIALIZED (SELECT row, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM d),
bf AS MATERIALIZED (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM b),
v AS MATERIALIZED (SELECT f, {_crc32("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM df UNION SELECT f FROM bf)),
s AS (SELECT bucket, count(*) AS n FROM df JOIN v USING (f) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM bf JOIN v USING (f) GROUP BY 1),
z AS (SELECT (SELECT count(*) FROM df) + 10000 AS s, (SELECT count(*) FROM bf) + 10000 AS t),
g AS MATERIALIZED (SELECT r.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * z.s) / ((coalesce(s.n, 0) + 1)::DOUBLE * z.t)))::BIGINT AS gain
  FROM range(10000) AS r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), z),
a AS (SELECT row, sum(gain)::BIGINT AS total, count(*) AS n FROM df JOIN v USING (f) JOIN g USING (bucket) GROUP BY 1),
x AS MATERIALIZED (SELECT row, doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(floor(total / n), 0)::BIGINT AS weight,
  floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS noise FROM d LEFT JOIN a USING (row)),
y AS (SELECT row, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER () AS eligible FROM x WHERE words >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= floor(25 * eligible / 100) THEN place END AS rank FROM x LEFT JOIN y USING (row)
""",
    "op7_ngram_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
m AS (SELECT doc_id, min(other) AS least FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(m.least, w.doc_id), w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
""",
    # for pages that mark one article of headings and paragraphs, as those of the tables do
    "op10_html_extraction": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, unnest(string_split(regexp_replace(body, '</?(p|h1)>', chr(1), 'g'), chr(1))) AS part, generate_subscripts(string_split(regexp_replace(body, '</?(p|h1)>', chr(1), 'g'), chr(1)), 1) AS pos FROM a),
t AS (SELECT page_id, url, pos, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(part, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS line FROM b),
g AS (SELECT page_id, url, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE line <> ''), '') AS text FROM t GROUP BY ALL)
SELECT page_id, url, text, length(text) AS n_chars FROM g
""",
    # the licence lines of the synthetic documents, found by their words alone and without the operator's tables
    "op4_license_scan": r"""
WITH k(licence, rule, line) AS (VALUES ('MIT', 'mit_release', 'released under the mit license'), ('Apache-2.0', 'apache_short', 'licensed under the apache license version 2 0'),
  ('GPL-3.0', 'gpl3_work', 'this work is licensed under the gnu general public license version 3'), ('CC-BY-NC-4.0', 'ccbync_short', 'licensed under cc by nc 4 0')),
c AS (SELECT row_number() OVER () AS row, doc_id, string_split_regex(text, '[.!?:;]\s+|\n') AS parts FROM documents),
s AS (SELECT row, doc_id, trim(regexp_replace(lower(unnest(parts)), '[^\p{L}\p{N}]+', ' ', 'g')) AS line FROM c),
f AS (SELECT row, doc_id, licence, rule FROM s JOIN k USING (line)),
n AS (SELECT row, count(*) AS n_sentences FROM f GROUP BY 1)
SELECT DISTINCT ON (row, licence) doc_id, licence, rule, n_sentences FROM f JOIN n USING (row)
""",
    # every window of every text, however it lies, against every item with which the text shares a shingle at all
    "op8_decontamination": f"""
WITH {_SHINGLES},
t AS (SELECT DISTINCT doc_id, g FROM dg), i AS (SELECT DISTINCT item_id, g FROM ig),
p AS MATERIALIZED (SELECT row_number() OVER () AS pair, t.doc_id, i.item_id, t.g AS dg, i.g AS ig, len(i.g) AS n FROM t JOIN i ON list_has_any(t.g, i.g)),
c AS (SELECT pair, h, count(*) AS held FROM (SELECT pair, unnest(ig) AS h FROM p) GROUP BY ALL),
pl AS (SELECT pair, n, len(dg) AS size, unnest(dg) AS h, generate_subscripts(dg, 1) - 1 AS pos FROM p),
win AS (SELECT pl.pair, h, s, count(*) AS seen, any_value(size) AS size, any_value(n) AS n FROM pl SEMI JOIN c USING (pair, h), unnest(range(greatest(0, pos - n + 1), least(pos, greatest(0, size - n)) + 1)) AS u(s) GROUP BY ALL),
x AS (SELECT pair, s, sum(least(seen, held))::BIGINT AS shared, any_value(least(size, n) + n) AS sizes FROM win JOIN c USING (pair, h) GROUP BY ALL)
SELECT doc_id, item_id, max(shared / (sizes - shared)) AS similarity FROM x JOIN p USING (pair) WHERE 100 * shared >= 80 * (sizes - shared) GROUP BY ALL
""",
    "op3_line_dedup": r"""
WITH l AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
r AS (SELECT key, max(doc_id) AS keep FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, r.keep IS NOT NULL AND l.doc_id <> r.keep AS gone FROM l LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op5_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f
""",
    "op6_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
}
