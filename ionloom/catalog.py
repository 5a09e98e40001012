"""The registry of queries and of the SQL that each is held against.

The driver's tables stand in for proteomics data: a part is a protein (its size the length, its brand the organism), a
ship date a scan, a return flag a sample, an extended price an intensity, a quantity a score, ``R`` a decoy; texts of
letters are peptides or, translated to ACGT, nucleotides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ionloom.functions import ids, numeric, sequences
from ionloom.operators import annotation, matching, ordered, quant, relational, stats
from ionloom.plans import metaproteomics
from ionloom.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its DuckDB SQL if SQL can express it."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """(acc, sample, scan) of every identified spectrum."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("acc"), F.col("l_returnflag").alias("sample"), F.col("l_shipdate").alias("scan"))


def proteins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("acc"), F.col("p_size").alias("length"), F.col("p_brand").alias("organism"))


# ---- abundance and the parsimonious ranking ----

_COUNTS = "c AS (SELECT l_partkey AS acc, l_returnflag AS sample, count(DISTINCT l_shipdate) AS msms FROM lineitem GROUP BY ALL)"
_SAF = _COUNTS + ", s AS (SELECT c.*, p_size AS length, msms / p_size AS saf FROM c JOIN part ON acc = p_partkey)"
_NSAF = _SAF + ", n AS (SELECT acc, round(sum(saf / total), 12) AS summed_nsaf FROM s JOIN (SELECT sample, sum(saf) AS total FROM s GROUP BY 1) USING (sample) GROUP BY 1)"
_FIRST = _NSAF + """, r AS (SELECT *, row_number() OVER (ORDER BY summed_nsaf DESC, acc) AS rank FROM n),
e AS (SELECT DISTINCT l_partkey AS acc, l_shipdate AS scan FROM lineitem),
f AS (SELECT rank, count(*) AS new_scans FROM (SELECT scan, min(rank) AS rank FROM e JOIN r USING (acc) GROUP BY 1) GROUP BY 1),
k AS (SELECT acc, rank, new_scans FROM r JOIN f USING (rank))"""
_PROB = _FIRST + """, o AS (SELECT acc, p_brand AS organism, summed_nsaf FROM n JOIN part ON acc = p_partkey),
kept AS (SELECT o.* FROM o SEMI JOIN k USING (acc)),
b AS (SELECT organism, sum(summed_nsaf) AS organism_nsaf FROM kept GROUP BY 1),
pr AS (SELECT acc, organism, summed_nsaf, round(summed_nsaf / (SELECT sum(summed_nsaf) FROM o), 12) AS protein_prob,
  round(coalesce(organism_nsaf, 0) / (SELECT sum(summed_nsaf) FROM kept), 12) AS organism_prob FROM o LEFT JOIN b USING (organism)),
q AS (SELECT *, round(protein_prob * organism_prob, 12) AS combined_prob FROM pr)"""


@query("WITH " + _COUNTS + " SELECT * FROM c")
def spectral_counts(spark, d):
    return quant.spectral_counts(evidence(spark, d))


@query("WITH " + _SAF + " SELECT acc, sample, msms, length, round(saf, 9) AS saf FROM s")
def saf(spark, d):
    return quant.saf(quant.spectral_counts(evidence(spark, d)), proteins(spark, d)).withColumn("saf", F.round("saf", 9))


@query("WITH " + _NSAF + " SELECT acc, round(summed_nsaf, 9) AS summed_nsaf FROM n")
def nsaf(spark, d):
    return quant.nsaf(quant.saf(quant.spectral_counts(evidence(spark, d)), proteins(spark, d))).withColumn("summed_nsaf", F.round("summed_nsaf", 9))


def _ranked(spark, d) -> DataFrame:
    scored = quant.nsaf(quant.saf(quant.spectral_counts(evidence(spark, d)), proteins(spark, d)))
    return quant.with_rank(scored, "summed_nsaf").select("acc", "rank")


@query("WITH " + _FIRST + " SELECT acc, rank, new_scans FROM k")
def parsimony(spark, d):
    return quant.greedy_cover(_ranked(spark, d), evidence(spark, d))


@query("WITH " + _PROB + " SELECT acc, organism, round(summed_nsaf, 9) AS summed_nsaf, round(protein_prob, 9) AS protein_prob, round(organism_prob, 9) AS organism_prob, round(combined_prob, 9) AS combined_prob FROM q")
def organism_prob(spark, d):
    scored = quant.nsaf(quant.saf(quant.spectral_counts(evidence(spark, d)), proteins(spark, d)))
    kept = quant.greedy_cover(quant.with_rank(scored, "summed_nsaf").select("acc", "rank"), evidence(spark, d))
    out = quant.organism_prob(scored, kept, proteins(spark, d))
    return out.select("acc", "organism", *(F.round(c, 9).alias(c) for c in ("summed_nsaf", "protein_prob", "organism_prob", "combined_prob")))


@query("WITH " + _FIRST + ", t AS (SELECT acc, rank, sum(new_scans) OVER (ORDER BY rank)::BIGINT AS scans FROM k) SELECT acc, rank, scans, round(100 * scans / (SELECT sum(new_scans) FROM k), 6) AS percent FROM t")
def cumulative_coverage(spark, d):
    return quant.cumulative_coverage(quant.greedy_cover(_ranked(spark, d), evidence(spark, d)))


@query("WITH " + _PROB + """, r2 AS (SELECT *, row_number() OVER (ORDER BY combined_prob DESC, acc) AS rank2 FROM q),
f2 AS (SELECT rank2, count(*) AS new_scans FROM (SELECT scan, min(rank2) AS rank2 FROM e JOIN r2 USING (acc) GROUP BY 1) GROUP BY 1)
SELECT acc, organism, rank2 AS rank, new_scans, round(combined_prob, 9) AS combined_prob FROM r2 JOIN f2 USING (rank2)""")
def flagship_ranked(spark, d):
    out = quant.ranked_proteins(evidence(spark, d), proteins(spark, d))
    return out.select("acc", "organism", "rank", "new_scans", F.round("combined_prob", 9).alias("combined_prob"))


@query("""WITH p AS (SELECT l_suppkey AS acc, l_partkey AS peptide, count(*) AS scans FROM lineitem GROUP BY ALL),
o AS (SELECT peptide, count(DISTINCT acc) AS owners FROM p GROUP BY 1)
SELECT acc, sum(scans)::BIGINT AS all_scans, coalesce(sum(scans) FILTER (WHERE owners = 1), 0)::BIGINT AS unique_scans FROM p JOIN o USING (peptide) GROUP BY 1""")
def shared_and_unique_counts(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("acc"), F.col("l_partkey").alias("peptide")).agg(F.count("*").alias("scans"))
    return quant.shared_and_unique(rows)


@query("""WITH r AS (SELECT p_brand AS acc, l_partkey AS peptide, l_linestatus AS sample, l_linestatus AS level, sum(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
s AS (SELECT DISTINCT level FROM r),
g AS (SELECT a.acc, a.peptide, s.level AS sample, s.level, r.value FROM (SELECT DISTINCT acc, peptide FROM r) a CROSS JOIN s LEFT JOIN r ON r.acc = a.acc AND r.peptide = a.peptide AND r.level = s.level),
k AS (SELECT acc, peptide FROM g GROUP BY ALL HAVING count(value) = count(*)),
m AS (SELECT acc, sample, level, median(value) AS value, count(DISTINCT peptide) AS n_peptides FROM g SEMI JOIN k USING (acc, peptide) GROUP BY ALL)
SELECT acc, level, round(avg(value), 4) AS value, max(n_peptides) AS n_peptides FROM m GROUP BY ALL""")
def peptide_median_quant(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    wide = rows.groupBy(F.col("p_brand").alias("acc"), F.col("l_partkey").alias("peptide")).pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_extendedprice"))
    long = wide.unpivot(["acc", "peptide"], ["F", "O"], "sample", "value").withColumn("level", F.col("sample"))
    return quant.median_of_peptides(long).withColumn("value", F.round("value", 4))


@query("""WITH c AS (SELECT l_partkey AS acc, l_returnflag AS sample, count(DISTINCT l_shipdate) AS msms FROM lineitem GROUP BY ALL)
SELECT acc, sample, msms, p_size::BIGINT AS n_observable, round(msms / p_size, 9) AS ratio FROM c JOIN part ON acc = p_partkey""")
def observable_peptide_ratio(spark, d):
    observable = proteins(spark, d).select("acc", F.col("length").cast("bigint").alias("n_observable"))
    return quant.observable_ratio(quant.spectral_counts(evidence(spark, d)), observable).withColumn("ratio", F.round("ratio", 9))


# ---- filters ----

@query("SELECT l_returnflag <> 'R' AS target, count(*) AS n, round(sum(l_extendedprice), 2) AS intensity FROM lineitem GROUP BY 1")
def target_decoy(spark, d):
    rows = table(spark, d, "lineitem").withColumn("reverse", F.when(F.col("l_returnflag") == "R", "+"))
    target, decoy = relational.split_targets(rows, "reverse")
    total = lambda df, t: df.agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("intensity")).select(F.lit(t).alias("target"), "n", "intensity")
    return total(target, True).union(total(decoy, False))


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE (c_acctbal > 0)::INT + (c_mktsegment = 'BUILDING')::INT + (c_custkey % 2 = 0)::INT > 1 GROUP BY 1")
def replicate_support(spark, d):
    rows = relational.replicate_support(table(spark, d, "customer"), [F.col("c_acctbal") > 0, F.col("c_mktsegment") == "BUILDING", F.col("c_custkey") % 2 == 0], 1)
    return rows.groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1)")
def seen_in_several_samples(spark, d):
    return relational.seen_in_several(table(spark, d, "lineitem"), "l_partkey", "l_returnflag").select("l_partkey", "l_orderkey", "l_linenumber")


@query("""WITH g AS (SELECT s_suppkey AS sample, s_nationkey % 2 AS level FROM supplier), z AS (SELECT level, count(*) AS size FROM g GROUP BY 1),
m AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS sample FROM lineitem WHERE l_quantity > 5),
s AS (SELECT id, level, count(*) AS seen FROM m JOIN g USING (sample) GROUP BY ALL)
SELECT id FROM s JOIN z USING (level) WHERE seen > 0.3 * size GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT level) FROM g)""")
def valid_values(spark, d):
    groups = table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample"), (F.col("s_nationkey") % 2).alias("level"))
    rows = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("sample")).agg(F.max(F.when(F.col("l_quantity") > 5, F.col("l_quantity"))).alias("value"))
    return relational.valid_values(rows, groups, 0.3)


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) BETWEEN 500 AND 1500")
def length_window(spark, d):
    return table(spark, d, "documents").select("doc_id", F.char_length("text").cast("bigint").alias("n")).where(F.col("n").between(500, 1500))


@query("SELECT n_name || ' renamed' AS sample, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 0 GROUP BY 1")
def rename_and_exclude(spark, d):
    design = table(spark, d, "nation").select(F.col("n_nationkey").alias("sample"), F.concat("n_name", F.lit(" renamed")).alias("rename"), F.when(F.col("n_regionkey") == 0, "+").otherwise("-").alias("exclude"))
    kept = design.where(~ids.flag("exclude"))
    return table(spark, d, "customer").join(kept, F.col("c_nationkey") == F.col("sample")).groupBy(F.col("rename").alias("sample")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_brand || ';...' || ' (Protein group ' || p_partkey || ')' AS label FROM part")
def group_labels(spark, d):
    return table(spark, d, "part").select("p_partkey", ids.group_label("p_partkey", F.concat_ws(";", "p_brand", "p_type")).alias("label"))


@query("SELECT p_type, count(*) AS n FROM part WHERE contains(p_type, 'ECON') OR contains(p_type, 'MALL') GROUP BY 1")
def annotation_type_counts(spark, d):
    kind = F.col("p_type")
    return table(spark, d, "part").where(kind.contains("ECON") | kind.contains("MALL")).groupBy("p_type").agg(F.count("*").alias("n"))


# ---- joins ----

@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def left_lookup(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "n_name", "r_name")


@query("SELECT l.doc_id, l.quality, d.source FROM documents d RIGHT JOIN labels l ON d.doc_id = l.doc_id")
def right_lookup(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "right").select("doc_id", "quality", "source")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def semi(spark, d):
    orders = table(spark, d, "orders").where(F.col("o_totalprice") > 100000)
    return table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def anti(spark, d):
    orders = table(spark, d, "orders").where(F.col("o_totalprice") > 400000)
    return table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""WITH m AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents),
k AS (SELECT 'the' AS word, 'ART' AS v UNION ALL SELECT 'of', 'PRE' UNION ALL SELECT 'and', 'CON' UNION ALL SELECT 'de', 'PRE'),
f AS (SELECT doc_id, v, min(pos) AS pos FROM m JOIN k USING (word) GROUP BY ALL)
SELECT doc_id, string_agg(v, ';' ORDER BY pos) AS "values" FROM f GROUP BY 1""")
def explode_join(spark, d):
    lookup = spark.createDataFrame([("the", "ART"), ("of", "PRE"), ("and", "CON"), ("de", "PRE")], "word string, v string")
    groups = table(spark, d, "documents").select("doc_id", F.col("text").alias("members"))
    return relational.explode_join(groups, "doc_id", "members", lookup, "word", "v", sep=" ").withColumn("values", F.replace("values", F.lit(" "), F.lit(";")))


@query("""WITH l AS (SELECT s_suppkey, s_name AS full_id, split_part(s_name, '#', 2) AS part_id FROM supplier), k AS (SELECT 'Supplier#' || lpad(r_regionkey::VARCHAR, 9, '0') AS id FROM region UNION ALL SELECT lpad((r_regionkey + 3)::VARCHAR, 9, '0') FROM region)
SELECT DISTINCT s_suppkey, full_id, id FROM l JOIN k ON l.full_id = k.id OR l.part_id = k.id""")
def either_form_join(spark, d):
    left = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("full_id"), F.get(F.split("s_name", "#"), F.lit(1)).alias("part_id"))
    region = table(spark, d, "region")
    number = lambda c: F.lpad(c.cast("string"), 9, "0")
    keys = region.select(F.concat(F.lit("Supplier#"), number(F.col("r_regionkey"))).alias("id")).union(region.select(number(F.col("r_regionkey") + 3)))
    return relational.either_form_join(left, keys, "full_id", "part_id", "id").select("s_suppkey", "full_id", "id")


@query("SELECT DISTINCT l_suppkey AS grp, p_brand AS term FROM lineitem JOIN part ON l_partkey = p_partkey")
def two_hop_terms(spark, d):
    entries = table(spark, d, "part").select(F.col("p_partkey").alias("entry"), F.col("p_brand").alias("term"))
    return table(spark, d, "lineitem").join(entries, F.col("l_partkey") == F.col("entry")).select(F.col("l_suppkey").alias("grp"), "term").distinct()


@query("""WITH p AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem)
SELECT p.a, p.b FROM p JOIN p r ON p.a = r.b AND p.b = r.a WHERE p.a < p.b""")
def reciprocal(spark, d):
    pairs = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("x"), F.col("l_partkey").alias("y"))
    return relational.reciprocal(pairs, "x", "y")


@query("""WITH f AS (SELECT 0 AS source, c_custkey AS k, c_name AS name FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 1, s_suppkey, s_name FROM supplier UNION ALL SELECT 2, p_partkey, p_name FROM part)
SELECT o.k, source, name FROM (SELECT DISTINCT o_custkey AS k FROM orders) o LEFT JOIN (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY k ORDER BY source) = 1) USING (k)""")
def prioritised_fallback(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_custkey").alias("k")).distinct()
    pick = lambda t, k, n: table(spark, d, t).select(F.col(k).alias("k"), F.col(n).alias("name"))
    rich = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    sources = [rich, pick("supplier", "s_suppkey", "s_name"), pick("part", "p_partkey", "p_name")]
    return relational.with_fallback(keys, sources, "k").select("k", "source", "name")


@query("""WITH h AS (SELECT DISTINCT l_suppkey AS id, l_orderkey AS ref FROM lineitem),
a AS (SELECT s_suppkey AS a, s_suppkey + 1 AS b FROM supplier)
SELECT x.id AS a, y.id AS b, x.ref FROM h x JOIN h y ON x.ref = y.ref AND x.id < y.id WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.a = x.id AND a.b = y.id)""")
def shared_reference_pairs(spark, d):
    hits = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_orderkey").alias("ref"))
    aligned = table(spark, d, "supplier").select((F.col("s_suppkey") + 1).alias("a"), F.col("s_suppkey").alias("b"))
    return relational.shared_reference_pairs(hits, aligned)


_INTERVALS = """a AS (SELECT event_id AS a_id, floor(epoch(ts))::BIGINT AS a_start, floor(epoch(ts))::BIGINT + round_even(value * 10, 0)::BIGINT AS a_end FROM events WHERE event_type = 'click' AND value > 0),
b AS (SELECT event_id AS b_id, floor(epoch(ts))::BIGINT AS b_start, floor(epoch(ts))::BIGINT + 600 AS b_end FROM events WHERE event_type <> 'click')"""


@query("WITH " + _INTERVALS + " SELECT a_id, b_id FROM a JOIN b ON a_start <= b_end AND b_start <= a_end")
def overlap(spark, d):
    events = table(spark, d, "events").withColumn("at", F.unix_seconds(F.col("ts").cast("timestamp")))
    a = events.where("event_type = 'click' AND value > 0").select(F.col("event_id").alias("a_id"), F.col("at").alias("a_start"), (F.col("at") + F.bround(F.col("value") * 10).cast("bigint")).alias("a_end"))
    b = events.where("event_type <> 'click'").select(F.col("event_id").alias("b_id"), F.col("at").alias("b_start"), (F.col("at") + 600).alias("b_end"))
    return relational.overlaps(a, b, 1200, parts=b.count() // 32_768).select("a_id", "b_id")


# ---- aggregates ----

@query("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def value_counts(spark, d):
    return relational.value_counts(table(spark, d, "documents"), "lang")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1")
def distinct_per_key(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n_suppliers"))


@query("""SELECT p_type, string_agg(DISTINCT p_brand, ';' ORDER BY p_brand) AS "values" FROM part WHERE p_type IS NOT NULL GROUP BY 1""")
def joined_sets(spark, d):
    return relational.joined_set(table(spark, d, "part"), "p_type", "p_brand")


@query("""WITH b AS (SELECT l_quantity, l_extendedprice, r_name, n_name, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
u AS (SELECT 'r_name' AS rank, r_name AS taxon, * FROM b UNION ALL SELECT 'n_name', n_name, * FROM b UNION ALL SELECT 's_name', s_name, * FROM b)
SELECT rank, taxon, count(*) AS peptide_count, sum(l_quantity) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice FROM u WHERE taxon IS NOT NULL GROUP BY ALL HAVING count(*) >= 1""")
def rank_rollup(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return relational.rank_rollup(rows, ["r_name", "n_name", "s_name"], ["l_quantity", "l_extendedprice"]).withColumn("l_extendedprice", F.round("l_extendedprice", 2))


@query("""WITH t AS (SELECT DISTINCT p_partkey, p_retailprice, unnest(string_split(p_name, ' ')) AS term FROM part)
SELECT term, round(sum(p_retailprice), 2) AS p_retailprice, count(*) AS n FROM t WHERE term <> '' GROUP BY 1""")
def term_sums(spark, d):
    return relational.term_sums(table(spark, d, "part"), F.split("p_name", " "), ["p_retailprice"]).withColumn("p_retailprice", F.round("p_retailprice", 2))


@query("""SELECT l_partkey AS sequence, count(*) FILTER (WHERE l_returnflag = 'A') AS "A", count(*) FILTER (WHERE l_returnflag = 'N') AS "N", count(*) FILTER (WHERE l_returnflag = 'R') AS "R" FROM lineitem GROUP BY 1""")
def spectral_count_matrix(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("sequence")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1))).na.fill(0)


@query("""WITH h AS (SELECT l_orderkey AS query, l_partkey AS acc, p_brand AS organism, l_quantity AS score FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT query, acc, organism, score, round(count(*) OVER (PARTITION BY organism) * count(*) OVER (PARTITION BY acc) * score / sum(score) OVER (PARTITION BY query), 8) AS weight, count(*) OVER () AS n FROM h)
SELECT query, acc, organism, weight / (n * n) AS prob FROM j QUALIFY row_number() OVER (PARTITION BY query ORDER BY weight DESC, acc, score DESC) = 1""")
def taxon_scores(spark, d):
    hits = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    hits = hits.select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("acc"), F.col("p_brand").alias("organism"), F.col("l_quantity").alias("score"))
    return relational.taxon_scores(hits)


@query("SELECT p_brand, round(sum(l_extendedprice), 2) AS intensity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY intensity DESC, p_brand LIMIT 5")
def top_sources(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.round(F.sum("l_extendedprice"), 2).alias("intensity"))
    return rows.orderBy(F.desc("intensity"), "p_brand").limit(5)


@query("SELECT l_shipdate::DATE::VARCHAR AS day, round(median(l_extendedprice), 4) AS median, round(stddev_pop(l_extendedprice), 4) AS deviation FROM lineitem GROUP BY 1")
def class_distributions(spark, d):
    rows = table(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_extendedprice")
    spread = rows.groupBy("day").agg(F.round(F.stddev_pop("l_extendedprice"), 4).alias("deviation"))
    return ordered.medians(rows, "l_extendedprice", ("day",)).join(spread, "day").select("day", F.round("median", 4).alias("median"), "deviation")


@query("SELECT coalesce(l_returnflag, 'combined') AS strain, count(DISTINCT l_partkey) AS orfs, count(DISTINCT l_orderkey) AS peptides FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())")
def strain_statistics(spark, d):
    rows = table(spark, d, "lineitem")
    rows = rows.select(F.explode(F.array("l_returnflag", F.lit("combined"))).alias("strain"), "l_partkey", "l_orderkey")
    return rows.groupBy("strain").agg(F.count_distinct("l_partkey").alias("orfs"), F.count_distinct("l_orderkey").alias("peptides"))


@query("SELECT starts, count(*) AS n_orfs FROM (SELECT l_partkey, count(DISTINCT l_linenumber) AS starts FROM lineitem GROUP BY 1) GROUP BY 1")
def start_site_histogram(spark, d):
    starts = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_linenumber").alias("starts"))
    return starts.groupBy("starts").agg(F.count("*").alias("n_orfs"))


@query("SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS strains FROM lineitem GROUP BY 1")
def acetylated_strains(spark, d):
    rows = table(spark, d, "lineitem")
    return relational.joined_set(rows, "l_orderkey", "l_returnflag").withColumnRenamed("values", "strains")


@query("""WITH f AS (SELECT l_suppkey AS contig, l_partkey * 3 AS s, l_partkey * 3 + p_size AS e, l_quantity::BIGINT AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
x AS (SELECT contig, s AS position, v AS change, 1 AS o FROM f UNION ALL SELECT contig, e + 1, -v, -1 FROM f), g AS (SELECT contig, position, sum(change) AS change, sum(o) AS o FROM x GROUP BY ALL),
r AS (SELECT contig, position AS start, lead(position) OVER w - 1 AS "end", sum(change) OVER w AS value, sum(o) OVER w AS o FROM g WINDOW w AS (PARTITION BY contig ORDER BY position))
SELECT contig, start, "end", value::BIGINT AS value FROM r WHERE o > 0""")
def base_coverage(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("l_suppkey").alias("contig"), (F.col("l_partkey") * 3).alias("start"), (F.col("l_partkey") * 3 + F.col("p_size")).alias("end"), F.col("l_quantity").cast("bigint").alias("v"))
    return relational.base_coverage(rows, "v", ["contig"])


@query("SELECT l_partkey, l_returnflag AS grp, round(avg(l_extendedprice), 7) AS mean, round(var_samp(l_extendedprice), 2) AS variance FROM lineitem GROUP BY ALL")
def group_means(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey", F.col("l_returnflag").alias("grp")).agg(F.round(F.avg("l_extendedprice"), 7).alias("mean"), F.round(F.var_samp("l_extendedprice"), 2).alias("variance"))


@query("SELECT coalesce(n_name, 'unassigned') AS taxon, count(*) AS spectra FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3 GROUP BY 1")
def taxon_spectra(spark, d):
    known = table(spark, d, "nation").where("n_regionkey < 3")
    return table(spark, d, "customer").join(known, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.coalesce("n_name", F.lit("unassigned")).alias("taxon")).agg(F.count("*").alias("spectra"))


@query("""WITH c AS (SELECT l_suppkey AS grp, l_partkey % 20 AS entry, count(DISTINCT l_partkey) AS n_peptides FROM lineitem GROUP BY ALL),
m AS (SELECT * FROM c QUALIFY rank() OVER (PARTITION BY grp ORDER BY n_peptides DESC) = 1),
o AS (SELECT m.*, len(list_intersect([entry % 2, entry % 3 + 10, entry % 5 + 20], [0, 11, 22])) AS overlap FROM m)
SELECT grp, entry, n_peptides, overlap::INTEGER AS overlap FROM o QUALIFY rank() OVER (PARTITION BY grp ORDER BY overlap DESC) = 1""")
def best_mapped_entry(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("grp"), (F.col("l_partkey") % 20).alias("entry"), F.col("l_partkey").alias("peptide"))
    entry = F.col("id")
    lineages = spark.range(20).select(entry.alias("entry"), F.array(entry % 2, entry % 3 + 10, entry % 5 + 20).alias("lineage"))
    return relational.best_mapped(rows, lineages, F.array(*(F.lit(x).cast("bigint") for x in (0, 11, 22))))


# ---- windows, order and sets ----

@query("""WITH s AS (SELECT l_quantity::INTEGER AS score, l_returnflag = 'R' AS decoy FROM lineitem)
SELECT DISTINCT score, count(*) FILTER (WHERE decoy) OVER (ORDER BY score DESC) AS decoys, count(*) OVER (ORDER BY score DESC) AS total,
  round(100 * count(*) FILTER (WHERE decoy) OVER (ORDER BY score DESC) / count(*) OVER (ORDER BY score DESC), 6) AS fdr FROM s""")
def fdr(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_quantity").cast("int").alias("score"), (F.col("l_returnflag") == "R").alias("decoy"))
    return relational.target_decoy_fdr(rows, "score", F.col("decoy"))


@query("""WITH p AS (SELECT p_partkey, (p_retailprice - floor(p_retailprice / 100) * 100 + 1) / 1000 AS p FROM part),
r AS (SELECT *, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS i, count(*) OVER () AS n FROM p)
SELECT p_partkey, round(p, 9) AS p, round(least(1.0, min(p * n / i) OVER (ORDER BY p DESC)), 9) AS adjusted FROM r""")
def benjamini_hochberg(spark, d):
    price = F.col("p_retailprice")
    rows = table(spark, d, "part").select("p_partkey", ((price - F.floor(price / 100) * 100 + 1) / 1000).alias("p"))
    return relational.benjamini_hochberg(rows, "p", "p_partkey").select("p_partkey", F.round("p", 9).alias("p"), F.round("adjusted", 9).alias("adjusted"))


@query("""WITH h AS (SELECT l_suppkey AS q, l_partkey AS s, l_orderkey, l_linenumber, l_extendedprice AS score FROM lineitem),
b AS (SELECT q, s, row_number() OVER (PARTITION BY q ORDER BY best DESC, s) AS alignment_rank FROM (SELECT q, s, max(score) AS best FROM h GROUP BY q, s))
SELECT h.q, h.s, l_orderkey, l_linenumber, alignment_rank, row_number() OVER (PARTITION BY h.q, h.s ORDER BY score DESC, l_orderkey, l_linenumber) AS hsp_rank FROM h JOIN b ON h.q = b.q AND h.s = b.s""")
def alignment_ranks(spark, d):
    hits = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("q"), F.col("l_partkey").alias("s"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("score"))
    return relational.ranked_hits(hits, "q", "s", "score").select("q", "s", "l_orderkey", "l_linenumber", F.col("alignment_rank").cast("bigint").alias("alignment_rank"), F.col("hsp_rank").cast("bigint").alias("hsp_rank"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1")
def top1_per_query(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return relational.top_per_key(rows, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")])


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, CASE WHEN l_returnflag IS NOT DISTINCT FROM lag(l_returnflag) OVER w THEN 0 ELSE 1 END AS ch FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS runs FROM c) SELECT l_orderkey, l_linenumber, l_returnflag FROM r WHERE runs <= 2""")
def subject_cutoff(spark, d):
    order = [F.asc(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return relational.subject_cutoff(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", order, 2).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) AS id FROM part")
def dense_ids(spark, d):
    return relational.dense_ids(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "id")


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN value END AS v FROM events)
SELECT user_id, event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS v FROM e""")
def fill_forward(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("v"))
    return relational.fill_forward(rows, ["user_id"], ["event_id"], "v")


@query("SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_type, p_size) > 1 AS repeated FROM part")
def repeated_flag(spark, d):
    return relational.repeated_flag(table(spark, d, "part"), ["p_brand", "p_type", "p_size"]).select("p_partkey", "repeated")


@query("""WITH v AS (SELECT user_id AS contig, event_id AS pos, repeat('A', (event_id % 4)::INTEGER + 1) AS ref, repeat('C', (event_id % 3)::INTEGER + 1) AS alt FROM events)
SELECT contig, pos, sum(length(alt) - length(ref)) OVER (PARTITION BY contig ORDER BY pos)::BIGINT AS "offset" FROM v""")
def vcf_offset(spark, d):
    rep = lambda letter, n: F.repeat(F.lit(letter), ((F.col("event_id") % n) + 1).cast("int"))
    rows = table(spark, d, "events").select(F.col("user_id").alias("contig"), F.col("event_id").alias("pos"), rep("A", 4).alias("ref"), rep("C", 3).alias("alt"))
    return relational.running_offset(rows, ["contig"]).select("contig", "pos", "offset")


@query("SELECT l_partkey, min_by(l_orderkey, l_linenumber * 10000000 + l_orderkey) AS first_order FROM lineitem GROUP BY 1")
def lowest_version(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.min_by("l_orderkey", F.struct("l_linenumber", "l_orderkey")).alias("first_order"))


@query("SELECT p_name, p_partkey, row_number() OVER (ORDER BY lpad(regexp_extract(p_brand, '([0-9]+)', 1), 12, '0'), p_partkey) AS place FROM part")
def natural_order(spark, d):
    key = F.conv(F.regexp_extract(ids.natural_key("p_brand"), r"(\d+)", 1), 10, 10).cast("bigint")
    ranked = quant.row_numbers(table(spark, d, "part").withColumn("key", key), "key", ("p_partkey",), "place", descending=False)
    return ranked.select("p_name", "p_partkey", "place")


_MASK = "SELECT mask, count(*) AS n FROM (SELECT l_orderkey, (max((l_returnflag = 'A')::INT) + 2 * max((l_returnflag = 'N')::INT) + 4 * max((l_returnflag = 'R')::INT))::INT AS mask FROM lineitem GROUP BY 1) GROUP BY 1"


@query(_MASK)
def venn_bitmask(spark, d):
    return relational.membership_regions(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", ["A", "N", "R"])


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'A')")
def exclusive_set(spark, d):
    return relational.exclusive_to(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "A")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = (SELECT count(DISTINCT l_returnflag) FROM lineitem)")
def common_set(spark, d):
    return relational.common_to_all(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("SELECT 'customer' AS kind, c_name AS name, c_acctbal AS bal, NULL::INTEGER AS size FROM customer UNION ALL SELECT 'part', p_name, NULL, p_size FROM part")
def union_by_name(spark, d):
    a = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    b = table(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT l_orderkey, string_agg(DISTINCT t, ';' ORDER BY t) AS terms FROM (SELECT l_orderkey, unnest(string_split(p_name, ' ')) AS t FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1")
def group_terms_union(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("p_name", " "))))), ";").alias("terms"))


# ---- scalar functions ----

@query("SELECT s_suppkey, s_suppkey || ';REV__P' || s_nationkey || ';Z' AS ids, 'Unit ' || s_suppkey AS organism FROM supplier")
def parse_ids(spark, d):
    cell = F.concat(F.lit("sp|"), F.col("s_suppkey").cast("string"), F.lit("|A_X;REV__sp|P"), F.col("s_nationkey").cast("string"), F.lit("|B_Y;Z"))
    header = F.concat(F.lit("x some protein OS=Unit "), F.col("s_suppkey").cast("string"), F.lit(" OX=1 GN=a"))
    return table(spark, d, "supplier").select("s_suppkey", ids.parse_ids(cell).alias("ids"), ids.organism(header).alias("organism"))


@query(r"SELECT doc_id, translate(text, 'I', 'L') AS il, regexp_replace(text, '[^A-Z]', '', 'g') AS bare, regexp_replace(source, '[.\s/()\[\]\\]+', '_', 'g') AS field FROM documents")
def text_cleaning(spark, d):
    return table(spark, d, "documents").select("doc_id", ids.il_equivalent("text").alias("il"), ids.bare_peptide("text").alias("bare"), ids.clean_field("source").alias("field"))


@query("SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * 2 - 1.007276 * 2, 4) AS mw, round(log2(l_quantity), 9) AS l2, CASE WHEN l_discount > 0 THEN round(-log10(l_discount), 9) END AS nl FROM lineitem")
def mz_and_logs(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", numeric.neutral_mass("l_extendedprice", F.lit(2)).alias("mw"), F.round(numeric.log2_or_null("l_quantity"), 9).alias("l2"), F.round(numeric.neg_log10("l_discount"), 9).alias("nl"))


@query("SELECT event_id, event_id + user_id + event_id % 7 AS aligned_end FROM events")
def cigar_end(spark, d):
    cigar = F.concat(F.lit("5S"), F.col("user_id").cast("string"), F.lit("M2I"), (F.col("event_id") % 7).cast("string"), F.lit("D"))
    return table(spark, d, "events").select("event_id", numeric.cigar_end("event_id", cigar).alias("aligned_end"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_attribute(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# ---- sequences ----

_LETTERS = "upper(regexp_replace(text, '[^A-Za-z]', '', 'g'))"


def peptides_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))


def benchmark_letters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))


def nucleotides(spark: SparkSession, d: str) -> DataFrame:
    letters = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC")
    return table(spark, d, "documents").select(F.col("doc_id").alias("contig"), letters.alias("seq"))


def bases(spark: SparkSession, d: str) -> DataFrame:
    """The rows of ``nucleotides``, whose letters are looked up in Arrow batches, as the frames are."""
    letters = bytes.maketrans(bytes(range(65, 91)) + bytes(range(97, 123)), 2 * b"ACGTACGTACGTACGTACGTACGTAC")
    other = bytes(k for k in range(256) if not chr(k).isascii() or not chr(k).isalpha())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = [t and t.encode().translate(letters, other).decode() for t in (x.as_py() for x in batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("contig"), pa.array(seqs, pa.string())], ["contig", "seq"])

    rows = table(spark, d, "documents").select(F.col("doc_id").alias("contig"), "text")
    return rows.mapInArrow(run, StructType([rows.schema["contig"], StructField("seq", StringType())]))


_ACGT = "SELECT doc_id AS contig, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents"


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace({_LETTERS}, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'), '|')) AS peptide FROM documents)
SELECT doc_id, count(*) AS n, count(DISTINCT peptide) AS kinds, max(length(peptide))::INTEGER AS longest FROM p WHERE length(peptide) BETWEEN 7 AND 30 GROUP BY 1""")
def digest(spark, d):
    rows = peptides_of(spark, d).select("doc_id", F.explode_outer(sequences.tryptic_peptides("seq")).alias("peptide")).where("peptide IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("peptide").alias("kinds"), F.max(F.length("peptide")).alias("longest"))


@query(f"""WITH p AS (SELECT doc_id, {_LETTERS} AS s FROM documents)
SELECT doc_id, (length(s) - length(regexp_replace(regexp_replace(s, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'))) * -1 AS trypsin, length(regexp_replace(s, '[^RK]', '', 'g')) AS any_site FROM p""")
def missed_cleavages(spark, d):
    rows = peptides_of(spark, d).select("doc_id", F.col("seq").alias("s"))
    return rows.select("doc_id", sequences.missed_cleavages("s").cast("bigint").alias("trypsin"), sequences.missed_cleavages("s", False).cast("bigint").alias("any_site"))


_MASSES = ", ".join(f"('{a}', {m})" for a, m in sequences.RESIDUE_MASS.items())


@query(f"""WITH m(r, w) AS (VALUES {_MASSES}), p AS (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace({_LETTERS}, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'), '|')) AS s FROM documents),
k AS (SELECT DISTINCT s FROM p WHERE length(s) BETWEEN 7 AND 30 AND NOT regexp_matches(s, '[XZB]')), x AS (SELECT s, unnest(string_split(s, '')) AS r FROM k)
SELECT s AS peptide, round(sum(w + CASE WHEN r = 'C' THEN 57.021464 ELSE 0 END)::DOUBLE + 18.010565, 6) AS mass FROM x JOIN m USING (r) GROUP BY 1""")
def peptide_mass(spark, d):
    rows = peptides_of(spark, d).select(F.explode_outer(sequences.tryptic_peptides("seq")).alias("peptide")).where("peptide IS NOT NULL").distinct()
    return rows.withColumn("mass", F.round(sequences.peptide_mass("peptide"), 6)).where(F.col("mass") < 1e9)


@query(f"""WITH p AS (SELECT doc_id, {_LETTERS} AS s FROM documents), q AS (SELECT doc_id, s, unnest(range(1, length(s) - 2)) AS i FROM p WHERE length(s) >= 4)
SELECT doc_id, count(*) AS n, min(i)::INTEGER AS first FROM q WHERE substr(s, i, 4) = 'ERER' GROUP BY 1""")
def occurrences(spark, d):
    rows = peptides_of(spark, d).select("doc_id", sequences.occurrences("seq", F.lit("ERER")).alias("at")).where(F.size("at") > 0)
    return rows.select("doc_id", F.size("at").cast("bigint").alias("n"), F.get("at", F.lit(0)).alias("first"))


@query(f"""WITH p AS (SELECT DISTINCT {_LETTERS} AS pattern FROM benchmark), t AS (SELECT doc_id, {_LETTERS} AS s FROM documents)
SELECT doc_id AS text_id, pattern FROM t JOIN p ON contains(s, pattern) WHERE pattern <> ''""")
def containment(spark, d):
    texts = peptides_of(spark, d).select(F.col("doc_id").alias("text_id"), F.col("seq").alias("text"))
    return matching.contained_pairs(texts, benchmark_letters(spark, d).select(F.col("seq").alias("pattern")))


@query(f"""WITH k(pattern) AS (VALUES ('ERE'), ('TIO'), ('THE'), ('AND')), t AS (SELECT doc_id, {_LETTERS} AS s FROM documents),
i AS (SELECT doc_id, s, unnest(range(1, length(s) - 1)) AS start FROM t WHERE length(s) >= 3),
h AS (SELECT doc_id, start FROM i JOIN k ON substr(s, start, 3) = pattern),
c AS (SELECT DISTINCT doc_id, unnest(range(start, start + 3)) AS at FROM h) SELECT doc_id AS text_id, count(*) AS covered FROM c GROUP BY 1""")
def match_coverage(spark, d):
    texts = peptides_of(spark, d).select(F.col("doc_id").alias("text_id"), F.col("seq").alias("text"))
    patterns = spark.createDataFrame([("ERE",), ("TIO",), ("THE",), ("AND",)], "pattern string")
    return matching.covered(matching.match_all(texts, patterns))


@query(f"WITH g AS ({_ACGT}) SELECT contig, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, substr(seq, 2, ((length(seq) - 1) // 3 * 3)::INTEGER) AS frame1 FROM g WHERE length(seq) > 0")
def revcomp(spark, d):
    return nucleotides(spark, d).where("length(seq) > 0").select("contig", sequences.reverse_complement("seq").alias("rc"), sequences.frame("seq", 1).alias("frame1"))


_CODE = ", ".join(f"('{c}', '{a}')" for c, a in sequences.CODONS.items())


@query(f"""WITH k(codon, aa) AS (VALUES {_CODE}), g AS ({_ACGT}), x AS (SELECT contig, seq, unnest(range(0, length(seq) // 3)) AS i FROM g)
SELECT contig, string_agg(aa, '' ORDER BY i) AS protein FROM x JOIN k ON substr(seq, (3 * i + 1)::INTEGER, 3) = codon GROUP BY 1""")
def translation(spark, d):
    return nucleotides(spark, d).where("length(seq) >= 3").select("contig", sequences.translate("seq").alias("protein"))


_ORFS = f"""g AS ({_ACGT}), s AS (SELECT contig, '+' AS strand, seq AS s, length(seq) AS n FROM g UNION ALL SELECT contig, '-', reverse(translate(seq, 'ACGT', 'TGCA')), length(seq) FROM g),
i AS (SELECT contig, strand, s, n, unnest(range(1, n - 1)) AS stop FROM s WHERE n >= 3),
m AS (SELECT DISTINCT contig, strand, s, n, stop, (stop - 1) % 3 AS frame FROM i WHERE substr(s, stop, 3) IN ('TAA', 'TAG', 'TGA')
  OR stop = (stop - 1) % 3 + 3 * ((n - (stop - 1) % 3) // 3) - 2),
o AS (SELECT *, coalesce(lag(stop) OVER (PARTITION BY contig, strand, frame ORDER BY stop) + 3, frame + 1) AS f, stop + 2 AS t FROM m),
orfs AS (SELECT contig, strand, (CASE strand WHEN '+' THEN f ELSE n - t + 1 END)::INTEGER AS start, (CASE strand WHEN '+' THEN t ELSE n - f + 1 END)::INTEGER AS "end", substr(s, f, t - f + 1) AS seq FROM o WHERE t - f + 1 >= 60)"""


@query("WITH " + _ORFS + " SELECT * FROM orfs")
def six_frame(spark, d):
    return matching.open_frames(bases(spark, d), 20, 250)


@query(f"""WITH {_ORFS}, k AS (SELECT contig || strand || start || ':' || "end" AS orf, seq FROM orfs), x AS (SELECT orf, seq, unnest(range(0, length(seq) // 3)) AS i FROM k)
SELECT orf, (row_number() OVER (PARTITION BY orf ORDER BY i) - 1)::INTEGER AS k, (3 * i + 1)::INTEGER AS start, substr(seq, (3 * i + 1)::INTEGER) AS seq FROM x WHERE substr(seq, (3 * i + 1)::INTEGER, 3) IN ('TTG', 'CTG', 'ATT', 'ATC', 'ATA', 'ATG', 'GTG')""")
def alt_tss(spark, d):
    orf = F.concat(F.col("contig").cast("string"), "strand", F.col("start").cast("string"), F.lit(":"), F.col("end").cast("string"))
    return matching.alternative_starts(matching.open_frames(bases(spark, d), 20).select(orf.alias("orf"), "seq"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN l_partkey * 100 + 3 * l_linenumber ELSE l_partkey * 100 + 899 - 3 * (l_linenumber + l_suppkey % 9 + 1) + 1 END AS start,
CASE WHEN l_linestatus = 'F' THEN l_partkey * 100 + 3 * (l_linenumber + l_suppkey % 9 + 1) - 1 ELSE l_partkey * 100 + 899 - 3 * l_linenumber END AS "end" FROM lineitem""")
def project_coords(spark, d):
    strand = F.when(F.col("l_linestatus") == "F", "+").otherwise("-")
    at = sequences.to_genome(strand, F.col("l_partkey") * 100, F.col("l_partkey") * 100 + 899, "l_linenumber", F.col("l_suppkey") % 9 + 1)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", at.alias("x")).select("l_orderkey", "l_linenumber", "x.start", "x.end")


@query(f"""WITH s AS (SELECT doc_id AS id, {_LETTERS} AS seq FROM documents), g AS (SELECT seq, min(id) AS first, string_agg(id::VARCHAR, ';' ORDER BY id) AS members FROM s GROUP BY 1)
SELECT row_number() OVER (ORDER BY first) AS nr_id, seq, members FROM g""")
def nr_sequences(spark, d):
    return matching.non_redundant(peptides_of(spark, d).select(F.col("doc_id").alias("id"), "seq"))


@query("""WITH s AS (SELECT p_partkey AS pair, p_name AS a, translate(p_name, 'aeiou', 'eioua') AS b FROM part), x AS (SELECT pair, a, b, unnest(range(1, length(a) + 1)) AS i FROM s)
SELECT pair, i::INTEGER AS position, substr(a, i, 1) || '->' || substr(b, i, 1) AS variant FROM x WHERE substr(a, i, 1) <> substr(b, i, 1)""")
def alignment_differences(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("pair"), F.col("p_name").alias("query"), F.translate("p_name", "aeiou", "eioua").alias("subject"))
    return matching.alignment_differences(rows)


@query("""WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey % 12 AS pos, l_suppkey % 5 AS annotated, substr('KRMAG', (l_suppkey % 5 + 1)::INTEGER, 1) AS before, CASE WHEN l_linenumber % 2 = 0 THEN 'ATG' ELSE 'AAA' END AS codon, substr('MAK', (l_orderkey % 3 + 1)::INTEGER, 1) AS first FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN pos = annotated THEN 'annotated start' WHEN pos = annotated + 1 AND before = 'M' THEN 'annotated start, Met removed' WHEN pos < annotated THEN 'upstream of annotated start'
 WHEN codon = 'ATG' AND before NOT IN ('K', 'R') THEN 'alternative start, Met removed' WHEN first = 'M' AND before NOT IN ('K', 'R') THEN 'alternative start' WHEN before IN ('K', 'R') THEN 'tryptic internal' ELSE 'non-tryptic internal' END AS kind FROM h""")
def start_types(spark, d):
    pick = lambda letters, n: F.substring(F.lit(letters), (n + 1).cast("int"), F.lit(1))
    codon = F.when(F.col("l_linenumber") % 2 == 0, "ATG").otherwise("AAA")
    kind = matching.start_type(pick("MAK", F.col("l_orderkey") % 3), codon, pick("KRMAG", F.col("l_suppkey") % 5), F.col("l_partkey") % 12, F.col("l_suppkey") % 5)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", kind.alias("kind"))


# ---- statistics ----

_LONG = "f AS (SELECT l_partkey AS id, l_returnflag AS sample, round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY ALL)"


def _long(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("sample")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))



@query(f"WITH {_LONG}, o AS (SELECT sample, median(value) AS own FROM f GROUP BY 1) SELECT id, sample, round(value * (SELECT median(value) FROM f) / own, 4) AS value FROM f JOIN o USING (sample)")
def median_norm(spark, d):
    return stats.median_normalise(_long(spark, d)).withColumn("value", F.round("value", 4))


@query(f"WITH {_LONG}, k AS (SELECT id FROM f GROUP BY 1 HAVING count(DISTINCT sample) = 3), g AS (SELECT * FROM f SEMI JOIN k USING (id)) SELECT id, sample, round(value / avg(value) OVER (PARTITION BY sample), 8) AS value FROM g")
def mean_norm(spark, d):
    return stats.mean_normalise(_long(spark, d)).withColumn("value", F.round("value", 8))


@query(f"WITH {_LONG}, r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY value, id) AS place FROM f) SELECT id, sample, round(avg(value) OVER (PARTITION BY place), 4) AS value FROM r")
def quantile_norm(spark, d):
    return stats.quantile_normalise(_long(spark, d)).withColumn("value", F.round("value", 4))


_GROUPS = "g AS (SELECT l_partkey AS id, l_linestatus AS grp, l_quantity AS value FROM lineitem), m AS (SELECT id, count(value) FILTER (WHERE grp = 'O') AS na, avg(value) FILTER (WHERE grp = 'O') AS ma, var_samp(value) FILTER (WHERE grp = 'O') AS va, count(value) FILTER (WHERE grp = 'F') AS nb, avg(value) FILTER (WHERE grp = 'F') AS mb, var_samp(value) FILTER (WHERE grp = 'F') AS vb FROM g GROUP BY 1)"


def _two_groups(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_linestatus").alias("grp"), F.col("l_quantity").alias("value"))


@query(f"WITH {_GROUPS} SELECT id, round(ma - mb, 8) AS log_fc, round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)), 7) AS t, (na + nb - 2)::DOUBLE AS df FROM m WHERE na >= 2 AND nb >= 2")
def ttest(spark, d):
    return stats.t_test(_two_groups(spark, d), "O", "F").select("id", F.round("log_fc", 8).alias("log_fc"), F.round("t", 7).alias("t"), "df")


@query(f"WITH {_GROUPS} SELECT id, round(ma - mb, 8) AS log_fc, round((ma - mb) / sqrt(va / na + vb / nb), 7) AS t, round((va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)), 6) AS df FROM m WHERE na >= 2 AND nb >= 2")
def welch(spark, d):
    return stats.t_test(_two_groups(spark, d), "O", "F", welch=True).select("id", F.round("log_fc", 8).alias("log_fc"), F.round("t", 7).alias("t"), F.round("df", 6).alias("df"))


@query()
def ttest_p_values(spark, d):
    tested = stats.t_test(_two_groups(spark, d), "O", "F")
    return tested.select("id", "t", "df", stats.t_p_value("t", "df").alias("p"))


_RANKS = "r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY value) + (count(*) OVER (PARTITION BY id, value) - 1) / 2 AS r FROM g)"


@query(f"""WITH {_GROUPS}, {_RANKS}, s AS (SELECT id, sum(r) FILTER (WHERE grp = 'O') AS rs, count(*) FILTER (WHERE grp = 'O') AS na, count(*) FILTER (WHERE grp = 'F') AS nb FROM r GROUP BY 1)
SELECT id, rs - na * (na + 1) / 2 AS u, round((rs - na * (na + 1) / 2 - na * nb / 2) / sqrt(na * nb * (na + nb + 1) / 12), 8) AS z FROM s WHERE na > 0 AND nb > 0""")
def ranksum(spark, d):
    return stats.rank_sum(_two_groups(spark, d), "O", "F").select("id", "u", F.round("z", 8).alias("z"))


@query("""WITH g AS (SELECT l_partkey AS id, l_returnflag AS grp, l_quantity AS value FROM lineitem), """ + _RANKS + """,
p AS (SELECT id, grp, sum(r) ** 2 / count(*) AS part, count(*) AS n FROM r GROUP BY ALL), t AS (SELECT id, sum(c ** 3 - c) AS ties FROM (SELECT id, value, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1),
w AS (SELECT id, sum(part) AS s, sum(n)::DOUBLE AS n, count(*) - 1 AS df FROM p GROUP BY 1)
SELECT id, round((12 / (n * (n + 1)) * s - 3 * (n + 1)) / nullif(1 - ties / (n ** 3 - n), 0), 7) AS h, df FROM w JOIN t USING (id) WHERE df > 0""")
def kruskal(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("value"))
    return stats.kruskal_wallis(rows).withColumn("h", F.round("h", 7))


@query("""WITH x AS (SELECT l_suppkey AS id, l_quantity AS x, l_extendedprice AS y FROM lineitem),
r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY x) + (count(*) OVER (PARTITION BY id, x) - 1) / 2 AS rx, rank() OVER (PARTITION BY id ORDER BY y) + (count(*) OVER (PARTITION BY id, y) - 1) / 2 AS ry FROM x)
SELECT id, round(corr(x, y), 8) AS pearson, round(corr(rx, ry), 8) AS spearman FROM r GROUP BY 1""")
def correlation(spark, d):
    pairs = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return stats.correlations(pairs).select("id", F.round("pearson", 8).alias("pearson"), F.round("spearman", 8).alias("spearman"))


@query()
def moderated_t(spark, d):
    return stats.moderated_t(_two_groups(spark, d), "O", "F")


@query("""WITH v AS (SELECT p_partkey AS member, p_retailprice AS value FROM part), s AS (SELECT DISTINCT l_suppkey AS term, l_partkey AS member FROM lineitem),
o AS (SELECT term, count(value) AS n, avg(value) AS mean, var_samp(value) AS var FROM s JOIN v USING (member) GROUP BY 1)
SELECT term, n, round(mean, 10) AS mean, round((mean - (SELECT avg(value) FROM v)) / sqrt(var / n + (SELECT var_samp(value) / count(*) FROM v)), 7) AS t FROM o WHERE n >= 2""")
def enrichment(spark, d):
    values = table(spark, d, "part").select(F.col("p_partkey").alias("member"), F.col("p_retailprice").alias("value"))
    sets = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("term"), F.col("l_partkey").alias("member"))
    return stats.enrichment(values, sets).select("term", "n", F.round("mean", 10).alias("mean"), F.round("t", 7).alias("t"))


@query("""WITH c(cut) AS (VALUES (10.0::DOUBLE), (20.0), (30.0), (40.0), (49.0))
SELECT cut, count(*) FILTER (WHERE l_quantity >= cut AND l_returnflag <> 'R') AS targets, count(*) FILTER (WHERE l_quantity >= cut AND l_returnflag = 'R') AS decoys,
  round(100 * count(*) FILTER (WHERE l_quantity >= cut AND l_returnflag = 'R') / count(*) FILTER (WHERE l_quantity >= cut), 6) AS fdr FROM c CROSS JOIN lineitem GROUP BY 1""")
def threshold_grid(spark, d):
    return stats.threshold_grid(table(spark, d, "lineitem"), "l_quantity", F.col("l_returnflag") == "R", [10, 20, 30, 40, 49])


@query("""WITH p AS (SELECT p_partkey, (p_retailprice - floor(p_retailprice / 100) * 100 + 1) / 101 AS p FROM part),
r AS (SELECT *, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS i, count(*) OVER () AS n FROM p)
SELECT p_partkey, round(p, 9) AS p, round(least(1.0, min(p * n / i) OVER (ORDER BY p DESC)) * (SELECT least(1.0, count(*) FILTER (WHERE p > 0.5) / (count(*) * 0.5)) FROM p), 9) AS q FROM r""")
def storey_q(spark, d):
    price = F.col("p_retailprice")
    rows = table(spark, d, "part").select("p_partkey", ((price - F.floor(price / 100) * 100 + 1) / 101).alias("p"))
    return stats.storey_q(rows, "p", "p_partkey").select("p_partkey", F.round("p", 9).alias("p"), F.round("q", 9).alias("q"))


# ---- annotation, genome tracks and the rest ----

@query("""WITH t AS (SELECT p_partkey AS member, unnest(string_split(p_name, ' ')) AS term FROM part)
SELECT term, string_agg(DISTINCT member::VARCHAR, ';' ORDER BY member::VARCHAR) AS members, count(DISTINCT member)::INTEGER AS n FROM t WHERE term <> '' GROUP BY 1 HAVING count(DISTINCT member) >= 2""")
def gene_sets(spark, d):
    sets = annotation.gene_sets(table(spark, d, "part").withColumn("member", F.col("p_partkey").cast("string")), "member", F.split("p_name", " "), 2)
    return sets.withColumn("members", F.array_join("members", ";"))


@query("SELECT a.r_name AS treated, b.r_name AS control FROM region a JOIN region b ON a.r_name < b.r_name")
def contrasts(spark, d):
    return annotation.contrasts(table(spark, d, "region").select(F.col("r_regionkey").alias("sample"), F.col("r_name").alias("level")))


@query("""SELECT l_partkey AS protein, l_linenumber AS form, p_type AS name, p_size AS start, p_size + 10 AS "end", p_size < l_linenumber * 5 AS excluded FROM (SELECT DISTINCT l_partkey, l_linenumber FROM lineitem) JOIN part ON l_partkey = p_partkey""")
def domain_exclusion(spark, d):
    domains = table(spark, d, "part").select(F.col("p_partkey").alias("protein"), F.col("p_type").alias("name"), F.col("p_size").alias("start"), (F.col("p_size") + 10).alias("end"))
    forms = table(spark, d, "lineitem").select(F.col("l_partkey").alias("protein"), F.col("l_linenumber").alias("form"), (F.col("l_linenumber") * 5).alias("aa_start")).distinct()
    return annotation.domains_in_proteoforms(domains, forms)


_ALIGNED = """a AS (SELECT p_partkey AS hit, (p_partkey % 9 + 1)::INTEGER AS query_from, translate(upper(p_name), 'L', '-') AS query_seq, translate(upper(p_name), 'EO', '+ ') AS midline FROM part)"""


@query(f"""WITH {_ALIGNED}, c AS (SELECT hit, query_from, i, substr(query_seq, i, 1) AS q, substr(midline, i, 1) AS m FROM (SELECT *, unnest(range(1, length(query_seq) + 1)) AS i FROM a)),
p AS (SELECT *, query_from - 1 + sum((q <> '-')::INT) OVER w AS place, sum((NOT (q = m AND q <> '-'))::INT) OVER w AS breaks FROM c WINDOW w AS (PARTITION BY hit ORDER BY i)),
s AS (SELECT hit, breaks, min(place)::BIGINT AS query_start, max(place)::BIGINT AS query_end FROM p WHERE q = m AND q <> '-' GROUP BY ALL)
SELECT hit, row_number() OVER (PARTITION BY hit ORDER BY query_start)::INTEGER AS segment, query_start, query_end FROM s""")
def alignment_segments(spark, d):
    name = F.upper("p_name")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("hit"), (F.col("p_partkey") % 9 + 1).cast("int").alias("query_from"), F.translate(name, "L", "-").alias("query_seq"), F.translate(name, "EO", "+ ").alias("midline"))
    return annotation.match_segments(rows)


@query("SELECT user_id::VARCHAR AS scanid, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS sequences FROM events GROUP BY 1")
def concatenated_tags(spark, d):
    return annotation.concatenated_tags(table(spark, d, "events").select(F.col("user_id").cast("string").alias("scanid"), F.col("event_type").alias("sequence")))


@query("""WITH c AS (SELECT l_suppkey AS sample, l_partkey AS taxon, count(*) AS n FROM lineitem GROUP BY ALL),
p AS (SELECT sample, count(*) FILTER (WHERE n > 10) AS abundant, count(*) FILTER (WHERE n <= 10) AS s, coalesce(sum(n) FILTER (WHERE n <= 10), 0) AS total, count(*) FILTER (WHERE n = 1) AS f1, coalesce(sum(n * (n - 1)) FILTER (WHERE n <= 10), 0) AS pairs FROM c GROUP BY 1),
q AS (SELECT *, nullif(1 - f1 / nullif(total, 0), 0) AS cov FROM p)
SELECT sample, round(coalesce(abundant + s / cov + f1 / cov * coalesce(greatest(0.0, s / cov * (pairs / nullif(total * (total - 1), 0)) - 1), 0), (abundant + s)::DOUBLE), 6) AS ace FROM q""")
def alpha_diversity(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("taxon")).agg(F.count("*").alias("n"))
    return annotation.abundance_coverage(counts).withColumn("ace", F.round("ace", 6))


@query("""WITH g AS (SELECT l_partkey AS id, l_returnflag AS grp, l_quantity AS value FROM lineitem), """ + _RANKS + """,
m AS (SELECT id, grp, avg(r) AS mean, count(*) AS n FROM r GROUP BY ALL), t AS (SELECT id, sum(c ** 3 - c) AS ties, sum(c)::DOUBLE AS n FROM (SELECT id, value, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1)
SELECT x.id, x.grp AS a, y.grp AS b, round((x.mean - y.mean) / nullif(sqrt((t.n * (t.n + 1) / 12 - ties / (12 * (t.n - 1))) * (1 / x.n + 1 / y.n)), 0), 7) AS z FROM m x JOIN m y ON x.id = y.id AND x.grp < y.grp JOIN t ON t.id = x.id""")
def dunn_test(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("value"))
    return annotation.dunn(rows).withColumn("z", F.round("z", 7))


@query(f"WITH {_GROUPS}, s AS (SELECT id, ma - mb AS d, sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)) AS e FROM m WHERE na >= 2 AND nb >= 2) SELECT id, round(d, 8) AS log_fc, round(sign(d) * greatest(0.0, (abs(d) - 1) / e), 7) AS t FROM s")
def threshold_t(spark, d):
    return annotation.threshold_t(_two_groups(spark, d), "O", "F", 1.0).select("id", F.round("log_fc", 8).alias("log_fc"), F.round("t", 7).alias("t"))


@query()
def sample_components(spark, d):
    return annotation.sample_components(_long(spark, d))


@query(f"WITH {_GROUPS}, s AS (SELECT (ma - mb) AS d FROM m WHERE na >= 2 AND nb >= 2 AND abs(ma - mb) > 3) SELECT CASE WHEN d > 0 THEN 'up' ELSE 'down' END AS direction, count(*) AS n, count(*) || ' ' || CASE WHEN d > 0 THEN 'up' ELSE 'down' END || ' at p < 0.05' AS text FROM s GROUP BY 1")
def significant_summary(spark, d):
    tested = stats.t_test(_two_groups(spark, d), "O", "F").withColumn("p", F.when(F.abs("log_fc") > 3, 0.01).otherwise(1.0))
    return annotation.significant_summary(tested, "p")


@query(f"""WITH p AS (SELECT DISTINCT unnest(string_split(regexp_replace(regexp_replace({_LETTERS}, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'), '|')) AS pattern FROM benchmark),
t AS (SELECT {_LETTERS} AS s FROM documents), k AS (SELECT pattern FROM p WHERE length(pattern) BETWEEN 7 AND 30)
SELECT pattern, coalesce(sum((length(s) - length(replace(s, pattern, ''))) // length(pattern)), 0)::BIGINT AS n FROM k LEFT JOIN t ON contains(s, pattern) GROUP BY 1""")
def frame_specific_peptides(spark, d):
    texts = peptides_of(spark, d).select(F.col("doc_id").alias("text_id"), F.col("seq").alias("text"))
    patterns = benchmark_letters(spark, d).select(F.explode_outer(sequences.tryptic_peptides("seq")).alias("pattern")).where("pattern IS NOT NULL")
    return matching.unique_in_frames(patterns, texts)


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 1 WHEN p_type = 'SMALL' THEN 2 WHEN p_retailprice > 1000 THEN 3 ELSE 13 END AS code FROM part")
def evidence_codes(spark, d):
    code = matching.evidence_code([(F.col("p_size") > 40, 1), (F.col("p_type") == "SMALL", 2), (F.col("p_retailprice") > 1000, 3)], 13)
    return table(spark, d, "part").select("p_partkey", code.alias("code"))


@query("""WITH a AS (SELECT p_partkey AS a_id, p_brand AS strand, p_partkey AS a_start, p_partkey + p_size AS a_end FROM part), b AS (SELECT s_suppkey AS b_id, 'Brand#' || s_nationkey AS strand, s_suppkey * 15 AS b_start, s_suppkey * 15 + 60 AS b_end FROM supplier)
SELECT a_id, b_id FROM a JOIN b ON a.strand = b.strand AND b_start <= a_start AND a_end <= b_end""")
def same_strand_containment(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("a_id"), F.col("p_brand").alias("strand"), F.col("p_partkey").alias("a_start"), (F.col("p_partkey") + F.col("p_size")).alias("a_end"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("b_id"), F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")).alias("strand"), (F.col("s_suppkey") * 15).alias("b_start"), (F.col("s_suppkey") * 15 + 60).alias("b_end"))
    return relational.overlaps(a, b, 64, ["strand"]).where("b_start <= a_start AND a_end <= b_end").select("a_id", "b_id")


@query("SELECT doc_id, quality, toxic, lang, n_chars FROM labels JOIN documents USING (doc_id)")
def natural_join(spark, d):
    return table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").select("doc_id", "quality", "toxic", "lang", "n_chars")


@query("SELECT p_brand, p_type, count(*) FILTER (WHERE p_size <= 25) AS small, count(*) FILTER (WHERE p_size > 25) AS large FROM part GROUP BY ALL")
def annotation_matrix(spark, d):
    size = F.when(F.col("p_size") <= 25, "small").otherwise("large")
    return table(spark, d, "part").withColumn("size", size).groupBy("p_brand", "p_type").pivot("size", ["small", "large"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT p_brand, p_type, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey) = 1")
def isoform_collapse(spark, d):
    return relational.top_per_key(table(spark, d, "part"), ["p_brand", "p_type"], [F.desc("p_retailprice"), F.asc("p_partkey")]).select("p_brand", "p_type", "p_partkey")


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY md5(s_suppkey::VARCHAR)")
def fixed_shuffle(spark, d):
    """Rows in an order that only the key decides, which a run can repeat."""
    return table(spark, d, "supplier").orderBy(F.md5(F.col("s_suppkey").cast("string").cast("binary"))).select("s_suppkey", "s_name")


@query("WITH RECURSIVE f(n, a, b) AS (SELECT 1, 1::BIGINT, 1::BIGINT UNION ALL SELECT n + 1, b, a + b FROM f WHERE n < 40) SELECT n, a AS fib FROM f")
def fibonacci(spark, d):
    return spark.sql("WITH RECURSIVE f(n, a, b) AS (SELECT 1, 1L, 1L UNION ALL SELECT n + 1, b, a + b FROM f WHERE n < 40) SELECT n, a AS fib FROM f")


@query("""WITH e AS (SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, n FROM e""")
def windowed_counts(spark, d):
    from ionloom.streaming.tags import windowed_counts as counted

    return counted(table(spark, d, "events")).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


# ---- tags, variants and headers ----

@query("""WITH s AS (SELECT DISTINCT l_returnflag AS strain, l_partkey || ':' || l_linenumber AS cluster FROM lineitem), k AS (SELECT DISTINCT strain FROM s)
SELECT s.strain, k.strain AS other, cluster FROM s JOIN k ON s.strain <> k.strain WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.strain = k.strain AND o.cluster = s.cluster)""")
def strain_differences(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("strain"), F.col("l_partkey").alias("protein"), F.col("l_linenumber").alias("position"))
    return metaproteomics.map_clusters(rows)


_ALPHABET = ", ".join(f"('{a}', {m}::DOUBLE)" for a, m in sorted(sequences.RESIDUE_MASS.items()) if a in "ARNDCEQGHLKMFPSTWYV")


@query(f"""WITH r(x, m) AS (VALUES {_ALPHABET}), g AS (SELECT p_partkey AS gap_id, 57.02146 + (p_partkey % 400)::DOUBLE AS mass FROM part),
k AS (SELECT a.x AS residues, a.m AS m FROM r a UNION ALL SELECT a.x || b.x, a.m + b.m FROM r a JOIN r b ON a.x <= b.x UNION ALL SELECT a.x || b.x || c.x, a.m + b.m + c.m FROM r a JOIN r b ON a.x <= b.x JOIN r c ON b.x <= c.x)
SELECT gap_id, residues FROM g JOIN k ON abs(mass - m) <= 0.05""")
def gap_sequences(spark, d):
    gaps = table(spark, d, "part").select(F.col("p_partkey").alias("gap_id"), (F.lit(57.02146) + (F.col("p_partkey") % 400).cast("double")).alias("mass"))
    return matching.gap_sequences(gaps, 0.05, 3)


@query(f"""WITH m(r, w) AS (VALUES {_MASSES}), p AS (SELECT DISTINCT unnest(string_split(regexp_replace(regexp_replace({_LETTERS}, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'), '|')) AS s FROM documents),
x AS (SELECT s, unnest(string_split(s, '')) AS r FROM p WHERE length(s) BETWEEN 7 AND 30 AND NOT regexp_matches(s, '[XZB]')),
t AS (SELECT s, sum(w + CASE WHEN r = 'C' THEN 57.021464 ELSE 0 END)::DOUBLE + 18.010565 AS own FROM x JOIN m USING (r) GROUP BY 1)
SELECT s AS sequence FROM t WHERE abs(own + 2 * 40.0::DOUBLE - 110.5 * length(s)) <= 100 + 2 * 1.5""")
def consistent_tags(spark, d):
    rows = peptides_of(spark, d).select(F.explode_outer(sequences.tryptic_peptides("seq")).alias("sequence")).where("sequence IS NOT NULL").distinct()
    rows = rows.select("sequence", F.lit(40.0).alias("n_gap"), F.lit(40.0).alias("c_gap"), (F.length("sequence") * F.lit(110.5)).alias("mass"))
    return matching.consistent_tags(rows, 100.0, 1.5).select("sequence")


_CUT = "(c[i] IN ('K', 'R') AND c[i + 1] <> 'P')"


@query(f"""WITH p AS (SELECT doc_id, string_split({_LETTERS}, '') AS c FROM documents)
SELECT doc_id, len(list_filter(range(1, len(c) - 10), lambda i: {_CUT} AND c[i + 10] IN ('K', 'R'))) AS specific, len(list_filter(range(1, len(c) - 10), lambda i: {_CUT} OR c[i + 10] IN ('K', 'R'))) AS semi FROM p WHERE len(c) > 30""")
def cleavage(spark, d):
    """How many of all runs of ten residues of a text the enzyme could make at both ends, and at one at least."""
    at = lambda i: F.get("chars", i)
    ok = lambda i, s: sequences.valid_cleavage(at(i), at(i + 1), at(i + 10), at(i + 11), "Trypsin", s)
    runs = F.sequence(F.lit(0), F.size("chars") - 12)
    chars = peptides_of(spark, d).where("length(seq) > 30").select("doc_id", F.filter(F.split("seq", ""), lambda r: r != "").alias("chars"))
    count = lambda s: F.size(F.filter(runs, lambda i: ok(i, s))).cast("bigint")
    return chars.select("doc_id", count("specific").alias("specific"), count("semi-specific").alias("semi"))


@query(f"""WITH g AS ({_ACGT}), v AS (SELECT DISTINCT doc_id AS contig, 20 * (1 + (doc_id * 7 + k) % 25) AS pos, 2 AS n, repeat('T', (k % 4)::INTEGER) AS alt, k FROM documents, (SELECT unnest(range(0, 5)) AS k)),
u AS (SELECT contig, pos, n, min(alt) AS alt FROM v JOIN g USING (contig) WHERE pos + 2 <= length(seq) GROUP BY ALL),
p AS (SELECT u.contig, pos, substr(seq, coalesce(lag(pos + n) OVER w, 1)::INTEGER, (pos - coalesce(lag(pos + n) OVER w, 1))::INTEGER) || alt AS piece, pos + n AS after, seq FROM u JOIN g ON u.contig = g.contig WINDOW w AS (PARTITION BY u.contig ORDER BY pos)),
b AS (SELECT contig, string_agg(piece, '' ORDER BY pos) AS head, max(after) AS after FROM p GROUP BY 1)
SELECT g.contig, CASE WHEN head IS NULL THEN seq ELSE head || substr(seq, after::INTEGER) END AS seq FROM g LEFT JOIN b USING (contig)""")
def variant_genome(spark, d):
    genome = nucleotides(spark, d)
    k = F.explode(F.sequence(F.lit(0), F.lit(4)))
    rows = genome.select("contig", F.length("seq").alias("n"), k.alias("k")).select("contig", "n", (20 * (1 + (F.col("contig") * 7 + F.col("k")) % 25)).cast("int").alias("pos"), F.repeat(F.lit("T"), F.col("k") % 4).alias("alt"))
    variants = rows.where("pos + 2 <= n").groupBy("contig", "pos").agg(F.min("alt").alias("alt")).withColumn("ref", F.lit("NN"))
    return matching.apply_variants(genome, variants)


@query("""SELECT p_partkey, 'x' || p_partkey AS contig, 'x' || p_partkey || '_recno_3.1' AS orf, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_size::BIGINT AS start, p_size::BIGINT + 30 AS "end", 'x' || p_partkey || '_recno_3.0' AS base FROM part""")
def orf_headers(spark, d):
    key = F.concat(F.lit("x"), F.col("p_partkey").cast("string"))
    orf = F.concat(key, F.lit("_recno_3.1"))
    text = F.concat(key, F.lit("|"), orf, F.lit("|("), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-"), F.lit(")"), F.col("p_size").cast("string"), F.lit(":"), (F.col("p_size") + 30).cast("string"))
    return table(spark, d, "part").select("p_partkey", ids.orf_fields(text).alias("f"), ids.base_orf(orf).alias("base")).select("p_partkey", "f.*", "base")


@query("""SELECT p_partkey, p_name AS protein, 'g' || p_size AS gene, CASE WHEN p_type = 'SMALL' THEN 'Unspecified' ELSE p_type || ' sp' END AS organism, '1.2.' || p_size || '.4' AS ec, 'GO:' || p_size AS go, p_brand || '%20x' AS quoted FROM (SELECT * REPLACE (replace(p_brand, '#', '%23') AS p_brand) FROM part)""")
def header_fields(spark, d):
    size = F.col("p_size").cast("string")
    header = F.concat(F.lit("sp|A|B "), F.col("p_name"), F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(F.concat(F.lit(" OS="), F.col("p_type"), F.lit(" sp OX=1"))), F.lit(" GN=g"), size, F.lit(" PE=1"))
    cell = F.concat(F.lit("KEGG:1|GO:"), size, F.lit("|1.2."), size, F.lit(".4"))
    out = [ids.protein_name(header).alias("protein"), ids.header_value(header, "GN").alias("gene"), ids.organism(header).alias("organism"), ids.leading(F.array_join(ids.ec_numbers(cell), ";")).alias("ec"), F.get(ids.terms(cell, "GO:"), F.lit(0)).alias("go"), ids.url_quoted(F.concat("p_brand", F.lit(" x"))).alias("quoted")]
    return table(spark, d, "part").select("p_partkey", *out)


@query()
def tag_extension(spark, d):
    """Tags of three residues in the first tryptic peptide of each text, with the gaps and the mass of that peptide."""
    rows = peptides_of(spark, d).select(F.col("doc_id").alias("hit_id"), F.regexp_replace("seq", "[BXZ]", "G").alias("protein"))
    span = F.filter(F.split("protein", sequences.TRYPSIN_SITE), lambda p: F.length(p) >= 6)
    rows = rows.withColumn("peptide", F.get(span, F.lit(0))).where("peptide IS NOT NULL").withColumn("begin", F.expr("locate(peptide, protein) - 1"))
    water = sequences.peptide_mass(F.lit(""))
    rows = rows.select("hit_id", "protein", (F.col("begin") + 2).alias("start"), F.lit(3).alias("length"), (sequences.peptide_mass(F.expr("left(peptide, 2)")) - water).alias("n_gap"), (sequences.peptide_mass(F.expr("substring(peptide, 6)")) - water).alias("c_gap"), sequences.peptide_mass("peptide").alias("mass"))
    return matching.extend_tags(rows, 0.01, 0.01)


@query()
def corrected_tags(spark, d):
    name = F.upper("p_name")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("hit"), F.lit(1).alias("query_from"), name.alias("query_seq"), F.translate(name, "EO", "+ ").alias("midline"), name.alias("sequence"), F.lit(10.0).alias("n_gap"), F.lit(0.0).alias("c_gap"))
    return matching.corrected_tags(rows)


@query()
def frameshifts(spark, d):
    """Peptides that begin like one text and go on like the next one, by doc_id."""
    orfs = peptides_of(spark, d).where("length(seq) >= 26").select(F.col("doc_id").alias("orf"), "seq")
    pairs = orfs.select(F.col("orf").alias("a"), (F.col("orf") + 1).alias("b")).join(orfs.select(F.col("orf").alias("b")), "b", "left_semi")
    own = orfs.select(F.col("orf").alias("a"), F.substring("seq", 5, 6).alias("head"))
    other = orfs.select((F.col("orf") - 1).alias("a"), F.substring("seq", 20, 6).alias("rest"))
    return matching.frameshift_peptides(pairs, own.join(other, "a").select(F.concat("head", "rest").alias("peptide"), "a"), orfs)