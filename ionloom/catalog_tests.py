"""Queries of the statistical tests and of the smaller sequence and set operators, with the SQL that each is held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionloom.catalog import _GROUPS, _LETTERS, _MASSES, _RANKS, ORACLES, QUERIES, _two_groups, peptides_of, query
from ionloom.functions import sequences
from ionloom.operators import inference, matching, relational
from ionloom.plans import metaproteomics
from ionloom.session import table

# Tails that have a finite or a fast series, written as such: Student's t with whole degrees of freedom, the normal.
_TH = "atan(abs(t) / sqrt(df))"
_T_P = f"""CASE WHEN df::INTEGER % 2 = 1 THEN 1 - 2 / pi() * ({_TH} + CASE WHEN df > 1 THEN sin({_TH}) * list_sum(list_transform(range(0, ((df - 1) / 2)::BIGINT), lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)) * cos({_TH}) ** (2 * j + 1))) ELSE 0 END)
  ELSE 1 - sin({_TH}) * list_sum(list_transform(range(0, (df / 2)::BIGINT), lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * cos({_TH}) ** (2 * j))) END"""
_NORMAL_P = "(1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 90), lambda j: CASE WHEN j % 2 = 0 THEN 1 ELSE -1 END * exp((2 * j + 1) * ln(greatest(abs(z), 1e-12) / sqrt(2)) - lgamma(j + 1)) / (2 * j + 1))))"
_FLAGS = "g AS (SELECT l_partkey AS id, l_returnflag AS grp, l_quantity AS value FROM lineitem), s AS (SELECT id, grp, count(*)::DOUBLE AS n, avg(value) AS mean, var_samp(value) AS var FROM g GROUP BY ALL)"


def _flags(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("value"))


ORACLES["ttest_p_values"] = f"WITH {_GROUPS}, x AS (SELECT id, (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)) AS t, (na + nb - 2)::DOUBLE AS df FROM m WHERE na >= 2 AND nb >= 2) SELECT id, round(t, 7) AS t, df, round({_T_P}, 7) AS p FROM x"
_plain_p = QUERIES["ttest_p_values"]
QUERIES["ttest_p_values"] = lambda spark, d: _plain_p(spark, d).select("id", F.round("t", 7).alias("t"), "df", F.round("p", 7).alias("p"))


@query(f"""WITH x AS (SELECT l_suppkey AS id, corr(l_quantity, l_extendedprice) AS r, (count(*) - 2)::DOUBLE AS df FROM lineitem GROUP BY 1 HAVING count(*) > 2), y AS (SELECT id, r, r * sqrt(df) / sqrt(1 - r * r) AS t, df FROM x)
SELECT id, round(r, 8) AS pearson, round(t, 6) AS t, df, round({_T_P}, 6) AS p FROM y""")
def correlation_p(spark, d):
    pairs = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return inference.correlation_test(pairs).select("id", F.round("pearson", 8).alias("pearson"), F.round("t", 6).alias("t"), "df", F.round("p", 6).alias("p"))


@query(f"""WITH {_GROUPS}, {_RANKS}, k AS (SELECT id, sum(c ** 3 - c) AS ties FROM (SELECT id, value, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1),
s AS (SELECT id, sum(r) FILTER (WHERE grp = 'O') AS rs, (count(*) FILTER (WHERE grp = 'O'))::DOUBLE AS na, (count(*) FILTER (WHERE grp = 'F'))::DOUBLE AS nb FROM r GROUP BY 1),
w AS (SELECT id, rs - na * (na + 1) / 2 AS u, rs - na * (na + 1) / 2 - na * nb / 2 AS off, sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1)))) AS e FROM s JOIN k USING (id) WHERE na > 0 AND nb > 0),
x AS (SELECT id, u, (off - sign(off) / 2) / nullif(e, 0) AS z FROM w) SELECT id, u, round(z, 7) AS z, round({_NORMAL_P}, 7) AS p FROM x""")
def ranksum_p(spark, d):
    return inference.rank_sum_test(_two_groups(spark, d), "O", "F").select("id", "u", F.round("z", 7).alias("z"), F.round("p", 7).alias("p"))


@query(f"""WITH {_FLAGS}, {_RANKS}, p AS (SELECT id, grp, sum(r) ** 2 / count(*) AS part, count(*) AS n FROM r GROUP BY ALL), t AS (SELECT id, sum(c ** 3 - c) AS ties FROM (SELECT id, value, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1),
w AS (SELECT id, sum(part) AS s, sum(n)::DOUBLE AS n, count(*) - 1 AS df FROM p GROUP BY 1),
h AS (SELECT id, (12 / (n * (n + 1)) * s - 3 * (n + 1)) / nullif(1 - ties / (n ** 3 - n), 0) AS h, df, sqrt(abs((12 / (n * (n + 1)) * s - 3 * (n + 1)) / nullif(1 - ties / (n ** 3 - n), 0))) AS z FROM w JOIN t USING (id) WHERE df > 0)
SELECT id, round(h, 7) AS h, df, round(CASE WHEN df = 2 THEN exp(-h / 2) ELSE {_NORMAL_P} END, 6) AS p FROM h""")
def kruskal_p(spark, d):
    return inference.kruskal_test(_flags(spark, d)).select("id", F.round("h", 7).alias("h"), "df", F.round("p", 6).alias("p"))


@query(f"""WITH {_FLAGS}, {_RANKS}, m AS (SELECT id, grp, avg(r) AS mean, count(*) AS n FROM r GROUP BY ALL), t AS (SELECT id, sum(c ** 3 - c) AS ties, sum(c)::DOUBLE AS n FROM (SELECT id, value, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1),
y AS (SELECT x.id, x.grp AS a, y.grp AS b, (x.mean - y.mean) / nullif(sqrt((t.n * (t.n + 1) / 12 - ties / (12 * (t.n - 1))) * (1 / x.n + 1 / y.n)), 0) AS z FROM m x JOIN m y ON x.id = y.id AND x.grp < y.grp JOIN t ON t.id = x.id),
p AS (SELECT *, {_NORMAL_P} AS p FROM y WHERE z IS NOT NULL)
SELECT id, a, b, round(p, 6) AS p, round(least(1.0, (SELECT min(q.p * (SELECT count(*) FROM p c WHERE c.id = p.id) / (SELECT count(*) FROM p c WHERE c.id = p.id AND c.p <= q.p)) FROM p q WHERE q.id = p.id AND q.p >= p.p)), 6) AS adjusted FROM p""")
def dunn_p(spark, d):
    return inference.dunn_test(_flags(spark, d)).select("id", "a", "b", F.round("p", 6).alias("p"), F.round("adjusted", 6).alias("adjusted"))


@query(f"""WITH {_GROUPS}, s AS (SELECT id, ma - mb AS d, (na + nb - 2)::DOUBLE AS df, sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)) AS e FROM m WHERE na >= 2 AND nb >= 2),
b AS (SELECT id, d, df, 0 AS side, (abs(d) - 1) / e AS t FROM s UNION ALL SELECT id, d, df, 1, (abs(d) + 1) / e FROM s), p AS (SELECT id, d, df, CASE WHEN t >= 0 THEN ({_T_P}) / 2 ELSE 1 - ({_T_P}) / 2 END AS p FROM b)
SELECT id, round(d, 8) AS log_fc, df, round(sum(p), 7) AS p FROM p GROUP BY ALL""")
def threshold_p(spark, d):
    return inference.threshold_test(_two_groups(spark, d), "O", "F", 1.0).select("id", F.round("log_fc", 8).alias("log_fc"), "df", F.round("p", 7).alias("p"))


@query(f"""WITH {_FLAGS}, w AS (SELECT id, (count(*) - 1)::DOUBLE AS df1, sum(n) - count(*) AS df2, sum(n * mean ** 2) - sum(n * mean) ** 2 / sum(n) AS between_, sum(coalesce((n - 1) * var, 0)) AS within_ FROM s GROUP BY 1),
f AS (SELECT id, (between_ / df1) / nullif(within_ / df2, 0) AS f, df1, df2, sqrt(greatest(0.0, (between_ / df1) / nullif(within_ / df2, 0))) AS t, df2 AS df FROM w WHERE df1 > 0 AND df2 > 0)
SELECT id, round(f, 6) AS f, df1, df2, round(CASE WHEN df1 = 2 THEN (df2 / (df2 + 2 * f)) ** (df2 / 2) ELSE {_T_P} END, 6) AS p FROM f""")
def anova(spark, d):
    return inference.anova(_flags(spark, d)).select("id", F.round("f", 6).alias("f"), "df1", "df2", F.round("p", 6).alias("p"))


@query(f"""WITH {_FLAGS}, w AS (SELECT id, count(*)::DOUBLE AS k, sum(n - 1) AS a, sum((n - 1) * var) / sum(n - 1) AS pooled, sum((n - 1) * ln(CASE WHEN var > 0 THEN var END)) AS logs, sum(1 / (n - 1)) AS parts, min(var) AS least FROM s WHERE n >= 2 GROUP BY 1),
b AS (SELECT id, (a * ln(pooled) - logs) / (1 + (parts - 1 / a) / (3 * (k - 1))) AS k2, k - 1 AS df FROM w WHERE k > 1 AND least > 0), x AS (SELECT *, sqrt(greatest(0.0, k2)) AS z FROM b)
SELECT id, round(k2, 6) AS k2, df, round(CASE WHEN df = 2 THEN exp(-k2 / 2) ELSE {_NORMAL_P} END, 5) AS p FROM x""")
def bartlett(spark, d):
    return inference.bartlett(_flags(spark, d)).select("id", F.round("k2", 6).alias("k2"), "df", F.round("p", 5).alias("p"))


@query(f"""WITH {_FLAGS}, w AS (SELECT id, count(*) AS k, sum(n) - count(*) AS df, sum(coalesce((n - 1) * var, 0)) AS within_ FROM s GROUP BY 1)
SELECT x.id, x.grp AS a, y.grp AS b, round(x.mean - y.mean, 8) AS diff, round(abs(x.mean - y.mean) / nullif(sqrt(within_ / df / 2 * (1 / x.n + 1 / y.n)), 0), 6) AS q, df FROM s x JOIN s y ON x.id = y.id AND x.grp < y.grp JOIN w ON w.id = x.id WHERE k > 1 AND df > 0""")
def tukey(spark, d):
    return inference.tukey(_flags(spark, d)).select("id", "a", "b", F.round("diff", 8).alias("diff"), F.round("q", 6).alias("q"), "df")


@query()
def fligner(spark, d):
    return inference.fligner(_flags(spark, d))


@query()
def enrichment_p(spark, d):
    values = table(spark, d, "part").select(F.col("p_partkey").alias("member"), F.col("p_retailprice").alias("value"))
    sets = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("term"), F.col("l_partkey").alias("member"))
    return inference.enrichment_test(values, sets)


# ---- sequences and sets ----

@query(f"""WITH p AS (SELECT doc_id, {_LETTERS} AS s FROM documents), c AS (SELECT doc_id, s, unnest(string_split(regexp_replace(regexp_replace(s, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'), '|')) AS peptide, generate_subscripts(string_split(regexp_replace(regexp_replace(s, '([RK])([^P])', '\\1|\\2', 'g'), '([RK])([^P|])', '\\1|\\2', 'g'), '|'), 1) AS k FROM p),
b AS (SELECT doc_id, s, k, length(peptide) AS n, sum(length(peptide)) OVER (PARTITION BY doc_id ORDER BY k)::BIGINT AS stop FROM c WHERE peptide <> '')
SELECT doc_id, stop - n + 1 AS start, stop AS "end", nullif(substr(s, stop - n, CASE WHEN stop > n THEN 1 ELSE 0 END), '') AS before, substr(s, stop - n + 1, 1) AS first, substr(s, stop, 1) AS last, nullif(substr(s, stop + 1, 1), '') AS after FROM b""")
def neighbours(spark, d):
    """The residues around every tryptic peptide of every text."""
    texts = peptides_of(spark, d).select(F.col("doc_id").alias("text_id"), F.col("seq").alias("text"))
    return matching.cleaved_in_context(texts).withColumnRenamed("text_id", "doc_id")


@query(f"""WITH m(r, w) AS (VALUES {_MASSES}), p AS (SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z]|[bxzBXZ]', '', 'g')) AS s, p_size FROM part), x AS (SELECT p_partkey, p_size, unnest(string_split(s, '')) AS r FROM p WHERE s <> ''),
t AS (SELECT p_partkey, p_size, sum(w + CASE WHEN r = 'C' THEN 57.021464 ELSE 0 END)::DOUBLE + 18.010565 AS own FROM x JOIN m USING (r) GROUP BY ALL)
SELECT p_partkey FROM t WHERE abs(own - own * (1 + (p_size - 25) * 1e-6)) / (own * (1 + (p_size - 25) * 1e-6)) * 1e6 <= 10.5""")
def precursor_check(spark, d):
    """Sequences whose mass agrees with the precursor's within 10.5 ppm."""
    rows = table(spark, d, "part").select("p_partkey", F.upper(F.regexp_replace("p_name", "[^A-Za-z]|[bxzBXZ]", "")).alias("sequence"), ((F.col("p_size") - 25) * F.lit(1e-6)).alias("off")).where("sequence <> ''")
    rows = rows.withColumn("precursor", sequences.peptide_mass("sequence") * (1 + F.col("off")))
    return rows.where(sequences.agrees_with_precursor("sequence", "precursor", 10.5)).select("p_partkey")


@query("SELECT p_partkey, 'ctg.' || lower(p_brand) AS contig, p_type AS seq FROM part")
def trimmed_records(spark, d):
    """Stops behind a sequence go, and contigs get lower-case names."""
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.lit("ctg."), "p_brand").alias("contig"), F.concat("p_type", F.repeat(F.lit("*"), F.col("p_size") % 3)).alias("seq"))
    return rows.select("p_partkey", F.lower("contig").alias("contig"), sequences.without_stops("seq").alias("seq"))


@query("SELECT DISTINCT l_orderkey AS peptide FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> (SELECT min(p_type) FROM part))")
def ranked_taxa_only(spark, d):
    """Peptides with a taxon of some rank, where one type stands for no rank."""
    part = table(spark, d, "part")
    taxa = part.crossJoin(F.broadcast(part.agg(F.min("p_type").alias("root_")))).select(F.col("p_partkey").alias("taxon"), F.when(F.col("p_type") == F.col("root_"), "no rank").otherwise("species").alias("taxon_rank"))  # one row
    hits = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("peptide"), F.col("l_partkey").alias("taxon"))
    return relational.with_ranked_taxon(hits, taxa).select("peptide").distinct()


@query("""WITH s AS (SELECT DISTINCT l_partkey AS k, l_shipdate::DATE AS day, l_returnflag AS grp FROM lineitem), n AS (SELECT grp, count(*) AS n FROM (SELECT DISTINCT k, grp FROM s) GROUP BY 1),
b AS (SELECT x.grp AS a, y.grp AS b, count(*) AS both_ FROM (SELECT DISTINCT k, grp FROM s) x JOIN (SELECT DISTINCT k, grp FROM s) y ON x.k = y.k AND x.grp < y.grp GROUP BY ALL)
SELECT b.a, b.b, both_ AS shared, round(100 * both_ / (p.n + q.n - both_), 8) AS percent FROM b JOIN n p ON p.grp = b.a JOIN n q ON q.grp = b.b""")
def jaccard_percent(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_returnflag").alias("grp"))
    return relational.jaccard_percent(rows).withColumn("percent", F.round("percent", 8))


@query("""WITH f AS (SELECT l_suppkey AS id, l_returnflag AS grp, l_extendedprice AS value FROM lineitem), t AS (SELECT id FROM f GROUP BY 1 HAVING sum(value) >= 0.01 * (SELECT sum(value) FROM f))
SELECT id, grp, round(avg(value), 6) AS mean, round(var_samp(value), 2) AS var FROM f SEMI JOIN t USING (id) GROUP BY ALL""")
def large_feature_means(spark, d):
    """Group means of the features that hold at least a hundredth of everything."""
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("grp"), F.col("l_extendedprice").alias("value"))
    kept = relational.large_features(rows, 0.01)
    return kept.groupBy("id", "grp").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.var_samp("value"), 2).alias("var"))


# ---- strains and databases ----

_MAPPING = "mp AS (SELECT l_suppkey AS orf, CASE WHEN l_partkey % 3 = 0 THEN 'M' ELSE 'A' END || l_partkey AS peptide, CASE WHEN l_linenumber > 2 THEN '+' ELSE '-' END AS sp, CASE WHEN l_linenumber % 2 = 0 THEN 'ATG;GTG' ELSE 'GTG;TTG' END AS cd FROM lineitem)"
_CLASSES = _MAPPING + """, cl AS (SELECT peptide, count(DISTINCT orf) AS n_orfs, bool_or(sp = '+') AS specific, bool_or(sp = '-') AS non_specific, bool_or(sp = '+') AND count(DISTINCT orf) > 1 AS paralogous,
  peptide[1] = 'M' AND bool_or(NOT list_contains(string_split(cd, ';'), 'ATG')) AS non_atg_start FROM mp GROUP BY 1)"""


def _mapping(spark, d):
    peptide = F.concat(F.when(F.col("l_partkey") % 3 == 0, "M").otherwise("A"), F.col("l_partkey").cast("string"))
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("orf"), peptide.alias("peptide"), F.when(F.col("l_linenumber") > 2, "+").otherwise("-").alias("cluster_specific"),
        F.when(F.col("l_linenumber") % 2 == 0, "ATG;GTG").otherwise("GTG;TTG").alias("first_codon"), "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber",
    )


@query(f"WITH {_CLASSES} SELECT * FROM cl")
def peptide_classes(spark, d):
    return metaproteomics.peptide_classes(_mapping(spark, d))


_COMBINED = _CLASSES + """, ev AS (SELECT DISTINCT l_orderkey % 1000 AS g, CASE WHEN l_partkey % 3 = 0 THEN 'M' ELSE 'A' END || l_partkey AS peptide FROM lineitem),
ob AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN 'M' ELSE 'A' END || l_partkey AS peptide, l_returnflag || l_linestatus AS sample, l_returnflag AS strain, CASE WHEN l_partkey % 3 = 0 THEN 'M' ELSE 'A' END || l_partkey || '_' || l_linenumber AS modified FROM lineitem),
se AS (SELECT DISTINCT g, ev.peptide, strain, sample, modified FROM ev JOIN ob USING (peptide))"""


def _combined(spark, d):
    rows = _mapping(spark, d)
    members = rows.select((F.col("l_orderkey") % 1000).alias("group_id"), "peptide")
    sample = F.concat("l_returnflag", "l_linestatus")
    evidence = rows.select("peptide", sample.alias("sample"), F.concat("peptide", F.lit("_"), F.col("l_linenumber").cast("string")).alias("modified"))
    design = rows.select(sample.alias("sample"), F.col("l_returnflag").alias("strain")).distinct()
    return metaproteomics.combined_groups(members, evidence, design, metaproteomics.peptide_classes(rows))


@query(f"""WITH {_COMBINED}, sh AS (SELECT g, peptide, count(DISTINCT strain) AS n FROM se GROUP BY ALL)
SELECT g AS group_id, coalesce(string_agg(DISTINCT peptide, ';' ORDER BY peptide) FILTER (WHERE specific AND NOT non_specific), '') AS specific_peptides, coalesce(string_agg(DISTINCT peptide, ';' ORDER BY peptide) FILTER (WHERE paralogous), '') AS paralogous_peptides,
  CASE WHEN bool_or(paralogous) THEN '+' ELSE '-' END AS paralogous, coalesce(string_agg(DISTINCT peptide, ';' ORDER BY peptide) FILTER (WHERE specific AND NOT non_specific AND n = 1), '') AS one_strain_peptides
FROM ev LEFT JOIN cl USING (peptide) LEFT JOIN sh USING (g, peptide) GROUP BY 1""")
def combined_groups(spark, d):
    return _combined(spark, d)[0]


@query(f"WITH {_COMBINED} SELECT g AS group_id, strain, count(DISTINCT sample) AS n_samples, string_agg(DISTINCT modified, ';' ORDER BY modified) AS peptides FROM se GROUP BY ALL")
def combined_strains(spark, d):
    return _combined(spark, d)[1]


@query("""WITH a AS (SELECT 'one' AS database, l_orderkey::VARCHAR AS g, l_partkey::VARCHAR AS protein FROM lineitem WHERE l_linestatus = 'O' UNION SELECT 'two', l_orderkey::VARCHAR, l_partkey::VARCHAR FROM lineitem WHERE l_linestatus = 'F')
SELECT protein, string_agg(DISTINCT database, ';' ORDER BY database) AS databases, count(DISTINCT database) AS n_databases, string_agg(DISTINCT database || ':' || g, ';' ORDER BY database || ':' || g) AS groups FROM a GROUP BY 1""")
def merged_groups(spark, d):
    """The groups of two databases, one for each line status."""
    rows = table(spark, d, "lineitem")
    of = lambda s: rows.where(F.col("l_linestatus") == s).groupBy(F.col("l_orderkey").alias("group_id")).agg(F.array_join(F.collect_list(F.col("l_partkey").cast("string")), ";").alias("proteins"))
    return metaproteomics.merged_groups({"one": of("O"), "two": of("F")})
