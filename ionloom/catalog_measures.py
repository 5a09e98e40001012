"""Queries of designs within subjects, of score thresholds and mass errors, and of indexed regions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionloom.catalog import query
from ionloom.operators import filters, inference
from ionloom.session import table
from ionloom.sources import regions
from ionloom.storage import temporary

_CELLS = """c AS (SELECT l_suppkey AS id, month(l_shipdate) AS subject, l_returnflag AS condition, avg(l_quantity) AS v FROM lineitem GROUP BY ALL), kk AS (SELECT id, count(DISTINCT condition) AS k FROM c GROUP BY 1),
w AS (SELECT id, subject FROM c JOIN kk USING (id) GROUP BY id, subject, k HAVING count(*) = k), h AS (SELECT c.* FROM c JOIN w USING (id, subject)),
g AS (SELECT id, avg(v) AS m, count(DISTINCT subject) AS n, count(DISTINCT condition) AS k, sum(v * v) - count(*) * avg(v) ** 2 AS total FROM h GROUP BY 1),
b AS (SELECT id, sum(n * (mc - m) ** 2) AS between_ FROM (SELECT id, condition, avg(v) AS mc FROM h GROUP BY ALL) JOIN g USING (id) GROUP BY 1), s AS (SELECT id, sum(k * (ms - m) ** 2) AS subjects FROM (SELECT id, subject, avg(v) AS ms FROM h GROUP BY ALL) JOIN g USING (id) GROUP BY 1),
cv AS (SELECT x.id, x.condition AS a, y.condition AS b, covar_samp(x.v, y.v) AS s FROM h x JOIN h y ON x.id = y.id AND x.subject = y.subject GROUP BY ALL), rw AS (SELECT id, a, avg(s) AS mean, sum(s * s) AS squares, max(s) FILTER (WHERE a = b) AS own FROM cv GROUP BY ALL),
sp AS (SELECT id, avg(own) AS dg, avg(mean) AS gm, sum(squares) AS sq, sum(mean * mean) AS rs FROM rw GROUP BY 1)"""


@query(f"""WITH {_CELLS}, e AS (SELECT id, n, k, (between_ / (k - 1)) / ((total - between_ - subjects) / ((k - 1) * (n - 1))) AS f, least(1, greatest(1 / (k - 1), (k * (dg - gm)) ** 2 / ((k - 1) * (sq - 2 * k * rs + k * k * gm * gm)))) AS epsilon FROM g JOIN b USING (id) JOIN s USING (id) JOIN sp USING (id) WHERE n >= 2 AND k >= 2)
SELECT id, n, k, round(f, 6) AS f, round(epsilon, 6) AS epsilon, round(epsilon * (k - 1), 6) AS df1, round(epsilon * (k - 1) * (n - 1), 6) AS df2 FROM e""")
def repeated_measures(spark, d):
    """Suppliers measured every month under three flags; p, which SQL has no function for, is left to a test."""
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.month("l_shipdate").alias("subject"), F.col("l_returnflag").alias("condition"), F.col("l_quantity").alias("value"))
    found = inference.repeated_measures(rows)
    return found.select("id", "n", "k", *(F.round(c, 6).alias(c) for c in ("f", "epsilon", "df1", "df2")))


_STEPS = {"quantity": [1.0, 10.0, 20.0, 30.0, 40.0, 45.0, 50.0], "discount": [0.0, 0.02, 0.05, 0.08], "tax": [0.0, 0.01, 0.04, 0.07]}
_JOINT = "WITH " + ", ".join(f"{s} AS (SELECT unnest({v})::DOUBLE AS {s})" for s, v in _STEPS.items()) + """, p AS (SELECT l_quantity::DOUBLE AS q, l_discount::DOUBLE AS d, l_tax::DOUBLE AS t, l_returnflag = 'R' AS decoy FROM lineitem),
j AS (SELECT quantity, discount, tax, count(*) FILTER (WHERE NOT decoy) AS targets, count(*) FILTER (WHERE decoy) AS decoys FROM quantity, discount, tax LEFT JOIN p ON q >= quantity AND d >= discount AND t >= tax GROUP BY ALL)"""


def _joint(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").cast("double").alias("discount"), F.col("l_tax").cast("double").alias("tax"), (F.col("l_returnflag") == "R").alias("is_decoy"))
    return filters.joint_counts(rows, list(_STEPS), _STEPS, F.col("is_decoy"))


@query(_JOINT + " SELECT * FROM j")
def joint_threshold_counts(spark, d):
    """Targets and decoys that reach each combination of three thresholds."""
    return _joint(spark, d)


@query(_JOINT + " SELECT * FROM j WHERE targets > 0 AND decoys <= 0.32 * targets ORDER BY targets DESC, decoys, quantity, discount, tax LIMIT 1")
def best_thresholds(spark, d):
    return filters.best_thresholds(_joint(spark, d), list(_STEPS), 0.32)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag AS run, floor(l_extendedprice / 5000) AS bin, l_quantity > 25 AS trusted, l_extendedprice::DOUBLE AS theoretical, l_extendedprice::DOUBLE * (1 + l_tax * 1e-4) AS mass FROM lineitem),
e AS (SELECT *, (mass - theoretical) / theoretical * 1e6 AS ppm FROM r), n AS (SELECT run, bin, median(ppm) AS near FROM e WHERE trusted GROUP BY ALL), w AS (SELECT run, median(ppm) AS whole FROM e WHERE trusted GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(ppm, 4) + 0.0 AS ppm, round(ppm - coalesce(near, whole, 0), 4) + 0.0 AS ppm_corrected FROM e LEFT JOIN n USING (run, bin) LEFT JOIN w USING (run)""")
def recalibrated_masses(spark, d):
    price = F.col("l_extendedprice").cast("double")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("run"), price.alias("theoretical"), (price * (1 + F.col("l_tax") * 1e-4)).alias("mass"), (F.col("l_quantity") > 25).alias("sure"))
    found = filters.recalibrated(rows, "run", "mass", "theoretical", F.col("sure"), 5000.0)
    return found.select("l_orderkey", "l_linenumber", (F.round("ppm", 4) + F.lit(0.0)).alias("ppm"), (F.round("ppm_corrected", 4) + F.lit(0.0)).alias("ppm_corrected"))


@query("""WITH f AS (SELECT l_returnflag AS seqid, l_partkey * 10 AS start, l_partkey * 10 + l_quantity::BIGINT AS "end", l_orderkey, l_linenumber FROM lineitem)
SELECT seqid, start, "end", l_orderkey, l_linenumber FROM f WHERE (seqid = 'A' AND start <= 1200 AND "end" >= 700) OR (seqid = 'N' AND start <= 345 AND "end" >= 300)""")
def indexed_regions(spark, d):
    """All lines as features, written in blocks with an index, and two regions read back from their blocks."""
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("seqid"), (F.col("l_partkey") * 10).cast("long").alias("start"), (F.col("l_partkey") * 10 + F.col("l_quantity").cast("long")).cast("long").alias("end"), "l_orderkey", "l_linenumber")
    folder = temporary(spark, "regions")
    regions.write_indexed(rows, folder, 5_000)
    return regions.read_region(spark, folder, "A", 700, 1200).unionByName(regions.read_region(spark, folder, "N", 300, 345))
