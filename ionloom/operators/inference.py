"""Tests with their p values, and tests of several groups, over long tables (id, grp, value).

Spark forms each id's sufficient statistics; tail functions alone are evaluated in NumPy, a batch of rows at a time.
Ids without enough values have no row, and a statistic that nothing varies in is null, as is its p.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ionloom.operators.annotation import dunn
from ionloom.operators.stats import average_ranks, chi2_tail, correlations, group_moments, incomplete_beta, kruskal_wallis, t_p_value, t_tail, variance_prior
from ionloom.storage import materialize

_erfc = np.vectorize(math.erfc, otypes=[float])


def _by_row(tail, *columns: pd.Series) -> pd.Series:
    good = np.logical_and.reduce([c.notna() for c in columns])
    out = pd.Series(np.nan, index=columns[0].index)
    if good.any():
        out[good] = tail(*(c[good].to_numpy(float) for c in columns))
    return out


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal statistic."""
    return _by_row(lambda x: _erfc(np.abs(x) / math.sqrt(2)), z)


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of chi-squared."""
    return _by_row(chi2_tail, x, df)


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """Upper tail of Fisher's F."""
    return _by_row(lambda x, a, b: incomplete_beta(b / 2, a / 2, b / (b + a * x)), f, df1, df2)


@F.pandas_udf(DoubleType())
def normal_quantile(p: pd.Series) -> pd.Series:
    return _by_row(np.vectorize(NormalDist().inv_cdf, otypes=[float]), p)


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(48)


def studentized_range_tail(q: np.ndarray, groups: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(range of ``groups`` normal means over their pooled deviation > q), by two Gauss-Legendre integrals."""
    phi = lambda x: 0.5 * _erfc(-x / math.sqrt(2))
    z = 8 * _NODES
    density, below = np.exp(-z * z / 2) / math.sqrt(2 * math.pi), phi(z)
    out = np.empty(len(q))
    for i, (width, k, nu) in enumerate(zip(q, groups, df, strict=True)):
        spread = 8 / math.sqrt(2 * nu)
        low, high = max(1e-9, 1 - spread), 1 + spread + 2 / nu
        s = (high - low) / 2 * _NODES + (high + low) / 2
        log_density = math.log(2) + nu / 2 * math.log(nu / 2) - math.lgamma(nu / 2) + (nu - 1) * np.log(s) - nu * s * s / 2
        inner = k * (density * (below[None, :] - phi(z[None, :] - width * s[:, None])) ** (k - 1)) @ (8 * _WEIGHTS)
        out[i] = 1 - np.sum(np.exp(log_density) * inner * _WEIGHTS) * (high - low) / 2
    return np.clip(out, 0, 1)


@F.pandas_udf(DoubleType())
def tukey_p(q: pd.Series, groups: pd.Series, df: pd.Series) -> pd.Series:
    return _by_row(studentized_range_tail, q, groups, df)


def correlation_test(pairs: DataFrame) -> DataFrame:
    """id, pearson, t, df and p of (id, x, y)."""
    n = pairs.where(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("id").agg((F.count("*") - 2).cast("double").alias("df")).where("df > 0")
    r = F.col("pearson")
    tested = correlations(pairs).join(n, "id").withColumn("t", F.try_divide(r * F.sqrt("df"), F.sqrt(1 - r * r)))
    return tested.select("id", "pearson", "t", "df", t_p_value("t", "df").alias("p"))


def rank_sum_test(long: DataFrame, a: str, b: str) -> DataFrame:
    """id, u (Mann-Whitney of group a), z and p by the normal approximation, corrected for ties and continuity."""
    ranked = average_ranks(long.where(F.col("grp").isin(a, b) & F.col("value").isNotNull()), ["id"], "value", "r")
    ties = ranked.groupBy("id", "value").agg(F.count("*").alias("t")).groupBy("id").agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("ties"))
    sums = ranked.groupBy("id").agg(F.sum(F.when(F.col("grp") == a, F.col("r"))).alias("rs"), F.count_if(F.col("grp") == a).cast("double").alias("na"), F.count_if(F.col("grp") == b).cast("double").alias("nb"))
    na, nb, n = F.col("na"), F.col("nb"), F.col("na") + F.col("nb")
    u = F.col("rs") - na * (na + 1) / 2
    off = u - na * nb / 2
    spread = F.sqrt(na * nb / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    tested = sums.where("na > 0 AND nb > 0").join(ties, "id").select("id", u.alias("u"), F.try_divide(off - F.signum(off) / 2, spread).alias("z"))
    return tested.withColumn("p", normal_p("z"))


def kruskal_test(long: DataFrame) -> DataFrame:
    """id, h, df and p."""
    return kruskal_wallis(long).withColumn("p", chi2_p("h", F.col("df").cast("double")))


def dunn_test(long: DataFrame) -> DataFrame:
    """id, a, b, z, p, and p adjusted over the pairs of the id (Benjamini-Hochberg)."""
    tested = dunn(long).withColumn("p", normal_p("z")).where(F.col("p").isNotNull() & ~F.isnan("p"))
    own = Window.partitionBy("id")  # the pairs of an id's groups, which are few
    ties = F.count("*").over(Window.partitionBy("id", "p")) - 1
    raw = F.col("p") * F.count("*").over(own) / (F.rank().over(own.orderBy("p")) + ties)
    least = F.min("raw").over(own.orderBy(F.desc("p")).rangeBetween(Window.unboundedPreceding, 0))
    return tested.withColumn("raw", raw).select("id", "a", "b", "z", "p", F.least(F.lit(1.0), least).alias("adjusted"))


def _t_upper(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    return np.where(t >= 0, t_tail(t, df) / 2, 1 - t_tail(t, df) / 2)


@F.pandas_udf(DoubleType())
def one_sided_t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of Student's t."""
    return _by_row(_t_upper, t, df)


def threshold_test(long: DataFrame, treated: str, control: str, least: float) -> DataFrame:
    """id, log_fc, df and p of a change beyond ``least`` in either direction."""
    m = group_moments(long, treated, control).where("n_a >= 2 AND n_b >= 2")
    df = (F.col("n_a") + F.col("n_b") - 2).cast("double")
    error = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / df * (1 / F.col("n_a") + 1 / F.col("n_b")))
    diff = F.col("mean_a") - F.col("mean_b")
    rows = m.select("id", diff.alias("log_fc"), df.alias("df"), F.try_divide(F.abs(diff) - least, error).alias("near"), F.try_divide(F.abs(diff) + least, error).alias("far"))
    return rows.select("id", "log_fc", "df", (one_sided_t_p("near", "df") + one_sided_t_p("far", "df")).alias("p"))


def enrichment_test(values: DataFrame, sets: DataFrame, least: int = 2) -> DataFrame:
    """term, n, mean, t, df, p_up and p_down of the members' values against all values (unequal variances).

    ``values`` is (member, value), ``sets`` is (term, member). Of rows that repeat a member the largest value counts."""
    one = values.where(F.col("value").isNotNull()).groupBy("member").agg(F.max("value").alias("value"))
    whole = one.agg(F.count("value").alias("n0"), F.avg("value").alias("m0"), F.var_samp("value").alias("v0"))
    own = sets.distinct().join(one, "member").groupBy("term").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var")).where(F.col("n") >= least)
    a, b = F.col("var") / F.col("n"), F.col("v0") / F.col("n0")
    rows = own.crossJoin(F.broadcast(whole)).select("term", "n", "mean", F.try_divide(F.col("mean") - F.col("m0"), F.sqrt(a + b)).alias("t"), F.try_divide((a + b) ** 2, a**2 / (F.col("n") - 1) + b**2 / (F.col("n0") - 1)).alias("df"))  # one row
    return rows.withColumn("p_up", one_sided_t_p("t", "df")).withColumn("p_down", 1 - F.col("p_up"))


def _groups(long: DataFrame) -> DataFrame:
    """(id, grp, n, mean, var) of groups with values."""
    return long.where(F.col("value").isNotNull()).groupBy("id", "grp").agg(F.count("*").cast("double").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))


def anova(long: DataFrame) -> DataFrame:
    """id, f, df1, df2 and p of a one-way analysis of variance."""
    own = _groups(long)
    whole = own.groupBy("id").agg(F.count("*").alias("k"), F.sum("n").alias("all"), (F.sum(F.col("n") * F.col("mean") ** 2) - F.sum(F.col("n") * F.col("mean")) ** 2 / F.sum("n")).alias("between"), F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("within"))
    rows = whole.select("id", (F.col("k") - 1).cast("double").alias("df1"), (F.col("all") - F.col("k")).alias("df2"), "between", "within").where("df1 > 0 AND df2 > 0")
    return rows.select("id", F.try_divide(F.col("between") / F.col("df1"), F.col("within") / F.col("df2")).alias("f"), "df1", "df2").withColumn("p", f_p("f", "df1", "df2"))


def bartlett(long: DataFrame) -> DataFrame:
    """id, k2, df and p of equal variances, over the groups with at least two values."""
    own = _groups(long).where("n >= 2").withColumn("d", F.col("n") - 1)
    logs = F.sum(F.col("d") * F.when(F.col("var") > 0, F.log("var")))
    whole = own.groupBy("id").agg(F.count("*").alias("k"), F.sum("d").alias("all"), F.try_divide(F.sum(F.col("d") * F.col("var")), F.sum("d")).alias("pooled"), logs.alias("logs"), F.sum(1 / F.col("d")).alias("parts"), F.min("var").alias("least"))
    k = F.col("k").cast("double")
    k2 = (F.col("all") * F.log("pooled") - F.col("logs")) / (1 + (F.col("parts") - 1 / F.col("all")) / (3 * (k - 1)))
    return whole.where("k > 1 AND least > 0").select("id", k2.alias("k2"), (k - 1).alias("df")).withColumn("p", chi2_p("k2", "df"))


def fligner(long: DataFrame) -> DataFrame:
    """id, x2, df and p of the rank test of equal variances, about the groups' medians."""
    seen = long.where(F.col("value").isNotNull()).select("id", "grp", F.col("value").cast("double").alias("value"))
    centred = seen.join(seen.groupBy("id", "grp").agg(F.median("value").alias("mid")), ["id", "grp"]).select("id", "grp", F.abs(F.col("value") - F.col("mid")).alias("far"))
    ranked = average_ranks(centred, ["id"], "far", "r", seen.count()).withColumn("n", F.count("*").over(Window.partitionBy("id")))
    scored = ranked.withColumn("score", normal_quantile(0.5 + F.col("r") / (F.col("n") + 1) / 2))
    moments = scored.groupBy("id").agg(F.avg("score").alias("level"), F.var_samp("score").alias("spread"))
    own = scored.groupBy("id", "grp").agg(F.count("*").alias("n"), F.avg("score").alias("mean")).join(moments, "id")
    rows = own.groupBy("id").agg((F.count("*") - 1).cast("double").alias("df"), F.try_divide(F.sum(F.col("n") * (F.col("mean") - F.col("level")) ** 2), F.max("spread")).alias("x2")).where("df > 0")
    return rows.select("id", "x2", "df", chi2_p("x2", "df").alias("p"))


def tukey(long: DataFrame) -> DataFrame:
    """id, a, b (a < b), diff (a - b), q, df and p of every pair of groups, by the studentized range."""
    own = _groups(long)
    whole = own.groupBy("id").agg(F.count("*").cast("double").alias("k"), (F.sum("n") - F.count("*")).alias("df"), F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("within")).where("k > 1 AND df > 0")
    side = lambda s: own.select("id", F.col("grp").alias(s), F.col("mean").alias(f"m{s}"), F.col("n").alias(f"n{s}"))
    pairs = side("a").join(side("b"), "id").where("a < b").join(whole, "id")  # the groups of one id, which are few
    diff = F.col("ma") - F.col("mb")
    error = F.sqrt(F.col("within") / F.col("df") / 2 * (1 / F.col("na") + 1 / F.col("nb")))
    return pairs.select("id", "a", "b", diff.alias("diff"), F.try_divide(F.abs(diff), error).alias("q"), "k", "df").withColumn("p", tukey_p("q", "k", "df")).drop("k")


def _solve(weights: list[list[float]], size: int):
    """Least squares of every id from its sums, and each contrast's estimate and unscaled variance."""

    def run(frames):
        c = np.array(weights, float)
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                xx, xy = np.array(r.xx, float).reshape(size, size), np.array(r.xy, float)
                if np.linalg.matrix_rank(xx) < size or r.n <= size:
                    continue
                inverse = np.linalg.inv(xx)
                beta, df = inverse @ xy, float(r.n - size)
                s2 = max(0.0, float(r.yy - xy @ beta)) / df
                out += [(r.id, k, float(w @ beta), float(w @ inverse @ w), s2, df) for k, w in enumerate(c)]
            yield pd.DataFrame(out, columns=["id", "k", "log_fc", "unscaled", "s2", "df"])

    return run


def moderated_contrasts(long: DataFrame, design: DataFrame, contrasts: dict[str, list[float]]) -> DataFrame:
    """id, contrast, log_fc, t, df and p of contrasts in a linear model of any design, variances shrunk to a common prior.

    ``long`` is (id, sample, value), ``design`` (sample, x): a row of the design matrix for each sample, which is small;
    ``contrasts`` names weights of its columns. Spark adds up each id's products; the few numbers of an id are solved in
    the tasks. Ids whose samples don't determine all columns, or leave nothing over, have no row."""
    size = len(next(iter(contrasts.values())))
    x = lambda i: F.get("x", F.lit(i))
    held = long.where(F.col("value").isNotNull()).join(F.broadcast(design), "sample")  # a row for each sample
    sums = held.groupBy("id").agg(
        F.array(*(F.sum(x(i) * x(j)) for i in range(size) for j in range(size))).alias("xx"), F.array(*(F.sum(x(i) * F.col("value")) for i in range(size))).alias("xy"),
        F.sum(F.col("value") * F.col("value")).alias("yy"), F.count("*").alias("n"),
    )
    kind = long.schema["id"].dataType.simpleString()
    fits = materialize(sums.mapInPandas(_solve(list(contrasts.values()), size), f"id {kind}, k int, log_fc double, unscaled double, s2 double, df double"), "contrasts")
    prior = variance_prior(fits.where("k = 0"))
    names = F.get(F.array(*(F.lit(n) for n in contrasts)), F.col("k")).alias("contrast")
    if prior is None:
        return fits.select("id", names, "log_fc", F.lit(None).cast("double").alias("t"), "df", F.lit(None).cast("double").alias("p"))
    d0, s0 = prior
    shrunk = (F.lit(d0 * s0) + F.col("df") * F.col("s2")) / (F.lit(d0) + F.col("df")) if math.isfinite(d0) else F.lit(s0)
    tested = fits.select("id", names, "log_fc", F.try_divide(F.col("log_fc"), F.sqrt(shrunk * F.col("unscaled"))).alias("t"), (F.col("df") + F.lit(d0)).alias("df"))
    return tested.withColumn("p", t_p_value("t", F.least("df", F.lit(1e10))))


def repeated_measures(long: DataFrame) -> DataFrame:
    """A within-subject analysis of variance with its sphericity correction: id, n, k, f, epsilon, df1, df2 and p.

    ``long`` is (id, subject, condition, value); cells are averaged, and the subjects of an id without one of its
    conditions are left out. ``epsilon`` is the correction by the covariances of the conditions, with which both degrees of
    freedom are multiplied before p is taken. Sums of squares and covariances are aggregates by id, condition and pair of
    conditions, so an id of many subjects is no group of its own. Ids with fewer than two subjects or conditions have no
    row; f and p are null where nothing varies within subjects."""
    cells = long.where(F.col("value").isNotNull()).groupBy("id", "subject", "condition").agg(F.avg("value").alias("value"))
    conditions = cells.groupBy("id").agg(F.count_distinct("condition").alias("k"))
    whole = cells.groupBy("id", "subject").agg(F.count("*").alias("own")).join(conditions, "id").where("own = k").select("id", "subject", "k")
    held = materialize(cells.join(whole, ["id", "subject"]), "repeated-cells")
    square = lambda keys, name: held.groupBy("id", *keys).agg(F.avg("value").alias("m"), F.count("*").alias("c")).groupBy("id").agg(F.sum("c").alias("all"), (F.sum(F.col("c") * F.col("m") ** 2) - F.sum(F.col("c") * F.col("m")) ** 2 / F.sum("c")).alias(name), F.count("*").alias(f"{name}_n"))
    by_condition, by_subject = square(["condition"], "between"), square(["subject"], "subjects").drop("all")
    total = held.groupBy("id").agg((F.var_pop("value") * F.count("*")).alias("total"))
    pair = lambda side: held.select("id", "subject", F.col("condition").alias(side), F.col("value").alias(f"v{side}"))
    shared = pair("a").join(pair("b"), ["id", "subject"]).groupBy("id", "a", "b").agg(F.covar_samp("va", "vb").alias("s"))
    rows = shared.groupBy("id", "a").agg(F.avg("s").alias("mean"), F.sum(F.col("s") ** 2).alias("squares"), F.sum("s").alias("sum"), F.max(F.when(F.col("a") == F.col("b"), F.col("s"))).alias("own"))
    spread = rows.groupBy("id").agg(F.avg("own").alias("diagonal"), F.avg("mean").alias("grand"), F.sum("squares").alias("squares"), F.sum(F.col("mean") ** 2).alias("row_squares"))
    k, n = F.col("between_n").cast("double"), F.col("subjects_n").cast("double")
    joined = by_condition.join(by_subject, "id").join(total, "id").join(spread, "id").where("between_n >= 2 AND subjects_n >= 2")
    rest = F.greatest(F.col("total") - F.col("between") - F.col("subjects"), F.lit(0.0))
    free = (k - 1) * (n - 1)
    corrected = (k * (F.col("diagonal") - F.col("grand"))) ** 2 / F.nullif((k - 1) * (F.col("squares") - 2 * k * F.col("row_squares") + k**2 * F.col("grand") ** 2), F.lit(0.0))
    epsilon = F.least(F.lit(1.0), F.greatest(1 / (k - 1), corrected))
    f = F.when(rest > 1e-12 * F.col("total"), (F.col("between") / (k - 1)) / (rest / free))
    out = joined.select("id", n.cast("long").alias("n"), k.cast("long").alias("k"), f.alias("f"), epsilon.alias("epsilon"))
    out = out.withColumn("df1", F.col("epsilon") * (F.col("k") - 1)).withColumn("df2", F.col("epsilon") * (F.col("k") - 1) * (F.col("n") - 1))
    return out.withColumn("p", F.when(F.col("f").isNotNull(), f_p("f", "df1", "df2")))
