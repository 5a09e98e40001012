"""Statistics over long tables (id, sample, value): sufficient statistics in Spark, only tail functions in NumPy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ionloom.operators.ordered import WINDOW_ROWS, medians, row_numbers

# ---- tails ----


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Lentz's continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps + 1):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + k * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + k / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    return h


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def incomplete_beta(a, b, x) -> np.ndarray:
    """Regularised incomplete beta function."""
    a, b, x = (np.asarray(v, float) for v in np.broadcast_arrays(a, b, x))
    inside = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(a * np.log(inside) + b * np.log1p(-inside) + _lgamma(a + b) - _lgamma(a) - _lgamma(b))
    left = x < (a + 1) / (a + b + 2)
    out = np.where(left, front * _beta_fraction(np.where(left, a, b), np.where(left, b, a), np.where(left, inside, 1 - inside)) / np.where(left, a, b), 0)
    out = np.where(left, out, 1 - front * _beta_fraction(np.where(left, a, b), np.where(left, b, a), np.where(left, inside, 1 - inside)) / b)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def t_tail(t, df) -> np.ndarray:
    """Two-sided p of Student's t."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def chi2_tail(x, df) -> np.ndarray:
    """Upper tail of chi-squared for each x and its df, by the series of the incomplete gamma function, of all values at
    once and only as far as it still changes one."""
    x, a = np.broadcast_arrays(np.asarray(x, float) / 2, np.asarray(df, float) / 2)
    term = total = np.where(x > 0, 1 / a, 0.0)
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        for k in range(1, 2000):
            term = term * x / (a + k)
            before, total = total, total + term
            if np.array_equal(before, total, equal_nan=True) and not ((x > a + k) & np.isfinite(total)).any():  # terms fall from here on
                break
        low = np.where(np.isposinf(total), 1.0, total * np.exp(-x + a * np.log(np.where(x > 0, x, 1)) - _lgamma(a)))  # a sum beyond floats leaves no tail
    return np.clip(1 - np.where(x > 0, low, 0), 0, 1)


def trigamma_inverse(x: float) -> float:
    """y with trigamma(y) = x, by Newton's method."""

    def poly(y: float, order: int) -> float:
        total = 0.0
        while y < 12:
            total += 1 / y**2 if order == 1 else -2 / y**3
            y += 1
        if order == 1:
            return total + 1 / y + 1 / (2 * y**2) + 1 / (6 * y**3) - 1 / (30 * y**5) + 1 / (42 * y**7)
        return total - 1 / y**2 - 1 / y**3 - 1 / (2 * y**4) + 1 / (6 * y**6) - 1 / (6 * y**8)

    if x > 1e7:
        return 1 / math.sqrt(x)
    if x < 1e-6:
        return 1 / x
    y = 0.5 + 1 / x
    for _ in range(50):
        t = poly(y, 1)
        step = t * (1 - t / x) / poly(y, 2)
        y += step
        if -step / y < 1e-10:
            break
    return y


def _digamma(y: float) -> float:
    total = 0.0
    while y < 12:
        total -= 1 / y
        y += 1
    return total + math.log(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6)


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p; null where the statistic is."""
    good = t.notna() & df.notna() & (df > 0)
    out = pd.Series(np.nan, index=t.index)
    out[good] = t_tail(t[good], df[good])
    return out


# ---- normalisation and imputation ----


def median_normalise(long: DataFrame) -> DataFrame:
    """Every sample scaled to the median of all values; 0 is missing."""
    seen = long.withColumn("value", F.when(F.col("value") != 0, F.col("value")))
    own, whole = medians(seen, "value", ("sample",), "own"), medians(seen, "value", (), "whole")
    scaled = seen.join(F.broadcast(own), "sample", "left").crossJoin(F.broadcast(whole))  # a row for each sample; one row
    return scaled.select("id", "sample", (F.col("value") * F.col("whole") / F.col("own")).alias("value"))


def mean_normalise(long: DataFrame) -> DataFrame:
    """Values over their sample's mean, for ids that every sample has."""
    n = long.select(F.count_distinct("sample").alias("n"))
    whole = long.where(F.col("value").isNotNull()).groupBy("id").agg(F.count_distinct("sample").alias("own")).crossJoin(F.broadcast(n)).where("own = n").select("id")
    kept = long.join(whole, "id", "left_semi")
    means = kept.groupBy("sample").agg(F.avg("value").alias("mean"))
    return kept.join(F.broadcast(means), "sample").select("id", "sample", (F.col("value") / F.col("mean")).alias("value"))


def impute_low(long: DataFrame, seed: int, shift: float = 1.8, width: float = 0.3) -> DataFrame:
    """Missing values drawn from a normal ``shift`` deviations below the sample's mean, ``width`` deviations wide.

    Draws are hashes of the seed, the id and the sample, so that a rerun, however the rows are dealt, gives the same."""
    uniform = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col("id"), F.col("sample")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    normal = F.sqrt(-2 * F.log(uniform(0))) * F.cos(2 * math.pi * uniform(1))
    parts = long.groupBy("sample").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    drawn = F.col("m") - shift * F.col("s") + width * F.col("s") * normal
    return long.join(F.broadcast(parts), "sample").select("id", "sample", F.coalesce("value", drawn).alias("value"))


def quantile_normalise(long: DataFrame) -> DataFrame:
    """Every sample gets the mean over samples of the values of its rank; ties by id."""
    ranked = row_numbers(long.where(F.col("value").isNotNull()), "value", ("id",), "place", descending=False, within=("sample",))
    level = ranked.groupBy("place").agg(F.avg("value").alias("level"))
    return ranked.join(level, "place").select("id", "sample", F.col("level").alias("value"))


#: Features of a block in a nearest-neighbour comparison, and lists merged by one node of the tree.
BLOCK_FEATURES, FAN_IN = 512, 16


def _nearest_tile(k: int):
    """For each missing cell of the open features the k nearest of the block's features that have the cell's sample."""

    def run(open_: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(open_) and len(block):
            block = block.sort_values("id", kind="stable")
            q, x = (np.array([[np.nan if v is None else v for v in row] for row in rows], float) for rows in (open_["q_vector"], block["vector"]))
            ids, own = block["id"].tolist(), open_["q_id"].tolist()
            for i, row in enumerate(q):
                gap = (x - row) ** 2
                shared = np.sum(~np.isnan(gap), axis=1)
                far = np.where(shared > 0, np.nansum(gap, axis=1) / np.maximum(shared, 1), np.inf)
                far[[n for n, other in enumerate(ids) if other == own[i]]] = np.inf
                order = np.argsort(far, kind="stable")
                order = order[np.isfinite(far[order])]
                for j in np.flatnonzero(np.isnan(row)).tolist():
                    out += [(own[i], j, far[r], ids[r], x[r, j], block["block"].iat[0]) for r in order[~np.isnan(x[order, j])][:k].tolist()]
        return pd.DataFrame(out, columns=["id", "pos", "far", "near_id", "value", "list_id"])

    return run


def impute_nearest(long: DataFrame, k: int = 5) -> DataFrame:
    """Missing values as the sample's mean of the k features that are nearest over the shared samples, ties to the smaller id.

    Every feature with a missing value is compared with all others, in tiles of one block of each. Imputed values don't
    serve as neighbours' values. A value that no feature can give stays null, and so does all of a feature without values."""
    samples = [r.sample for r in long.select("sample").where(F.col("sample").isNotNull()).distinct().sort("sample").collect()]  # a row for each
    if not samples:
        return long.select("id", "sample", F.col("value").cast("double").alias("value"))
    kind = {f.name: f.dataType.simpleString() for f in long.schema}
    given = F.map_from_entries(F.collect_list(F.struct("sample", F.nanvl(F.col("value").cast("double"), F.lit(None)).alias("value"))))
    names = F.array(*(F.lit(s).cast(kind["sample"]) for s in samples))
    wide = long.where(F.col("sample").isNotNull()).groupBy("id").agg(given.alias("values"))
    wide = wide.select("id", F.transform(names, lambda s: F.try_element_at("values", s)).alias("vector"))
    is_open = F.exists("vector", lambda x: x.isNull())
    n, n_open = wide.select(F.count("*"), F.count_if(is_open)).first()
    blocks, tiles = max(1, math.ceil(n / BLOCK_FEATURES)), max(1, math.ceil(n_open / BLOCK_FEATURES))
    part = lambda m: F.pmod(F.xxhash64("id"), F.lit(m))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<long>"))
    asked = wide.where(is_open & F.exists("vector", lambda x: x.isNotNull())).select(F.col("id").alias("q_id"), F.col("vector").alias("q_vector"), every(blocks).alias("q_block"), part(tiles).alias("q_tile"))
    held = wide.withColumn("block", part(blocks)).withColumn("tile", every(tiles))
    lists = asked.groupBy("q_block", "q_tile").cogroup(held.groupBy("block", "tile")).applyInPandas(_nearest_tile(k), f"id {kind['id']}, pos int, far double, near_id {kind['id']}, value double, list_id long")
    best = F.slice(F.sort_array(F.collect_list(F.struct("far", "near_id", "value"))), 1, k).alias("best")
    while blocks > 1:  # each level merges FAN_IN lists of at most k features
        blocks = math.ceil(blocks / FAN_IN)
        merged = lists.groupBy("id", "pos", F.floor(F.col("list_id") / FAN_IN).alias("list_id")).agg(best)
        lists = merged.select("id", "pos", "list_id", F.inline("best"))
    near = lists.groupBy("id", "pos").agg(best).select(F.col("id").alias("i_"), F.col("pos").alias("p_"), (F.aggregate("best", F.lit(0.0), lambda s, b: s + b["value"]) / F.size("best")).alias("mean"))
    cells = wide.select("id", F.posexplode("vector").alias("pos", "value"))
    return cells.join(near, cells["id"].eqNullSafe(near["i_"]) & (cells["pos"] == near["p_"]), "left").select("id", F.element_at(names, F.col("pos") + 1).alias("sample"), F.coalesce("value", "mean").alias("value"))


# ---- tests ----


def group_moments(long: DataFrame, a: str, b: str) -> DataFrame:
    """n, mean and variance of two groups for each id; ``long`` is (id, grp, value)."""
    of = lambda g: F.when(F.col("grp") == F.lit(g), F.col("value"))
    moments = [f(of(g)).alias(f"{n}_{k}") for k, g in (("a", a), ("b", b)) for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))]
    return long.groupBy("id").agg(*moments)


def t_test(long: DataFrame, treated: str, control: str, welch: bool = False) -> DataFrame:
    """id, log_fc (treated - control), t and df; null where a group has fewer than two values or nothing varies."""
    m = group_moments(long, treated, control).where("n_a >= 2 AND n_b >= 2")
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    diff = F.col("mean_a") - F.col("mean_b")
    if welch:
        error, df = F.sqrt(va + vb), F.try_divide((va + vb) ** 2, va**2 / (F.col("n_a") - 1) + vb**2 / (F.col("n_b") - 1))
    else:
        df = (F.col("n_a") + F.col("n_b") - 2).cast("double")
        pooled = ((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / df
        error = F.sqrt(pooled * (1 / F.col("n_a") + 1 / F.col("n_b")))
    return m.select("id", diff.alias("log_fc"), F.try_divide(diff, error).alias("t"), df.alias("df"))


def by_key(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows, dealt by key into so many parts that a task sorts some WINDOW_ROWS of them, whatever the
    number of shuffle partitions; a key lies in one part."""
    n = 1 + rows // WINDOW_ROWS
    return df if n == 1 else df.repartition(max(n, df.sparkSession.sparkContext.defaultParallelism), *keys)


def average_ranks(df: DataFrame, keys: list[str], value: str, name: str, rows: int | None = None) -> DataFrame:
    """Ranks within each key, ties sharing their mean. ``df`` has ``rows`` rows, which are counted where that isn't known."""
    return _average_ranks(by_key(df, keys, df.count() if rows is None else rows), keys, value, name)


def _average_ranks(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy(value)
    same = Window.partitionBy(*keys, value)
    return df.withColumn(name, F.rank().over(over) + (F.count("*").over(same) - 1) / 2)


def rank_sum(long: DataFrame, a: str, b: str) -> DataFrame:
    """id, u (Mann-Whitney of group a) and z without continuity correction, ties not corrected for."""
    ranked = average_ranks(long.where(F.col("grp").isin(a, b) & F.col("value").isNotNull()), ["id"], "value", "r")
    sums = ranked.groupBy("id").agg(F.sum(F.when(F.col("grp") == a, F.col("r"))).alias("rs"), F.count_if(F.col("grp") == a).alias("na"), F.count_if(F.col("grp") == b).alias("nb"))
    u = F.col("rs") - F.col("na") * (F.col("na") + 1) / 2
    spread = F.sqrt(F.col("na") * F.col("nb") * (F.col("na") + F.col("nb") + 1) / 12)
    return sums.where("na > 0 AND nb > 0").select("id", u.alias("u"), F.try_divide(u - F.col("na") * F.col("nb") / 2, spread).alias("z"))


def kruskal_wallis(long: DataFrame) -> DataFrame:
    """id, h (corrected for ties) and df over all groups of (id, grp, value)."""
    ranked = average_ranks(long.where(F.col("value").isNotNull()), ["id"], "value", "r")
    groups = ranked.groupBy("id", "grp").agg((F.sum("r") ** 2 / F.count("*")).alias("part"), F.count("*").alias("n"))
    ties = ranked.groupBy("id", "value").agg(F.count("*").alias("t")).groupBy("id").agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("ties"))
    whole = groups.groupBy("id").agg(F.sum("part").alias("s"), F.sum("n").alias("n"), (F.count("*") - 1).alias("df")).join(ties, "id")
    n = F.col("n").cast("double")
    h = 12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    return whole.where("df > 0").select("id", F.try_divide(h, 1 - F.col("ties") / (n**3 - n)).alias("h"), F.col("df").cast("bigint").alias("df"))


def correlations(pairs: DataFrame) -> DataFrame:
    """id, pearson and spearman of (id, x, y)."""
    whole = pairs.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    dealt = by_key(whole, ["id"], whole.count())
    ranked = _average_ranks(_average_ranks(dealt, ["id"], "x", "rx"), ["id"], "y", "ry")
    return ranked.groupBy("id").agg(F.corr("x", "y").alias("pearson"), F.corr("rx", "ry").alias("spearman"))


def variance_prior(rows: DataFrame) -> tuple[float, float] | None:
    """(degrees of freedom, variance) of the prior that the rows' variances (s2, df) suggest; None without a variance."""
    mean, var, d = rows.where("s2 > 0").agg(F.avg(F.log("s2")), F.var_samp(F.log("s2")), F.avg("df")).first()
    if mean is None:
        return None
    e_mean = mean - _digamma(d / 2) + math.log(d / 2)
    excess = (var or 0.0) - _trigamma(d / 2)
    d0 = 2 * trigamma_inverse(excess) if excess > 0 else math.inf
    return d0, math.exp(e_mean + _digamma(d0 / 2) - math.log(d0 / 2)) if math.isfinite(d0) else math.exp(e_mean)


def moderated_t(long: DataFrame, treated: str, control: str) -> DataFrame:
    """id, log_fc, t and df with each row's variance shrunk to a common prior (the published empirical-Bayes method).

    The prior's two numbers come from the mean and variance of log variances, one aggregate over all rows."""
    m = group_moments(long, treated, control).where("n_a >= 2 AND n_b >= 2")
    df = (F.col("n_a") + F.col("n_b") - 2).cast("double")
    s2 = ((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / df
    rows = m.withColumn("df", df).withColumn("s2", s2)
    prior = variance_prior(rows)
    if prior is None:
        return rows.select("id", (F.col("mean_a") - F.col("mean_b")).alias("log_fc"), F.lit(None).cast("double").alias("t"), "df")
    d0, s0 = prior
    shrunk = (F.lit(d0) * s0 + F.col("df") * F.col("s2")) / (F.lit(d0) + F.col("df")) if math.isfinite(d0) else F.lit(s0)
    diff = F.col("mean_a") - F.col("mean_b")
    return rows.select("id", diff.alias("log_fc"), F.try_divide(diff, F.sqrt(shrunk * (1 / F.col("n_a") + 1 / F.col("n_b")))).alias("t"), (F.col("df") + F.lit(d0)).alias("df"))


def _trigamma(y: float) -> float:
    total = 0.0
    while y < 12:
        total += 1 / y**2
        y += 1
    return total + 1 / y + 1 / (2 * y**2) + 1 / (6 * y**3) - 1 / (30 * y**5) + 1 / (42 * y**7)


def storey_q(df: DataFrame, p: str, key: str, cut: float = 0.5) -> DataFrame:
    """Benjamini-Hochberg times the share of true nulls that the p above ``cut`` suggest."""
    from ionloom.operators.relational import benjamini_hochberg

    share = df.where(F.col(p).isNotNull()).agg(F.least(F.lit(1.0), F.count_if(F.col(p) > cut) / (F.count("*") * (1 - cut))).alias("share_"))
    return benjamini_hochberg(df, p, key).crossJoin(F.broadcast(share)).select(key, p, (F.col("adjusted") * F.col("share_")).alias("q"))  # one row


def enrichment(values: DataFrame, sets: DataFrame, least: int = 2) -> DataFrame:
    """term, n, mean and t of the members' values against all values (two samples, equal variance ignored).

    ``values`` is (member, value), one value for each member; ``sets`` is (term, member)."""
    whole = values.agg(F.count("value").alias("n0"), F.avg("value").alias("m0"), F.var_samp("value").alias("v0"))
    own = sets.distinct().join(values, "member").groupBy("term").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var")).where(F.col("n") >= least)
    t = F.try_divide(F.col("mean") - F.col("m0"), F.sqrt(F.col("var") / F.col("n") + F.col("v0") / F.col("n0")))
    return own.crossJoin(F.broadcast(whole)).select("term", "n", "mean", t.alias("t"))  # one row


def threshold_grid(psms: DataFrame, score: str, decoy: Column, cuts: list[float]) -> DataFrame:
    """Targets, decoys and percentage of decoys at each cut of a score, in one pass over the rows."""
    cells = [F.struct(F.lit(float(c)).alias("cut"), F.count_if((F.col(score) >= c) & ~decoy).alias("targets"), F.count_if((F.col(score) >= c) & decoy).alias("decoys")) for c in cuts]
    grid = psms.agg(F.array(*cells).alias("grid")).select(F.inline("grid"))
    return grid.withColumn("fdr", F.round(F.try_divide(100 * F.col("decoys"), F.col("targets") + F.col("decoys")), 6))
