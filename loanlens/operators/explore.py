"""Exploration and feature-selection statistics (D1, D3–D7, D15–D25, C1, E1,
E2, F1, F2, F6).

Statistics per feature are computed from one wide aggregate (or one
``groupBy(feature, class)`` over a stacked view whose partial aggregation
collapses rows map-side), so the result is bounded by features × classes ×
bins, never by rows.  Label codes come from a bounded distinct-value table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions.columns import round_ratio
from loanlens.functions.stats import f_upper_udf
from loanlens.operators.clean import listwise_drop
from loanlens.plans.prefix import exact_quantiles, numbered, prefix_sums
from loanlens.session import shared_table

# Fixed values of the reference's exploration rules.
LEAKAGE_PATTERNS = ["total_pymnt", "recoveries", "total_rec_", "out_prncp", "last_pymnt",
                    "hardship_", "settlement_"]
LEAKAGE_CORR = 0.3
MISSING_TIERS = ((40.0, "drop"), (5.0, "impute"), (0.0, "optional"))
MEAN_SHIFT_FLAG = 10.0


def target_rate_by(df: DataFrame, group: str | Column, target: str = "default") -> DataFrame:
    """Count, defaults and default rate per group."""
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target)).cast("bigint").alias("defaults"))
    return g.select("*", round_ratio(F.col("defaults"), F.col("n"), 6).alias("default_rate"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """D3: value counts with percent share (1 dp)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.select(col, "n", round_ratio(F.col("n") * 100, total, 1).alias("pct"))


def top_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """the k most frequent values (ties broken by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(col).asc_nulls_last()).limit(k))


def missing_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count, percent (1 dp) and action tier per column, sorted."""
    r = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)]
    long = r.select("_n", F.explode(F.array(*items)).alias("s")).select("s.feature", "s.missing", "_n")
    pct = round_ratio(F.col("missing") * 100, F.col("_n"), 1)
    tier = F.when(pct > MISSING_TIERS[0][0], "drop").when(pct > MISSING_TIERS[1][0], "impute") \
            .when(pct > MISSING_TIERS[2][0], "optional").otherwise("complete")
    return long.select("feature", "missing", pct.alias("pct"), tier.alias("action"))


def class_profile(df: DataFrame, cols: Sequence[str], target: str = "default") -> DataFrame:
    """Mean per class, transposed, percent difference vs class 0."""
    aggs = []
    for i, c in enumerate(cols):
        for k in (0, 1):
            aggs.append(F.avg(F.when(F.col(target) == k, F.col(c))).alias(f"_a{i}_{k}"))
    r = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"_a{i}_0").alias("mean_0"), F.col(f"_a{i}_1").alias("mean_1"))
             for i, c in enumerate(cols)]
    long = r.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    return long.select("feature", F.round("mean_0", 6).alias("mean_0"), F.round("mean_1", 6).alias("mean_1"),
                       F.round(F.try_divide(F.col("mean_1") - F.col("mean_0"), F.abs("mean_0")) * 100, 4).alias("pct_diff"))


def mean_shift(df: DataFrame, cols: Sequence[str], base: Column, later: Column, flag_pct: float = MEAN_SHIFT_FLAG) -> DataFrame:
    """Mean in the base period vs later periods, % change, flag above ``flag_pct``."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.when(base, F.col(c))).alias(f"_b{i}"), F.avg(F.when(later, F.col(c))).alias(f"_l{i}")]
    r = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"_b{i}").alias("base_mean"), F.col(f"_l{i}").alias("later_mean"))
             for i, c in enumerate(cols)]
    long = r.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    chg = F.try_divide(F.col("later_mean") - F.col("base_mean"), F.abs("base_mean")) * 100
    return long.select("feature", F.round("base_mean", 6).alias("base_mean"), F.round("later_mean", 6).alias("later_mean"),
                       F.round(chg, 4).alias("pct_change"), F.coalesce(F.abs(chg) > flag_pct, F.lit(False)).alias("flagged"))


def _pearson(x: Column, y: Column, i: int) -> list[Column]:
    both = x.isNotNull() & y.isNotNull()
    xv, yv = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return [F.count_if(both).alias(f"_n{i}"), F.sum(xv).alias(f"_sx{i}"), F.sum(yv).alias(f"_sy{i}"),
            F.sum(xv * xv).alias(f"_sxx{i}"), F.sum(yv * yv).alias(f"_syy{i}"), F.sum(xv * yv).alias(f"_sxy{i}")]


def _r_from_sums(i: int) -> Column:
    n, sx, sy = F.col(f"_n{i}"), F.col(f"_sx{i}"), F.col(f"_sy{i}")
    cov = F.col(f"_sxy{i}") - sx * sy / n
    vx = F.col(f"_sxx{i}") - sx * sx / n
    vy = F.col(f"_syy{i}") - sy * sy / n
    return F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], flag: float) -> DataFrame:
    """Pearson r of column pairs (pairwise NULL drop), one pass;
    undefined r (constant side) stays NULL and never flags."""
    aggs = [a for i, (x, y) in enumerate(pairs) for a in _pearson(F.col(x), F.col(y), i)]
    r = df.agg(*aggs)
    items = [F.struct(F.lit(x).alias("feature"), F.lit(y).alias("other"), _r_from_sums(i).alias("r"))
             for i, (x, y) in enumerate(pairs)]
    long = r.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    return long.select("feature", "other", F.round("r", 6).alias("correlation"),
                       F.coalesce(F.abs("r") > flag, F.lit(False)).alias("flagged"))


def leakage_report(df: DataFrame, target: str = "default", threshold: float | None = LEAKAGE_CORR) -> DataFrame:
    """Name-pattern flags first, then |r| with the target above the
    threshold for the remaining numeric columns.  ``threshold=0`` is honoured."""
    from pyspark.sql.types import NumericType
    t = LEAKAGE_CORR if threshold is None else threshold
    named = []
    for c in df.columns:
        for p in LEAKAGE_PATTERNS:
            if c.startswith(p):
                named.append((c, p))
                break
    flagged_names = {c for c, _ in named}
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)
            and f.name != target and f.name not in flagged_names]
    corr = correlations(df, [(c, target) for c in nums], t)
    rows = corr.select(F.col("feature").alias("name"),
                       F.when(F.col("flagged"), F.lit("correlation")).otherwise(F.lit("safe")).alias("reason"),
                       F.round("correlation", 4).alias("correlation"))
    if named:
        spark = df.sparkSession
        pat = spark.createDataFrame([(c, f"pattern:{p}", None) for c, p in named], "name string, reason string, correlation double")
        rows = pat.unionByName(rows)
    return rows


def _anova(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(feature, f, df2) from per-class n, Σx, Σx² after a list-wise NULL drop (one aggregate)."""
    d = listwise_drop(df, [*cols, target])
    aggs = [F.count_if(F.col(target) == k).alias(f"_n{k}") for k in (0, 1)]
    for i, c in enumerate(cols):
        for k in (0, 1):
            x = F.when(F.col(target) == k, F.col(f"`{c}`").cast("double"))
            aggs += [F.sum(x).alias(f"_s{i}_{k}"), F.sum(x * x).alias(f"_q{i}_{k}")]
    r = d.agg(*aggs)
    items = []
    for i, c in enumerate(cols):
        n0, n1 = F.col("_n0"), F.col("_n1")
        s0, s1, q0, q1 = (F.col(f"_s{i}_0"), F.col(f"_s{i}_1"), F.col(f"_q{i}_0"), F.col(f"_q{i}_1"))
        n = n0 + n1
        grand = (s0 + s1) / n
        ssb = n0 * (s0 / n0 - grand) * (s0 / n0 - grand) + n1 * (s1 / n1 - grand) * (s1 / n1 - grand)
        ssw = (q0 - s0 * s0 / n0) + (q1 - s1 * s1 / n1)
        fstat = F.when(ssw > 0, (ssb / F.lit(1.0)) / (ssw / (n - 2)))
        items.append(F.struct(F.lit(c).alias("feature"), fstat.alias("f"), (n - 2).alias("df2")))
    return r.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def anova_f(df: DataFrame, cols: Sequence[str], target: str = "default") -> DataFrame:
    """One-way ANOVA F per numeric feature."""
    return _anova(df, cols, target).select("feature", F.round("f", 6).alias("anova_f"))


def anova_test(df: DataFrame, cols: Sequence[str], target: str = "default") -> DataFrame:
    """D20 with p values: the upper tail of F with (1, n - 2) degrees of freedom, on the result rows."""
    r = _anova(df, cols, target)
    return r.select("feature", F.round("f", 6).alias("anova_f"), f_upper_udf(F.col("f"), F.lit(1.0), F.col("df2").cast("double")).alias("anova_p"))


def variance_inflation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factor of each column against the others, without
    an intercept, after a list-wise NULL drop.

    One aggregate gives the matrix of cross products (columns² numbers); the
    factor is 1 / (1 - R²) of the column on the others.  A column that the
    others give exactly has an infinite factor, a column of zeros none.
    """
    import numpy as np
    k, v = len(cols), [F.col(f"`{c}`").cast("double") for c in cols]
    row = listwise_drop(df, list(cols)).agg(*[F.sum(v[i] * v[j]).alias(f"_{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    gram = np.array([[row[f"_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)], float)
    scale = np.sqrt(np.diag(gram))
    unit = gram / np.outer(np.where(scale > 0, scale, 1), np.where(scale > 0, scale, 1))
    rows = []
    for i, c in enumerate(cols):
        others = [j for j in range(k) if j != i]
        left = 1 - unit[i, others] @ np.linalg.pinv(unit[np.ix_(others, others)], rcond=1e-12, hermitian=True) @ unit[others, i]
        rows.append((c, None if not scale[i] else float(1 / left) if left > 1e-10 else float("inf")))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Z-scores by mean and population standard deviation (0 if constant); one aggregate, joined as scalars."""
    stats = df.agg(F.struct(*[x for i, c in enumerate(cols) for x in
                              (F.avg(f"`{c}`").alias(f"m{i}"), F.stddev_pop(f"`{c}`").alias(f"s{i}"))])).scalar()
    z = {c: F.when(stats[f"s{i}"] > 0, (F.col(f"`{c}`") - stats[f"m{i}"]) / stats[f"s{i}"]).otherwise(F.lit(0.0)) for i, c in enumerate(cols)}
    return df.select(*[z[c].alias(c) if c in z else F.col(f"`{c}`") for c in df.columns])


def label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, v, code): the place of each value among its column's sorted
    distinct values, NULL as the text 'nan'; all columns in one pass.

    The distinct pairs are numbered in a distributed global order, so no
    task holds a column's values.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")).alias("v"))
                                          for i, c in enumerate(cols)])).alias("s")).select("s.*").distinct()
    placed = numbered(pairs, [F.col("i"), F.col("v")], "label-codes")
    first = placed.groupBy("i").agg(F.min("_number").alias("_first"))
    return placed.join(F.broadcast(first), "i").select("i", "v", (F.col("_number") - F.col("_first")).cast("int").alias("code"))


def encode_labels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``<column>_enc`` for each column; the optimiser picks the join by the code table's size."""
    codes, out = shared_table(label_codes(df, cols), "label-codes"), df
    for i, c in enumerate(cols):
        mine = codes.where(F.col("i") == i).select(F.col("v").alias(f"_v_{c}"), F.col("code").alias(f"{c}_enc"))
        out = (out.withColumn(f"_v_{c}", F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")))
                  .join(mine, f"_v_{c}").drop(f"_v_{c}"))
    return out


def chi2_codes(df: DataFrame, code_cols: Sequence[str], target: str = "default") -> DataFrame:
    """The library's chi² 'score' of non-negative codes: observed_c =
    Σ code in class c, expected_c = P(c)·Σ code (not a contingency test)."""
    aggs = [F.count_if(F.col(target) == k).alias(f"_n{k}") for k in (0, 1)]
    for i, c in enumerate(code_cols):
        aggs += [F.sum(F.when(F.col(target) == k, F.col(c))).cast("double").alias(f"_o{i}_{k}") for k in (0, 1)]
    r = df.agg(*aggs)
    items = []
    for i, c in enumerate(code_cols):
        n = F.col("_n0") + F.col("_n1")
        tot = F.col(f"_o{i}_0") + F.col(f"_o{i}_1")
        chi = None
        for k in (0, 1):
            e = F.col(f"_n{k}") / n * tot
            t = (F.col(f"_o{i}_{k}") - e) * (F.col(f"_o{i}_{k}") - e) / e
            chi = t if chi is None else chi + t
        items.append(F.struct(F.lit(c).alias("feature"), chi.alias("chi2")))
    return r.select(F.explode(F.array(*items)).alias("s")).select("s.feature", F.round("s.chi2", 6).alias("chi2"))


def chi2_table(df: DataFrame, cols: Sequence[str], target: str = "default") -> DataFrame:
    """True contingency chi-square (no correction) of each categorical
    column × target, from cell counts of one stacked ``groupBy``."""
    items = [F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value")) for c in cols]
    cells = (df.select(F.explode(F.array(*items)).alias("s"), F.col(target).alias("y"))
               .groupBy("s.feature", "s.value").agg(F.count_if(F.col("y") == 0).alias("c0"), F.count_if(F.col("y") == 1).alias("c1")))
    n0 = df.agg(F.count_if(F.col(target) == 0)).scalar()
    n1 = df.agg(F.count_if(F.col(target) == 1)).scalar()
    n = n0 + n1
    row = F.col("c0") + F.col("c1")
    row = row.cast("double")             # counts multiplied as doubles: no overflow at billions of rows
    e0, e1 = row * n0 / n, row * n1 / n
    term = (F.col("c0") - e0) * (F.col("c0") - e0) / e0 + (F.col("c1") - e1) * (F.col("c1") - e1) / e1
    r = cells.groupBy("feature").agg(F.sum(term).alias("chi2"), F.count(F.lit(1)).alias("k"))
    return r.select("feature", F.round("chi2", 6).alias("chi2"), (F.col("k") - 1).cast("int").alias("dof"))


def mutual_info(df: DataFrame, cols: Sequence[str], target: str = "default") -> DataFrame:
    """D22 (re-aimed): plug-in mutual information (nats) of each discrete or
    binned column with the target, from one stacked ``groupBy``."""
    items = [F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value"))
             for c in cols]
    cells = (df.select(F.explode(F.array(*items)).alias("s"), F.col(target).alias("y"))
               .groupBy("s.feature", "s.value", "y").agg(F.count(F.lit(1)).alias("nxy")))
    n = df.agg(F.count(F.lit(1))).scalar()
    px = cells.groupBy("feature", "value").agg(F.sum("nxy").alias("nx"))
    py = df.groupBy(F.col(target).alias("y")).agg(F.count(F.lit(1)).alias("ny"))
    j = cells.join(px, ["feature", "value"]).join(F.broadcast(py), "y")
    term = F.col("nxy") / n * F.log(F.col("nxy").cast("double") * n / (F.col("nx").cast("double") * F.col("ny")))
    return j.groupBy("feature").agg(F.round(F.sum(term), 6).alias("mutual_info"))


def digamma(x: Column) -> Column:
    """Digamma of x >= 1: recurrence up to x + 10, then the asymptotic series (error below 1e-13)."""
    y = x + 10
    near = sum(1 / (x + i) for i in range(10))
    inv = 1 / (y * y)
    return F.log(y) - 0.5 / y - inv * (1 / 12 - inv * (1 / 120 - inv * (1 / 252 - inv * (1 / 240 - inv / 132)))) - near


KNN_BLOCK = 10_000


def mutual_info_knn(df: DataFrame, cols: Sequence[str], target: str = "default", neighbors: int = 3) -> DataFrame:
    """Nearest-neighbour mutual information (nats) of each numeric column with a class column.

    For a row of class c, r is the distance to its k-th nearest row of the
    same class (k = ``neighbors``, one less than the class's rows if there are
    fewer; classes of one row take no part), and m the number of rows of all
    classes strictly between x - r and x + r (r = 0: with the same x).  With
    psi the digamma function the estimate is
    psi(N) + mean psi(k) - mean psi(n_c) - mean psi(m), and 0 if that is
    negative.  Rows whose value is NULL or NaN are left out, column by column.

    Equal values of a class share r and m, so all steps work on counts by
    (column, class, value).  These are numbered by a distributed sort and cut
    into blocks; each block also gets its neighbours' first and last
    ``neighbors`` rows, which is all that the k-th distance can depend on.
    The numbers m are differences of two running counts at x - r and x + r,
    read off one ordered pass over values and probes together.
    """
    names = list(cols)
    items = [F.struct(F.lit(i).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(names)]
    pairs = df.where(F.col(target).isNotNull()).select(F.explode(F.array(*items)).alias("s"), F.col(target).alias("y"))
    pairs = pairs.select("s.feature", "y", "s.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    counts = shared_table(pairs.groupBy("feature", "y", "x").agg(F.count(F.lit(1)).alias("n")), "knn-counts")
    classes = counts.groupBy("feature", "y").agg(F.sum("n").alias("n_class")).where("n_class > 1")
    rows = counts.join(classes, ["feature", "y"]).withColumn("k", F.least(F.lit(neighbors), F.col("n_class") - 1))

    h = neighbors
    rows = numbered(rows, [F.col("feature"), F.col("y"), F.col("x")], "knn-order").withColumn("block", F.floor(F.col("_number") / KNN_BLOCK))
    place = F.col("_number") % KNN_BLOCK
    halo = F.array_compact(F.array(F.col("block"), F.when(place < h, F.col("block") - 1), F.when(place >= KNN_BLOCK - h, F.col("block") + 1)))
    near = Window.partitionBy("at").orderBy("_number").rowsBetween(-h, h)
    rows = rows.withColumn("at", F.explode(halo)).withColumn("near", F.collect_list(F.struct("feature", "y", "x", "n")).over(near))
    rows = rows.where(F.col("at") == F.col("block"))
    others = F.filter("near", lambda o: (o["feature"] == F.col("feature")) & (o["y"] == F.col("y")) & (o["x"] != F.col("x")))
    by_distance = F.array_sort(F.transform(others, lambda o: F.struct(F.abs(o["x"] - F.col("x")).alias("d"), o["n"].alias("n"))))
    start = F.struct((F.col("k") - F.col("n") + 1).alias("left"), F.lit(0.0).alias("d"))
    radius = F.aggregate(by_distance, start, lambda a, o: F.when(a["left"] > 0, F.struct((a["left"] - o["n"]).alias("left"), o["d"].alias("d"))).otherwise(a),
                         lambda a: a["d"])
    rows = shared_table(rows.select("feature", "x", "n", "k", "n_class", F.col("_number").alias("row"), radius.alias("r")), "knn-radii")

    # values (rank 1) and probes in one order; a probe of rank 0 counts what is below its x, one of rank 2 also what is at it
    event = lambda x, rank, n, sign: F.struct(x.alias("x"), F.lit(rank).alias("rank"), n.alias("n"), F.lit(sign).alias("sign"))
    zero, x, r = F.lit(0).cast("long"), F.col("x"), F.col("r")
    events = rows.select("feature", "row", F.explode(F.array(
        event(x, 1, F.col("n"), 0),
        F.when(r > 0, event(x + r, 0, zero, 1)).otherwise(event(x, 2, zero, 1)),
        F.when(r > 0, event(x - r, 2, zero, -1)).otherwise(event(x, 0, zero, -1)))).alias("e"))
    events = events.select("feature", "row", F.struct("e.x", "e.rank").alias("at"), "e.n", "e.sign")
    m = prefix_sums(events, ["feature"], "at", ["n"]).where("sign <> 0").groupBy("row").agg(F.sum(F.col("sign") * F.col("cum_n")).alias("m"))

    n = F.col("n")
    sums = rows.join(m, "row").groupBy("feature").agg(
        F.sum(n).alias("N"), F.sum(n * digamma(F.col("k").cast("double"))).alias("k"),
        F.sum(n * digamma(F.col("n_class").cast("double"))).alias("c"), F.sum(n * digamma(F.col("m").cast("double"))).alias("m"))
    value = digamma(F.col("N").cast("double")) + (F.col("k") - F.col("c") - F.col("m")) / F.col("N")
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("feature") + 1)
    return sums.select(name.alias("feature"), F.round(F.greatest(value, F.lit(0.0)), 6).alias("mutual_info"), F.col("N").alias("n_rows"))


def quantile_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, Column]:
    """Bin index of each column on its own exact quantile edges; the edges of
    all columns come from one pass (columns × (bins − 1) numbers)."""
    edges = exact_quantiles(df, {c: F.col(f"`{c}`") for c in cols}, [i / bins for i in range(1, bins)])
    out = {}
    for c in cols:
        idx = sum(((F.col(f"`{c}`") > F.lit(e)).cast("int") for e in edges.get(c, ())), F.lit(0))
        out[c] = F.when(F.col(f"`{c}`").isNotNull(), idx)
    return out


def variance_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D24 (intent kept): sample variance and coefficient of variation."""
    r = df.agg(*[a for i, c in enumerate(cols) for a in (F.var_samp(c).alias(f"_v{i}"), F.avg(c).alias(f"_m{i}"))])
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"_v{i}").alias("v"), F.col(f"_m{i}").alias("m")) for i, c in enumerate(cols)]
    long = r.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    return long.select("feature", F.round("v", 4).alias("variance"),
                       F.round(F.try_divide(F.sqrt("v"), F.abs("m")), 6).alias("coef_variation"))


def histogram(df: DataFrame, col: str, bins: int = 40, by: str | None = None) -> DataFrame:
    """Equal-width bins on [min, max], last bin closed; counts and density."""
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    width = (hi - lo) / F.lit(bins)
    b = F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)).cast("int")
    keys = [by] if by else []
    g = df.where(F.col(col).isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    tot = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return g.select(*keys, "bin", "n", (F.col("n") / F.sum("n").over(tot) / width).alias("density"))


def average_rank(scores: DataFrame, score_cols: Sequence[str], key: str = "feature") -> DataFrame:
    """E1 + E2: descending average rank per score (NULL stays NULL) and the
    mean of the available ranks.  ``scores`` is one row per feature (bounded)."""
    out = scores
    for c in score_cols:
        nn = scores.where(F.col(c).isNotNull()).select(key, c)
        w = Window.orderBy(F.col(c).desc())
        ties = Window.partitionBy(c)
        rk = nn.select(key, (F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0).alias(f"{c}_rank"))
        out = out.join(rk, key, "left")
    ranks = [F.col(f"{c}_rank") for c in score_cols]
    avail = sum(F.when(r.isNotNull(), 1).otherwise(0) for r in ranks)
    total = sum(F.coalesce(r, F.lit(0.0)) for r in ranks)
    return out.select("*", F.when(avail > 0, total / avail).alias("avg_rank"))
