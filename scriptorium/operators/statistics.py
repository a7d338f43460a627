"""Descriptive statistics of tables: summaries, contingency, association, correlation, binning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import Scratch


def quantiles(df: DataFrame, columns: list[str], shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> dict[str, list[float | None]]:
    """Exact quantiles of each column by linear interpolation. Values are counted, the counts sorted by ranges, and only the ranges
    that hold a wanted place are looked through, so that no task has all values of a column."""
    scratch, parts = Scratch(df.sparkSession, "quantiles"), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("x")) for k, c in enumerate(columns))))
    counts = df.select(pairs.alias("p")).select("p.*").filter("x IS NOT NULL").groupBy("k", "x").agg(F.count("*").alias("n"))
    placed = scratch.save(counts.repartitionByRange(parts, "k", "x").sortWithinPartitions("k", "x").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    sizes = sorted(tuple(r) for r in placed.groupBy("k", part).agg(F.sum("n")).collect())
    totals = {k: sum(n for j, _, n in sizes if j == k) for k in range(len(columns))}
    at = {(k, p): (totals[k] - 1) * p for k in totals if totals[k] for p in shares}
    wanted = sorted({(k, rank) for (k, _), x in at.items() for rank in (math.floor(x), math.ceil(x))})
    asked, before = [], dict.fromkeys(totals, 0)
    for k, p, n in sizes:
        asked += [(k, p, before[k], rank) for j, rank in wanted if j == k and before[k] <= rank < before[k] + n]
        before[k] += n
    found: dict[tuple[int, int], float] = {}
    if asked:
        ranks = df.sparkSession.createDataFrame(asked, "k int, part long, before long, rank long")
        rows = placed.select("*", part).join(F.broadcast(ranks.select("k", "part", "before").distinct()), ["k", "part"])
        upto = rows.withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy("k", "part").orderBy("at")))
        hit = upto.join(F.broadcast(ranks.select("k", "part", "rank")), ["k", "part"]).filter("rank >= upto - n AND rank < upto")
        found = {(r["k"], r["rank"]): r["x"] for r in hit.select("k", "rank", "x").collect()}

    def between(k: int, p: float) -> float | None:
        if not totals[k]:
            return None
        x = at[k, p]
        low, high = found[k, math.floor(x)], found[k, math.ceil(x)]
        return low if low == high else (math.ceil(x) - x) * low + (x - math.floor(x)) * high

    return {c: [between(k, p) for p in shares] for k, c in enumerate(columns)}


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG5: a row for each numeric column, exact quartiles by linear interpolation; no row if the table has none."""
    of = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(F.count("*").alias("rows"), *(f(F.col(c).cast("double")).alias(f"{name}_{k}") for k, c in enumerate(columns) for name, f in of.items())).first()
    quarters = quantiles(df, columns)
    out = [(c, *(row[f"{x}_{k}"] for x in ("count", "mean", "std", "min")), *quarters[c], row[f"max_{k}"]) for k, c in enumerate(columns)] if row["rows"] else []
    return df.sparkSession.createDataFrame(out, "name string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def describe_objects(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG6: count, distinct values, most frequent value (the least one of ties) and its frequency."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("x")) for c in columns)))
    counts = df.select(pairs.alias("p")).select("p.*").filter("x IS NOT NULL").groupBy("name", "x").agg(F.count("*").alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("m"), "x"))
    return counts.groupBy("name").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), top.alias("t")).select("name", "count", "unique", F.col("t.x").alias("top"), (-F.col("t.m")).alias("freq"))


def null_counts(df: DataFrame) -> DataFrame:
    """AGG4"""
    return df.agg(*(F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in df.columns))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG7, AGG8 in long form: n and its row, column and total shares; rows with a null in either are left out."""
    n = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n"))
    share = lambda *by: F.col("n") / F.sum("n").over(W.partitionBy(*by))
    return n.withColumns({"row_share": share(a), "column_share": share(b), "total_share": share()})


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """AGG7, AGG9 in wide form."""
    return df.filter(F.col(a).isNotNull()).groupBy(a).pivot(b, values).count().na.fill(0)


def margins(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.cube(a, b).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def sums_by(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """AGG1"""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*(F.sum(c).alias(c) for c in columns))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """STA4, STA6, STA7: (n, r, k, chi2, chi2_yates, dof, cramer, cramer_yates); bias-corrected V. One aggregation of the table, then of its cells."""
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("o"))
    rows, cols, total = cells.groupBy(a).agg(F.sum("o").alias("ro")), cells.groupBy(b).agg(F.sum("o").alias("co")), cells.agg(F.sum("o").alias("n"), F.count_distinct(a).alias("r"), F.count_distinct(b).alias("k"))
    # Empty cells add their expectation: sum(E) over all cells is n, so chi2 = sum(o^2/E) - n.
    grid = cells.join(rows, a).join(cols, b).join(F.broadcast(total))
    e = F.col("ro") * F.col("co") / F.col("n")
    d = F.abs(F.col("o") - e)
    full = grid.groupBy("n", "r", "k").agg((F.sum(F.col("o") * F.col("o") / e) - F.first("n")).alias("chi2"), F.sum(F.pow(d - F.least(F.lit(0.5), d), F.lit(2)) / e).alias("_yates"), F.count("*").alias("_cells"))
    two = (F.col("r") == 2) & (F.col("k") == 2)
    full = full.withColumn("chi2_yates", F.when(two & (F.col("_cells") == 4), F.col("_yates")).otherwise(F.col("chi2"))).withColumn("dof", (F.col("r") - 1) * (F.col("k") - 1))

    def v(x: Column) -> Column:
        n = F.col("n")
        phi = F.greatest(F.lit(0.0), x / n - (F.col("k") - 1) * (F.col("r") - 1) / (n - 1))
        rc, kc = F.col("r") - F.pow(F.col("r") - 1, F.lit(2)) / (n - 1), F.col("k") - F.pow(F.col("k") - 1, F.lit(2)) / (n - 1)
        m = F.least(kc - 1, rc - 1)
        return F.when(m > 0, F.sqrt(phi / m))

    return full.select("n", "r", "k", "chi2", "chi2_yates", "dof", v(F.col("chi2")).alias("cramer"), v(F.col("chi2_yates")).alias("cramer_yates"))


def cramer_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """STA8: (a, b, cramer) of all pairs of columns, the diagonal included."""
    out = None
    for a in columns:
        for b in columns:
            one = chi_square(df.select(F.col(a).alias("_a"), F.col(b).alias("_b")), "_a", "_b").select(F.lit(a).alias("a"), F.lit(b).alias("b"), "cramer")
            out = one if out is None else out.union(one)
    return out


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """STA1: (a, b, r), complete pairs, all in one aggregation."""
    both = [(a, b) for a in columns for b in columns]
    row = df.agg(*(F.corr(F.when(F.col(b).isNotNull(), F.col(a)).cast("double"), F.when(F.col(a).isNotNull(), F.col(b)).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(both)))
    return row.select(F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(both)))).alias("p")).select("p.*")


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """(column, rank) of each distinct value: ranks are summed over value counts, so only distinct values are ordered."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy(column).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return counts.select(column, (before + (F.col("_n") + 1) / 2).alias(f"{column}_rank"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """STA2, STA3: (n, rho, t); the p value is `t_two_sided(t, n - 2)`."""
    d = df.select(a, b).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranked = d.join(average_ranks(d, a), a).join(average_ranks(d, b), b)
    out = ranked.agg(F.count("*").alias("n"), F.corr(f"{a}_rank", f"{b}_rank").alias("rho"))
    return out.withColumn("t", F.col("rho") * F.sqrt((F.col("n") - 2) / F.greatest(1 - F.col("rho") * F.col("rho"), F.lit(1e-300))))


def spearman_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """STA2, STA3: (a, b, n, rho, p) of all pairs of columns, over the rows where all of them are given."""
    d = df.select(*columns).dropna()
    for c in columns:
        d = d.join(average_ranks(d, c), c)
    pairs = [(a, b) for a in columns for b in columns]
    row = d.agg(F.count("*").alias("n"), *(F.corr(f"{a}_rank", f"{b}_rank").alias(f"r{k}") for k, (a, b) in enumerate(pairs))).first()
    out = []
    for k, (a, b) in enumerate(pairs):
        n, rho = row["n"], row[f"r{k}"]
        given = rho is not None and n > 2
        out.append((a, b, n, rho, (t_two_sided(rho * math.sqrt((n - 2) / (1 - rho * rho)), n - 2) if rho * rho < 1 else 0.0) if given else None))
    return df.sparkSession.createDataFrame(out, "a string, b string, n long, rho double, p double")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, dof: float) -> float:
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


def chi_square_tail(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution: by series below, by continued fraction above the mean."""
    a, x = dof / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1 - front * total
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d, c = 1 / (an * d + b), b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def fisher_exact(a: int, b: int, c: int, d: int) -> tuple[float, float]:
    """STA5: odds ratio and two-sided p of a 2x2 table."""
    logs = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    n, row, col = a + b + c + d, a + b, a + c
    chance = lambda x: math.exp(logs(col, x) + logs(n - col, row - x) - logs(n, row))
    here = chance(a)
    p = sum(q for x in range(max(0, row - (n - col)), min(row, col) + 1) if (q := chance(x)) <= here * (1 + 1e-7))
    return (a * d / (b * c) if b * c else math.inf if a * d else math.nan), min(1.0, p)


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """STA9: equal bins, the last one closed on the right; empty bins have no row."""
    x, span = F.col(column).cast("double"), df.agg(F.min(F.col(column).cast("double")).alias("lo"), F.max(F.col(column).cast("double")).alias("hi"))
    k = F.when(F.col("hi") == F.col("lo"), 1).otherwise(F.least(F.lit(bins), F.floor((x - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))) + 1)).cast("int")
    return df.filter(F.col(column).isNotNull()).join(F.broadcast(span)).groupBy(k.alias("bin")).agg(F.count("*").alias("n"))


def box(df: DataFrame, column: str) -> DataFrame:
    """STA10: quartiles, whiskers at the outermost values within 1.5 interquartile ranges, number of outliers."""
    q1, q2, q3 = (F.lit(q).cast("double") for q in quantiles(df, [column])[column])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return df.filter(F.col(column).isNotNull()).select(column, q1.alias("q1"), q2.alias("q2"), q3.alias("q3")).groupBy("q1", "q2", "q3").agg(
        F.min(F.when(inside, F.col(column))).alias("low"), F.max(F.when(inside, F.col(column))).alias("high"), F.count_if(~inside).alias("n_outliers")
    )


def density(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """STA11: Gaussian kernel density on a grid, Scott's bandwidth. The grid is an array in each row, summed in one aggregation."""
    s = df.agg(F.count(column).alias("n"), F.stddev_samp(column).alias("sd"), F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    h = float(s["sd"] or 0) * (s["n"] or 1) ** -0.2 or 1.0
    lo, hi = float(s["lo"] or 0) - 3 * h, float(s["hi"] or 0) + 3 * h
    grid = [lo + (hi - lo) * i / (points - 1) for i in range(points)]
    kernel = lambda g: F.exp(-F.pow((F.lit(g) - F.col(column)) / h, F.lit(2)) / 2)
    row = df.agg(*(F.sum(kernel(g)).alias(f"d{i}") for i, g in enumerate(grid)))
    scale = (s["n"] or 1) * h * math.sqrt(2 * math.pi)
    return row.select(F.explode(F.array(*(F.struct(F.lit(g).alias("x"), (F.col(f"d{i}") / scale).alias("density")) for i, g in enumerate(grid)))).alias("p")).select("p.*")


#: Most points that one task smooths for.
LOWESS_POINTS = 1000


def lowess(df: DataFrame, x: str, y: str, by: str, share: float = 2 / 3) -> DataFrame:
    """STA12: local linear smoothing with tricube weights within each group (`by`).

    The smooth depends on x alone, and rows of one x weigh alike, so that it is computed from the count and sum of y of each x, for
    LOWESS_POINTS points a task. Rows as far away as the farthest neighbour have no weight; only where a single x holds all the
    neighbours, or lies within 1e-12 of them, does the order of y decide which rows count: there the y are added up in order.
    """
    import numpy as np
    import pandas as pd

    scratch = Scratch(df.sparkSession, "lowess")
    d = df.select(F.col(by).cast("string").alias("grp"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    cells = scratch.save(d.groupBy("grp", "x").agg(F.count("*").alias("n"), F.sum("y").alias("t")))
    sizes = cells.groupBy("grp").agg(F.sum("n").alias("rows"), F.count("*").alias("points"))
    spread = cells.join(sizes, "grp").withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("points") - 1) / LOWESS_POINTS))))
    columns = "grp string, x double, smooth double, sw double, mx double, my double, xx double, xy double, edge double, held long, weight double"

    def smooth(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        xs, ns, ts = (pdf[c].to_numpy() for c in ("x", "n", "t"))
        k, out = max(2, int(math.ceil(share * int(pdf["rows"].iloc[0])))), []
        for at in range(int(key[1]) * LOWESS_POINTS, min(len(xs), (int(key[1]) + 1) * LOWESS_POINTS)):
            v = xs[at]
            away = np.abs(xs - v)
            order = np.argsort(away, kind="stable")
            upto = np.cumsum(ns[order])
            last = int(min(np.searchsorted(upto, k), len(order) - 1))  # the x whose rows fill the neighbours up
            far, whole, edge = away[order[last]], order[:last], order[last]
            u = lambda a: (1 - np.minimum(1, a / max(far, 1e-12)) ** 3) ** 3
            w, held, weight = u(away[whole]), int(min(k, upto[last]) - (upto[last] - ns[edge])), float(u(far))
            a, b, n, t = w * ns[whole], w * ts[whole], xs[whole], weight * held
            sums = (a.sum() + t, (a * n).sum() + t * xs[edge], b.sum(), (a * n**2).sum() + t * xs[edge] ** 2, (b * n).sum())
            if weight and held == ns[edge]:
                sums, weight = (*sums[:2], sums[2] + ts[edge], sums[3], sums[4] + ts[edge] * xs[edge]), 0.0
            out.append((key[0], v, local_line(v, *sums), *sums, xs[edge], held, weight))
        return pd.DataFrame(out, columns=columns.replace(" string", "").replace(" double", "").replace(" long", "").split(", "))

    points = scratch.save(spread.groupBy("grp", "part").applyInPandas(smooth, columns))
    partial = points.filter("weight > 0")
    if not partial.isEmpty():
        asked = partial.select("grp", F.col("edge").alias("x"), "held").distinct()
        values = d.join(asked.select("grp", "x").distinct(), ["grp", "x"], "left_semi").groupBy("grp", "x", "y").agg(F.count("*").alias("c"))
        before = values.withColumn("before", F.sum("c").over(W.partitionBy("grp", "x").orderBy("y")) - F.col("c"))
        first = before.join(asked, ["grp", "x"]).filter("before < held").groupBy("grp", F.col("x").alias("edge"), "held").agg(F.sum(F.col("y") * F.least("c", F.col("held") - F.col("before"))).alias("s"))
        line = F.udf(local_line, "double")
        more = F.col("weight") * F.col("s")
        partial = partial.join(first, ["grp", "edge", "held"]).withColumn("smooth", line("x", "sw", "mx", F.col("my") + more, "xx", F.col("xy") + more * F.col("edge")))
        points = scratch.save(points.filter("weight = 0").select("grp", "x", "smooth").union(partial.select("grp", "x", "smooth")))
    return d.join(points.select("grp", "x", "smooth"), ["grp", "x"]).select("grp", "x", "y", "smooth")


def local_line(v: float, sw: float, mx: float, my: float, xx: float, xy: float) -> float:
    """The weighted least squares line at v, level where x hardly varies."""
    var = xx - mx * mx / sw
    slope = (xy - mx * my / sw) / var if var > 1e-12 else 0.0
    return float((my + slope * (v * sw - mx)) / sw)


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """MLX1: codes in alphabetical order, from the distinct values."""
    codes = df.select(column).distinct().filter(F.col(column).isNotNull()).withColumn(f"{column}_code", F.row_number().over(W.orderBy(column)) - 1)
    return df.join(codes, column, "left")


def split(df: DataFrame, key: str, share: float = 0.7, seed: int = 42) -> DataFrame:
    """MLX2: `in_training` by a hash of the key, the same on every run."""
    return df.withColumn("in_training", F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long") % 1000 < int(share * 1000))


def decision_tree(df: DataFrame, features: list[str], label: str, key: str, depth: int = 5):
    """MLX3: (model, accuracy on the held-out rows)."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler

    df = Scratch(df.sparkSession, "tree").save(df.select(key, *features, label))  # fitting reads its rows many times
    rows = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip").transform(split(df, key).withColumn("_y", F.col(label).cast("double")))
    model = DecisionTreeClassifier(featuresCol="_x", labelCol="_y", maxDepth=depth, seed=42).fit(rows.filter("in_training"))
    score = MulticlassClassificationEvaluator(labelCol="_y", metricName="accuracy").evaluate(model.transform(rows.filter("NOT in_training")))
    return model, score


# Projections (PRJ)
def integral_text(x: Column) -> Column:
    """PRJ9"""
    return F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def log_filled(df: DataFrame, column: str, out: str) -> DataFrame:
    """PRJ12: zeros and nulls get the least positive value before the logarithm."""
    least = df.agg(F.min(F.when(F.col(column) > 0, F.col(column))).alias("_least"))
    return df.join(F.broadcast(least)).withColumn(out, F.ln(F.coalesce(F.nullif(F.col(column), F.lit(0)), F.col("_least")))).drop("_least")


def fill_by_type(df: DataFrame, text: str = "manque", number: float = 0) -> DataFrame:
    """PRJ13"""
    names = {c for c, t in df.dtypes if t == "string"}
    return df.na.fill(text, list(names)).na.fill(number, [c for c in df.columns if c not in names])


def missing_share(df: DataFrame, columns: list[str], marker: str = "manque") -> DataFrame:
    """AGG10"""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), (F.col(c) == marker).cast("double").alias("x")) for c in columns)))
    return df.select(pairs.alias("p")).groupBy("p.name").agg(F.avg("p.x").alias("share"))
