"""Aggregations: objects, moments, histograms and thresholds, agreement of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import EPSILON


def segment_stats(cells: DataFrame, label: str, bands: list[str]) -> DataFrame:
    """Per object: cells, and mean and sample variance of each band. One shuffle with partial aggregation."""
    aggs = [F.count(F.lit(1)).alias("nb_cells")]
    for k, b in enumerate(bands):
        aggs += [F.avg(b).alias(f"mean_b{k}"), F.var_samp(b).alias(f"var_b{k}")]
    return cells.groupBy(label).agg(*aggs)


def moments(frame: DataFrame, value: str, *keys: str) -> DataFrame:
    """Mean, sample variance, and skewness and excess kurtosis that divide by the sample variance.

    Where the variance is about 0 the last two are 0; one row alone has null variance. Spark's own central moments, which
    don't cancel for large means, are rescaled from population to sample variance.
    """
    x = F.col(value)
    mean, var = F.avg(x), F.var_samp(x)
    n = F.count(x)
    sums = frame.groupBy(*keys).agg(n.alias("n"), mean.alias("mean"), var.alias("variance"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))
    shrink = (F.col("n") - 1) / F.col("n")  # population over sample variance
    flat = F.col("variance").isNull() | (F.abs("variance") <= EPSILON)
    skew = F.when(flat, 0.0).otherwise(F.col("g1") * F.pow(shrink, 1.5))
    kurt = F.when(flat, 0.0).otherwise((F.col("g2") + 3) * shrink * shrink - 3)
    return sums.select(*keys, "n", "mean", "variance", skew.alias("skewness"), kurt.alias("kurtosis"))


def standardised(frame: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / sigma of each column; a column without spread becomes 0."""
    stats = frame.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    out = frame.crossJoin(F.broadcast(stats))  # one row is broadcast
    for c in columns:
        out = out.withColumn(c, F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0))
    return out.drop(*[f"_{n}_{c}" for c in columns for n in "ms"])


def histogram(frame: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """``bin, freq`` of all bins, empty ones with 0; values beyond the range count in the outer bins."""
    b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(value) - low) / (high - low) * bins))).cast("int")
    seen = frame.where(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("freq"))
    every = frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(seen, "bin", "left").na.fill(0, ["freq"])


def _running(h: DataFrame) -> DataFrame:
    """Cumulated shares, squares and first moments of a histogram. The windows run over its bins alone."""
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    every = Window.partitionBy()
    h = h.withColumn("p", F.col("freq") / F.sum("freq").over(every))
    h = h.withColumn("p1", F.sum("p").over(up)).withColumn("s1", F.sum(F.col("p") * F.col("p")).over(up))
    h = h.withColumn("s2", F.coalesce(F.sum(F.col("p") * F.col("p")).over(down), F.lit(0.0)))
    return h.withColumn("m1", F.sum(F.col("p") * F.col("bin")).over(up)).withColumn("mt", F.sum(F.col("p") * F.col("bin")).over(every))


def yen_threshold(h: DataFrame) -> DataFrame:
    """The bin with the greatest Yen criterion, the first of equal ones."""
    safe = lambda x: F.when(x > 0, F.ln(x)).otherwise(0.0)
    crit = -safe(F.col("s1") * F.col("s2")) + 2 * safe(F.col("p1") * (1 - F.col("p1")))
    best = _running(h).withColumn("crit", F.round(crit, 9)).agg(F.max(F.struct("crit", (-F.col("bin")).alias("b"))).alias("x"))
    return best.select((-F.col("x.b")).alias("threshold_bin"), F.col("x.crit").alias("criterion"))


def otsu_threshold(h: DataFrame) -> DataFrame:
    """The bin with the greatest variance between the two classes, the first of equal ones."""
    w = F.col("p1") * (1 - F.col("p1"))
    between = F.when(w > 1e-12, F.pow(F.col("mt") * F.col("p1") - F.col("m1"), 2) / w).otherwise(0.0)
    best = _running(h).withColumn("crit", F.round(between, 9)).agg(F.max(F.struct("crit", (-F.col("bin")).alias("b"))).alias("x"))
    return best.select((-F.col("x.b")).alias("threshold_bin"), F.col("x.crit").alias("criterion"))


def joint_entropy(frame: DataFrame, a: str, b: str) -> DataFrame:
    """-sum over rows of f ln f, over N, plus ln N, for the frequency f of a row's pair of bins.

    The sum runs over rows, so a pair of frequency f adds f * f ln f.
    """
    f = F.col("f")
    return frame.groupBy(a, b).agg(F.count("*").alias("f")).agg((-F.sum(f * f * F.ln(f)) / F.sum(f) + F.ln(F.sum(f))).alias("joint_entropy"), F.sum(f).alias("n_rows"))


def confusion(frame: DataFrame, reference: str, produced: str, classes: list) -> DataFrame:
    """One row a reference class, one column a produced class (``as_<class>``)."""
    return frame.groupBy(reference).agg(*[F.sum(F.when(F.col(produced) == c, 1).otherwise(0)).alias(f"as_{c}") for c in classes])


def agreement(frame: DataFrame, reference: str, produced: str) -> DataFrame:
    """Per class: precision, recall and F-score; and the overall accuracy and kappa on every row."""
    pairs = frame.groupBy(F.col(reference).alias("r"), F.col(produced).alias("p")).agg(F.count("*").alias("n"))
    none = F.lit(0).cast("long")
    side = pairs.select(F.explode(F.array(F.struct(F.col("r").alias("c"), F.col("n").alias("ref"), none.alias("got")), F.struct(F.col("p").alias("c"), none.alias("ref"), F.col("n").alias("got")))).alias("x"))
    per = side.groupBy(F.col("x.c").alias("class")).agg(F.sum("x.ref").alias("ref"), F.sum("x.got").alias("got"))
    hits = pairs.where("r = p").select(F.col("r").alias("class"), F.col("n").alias("hit"))
    per = per.join(hits, "class", "left").na.fill(0, ["hit"])
    every = Window.partitionBy()
    n = F.sum("ref").over(every)
    accuracy = F.sum("hit").over(every) / n
    chance = F.sum(F.col("ref") * F.col("got")).over(every) / (n * n)
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    return per.select("class", "ref", "got", "hit", ratio(F.col("hit"), F.col("got")).alias("precision"), ratio(F.col("hit"), F.col("ref")).alias("recall"), ratio(2 * F.col("hit"), F.col("ref") + F.col("got")).alias("f_score"), accuracy.alias("accuracy"), F.when(chance == 1, 0.0).otherwise((accuracy - chance) / (1 - chance)).alias("kappa"))


def overlap_matrix(frame: DataFrame, a: str, b: str) -> DataFrame:
    """Sizes of the overlaps of two segmentations, with both regions' sizes: what region scores are made of."""
    pairs = frame.groupBy(a, b).agg(F.count("*").alias("overlap"))
    return pairs.withColumn("size_a", F.sum("overlap").over(Window.partitionBy(a))).withColumn("size_b", F.sum("overlap").over(Window.partitionBy(b)))


def hoover(cells: DataFrame, a: str, b: str, tolerance: float) -> DataFrame:
    """How each region of the reference ``a`` fares in the segmentation ``b``: ``region, kind``.

    correct: it and a region of b share the tolerated part of both; split: several regions of b lie in it and fill it; merged:
    several regions of a, it among them, lie in one of b and fill it; missed: none of these.
    """
    o = overlap_matrix(cells, a, b)
    in_a, in_b = F.col("overlap") >= F.lit(tolerance) * F.col("size_a"), F.col("overlap") >= F.lit(tolerance) * F.col("size_b")
    named = lambda f, kind: f.select(F.col(a).alias("region"), F.lit(kind).alias("kind"))
    filled = lambda f, key, size: f.groupBy(key).agg(F.count("*").alias("k"), F.sum("overlap").alias("n"), F.max(size).alias("s")).where((F.col("k") > 1) & (F.col("n") >= F.lit(tolerance) * F.col("s"))).select(key)
    split, merged = o.where(in_b & ~in_a), o.where(in_a & ~in_b)
    found = named(o.where(in_a & in_b), "correct").unionByName(named(filled(split, a, "size_a"), "split")).unionByName(named(merged.join(filled(merged, b, "size_b"), b), "merged"))
    rest = o.select(F.col(a).alias("region")).distinct().join(found, "region", "left_anti")
    return found.unionByName(rest.withColumn("kind", F.lit("missed")))


def difference(frame: DataFrame, a: Column, b: Column, *keys: str) -> DataFrame:
    """Mean squared and absolute error, peak signal to noise ratio against the largest ``a``, and how many rows differ."""
    mse = F.avg((a - b) * (a - b))
    return frame.groupBy(*keys).agg(mse.alias("mse"), F.avg(F.abs(a - b)).alias("mae"), F.when(mse > 0, 10 * F.log10(F.max(a) * F.max(a) / mse)).alias("psnr"), F.sum((a != b).cast("int")).alias("n_different"))


def plane_fit(frame: DataFrame, x: str, y: str, z: str, *keys: str) -> DataFrame:
    """Least-squares plane z = a x + b y + c by its normal equations; null below three rows or where points lie on a line."""
    cov = lambda p, q: F.covar_pop(p, q)
    s = frame.groupBy(*keys).agg(F.count("*").alias("n"), cov(x, x).alias("xx"), cov(y, y).alias("yy"), cov(x, y).alias("xy"), cov(x, z).alias("xz"), cov(y, z).alias("yz"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.avg(z).alias("mz"))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    ok = (F.col("n") >= 3) & (F.abs(det) > EPSILON)
    s = s.withColumn("a", F.when(ok, (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / det)).withColumn("b", F.when(ok, (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / det))
    return s.select(*keys, "n", "a", "b", (F.col("mz") - F.col("a") * F.col("mx") - F.col("b") * F.col("my")).alias("c"))
