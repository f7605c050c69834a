"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Sources in code point order (null last) take the weights in turn and share the whole budget; a source's target stops
at ``most`` times its size and the excess goes to the others by weight. Within a source every document gets the
exponential key -ln(u) / w, with u from a digest of its id and w its quality weight; documents are taken in
order of the key while the prefix sum of their sizes stays within the target. Complete epochs precede that fraction. What
is then left of a source's target goes to the largest further document that fits (the first of them in order), so that
a source comes near its target in whole documents.

The order within a source is cut into buckets by the key, so that a source with a third of all rows is summed in many
tasks: bucket sums first, their running offsets next, running sums within a bucket last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .rows import one_of_each
from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[$%&#*!|<>{}=]"
#: Buckets to a doubling of the key. However small the weights are, none holds more than 0.2 % of the rows of one weight.
BUCKETS = 128


def quality_weight(text: Column, size: Column) -> Column:
    """Share of words against words and mark-up symbols; 1 for a text without either."""
    symbols = F.regexp_count(text, F.lit(SYMBOL))
    return F.when(size + symbols == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.01), size / (size + symbols)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget_percent: int = 100, most: int = 3) -> DataFrame:
    """``source, size`` (one row a source) with ``target``; the windows run over the sources alone."""
    turn = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy("cap_rate", "turn")
    s = sizes.withColumn("turn", F.row_number().over(turn) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap_rate", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    every = Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(every) * F.lit(budget_percent) / F.lit(100))
    s = s.withColumn("capped", F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("rest"))
    open_ones = F.when(F.col("cap_rate") >= F.col("level"), F.struct("cap_rate", "turn", "level"))
    s = s.withColumn("level", F.min(open_ones).over(every)["level"])
    cap = F.lit(float(most)) * F.col("source_size")
    return s.withColumn("target", F.coalesce(F.least(cap, F.col("level") * F.col("weight")), cap)).select("source", "source_size", "weight", "target")


def mix(spark: SparkSession, documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: str = "mix", budget_percent: int = 100, most: int = 3, weight: Column | None = None, also: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, epochs`` for each row of ``documents``, and the small columns of ``also``.

    Null and empty texts have size 0 and take nothing; a null source is a source; a null id is keyed as 'null';
    repeated rows have equal keys and are taken one by one. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    base = documents.select("doc_id", "source", size.alias("size"), (quality_weight(text, size) if weight is None else weight).alias("w"), *(c.alias(f"also_{k}") for k, c in (also or {}).items()))
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    base = base.withColumn("key", -F.ln(u) / F.col("w"))
    base = base.withColumn("bucket", F.floor(F.lit(BUCKETS) * F.log2("key")).cast("int"))
    base = Scratch(spark, "mixing").table(base.drop("w"), "sizes")

    sums = base.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    goal = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, budget_percent, most)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    named = lambda f: f.withColumn("has_source", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    offsets = named(offsets).join(named(goal), ["source", "has_source"]).select("source", "has_source", "bucket", "offset", "source_size", "target")

    within = Window.partitionBy("source", "has_source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = named(base).withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, ["source", "has_source", "bucket"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.withColumn("whole", epochs).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = rows.withColumn("before", F.col("offset") + F.col("inside")).withColumn("fits", F.col("before") + F.col("size") <= F.col("left"))

    keys = ["source", "has_source"]
    met = rows.where("fits").groupBy(*keys).agg(F.max(F.col("before") + F.col("size")).alias("met"))
    rest = offsets.select(*keys, "bucket").join(met, keys, "left").withColumn("met", F.coalesce("met", F.lit(0)))
    rows = rows.join(rest, [*keys, "bucket"])
    last = F.when(~F.col("fits") & (F.col("size") > 0) & (F.col("met") + F.col("size") <= F.col("left")), F.struct("size", (-F.col("before")).alias("place")))
    best = rows.groupBy(*keys).agg(F.max(last).alias("best"))
    rows = rows.join(offsets.select(*keys, "bucket").join(best, keys), [*keys, "bucket"])
    more = F.col("fits") | F.coalesce((F.col("size") == F.col("best.size")) & (-F.col("before") == F.col("best.place")), F.lit(False))
    rows = rows.withColumn("epochs", F.col("whole") + more.cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size")).alias("taken"), "epochs", *(F.col(f"also_{k}").alias(k) for k in also or {}))


def mixed_documents(spark: SparkSession, documents: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``size, source_size, target, taken, epochs``.

    Rows that repeat an id, its text and its source are one row (the least by the other columns), with what is taken of all
    of them. Input columns of these five names are replaced.
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")), "source")
    more = ["size", "source_size", "target", "taken", "epochs"]
    got = mix(spark, documents, also={"__text": digest}, **options).where("epochs > 0")
    keyed = lambda frame, c: frame.select("*", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("doc_id").isNull().alias("__none"), *c)
    on = ["__id", "__none", "__text"]
    got = keyed(got, []).groupBy(*on).agg(*(F.first(c).alias(f"__{c}") for c in more[:3]), *(F.sum(c).alias(f"__{c}") for c in more[3:]))
    rows = keyed(documents.drop(*more), [digest.alias("__text")]).join(got, on)
    return one_of_each(rows, on).withColumnsRenamed({f"__{c}": c for c in more})
