"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources stand in code-point order with null last and weigh 5, 2, 1,
repeating. They share the size of all documents by weight; a target stops at
`cap` times its source's size and the excess goes to the others by weight.

Copies. A source with target / size = r takes floor(r) whole copies of each of
its documents. The rest of its target, (r - floor(r)) * size, is drawn: document
i has inclusion probability p_i = min(1, c * g_i), where g_i grows with a power
of the document's size class and c makes the expected words meet the rest.
With u_i uniform from a hash of doc_id, documents are ranked by
q_i = (u_i / (1 - u_i)) / (p_i / (1 - p_i)), random odds over inclusion odds
(Rosen 1997), and taken in that order until the rest is filled.

No source is ever sorted as a whole. A histogram of q of 4,096 bins a source finds the bin of the cut; the
documents of that bin alone, about one in 4,096, are ranked one by one, and the last one taken is the
source's cut. A document compares itself with the cut of its source, so a source with a third of all rows is no hot task.

Edge cases: null or empty text has size 0 and takes 0; a null source is a
source of its own; rows that repeat a doc_id share its random number and rank
next to each other; an empty table gives an empty result; further columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringfold.llm.common import table, word_count
from ringfold.plans.shared import cut

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SEED = 20250101
POWER = 0.5
BINS = 4096


def targets(sizes: DataFrame, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) to (source, source_size, target): the capped shares, by one sorted pass.

    Sources fill up in the order of cap * size / weight, so the k that fill up
    are a prefix of that order and the level of the others follows in one step.
    The window holds one row a source, not one a document.
    """
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("w", F.element_at(wheel, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    order = Window.partitionBy().orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(cap))
    s = s.withColumn("level", (F.col("total") - F.col("full")) / F.col("w_left")).withColumn("open", F.col("level") * F.col("w") <= F.col("source_size") * cap)
    s = s.withColumn("lvl", F.min(F.when(F.col("open"), F.struct("full", "level"))).over(everything))
    share = F.least(F.col("source_size") * F.lit(cap), F.col("lvl.level") * F.col("w"))
    return s.select("source", "source_size", F.coalesce(share, F.lit(0.0)).cast("double").alias("target"))


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 12).cast("double") + 0.5) / float(1 << 52)


def odds(classes: DataFrame, cap: float, weights: tuple[float, ...], power: float) -> DataFrame:
    """(source, class, words) to source, class, source_size, target, whole, rest, p: what documents of a class share.

    A source has at most 64 classes, and the k largest that reach probability 1 are a prefix of them.
    """
    aim = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), cap, weights)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aim = aim.withColumn("whole", F.floor(ratio)).withColumn("rest", (ratio - F.floor(ratio)) * F.col("source_size"))
    classes = same_source(classes, aim).withColumn("g", F.pow(F.lit(2.0), F.col("class") * power))
    down = Window.partitionBy("source").orderBy(F.col("class").desc())
    sure = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = F.sum(F.col("g") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    classes = classes.withColumn("k", sure).withColumn("c", F.when(open_ > 0, (F.col("rest") - sure) / open_).otherwise(0.0))
    pick = F.min(F.when(F.col("c") * F.col("g") <= 1, F.struct("k", "c"))).over(Window.partitionBy("source"))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("pick.c") * F.col("g")))
    return classes.withColumn("pick", pick).select("source", "class", "source_size", "target", "whole", "rest", p.alias("p"))


def mix(docs: DataFrame, size: Column | None = None, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, power: float = POWER) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken, inclusion for each row of docs.

    size: words of `text` unless given. power: how much longer documents are
    preferred in the drawn part (0: not at all, 1: in proportion to size).
    """
    size = word_count(F.col("text")) if size is None else size
    level = F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")))).otherwise(0).cast("int")
    slim = cut(docs.select("doc_id", "source", size.cast("long").alias("size")).withColumn("class", level), "mix-sizes")
    # a row a source and class, read back below instead of being worked out for the join
    shared = cut(odds(slim.groupBy("source", "class").agg(F.sum("size").alias("words")), cap, weights, power), "mix-odds")

    rows = same_source(slim, shared.withColumnRenamed("class", "k"), F.col("class") == F.col("k"))
    u = uniform(seed, F.col("doc_id"))
    q = F.when(F.col("p") >= 1, 0.0).when((F.col("p") > 0) & (F.col("size") > 0), u / (1 - u) * (1 - F.col("p")) / F.col("p"))
    rows = rows.drop("class", "k").withColumn("v", q / (1 + q)).withColumn("bin", F.least(F.floor(F.col("v") * BINS), F.lit(BINS - 1)).cast("int"))
    rows = cut(rows, "mix-rows")

    drawn = rows.where("v IS NOT NULL AND size > 0")
    run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("room")).withColumn("upto", F.sum("words").over(run))
    cross = bins.where("upto >= room AND upto - words < room").select("source", F.col("bin").alias("at"), (F.col("room") - F.col("upto") + F.col("words")).alias("left"))
    near = same_source(drawn, cut(cross, "mix-bins"), F.col("bin") == F.col("at"))
    rank = Window.partitionBy("source").orderBy("v", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    taken = near.withColumn("upto", F.sum("size").over(rank)).groupBy("source").agg(F.first("at").alias("at"), F.max(F.when(F.col("upto") - F.col("size") / 2.0 <= F.col("left"), F.struct("v", F.coalesce("doc_id", F.lit(-(2**63))).alias("i")))).alias("last"))
    rows = same_source(rows, cut(taken, "mix-cuts"), how="left")

    me = F.struct("v", F.coalesce("doc_id", F.lit(-(2**63))).alias("i"))
    under = F.col("at").isNull() | (F.col("bin") < F.col("at")) | ((F.col("bin") == F.col("at")) & F.coalesce(me <= F.col("last"), F.lit(False)))
    rows = rows.withColumn("copies", F.col("whole") + (F.col("v").isNotNull() & under).cast("int"))
    return rows.select("doc_id", "source", "size", F.col("source_size").cast("long"), "target", F.col("copies").cast("long"), (F.col("copies") * F.col("size")).cast("long").alias("taken"), F.col("p").alias("inclusion"))


def same_source(a: DataFrame, b: DataFrame, also: Column | None = None, how: str = "inner") -> DataFrame:
    """Join on source where null equals null; Spark broadcasts b only if its size at run time allows."""
    b = b.withColumnRenamed("source", "__s")
    on = F.col("source").eqNullSafe(F.col("__s"))
    return a.join(b, on if also is None else on & also, how).drop("__s")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
