"""Mixing sources to target weights by systematic sampling, in DataFrame
operations alone.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share
``share`` of all words; a target stops at ``cap`` times its source's size and
the excess goes to the others by weight. Every document of a source expects
target / source size copies. Documents are laid out by size, largest first;
the prefix sum of expected copies plus one offset of the source gives a copy
for each integer boundary it crosses, so a document gets the floor or the
ceiling of its expectation, and the words taken stay within about the largest
document of the target.

The prefix sum of a source is spread: documents are numbered within
(source, size, salt) and the counts of these small groups are summed before;
salts grow with the rows. Sums over all sources go by ranges of sources, so any
number of them will do. Rates are integers of 2^-30, so reruns agree exactly.

Every row counts: repeated rows and null doc_ids are documents like others, a
null text has no words and gives no copies, a null source is one of its own,
texts of any length are counted whole. Extra columns stay, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkretail.llm.components import stored

ONE = 1 << 30


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


#: sources that one task puts in order; rows of one size of a source that one task numbers
RANGE_SOURCES, NUMBERED_ROWS = 100_000, 250_000


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], parts: int) -> DataFrame:
    """``df`` with, per name, the sum over all rows before each one in an order
    without ties: within ranges of the order, after the totals of the ranges
    before."""
    ranged = stored(df.repartitionByRange(parts, *order).withColumn("range_", F.spark_partition_id()), "ranges")
    each = W.partitionBy("range_").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("double"))
    totals = ranged.groupBy("range_").agg(*[F.sum(v.cast("double")).alias(f"{k}_") for k, v in sums.items()])
    upto = W.orderBy("range_").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    starts = totals.select("range_", *[zero(F.sum(f"{k}_").over(upto)).alias(f"{k}_") for k in sums])
    out = ranged.select("*", *[zero(F.sum(v.cast("double")).over(each)).alias(k) for k, v in sums.items()])
    return (out.join(F.broadcast(starts), "range_")
            .select(*df.columns, *[(F.col(k) + F.col(f"{k}_")).alias(k) for k in sums]))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """``key_, source, source_size, target`` of ``(key_, source, source_size)``,
    a row a source. Sources are capped in order of size / weight; the rate of the
    others follows from prefix sums in that order."""
    parts = 1 + sizes.count() // RANGE_SOURCES
    by_name = F.col("source").asc_nulls_last()
    placed = running(sizes, [by_name], {"place": F.lit(1)}, parts)
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    at = placed.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    at = running(at.withColumn("need", F.col("source_size") / F.col("weight")), [F.col("need"), by_name],
                 {"given": F.col("limit"), "passed": F.col("weight")}, parts)
    at = stored(at, "needs")
    all_ = at.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    want, open_ = all_.select(F.col("size") * F.lit(float(share))).scalar(), all_.select("weight").scalar() - F.col("passed")
    at = at.withColumn("rate", (want - F.col("given")) / open_)
    # the first source whose share stays within its limit sets the rate of all after it
    level = at.where(F.col("rate") * F.col("weight") <= F.col("limit")).agg(F.min(F.struct("given", "rate")).alias("least"))
    rest = level.select(F.col("least.rate")).scalar()
    return at.select("key_", "source", "source_size",
                     F.coalesce(F.least(rest * F.col("weight"), F.col("limit")), F.col("limit")).alias("target"))


def plan_copies(docs: DataFrame, keep: list[str] | None = None, **kw) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them) with ``size, source_size,
    target, copies`` per row; columns of these names are replaced. Options: see
    ``_planned``."""
    own = [c for c in keep or docs.columns if c not in ("size", "source_size", "target", "copies")]
    return _planned(docs, own, **kw).select("row_.*", "size", "source_size", "target", "copies")


def _planned(docs: DataFrame, own: list[str], weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
             seed: str = "mix", tries: int = 64) -> DataFrame:
    """``row_`` (the columns ``own``), ``size, source_size, target, copies`` per
    row. Documents without words give no copies. The offset of a source is the
    one, of ``tries`` random ones, whose words come nearest to the target."""
    key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("v"), F.coalesce("source", F.lit("")))  # never null
    # within a struct no column of the documents meets one of the plan
    rows = docs.select(F.struct(*own).alias("row_"), "doc_id", "source", word_count().alias("size"), key.alias("key_"))
    salts = 32 + docs.count() // NUMBERED_ROWS
    rows = rows.withColumn("salt_", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    small = stored(rows.groupBy("key_", "source", "size", "salt_").agg(F.count("*").alias("n")), "groups")
    groups = small.groupBy("key_", "source", "size").agg(F.sum("n").alias("n"))
    sizes = groups.groupBy("key_", "source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * ONE + F.lit(0.5))) \
        .otherwise(0).cast("long")
    goal = stored(targets(sizes, weights, share, cap).withColumn("rate", rate), "goal")
    before = W.partitionBy("key_").orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, -1)
    groups = stored(groups.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
                    .join(goal.drop("source"), "key_"), "sizes")

    def crossed(first: Column, n: Column, start: Column, rate: Column) -> Column:
        """Integer boundaries crossed by n documents after the first ones."""
        low = start + first * rate
        return F.shiftright(low + n * rate, 30) - F.shiftright(low, 30)

    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("t").cast("string"), F.lit("|"), F.col("key_"))), 1, 7),
                    16, 10).cast("long") * 4  # in [0, 2^30)
    taken = (groups.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tries - 1)))).withColumn("start", offset)
             .groupBy("key_", "target", "t", "start")
             .agg(F.sum(crossed(F.col("before"), F.col("n"), F.col("start"), F.col("rate")) * F.col("size")).alias("words")))
    best = taken.groupBy("key_").agg(F.min_by("start", F.struct(F.abs(F.col("words") - F.col("target")), "t")).alias("start"))
    within = W.partitionBy("key_", "size").orderBy("salt_").rowsBetween(W.unboundedPreceding, -1)
    place = (small.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0).cast("long")))
             .join(groups.select("key_", "size", "before", "source_size", "target", "rate"), ["key_", "size"])
             .join(best, "key_")
             .select("key_", "size", "salt_", (F.col("before") + F.col("inside")).alias("first_"),
                     "source_size", "target", F.col("rate").alias("rate_"), F.col("start").alias("start_")))
    # the join below has the window's keys: the rows are shuffled once
    number = F.row_number().over(W.partitionBy("key_", "size", "salt_").orderBy("doc_id")) - 1
    copies = crossed(F.col("first_") + F.col("number_"), F.lit(1), F.col("start_"), F.col("rate_"))
    return (rows.select("row_", "size", "key_", "salt_", "doc_id").withColumn("number_", number)
            .join(place, ["key_", "size", "salt_"])
            .select("row_", "size", "source_size", "target",
                    F.when(F.col("size") > 0, copies).otherwise(0).cast("long").alias("copies")))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    plan = _planned(docs, docs.columns, **kw).where("copies > 0").select("row_", F.explode(
        F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_"))
    return plan.select("row_.*")
