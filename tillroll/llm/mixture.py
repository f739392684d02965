"""Sources mixed to target weights by capped water-filling.

The mix is ``share`` of all words, dealt to the sources by weight.  No source
gives more than ``epochs`` times its words: those that would are clamped there
and their excess is dealt to the others by weight, until none is above.
With the sources in order of cap over weight the clamped ones are the first,
so one pass over the sources' totals finds them.  Every document is then taken
whole as often as its source's target holds the source, and once more if a
seeded hash puts it among the documents that fill the rest.

Only totals by source and by (source, hash prefix) are ever gathered; the cut
within a source is found in two steps, over at most 4096 prefixes and then over
the documents of one prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.tables import Stages, plain, spare

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
EPOCHS = 2.0
SEED = 17
PREFIX = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lot(doc_id: Column, text: Column, seed: int) -> Column:
    """A document's place in the order in which documents fill a source's rest."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    return plain(docs, doc_id="long", text="string", source="string").select(
        "doc_id", "source", words(F.col("text")).alias("size"), lot(F.col("doc_id"), F.col("text"), seed).alias("lot")
    )


def plan_mix(
    rows: DataFrame,
    stages: Stages,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
) -> DataFrame:
    """One row a source of ``rows`` (source, size, lot): source, source_size, target,
    whole (times that all documents are taken) and cut (the last lot taken once more)."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    # windows over all sources: one row a source
    totals = totals.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    totals = totals.withColumn("weight", weight).withColumn("most", F.lit(epochs) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    upto, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    totals = (
        totals.withColumn("total", F.lit(share) * F.sum("source_size").over(all_rows))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(upto), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("most") * F.col("weights"))
    )
    level = F.min_by(F.when(~F.col("full"), F.col("left") / F.col("weights")), F.when(~F.col("full"), F.col("most") / F.col("weight"))).over(all_rows)
    totals = totals.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * level))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    totals = totals.withColumn("whole", whole.cast("int")).select(
        "source", "source_size", "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest")
    )
    totals = stages.write(totals, "sources")

    start = F.substring("lot", 1, PREFIX)
    steps = rows.groupBy("source", start.alias("start")).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(
        totals.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s"))
    )
    cut_step = stages.write(
        # a source clamped at its cap has no rest to fill: not even a text without words goes once more
        steps.where((F.col("rest") > 0) & (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest"))).select(
            "source", "start", "before", "rest"
        ),
        "cut_steps",
    )
    fine = rows.withColumn("start", start).join(
        cut_step.select(F.col("source").alias("s"), F.col("start").alias("t"), "before", "rest"),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("t")),
    )
    earlier = Window.partitionBy("source").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)) + F.col("size") / 2
    taken = fine.withColumn("middle", middle).where(F.col("middle") <= F.col("rest")).groupBy("source").agg(F.max("lot").alias("lot"))
    cuts = cut_step.join(taken.select(F.col("source").alias("s"), "lot"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("c"), F.coalesce("lot", "start").alias("cut")
    )
    return stages.write(totals.join(cuts, F.col("source").eqNullSafe(F.col("c")), "left").drop("c", "rest"), "plan")


def with_times(rows: DataFrame, plan: DataFrame, epochs: float = EPOCHS) -> DataFrame:
    """rows (with source and lot) and source_size, target, and times: how often each is taken (``epochs``, rounded up, at most)."""
    plan = plan.select(F.col("source").alias("_s"), "source_size", "target", "whole", "cut")
    once = F.when(F.col("lot") <= F.col("cut"), 1).otherwise(0)
    times = F.least(F.col("whole") + once, F.lit(math.ceil(epochs)))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("times", times).drop("_s", "whole", "cut")


def mix_sources(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """doc_id, source, size, source_size, target, times and taken, one row for each row of docs.

    Reads doc_id, text and source.  size is the number of words (null text: 0),
    taken is times * size.  Sources stand by code point, null (a source of its
    own) last, and take the weights in turn.  Documents of a source that fill
    its rest are those of smallest seeded hash, up to the one whose middle the
    rest reaches, so that what a source gives is off its target by half a
    document.  Rows equal in doc_id and text share one fate; a null doc_id
    hashes as none.  A source without words has target 0.  Other columns are
    not read; an empty table gives an empty result.  Reruns agree.
    """
    stages = Stages(docs.sparkSession, "mixture")
    rows = stages.write(sized(docs, seed), "sized")
    plan = plan_mix(rows, stages, **settings)
    return with_times(rows, plan, settings.get("epochs", EPOCHS)).select(
        "doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """The rows of docs, all their columns whatever their names, each as often as ``mix_sources`` takes it."""
    stages = Stages(docs.sparkSession, "mixture")
    plan = plan_mix(stages.write(sized(docs, seed), "sized"), stages, **settings)
    of, whole, cut, copy = spare(docs, "of", "whole", "cut", "copy")
    plan = plan.select(F.col("source").alias(of), F.col("whole").alias(whole), F.col("cut").alias(cut))
    times = F.col(whole) + F.when(lot(F.col("doc_id"), F.col("text"), seed) <= F.col(cut), 1).otherwise(0)
    times = F.least(times, F.lit(math.ceil(settings.get("epochs", EPOCHS))))
    joined = docs.join(plan, F.col("source").cast("string").eqNullSafe(F.col(of)))
    repeated = joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
