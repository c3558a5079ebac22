"""A mix of sources whose token shares meet their targets.

Every record gets a hash-random key; each source is put in the order of these keys by a range sort, so a source
of any size is spread over many partitions. Distributed prefix sums (running sums inside each partition, shifted
by the totals of the partitions before it) give the place of each record in its source, and the source is cut at its exact
budget: whole passes over the source first, then the records up to the cut. A source is never used more often
than its cap.

Defined results: without a given total, the mix is the largest one in which every source meets its share within
its cap; with a total, a source that runs out falls short and the report says so. Records without tokens, of no
listed source, or with a NULL source are not used. Targets of sources without any tokens are reported with
nothing and left out of the shares. The record at the cut is taken if more than half of it lies before the cut.
Ties of the random key go by the record's key; repeated rows are records of their own. Empty tables give an
empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.tokenizer import VOCABULARY, count_tokens
from postloom.operators.ordered import running_sums
from postloom.runtime import broadcast_if_small, cut


def source_budgets(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row for each target: source, share, max_repeats, available, budget, passes (whole ones), rest (tokens of the last pass)."""
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("n_docs"))
    plan = targets.filter("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("bigint").alias("max_repeats"))
    plan = plan.join(broadcast_if_small(cut(have)), "source", "left").fillna(0, ["available", "n_docs"])
    every = Window.partitionBy(F.lit(1))  # one row per source of the mix
    plan = plan.withColumn("share", F.when(F.col("available") > 0, F.col("target_share")))
    plan = plan.withColumn("share", F.col("share") / F.sum("share").over(every))
    cap = F.col("available") * F.col("max_repeats")
    total = F.lit(float(total_tokens)) if total_tokens is not None else F.min(F.when(F.col("share") > 0, cap / F.col("share"))).over(every)
    plan = plan.withColumn("budget", F.coalesce(F.least(F.round(F.col("share") * total).cast("bigint"), cap), F.lit(0).cast("bigint")))
    whole = F.when(F.col("available") > 0, F.floor(F.col("budget") / F.greatest(F.col("available"), F.lit(1)))).otherwise(0).cast("bigint")
    return plan.withColumn("passes", whole).withColumn("rest", F.col("budget") - F.col("passes") * F.col("available"))


def mix_sources(docs: DataFrame, targets: DataFrame, key: str = "doc_id", total_tokens: int | None = None, seed: int = 42, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(mix, report). mix: key, source, n_tokens, copies; report: one row for each target with the shares reached."""
    named = broadcast_if_small(cut(targets.filter("source is not null").select("source").distinct()))
    wanted = docs.filter("source is not null and text is not null").join(named, "source", "left_semi")
    sizes = count_tokens(wanted.select(F.struct(F.col(key), F.col("source")).alias("_k"), "text"), "_k", "text", vocabulary)
    sizes = sizes.filter("n_tokens > 0").select(F.col(f"_k.{key}").alias(key), F.col("_k.source").alias("source"), "n_tokens", F.xxhash64(F.col(f"_k.{key}"), F.lit(seed)).alias("_draw"))
    sizes = cut(sizes)  # the range sort samples its input; texts are tokenised once
    # Range partitions over (source, draw); sums run on inside them and across their borders.
    placed = running_sums(sizes, ["source"], ["_draw", key], {"_before": F.col("n_tokens")})
    budgets = cut(source_budgets(sizes.select("source", "n_tokens"), targets, total_tokens))
    placed = placed.join(broadcast_if_small(budgets.select("source", "passes", "rest", "max_repeats")), "source")
    into_rest = (F.col("_before") + F.col("n_tokens") / 2) < F.col("rest")
    copies = F.least(F.col("passes") + into_rest.cast("bigint"), F.col("max_repeats"))
    mix = placed.select(key, "source", "n_tokens", copies.alias("copies")).filter("copies > 0")
    used = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("records"))
    report = budgets.join(used, "source", "left").fillna(0, ["tokens", "records"])
    share = F.try_divide(F.col("tokens").cast("double"), F.sum("tokens").over(Window.partitionBy(F.lit(1))))
    return mix, report.select("source", "target_share", F.coalesce(share, F.lit(0.0)).alias("actual_share"), "tokens", "records", "available", "budget", "max_repeats")
