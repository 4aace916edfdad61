"""Relational parts of training runs: schedules, perplexity, best so far, top-k thresholds, batch plans."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def learning_rate(step: Column, peak: float, floor: float, warmup: int, steps: int) -> Column:
    """Linear warm-up, then half a cosine down to `floor`, where it stays."""
    done = F.least((step - warmup) / (steps - warmup), F.lit(1.0))
    return F.when(step < warmup, peak * step / max(warmup, 1)).otherwise(floor + 0.5 * (1 + F.cos(math.pi * done)) * (peak - floor))


def perplexity(loss: Column, capped: bool = True) -> Column:
    return F.exp(F.least(loss, F.lit(20.0)) if capped else loss)


def running_best(df: DataFrame, group: str, step: str, loss: str) -> DataFrame:
    """The rows with `best_before` (null at first) and whether the row is a new best."""
    before = F.min(loss).over(Window.partitionBy(group).orderBy(step).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("best_before", before).withColumn("is_best", F.col("best_before").isNull() | (F.col(loss) < F.col("best_before")))


def top_k(values: Column, k: int) -> Column:
    """The values that are at least the k-th largest; ties stay."""
    kth = F.get(F.sort_array(values, asc=False), F.least(F.lit(k), F.size(values)) - 1)
    return F.filter(values, lambda x: x >= kth)


def batch_plan(spark: SparkSession, topics: DataFrame, target: int, size: int) -> DataFrame:
    """(topic, batch_idx, batch_key): whole batches per topic that reach the target, one at least.

    `topics` is a short list; its product with the batch numbers is the plan itself.
    """
    count = max(1, topics.count())
    per_topic = max(size, -(-target // count))
    batches = -(-per_topic // size)
    plan = topics.select("topic").withColumn("batch_idx", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    return plan.withColumn("batch_key", F.concat_ws("_", "topic", F.col("batch_idx").cast("string")))


def prompts(plan: DataFrame, template: str) -> DataFrame:
    """The plan with `prompt`: a template with {topic} and {batch} filled in."""
    filled = F.replace(F.replace(F.lit(template), F.lit("{topic}"), F.col("topic")), F.lit("{batch}"), (F.col("batch_idx") + 1).cast("string"))
    return plan.withColumn("prompt", filled)
