"""Answers by echo, and their lexical grading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragstone.functions import similarity, text

METRICS = ("faithfulness", "answer_relevancy", "context_precision", "answer_correctness")
#: Fixed value: the answer without a context.
REFUSAL = "I don't have enough information in the provided guidance to answer that."


def echo_answer(contexts: Column, n_sentences: int = 2, refusal: str = REFUSAL) -> Column:
    """The first sentences of the contexts, joined; ``refusal`` if all are blank."""
    kept = F.filter(F.transform(contexts, text.strip), lambda c: c != "")
    return F.when(F.size(kept) == 0, refusal).otherwise(F.array_join(F.slice(text.loose_sentences(F.array_join(kept, " ")), 1, n_sentences), " "))


def heuristic_scores(samples: DataFrame) -> DataFrame:
    """``samples`` (question, answer, contexts, ground_truth) with the four lexical metrics."""
    context, truth = F.array_join("contexts", " "), F.col("ground_truth")
    against = F.when(F.coalesce(truth, F.lit("")) == "", F.col("question")).otherwise(truth)
    return samples.withColumns(
        {
            "faithfulness": similarity.raw_overlap(F.col("answer"), context),
            "answer_relevancy": similarity.raw_overlap(F.col("answer"), F.col("question")),
            "context_precision": similarity.raw_overlap(context, against),
            "answer_correctness": similarity.raw_overlap(F.col("answer"), F.coalesce(truth, F.lit(""))),
        }
    )


def judge_means(scored: DataFrame) -> DataFrame:
    """One row of means; zeros over no samples."""
    return scored.agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in METRICS], F.count(F.lit(1)).alias("n_judged"))


def weighted_precision(similarities: Column) -> Column:
    """Sum of similarity / rank over the sum of 1 / rank, each similarity clamped to [0, 1]."""
    part = lambda f: F.aggregate(F.transform(similarities, f), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(similarities) == 0, 0.0).otherwise(part(lambda x, i: text.clamp01(x) / (i + 1)) / part(lambda x, i: 1.0 / (i + 1)))


def faithfulness(answer: Column, contexts: Column, entailment, most: int = 5) -> Column:
    """Mean over the answer's sentences of the best ``entailment(context, sentence)`` among the first contexts."""
    said = text.sentences(answer)
    first = F.filter(F.slice(contexts, 1, most), lambda c: text.strip(c) != "")
    best = F.transform(said, lambda s: F.array_max(F.transform(first, lambda c: entailment(c, s))))
    return F.when((F.size(said) == 0) | (F.size(first) == 0), 0.0).otherwise(F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / F.size(said))


def run_spread(runs: DataFrame) -> DataFrame:
    """metric, median, least, most, runs of ``runs`` (metric, value): repeated runs of a judge."""
    value = text.as_finite(F.col("value"))
    return runs.withColumn("v", value).groupBy("metric").agg(F.median("v").alias("median"), F.min("v").alias("least"), F.max("v").alias("most"), F.array_sort(F.collect_list("v")).alias("runs"))


def noise(runs: DataFrame) -> DataFrame:
    """metric, mean, sd, rel_sd (sample deviation) of ``runs`` (metric, value)."""
    return runs.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd")).withColumn("rel_sd", F.col("sd") / F.col("mean"))
