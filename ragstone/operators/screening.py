"""Screening of drafted questions: an ordered rule table, deterministic criteria, near duplicates."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragstone.functions import similarity, text

# Thresholds and the rule table, first match wins. Conditions: facts that must hold,
# `fails` (one of these criteria failed), `clean` (all passed and no duplicate), `sure` (least confidence).
CRITERIA = ("relevance", "ground_truth_accuracy", "source_support", "question_quality")
DUPLICATE_SIMILARITY = 0.82
APPROVE_FROM, REJECT_FROM = 0.80, 0.70
QUESTION_OVERLAP, ANSWER_SUPPORT = 0.04, 0.30
QUESTION_LENGTH, ANSWER_LENGTH = (20, 300), 3
RULES: tuple[tuple[str, dict, str], ...] = (
    ("unparseable", {"complete": False}, "review"),
    ("negative_needs_corpus_check", {"is_negative": True}, "review"),
    ("no_passage", {"has_passage": False}, "review"),
    ("duplicate", {"duplicate": True, "sure": REJECT_FROM}, "reject"),
    ("duplicate_unsure", {"duplicate": True}, "review"),
    ("source_support_failed", {"fails": ("source_support",)}, "review"),
    ("clear_failure", {"fails": ("relevance", "ground_truth_accuracy"), "sure": REJECT_FROM}, "reject"),
    ("failure_unsure", {"fails": ("relevance", "ground_truth_accuracy")}, "review"),
    ("quality_fixable", {"fails": ("question_quality",)}, "review"),
    ("clean_and_confident", {"clean": True, "sure": APPROVE_FROM}, "approve"),
    ("clean_but_unsure", {"clean": True}, "review"),
    ("fallback", {}, "review"),
)


def _holds(condition: dict) -> Column:
    holds = F.lit(True)
    for name, want in condition.items():
        if name == "fails":
            one = F.lit(False)
            for criterion in want:
                one |= F.coalesce(F.col(criterion) == "fail", F.lit(False))
            holds &= one
        elif name == "sure":
            holds &= F.col("confidence") >= want
        elif name == "complete":
            holds &= _complete() == F.lit(want)
        elif name == "clean":
            passed = ~F.col("duplicate")
            for criterion in CRITERIA:
                passed &= F.coalesce(F.col(criterion) == "pass", F.lit(False))
            holds &= passed
        else:
            holds &= F.col(name) == F.lit(want)
    return holds


def _complete() -> Column:
    graded = F.lit(True)
    for criterion in CRITERIA:
        graded &= F.coalesce(F.col(criterion).isin("pass", "fail"), F.lit(False))
    return graded


def decided(facts: DataFrame, rules: Sequence[tuple[str, dict, str]] = RULES) -> DataFrame:
    """``facts`` (criteria, confidence, duplicate, is_negative, has_passage) with rule and decision."""
    rule, decision = F.lit(None), F.lit(None)
    for name, condition, verdict in reversed(rules):
        rule, decision = F.when(_holds(condition), name).otherwise(rule), F.when(_holds(condition), verdict).otherwise(decision)
    return facts.withColumns({"rule": rule.cast("string"), "decision": decision.cast("string")})


def screened(candidates: DataFrame) -> DataFrame:
    """``candidates`` (question, ground_truth, source_excerpt, difficulty, duplicate) with criteria, confidence, rule, decision.

    Confidence is the least margin to two decimals, rounded half to even on the decimal value.
    """
    q, a, p = (text.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("question", "ground_truth", "source_excerpt"))
    rows = candidates.withColumns({"__q": q, "__a": a, "__p": p})
    q, a, p = F.col("__q"), F.col("__a"), F.col("__p")
    rows = rows.withColumns({"q_overlap": F.when(p == "", 0.0).otherwise(similarity.overlap(q, p)), "gt_support": F.when(p == "", 0.0).otherwise(similarity.overlap(a, p)), "__odd": F.size(text.unsupported_figures(a, p)) > 0})
    echo = similarity.restates_question(a, q) & (F.size(text.content_tokens(a)) > 2)
    poor = text.is_self_referential(q) | (F.length(q) < QUESTION_LENGTH[0]) | (F.length(q) > QUESTION_LENGTH[1]) | ~text.reads_as_question(q)
    graded = lambda fails: F.when(fails, "fail").otherwise("pass")
    rows = rows.withColumns(
        {
            "relevance": graded(F.col("q_overlap") < QUESTION_OVERLAP),
            "source_support": graded(F.col("__odd") | (F.col("gt_support") < ANSWER_SUPPORT)),
            "ground_truth_accuracy": graded((F.length(a) < ANSWER_LENGTH) | echo),
            "question_quality": graded(poor),
            "is_negative": F.col("difficulty") == "negative",
            "has_passage": p != "",
        }
    )
    sure = F.least(
        text.margin(F.col("q_overlap"), QUESTION_OVERLAP, 0.15),
        F.when(F.col("__odd"), 0.0).otherwise(text.margin(F.col("gt_support"), ANSWER_SUPPORT, 0.25)),
        F.when(F.col("ground_truth_accuracy") == "fail", 0.0).otherwise(1.0),
        F.when(F.col("question_quality") == "fail", 0.0).otherwise(1.0),
    )
    return decided(rows.withColumn("confidence", F.bround(sure, 2))).drop("__q", "__a", "__p", "__odd")


def near_pairs(rows: DataFrame, threshold: float = DUPLICATE_SIMILARITY) -> DataFrame:
    """a, b, similarity (a < b) of rows (id, text) whose word sets have a Jaccard similarity of ``threshold`` or more.

    Rows with equal word sets are compared once: pairs are found between distinct sets, and a set's
    rows all pair with its least id and with the least id of a linked set. Candidates share a word of
    their prefixes in the order of ascending frequency, and fit in size.
    """
    sets = rows.select("id", F.array_sort(text.token_set(F.col("text"))).alias("words")).filter(F.size("words") > 0)
    distinct = sets.groupBy("words").agg(F.min("id").alias("id"))
    same = sets.join(distinct.withColumnRenamed("id", "a"), "words").filter(F.col("id") > F.col("a")).select("a", F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    words = distinct.select("id", F.size("words").alias("n"), F.explode("words").alias("word"))
    order = words.groupBy("word").agg(F.count(F.lit(1)).alias("often"))
    ranked = words.join(order, "word").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("often", "word"))).alias("words"))
    first = F.slice("words", 1, F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1)
    listed = ranked.select("id", "n", F.explode(first).alias("w")).select("id", "n", "w.word")
    x, y = (listed.select("word", F.col("id").alias(s), F.col("n").alias(f"n_{s}")) for s in "ab")
    fits = (F.col("a") < F.col("b")) & (F.col("n_a") >= threshold * F.col("n_b") - 1e-9) & (F.col("n_b") >= threshold * F.col("n_a") - 1e-9)
    pairs = x.join(y, "word").filter(fits).select("a", "b").distinct()
    side = lambda s: distinct.select(F.col("id").alias(s), F.col("words").alias(f"w_{s}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("similarity", similarity.jaccard(F.col("w_a"), F.col("w_b")))
    return near.filter(F.col("similarity") >= threshold).select("a", "b", "similarity").union(same)


def earlier_kept(nodes: DataFrame, pairs: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """id and rejected: a node (id, eligible) is rejected if it is eligible and an earlier neighbour is not rejected.

    ``pairs``: a, b with a < b. Each round decides all nodes whose earlier neighbours are decided; the
    state is checkpointed to the shared folder.
    """
    spark = nodes.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ragstone-"))
    state = nodes.select("id", "eligible", F.lit(None).cast("boolean").alias("rejected")).checkpoint()
    pairs = pairs.select("a", "b").distinct().checkpoint()
    for _ in range(most_rounds):
        before = pairs.join(state.select(F.col("id").alias("a"), F.col("rejected").alias("gone")), "a").groupBy("b").agg(F.bool_or(~F.coalesce("gone", F.lit(True))).alias("kept"), F.bool_or(F.col("gone").isNull()).alias("open"))
        now = F.when(~F.col("eligible") | F.coalesce(~F.col("kept") & ~F.col("open"), F.lit(True)), False).when(F.col("kept"), True)
        state = state.join(before.withColumnRenamed("b", "id"), "id", "left").select("id", "eligible", F.coalesce("rejected", now).alias("rejected")).checkpoint()
        if state.filter("rejected is null").isEmpty():
            return state.select("id", "rejected")
    raise RuntimeError("the chain of neighbours is longer than most_rounds")


def applied(status: Column, decision: Column, override: bool = False) -> Column:
    """The status after a decision; a human's approved or rejected stands unless ``override``."""
    new = F.when(decision == "approve", "approved").when(decision == "reject", "rejected").otherwise("pending")
    return new if override else F.when(status.isin("approved", "rejected"), status).otherwise(new)
