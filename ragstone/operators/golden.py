"""Golden questions: validation, selection, decisions, promotion, summaries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragstone.functions import text

DIFFICULTIES = ("single_hop", "multi_hop", "negative")
STATUSES = ("pending", "approved", "rejected")


def violations(golden: DataFrame) -> DataFrame:
    """id and violation of every broken rule of golden records; no rows if all is well but the set is not empty."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    sources = F.coalesce(F.size("source_ids"), F.lit(0))
    checks = {
        "missing id": blank("id"),
        "missing question": blank("question"),
        "missing ground_truth": blank("ground_truth"),
        "unknown difficulty": ~F.coalesce(F.col("difficulty").isin(*DIFFICULTIES), F.lit(False)),
        "bad added_in": ~F.coalesce(F.col("added_in").rlike(r"^v\d+$"), F.lit(False)),
        "negative with sources": (F.col("difficulty") == "negative") & (sources > 0),
        "answerable without sources": F.col("difficulty").isin("single_hop", "multi_hop") & (sources < 1),
    }
    found = F.array_compact(F.array(*[F.when(broken, name) for name, broken in checks.items()]))
    rows = golden.select("id", F.explode(found).alias("violation"))
    twice = golden.groupBy("id").count().filter("count > 1").select("id", F.lit("duplicate id").alias("violation"))
    empty = golden.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(None).cast("string").alias("id"), F.lit("empty set").alias("violation"))
    return rows.union(twice).union(empty)


def is_answerable() -> Column:
    return (F.col("difficulty") != "negative") & (F.size("source_ids") > 0)


def dataset_version(golden: DataFrame) -> DataFrame:
    return golden.agg(F.concat(F.lit("v"), F.max(F.regexp_extract("added_in", r"^v(\d+)$", 1).try_cast("int")).cast("string")).alias("version"))


def select_chunks(chunks: DataFrame, limit: int, per_page: int = 2, least_chars: int = 200) -> DataFrame:
    """``limit`` chunks (page_path, chunk_index, text) spread over pages, with tier and depth.

    Tier 1: the first ``per_page`` of every stride-th page; tier 2: deeper ones of those; tier 3: the
    rest. Within a tier by depth, then page. Page numbers come from the distinct pages alone.
    """
    rows = chunks.filter(F.length(text.strip(F.col("text"))) >= least_chars)
    pages = rows.select("page_path").distinct()
    wanted = -(-limit // per_page)
    number = F.row_number().over(Window.orderBy("page_path")) - 1
    pages = pages.withColumns({"page_no": number, "n_pages": F.count(F.lit(1)).over(Window.partitionBy())})
    stride = F.when(F.col("n_pages") > wanted, F.ceil(F.col("n_pages") / wanted)).otherwise(1)
    depth = F.row_number().over(Window.partitionBy("page_path").orderBy("chunk_index")) - 1
    rows = rows.withColumn("depth", depth).join(pages.withColumn("chosen", F.col("page_no") % stride == 0), "page_path")
    tier = F.when(F.col("chosen") & (F.col("depth") < per_page), 1).when(F.col("chosen"), 2).otherwise(3)
    return rows.withColumn("tier", tier).orderBy("tier", "depth", "page_no").limit(limit)


def decision_faults(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidate_id and fault: unknown ids, repeated ids, bad verdicts, blank rewrites."""
    unknown = decisions.join(candidates.select("candidate_id"), "candidate_id", "left_anti").select("candidate_id", F.lit("unknown id").alias("fault"))
    twice = decisions.groupBy("candidate_id").count().filter("count > 1").select("candidate_id", F.lit("repeated id").alias("fault"))
    bad = decisions.filter(~F.coalesce(F.col("decision").isin("approve", "reject", "review"), F.lit(False))).select("candidate_id", F.lit("bad verdict").alias("fault"))
    blank = decisions.filter((F.trim("question") == "") | (F.trim("ground_truth") == "")).select("candidate_id", F.lit("blank rewrite").alias("fault"))
    return unknown.union(twice).union(bad).union(blank)


def refuse(faults: DataFrame, what: str) -> None:
    """Raise ValueError with the first of ``faults``, if there are any."""
    if found := faults.head(5):
        raise ValueError(f"{what}: " + "; ".join(", ".join(f"{k}={v!r}" for k, v in row.asDict().items()) for row in found))


def apply_decisions(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """``with_decisions`` after every decision was found to be sound; raises ValueError with the first faults."""
    if "_corrupt" in decisions.columns:
        refuse(decisions.filter("_corrupt is not null").select("candidate_id", "_corrupt"), "unreadable decisions")
    refuse(decision_faults(decisions, candidates), "decisions")
    return with_decisions(candidates, decisions)


def with_decisions(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """``candidates`` with human decisions applied: status, and rewritten question and ground_truth."""
    d = decisions.select("candidate_id", F.col("decision").alias("d"), F.col("question").alias("q"), F.col("ground_truth").alias("a"))
    status = F.when(F.col("d") == "approve", "approved").when(F.col("d") == "reject", "rejected").when(F.col("d") == "review", "pending").otherwise(F.col("status"))
    rows = candidates.join(d, "candidate_id", "left")
    return rows.withColumns({"status": status, "question": F.coalesce("q", "question"), "ground_truth": F.coalesce("a", "ground_truth")}).drop("d", "q", "a")


def _promotable(candidates: DataFrame, golden: DataFrame) -> DataFrame:
    """Approved ``candidates`` with their key and ``skip``: known or repeated questions, and sources that do not suit the difficulty."""
    key = lambda c: F.lower(text.strip(F.coalesce(F.col(c), F.lit(""))))
    n_sources = F.coalesce(F.size("source_ids"), F.lit(0))
    fine = F.when(F.coalesce(F.col("difficulty") == "negative", F.lit(False)), n_sources <= 0).otherwise(n_sources > 0)
    rows = candidates.filter(F.col("status") == "approved").withColumns({"key": key("question"), "fine": fine})
    known = golden.select(key("question").alias("key"), F.lit(True).alias("known")).distinct()
    nth = F.row_number().over(Window.partitionBy("key", "fine").orderBy("pos"))
    rows = rows.join(known, "key", "left").withColumn("nth", nth)
    return rows.withColumn("skip", F.col("known").isNotNull() | ~F.col("fine") | (F.col("nth") > 1))


def promote(candidates: DataFrame, golden: DataFrame, version: str) -> DataFrame:
    """New golden records from approved ``candidates`` (with pos), as ``version`` (like v2); ids go on from the highest, or start at 1.

    Known and repeated questions are skipped, and negatives with sources and others without (null counts
    as none); a skipped candidate does not make a later one repeated. Question and ground truth are
    stripped.
    """
    if not re.fullmatch(r"v\d+", version):
        raise ValueError(f"version must look like 'v2', got {version!r}")
    rows = _promotable(candidates, golden).filter("not skip")
    base = golden.agg((F.coalesce(F.max(F.regexp_extract("id", r"^q_(\d+)$", 1).try_cast("int")), F.lit(0)) + 1).alias("base"))
    number = F.row_number().over(Window.orderBy("pos")) - 1
    rows = rows.withColumn("number", number).join(F.broadcast(base))
    new_id = F.format_string("q_%04d", (F.col("number") + F.col("base")).cast("int"))
    stripped = [text.strip(F.col(c)).alias(c) for c in ("question", "ground_truth")]
    return rows.select(new_id.alias("id"), *stripped, F.coalesce("source_ids", F.array().cast("array<string>")).alias("source_ids"), "difficulty", F.lit(version).alias("added_in"))


def promote_skipped(candidates: DataFrame, golden: DataFrame) -> DataFrame:
    """candidate_id of the approved ``candidates`` that ``promote`` skips."""
    return _promotable(candidates, golden).filter("skip").select("candidate_id")


def queue_summary(candidates: DataFrame) -> DataFrame:
    """dimension, value, n: counts by status, difficulty and decision in one pass over grouping sets."""
    decision = F.coalesce("decision", F.lit("unevaluated"))
    rows = candidates.select("status", "difficulty", decision.alias("decision"))
    sets = rows.groupingSets([["status"], ["difficulty"], ["decision"]], "status", "difficulty", "decision").agg(F.count(F.lit(1)).alias("n"), F.grouping("status").alias("s"), F.grouping("difficulty").alias("d"))
    dimension = F.when(F.col("s") == 0, "status").when(F.col("d") == 0, "difficulty").otherwise("decision")
    counted = sets.select(dimension.alias("dimension"), F.coalesce("status", "difficulty", "decision").alias("value"), "n")
    domain = candidates.sparkSession.createDataFrame([("status", s) for s in STATUSES], "dimension string, value string")
    missing = domain.join(counted, ["dimension", "value"], "left_anti").select("dimension", "value", F.lit(0).cast("long").alias("n"))
    return counted.union(missing)
