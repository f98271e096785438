"""The gate: metrics against floors, tolerances and a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def gated(current: DataFrame, baseline: DataFrame, rules: DataFrame, comparable: bool = True) -> DataFrame:
    """suite, metric, current, baseline, passed, reason, blocking, gates for every rule with a current value.

    ``rules``: suite, metric, floor, max_drop, gating. The floor is looked at first; both limits are
    strict; a baseline that is not positive, or none, sets no tolerance. A rule that does not gate, and
    every rule of a run that is not comparable, is only reported: it passes, with an empty reason.
    """
    rows = rules.join(current.withColumnRenamed("value", "current"), ["suite", "metric"]).join(baseline.withColumnRenamed("value", "baseline"), ["suite", "metric"], "left")
    drop = F.when(F.col("baseline") > 0, (F.col("baseline") - F.col("current")) / F.col("baseline"))
    gates = F.coalesce("gating", F.lit(True)) & F.lit(comparable)
    reason = F.when(~gates, "").when(F.col("current") < F.col("floor"), "floor").when(drop > F.col("max_drop"), "drop").otherwise("")
    rows = rows.withColumn("reason", reason).withColumn("passed", F.col("reason") == "")
    return rows.select("suite", "metric", "current", "baseline", "passed", "reason", (~F.col("passed")).alias("blocking"), gates.alias("gates"))


def comparability(results: dict, baseline: dict, expected_version: str) -> tuple[dict[str, bool], list[str]]:
    """Whether each suite can be held against ``baseline``, by name ("" for all others), and why not.

    Another dataset version, or no baseline, makes the whole run report only; a judge suite also needs
    the same recorded grader and as many questions judged. ValueError if there are no results, or they
    carry another version than ``expected_version``.
    """
    version, then = results.get("dataset_version"), baseline.get("dataset_version")
    if not results:
        raise ValueError("no results")
    if version != expected_version:
        raise ValueError(f"results carry dataset {version!r}, {expected_version!r} is expected")
    if not baseline:
        return {"": False, "judge": False}, ["There is no baseline; this is a report only."]
    whole, notes = then == version, []
    if not whole:
        notes.append(f"The dataset moved from `{then}` to `{version}`; this is a report only.")
    judged = whole
    grader, before = results.get("judge_backend"), baseline.get("judge_backend")
    n, n_before = results.get("judge_n_judged"), baseline.get("judge_n_judged")
    if results.get("judge") and grader and grader != before:
        judged = False
        notes.append(f"Judge: the grader is `{grader}`, the baseline's is " + (f"`{before}`." if before else "not recorded."))
    elif results.get("judge") and n and n_before and n != n_before:
        judged = False
        notes.append(f"Judge: {n} questions were judged, {n_before} for the baseline.")
    return {"": whole, "judge": judged}, notes


def baseline_of(results: dict) -> dict:
    """What of ``results`` a baseline keeps: versions, metrics and counts, nothing per question; the judge's part only if it ran."""
    detail, judged = results.get("retrieval_detail") or {}, results.get("judge_detail") or {}
    kept = {"dataset_version": results.get("dataset_version"), "retrieval": results.get("retrieval") or {}}
    kept["retrieval_detail"] = {k: detail[k] for k in ("n_questions", "n_answerable", "n_negatives") if k in detail}
    if results.get("judge"):
        kept |= {k: results.get(k) for k in ("judge", "judge_runs", "judge_backend", "judge_n_judged")}
        kept["judge_spread"] = judged.get("spread") or {}
        if judged.get("truncated"):
            kept["judge_truncated_from"] = judged.get("n_answerable_total")
    return kept


def gate_run(spark: SparkSession, results: dict, baseline: dict, thresholds: dict) -> tuple[int, DataFrame | None, list[str]]:
    """(exit code, result rows, notes) of the ``thresholds`` (dataset.version, suites) over two result files.

    2: the run cannot be held against anything; 1: a gating rule failed; 0: none did.
    """
    try:
        comparable, notes = comparability(results, baseline, thresholds["dataset"]["version"])
    except ValueError as e:
        return 2, None, [str(e)]
    rules, values = [], {"current": [], "baseline": []}
    for suite, about in thresholds["suites"].items():
        for metric, rule in about["metrics"].items():
            gating = about.get("gating", True) and rule.get("gating", True) and comparable.get(suite, comparable[""])
            number = lambda k: None if rule.get(k) is None else float(rule[k])  # noqa: B023, E731
            rules.append((suite, metric, number("absolute_floor"), number("max_relative_drop"), bool(gating)))
            for side, file in (("current", results), ("baseline", baseline)):
                if (file.get(suite) or {}).get(metric) is not None:
                    values[side].append((suite, metric, float(file[suite][metric])))
    frame = lambda rows: spark.createDataFrame(rows, "suite string, metric string, value double")
    rows = gated(frame(values["current"]), frame(values["baseline"]), spark.createDataFrame(rules, "suite string, metric string, floor double, max_drop double, gating boolean"))
    return exit_code(rows), rows, notes


def exit_code(result: DataFrame, version_matches: bool = True) -> int:
    """0 pass, 1 a blocking failure, 2 not comparable."""
    if not version_matches:
        return 2
    return int(not result.filter("blocking").isEmpty())


def regressions(current: DataFrame, baseline: DataFrame, least_drop: float = 0.30, most: int = 5) -> DataFrame:
    """id, delta of the questions (id, value) that fell by ``least_drop`` or more, worst first. Beyond the gate's own rules."""
    rows = current.join(baseline.withColumnRenamed("value", "was"), "id").withColumn("delta", F.col("value") - F.col("was"))
    return rows.filter(F.col("delta") <= -least_drop).orderBy("delta", "id").limit(most).select("id", "delta")


def band_faults(rules: DataFrame, noise: DataFrame, sigmas: float = 3.0, least: float = 0.02) -> DataFrame:
    """metric and fault of tolerances below ``sigmas`` relative deviations or below ``least``."""
    rows = rules.join(noise.select("metric", "rel_sd"), "metric", "left")
    fault = F.when(F.col("max_drop") < least, "narrow").when(F.col("max_drop") < sigmas * F.col("rel_sd"), "within noise")
    return rows.select("metric", fault.alias("fault")).filter("fault is not null")


def winner(experiments: DataFrame, metric: str = "value") -> DataFrame:
    """``experiments`` (name, metric) with ``won``: the best metric, ties to the first name."""
    best = F.row_number().over(Window.orderBy(F.desc_nulls_last(metric), "name"))
    return experiments.withColumn("won", best == 1)
