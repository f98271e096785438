"""Evaluation suites: retrieval and judging over a golden set, comparison of configurations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragstone.functions import similarity, text
from ragstone.operators import golden as golden_set
from ragstone.operators import indexing, judge, retrieval

RETRIEVAL_METRICS = ("hit_at_5", "mrr", "context_recall_at_10", "served_context_recall")
#: What rankings are cut at for scoring; dollars a question for grading (by backend) and
#: for answering (by provider); the guards of a judge run.
DEPTH = 10
GRADING_COST = {"heuristic": 0.0, "nli": 0.0, "ragas": 0.03}
GENERATION_COST = {"echo": 0.0, "openai": 0.002, "anthropic": 0.003}
CAPS = {"max_judge_questions_per_run": 120, "max_usd_per_run": 4.00}


def answerable(golden: DataFrame, limit: int | None = None) -> DataFrame:
    """The answerable questions of ``golden`` (with line_no); with ``limit`` the first so many in file order."""
    rows = golden.filter(golden_set.is_answerable())
    return rows if limit is None else rows.orderBy("line_no").limit(limit)


def coverage(golden: DataFrame, limit: int | None = None) -> DataFrame:
    """One row: n_questions, n_negatives, n_answerable_total, n_answerable (taken under ``limit``) and truncated."""
    total = F.count_if(golden_set.is_answerable())
    taken = total if limit is None else F.least(total, F.lit(limit))
    return golden.agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.count_if(F.col("difficulty") == "negative").alias("n_negatives"),
        total.alias("n_answerable_total"),
        taken.cast("long").alias("n_answerable"),
        (taken < total).alias("truncated"),
    )


def scored_questions(questions: DataFrame, ranking: DataFrame, index: DataFrame, served: int = 5) -> DataFrame:
    """Per question (id, difficulty, source_ids): the metrics, first_relevant_rank, retrieved, expected, and expected ids that ``index`` (id) lacks.

    ``ranking``: qid, id, rank, of DEPTH at least. A question that nothing was retrieved for has zeros.
    """
    relevant = questions.select(F.col("id").alias("qid"), F.explode("source_ids").alias("id"))
    metrics = retrieval.question_metrics(ranking, relevant, served, DEPTH)
    # At most DEPTH rows per question are gathered.
    retrieved = ranking.filter(F.col("rank") <= DEPTH).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("r"))
    missing = retrieval.missing_gold(relevant, index).groupBy("qid").agg(F.collect_set("id").alias("m"))
    empty = F.array().cast("array<string>")
    rows = questions.select(F.col("id").alias("qid"), "difficulty", F.col("source_ids").alias("expected")).join(metrics, "qid").join(retrieved, "qid", "left").join(missing, "qid", "left")
    return rows.select(
        F.col("qid").alias("id"),
        "difficulty",
        "hit_at_5",
        F.col("reciprocal_rank").alias("mrr"),
        F.col(f"recall_at_{DEPTH}").alias("context_recall_at_10"),
        F.col("served_recall").alias("served_context_recall"),
        "first_relevant_rank",
        F.coalesce(F.transform("r", lambda x: x["id"]), empty).alias("retrieved"),
        "expected",
        F.filter("expected", lambda e: F.array_contains(F.coalesce("m", empty), e)).alias("expected_missing_from_index"),
    )


def retrieval_summary(golden: DataFrame, scored: DataFrame, limit: int | None = None) -> DataFrame:
    """One row: the counts of ``coverage`` and the mean of each metric over ``scored``, 0 over none."""
    means = scored.agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in RETRIEVAL_METRICS])
    return coverage(golden, limit).join(means)  # two tables of one row


def by_difficulty(scored: DataFrame) -> DataFrame:
    """difficulty, n and the mean of each metric. An extension: questions carry their difficulty for this."""
    return scored.groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(m) for m in RETRIEVAL_METRICS])


def retrieval_suite(golden: DataFrame, chunks: DataFrame, config: dict, embedder: indexing.Embedder | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary, scored questions) of searching ``chunks`` for the answerable questions of ``golden``."""
    questions, served = answerable(golden, limit), config["retrieval"]["top_k"]
    ranking = indexing.retrieve(questions.select(F.col("id").alias("qid"), "question"), chunks, config, embedder, max(served, DEPTH))
    scored = scored_questions(questions, ranking, chunks.select(F.col("chunk_id").alias("id")), served)
    return retrieval_summary(golden, scored, limit), scored


# --- judging -------------------------------------------------------------------------------------


def samples(questions: DataFrame, ranking: DataFrame, chunks: DataFrame, generate: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """id, question, ground_truth, contexts (texts in rank order) and answer of each question.

    ``ranking`` (qid, id, rank) holds what is served, so few texts are gathered per question; one
    without any has no contexts. ``generate`` makes an answer of question and contexts, by default an
    echo of the first sentences.
    """
    generate = generate or (lambda _, contexts: judge.echo_answer(contexts))
    served = ranking.join(chunks.select(F.col("chunk_id").alias("id"), F.col("text").alias("context")), "id")
    gathered = served.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "context"))).alias("r")).select(F.col("qid").alias("id"), F.transform("r", lambda x: x["context"]).alias("contexts"))
    rows = questions.select("id", "question", "ground_truth").join(gathered, "id", "left").withColumn("contexts", F.coalesce("contexts", F.array().cast("array<string>")))
    return rows.withColumn("answer", generate(F.col("question"), F.col("contexts")))


def semantic_scores(rows: DataFrame, embedder: indexing.Embedder, entailment: Callable[[Column, Column], Column] | None = None, most: int = 5) -> DataFrame:
    """``rows`` (question, answer, contexts, ground_truth) with the four metrics, by vectors and ``entailment(context, sentence)``.

    Blank contexts among the first ``most`` do not count; a similarity with a blank or null text is 0.
    All texts of a row are embedded in one call. Without a model, entailment is the part of the
    sentence's words that the context has.
    """
    entailment = entailment or (lambda context, sentence: similarity.raw_overlap(sentence, context))
    full = lambda x: F.coalesce(text.strip(x) != "", F.lit(False))
    first = F.filter(F.slice("contexts", 1, most), full)
    rows = rows.withColumn("_c", first)
    rows = rows.withColumn("_v", embedder.embed(F.concat(F.array("question", "answer", "ground_truth"), F.col("_c"))))
    near = lambda i, j, a, b: F.when(full(F.col(a)) & full(F.col(b)), text.clamp01(similarity.cosine(F.col("_v")[i], F.col("_v")[j]))).otherwise(0.0)
    to_contexts = F.transform(F.slice("_v", 4, F.greatest(F.size("_c"), F.lit(0))), lambda v: similarity.cosine(F.col("_v")[0], v))
    f1 = similarity.token_f1(F.coalesce("answer", F.lit("")), F.coalesce("ground_truth", F.lit("")))
    scores = {
        "faithfulness": F.coalesce(judge.faithfulness(F.col("answer"), F.col("_c"), entailment, most), F.lit(0.0)),
        "answer_relevancy": near(0, 1, "question", "answer"),
        "context_precision": F.when(full(F.col("question")), judge.weighted_precision(to_contexts)).otherwise(0.0),
        "answer_correctness": 0.5 * near(1, 2, "answer", "ground_truth") + 0.5 * f1,
    }
    return rows.withColumns(scores).drop("_c", "_v")


def graded_mean(scored: DataFrame, metrics: tuple[str, ...] = judge.METRICS) -> DataFrame:
    """One row: the mean of the finite scores of each metric.

    Scores that are null, NaN or infinite failed to grade and do not count; running the plan raises if
    a metric has none, or nothing was graded: a zero would look like a collapse. A text or boolean
    column raises TypeError at once.
    """
    types = dict(scored.dtypes)
    if wrong := [m for m in metrics if types[m] in ("string", "binary", "boolean")]:
        raise TypeError(f"no scores: {wrong}")
    mean = lambda m: F.when(F.count(text.as_finite(F.col(m))) == 0, F.raise_error(F.lit(f"{m}: no usable score")).cast("double")).otherwise(F.avg(text.as_finite(F.col(m))))
    return scored.agg(*[mean(m).alias(m) for m in metrics])


def run_cost(n_questions: int, runs: int, backend: str, provider: str, most_usd: float = CAPS["max_usd_per_run"]) -> dict[str, float]:
    """Estimated dollars of a judge run, grading in each run and answering once; ValueError above ``most_usd``."""
    grading, generation = n_questions * runs * GRADING_COST.get(backend, 0.0), n_questions * GENERATION_COST.get(provider, 0.0)
    if grading + generation > most_usd:
        raise ValueError(f"the run would cost about ${grading + generation:.2f}, over the cap of ${most_usd:.2f}")
    return {"estimated_cost_usd": round(grading + generation, 4), "estimated_grading_usd": round(grading, 4), "estimated_generation_usd": round(generation, 4)}


def judge_suite(golden: DataFrame, chunks: DataFrame, config: dict, embedder: indexing.Embedder | None = None, runs: int = 1, backend: str = "nli", limit: int | None = None, caps: dict | None = None, generate=None, grade: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """The results of a judge run: metrics (medians of ``runs``), their spread, what was covered and cost.

    The question cap and the cost guard come first. Answers are made once and graded in each run by
    ``grade``, which adds the four metrics: by default the semantic scores (``nli``) or the lexical
    ones (``heuristic``). Questions that a cap leaves out are told by ``truncated``.
    """
    caps = {**CAPS, **(caps or {})}
    ceiling = min(x for x in (limit, caps["max_judge_questions_per_run"]) if x is not None)
    covered = coverage(golden, ceiling).first()
    if not runs >= 1 or not covered.n_answerable:
        raise ValueError("nothing to grade")
    cost = run_cost(covered.n_answerable, runs, backend, config["generation"]["provider"], caps["max_usd_per_run"])
    if generate is None and config["generation"]["provider"] != "echo":
        raise NotImplementedError(f"generation.provider {config['generation']['provider']!r}: pass generate instead")
    if grade is None:
        if backend not in ("nli", "heuristic"):
            raise NotImplementedError(f"judge backend {backend!r}: pass grade instead")
        embedder = embedder or indexing.embedder_of(config)
        grade = judge.heuristic_scores if backend == "heuristic" else lambda rows: semantic_scores(rows, embedder)
    questions = answerable(golden, ceiling)
    ranking = indexing.retrieve(questions.select(F.col("id").alias("qid"), "question"), chunks, config, embedder)
    # At most the cap's number of rows, graded more than once.
    answered = samples(questions, ranking, chunks, generate).persist()
    try:
        graded = [graded_mean(grade(answered)).first().asDict() for _ in range(runs)]
    finally:
        answered.unpersist()
    middle = lambda xs: (sorted(xs)[(len(xs) - 1) // 2] + sorted(xs)[len(xs) // 2]) / 2
    values = {m: [g[m] for g in graded] for m in judge.METRICS}
    return {
        "n_judged": covered.n_answerable,
        "n_answerable_total": covered.n_answerable_total,
        "truncated": covered.truncated,
        "runs": runs,
        "backend": backend,
        "generator": config["generation"]["provider"],
        "metrics": {m: middle(v) for m, v in values.items()},
        "spread": {m: {"min": min(v), "max": max(v), "runs": v} for m, v in values.items()},
        **cost,
    }


# --- experiments and drafts ----------------------------------------------------------------------


def run_experiments(configs: dict[str, dict | Exception], pages: DataFrame, golden: DataFrame, workdir: str, primary: str = "mrr") -> dict:
    """Index and retrieval suite of each configuration, in order of name, and the winner by ``primary``.

    One that cannot run here, or that could not be loaded (its exception stands in for it), is a row
    whose status says why. Ties go to the first name.
    """
    if primary not in RETRIEVAL_METRICS:
        raise ValueError(f"unknown metric {primary!r}")
    rows = []
    for name in sorted(configs):
        try:
            config = configs[name]
            if isinstance(config, Exception):
                raise config
            chunks = indexing.build_index(pages, config, f"{workdir}/{name}")
            summary = retrieval_suite(golden, chunks, config)[0].first()
            rows.append({"name": name, "metrics": {m: summary[m] for m in RETRIEVAL_METRICS}, "n_chunks": chunks.count(), "n_answerable": summary.n_answerable, "status": "ok"})
        except (NotImplementedError, ValueError, RuntimeError, ImportError, OSError, KeyError, TypeError) as e:
            rows.append({"name": name, "status": f"skipped: {type(e).__name__}: {e}"})
    ran = [r for r in rows if r["status"] == "ok"]
    best = min(ran, key=lambda r: (-r["metrics"][primary], r["name"]), default=None)
    return {"rows": rows, "winner": best and best["name"], "primary_metric": primary}


def fresh_drafts(drafts: DataFrame, seeds: DataFrame) -> DataFrame:
    """``drafts`` (pos, question) whose question no seed and no earlier draft has, up to case, space and end punctuation."""
    key = text.normalise_question(F.coalesce("question", F.lit("")))
    rows = drafts.withColumn("_key", key).join(seeds.select(key.alias("_key")).distinct(), "_key", "left_anti")
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy("pos"))).filter("_nth = 1").drop("_key", "_nth")


def nearest_questions(pairs: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most similar partners per id of ``pairs`` (id, other, similarity): ties to the smaller other."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k)
