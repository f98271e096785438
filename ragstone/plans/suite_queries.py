"""Named queries of the suites, record checks and scalar rules, each with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragstone.functions import text
from ragstone.operators import chunking, golden, indexing, judge, suites
from ragstone.plans.catalogue import _RANKED, _SPACE_RE2, _ranking, _raw, _strip, _tok, query
from ragstone.sources.tables import table

# Every 50th vector is a question (every third of them a negative); its sources are the vectors of its
# label within 40 places and one id that no index has. The question takes its own document's text.
_GOLDEN = """
g AS (SELECT vec_id, CAST(vec_id AS VARCHAR) AS id, label, vec_id AS line_no, CASE WHEN vec_id % 150 = 0 THEN 'negative' WHEN vec_id % 100 = 0 THEN 'multi_hop' ELSE 'single_hop' END AS difficulty
      FROM embeddings WHERE vec_id % 50 = 0),
x AS (SELECT g.id AS qid, CAST(e.vec_id AS VARCHAR) AS id FROM g JOIN embeddings e ON e.label = g.label AND e.vec_id <> g.vec_id AND abs(e.vec_id - g.vec_id) <= 40 WHERE difficulty <> 'negative'
      UNION ALL SELECT id, 'gone-' || id FROM g WHERE difficulty <> 'negative'),
"""
_SCORED = f"""
WITH {_RANKED}, {_GOLDEN.rstrip().rstrip(",")},
h AS (SELECT x.qid, count(*) AS n, count(CASE WHEN rank <= 5 THEN 1 END) AS k5, count(rank) AS k10, min(rank) AS f, count(CASE WHEN x.id NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings) THEN 1 END) AS lost
      FROM x LEFT JOIN r ON CAST(r.qid AS VARCHAR) = x.qid AND CAST(r.id AS VARCHAR) = x.id GROUP BY x.qid),
m AS (SELECT qid AS id, CASE WHEN k5 > 0 THEN 1.0::DOUBLE ELSE 0 END AS hit_at_5, coalesce(1.0::DOUBLE / f, 0) AS mrr, k10 / n AS context_recall_at_10, k5 / n AS served_context_recall, CAST(f AS INTEGER) AS first_relevant_rank, n, lost FROM h)
"""


def _golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    difficulty = F.when(F.col("vec_id") % 150 == 0, "negative").when(F.col("vec_id") % 100 == 0, "multi_hop").otherwise("single_hop")
    asked = rows.filter("vec_id % 50 = 0").withColumn("difficulty", difficulty)
    near = asked.select(F.col("vec_id").alias("q"), "label", F.explode(F.sequence(F.col("vec_id") - 40, F.col("vec_id") + 40)).alias("vec_id"))
    near = near.filter("q <> vec_id").join(rows, ["vec_id", "label"]).groupBy(F.col("q").alias("vec_id")).agg(F.collect_list(F.col("vec_id").cast("string")).alias("near"))
    own = F.col("vec_id").cast("string")
    sources = F.when(F.col("difficulty") == "negative", F.array()).otherwise(F.concat(F.coalesce("near", F.array()), F.array(F.concat(F.lit("gone-"), own))))
    return asked.join(near, "vec_id", "left").select(own.alias("id"), F.col("vec_id").alias("line_no"), "difficulty", sources.cast("array<string>").alias("source_ids"))


def _as_text(ranking: DataFrame) -> DataFrame:
    return ranking.withColumns({c: F.col(c).cast("string") for c in ("qid", "id")})


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"))
    return suites.scored_questions(suites.answerable(_golden(spark, sf_dir)), _as_text(_ranking(spark, sf_dir)), index)


def _nine(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return rows.withColumns({n: F.round(n, 9) for n in names})


_ROUND9 = ", ".join(f"round({m}, 9) AS {m}" for m in suites.RETRIEVAL_METRICS)
_MEAN9 = ", ".join(f"round(coalesce(avg({m}), 0), 9) AS {m}" for m in suites.RETRIEVAL_METRICS)


@query(f"{_SCORED} SELECT m.id, difficulty, {_ROUND9}, first_relevant_rank, n AS n_expected, lost AS n_missing FROM m JOIN g ON g.id = m.id")
def suite_questions(spark, sf_dir):
    """The retrieval suite's row of each answerable question."""
    rows = _nine(_scored(spark, sf_dir), suites.RETRIEVAL_METRICS)
    return rows.select("id", "difficulty", *suites.RETRIEVAL_METRICS, "first_relevant_rank", F.size("expected").cast("long").alias("n_expected"), F.size("expected_missing_from_index").cast("long").alias("n_missing"))


@query(f"""{_SCORED} SELECT (SELECT count(*) FROM g) AS n_questions, (SELECT count(*) FROM g WHERE difficulty = 'negative') AS n_negatives,
(SELECT count(*) FROM g WHERE difficulty <> 'negative') AS n_answerable_total, (SELECT count(*) FROM g WHERE difficulty <> 'negative') AS n_answerable, FALSE AS truncated, {_MEAN9} FROM m""")
def suite_summary(spark, sf_dir):
    """The retrieval suite's counts and means."""
    return _nine(suites.retrieval_summary(_golden(spark, sf_dir), _scored(spark, sf_dir)), suites.RETRIEVAL_METRICS)


@query(f"{_SCORED} SELECT difficulty, count(*) AS n, {_MEAN9} FROM m JOIN g ON g.id = m.id GROUP BY difficulty")
def suite_by_difficulty(spark, sf_dir):
    """The retrieval suite's means by difficulty."""
    return _nine(suites.by_difficulty(_scored(spark, sf_dir)), suites.RETRIEVAL_METRICS)


@query("""
WITH g AS (SELECT doc_id, toxic FROM labels)
SELECT count(*) AS n_questions, count(*) FILTER (toxic = 1) AS n_negatives, count(*) FILTER (toxic <> 1) AS n_answerable_total, least(count(*) FILTER (toxic <> 1), 120) AS n_answerable,
       count(*) FILTER (toxic <> 1) > 120 AS truncated FROM g
""")
def judge_coverage(spark, sf_dir):
    """What a judge run covers under its question cap."""
    negative = F.col("toxic") == 1
    rows = table(spark, sf_dir, "labels").select(F.when(negative, "negative").otherwise("single_hop").alias("difficulty"), F.when(negative, F.array()).otherwise(F.array(F.lit("s"))).alias("source_ids"))
    return suites.coverage(rows, suites.CAPS["max_judge_questions_per_run"])


# --- judging -------------------------------------------------------------------------------------

_ANSWERED = f"""
WITH {_RANKED},
c AS (SELECT qid, list(text ORDER BY rank) AS contexts FROM r JOIN documents ON doc_id = id WHERE rank <= 5 GROUP BY qid),
a AS (SELECT doc_id AS id, text AS ground_truth, lang || ' ' || source || ' ' || left(text, 200) AS question, contexts, coalesce(contexts[1], '') AS answer FROM documents JOIN c ON qid = doc_id)
"""


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of every 50th vector's document, answered by the best context."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.join(_ranking(spark, sf_dir, 1).select(F.col("qid").alias("doc_id")), "doc_id")
    questions = asked.select(F.col("doc_id").alias("id"), F.concat_ws(" ", "lang", "source", F.left("text", F.lit(200))).alias("question"), F.col("text").alias("ground_truth"))
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), "text")
    return suites.samples(questions, _ranking(spark, sf_dir, 5), chunks, lambda _, contexts: F.coalesce(F.get(contexts, F.lit(0)), F.lit("")))


@query(f"{_ANSWERED} SELECT id, len(contexts) AS n_contexts, sha256(array_to_string(contexts, chr(10))) AS contexts, sha256(answer) AS answer FROM a")
def judge_samples(spark, sf_dir):
    """Contexts in rank order and the answer of each question."""
    rows = _answered(spark, sf_dir)
    return rows.select("id", F.size("contexts").cast("long").alias("n_contexts"), F.sha2(F.array_join("contexts", "\n"), 256).alias("contexts"), F.sha2("answer", 256).alias("answer"))


@query(f"""{_ANSWERED} SELECT round(avg({_raw('answer', "array_to_string(contexts, ' ')")}), 9) AS faithfulness, round(avg({_raw('answer', 'question')}), 9) AS answer_relevancy,
round(avg({_raw("array_to_string(contexts, ' ')", "CASE WHEN ground_truth = '' THEN question ELSE ground_truth END")}), 9) AS context_precision, round(avg({_raw('answer', 'ground_truth')}), 9) AS answer_correctness FROM a""")
def judge_suite_lexical(spark, sf_dir):
    """Means of the lexical judge over answered questions."""
    return _nine(suites.graded_mean(judge.heuristic_scores(_answered(spark, sf_dir))), judge.METRICS)


_LETTERS = "aeinrst"


def _letters(texts: Column) -> Column:
    """Counts of a few letters, a stand-in for an embedding that SQL can say."""
    return F.transform(texts, lambda x: F.array(*[(F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))).cast("double") for c in _LETTERS]))


_vector = lambda x: "[" + ", ".join(f"(length({x}) - length(replace({x}, '{c}', '')))::DOUBLE" for c in _LETTERS) + "]"
_norm = lambda v: f"sqrt(list_dot_product({v}, {v}))"
_cosine = lambda a, b: f"CASE WHEN {_norm(a)} * {_norm(b)} = 0 THEN 0 ELSE least(1, greatest(0, list_dot_product({a}, {b}) / ({_norm(a)} * {_norm(b)}))) END"
_full = lambda x: f"{_strip(x)} <> ''"


@query(f"""{_ANSWERED},
v AS (SELECT *, {_vector('question')} AS vq, {_vector('answer')} AS va, {_vector('ground_truth')} AS vg, list_distinct({_tok('answer')}) AS wa, list_distinct({_tok('ground_truth')}) AS wg FROM a),
e AS (SELECT id, vq, pos, {_vector('c')} AS vc FROM (SELECT id, vq, unnest(full_contexts) AS c, generate_subscripts(full_contexts, 1) AS pos FROM (SELECT *, list_filter(contexts, lambda c: {_full('c')}) AS full_contexts FROM v))),
p AS (SELECT id, sum({_cosine('vq', 'vc')} / pos) / sum(1.0::DOUBLE / pos) AS score FROM e GROUP BY id)
SELECT v.id, round(CASE WHEN {_full('question')} AND {_full('answer')} THEN {_cosine('vq', 'va')} ELSE 0 END, 9) AS answer_relevancy,
       round(CASE WHEN {_full('question')} THEN coalesce(p.score, 0) ELSE 0 END, 9) AS context_precision,
       round(0.5 * CASE WHEN {_full('answer')} AND {_full('ground_truth')} THEN {_cosine('va', 'vg')} ELSE 0 END
             + CASE WHEN len(list_intersect(wa, wg)) = 0 THEN 0 ELSE len(list_intersect(wa, wg)) / (len(wa) + len(wg)) END, 9) AS answer_correctness
FROM v LEFT JOIN p ON p.id = v.id
""")
def judge_semantic(spark, sf_dir):
    """Relevancy, precision and correctness by vectors, per answered question."""
    rows = suites.semantic_scores(_answered(spark, sf_dir), indexing.Embedder("letters", len(_LETTERS), _letters))
    return _nine(rows, judge.METRICS).select("id", "answer_relevancy", "context_precision", "answer_correctness")


# --- records, drafts and look-up -------------------------------------------------------------------

_KEY = f"lower(replace(regexp_replace({_strip(f'''regexp_replace(text, '{_SPACE_RE2}+', ' ', 'g')''')}, '^[?.!]+|[?.!]+$', '', 'g'), 'ß', 'ss'))"


@query(f"""
WITH t AS (SELECT doc_id, {_KEY} AS key FROM documents WHERE text IS NOT NULL),
d AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS nth FROM t WHERE doc_id % 10 <> 0)
SELECT doc_id AS pos FROM d WHERE nth = 1 AND key NOT IN (SELECT key FROM t WHERE doc_id % 10 = 0)
""")
def fresh_drafts(spark, sf_dir):
    """Drafted questions that neither the seeds (every tenth document) nor earlier drafts have."""
    rows = table(spark, sf_dir, "documents").filter("text is not null").select(F.col("doc_id").alias("pos"), F.col("text").alias("question"))
    return suites.fresh_drafts(rows.filter("pos % 10 <> 0"), rows.filter("pos % 10 = 0")).select("pos")


@query(f"WITH {_RANKED} SELECT qid AS id, id AS other, score AS similarity, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3")
def nearest_three(spark, sf_dir):
    """The three most similar partners of each question."""
    pairs = _ranking(spark, sf_dir).select(F.col("qid").alias("id"), F.col("id").alias("other"), F.col("score").alias("similarity"))
    return suites.nearest_questions(pairs)


_RECORDS = """
r AS (SELECT CASE WHEN doc_id % 31 = 0 THEN '' ELSE 'q_' || CAST(doc_id - (CASE WHEN doc_id % 37 = 0 AND doc_id > 0 THEN 1 ELSE 0 END) AS VARCHAR) END AS id, CASE WHEN doc_id % 29 = 0 THEN ' ' ELSE text END AS question, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE lang END AS ground_truth,
      CASE WHEN doc_id % 5 = 0 THEN 'negative' WHEN doc_id % 41 = 0 THEN 'odd' ELSE 'single_hop' END AS difficulty, CASE WHEN doc_id % 43 = 0 THEN 'x1' ELSE 'v' || CAST(1 + doc_id % 3 AS VARCHAR) END AS added_in,
      doc_id % 7 = 0 AS bare FROM documents)
"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.when(i % 31 == 0, "").otherwise(F.concat(F.lit("q_"), (i - F.when((i % 37 == 0) & (i > 0), 1).otherwise(0)).cast("string"))).alias("id"),
        F.when(i % 29 == 0, " ").otherwise(F.col("text")).alias("question"),
        F.when(i % 23 != 0, F.col("lang")).alias("ground_truth"),
        F.when(i % 5 == 0, "negative").when(i % 41 == 0, "odd").otherwise("single_hop").alias("difficulty"),
        F.when(i % 43 == 0, "x1").otherwise(F.concat(F.lit("v"), (1 + i % 3).cast("string"))).alias("added_in"),
        F.when(i % 7 != 0, F.array(F.lit("s"))).alias("source_ids"),
    )


@query(f"""
WITH {_RECORDS},
f AS (SELECT 'missing id' AS violation FROM r WHERE trim(coalesce(id, '')) = '' UNION ALL SELECT 'missing question' FROM r WHERE trim(coalesce(question, '')) = ''
      UNION ALL SELECT 'missing ground_truth' FROM r WHERE trim(coalesce(ground_truth, '')) = '' UNION ALL SELECT 'unknown difficulty' FROM r WHERE difficulty NOT IN ('single_hop', 'multi_hop', 'negative')
      UNION ALL SELECT 'bad added_in' FROM r WHERE NOT regexp_matches(added_in, '^v[0-9]+$') UNION ALL SELECT 'negative with sources' FROM r WHERE difficulty = 'negative' AND NOT bare
      UNION ALL SELECT 'answerable without sources' FROM r WHERE difficulty IN ('single_hop', 'multi_hop') AND bare UNION ALL SELECT 'duplicate id' FROM r GROUP BY id HAVING count(*) > 1)
SELECT violation, count(*) AS n FROM f GROUP BY violation
""")
def record_violations(spark, sf_dir):
    """How many golden records break each rule."""
    return golden.violations(_records(spark, sf_dir)).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_RECORDS} SELECT 'v' || CAST(max(TRY_CAST(regexp_extract(added_in, '^v([0-9]+)$', 1) AS INTEGER)) AS VARCHAR) AS version, count(*) FILTER (difficulty <> 'negative' AND NOT bare) AS n_answerable FROM r")
def record_version(spark, sf_dir):
    """The version of a golden set and its answerable questions."""
    rows = _records(spark, sf_dir)
    return golden.dataset_version(rows).join(rows.agg(F.count_if(golden.is_answerable()).alias("n_answerable")))


@query("""
WITH c AS (SELECT doc_id FROM documents WHERE doc_id % 4 <> 0),
d AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'approve' WHEN toxic = 1 THEN 'reject' ELSE 'maybe' END AS decision, CASE WHEN doc_id % 11 = 0 THEN ' ' END AS question FROM labels)
SELECT doc_id AS candidate_id, 'unknown id' AS fault FROM d WHERE doc_id NOT IN (SELECT doc_id FROM c) UNION ALL SELECT doc_id, 'bad verdict' FROM d WHERE decision = 'maybe'
UNION ALL SELECT doc_id, 'blank rewrite' FROM d WHERE question = ' ' UNION ALL SELECT doc_id, 'repeated id' FROM d GROUP BY doc_id HAVING count(*) > 1
""")
def decision_faults(spark, sf_dir):
    """Faults of human decisions over candidates."""
    candidates = table(spark, sf_dir, "documents").filter("doc_id % 4 <> 0").select(F.col("doc_id").alias("candidate_id"))
    verdict = F.when(F.col("quality") == 1, "approve").when(F.col("toxic") == 1, "reject").otherwise("maybe")
    made = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("candidate_id"), verdict.alias("decision"), F.when(F.col("doc_id") % 11 == 0, " ").alias("question"), F.lit(None).cast("string").alias("ground_truth"))
    return golden.decision_faults(made, candidates)


@query("""
WITH c AS (SELECT *, 'p/' || CAST(doc_id // 3 AS VARCHAR) AS page_path, CAST(doc_id % 3 AS INTEGER) AS chunk_index FROM documents),
k AS (SELECT *, page_path || '#chunk-' || CAST(chunk_index AS VARCHAR) AS chunk_id FROM c),
w AS (SELECT unnest([0, 1, 2, 3]) AS position, unnest(['p/3', 'p/5#chunk-1', 'p/none', 'p/7#chunk-9']) AS wanted),
f AS (SELECT position, wanted, chunk_id, text FROM w JOIN k ON wanted = chunk_id UNION ALL SELECT position, wanted, chunk_id, text FROM w JOIN k ON wanted = page_path)
SELECT CAST(position AS INTEGER) AS position, wanted, chunk_id, length(text) AS n_chars FROM (SELECT * FROM f UNION ALL SELECT position, wanted, NULL, NULL FROM w WHERE position NOT IN (SELECT position FROM f))
""")
def chunk_lookup(spark, sf_dir):
    """Chunks by id or page, and what was not found."""
    page = F.concat(F.lit("p/"), F.floor(F.col("doc_id") / 3).cast("string"))
    chunks = table(spark, sf_dir, "documents").select(page.alias("page_path"), (F.col("doc_id") % 3).cast("int").alias("chunk_index"), "text")
    chunks = chunks.withColumn("chunk_id", F.concat("page_path", F.lit("#chunk-"), F.col("chunk_index").cast("string")))
    found = indexing.looked_up(chunks, ["p/3", "p/5#chunk-1", "p/none", "p/7#chunk-9"])
    return found.select("position", "wanted", "chunk_id", F.length("text").cast("long").alias("n_chars"))


@query("SELECT CAST(vec_id AS VARCHAR) AS chunk_id, CAST(len(CASE WHEN vec_id % 9 = 0 THEN embedding[1:3] ELSE embedding END) AS INTEGER) AS n FROM embeddings WHERE vec_id % 9 = 0")
def shape_faults(spark, sf_dir):
    """Vectors of another length than the index has."""
    cut = F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), cut.alias("embedding"))
    return indexing.shape_faults(rows, 64)


@query("""
SELECT event_id, round(least(1, greatest(0, value)), 9) AS clamped, round(least(1, greatest(0, 0.5 + (value - 50) / 40)), 9) AS margin,
       CASE WHEN abs(value - 50) < 10 THEN 'flat' WHEN value > 50 THEN 'up' ELSE 'DOWN' END AS arrow, CASE WHEN event_id % 3 <> 0 THEN round(value, 9) END AS finite FROM events
""")
def score_scalars(spark, sf_dir):
    """Clamping, margins, directions and finite scores of values."""
    v, rows = F.col("value"), table(spark, sf_dir, "events")
    odd = F.when(F.col("event_id") % 6 == 0, float("nan")).when(F.col("event_id") % 3 == 0, float("inf")).otherwise(v)
    return rows.select("event_id", F.round(text.clamp01(v), 9).alias("clamped"), F.round(text.margin(v, 50, 20), 9).alias("margin"), text.arrow(v - 50, F.lit(20.0)).alias("arrow"), F.round(text.as_finite(odd), 9).alias("finite"))


# --- raw pages ------------------------------------------------------------------------------------


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE html || CASE WHEN page_id % 3 = 1 THEN '' ELSE chr(10) || chr(10) END END || CASE WHEN page_id % 3 = 1 THEN '' ELSE url || chr(10) || chr(10) || 'end' END AS body FROM pages")
def raw_bodies(spark, sf_dir):
    """Bodies of raw content items, those of their parts joined."""
    part = lambda body: F.struct(F.lit("s").alias("slug"), body.alias("body"))
    three, none = F.col("page_id") % 3, F.array().cast("array<struct<slug:string,body:string>>")
    parts = F.when(three == 1, none).otherwise(F.array(part(F.col("url")), part(F.lit(None).cast("string")), part(F.lit("end"))))
    details = F.struct(F.when(three != 0, F.col("html")).alias("body"), parts.alias("parts"))
    return table(spark, sf_dir, "pages").select("page_id", F.struct(details.alias("d")).alias("x")).select("page_id", chunking.raw_body(F.col("x.d")).alias("body"))
