import itertools
import random

import pytest
from pyspark.sql import functions as F

from ragstone.operators import drift, gate, golden, judge, retrieval, screening
from ragstone.sources import tables
from ragstone.streaming import drift_stream


def test_ties_and_metrics(spark):
    index = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], "id long, embedding array<float>")
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "qid long, embedding array<float>")
    ranking = retrieval.dense_topk(queries, index, 3)
    assert [(r.id, r.rank) for r in ranking.orderBy("rank").collect()] == [(0, 1), (2, 2), (1, 3)]
    relevant = spark.createDataFrame([(9, 1), (9, 1), (9, 77), (8, 5)], "qid long, id long")
    got = {r.qid: r for r in retrieval.question_metrics(ranking, relevant, served=2).collect()}
    assert (got[9].hit_at_5, got[9].reciprocal_rank, got[9].recall_at_10, got[9].served_recall, got[9].first_relevant_rank) == (1.0, pytest.approx(1 / 3), 0.5, 0.0, 3)
    assert (got[8].hit_at_5, got[8].reciprocal_rank, got[8].first_relevant_rank) == (0.0, 0.0, None)
    assert retrieval.suite_means(retrieval.question_metrics(ranking, relevant.limit(0)), ["hit_at_5"]).first()["hit_at_5"] == 0.0
    assert {(r.qid, r.id) for r in retrieval.missing_gold(relevant, index).collect()} == {(9, 77), (8, 5)}


def test_sparse_equals_dense(spark):
    docs = spark.createDataFrame([(1, "tax return tax"), (2, "council tax"), (3, "other words")], "id long, text string")
    vectors = retrieval.sparse_vectors(docs, 64)
    best = retrieval.sparse_topk(vectors.filter("id = 1"), vectors, 1).first()
    assert (best.id, best.score) == (1, 1.0)


def test_rule_table(spark):
    graded, flags = ["pass", "fail"], [False, True]
    grid = list(itertools.product(graded, graded, graded, graded, [0.0, 0.69, 0.7, 0.79, 0.8], flags, flags, flags))
    schema = ", ".join(f"{c} string" for c in screening.CRITERIA) + ", confidence double, duplicate boolean, is_negative boolean, has_passage boolean"

    def expected(rel, acc, sup, qual, sure, dup, neg, has):
        if neg or not has:
            return "review"
        if dup:
            return "reject" if sure >= 0.7 else "review"
        if sup == "fail":
            return "review"
        if "fail" in (rel, acc):
            return "reject" if sure >= 0.7 else "review"
        return "approve" if qual == "pass" and sure >= 0.8 else "review"

    for r in screening.decided(spark.createDataFrame(grid, schema)).collect():
        assert r.decision == expected(*r[:8])
    odd = screening.decided(spark.createDataFrame([(None, "pass", "pass", "pass", 1.0, False, False, True)], schema)).first()
    assert odd.rule == "unparseable"


def test_screening(spark):
    passage = "You must register for Self Assessment by 5 October if you earned more than £1,000 from self-employment."
    rows = [
        ("When must I register for Self Assessment?", "By 5 October if you earned more than £1,000", passage, "single_hop", False),
        ("When must I register for Self Assessment?", "By 31 January if you earned £5,000", passage, "single_hop", False),
        ("When must I register for Self Assessment?", "By 5 October", "", "single_hop", False),
        ("When must I register for Self Assessment?", "", passage, "negative", False),
    ]
    got = screening.screened(spark.createDataFrame(rows, "question string, ground_truth string, source_excerpt string, difficulty string, duplicate boolean")).collect()
    assert [r.rule for r in got] == ["clean_and_confident", "source_support_failed", "no_passage", "negative_needs_corpus_check"]


def test_near_pairs_and_order(spark):
    rng = random.Random(0)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.sample(words[:12], 11)) for _ in range(20)] + [" ".join(rng.sample(words, 10)) for _ in range(20)] + [""]
    rows = list(enumerate(texts))
    got = {(r.a, r.b) for r in screening.near_pairs(spark.createDataFrame(rows, "id long, text string")).collect()}
    sets = [frozenset(t.split()) for t in texts]
    first = {s: min(i for i, x in enumerate(sets) if x == s) for s in sets}
    want = set()
    for a, b in itertools.combinations(range(40), 2):
        if sets[a] == sets[b]:
            if first[sets[a]] == a:
                want.add((a, b))
        elif first[sets[a]] == a and first[sets[b]] == b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.82:
            want.add((a, b))
    assert got == want
    pairs = [(0, 1), (1, 2), (2, 3), (0, 4), (3, 4)]
    eligible = {0: True, 1: True, 2: True, 3: False, 4: True}
    gone = {}
    for i in range(5):
        gone[i] = eligible[i] and any(not gone[a] for a, b in pairs if b == i)
    result = screening.earlier_kept(spark.createDataFrame(list(eligible.items()), "id long, eligible boolean"), spark.createDataFrame(pairs, "a long, b long"))
    assert {r.id: r.rejected for r in result.collect()} == gone


def test_applied(spark):
    rows = spark.createDataFrame([("approved", "reject"), ("pending", "reject"), ("rejected", "approve"), ("pending", "review")], "s string, d string")
    assert [r[0] for r in rows.select(screening.applied(F.col("s"), F.col("d"))).collect()] == ["approved", "rejected", "rejected", "pending"]


def test_golden(spark):
    schema = tables.GOLDEN
    rows = [("q_0001", "A?", "a", ["s"], "single_hop", "v1"), ("q_0001", "B?", "b", [], "multi_hop", "v12"), ("q_0003", "C?", "c", ["s"], "negative", "x"), (None, "", "d", None, "odd", "v2")]
    data = spark.createDataFrame(rows, schema)
    found = {(r.id, r.violation) for r in golden.violations(data).collect()}
    assert {("q_0001", "duplicate id"), ("q_0001", "answerable without sources"), ("q_0003", "negative with sources"), ("q_0003", "bad added_in"), (None, "unknown difficulty")} <= found
    assert golden.violations(data.limit(0)).first().violation == "empty set"
    assert golden.dataset_version(data).first().version == "v12"
    drafts = [(3, " a? ", "approved", ["s"], "single_hop"), (1, "New?", "approved", ["s"], "single_hop"), (2, "new? ", "approved", ["s"], "single_hop"), (4, "Neg?", "approved", [], "negative"), (5, "P?", "pending", ["s"], "single_hop"), (6, "No source?", "approved", [], "single_hop")]
    drafts = spark.createDataFrame([(p, q, "g", s, ids, d) for p, q, s, ids, d in drafts], "pos long, question string, ground_truth string, status string, source_ids array<string>, difficulty string")
    assert [(r.id, r.question) for r in golden.promote(drafts, data, "v13").orderBy("id").collect()] == [("q_0004", "New?"), ("q_0005", "Neg?")]


def test_promotion_strips_and_tells_what_it_skips(spark):
    known = spark.createDataFrame([("q_0007", " Known? ", "a", ["s"], "single_hop", "v1")], tables.GOLDEN)
    rows = [(1, "c1", "known?", "g", ["s"], "single_hop"), (2, "c2", " Neg? ", " g ", None, "negative"), (3, "c3", "Twice?", "g", None, "single_hop"), (4, "c4", "twice?", "g", ["s"], "single_hop"), (5, "c5", "TWICE?", "g", ["s"], "single_hop"), (6, "c6", "Sourced?", "g", ["s"], "negative")]
    drafts = spark.createDataFrame([(*r, "approved") for r in rows], "pos long, candidate_id string, question string, ground_truth string, source_ids array<string>, difficulty string, status string")
    got = golden.promote(drafts, known, "v2").orderBy("id").collect()
    assert [(r.id, r.question, r.ground_truth, r.source_ids) for r in got] == [("q_0008", "Neg?", "g", []), ("q_0009", "twice?", "g", ["s"])]
    assert {r.candidate_id for r in golden.promote_skipped(drafts, known).collect()} == {"c1", "c3", "c5", "c6"}
    for version in ("2", "v", "v2 ", "x2"):
        with pytest.raises(ValueError):
            golden.promote(drafts, known, version)


def test_selection(spark):
    chunks = spark.createDataFrame([(f"p{i:02d}", c, "x" * 250) for i in range(9) for c in range(2)], "page_path string, chunk_index int, text string")
    assert [r.page_path for r in golden.select_chunks(chunks, 3, per_page=1).collect()] == ["p00", "p03", "p06"]


def test_decisions(spark):
    candidates = spark.createDataFrame([("c1", "pending", "q", "g"), ("c2", "pending", "q", "g")], "candidate_id string, status string, question string, ground_truth string")
    decisions = spark.createDataFrame([("c1", "approve", "new q", None), ("c9", "maybe", " ", None), ("c9", "reject", None, None)], tables.DECISION)
    assert {(r.candidate_id, r.fault) for r in golden.decision_faults(decisions, candidates).collect()} == {("c9", "unknown id"), ("c9", "repeated id"), ("c9", "bad verdict"), ("c9", "blank rewrite")}
    got = {r.candidate_id: (r.status, r.question) for r in golden.with_decisions(candidates, decisions.filter("candidate_id = 'c1'")).collect()}
    assert got == {"c1": ("approved", "new q"), "c2": ("pending", "q")}


def test_drift(spark, tmp_path):
    old = [("/a", "1", "t0"), ("/b", "1", "t0"), ("/c", "1", "t0")]
    new = [("/a", "1", "t1"), ("/b", "2", "t1"), ("/d", "1", "t1")]
    schema = "base_path string, content_hash string, fetched_at string"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    want = {("/b", "changed"), ("/c", "removed"), ("/d", "added")}
    assert {tuple(r) for r in drift.manifest_diff(a, b).collect()} == want
    assert {(r.base_path, r.fetched_at) for r in drift.manifest_merge(a, b).collect()} == {("/a", "t0"), ("/b", "t1"), ("/d", "t1")}
    inbox = f"{tmp_path}/in"
    tables.write_lines(a.coalesce(1), inbox)
    drift_stream.compare_arrivals(spark, inbox, schema, f"{tmp_path}/stored", f"{tmp_path}/changes", f"{tmp_path}/check")
    tables.write_lines(b.coalesce(1), inbox)
    drift_stream.compare_arrivals(spark, inbox, schema, f"{tmp_path}/stored", f"{tmp_path}/changes", f"{tmp_path}/check")
    assert {(r.base_path, r.change) for r in spark.read.parquet(f"{tmp_path}/changes").filter("batch = 1").collect()} == want


def test_gate(spark):
    rules = spark.createDataFrame([("r", "hit", 0.8, 0.02, True), ("r", "mrr", 0.6, 0.02, True), ("r", "rec", None, 0.02, False), ("r", "new", 0.1, None, True)], "suite string, metric string, floor double, max_drop double, gating boolean")
    current = spark.createDataFrame([("r", "hit", 0.79), ("r", "mrr", 0.70), ("r", "rec", 0.5), ("r", "new", 0.1)], "suite string, metric string, value double")
    baseline = spark.createDataFrame([("r", "hit", 0.9), ("r", "mrr", 0.75), ("r", "rec", 0.6)], "suite string, metric string, value double")
    got = {r.metric: (r.reason, r.blocking) for r in gate.gated(current, baseline, rules).collect()}
    assert got == {"hit": ("floor", True), "mrr": ("drop", True), "rec": ("", False), "new": ("", False)}
    assert gate.exit_code(gate.gated(current, baseline, rules)) == 1
    assert {(r.passed, r.reason) for r in gate.gated(current, baseline, rules, comparable=False).collect()} == {(True, "")}
    assert gate.exit_code(gate.gated(current, baseline, rules, comparable=False)) == 0
    assert gate.exit_code(current, version_matches=False) == 2


def test_judge(spark):
    rows = spark.createDataFrame([(["", "One. Two! Three."],), ([" "],)], "c array<string>")
    assert [r[0] for r in rows.select(judge.echo_answer(F.col("c"))).collect()] == ["One. Two!", judge.REFUSAL]
    runs = spark.createDataFrame([("m", 1.0), ("m", 4.0), ("m", 2.0), ("m", float("nan"))], "metric string, value double")
    spread = judge.run_spread(runs).first()
    assert (spread.median, spread.least, spread.most, spread.runs) == (2.0, 1.0, 4.0, [1.0, 2.0, 4.0])
    weights = spark.createDataFrame([([1.0, -1.0],), ([],)], "s array<double>")
    assert [r[0] for r in weights.select(judge.weighted_precision(F.col("s"))).collect()] == [pytest.approx(2 / 3), 0.0]


def test_index_guard(spark, tmp_path):
    chunks = spark.createDataFrame([("c", [1.0])], "id string, embedding array<float>")
    tables.save_index(chunks, str(tmp_path / "index"), {"embedder_id": "e1"})
    assert tables.load_index(spark, str(tmp_path / "index"), {"embedder_id": "e1"}).count() == 1
    with pytest.raises(ValueError):
        tables.load_index(spark, str(tmp_path / "index"), {"embedder_id": "e2"})
