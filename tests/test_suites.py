"""Configuration, index, suites, gate runs, reports, sources: by hand-made cases and brute force."""

import http.server
import json
import math
import threading
import urllib.parse

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragstone import config as configuration
from ragstone.operators import gate, golden, indexing, judge, retrieval, suites
from ragstone.sources import crawl, reports, tables

CONFIG = {"chunking": {"splitter": "simple", "chunk_size": 40, "chunk_overlap": 10}, "embedding": {"provider": "hashing", "model": "", "dimensions": 64}, "generation": {"provider": "echo"}}
PAGES = [("/bread", "Bread", "Flour and water make dough. Dough rests an hour before it is baked."), ("/tea", "Tea", "Tea steeps for four minutes in hot water."), ("/blank", "Blank", "")]
GOLDEN = [
    {"id": "q_0001", "question": "How long does dough rest?", "ground_truth": "an hour", "source_ids": ["gov-uk/bread#chunk-0", "gov-uk/bread#chunk-1"], "difficulty": "multi_hop", "added_in": "v1"},
    {"id": "q_0002", "question": "How long does tea steep?", "ground_truth": "four minutes", "source_ids": ["gov-uk/tea#chunk-0", "gov-uk/gone#chunk-0"], "difficulty": "single_hop", "added_in": "v2"},
    {"id": "q_0003", "question": "Who won?", "ground_truth": "not covered", "source_ids": [], "difficulty": "negative", "added_in": "v2"},
]


@pytest.fixture()
def golden_file(tmp_path):
    path = tmp_path / "golden" / "questions.jsonl"
    path.parent.mkdir()
    path.write_text("\n\n".join(map(json.dumps, GOLDEN)) + "\n")
    return str(path.parent)


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(PAGES, "base_path string, title string, body string")


def test_configuration(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("seed: 7\nretrieval:\n  top_k: 3\n")
    c = configuration.load(str(path))
    assert (c["seed"], c["retrieval"]["top_k"], c["chunking"]["chunk_size"]) == (7, 3, 512)
    for bad in ({"reranker": {}}, {"chunking": {"size": 3}}):
        with pytest.raises(ValueError, match="unknown"):
            configuration.complete(bad)
    same = configuration.fingerprint(configuration.complete({"store": {"path": "x"}, "retrieval": {"top_k": 9}}))
    assert same == configuration.fingerprint(configuration.complete({})) != configuration.fingerprint(c)
    assert configuration.judge_provider("anthropic") == "anthropic" and configuration.judge_provider("echo", "openai") == "openai"
    with pytest.raises(ValueError, match="cannot grade"):
        configuration.judge_provider("echo")


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("others", [False, True])
def test_blocks_of_queries_give_the_same_ranking(spark, monkeypatch, text_ids, others):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.integers(-2, 3, 4).astype(float).tolist() if i % 11 else None) for i in range(120)]
    index = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)
    queries = index.filter("id % 3 = 0 or embedding is null").withColumnRenamed("id", "qid")
    if text_ids:
        index, queries = index.withColumn("id", F.col("id").cast("string")), queries.withColumn("qid", F.col("qid").cast("string"))
    name = str if text_ids else int
    want = {}
    for q, e in rows:
        if e and q % 3 == 0:
            unit = lambda x: np.array(x) / (np.linalg.norm(x) or 1)
            scored = [(-round(float(unit(e) @ unit(v)), 6) + 0.0, name(i)) for i, v in rows if v and not (others and i == q)]
            want[name(q)] = [i for _, i in sorted(scored)[:7]]
    monkeypatch.setattr(retrieval, "INDEX_SLICE", 50)
    for block in (1024, 8):
        found = retrieval.dense_topk(queries, index, 7, others=others, block=block).orderBy("qid", "rank").collect()
        assert {q: [r.id for r in found if r.qid == q] for q in want} == want and len(found) == 7 * len(want)
    assert retrieval.dense_topk(queries.limit(0), index, 7).count() == 0 == retrieval.dense_topk(queries, index.limit(0), 7, block=8).count()


def test_index_is_built_guarded_and_looked_up(spark, pages, tmp_path):
    c, path = configuration.complete(CONFIG), str(tmp_path / "index")
    built = indexing.build_index(pages, c, path)
    assert {r.chunk_id for r in built.collect()} == {r.chunk_id for r in indexing.open_index(spark, path, c).collect()} >= {"gov-uk/bread#chunk-0", "gov-uk/tea#chunk-0"}
    with pytest.raises(ValueError, match="does not fit"):
        indexing.open_index(spark, path, {**c, "seed": 1})
    with pytest.raises(ValueError, match="no chunks"):
        indexing.build_index(pages.filter("body = ''"), c, str(tmp_path / "none"))
    short = indexing.Embedder("short", 9, indexing.hashing_embedder(8).embed)
    with pytest.raises(ValueError, match="8 components"):
        indexing.build_index(pages, c, str(tmp_path / "short"), short)
    with pytest.raises(NotImplementedError):
        indexing.retrieve(pages, built, configuration.complete({**CONFIG, "retrieval": {"retriever": "bm25"}}))
    found = indexing.looked_up(built, ["/bread", "gov-uk/tea#chunk-0", "/gone", "gov-uk/tea#chunk-99"])
    assert [r.chunk_id for r in found.collect()][:2] == ["gov-uk/bread#chunk-0", "gov-uk/bread#chunk-1"]
    shown, code = reports.shown_chunks(found, 5)
    assert code == 1 and "not found: /gone, gov-uk/tea#chunk-99" in shown and "\nFlour\n" in shown and "title: Tea" in shown


def test_dense_embedder_equals_the_sparse_vectors(spark):
    docs = spark.createDataFrame([(1, "Tax return TAX"), (2, "council tax"), (3, ""), (4, None)], "id long, text string")
    dense = {r.id: r.v[0] for r in docs.select("id", indexing.hashing_embedder(64).embed(F.array("text")).alias("v")).collect()}
    for r in retrieval.sparse_vectors(docs, 64).collect():
        assert dense[r.id][r.bucket] == pytest.approx(r.weight)
    assert not any(dense[3]) and not any(dense[4]) and sum(x > 0 for x in dense[2]) == 2


def test_retrieval_suite(spark, pages, golden_file, tmp_path):
    c = configuration.complete({**CONFIG, "retrieval": {"top_k": 1}})
    chunks, records = indexing.build_index(pages, c, str(tmp_path / "index")), tables.golden(spark, golden_file)
    summary, scored = suites.retrieval_suite(records, chunks, c)
    row, each = summary.first(), {r.id: r for r in scored.collect()}
    assert (row.n_questions, row.n_answerable, row.n_negatives, row.truncated) == (3, 2, 1, False)
    assert (each["q_0002"].context_recall_at_10, each["q_0002"].expected_missing_from_index) == (0.5, ["gov-uk/gone#chunk-0"])
    assert each["q_0001"].context_recall_at_10 == 1.0 and set(each["q_0001"].expected) <= set(each["q_0001"].retrieved)
    assert row.mrr == pytest.approx(np.mean([r.mrr for r in each.values()]))
    first = suites.retrieval_suite(records, chunks, c, limit=1)
    assert (first[0].first().n_answerable, first[0].first().truncated, [r.id for r in first[1].collect()]) == (1, True, ["q_0001"])
    assert {r.difficulty for r in suites.by_difficulty(scored).collect()} == {"single_hop", "multi_hop"}


def test_judge_suite(spark, pages, golden_file, tmp_path):
    c = configuration.complete({**CONFIG, "retrieval": {"top_k": 2}})
    chunks, records = indexing.build_index(pages, c, str(tmp_path / "index")), tables.golden(spark, golden_file)
    for backend in ("nli", "heuristic"):
        run = suites.judge_suite(records, chunks, c, runs=2, backend=backend)
        assert (run["n_judged"], run["truncated"], run["generator"], run["estimated_cost_usd"]) == (2, False, "echo", 0.0)
        assert all(0 <= v <= 1 and run["spread"][m]["min"] == run["spread"][m]["max"] == v for m, v in run["metrics"].items())
    capped = suites.judge_suite(records, chunks, c, caps={"max_judge_questions_per_run": 1})
    assert (capped["n_judged"], capped["n_answerable_total"], capped["truncated"]) == (1, 2, True)
    seen = iter([0.1, 0.9, 0.4])
    varying = suites.judge_suite(records, chunks, c, runs=3, grade=lambda rows: rows.withColumns(dict.fromkeys(judge.METRICS, F.lit(next(seen)))))
    assert varying["metrics"]["faithfulness"] == pytest.approx(0.4) and varying["spread"]["faithfulness"]["runs"] == [0.1, 0.9, 0.4]
    with pytest.raises(ValueError, match="over the cap"):
        suites.judge_suite(records, chunks, c, backend="ragas", runs=99)
    with pytest.raises(ValueError, match="nothing to grade"):
        suites.judge_suite(records.limit(0), chunks, c)
    assert suites.run_cost(100, 1, "ragas", "openai", 9) == {"estimated_cost_usd": 3.2, "estimated_grading_usd": 3.0, "estimated_generation_usd": 0.2}


def test_semantic_scores_by_brute_force(spark):
    rows = [(1, "tax due", "tax is due now. Pay tax", ["", "pay tax now", "tea"], "tax due now"), (2, "", "x", [], None), (3, "q words", "", ["a b"], "t"), (4, None, None, None, None)]
    e, out = indexing.hashing_embedder(32), suites.semantic_scores
    found = {r.id: r for r in out(spark.createDataFrame(rows, "id long, question string, answer string, contexts array<string>, ground_truth string"), e).collect()}
    buckets = {t: indexing._bucket(t, 32, 42) for t in "tax due is now pay tea".split()}

    def cosine(a, b):
        v = np.zeros((2, 32))
        for i, x in enumerate((a, b)):
            for t in x.lower().replace(".", "").split():
                v[i, buckets[t]] += 1
        return float(v[0] @ v[1] / np.linalg.norm(v[0]) / np.linalg.norm(v[1]))

    q, a, g = rows[0][1], rows[0][2], rows[0][4]
    assert found[1].answer_relevancy == pytest.approx(cosine(q, a), abs=1e-6)
    assert found[1].context_precision == pytest.approx((cosine(q, "pay tax now") + cosine(q, "tea") / 2) / 1.5, abs=1e-6)
    assert found[1].answer_correctness == pytest.approx(0.5 * cosine(a, g) + 0.5 * 2 * 3 / (5 + 3), abs=1e-6)
    assert found[1].faithfulness == pytest.approx((2 / 4 + 1) / 2)
    assert all(found[i][m] == 0 for i in (2, 3, 4) for m in judge.METRICS)


def test_scores_that_failed_do_not_count(spark):
    frame = lambda xs, kind="double": spark.createDataFrame([(x,) for x in xs], f"faithfulness {kind}")
    assert suites.graded_mean(frame([0.5, math.nan, None, math.inf, 1.0]), ("faithfulness",)).first()[0] == 0.75
    for bad in ([math.nan, None], []):
        with pytest.raises(Exception, match="no usable score"):
            suites.graded_mean(frame(bad), ("faithfulness",)).collect()
    with pytest.raises(TypeError):
        suites.graded_mean(frame(["0.5"], "string"), ("faithfulness",))


def test_experiments(spark, pages, golden_file, tmp_path):
    named = {"b": configuration.complete(CONFIG), "a": configuration.complete(CONFIG), "remote": configuration.complete({}), "broken": ValueError("unknown sections")}
    result = suites.run_experiments(named, pages, tables.golden(spark, golden_file), str(tmp_path / "work"))
    assert result["winner"] == "a" and [r["name"] for r in result["rows"]] == ["a", "b", "broken", "remote"]
    assert result["rows"][2]["status"] == "skipped: ValueError: unknown sections" and result["rows"][3]["status"].startswith("skipped: NotImplementedError")
    shown = reports.experiments_report(result, "v2")
    assert "| `a` (winner) |" in shown and all(f"`{m}`" in shown for m in suites.RETRIEVAL_METRICS)


THRESHOLDS = {"dataset": {"version": "v2"}, "suites": {"retrieval": {"gating": True, "metrics": {"mrr": {"absolute_floor": 0.5, "max_relative_drop": 0.1}, "hit_at_5": {"gating": False, "absolute_floor": 0.9}}}, "judge": {"metrics": {"faithfulness": {"max_relative_drop": 0.1}}}}}


@pytest.mark.parametrize(
    ("change", "was", "code", "note"),
    [
        ({}, {}, 0, None),
        ({"retrieval": {"mrr": 0.4, "hit_at_5": 0.1}}, {}, 1, None),
        ({"judge": {"faithfulness": 0.5}}, {}, 1, None),
        ({"judge": {"faithfulness": 0.5}, "judge_backend": "heuristic"}, {}, 0, "grader"),
        ({"judge": {"faithfulness": 0.5}}, {"judge_backend": None}, 0, "not recorded"),
        ({"judge": {"faithfulness": 0.5}, "judge_n_judged": 9}, {}, 0, "9 questions"),
        ({"retrieval": {"mrr": 0.4}}, {"dataset_version": "v1"}, 0, "moved"),
        ({"retrieval": {"mrr": 0.4}}, None, 0, "no baseline"),
        ({"dataset_version": "v3"}, {}, 2, "expected"),
        ({"judge": None, "retrieval": {"mrr": 0.8, "hit_at_5": 0.8}}, {}, 0, None),
    ],
)
def test_gate_run(spark, change, was, code, note):
    results = {"dataset_version": "v2", "retrieval": {"mrr": 0.8, "hit_at_5": 0.8}, "judge": {"faithfulness": 0.9}, "judge_backend": "nli", "judge_n_judged": 2, "judge_runs": 1}
    baseline = {} if was is None else {**gate.baseline_of(results), **was}
    results |= change
    found, rows, notes = gate.gate_run(spark, results, baseline, THRESHOLDS)
    assert found == code and (note is None) == (not notes) and (note is None or note in notes[0])
    if rows is not None:
        shown = reports.gate_report(rows, THRESHOLDS, results, notes)
        assert ("**FAIL**" in shown) == (code == 1) and ("not run" in shown) == (not results["judge"]) and "report only" in shown or "hit_at_5" not in shown


def test_result_files(spark, tmp_path):
    path = str(tmp_path / "r" / "results.json")
    assert reports.load_json(path) == {}
    run = {"metrics": {"faithfulness": 0.5}, "runs": 1, "backend": "nli", "n_judged": 2, "n_answerable_total": 3, "truncated": True, "generator": "echo", "spread": {"faithfulness": {}}, "estimated_cost_usd": 0.0}
    reports.save_results(path, {"retrieval": {"mrr": 1.0}, "retrieval_detail": {"n_questions": 3, "per_question": [1]}})
    merged = reports.save_results(path, reports.judge_results("v2", run), merge=True)
    kept = gate.baseline_of(reports.load_json(path))
    assert merged["retrieval"] == {"mrr": 1.0} == kept["retrieval"] and kept["retrieval_detail"] == {"n_questions": 3}
    assert (kept["judge_backend"], kept["judge_n_judged"], kept["judge_truncated_from"]) == ("nli", 2, 3)
    assert "judge" not in gate.baseline_of({"dataset_version": "v1", "judge": {}})
    open(path, "w").write(" \n")
    assert reports.load_json(path) == {}


def test_drift_reports(spark):
    changes = spark.createDataFrame([("/b", "changed"), ("/a", "changed"), ("/c", "removed")], "base_path string, change string")
    shown = reports.drift_report(changes)
    assert shown.index("`/a`") < shown.index("`/b`") < shown.index("### Removed") and "### Added" not in shown and "- added: 0" in shown
    assert reports.drift_outputs(changes) == ["changed=true", "pages_changed=3"] and reports.drift_outputs(changes.limit(0))[0] == "changed=false"
    assert reports.drift_report(changes.limit(0)) == "The corpus has not drifted."


def test_golden_files(spark, golden_file):
    rows = tables.golden(spark, golden_file).orderBy("line_no").collect()
    assert [(r.id, r.line_no) for r in rows] == [("q_0001", 1), ("q_0002", 3), ("q_0003", 5)]
    new = spark.createDataFrame([{**GOLDEN[1], "id": "q_0004"}], tables.GOLDEN)
    assert tables.append_golden(spark, golden_file, new).count() == 4
    with pytest.raises(ValueError, match="duplicate id"):
        tables.append_golden(spark, golden_file, new)
    assert tables.golden(spark, golden_file).count() == 4
    with pytest.raises(ValueError, match="empty set"):
        golden.refuse(golden.violations(new.limit(0)), "golden")


def test_review_files(spark, tmp_path):
    queue, made = tmp_path / "queue.jsonl", tmp_path / "decisions.jsonl"
    queue.write_text('{"candidate_id": "c1", "question": "Old?"}\n{"candidate_id": "c2", "status": "rejected"}\n')
    candidates = tables.review_queue(spark, str(queue))
    assert {(r.candidate_id, r.status, r.difficulty) for r in candidates.collect()} == {("c1", "pending", "single_hop"), ("c2", "rejected", "single_hop")}
    made.write_text('{"candidate_id": "c1", "decision": "approve", "question": "New?"}\n')
    applied = {r.candidate_id: r for r in golden.apply_decisions(candidates, tables.decisions(spark, str(made))).collect()}
    assert (applied["c1"].status, applied["c1"].question, applied["c2"].status) == ("approved", "New?", "rejected")
    for line, fault in (("{no json", "line 2: no JSON"), ('{"decision": "approve"}', "line 2: no candidate_id"), ('{"candidate_id": "c9", "decision": "approve"}', "unknown id"), ('{"candidate_id": "c1", "decision": "reject"}', "repeated id"), ('{"candidate_id": "c2", "decision": "so"}', "bad verdict")):
        made.write_text('{"candidate_id": "c1", "decision": "approve"}\n' + line + "\n")
        with pytest.raises(ValueError, match=fault):
            golden.apply_decisions(candidates, tables.decisions(spark, str(made)))
    queue.write_text('{"candidate_id": "c1", "status": "lost"}\n')
    with pytest.raises(ValueError, match="lost"):
        tables.review_queue(spark, str(queue))


def test_ids_start_at_one(spark):
    drafts = spark.createDataFrame([(0, "A new one?", "yes", ["s"], "single_hop", "approved")], "pos long, question string, ground_truth string, source_ids array<string>, difficulty string, status string")
    none = spark.createDataFrame([], "id string, question string")
    assert golden.promote(drafts, none, "v1").first().id == "q_0001"


def test_corpus_from_manifest_and_cache(spark, tmp_path):
    raw, manifest = tmp_path / "raw", str(tmp_path / "manifest")
    raw.mkdir()
    (raw / "a__b.json").write_text(json.dumps({"base_path": "/a/b", "title": "AB", "details": {"body": "<p>One</p>", "parts": [{"slug": "s", "body": "<p>Two</p>"}, {"slug": "t"}]}}))
    (raw / "c.json").write_text(json.dumps({"base_path": "/c", "title": "Blank", "details": {"body": "<b> </b>"}}))
    (raw / "unlisted.json").write_text(json.dumps({"base_path": "/unlisted", "details": {"body": "x"}}))
    listed = spark.createDataFrame([("/a/b", "u", "AB", "t", "h"), ("/c", "u", "Blank", "t", "h")], "base_path string, url string, title string, fetched_at string, content_hash string")
    tables.write_manifest(listed, manifest, "words")
    assert [r.base_path for r in tables.manifest_pages(spark, manifest).collect()] == ["/a/b", "/c"]
    found = tables.corpus(spark, manifest, str(raw)).collect()
    assert [(r.base_path, r.title, r.body.split()) for r in found] == [("/a/b", "AB", ["One", "Two"])]
    tables.write_manifest(listed.union(listed.limit(1).withColumn("base_path", F.lit("/gone"))), manifest)
    with pytest.raises(ValueError, match="not in the cache: asked='/gone'"):
        tables.corpus(spark, manifest, str(raw)).collect()


def test_paged_search(spark):
    links, calls = [f"/p{i % 150:03d}" for i in range(230)] + ["https://elsewhere.test/"], []

    class Service(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
            start, count = int(asked["start"]), int(asked["count"])
            calls.append((start, count))
            body = json.dumps({"results": [{"link": x} for x in links[start : start + count]]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(crawl.PagedSearch)
        read = lambda most: spark.read.format("paged_search").option("url", f"http://127.0.0.1:{server.server_port}/").option("max_pages", most).option("delay", 0).load()
        assert [r.base_path for r in crawl.slice_paths(read(500), 500).collect()] == sorted(set(links[:230]))
        assert calls == [(0, 100), (100, 100), (200, 100), (300, 100)]
        calls.clear()
        assert crawl.slice_paths(read(130), 130).count() == 130 and calls == [(0, 100), (100, 30)]
    finally:
        server.shutdown()


def test_fresh_drafts_and_nearest(spark):
    drafts = spark.createDataFrame([(0, "What is it?"), (1, " what  is it"), (2, "Known!"), (3, "Other?"), (4, None)], "pos long, question string")
    assert [r.pos for r in suites.fresh_drafts(drafts, spark.createDataFrame([("known",)], "question string")).orderBy("pos").collect()] == [0, 3, 4]
    pairs = spark.createDataFrame([(1, 5, 0.9), (1, 4, 0.9), (1, 3, 0.8), (1, 2, 1.0)], "id long, other long, similarity double")
    assert [r.other for r in suites.nearest_questions(pairs).orderBy("rank").collect()] == [2, 4, 5]
