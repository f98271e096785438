"""Result files and Markdown reports. They hold a few dozen rows each, which the driver formats."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.functions import text
from ragstone.operators import suites


def load_json(path: str) -> dict:
    """The object in ``path``; empty if the file is missing or blank."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        return json.loads(file.read().strip() or "{}")


def load_thresholds(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)


def _write(path: str, content: str) -> str:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(content)
    return content


def save_results(path: str, results: dict, merge: bool = False) -> dict:
    """Write ``results``; with ``merge`` over what the file has. The other suite's results stay then."""
    results = {**(load_json(path) if merge else {}), **results}
    _write(path, json.dumps(results, indent=2, sort_keys=True))
    return results


def retrieval_results(version: str, summary: DataFrame, scored: DataFrame) -> dict:
    """The retrieval part of a result file from one summary row and its scored questions, in order of id."""
    row = summary.first()
    counts = {k: row[k] for k in ("n_questions", "n_answerable", "n_negatives")}
    each = [r.asDict(recursive=True) for r in scored.orderBy("id").toLocalIterator()]
    return {"dataset_version": version, "retrieval": {m: row[m] for m in suites.RETRIEVAL_METRICS}, "retrieval_detail": {**counts, "per_question": each}}


def judge_results(version: str, run: dict) -> dict:
    """The judge part of a result file from what ``suites.judge_suite`` gives."""
    detail = {k: run[k] for k in ("n_judged", "n_answerable_total", "truncated", "backend", "generator", "spread")}
    return {"dataset_version": version, "judge": run["metrics"], "judge_runs": run["runs"], "judge_backend": run["backend"], "judge_n_judged": run["n_judged"], "estimated_cost_usd": run["estimated_cost_usd"], "judge_detail": detail}


def _table(head: Sequence[str], rows: Sequence[Sequence[str]]) -> list[str]:
    row = lambda cells: "| " + " | ".join(cells) + " |"
    return [row(head), row(["---"] * len(head)), *map(row, rows)]


def _number(x: float | None, form: str = ".3f") -> str:
    return "—" if x is None else format(x, form)


def gate_report(rows: DataFrame, thresholds: dict, results: dict, notes: Sequence[str] = (), most_regressions: int = 5) -> str:
    """Markdown of gate result rows: every rule with its delta and outcome, suites not run, regressions and the verdict."""
    tolerance = {(s, m): r.get("max_relative_drop", 0.02) for s, about in thresholds["suites"].items() for m, r in about["metrics"].items()}
    places = {key: i for i, key in enumerate(tolerance)}
    tolerances = rows.sparkSession.createDataFrame([(*k, float(t or 0)) for k, t in tolerance.items()], "suite string, metric string, tolerance double")
    delta = F.col("current") - F.col("baseline")
    found = rows.join(tolerances, ["suite", "metric"]).withColumns({"delta": delta, "arrow": text.arrow(delta, F.col("tolerance"))}).collect()
    found.sort(key=lambda r: places[r.suite, r.metric])
    shown = lambda r: f"**FAIL** ({r.reason})" if r.blocking else "pass" if r.gates else "report only"
    cells = [[f"`{r.suite}.{r.metric}`", _number(r.baseline), _number(r.current), "—" if r.delta is None else f"{r.delta:+.3f} {r.arrow}", shown(r)] for r in found]
    cells += [[f"_{s}_", "—", "not run", "—", "skipped"] for s in thresholds["suites"] if not results.get(s)]
    out = ["## Evaluation", "", *[line for note in notes for line in (note, "")], *_table(["Metric", "Baseline", "Current", "Delta", "Gate"], cells), ""]
    if worst := results.get("per_question_regressions", [])[:most_regressions]:
        out += [f"### Questions that fell most (top {most_regressions})", "", *[f"- `{q.get('id')}` {q.get('question', '')[:110]} ({q.get('delta', 0):+.2f})" for q in worst], ""]
    failed = sum(r.blocking for r in found)
    if failed:
        out += [f"**The gate failed on {failed} metric(s).** If that is meant, renew the baseline and say why.", ""]
    elif any(r.gates for r in found):
        out += ["**The gate passed.**", ""]
    return "\n".join([*out, f"Dataset `{results.get('dataset_version')}`, judge runs: {results.get('judge_runs', 'none')}, estimated cost: ${results.get('estimated_cost_usd', 0):.2f}"])


def experiments_report(result: dict, version: str) -> str:
    """Markdown of what ``suites.run_experiments`` gives: one row per configuration, the winner marked."""
    rows = []
    for r in result["rows"]:
        metrics = [_number(r.get("metrics", {}).get(m)) for m in suites.RETRIEVAL_METRICS]
        rows.append([f"`{r['name']}`" + (" (winner)" if r["name"] == result["winner"] else ""), *metrics, str(r.get("n_chunks", "—")), r["status"]])
    head = ["Configuration", *[f"`{m}`" for m in suites.RETRIEVAL_METRICS], "Chunks", "Status"]
    first = f"Primary metric: `{result['primary_metric']}`. Winner: **{result['winner'] or '—'}**."
    return "\n".join([f"## Experiments (dataset `{version}`)", "", first, "", *_table(head, rows), ""])


def drift_report(changes: DataFrame) -> str:
    """Markdown of a manifest comparison (base_path, change): counts, and the pages of each change in order."""
    pages: dict[str, list[str]] = {"changed": [], "added": [], "removed": []}
    for r in changes.orderBy("base_path").collect():
        pages[r.change].append(r.base_path)
    if not any(pages.values()):
        return "The corpus has not drifted."
    out = ["## The corpus has drifted", "", *[f"- {change}: {len(paths)}" for change, paths in pages.items()], ""]
    for change, paths in pages.items():
        out += [f"### {change.capitalize()}", "", *[f"- `{p}`" for p in paths], ""] if paths else []
    return "\n".join(out)


def drift_outputs(changes: DataFrame) -> list[str]:
    """The lines that tell a workflow whether pages changed, and how many."""
    n = changes.count()
    return [f"changed={'true' if n else 'false'}", f"pages_changed={n}"]


def shown_chunks(found: DataFrame, chars: int = 0) -> tuple[str, int]:
    """Text of looked-up chunks (``indexing.looked_up``), each cut to ``chars`` if not 0, and 1 if any was not found, else 0."""
    shown = F.left("text", F.lit(chars)) if chars else F.col("text")
    extra = [F.col(c) if c in found.columns else F.lit("").alias(c) for c in ("title", "url")]
    out, missing = [], []
    for r in found.select("position", "chunk_index", "wanted", "chunk_id", *extra, F.length("text").alias("n"), shown.alias("shown")).orderBy("position", "chunk_index").collect():
        if r.chunk_id is None:
            missing.append(r.wanted)
            out += [f"=== {r.wanted} ===", "not in the index", ""]
        else:
            out += [f"=== {r.chunk_id} ===", f"title: {r.title}", f"url: {r.url}", f"characters: {r.n}" + (f" ({len(r.shown)} shown)" if len(r.shown) < r.n else ""), r.shown, ""]
    return "\n".join([*out, *([f"not found: {', '.join(missing)}"] if missing else [])]), int(bool(missing))
