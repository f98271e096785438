"""Scalar text functions as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space, words without topic signal, document words,
# question openers and figure patterns that results depend on.
SPACE = "\\t-\\r \\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
STOPWORDS = tuple(
    """
    a an the and or but if then than that this these those of in on at to for from by
    with without about into over under again further is are was were be been being am
    do does did doing have has had having i you he she it we they them his her its our
    your their what which who whom when where why how all any both each few more most
    other some such no nor not only own same so too very can will just should now as
    """.split()
)
DOCUMENT_WORD = "(?:guide|guidance|passage|page|document|section|text|notes?|extract|workbook)"
SELF_REFERENCES = (
    rf"according to\s+(?:[\w.'\-]+\s+){{0,3}}{DOCUMENT_WORD}",
    r"according to\s+(?:hs|sa|p|ch|bscc|ir)\d{1,4}[a-z]?\b",
    rf"in (?:this|the (?:above|following))\s+{DOCUMENT_WORD}",
    rf"(?:the|this)\s+{DOCUMENT_WORD}\s+(?:says|states|mentions|explains|describes|notes|sets out)",
    rf"as (?:stated|mentioned|described|set out|noted)\s+in\s+(?:the|this)\s+{DOCUMENT_WORD}",
    r"as (?:stated|mentioned|described|set out|noted)\s+(?:above|below)",
    r"(?:mentioned|described|listed|shown)\s+(?:above|below)",
    r"this (?:section|passage|extract)",
)
OPENERS = "what when where which who whom whose why how do does did is are was were can could should must will would may might".split()
MONTHS = "january february march april may june july august september october november december".split()
FIGURES = (
    r"£\s?[\d,]+(?:\.\d+)?",
    r"\d+(?:\.\d+)?\s?%",
    rf"\b\d{{1,2}}\s+(?:{'|'.join(MONTHS)})\b",
    r"\b(?:19|20)\d{2}(?:[-/]\d{2})?\b",
    r"\b[A-Z]{1,3}\d{2,4}[A-Z]?\b",
    r"\b\d[\d,]*(?:\.\d+)?\b",
)
UNRECOVERABLE = (
    "credit balance", "insufficient_quota", "quota", "authentication", "invalid api key", "invalid x-api-key",
    "permission", "not_found_error", "model not found", "no module named",
)
ASCII_BOUNDARY = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
EMBEDDED = r"(?is)<(script|style)\b.*?</\1>"
BLOCK_END = r"(?i)</(?:p|div|li|h[1-6]|tr|section|article)>"
LINE_BREAK = r"(?i)<br\s*/?>"
TAG = r"<[^>]+>"
ID_PREFIX = "gov-uk/"


def strip(x: Column) -> Column:
    """Without white space at both ends, all of Unicode's."""
    return F.regexp_replace(x, f"^[{SPACE}]+|[{SPACE}]+$", "")


def strip_html(x: Column) -> Column:
    """Markup to text: scripts and styles go, block ends and breaks become line ends, other tags spaces. Entities stay."""
    for pattern, instead in ((EMBEDDED, " "), (BLOCK_END, "\n"), (LINE_BREAK, "\n"), (TAG, " ")):
        x = F.regexp_replace(x, pattern, instead)
    return x


def normalise_text(x: Column) -> Column:
    """One kind of line end, single spaces, stripped lines, at most one blank line in a row."""
    x = F.regexp_replace(x, r"\r\n?", "\n")
    x = F.regexp_replace(x, r"[ \t\r\f\x0B]+", " ")
    x = F.regexp_replace(x, f"(?m)^[{SPACE}&&[^\\n]]+|[{SPACE}&&[^\\n]]+$", "")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def page_path_id(x: Column, prefix: str = ID_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.regexp_replace(strip(x), "^/+|/+$", ""))


def content_hash(x: Column) -> Column:
    return F.substring(F.sha2(x, 256), 1, 16)


def tokens(x: Column) -> Column:
    """Lower-case ASCII words, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), 0)


def token_set(x: Column) -> Column:
    """Distinct words after case folding (ß as ss)."""
    return F.array_distinct(tokens(F.replace(x, F.lit("ß"), F.lit("ss"))))


def content_tokens(x: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    return F.array_except(token_set(x), F.array(*map(F.lit, stopwords)))


def sentences(x: Column) -> Column:
    """Split after . ! ? and space, before a capital, digit or pound sign."""
    return F.filter(F.transform(F.split(x, r"(?<=[.!?])\s+(?=[A-Z0-9£])"), strip), lambda s: s != "")


def loose_sentences(x: Column) -> Column:
    return F.split(strip(x), r"(?<=[.!?])\s+")


def normalise_question(x: Column) -> Column:
    """Key under which rewordings of punctuation and case are one question."""
    x = strip(F.regexp_replace(x, f"[{SPACE}]+", " "))
    return F.lower(F.replace(F.regexp_replace(x, "^[?.!]+|[?.!]+$", ""), F.lit("ß"), F.lit("ss")))


def is_self_referential(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?iU)\b(?:" + "|".join(SELF_REFERENCES) + r")\b"), F.lit(False))


def reads_as_question(x: Column, ascii_words: bool = False) -> Column:
    """Whether a question mark ends it or an opener begins it as a whole word, followed by no letter of any script.

    ``ascii_words``: words as RE2 has them, and with it SQL. They end where A-Z, a-z, 0-9 and _ meet anything
    else, so "doñ" opens with "do"; ſ is read as s.
    """
    s = strip(F.coalesce(x, F.lit("")))
    openers, end = "|".join(OPENERS), r"\b"
    if ascii_words:
        openers, end = openers.replace("s", "[sſ]"), ASCII_BOUNDARY
    return s.endswith("?") | s.rlike(rf"(?i)^\s*(?:{openers}){end}")


def figures(x: Column) -> Column:
    """Amounts, shares, dates, years, form codes and numbers, leftmost first."""
    return F.regexp_extract_all(x, F.lit("(?i)(" + "|".join(FIGURES) + ")"), 1)


def normalise_figure(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(x, r"[£,\s]", "")), r"\.+$", "")


def unsupported_figures(answer: Column, passage: Column) -> Column:
    """Figures of the answer that the passage lacks by value; none for a blank passage."""
    found = figures(answer)
    lacking = F.array_except(F.transform(found, normalise_figure), F.transform(figures(passage), normalise_figure))
    # What is lacking is an element of an array here, else it was found anew for every figure.
    pick = lambda lost: F.filter(found, lambda f: (normalise_figure(f) != "") & F.array_contains(lost, normalise_figure(f)))
    missing = F.element_at(F.transform(F.array(lacking), pick), 1)
    return F.when(strip(passage) == "", F.array().cast("array<string>")).otherwise(F.transform(missing, strip))


def strip_fences(x: Column) -> Column:
    return strip(F.regexp_replace(x, r"(?m)^```(?:json)?\s*|\s*```$", ""))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def margin(value: Column, threshold: float, scale: float) -> Column:
    """How comfortably ``value`` clears ``threshold``: 0.5 at the threshold, 1 at ``scale`` above."""
    if scale <= 0:
        return F.when(value >= threshold, 1.0).otherwise(0.0)
    return clamp01(F.lit(0.5) + (value - F.lit(threshold)) / F.lit(2 * scale))


def arrow(delta: Column, tolerance: Column) -> Column:
    return F.when(F.abs(delta) < tolerance / 2, "flat").when(delta > 0, "up").otherwise("DOWN")


def is_unrecoverable(message: Column) -> Column:
    return F.lower(message).rlike("|".join(map(re.escape, UNRECOVERABLE)))


def as_finite(x: Column) -> Column:
    x = x.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def source_page(ids: Column) -> Column:
    """struct(page, chunk_index) of the first id that parses as a chunk id."""
    pattern = r"^(.*)#chunk-(\d+)$"
    first = F.element_at(F.filter(ids, lambda i: i.rlike(pattern)), 1)
    return F.struct(F.regexp_extract(first, pattern, 1).alias("page"), F.regexp_extract(first, pattern, 2).try_cast("int").alias("chunk_index"))


def parse_verdict(raw: Column) -> Column:
    """A judge's JSON answer as a struct; fields that do not validate are null, an unknown decision empty."""
    body = F.regexp_extract(strip_fences(raw), r"(?s)(\{.*\})", 1)
    grade = lambda k: F.lower(F.get_json_object(body, f"$.{k}"))
    checked = lambda k: F.when(grade(k).isin("pass", "true"), "pass").when(grade(k).isin("fail", "false"), "fail").alias(k)
    confidence = F.get_json_object(body, "$.confidence").try_cast("double")
    decision = F.lower(F.get_json_object(body, "$.decision"))
    return F.struct(
        *[checked(k) for k in ("relevance", "ground_truth_accuracy", "source_support", "question_quality")],
        F.when((confidence >= 0) & (confidence <= 1), confidence).alias("confidence"),
        F.get_json_object(body, "$.duplicate").try_cast("boolean").alias("duplicate"),
        F.when(decision.isin("approve", "reject", "review"), decision).otherwise("").alias("decision"),
    )


def parse_candidates(raw: Column) -> Column:
    """A drafter's JSON list as array<struct>: blank questions go, unknown difficulties become single_hop."""
    rows = F.from_json(strip_fences(raw), "array<struct<question:string,ground_truth:string,difficulty:string>>")
    fine = F.filter(F.coalesce(rows, F.array().cast("array<struct<question:string,ground_truth:string,difficulty:string>>")), lambda r: strip(F.coalesce(r["question"], F.lit(""))) != "")
    known = lambda r: F.when(r["difficulty"].isin("single_hop", "multi_hop", "negative"), r["difficulty"]).otherwise("single_hop")
    return F.transform(fine, lambda r: F.struct(strip(r["question"]).alias("question"), strip(F.coalesce(r["ground_truth"], F.lit(""))).alias("ground_truth"), known(r).alias("difficulty")))
