"""Quality rules with thresholds that adapt to language and source.

Each document is measured natively. Quantile sketches per (lang, source) and measure are histograms
over log-linear buckets (exact below 16, then 16 buckets per power of two, so a quantile is off by
at most 1/16 of itself). They merge by adding counts: partial aggregation shrinks every task's rows
to a few hundred buckets before the shuffle, a hot source included, and the result does not depend
on the order of merging. From each sketch an upper fence is taken, third quartile plus the larger of
three quartile ranges and a margin; documents above a fence of their own group are rejected. Sketches
also merge upwards, source to lang to all. The wider fence bounds that of a small group, and that of
a group whose median lies within it: the bulk of such a group is like the others, however much junk
its upper quarter holds. A large group whose median lies beyond is another kind of text and keeps its
own fence. The fences come back by a join: broadcast after a count, salted if they are many.

The registered SQL defines the query ``op1_quality`` without these bounds: it takes ``bounded=False``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragstone.llm.common import lookup_join, written

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
#: Least distance of a fence from the third quartile. word_length: hundredths of a character per word;
#: symbols, repeats: per thousand words; dup_lines: per thousand words lines.
MARGINS = {"word_length": 250, "symbols": 300, "dup_lines": 450, "repeats": 300}
SPREADS = 3
#: A group with fewer documents than this has too few above its third quartile to set a fence alone.
LEAST_GROUP = 40
LEAST_WORDS = 50


def bucket_of(v: Column) -> Column:
    """The log-linear bucket of a whole number that is not negative."""
    e = F.length(F.bin(v)) - 1
    return F.when(v < 16, v).otherwise((e - 4) * 16 + F.floor(v / F.pow(F.lit(2.0), e - 4)).cast("long")).cast("long")


def bucket_floor(b: Column) -> Column:
    """The least number in a bucket."""
    return F.when(b < 16, b).otherwise(((F.lit(16) + b % 16) * F.pow(F.lit(2.0), F.floor(b / 16) - 1)).cast("long")).cast("long")


def measured(docs: DataFrame, *carry: Column) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, then ``carry``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("lang"), F.col("source").alias("source"), text.alias("__text"), *carry)
    kept = rows.columns[4:]
    words = F.filter(F.split("__text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))
    rows = rows.withColumns({"__words": words, "__lines": lines})
    w = lambda i: F.get("__words", i)
    windows = F.transform(F.slice("__words", 1, F.greatest(F.size("__words") - 2, F.lit(0))), lambda x, i: F.struct(F.xxhash64(x, w(i + 1), w(i + 2)).alias("h"), i.alias("i")))
    rows = rows.withColumn("__windows", F.sort_array(windows))
    near = lambda k: F.get("__windows", k)
    same = lambda x, y: (x["h"] == y["h"]) & (w(x["i"]) == w(y["i"])) & (w(x["i"] + 1) == w(y["i"] + 1)) & (w(x["i"] + 2) == w(y["i"] + 2))
    twice = F.filter("__windows", lambda x, k: F.coalesce(same(x, near(k - 1)), F.lit(False)) | F.coalesce(same(x, near(k + 1)), F.lit(False)))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        *kept,
    )


def _measures() -> dict[str, Column]:
    whole = lambda a, n: F.floor(a / F.greatest(F.col(n), F.lit(1))).cast("long")
    return {
        "word_length": whole(100 * F.col("word_chars"), "n_words"),
        "symbols": whole(1000 * F.col("n_symbols"), "n_words"),
        "dup_lines": whole(1000 * F.col("n_dup_lines"), "n_lines"),
        "repeats": whole(1000 * F.col("n_repeat_words"), "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n over measured rows that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket_of(v).alias("bucket")) for k, v in _measures().items()]))
    return rows.filter(~base_failed()).select("lang", "source", each.alias("m")).groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, n, median and fence of the sketches merged by ``keys``."""
    group = Window.partitionBy(*keys, "measure")
    rows = counts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    rows = rows.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "all": F.sum("n").over(group)})
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, bucket_floor(F.col("bucket"))))
    per = rows.groupBy(*keys, "measure").agg(F.max("all").alias("n"), quartile(1).alias("q1"), quartile(2).alias("median"), quartile(3).alias("q3"))
    margin = F.create_map(*[F.lit(x) for kv in MARGINS.items() for x in kv])
    fence = F.col("q3") + F.greatest(SPREADS * (F.col("q3") - F.col("q1")), margin[F.col("measure")])
    return per.select(*keys, "measure", "n", "median", fence.alias("fence"))


def _bounded(own: DataFrame, wide: DataFrame, keys: list[str]) -> DataFrame:
    """``own`` with its fences bounded by those of the ``wide`` groups, which ``keys`` name.

    Small groups: by the wide fence as it is. Others, if their median lies within it: by the wide
    fence, moved up as far as their median lies above the wide one.
    """
    wide = written(wide.select(*keys, F.col("median").alias("wide_median"), F.col("fence").alias("wide_fence")), "quality-wide")
    rows = lookup_join(own, wide, keys)
    moved = F.col("wide_fence") + F.greatest(F.col("median") - F.col("wide_median"), F.lit(0))
    bound = F.when(F.col("n") < LEAST_GROUP, F.col("wide_fence")).when(F.col("median") <= F.col("wide_fence"), moved)
    return rows.withColumn("fence", F.least("fence", bound)).drop("wide_median", "wide_fence")


def fences(counts: DataFrame, bounded: bool = True) -> DataFrame:
    """lang, source, and the upper fence of each measure, from merged sketches; each group's own if not ``bounded``."""
    if bounded:
        counts = written(counts, "quality-sketches")
        langs = _bounded(_quartiles(counts, ["lang"]), _quartiles(counts, []), ["measure"])
        per = _bounded(_quartiles(counts, ["lang", "source"]), langs, ["lang", "measure"])
    else:
        per = _quartiles(counts, ["lang", "source"])
    return per.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == k, F.col("fence"))).alias(f"max_{k}") for k in MARGINS])


def judged(docs: DataFrame, *carry: Column, bounded: bool = True) -> DataFrame:
    """The measures of every row with base_failed and kept, then the columns ``carry``.

    Null text: measured as empty, fails the base rules. Null lang or source: a group of their own.
    Repeated rows count and are judged each for itself; an empty table gives an empty result; other
    columns of ``docs`` are not read, whatever their names.
    """
    rows = written(measured(docs, *carry), "quality-measures")
    limits = written(fences(sketches(rows), bounded), "quality-fences")
    rows = lookup_join(rows, limits, ["lang", "source"], salt=F.xxhash64("doc_id", "word_chars")).withColumn("base_failed", base_failed())
    within = ~F.col("base_failed")
    for name, value in _measures().items():
        within &= F.coalesce(value <= F.col(f"max_{name}"), F.lit(True))
    return rows.withColumn("kept", within).drop(*[f"max_{k}" for k in MARGINS])


def quality_verdicts(docs: DataFrame, bounded: bool = True) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row."""
    return judged(docs, bounded=bounded).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return judged(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")).filter("kept").select("__row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
a AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a WHERE len(w) >= 3)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT a.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM a LEFT JOIN c ON a.doc_id = c.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             [100 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(n_words, 1),
              1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)] AS v FROM m),
e AS (SELECT lang, source, k, v[k] AS x FROM b, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE NOT base_failed),
f AS (SELECT lang, source, k, CASE WHEN x < 16 THEN x ELSE (x >> (length(bin(x)) - 5)) << (length(bin(x)) - 5) END AS x FROM e),
h AS (SELECT lang, source, k, x, sum(count(*)) OVER (PARTITION BY lang, source, k ORDER BY x) AS upto,
             sum(count(*)) OVER (PARTITION BY lang, source, k) AS n FROM f GROUP BY lang, source, k, x),
q AS (SELECT lang, source, k, min(CASE WHEN upto * 4 >= n THEN x END) AS q1, min(CASE WHEN upto * 4 >= 3 * n THEN x END) AS q3
      FROM h GROUP BY lang, source, k),
z AS (SELECT lang, source, list(q3 + greatest(3 * (q3 - q1), [250, 300, 450, 300][k]) ORDER BY k) AS top FROM q GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(v[1] <= top[1] AND v[2] <= top[2] AND v[3] <= top[3] AND v[4] <= top[4], true) AS kept
FROM b LEFT JOIN z ON b.lang IS NOT DISTINCT FROM z.lang AND b.source IS NOT DISTINCT FROM z.source
"""
