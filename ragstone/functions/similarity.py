"""Similarities of vectors and word sets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ragstone.functions import text


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where either norm is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, 0.0).otherwise(dot(a, b) / norms)


def share(a: Column, b: Column) -> Column:
    """Part of the distinct elements of ``a`` that ``b`` has; 0 for an empty ``a``."""
    return F.when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def jaccard(a: Column, b: Column) -> Column:
    """0 where either side is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def similarity(a: Column, b: Column) -> Column:
    return jaccard(text.token_set(a), text.token_set(b))


def overlap(a: Column, b: Column) -> Column:
    """Directional, on words with topic signal."""
    return share(text.content_tokens(a), text.content_tokens(b))


def raw_overlap(a: Column, b: Column) -> Column:
    """Directional, on all words."""
    return share(F.array_distinct(text.tokens(a)), F.array_distinct(text.tokens(b)))


def token_f1(a: Column, b: Column) -> Column:
    x, y = F.array_distinct(text.tokens(a)), F.array_distinct(text.tokens(b))
    both = F.size(F.array_intersect(x, y))
    return F.when(both == 0, 0.0).otherwise(2.0 * both / (F.size(x) + F.size(y)))


def restates_question(answer: Column, question: Column) -> Column:
    return (overlap(answer, question) > 0.95) & (overlap(question, answer) > 0.80)
