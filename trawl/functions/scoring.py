"""Ranking formulas as Column expressions.

A ranker is any callable ``(tf, df, dl, n, avgdl) -> Column``; it is evaluated
inside Catalyst, so a user-defined ranker costs no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

Ranker = Callable[[Column, Column, Column, Column, Column], Column]

# The reference's ranking parameters.
BM25_K1 = 1.5
BM25_B = 0.75


def bm25(tf: Column, df: Column, dl: Column, n: Column, avgdl: Column,
         k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """Okapi BM25 term score with the ``+1`` inside the idf logarithm."""
    tf = tf.cast("double")
    df = df.cast("double")
    idf = F.ln((n - df + F.lit(0.5)) / (df + F.lit(0.5)) + F.lit(1.0))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl.cast("double") / avgdl)
    return idf * (tf * F.lit(k1 + 1.0)) / (tf + norm)


def tfidf(tf: Column, df: Column, dl: Column, n: Column, avgdl: Column) -> Column:
    """``(1 + ln tf) * ln(N / df)``; no length normalisation."""
    return (F.lit(1.0) + F.ln(tf.cast("double"))) * F.ln(n.cast("double") / df.cast("double"))


def bm25_with(k1: float, b: float) -> Ranker:
    return partial(bm25, k1=k1, b=b)


RANKERS: dict[str, Ranker] = {"bm25": bm25, "tfidf": tfidf}


def resolve_ranker(ranker: str | Ranker) -> Ranker:
    if callable(ranker):
        return ranker
    try:
        return RANKERS[ranker.lower()]
    except KeyError:
        raise ValueError(f"unknown ranker {ranker!r}; expected one of {sorted(RANKERS)} or a function") from None
