"""The search side: n-gram typeahead, highlights and vector ranking over documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ngrams(c: Column, least: int = 3, most: int = 10) -> Column:
    """All distinct substrings of least to most characters of the words, in lower case."""
    words = F.split(F.lower(c), r"[^\p{L}\p{N}]+")
    sizes = F.array(*[F.lit(n) for n in range(least, most + 1)])

    def of(w: Column) -> Column:
        def cut(n: Column) -> Column:
            starts = F.when(F.length(w) >= n, F.sequence(F.lit(1), F.length(w) - n + 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.substring(w, i, n))

        return F.flatten(F.transform(sizes, cut))

    return F.array_distinct(F.flatten(F.transform(words, of)))


def matches(fields: list[str], term: str) -> Column:
    """Any field holds the term within a word, whatever the case.

    Terms of 3 to 10 characters are looked up among the n-grams, as with_ngrams() stores them; shorter and longer ones
    have none and are looked for in the words themselves.
    """
    out = F.lit(False)
    for f in fields:
        if 3 <= len(term) <= 10:
            found = F.array_contains(ngrams(F.col(f)), F.lit(term.lower()))
        else:
            found = F.exists(F.split(F.lower(F.col(f)), r"[^\p{L}\p{N}]+"), lambda w: w.contains(term.lower()))
        out = out | F.coalesce(found, F.lit(False))
    return out


def with_ngrams(documents: DataFrame, fields: list[str]) -> DataFrame:
    """The documents made anew with <field>_ngram beside each field, so that a search reads an array instead of cutting words."""
    return documents.withColumns({f"{f}_ngram": ngrams(F.col(f)) for f in fields})


def query(documents: DataFrame, body: str, name: str = "documents") -> DataFrame:
    """Any SQL over documents under a name; _meta, lineage and vectors are not part of what is searched."""
    hidden = [c for c in documents.columns if c in ("_meta", "_keys", "embedding")]
    return documents.sparkSession.sql(body, **{name: documents.drop(*hidden)})


def highlight(field: str, term: str, before: str = "<em>", after: str = "</em>") -> Column:
    return F.regexp_replace(F.col(field), f"(?i)({re.escape(term)})", f"{before}$1{after}")


def cosine(vector: Column, query: list[float]) -> Column:
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    v = vector.cast("array<double>")
    return dot(v, q) / F.sqrt(dot(v, v) * dot(q, q))


def top_by_cosine(df: DataFrame, vector: str, query: list[float], k: int, key: str) -> DataFrame:
    """The k rows of the highest cosine + 1, ties by key; the vector is left out."""
    scored = df.withColumn("score", cosine(F.col(vector), query) + 1.0)
    return scored.orderBy(F.desc("score"), key).limit(k).drop(vector)
