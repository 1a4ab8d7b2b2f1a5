"""Ratcliff-Obershelp similarity in Arrow batches; Spark has no built-in for it."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts between 0 and 1; null with a null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def spellings(cutoff: float = 0.85, most: int = 5):
    """UDF (term, text) -> array of the term's spellings in a lower-cased text: exact, fuzzy word, or fuzzy run of words."""

    def of(term: str | None, text: str | None, words: list[str]) -> list[str]:
        term = (term or "").lower()
        if not term or not text:
            return []
        found = {term} if term in text else set()
        size = len(term.split())
        if size == 1:
            found.update(difflib.get_close_matches(term, words, n=most, cutoff=cutoff))
        elif size:
            matcher = difflib.SequenceMatcher()
            matcher.set_seq2(term)
            for phrase in dict.fromkeys(" ".join(words[i : i + size]) for i in range(len(words) - size + 1)):
                matcher.set_seqs(term, phrase)
                if matcher.real_quick_ratio() >= cutoff and matcher.quick_ratio() >= cutoff and matcher.ratio() >= cutoff:
                    found.add(phrase)
        return sorted(found)

    @F.pandas_udf("array<string>")
    def run(terms: pd.Series, texts: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([of(t, x, list(w) if w is not None else []) for t, x, w in zip(terms, texts, words)])

    return run
