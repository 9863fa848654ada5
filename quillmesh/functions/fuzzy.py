"""Comparisons that built-in expressions lack, as Arrow-batched functions."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two strings, 0 to 1; null counts as empty."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def topic_match(text: pd.Series, title: pd.Series, words: pd.Series) -> pd.Series:
    """How well ``text`` fits a topic: the ratio with its title, or the mean of that and the share of words found."""
    out = []
    for t, n, w in zip(text, title, words):
        target, name, have = (" ".join((x or "").lower().split()) for x in (t, n, w))
        ratio = difflib.SequenceMatcher(None, target, name).ratio()
        asked = set(target.split())
        out.append(max(ratio, 0.5 * ratio + 0.5 * len(asked & set(have.split())) / max(1, len(asked))))
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.StringType())
def without_accents(text: pd.Series) -> pd.Series:
    """Decomposed and stripped of combining marks; null stays null."""
    return text.map(lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)), na_action="ignore")
