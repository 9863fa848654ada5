"""Routing of texts to families by weighted terms, given as a table of parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def haystack(*parts: Column) -> Column:
    """The parts in lower case, as they are and with punctuation (but + # .) as blanks."""
    joined = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))
    return F.concat(joined, F.lit(" "), F.regexp_replace(joined, r"[^a-z0-9+#.]+", " "))


def with_family_scores(df: DataFrame, text: Column, families: dict[str, dict[str, float]]) -> DataFrame:
    """``df`` with family_scores: array<struct(family, score, hits)> of the families whose terms occur, best first, then by name.

    ``text`` is a ``haystack``. It is made once per row and searched once for all words together, and once for each
    term that has a blank or punctuation: no join, no shuffle. The terms are parameters, a few hundred constants.
    """
    terms = sorted({t for weights in families.values() for t in weights})
    phrases = [t for t in terms if any(c in t for c in " -.+#")]
    words = [t for t in terms if t not in phrases]
    found = [F.array_compact(F.array(*[F.when(F.contains("_text", F.lit(p)), F.lit(p)) for p in phrases]).cast("array<string>"))]
    if words:
        found.append(F.array_distinct(F.regexp_extract_all("_text", F.lit(whole_words(words)), F.lit(0))))
    out = df.withColumn("_text", text).withColumn("_found", F.concat(*found)).drop("_text")
    made = []
    for family, weights in sorted(families.items()):
        hit = {t: F.array_contains("_found", t) for t in weights}
        score = sum((F.when(h, float(weights[t])).otherwise(0.0) for t, h in hit.items()), F.lit(0.0))
        hits = F.array_compact(F.array(*[F.when(h, F.lit(t)) for t, h in hit.items()]))
        made.append(F.struct((-score).alias("_order"), F.lit(family).alias("family"), score.alias("score"), hits.alias("hits")))
    ordered = F.array_sort(F.filter(F.array(*made), lambda x: x["score"] > 0))
    shown = F.transform(ordered, lambda x: F.struct(x["family"].alias("family"), x["score"].alias("score"), x["hits"].alias("hits")))
    return out.withColumn("family_scores", shown).drop("_found")


def whole_words(words: list[str]) -> str:
    """A pattern for any of the words, longest first, with no letter or digit at either side."""
    return rf"(?<![a-z0-9])(?:{'|'.join(sorted(words, key=lambda w: (-len(w), w)))})(?![a-z0-9])"


def classified(df: DataFrame, text: Column, families: dict[str, dict[str, float]], *, least: float = 5.0) -> DataFrame:
    """``df`` with family_scores and families: those of at least ``least``, else the best one, else none."""
    out = with_family_scores(df, text, families)
    strong = F.filter("family_scores", lambda x: x["score"] >= least)
    chosen = F.when(F.size(strong) > 0, strong).otherwise(F.slice("family_scores", 1, 1))
    return out.withColumn("families", F.transform(chosen, lambda x: x["family"]))


def routed(df: DataFrame, topics: Column, description: Column, families: dict[str, list[str]]) -> DataFrame:
    """``df`` with tags, source ("topic", "desc", "none") and bucket ("dark", "clean", "ambiguous" for 0, 1, more tags).

    A family is tagged if one of its signals is a topic, or else a whole word of the description.
    """
    every = sorted({s for signals in families.values() for s in signals})
    words = F.regexp_extract_all(F.lower(F.coalesce(description, F.lit(""))), F.lit(whole_words(every)), F.lit(0))
    df = df.withColumn("_topics", F.transform(F.coalesce(topics, F.array().cast("array<string>")), lambda t: F.lower(t))).withColumn("_words", words)
    tags, by_topic = [], F.lit(False)
    for family, signals in sorted(families.items()):
        wanted = F.array(*[F.lit(s) for s in signals])
        in_topics, in_text = F.arrays_overlap("_topics", wanted), F.arrays_overlap("_words", wanted)
        tags.append(F.when(in_topics | in_text, F.lit(family)))
        by_topic = by_topic | in_topics
    n = F.size("tags")
    source = F.when(n == 0, "none").when(by_topic, "topic").otherwise("desc")
    out = df.withColumn("tags", F.array_compact(F.array(*tags))).withColumn("source_of_tags", source).drop("_topics", "_words")
    return out.withColumn("bucket", F.when(n == 0, "dark").when(n == 1, "clean").otherwise("ambiguous"))
