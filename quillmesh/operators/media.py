"""Recordings and scans: pieces to upload, transcripts put together, whether pages have text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def planned_pieces(media: DataFrame, key: str, *, size: str, seconds: str, most_bytes: int, wanted_seconds: int, target_ratio: float = 0.9) -> DataFrame:
    """(key, piece, start, length): a recording that is small enough is one piece; others are cut into pieces of equal time, short
    enough to stay below ``most_bytes`` times ``target_ratio``, but not under a minute."""
    safe = F.greatest(F.lit(60), F.floor(F.lit(most_bytes * target_ratio) / (F.col(size) / F.col(seconds))).cast("int"))
    step = F.least(F.lit(wanted_seconds), safe)
    starts = F.when(F.col(size) <= most_bytes, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.ceil(seconds).cast("int") - 1, step))
    length = F.when(F.col(size) <= most_bytes, F.ceil(seconds).cast("int")).otherwise(step)
    return media.withColumn("length", length).select(key, "length", F.posexplode(starts).alias("piece", "start")).select(key, "piece", "start", "length")


def merged_transcripts(pieces: DataFrame, key: str, *, offset: str, language: str, segments: str) -> tuple[DataFrame, DataFrame]:
    """Segments of all pieces with their times from the start of the whole, and per key their number, end, languages and text.

    ``segments`` is an array of struct(start, end, text); a segment without start begins with its piece, one without end has no
    duration. Languages are in the order in which they come up, "en" where none is known.
    """
    begin = F.coalesce("_s.start", F.lit(0.0)) + F.col(offset)
    end = F.coalesce("_s.end", F.coalesce("_s.start", F.lit(0.0))) + F.col(offset)
    rows = pieces.select(key, offset, F.posexplode(segments).alias("_i", "_s"))
    rows = rows.select(key, offset, "_i", F.round(begin, 3).alias("start"), F.round(F.greatest(end - begin, F.lit(0.0)), 3).alias("duration"), F.trim(F.coalesce("_s.text", F.lit(""))).alias("text"))
    order = F.struct(F.col(offset).alias("o"), F.col("_i").alias("i"), F.col("text").alias("t"))
    texts = F.transform(F.filter(F.array_sort(F.collect_list(order)), lambda x: x["t"] != ""), lambda x: x["t"])
    whole = rows.groupBy(key).agg(F.count("*").alias("segments"), F.round(F.max(F.col("start") + F.col("duration")), 3).alias("seconds"), F.array_join(texts, "\n").alias("text"))
    spoken = pieces.filter(F.col(language) != "").groupBy(key, language).agg(F.min(offset).alias("_o"))
    spoken = spoken.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", language))), lambda x: x[language]), ",").alias("languages"))
    whole = whole.join(spoken, key, "left").withColumn("languages", F.coalesce("languages", F.lit("en")))
    return rows.select(key, "start", "duration", "text"), whole


def sampled_page(page: Column, pages: Column, target: int) -> Column:
    """Whether a page (from 1) is in the sample of a document: about ``target`` pages at equal steps behind the first twentieth."""
    start = F.greatest(F.lit(1), F.floor(pages * 0.05).cast("int"))
    span = pages - start + 1
    step = span / F.lit(float(target))
    nearest = F.ceil((page - start) / step)
    hit = (F.floor(start + nearest * step) == page) & (nearest < target)
    return (page >= start) & ((span <= target) | hit)


def text_layers(pages: DataFrame, doc: str, *, page: str, words: str, target: int = 20, least_words: int = 50, least_ratio: float = 0.7) -> DataFrame:
    """Per document its pages, those sampled, their share with text and the verdict: TEXT, PARTIAL or OCR_REQUIRED.

    A sampling operator: the pages that count are given by ``sampled_page``.
    """
    counts = pages.groupBy(doc).agg(F.max(page).cast("int").alias("pages"))
    rows = pages.join(counts, doc).filter(sampled_page(F.col(page), F.col("pages"), target))
    per = rows.groupBy(doc).agg(F.max("pages").alias("pages"), F.count("*").alias("sampled"), F.count_if(F.col(words) >= least_words).alias("with_text"), F.sum(words).alias("_words"))
    ratio = F.col("with_text") / F.col("sampled")
    verdict = F.when(ratio >= least_ratio, "TEXT").when(ratio == 0, "OCR_REQUIRED").otherwise("PARTIAL")
    return per.select(doc, "pages", "sampled", "with_text", F.round(ratio, 3).alias("text_ratio"), F.floor(F.col("_words") / F.col("sampled") * F.col("pages")).cast("long").alias("projected_words"), verdict.alias("verdict"))
