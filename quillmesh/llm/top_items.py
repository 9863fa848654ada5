"""Top N items within every group, with one tie rule.

Method: SQL ``row_number`` over score and identifier with a filter on the rank, so that the optimizer puts a
group limit before and after the shuffle: of a group with millions of rows each task sends N at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.storage import blank_to_null, pick


def top_items(df: DataFrame, *, group: str, item: str, score: str, n: int) -> DataFrame:
    """The ``n`` items of highest score of every group: group_id, place (1 to n), item, score.

    An item counts once per group, with its highest score; ties in score go by item in byte order, so that
    places have neither gaps nor repeats and are the same on every run. A null or NaN score is no score, an
    item without any isn't ranked; -0.0 equals 0.0. Rows with a null group or a null or blank item are left
    out. Groups with fewer items give fewer rows; an empty table none. Of further columns nothing is read.
    """
    rows = pick(df, group_id=group, item=item, score=score)
    rows = rows.select("group_id", blank_to_null(F.col("item")).alias("item"), (F.col("score").cast("double") + F.lit(0.0)).alias("score"))
    rows = rows.filter("group_id is not null and item is not null and score is not null and not isnan(score)")
    best = rows.groupBy("group_id", "item").agg(F.max("score").alias("score"))
    return df.sparkSession.sql(
        """
        SELECT group_id, place, item, score FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY group_id ORDER BY score DESC, item) AS INT) AS place FROM {best}
        ) WHERE place <= {n}
        """,
        best=best,
        n=int(n),
    )
