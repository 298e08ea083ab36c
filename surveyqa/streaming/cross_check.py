"""The chapter comparison on streams: persons that one side lists and the other does not.

State is one row per (household, member) and one per household, each for as long as the watermark is behind
the interview's start. No household is gathered: members are aggregated one by one, as in the batch check,
and only a household's summary is joined back, salted. A questionnaire sent again changes nothing, since a
member is listed or not, however often.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa.operators.checks import SALTS


def side(df: DataFrame, key: str, member: str, event_time: str, carry: Sequence[str], left: bool, member_type: str) -> DataFrame:
    return df.select(
        F.col(f"`{key}`"), F.col(f"`{member}`").try_cast(member_type).alias("member"), F.col(f"`{event_time}`"),
        *[F.col(f"`{c}`") for c in carry], F.lit(left).alias("in_left"), F.lit(not left).alias("in_right"),
    )


def stream_mismatch(
    left: DataFrame, right: DataFrame, key: str, left_member: str, right_member: str, event_time: str, delay: str,
    carry: Sequence[str] = (), salts: int = SALTS,
) -> DataFrame:
    """Members listed on one side only, for households present on both, once their time is over.

    Columns: the key, ``event_time``, the carried columns, ``member``, ``in_left``. ``event_time`` is a
    timestamp that all answers of a household share, such as the start of the interview; answers that come
    more than ``delay`` after a later one are left out. Append mode: a household's rows come when the
    watermark has passed its time. Answers without a member neither count nor move the watermark.
    """
    member_type = left.select(F.col(f"`{left_member}`")).schema[0].dataType.simpleString()
    sides = side(left, key, left_member, event_time, carry, True, member_type).unionByName(
        side(right, key, right_member, event_time, carry, False, member_type)
    ).withWatermark(event_time, delay)
    household = [F.col(f"`{event_time}`"), F.col(f"`{key}`")]
    pairs = sides.filter("member IS NOT NULL").groupBy(*household, "member").agg(
        F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"), *[F.min(F.col(f"`{c}`")).alias(c) for c in carry]
    )
    differs = F.col("in_left") != F.col("in_right")
    summary = pairs.groupBy(*household).agg(
        F.max("in_left").alias("any_left"), F.max("in_right").alias("any_right"), F.max(differs).alias("any_differs")
    ).filter("any_left AND any_right AND any_differs").select(
        *household, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    different = pairs.filter(differs).withColumn("salt", F.pmod(F.hash("member"), F.lit(salts)))
    return different.join(summary, [event_time, key, "salt"]).select(
        F.col(f"`{key}`"), F.col(f"`{event_time}`"), *[F.col(f"`{c}`") for c in carry], "member", "in_left"
    )
