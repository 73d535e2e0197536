"""Page finding: weighted keyword scores, title filters, top pages and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_score(text: Column, phrases: Sequence[str], indicators: Sequence[str], bonus: str | None = None, phrase_weight: float = 2.0, indicator_weight: float = 0.5, bonus_weight: float = 3.0, bonus_at: int = 3) -> Column:
    """phrase_weight for each phrase present, indicator_weight for each match of an indicator pattern, and
    bonus_weight once where the bonus pattern matches at least bonus_at times. Null text scores 0."""
    low = F.lower(F.coalesce(text, F.lit("")))
    score = F.lit(0.0)
    for phrase in phrases:
        score = score + F.when(F.contains(low, F.lit(phrase)), F.lit(phrase_weight)).otherwise(F.lit(0.0))
    for pattern in indicators:
        score = score + F.regexp_count(low, F.lit(pattern)) * F.lit(indicator_weight)
    if bonus is not None:
        score = score + F.when(F.regexp_count(low, F.lit(bonus)) >= bonus_at, F.lit(bonus_weight)).otherwise(F.lit(0.0))
    return score


def top_pages(df: DataFrame, group: str, score: str, order: str, n: int) -> DataFrame:
    """The n rows of each group with the highest positive score, ties by order; adds rank."""
    best = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(order).asc())
    return df.filter(F.col(score) > 0).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def title_filter(text: Column, caption: str, phrase: str, structure: Sequence[str], at_least: int = 3) -> Column:
    """True where the caption matches, or the phrase occurs and at least at_least structure patterns match."""
    hits = sum((F.when(text.rlike(p), 1).otherwise(0) for p in structure), F.lit(0))
    return F.coalesce(text.rlike(caption) | (text.rlike(phrase) & (hits >= at_least)), F.lit(False))


def fill_gaps(df: DataFrame, group: str, page: str, first: int, last: Column, gap: int = 3) -> DataFrame:
    """Adds the pages between two kept pages at most gap apart, and one at either end, within first..last."""
    w = Window.partitionBy(group).orderBy(page)
    spread = (
        df.select(group, page, last.alias("_last")).distinct()
        .withColumn("_next", F.lead(page).over(w)).withColumn("_prev", F.lag(page).over(w))
        .withColumn("_lo", F.when(F.col("_prev").isNull(), F.greatest(F.col(page) - 1, F.lit(first))).otherwise(F.col(page)))
        .withColumn("_hi", F.when(F.col("_next").isNull(), F.least(F.col(page) + 1, F.col("_last"))).when(F.col("_next") - F.col(page) <= gap, F.col("_next") - 1).otherwise(F.col(page)))
    )
    return spread.select(group, F.explode(F.sequence("_lo", "_hi")).alias(page)).distinct()
