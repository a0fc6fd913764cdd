"""Small Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlumen.schemas import COUNTRIES, MAX_BID_PRICE, SILVER_CURRENCIES

MICROS = 1_000_000.0


def quality_issues() -> Column:
    """Comma-separated names of the quality rules a bronze row breaks, '' when it breaks none.

    A NULL country or currency is not reported: it is neither in nor out of the allowed list.
    """
    rules = [
        ("null_bid_price", F.col("bid_price").isNull()),
        ("null_user_id", F.col("user_id").isNull()),
        ("invalid_country", ~F.col("country_code").isin(COUNTRIES)),
        ("invalid_currency", ~F.col("currency").isin(SILVER_CURRENCIES)),
        ("bid_price_exceeds_threshold", F.col("bid_price") > MAX_BID_PRICE),
    ]
    return F.concat_ws(", ", *[F.when(broken, F.lit(name)) for name, broken in rules])


def rate(part: Column, whole: Column) -> Column:
    """part / whole rounded to 4 places, 0.0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, 4)).otherwise(F.lit(0.0))


def micros(amount: str) -> Column:
    """An amount in whole millionths, the precision prices are stored with.

    Sums of whole numbers do not depend on the order of the rows, so a repeated task or another
    partitioning cannot change the last digit of a result, and they stay in hash aggregation.
    An amount that is not finite, or beyond nine million millions, counts as NULL: one such row of a
    stored table must not end the run.
    """
    return F.rint(F.col(amount) * MICROS).try_cast("long")


def amount(total_micros: Column) -> Column:
    """Summed millionths as an amount, rounded to 4 places."""
    return F.round(total_micros / MICROS, 4)


def mean_amount(total_micros: Column, n: Column) -> Column:
    """Mean amount from the unrounded total, rounded to 4 places; NULL when n is 0."""
    return F.round(F.try_divide(total_micros, n) / MICROS, 4)


def cpm(total_micros: Column, impressions: Column) -> Column:
    """Revenue per thousand impressions from the unrounded total; NULL without impressions."""
    return F.round(F.try_divide(total_micros, impressions) / (MICROS / 1000), 4)


def whole(column: str, places: int = 4) -> Column:
    """A value in whole units of its last decimal; NULL if it is not finite or fits no long."""
    return F.rint(F.col(column) * 10.0 ** places).try_cast("long")


def exact_sum(column: str, places: int = 4) -> Column:
    """Aggregate: order-independent sum of values that have at most ``places`` decimals."""
    return F.sum(whole(column, places)) / 10.0 ** places


def most_frequent(value: str, count: Column, among: Column | None = None) -> Column:
    """Aggregate: the value with the highest count; on a tie the smallest value, NULL last.

    ``among`` limits the rows that compete. It is an ordinary aggregate, so a hot group is
    combined before the shuffle and never sorted in one task.
    """
    order = F.struct((-count).alias("n"), F.col(value).isNull().alias("missing"), F.col(value).alias("v"))
    return F.min_by(F.col(value), order if among is None else F.when(among, order))


def code(prefix: str, number: Column, width: int) -> Column:
    """An identifier such as ``adv_007``; numbers wider than ``width`` keep all their digits."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
    )


def pick(index: Column, values: Sequence[str]) -> Column:
    """The value at a 0-based index of a short fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
