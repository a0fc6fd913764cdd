"""Message validation.

``validate_*`` takes a frame with a JSON text column and returns it with the message's typed
fields and ``errors``, the names of all rules the message breaks (empty for a valid one). It is a
projection: no shuffle, no Python per row. Unknown fields are ignored; an absent optional field
gets its default, an explicit null does not.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.functions import coerce
from adlumen.functions.columns import rate
from adlumen.schemas import (
    AD_FORMATS, DEVICES, IMPRESSION_COLUMNS, INGEST_CURRENCIES, PAYMENT_STATUSES,
)


def parse_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``is_malformed`` and, for well-formed messages, ``event`` as VARIANT."""
    text = F.col(value_col).cast("string")
    well_formed = coerce.is_one_object(text, F.col("_parsed"))
    return (
        messages.withColumn("_parsed", coerce.parse_any(text))
        .withColumn("is_malformed", ~well_formed)
        .withColumn("event", F.when(well_formed, F.get("_parsed", F.lit(0))))
        .drop("_parsed")
    )


class _Field(NamedTuple):
    """One field's rule: how it is read, what it must satisfy, how it is stored."""

    name: str
    reader: coerce.Reader
    default: Column | None = None
    check: Callable[[Column], Column] = lambda value: F.lit(True)
    clean: Callable[[Column], Column] = lambda value: value


def _validate(messages: DataFrame, value_col: str, fields: list[_Field]) -> DataFrame:
    """Typed fields and errors, in steps that each use the columns of the one before.

    A step's columns are read several times by the next one, so Spark keeps the steps apart and
    evaluates every lookup once per message.

    Columns of ``messages`` stay, unless one has the name of a field or of the result, as the time
    stamp of a topic's frame has: then all but the text move into the struct ``source``.
    """
    names = [f.name for f in fields]
    messages = _own_columns_apart(messages, value_col, [*names, "errors"])
    keep, text = messages.columns, F.col(value_col).cast("string")
    first = F.get("_texts", F.lit(0))
    texts = messages.withColumn("_texts", coerce.parse_objects(text, names, "STRING")).select(
        *keep,
        coerce.is_one_object(text, F.col("_texts")).alias("_ok"),
        *[first.getField(n).alias(f"_{n}_text") for n in names],
    )
    usual = functools.reduce(
        lambda all_usual, f: all_usual & f.reader.usual(F.col(f"_{f.name}_text")), fields, F.lit(True)
    )
    doubted = texts.withColumn("_doubt", F.col("_ok") & ~F.coalesce(usual, F.lit(False)))
    sent = (
        doubted.withColumn("_sent", F.when(F.col("_doubt"), coerce.parse_objects(text, names, "VARIANT")))
        .withColumns({f"_{n}": F.get("_sent", F.lit(0)).getField(n) for n in names})
        .withColumns({f"_{n}_kind": F.schema_of_variant(f"_{n}") for n in names})
    )

    def absent(f: _Field) -> Column:
        return F.col("_doubt") & F.col(f"_{f.name}_kind").isNull()

    def value_of(f: _Field) -> Column:
        again = f.reader.from_sent(coerce.Sent(F.col(f"_{f.name}"), F.col(f"_{f.name}_kind")))
        value = F.when(F.col("_doubt"), again).otherwise(f.reader.from_text(F.col(f"_{f.name}_text")))
        return value if f.default is None else F.when(absent(f), f.default).otherwise(value)

    # Defaults are filled in before the rules are checked. The generated id, being random, also
    # keeps a filter on the errors above this step instead of having it repeat the lookups below.
    filled = sent.select(
        *keep, "_ok",
        *[absent(f).alias(f"_{f.name}_absent") for f in fields],
        *[value_of(f).alias(f"_{f.name}_value") for f in fields],
    )

    def accepted(f: _Field) -> Column:
        value = F.col(f"_{f.name}_value")
        return value.isNotNull() & f.check(value)

    def broken(f: _Field) -> Column:
        code = F.lit(f"invalid_{f.name}")
        if f.default is None:
            code = F.when(F.col(f"_{f.name}_absent"), F.lit(f"missing_{f.name}")).otherwise(code)
        return F.when(~accepted(f), code)

    ok = F.col("_ok")
    none = F.array(F.lit(None).cast("string"))
    errors = (
        F.when(ok, F.array_except(F.array(*[broken(f) for f in fields]), none))
        .otherwise(F.array(F.lit("malformed_json")))
    )
    stored = [
        F.when(ok & accepted(f), f.clean(F.col(f"_{f.name}_value"))).alias(f.name) for f in fields
    ]
    return filled.select(*keep, *stored, errors.alias("errors"))


def _own_columns_apart(messages: DataFrame, value_col: str, taken: list[str]) -> DataFrame:
    own = [c for c in messages.columns if c.lower() != value_col.lower()]
    if {c.lower() for c in own}.isdisjoint(taken):
        return messages
    return messages.select(value_col, F.struct(*[F.col(f"`{c}`") for c in own]).alias("source"))


def _one_of(values: list[str]) -> Callable[[Column], Column]:
    return lambda value: value.isin(values)


def validate_impressions(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return _validate(messages, value_col, [
        _Field("impression_id", coerce.text(), default=F.uuid()),
        _Field("user_id", coerce.text()),
        _Field("advertiser_id", coerce.text()),
        _Field("campaign_id", coerce.text()),
        _Field("content_id", coerce.text()),
        _Field("bid_price", coerce.number(), check=lambda v: v > 0, clean=lambda v: F.bround(v, 6)),
        _Field("currency", coerce.text(), check=_one_of(INGEST_CURRENCIES)),
        _Field("country_code", coerce.text(), check=lambda v: F.length(v) == 2, clean=F.upper),
        _Field("device_type", coerce.text(), check=_one_of(DEVICES)),
        _Field("ad_format", coerce.text(), check=_one_of(AD_FORMATS)),
        _Field("timestamp", coerce.instant(), default=F.current_timestamp()),
        _Field("is_fraud", coerce.boolean(), default=F.lit(False)),
    ])


def validate_payments(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return _validate(messages, value_col, [
        _Field("payment_id", coerce.text(), default=F.uuid()),
        _Field("advertiser_id", coerce.text()),
        _Field("campaign_id", coerce.text()),
        _Field("amount", coerce.number(), check=lambda v: v > 0, clean=lambda v: F.bround(v, 2)),
        _Field("currency", coerce.text(), check=_one_of(INGEST_CURRENCIES)),
        _Field("impression_batch_id", coerce.text()),
        _Field("payment_status", coerce.text(), check=_one_of(PAYMENT_STATUSES)),
        _Field("timestamp", coerce.instant(), default=F.current_timestamp()),
    ])


def validate_engagements(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return _validate(messages, value_col, [
        _Field("engagement_id", coerce.text(), default=F.uuid()),
        _Field("user_id", coerce.text()),
        _Field("content_id", coerce.text()),
        _Field("impression_id", coerce.text()),
        _Field("watch_duration_seconds", coerce.integer()),
        _Field("completion_rate", coerce.number(), check=lambda v: v.between(0.0, 1.0),
               clean=lambda v: F.bround(v, 4)),
        _Field("clicked", coerce.boolean()),
        _Field("timestamp", coerce.instant(), default=F.current_timestamp()),
    ])


def valid(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") == 0)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") > 0)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); fraud events are valid, and every message is in exactly one of them."""
    return valid(validated), rejected(validated)


def bronze_rows(validated: DataFrame) -> DataFrame:
    """The rows bronze stores: valid impressions and the day they happened."""
    return with_ingestion_date(valid(validated).select(*IMPRESSION_COLUMNS))


def with_ingestion_date(impressions: DataFrame) -> DataFrame:
    """Adds the partition column. Despite its name it is the date of the event."""
    return impressions.withColumn("ingestion_date", F.to_date("timestamp"))


def ingest_stats(validated: DataFrame) -> DataFrame:
    """One row: valid, invalid and fraud counts and the fraud share of the valid ones."""
    is_valid = F.coalesce(F.size("errors"), F.lit(0)) == 0  # stored valid rows have no list
    counts = validated.agg(
        F.count_if(is_valid).alias("valid_count"),
        F.count_if(~is_valid).alias("invalid_count"),
        F.count_if(is_valid & F.col("is_fraud")).alias("fraud_count"),
    )
    return counts.withColumn("fraud_rate", rate(F.col("fraud_count"), F.col("valid_count")))


def fraud_alerts(validated: DataFrame) -> DataFrame:
    """One row per valid impression marked as fraud."""
    return valid(validated).where("is_fraud").select(
        "impression_id", "user_id", "bid_price", "advertiser_id"
    )
