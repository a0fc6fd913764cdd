"""Reading the fields of JSON messages.

The accepted coercions depend on the JSON type that was sent: ``"0.45"`` is a fine price, ``5`` is
not a fine user id, and a null is not the same as an absent field. VARIANT keeps that apart, plain
``from_json`` types do not, but reading scalars out of VARIANT costs several times as much. So
messages are read as plain text fields first, and a field's reader says for which texts the JSON
type cannot matter. Only messages with another text in some field are read again as VARIANT.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted text forms ----------------------------------------------------
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
TIMESTAMP_TEXT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([Tt _]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})?)?$"
)
# Texts that read the same whether they were sent as a string or as another JSON type.
PLAIN_NUMBER_TEXT = r"^-?\d+(\.\d+)?$"
PLAIN_INTEGER_TEXT = r"^-?\d+$"
PLAIN_TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
# Texts that a number or another JSON type can have as well as a string.
JSON_NUMBER_TEXT = r"^[-+]?(\d+(\.\d+)?([eE][+-]?\d+)?|INF|Infinity)$"
JSON_WORDS = ["true", "false", "NaN", "INF", "Infinity"]
TRUE_TEXT = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXT = ["0", "off", "f", "false", "n", "no"]
# Epoch numbers beyond this are milliseconds.
EPOCH_SECONDS_LIMIT = 20_000_000_000


def _from_json_array(value: Column, element: str) -> Column:
    """The message read as an array of one element.

    ``from_json`` stops at the end of the first JSON value. With brackets around the message,
    trailing text is a syntax error or a second element and cannot pass unseen.
    """
    return F.from_json(
        F.concat(F.lit("["), value, F.lit("]")), f"ARRAY<{element}>", {"allowSingleQuotes": "false"}
    )


def parse_objects(value: Column, names: Sequence[str], field_type: str) -> Column:
    """The message as an array of one struct; of a repeated key the last one counts.

    As STRING fields, a text is the string sent or the JSON text of anything else, and null is
    like absent. As VARIANT fields, an absent field is NULL and a null is a VARIANT null.
    """
    return _from_json_array(value, f"STRUCT<{', '.join(f'{n}: {field_type}' for n in names)}>")


def parse_any(value: Column) -> Column:
    """The message as an array of one VARIANT."""
    return _from_json_array(value, "VARIANT")


def is_one_object(value: Column, parsed: Column) -> Column:
    """True when the message is exactly one JSON object."""
    bare = F.trim(value, F.lit(" \t\r\n"))
    whole = bare.startswith("{") & bare.endswith("}")
    return F.coalesce((F.size(parsed) == 1) & whole, F.lit(False))


class Sent(NamedTuple):
    """What a message holds for one field: the value as VARIANT and its JSON type.

    The type is NULL when the field is absent, VOID for null, else STRING, BIGINT, DOUBLE, …
    """

    variant: Column
    kind: Column

    @property
    def is_number(self) -> Column:
        return self.kind.isin("BIGINT", "DOUBLE", "FLOAT") | self.kind.startswith("DECIMAL")

    @property
    def is_boolean(self) -> Column:
        return self.kind == "BOOLEAN"

    @property
    def is_string(self) -> Column:
        return self.kind == "STRING"

    def get(self, target: str) -> Column:
        return F.try_variant_get(self.variant, "$", target)


class Reader(NamedTuple):
    """How one type is read.

    ``usual`` tells for which texts ``from_text`` gives what ``from_sent`` would give for every
    JSON type that has this text. Both give NULL for a value that is not acceptable.
    """

    usual: Callable[[Column], Column]
    from_text: Callable[[Column], Column]
    from_sent: Callable[[Sent], Column]


def _number(sent: Sent) -> Column:
    raw = sent.get("string")
    return (
        F.when(sent.is_number | sent.is_boolean, sent.get("double"))
        .when(sent.is_string & raw.rlike(NUMBER_TEXT), F.trim(raw).try_cast("double"))
    )


def _integer(sent: Sent) -> Column:
    raw, as_double = sent.get("string"), sent.get("double")
    whole = sent.is_number & (as_double == F.floor(as_double))
    return (
        F.when(sent.is_boolean | whole, as_double.try_cast("int"))
        .when(sent.is_string & raw.rlike(INTEGER_TEXT),
              F.regexp_extract(raw, r"[+-]?\d+", 0).try_cast("int"))
    )


def _boolean(sent: Sent) -> Column:
    word = F.lower(sent.get("string"))
    known = (sent.is_string | sent.is_number) & word.isin(TRUE_TEXT + FALSE_TEXT)
    return F.when(sent.is_boolean, sent.get("boolean")).when(known, word.isin(TRUE_TEXT))


def _instant(sent: Sent) -> Column:
    raw, epoch = F.trim(sent.get("string")), sent.get("double")
    seconds = F.when(F.abs(epoch) <= EPOCH_SECONDS_LIMIT, epoch).otherwise(epoch / 1000)
    is_epoch = sent.is_number | (sent.is_string & raw.rlike(NUMBER_TEXT))
    iso = F.regexp_replace(F.translate(raw, "_tz,", "TTZ."), r"([T ]\d{2}:\d{2})(?!:)", "$1:00")
    return (
        F.when(sent.is_string & raw.rlike(TIMESTAMP_TEXT), iso.try_cast("timestamp"))
        .when(is_epoch, F.timestamp_micros((seconds * 1_000_000).try_cast("long")))
    )


def _only_a_string(raw: Column) -> Column:
    # Most ids start with a letter, which settles it without a pattern.
    other = raw.startswith("[") | raw.startswith("{") | raw.isin(JSON_WORDS)
    return F.when(raw >= "A", ~other).otherwise(~raw.rlike(JSON_NUMBER_TEXT))


def text() -> Reader:
    """Only JSON strings are text; numbers are not turned into ids."""
    return Reader(
        usual=_only_a_string,
        from_text=lambda raw: raw,
        from_sent=lambda sent: F.when(sent.is_string, sent.get("string")),
    )


def number() -> Reader:
    """Numbers, booleans as 0/1, and numeric text."""
    return Reader(
        usual=lambda raw: raw.rlike(PLAIN_NUMBER_TEXT),
        from_text=lambda raw: raw.try_cast("double"),
        from_sent=_number,
    )


def integer() -> Reader:
    """Whole numbers, also when sent as 10.0, as text, or as a boolean."""
    return Reader(
        usual=lambda raw: raw.rlike(PLAIN_INTEGER_TEXT),
        from_text=lambda raw: raw.try_cast("int"),
        from_sent=_integer,
    )


def boolean() -> Reader:
    """Booleans, 0/1, and the usual words."""
    return Reader(
        usual=lambda raw: raw.isin("true", "false"),
        from_text=lambda raw: raw == "true",
        from_sent=_boolean,
    )


def instant() -> Reader:
    """ISO-8601 text (no zone means the session zone) or an epoch number."""
    return Reader(
        usual=lambda raw: raw.rlike(PLAIN_TIMESTAMP_TEXT),
        from_text=lambda raw: raw.try_cast("timestamp"),
        from_sent=_instant,
    )
