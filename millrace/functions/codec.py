"""Delimited messages of Base64 fields, as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = ","

# The standard Base64 alphabet with its padding sign, to the very
# end of the text: a dollar sign would let a line end pass.
BASE64_TOKEN = r"^[A-Za-z0-9+/=]*\z"
# Fixed value: how a missing field is spelled inside a message.
NULL_TEXT = "null"

# try_to_binary checks length and padding but skips whitespace, hence the
# alphabet test. Bytes that are not UTF-8 become U+FFFD.
_DECODE_SQL = (
    "CASE WHEN {x} RLIKE '" + BASE64_TOKEN.replace("\\", "\\\\") + "' "
    "THEN make_valid_utf8(CAST(try_to_binary({x}, 'base64') AS STRING)) END"
)


def base64_text(token: Column) -> Column:
    """Text behind a Base64 token, or NULL when the token is not valid Base64."""
    decoded = F.make_valid_utf8(F.try_to_binary(token, F.lit("base64")).cast("string"))
    return F.when(token.rlike(BASE64_TOKEN), decoded)


def base64_token(text: Column) -> Column:
    """Unbroken Base64 token of a text (Spark's ``base64`` wraps at 76 characters)."""
    wrapped = F.base64(text.cast("string").cast("binary"))
    return F.replace(wrapped, F.lit("\r\n"), F.lit(""))


def register_converter(spark: SparkSession, name: str = "converter") -> None:
    """Make :func:`base64_text` callable from SQL; the optimizer inlines it."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING "
        f"RETURN {_DECODE_SQL.format(x='x')}"
    )


def split_fields(message: Column, *, drop_trailing_empty: bool = False) -> Column:
    """Fields of a message as an array.

    Trailing empty fields are kept so that fixed-width records stay aligned;
    ``drop_trailing_empty`` drops them, and gives no field at all for a message
    made of separators only.
    """
    if not drop_trailing_empty:
        return F.split(message, SEPARATOR, -1)
    stripped = F.rtrim(message, F.lit(SEPARATOR))
    no_fields = (stripped == "") & (message != "")
    return F.when(no_fields, F.array().cast("array<string>")).otherwise(
        F.split(stripped, SEPARATOR, -1)
    )


def decode_fields(message: Column, *, drop_trailing_empty: bool = False) -> Column:
    """Decoded fields of a message of any width; invalid tokens become NULL."""
    fields = split_fields(message, drop_trailing_empty=drop_trailing_empty)
    return F.transform(fields, base64_text)


def join_fields(columns: Sequence[Column]) -> Column:
    """One message from many columns; a NULL is spelled out so no field shifts."""
    spelled = [F.coalesce(c.cast("string"), F.lit(NULL_TEXT)) for c in columns]
    return F.concat_ws(SEPARATOR, *spelled)


def rows_to_messages(df: DataFrame) -> DataFrame:
    """All columns of each row joined into the single column ``value``."""
    return df.select(join_fields([df[f"`{c}`"] for c in df.columns]).alias("value"))


def decode_records(
    messages: DataFrame, schema: T.StructType, value: str = "value"
) -> DataFrame:
    """Fixed-width messages as typed columns plus ``quarantined``.

    Every field is decoded by position and cast to its declared type; a field
    spelled ``null`` and an empty number, date or the like are NULL. A message
    with the wrong number of fields, an invalid token or a text that does not
    fit its type keeps its text in ``quarantined`` and has NULL in every column;
    good messages have NULL there. A missing message counts as empty. Fields are addressed one by one rather than
    through a lambda over the array, so the projection stays in generated code.
    """
    message = F.col(value).cast("string")
    fields = messages.select(
        message.alias("_message"), F.split(message, SEPARATOR, -1).alias("_fields")
    )
    decoded = [F.col("_message"), F.size("_fields").alias("_width")]
    for i in range(len(schema)):
        token = F.get("_fields", F.lit(i))
        decoded.append((token == NULL_TEXT).alias(f"_null{i}"))
        decoded.append(base64_text(token).alias(f"_text{i}"))
    texts = fields.select(*decoded)

    good = F.col("_width") == len(schema)
    values = []
    for i, field in enumerate(schema):
        text = F.col(f"_text{i}")
        if not isinstance(field.dataType, T.StringType):
            text = F.nullif(text, F.lit(""))
        typed = text.try_cast(field.dataType)
        fits = F.col(f"_text{i}").isNotNull() & (text.isNull() | typed.isNotNull())
        good = good & (F.col(f"_null{i}") | fits)
        values.append((field.name, F.when(~F.col(f"_null{i}"), typed)))
    good = F.coalesce(good, F.lit(False))
    return texts.select(
        *[F.when(good, typed).alias(name) for name, typed in values],
        F.when(~good, F.coalesce("_message", F.lit(""))).alias("quarantined"),
    )
