"""JSON documents as columns.

The parser accepts text after the first value, so the text is parsed as the first element of an
array whose second element is a hash of that same text. Anything that ends the array early, or
adds elements to it, fails the comparison with the hash.

VARIANT sorts object keys and normalises number scale. Where a stage hands a document on, the
checked source text goes on instead, so key order and number text survive; VARIANT is used to look
inside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of JSON; other white space outside strings is an error.
_SPACES = " \n\r\t"
_STRING = r'"(?:[^"\\]|\\.)*+"'
_STRING_OR_SPACE = rf"({_STRING})|[{_SPACES}]+"
# A null member after another one, null members at the start of an object, or a string to keep.
_NULL_MEMBER_OR_STRING = (
    rf",{_STRING}:null(?=[,}}])|(?<=\{{)(?:{_STRING}:null(?:,|(?=\}})))++|({_STRING})"
)


# Strict JSON, with strings of any length; ``try_parse_json`` stops at 20 million characters.
_STRICT = {
    "maxStringLen": "2147483647",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
#: Bytes of text from which a parsed document may outgrow what a VARIANT holds, 128 MiB.
LARGE_DOCUMENT = 120 * 1024 * 1024


def _wrapped(text: Column) -> Column:
    return F.from_json(
        F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]")),
        "variant",
        _STRICT,
    )


def not_parsed(text: Column, doc: Column, message: str) -> Column:
    """Why a row was rejected: the message, or that its text is too large to be parsed."""
    large = doc.isNull() & (F.octet_length(text) > LARGE_DOCUMENT)
    return F.when(large, F.lit("the document is too large")).otherwise(F.lit(message))


def once(value: Column) -> Column:
    """Keep a costly column from being worked out again wherever it is used.

    The optimizer moves a filter below the projection it looks at, and copies the column's
    expression into it — here the parsing of every document, several times over. It leaves
    columns alone that depend on the task, so the column is made to; the value is the same.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def with_document(df: DataFrame, text: str, out: str = "doc") -> DataFrame:
    """Add the text as VARIANT if it is exactly one JSON value, else null.

    It is parsed once per row whatever is made of it.
    """
    kept = [c for c in df.columns if c != out]
    wrapped = df.select(*kept, once(_wrapped(F.col(text))).alias("_wrapped"))
    whole = (
        F.try_variant_get("_wrapped", "$[1]", "bigint") == F.xxhash64(F.col(text))
    ) & F.try_variant_get("_wrapped", "$[2]", "variant").isNull()
    first = F.when(whole, F.try_variant_get("_wrapped", "$[0]", "variant"))
    return wrapped.select(*kept, once(first).alias(out))


def is_json(doc: Column) -> Column:
    """A parsed document exists. Always true or false."""
    return doc.isNotNull()


def is_object(text: Column, doc: Column) -> Column:
    """A valid document whose text opens an object; the text decides, so nothing is walked."""
    return doc.isNotNull() & _opens(text, "{")


def is_array(text: Column, doc: Column) -> Column:
    return doc.isNotNull() & _opens(text, "[")


def _opens(text: Column, bracket: str) -> Column:
    return F.coalesce(F.ltrim(text, F.lit(_SPACES)).startswith(bracket), F.lit(False))


def compact(text: Column) -> Column:
    """Drop white space outside strings; keys keep their order and numbers their text."""
    spaced = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in _SPACES])
    return F.when(
        spaced, F.regexp_replace(text, F.lit(_STRING_OR_SPACE), F.lit("$1"))
    ).otherwise(text)


def without_nulls(text: Column) -> Column:
    """Compact text without the object members that are null; nulls in arrays stay."""
    return F.when(
        F.contains(text, F.lit(":null")),
        F.regexp_replace(text, F.lit(_NULL_MEMBER_OR_STRING), F.lit("$1")),
    ).otherwise(text)


def quoted(text: Column) -> Column:
    """The text as a JSON string literal, or the literal ``null``."""
    listed = F.to_json(F.array(text))
    inner = F.substring(listed, F.lit(2), F.length(listed) - 2)
    return F.when(text.isNull(), F.lit("null")).otherwise(inner)


def scalar_text(doc: Column, path: str) -> Column:
    """the value at ``path`` read as a string.

    Strings come as they are, numbers and booleans as text, an array of exactly one element as that
    element. Missing values, JSON null, objects and other arrays are null.
    """
    value = F.try_variant_get(doc, path, "variant")
    kind = F.schema_of_variant(value)
    first = F.try_variant_get(doc, f"{path}[0]", "variant")
    first_kind = F.schema_of_variant(first)
    single = F.try_variant_get(doc, f"{path}[1]", "variant").isNull()
    nested = "^(OBJECT|ARRAY|VOID)"
    return F.when(
        kind.startswith("ARRAY"),
        F.when(single & ~first_kind.rlike(nested), F.try_variant_get(first, "$", "string")),
    ).when(~kind.rlike(nested), F.try_variant_get(value, "$", "string"))


def field_is_array(doc: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return F.coalesce(kind.startswith("ARRAY"), F.lit(False))


def has_more_than_one(doc: Column, path: str) -> Column:
    """the array at ``path`` has at least two elements."""
    return F.try_variant_get(doc, f"{path}[1]", "variant").isNotNull()


def array_size(doc: Column, path: str) -> Column:
    """element count of the array at ``path``; null if there is none."""
    return F.size(F.try_variant_get(doc, path, "array<variant>")).cast("int")


def open_field(text: Column, doc: Column, key: str) -> Column:
    """The object text up to the place for the value of ``key``; ``close_field`` completes it.

    A new key goes to the end of the compact source text. If the key is there already the object is
    rebuilt without it, as its old value has to go.
    """
    kept = F.map_filter(doc.cast("map<string,variant>"), lambda k, _: k != F.lit(key))
    present = F.try_variant_get(doc, f"$.{key}", "variant").isNotNull()
    body = F.when(present, F.to_json(kept)).otherwise(compact(text))
    head = F.substring(body, F.lit(1), F.length(body) - 1)
    comma = F.when(head != "{", F.lit(",")).otherwise(F.lit(""))
    return F.concat(head, comma, F.lit(f'"{key}":'))


def close_field(opened: Column, value: Column) -> Column:
    return F.concat(opened, quoted(value), F.lit("}"))


def set_field(text: Column, doc: Column, key: str, value: Column) -> Column:
    """the object text with ``key`` set to a string or to JSON null."""
    return close_field(open_field(text, doc, key), value)


def array_wrap(text: Column, key: str) -> Column:
    """``{"key":[…]}`` around a checked array text; null members are dropped."""
    return F.concat(F.lit(f'{{"{key}":'), without_nulls(compact(text)), F.lit("}"))


def parse_error_text(doc: Column) -> Column:
    """P10: the parser's complaint inside schematized data; empty text when there is none."""
    return F.coalesce(F.try_variant_get(doc, "$.schematizedData.error", "string"), F.lit(""))
