"""Small text and byte functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def folder_glob(path: Column) -> Column:
    """a folder path without trailing slashes, as a glob for the files in it."""
    return F.concat(F.regexp_replace(path, "/+$", ""), F.lit("/*"))


def base64_text(payload: Column) -> Column:
    """UTF-8 bytes of the payload in base64, on one line."""
    return F.translate(F.base64(F.encode(payload, "UTF-8")), "\r\n", "")


def utf8_text(payload: Column) -> Column:
    """bytes to text. Bytes that are no UTF-8 become the replacement character."""
    return F.make_valid_utf8(payload.cast("string"))
