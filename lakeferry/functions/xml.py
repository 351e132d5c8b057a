"""Expressions over XML text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path of the signed text in an XML signature; prefixes differ, so elements go by local name.
SIGNED_TEXT_PATH = (
    "/*[local-name()='Signature']/*[local-name()='Object']"
    "/*[local-name()='bankIdSignedData']/*[local-name()='usrVisibleData']/text()"
)


def base64_text(column: Column) -> Column:
    """UTF-8 text of base64; null when it is not valid base64."""
    return F.decode(F.try_to_binary(column, F.lit("base64")), "UTF-8")


def first_node_text(xml: Column, path: str) -> Column:
    """Text of the first matching node; null (not empty text) when there is none."""
    return F.get(F.xpath(xml, F.lit(path)), F.lit(0))


def signed_text(signature: Column, path: str = SIGNED_TEXT_PATH) -> Column:
    """Text that was signed: base64 -> XML -> node -> base64 -> text."""
    return base64_text(first_node_text(base64_text(signature), path))


def fault_text(body: Column) -> Column:
    """Reason of a fault response; null for a normal response."""
    text = first_node_text(body, "//*[local-name()='Fault']//*[local-name()='Text']/text()")
    # only a body that has the word at all is parsed
    fault = body.contains("Fault") & F.xpath_boolean(body, F.lit("//*[local-name()='Fault']"))
    return F.when(fault, F.coalesce(text, F.lit("unknown fault")))
