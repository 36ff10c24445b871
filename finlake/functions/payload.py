"""Access to JSON payload text through the variant type.

A variant keeps every digit of a JSON number and its paths are case-sensitive,
so ``$.t`` and ``$.T`` stay apart. ``get_json_object`` would push decimals
through a double.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse(payload: Column | str) -> Column:
    """Payload text as a variant; malformed text gives null."""
    return F.try_parse_json(payload)


def scalar(doc: Column | str, path: str) -> Column:
    """Text of the scalar at ``path``; null when absent, null or not a scalar."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return unless_nested(text_at(doc, path), doc, path)


def text_at(doc: Column | str, path: str) -> Column:
    """Text at ``path``; an object or array gives its JSON text."""
    return F.try_variant_get(doc, path, "string")


def texts(doc: Column | str, members: list[str]) -> Column:
    """Struct of the texts of members of an object, ``c0``, ``c1`` and so on in their order, by one lookup.

    Fields go by place: members such as ``t`` and ``T`` have names that differ by case only.
    """
    doc = F.col(doc) if isinstance(doc, str) else doc
    kind = ",".join(f"`{name}`:string" for name in members)
    places = ",".join(f"c{k}:string" for k in range(len(members)))
    return F.try_variant_get(doc, "$", f"struct<{kind}>").cast(f"struct<{places}>")


def unless_nested(text: Column, doc: Column | str, path: str) -> Column:
    """Null in place of the text of an object or array.

    ``text`` is used several times: for many paths select it as a column first. The
    type is looked up only for text that could be an object or an array; that is a
    branch of its own because both sides of an AND may be evaluated up front.
    """
    shape = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    scalar_only = F.when(~shape.rlike("^(OBJECT|ARRAY)"), text)
    return F.when(text.startswith("{") | text.startswith("["), scalar_only).otherwise(text)


def strip(line: Column | str) -> Column:
    """Remove blanks, tabs and line ends on both sides."""
    return F.regexp_replace(line, r"^\s+|\s+$", "")
