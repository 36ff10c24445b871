"""Response pages and stream messages around the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finlake.functions import payload as P

DEFAULT_SYMBOL = "unknown"


def _elements(page: Column | str, key: str) -> Column:
    """Record texts of the array at ``key``, digits of numbers kept."""
    return F.transform(
        F.try_variant_get(P.parse(page), f"$.{key}", "array<variant>"), lambda item: F.to_json(item)
    )


def value_records(
    pages: DataFrame, page: str = "page", out: str = "payload", fail_fast: bool = True
) -> DataFrame:
    """Records of ``{"value": [...]}`` pages; an empty page gives no rows.

    A page that is no JSON raises, or, with ``fail_fast=False``, is left out; list those
    with :func:`unreadable_pages`.
    """
    records = _elements(page, "value")
    if fail_fast:
        message = F.concat(F.lit("unreadable page: "), F.left(F.col(page), F.lit(200)))
        records = F.when(_unreadable(page), F.raise_error(message).cast("array<string>")).otherwise(records)
    return pages.select(
        *(name for name in pages.columns if name != page),
        F.explode(records).alias(out),
    )


def _unreadable(page: str) -> Column:
    return F.col(page).isNotNull() & P.parse(page).isNull()


def unreadable_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """Pages that are no JSON, or repeat a member name."""
    return pages.where(_unreadable(page))


def status_records(
    pages: DataFrame, page: str = "page", out: str = "payload", fail_fast: bool = True
) -> DataFrame:
    """Records of ``{"status": "ok", "registros": [...]}`` responses.

    Another status raises, or, with ``fail_fast=False``, leaves the page out; list
    those with :func:`rejected_pages`.
    """
    kept = [name for name in pages.columns if name != page]
    status = P.scalar(P.parse(page), "$.status")
    good = status.eqNullSafe(F.lit("ok"))
    records = _elements(page, "registros")
    if fail_fast:
        message = F.concat(F.lit("unexpected response status: "), F.coalesce(status, F.lit("none")))
        records = F.when(good, records).otherwise(F.raise_error(message).cast("array<string>"))
    else:
        pages = pages.where(good)
    return pages.select(*kept, F.explode(records).alias(out))


def rejected_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """Responses whose status is not ``ok``, with that status."""
    status = P.scalar(P.parse(page), "$.status")
    return pages.withColumn("status", status).where(~status.eqNullSafe(F.lit("ok")))


def unwrap_messages(messages: DataFrame, message: str = "message") -> DataFrame:
    """Trade text and lower-case symbol of stream messages.

    The trade is the ``data`` member, or the whole message without one. Text that
    is no JSON object, or whose symbol is no text, has no trade: it is left out
    here and kept by :func:`unreadable_messages`.
    """
    kept = [name for name in messages.columns if name != message]
    symbol = F.lower(F.coalesce(P.scalar("trade", "$.s"), F.lit(DEFAULT_SYMBOL)))
    return (
        messages.select(*kept, _trade(message).alias("trade"))
        .where(_readable(F.col("trade")))
        .select(*kept, symbol.alias("symbol"), F.to_json("trade").alias("payload"))
    )


def unreadable_messages(messages: DataFrame, message: str = "message") -> DataFrame:
    """Messages :func:`unwrap_messages` leaves out."""
    return messages.where(~_readable(_trade(message)))


def sorted_messages(messages: DataFrame, message: str = "message") -> DataFrame:
    """Every message with its ``symbol`` and ``payload``, or with the ``reason`` it has none.

    One pass for both sides of :func:`unwrap_messages`; ``message`` stays.
    """
    trade, symbol = F.col("__trade"), F.lower(F.coalesce(P.scalar("__trade", "$.s"), F.lit(DEFAULT_SYMBOL)))
    is_object = F.coalesce(F.schema_of_variant(trade).startswith("OBJECT"), F.lit(False))
    parsed = messages.withColumn("__trade", _trade(message))
    return parsed.select(
        *messages.columns,
        F.when(_readable(trade), symbol).alias("symbol"),
        F.when(_readable(trade), F.to_json(trade)).alias("payload"),
        F.when(~is_object, F.lit("no JSON object"))
        .when(~_readable(trade), F.lit("symbol is no text"))
        .alias("reason"),
    )


def _trade(message: str) -> Column:
    whole = P.parse(message)
    return F.coalesce(F.try_variant_get(whole, "$.data", "variant"), whole)


def _readable(trade: Column) -> Column:
    symbol = F.try_variant_get(trade, "$.s", "variant")
    named = symbol.isNull() | (F.schema_of_variant(symbol) == "STRING")
    return F.coalesce(F.schema_of_variant(trade).startswith("OBJECT") & named, F.lit(False))
