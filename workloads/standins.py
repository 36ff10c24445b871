"""Market tables derived from the shared tables, in Spark and in SQL.

orders and lineitem stand for auctions, benchmark periods and the calendar;
events stand for trades. The SQL texts define the same tables as common table
expressions for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from finlake.functions.numbers import AT_REST


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(rows: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles: the same in every engine."""
    columns = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def moment(expression: str) -> str:
    """SQL text of a timestamp, as :func:`flat` writes it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed auction results: one auction per order."""
    lots = F.col("l_quantity").cast("bigint")
    second = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")
    returned = F.col("l_returnflag") == "R"
    lines = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.when(F.col("l_tax") > 0, lots).otherwise(0)).alias("qtd_oferta"),
            F.sum(F.when(F.col("l_linestatus") == "F", lots).otherwise(0)).alias(
                "qtd_oferta_segunda_volta"
            ),
            F.sum(F.when(~returned, lots)).alias("qtd_aceita"),
            F.sum(F.when(second, lots)).alias("qtd_aceita_segunda_volta"),
            F.sum(F.when(returned, lots).otherwise(0)).alias("qtd_bcb"),
            F.min("l_discount").alias("low_discount"),
            F.max("l_discount").alias("high_discount"),
            F.max("l_tax").alias("high_tax"),
            F.max(money("l_extendedprice")).alias("pu_medio"),
            F.min(money("l_extendedprice")).alias("pu_minimo"),
            F.sum(money("l_extendedprice")).alias("financeiro_aceito"),
            F.sum(F.when(second, money("l_extendedprice"))).alias("financeiro_aceito_segunda_volta"),
            F.sum(F.when(returned, money("l_extendedprice"))).alias("financeiro_bcb"),
        )
    )
    day = F.to_date("o_orderdate")
    tax = F.col("high_tax").cast("decimal(9,4)")
    joined = read(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        F.col("o_orderkey").alias("num_edital"),
        F.col("o_orderpriority").alias("titulo"),
        F.col("o_orderstatus").alias("benchmark"),
        auction_type().alias("tipo_leilao"),
        maturity().alias("data_vencimento"),
        day.alias("data_leilao"),
        F.date_add(day, 1).alias("data_liquidacao"),
        F.when(F.col("o_custkey") % 2 == 0, F.date_add(day, 2)).alias("data_liquidacao_segunda_volta"),
        "qtd_oferta",
        "qtd_oferta_segunda_volta",
        "qtd_aceita",
        "qtd_aceita_segunda_volta",
        "qtd_bcb",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("low_discount").cast("decimal(9,4)") + tax)
        .cast(AT_REST)
        .alias("pct_taxa_media"),
        (F.col("high_discount").cast("decimal(9,4)") + tax).cast(AT_REST).alias("pct_taxa_maxima"),
        *(
            F.col(name).cast(AT_REST).alias(name)
            for name in (
                "pu_medio",
                "pu_minimo",
                "financeiro_aceito",
                "financeiro_aceito_segunda_volta",
                "financeiro_bcb",
            )
        ),
    )


def auction_type() -> Column:
    return F.when(F.col("o_custkey") % 4 == 0, "Troca").otherwise("Venda")


def maturity() -> Column:
    return F.make_date(F.year("o_orderdate") + 3, F.lit(1), F.lit(1))


AUCTIONS_SQL = """
lots AS (
    SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS lots, l_tax, l_discount, l_linestatus, l_returnflag,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           l_linestatus = 'F' AND l_returnflag = 'A' AS second_round
    FROM lineitem
),
lot_sums AS (
    SELECT l_orderkey,
           CAST(sum(CASE WHEN l_tax > 0 THEN lots ELSE 0 END) AS BIGINT) AS qtd_oferta,
           CAST(sum(CASE WHEN l_linestatus = 'F' THEN lots ELSE 0 END) AS BIGINT) AS qtd_oferta_segunda_volta,
           CAST(sum(lots) FILTER (l_returnflag <> 'R') AS BIGINT) AS qtd_aceita,
           CAST(sum(lots) FILTER (second_round) AS BIGINT) AS qtd_aceita_segunda_volta,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN lots ELSE 0 END) AS BIGINT) AS qtd_bcb,
           min(l_discount) AS low_discount, max(l_discount) AS high_discount, max(l_tax) AS high_tax,
           max(price) AS pu_medio, min(price) AS pu_minimo,
           sum(price) AS financeiro_aceito,
           sum(price) FILTER (second_round) AS financeiro_aceito_segunda_volta,
           sum(price) FILTER (l_returnflag = 'R') AS financeiro_bcb
    FROM lots GROUP BY l_orderkey
),
res AS (
    SELECT o_orderkey AS num_edital, o_orderpriority AS titulo, o_orderstatus AS benchmark,
           CASE WHEN o_custkey % 4 = 0 THEN 'Troca' ELSE 'Venda' END AS tipo_leilao,
           make_date(year(o_orderdate) + 3, 1, 1) AS data_vencimento,
           CAST(o_orderdate AS DATE) AS data_leilao,
           CAST(o_orderdate AS DATE) + 1 AS data_liquidacao,
           CASE WHEN o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 2 END AS data_liquidacao_segunda_volta,
           qtd_oferta, qtd_oferta_segunda_volta, qtd_aceita, qtd_aceita_segunda_volta, qtd_bcb,
           CASE WHEN o_orderkey % 11 <> 0
                THEN CAST(low_discount AS DECIMAL(9,4)) + CAST(high_tax AS DECIMAL(9,4)) END AS pct_taxa_media,
           CAST(high_discount AS DECIMAL(9,4)) + CAST(high_tax AS DECIMAL(9,4)) AS pct_taxa_maxima,
           pu_medio, pu_minimo, financeiro_aceito, financeiro_aceito_segunda_volta, financeiro_bcb
    FROM orders JOIN lot_sums ON l_orderkey = o_orderkey
)"""


def period_title() -> Column:
    """Bond kind of an order's period; one kind is named unlike its auctions."""
    return F.when(F.col("o_orderpriority") == "5-LOW", "5-NONE").otherwise(F.col("o_orderpriority"))


def entry_type() -> Column:
    """Auction type of an order's calendar entry; dear orders' entries fit no auction."""
    return F.when(F.col("o_totalprice") >= 150000, "Adiada").otherwise(auction_type())


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark periods, of three lengths; one bond kind has none under its own name."""
    start = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    days = (
        F.when(F.col("o_orderstatus") == "F", 60)
        .when(F.col("o_orderstatus") == "O", 120)
        .otherwise(200)
    )
    return (
        read(spark, sf_dir, "orders")
        .select(
            F.col("o_orderstatus").alias("benchmark"),
            period_title().alias("titulo"),
            maturity().alias("data_vencimento"),
            start.alias("data_inicio"),
            F.date_add(start, days).alias("data_termino"),
        )
        .distinct()
    )


PERIODS_SQL = """
bench AS (
    SELECT DISTINCT o_orderstatus AS benchmark,
           CASE WHEN o_orderpriority = '5-LOW' THEN '5-NONE' ELSE o_orderpriority END AS titulo,
           make_date(year(o_orderdate) + 3, 1, 1) AS data_vencimento,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS data_inicio,
           CAST(date_trunc('quarter', o_orderdate) AS DATE)
               + CASE o_orderstatus WHEN 'F' THEN 60 WHEN 'O' THEN 120 ELSE 200 END AS data_termino
    FROM orders
)"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar entries, several benchmarks per slot; those of dear orders fit no auction of theirs."""
    return (
        read(spark, sf_dir, "orders")
        .select(
            F.col("o_orderstatus").alias("benchmark"),
            F.col("o_orderpriority").alias("titulo"),
            maturity().alias("data_vencimento"),
            F.to_date("o_orderdate").alias("data_leilao"),
            entry_type().alias("tipo_leilao"),
        )
        .distinct()
    )


CALENDAR_SQL = """
cal AS (
    SELECT DISTINCT o_orderstatus AS benchmark, o_orderpriority AS titulo,
           make_date(year(o_orderdate) + 3, 1, 1) AS data_vencimento,
           CAST(o_orderdate AS DATE) AS data_leilao,
           CASE WHEN o_totalprice >= 150000 THEN 'Adiada'
                WHEN o_custkey % 4 = 0 THEN 'Troca' ELSE 'Venda' END AS tipo_leilao
    FROM orders
)"""


def raw_rows(
    records: DataFrame, members: dict[str, Column], ingested: Column, *kept: Column
) -> DataFrame:
    """Records as raw rows: members become the JSON payload, nulls are left out."""
    payload = F.to_json(F.struct(*(value.alias(name) for name, value in members.items())))
    return records.select(
        payload.alias("payload"),
        *kept,
        F.lit("landing/part-0.jsonl").alias("_source_file"),
        ingested.alias("_ingested_at"),
        F.to_date(ingested).alias("_load_date"),
    )


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade payloads; every third trade arrives again a day later, corrected."""
    events = read(spark, sf_dir, "events").withColumn(
        "millis", F.unix_millis(F.col("ts").cast("timestamp"))
    )
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = events.select("*", F.explode(copies).alias("again"))
    members = {
        "e": F.lit("trade"),
        "E": F.col("millis") + F.col("again") * 5000,
        "s": F.concat(F.upper("event_type"), F.lit("BRL")),
        "t": F.col("event_id"),
        "p": (F.col("value").cast("decimal(18,2)") + F.col("again")).cast("string"),
        "q": (F.get_json_object("props", "$.k").cast("decimal(9,0)") / 1000).cast("decimal(18,8)"),
        "T": F.col("millis") - 5,
        "m": F.col("user_id") % 2 == 0,
    }
    ingested = F.timestamp_seconds(
        F.unix_date(F.to_date("ts")) * 86400 + (F.col("again") + 1) * 86400 + 7200
    )
    return raw_rows(sent, members, ingested)


TRADES_SQL = f"""
sent AS (
    SELECT *, 0 AS again FROM events UNION ALL SELECT *, 1 FROM events WHERE event_id % 3 = 0
),
trade_rows AS (
    SELECT event_id AS trade_id, 'trade' AS event_type,
           epoch_us(ts) // 1000 + again * 5000 AS event_millis,
           upper(event_type) || 'BRL' AS symbol,
           CAST(CAST(value AS DECIMAL(18,2)) + again AS DOUBLE) AS price,
           CAST(CAST(regexp_extract(props, '[0-9]+') AS DECIMAL(18,3)) / 1000 AS DOUBLE) AS quantity,
           epoch_us(ts) // 1000 - 5 AS trade_millis,
           user_id % 2 = 0 AS is_buyer_maker,
           CAST(ts AS DATE) + 1 + again AS load_date
    FROM sent
),
trades AS (
    SELECT trade_id, event_type, {moment('make_timestamp(event_millis * 1000)')} AS event_time, symbol, price,
           quantity, {moment('make_timestamp(trade_millis * 1000)')} AS trade_time, is_buyer_maker, load_date
    FROM trade_rows
    QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY event_millis DESC) = 1
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(part.strip("\n") for part in parts)
