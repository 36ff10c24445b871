"""Payload typing, filters, dedup: the trusted models on payloads made of shared tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from finlake.functions import dates, payload as P
from finlake.operators.latest import latest
from finlake.plans import models
from finlake.plans.spec import Field, TrustedSpec, build, select_window, type_payloads
from finlake.sources import raw
from workloads import standins as S

RUN_AT = datetime(2024, 6, 1)


def _typed(rows: DataFrame, spec: TrustedSpec) -> DataFrame:
    return S.flat(build(rows, spec, RUN_AT).drop("_insert_date"))


def _sequence_time(number: Column) -> Column:
    """A distinct ingest time per record number."""
    return F.timestamp_seconds(F.lit(1704067200) + number)


def _text_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


# -- trades -----------------------------------------------------------------------------


def trades_trusted(spark, sf_dir):
    return _typed(S.raw_trades(spark, sf_dir), models.TRADES)


TRADES = f"{S.with_ctes(S.TRADES_SQL)} SELECT * EXCLUDE (load_date) FROM trades"


# -- central bank -------------------------------------------------------------------------


def interest_rates(spark, sf_dir):
    orders = S.read(spark, sf_dir, "orders")
    group = F.col("o_custkey") % 200
    members = {
        "anoMes": F.when(F.col("o_totalprice") >= 30000, F.date_format("o_orderdate", "yyyy-MM")),
        "Modalidade": F.col("o_orderpriority"),
        "cnpj8": F.lpad(group.cast("string"), 8, "0"),
        "InstituicaoFinanceira": F.concat(F.lit("Instituição "), group),
        "Posicao": F.col("o_orderkey") % 50,
        "TaxaJurosAoMes": (S.money("o_totalprice") / 100000).cast("decimal(18,6)"),
        "TaxaJurosAoAno": (S.money("o_totalprice") / 8000).cast("decimal(18,6)").cast("string"),
    }
    rows = S.raw_rows(orders, members, _sequence_time(F.col("o_orderkey")))
    return _typed(rows, models.INTEREST_RATES)


INTEREST_RATES = """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS data_referencia,
       o_orderpriority AS modalidade,
       lpad(CAST(o_custkey % 200 AS VARCHAR), 8, '0') AS cnpj8,
       'Instituição ' || (o_custkey % 200) AS instituicao_financeira,
       o_orderkey % 50 AS posicao,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.00001 AS DECIMAL(6,5)), 6) AS DOUBLE)
           AS pct_taxa_juros_mes,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.000125 AS DECIMAL(7,6)), 6) AS DOUBLE)
           AS pct_taxa_juros_ano
FROM orders WHERE o_totalprice >= 30000
QUALIFY row_number() OVER (
    PARTITION BY date_trunc('month', o_orderdate), o_orderpriority, o_custkey % 200
    ORDER BY o_orderkey DESC) = 1
"""


def institutions(spark, sf_dir):
    customers = S.read(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    members = {
        "CodInst": F.lpad((F.col("c_custkey") / 3).cast("bigint").cast("string"), 8, "0"),
        "Data": F.when(nation % 2 == 0, "202403").otherwise("202406"),
        "NomeInstituicao": F.col("c_name"),
        "DataInicioAtividade": F.concat((nation + 1980).cast("string"), F.lit("07")),
        "Tcb": F.concat(F.lit("B"), nation % 4),
        "Td": F.when(F.col("c_custkey") % 2 == 0, "I").otherwise("C"),
        "Tc": nation % 3,
        "SegmentoTb": F.col("c_mktsegment"),
        "Uf": F.when(nation % 5 != 0, F.concat(F.lit("U"), nation)),
        "Municipio": F.concat(F.lit("São "), nation),
        "Sr": F.when(nation % 6 != 0, F.concat(F.lit("S"), nation % 6)),
        "CodConglomeradoFinanceiro": F.concat(F.lit("F"), F.col("c_custkey") % 10),
        "CodConglomeradoPrudencial": F.concat(F.lit("P"), F.col("c_custkey") % 7),
        "CnpjInstituicaoLider": F.lpad((F.col("c_custkey") % 97).cast("string"), 8, "0"),
        "Situacao": F.when(F.col("c_acctbal") < 0, "I").otherwise("A"),
    }
    rows = S.raw_rows(customers, members, _sequence_time(F.col("c_custkey")))
    return _typed(rows, models.INSTITUTIONS)


INSTITUTIONS = """
SELECT lpad(CAST(c_custkey // 3 AS VARCHAR), 8, '0') AS cod_inst,
       CASE WHEN c_nationkey % 2 = 0 THEN '2024-03-01' ELSE '2024-06-01' END AS data_referencia,
       c_name AS nome_instituicao,
       (c_nationkey + 1980) || '-07-01' AS data_inicio_atividade,
       'B' || (c_nationkey % 4) AS tcb,
       CASE WHEN c_custkey % 2 = 0 THEN 'I' ELSE 'C' END AS td,
       CAST(c_nationkey % 3 AS BIGINT) AS tc,
       c_mktsegment AS segmento,
       CASE WHEN c_nationkey % 5 <> 0 THEN 'U' || c_nationkey END AS uf,
       'São ' || c_nationkey AS municipio,
       CASE WHEN c_nationkey % 6 <> 0 THEN 'S' || (c_nationkey % 6) END AS sr,
       'F' || (c_custkey % 10) AS cod_conglomerado_financeiro,
       'P' || (c_custkey % 7) AS cod_conglomerado_prudencial,
       lpad(CAST(c_custkey % 97 AS VARCHAR), 8, '0') AS cnpj_instituicao_lider,
       CASE WHEN c_acctbal < 0 THEN 'I' ELSE 'A' END AS situacao
FROM customer
QUALIFY row_number() OVER (
    PARTITION BY c_custkey // 3, c_nationkey % 2, c_custkey % 2 ORDER BY c_custkey DESC) = 1
"""


def reports(spark, sf_dir):
    parts = S.read(spark, sf_dir, "part")
    number = F.col("p_partkey") % 300
    members = {
        # A number sent as text now and then, with a leading zero.
        "NumeroRelatorio": F.when(F.col("p_partkey") % 2 == 0, number.cast("string")).otherwise(
            F.concat(F.lit("0"), number)
        ),
        "NomeRelatorio": F.concat_ws(" ", "p_brand", "p_name"),
    }
    rows = S.raw_rows(parts, members, _sequence_time(F.col("p_partkey")))
    return _typed(rows, models.REPORTS)


REPORTS = """
SELECT p_partkey % 300 AS num_relatorio, p_brand || ' ' || p_name AS nome_relatorio
FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey % 300 ORDER BY p_partkey DESC) = 1
"""


def payments(spark, sf_dir):
    orders = S.read(spark, sf_dir, "orders")
    members = {"AnoMes": F.date_format("o_orderdate", "yyyyMM")}
    for i, means in enumerate(("Pix", "TED", "Boleto", "Cheque", "DOC", "TEC"), start=1):
        members[f"quantidade{means}"] = F.col("o_custkey") * i
        amount = S.money("o_totalprice") * i
        members[f"valor{means}"] = amount if i % 2 else amount.cast("string")
    rows = S.raw_rows(orders, members, _sequence_time(F.col("o_orderkey")))
    return _typed(rows, models.PAYMENTS)


PAYMENTS = f"""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS data_referencia,
       {', '.join(
           f'o_custkey * {i} AS qtd_{m}, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * {i} AS DOUBLE) AS val_{m}'
           for i, m in enumerate(('pix', 'ted', 'boleto', 'cheque', 'doc', 'tec'), start=1))}
FROM orders
QUALIFY row_number() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderkey DESC) = 1
"""


def expectations(spark, sf_dir):
    events = S.read(spark, sf_dir, "events")
    value = F.col("value").cast("decimal(18,2)")
    members = {
        "Data": _text_day(F.col("ts")),
        "Indicador": F.col("event_type"),
        "DataReferencia": (F.col("user_id") % 5 + 2024).cast("string"),
        "Media": value,
        "Mediana": (value + 1).cast("string"),
        "DesvioPadrao": F.when(F.col("user_id") % 7 != 0, value * 2),
        "Minimo": value - 10,
        "Maximo": value + 10,
        "numeroRespondentes": F.col("user_id"),
    }
    rows = S.raw_rows(events, members, F.col("ts").cast("timestamp"))
    return _typed(rows, models.EXPECTATIONS)


EXPECTATIONS = """
WITH surveys AS (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events)
SELECT strftime(ts, '%Y-%m-%d') AS data_coleta, event_type AS indicador, user_id % 5 + 2024 AS data_referencia,
       CAST(v AS DOUBLE) AS media, CAST(v + 1 AS DOUBLE) AS mediana,
       CASE WHEN user_id % 7 <> 0 THEN CAST(v * 2 AS DOUBLE) END AS desvio_padrao,
       CAST(v - 10 AS DOUBLE) AS minimo, CAST(v + 10 AS DOUBLE) AS maximo, user_id AS num_respondentes
FROM surveys
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type, user_id % 5 ORDER BY ts DESC) = 1
"""


# -- auctions -----------------------------------------------------------------------------


def _endpoint_rows(records: DataFrame, endpoint: str, members: dict[str, Column], ingested: Column):
    return S.raw_rows(records, members, ingested, F.lit(endpoint).alias(raw.ENDPOINT))


def _slash(day: str) -> Column:
    """Both spellings of a slash date, by auction number."""
    return F.when(F.col("num_edital") % 2 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(
        F.date_format(day, "d/M/yyyy")
    )


def raw_results(spark, sf_dir) -> DataFrame:
    """Result payloads; each arrives twice, the first time with other amounts."""
    rows = S.auctions(spark, sf_dir).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("last"))
    members = {
        "numero_edital": F.col("num_edital"),
        "titulo": F.col("titulo"),
        "benchmark": F.col("benchmark"),
        "tipo_leilao": F.col("tipo_leilao"),
        "vencimento": _slash("data_vencimento"),
        "data_leilao": _slash("data_leilao"),
        "liquidacao": _slash("data_liquidacao"),
        "liquidacao_segunda_volta": _slash("data_liquidacao_segunda_volta"),
        "oferta": F.col("qtd_oferta"),
        "oferta_segunda_volta": F.col("qtd_oferta_segunda_volta"),
        "quantidade_aceita": F.col("qtd_aceita"),
        "quantidade_aceita_segunda_volta": F.col("qtd_aceita_segunda_volta"),
        "quantidade_bcb": F.col("qtd_bcb"),
        "taxa_media": F.col("pct_taxa_media"),
        "taxa_maxima": F.col("pct_taxa_maxima"),
        "pu_medio": F.col("pu_medio"),
        "pu_minimo": F.col("pu_minimo"),
        "financeiro_aceito": (F.col("financeiro_aceito") + (1 - F.col("last"))).cast("decimal(28,2)"),
        "financeiro_aceito_segunda_volta": F.col("financeiro_aceito_segunda_volta"),
        "financeiro_bcb": F.col("financeiro_bcb").cast("decimal(28,2)").cast("string"),
    }
    ingested = _sequence_time(F.col("last") * 3600)
    return _endpoint_rows(rows, "resultados", members, ingested)


def _orders_with_parts(spark, sf_dir) -> DataFrame:
    return S.read(spark, sf_dir, "orders").select(
        "*",
        S.maturity().alias("due"),
        S.period_title().alias("period_title"),
        S.entry_type().alias("kind"),
        F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("start"),
        F.when(F.col("o_orderstatus") == "F", 60)
        .when(F.col("o_orderstatus") == "O", 120)
        .otherwise(200)
        .alias("days"),
    )


def raw_benchmarks(spark, sf_dir) -> DataFrame:
    """One payload per order: a period is repeated by all orders of its quarter."""
    orders = _orders_with_parts(spark, sf_dir)
    members = {
        "BENCHMARK": F.col("o_orderstatus"),
        "TÍTULO": F.col("period_title"),
        "VENCIMENTO": _text_day(F.col("due")),
        "INÍCIO": _text_day(F.col("start")),
        "TERMINO": _text_day(F.expr("date_add(start, days)")),
    }
    return _endpoint_rows(orders, "benchmarks", members, _sequence_time(F.col("o_orderkey")))


def raw_calendar(spark, sf_dir) -> DataFrame:
    orders = _orders_with_parts(spark, sf_dir)
    members = {
        "BENCHMARK": F.col("o_orderstatus"),
        "TITULO": F.col("o_orderpriority"),
        "VENCIMENTO": _text_day(F.col("due")),
        "DATA_LEILAO": _text_day(F.col("o_orderdate")),
        "TIPO_LEILAO": F.col("kind"),
    }
    return _endpoint_rows(orders, "calendario", members, _sequence_time(F.col("o_orderkey")))


def raw_announcements(spark, sf_dir) -> DataFrame:
    pages = S.read(spark, sf_dir, "pages").select(
        "page_id", "url", F.explode(F.array(F.lit(0), F.lit(1))).alias("again")
    )
    members = {
        "LINK": F.col("url"),
        "TITULO": F.concat_ws(" ", F.lit("Comunicado"), F.col("page_id") + F.col("again")),
    }
    return _endpoint_rows(
        pages, "comunicados", members, _sequence_time(F.col("page_id") * 2 + F.col("again"))
    )


def raw_dealers(spark, sf_dir) -> DataFrame:
    halves = F.array(
        F.struct(F.lit(date(2023, 2, 10)).alias("start"), F.lit(date(2023, 8, 9)).alias("end")),
        F.struct(F.lit(date(2023, 8, 10)).alias("start"), F.lit(date(2024, 2, 9)).alias("end")),
    )
    suppliers = S.read(spark, sf_dir, "supplier").select("*", F.inline(halves))
    members = {
        "DEALER": F.when(F.col("s_nationkey") % 9 != 0, F.col("s_name")),
        "CNPJ": F.lpad((F.col("s_suppkey") % 50).cast("string"), 14, "0"),
        "INICIO_PERIODO": _text_day(F.col("start")),
        "FIM_PERIODO": _text_day(F.col("end")),
    }
    return _endpoint_rows(suppliers, "dealers", members, _sequence_time(F.col("s_suppkey")))


def raw_auctions(spark, sf_dir) -> DataFrame:
    """The multiplexed raw table of all auction endpoints that have a model."""
    frames = [raw_results, raw_benchmarks, raw_calendar, raw_announcements, raw_dealers]
    first, *others = (make(spark, sf_dir) for make in frames)
    for other in others:
        first = first.unionByName(other)
    return first


def auction_results(spark, sf_dir):
    return _typed(raw_results(spark, sf_dir), models.RESULTS)


_DAYS = ("data_vencimento", "data_leilao", "data_liquidacao", "data_liquidacao_segunda_volta")
_AMOUNTS = (
    "pct_taxa_media",
    "pct_taxa_maxima",
    "pu_medio",
    "pu_minimo",
    "financeiro_aceito",
    "financeiro_aceito_segunda_volta",
    "financeiro_bcb",
)

AUCTION_RESULTS = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _DAYS)},
                  {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _AMOUNTS)})
FROM res
"""


def benchmarks(spark, sf_dir):
    return _typed(raw_benchmarks(spark, sf_dir), models.BENCHMARKS)


BENCHMARKS = f"""
{S.with_ctes(S.PERIODS_SQL)}
SELECT benchmark, titulo, CAST(data_vencimento AS VARCHAR) AS data_vencimento,
       CAST(data_inicio AS VARCHAR) AS data_inicio, CAST(data_termino AS VARCHAR) AS data_termino
FROM bench
"""


def calendar(spark, sf_dir):
    return _typed(raw_calendar(spark, sf_dir), models.CALENDAR)


CALENDAR = f"""
{S.with_ctes(S.CALENDAR_SQL)}
SELECT * REPLACE (CAST(data_vencimento AS VARCHAR) AS data_vencimento, CAST(data_leilao AS VARCHAR) AS data_leilao)
FROM cal
"""


def announcements(spark, sf_dir):
    return _typed(raw_announcements(spark, sf_dir), models.ANNOUNCEMENTS)


ANNOUNCEMENTS = """
SELECT url AS link, 'Comunicado ' || (max(page_id) + 1) AS titulo FROM pages GROUP BY url
"""


def dealers(spark, sf_dir):
    return _typed(raw_dealers(spark, sf_dir), models.DEALERS)


DEALERS = """
SELECT DISTINCT CASE WHEN s_nationkey % 9 <> 0 THEN s_name END AS dealer,
       lpad(CAST(s_suppkey % 50 AS VARCHAR), 14, '0') AS cnpj, data_inicio_periodo, data_fim_periodo
FROM supplier, (VALUES ('2023-02-10', '2023-08-09'), ('2023-08-10', '2024-02-09'))
    AS half(data_inicio_periodo, data_fim_periodo)
"""


# -- operators of the typing and loading step --------------------------------------------


def dedup_latest(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    newest = [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey"), F.desc("l_extendedprice")]
    return S.flat(latest(S.read(spark, sf_dir, "lineitem"), keys, newest))


DEDUP_LATEST = f"""
SELECT * REPLACE ({S.moment('l_shipdate')} AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber)
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
"""


def json_paths(spark, sf_dir):
    """Scalars, nested values, case-distinct and accented names, long numbers."""
    events = S.read(spark, sf_dir, "events")
    number = F.concat(F.lit("9007199254740"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))
    doc = F.concat(
        F.lit('{"t":'), "event_id", F.lit(',"T":'), "user_id", F.lit(',"TÍTULO":"'), "event_type",
        F.lit('","n":'), number, F.lit('.123456789,"o":'), "props", F.lit(',"a":[1,2],"z":null,"s":"[x]"}'),
    )
    parsed = events.select(P.parse(doc).alias("doc"), P.parse("props").alias("props"))
    return parsed.select(
        P.scalar("doc", "$.t").cast("bigint").alias("event_id"),
        P.scalar("doc", "$.T").cast("bigint").alias("user_id"),
        P.scalar("doc", "$.TÍTULO").alias("event_type"),
        P.scalar("doc", "$.n").alias("long_number"),
        P.scalar("doc", "$.o.k").cast("bigint").alias("nested_k"),
        P.scalar("doc", "$.o").isNull().alias("object_is_null"),
        P.scalar("doc", "$.a").isNull().alias("array_is_null"),
        P.scalar("doc", "$.z").isNull().alias("json_null_is_null"),
        P.scalar("doc", "$.s").alias("bracket_text"),
        P.scalar("doc", "$.absent").isNull().alias("absent_is_null"),
        P.scalar("props", "$.k").cast("bigint").alias("k"),
    )


JSON_PATHS = """
SELECT event_id, user_id, event_type,
       '9007199254740' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '.123456789' AS long_number,
       CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS nested_k,
       true AS object_is_null, true AS array_is_null, true AS json_null_is_null, '[x]' AS bracket_text,
       true AS absent_is_null, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
FROM events
"""

ORDERS = TrustedSpec(
    name="orders",
    source="orders",
    fields=(
        Field("order_id", "id", "integer"),
        Field("customer_id", "customer", "integer"),
        Field("status", "status"),
        Field("amount", "amount", "numeric"),
        Field("amount_as_text", "amountText", "numeric"),
        Field("tenth_digit", "tenth", "numeric"),
        Field("order_day", "day", "iso_day"),
        Field("is_final", "final", "boolean"),
        Field("ordered_at", "millis", "epoch_millis"),
    ),
    key=("order_id",),
    required=("order_id",),
)


def typed_orders(spark, sf_dir):
    orders = S.read(spark, sf_dir, "orders")
    members = {
        "id": F.col("o_orderkey").cast("string"),
        "customer": F.col("o_custkey"),
        "status": F.col("o_orderstatus"),
        "amount": S.money("o_totalprice"),
        "amountText": S.money("o_totalprice").cast("string"),
        "tenth": F.lit("0.1234567885"),
        "day": F.date_format("o_orderdate", "yyyy-M-d"),
        "final": F.col("o_orderstatus") == "F",
        "millis": F.unix_millis(F.col("o_orderdate").cast("timestamp")),
    }
    rows = S.raw_rows(orders, members, _sequence_time(F.col("o_orderkey")))
    return S.flat(type_payloads(rows, ORDERS).select(*(f.name for f in ORDERS.fields)))


TYPED_ORDERS = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS amount, o_totalprice AS amount_as_text, CAST(0.123456789 AS DOUBLE) AS tenth_digit,
       strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderstatus = 'F' AS is_final,
       {S.moment('o_orderdate')} AS ordered_at
FROM orders
"""


def parse_dates(spark, sf_dir):
    orders = S.read(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return S.flat(
        orders.select(
            "o_orderkey",
            dates.iso_day(F.date_format(day, "yyyy-MM-dd")).alias("iso"),
            dates.iso_day(F.date_format(day, "yyyy-M-d")).alias("iso_short"),
            dates.slash_day(F.date_format(day, "dd/MM/yyyy")).alias("slash"),
            dates.slash_day(F.date_format(day, "d/M/yyyy")).alias("slash_short"),
            dates.compact_month(F.date_format(day, "yyyyMM")).alias("compact"),
            dates.compact_month_start(F.date_format(day, "yyyyMM")).alias("compact_start"),
            dates.dashed_month(F.date_format(day, "yyyy-MM")).alias("dashed"),
            dates.slash_day(F.date_format(day, "yyyy-MM"), strict=False).isNull().alias("bad_is_null"),
        )
    )


PARSE_DATES = f"""
WITH days AS (
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS m FROM orders)
SELECT o_orderkey, d AS iso, d AS iso_short, d AS slash, d AS slash_short,
       m AS compact, m AS compact_start, m AS dashed, true AS bad_is_null
FROM days
"""


def _event_rows(spark, sf_dir) -> DataFrame:
    """Events as rows of a multiplexed raw table; some miss a required value."""
    events = S.read(spark, sf_dir, "events")
    members = {
        "id": F.when(F.col("value") >= 5, F.col("event_id")),
        "who": F.col("user_id"),
        "value": F.col("value").cast("decimal(18,2)"),
    }
    return S.raw_rows(
        events, members, F.col("ts").cast("timestamp"), F.col("event_type").alias(raw.ENDPOINT)
    )


def _event_spec(endpoint: str | None = None) -> TrustedSpec:
    return TrustedSpec(
        name="events",
        source="events",
        fields=(
            Field("event_id", "id", "integer"),
            Field("user_id", "who", "integer"),
            Field("value", "value", "numeric"),
        ),
        key=("event_id",),
        required=("event_id",),
        endpoint=endpoint,
    )


def required_paths(spark, sf_dir):
    typed = type_payloads(_event_rows(spark, sf_dir), _event_spec())
    return S.flat(typed.select("event_id", "user_id", "value"))


REQUIRED_PATHS = "SELECT event_id, user_id, value FROM events WHERE value >= 5"


def discriminator_route(spark, sf_dir):
    spec = _event_spec("purchase")
    rows = select_window(_event_rows(spark, sf_dir), spec, date(2024, 2, 1), incremental=False)
    return S.flat(type_payloads(rows, spec).select("event_id", "user_id", "value"))


DISCRIMINATOR_ROUTE = """
SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value >= 5
"""


def lookback_filter(spark, sf_dir):
    rows = raw.since(_event_rows(spark, sf_dir), date(2024, 1, 20))
    return S.flat(rows.groupBy("_load_date").agg(F.count(F.lit(1)).alias("n_records")))


LOOKBACK_FILTER = """
SELECT strftime(ts, '%Y-%m-%d') AS _load_date, count(*) AS n_records FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - 2 GROUP BY 1
"""


def backfill_filter(spark, sf_dir):
    rows = raw.since(_event_rows(spark, sf_dir), date(2024, 1, 20), start_date=date(2024, 1, 7))
    return S.flat(rows.groupBy("_load_date").agg(F.count(F.lit(1)).alias("n_records")))


BACKFILL_FILTER = """
SELECT strftime(ts, '%Y-%m-%d') AS _load_date, count(*) AS n_records FROM events
WHERE ts >= TIMESTAMP '2024-01-07' GROUP BY 1
"""

QUERIES = {
    "dedup_latest": (dedup_latest, DEDUP_LATEST),
    "json_paths": (json_paths, JSON_PATHS),
    "typed_orders": (typed_orders, TYPED_ORDERS),
    "parse_dates": (parse_dates, PARSE_DATES),
    "trades_trusted": (trades_trusted, TRADES),
    "trusted_taxa_juros_mensal": (interest_rates, INTEREST_RATES),
    "trusted_ifdata_cadastro": (institutions, INSTITUTIONS),
    "trusted_ifdata_lista_relatorio": (reports, REPORTS),
    "trusted_meios_pagamento_mensal": (payments, PAYMENTS),
    "trusted_expectativas_anuais": (expectations, EXPECTATIONS),
    "trusted_benchmarks": (benchmarks, BENCHMARKS),
    "trusted_calendario": (calendar, CALENDAR),
    "trusted_comunicados": (announcements, ANNOUNCEMENTS),
    "trusted_dealers": (dealers, DEALERS),
    "trusted_resultados": (auction_results, AUCTION_RESULTS),
    "required_paths": (required_paths, REQUIRED_PATHS),
    "discriminator_route": (discriminator_route, DISCRIMINATOR_ROUTE),
    "lookback_filter": (lookback_filter, LOOKBACK_FILTER),
    "backfill_filter": (backfill_filter, BACKFILL_FILTER),
}
