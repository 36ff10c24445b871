"""Auction models and their parts, on stored auctions, periods and calendar."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from finlake.functions.numbers import rounded, safe_divide
from finlake.operators import periods as period_ops, rolling, totals
from finlake.plans import models, refined
from finlake.plans.spec import build
from finlake.session import job_dir
from workloads import standins as S
from workloads.trusted import raw_auctions

# Small buckets, so that the test tables cross many bucket borders.
BUCKET_ROWS = 2_000

def stored(
    spark: SparkSession, sf_dir: str, name: str, make: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """A derived table, written for this call: the refined models read tables."""
    path = job_dir(spark, name)
    frame = make(spark, sf_dir)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _auctions(spark, sf_dir):
    return stored(spark, sf_dir, "auctions", S.auctions)


def _periods(spark, sf_dir):
    return stored(spark, sf_dir, "periods", S.periods)


def _calendar(spark, sf_dir):
    return stored(spark, sf_dir, "calendar", S.calendar)


BOND = ["titulo", "data_vencimento"]


def interval_join(spark, sf_dir):
    rows = _auctions(spark, sf_dir).select("num_edital", *BOND, "data_leilao")
    found = period_ops.interval_join(
        rows, _periods(spark, sf_dir), BOND, "data_leilao", "data_inicio", "data_termino"
    )
    return S.flat(found.select("num_edital", "titulo", "benchmark", "data_inicio", "data_termino"))


INTERVAL_JOIN = f"""
{S.with_ctes(S.AUCTIONS_SQL, S.PERIODS_SQL)}
SELECT num_edital, res.titulo, bench.benchmark,
       CAST(data_inicio AS VARCHAR) AS data_inicio, CAST(data_termino AS VARCHAR) AS data_termino
FROM res JOIN bench ON res.titulo = bench.titulo AND res.data_vencimento = bench.data_vencimento
    AND data_leilao >= data_inicio AND data_leilao <= data_termino
"""


def latest_valid_period(spark, sf_dir):
    rows = _auctions(spark, sf_dir)
    found = refined.benchmark_periods(rows, _periods(spark, sf_dir))
    return S.flat(
        rows.select("num_edital", *BOND, "data_leilao")
        .join(found, [*BOND, "data_leilao"], "left")
        .drop("data_vencimento")
    )


_PERIOD_CTE = """
in_force AS (
    SELECT num_edital, data_inicio AS data_benchmark_inicio, data_termino AS data_benchmark_termino
    FROM res JOIN bench USING (titulo, data_vencimento)
    WHERE data_leilao BETWEEN data_inicio AND data_termino
    QUALIFY row_number() OVER (PARTITION BY num_edital ORDER BY data_inicio DESC, data_termino DESC) = 1
)"""

LATEST_VALID_PERIOD = f"""
{S.with_ctes(S.AUCTIONS_SQL, S.PERIODS_SQL, _PERIOD_CTE)}
SELECT num_edital, titulo, CAST(data_leilao AS VARCHAR) AS data_leilao,
       CAST(data_benchmark_inicio AS VARCHAR) AS data_benchmark_inicio,
       CAST(data_benchmark_termino AS VARCHAR) AS data_benchmark_termino
FROM res LEFT JOIN in_force USING (num_edital)
"""


def calendar_flag(spark, sf_dir):
    rows = _auctions(spark, sf_dir).select("num_edital", *refined.SLOT)
    flagged = period_ops.with_match_flag(
        rows, _calendar(spark, sf_dir), refined.SLOT, "foi_agendado"
    )
    return flagged.select("num_edital", "foi_agendado")


_FLAG = """EXISTS (
    SELECT 1 FROM cal WHERE cal.titulo = res.titulo AND cal.data_vencimento = res.data_vencimento
        AND cal.data_leilao = res.data_leilao AND cal.tipo_leilao = res.tipo_leilao)"""

CALENDAR_FLAG = f"""
{S.with_ctes(S.AUCTIONS_SQL, S.CALENDAR_SQL)}
SELECT num_edital, {_FLAG} AS foi_agendado FROM res
"""


def calendar_matches(spark, sf_dir):
    """The join as such: one row per auction and calendar entry, or one without."""
    rows = _auctions(spark, sf_dir).select("num_edital", *refined.SLOT)
    entries = _calendar(spark, sf_dir).withColumnRenamed("benchmark", "benchmark_agenda")
    return rows.join(entries, refined.SLOT, "left").select("num_edital", "benchmark_agenda")


CALENDAR_MATCHES = f"""
{S.with_ctes(S.AUCTIONS_SQL, S.CALENDAR_SQL)}
SELECT num_edital, cal.benchmark AS benchmark_agenda
FROM res LEFT JOIN cal USING (titulo, data_vencimento, data_leilao, tipo_leilao)
"""


def safe_divide_query(spark, sf_dir):
    rows = _auctions(spark, sf_dir)
    return rows.select(
        "num_edital",
        refined.coverage().alias("pct_cobertura"),
        refined.measures()["pct_cobertura_segunda_volta"].alias("pct_cobertura_segunda_volta"),
        safe_divide("financeiro_bcb", "financeiro_aceito_segunda_volta").alias("bcb_ratio"),
    ).withColumn("bcb_ratio", rounded("bcb_ratio", 6))


_COVERAGE = "CASE WHEN qtd_oferta <> 0 THEN CAST(qtd_aceita AS DOUBLE) / qtd_oferta END"
_COVERAGE_2 = (
    "CASE WHEN qtd_oferta_segunda_volta <> 0 "
    "THEN CAST(qtd_aceita_segunda_volta AS DOUBLE) / qtd_oferta_segunda_volta END"
)

SAFE_DIVIDE = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT num_edital, {_COVERAGE} AS pct_cobertura, {_COVERAGE_2} AS pct_cobertura_segunda_volta,
       CAST(round(CAST(CAST(financeiro_bcb AS DOUBLE) / nullif(CAST(financeiro_aceito_segunda_volta AS DOUBLE), 0)
            AS DECIMAL(38,10)), 6) AS DOUBLE) AS bcb_ratio
FROM res
"""


def auction_measures(spark, sf_dir):
    derived = refined.measures()
    rows = _auctions(spark, sf_dir)
    return S.flat(rows.select("num_edital", *(v.alias(k) for k, v in derived.items())))


_MEASURES = f"""
    qtd_aceita + coalesce(qtd_aceita_segunda_volta, 0) AS qtd_aceita_total,
    CAST(pct_taxa_maxima - pct_taxa_media AS DOUBLE) AS pct_spread_taxa,
    CAST(pu_medio - pu_minimo AS DOUBLE) AS spread_pu,
    CAST(financeiro_aceito + coalesce(financeiro_aceito_segunda_volta, 0) AS DOUBLE) AS financeiro_total,
    date_diff('day', data_leilao, data_vencimento) AS dias_ate_vencimento,
    {_COVERAGE} AS pct_cobertura,
    {_COVERAGE_2} AS pct_cobertura_segunda_volta"""

AUCTION_MEASURES = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT num_edital, {_MEASURES} FROM res
"""


def _rolling(spark, sf_dir, column, out):
    rows = _auctions(spark, sf_dir).select(
        "num_edital", "titulo", "data_leilao", "pct_taxa_media", refined.coverage().alias("pct_cobertura")
    )
    cut = rolling.with_buckets(rows, ["titulo"], "data_leilao", "num_edital", BUCKET_ROWS)
    means = rolling.rolling_means(cut, ["titulo"], "data_leilao", "num_edital", {out: column})
    return means.select("num_edital", rounded(out, 6).alias(out))


def rolling4_rate(spark, sf_dir):
    return _rolling(spark, sf_dir, "pct_taxa_media", "pct_taxa_media_rolling_4")


def rolling4_coverage(spark, sf_dir):
    return _rolling(spark, sf_dir, "pct_cobertura", "pct_cobertura_rolling_4")


def _sql_round(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


_LAST_4 = "PARTITION BY titulo ORDER BY data_leilao, num_edital ROWS 3 PRECEDING"

ROLLING4_RATE = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT num_edital, {_sql_round(f'avg(pct_taxa_media) OVER ({_LAST_4})', 6)} AS pct_taxa_media_rolling_4
FROM res
"""

ROLLING4_COVERAGE = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT num_edital, {_sql_round(f'avg({_COVERAGE}) OVER ({_LAST_4})', 6)} AS pct_cobertura_rolling_4
FROM res
"""


def _month_totals(spark, sf_dir):
    rows = _auctions(spark, sf_dir)
    return totals.with_month_totals(
        rows,
        ["titulo"],
        "data_leilao",
        refined.total_amount(),
        "financeiro_mes_titulo",
        "financeiro_mes_mercado",
    )


def month_title_total(spark, sf_dir):
    return S.flat(_month_totals(spark, sf_dir).select("num_edital", "financeiro_mes_titulo"))


def month_market_total(spark, sf_dir):
    return S.flat(_month_totals(spark, sf_dir).select("num_edital", "financeiro_mes_mercado"))


_TOTAL = "sum(financeiro_aceito + coalesce(financeiro_aceito_segunda_volta, 0))"
_MONTH_TITLE = f"CAST({_TOTAL} OVER (PARTITION BY titulo, date_trunc('month', data_leilao)) AS DOUBLE)"
_MONTH_MARKET = f"CAST({_TOTAL} OVER (PARTITION BY date_trunc('month', data_leilao)) AS DOUBLE)"

MONTH_TITLE_TOTAL = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT num_edital, {_MONTH_TITLE} AS financeiro_mes_titulo FROM res
"""

MONTH_MARKET_TOTAL = f"""
{S.with_ctes(S.AUCTIONS_SQL)}
SELECT num_edital, {_MONTH_MARKET} AS financeiro_mes_mercado FROM res
"""


def _enriched(spark, sf_dir, **options):
    return refined.enrich(
        _auctions(spark, sf_dir),
        _calendar(spark, sf_dir),
        _periods(spark, sf_dir),
        rows_per_bucket=BUCKET_ROWS,
        **options,
    )


def _shown(enriched: DataFrame) -> DataFrame:
    """Comparable form: rolling means, the only inexact columns, at six digits."""
    means = ("pct_taxa_media_rolling_4", "pct_cobertura_rolling_4")
    return S.flat(
        enriched.withColumns({name: rounded(name, 6) for name in means}).drop("_insert_date")
    )


def auctions_enriched(spark, sf_dir):
    return _shown(_enriched(spark, sf_dir))


_ENRICHED_CTE = f"""
enriched AS (
    SELECT num_edital, res.titulo, res.benchmark, res.tipo_leilao, res.data_vencimento, res.data_leilao,
           data_liquidacao, data_liquidacao_segunda_volta, data_benchmark_inicio, data_benchmark_termino,
           {_FLAG} AS foi_agendado,
           qtd_oferta, qtd_oferta_segunda_volta, qtd_aceita, qtd_aceita_segunda_volta, qtd_bcb,
           pct_taxa_media, pct_taxa_maxima, pu_medio, pu_minimo,
           financeiro_aceito, financeiro_aceito_segunda_volta, financeiro_bcb,
           {_MEASURES},
           avg(pct_taxa_media) OVER ({_LAST_4}) AS rate_4,
           avg({_COVERAGE}) OVER ({_LAST_4}) AS coverage_4,
           {_MONTH_TITLE} AS financeiro_mes_titulo,
           {_MONTH_MARKET} AS financeiro_mes_mercado
    FROM res LEFT JOIN in_force USING (num_edital)
)"""

_ENRICHED_PARTS = (S.AUCTIONS_SQL, S.PERIODS_SQL, S.CALENDAR_SQL, _PERIOD_CTE, _ENRICHED_CTE)

_DAY_COLUMNS = (
    "data_vencimento",
    "data_leilao",
    "data_liquidacao",
    "data_liquidacao_segunda_volta",
    "data_benchmark_inicio",
    "data_benchmark_termino",
)
_DECIMAL_COLUMNS = (
    "pct_taxa_media",
    "pct_taxa_maxima",
    "pu_medio",
    "pu_minimo",
    "financeiro_aceito",
    "financeiro_aceito_segunda_volta",
    "financeiro_bcb",
)

AUCTIONS_ENRICHED = f"""
{S.with_ctes(*_ENRICHED_PARTS)}
SELECT * EXCLUDE (rate_4, coverage_4) REPLACE (
           {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _DAY_COLUMNS)},
           {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _DECIMAL_COLUMNS)}),
       {_sql_round('rate_4', 6)} AS pct_taxa_media_rolling_4,
       {_sql_round('coverage_4', 6)} AS pct_cobertura_rolling_4
FROM enriched
"""


def summary_by_title(spark, sf_dir):
    return S.flat(refined.summarize_by_title(_enriched(spark, sf_dir)))


SUMMARY_BY_TITLE = f"""
{S.with_ctes(*_ENRICHED_PARTS)}
SELECT titulo, benchmark, count(*) AS num_leiloes,
       CAST(min(data_leilao) AS VARCHAR) AS data_primeiro_leilao,
       CAST(max(data_leilao) AS VARCHAR) AS data_ultimo_leilao,
       {_sql_round('avg(pct_taxa_media)', 4)} AS pct_taxa_media_historica,
       {_sql_round('min(pct_taxa_media)', 4)} AS pct_taxa_minima_historica,
       {_sql_round('max(pct_taxa_maxima)', 4)} AS pct_taxa_maxima_historica,
       {_sql_round('avg(pct_cobertura)', 3)} AS pct_cobertura_media,
       count(*) FILTER (pct_cobertura < 1) AS leiloes_sem_cobertura,
       {_sql_round('sum(financeiro_total) / 1e9', 2)} AS financeiro_total_bi,
       {_sql_round('avg(financeiro_total) / 1e6', 2)} AS ticket_medio_mi,
       {_sql_round('avg(dias_ate_vencimento) / 365.0', 1)} AS prazo_medio_anos
FROM enriched GROUP BY titulo, benchmark
"""


def stress_auctions(spark, sf_dir):
    return S.flat(refined.stressed(_enriched(spark, sf_dir)))


STRESS_AUCTIONS = f"""
{S.with_ctes(*_ENRICHED_PARTS)}
SELECT CAST(data_leilao AS VARCHAR) AS data_leilao, titulo, benchmark, tipo_leilao, num_edital,
       qtd_oferta, qtd_aceita,
       {_sql_round('pct_cobertura', 3)} AS pct_cobertura,
       {_sql_round('pct_taxa_media', 4)} AS pct_taxa_media,
       {_sql_round('pct_taxa_maxima', 4)} AS pct_taxa_maxima,
       {_sql_round('pct_spread_taxa', 4)} AS pct_spread_taxa,
       {_sql_round('financeiro_total / 1e6', 2)} AS financeiro_mi,
       {_sql_round('CAST(rate_4 AS DECIMAL(38,9))', 4)} AS pct_taxa_media_rolling_4,
       {_sql_round('pct_taxa_media - CAST(rate_4 AS DECIMAL(38,9))', 4)} AS pct_delta_vs_rolling,
       foi_agendado
FROM enriched WHERE pct_cobertura < 1
"""


def medallion_auctions(spark, sf_dir):
    """Raw payloads of three endpoints through the trusted models to the enriched table."""
    raw = stored(spark, sf_dir, "raw_auctions", raw_auctions)
    run_at = datetime(2024, 6, 1)
    results, calendar, benchmarks = (
        build(raw, spec, run_at) for spec in (models.RESULTS, models.CALENDAR, models.BENCHMARKS)
    )
    # The trusted layer is stored: each model is built from raw once.
    stored_results = stored(spark, sf_dir, "trusted_results", lambda *_: results)
    stored_calendar = stored(spark, sf_dir, "trusted_calendar", lambda *_: calendar)
    stored_periods = stored(spark, sf_dir, "trusted_periods", lambda *_: benchmarks)
    return _shown(
        refined.enrich(stored_results, stored_calendar, stored_periods, rows_per_bucket=BUCKET_ROWS)
    )


QUERIES = {
    "interval_join": (interval_join, INTERVAL_JOIN),
    "latest_valid_period": (latest_valid_period, LATEST_VALID_PERIOD),
    "calendar_flag": (calendar_flag, CALENDAR_FLAG),
    "calendar_matches": (calendar_matches, CALENDAR_MATCHES),
    "safe_divide": (safe_divide_query, SAFE_DIVIDE),
    "auction_measures": (auction_measures, AUCTION_MEASURES),
    "rolling4_rate": (rolling4_rate, ROLLING4_RATE),
    "rolling4_coverage": (rolling4_coverage, ROLLING4_COVERAGE),
    "month_title_total": (month_title_total, MONTH_TITLE_TOTAL),
    "month_market_total": (month_market_total, MONTH_MARKET_TOTAL),
    "auctions_enriched": (auctions_enriched, AUCTIONS_ENRICHED),
    "summary_by_title": (summary_by_title, SUMMARY_BY_TITLE),
    "stress_auctions": (stress_auctions, STRESS_AUCTIONS),
    "medallion_auctions": (medallion_auctions, AUCTIONS_ENRICHED),
}
