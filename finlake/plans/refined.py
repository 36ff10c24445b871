"""Refined auction models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finlake.functions.dates import days_between
from finlake.functions.numbers import AT_REST, IN_SUMS, minus, plus_optional, rounded, safe_divide
from finlake.operators import periods, rolling, totals
from finlake.plans.spec import INSERT_DATE
from finlake.sources import files

SLOT = ["titulo", "data_vencimento", "data_leilao", "tipo_leilao"]
_BOND = ["titulo", "data_vencimento"]

# Fixed order of the columns of tesouro_leiloes_enriched.
ENRICHED_COLUMNS = [
    "num_edital",
    "titulo",
    "benchmark",
    "tipo_leilao",
    "data_vencimento",
    "data_leilao",
    "data_liquidacao",
    "data_liquidacao_segunda_volta",
    "data_benchmark_inicio",
    "data_benchmark_termino",
    "foi_agendado",
    "qtd_oferta",
    "qtd_oferta_segunda_volta",
    "qtd_aceita",
    "qtd_aceita_segunda_volta",
    "qtd_bcb",
    "qtd_aceita_total",
    "pct_taxa_media",
    "pct_taxa_maxima",
    "pct_spread_taxa",
    "pu_medio",
    "pu_minimo",
    "spread_pu",
    "financeiro_aceito",
    "financeiro_aceito_segunda_volta",
    "financeiro_bcb",
    "financeiro_total",
    "dias_ate_vencimento",
    "pct_cobertura",
    "pct_cobertura_segunda_volta",
    "pct_taxa_media_rolling_4",
    "pct_cobertura_rolling_4",
    "financeiro_mes_titulo",
    "financeiro_mes_mercado",
    INSERT_DATE,
]


def coverage() -> Column:
    return safe_divide("qtd_aceita", "qtd_oferta")


def total_amount() -> Column:
    return plus_optional("financeiro_aceito", "financeiro_aceito_segunda_volta")


def measures() -> dict[str, Column]:
    """Columns derived from one auction row alone."""
    second_offer = F.nullif(F.col("qtd_oferta_segunda_volta"), F.lit(0))
    return {
        "qtd_aceita_total": F.col("qtd_aceita")
        + F.coalesce("qtd_aceita_segunda_volta", F.lit(0).cast("bigint")),
        "pct_spread_taxa": minus("pct_taxa_maxima", "pct_taxa_media"),
        "spread_pu": minus("pu_medio", "pu_minimo"),
        "financeiro_total": total_amount(),
        "dias_ate_vencimento": days_between("data_vencimento", "data_leilao"),
        "pct_cobertura": coverage(),
        "pct_cobertura_segunda_volta": safe_divide("qtd_aceita_segunda_volta", second_offer),
    }


def benchmark_periods(slots: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Benchmark period in force for each bond and auction day of ``slots`` (or of auctions)."""
    return periods.latest_period(
        slots, benchmarks, _BOND, "data_leilao", "data_inicio", "data_termino"
    ).withColumnsRenamed(
        {"data_inicio": "data_benchmark_inicio", "data_termino": "data_benchmark_termino"}
    )


def enrich(
    results: DataFrame,
    calendar: DataFrame,
    benchmarks: DataFrame,
    one_row_per_auction: bool = True,
    rows_per_bucket: int = rolling.ROWS_PER_BUCKET,
    work: str | None = None,
) -> DataFrame:
    """One row per auction with calendar, benchmark period, measures, rolling means, totals.

    Everything an auction gets from elsewhere depends on its slot only (bond,
    day, type). Auctions are therefore reduced to slots first, which are written once, below ``work``;
    the calendar, the benchmark periods, the month totals and the rolling buckets are worked out on
    slots, and one join brings them back. The auctions themselves are read twice, for the slots and
    for that join (days larger than a share of a bucket twice more), and shuffled
    for that join and for the rolling means, and nowhere else.

    The calendar is keyed by benchmark as well, so several entries may fit a slot.
    They count once; ``one_row_per_auction=False`` repeats the auction per entry, and
    with it the amounts in the totals.
    """
    if not one_row_per_auction:
        entries = calendar.select(*SLOT, F.lit(True).alias("__entry"))
        results = results.join(entries, SLOT, "left").drop("__entry")

    day, bond_day = "data_leilao", ["titulo", "data_leilao"]
    slots = results.groupBy(*SLOT).agg(
        F.sum(total_amount()).alias("__amount"), F.count(F.lit(1)).alias("__n")
    )
    slots = files.hold(slots, "slots", work)
    days = slots.groupBy(*bond_day).agg(*(F.sum(c).alias(c) for c in ("__n", "__amount")))
    places = rolling.place_days(days, results, ["titulo"], day, "num_edital", rows_per_bucket, work=work)
    days = totals.spread_month_totals(
        days.drop("__n"), day, ["titulo"], "financeiro_mes_titulo", "financeiro_mes_mercado"
    )

    facts = periods.with_match_flag(slots.select(*SLOT), calendar, SLOT, "foi_agendado")
    facts = facts.join(benchmark_periods(slots, benchmarks), [*_BOND, day], "left")
    facts = periods.null_safe_left_join(facts, days, bond_day)
    facts = periods.null_safe_left_join(facts, places, bond_day)

    kept = results.columns
    added = [c for c in facts.columns if c not in SLOT and c not in rolling.PLACE]
    rows = periods.null_safe_left_join(
        results,
        facts,
        SLOT,
        *kept,
        *added,
        *rolling.bucket_columns("num_edital"),
        *(value.alias(name) for name, value in measures().items()),
    )
    rows = rolling.rolling_means(
        rows,
        ["titulo"],
        day,
        "num_edital",
        {
            "pct_taxa_media_rolling_4": "pct_taxa_media",
            "pct_cobertura_rolling_4": "pct_cobertura",
        },
        rows=4,
    )
    rate = "pct_taxa_media_rolling_4"
    return rows.select(
        *(
            F.col(c).cast(AT_REST).alias(c) if c == rate else c
            for c in ENRICHED_COLUMNS
            if c in rows.columns
        )
    )


def summarize_by_title(enriched: DataFrame, ordered: bool = True) -> DataFrame:
    """History per bond kind and benchmark: volume, rates, coverage, ticket, term."""
    total = F.col("financeiro_total")
    summary = enriched.groupBy("titulo", "benchmark").agg(
        F.count(F.lit(1)).alias("num_leiloes"),
        F.min("data_leilao").alias("data_primeiro_leilao"),
        F.max("data_leilao").alias("data_ultimo_leilao"),
        rounded(F.avg("pct_taxa_media"), 4).alias("pct_taxa_media_historica"),
        rounded(F.min("pct_taxa_media"), 4).alias("pct_taxa_minima_historica"),
        rounded(F.max("pct_taxa_maxima"), 4).alias("pct_taxa_maxima_historica"),
        rounded(F.avg("pct_cobertura"), 3).alias("pct_cobertura_media"),
        F.count_if(F.col("pct_cobertura") < 1).alias("leiloes_sem_cobertura"),
        rounded(F.sum(total).cast("double") / 1e9, 2).alias("financeiro_total_bi"),
        rounded(F.avg(total).cast("double") / 1e6, 2).alias("ticket_medio_mi"),
        rounded(F.avg("dias_ate_vencimento") / 365.0, 1).alias("prazo_medio_anos"),
    )
    return summary.orderBy(F.desc("financeiro_total_bi"), "titulo", "benchmark") if ordered else summary


def stressed(enriched: DataFrame, ordered: bool = True) -> DataFrame:
    """Auctions that placed less than they offered.

    Sorted by day, newest first; the notice number makes the sort key unique, so
    a busy day is spread over several sort ranges.
    """
    short = enriched.where(F.col("pct_cobertura") < 1).select(
        "data_leilao",
        "titulo",
        "benchmark",
        "tipo_leilao",
        "num_edital",
        "qtd_oferta",
        "qtd_aceita",
        rounded("pct_cobertura", 3).alias("pct_cobertura"),
        rounded("pct_taxa_media", 4).alias("pct_taxa_media"),
        rounded("pct_taxa_maxima", 4).alias("pct_taxa_maxima"),
        rounded("pct_spread_taxa", 4).alias("pct_spread_taxa"),
        rounded(F.col("financeiro_total").cast("double") / 1e6, 2).alias("financeiro_mi"),
        rounded("pct_taxa_media_rolling_4", 4).alias("pct_taxa_media_rolling_4"),
        rounded(minus("pct_taxa_media", "pct_taxa_media_rolling_4"), 4).alias(
            "pct_delta_vs_rolling"
        ),
        "foi_agendado",
    )
    return short.orderBy(F.desc("data_leilao"), "num_edital") if ordered else short


def _rounded_sql(expression: str, digits: int) -> str:
    """:func:`rounded` in SQL."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


# The two lists as text, for views of the catalog, which hold SQL only. They say what
# summarize_by_title and stressed say.
BY_TITLE_SQL = f"""
SELECT titulo, benchmark, COUNT(*) AS num_leiloes,
       MIN(data_leilao) AS data_primeiro_leilao, MAX(data_leilao) AS data_ultimo_leilao,
       {_rounded_sql("AVG(pct_taxa_media)", 4)} AS pct_taxa_media_historica,
       {_rounded_sql("MIN(pct_taxa_media)", 4)} AS pct_taxa_minima_historica,
       {_rounded_sql("MAX(pct_taxa_maxima)", 4)} AS pct_taxa_maxima_historica,
       {_rounded_sql("AVG(pct_cobertura)", 3)} AS pct_cobertura_media,
       COUNT_IF(pct_cobertura < 1) AS leiloes_sem_cobertura,
       {_rounded_sql("CAST(SUM(financeiro_total) AS DOUBLE) / 1e9", 2)} AS financeiro_total_bi,
       {_rounded_sql("CAST(AVG(financeiro_total) AS DOUBLE) / 1e6", 2)} AS ticket_medio_mi,
       {_rounded_sql("AVG(dias_ate_vencimento) / 365.0D", 1)} AS prazo_medio_anos
FROM {{enriched}} GROUP BY titulo, benchmark
ORDER BY financeiro_total_bi DESC, titulo, benchmark
"""

_DELTA_SQL = f"CAST(pct_taxa_media AS {IN_SUMS}) - CAST(pct_taxa_media_rolling_4 AS {IN_SUMS})"

STRESS_SQL = f"""
SELECT data_leilao, titulo, benchmark, tipo_leilao, num_edital, qtd_oferta, qtd_aceita,
       {_rounded_sql("pct_cobertura", 3)} AS pct_cobertura,
       {_rounded_sql("pct_taxa_media", 4)} AS pct_taxa_media,
       {_rounded_sql("pct_taxa_maxima", 4)} AS pct_taxa_maxima,
       {_rounded_sql("pct_spread_taxa", 4)} AS pct_spread_taxa,
       {_rounded_sql("CAST(financeiro_total AS DOUBLE) / 1e6", 2)} AS financeiro_mi,
       {_rounded_sql("pct_taxa_media_rolling_4", 4)} AS pct_taxa_media_rolling_4,
       {_rounded_sql(_DELTA_SQL, 4)} AS pct_delta_vs_rolling,
       foi_agendado
FROM {{enriched}} WHERE pct_cobertura < 1
ORDER BY data_leilao DESC, num_edital
"""
