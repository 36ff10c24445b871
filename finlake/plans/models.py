"""The eleven trusted models.

Fixed values: table and column names, payload member names, keys and checks are
those of the published data sets and of the tables their users query.
"""

from __future__ import annotations

from finlake.operators.quality import Checks
from finlake.plans.spec import Field, TrustedSpec

TRADES = TrustedSpec(
    name="binance_btc_trades",
    source="btcbrl_trades",
    comment="Exchange trades, one row per trade id.",
    fields=(
        Field("trade_id", "t", "integer"),
        Field("event_type", "e"),
        Field("event_time", "E", "epoch_millis"),
        Field("symbol", "s"),
        Field("price", "p", "numeric"),
        Field("quantity", "q", "numeric"),
        Field("trade_time", "T", "epoch_millis"),
        Field("is_buyer_maker", "m", "boolean"),
    ),
    key=("trade_id",),
    required=("trade_id",),
    event_order="event_time",
    partition_day="trade_time",
    checks=Checks(not_null=("trade_id", "trade_time", "price"), unique=(("trade_id",),)),
)

INTEREST_RATES = TrustedSpec(
    name="bacen_taxa_juros_mensal",
    source="bacen_taxa_juros_mensal",
    comment="Monthly interest rates by credit line and institution.",
    fields=(
        Field("data_referencia", "anoMes", "dashed_month", "first day of the reference month"),
        Field("modalidade", "Modalidade", comment="credit line"),
        Field("cnpj8", "cnpj8", comment="first eight digits of the institution's number"),
        Field("instituicao_financeira", "InstituicaoFinanceira", comment="institution"),
        Field("posicao", "Posicao", "integer", "rank in the period"),
        Field("pct_taxa_juros_mes", "TaxaJurosAoMes", "numeric", "percent per month"),
        Field("pct_taxa_juros_ano", "TaxaJurosAoAno", "numeric", "percent per year"),
    ),
    key=("data_referencia", "modalidade", "cnpj8"),
    key_month="data_referencia",
    required=("data_referencia", "modalidade", "cnpj8"),
    checks=Checks(
        not_null=("data_referencia", "modalidade", "cnpj8"),
        unique=(("data_referencia", "modalidade", "cnpj8"),),
    ),
)

INSTITUTIONS = TrustedSpec(
    name="bacen_ifdata_cadastro",
    source="bacen_ifdata_cadastro",
    comment="Quarterly register of financial institutions.",
    fields=(
        Field("cod_inst", "CodInst", comment="institution code"),
        Field("data_referencia", "Data", "compact_month", "first day of the reference month"),
        Field("nome_instituicao", "NomeInstituicao", comment="name"),
        Field("data_inicio_atividade", "DataInicioAtividade", "compact_month", "month operations began"),
        Field("tcb", "Tcb", comment="consolidated bank type"),
        Field("td", "Td", comment="I individual, C conglomerate"),
        Field("tc", "Tc", "integer", "control type"),
        Field("segmento", "SegmentoTb", comment="segment"),
        Field("uf", "Uf", comment="state"),
        Field("municipio", "Municipio", comment="city"),
        Field("sr", "Sr", comment="size segment S1 to S5, may be absent"),
        Field("cod_conglomerado_financeiro", "CodConglomeradoFinanceiro"),
        Field("cod_conglomerado_prudencial", "CodConglomeradoPrudencial"),
        Field("cnpj_instituicao_lider", "CnpjInstituicaoLider", comment="leading institution"),
        Field("situacao", "Situacao", comment="A active, I inactive"),
    ),
    key=("cod_inst", "data_referencia", "td"),
    key_month="data_referencia",
    required=("cod_inst", "data_referencia"),
    checks=Checks(
        not_null=("cod_inst", "data_referencia", "td"),
        unique=(("cod_inst", "data_referencia", "td"),),
    ),
)

REPORTS = TrustedSpec(
    name="bacen_ifdata_lista_relatorio",
    source="bacen_ifdata_lista_relatorio",
    comment="Catalogue of available reports.",
    fields=(
        Field("num_relatorio", "NumeroRelatorio", "integer", "report number"),
        Field("nome_relatorio", "NomeRelatorio", comment="report name"),
    ),
    key=("num_relatorio",),
    key_range="num_relatorio",
    required=("num_relatorio",),
    checks=Checks(not_null=("num_relatorio",), unique=(("num_relatorio",),)),
)

_PAYMENT_MEANS = ("Pix", "TED", "Boleto", "Cheque", "DOC", "TEC")

PAYMENTS = TrustedSpec(
    name="bacen_meios_pagamento_mensal",
    source="bacen_meios_pagamento_mensal",
    comment="Monthly volumes by means of payment.",
    fields=(
        Field("data_referencia", "AnoMes", "compact_month_start", "first day of the reference month"),
        *(
            field
            for means in _PAYMENT_MEANS
            for field in (
                Field(f"qtd_{means.lower()}", f"quantidade{means}", "integer", f"{means}: transactions"),
                Field(f"val_{means.lower()}", f"valor{means}", "numeric", f"{means}: amount"),
            )
        ),
    ),
    key=("data_referencia",),
    key_month="data_referencia",
    required=("data_referencia",),
    checks=Checks(not_null=("data_referencia",), unique=(("data_referencia",),)),
)

EXPECTATIONS = TrustedSpec(
    name="bacen_expectativas_anuais",
    source="bacen_expectativas_anuais",
    comment="Yearly market expectations by indicator and reference year.",
    fields=(
        Field("data_coleta", "Data", "iso_day", "survey day"),
        Field("indicador", "Indicador", comment="indicator"),
        Field("data_referencia", "DataReferencia", "integer", "reference year"),
        Field("media", "Media", "numeric", "mean"),
        Field("mediana", "Mediana", "numeric", "median"),
        Field("desvio_padrao", "DesvioPadrao", "numeric", "standard deviation"),
        Field("minimo", "Minimo", "numeric", "lowest"),
        Field("maximo", "Maximo", "numeric", "highest"),
        Field("num_respondentes", "numeroRespondentes", "integer", "respondents"),
    ),
    key=("data_coleta", "indicador", "data_referencia"),
    key_month="data_coleta",
    required=("data_coleta", "indicador"),
    checks=Checks(
        not_null=("data_coleta", "indicador", "data_referencia"),
        unique=(("data_coleta", "indicador", "data_referencia"),),
    ),
)

_AUCTIONS = "tesouro_leiloes"

BENCHMARKS = TrustedSpec(
    name="tesouro_benchmarks",
    source=_AUCTIONS,
    endpoint="benchmarks",
    comment="Periods in which a bond is the benchmark of its kind.",
    fields=(
        Field("benchmark", "BENCHMARK"),
        Field("titulo", "TÍTULO", comment="bond kind"),
        Field("data_vencimento", "VENCIMENTO", "iso_day", "maturity"),
        Field("data_inicio", "INÍCIO", "iso_day", "first day of the period"),
        Field("data_termino", "TERMINO", "iso_day", "last day of the period"),
    ),
    key=("benchmark", "titulo", "data_vencimento", "data_inicio", "data_termino"),
    key_month="data_inicio",
    required=("data_vencimento",),
    checks=Checks(
        not_null=("benchmark", "data_vencimento", "data_inicio"),
        unique=(("benchmark", "titulo", "data_vencimento", "data_inicio", "data_termino"),),
    ),
)

CALENDAR = TrustedSpec(
    name="tesouro_calendario",
    source=_AUCTIONS,
    endpoint="calendario",
    comment="Official auction calendar.",
    fields=(
        Field("benchmark", "BENCHMARK"),
        Field("titulo", "TITULO", comment="bond kind"),
        Field("data_vencimento", "VENCIMENTO", "iso_day", "maturity"),
        Field("data_leilao", "DATA_LEILAO", "iso_day", "auction day"),
        Field("tipo_leilao", "TIPO_LEILAO", comment="auction type"),
    ),
    key=("benchmark", "titulo", "data_vencimento", "data_leilao", "tipo_leilao"),
    key_month="data_leilao",
    checks=Checks(
        not_null=("titulo", "data_vencimento", "data_leilao"),
        unique=(("benchmark", "titulo", "data_vencimento", "data_leilao", "tipo_leilao"),),
    ),
)

ANNOUNCEMENTS = TrustedSpec(
    name="tesouro_comunicados",
    source=_AUCTIONS,
    endpoint="comunicados",
    comment="Official announcements, one row per link.",
    fields=(
        Field("link", "LINK", comment="download address"),
        Field("titulo", "TITULO", comment="title"),
    ),
    key=("link",),
    checks=Checks(not_null=("link",), unique=(("link",),)),
)

DEALERS = TrustedSpec(
    name="tesouro_dealers",
    source=_AUCTIONS,
    endpoint="dealers",
    comment="Primary dealers by period.",
    fields=(
        Field("dealer", "DEALER", comment="institution"),
        Field("cnpj", "CNPJ", comment="company number"),
        Field("data_inicio_periodo", "INICIO_PERIODO", "iso_day", "first day as dealer"),
        Field("data_fim_periodo", "FIM_PERIODO", "iso_day", "last day as dealer"),
    ),
    key=("dealer", "cnpj", "data_inicio_periodo", "data_fim_periodo"),
    key_month="data_inicio_periodo",
    checks=Checks(
        not_null=("cnpj", "data_inicio_periodo"),
        unique=(("dealer", "cnpj", "data_inicio_periodo", "data_fim_periodo"),),
    ),
)

RESULTS = TrustedSpec(
    name="tesouro_resultados",
    source=_AUCTIONS,
    endpoint="resultados",
    comment="Auction results, one row per notice number.",
    fields=(
        Field("num_edital", "numero_edital", "integer", "auction notice number"),
        Field("titulo", "titulo", comment="bond kind"),
        Field("benchmark", "benchmark", comment="term reference"),
        Field("tipo_leilao", "tipo_leilao", comment="auction type"),
        Field("data_vencimento", "vencimento", "slash_day", "maturity"),
        Field("data_leilao", "data_leilao", "slash_day", "auction day"),
        Field("data_liquidacao", "liquidacao", "slash_day", "settlement"),
        Field(
            "data_liquidacao_segunda_volta", "liquidacao_segunda_volta", "slash_day",
            "settlement of the second round",
        ),
        Field("qtd_oferta", "oferta", "integer", "offered"),
        Field("qtd_oferta_segunda_volta", "oferta_segunda_volta", "integer", "offered, second round"),
        Field("qtd_aceita", "quantidade_aceita", "integer", "accepted"),
        Field(
            "qtd_aceita_segunda_volta", "quantidade_aceita_segunda_volta", "integer",
            "accepted, second round",
        ),
        Field("qtd_bcb", "quantidade_bcb", "integer", "accepted by the central bank"),
        Field("pct_taxa_media", "taxa_media", "numeric", "mean accepted rate, percent per year"),
        Field("pct_taxa_maxima", "taxa_maxima", "numeric", "highest accepted rate, percent per year"),
        Field("pu_medio", "pu_medio", "numeric", "mean accepted unit price"),
        Field("pu_minimo", "pu_minimo", "numeric", "lowest accepted unit price"),
        Field("financeiro_aceito", "financeiro_aceito", "numeric", "accepted amount"),
        Field(
            "financeiro_aceito_segunda_volta", "financeiro_aceito_segunda_volta", "numeric",
            "accepted amount, second round",
        ),
        Field("financeiro_bcb", "financeiro_bcb", "numeric", "amount accepted by the central bank"),
    ),
    key=("num_edital",),
    key_range="num_edital",
    checks=Checks(
        not_null=("num_edital", "titulo", "data_vencimento", "data_leilao"),
        unique=(("num_edital",),),
    ),
)

ALL = {
    spec.name: spec
    for spec in (
        TRADES,
        INTEREST_RATES,
        INSTITUTIONS,
        REPORTS,
        PAYMENTS,
        EXPECTATIONS,
        BENCHMARKS,
        CALENDAR,
        ANNOUNCEMENTS,
        DEALERS,
        RESULTS,
    )
}

# Auction endpoints that share one raw table; the first three have no trusted model.
AUCTION_ENDPOINTS = (
    "homologacao",
    "portarias",
    "editais",
    "benchmarks",
    "calendario",
    "comunicados",
    "dealers",
    "resultados",
)

REFINED_CHECKS = {
    "tesouro_leiloes_enriched": Checks(
        not_null=("num_edital", "data_leilao", "titulo"), unique=(("num_edital",),)
    ),
    "tesouro_leiloes_por_titulo": Checks(not_null=("titulo",)),
    "tesouro_leiloes_stress": Checks(not_null=("num_edital", "data_leilao")),
}
