"""The trusted models on payloads in the shapes of their sources."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finlake.plans import models
from finlake.plans.spec import build, quarantine, type_payloads
from finlake.sources import raw

RUN_AT = datetime(2024, 6, 1, 4, 0)


def raw_frame(spark, payloads, endpoint=None, ingested=None):
    rows = []
    for i, p in enumerate(payloads):
        text = p if isinstance(p, str) or p is None else json.dumps(p, ensure_ascii=False)
        at = ingested[i] if ingested else datetime(2024, 5, 31, 4, 0)
        rows.append((text, endpoint, f"f{i:03}.jsonl", at, at.date()))
    frame = spark.createDataFrame(rows, raw.MULTIPLEXED_SCHEMA)
    return frame if endpoint else frame.drop(raw.ENDPOINT)


def built(spark, spec, payloads, **kw):
    frame = raw_frame(spark, payloads, spec.endpoint, kw.pop("ingested", None))
    return build(frame, spec, RUN_AT, **kw).orderBy(*spec.key).collect()


EXAMPLES = {
    "binance_btc_trades": (
        {"e": "trade", "E": 1704067211172, "s": "BTCBRL", "t": 7, "p": "210000.10", "q": "0.00001200",
         "T": 1704067211170, "m": False},
        (7, "trade", datetime(2024, 1, 1, 0, 0, 11, 172000), "BTCBRL", Decimal("210000.1"),
         Decimal("0.000012"), datetime(2024, 1, 1, 0, 0, 11, 170000), False),
    ),
    "bacen_taxa_juros_mensal": (
        {"anoMes": "2024-03", "Modalidade": "Crédito", "cnpj8": "00000001", "InstituicaoFinanceira": "A",
         "Posicao": 3, "TaxaJurosAoMes": 1.23, "TaxaJurosAoAno": "15.8"},
        (date(2024, 3, 1), "Crédito", "00000001", "A", 3, Decimal("1.23"), Decimal("15.8")),
    ),
    "bacen_ifdata_cadastro": (
        {"CodInst": "C1", "Data": "202412", "NomeInstituicao": "N", "DataInicioAtividade": "199907",
         "Tcb": "B1", "Td": "I", "Tc": 2, "SegmentoTb": "Banco", "Uf": "SP", "Municipio": "São Paulo",
         "Sr": None, "CodConglomeradoFinanceiro": "F", "CodConglomeradoPrudencial": "P",
         "CnpjInstituicaoLider": "L", "Situacao": "A"},
        ("C1", date(2024, 12, 1), "N", date(1999, 7, 1), "B1", "I", 2, "Banco", "SP", "São Paulo", None,
         "F", "P", "L", "A"),
    ),
    "bacen_ifdata_lista_relatorio": ({"NumeroRelatorio": "1", "NomeRelatorio": "Resumo"}, (1, "Resumo")),
    "bacen_meios_pagamento_mensal": (
        {"AnoMes": "202404", "quantidadePix": 1, "valorPix": 1.5, "quantidadeTED": 2, "valorTED": 2.5,
         "quantidadeBoleto": 3, "valorBoleto": 3.5, "quantidadeCheque": 4, "valorCheque": 4.5,
         "quantidadeDOC": 5, "valorDOC": 5.5, "quantidadeTEC": 6, "valorTEC": 6.5},
        (date(2024, 4, 1), *(v for i in range(1, 7) for v in (i, Decimal(f"{i}.5")))),
    ),
    "bacen_expectativas_anuais": (
        {"Data": "2024-03-05", "Indicador": "IPCA", "DataReferencia": "2026", "Media": 3.9, "Mediana": 4,
         "DesvioPadrao": 0.2, "Minimo": 3, "Maximo": 5, "numeroRespondentes": 100},
        (date(2024, 3, 5), "IPCA", 2026, Decimal("3.9"), Decimal(4), Decimal("0.2"), Decimal(3), Decimal(5),
         100),
    ),
    "tesouro_benchmarks": (
        {"BENCHMARK": "LFT 3 anos", "TÍTULO": "LFT", "VENCIMENTO": "2027-03-01", "INÍCIO": "2024-01-01",
         "TERMINO": "2024-06-30"},
        ("LFT 3 anos", "LFT", date(2027, 3, 1), date(2024, 1, 1), date(2024, 6, 30)),
    ),
    "tesouro_calendario": (
        {"BENCHMARK": "B", "TITULO": "LFT", "VENCIMENTO": "2027-03-01", "DATA_LEILAO": "2024-01-09",
         "TIPO_LEILAO": "Venda"},
        ("B", "LFT", date(2027, 3, 1), date(2024, 1, 9), "Venda"),
    ),
    "tesouro_comunicados": ({"LINK": "http://x/1", "TITULO": "Aviso"}, ("http://x/1", "Aviso")),
    "tesouro_dealers": (
        {"DEALER": "D", "CNPJ": "1", "INICIO_PERIODO": "2024-02-10", "FIM_PERIODO": "2024-08-09"},
        ("D", "1", date(2024, 2, 10), date(2024, 8, 9)),
    ),
    "tesouro_resultados": (
        {"numero_edital": 12, "titulo": "LFT", "benchmark": "B", "tipo_leilao": "Venda",
         "vencimento": "01/03/2027", "data_leilao": "9/1/2024", "liquidacao": "10/01/2024", "oferta": 100,
         "quantidade_aceita": "90", "taxa_media": 0.1, "taxa_maxima": "0.12", "pu_medio": 999.5,
         "pu_minimo": 999.1, "financeiro_aceito": 12345678901234567.12},
        (12, "LFT", "B", "Venda", date(2027, 3, 1), date(2024, 1, 9), date(2024, 1, 10), None, 100, None,
         90, None, None, Decimal("0.1"), Decimal("0.12"), Decimal("999.5"), Decimal("999.1"),
         Decimal("12345678901234567.12"), None, None),
    ),
}


@pytest.mark.parametrize("name", list(models.ALL))
def test_payload_becomes_typed_row(spark, name):
    payload, expected = EXAMPLES[name]
    spec = models.ALL[name]
    text = json.dumps(payload, ensure_ascii=False).replace("1.2345678901234568e+16", "12345678901234567.12")
    frame = build(raw_frame(spark, [text], spec.endpoint), spec, RUN_AT)
    assert [f.dataType for f in frame.schema] == [f.dataType for f in spec.schema()]
    assert tuple(frame.first()) == (*expected, RUN_AT)


@pytest.mark.parametrize("name", [n for n, s in models.ALL.items() if s.required])
def test_rows_without_required_values_are_left_out(spark, name):
    payload, _ = EXAMPLES[name]
    spec = models.ALL[name]
    members = {f.name: f.member for f in spec.fields}
    for column in spec.required:
        lacking = {**payload, members[column]: None}
        absent = {k: v for k, v in payload.items() if k != members[column]}
        assert built(spark, spec, [lacking, absent]) == []


def test_declared_checks():
    not_null = sum(len(s.checks.not_null) for s in models.ALL.values())
    not_null += sum(len(c.not_null) for c in models.REFINED_CHECKS.values())
    assert not_null == 33
    unique = [k for s in models.ALL.values() for k in s.checks.unique]
    unique += [k for c in models.REFINED_CHECKS.values() for k in c.unique]
    combos = [s for s in models.ALL.values() if s.checks.unique and s.checks.unique[0] == s.key]
    assert len(unique) == 12 and len(combos) == 11


def test_latest_record_wins_and_ties_are_stable(spark):
    payload, _ = EXAMPLES["tesouro_comunicados"]
    early, late = datetime(2024, 5, 1), datetime(2024, 5, 2)
    titles = ["old", "new b", "new a"]
    frames = [{**payload, "TITULO": t} for t in titles]
    spec = models.ANNOUNCEMENTS
    rows = built(spark, spec, frames, ingested=[early, late, late])
    again = built(spark, spec, frames[::-1], ingested=[late, late, early])
    assert rows == again and rows[0].titulo.startswith("new")


def test_trades_are_ordered_by_event_time(spark):
    payload, _ = EXAMPLES["binance_btc_trades"]
    first = {**payload, "E": 1704067211999, "p": "2"}
    second = {**payload, "E": 1704067211000, "p": "1"}
    rows = built(
        spark, models.TRADES, [first, second], ingested=[datetime(2024, 5, 1), datetime(2024, 5, 2)]
    )
    assert [r.price for r in rows] == [Decimal(2)]


def test_keys_are_compared_after_typing(spark):
    rows = built(
        spark,
        models.REPORTS,
        [{"NumeroRelatorio": "01", "NomeRelatorio": "a"}, {"NumeroRelatorio": 1, "NomeRelatorio": "b"}],
    )
    assert [(r.num_relatorio, r.nome_relatorio) for r in rows] == [(1, "b")]


def test_null_key_parts_are_one_group(spark):
    payload = {"CNPJ": "1", "INICIO_PERIODO": "2024-02-10", "FIM_PERIODO": "2024-08-09"}
    assert len(built(spark, models.DEALERS, [payload, payload])) == 1


def test_strict_raises_and_quarantine_lists(spark):
    good, _ = EXAMPLES["bacen_ifdata_lista_relatorio"]
    frame = raw_frame(spark, [good, {"NumeroRelatorio": "1.0", "NomeRelatorio": "x"}, '{"NumeroRelatorio":'])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        type_payloads(frame, models.REPORTS).collect()
    lenient = type_payloads(frame, models.REPORTS, strict=False).orderBy("_source_file").collect()
    assert [r.num_relatorio for r in lenient] == [1, None]
    listed = quarantine(frame, models.REPORTS).orderBy("_source_file").collect()
    assert [r.reasons for r in listed] == [["num_relatorio: not integer"], ["malformed payload"]]


def test_windows(spark):
    payload = EXAMPLES["tesouro_comunicados"][0]
    as_of = date(2024, 5, 10)
    days = [datetime(2024, 5, d) for d in (7, 8, 9, 10)]
    payloads = [{**payload, "LINK": str(d.day)} for d in days]

    def links(**kw):
        rows = built(spark, models.ANNOUNCEMENTS, payloads, ingested=days, as_of=as_of, **kw)
        return sorted(int(r.link) for r in rows)

    assert links() == [7, 8, 9, 10]
    assert links(incremental=True) == [8, 9, 10]
    assert links(incremental=True, start_date=date(2024, 5, 9)) == [9, 10]
    assert links(incremental=False, start_date=date(2024, 5, 9)) == [7, 8, 9, 10]


def test_endpoints_are_separated(spark):
    frame = raw_frame(spark, [EXAMPLES["tesouro_comunicados"][0]], "comunicados").unionByName(
        raw_frame(spark, [EXAMPLES["tesouro_dealers"][0]], "dealers")
    )
    assert build(frame, models.ANNOUNCEMENTS, RUN_AT).count() == 1
    assert build(frame, models.DEALERS, RUN_AT).count() == 1
    assert build(frame, models.CALENDAR, RUN_AT).count() == 0


def test_comments_are_kept_in_the_schema():
    schema = models.RESULTS.schema()
    assert schema["num_edital"].metadata["comment"]
    assert schema.fieldNames()[-1] == "_insert_date"


def test_one_row_per_distinct_key_however_hot(spark):
    rows = spark.range(30000).select(
        F.to_json(F.struct(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 977).alias("NumeroRelatorio"),
            F.col("id").cast("string").alias("NomeRelatorio"),
        )).alias("payload"),
        F.lit("f").alias("_source_file"),
        F.timestamp_seconds("id").alias("_ingested_at"),
        F.lit(date(2024, 1, 1)).alias("_load_date"),
    )
    out = build(rows, models.REPORTS, RUN_AT)
    assert out.count() == out.select("num_relatorio").distinct().count() == 977
    assert out.where("num_relatorio = 1").first().nome_relatorio == "29997"
