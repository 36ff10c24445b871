"""Period joins, rolling means, totals and the refined auction models."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from finlake.operators import periods, quality, rolling, totals
from finlake.plans import models, refined
from finlake.plans.tables import Lake
from finlake.sources import raw

RESULT_COLUMNS = models.RESULTS.schema()


def auction(number, day, titulo="LFT", **other):
    row = {
        "num_edital": number, "titulo": titulo, "benchmark": "B", "tipo_leilao": "Venda",
        "data_vencimento": date(2030, 1, 1), "data_leilao": day, "data_liquidacao": None,
        "data_liquidacao_segunda_volta": None, "qtd_oferta": 100, "qtd_oferta_segunda_volta": 0,
        "qtd_aceita": 50, "qtd_aceita_segunda_volta": None, "qtd_bcb": 0,
        "pct_taxa_media": Decimal(number), "pct_taxa_maxima": Decimal(number + 1),
        "pu_medio": Decimal(10), "pu_minimo": Decimal(9), "financeiro_aceito": Decimal(1000),
        "financeiro_aceito_segunda_volta": None, "financeiro_bcb": None,
        "_insert_date": datetime(2024, 6, 1),
    }
    return {**row, **other}


def results(spark, *rows):
    data = [tuple(r[f.name] for f in RESULT_COLUMNS) for r in rows]
    return spark.createDataFrame(data, RESULT_COLUMNS)


def bench(spark, *rows):
    schema = "benchmark string, titulo string, data_vencimento date, data_inicio date, data_termino date"
    return spark.createDataFrame([("B", "LFT", date(2030, 1, 1), *r) for r in rows], schema)


def cal(spark, *rows):
    schema = (
        "benchmark string, titulo string, data_vencimento date, data_leilao date, tipo_leilao string"
    )
    return spark.createDataFrame([(b, "LFT", date(2030, 1, 1), d, "Venda") for b, d in rows], schema)


J = [date(2024, 1, 1) + timedelta(days=i) for i in range(400)]


def enriched(spark, rows, entries=(), terms=(), **kw):
    frame = refined.enrich(results(spark, *rows), cal(spark, *entries), bench(spark, *terms), **kw)
    return {r.num_edital: r for r in frame.collect()}


def test_period_edges_latest_start_and_no_period(spark):
    terms = [(J[10], J[20]), (J[15], J[18]), (J[15], J[16]), (J[40], J[30])]
    days = {9: None, 10: 10, 14: 10, 15: 15, 18: 15, 19: 10, 20: 10, 21: None, 35: None}
    rows = [auction(i, J[d]) for i, d in enumerate(days)]
    got = enriched(spark, rows, terms=terms)
    for i, start in enumerate(days.values()):
        assert got[i].data_benchmark_inicio == (J[start] if start is not None else None)
    assert got[3].data_benchmark_termino == J[18]  # of two with one start, the longer


def test_interval_join_gives_every_pair_once(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), J[rng.randrange(300)]) for i in range(60)]
    spans = [(j, rng.choice("ab"), s := rng.randrange(300), s + rng.randrange(-5, 90)) for j in range(40)]
    left = spark.createDataFrame(rows, "i int, k string, day date")
    right = spark.createDataFrame(
        [(j, k, J[s], J[e] if e >= 0 else J[0]) for j, k, s, e in spans], "j int, k string, s date, e date"
    )
    got = periods.interval_join(left, right, ["k"], "day", "s", "e").select("i", "j").collect()
    want = [(i, j) for i, k, d in rows for j, kk, s, e in spans if k == kk and J[s] <= d <= J[max(e, 0)]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_calendar_flag_does_not_repeat_auctions(spark):
    rows = [auction(1, J[0]), auction(2, J[1])]
    entries = [("B", J[0]), ("C", J[0])]
    got = enriched(spark, rows, entries)
    assert len(got) == 2 and got[1].foi_agendado is True and got[2].foi_agendado is False
    assert got[2].financeiro_mes_mercado == 2000
    repeated = refined.enrich(
        results(spark, *rows), cal(spark, *entries), bench(spark), one_row_per_auction=False
    ).collect()
    assert sorted(r.num_edital for r in repeated) == [1, 1, 2]
    assert {r.financeiro_mes_mercado for r in repeated} == {3000}


def test_null_type_finds_no_calendar_entry_but_keeps_its_totals(spark):
    got = enriched(spark, [auction(1, J[0], tipo_leilao=None), auction(2, J[0])], [("B", J[0])])
    assert got[1].foi_agendado is False and got[2].foi_agendado is True
    assert got[1].financeiro_mes_titulo == got[2].financeiro_mes_titulo == 2000


def test_measures(spark):
    got = enriched(
        spark,
        [
            auction(1, J[0], qtd_oferta=0),
            auction(2, J[0], qtd_aceita=None),
            auction(3, J[0], qtd_aceita=100, qtd_oferta_segunda_volta=4, qtd_aceita_segunda_volta=3),
            auction(4, J[0], financeiro_aceito_segunda_volta=Decimal("0.000000001")),
        ],
    )
    assert got[1].pct_cobertura is None and got[1].pct_cobertura_segunda_volta is None
    assert got[2].pct_cobertura is None and got[2].qtd_aceita_total is None
    assert (got[3].pct_cobertura, got[3].pct_cobertura_segunda_volta, got[3].qtd_aceita_total) == (1.0, 0.75, 103)
    assert got[4].financeiro_total == Decimal("1000.000000001")
    assert got[1].dias_ate_vencimento == (date(2030, 1, 1) - J[0]).days
    assert (got[1].pct_spread_taxa, got[1].spread_pu) == (1, 1)


def test_rolling_and_totals_across_a_month_end(spark):
    days = [date(2024, 1, 29), date(2024, 1, 30), date(2024, 1, 30), date(2024, 2, 1), date(2024, 2, 2)]
    rows = [auction(n, d) for n, d in zip((5, 3, 2, 9, 7), days)]
    got = enriched(spark, rows, rows_per_bucket=1)
    means = {5: 5, 2: 3.5, 3: 10 / 3, 9: 4.75, 7: 5.25}
    for number, mean in means.items():
        assert float(got[number].pct_taxa_media_rolling_4) == pytest.approx(mean, abs=1e-9)
    assert [got[n].financeiro_mes_titulo for n in (5, 9)] == [3000, 2000]


def random_rows(seed, n):
    """One group holds a third of the rows, one day of it most of them."""
    rng = random.Random(seed)
    ids = rng.sample(range(-(10**6), 10**6), n)
    rows = []
    for i, number in enumerate(ids):
        hot = i % 3 == 0
        group = "hot" if hot else rng.choice(["a", "b", None])
        day = J[7] if hot and rng.random() < 0.8 else rng.choice([*J[:25], None])
        rows.append((number, group, day, rng.choice([None, float(rng.randrange(1000))])))
    return rows


@pytest.mark.parametrize("size", [1, 2, 7, 50, 10_000])
@pytest.mark.parametrize("rows_back", [4, 2])
def test_bucketed_rolling_equals_plain_window(spark, size, rows_back):
    frame = spark.createDataFrame(random_rows(size, 400), "id bigint, g string, d date, v double")
    cut = rolling.with_buckets(frame, ["g"], "d", "id", size)
    got = rolling.rolling_means(cut, ["g"], "d", "id", {"m": "v"}, rows=rows_back)
    order = [F.col("d").asc_nulls_first(), F.col("id")]
    plain = Window.partitionBy("g").orderBy(*order).rowsBetween(1 - rows_back, 0)
    want = frame.withColumn("m", F.avg("v").over(plain))
    assert got.columns == want.columns
    assert quality.symmetric_difference(
        got.withColumn("m", F.round("m", 9)), want.withColumn("m", F.round("m", 9))
    ).count() == 0


def test_buckets_are_small_and_in_order(spark):
    frame = spark.range(3000).select(
        (F.col("id") * 7).alias("id"),
        F.lit("one").alias("g"),
        F.when(F.col("id") < 2000, F.lit(J[3])).otherwise(F.lit(J[4])).alias("d"),
    )
    cut = rolling.with_buckets(frame, ["g"], "d", "id", 100)
    sizes = cut.groupBy(rolling.BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
    first_last = cut.groupBy(rolling.BUCKET).agg(F.min("id").alias("a"), F.max("id").alias("z"))
    spans = sorted((r.a, r.z, r[rolling.BUCKET]) for r in first_last.collect())
    assert all(x[1] < y[0] and x[2] < y[2] for x, y in zip(spans, spans[1:]))


def test_one_day_with_outliers_gives_even_buckets(spark):
    """200,000 rows of one day, their numbers close together but for two."""
    frame = spark.range(200_000).select(
        F.when(F.col("id") == 7, F.lit(10**15)).when(F.col("id") == 8, F.lit(-(10**15))).otherwise(F.col("id")).alias("id"),
        F.lit("one").alias("g"),
        F.lit(J[3]).alias("d"),
        (F.col("id") % 1000).cast("double").alias("v"),
    )
    cut = rolling.with_buckets(frame, ["g"], "d", "id", 20_000)
    sizes = [r["count"] for r in cut.groupBy(rolling.BUCKET).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 22_000 and min(sizes) > 18_000
    assert cut.agg(F.sum(F.size(rolling.LATER))).first()[0] < 10_000
    got = rolling.rolling_means(cut, ["g"], "d", "id", {"m": "v"})
    plain = Window.partitionBy("g").orderBy("d", "id").rowsBetween(-3, 0)
    assert quality.symmetric_difference(got, frame.withColumn("m", F.avg("v").over(plain))).count() == 0


def test_repeated_and_missing_numbers_stay_in_one_part(spark):
    frame = spark.range(500).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("id"), F.lit("one").alias("g"), F.lit(J[3]).alias("d")
    )
    cut = rolling.with_buckets(frame, ["g"], "d", "id", 50)
    assert cut.groupBy("id").agg(F.count_distinct(rolling.BUCKET).alias("n")).where("n > 1").isEmpty()
    assert cut.count() == 500 and cut.where(F.col(rolling.BUCKET).isNull()).isEmpty()
    unnumbered = frame.select(F.lit(None).cast("int").alias("id"), "g", "d", F.lit(2.0).alias("v"))
    cut = rolling.with_buckets(unnumbered, ["g"], "d", "id", 50)
    assert rolling.rolling_means(cut, ["g"], "d", "id", {"m": "v"}).where("m = 2").count() == 500


def test_month_totals_equal_grouped_sums(spark):
    frame = spark.createDataFrame(random_rows(3, 300), "id bigint, g string, d date, v double")
    frame = frame.withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = totals.with_month_totals(frame, ["g"], "d", F.col("v"), "tg", "tm")
    month = F.trunc("d", "MM")
    want = frame.withColumns({
        "tg": F.sum("v").over(Window.partitionBy("g", month)),
        "tm": F.sum("v").over(Window.partitionBy(month)),
    })
    assert quality.symmetric_difference(got, want.select(got.columns)).count() == 0


def test_summary_and_stress(spark):
    rows = [
        auction(1, J[0], qtd_aceita=100),
        auction(2, J[1], qtd_aceita=99, pct_taxa_media=None),
        auction(3, J[2], qtd_oferta=0),
        auction(4, J[3], "NTN", financeiro_aceito=Decimal("2500000000")),
    ]
    frame = refined.enrich(results(spark, *rows), cal(spark), bench(spark))
    summary = refined.summarize_by_title(frame).collect()
    assert [r.titulo for r in summary] == ["NTN", "LFT"]
    lft = summary[1]
    assert (lft.num_leiloes, lft.leiloes_sem_cobertura) == (3, 1)
    assert (lft.data_primeiro_leilao, lft.data_ultimo_leilao) == (J[0], J[2])
    assert (lft.pct_taxa_media_historica, lft.pct_taxa_minima_historica) == (2.0, 1.0)
    assert lft.pct_taxa_maxima_historica == 4.0 and lft.pct_cobertura_media == 0.995
    assert (summary[0].financeiro_total_bi, summary[0].ticket_medio_mi) == (2.5, 2500.0)
    assert lft.prazo_medio_anos == 6.0
    stress = refined.stressed(frame).collect()
    assert [r.num_edital for r in stress] == [4, 2]  # newest first; exactly 1 and null are out
    assert stress[1].pct_delta_vs_rolling is None and stress[1].financeiro_mi == 0.0


def test_enriched_columns(spark):
    frame = refined.enrich(results(spark, auction(1, J[0])), cal(spark), bench(spark))
    assert frame.columns == refined.ENRICHED_COLUMNS and len(frame.columns) == 35
    types = dict(frame.dtypes)
    assert types["pct_cobertura"] == "double" and types["dias_ate_vencimento"] == "bigint"
    for name in ("financeiro_total", "pct_taxa_media_rolling_4", "financeiro_mes_mercado", "spread_pu"):
        assert types[name] == "decimal(38,9)"


def test_published_views_read_the_newest_version(spark, folder):
    lake = Lake(spark, folder, buckets=2)
    entry = (
        '{{"numero_edital":{n},"titulo":"LFT","benchmark":"B","vencimento":"01/01/2030",'
        '"data_leilao":"{d:02}/01/2024","oferta":10,"quantidade_aceita":5,"financeiro_aceito":100}}'
    )
    for run, numbers in enumerate(([1], [1, 2], [1, 2, 3]), start=1):
        at = datetime(2024, 6, run)
        rows = [(entry.format(n=n, d=n), "resultados", "f", at, at.date()) for n in numbers]
        raw.append(spark.createDataFrame(rows, raw.MULTIPLEXED_SCHEMA), lake.path("raw", "tesouro_leiloes"))
        lake.refresh(models.RESULTS, at)
        lake.publish_refined(at)
        assert lake.enriched().count() == len(numbers)
        assert lake.by_title().first().num_leiloes == len(numbers)
        assert lake.stressed().count() == len(numbers)
        other = spark.newSession()
        assert other.sql("SELECT * FROM refined.tesouro_leiloes_stress").count() == len(numbers)
        assert other.sql("SELECT num_leiloes FROM refined.tesouro_leiloes_por_titulo").first()[0] == len(numbers)
        for view, rows in (("por_titulo", refined.summarize_by_title), ("stress", refined.stressed)):
            got, want = spark.table(f"refined.tesouro_leiloes_{view}"), rows(lake.enriched())
            assert got.dtypes == want.dtypes and got.collect() == want.collect()
    import os

    def versions():
        found = os.listdir(f"{folder}/refined/tesouro_leiloes_enriched")
        return sorted(name.split("-")[0] for name in found if name.startswith("version="))

    assert versions() == ["version=20240602T000000", "version=20240603T000000"]
    lake.publish_refined(datetime(2024, 6, 1))  # an older run published last is the live one
    assert versions() == ["version=20240601T000000", "version=20240603T000000"]
    assert lake.enriched().count() == 3


def test_a_large_day_has_as_many_parts_as_it_needs(spark):
    rows = spark.range(300).select(F.lit("g").alias("g"), F.lit(date(2024, 1, 1)).alias("d"), "id")
    places = rolling.place_days(rolling.day_counts(rows, ["g"], "d"), rows, ["g"], "d", "id", 2_000)
    parts = places.select(F.map_keys("__places").alias("parts"), F.size("__bounds").alias("bounds")).first()
    assert sorted(parts.parts) == [0, 1, 2, 3, 4] and parts.bounds == 4
