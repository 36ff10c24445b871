"""Physical plans: what is pushed down, what is reduced before a shuffle."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from finlake.operators import merge, quality, totals
from finlake.operators.latest import latest
from finlake.plans import models, refined
from finlake.plans.spec import build
from finlake.sources import landing, raw
from workloads import standins as S

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_reduces_before_the_shuffle(spark):
    text = plan(latest(S.read(spark, SF, "lineitem"), ["l_orderkey"], [F.desc("l_shipdate")]))
    kinds = re.findall(r"WindowGroupLimit .*?(Partial|Final)", text)
    assert kinds == ["Final", "Partial"]
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def stored_raw(spark, folder):
    path = f"{folder}/raw"
    raw.append(S.raw_trades(spark, SF), path)
    return raw.read(spark, path)


def test_payloads_are_parsed_once(spark, folder):
    text = plan(build(stored_raw(spark, folder), models.TRADES, datetime(2024, 6, 1)))
    assert text.count("parseJson") == 1
    assert "WindowGroupLimit" in text


def test_load_window_prunes_partitions(spark, folder):
    rows = stored_raw(spark, folder)
    text = plan(build(rows, models.TRADES, datetime(2024, 6, 1), date(2024, 1, 20), incremental=True))
    filters = re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)
    assert "_load_date" in filters
    scan = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert scan == "payload:string,_ingested_at:timestamp"


def test_endpoint_filter_reaches_the_scan(spark, folder):
    path = f"{folder}/raw"
    rows = S.raw_trades(spark, SF).withColumn(raw.ENDPOINT, F.lit("dealers"))
    raw.append(rows, path)
    text = plan(build(raw.read(spark, path, multiplexed=True), models.DEALERS, datetime(2024, 6, 1)))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(endpoint_name,dealers\)", text)


def test_landing_entity_and_day_are_partition_filters(spark, folder):
    frame = spark.createDataFrame([("a", date(2024, 5, 1), "x")], "entity string, d date, payload string")
    landing.write(landing.with_path_parts(frame, "d"), folder)
    text = plan(landing.scan(spark, folder, date(2024, 1, 1), date(2024, 12, 31), entities=["a"]))
    filters = re.search(r"PartitionFilters: \[(.*)\], PushedFilters", text).group(1)
    assert "entity" in filters and "year" in filters


def write(frame, path):
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def test_no_window_of_auctions_spans_a_whole_group(spark, folder):
    """Windows over auction rows are cut into buckets; the others see reduced rows."""
    results = write(S.auctions(spark, SF), f"{folder}/a")
    calendar = write(S.calendar(spark, SF), f"{folder}/c")
    terms = write(S.periods(spark, SF), f"{folder}/p")
    frame = refined.enrich(results, calendar, terms)
    text = optimized(frame)
    assert "Cartesian" not in plan(frame) and "BroadcastNestedLoop" not in plan(frame)
    wide = [line for line in text.splitlines() if "Window [" in line and "pct_taxa_media" in line]
    assert wide and all("__bucket_of_frame" in line for line in wide)
    # Auctions are read by the job that wrote the slots, and once by this plan.
    assert plan(frame).count(f"{folder}/a]") == 1
    assert not re.search(r"Exchange SinglePartition(?!.*RoundRobin)", plan(frame))


def test_nothing_is_broadcast_by_hint(spark):
    frame = totals.with_month_totals(
        S.auctions(spark, SF), ["titulo"], "data_leilao", refined.total_amount(), "a", "b"
    )
    hints = [line for line in frame._jdf.queryExecution().analyzed().toString().splitlines() if "Hint" in line]
    assert not hints


def test_summary_and_checks_aggregate_before_the_shuffle(spark):
    lines = S.read(spark, SF, "lineitem")
    for frame in (
        quality.duplicate_keys(lines, ["l_orderkey"]),
        lines.groupBy("l_returnflag").agg(F.sum("l_quantity")),
    ):
        assert re.search(r"partial_(count|sum)", plan(frame))
    assert "partial_count" in plan(quality.null_counts(lines, ["l_orderkey", "l_shipdate"]))


def test_null_keys_do_not_meet_in_the_join(spark):
    keys = ["k"]
    target = spark.createDataFrame([(None, 1), (1, 2)], "k bigint, v bigint")
    text = optimized(merge.unmatched(target, target, keys, null_safe=False))
    assert "Join LeftAnti" in text and "isnotnull(k" in text and "Union" in text


def test_typed_columns_only(spark, folder):
    text = plan(build(stored_raw(spark, folder), models.TRADES, datetime(2024, 6, 1)))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.fixture
def no_broadcast_small_skew(spark):
    """Settings that make AQE treat small test data as it treats large partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_slot_with_a_third_of_the_auctions_is_split(spark, folder, no_broadcast_small_skew):
    rows = S.auctions(spark, "/root/testdata/sf0.01")
    hot = F.col("num_edital") % 3 == 0
    slot = {
        "titulo": F.lit("HOT"),
        "data_leilao": F.lit(date(1998, 5, 5)),
        "data_vencimento": F.lit(date(2001, 1, 1)),
        "tipo_leilao": F.lit("Venda"),
    }
    rows = rows.withColumns({c: F.when(hot, v).otherwise(F.col(c)) for c, v in slot.items()})
    results = write(rows.repartition(8), f"{folder}/a")
    frame = refined.enrich(
        results,
        write(S.calendar(spark, SF), f"{folder}/c"),
        write(S.periods(spark, SF), f"{folder}/p"),
        rows_per_bucket=500,
    )
    counted = frame.agg(*(F.max(c) for c in frame.columns))
    counted.collect()
    final = plan(counted).split("== Initial Plan ==")[0]
    joins = [line for line in final.splitlines() if "SortMergeJoin(skew=true)" in line]
    assert len(joins) == 1  # the join of the slots' facts


def test_merge_lookup_is_limited_to_the_key_range(spark):
    batch = spark.createDataFrame([(5, "b"), (9, "d"), (7, None)], "k bigint, s string")
    target = spark.range(100).select(F.col("id").alias("k"), F.lit("c").alias("s"))
    found = target.where(merge._in_range_of(batch, ["k", "s"]))
    assert [r.k for r in found.orderBy("k").collect()] == [5, 6, 7, 8, 9]
    assert "k" in optimized(found) and ">= 5" in optimized(found) and "<= 9" in optimized(found)
