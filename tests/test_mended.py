"""Cases in which rows were once lost or a plan was unbounded."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from finlake.operators import periods, spine
from finlake.plans import models
from finlake.plans.spec import build
from finlake.sources import envelopes, files, landing, raw

LONG_AGO, TODAY = date(2024, 1, 1), date(2024, 6, 30)


def landed(spark, root, day, text):
    rows = spark.createDataFrame([("e", day, text)], "entity string, day_ date, payload string")
    landing.write(landing.with_path_parts(rows, "day_"), root)


def test_any_range_sees_the_same_files(spark, folder):
    root = f"{folder}/area"
    landed(spark, root, date(2024, 1, 15), "1")
    landed(spark, root, date(2024, 3, 1), "2")
    # A stream's sink keeps its own list of files; a later batch file is not on it.
    files.write_text(spark, f"{folder}/in/x.txt", "3")
    stream = spark.readStream.schema("value string").option("pathGlobFilter", "*.txt").text(f"{folder}/in")
    parts = {"entity": "e", "year": "2024", "month": "01", "day": "20"}
    query = (
        stream.select(F.col("value"), *[F.lit(v).alias(k) for k, v in parts.items()])
        .writeStream.format("csv").option("extension", "jsonl").partitionBy(*parts)
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(root)
    )
    query.awaitTermination()
    found = [
        sorted(r.payload for r in landing.scan(spark, root, date(2024, 1, 1), end).collect())
        for end in (date(2024, 3, 2), date(2024, 3, 3), date(2025, 12, 31))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 2
    assert [r.payload for r in landing.scan(spark, root, date(2024, 3, 1)).collect()] == ["2"]


def test_landing_expires_old_days(spark, folder):
    for day in (date(2024, 3, 31), date(2024, 4, 1), TODAY):
        landed(spark, folder, day, str(day))
    assert len(landing.expire(spark, folder, TODAY, 90)) == 1
    left = landing.scan(spark, folder, LONG_AGO, TODAY).collect()
    assert sorted(r.payload for r in left) == ["2024-04-01", "2024-06-30"]


def test_period_filter_reaches_the_scan(spark, folder):
    days = spark.range(400).select(F.date_add(F.lit(LONG_AGO), F.col("id").cast("int")).alias("d"))
    days.write.parquet(f"{folder}/days")
    rows = spark.read.parquet(f"{folder}/days")
    month = spine.in_period(rows, "d", date(2024, 2, 10))
    assert month.count() == 29 and spine.in_period(rows, "d", date(2024, 2, 10), "yyyy").count() == 366
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2024-02-01)" in plan and "LessThan(d,2024-03-01)" in plan


def test_periods_repeat_a_few_hundred_times_at_most(spark):
    """An open period beside a day in 9999 (the outlier that once made 95,712 rows a period)."""
    rows = spark.createDataFrame(
        [("a", date(2024, 1, 5)), ("a", date(2024, 3, 5)), ("a", date(9999, 12, 31))], "k string, day date"
    )
    terms = [(date(1, 1, 1), date(9999, 12, 31)), (date(1900, 1, 1), date(9999, 12, 31)),
             (date(2024, 2, 28), date(2024, 3, 5)), (TODAY, LONG_AGO), (LONG_AGO, None)]
    open_ended = spark.createDataFrame([("a", *t) for t in terms], "k string, s date, e date")
    joined = periods.interval_join(rows, open_ended, ["k"], "day", "s", "e")
    assert joined.count() == 7
    offered = open_ended.select("s", F.explode(periods.blocks_of_period("s", "e"))).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in offered}[date(2024, 2, 28)] == 2
    assert len(offered) == 3 and max(r["count"] for r in offered) < 200


def test_blocks_of_a_period_cover_its_months_once(spark):
    rng = random.Random(3)
    spans = []
    for i in range(300):
        first = date(1, 1, 1) + timedelta(days=rng.randrange(3_600_000))
        last = date.fromordinal(min(first.toordinal() + int(10 ** rng.uniform(0, 6.5)), date.max.toordinal()))
        spans.append((i, first, last))
    frame = spark.createDataFrame(spans, "i int, s date, e date")
    blocks = frame.select("i", F.inline(periods.blocks_of_period("s", "e"))).collect()
    found = {}
    for r in blocks:
        width = 16**r.level
        found.setdefault(r.i, []).append((r.block * width, (r.block + 1) * width))
    for i, first, last in spans:
        got = sorted(found[i])
        months = [d.year * 12 + d.month - 1 for d in (first, last)]
        assert got[0][0] == months[0] and got[-1][1] == months[1] + 1
        assert all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_unreadable_page_raises_or_is_listed(spark):
    pages = spark.createDataFrame([('{"value":[{"a":1}]}',), ('{"value":[{"a":',), ('{"value":[]}',)], "page string")
    with pytest.raises(Exception, match="unreadable page"):
        envelopes.value_records(pages).collect()
    assert envelopes.value_records(pages, fail_fast=False).count() == 1
    assert envelopes.unreadable_pages(pages).count() == 1


def trades(spark, records):
    at = [datetime(2024, 1, 1, h) for h in range(len(records))]
    data = [(text, "f.jsonl", t, t.date()) for text, t in zip(records, at, strict=True)]
    return spark.createDataFrame(data, raw.PAYLOAD_SCHEMA)


def test_superseded_bad_record_passes(spark):
    bad = '{"e":"trade","E":1,"s":"X","t":7,"p":"abc","q":"1","T":1,"m":true}'
    good = bad.replace("abc", "2.5").replace('"E":1', '"E":2').replace('"T":1', '"T":2')
    run_at = datetime(2024, 1, 2)
    kept = build(trades(spark, [bad, good]), models.TRADES, run_at).collect()
    assert len(kept) == 1
    with pytest.raises(Exception, match="do not fit"):
        build(trades(spark, [bad]), models.TRADES, run_at).collect()
    assert build(trades(spark, [bad]), models.TRADES, run_at, strict=False).count() == 1


def test_incomplete_entities_are_counted(spark):
    runs = spark.range(25).select(F.col("id").cast("string").alias("e"), F.lit(3).alias("old_gaps"))
    with pytest.raises(RuntimeError, match="and 5 more"):
        spine.require_complete(runs, "e")
