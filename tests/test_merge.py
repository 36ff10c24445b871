"""Upserts, their properties, and tables refreshed in place."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from finlake.operators import merge
from finlake.operators.quality import symmetric_difference
from finlake.plans import models
from finlake.plans.tables import LAYERS, Lake, create_layers, qualified
from finlake.sources import files, raw, versions

SCHEMA = "k1 bigint, k2 string, v bigint"
KEYS = ["k1", "k2"]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=repr)


def expected_upsert(target, batch, null_safe):
    def matched(key):
        return any(
            r[:2] == key and (null_safe or None not in key) for r in batch
        )

    return sorted([r for r in target if not matched(r[:2])] + batch, key=repr)


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_matches_plain_rule_and_is_idempotent(spark, null_safe, seed):
    rng = random.Random(seed)

    def some(n):
        found = {}
        for _ in range(n):
            key = (rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]))
            found[key] = rng.randrange(100)
        return [(*key, v) for key, v in found.items()]

    target, batch = some(8), some(6)
    t, b = frame(spark, target), frame(spark, batch)
    once = merge.upsert(t, b, KEYS, null_safe)
    assert rows_of(once) == expected_upsert(target, batch, null_safe)
    if null_safe:
        assert symmetric_difference(once, merge.upsert(once, b, KEYS)).count() == 0


def test_null_keys_pile_up_only_with_plain_equality(spark):
    target, batch = frame(spark, [(1, None, 1)]), frame(spark, [(1, None, 2)])
    assert rows_of(merge.upsert(target, batch, KEYS)) == [(1, None, 2)]
    assert rows_of(merge.upsert(target, batch, KEYS, null_safe=False)) == [(1, None, 1), (1, None, 2)]


def test_single_key_name(spark):
    assert merge.key_list("a") == ["a"] and merge.key_list(("a", "b")) == ["a", "b"]
    t, b = frame(spark, [(1, "a", 1), (2, "a", 1)]), frame(spark, [(2, "b", 5)])
    assert rows_of(merge.upsert(t, b, "k1")) == [(1, "a", 1), (2, "b", 5)]


def test_newest_wins_in_any_batch_order(spark):
    batches = [frame(spark, [(1, "a", v), (2, "b", 10 - v)]) for v in (3, 9, 5)]
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        table = frame(spark, [])
        for i in order:
            table = merge.upsert_newest(table, batches[i], KEYS, "v")
        assert rows_of(table) == [(1, "a", 9), (2, "b", 7)]


DAY_SCHEMA = "id bigint, day date, v string"


def merge_days(spark, path, rows, **kw):
    return merge.merge_into(spark, path, frame(spark, rows, DAY_SCHEMA), "id", "day", **kw)


def table(spark, path):
    return rows_of(versions.read(spark, path), "id", "day", "v")


D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def folders(spark, path):
    return versions.current(spark, path).folders


def test_table_merge_moves_rows_between_days(spark, folder):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, D1, "a"), (2, D1, "b"), (3, D2, "c"), (4, D3, "d")])
    untouched = folders(spark, path)["day=2024-01-03"]
    done = merge_days(spark, path, [(3, D1, "moved"), (1, D1, "new"), (5, D2, "e")])
    assert done == merge.Merged(("day=2024-01-01", "day=2024-01-02"), 3, 3)
    assert table(spark, path) == [
        (1, D1, "new"), (2, D1, "b"), (3, D1, "moved"), (4, D3, "d"), (5, D2, "e"),
    ]
    assert folders(spark, path)["day=2024-01-03"] == untouched
    merge_days(spark, path, [(5, D1, "e2")])  # the last row of a day leaves it
    assert table(spark, path) == [
        (1, D1, "new"), (2, D1, "b"), (3, D1, "moved"), (4, D3, "d"), (5, D1, "e2"),
    ]
    assert "day=2024-01-02" not in folders(spark, path)
    merge_days(spark, path, [])
    assert len(table(spark, path)) == 5


def test_null_partition(spark, folder):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, None, "a"), (2, D1, "b")])
    merge_days(spark, path, [(1, D1, "a2"), (3, None, "c")])
    assert table(spark, path) == [(1, D1, "a2"), (2, D1, "b"), (3, None, "c")]


class Lost(RuntimeError):
    """The driver is gone."""


def lost(*_, **__):
    raise Lost


@pytest.mark.parametrize("first", [True, False])
def test_a_cut_write_changes_nothing(spark, folder, monkeypatch, first):
    path = f"{folder}/t"
    before = None if first else [(1, D1, "a"), (2, D2, "b")]
    if not first:
        merge_days(spark, path, before)
    for step in ("publish", "write"):
        with monkeypatch.context() as patched:
            patched.setattr(versions, step, lost)
            with pytest.raises(Lost):
                merge_days(spark, path, [(1, D1, "cut"), (9, D3, "cut")])
        assert (versions.current(spark, path) is None) if first else table(spark, path) == before
    merge_days(spark, path, [(4, D2, "d")])
    assert table(spark, path) == [*(before or []), (4, D2, "d")]
    # What the cut runs left behind is gone after the next two commits.
    merge_days(spark, path, [(4, D2, "e")])
    merge_days(spark, path, [(4, D2, "f")])
    used = {f.split("/")[0] for f in folders(spark, path).values()}
    assert len([v for v in os.listdir(path) if v.startswith("_version=")]) <= len(used) + 1


def test_half_copied_first_build_leaves_nothing(spark, folder):
    """A store that copies file by file, cut after any number of files and in the manifest itself."""
    whole = f"{folder}/whole"
    rows = [(i, D1 + timedelta(days=i % 5), "x") for i in range(100)]
    merge_days(spark, whole, rows)
    found = []
    for root, _, names in os.walk(whole):
        found += [os.path.relpath(f"{root}/{n}", whole) for n in names]
    # Data first, the manifest last, as they are written.
    found.sort(key=lambda f: (f.startswith(versions.MANIFESTS), f))
    for cut in (1, len(found) // 2, len(found) - 2, len(found)):
        part = f"{folder}/cut{cut}"
        for name in found[:cut]:
            os.makedirs(os.path.dirname(f"{part}/{name}"), exist_ok=True)
            with open(f"{whole}/{name}", "rb") as source, open(f"{part}/{name}", "wb") as copy:
                copy.write(source.read())
        state = versions.current(spark, part)
        assert (len(table(spark, part)) == 100) if cut == len(found) else state is None
        merge_days(spark, part, rows[:3] if state else rows)
        assert len(table(spark, part)) == 100
    manifest = f"{whole}/{versions.MANIFESTS}/{1:012d}"
    text = open(manifest).read()
    os.remove(f"{whole}/{versions.MANIFESTS}/.{1:012d}.crc")
    with open(manifest, "w") as out:
        out.write(text[: len(text) // 2])
    assert versions.current(spark, whole) is None
    merge_days(spark, whole, rows)
    assert len(table(spark, whole)) == 100


def test_second_writer_raises(spark, folder, monkeypatch):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, D1, "a")])
    real = versions.write

    def overtaken(rows, target, partition):
        made = real(rows, target, partition)
        monkeypatch.setattr(versions, "write", real)
        merge_days(spark, path, [(2, D1, "other")])
        return made

    monkeypatch.setattr(versions, "write", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        merge_days(spark, path, [(3, D1, "late")])
    assert table(spark, path) == [(1, D1, "a"), (2, D1, "other")]


def test_recent_batch_writes_few_partitions(spark, folder):
    """200 changed of 5,000 records: under a tenth of the partitions, once, by month or range of the key."""
    first = date(2019, 1, 1)
    schema = "day date, kind string, v string"
    rows = [(first + timedelta(days=i // 3), "abc"[i % 3], "x") for i in range(5_000)]
    batch = [(day, kind, "new") for day, kind, _ in rows[-200:]]
    path = f"{folder}/months"
    by_month = lambda r: frame(spark, r, schema).withColumn("_m", merge.month_of_key("day"))
    merge.merge_into(spark, path, by_month(rows), ["day", "kind"], "_m", key_fixes_partition=True)
    before = folders(spark, path)
    done = merge.merge_into(spark, path, by_month(batch), ["day", "kind"], "_m", key_fixes_partition=True)
    assert len(done.touched) < done.after / 10 and done.after == done.before
    changed = {name for name, place in folders(spark, path).items() if before[name] != place}
    assert changed == set(done.touched)
    assert versions.read(spark, path).groupBy("v").count().collect() and table_count(spark, path, "new") == 200

    path = f"{folder}/ranges"
    by_range = lambda lo, hi, v: spark.range(lo, hi).select(
        "id", F.lit(v).alias("v"), merge.range_of_key("id", 100).alias("_r"))
    merge.merge_into(spark, path, by_range(0, 5_000, "x"), "id", "_r", key_fixes_partition=True)
    done = merge.merge_into(spark, path, by_range(4_850, 5_050, "new"), "id", "_r", key_fixes_partition=True)
    assert len(done.touched) == 3 and done.after == 51
    assert table_count(spark, path, "new") == 200 and versions.read(spark, path).count() == 5_050


def table_count(spark, path, value):
    return versions.read(spark, path).where(F.col("v") == value).count()


def test_readers_of_the_version_before_finish(spark, folder):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, D1, "a"), (2, D2, "b")])
    old = versions.read(spark, path)
    merge_days(spark, path, [(1, D1, "new")])
    assert rows_of(old, "id", "v") == [(1, "a"), (2, "b")]


def test_merge_without_success_marker(spark, folder):
    path = f"{folder}/t"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        merge_days(spark, path, [(1, D1, "a")])
        merge_days(spark, path, [(2, D2, "b"), (1, D1, "a2")])
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not os.path.exists(f"{path}/_SUCCESS")
    assert table(spark, path) == [(1, D1, "a2"), (2, D2, "b")]


def test_foreign_data_and_other_layout_are_refused(spark, folder):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, D1, "a")])
    with pytest.raises(ValueError, match="layout"):
        merge.merge_into(spark, path, frame(spark, [(2, D1, "b")], DAY_SCHEMA), "id", "day", layout="buckets=8")
    path = f"{folder}/plain"
    frame(spark, [(1, D1, "a")], DAY_SCHEMA).write.partitionBy("day").parquet(path)
    with pytest.raises(ValueError, match="no manifest"):
        merge_days(spark, path, [(2, D2, "b")])
    versions.adopt(spark, path, T.StructField("day", T.DateType()))
    merge_days(spark, path, [(2, D2, "b")])
    assert table(spark, path) == [(1, D1, "a"), (2, D2, "b")]


def test_emptied_partition_with_escaped_name_is_removed(spark, folder):
    path = f"{folder}/t"
    for rows in ([(1, "a:b/c", "x"), (2, "d", "y")], [(1, "d", "z")]):
        merge.merge_into(spark, path, frame(spark, rows, "id bigint, part string, v string"), "id", "part")
    found = versions.read(spark, path).orderBy("id").collect()
    assert [(r.id, r.part, r.v) for r in found] == [(1, "d", "z"), (2, "d", "y")]


def test_schema_drift_is_refused(spark, folder):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, D1, "a")])
    wider = frame(spark, [(1, D1, "a", 1)], DAY_SCHEMA + ", extra int")
    retyped = frame(spark, [(1, D1, 5)], "id bigint, day date, v int")
    for batch in (wider, retyped):
        with pytest.raises(ValueError, match="schema drift"):
            merge.merge_into(spark, path, batch, "id", "day")
    assert table(spark, path) == [(1, D1, "a")]


def test_newer_stored_row_stays(spark, folder):
    path = f"{folder}/t"
    merge_days(spark, path, [(1, D1, "b")])
    merge_days(spark, path, [(1, D2, "a"), (2, D2, "x")], newer_by="v")
    assert table(spark, path) == [(1, D1, "b"), (2, D2, "x")]


def payload_rows(spark, entries):
    """(report number, name, load moment)"""
    data = [
        (f'{{"NumeroRelatorio":{n},"NomeRelatorio":"{name}"}}', "f.jsonl", at, at.date())
        for n, name, at in entries
    ]
    return spark.createDataFrame(data, raw.PAYLOAD_SCHEMA)


def test_lake_first_build_lookback_and_backfill(spark, folder):
    lake = Lake(spark, folder, buckets=4)
    spec = models.REPORTS
    path = lake.path("raw", spec.source)
    now = datetime(2024, 5, 10, 3, 0)
    old = now - timedelta(days=30)
    raw.append(payload_rows(spark, [(1, "one", old), (2, "two", old), (1, "uno", now - timedelta(days=3))]), path)
    lake.refresh(spec, now)
    names = lambda: {r.num_relatorio: r.nome_relatorio for r in lake.trusted(spec).collect()}
    assert names() == {1: "uno", 2: "two"}
    assert lake.trusted(spec).schema.fieldNames() == spec.schema().fieldNames()

    raw.append(payload_rows(spark, [(2, "dois", now - timedelta(days=2)), (3, "três", now - timedelta(days=5))]), path)
    lake.refresh(spec, now)
    assert names() == {1: "uno", 2: "dois"}  # 3 lies before the lookback window
    lake.refresh(spec, now, start_date=(now - timedelta(days=5)).date())
    assert names() == {1: "uno", 2: "dois", 3: "três"}
    lake.refresh(spec, now)
    assert names() == {1: "uno", 2: "dois", 3: "três"}


def test_lake_checks_stop_the_run(spark, folder):
    lake = Lake(spark, folder, buckets=2)
    spec = models.ANNOUNCEMENTS
    rows = spark.createDataFrame(
        [('{"TITULO":"sem link"}', "comunicados", "f", datetime(2024, 5, 1), date(2024, 5, 1))],
        raw.MULTIPLEXED_SCHEMA,
    )
    raw.append(rows, lake.path("raw", spec.source))
    with pytest.raises(ValueError, match="not_null:link"):
        lake.refresh(spec, datetime(2024, 5, 2))


TRADE = '{{"e":"trade","E":{e},"s":"X","t":{t},"p":"{p}","q":"1","T":{at},"m":true}}'
DAY = 86_400_000


def trade_rows(spark, now, *entries):
    data = [(text, f"f{i}.jsonl", now, now.date()) for i, text in enumerate(entries)]
    return spark.createDataFrame(data, raw.PAYLOAD_SCHEMA)


def test_failed_checks_leave_the_table_as_it_was(spark, folder):
    lake, spec = Lake(spark, folder), models.TRADES
    path, now = lake.path("raw", spec.source), datetime(2024, 5, 10, 3, 0)
    raw.append(trade_rows(spark, now, TRADE.format(e=1, t=1, p=10, at=DAY)), path)
    done = lake.refresh(spec, now)
    assert (done.payloads, done.malformed, done.quarantined, done.merged.after) == (1, 0, 0, 1)
    raw.append(trade_rows(spark, now, TRADE.format(e=2, t=1, p=11, at=DAY).replace('"p":"11",', "")), path)
    with pytest.raises(ValueError, match="not_null:price"):
        lake.refresh(spec, now)
    assert [(r.trade_id, float(r.price)) for r in lake.trusted(spec).collect()] == [(1, 10.0)]


def test_quarantine_keeps_bad_records_and_goes_on(spark, folder):
    lake, spec = Lake(spark, folder), models.TRADES
    path, now = lake.path("raw", spec.source), datetime(2024, 5, 10, 3, 0)
    bad_price, bad_key = TRADE.format(e=5, t=1, p="abc", at=DAY), TRADE.format(e=5, t='"x1"', p=3, at=DAY)
    bad_order = TRADE.format(e='"soon"', t=4, p=3, at=DAY)
    raw.append(
        trade_rows(
            spark, now, TRADE.format(e=1, t=1, p=10, at=DAY), bad_price, bad_key, bad_order, "{broken",
            TRADE.format(e=1, t=2, p="old", at=DAY), TRADE.format(e=2, t=2, p=7, at=DAY),
        ),
        path,
    )
    with pytest.raises(Exception):
        lake.refresh(spec, now)
    assert not lake.is_built(spec)
    for _ in range(2):  # a repeated run finds the same payloads and keeps each once
        done = lake.refresh(spec, now, quarantine=True)
        assert (done.payloads, done.malformed, done.quarantined) == (7, 1, 4)
        # The newest record of trade 1 does not fit, so the trade waits for its correction.
        assert [(r.trade_id, float(r.price)) for r in lake.trusted(spec).collect()] == [(2, 7.0)]
        kept = {r.payload: r.reasons for r in lake.quarantined(spec).collect()}
        assert kept == {
            bad_price: ["price: not numeric"], bad_key: ["trade_id: not integer"],
            bad_order: ["event_time: not epoch_millis"], "{broken": ["malformed payload"],
        }
    assert lake.quarantined().count() == 4 and lake.quarantined(models.DEALERS).count() == 0
    assert lake.quarantined().schema["reasons"].dataType == T.ArrayType(T.StringType())


def test_refresh_of_an_empty_source(spark, folder):
    lake = Lake(spark, folder)
    for quarantine in (False, True):
        done = lake.refresh(models.REPORTS, datetime(2024, 5, 10), quarantine=quarantine)
        assert (done.payloads, done.quarantined, done.merged.after) == (0, 0, 0)
    assert lake.trusted(models.REPORTS).count() == 0 and lake.quarantined().count() == 0


def test_bounds_of_stored_columns_prune_folders(spark, folder):
    lake, now = Lake(spark, folder), datetime(2024, 5, 10)
    start = 1_704_067_200_000  # 2024-01-01
    entries = [TRADE.format(e=i, t=i, p=1, at=start + i * DAY // 2) for i in range(100)]
    raw.append(trade_rows(spark, now, *entries), lake.path("raw", models.TRADES.source))
    lake.refresh(models.TRADES, now)
    first, last = datetime(2024, 1, 10, 12), datetime(2024, 1, 12)
    found = lake.trusted(models.TRADES, first, last)
    assert sorted(r.trade_id for r in found.collect()) == [19, 20, 21, 22]
    text = found._jdf.queryExecution().executedPlan().toString()
    pruned = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "_partition_day" in pruned and "2024-01-10" in pruned and "2024-01-12" in pruned
    assert len({r[0] for r in found.select(F.input_file_name()).collect()}) <= 3
    raw.append(
        payload_rows(spark, [(n, "r", datetime(2024, 5, 10)) for n in range(0, 9_000, 500)]),
        lake.path("raw", models.REPORTS.source),
    )
    lake.refresh(models.REPORTS, now)
    found = lake.trusted(models.REPORTS, first=4_000, last=4_500)
    assert sorted(r.num_relatorio for r in found.collect()) == [4_000, 4_500]
    with pytest.raises(ValueError, match="hash"):
        lake.trusted(models.ANNOUNCEMENTS, first=1)


def test_layers_and_comments(spark, folder):
    assert qualified("trusted", "t") == "trusted.t" and qualified(None, "t") == "default.t"
    create_layers(spark)
    assert set(LAYERS) <= {row.name for row in spark.catalog.listDatabases()}
    lake = Lake(spark, folder, buckets=2)
    raw.append(payload_rows(spark, [(1, "one", datetime(2024, 5, 1))]), lake.path("raw", models.REPORTS.source))
    lake.refresh(models.REPORTS, datetime(2024, 5, 2))
    lake.describe_trusted(models.REPORTS)
    name = "trusted.bacen_ifdata_lista_relatorio"
    columns = {c.name: c.description for c in spark.catalog.listColumns(name)}
    assert columns["num_relatorio"] == "report number"
    assert spark.table(name).count() == 1
    assert "Catalogue of available reports." in str(spark.sql(f"DESCRIBE EXTENDED {name}").collect())
    spark.sql(f"DROP TABLE {name}")


def test_key_bucket_is_stable(spark):
    df = frame(spark, [(1, "a", 1), (1, "a", 2), (None, None, 3)])
    buckets = [r[0] for r in df.select(merge.bucket_of(KEYS, 8)).collect()]
    assert buckets[0] == buckets[1] and all(0 <= b < 8 for b in buckets)
    assert isinstance(df.select(merge.bucket_of(KEYS, 8).alias("b")).schema["b"].dataType, T.IntegerType)


def test_order_of_batches_does_not_matter_for_disjoint_keys(spark):
    base = frame(spark, [(i, "a", 0) for i in range(5)])
    one, two = frame(spark, [(1, "a", 1), (9, "x", 1)]), frame(spark, [(2, "a", 2), (8, "x", 2)])
    ab = merge.upsert(merge.upsert(base, one, KEYS), two, KEYS)
    ba = merge.upsert(merge.upsert(base, two, KEYS), one, KEYS)
    assert symmetric_difference(ab, ba).where(F.lit(True)).count() == 0


def test_ranges_of_many_keys_are_few_and_in_order(spark):
    numbers = [*range(-600, 600), *(s * 2**k + d for k in range(10, 60) for s in (-1, 1) for d in (-1, 0, 1))]
    rows = frame(spark, [(n,) for n in numbers], "n bigint").select("n", merge.range_of_key("n", 1).alias("r"))
    exact = [r for r in rows.collect() if abs(r.n) < 2**53]  # a range comes from a division of doubles
    assert all(r.r == merge.first_range(r.n) for r in exact)
    places = [r.r for r in sorted(exact, key=lambda r: r.n)]
    assert places == sorted(places)
    assert merge.first_range(127) == 127 and merge.first_range(-128) == -128
    assert spark.range(5_400_000).select(merge.range_of_key("id", 100)).distinct().count() < 800
    assert frame(spark, [(None,)], "n bigint").select(merge.range_of_key("n", 1).alias("r")).first().r is None
