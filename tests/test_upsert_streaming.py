import datetime as dt
import os
import tempfile

import pyarrow.parquet as pq

from hearth.operators import upsert
from hearth.schemas import LISTING_SCHEMA
from hearth.sources import adapters
from hearth.streaming import listings as S
from tests.conftest import SF_SMALL, rows

T0 = dt.datetime(2024, 1, 1)


def obs(i, title, rent, rooms=2, pet=False, day=0):
    t = T0 + dt.timedelta(days=day)
    return (i, title, rent, "X", rooms, pet, t, t)


def test_update_on_conflict_changes_only_rent_and_last_seen(spark):
    target = upsert.rollup_observations(spark.createDataFrame([obs(1, "a", 100.0, rooms=2, day=0)], LISTING_SCHEMA))
    batch = spark.createDataFrame([obs(5, "a", 120.0, rooms=3, pet=True, day=2), obs(6, "a", 130.0, rooms=4, day=3),
                                   obs(7, "b", 90.0, rooms=1, day=3), obs(8, "b", 95.0, rooms=5, day=4)],
                                  LISTING_SCHEMA)
    out = {r["title"]: r for r in upsert.upsert_update(target, batch).collect()}
    a, b = out["a"], out["b"]
    assert (a["id"], a["monthly_rent_eur"], a["rooms"], a["is_pet_friendly"]) == (1, 130.0, 2, False)
    assert a["first_seen"] == T0 and a["last_seen"] == T0 + dt.timedelta(days=3)
    assert (b["id"], b["monthly_rent_eur"], b["rooms"]) == (7, 95.0, 1)


def test_ignore_on_conflict(spark):
    target = spark.createDataFrame([obs(1, "a", 100.0)], LISTING_SCHEMA)
    batch = spark.createDataFrame([obs(2, "a", 999.0), obs(4, "c", 10.0), obs(3, "c", 20.0)], LISTING_SCHEMA)
    out = rows(upsert.upsert_ignore(target, batch), "id", "title", "monthly_rent_eur")
    assert out == [(1, "a", 100.0), (3, "c", 20.0)]


def test_multi_batch_stream_equals_batch_rollup(spark):
    src = tempfile.mkdtemp(prefix="hearth-events-")
    table = pq.read_table(f"{SF_SMALL}/events.parquet")
    n = table.num_rows
    for i, start in enumerate(range(0, n, n // 3 + 1)):
        pq.write_table(table.slice(start, n // 3 + 1), os.path.join(src, f"events.parquet.{i}"))
    # a directory with several files → several micro-batches
    stream_dir = tempfile.mkdtemp(prefix="hearth-stream-src-")
    for i, f in enumerate(sorted(os.listdir(src))):
        to = os.path.join(stream_dir, f.replace("events.parquet.", "part-") + ".parquet")
        os.rename(os.path.join(src, f), to)
        os.utime(to, (1_000_000 + i, 1_000_000 + i))  # the source takes files by their time

    def one_file_at_a_time(spark_, d, max_files=None):
        schema = spark_.read.parquet(f"{SF_SMALL}/events.parquet").schema
        return adapters.observations_from_events(
            spark_.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))

    orig = S.observation_stream
    S.observation_stream = one_file_at_a_time
    try:
        from hearth.session import work_dir
        root = S.run_upsert_stream(spark, stream_dir, work_dir(spark, "t-upsert"))
        cur = S.run_current_view(spark, stream_dir, work_dir(spark, "t-current"))
    finally:
        S.observation_stream = orig
    from hearth.operators import validation
    expect = rows(upsert.rollup_observations(validation.not_null_rows(adapters.observations(spark, SF_SMALL))))
    assert rows(S.read_snapshot(spark, root)) == expect
    assert rows(S.read_current_view(spark, cur)) == expect
    assert rows(S.read_current_view(spark, cur, batch_id=0)) != expect  # the state of an earlier batch
    log = spark.read.parquet(f"{root}/_log")
    assert log.select("batch_id").distinct().count() == 3


def test_replayed_batch_is_not_rewritten(spark):
    from hearth.session import work_dir
    root = work_dir(spark, "t-replay")
    b0 = spark.createDataFrame([obs(1, "a", 100.0, day=0)], LISTING_SCHEMA)
    b1 = spark.createDataFrame([obs(2, "a", 150.0, day=1)], LISTING_SCHEMA)
    S.apply_upsert_batch(spark, root, b0, 0)
    S.apply_upsert_batch(spark, root, b1, 1)
    S.apply_upsert_batch(spark, root, b1.withColumn("monthly_rent_eur", b1.monthly_rent_eur * 10), 1)  # replay
    assert spark.read.parquet(f"{root}/_log").count() == 2
    assert rows(S.read_snapshot(spark, root), "id", "monthly_rent_eur") == [(1, 150.0)]


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_a_batch_rewrites_only_the_buckets_it_hits(spark, tmp_path):
    root = f"{tmp_path}/t"
    many = spark.createDataFrame([obs(i, f"t{i}", float(i)) for i in range(400)], LISTING_SCHEMA)
    S.apply_upsert_batch(spark, root, many, 0, buckets=16)
    before = files(f"{root}/data")
    assert len(before) == 16 and S.read_snapshot(spark, root).count() == 400
    S.apply_upsert_batch(spark, root, spark.createDataFrame([obs(500, "t7", 99.0, day=1), obs(501, "new", 5.0, day=1)], LISTING_SCHEMA), 1)
    after = files(f"{root}/data")
    assert 1 <= len(set(after) - set(before)) <= 2 and all(after[f] == before[f] for f in before)  # 2 keys: 2 files at most
    out = {r["title"]: r["monthly_rent_eur"] for r in S.read_snapshot(spark, root).collect()}
    assert len(out) == 401 and out["t7"] == 99.0 and out["new"] == 5.0 and out["t8"] == 8.0
    assert S.table_buckets(spark, root) == 16  # a table keeps its number of buckets
    S.apply_upsert_batch(spark, root, spark.createDataFrame([], LISTING_SCHEMA), 2)
    assert S.is_committed(spark, root, 2) and S.read_snapshot(spark, root).count() == 401
    for n in (3, 4):  # the same bucket again and again: its last two versions stay
        S.apply_upsert_batch(spark, root, spark.createDataFrame([obs(600 + n, "t7", 100.0 + n, day=n)], LISTING_SCHEMA), n)
    mine = [p for p in files(f"{root}/data") if "bucket=" + S.latest_paths(spark, root)[[b for b, p in S.latest_paths(spark, root).items()
            if p.startswith(f"{root}/data/v0000000004")][0]].split("bucket=")[1] + "/" in p]
    assert len(mine) == S.KEPT_VERSIONS


def test_an_unlogged_partial_write_is_redone(spark, tmp_path):
    """Files of a batch that died before its log row are overwritten by the replay, and not read before."""
    root = f"{tmp_path}/t"
    S.apply_upsert_batch(spark, root, spark.createDataFrame([obs(1, "a", 100.0)], LISTING_SCHEMA), 0)
    junk = spark.createDataFrame([obs(9, "a", 1.0)], LISTING_SCHEMA).select(*upsert.TABLE_COLUMNS)
    for b in range(S.BUCKETS):
        junk.write.parquet(f"{root}/data/v0000000001/bucket={b}")
    assert rows(S.read_snapshot(spark, root), "id", "monthly_rent_eur") == [(1, 100.0)]
    S.apply_upsert_batch(spark, root, spark.createDataFrame([obs(2, "a", 150.0, day=1), obs(3, "b", 7.0)], LISTING_SCHEMA), 1)
    assert rows(S.read_snapshot(spark, root), "id", "monthly_rent_eur") == [(1, 150.0), (3, 7.0)]


def run_sessions(spark, tmp_path, batches):
    """The alerts of a stream whose files arrive one batch after the other."""
    src, root = tmp_path / "src", f"{tmp_path}/out"
    src.mkdir(parents=True)
    schema = "id long, title string, neighborhood string, monthly_rent_eur double, rooms int, last_seen timestamp_ntz"
    for n, batch in enumerate(batches):
        data = [(i, t, "Complexul", float(100 + i), 2, T0 + dt.timedelta(hours=h)) for i, t, h in batch]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(src / f"b{n}"))
        os.utime(src / f"b{n}", (n + 1, n + 1))
        for f in os.listdir(src / f"b{n}"):
            if f.endswith(".parquet"):
                os.rename(src / f"b{n}" / f, src / f"{n:03d}.parquet")
                os.utime(src / f"{n:03d}.parquet", (1_000_000 + n, 1_000_000 + n))
        for f in os.listdir(src / f"b{n}"):
            os.remove(src / f"b{n}" / f)
        os.rmdir(src / f"b{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = (S.alert_sessions(stream, "24 hours", "48 hours").writeStream.format("parquet").option("path", f"{root}/a")
         .option("checkpointLocation", f"{root}/c").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return rows(spark.read.parquet(f"{root}/a"), "id", "title", "hits")


def test_sessions_do_not_depend_on_batches_and_late_rows_go(spark, tmp_path):
    S._use_rocksdb(spark)
    hits = [(1, "a", 0), (2, "a", 10), (3, "a", 30), (4, "a", 60), (5, "b", 5), (6, "b", 5), (7, "a", 82), (8, "z", 300)]
    want = [(1, "a", 3), (4, "a", 2), (5, "b", 2)]  # the session of z is open at the end
    assert run_sessions(spark, tmp_path / "one", [hits]) == want
    assert run_sessions(spark, tmp_path / "out-of-order", [[hits[2], hits[4]], [hits[0], hits[3]], [hits[1], hits[5], hits[6]], [hits[7]]]) == want
    # the batch after 300 h closes the sessions before 252 h; from then on a row of 20 h is dropped, one of 260 h is not
    late = run_sessions(spark, tmp_path / "late", [hits, [(12, "y", 299)], [(9, "a", 20), (10, "c", 260)], [(11, "z", 400)]])
    assert late == sorted([*want, (10, "c", 1), (8, "z", 1), (12, "y", 1)], key=repr)
