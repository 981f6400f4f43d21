"""Feeds over file streams: malformed messages, replays, upserts, two feeds at once."""

import json
import os
import shutil

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from starfeed.sources import Database, read_messages
from starfeed.streaming import (
    LOCATIONS, STATUSES, JdbcLog, JdbcState, LatestState, ParquetLog, await_feeds, parse_messages, run_feeds,
    start_feed,
)


def say(**fields):
    return json.dumps(fields)


def location(driver, lat, second):
    return say(repartidor_id=driver, latitud=lat, longitud=0.0, timestamp=f"2024-01-01T00:00:{second:02d}Z")


def put(spark, folder, number, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "value string").select(F.col("value").cast("binary"))
    df.coalesce(1).write.mode("append").parquet(f"{folder}/part{number}")


def stream(spark, folder):
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def run(spark, folder, feed, write, checkpoint):
    rows = parse_messages(stream(spark, folder), feed)
    start_feed(rows, write, str(checkpoint), available_now=True).awaitTermination()


def forget_last_commit(checkpoint):
    commits = [f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]
    last = max(commits, key=int)
    for name in (last, f".{last}.crc"):
        path = f"{checkpoint}/commits/{name}"
        if os.path.exists(path):
            os.rename(path, f"{checkpoint}/{name}.away")


def test_malformed_messages(spark):
    bodies = [
        "junk", None, '{"repartidor_id": "a", "latitud": "x", "longitud": 2.5, "timestamp": "2024-01-01T00:00:00Z"}',
        '{"repartidor_id": 7, "latitud": 1, "otro": 1}', '{"repartidor_id": "cut',
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "value string").select(F.col("value").cast("binary"))
    got = [tuple(r)[:3] for r in parse_messages(df, LOCATIONS).collect()]
    assert got[:2] == [(None, None, None)] * 2
    assert got[2] == ("a", None, 2.5)
    assert got[3] == ("7", 1.0, None)
    assert got[4] == (None, None, None)


def test_columns_and_one_ingestion_time_per_batch(spark, tmp_path):
    put(spark, tmp_path / "in", 0, [location("a", 1.0, 1), location("b", 2.0, 2), "junk"])
    log = ParquetLog(str(tmp_path / "out"))
    run(spark, tmp_path / "in", LOCATIONS, log.write, tmp_path / "cp")
    got = log.read(spark)
    assert got.columns == ["repartidor_id", "latitud", "longitud", "timestamp", "ingestion_time"]
    assert got.count() == 3
    assert got.select("ingestion_time").distinct().count() == 1


def test_replayed_batch_adds_nothing(spark, tmp_path):
    for i in range(3):
        put(spark, tmp_path / "in", i, [location(d, float(i), i) for d in "abc"])
    log = ParquetLog(str(tmp_path / "out"))
    run(spark, tmp_path / "in", LOCATIONS, log.write, tmp_path / "cp")
    assert log.read(spark).count() == 9
    forget_last_commit(tmp_path / "cp")
    put(spark, tmp_path / "in", 3, [location("d", 0.0, 9)])
    run(spark, tmp_path / "in", LOCATIONS, log.write, tmp_path / "cp")
    assert log.read(spark).count() == 10


@pytest.fixture
def database(tmp_path):
    return Database(
        f"jdbc:derby:{tmp_path}/db;create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        lookup="select TABLENAME from SYS.SYSTABLES where TABLENAME = upper('{table}')",
    )


def test_database_log_takes_a_batch_once(spark, tmp_path, database):
    put(spark, tmp_path / "in", 0, [say(pedido_id=str(i), estado="x") for i in range(5)])
    log = JdbcLog(database, STATUSES.table)
    run(spark, tmp_path / "in", STATUSES, log.write, tmp_path / "cp")
    assert log.read(spark).count() == 5
    forget_last_commit(tmp_path / "cp")
    run(spark, tmp_path / "in", STATUSES, log.write, tmp_path / "cp")
    assert log.read(spark).count() == 5


def test_database_log_completes_a_batch_cut_off(spark, database, monkeypatch):
    bodies = [say(pedido_id=str(i % 3), estado="x") for i in range(6)]
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    batch, log = parse_messages(df, STATUSES), JdbcLog(database, STATUSES.table)
    append = Database.append

    def cut_off(self, df, table):
        append(self, df.limit(2) if table == STATUSES.table else df, table)
        if table == STATUSES.table:
            raise RuntimeError("no room")

    with monkeypatch.context() as patch:
        patch.setattr(Database, "append", cut_off)
        with pytest.raises(RuntimeError, match="no room"):
            log.write(batch, 0)
    log.write(batch, 0)
    log.write(batch, 0)
    log.write(batch, 1)
    counts = {r["pedido_id"]: r["count"] for r in log.read(spark).groupBy("pedido_id").count().collect()}
    assert counts == {"0": 4, "1": 4, "2": 4}


@pytest.mark.parametrize("fold_every", [1, 2, 20])
def test_latest_state(spark, tmp_path, fold_every):
    put(spark, tmp_path / "in", 0, [location("a", 1.0, 5), location("b", 1.0, 1), location("a", 0.5, 4)])
    put(spark, tmp_path / "in", 1, [location("a", 2.0, 3), location("c", 2.0, 3), "junk"])  # a: too late
    put(spark, tmp_path / "in", 2, [location("b", 3.0, 9)])
    state = LatestState(str(tmp_path / "out"), "repartidor_id", ["timestamp", "latitud"], fold_every)
    run(spark, tmp_path / "in", LOCATIONS, state.write, tmp_path / "cp")
    want = {"a": 1.0, "b": 3.0, "c": 2.0}
    assert {r["repartidor_id"]: r["latitud"] for r in state.read(spark).collect()} == want
    forget_last_commit(tmp_path / "cp")
    run(spark, tmp_path / "in", LOCATIONS, state.write, tmp_path / "cp")
    assert {r["repartidor_id"]: r["latitud"] for r in state.read(spark).collect()} == want


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path, database):
    put(spark, tmp_path / "in", 0, [location("a", 1.0, 1), location("b", 1.0, 1)])
    put(spark, tmp_path / "in", 1, [location("a", 2.0, 5)])
    put(spark, tmp_path / "new", 0, [location("a", 9.0, 9)])
    logs = [ParquetLog(str(tmp_path / "out")), JdbcLog(database, LOCATIONS.table)]
    state = LatestState(str(tmp_path / "state"), "repartidor_id", ["timestamp", "latitud"], 1)
    for number, write in enumerate([*(log.write for log in logs), state.write]):
        run(spark, tmp_path / "in", LOCATIONS, write, tmp_path / f"cp{number}")
        run(spark, tmp_path / "new", LOCATIONS, write, tmp_path / f"cp{number}-new")
    for log in logs:
        assert sorted(r["latitud"] for r in log.read(spark).collect()) == [1.0, 1.0, 2.0, 9.0]
    assert {r["repartidor_id"]: r["latitud"] for r in state.read(spark).collect()} == {"a": 9.0, "b": 1.0}


def test_fold_every_may_change(spark, tmp_path):
    for i, every in enumerate([1, 3, 2]):
        put(spark, tmp_path / "in", i, [location("a", float(i), i), location(f"k{i}", 0.0, 0)])
        state = LatestState(str(tmp_path / "out"), "repartidor_id", ["timestamp", "latitud"], every)
        run(spark, tmp_path / "in", LOCATIONS, state.write, tmp_path / "cp")
    assert {r["repartidor_id"]: r["latitud"] for r in state.read(spark).collect()} == {"a": 2.0, "k0": 0.0, "k1": 0.0, "k2": 0.0}


def by_hand(spark, *rows):
    bodies = spark.createDataFrame([(location(*r),) for r in rows], "value string")
    return parse_messages(bodies, LOCATIONS)


def files_below(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_rewrites_the_parts_it_changes(spark, tmp_path):
    state = LatestState(str(tmp_path / "out"), "repartidor_id", ["timestamp", "latitud"], fold_every=2, parts=8, share=10.0)
    drivers = [f"d{i}" for i in range(40)]
    for batch_id in range(2):
        state.write(by_hand(spark, *[(d, float(batch_id), batch_id) for d in drivers]), batch_id)
    before = files_below(tmp_path / "out" / "full")
    assert len({f.split("part=")[1].split("/")[0] for f in before}) == 8
    for batch_id in range(2, 12):
        state.write(by_hand(spark, ("d0", 5.0, batch_id), ("new", 1.0, batch_id)), batch_id)
    after = files_below(tmp_path / "out" / "full")
    touched = {f.split("part=")[1].split("/")[0] for f in after - before}
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if f.split("part=")[1].split("/")[0] not in touched}
    assert kept < after
    # of a part that was folded often, the last two versions stay
    for kind in ("full", "changes"):
        for part in touched:
            assert len(os.listdir(tmp_path / "out" / kind / f"part={part}")) <= 2
    got = {r["repartidor_id"]: r["latitud"] for r in state.read(spark).collect()}
    assert got == {**{d: 1.0 for d in drivers}, "d0": 5.0, "new": 1.0}


def test_a_part_is_folded_when_its_changes_outgrow_a_share(spark, tmp_path):
    state = LatestState(str(tmp_path / "out"), "repartidor_id", ["timestamp", "latitud"], fold_every=10, parts=1, share=0.5, least=0)
    state.write(by_hand(spark, *[(f"d{i}", 0.0, 0) for i in range(4)]), 9)
    assert state._folded(spark) == {0: 1}
    state.write(by_hand(spark, ("d0", 1.0, 1)), 11)
    assert state._folded(spark) == {0: 1}
    state.write(by_hand(spark, ("d1", 1.0, 1), ("d2", 1.0, 1)), 13)
    assert state._folded(spark) == {0: 2}
    assert sorted(r["latitud"] for r in state.read(spark).collect()) == [0.0, 1.0, 1.0, 1.0]


def test_merged_logs_keep_rows_and_few_files(spark, tmp_path):
    log, other = ParquetLog(str(tmp_path / "out"), fan=3), "second"
    days = ["2024-01-01 10:00:00", "2024-01-02 10:00:00"]
    rows = lambda n, day: by_hand(spark, *[(f"d{n}", float(n), 1)] * 2).withColumn("ingestion_time", F.lit(day).cast("timestamp"))
    assert log.merge(spark) == 0
    counts = []
    for n in range(36):
        log.write(rows(n, days[n // 18]), n)
        if n % 2:
            log.merge(spark)
            counts.append(len(files_below(tmp_path)))
            if n in (5, 11, 35):
                assert sorted(r["latitud"] for r in log.read(spark).collect()) == [float(x) for x in range(n + 1) for _ in "ab"]
    assert max(counts[len(counts) // 2 :]) <= 40 and log._published(spark)["upto"] == {"by-hand": 34}
    # the last batch may be run again, and another query may write beside
    log.write(rows(99, days[1]), 35)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", other)
    try:
        log.write(rows(7, days[0]), 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert log.merge(spark) == 0
    want = [float(x) for x in [*range(35), 99, 7] for _ in "ab"]
    assert sorted(r["latitud"] for r in log.read(spark).collect()) == sorted(want)
    with pytest.raises(ValueError):
        ParquetLog(str(tmp_path / "none")).read(spark)


def test_a_thousand_batches_become_few_files(spark, tmp_path):
    log = ParquetLog(str(tmp_path / "out"), fan=4)
    log.write(by_hand(spark, ("a", 1.0, 1), ("b", 2.0, 1)), 0)
    batches = tmp_path / "out" / "query_id=by-hand"
    shutil.copytree(batches / "batch_id=0", tmp_path / "copy")
    for n in range(1000):
        if n:
            shutil.copytree(tmp_path / "copy", batches / f"batch_id={n}")
        if n in (300, 600, 900):
            assert log.merge(spark) == 300
    assert log.merge(spark) == 99
    log.write(by_hand(spark, ("c", 3.0, 1)), 1000)
    assert log.merge(spark) == 1
    assert len(files_below(tmp_path)) <= 30
    counts = {r["repartidor_id"]: r["count"] for r in log.read(spark).groupBy("repartidor_id").count().collect()}
    assert counts == {"a": 1000, "b": 1000, "c": 1}


def test_readers_that_have_begun_can_end(spark, tmp_path):
    log = ParquetLog(str(tmp_path / "out"), fan=2)
    for n in range(4):
        log.write(by_hand(spark, (f"d{n}", float(n), 1)), n)
    reading = log.read(spark)
    log.merge(spark)
    assert reading.count() == log.read(spark).count() == 4


@pytest.mark.parametrize("fold_every", [1, 2, 20])
def test_state_in_a_database(spark, tmp_path, database, fold_every, monkeypatch):
    """Late messages, one batch run again, and one cut off."""
    put(spark, tmp_path / "in", 0, [location("a", 1.0, 5), location("b", 1.0, 1), location("a", 0.5, 4)])
    put(spark, tmp_path / "in", 1, [location("a", 2.0, 3), location("c", 2.0, 3), "junk"])  # a: too late
    put(spark, tmp_path / "in", 2, [location("b", 3.0, 9)])
    state = JdbcState(database, "ultimas", "repartidor_id", ["timestamp", "latitud"], fold_every)
    with pytest.raises(ValueError, match="no state"):
        state.read(spark)
    run(spark, tmp_path / "in", LOCATIONS, state.write, tmp_path / "cp")
    want = {"a": 1.0, "b": 3.0, "c": 2.0}
    read = lambda: {r["repartidor_id"]: r["latitud"] for r in state.read(spark).collect()}
    assert read() == want and state.read(spark).count() == 3
    forget_last_commit(tmp_path / "cp")
    run(spark, tmp_path / "in", LOCATIONS, state.write, tmp_path / "cp")
    assert read() == want

    append = Database.append

    def cut_off(self, df, table):
        if table.endswith("_notes"):
            raise RuntimeError("no room")
        return append(self, df, table)

    with monkeypatch.context() as patch:
        patch.setattr(Database, "append", cut_off)
        with pytest.raises(RuntimeError, match="no room"):
            state.write(by_hand(spark, ("a", 9.0, 50)), 3)
    assert read() == want
    state.write(by_hand(spark, ("a", 9.0, 50)), 3)
    assert read() == {**want, "a": 9.0}


def test_two_feeds_at_once(spark, tmp_path):
    put(spark, tmp_path / "a", 0, [location("a", 1.0, 5)])
    put(spark, tmp_path / "b", 0, [say(pedido_id="1", estado="LISTO", timestamp="2024-01-01T00:00:00Z")])
    logs = [ParquetLog(str(tmp_path / t)) for t in ("out-a", "out-b")]
    topics = (LOCATIONS.topic, STATUSES.topic)
    run_feeds(
        {t: stream(spark, tmp_path / n) for t, n in zip(topics, "ab")},
        {t: log.write for t, log in zip(topics, logs)},
        str(tmp_path / "cp"),
        available_now=True,
    )
    assert [log.read(spark).count() for log in logs] == [1, 1]


def test_one_failing_feed_stops_the_other(spark, tmp_path):
    put(spark, tmp_path / "a", 0, [location("a", 1.0, 5)])

    def fail(batch, batch_id):
        raise RuntimeError("no room")

    log = ParquetLog(str(tmp_path / "out"))
    healthy = start_feed(parse_messages(stream(spark, tmp_path / "a"), LOCATIONS), log.write, str(tmp_path / "cp1"))
    broken = start_feed(parse_messages(stream(spark, tmp_path / "a"), LOCATIONS), fail, str(tmp_path / "cp2"))
    with pytest.raises(StreamingQueryException, match="no room"):
        await_feeds([healthy, broken])
    assert not healthy.isActive


def test_topics_need_the_connector(spark):
    """There is no broker here: only that the reader asks Spark for its Kafka source."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_messages(spark, "broker:9092", LOCATIONS.topic, max_per_trigger=1000)
