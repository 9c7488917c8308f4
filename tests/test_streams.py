from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import pairs, plan, write_gzip
from tidemark.jobs import run
from tidemark.operators import latest_per_key
from tidemark.plans.workspace import AVAILABLE_NOW, Workspace
from tidemark.schema import BATCH, KEY, TIEBREAK, TS
from tidemark.session import sql_settings
from tidemark.sources import CurrentTable, append_table, files, infer_landing, read_quarantine, read_table
from tidemark.sources import current as current_module
from tidemark.streaming import incremental_upsert, ingest, ingest_raw
from tidemark.streaming.batches import bounded

SF = "/root/testdata/sf0.001"


@pytest.fixture
def space(spark):
    return Workspace(spark, SF, "test")


def land(space, name, *rows):
    lines = [
        f'{{"order_id": {key}, "user_id": "1", "product_id": "2", "database_operation": "u", "amount": {amount},'
        f' "payment_method": "pix", "event_timestamp": "2025-01-01T00:{minute:02d}:00"}}\n'
        for key, minute, amount in rows
    ]
    write_gzip(f"{space.landing}/event_date=2025-01-01/{name}.json.gz", "".join(lines))


def current(space):
    return [(key, int(amount)) for key, amount in pairs(space.current.read())]


def test_restart_reads_only_new_files(space):
    land(space, "a", (1, 1, 10), (2, 1, 20))
    space.ingest()
    land(space, "b", (1, 2, 30))
    space.ingest()
    space.ingest()
    assert space.raw().count() == 3
    assert space.raw().select("etl_timestamp").distinct().count() == 2
    assert space.raw().select("source_filename").distinct().count() == 2


def test_stream_applies_batches_in_order(space):
    land(space, "a", (1, 5, 10), (2, 1, 20), (1, 4, 11))
    space.ingest()
    space.upsert()
    assert current(space) == [("1", 10), ("2", 20)]
    # An older time in a later batch wins.
    land(space, "b", (1, 1, 30), ("null", 1, 40))
    space.ingest()
    space.upsert()
    assert current(space) == [(None, 40), ("1", 30), ("2", 20)]
    # Nothing new: no batch, no change.
    commits = space.current.commits()
    space.upsert()
    assert space.current.commits() == commits == [0, 1]


def test_one_file_per_batch_equals_one_batch(space):
    for number in range(4):
        land(space, f"f{number}", (1, number, number), (number + 10, 1, number))
        space.ingest()
    incremental_upsert(
        space.spark,
        space.raw_table,
        space.current,
        f"{space.root}/checkpoints/processed",
        trigger=AVAILABLE_NOW,
        options={"maxFilesPerTrigger": "1"},
    ).awaitTermination()
    assert space.current.commits() == [0, 1, 2, 3]
    newest = latest_per_key(space.raw(), [KEY], TS, TIEBREAK)
    assert pairs(space.current.read()) == pairs(newest)


def test_a_failing_batch_fails_the_query_and_is_repeated(space, monkeypatch):
    land(space, "a", (1, 1, 10))
    space.ingest()

    def fail(*args):
        raise RuntimeError("store is down")

    with monkeypatch.context() as patch:
        patch.setattr(space.current, "apply", fail)
        with pytest.raises(StreamingQueryException, match="store is down"):
            space.upsert()
    assert current(space) == []
    space.upsert()
    assert current(space) == [("1", 10)]


def test_crash_between_the_write_and_the_checkpoint(space):
    land(space, "a", (1, 1, 10), ("null", 1, 20))
    space.ingest()

    def crash(commit, records):
        assert (commit, records) == (0, 2)
        raise RuntimeError("lost driver")

    with pytest.raises(StreamingQueryException, match="lost driver"):
        space.upsert(after_batch=crash)
    assert current(space) == [(None, 20), ("1", 10)]
    seen = []
    space.upsert(after_batch=lambda *batch: seen.append(batch))
    assert seen == [(0, 2)]
    assert current(space) == [(None, 20), ("1", 10)]


def test_a_repeated_raw_batch_leaves_no_duplicate(space, monkeypatch):
    land(space, "a", (1, 1, 10), (2, 1, 20))
    space.ingest()
    land(space, "b", (3, 1, 30))
    sink = ingest.table_sink

    def crashing_sink(*args):
        write = sink(*args)

        def write_and_crash(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost driver")

        return write_and_crash

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "table_sink", crashing_sink)
        with pytest.raises(StreamingQueryException, match="lost driver"):
            space.ingest()
    assert space.raw().count() == 3
    space.ingest()
    assert space.raw().count() == 3
    assert sorted(row["order_id"] for row in space.raw().collect()) == ["1", "2", "3"]


def test_the_raw_table_is_the_catalogs(space):
    land(space, "a", (1, 1, 10))
    space.ingest()
    text = plan(read_table(space.spark, space.raw_table))
    assert "CatalogFileIndex" in text
    assert "_spark_metadata" not in files.list_names(space.spark, space.raw_location)
    # A batch job may add rows too, as a batch of its own.
    columns = read_table(space.spark, space.raw_table).columns
    extra = space.raw().withColumn(BATCH, F.lit(1).cast("long")).select(*columns)
    append_table(extra, space.raw_table)
    assert space.raw().count() == 2
    space.upsert()
    assert current(space) == [("1", 10)]


def test_new_checkpoints_go_on_with_the_numbers(space):
    land(space, "a", (1, 1, 10), ("null", 1, 20))
    space.ingest()
    space.upsert("first")
    space.upsert("second")
    assert space.current.commits() == [0, 1]
    # Every batch with NULL keys adds one, a replayed one too.
    assert current(space) == [(None, 20), (None, 20), ("1", 10)]
    land(space, "b", (2, 1, 30))
    space.ingest()
    space.upsert("second")
    # The first checkpoint's next commit is the second one's, so it may not go on.
    with pytest.raises(ValueError, match="another checkpoint"):
        space.upsert("first")
    assert current(space) == [(None, 20), (None, 20), ("1", 10), ("2", 30)]


def test_initial_load_then_stream(space):
    land(space, "a", (1, 1, 10), (1, 2, 11), (2, 1, 20))
    space.ingest()
    result = space.initial_load()
    assert (result.status, result.raw_count, result.dedup_count, result.removed_count, result.target_count) == (
        "loaded", 3, 2, 1, 2,
    )
    assert space.initial_load().status == "target_not_empty"
    before = space.raw().where(f"{KEY} = '1'").first()["etl_timestamp"]
    land(space, "b", (3, 1, 30))
    space.ingest()
    # Each raw row is read once: by the load or by the stream.
    records = []
    space.upsert(after_batch=lambda commit, n: records.append(n))
    assert (sum(records), space.current.loaded_through()) == (1, 0)
    assert current(space) == [("1", 11), ("2", 20), ("3", 30)]
    # The load time is that of the raw row, not of the upsert.
    assert space.current.read().where(f"{KEY} = '1'").first()["etl_timestamp"] == before


def test_initial_load_of_nothing(space):
    Path(space.landing).mkdir(parents=True)
    space.ingest()
    assert space.initial_load().status == "source_empty"
    assert (space.current.base(), space.current.commits()) == (None, [])


def test_batches_that_arrive_during_the_load_are_left_to_the_stream(space, monkeypatch):
    land(space, "a", (1, 1, 10), (2, 1, 20))
    space.ingest()
    load = CurrentTable.load

    def land_and_load(*args, **kwargs):
        land(space, "b", (1, 2, 11), ("null", 1, 5))
        space.ingest()
        load(*args, **kwargs)

    monkeypatch.setattr(CurrentTable, "load", land_and_load)
    result = space.initial_load()
    assert (result.raw_count, result.target_count) == (2, 2)
    space.upsert()
    assert current(space) == [(None, 5), ("1", 11), ("2", 20)]


def test_initial_load_fails_when_the_target_cannot_be_read(space, monkeypatch):
    land(space, "a", (1, 1, 10))
    space.ingest()

    def fail(*args):
        raise OSError("no access")

    monkeypatch.setattr(space.current, "read", fail)
    with pytest.raises(OSError, match="no access"):
        space.initial_load()


def test_the_shuffle_of_a_batch_follows_its_bytes(space, monkeypatch):
    partitions = []

    def seen(frame, settings):
        partitions.append(settings.get("spark.sql.shuffle.partitions"))
        return sql_settings(frame, settings)

    monkeypatch.setattr(current_module, "sql_settings", seen)
    land(space, "a", *((key, 1, key) for key in range(50)))
    space.ingest()
    space.upsert()
    monkeypatch.setattr(current_module, "BATCH_SPLIT", 500)
    land(space, "b", *((key, 1, key) for key in range(50)))
    space.ingest()
    space.upsert()
    size = sum(path.stat().st_size for path in Path(space.raw_location).rglob("ingest_batch=1/*.parquet"))
    assert partitions == ["1", str(size // 500 + 1)]
    assert size > 1_000


def test_a_batch_has_a_bound_unless_it_is_given_one():
    assert bounded(None) == {"maxBytesPerTrigger": str(256 * 1024**3)}
    assert bounded({"MaxFilesPerTrigger": "7"}) == {"MaxFilesPerTrigger": "7"}
    assert bounded({"maxFileAge": "7d"})["maxBytesPerTrigger"] == str(256 * 1024**3)


def test_ingest_with_the_inferred_schema(space):
    space.land()
    checkpoint, location = f"{space.root}/checkpoints/inferred", f"{space.root}/inferred"
    table = f"{space.database}.inferred"
    schema = infer_landing(space.spark, space.landing)
    ingest_raw(
        space.spark, space.landing, table, location, checkpoint, schema=schema, trigger=AVAILABLE_NOW
    ).awaitTermination()
    space.ingest()
    declared, inferred = (
        df.select(*space.raw().columns).drop("etl_timestamp") for df in (space.raw(), read_table(space.spark, table))
    )
    assert inferred.count() == 1000
    assert inferred.exceptAll(declared).isEmpty()


def test_late_date_folders_and_rebalance(space):
    space.land()
    query = ingest_raw(
        space.spark,
        space.landing,
        space.raw_table,
        space.raw_location,
        f"{space.root}/checkpoints/raw",
        trigger=AVAILABLE_NOW,
        options={"maxFilesPerTrigger": "7"},
        rebalance=True,
    )
    query.awaitTermination()
    assert space.raw().count() == 1000
    assert space.raw().select("event_date").distinct().count() == 30


def test_a_session_sees_rows_that_arrive_after_its_first_read(space):
    for number in range(3):
        land(space, f"f{number}", (number, 1, 10))
        space.ingest()
        assert space.raw().count() == number + 1


@pytest.mark.parametrize("trigger", [None, {"processingTime": "1 second"}])
def test_continuous_run(space, trigger):
    land(space, "a", (1, 1, 10))
    checkpoints = f"{space.root}/checkpoints"
    appends = ingest_raw(
        space.spark, space.landing, space.raw_table, space.raw_location, f"{checkpoints}/raw", trigger=trigger
    )
    appends.processAllAvailable()
    upserts = incremental_upsert(
        space.spark, space.raw_table, space.current, f"{checkpoints}/processed", trigger=trigger
    )
    try:
        upserts.processAllAvailable()
        land(space, "b", (1, 2, 20), (2, 1, 30))
        appends.processAllAvailable()
        upserts.processAllAvailable()
        assert current(space) == [("1", 20), ("2", 30)]
        assert appends.isActive and upserts.isActive
    finally:
        appends.stop()
        upserts.stop()


def test_malformed_lines_come_from_the_read_of_the_others(space):
    path = f"{space.landing}/event_date=2025-01-01"
    errors = f"{space.root}/landing/errors/orders"
    assert read_quarantine(space.spark, errors).collect() == []
    land(space, "good", (7, 1, 70))
    space.ingest(errors)
    assert read_quarantine(space.spark, errors).collect() == []
    for name, line in (("a", "broken"), ("b", "{")):
        write_gzip(f"{path}/{name}.json.gz", f'{{"order_id": 1}}\n{line}\n')
        space.ingest(errors)
    rows = read_quarantine(space.spark, errors).collect()
    assert sorted((row["line"], str(row["event_date"])) for row in rows) == [("broken", "2025-01-01"), ("{", "2025-01-01")]
    assert space.raw().where(F.col(KEY).isNull()).count() == 2
    assert space.raw().where("source_filename LIKE '%event_date=2025-01-01/%.json.gz'").count() == 5


def test_a_repeated_batch_of_malformed_lines_is_written_once(space, monkeypatch):
    errors = f"{space.root}/errors"
    write_gzip(f"{space.landing}/event_date=2025-01-01/a.json.gz", 'broken\n{"order_id": 1}\n')
    write = ingest.write_quarantine

    def write_and_crash(*args):
        write(*args)
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "write_quarantine", write_and_crash)
        with pytest.raises(StreamingQueryException, match="lost driver"):
            space.ingest(errors)
    space.ingest(errors)
    assert [row["line"] for row in read_quarantine(space.spark, errors).collect()] == ["broken"]
    assert space.raw().count() == 2


def test_landing_is_scanned_once_for_both_sinks(space):
    write_gzip(f"{space.landing}/event_date=2025-01-01/a.json.gz", 'broken\n{"order_id": 1}\n{"order_id": 2}\n')
    query = ingest.ingest_raw(
        space.spark, space.landing, space.raw_table, space.raw_location, f"{space.root}/checkpoints/raw",
        trigger=AVAILABLE_NOW, errors=f"{space.root}/errors",
    )
    query.awaitTermination()
    # Rows that left the scan, however many sinks they went to.
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == 3


def test_command_line(spark, space):
    land(space, "a", (1, 1, 10), (1, 2, 11))
    raw = ["--raw-table", space.raw_table, "--raw-location", space.raw_location]
    table = ["--processed-table", space.processed, "--processed-location", space.current.location]
    ingest_job = ["ingest-raw", "--landing", space.landing, "--checkpoint", f"{space.root}/c1", *raw]
    upserts = ["incremental-upsert", "--checkpoint", f"{space.root}/c2", *raw, *table]

    run(spark, [*ingest_job, "--available-now", "--infer-schema", "--option", "maxFilesPerTrigger=10"])
    run(spark, ["initial-load", *raw, *table])
    assert current(space) == [("1", 11)]
    for number in range(3):
        land(space, f"b{number}", (2, 1, 20 + number))
        run(spark, [*ingest_job, "--available-now", "--errors", f"{space.root}/errors"])
        run(spark, [*upserts, "--available-now"])
    assert space.current.commits() == [1, 2, 3]
    run(spark, ["merge", *table])
    assert (space.current.base(), space.current.commits()) == (2, [3])
    assert current(space) == [("1", 11), ("2", 22)]
