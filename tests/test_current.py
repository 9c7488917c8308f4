import datetime as dt
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import START, order, orders, pairs, plan
from tidemark.functions import quoted
from tidemark.operators import latest_per_key, upsert
from tidemark.schema import COMMIT, KEY, TIEBREAK, TS
from tidemark.session import scratch_dir, sql_settings
from tidemark.sources import CurrentTable, files

BATCHES = [
    [("a", 5, 1), ("b", 1, 2), ("a", 4, 3), (None, 1, 4)],
    [("a", 1, 5), ("c", 1, 6), (None, 1, 7), (None, 2, 8)],
    [("b", 9, 9), ("d", 1, 10)],
    [("a", 2, 11), ("d", 0, 12), (None, 3, 13)],
    [("e", 1, 14)],
]


def batch(spark, rows):
    return orders(spark, [order(*row) for row in rows])


def folded(spark, batches):
    newest = [latest_per_key(batch(spark, rows), [KEY], TS, TIEBREAK) for rows in batches]
    current = newest[0]
    for updates in newest[1:]:
        current = upsert(current, updates, [KEY])
    return pairs(current)


def table_in(spark, folder, **layout):
    """A table with a name of its own under ``folder``."""
    name = f"current_{Path(folder).name.replace('-', '_')}.orders"
    return CurrentTable(spark, name, folder, **{"min_buckets": 2, "merge_ratio": None, **layout})


def apply_all(spark, table, batches, first=0):
    for number, rows in enumerate(batches, first):
        assert table.apply(batch(spark, rows), number)


def folders(folder):
    """(bases, commits) that have files."""
    bases = sorted(path.name for path in Path(folder).glob("base-*"))
    commits = sorted(int(path.name.split("=")[1]) for path in Path(folder, "changes").glob(f"{COMMIT}=*"))
    return bases, commits


@pytest.mark.parametrize("layout", [{}, {"merge_ratio": 0.25, "merge_size": 0}])
def test_applied_batches_equal_a_fold_of_upserts(spark, folder, layout):
    table = table_in(spark, folder, **layout)
    apply_all(spark, table, BATCHES)
    assert (table.base() is None) == (not layout)
    assert pairs(table.read()) == folded(spark, BATCHES)
    table.merge()
    assert len(table.commits()) == 1
    assert pairs(table.read()) == folded(spark, BATCHES)


STEPS = st.lists(
    st.one_of(
        st.sampled_from(["merge", "repeat", "reopen", "old"]),
        st.lists(
            st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5), st.integers(0, 99)),
            min_size=1,
            max_size=5,
        ),
    ),
    min_size=3,
    max_size=7,
)


@settings(max_examples=6, deadline=None)
@given(steps=STEPS)
def test_maintenance_never_changes_the_rows(spark, steps):
    folder = scratch_dir(spark, "steps")
    table = table_in(spark, folder)
    current, keyless, number, last = {}, [], 0, None
    for step in steps:
        if step == "repeat":
            assert last is None or table.apply(batch(spark, last), number - 1)
        elif step == "merge":
            table.merge()
        elif step == "old":
            base = table.base()
            assert base is None or not table.apply(batch(spark, [("a", 9, 1000)]), base)
        elif step == "reopen":
            forget(spark, table)
            table = table_in(spark, folder)
        else:
            table.apply(batch(spark, step), number)
            number, last = number + 1, step
            best = {}
            for key, minute, amount in step:
                best[key] = max(best.get(key, (minute, amount)), (minute, amount))
            keyless += [(None, best.pop(None)[1])] if None in best else []
            current |= {key: amount for key, (_, amount) in best.items()}
    expected = sorted([*keyless, *current.items()], key=lambda pair: (pair[0] or "", pair[1]))
    assert [(key, int(amount)) for key, amount in pairs(table.read())] == expected


def forget(spark, table):
    """What a session without a shared catalog knows: nothing."""
    spark.sql(f"DROP VIEW {table.name}")
    for row in spark.sql(f"SHOW TABLES IN {quoted(table.database)}").collect():
        spark.sql(f"DROP TABLE {quoted(table.database, row['tableName'])}")


def test_the_name_is_a_table_in_sql(spark, folder):
    table = table_in(spark, folder)
    assert spark.sql(f"SELECT * FROM {table.name}").columns == table.schema.fieldNames()
    apply_all(spark, table, BATCHES[:2])
    assert spark.sql(f"SELECT max(amount) FROM {table.name}").first()[0] == 8
    apply_all(spark, table, BATCHES[2:], first=2)
    counted = spark.sql(f"SELECT count(*), count({KEY}), sum(amount) FROM {table.name}").first()
    rows = folded(spark, BATCHES)
    assert tuple(counted) == (len(rows), len([k for k, _ in rows if k]), sum(amount for _, amount in rows))


def test_changes_over_a_loaded_base(spark, folder):
    table = table_in(spark, folder)
    table.load(latest_per_key(batch(spark, BATCHES[0]), [KEY], TS, TIEBREAK), size=0, raw_batch=3)
    assert (table.base(), table.loaded_through()) == (0, 3)
    apply_all(spark, table, BATCHES[1:], first=1)
    assert table.commits() == [1, 2, 3, 4]
    assert pairs(table.read()) == folded(spark, BATCHES)
    table.merge()
    assert (table.base(), table.commits(), table.loaded_through()) == (3, [4], 3)
    assert pairs(table.read()) == folded(spark, BATCHES)


def test_merge_keeps_what_readers_and_repeats_need(spark, folder):
    table = table_in(spark, folder)
    apply_all(spark, table, BATCHES[:3])
    assert table.merge() and not table.merge()
    assert folders(folder) == (["base-1-2"], [0, 1, 2])
    reader = table.read()
    # The last commit may be repeated: it is in no base.
    table.apply(batch(spark, BATCHES[2]), 2)
    assert not table.apply(batch(spark, [("a", 9, 99)]), 1)
    apply_all(spark, table, BATCHES[3:], first=3)
    reader_plan = plan(reader)
    assert "base_1" in reader_plan
    table.merge()
    # The base before stays, with the changes since, for queries planned on it.
    assert folders(folder) == (["base-1-2", "base-3-2"], [2, 3, 4])
    assert len(reader.collect()) > 0
    apply_all(spark, table, [BATCHES[0], BATCHES[1]], first=5)
    table.merge()
    assert folders(folder) == (["base-3-2", "base-5-2"], [4, 5, 6])
    assert pairs(table.read()) == folded(spark, [*BATCHES, BATCHES[0], BATCHES[1]])


def test_empty_table_and_empty_batches(spark, folder):
    table = table_in(spark, folder)
    assert table.is_empty() and table.next_commit() == 0
    assert table.read().columns == table.schema.fieldNames()
    assert not table.merge()
    assert table.apply(batch(spark, BATCHES[0]).limit(0), 0)
    assert table.is_empty()
    assert table.apply(batch(spark, BATCHES[0]), 0)
    assert pairs(table.read()) == folded(spark, BATCHES[:1])


def test_load_is_refused_after_rows(spark, folder):
    table = table_in(spark, folder)
    rows = batch(spark, [("a", 1, 1)])
    table.apply(rows.limit(0), 0)
    table.load(rows, size=0)
    assert len(pairs(table.read())) == 1
    with pytest.raises(ValueError, match="already has rows"):
        table.load(rows, size=0)


def test_a_repeated_batch_replaces_what_it_left(spark, folder, monkeypatch):
    table = table_in(spark, folder)
    apply_all(spark, table, BATCHES[:2])
    before = pairs(table.read())
    files_before = {path.name for path in Path(folder).rglob("*.parquet")}
    apply_all(spark, table, BATCHES[1:2], first=1)
    assert pairs(table.read()) == before
    assert len(files_before ^ {path.name for path in Path(folder).rglob("*.parquet")}) > 0
    assert len(files_before) == len(list(Path(folder).rglob("*.parquet")))


def test_other_schema_and_composite_key(spark, folder):
    rows = spark.createDataFrame(
        [("a", 1, 10, "x"), ("a", 1, 20, "y"), ("a", 2, 10, "z"), ("a", None, 1, "n")],
        "`the name` string, `li``ne` int, version int, text string",
    )
    table = table_in(
        spark, folder, schema=rows.schema, keys=["the name", "li`ne"], order_by="version", tiebreak=(), sort_by=()
    )
    table.apply(rows, 0)
    table.apply(rows.where("version = 10 OR `li``ne` IS NULL"), 1)
    assert sorted(row["text"] for row in table.read().collect()) == ["n", "n", "x", "z"]
    table.apply(rows.where("version = 20"), 2)
    table.merge()
    table.apply(rows.where("`li``ne` = 2").limit(0), 3)
    assert sorted(row["text"] for row in table.read().collect()) == ["n", "n", "y", "z"]


@pytest.mark.parametrize("crash_at", ["_write_base", "_show", "_delete_before"])
@pytest.mark.parametrize("lost_catalog", [False, True])
def test_crash_during_a_merge(spark, folder, monkeypatch, crash_at, lost_catalog):
    table = table_in(spark, folder)
    apply_all(spark, table, BATCHES[:3])
    table.merge()
    apply_all(spark, table, BATCHES[3:], first=3)

    def crash(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(table, crash_at, crash)
        with pytest.raises(RuntimeError):
            table.merge()
    if lost_catalog:
        forget(spark, table)
        table = table_in(spark, folder)
    assert pairs(table.read()) == folded(spark, BATCHES)
    table.merge()
    assert pairs(table.read()) == folded(spark, BATCHES)
    apply_all(spark, table, BATCHES[:1], first=5)
    table.merge()
    assert pairs(table.read()) == folded(spark, [*BATCHES, BATCHES[0]])


def test_a_base_that_is_not_whole_is_not_used(spark, folder):
    table = table_in(spark, folder)
    apply_all(spark, table, BATCHES[:3])
    table.merge()
    apply_all(spark, table, BATCHES[3:], first=3)
    rows = table.read()
    rows.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/base-9-2")
    assert "_SUCCESS" not in files.list_names(spark, f"{folder}/base-9-2")
    forget(spark, table)
    assert pairs(table_in(spark, folder).read()) == folded(spark, BATCHES)


def test_another_session_finds_the_table(spark, folder):
    table = table_in(spark, folder)
    apply_all(spark, table, BATCHES)
    assert pairs(table_in(spark.newSession(), folder).read()) == folded(spark, BATCHES)


def test_bucket_count_follows_the_size(spark, folder):
    table = table_in(spark, folder, bucket_size=100, min_buckets=4)
    assert (table._bucket_count(0), table._bucket_count(401)) == (4, 5)
    table.load(batch(spark, [("a", 1, 1)]), size=5_000)
    assert folders(folder)[0] == ["base-0-50"]
    assert len(pairs(table.read())) == 1


def many(spark, keys, amount):
    rows = [order(str(key), 1, amount) for key in range(keys)]
    return orders(spark, rows)


def exchanges(text):
    return [line for line in text.splitlines() if "Exchange" in line]


def test_loading_shuffles_once(spark, folder):
    """The shuffle that finds the newest rows also fills the buckets."""
    table = table_in(spark, folder, min_buckets=16)
    rows = latest_per_key(many(spark, 200, 1), [KEY], TS, TIEBREAK)
    with sql_settings(spark, {"spark.sql.shuffle.partitions": "16"}):
        assert len(exchanges(plan(rows.repartition(16, KEY)))) == 1
    table.load(rows, size=0)
    parts = list(Path(folder).glob("base-*/*.parquet"))
    assert len(parts) <= 16
    assert len({path.name.split("_")[-1] for path in parts}) == len(parts)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_reading_and_merging_leave_the_base_in_place(spark, folder, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    table = table_in(spark, folder, min_buckets=16)
    table.load(many(spark, 500, 1), size=0)
    apply_all(spark, table, [[(str(key), 1, n + 2) for key in range(5)] for n in range(3)], first=1)
    text = plan(table.read())
    join = "BroadcastHashJoin" if threshold == "10m" else "SortMergeJoin"
    base_side = text.split("base_0")[0].split(join)[1]
    assert "LeftAnti" in base_side
    assert exchanges(base_side) == []
    if threshold == "-1":
        assert "Bucketed: true" in text
    table.merge()
    assert len(list(Path(folder, "base-2-16").glob("*.parquet"))) <= 16
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [int(amount) for _, amount in pairs(table.read())].count(4) == 5


def test_changes_are_read_without_other_commits(spark, folder):
    table = table_in(spark, folder)
    apply_all(spark, table, BATCHES)
    table.merge()
    # The merge left the commits before for one more round; no query opens them.
    assert {Path(path).parent.name for path in table.read().inputFiles() if "changes" in path} == {f"{COMMIT}=4"}


@pytest.mark.parametrize("sort_by", [("event_date",), ()])
def test_date_filter_reaches_files_in_date_order(spark, folder, sort_by):
    table = table_in(spark, folder, min_buckets=4, sort_by=sort_by)
    days = [START.date() + dt.timedelta(days=number * 7 % 30) for number in range(200)]
    rows = [order(str(key), 1, event_date=day) for key, day in enumerate(days)]
    table.load(orders(spark, rows), size=0)
    for path in Path(folder).glob("base-*/*.parquet"):
        dates = [row[0] for row in spark.read.parquet(str(path)).coalesce(1).select("event_date").collect()]
        assert (dates == sorted(dates)) == bool(sort_by)
    some = table.read().where("event_date = DATE '2025-01-05'")
    assert "EqualTo(event_date,2025-01-05)" in plan(some)
    assert some.count() == days.count(dt.date(2025, 1, 5))


def test_key_filter_reaches_the_scans(spark, folder):
    table = table_in(spark, folder, min_buckets=16)
    table.load(many(spark, 100, 1), size=0)
    apply_all(spark, table, [[("7", 1, 2)]], first=1)
    one = table.read().where(f"{KEY} = '7'")
    assert plan(one).count("EqualTo(order_id,7)") >= 2
    assert [int(amount) for _, amount in pairs(one)] == [2]


def test_merges_follow_the_size_of_changes(spark, folder):
    table = table_in(spark, folder, merge_ratio=0.5, merge_size=0)
    table.load(many(spark, 3_000, 1), size=0)
    apply_all(spark, table, [[("1", 1, 2)], [("2", 1, 2)]], first=1)
    assert table.base() == 0
    table.apply(many(spark, 3_000, 3), 3)
    assert (table.base(), table.commits()) == (2, [3])


def test_columns_outside_the_schema_are_refused(spark, folder):
    for wrong in ({"order_by": "event_time_"}, {"keys": ["idd"]}, {"tiebreak": ["x"]}, {"sort_by": ["x"]}):
        with pytest.raises(ValueError, match="not in the schema"):
            table_in(spark, folder, **wrong)
