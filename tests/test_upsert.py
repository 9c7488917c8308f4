from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import order, orders, pairs, plan
from tidemark.operators import change_counts, latest_per_key, matched_updates, unmatched_updates, upsert
from tidemark.schema import KEY, TIEBREAK, TS
from tidemark.session import sql_settings

BATCHES = st.lists(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 9), st.integers(0, 99)),
        min_size=1,
        max_size=6,
    ),
    min_size=1,
    max_size=4,
)


def newest(df):
    return latest_per_key(df, [KEY], TS, TIEBREAK)


def model(batches):
    """The last batch with a key wins; within it the greatest time, then the greatest amount."""
    current, keyless = {}, []
    for batch in batches:
        best = {}
        for key, minute, amount in batch:
            best[key] = max(best.get(key, (minute, amount)), (minute, amount))
        if None in best:
            keyless.append((None, best.pop(None)[1]))
        current |= {key: amount for key, (_, amount) in best.items()}
    return sorted([*keyless, *current.items()], key=lambda pair: (pair[0] or "", pair[1]))


def frames(spark, batches):
    return [newest(orders(spark, [order(*row) for row in batch])) for batch in batches]


@settings(max_examples=8, deadline=None)
@given(batches=BATCHES)
def test_folding_batches(spark, batches):
    first, *rest = frames(spark, batches)
    current = first
    for batch in rest:
        current = upsert(current, batch, [KEY])
    assert [(key, int(amount)) for key, amount in pairs(current)] == model(batches)


def test_replay_of_the_last_batch_changes_nothing_but_null_keys(spark):
    first, second = frames(spark, [[("a", 1, 1), ("b", 1, 2)], [("a", 0, 3), (None, 1, 4)]])
    once = upsert(first, second, [KEY])
    twice = upsert(once, second, [KEY])
    assert [int(a) for _, a in pairs(once)] == [4, 3, 2]
    assert [int(a) for _, a in pairs(twice)] == [4, 4, 3, 2]


def test_any_split_of_a_feed_in_time_order_ends_the_same(spark):
    feed = [(key, minute, minute) for minute, key in enumerate("abacbdaacb")]
    whole = [feed]
    halves = [feed[:5], feed[5:]]
    uneven = [feed[:1], feed[1:3], feed[3:]]
    results = []
    for batches in (whole, halves, uneven):
        current, *rest = frames(spark, batches)
        for batch in rest:
            current = upsert(current, batch, [KEY])
        results.append(pairs(current))
    assert results[0] == results[1] == results[2]


def test_update_for_an_unseen_key_is_inserted(spark):
    target, updates = frames(spark, [[("a", 5, 1)], [("a", 1, 2), ("z", 1, 3)]])
    assert [(k, int(a)) for k, a in pairs(upsert(target, updates, [KEY]))] == [("a", 2), ("z", 3)]
    assert [k for k, _ in pairs(matched_updates(target, updates, [KEY]))] == ["a"]
    assert [k for k, _ in pairs(unmatched_updates(target, updates, [KEY]))] == ["z"]


def test_composite_key_with_a_null_part_matches_nothing(spark):
    rows = [order("a", 1, 1, product_id=None), order("a", 1, 2)]
    df = orders(spark, rows)
    result = upsert(df, df, [KEY, "product_id"])
    assert [int(a) for _, a in pairs(result)] == [1, 1, 2]


def test_both_sides_are_read_and_shuffled_once(spark, folder):
    df = orders(spark, [order("a", 1)])
    df.write.parquet(f"{folder}/target")
    df.write.parquet(f"{folder}/updates")
    target, updates = (spark.read.parquet(f"{folder}/{side}") for side in ("target", "updates"))
    newest_updates = newest(updates)
    text = plan(upsert(target, newest_updates, [KEY]).select(KEY, "amount"))
    assert text.count("FileScan parquet") == 2
    # One shuffle makes the updates unique, the other one puts both sides together.
    assert text.count("Exchange hashpartitioning") == 2
    assert "Join" not in text
    assert "Final" in text.split("WindowGroupLimit")[1]
    some = plan(upsert(target, updates, [KEY]).where(f"{KEY} = 'a'"))
    assert some.count("EqualTo(order_id,a)") == 2


def test_a_target_full_of_null_keys_is_spread_over_tasks(spark):
    """Rows without a key are groups of their own: no task gets them all, and none is held back by thresholds."""
    key = F.when(F.col("id") % 3 != 0, F.col("id").cast("string"))
    rows = spark.range(0, 300_000, 1, 8).select(key.alias(KEY), F.col("id").alias("value"))
    updates = rows.where(F.col(KEY).isNotNull()).withColumn("value", -F.col("value"))
    with sql_settings(spark, {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        result = upsert(rows, updates, [KEY])
        per_task = result.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count_if(F.col(KEY).isNull()).alias("keyless"), F.count("*").alias("n"), F.sum(F.sign("value")).alias("signs")
        ).collect()
    assert len(per_task) == 20
    assert max(row["keyless"] for row in per_task) < 1.2 * 100_000 / 20
    assert max(row["n"] for row in per_task) < 1.2 * 300_000 / 20
    assert sum(row["n"] for row in per_task) == 300_000
    assert sum(row["signs"] for row in per_task) == 99_999 - 200_000


def test_repeated_rows_without_a_key_all_stay(spark):
    rows = orders(spark, [order(None, 1, 1), order(None, 1, 1), order("a", 1, 2), order("a", 2, 3)])
    # The target may hold a key twice: both go for one update.
    result = upsert(rows, orders(spark, [order("a", 0, 9), order(None, 1, 1)]), [KEY])
    assert [int(amount) for _, amount in pairs(result)] == [1, 1, 1, 9]


def test_keys_with_blanks_and_backticks(spark):
    columns = ["order id", "li`ne", "value"]
    target = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), (None, 1, 3)], columns)
    updates = spark.createDataFrame([("a", 1, 9), ("c", 1, 8)], columns)
    keys = columns[:2]
    assert sorted(r["value"] for r in upsert(target, updates, keys).collect()) == [2, 3, 8, 9]
    assert [r["value"] for r in matched_updates(target, updates, keys).collect()] == [9]
    assert [r["value"] for r in unmatched_updates(target, updates, keys).collect()] == [8]
    assert latest_per_key(target.union(updates), keys, "value").count() == 4
    assert change_counts(target.union(updates), keys).first()["dedup_count"] == 4
