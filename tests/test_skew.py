"""Plans for hot keys give the same rows as the plain ones, and as brute force."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from larder.operators import derive, pairs, prefix, ranking
from larder.sources.testdata import TestTables

from conftest import SF_SMALL


def _basket_rows(seed=7):
    """One basket holds about a third of all lines; one item is in most baskets; copies occur."""
    rng = random.Random(seed)
    rows = []
    for basket in range(120):
        for _ in range(rng.randint(1, 5)):
            rows.append((basket, 0 if rng.random() < 0.4 else rng.randint(1, 60)))
    rows += [(999, i % 90) for i in range(200)]
    return rows


def _true_pairs(rows):
    counts = Counter()
    lines = Counter(rows)
    by_basket = {}
    for (basket, item), n in lines.items():
        by_basket.setdefault(basket, []).append((item, n))
    for items in by_basket.values():
        for (a, m), (b, n) in combinations(sorted(items), 2):
            counts[a, b] += m * n
    return counts


@pytest.mark.parametrize("block", [7, 1000])
@pytest.mark.parametrize("seeds", [1, 3, 64])
def test_pairs_with_wide_basket(spark, block, seeds):
    rows = _basket_rows()
    df = spark.createDataFrame(rows, "basket long, item long").repartition(5)
    found = pairs.frequent_pairs(df, "basket", "item", 10, seed_items=seeds, block_items=block)
    best = found.orderBy(F.desc("times"), "item_a", "item_b").limit(10).collect()
    truth = sorted(_true_pairs(rows).items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert [((r.item_a, r.item_b), r.times) for r in best] == truth


def test_pairs_prune_nothing_that_counts(spark):
    """Pairs of rare items are pruned, ties with the last rank are not."""
    rows = [(b, i) for b in range(40) for i in (1, 2, 3)] + [(100 + b, 10 + b) for b in range(50)]
    rows += [(200, 500), (200, 501)]
    df = spark.createDataFrame(rows, "basket long, item long")
    found = {(r.item_a, r.item_b): r.times for r in pairs.frequent_pairs(df, "basket", "item", 3).collect()}
    assert found == {(1, 2): 40, (1, 3): 40, (2, 3): 40}


def test_pairs_of_plain_baskets(spark):
    rows = [r for r in _basket_rows() if r[0] != 999]
    df = spark.createDataFrame(rows, "basket long, item long")
    # more than there are pairs of the heaviest items: no floor, so all pairs are counted
    found = {(r.item_a, r.item_b): r.times for r in pairs.frequent_pairs(df, "basket", "item", 100_000).collect()}
    assert found == dict(_true_pairs(rows))


def test_pairs_of_empty_input(spark):
    empty = spark.createDataFrame([], "basket long, item long")
    assert pairs.frequent_pairs(empty, "basket", "item", 10).collect() == []


def test_allocation_of_large_orders(spark):
    """The path for large orders agrees with the windowed one, copies of a line included."""
    lines = TestTables(spark, SF_SMALL).order_details.select("order_id", "product_id", "line_number", "gross")
    hot = lines.filter("line_number >= 3").withColumn("order_id", F.lit(77).cast("bigint"))
    copies = spark.createDataFrame([(77, 5, 1, i) for i in range(300)], "order_id long, product_id long, line_number int, i int")
    copies = copies.select("order_id", "product_id", "line_number", F.lit("19.99").cast("decimal(14,2)").alias("gross"))
    lines = lines.unionByName(hot).unionByName(copies)
    targets = lines.groupBy("order_id").agg(F.round(F.sum("gross") * 0.77, 2).cast("decimal(18,2)").alias("target"))
    args = (lines, targets, "order_id", "product_id", "gross", "target", ["line_number"])
    plain = derive.allocate_discount(*args)
    split = derive.allocate_discount(*args, group_rows=50)
    assert Counter(plain.collect()) == Counter(split.collect())
    off = split.groupBy("order_id").agg(F.sum("final_item_price").alias("paid")).join(targets, "order_id")
    assert off.filter("paid <> target").count() == 0


def test_ordered_rank_is_row_number(spark):
    rng = random.Random(3)
    ids = rng.sample(range(1, 1 << 30), 500)
    rows = [(i % 3 if i % 2 else 0, i) for i in ids]
    df = spark.createDataFrame(rows, "g long, id long")
    ranked = prefix.ordered_rank(df, ["g"], [prefix.id_buckets(df, "id")], [F.col("id")]).collect()
    for g in {r.g for r in ranked}:
        members = sorted(r.id for r in ranked if r.g == g)
        assert {r.id: r["rank"] for r in ranked if r.g == g} == {v: n + 1 for n, v in enumerate(members)}


def test_ordered_rank_keeps_rows_of_the_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", None)], "g string, id long")
    ranked = prefix.ordered_rank(df, ["g"], [prefix.id_buckets(df, "id")], [F.col("id")]).collect()
    assert {(r.g, r.id): r["rank"] for r in ranked} == {(None, 1): 1, (None, 3): 2, ("a", None): 1, ("a", 2): 2}


def test_sequence_number_of_text_ids(spark):
    ids = [f"P{i:06d}" for i in range(0, 4000, 7)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    assert {r.id: r.sequence for r in prefix.sequence_number(df, "id").collect()} == {
        v: n + 1 for n, v in enumerate(sorted(ids))
    }


def test_text_ids_have_buckets_of_bounded_size(spark):
    """Zero-padded ids behind a prefix of twelve characters: no bucket holds more than a hundred of them, in the ids' order."""
    ids = [f"ORDER-BATCH-{i:06d}" for i in range(0, 20000, 3)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    assert df.select(prefix.common_prefix(df, "id").alias("n")).first().n == 13
    levels = prefix.id_levels(df, "id")
    sizes = df.groupBy(*[c.alias(f"l{n}") for n, c in enumerate(levels[:-1])]).count().collect()
    assert max(r["count"] for r in sizes) <= 100
    assert {r.id: r.sequence for r in prefix.sequence_number(df, "id").collect()} == {v: n + 1 for n, v in enumerate(sorted(ids))}


def test_odd_text_ids(spark):
    ids = ["", "a", "ab", "abc", "abcd" * 5, "b", "é", "日本語", "a b"]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(3)
    assert {r.id: r.sequence for r in prefix.sequence_number(df, "id").collect()} == {v: n + 1 for n, v in enumerate(sorted(ids))}
    assert prefix.sequence_number(df.limit(0), "id").collect() == []


def test_weighted_sample_takes_the_smallest_draws(spark):
    """The sample by the histogram's boundary cell is that of ranking every row, whatever the sizes."""
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("store"))
    weight = F.when(F.col("id") % 7 == 0, 0.0).otherwise(1.0 + F.col("id") % 5)
    for share in (0.0, 0.0003, 0.1, 0.5, 0.95):
        got = {r.id for r in derive.weighted_sample(df, "store", "id", weight, F.lit(share)).collect()}
        uniform = (derive.hashed(F.concat_ws(":", "store", "id"), 42) + 0.5) / float(2**derive.HASH_BITS)
        draws = df.filter(weight > 0).select("store", "id", (-F.ln(uniform) / weight).alias("draw")).collect()
        expected = set()
        for store in range(3):
            best = sorted((r.draw, r.id) for r in draws if r.store == store)
            expected |= {i for _, i in best[: int(1000 * share)]}
        assert got == expected


def test_building_a_plan_runs_no_job(spark):
    """All queries of the retail part are plans: nothing runs before the result is asked for."""
    from larder import registered

    context = spark.sparkContext
    context.setJobGroup("building", "plans only")
    try:
        for query in registered.queries().values():
            query(spark, SF_SMALL)
        assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_cells_are_dealt_among_tasks_before_they_become_pairs(spark):
    df = spark.createDataFrame([(b, i) for b in range(30) for i in range(b % 4 + 2)], "basket long, item long")
    found = pairs.frequent_pairs(df, "basket", "item", 3, tasks=7)
    plan = found._jdf.queryExecution().toString()
    assert "hashpartitioning(basket" in plan and ", 7), REPARTITION_BY_NUM" in plan
    assert [(r.item_a, r.item_b, r.times) for r in found.collect()] == [(0, 1, 30), (0, 2, 22), (1, 2, 22)]


def test_allocation_in_order_of_expiry(spark):
    """One shelf holds most of the stock: the same as handing out unit by unit."""
    import datetime as dt

    from larder.operators import fulfil

    rng = random.Random(6)
    day = dt.date(2024, 1, 1)
    def some(n):
        return [(0 if rng.random() < 0.6 else 1 + i % 3, i, day + dt.timedelta(rng.randint(0, 90)), rng.randint(0, 400)) for i in range(n)]
    supply, demand = some(60), some(50)
    units = lambda rows, shelf: [i for _, i, _ in sorted((d, i, q) for s, i, d, q in rows if s == shelf) for _ in range(next(q for s, j, d, q in rows if j == i))]
    expected = Counter((s, b, r) for s in range(4) for b, r in zip(units(supply, s), units(demand, s)))
    left = spark.createDataFrame(supply, "shelf long, batch_id long, expiry_date date, quantity long")
    right = spark.createDataFrame(demand, "shelf long, request_id long, day date, quantity long")
    found = fulfil.first_expired_first_out(left, right, ["shelf"]).collect()
    assert {(r.shelf, r.batch_id, r.request_id): r.quantity for r in found} == expected
    for rows in (0, 40, 200):  # every group spread over tasks, some, none
        again = fulfil.first_expired_first_out(left, right, ["shelf"], group_rows=rows).collect()
        assert {(r.shelf, r.batch_id, r.request_id): r.quantity for r in again} == expected


def test_running_total_keeps_peers_together(spark):
    rows = [(1, 5), (2, 5), (3, 3), (4, 9), (5, -2), (6, 9)]
    df = spark.createDataFrame(rows, "id long, amount long")
    for depth in (1, 2, 3):
        out = prefix.running_total(df, -F.col("amount"), "amount", "running", depth=depth).collect()
        assert {r.id: r.running for r in out} == {4: 18, 6: 18, 1: 28, 2: 28, 3: 31, 5: 29}


def test_running_total_over_bucket_borders(spark):
    rng = random.Random(11)
    amounts = [rng.randint(0, 1 << 45) for _ in range(300)] + [7] * 20
    df = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "id long, amount long")
    out = prefix.running_total(df, -F.col("amount"), "amount", "running", depth=3).collect()
    for row in out:
        assert row.running == sum(a for a in amounts if a >= row.amount)


def test_top_values_keep_all_ties(spark):
    rows = [("a", 10)] * 40 + [("a", 9)] * 3 + [("a", 8)] + [("b", 1)]
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v long, id long")
    top = ranking.top_values(df, ["g"], "v", 2).groupBy("g", "rank").count().collect()
    assert {(r.g, r["rank"]): r["count"] for r in top} == {("a", 1): 40, ("a", 2): 3, ("b", 1): 1}


def test_top_rows_beyond_map_side_rank(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    top = ranking.top_rows(df, ["g"], [F.desc("id")], 1500)
    assert top.count() == 3000
    assert top.filter("id < 2000").count() == 0


def test_quota_sample_paths_agree(spark, monkeypatch):
    df = spark.range(3000).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("cat"))
    weights = {"c0": 0.1, "c1": 0.4}
    small = derive.quota_sample(df, "cat", "id", 1000, weights).collect()
    monkeypatch.setattr(derive, "MAP_SIDE_RANK", 1)
    large = derive.quota_sample(df, "cat", "id", 1000, weights).collect()
    assert Counter(small) == Counter(large)
    assert Counter(r.cat for r in small) == {"c0": 100, "c1": 400, "c2": 50}


def test_weighted_sample_favours_weight(spark):
    df = spark.range(4000).select("id", (F.col("id") % 2).alias("store"))
    heavy = F.col("id") % 10 == 1
    sample = derive.weighted_sample(df, "store", "id", F.when(heavy, 8.0).otherwise(1.0), F.lit(0.25))
    assert {r.store: r["count"] for r in sample.groupBy("store").count().collect()} == {0: 500, 1: 500}
    assert sample.filter(heavy & (F.col("store") == 1)).count() > 250


def test_weight_of_zero_is_never_drawn(spark):
    df = spark.range(400).select("id", F.lit(1).alias("store"))
    weight = F.when(F.col("id") < 10, 0.0).when(F.col("id") < 20, -1.0).when(F.col("id") < 25, F.lit(None)).otherwise(1.0)
    drawn = derive.weighted_sample(df, "store", "id", weight, F.lit(1.0))
    assert {r.id for r in drawn.collect()} == set(range(25, 400))
