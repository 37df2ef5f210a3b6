"""What the plans must look like to hold at scale."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from keyframe.operators import keys, sizes, tickets, versions
from keyframe.operators.keys import decode_keys
from keyframe.operators.upsert import merge_rows
from keyframe.plans.read import collect_ticket, filter_table
from keyframe.plans.write import upsert
from keyframe.sources.warehouse import Warehouse
from tests.frames import LARGE_DATA, VERSIONED, dims, rows, settings, versioned_model


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """The fact table and its dimensions as files, which is how Spark knows their size."""
    spark.createDataFrame([(1, 3, 1, 1990, 1.0), (2, 2, 2, 1991, 2.0)], VERSIONED).write.parquet(f"{tmp_path}/f")
    parents = {}
    for name, frame in dims(spark).items():
        frame.write.parquet(f"{tmp_path}/{name}")
        parents[name] = spark.read.parquet(f"{tmp_path}/{name}")
    return {"Fact": spark.read.parquet(f"{tmp_path}/f")}, parents


def test_readable_filter_reaches_the_dimension_scan(spark, stored):
    tables, parents = stored
    frame = filter_table(
        tables, "Fact", "Country = 'NZL'", model=versioned_model(spark), dims=parents, versions="v2"
    ).select("Country", "val")
    text = plan(frame)
    assert "EqualTo(Country,NZL)" in text
    assert "LessThanOrEqual(ValidFromVersion,2)" in text and "GreaterThanOrEqual(ValidToVersion,2)" in text
    assert "ReadSchema: struct<ValidFromVersion:int,ValidToVersion:int,Country:int,val:double>" in text
    assert "Inner, BuildRight" in text and "SortMergeJoin" not in text
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in text


def test_decoding_does_not_shuffle_the_fact(spark, stored):
    tables, parents = stored
    text = plan(keys.decode_keys(tables["Fact"], "Fact", versioned_model(spark), parents))
    assert text.count("BroadcastHashJoin") == 3 and "Exchange hashpartitioning" not in text


def test_several_versions_take_one_scan(spark, stored):
    tables, parents = stored
    text = plan(versions.filter_versions(tables["Fact"], ["v1", "v2", "v5"], "Fact", versioned_model(spark), parents))
    assert text.count("FileScan") == 1 and "Join" not in text and "Exchange" not in text


def test_compression_is_one_aggregate_with_partial_results(spark, stored):
    tables, _ = stored
    text = plan(versions.compress_versions(tables["Fact"]))
    assert text.count("Exchange") == 1 and "partial_min" in text and "Window" not in text


def test_tickets_gather_no_lists(spark, stored):
    tables, _ = stored
    text = plan(tickets.ticket(tables["Fact"], "Fact"))
    assert "collect_list" not in text and "partial_sum" in text and text.count("Exchange") == 1
    assert "md5" not in text.split("partial_sum")[-1]
    written = plan(tickets.ticket(tables["Fact"], "Fact", algorithm="md5"))
    assert written.count("md5(cast(concat_ws(;,") == 1


def test_a_ticket_is_broadcast_and_the_fact_is_not_shuffled(spark, stored):
    tables, parents = stored
    model = versioned_model(spark)
    taken = tickets.ticket(keys.decode_keys(tables["Fact"], "Fact", model, parents), "Fact")
    fetched = collect_ticket(taken, tables, model=model, dims=parents, decode=False)
    assert "LeftSemi, BuildRight" in plan(fetched)


def test_tickets_and_readable_filters_prune_partitions(spark, tmp_path):
    store = Warehouse(spark, "pruned", str(tmp_path))
    store.upload_dimensions(versioned_model(spark), dims(spark), partition_by={"Fact": ["Country"]})
    fact = spark.createDataFrame([(1, 3, c, 1990, 1.0) for c in (1, 2, 3)], VERSIONED)
    taken = upsert(store, fact, "Fact", in_place=True, additional=["Country"]).ticket
    options = {"model": store.model(), "dims": store.dimensions()}
    readable = decode_keys(fact, "Fact", **options)
    one = tickets.ticket(readable, "Fact", additional=["Country"]).filter("Country = 'PER'")
    fetched = collect_ticket(one, store, **options)
    assert fetched.count() == 1 and "PartitionFilters: [isnotnull(Country" in plan(fetched)
    assert "InMemoryFileIndex(1 paths)" in plan(fetched)
    filtered = filter_table(store, "Fact", "Country = 'PER'", **options)
    assert filtered.count() == 1 and "dynamicpruning" in plan(filtered)
    assert taken.count() == 3


def test_implied_ranges_keep_every_match(spark):
    wanted = spark.sql(
        "SELECT * FROM VALUES (1, 'a', date'2020-01-01', 1.0D), (5, NULL, NULL, 2.0D), "
        "(NULL, 'c', date'2020-03-01', NULL), (7, 'a', date'2020-02-01', 1.0D) AS t(n, s, d, x)"
    )
    frame = wanted.unionByName(wanted.withColumn("n", F.lit(99)))
    kept = frame.filter(sizes.implied_range(wanted))
    assert rows(kept) == rows(wanted)
    nothing = wanted.select(F.lit(None).cast("int").alias("n"))
    assert frame.filter(sizes.implied_range(nothing)).count() == 1
    assert sizes.implied_range(wanted.select("x")) is None


def test_hot_groups_in_a_ticket_and_in_compression(spark):
    """A third of the rows share one group; results equal those of an even spread."""
    with settings(spark, LARGE_DATA):
        frame = spark.range(0, 30000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("Country"),
            (F.col("id") % 7).cast("int").alias("n"),
        )
        taken = {r["Country"]: r["NestedDataHash"] for r in tickets.ticket(frame, "T").collect()}
        assert len(taken) == frame.select("Country").distinct().count()
        alone = tickets.hash_groups(frame.filter("Country = 1").coalesce(1), "T", ["Country"]).first()
        assert taken[1] == alone["NestedDataHash"]
        facts = frame.select(
            (F.col("n") + 1).alias("ValidFromVersion"), (F.col("n") + 2).alias("ValidToVersion"), "Country"
        )
        for bridge in (True, False):
            merged = versions.compress_versions(facts, bridge_gaps=bridge)
            assert merged.filter("Country = 1").collect() == [(1, 8, 1)]


# Random data against brute force


def brute_compress(fact, bridge):
    groups = defaultdict(list)
    for start, end, *rest in fact:
        groups[tuple(rest)].append((start, end))
    result = []
    for rest, spans in groups.items():
        spans.sort()
        islands = [list(spans[0])]
        for start, end in spans[1:]:
            if bridge or start <= islands[-1][1] + 1:
                islands[-1][1] = max(islands[-1][1], end)
            else:
                islands.append([start, end])
        result += [(s, e, *rest) for s, e in islands]
    return sorted(result, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_versions(spark, seed):
    rng = random.Random(seed)
    fact = []
    for _ in range(300):
        start = rng.randint(1, 10)
        end = rng.randint(start, 10)
        fact.append((start, end, rng.choice([1, 1, 1, 2, None]), rng.choice([1990, None]), rng.choice([0.5, None])))
    frame = spark.createDataFrame(fact, VERSIONED)
    for bridge in (True, False):
        assert rows(versions.compress_versions(frame, bridge_gaps=bridge)) == brute_compress(fact, bridge)
    wanted = rng.sample(range(1, 11), 4)
    expected = Counter(r for r in fact for v in wanted if r[0] <= v <= r[1])
    found = versions.filter_versions(
        frame, [f"v{v}" for v in wanted], "Fact", versioned_model(spark), dims(spark)
    )
    assert Counter(tuple(r) for r in found.collect()) == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_random_upserts(spark, seed):
    rng = random.Random(seed)
    target = {(k, p): (rng.random(), rng.choice("abc")) for k in range(40) for p in range(3) if rng.random() < 0.5}
    source = {(rng.randint(0, 60), rng.randint(0, 4)): rng.random() for _ in range(50)}
    merged = merge_rows(
        spark.createDataFrame([(*k, *v) for k, v in target.items()], "k int, p int, x double, s string"),
        spark.createDataFrame([(*k, v) for k, v in source.items()], "k int, p int, x double"),
        ["k", "p"],
    )
    expected = dict(target)
    for key, x in source.items():
        expected[key] = (x, target.get(key, (None, None))[1])
    assert {tuple(r)[:2]: tuple(r)[2:] for r in merged.collect()} == expected
