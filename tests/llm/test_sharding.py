import math
import zlib
from collections import Counter, defaultdict

from odd import ODD_IDS, ids, odd_documents
from pyspark.sql import functions as F

from segspark.llm.sharding import even_tree, leaves, placed_documents, slots, with_new_region, with_shard, write_shards


def shards_of(spark, tree, n=4000):
    return {r["doc_id"]: r["shard"] for r in with_shard(spark.range(n).withColumnRenamed("id", "doc_id"), tree).collect()}


def test_shards_follow_the_weights(spark):
    tree = [[[(0, 1.0), (1, 3.0)]], [[(2, 4.0)], [(3, 0.0), (4, 8.0)]]]
    sizes = Counter(shards_of(spark, tree, 16_000).values())
    assert set(sizes) == {0, 1, 2, 4}
    for shard, weight in leaves(tree):
        expected = weight * 1000
        assert abs(sizes[shard] - expected) < 5 * math.sqrt(expected + 1)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    tree = even_tree()
    for _ in range(3):
        grown = with_new_region(tree)
        before, after = shards_of(spark, tree), shards_of(spark, grown)
        new = max(s for s, _ in leaves(grown))
        moved = [k for k in before if before[k] != after[k]]
        assert moved and all(after[k] == new for k in moved)
        assert len(moved) < 2 * len(before) / len(leaves(grown))
        tree = grown


def test_a_changed_weight_moves_rows_only_into_or_out_of_its_subtree(spark):
    tree = even_tree()
    heavier = [[[(s, 2.0 if s == 0 else w) for s, w in rack] for rack in region] for region in tree]
    before, after = shards_of(spark, tree), shards_of(spark, heavier)
    region = lambda s: s // 4
    for k in before:
        if before[k] != after[k]:
            assert region(after[k]) == 0  # the region that became heavier
            if region(before[k]) == 0:
                assert after[k] == 0 or (before[k] // 2, after[k] // 2) == (1, 0)


def test_slots_are_gapless_and_in_order_for_hot_shards_and_equal_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("shard"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    got = defaultdict(list)
    for r in slots(rows.repartition(5), "shard", ["k"]).collect():
        got[r["shard"]].append((r["slot"], r["k"]))
    for found in got.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found)))
        assert [k for _, k in found] == sorted(k for _, k in found)


def test_odd_rows(spark):
    df = odd_documents(spark)
    out = placed_documents(df, even_tree()).collect()
    assert sorted((r["doc_id"] for r in out), key=lambda x: (x is None, x)) == ODD_IDS
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == texts
    by_id = defaultdict(set)
    for r in out:
        by_id[r["doc_id"]].add(r["shard"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(len(s) == 1 for s in by_id.values())
    kept = with_shard(df, even_tree())
    assert kept.columns == [*df.columns, "shard"] and ids(kept) == ODD_IDS
    assert placed_documents(df.limit(0), even_tree()).isEmpty()


def test_written_shards_hold_all_rows(spark, tmp_path):
    df = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("x"))
    write_shards(df, even_tree(), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == shards_of(spark, even_tree(), 200)
