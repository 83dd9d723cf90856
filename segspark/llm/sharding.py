"""Shards by a hierarchical weighted hash tree.

The tree has levels (region, rack, shard). At every node each child draws -ln(u) / weight, where u comes
from a hash of the row's key and the child's path, and the smallest draw wins: a child gets rows in
proportion to its weight. A node weighs what its shards weigh. A draw depends on nothing but key,
path and weight, so a changed weight moves rows only into or out of the subtrees that hold the
change: siblings keep their draws, and inside an unchanged subtree the whole descent stays as it is.
`with_new_region` opens a new shard in a region of its own: no other weight changes, so rows move into
the new shard and nowhere else.

Everything is DataFrame expressions; a row's shard is found without any other row. Slots (0, 1, ...
within a shard, by key, size and checksum) come from a range-partitioned sort of the narrow columns, which splits
equal keys as well, and one offset per partition and shard: the only broadcast rows, whose number is that of the
sort's partitions and shards.

Results for odd cases: a null key counts as an empty one and sorts first; a null text has no bytes (size 1,
checksum 0). Equal keys share a shard. Repeated rows each have a slot; which of two equal rows has which is
open. Equal draws fall to the first path. An empty table gives no rows. Only key and text are read into names of our own, so
other columns cannot clash; `with_shard` replaces a column that has the name asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segspark.session import materialize

#: A tree: nested lists whose leaves are (shard number, weight).
Leaf = tuple[int, float]
Tree = list

BITS = 52


def even_tree(regions: int = 4, racks: int = 2, shards: int = 2, weight: float = 1.0) -> Tree:
    """Shards 0, 1, ... of equal weight, so many a rack, so many racks a region."""
    return [
        [[((g * racks + r) * shards + s, weight) for s in range(shards)] for r in range(racks)] for g in range(regions)
    ]


def leaves(node: Tree | Leaf) -> list[Leaf]:
    return [node] if isinstance(node, tuple) else [leaf for child in node for leaf in leaves(child)]


def with_new_region(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, numbered after the last, in a rack and region of its own."""
    return [*tree, [[(max(s for s, _ in leaves(tree)) + 1, weight)]]]


def _draw(key: Column, path: str, weight: float) -> Column:
    drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{path}"))), 1, BITS // 4), 16, 10).cast("double")
    return -F.log((drawn + F.lit(0.5)) / F.lit(float(1 << BITS))) / F.lit(float(weight))


def _inner(tree: Tree, path: str = "") -> list[tuple[int, str, Tree]]:
    """(level, path, node) of all nodes that have children."""
    own = [(path.count("."), path, tree)]
    return own + [x for i, child in enumerate(tree) if isinstance(child, list) for x in _inner(child, f"{path}{i}.")]


def _key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def with_shard(df: DataFrame, tree: Tree, key_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """The rows of `df` with the shard that their key reaches; children of weight 0 get no rows."""
    nodes, key = _inner(tree), _key_text(F.col(key_col))
    at, temporary = None, []
    for level in range(1 + max(depth for depth, _, _ in nodes)):
        choice = None
        for depth, path, node in nodes:
            if depth != level:
                continue
            drawn = []
            for i, child in enumerate(node):
                weight = sum(w for _, w in leaves(child))
                target = f"={child[0]}" if isinstance(child, tuple) else f"{path}{i}."
                if weight > 0:
                    drawn.append(F.struct(_draw(key, f"{path}{i}", weight).alias("draw"), F.lit(target).alias("to")))
            if not drawn:
                continue
            best = F.array_min(F.array(*drawn)).getField("to")
            choice = best if at is None else F.when(at == path, best) if choice is None else choice.when(at == path, best)
        temporary.append(f"~{name}~{level}")
        df = df.withColumn(temporary[-1], choice if at is None else choice.otherwise(at))
        at = F.col(f"`{temporary[-1]}`")
    return df.withColumn(name, F.substring(at, 2, 20).cast("int")).drop(*temporary)


def write_shards(df: DataFrame, tree: Tree, path: str, key_col: str = "doc_id") -> None:
    """All rows and columns, in one folder a shard (`shard=0`, ...). Tasks write side by side; nothing is shuffled."""
    with_shard(df, tree, key_col).write.partitionBy("shard").parquet(path)


def slots(rows: DataFrame, shard_col: str, order: list[str], name: str = "slot") -> DataFrame:
    """Numbers 0, 1, ... within each shard by `order`. `rows` should be a narrow written table."""
    salted = rows.withColumn("~salt", F.monotonically_increasing_id())  # so that equal rows can lie in several partitions
    placed = materialize(
        salted.orderBy(shard_col, *order, "~salt").drop("~salt").withColumn("~place", F.monotonically_increasing_id())
    ).withColumn("~part", F.shiftright("~place", 33))
    counted = placed.groupBy("~part", F.col(shard_col).alias("~shard")).agg(
        F.min("~place").alias("~first"), F.count(F.lit(1)).alias("~rows")
    )
    before = F.sum("~rows").over(W.partitionBy("~shard").orderBy("~part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counted.select(F.col("~part"), "~shard", (F.coalesce(before, F.lit(0)) - F.col("~first")).alias("~shift"))
    found = placed.join(F.broadcast(offsets), ["~part"]).where(F.col("~shard") == F.col(shard_col))
    return found.withColumn(name, F.col("~place") + F.col("~shift")).drop("~part", "~shard", "~place", "~shift")


def placed_documents(df: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text", new_weight: float = 1.0) -> DataFrame:
    """One row per row of `df`: id, size, text_crc32, shard, slot, grown_shard (its shard with one more region)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = df.select(
        F.col(id_col).alias("key"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32")
    )
    narrow = with_shard(with_shard(narrow, tree, "key"), with_new_region(tree, new_weight), "key", "grown_shard")
    return slots(materialize(narrow), "shard", ["key", "size", "text_crc32"]).withColumnRenamed("key", id_col)
