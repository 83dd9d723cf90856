"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

A document is the set of its distinct word shingles (64-bit rolling hashes, over the whole text).
Two documents are linked when their Jaccard similarity is at least the threshold; groups are the
connected components of the links. The steps:

1. One pass over the texts gives each document its set's size and 128-bit hash, its MinHash signature
   (one byte per hash function) and its band hashes. Documents with equal sets become one node (a
   map-side aggregate, so a third of all rows in one group is one row per task).
2. Nodes that agree on a band are candidates. The number of bands follows from the miss probability
   asked for. Candidates are never listed in pairs: in every bucket, all nodes are first compared
   with its smallest one, the hub - one pair per member.
3. A comparison looks at signatures batch by batch. After n hashes with m matches, the similarity has
   the posterior Beta(m + 1, n - m + 1); the pair is dropped once the probability that it reaches the
   threshold is below the miss probability. What survives is confirmed on the full sets, so every
   link is true. Sets are read from the texts a second time, for surviving nodes only (found by a
   bitmap of fixed size).
4. Links to hubs join most nodes of a large group. What is left are buckets whose other members lie
   in different components. They are dealt out in blocks of at most `BLOCK` members: the bucket's
   largest component is cut into blocks that each meet all blocks of the rest, and blocks of the rest
   meet each other. A task compares only members of different components, first by signatures
   (members without a surviving partner leave), then by full sets, and emits at most one link per
   member, since it joins components as it goes.
5. Components of all links by star rounds over the shrinking link table.

Nothing is capped or sampled. Results for odd cases: a null text counts as empty; a text without words
has the empty set and is linked with nothing, also not with other empty ones. With fewer words than a
shingle, the whole sequence is the one shingle. Ties need no rule: similarity is compared as integers.
Rows that are repeated, id included, are one document with several rows. A null id takes part, but names
no group unless all its documents have none. Rows of one id with different texts go or stay each by its
own text. An empty table gives an empty result. Only id and text are
read into names of our own, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segspark.llm.id_filter import split_by_bitmap
from segspark.llm.piece_cache import give_back
from segspark.llm.text_arrays import Rolling, Slice, byte_hashes, mix, slices, words
from segspark.session import materialize

SHINGLE, PERCENT = 5, 80
ROWS, MISS = 6, 1e-5
BATCH, BLOCK = 48, 1024
BITMAP_BITS = 1 << 23


def bands_for(percent: int, rows: int, miss: float) -> int:
    """Bands so that a pair at the threshold shares none with at most the miss probability."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def least_matches(hashes: int, percent: int, miss: float, batch: int = BATCH) -> list[tuple[int, int]]:
    """(n, m): after n hashes, with fewer than m matches the posterior chance of a link is below `miss`.

    P(similarity >= t | m of n) under a uniform prior is the chance of at most m successes in n + 1 trials of t.
    """
    t, out = percent / 100, []
    for n in [*range(batch, hashes, batch), hashes]:
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def shingle_sets(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and where each document's begin (and the end)."""
    upper = (part.data >= 65) & (part.data <= 90)
    lowered = Slice(part.first, np.where(upper, part.data + np.uint8(32), part.data), part.offsets)
    found = words(lowered)
    grams = Rolling(mix(byte_hashes(lowered).spans(found.start, found.end)))
    n_words = np.diff(found.bounds)
    owner = np.repeat(np.arange(len(part)), n_words)
    at = np.arange(len(owner))
    end = np.minimum(at + size, found.bounds[1:][owner])
    own = (end - at == size) | (at == found.bounds[:-1][owner])  # whole shingles, or the first of a short text
    at, end, owner = at[own], end[own], owner[own]
    hashes = mix(grams.spans(at, end) + (end - at).astype(np.uint64))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(part) + 1))


def signatures(hashes: np.ndarray, bounds: np.ndarray, rows: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """MinHash bytes (documents x rows * bands) and band hashes (documents x bands) of non-empty sets."""
    multipliers = mix(np.arange(1, rows * bands + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.empty((len(bounds) - 1, rows * bands), np.uint64)
    for i, a in enumerate(multipliers):
        least[:, i] = np.minimum.reduceat(hashes * a, bounds[:-1])
    mixed = mix(least)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(least), bands))
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + mixed[:, r * bands : (r + 1) * bands])
    return (mixed >> np.uint64(56)).astype(np.uint8), key


def set_hashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit sums of each set, whatever the order."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + np.uint64(s)))]) for s in (0, 1)]
    return np.stack([x[bounds[1:]] - x[bounds[:-1]] for x in sums]).view(np.int64)


def _describe(df: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """(row_id, n, h1, h2, bands, sig) per row of (row_id, body); bands and sig are null for empty sets."""
    kind = df.schema["row_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                hashes, bounds = shingle_sets(part, size)
                n = np.diff(bounds)
                filled = n > 0
                sig, keys = signatures(hashes, np.append(bounds[:-1][filled], len(hashes)), rows, bands) if filled.any() else (None, None)
                h1, h2 = set_hashes(hashes, bounds)
                place = np.cumsum(filled) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)), pa.array(n, pa.int64()), pa.array(h1), pa.array(h2),
                        pa.array([keys[place[i]].view(np.int64) if f else None for i, f in enumerate(filled)], pa.list_(pa.int64())),
                        pa.array([sig[place[i]].tobytes() if f else None for i, f in enumerate(filled)], pa.binary()),
                    ],
                    names=["row_id", "n", "h1", "h2", "bands", "sig"],
                )
            give_back()

    return df.mapInArrow(run, f"row_id {kind}, n long, h1 long, h2 long, bands array<long>, sig binary")


def _bytes_matrix(column: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of a matrix."""
    joined = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return joined.reshape(len(column), -1) if len(column) else joined.reshape(0, 1)


def survivors(a: np.ndarray, b: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signatures (rows of a and b; a may be one row) stay after all batches."""
    alive, matches, low = np.arange(len(b)), np.zeros(len(b), np.int64), 0
    for n, least in needed:
        left = a[alive, low:n] if len(a) == len(b) else a[:, low:n]
        matches[alive] += (left == b[alive, low:n]).sum(axis=1)
        alive, low = alive[matches[alive] >= least], n
    return alive


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact comparison of two sorted sets."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _prune(pairs: DataFrame, nodes: DataFrame, needed: list[tuple[int, int]]) -> DataFrame:
    """(u, v) of pairs whose signatures keep a chance."""
    v = nodes.select(F.col("node").alias("v"), F.col("sig").alias("sig_v"))
    u = nodes.select(F.col("node").alias("u"), F.col("sig").alias("sig_u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = survivors(_bytes_matrix(batch.column(2)), _bytes_matrix(batch.column(3)), needed)
            yield batch.select([0, 1]).take(pa.array(keep))

    return pairs.join(v, "v").join(u, "u").select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u long, v long")


def _sets_of(df: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, items): the full sets of the wanted nodes (node, h1, h2, n, rep), each once."""
    slots = wanted.select((F.pmod(F.xxhash64("rep"), F.lit(BITMAP_BITS))).alias("slot"))
    words32k = slots.groupBy(F.floor(F.col("slot") / 32768).cast("int").alias("w")).agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits"))
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)  # at most 256 rows of 4 KB
    for row in words32k.collect():
        bitmap[row["w"] * 4096 : (row["w"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    sent = df.sparkSession.sparkContext.broadcast(bitmap)
    source = df.select("row_id", F.pmod(F.xxhash64("row_id"), F.lit(BITMAP_BITS)).alias("slot"), "body")
    kind = source.schema["row_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            slot = batch.column(1).to_numpy()
            batch = batch.take(pa.array(np.flatnonzero((bits[slot // 8] >> (slot % 8)) & 1)))
            for part in slices(batch.column(2)):
                hashes, bounds = shingle_sets(part, size)
                h1, h2 = set_hashes(hashes, bounds)
                items = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), pa.array(np.diff(bounds), pa.int64()), pa.array(h1), pa.array(h2), pa.array(items, pa.binary())],
                    names=["row_id", "n", "h1", "h2", "items"],
                )
            give_back()

    found = source.mapInArrow(run, f"row_id {kind}, n long, h1 long, h2 long, items binary")
    keyed = found.join(wanted, (found["h1"] == wanted["h1"]) & (found["h2"] == wanted["h2"]) & (found["n"] == wanted["n"]) & found["row_id"].eqNullSafe(wanted["rep"]))
    return keyed.groupBy("node").agg(F.any_value("items").alias("items"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) of pairs whose full sets are similar."""
    v = sets.select(F.col("node").alias("v"), F.col("items").alias("items_v"))
    u = sets.select(F.col("node").alias("u"), F.col("items").alias("items_u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = [
                i for i in range(batch.num_rows)
                if similar(np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64), percent)
            ]
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))
            give_back()

    return pairs.join(v, "v").join(u, "u").select("u", "v", "items_u", "items_v").mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: the smallest node it can reach. Star rounds, each a written table."""
    links = materialize(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    while True:
        up = links.select(F.col("v").alias("node"), F.col("u").alias("near"))
        settled = links.join(up.select(F.col("node").alias("u")), "u", "left_semi").isEmpty()
        if settled and up.groupBy("node").count().filter("count > 1").isEmpty():
            return up.withColumnRenamed("near", "root").unionAll(links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        # Larger neighbours of a node move to the least of its neighbourhood ...
        around = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = links.join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        # ... then so do its smaller ones, and the node itself.
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(lower, "v").select(F.col("m").alias("a"), F.col("u").alias("b"))
        small = moved.unionAll(lower.select(F.col("m").alias("a"), F.col("v").alias("b"))).filter("a <> b")
        links = materialize(small.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())


def _blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, block, node, root) of buckets whose members (key, node) lie in more than one component."""
    rooted = members.join(roots.withColumnRenamed("node", "rooted"), F.col("node") == F.col("rooted"), "left").select(
        "key", "node", F.coalesce("root", "node").alias("root")
    )
    rooted = materialize(rooted)
    shares = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    largest = F.max(F.struct("c", "root"))
    live = shares.groupBy("key").agg(F.sum("c").alias("all"), largest.alias("top"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    live = live.select(
        "key", F.col("top.root").alias("top"),
        F.ceil(F.col("top.c") / BLOCK).alias("many"), F.ceil((F.col("all") - F.col("top.c")) / BLOCK).alias("few"),
    )
    rows = rooted.join(live, "key")
    # Blocks of the largest component are numbered below 0, blocks of the rest from 0 on. A meeting
    # is (block, block of the rest); a bucket that fits one block meets once, as a whole.
    whole = (F.col("many") == 1) & (F.col("few") == 1)
    own = F.pmod(F.xxhash64("node"), F.when(F.col("root") == F.col("top"), F.col("many")).otherwise(F.col("few")))
    meetings = (
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))))
        .when(F.col("root") == F.col("top"), F.expr("transform(sequence(0L, few - 1), j -> named_struct('x', -1 - own, 'y', j))"))
        .otherwise(
            F.expr(
                "concat(transform(sequence(0L, many - 1), i -> named_struct('x', -1 - i, 'y', own)),"
                " transform(sequence(0L, few - 1), j -> named_struct('x', least(j, own), 'y', greatest(j, own))))"
            )
        )
    )
    dealt = rows.withColumn("own", own.cast("long")).withColumn("block", F.explode(meetings))
    return dealt.select("key", F.col("block.x").alias("x"), F.col("block.y").alias("y"), "node", "root")


def _meet(rows: DataFrame, needed: list[tuple[int, int]], percent: int | None) -> DataFrame:
    """Compare the members of each meeting (key, x, y) that lie in different components.

    Without `percent`, returns the members (key, x, y, node, root, sig) that have a surviving
    partner; with it, confirmed links (u, v).
    """
    fields = ["key", "x", "y", "node", "root", "sig", *([] if percent is None else ["items"])]
    sorted_rows = rows.select(fields).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")

    def candidates(table: pa.Table) -> list[tuple]:
        node, root = table["node"].to_numpy(), table["root"].to_numpy()
        sig = _bytes_matrix(table["sig"].combine_chunks())
        if percent is None:
            keep = np.zeros(len(node), bool)
            for i in range(len(node) - 1):
                other = i + 1 + np.flatnonzero(root[i + 1 :] != root[i])
                found = other[survivors(sig[i : i + 1], sig[other], needed)]
                keep[found] = True
                keep[i] |= len(found) > 0
            return [(i,) for i in np.flatnonzero(keep)]
        root, links = root.copy(), []
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"].combine_chunks()]
        for i in range(len(node) - 1):
            other = i + 1 + np.flatnonzero(root[i + 1 :] != root[i])
            for j in other[survivors(sig[i : i + 1], sig[other], needed)]:
                if root[i] != root[j] and similar(sets[i], sets[j], percent):
                    links.append((int(node[i]), int(node[j])))
                    root[root == root[j]] = root[i]
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle(table: pa.Table) -> pa.RecordBatch | None:
            found = candidates(table) if table.num_rows > 1 else []
            if not found:
                return None
            if percent is None:
                return table.take([i for (i,) in found]).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if held and any(held[-1].column(i)[held[-1].num_rows - 1] != batch.column(i)[0] for i in range(3)):
                out = settle(pa.Table.from_batches(held))
                held = []
                if out:
                    yield out
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                held.append(batch.slice(a, b - a))
                if b < batch.num_rows:
                    out = settle(pa.Table.from_batches(held))
                    held = []
                    if out:
                        yield out
        if held:
            out = settle(pa.Table.from_batches(held))
            if out:
                yield out

    return sorted_rows.mapInArrow(run, "u long, v long" if percent is not None else "key long, x long, y long, node long, root long, sig binary")


def _marked(df: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """(row_id, h1, h2, n, component, kept) per row of `df`; rows of one id and one set share their fate."""
    bands = bands_for(percent, rows, miss)
    needed = least_matches(rows * bands, percent, miss)
    source = df.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("body"))
    described = materialize(_describe(source, size, rows, bands))
    key = ["h1", "h2", "n"]
    nodes = materialize(
        described.filter("n > 0").groupBy(*key).agg(F.min("row_id").alias("rep"), F.any_value(F.struct("bands", "sig")).alias("s"))
        .select(F.monotonically_increasing_id().alias("node"), *key, "rep", "s.bands", "s.sig")
    )

    banded = nodes.select("node", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = materialize(banded.join(hubs, "key").filter("node <> hub"))
    pairs = members.select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    likely = materialize(_prune(pairs, nodes, needed))
    in_pairs = likely.select(F.col("u").alias("node")).unionAll(likely.select("v")).distinct()
    wanted = nodes.join(in_pairs, "node", "left_semi").select("node", *key, "rep")
    links = materialize(_confirm(likely, materialize(_sets_of(source, wanted, size)), percent))

    roots = materialize(components(links))
    blocks = _blocks(members.filter("c > 2").select("key", "node"), roots)
    left = materialize(_meet(blocks.join(nodes.select("node", "sig"), "node"), needed, None))
    if not left.isEmpty():
        wanted = nodes.join(left.select("node").distinct(), "node", "left_semi").select("node", *key, "rep")
        more = materialize(_meet(left.join(_sets_of(source, wanted, size), "node"), needed, percent))
        if not more.isEmpty():
            roots = materialize(components(links.unionAll(more)))

    named = nodes.join(roots.withColumnRenamed("node", "rooted"), F.col("node") == F.col("rooted"), "left").select(*key, "rep", "root")
    least = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("first"))
    classes = named.join(least, "root", "left").select(*key, F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("first")).alias("component"))
    out = described.select("row_id", *key).join(classes, key, "left")
    component = F.when(F.col("n") == 0, F.col("row_id")).otherwise(F.col("component"))
    return out.select("row_id", *key, component.alias("component"), F.col("row_id").eqNullSafe(component).alias("kept"))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, miss: float = MISS,
) -> DataFrame:
    """One row per row of `df`: id, n_shingles, component_id (smallest id of the group), kept."""
    return _marked(df, id_col, text_col, size, percent, rows, miss).select(
        F.col("row_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


def _set_key(size: int):
    """Function of a text column: (h1, h2, n) of its set."""

    def run(texts: pa.Array) -> pa.Array:
        found = []
        for part in slices(texts):
            hashes, bounds = shingle_sets(part, size)
            h1, h2 = set_hashes(hashes, bounds)
            found.append(np.stack([h1, h2, np.diff(bounds)]))
        columns = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h1", "h2", "n"])

    return F.arrow_udf(run, "h1 long, h2 long, n long")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `df`, all columns, of one document per group. Only rows whose id a bitmap finds among those that go are shuffled.

    An id (null is one) may stand for several texts, of which some go: its rows are told apart by their sets.
    """
    marked = materialize(_marked(df, id_col, text_col, **how))
    fates = marked.groupBy(F.col("row_id").alias("gone_id")).agg(F.bool_and("kept").alias("all"), F.bool_or("kept").alias("some"))
    fates = materialize(fates.filter("NOT all"))
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("row_id"))
    sure, unsure = split_by_bitmap(rows, "row_id", fates.select("gone_id"))
    gone = fates.filter("NOT some")
    stay = unsure.join(gone, unsure["row_id"].eqNullSafe(gone["gone_id"]), "left_anti")
    torn = fates.filter("some").select("gone_id")
    if not torn.isEmpty():
        parts = marked.filter("NOT kept").join(torn, F.col("row_id").eqNullSafe(F.col("gone_id")), "left_semi")
        parts = materialize(parts.select(F.col("row_id").alias("gone_id"), F.struct("h1", "h2", "n").alias("gone_set")).distinct())
        key = _set_key(how.get("size", SHINGLE))(F.col("row").getField(text_col).cast("string"))
        keyed = stay.withColumn("set", key)
        stay = keyed.join(parts, keyed["row_id"].eqNullSafe(parts["gone_id"]) & (keyed["set"] == parts["gone_set"]), "left_anti")
    return sure.select("row").unionByName(stay.select("row")).select("row.*")
