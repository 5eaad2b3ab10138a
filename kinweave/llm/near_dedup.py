"""MinHash near-deduplication with SuperMinHash signatures.

A document's set holds its distinct five-word shingles (fewer words: the whole sequence as one; none:
empty). SuperMinHash gives each shingle a random permutation of the signature's places and, at level
j, a value in [j, j+1) for its j-th place; a document stops at the first level at which every place is
filled. Bands of the signature propose candidates, full sets confirm them, union-find groups them.

Equal sets are one class from the start, so that copies cost a sum, not pairs. Inside a bucket of a
band, every class is first held against one pivot, the class that shares most buckets. Where classes of a pivot are then still in different
components, a task gets all sets of the bucket and counts what each pair of them shares, where these sets are few and small enough for that by their counted size; of
what is linked, it hands back one edge a class. Larger buckets are sifted around a core, the items that most of the classes have. With D(x) as what x and
the core differ in, x and y differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)| items. So slack(x) = (100 - percent) |x| - (100 + percent) |D(x)| says all:
two classes whose slacks sum to 0 or more are linked, hence each of them with the class of the largest slack, an edge for each class; other classes
can only be linked if D(x) and D(y) share enough items, hence one of their first ones (a prefix filter; items that are rare in the bucket come first, by a
sample of its sets, those of the core last). Classes that share such an item are a cell. In small cells, pairs are compared for which as many items as they need can
still follow the shared one; large cells, one of those with the same classes, are sifted again around a core of their own.
Nothing is lost within a bucket whatever the core is, and no partner is capped. A bucket of near copies thus
costs about its size; one of large families whose classes stay below the threshold costs more than that in each round, since a class goes on in several cells.

Defined results: null or blank texts have an empty set, link with nothing and are kept; rows with
a null id link with nothing and have a null component; rows that share an id are one document, so what one of them links with is
linked with all of them, whatever their texts. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import forget, released, semi_by_id, stored, text_batches, text_slices
from kinweave.llm.components import components

SHINGLE_WORDS = 5
#: 16 bands of 4 places: of pairs with similarity 0.85, fewer than one in 100,000 share no band.
PLACES, BANDS = 64, 16
PERCENT = 85
#: Buckets up to so many classes and items, over all of their sets, are compared whole in one task, with so many items at once.
HELD_CLASSES, HELD_ITEMS, HELD_BLOCK = 1_000, 1_000_000, 4_096
#: Sets that a core is made of, about; cells of so many classes or fewer are compared pair by pair; rounds of sifting.
CORE_SETS, SMALL_CELL, ROUNDS = 32, 64, 4
BLOCK_SHINGLES = 200_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words_each: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles."""
    out = []
    digest = xxhash.xxh64_intdigest
    for t in texts:
        words = (t or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z is lowered, only \x20\x09-\x0D splits
        n = len(words)
        h = np.fromiter(map(digest, words), np.uint64, n)
        k = min(n, words_each)
        if not n:
            out.append(h)
            continue
        s = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            s += mix(h[i : n - k + 1 + i] * _ODD[i % 5] + np.uint64(i))
        out.append(np.unique(mix(s)))
    return out


def superminhash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """A row of places for each set: level in the upper bits, 24 bits of the random value below; all ones for an empty set."""
    sig = np.full((len(sets), places), 0xFFFFFFFF, np.uint32)
    start = 0
    while start < len(sets):
        end, held = start, 0
        while end < len(sets) and (end == start or held + len(sets[end]) <= BLOCK_SHINGLES):
            held += len(sets[end])
            end += 1
        _levels(sig[start:end], sets[start:end], places)
        start = end
    return sig


def _levels(sig: np.ndarray, sets: list[np.ndarray], places: int) -> None:
    x = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = None
    flat = sig.reshape(-1)
    for j in range(places):
        if not len(x):
            return
        r = mix(x + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) % 2**64))
        value = ((r & np.uint64(0xFFFFFF)) | np.uint64(j << 24)).astype(np.uint32)
        k = j + (((r >> np.uint64(32)) * np.uint64(places - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            place, first_k = k, k
        else:
            if order is None:  # only what lives past the first level needs its permutation
                order = np.tile(np.arange(places, dtype=np.uint8), (len(x), 1))
                rows = np.arange(len(x))
                order[rows, first_k] = 0
                order[:, 0] = first_k
            rows = np.arange(len(x))
            place = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
            order[:, j] = place
        np.minimum.at(flat, doc * places + place, value)
        alive = (sig == 0xFFFFFFFF).any(axis=1)[doc]
        if not alive.all():
            x, doc = x[alive], doc[alive]
            first_k = first_k[alive]
            order = order[alive] if order is not None else None


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    n, places = sig.shape
    rows = places // bands
    v = sig.reshape(n, bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    for i in range(rows):
        key = mix(key * _ODD[0] + v[:, :, i])
    return key.view(np.int64)


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, key (of the whole set, null if empty) and bands for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                sets = shingle_sets(texts)
                keys = [set_key(s) for s in sets]
                bands = band_keys(superminhash(sets))
                lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), pa.array(bands.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.string()), lists], names=["id", "n_shingles", "key", "bands"])

    rows = text_batches(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))
    return rows.mapInArrow(lambda batches: released(run(batches)), "id long, n_shingles long, key string, bands array<long>")


def set_key(s: np.ndarray) -> str | None:
    """128 bits for a whole set; none for the empty one."""
    return f"{int(mix(s).sum()):016x}{int(np.bitwise_xor.reduce(mix(s ^ _ODD[1]))):016x}" if len(s) else None


def sets_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key and full shingle set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                sets = shingle_sets(texts)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.string()), lists], names=["key", "items"])

    rows = text_batches(df.select(F.col(text_col).cast("string").alias("text")))
    return rows.mapInArrow(lambda batches: released(run(batches)), "key string, items array<long>")


def fits(n: Column, m: Column, percent: int) -> Column:
    """Sets of these sizes can be that similar."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def together(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (u, v, ...) with the full sets a of u and b of v."""
    a = sets.select(F.col("id").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("items").alias("b"))
    return pairs.join(a, "u").join(b, "v")


def similar(both: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * both >= percent * (n + m - both)


def differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """g, u, slack and delta (what u and the core of g differ in, in one order for all of g) of the members (g, u).

    The core holds the items of more than half of about CORE_SETS sets of g, drawn by a hash: any core is right, a typical one makes deltas short.
    """
    sizes = members.groupBy("g").agg(F.count("*").alias("size"))
    draw = F.pmod(F.xxhash64(F.lit("core"), "u"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    own = sets.select(F.col("id").alias("u"), "items")
    drawn = members.join(sizes, "g").where(draw < F.lit(float(CORE_SETS)) / F.col("size")).join(own, "u")
    cores = drawn.groupBy("g").agg(F.sort_array(F.flatten(F.collect_list("items"))).alias("all"), (F.floor(F.count("*") / 2) + 1).cast("int").alias("most"))
    held = lambda n: F.filter("all", lambda x, i: (F.get("all", i + n - 1) == x) & ~F.coalesce(F.get("all", i - 1) == x, F.lit(False)))
    cores = cores.select("g", held(F.col("most")).alias("core"), held(F.lit(2)).alias("known"))
    cores = stored(cores.select("g", "core", F.array_except("known", "core").alias("known")))
    # the sets travel to the cores, which are sent once for each g
    both = members.join(own, "u").join(cores, "g", "left")
    both = both.withColumns({c: F.coalesce(c, F.array().cast("array<long>")) for c in ("core", "known")})
    # rare items come first, so that few classes meet on them: own ones that the drawn sets don't repeat, then those they do, then what the core has
    extra = F.array_except("items", "core")
    delta = F.concat(F.sort_array(F.array_except(extra, "known")), F.sort_array(F.array_intersect(extra, "known")), F.sort_array(F.array_except("core", "items")))
    both = both.select("g", "u", F.size("items").cast("long").alias("n"), delta.alias("delta"))
    return both.select("g", "u", ((100 - percent) * F.col("n") - (100 + percent) * F.size("delta")).alias("slack"), "delta")


def labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.join(labels.select(F.col("node").alias("u"), "component"), "u", "left").withColumn("label", F.coalesce("component", "u")).drop("component")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that are linked by their full sets."""
    both = together(pairs, sets)
    return both.where(similar(F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b"), percent)).select("u", "v")


def all_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (u, v) of members (g, u, label, slack, rest, first, second) with different labels: one that may be first and one, of no larger slack, that may be second.

    Two classes that are linked share, from their first common item on, as many items as their slacks lack; after the cell's item only the shorter rest can follow.
    """
    left, right = (cells.where(role).select("g", *[F.col(c).alias(f"{c}{i}") for c in ("u", "label", "slack", "rest")]) for i, role in ((1, "first"), (2, "second")))
    ordered = (F.col("slack1") > F.col("slack2")) | ((F.col("slack1") == F.col("slack2")) & (F.col("u1") > F.col("u2")))
    enough = F.col("slack1") + F.col("slack2") + 2 * (100 + percent) * (1 + F.least("rest1", "rest2")) >= 0
    apart = left.join(right, "g").where((F.col("label1") != F.col("label2")) & ordered & enough)
    return apart.select(F.greatest("u1", "u2").alias("u"), F.least("u1", "u2").alias("v")).distinct()


def plain(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Members (g, u) for all_pairs, of which nothing is known but their labels."""
    return labelled(members, components(edges)).select("g", "u", "label", F.lit(0).alias("slack"), F.lit(0).alias("rest"), F.lit(True).alias("first"), F.lit(True).alias("second"))


def linked_to_first(items: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the place of the first set that a chain of links leads to; every pair is compared by the number of items that it shares."""
    n = np.array([len(s) for s in items])
    values, at, times = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1  # an item of a single set is shared by no pair
    row = np.repeat(np.arange(len(n)), n)
    shared = times[at] > 1
    row, column = row[shared], place[at[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(n), len(n)), np.float32)  # counts stay far below 2^24
    for start in range(0, int((times > 1).sum()), HELD_BLOCK):
        a, b = np.searchsorted(column, [start, start + HELD_BLOCK])
        m = np.zeros((len(n), HELD_BLOCK), np.float32)
        m[row[a:b], column[a:b] - start] = 1
        both += m @ m.T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    first = np.full(len(n), -1)
    for i in range(len(n)):
        if first[i] < 0:
            reached = np.zeros(len(n), bool)
            reached[i] = True
            while (more := reached | linked[reached].any(axis=0)).sum() > reached.sum():
                reached = more
            first[reached] = i
    return first


def compared_whole(members: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) that join what is linked among the members (g, u, items) of the same group."""

    def run(table: pa.Table) -> pa.Table:
        u = table.column("u").to_numpy()
        order = np.argsort(u)
        lists = table.column("items").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        u, first = u[order], linked_to_first([flat[ends[i] : ends[i + 1]] for i in order], percent)
        new = first != np.arange(len(u))
        return pa.table({"u": u[new], "v": u[first[new]]})

    return members.select("g", "u", "items").groupBy("g").applyInArrow(run, "u long, v long")


def sifted(members: DataFrame, sets: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """edges, and what else links the members (g, u) of the same group; all of them have been held against the class g."""
    own = sets.select(F.col("id").alias("u"), F.size("items").cast("long").alias("n"))
    sizes = stored(members.join(own, "u").groupBy("g").agg(F.count("*").alias("size"), F.sum("n").alias("total")))
    held = (F.col("size") <= HELD_CLASSES) & (F.col("total") <= HELD_ITEMS)
    whole = members.join(sizes.where(held).select("g"), "g").join(sets.select(F.col("id").alias("u"), "items"), "u")
    edges = stored(edges.unionByName(compared_whole(whole, percent)))
    members = stored(members.join(sizes.where(~held).select("g"), "g"))
    forget(sizes)
    for _ in range(ROUNDS):
        if not members.limit(1).count():
            return edges
        each = stored(differences(members, sets, percent))
        top = stored(each.groupBy("g").agg(F.max(F.struct("slack", "u")).alias("t")).select("g", F.col("t.slack").alias("best"), F.col("t.u").alias("top")))
        diff = each.join(top, "g")
        edges = stored(edges.unionByName(diff.where("u != top and slack + best >= 0").select("u", F.col("top").alias("v")).distinct()))
        loose = F.col("slack") + F.col("best") < 0
        # The fewest items of delta that two linked classes share follows from the sum of their slacks. The class with the larger slack
        # meets no larger one than its own (or, if linked with the best one, only loose ones), the other one's partner is at most the best.
        fewest = lambda total: F.ceil(-total / (2 * (100 + percent)))
        first = fewest(F.when(loose, 2 * F.col("slack")).otherwise(F.col("slack") - F.col("best") - 1))
        second = fewest(F.col("slack") + F.col("best"))
        size = F.size("delta")
        diff = diff.select("g", "u", "slack", loose.alias("second"), size.alias("size"), (size - first).alias("last"), F.slice("delta", 1, F.greatest(size + 1 - F.when(loose, second).otherwise(first), F.lit(0)).cast("int")).alias("prefix"))
        # labels come to the classes, before each of them becomes a row for every item of its prefix
        cells = labelled(diff, components(edges)).select("g", "u", "label", "slack", "second", "size", "last", F.posexplode("prefix").alias("at", "item"))
        split = stored(cells.select("u", "label", "slack", "second", (F.col("size") - F.col("at") - 1).alias("rest"), (F.col("at") <= F.col("last")).alias("first"), F.xxhash64("g", "item").alias("g")))
        forget(each, top)
        mark = lambda name: F.bit_xor(F.xxhash64(F.lit(name), "u")).alias(name)
        open_ = split.groupBy("g").agg(F.count("*").alias("size"), F.min("label").alias("a"), F.max("label").alias("b"), F.max("first").alias("f"), F.max("second").alias("s"), mark("x"), mark("y"))
        open_ = stored(open_.where("a != b and f and s").select("g", "size", "x", "y"))
        small = split.join(open_.where(F.col("size") <= SMALL_CELL).select("g"), "g")
        edges = stored(edges.unionByName(confirmed(all_pairs(small, percent), sets, percent)))
        # items that the same classes have, as those of a common passage, make equal cells: one of them stands for all
        large = open_.where(F.col("size") > SMALL_CELL).groupBy("size", "x", "y").agg(F.min("g").alias("g"))
        members = stored(split.join(large.select("g"), "g").select("g", "u"))
        forget(split, open_)
    return stored(edges.unionByName(confirmed(all_pairs(plain(members, edges), percent), sets, percent)))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of df."""
    rows = stored(signatures(df, id_col, text_col))
    named = rows.where("key is not null and id is not null")
    classes = named.groupBy("key").agg(F.min("id").alias("id"), F.min("n_shingles").alias("n"), F.min_by("bands", "id").alias("bands"))
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))  # a number for each class, fixed once it is written
    # one row for each class and band; only buckets of two classes or more matter
    slots = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    buckets = stored(slots.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
    members = stored(slots.join(buckets, "bucket"))
    weight = stored(members.groupBy("rep").agg(F.sum("size").alias("weight")))
    weighed = stored(members.join(weight, "rep").select("bucket", "rep", "n", "weight"))
    pivots = stored(weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("p")).select("bucket", (-F.col("p.minus")).alias("v")))
    pairs = stored(weighed.join(pivots, "bucket").select(F.col("rep").alias("u"), "v", "n").distinct())
    need = stored(weighed.select("rep").distinct().join(classes.select("rep", "key", "id"), "rep"))
    n_need = need.count()
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text_"))
    texts = semi_by_id(docs, need.select("id").distinct(), n_need, "id")
    sets = semi_by_id(sets_of(texts, "id", "text_"), need.select("key", F.col("rep").alias("id")), n_need, "key", "inner")
    sets = stored(sets.select("id", "items").dropDuplicates(["id"]))
    forget(members, weight, weighed, buckets, pivots)
    pairs = pairs.select("u", "v")
    linked = similar(F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b"), percent)
    held = stored(together(pairs.where("u != v"), sets).select("u", "v", linked.alias("linked")))
    # rows that share an id are one document: their classes hang together
    several = named.join(classes.select("key", "rep"), "key").groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v < most")
    several = stored(several.select("id", "v"))
    edges = held.where("linked").select("u", "v")
    if n_several := several.count():
        shared = semi_by_id(named.select("id", "key").distinct(), several, n_several, "id", "inner").join(classes.select("key", F.col("rep").alias("u")), "key").where("u != v")
        edges = edges.unionByName(shared.select("u", "v"))
    edges = stored(edges)
    labels = components(edges)
    apart = labelled(held.where("not linked"), labels).withColumnRenamed("label", "own").withColumnRenamed("u", "w").withColumnRenamed("v", "u")
    apart = stored(labelled(apart, labels).where("own != label").select(F.col("u").alias("v")).distinct())
    if apart.limit(1).count():
        members = stored(pairs.join(apart, "v").select(F.col("v").alias("g"), "u"))
        labels = components(sifted(members, sets, edges, percent))
    forget(sets, held, need, several)
    marked = classes.select("key", "rep", "id").join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = marked.groupBy("component").agg(F.min("id").alias("component_id"))
    marked = stored(marked.join(smallest, "component").select("key", "component_id"))
    return (
        rows.select("id", "n_shingles", "key")
        .join(marked, "key", "left")
        .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )
