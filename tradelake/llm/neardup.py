"""Near duplicates by bands of min-hash labels with leaders, in place of an LSH forest.

A document is the set of its shingles of `words` words. Each of `trees` trees has its own min-hash labels; documents
with the same DEPTH labels form a region of that tree, found by a hash of these labels. Nothing is sorted, no
neighbours by longest common prefix are taken and the depth is the same everywhere. Candidates are documents of one region:

- a small region gives all its pairs;
- in a large region every document is first paired with one leader, the member that shares most regions. After
  these pairs are confirmed, documents outside the region's largest component are compared with the rest, block by
  block, on their full sets: the shingles of a block are indexed, so that common ones are counted for a document at once.

So every pair of one region that could still join two components is judged, and every link is confirmed on the full
sets. Two documents of likeness s share no region with probability (1 - s**DEPTH)**trees, which is 8e-7 for 24 trees at
0.85 and 6e-7 for 36 trees at 0.8. Documents with equal sets are one node from the start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import drop, free_name, ship_package, stage, texts
from tradelake.llm.hashing import mix, word_hashes

DEPTH = 5
# Members of a region that gives all its pairs, and rows of a block of a larger one.
SMALL, BLOCK = 16, 512


@dataclass(frozen=True)
class Likeness:
    """Shingles of `words` words, linked if `percent` alike or more, sought with `trees` trees."""

    words: int = 5
    percent: int = 80
    trees: int = 36

    @property
    def labels(self) -> int:
        return self.trees * DEPTH


_draw = np.random.default_rng(11)
_XOR = _draw.integers(0, 2**32, 1024, dtype=np.uint64).astype(np.uint32)
_ODD = _draw.integers(0, 2**32, 1024, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of `size` words; a text of fewer words is one; none without words."""
    words = word_hashes((text or "").encode().lower())  # bytes lower only A-Z
    n = len(words)
    if not n:
        return words
    if n < size:
        return mix(np.array([sum(int(w) * (i + 3) for i, w in enumerate(words)) + n & 2**64 - 1], np.uint64))
    rolled = mix(words[: n - size + 1] * _A)
    for i in range(1, size):
        rolled = mix(rolled * _B + words[i : n - size + 1 + i] * _C)
    return np.unique(rolled)


def signature(found: np.ndarray, labels: int) -> np.ndarray:
    """The smallest value of the set under each of `labels` permutations."""
    low = np.full(labels, 2**32 - 1, np.uint32)
    xor, odd = _XOR[:labels], _ODD[:labels]
    short = (found >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 4096):
        np.minimum(low, ((short[i : i + 4096, None] ^ xor) * odd).min(0), out=low)
    return low


def regions_of(labels: np.ndarray) -> np.ndarray:
    """A hash of the DEPTH labels of each tree."""
    region = np.zeros(len(labels) // DEPTH, np.uint64)
    for label in labels.reshape(-1, DEPTH).T:
        region = mix(region * _A + label)
    return region


def common_shingles(one: np.ndarray, shingle: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """How many shingles of the set `one` each owner has; `shingle` is sorted, `owner` says whose each is."""
    both = np.zeros(owners, np.int64)
    for at in range(0, len(one), 2048):  # a hot shingle is had by every owner
        part = one[at : at + 2048]
        low, high = np.searchsorted(shingle, part), np.searchsorted(shingle, part, "right")
        many = high - low
        places = np.arange(many.sum()) + np.repeat(low - (np.cumsum(many) - many), many)
        both += np.bincount(owner[places], minlength=owners)
    return both


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("text_key"))


def sketches(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, text_key, n_shingles, set_hash (of the whole set; 128 bits), regions of each row.

    An id and a text_key together name a text, also where an id is used twice.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sizes, hashes, regions = [], [], []
            for text in b.column("text").to_pylist():
                found = shingles(text, like.words)
                sizes.append(len(found))
                both = (int(found.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(found * _A)))) if len(found) else (0, 0)
                hashes.append(b"".join(x.to_bytes(8, "little") for x in both))
                regions.append(regions_of(signature(found, like.labels)).tobytes() if len(found) else b"")
            arrays = [b.column("doc_id"), b.column("text_key"), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), pa.array(regions, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n_shingles", "set_hash", "regions"])

    ship_package(docs.sparkSession)
    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_hash binary, regions binary")


def forest(nodes: DataFrame, like: Likeness) -> DataFrame:
    """node, n_shingles, tree, region: the place of each node in each tree."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            region = np.frombuffer(b"".join(b.column("regions").to_pylist()), np.int64)
            n = b.num_rows
            out = [np.repeat(b.column(c).to_numpy(), like.trees) for c in ("node", "n_shingles")]
            out += [np.tile(np.arange(like.trees, dtype=np.int32), n), region]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["node", "n_shingles", "tree", "region"])

    return nodes.select("node", "n_shingles", "regions").mapInArrow(run, "node long, n_shingles long, tree int, region long")


def _of_like_size(a: str, b: str, like: Likeness):
    """Sets can only be `percent` alike if their sizes are."""
    x, y = F.col(a), F.col(b)
    return 100 * F.least(x, y) >= like.percent * F.greatest(x, y)


def small_pairs(members: DataFrame, like: Likeness) -> DataFrame:
    """All pairs of small regions; a region has SMALL members at most, so its pairs are bounded."""
    groups = members.where(F.col("m") <= SMALL).groupBy("tree", "region").agg(
        F.array_sort(F.collect_list(F.struct("node", "n_shingles"))).alias("all")
    )
    first = groups.select("all", F.posexplode("all").alias("i", "x"))
    both = first.select("x", F.explode(F.slice("all", F.col("i") + 2, F.lit(SMALL))).alias("y"))
    flat = both.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n_shingles").alias("na"), F.col("y.n_shingles").alias("nb"))
    return flat.where(_of_like_size("na", "nb", like)).select("a", "b")


def leader_pairs(members: DataFrame, like: Likeness) -> DataFrame:
    """Every member of a large region with the region's leader: the member whose regions are largest in sum."""
    weights = members.groupBy("node").agg(F.sum("m").alias("weight"))
    large = members.where(F.col("m") > SMALL).join(weights, "node")
    best = F.max(F.struct("weight", (-F.col("node")).alias("minus"), F.col("n_shingles").alias("n"))).alias("best")
    leaders = stage(large.groupBy("tree", "region").agg(best), "leaders")
    led = large.join(leaders, ["tree", "region"]).withColumn("leader", -F.col("best.minus"))
    led = led.withColumn("n_leader", F.col("best.n")).where(_of_like_size("n_shingles", "n_leader", like) & (F.col("node") != F.col("leader")))
    # The leader is `b`: rows of one leader lie together when links are confirmed.
    return led.select(F.col("node").alias("a"), F.col("leader").alias("b"))


def confirmed(pairs: DataFrame, bodies: DataFrame, like: Likeness) -> DataFrame:
    """The pairs whose full sets are `percent` alike. `bodies` has node and text of every node in a pair."""

    def run(batches):
        import pyarrow as pa

        last, kept = None, None
        for batch in batches:
            hits = []
            for b, x, y in zip(*[batch.column(c).to_pylist() for c in ("b", "text_a", "text_b")], strict=True):
                if b != last or kept is None:
                    last, kept = b, shingles(y, like.words)
                one = shingles(x, like.words)
                both = len(np.intersect1d(one, kept, assume_unique=True))
                hits.append(both > 0 and 100 * both >= like.percent * (len(one) + len(kept) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(hits, pa.bool_()))

    one = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of an edge; edges are (a, b).

    Each round takes the smallest label among neighbours and then the label of that label, so that chains shorten
    by half. Every round's labels are written to the shared folder.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels"
    )
    before = labels
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("lower"))
        of = labels.select(F.col("node").alias("lower"), F.col("component").alias("jump"))
        jumped = lower.join(of, "lower").select(
            "node", F.least("lower", "jump").alias("new"), (F.least("lower", "jump") != F.col("component")).alias("moved")
        )
        step = stage(jumped, "labels")
        labels = step.select("node", F.col("new").alias("component"))
        drop(before)
        if step.where("moved").isEmpty():
            drop(both)
            return labels
        before = step


def leftover_links(members: DataFrame, labels: DataFrame, nodes: DataFrame, bodies: DataFrame, like: Likeness) -> DataFrame:
    """Links inside large regions between documents that are still in different components.

    Of a region's components the largest is compared with all others, these also among themselves. Both sides are
    dealt to blocks of BLOCK rows with their texts, and every two documents of unlike components are compared there on
    their full sets, in the first tree that has them in one region. Only links leave a block, at most as many as join
    its documents, so no table of pairs is made.
    """
    large = members.where(F.col("m") > SMALL).select("tree", "region", "node", "n_shingles")
    known = labels.select("node", "component")
    placed = large.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    per = placed.groupBy("tree", "region", "component").count()
    main = per.groupBy("tree", "region").agg(
        F.max(F.struct("count", "component")).alias("main"), F.sum("count").alias("m"), F.count(F.lit(1)).alias("parts")
    )
    main = main.where("parts > 1").select("tree", "region", F.col("main.component").alias("main"), "m", (F.col("m") - F.col("main.count")).alias("rest"))
    main = stage(main, "main-components")
    open_regions = stage(placed.join(main, ["tree", "region"]), "open-regions")
    cut = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    mine = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), cut(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), cut(n) - 1)
    row = ["tree", "region", "node", "n_shingles", "component"]
    asks = open_regions.where("component != main").withColumn("i", mine("rest", 1)).withColumn("j", F.explode(every("m"))).select(*row, "i", "j", F.lit(True).alias("asks"))
    rest = open_regions.withColumn("j", mine("m", 2)).withColumn("i", F.explode(every("rest"))).select(*row, "i", "j", F.lit(False).alias("asks"))
    full = nodes.select("node", "regions").join(bodies.select("node", "text"), "node")

    def compare(table):
        import pyarrow as pa

        side, tree = table.column("asks").to_numpy(), table.column("tree")[0].as_py()
        ids, n, part = (table.column(c).to_numpy() for c in ("node", "n_shingles", "component"))
        regions = np.frombuffer(b"".join(table.column("regions").to_pylist()), np.int64).reshape(-1, like.trees)[:, : tree + 1]
        sets = [shingles(text.as_py(), like.words) for text in table.column("text")]
        group = {p: p for p in part.tolist()}

        def top(p: int) -> int:
            while group[p] != p:
                group[p] = p = group[group[p]]
            return p

        q, r = np.flatnonzero(side), np.flatnonzero(~side)
        out = []
        shingle = np.concatenate([sets[y] for y in r]) if len(r) else np.zeros(0, np.uint64)
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], np.repeat(np.arange(len(r)), n[r])[order]
        for x in q.tolist():
            if (part[r] == part[x]).all():
                continue
            both = common_shingles(sets[x], shingle, owner, len(r))
            fit = r[(part[r] != part[x]) & (100 * both >= like.percent * (n[x] + n[r] - both))]
            for y in fit[(regions[fit] == regions[x]).argmax(1) == tree].tolist():
                one, two = top(int(part[x])), top(int(part[y]))
                if one != two:
                    group[one] = two
                    out.append((int(ids[x]), int(ids[y])))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return asks.union(rest).join(full, "node").groupBy("tree", "region", "i", "j").applyInArrow(compare, "a long, b long")


def _grouped(docs: DataFrame, like: Likeness) -> DataFrame:
    """The columns of `near_duplicates`, and text_key, of each row."""
    found = stage(sketches(docs, like), "sketches")
    full = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # A node is a class of equal sets. It has a number of its own, as its smallest id may also be that of another class.
    classes = full.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("class_id"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    firsts = classes.select(F.col("class_id").alias("doc_id"), "set_hash", "n_shingles", "node")
    nodes = stage(full.join(firsts, ["doc_id", "set_hash", "n_shingles"]).dropDuplicates(["node"]), "nodes")
    rows = stage(found.select("doc_id", "text_key", "n_shingles", "set_hash"), "sets")
    drop(found)
    placed = stage(forest(nodes, like), "forest")
    # Tables that are joined on a key that may be hot are written first: only then can the join split that key.
    regions = stage(placed.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "regions")
    members = stage(placed.join(regions, ["tree", "region"]), "members")
    drop(placed)
    first = stage(small_pairs(members, like).union(leader_pairs(members, like)).distinct(), "pairs")
    near = nodes.select("node", "doc_id", "text_key").join(members.select("node").distinct(), "node", "left_semi")
    bodies = stage(keyed(docs).join(near, ["doc_id", "text_key"]).select("node", "text").dropDuplicates(["node"]), "bodies")
    links = stage(confirmed(first, bodies, like), "links")
    labels = components(links)
    more = stage(leftover_links(members, labels, nodes, bodies, like), "links")
    if not more.isEmpty():
        drop(labels)
        labels = components(links.union(more))
    least = labels.join(classes.select("node", "class_id"), "node").groupBy("component").agg(F.min("class_id").alias("least"))
    named = stage(labels.join(least, "component").select("node", "least"), "components")
    for table in (nodes, regions, members, first, bodies, links, more, labels):
        drop(table)
    known = rows.join(classes, ["set_hash", "n_shingles"], "left")
    component = F.coalesce("least", "class_id", "doc_id")
    return known.join(named, "node", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept of each row.

    class_id is the smallest id with an equal set, component_id the smallest id reachable by links. A null or empty
    text, or one without words, has an empty set and is linked with nothing; so is a row with a null id, which is
    kept. Equal texts have equal sets and are linked. An id on several texts names each of them: every text has links
    and a group of its own, and each that lies in a group whose smallest id this is is kept.
    """
    return _grouped(docs, like).drop("text_key")


def keep_first(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns, whatever their names.

    Rows go by id and text: where an id is on several texts, only those go that repeat a text of a smaller id. Rows
    that agree in id and text stay or go together.
    """
    gone_id, gone_key = free_name(docs, "_gone_id"), free_name(docs, "_gone_key")
    gone = _grouped(docs, like).where("NOT kept").select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)).distinct()
    same = (F.col("doc_id").cast("long") == F.col(gone_id)) & (text_key() == F.col(gone_key))
    return docs.join(gone, same, "left_anti")
