"""Near-duplicate documents by MinHash with tensored banding.

Plain banding with L tables of K minhashes evaluates L*K hashes per shingle.
Here two collections of ``M`` half keys (``R`` minhashes each) are evaluated,
2*M*R hashes in all, and every pair (i, j) of a left and a right half key is
the key of one of M*M tables. A pair of sets of similarity s meets in a table
with probability ``(1 - (1 - s**R)**M)**2``: 0.9988 at s = 0.8 for R=4, M=14
(112 hashes serve 196 tables of 8 minhashes, which plainly need 1568).

Stages, each bounded per task:

1. Every text -> distinct word shingles (64-bit hashes), set size, a 128-bit
   fingerprint of the set and the half keys. Equal sets become one node.
2. Every member of a bucket hangs on the bucket's smallest id, first within a
   batch of nodes, then the batches' smallest on the smallest of all: a bucket
   of g members gives g - 1 pairs, never all pairs, and as many rows of the
   shuffle as there are batches at most.
3. These pairs are confirmed on full sets.
4. A pair that is no link ties the components of its two ends. Their members
   with most links are compared; components still tied then are a cluster, and
   members of different components of a cluster are compared on full sets where
   an exact prefix filter lets them meet.
5. Components of all confirmed links.

Defined results: null or wordless text: n_shingles 0, linked with nothing. Equal
sets are one class. Rows that share a doc_id are one document: it is linked when
one of its texts is, and each row keeps its own n_shingles; in ``drop_near_duplicates``
different texts under one doc_id are documents of their own. A null doc_id is linked with
nothing (component_id null, kept true). Extra columns are ignored by ``near_duplicates``
and returned unchanged by ``drop_near_duplicates``. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bowline.llm.common import Scratch, arrow_map, at_work, components, free_name
from bowline.session import broadcast_limit_bytes

SHINGLE_WORDS = 5      # default of the operator; the registered query takes 2
PERCENT = 80           # link when 100 * intersection >= PERCENT * union
R = 4                  # minhashes of a half key
M = 14                 # half keys of each collection; M * M tables
STAR_ROWS = 1024       # nodes whose buckets are joined before the shuffle
MIDDLE = 4             # members of a component that are compared before all
SEED = 20240229

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    if not text:
        return np.empty(0, np.uint64)
    # bytes.split() cuts at exactly \x20 and \x09-\x0D
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    acc = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        acc = _mix(acc * _C1 + h[k:len(h) - width + 1 + k] * _C2)
    return np.unique(acc)


@lru_cache(maxsize=4)
def _hash_family(r: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 2**63, 2 * m * r, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, 2 * m * r, dtype=np.uint64)
    return a[:, None], b[:, None]


def half_keys(sh: np.ndarray, r: int, m: int) -> np.ndarray:
    """2*m half keys (m left, then m right) of a nonempty set."""
    a, b = _hash_family(r, m)
    low = None
    for lo in range(0, len(sh), 2048):
        v = a * sh[None, lo:lo + 2048] + b
        v ^= v >> np.uint64(32)
        part = v.min(axis=1)
        low = part if low is None else np.minimum(low, part)
    low = low.reshape(2 * m, r)
    acc = np.arange(2 * m, dtype=np.uint64)
    for k in range(r):
        acc = _mix(acc * _C1 + low[:, k] * _C2)
    return acc.view(np.int64)


def _sketch_fn(width: int, r: int, m: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def fn(cols):
        at_work("minhash")
        n, f, keys = [], [], []
        for t in cols["text"]:
            s = shingle_set(t, width)
            n.append(len(s))
            f.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            keys.append(half_keys(s, r, m) if len(s) else None)
        return {"doc_id": cols["doc_id"], "n": n, "f": f, "keys": keys}

    return arrow_map(fn, schema)


def _set_fn(width: int):
    schema = pa.schema([("id", pa.int64()), ("s", pa.list_(pa.int64()))])

    def fn(cols):
        return {"id": cols["id"], "s": [shingle_set(t, width).view(np.int64) for t in cols["text"]]}

    return arrow_map(fn, schema)


def _sets_of(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Full sets of the documents ``ids(id)``, shingled again from the text.
    While the ids are known to fit a broadcast, no text is shuffled."""
    wanted = ids.select(F.col("id").alias("doc_id"))
    if 32 * wanted.count() <= broadcast_limit_bytes(docs.sparkSession):
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "doc_id", "left_semi") \
                .select(F.col("doc_id").alias("id"), "text")
    return (texts.mapInArrow(_set_fn(width), "id long, s array<long>")
            .where(F.size("s") > 0))


def _table_keys(x: list, m: int) -> np.ndarray:
    """Keys of the m * m tables, a row for each node."""
    half = np.array(x, np.int64).reshape(-1, 2 * m).view(np.uint64)
    return _mix(half[:, :m, None] * _C1 + half[:, None, m:] * _C2).reshape(-1, m * m).view(np.int64)


def _local_stars(m: int, pairs: bool):
    """Within a batch of nodes (id, keys), the members of a bucket hang on their
    smallest id: as rows (id, leader), or the leaders' rows (key, id). A bucket
    then has a row for each batch at most, however many members it has."""
    names = ("id", "leader") if pairs else ("key", "id")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, STAR_ROWS):
                part = batch.slice(lo, STAR_ROWS)
                ids = part.column(0).to_numpy()
                keys = _table_keys(part.column(1).flatten().to_numpy(), m)
                order = np.argsort(ids, kind="stable")
                ids, flat = ids[order], keys[order].ravel()
                # the first place of a key belongs to its smallest id
                found, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
                leader = ids[first // keys.shape[1]]
                if pairs:
                    own = np.repeat(ids, keys.shape[1])
                    rows = np.unique(np.stack([own, leader[inverse]], axis=1)[own != leader[inverse]], axis=0)
                    out = rows[:, 0], rows[:, 1]
                else:
                    out = found, leader
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], schema=schema)

    return run


def bucket_pairs(nodes: DataFrame, m: int) -> DataFrame:
    """Distinct (id, leader): in every bucket all members hang on one of them, in
    at most two steps (its batch's smallest id, and the smallest of all)."""
    keyed = nodes.select("id", "keys")
    local = keyed.mapInArrow(_local_stars(m, True), "id long, leader long")
    # A running first value: the window keeps no group in memory.
    w = Window.partitionBy("key").orderBy("id")
    leaders = keyed.mapInArrow(_local_stars(m, False), "key long, id long") \
        .withColumn("leader", F.first("id").over(w)).where("id <> leader").select("id", "leader")
    return leaders.unionByName(local).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs(a, b)``, on full sets."""
    both = F.size("sa").cast("long") + F.size("sb")
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
            .withColumn("inter", F.size(F.array_intersect("sa", "sb")).cast("long"))
            .where(100 * F.col("inter") >= percent * (both - F.col("inter"))).select("a", "b"))


def cross_candidates(rows: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of ``rows(id, component, cluster, top)`` of one cluster and
    different components that can be linked: an exact prefix filter over
    ``sets(id, set, s)``, whose ``set`` numbers the sets.

    Shingles are put in an order, first those that only one component of the
    cluster has, then the rarest. Two linked sets have at least a = ceil(p (n + m)
    / (100 + p)) common shingles, so the first of these is among the first n - a + 1
    of one set and among the first m - a + 1 of the other; for the smaller set that
    is within n - ceil(2 p n / (100 + p)) + 1 places, for the larger within m -
    ceil(p m / 100) + 1. Shingles of one component only fill these places without
    making pairs, so sets that are alike in a template but differ in a tenth of
    their own meet nobody. Members of a cluster's largest component (``top``) are
    not joined with each other at all.
    """
    held = (rows.join(sets, "id")
            .select("id", "set", F.size("s").cast("long").alias("n"), "component", "top", "cluster",
                    F.explode("s").alias("x"))
            .withColumn("x", F.xxhash64("cluster", "x")).drop("cluster"))
    shared = held.groupBy("x").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("lo"),
                                   F.max("component").alias("hi")).where("lo <> hi").select("x", "df")
    live = scratch.write(held.join(scratch.write(shared, "shared"), "x"), "live")
    # the shared shingles stand behind the own ones
    counts = live.groupBy("set", "n").agg(F.count(F.lit(1)).alias("kept")) \
        .withColumn("own", F.col("n") - F.col("kept"))
    reach = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    counts = counts.where(reach > F.col("own")).select("set", "own", reach.cast("long").alias("reach"))
    place = F.col("own") + F.row_number().over(Window.partitionBy("set").orderBy("df", "x"))
    prefix = scratch.write(live.join(counts, "set").withColumn("place", place).where("place <= reach")
                           .select("id", "n", "component", "top", "x", "place"), "prefix")
    both = F.lit(100 + percent)
    small = prefix.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * (2 * percent) / both) + 1)
    common = F.ceil((F.col("na") + F.col("nb")) * percent / both)

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = (df.select("x", *[F.col(c).alias(c[0] + side) for c in ("id", "n", "component", "place")])
                       for df, side in ((left, "a"), (right, "b")))
        return left.join(right, "x").where(
            (F.col("ca") != F.col("cb")) & (F.col("na") <= F.col("nb")) & (100 * F.col("na") >= percent * F.col("nb"))
            & (F.col("pa") <= F.col("na") - common + 1) & (F.col("pb") <= F.col("nb") - common + 1)) \
            .select(F.col("ia").alias("a"), F.col("ib").alias("b"))

    return meet(small.where("NOT top"), prefix).unionByName(meet(small.where("top"), prefix.where("NOT top"))).distinct()


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Distinct (a, b): components that a pair which is no link ties together."""
    return (pairs.join(comp.select("id", F.col("component").alias("ci")), "id", "left")
            .join(comp.select(F.col("id").alias("leader"), F.col("component").alias("cl")), "leader", "left")
            .select(F.least(F.coalesce("ci", "id"), F.coalesce("cl", "leader")).alias("a"),
                    F.greatest(F.coalesce("ci", "id"), F.coalesce("cl", "leader")).alias("b"))
            .where("a <> b").distinct())


def middle_pairs(members: DataFrame, comp: DataFrame, links: DataFrame, apart: DataFrame) -> DataFrame:
    """Pairs (a, b) of the members with most links of two tied components, at
    most MIDDLE * MIDDLE for each tie: where the middle of one is near that of the
    other, no other member has to be looked at."""
    ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    rows = (members.join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
            .join(ends.groupBy("id").agg(F.count(F.lit(1)).alias("links")), "id", "left"))
    order = Window.partitionBy("component").orderBy(F.desc_nulls_last("links"), "id")
    middle = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= MIDDLE).select("component", "id")
    left = middle.select(F.col("component").alias("a"), F.col("id").alias("ia"))
    right = middle.select(F.col("component").alias("b"), F.col("id").alias("ib"))
    return apart.join(left, "a").join(right, "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))


def near_duplicate_links(spark: SparkSession, nodes: DataFrame, docs: DataFrame, scratch: Scratch,
                         width: int, percent: int, r: int, m: int) -> DataFrame:
    """Confirmed links (a, b) between nodes (id, n, keys); enough of them that
    their components are those of all links between nodes that share a table."""
    pairs = scratch.write(bucket_pairs(nodes, m), "pairs")
    members = scratch.write(pairs.select("id").unionByName(pairs.select(F.col("leader").alias("id"))).distinct(),
                            "members")
    sets = scratch.write(_sets_of(members, docs, width).distinct()
                         .withColumn("set", F.monotonically_increasing_id()), "sets")
    # Sizes alone rule out most false pairs before the sets are read.
    sizes = nodes.select("id", "n")
    near = (pairs.join(sizes.withColumnRenamed("n", "na"), "id")
            .join(sizes.select(F.col("id").alias("leader"), F.col("n").alias("nb")), "leader")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .select(F.col("leader").alias("a"), F.col("id").alias("b")))
    star_links = scratch.write(_confirmed(near, sets, percent), "links")

    comp = scratch.write(components(star_links, scratch), "components")
    # A pair that is no link ties the components of its ends.
    apart = scratch.write(_apart(pairs, comp), "apart")
    if apart.isEmpty():
        return star_links
    middle = middle_pairs(members, comp, star_links, apart)
    links = star_links.unionByName(scratch.write(_confirmed(middle, sets, percent), "links"))
    comp = scratch.write(components(links, scratch), "components")
    # What is still tied is a cluster, and compared exactly.
    cluster = scratch.write(components(_apart(pairs, comp), scratch)
                            .select(F.col("id").alias("component"), F.col("component").alias("cluster")), "clusters")
    if cluster.isEmpty():
        return links
    rows = scratch.write(members.join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
                         .join(cluster, "component"), "rows")
    sizes = rows.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("c"))
    top = sizes.groupBy("cluster").agg(F.max(F.struct("c", "component")).alias("t")) \
        .select(F.col("t.component").alias("component"), F.lit(True).alias("top"))
    rows = rows.join(top, "component", "left").withColumn("top", F.coalesce("top", F.lit(False)))
    found = scratch.write(cross_candidates(rows, sets, percent, scratch), "candidates")
    return links.unionByName(scratch.write(_confirmed(found, sets, percent), "links"))


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT,
                    r: int = R, m: int = M) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept."""
    scratch = Scratch(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = scratch.write(docs.mapInArrow(_sketch_fn(width, r, m),
                                         "doc_id long, n long, f binary, keys array<long>"), "base")
    linkable = base.where("n > 0 AND doc_id IS NOT NULL")
    # One node for each distinct set, named by its smallest doc_id; half keys
    # are the same in every copy, so min() is combined before the shuffle.
    reps = linkable.groupBy("f").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    reps = scratch.write(reps, "reps")
    nodes = (base.where("n > 0").join(reps.select("f", F.col("id").alias("doc_id")), ["f", "doc_id"])
             .dropDuplicates(["f"]).select(F.col("doc_id").alias("id"), "n", "keys"))
    nodes = scratch.write(nodes, "nodes")
    links = near_duplicate_links(spark, nodes, docs, scratch, width, percent, r, m)
    # Copies hang on their node; documents of several rows tie their nodes together.
    copies = linkable.join(reps.where("copies > 1"), "f").where("doc_id <> id") \
        .select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    comp = scratch.write(components(links.unionByName(copies), scratch), "components")
    return (base.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _numbered(docs: DataFrame, scratch: Scratch, node: str, rows: str) -> DataFrame:
    """``docs`` with a number for each (doc_id, text), in the order of doc_id and
    the text's hash, and how many rows share it; null for rows without doc_id."""
    of = free_name(docs, "text_hash")
    docs = docs.withColumn(of, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    nodes = scratch.write(docs.where("doc_id IS NOT NULL").groupBy("doc_id", of).agg(F.count(F.lit(1)).alias(rows))
                          .sort("doc_id", of).withColumn(node, F.monotonically_increasing_id()), "nodes")
    return scratch.write(docs.join(nodes, ["doc_id", of], "left").drop(of), "numbered")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, width: int = SHINGLE_WORDS,
                         percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the smallest doc_id, and the
    smallest hash of the text where texts share it. Of rows that repeat doc_id
    and text the first as JSON stays, rows without doc_id all stay. Texts are
    shuffled once where a doc_id repeats, else only past the broadcast limit."""
    scratch = Scratch(spark, "dedup")
    columns, node, rows = docs.columns, "doc_id", None
    if not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        node, rows = free_name(docs, "node"), free_name(docs, "copies")
        docs = _numbered(docs, scratch, node, rows)
    found = near_duplicates(spark, docs.select(F.col(node).alias("doc_id"), "text"), width, percent)
    # Only ids that go are looked up; the rest, null ids too, pass by.
    ids = scratch.write(found.where("NOT kept").select(F.col("doc_id").alias(node)), "ids")
    if rows:
        ids = ids.distinct()
    # While the ids are known to fit a broadcast, no text is shuffled.
    small = F.broadcast if 32 * ids.count() <= broadcast_limit_bytes(spark) else (lambda df: df)
    out = docs.join(small(ids), node, "left_anti")
    if not rows:
        return out.select(columns)
    row = F.struct(*columns)
    first = out.where(F.col(rows) > 1).groupBy(node).agg(F.min_by(row, F.to_json(row)).alias(node + "_row"))
    return (out.where(F.col(rows).isNull() | (F.col(rows) == 1)).select(columns)
            .unionByName(first.select(node + "_row.*")))
