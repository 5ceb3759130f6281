"""The trie of conversation prefixes, by ROLLUP over positional turn-id columns.

A turn's id is 96 bits of a hash of role and text and 32 bits of the text's
length. A conversation is laid out in blocks of ``BLOCK`` turn-id columns; a
block is keyed by the node that the turns before it lead to, so one

    GROUP BY block, prior, ROLLUP (t1, .., t8)

aggregates all prefixes of all blocks together, and grouping_id tells the depth
of each. A node's id, and so a block's prior node, is the XOR of two hashes of
(position, turn id) over its turns: long conversations get it as a running
aggregate, without a sequence in memory.

Equal conversations are one class with a count before the rollup. A node is owned
by its smallest member, so the nodes of one owner are the end of its path. That
makes the sums over subtrees sums over members, which the rollup adds up:
(members - 1) * bytes over a subtree is what the members hold from there on, less
the bytes of the nodes that its classes own. No step walks the trie.

Defined results: rows without conv_id take no part. Turns are ordered by turn,
null first, ties by turn id (equal rows are interchangeable); null role or text
is empty. Extra columns are ignored. No rows: no nodes. A turn id, like a node's,
is a hash; two different turns or prefixes would have to agree in all its bits to
be taken for one.

Skew: a conversation's turns pass one task as a stream (sorted, not held); every
aggregate has partial sums, also for the root and a first turn that all share;
the ids that end in one node are joined in pieces of ``ID_RANGE`` and hashed as a
stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bowline.llm.common import Scratch

BLOCK = 8            # turn-id columns of a block
BASE_EVERY = 5       # a conversation starts like conversation c - c % BASE_EVERY,
MOST_SHARED = 8      # with crc32(c) % (MOST_SHARED + 1) of its turns
ID_RANGE = 4096      # conv_ids that are joined in one string

NODE = ["x1", "x2", "depth"]


def turn_id(role: str, text: str) -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    size = F.octet_length(text)
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.unhex(F.substring(F.md5(both.cast("binary")), 1, 24)),
                    F.unhex(F.lpad(F.hex(size.cast("long")), 8, "0")))


def _bytes_of(tid: Column) -> Column:
    return F.coalesce(F.conv(F.hex(F.substring(tid, 13, 4)), 16, 10).cast("long"), F.lit(0).cast("long"))


def _mark(half: int, position: Column, tid: Column) -> Column:
    """Share of a turn at a position in one half of its node's id."""
    return F.when(tid.isNotNull(), F.xxhash64(F.lit(half), position.cast("long"), tid)).otherwise(F.lit(0).cast("long"))


def rebuilt(turns: DataFrame, scratch: Scratch, base_every: int = BASE_EVERY,
            most_shared: int = MOST_SHARED) -> DataFrame:
    """Rows (conv_id, place, part, tid): each conversation's turns after those that
    it takes from its base, in order of (part, place), behind a row without tid."""
    slim = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_id("role", "text").alias("tid"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "tid")
    own = scratch.write(slim.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "tid"), "turns")
    c = F.col("conv_id")
    shared = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(most_shared + 1))
    convs = own.where("place = 1").select("conv_id", (c - c % base_every).alias("base"), shared.alias("shared"))
    bases = own.where((F.col("place") <= most_shared) & (c % base_every == 0)) \
        .select(c.alias("base"), "place", "tid")
    head = convs.join(bases, "base").where("place <= shared").select("conv_id", "place", F.lit(1).alias("part"), "tid")
    tail = own.where(F.col("place") > shared).select("conv_id", "place", F.lit(2).alias("part"), "tid")
    start = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(0).alias("part"),
                         F.lit(None).cast("binary").alias("tid"))
    return head.unionByName(tail).unionByName(start)


def paths(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Per conversation and depth 0, 1, ..: the turn, the node reached (x1, x2),
    bytes so far, and whether the conversation ends there."""
    order = Window.partitionBy("conv_id").orderBy("part", "place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tid, depth = F.col("tid"), F.col("depth")
    out = rows.withColumn("depth", (F.row_number().over(order) - 1).cast("long"))
    for k in (1, 2):
        out = out.withColumn(f"z{k}", _mark(k, depth, tid))
    return scratch.write(out.withColumn("b", _bytes_of(tid)).select(
        "conv_id", "depth", "tid", "b", "z1", "z2", F.bit_xor("z1").over(so_far).alias("x1"),
        F.bit_xor("z2").over(so_far).alias("x2"), F.sum("b").over(so_far).alias("bytes"),
        F.lead("depth").over(order).isNull().alias("ends")), "paths")


def _digest(batches):
    """Rows (x1, x2, depth, ids) sorted by node and range -> one digest a node;
    only the running hash of the present node is kept."""
    schema = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    node, state, done = None, None, []
    for batch in batches:
        for x1, x2, depth, ids in zip(*[col.to_pylist() for col in batch.columns]):
            if (x1, x2, depth) == node:
                state.update(b"," + ids.encode())
                continue
            if node:
                done.append((*node, state.hexdigest()))
            node, state = (x1, x2, depth), hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if node:
        done = [(*node, state.hexdigest())]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def end_digests(last: DataFrame, id_range: int = ID_RANGE) -> DataFrame:
    """SHA-256 of the ascending conv_ids that end in each node."""
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")), ",")
    pieces = (last.withColumn("range", F.floor(F.col("conv_id") / F.lit(id_range)).cast("long"))
              .groupBy(*NODE, "range").agg(ids.alias("ids")))
    return (pieces.repartition(*NODE).sortWithinPartitions(*NODE, "range").select(*NODE, "ids")
            .mapInArrow(_digest, "x1 long, x2 long, depth long, ends_sha256 string"))


def _blocks(path: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """Per class and block: the block's turn ids t1.. (null past the end), its
    prior node, and the class's bytes from the block on."""
    width = F.lit(block)
    mine = path.join(classes, "conv_id").where("depth > 0 OR len = 0")
    at = F.when(F.col("depth") > 0, F.pmod(F.col("depth") - 1, width)).otherwise(F.lit(0))
    first = F.col("at") == 0
    tids = F.transform(F.sort_array(F.collect_list(F.struct("at", "tid"))), lambda x: x["tid"])
    cells = (mine.withColumn("at", at)
             .withColumn("block", F.when(F.col("depth") > 0, F.floor((F.col("depth") - 1) / width)).otherwise(0).cast("long"))
             .groupBy("conv_id", "block", "n", "len").agg(
                 tids.alias("tids"),
                 F.max(F.when(first, F.col("x1").bitwiseXOR(F.col("z1")))).alias("p1"),
                 F.max(F.when(first, F.col("x2").bitwiseXOR(F.col("z2")))).alias("p2"),
                 F.max(F.when(first, F.col("total") - F.col("bytes") + F.col("b"))).alias("rest")))
    return cells.select("conv_id", "block", "n", "len", "p1", "p2", "rest",
                        *[F.get("tids", F.lit(i)).alias(f"t{i + 1}") for i in range(block)])


def _rollup(spark: SparkSession, blocks: DataFrame, block: int, sums: str) -> DataFrame:
    """The rollup of ``blocks``; of its rows those that are nodes: the root, and
    each whose deepest turn column holds a turn."""
    cols = ", ".join(f"t{i + 1}" for i in range(block))
    rows = spark.sql(f"""SELECT block, p1, p2, {cols}, {block} - bit_count(grouping_id()) AS k, {sums}
        FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP ({cols})""", blocks=blocks)
    k, tids = F.col("k"), [F.col(f"t{i + 1}") for i in range(block)]
    deepest = F.element_at(F.array(*tids), F.greatest(k, F.lit(1)).cast("int"))
    rows = rows.where(((k == 0) & (F.col("block") == 0)) | ((k > 0) & deepest.isNotNull()))
    place = F.col("block") * block
    # columns past a node's depth are null, and have no share
    for half in (1, 2):
        x = F.col(f"p{half}")
        for i, t in enumerate(tids):
            x = x.bitwiseXOR(_mark(half, place + (i + 1), t))
        rows = rows.withColumn(f"x{half}", x)
    return rows.withColumn("depth", (place + k).cast("long")).withColumn("tid", F.when(k > 0, deepest))


def shared_prefixes(spark: SparkSession, turns: DataFrame, block: int = BLOCK, base_every: int = BASE_EVERY,
                    most_shared: int = MOST_SHARED, id_range: int = ID_RANGE) -> DataFrame:
    """Per node of ``turns(conv_id, turn, role, text)``: conv_id (its smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (bytes of turns that a cache of prefixes saves below it) and ends_sha256."""
    scratch = Scratch(spark, "trie")
    path = paths(rebuilt(turns, scratch, base_every, most_shared), scratch)
    last = path.where("ends")
    classes = last.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
                                      F.max("bytes").alias("total")) \
        .select("conv_id", "n", F.col("depth").alias("len"), "total")
    blocks = scratch.write(_blocks(path, scratch.write(classes, "classes"), block), "blocks")

    nodes = _rollup(spark, blocks, block,
                    "min(conv_id) AS conv_id, sum(n) AS n_convs, max(len) AS longest, sum(n * rest) AS mass")
    # bytes of the turns of this block that stand before the node
    before = sum((F.when(F.col("k") > i + 1, _bytes_of(F.col(f"t{i + 1}"))).otherwise(0) for i in range(block)),
                 F.lit(0).cast("long"))
    nodes = scratch.write(nodes.select(
        *NODE, "conv_id", "n_convs", _bytes_of(F.col("tid")).alias("b"), (F.col("longest") == F.col("depth")).alias("leaf"),
        (F.col("mass") - F.col("n_convs") * before).alias("mass"),
        *[F.col(f"x{h}").bitwiseXOR(_mark(h, F.col("depth"), F.col("tid"))).alias(f"q{h}") for h in (1, 2)]), "nodes")

    owner = Window.partitionBy("conv_id").orderBy("depth")
    above = owner.rowsBetween(Window.unboundedPreceding, -1)
    nodes = scratch.write(nodes.withColumn("above", F.coalesce(F.sum("b").over(above), F.lit(0)))
                          .withColumn("head", F.row_number().over(owner) == 1)
                          .withColumn("goes_on", F.lead("depth").over(owner).isNotNull()), "owned")
    held = nodes.groupBy("conv_id").agg(F.sum("b").alias("own"), F.max(F.col("leaf").cast("long")).alias("leaves"))
    shares = blocks.join(held, "conv_id", "left").withColumn("own", F.coalesce("own", F.lit(0))) \
        .withColumn("leaves", F.coalesce("leaves", F.lit(0)))
    below = _rollup(spark, shares, block, "sum(own) AS own, sum(leaves) AS n_leaves").select(*NODE, "own", "n_leaves")

    # An owner's first node hangs on a node of another owner, its others on its own.
    heads = nodes.where("head AND depth > 0").select(*NODE, "q1", "q2")
    up = nodes.select(F.col("x1").alias("q1"), F.col("x2").alias("q2"), (F.col("depth") + 1).alias("depth"),
                      F.col("conv_id").alias("parent"))
    parents = scratch.write(heads.join(up, ["q1", "q2", "depth"]).select(*NODE, "parent"), "parents")
    grown = heads.groupBy("q1", "q2", "depth").agg(F.count(F.lit(1)).alias("others")) \
        .select(F.col("q1").alias("x1"), F.col("q2").alias("x2"), (F.col("depth") - 1).alias("depth"), "others")
    found = (nodes.join(below, NODE).join(grown, NODE, "left").join(parents, NODE, "left")
             .join(end_digests(last, id_range), NODE, "left"))
    return found.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs", (F.coalesce("others", F.lit(0)) + F.col("goes_on").cast("long")).alias("n_children"), "n_leaves",
        (F.col("mass") - F.col("own") + F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
