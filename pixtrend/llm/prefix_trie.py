"""Trie of conversation prefixes, screened by a count-min sketch.

A prefix is known by a 128-bit digest: the exclusive or of a hash of (depth, turn) over
its turns, which is a running aggregate and so can be taken block by block of a
conversation of any length.  All prefix digests are counted in a count-min
sketch whose counters stop at two.  An estimate of one proves that no other
conversation has the prefix; then none has a longer one either, and the
conversation's tail makes its nodes where it stands.  Only prefixes that may be shared
are shuffled, and grouped exactly.  A digest that the sketch wrongly takes
for shared costs a row of shuffle and changes no result.

What a node says of its subtree is summed over its members: every node of a
subtree is counted by the smallest conversation that has it, so subtree sums
are sums, over members, of what each counts from the node's depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.llm.groups import group_starts
from pixtrend.llm.ranking import left_join_skewed, numbered
from pixtrend.llm.scratch import materialise
from pixtrend.llm.words import mix64, releasing

#: Depths of a conversation that one task runs through.
BLOCK = 4096
#: Rows of the sketch, counters a prefix, and bounds of the counters in a row.
#: At the upper bound the bits sent to every task take 32 MB; with more prefixes than
#: that the sketch proves fewer of them single and the results stay as they are.
ROWS, SPARE, MIN_WIDTH, MAX_WIDTH = 2, 4, 1 << 16, 1 << 27
#: Bytes of a part of a row's bits, as partial sketches are merged.
CHUNK = 1 << 13
#: Conversation ids joined in one text before they are hashed.
ID_BLOCK = 1 << 14

NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, mark, words): every turn with its position from 0, a
    128-bit mark of role and text, and the text's words.

    Turns stand in order of ``turn`` (null first), those of equal ``turn`` in order of role
    and mark.  Null role or text is empty; rows without a conv_id belong to no
    conversation and are left out; repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), mark.alias("mark"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return numbered(rows, "conv_id", ["turn", "role", "mark"]).select("conv_id", "pos", "mark", "words")


def with_shared_heads(turns: DataFrame, stride: int, head: Column, most: int) -> DataFrame:
    """Conversations rebuilt on the first turns of others: (conv_id, depth, mark,
    words, length), a row of depth 0 for each and one for every turn.

    Conversation c has the first ``head`` (0 to ``most``, of conv_id) turns of
    c - c % stride, as many as that has, then its own after its first ``head``.
    A base is read by fewer than two ``stride`` conversations.
    """
    turns = materialise(turns, "turns")
    firsts = (turns.where((F.col("pos") < most) & (F.col("conv_id") % stride == 0)).groupBy(F.col("conv_id").alias("base"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "words"))).alias("first")))
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("base", F.col("conv_id") - F.col("conv_id") % stride).withColumn("h", head.cast("int"))
             .join(firsts, "base", "left")
             .withColumn("head", F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast("array<struct<pos:bigint,mark:binary,words:bigint>>")))
             .withColumn("k", F.size("head"))
             .withColumn("length", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long")))
    convs = materialise(convs.select("conv_id", "n", "h", "k", "length", "head"), "conversations")
    own = left_join_skewed(turns, convs.drop("head"), ["conv_id"], F.col("n")).where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k") + 1).alias("depth"), "mark", "words", "length")
    heads = convs.select("conv_id", "length", F.inline("head")).select("conv_id", (F.col("pos") + 1).alias("depth"), "mark", "words", "length")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("mark"), F.lit(0).cast("long").alias("words"), "length")
    return own.unionByName(heads).unionByName(roots)


def running(rows: DataFrame, values: dict[str, str], merge, descending: bool = False) -> DataFrame:
    """``rows`` with running values {new column: column} of ``merge`` along each conversation by
    depth, inside blocks of ``BLOCK`` depths; longer conversations add what
    their blocks before (``descending``: after) come to."""
    rows = rows.withColumn("_block", F.floor(F.col("depth") / BLOCK))
    by = (lambda c: F.col(c).desc()) if descending else F.col
    before = Window.partitionBy("conv_id").orderBy(by("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.where(F.col("length") >= BLOCK).groupBy("conv_id", "_block").agg(*[merge(c).alias(f"_{n}") for n, c in values.items()])
              .select("conv_id", "_block", *[merge(f"_{n}").over(before).alias(f"_{n}") for n in values]))
    inside = Window.partitionBy("conv_id", "_block").orderBy(by("depth")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("*", *[merge(c).over(inside).alias(n) for n, c in values.items()]).join(blocks, ["conv_id", "_block"], "left")
    return out


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, length, words, d0, d1, p0, p1): digests of each prefix and of the one before it."""
    zero = F.lit(0).cast("long")
    terms = turns.select("conv_id", "depth", "length", "words",
                         *[F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "mark", "depth")).otherwise(zero).alias(f"t{i}") for i in (0, 1)])
    runs = running(terms, {"r0": "t0", "r1": "t1"}, F.bit_xor)
    digest = [F.col(f"r{i}").bitwiseXOR(F.coalesce(F.col(f"_r{i}"), zero)) for i in (0, 1)]
    return runs.select("conv_id", "depth", "length", "words", *[d.alias(f"d{i}") for i, d in enumerate(digest)],
                       *[d.bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i, d in enumerate(digest)])


def _buckets(batch: pa.RecordBatch, a: str, b: str, width: int) -> list[np.ndarray]:
    """Counter of each digest in every row of the sketch."""
    lo, hi = (batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64).view(np.uint64) for c in (a, b))
    shift = np.uint64(64 - (width.bit_length() - 1))
    return [(mix64(lo * np.uint64(2 * r + 1) ^ mix64(hi + np.uint64(r + 1))) >> shift).astype(np.int64) for r in range(ROWS)]


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Bits (ROWS, width / 8) of the counters that reach two over all ``rows``.

    Every task counts its digests in bits for one and for two, and sends the
    parts that are not empty; parts are merged as they stream by.  The
    result is bounded by ``ROWS * MAX_WIDTH`` bits.
    """
    chunk = min(CHUNK, width // 8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (np.zeros(ROWS * width // 8, np.uint8) for _ in range(2))
        for batch in batches:
            for r, b in enumerate(_buckets(batch, "d0", "d1", width)):
                at, n = np.unique(b + r * width, return_counts=True)
                byte, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
                again = (n > 1) | ((once[byte] & bit) > 0)
                np.bitwise_or.at(twice, byte[again], bit[again])
                np.bitwise_or.at(once, byte, bit)
        once, twice = once.reshape(-1, chunk), twice.reshape(-1, chunk)
        for part in np.flatnonzero(once.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([once[part].tobytes()], pa.binary()), pa.array([twice[part].tobytes()], pa.binary())],
                                             names=["part", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([twice.tobytes()], pa.binary())], names=["part", "twice"])

        for batch in batches:
            for part, a, b in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if part != held:
                    if held is not None:
                        yield done()
                    held, once, twice = part, a, b
                else:
                    once, twice = once | a, twice | b | (once & a)
        if held is not None:
            yield done()

    parts = (rows.select("d0", "d1").mapInArrow(releasing(count), "part long, once binary, twice binary")
             .repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part long, twice binary"))
    bits = np.zeros((ROWS * width // 8 // chunk, chunk), np.uint8)
    for r in parts.toLocalIterator():
        bits[r["part"]] = np.frombuffer(r["twice"], np.uint8)
    return bits.reshape(ROWS, width // 8)


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` with ``single`` and ``parent_single``: the sketch proves that one
    conversation alone has the prefix, or the one before it."""
    width = 1 << max(SPARE * rows.count() - 1, 1).bit_length()
    width = min(max(width, MIN_WIDTH), MAX_WIDTH)
    bits = rows.sparkSession.sparkContext.broadcast(sketch(rows, width))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = bits.value
        for batch in batches:
            flags = []
            for a, b in (("d0", "d1"), ("p0", "p1")):
                many = np.ones(batch.num_rows, bool)
                for r, at in enumerate(_buckets(batch, a, b, width)):
                    many &= (twice[r][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                flags.append(pa.array(~many))
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], names=[*batch.schema.names, "single", "parent_single"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(releasing(test), f"{schema}, single boolean, parent_single boolean")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(d0, d1, ends_sha256): hash of the ids that end at a node, ascending, comma-joined.

    The ids are sorted and joined to texts range by range; what is left to one
    task a node is to run the hash over those texts, in order and in bounded memory.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in (batch.slice(i, ID_BLOCK) for i in range(0, batch.num_rows, ID_BLOCK)):
                t = pa.Table.from_batches([block])
                at = [*group_starts(t, ["d0", "d1"]).tolist(), t.num_rows]
                ids = t.column("conv_id").to_pylist()
                first = t.take(pa.array(at[:-1], pa.int64())).combine_chunks()
                texts = [",".join(map(str, ids[i:j])) for i, j in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*[first.column(c).combine_chunks() for c in ("d0", "d1", "conv_id")], pa.array(texts, pa.string())],
                                                 names=["d0", "d1", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            out = []
            for d0, d1, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (d0, d1) != held:
                    if held is not None:
                        out.append((*held, state.hexdigest()))
                    held, state = (d0, d1), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _nodes(out)
        if held is not None:
            yield _nodes([(*held, state.hexdigest())])

    order = ["d0", "d1", "conv_id"]
    texts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "d0 long, d1 long, first long, ids string")
    return texts.repartition("d0", "d1").sortWithinPartitions("d0", "d1", "first").mapInArrow(hashed, "d0 long, d1 long, ends_sha256 string")


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["d0", "d1", "ends_sha256"])


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, depth, mark, words, length; a row of
    depth 0 for every conversation): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation without turns is a member of the root alone.  Without
    conversations there is no node.
    """
    rows = materialise(screened(materialise(prefixes(turns), "prefixes")), "screened")
    shared = rows.where("not single")
    nodes = materialise(shared.groupBy("d0", "d1").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                                                       F.max("p0").alias("p0"), F.max("p1").alias("p1")), "shared-prefixes")
    tails = rows.where("single")
    heads = tails.where("depth > 0 and not parent_single")
    kids = (heads.select("p0", "p1").unionByName(nodes.where("depth > 0").select("p0", "p1"))
            .groupBy(F.col("p0").alias("d0"), F.col("p1").alias("d1")).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = materialise(nodes.join(kids, ["d0", "d1"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "shared-nodes")

    # along each conversation: what it counts as the smallest member, and an end that is no leaf of its own
    paths = left_join_skewed(shared.select("d0", "d1", F.col("conv_id").alias("c"), "depth", "length", "words"),
                             nodes.select("d0", "d1", "n", "conv_id", "n_children"), ["d0", "d1"], F.col("n"))
    counts = paths.select("d0", "d1", F.col("c").alias("conv_id"), "depth", "length",
                          F.when(F.col("conv_id") == F.col("c"), (F.col("n") - 1) * F.col("words")).otherwise(0).alias("gain"),
                          F.when((F.col("depth") == F.col("length")) & ~((F.col("n_children") == 0) & (F.col("conv_id") == F.col("c"))), 1).otherwise(0).cast("long").alias("none"))
    below = running(counts, {"g": "gain", "l": "none"}, F.sum, descending=True)
    zero = F.lit(0).cast("long")
    sums = below.groupBy("d0", "d1").agg(F.sum(F.col("g") + F.coalesce("_g", zero)).alias("saved_tokens"), F.sum(F.col("l") + F.coalesce("_l", zero)).alias("none"))
    ends = ends_digest(shared.where("depth = length"))

    parent = nodes.select(F.col("d0").alias("p0"), F.col("d1").alias("p1"), F.col("conv_id").alias("parent"), F.col("n_children").alias("of"))
    below_nodes = nodes.join(sums, ["d0", "d1"]).join(ends, ["d0", "d1"], "left").select(
        "conv_id", "depth", "p0", "p1", F.col("n").alias("n_convs"), "n_children", (F.col("n") - F.col("none")).alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    alone = [F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
             zero.alias("saved_tokens"), F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256")]
    hung = materialise(below_nodes.unionByName(heads.select("conv_id", "depth", "p0", "p1", *alone)), "below-shared")
    # a node's parent that the sketch proves single has the node's own conversation
    hung = left_join_skewed(hung, parent, ["p0", "p1"], F.col("of")).withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")))
    rest = tails.where("depth = 0 or parent_single").select("conv_id", "depth", *alone, F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return hung.select(*names).unionByName(rest.select(*names))
