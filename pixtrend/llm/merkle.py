"""Merkle manifest of a dataset by pivoting slots.

Nodes of a level are rows (group, position, digest).  One aggregation brings a
parent's children, up to ``fanout`` of them, into as many columns (a
conditional maximum for each slot).  Concatenating the columns and hashing gives the
parent; leaving one's own column out gives one's siblings.  Going up, each level
has a ``fanout``-th of the rows of the one below and is written; going down,
every parent hands its path to the children it holds, so that no leaf is ever
joined with all of its levels one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixtrend.llm.ranking import numbered
from pixtrend.llm.scratch import materialise

#: The columns of a document that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def sha256(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return sha256(F.concat(*[encoded(columns[f]) for f in FIELDS]))


def group_key(source: Column) -> Column:
    """Text that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("1"), source.cast("string")), F.lit("0"))


def pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """(grp, idx, s0 … s<fanout-1>): each parent's children as columns, each a
    struct of the node's ``digest`` and other columns, null where there is none."""
    value = F.struct(*[c for c in nodes.columns if c not in ("grp", "pos")])
    slot = F.col("pos") % fanout
    return nodes.groupBy("grp", F.floor(F.col("pos") / fanout).cast("long").alias("idx")) \
        .agg(*[F.max(F.when(slot == s, value)).alias(f"s{s}") for s in range(fanout)])


#: A run that is its group's only node: the top, not hashed again.
ALONE = "idx = 0 and s1 is null"


def digests(fanout: int, slots: range) -> Column:
    return F.concat(F.lit(""), *[F.coalesce(F.col(f"s{s}.digest"), F.lit("")) for s in slots])


def ascend(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """Pivots of all levels, from the leaves up, each a written table.  Ends when
    every group has come to one node: after log(rows of the largest group) levels."""
    levels, more = [], True
    while more:
        p = materialise(pivot(nodes, fanout), f"{name}-{len(levels)}")
        levels.append(p)
        inner = p.where(f"not ({ALONE})")
        nodes = inner.select("grp", F.col("idx").alias("pos"), sha256(digests(fanout, range(fanout))).alias("digest"))
        more = not inner.isEmpty()
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest): the last node of each group."""
    return reduce(DataFrame.unionByName, [p.where(ALONE).select("grp", F.col("s0.digest").alias("digest")) for p in levels])


def children(parents: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """The nodes that pivoted ``parents`` with a ``path`` hold, each with its own
    path: its siblings to the left and to the right, then the parent's path."""
    def child(s: int) -> Column:
        step = F.struct(digests(fanout, range(s)).alias("left"), digests(fanout, range(s + 1, fanout)).alias("right"))
        return F.when(F.col(f"s{s}").isNotNull(), F.struct((F.col("idx") * fanout + s).alias("pos"), F.col(f"s{s}").alias("node"),
                                                           F.concat(F.array(step), F.col("path")).alias("path")))

    return parents.select("grp", *carried, F.explode(F.array_compact(F.array(*[child(s) for s in range(fanout)]))).alias("_c")) \
        .select("grp", "_c.pos", "_c.node.*", "_c.path", *carried)


def descend(levels: list[DataFrame], above: DataFrame | None, fanout: int) -> DataFrame:
    """The nodes of the lowest level with their paths.  ``above`` (grp, path and
    columns to hand down) continues the path at each group's top; None: it ends there."""
    carried = [] if above is None else [c for c in above.columns if c not in ("grp", "path")]
    down = None
    for p in reversed(levels):
        top = p.where(ALONE)
        top = top.withColumn("path", F.array().cast(PATH)) if above is None else top.join(above, "grp")
        nodes = top.select("grp", F.lit(0).cast("long").alias("pos"), "s0.*", "path", *carried)
        if down is not None:
            held = p.where(f"not ({ALONE})").join(down.select("grp", F.col("pos").alias("idx"), "path", *carried), ["grp", "idx"])
            nodes = nodes.unionByName(children(held, fanout, carried))
        down = nodes
    return down


def folded(leaf: Column, path: Column) -> Column:
    """Root recomputed from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda h, step: sha256(F.concat(step["left"], h, step["right"])))


def manifest(docs: DataFrame, tampered_text: Column, fanout: int = 3) -> DataFrame:
    """A proof for every row of ``docs``: doc_id, source, pos (in its source), leaf,
    subroot, root, path, proof_sha256, folded_root, verified.

    Leaves cover ``FIELDS``.  Those of a source stand in order of doc_id (null
    first; rows of one doc_id by digest) under a tree of their own; the subroots
    in order of source (null first, by bytes) under the root.  ``tampered_text``
    is the text that a reader is shown, from which ``folded_root`` is computed with the siblings of the
    untampered tree.  Nulls have an encoding of their own; repeated rows are
    leaves of their own; other columns are ignored; an empty table has no rows.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    own = {f: F.col(f) for f in FIELDS}
    leaves = docs.select(group_key(F.col("source")).alias("grp"), "doc_id", leaf_digest(own).alias("digest"),
                         leaf_digest(own | {"text": tampered_text}).alias("shown"))
    levels = ascend(numbered(leaves, "grp", ["doc_id", "digest"]), fanout, "leaves")
    subroots = materialise(tops(levels), "subroots")
    ranked = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("source_key"), "digest"), "grp", ["source_key"])
    upper = ascend(ranked, fanout, "subroots")
    first = tops(upper).first()
    root = F.lit(first["digest"] if first else None).cast("string")
    above = materialise(descend(upper, None, fanout).select(F.col("source_key").alias("grp"), F.col("digest").alias("subroot"), "path"), "above")
    rows = descend(levels, above, fanout)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = rows.select("doc_id", F.when(F.col("grp") != "0", F.substring("grp", 2, 2**31 - 1)).alias("source"), "pos", F.col("digest").alias("leaf"),
                      "subroot", root.alias("root"), "path", sha256(siblings).alias("proof_sha256"), folded(F.col("shown"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
