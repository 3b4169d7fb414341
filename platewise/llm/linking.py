"""Connected groups of nodes that share a bucket and pass a check, without making all pairs of a bucket.

First every bucket member is checked against the smallest node of its bucket; what passes is joined into groups. Buckets whose
members then lie in one group, or that have two members, are settled. In the others, members outside the bucket's largest group are checked against
every member of another group, so that no link between two groups is missed: in buckets of up to ``SMALL`` members as pairs that
pass a cheap test on their signatures, in larger ones block by block inside tasks, which return links only. Nothing is
collected; every step reads tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import let_workers_import
from platewise.llm.steps import settled

Test = Callable[[Column, Column], Column]
Check = Callable[[DataFrame], DataFrame]
Prepare = Callable[[DataFrame], tuple[Check, Check]]

SMALL = 48  # members of a bucket whose pairs are listed
HELD, STREAMED = 512, 1024  # members of a block on either side
AT_ONCE = 1 << 19  # edges that a task shortens at a time


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect what the given ones connect, ``AT_ONCE`` at a time: each node with the smallest one of its group."""

    def shortened(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [np.concatenate([b.column(c).to_numpy() for b in some]) for c in ("node", "to")]
        nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
        a, b = place[: len(ends[0])], place[len(ends[0]) :]
        least = np.arange(len(nodes))
        while True:
            low, before = np.minimum(least[a], least[b]), least.copy()
            for side in (a, b, before[a], before[b]):  # also what stood for either end so far
                np.minimum.at(least, side, low)
            least = least[least]
            if (least == before).all():
                break
        more = np.flatnonzero(least != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[more]), pa.array(nodes[least[more]])], names=["node", "to"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= AT_ONCE:
            yield shortened(held)
            held, rows = [], 0
    if held:
        yield shortened(held)


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of ``links`` (``a``, ``b``) but the smallest ones.

    Edges are turned to point at ever smaller nodes: first those that lie in one partition among themselves, then alternately from the larger
    and from the smaller neighbours, until each node points at one node that points nowhere. The rounds grow with the logarithm of a component's size.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to"))
    links = let_workers_import(links)
    tasks = links.count() // AT_ONCE + 1  # a task connects that many edges at once, so few edges need no rounds
    edges = settled(links.coalesce(tasks).mapInArrow(_forest, "node long, to long").distinct(), "edges")
    while True:
        ends = edges.select("node", F.lit(1).alias("out"), F.lit(0).alias("met"))
        ends = ends.unionByName(edges.select(F.col("to").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("met")))
        open_ = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("met").alias("met")).where("out > 1 OR (out = 1 AND met = 1)")
        if open_.isEmpty():
            return edges.select("node", F.col("to").alias("component"))
        parents = settled(edges.groupBy(F.col("node").alias("to")).agg(F.min("to").alias("parent")), "parents")
        jumped = edges.join(parents, "to", "left").select("node", F.coalesce("parent", "to").alias("to")).distinct()
        jumped = settled(jumped, "jumped")
        parents = settled(jumped.groupBy("node").agg(F.min("to").alias("parent")), "parents")
        joined = jumped.join(parents, "node")
        down = joined.where("to <> parent").select(F.col("to").alias("node"), F.col("parent").alias("to"))
        turned = settled(parents.select("node", F.col("parent").alias("to")).unionByName(down), "turned")
        edges = settled(turned.coalesce(tasks).mapInArrow(_forest, "node long, to long").distinct(), "edges")


def link_groups(buckets: DataFrame, signatures: DataFrame, may_link: Test, prepare: Prepare, nodes: DataFrame | None = None) -> DataFrame:
    """``node`` and ``component`` of all nodes linked with a smaller one.

    ``buckets`` has ``key`` and ``node``, and may have the smallest node of each bucket as ``leader``; ``nodes``, if the caller has them, are those that
    share any bucket, and the only ones with a signature then. ``signatures`` a ``sig`` (a struct that ``may_link`` compares) for each ``node``. ``prepare``
    gets the nodes that share any bucket and returns two checks. The first gets pairs (``a``, ``b``) and returns those that are links. The
    second gets ``key``, ``chunk``, ``part`` (together a block), ``held``, ``node`` and ``component``; it returns enough of the links between held and
    other nodes of a block to connect whatever they connect.
    """
    members = buckets
    if "leader" not in buckets.columns:
        leaders = buckets.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last").drop("last")
        members = settled(buckets.join(settled(leaders, "bucket-leaders"), "key"), "bucket-members")
    if nodes is None:
        nodes = settled(members.select("node").distinct(), "bucket-nodes")
        signatures = settled(signatures.join(nodes, "node"), "signatures")
    check, check_blocks = prepare(nodes)
    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = settled(check(_tested(stars, signatures, may_link)), "links")
    groups = connected(links)

    members = members.drop("leader").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = settled(members, "labelled-members")
    open_keys = members.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.count("*").alias("groups"), F.sum("n").alias("members")
    )
    open_keys = open_keys.where("groups > 1 AND members > 2").select(
        "key", F.col("largest.component").alias("largest"), "members", (F.col("members") - F.col("largest.n")).alias("outside")
    )
    unsettled = settled(members.join(settled(open_keys, "open-buckets"), "key"), "unsettled-members")
    small = F.col("members") <= SMALL
    signed = settled(unsettled.where(small).join(signatures, "node"), "signed-members")
    more = settled(check(_pairs(signed, may_link)), "links")
    more = more.unionByName(settled(check_blocks(_blocks(unsettled.where(~small))), "links"))
    known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected(known.unionByName(more)) if more.head(1) else groups


def _tested(pairs: DataFrame, signatures: DataFrame, may_link: Test) -> DataFrame:
    first, second = signatures.toDF("a", "a_sig"), signatures.toDF("b", "b_sig")
    return pairs.join(first, "a").join(second, "b").where(may_link(F.col("a_sig"), F.col("b_sig"))).select("a", "b")


def _pairs(unsettled: DataFrame, may_link: Test) -> DataFrame:
    outside = unsettled.where("component <> largest").select(
        "key", F.col("node").alias("a"), F.col("sig").alias("a_sig"), F.col("component").alias("a_component")
    )
    return (
        outside.join(unsettled, "key")
        .where("component <> a_component AND (component = largest OR a < node)")
        .where(may_link(F.col("a_sig"), F.col("sig")))
        .select("a", F.col("node").alias("b"))
        .distinct()
    )


def _blocks(unsettled: DataFrame) -> DataFrame:
    """Members outside the largest group, in chunks, each together with all members of the bucket, in parts."""
    chunks, parts = F.ceil(F.col("outside") / HELD), F.ceil(F.col("members") / STREAMED)
    chunk = F.pmod(F.xxhash64("node"), chunks)
    part = F.pmod(F.xxhash64("node", F.lit("part")), parts)
    held = unsettled.where("component <> largest").select(
        "key", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.lit(True).alias("held"), "node", "component"
    )
    streamed = unsettled.select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), part.alias("part"), F.lit(False).alias("held"), "node", "component"
    )
    return held.unionByName(streamed)
