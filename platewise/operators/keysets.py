"""Sets of integer keys as exact bitmaps, 32,768 keys to a row.

A key check needs to know which keys of one table another one has. With bitmaps each task reduces its rows to one row for each
bucket of 32,768 consecutive keys before anything is shuffled, so dense keys cross the network in a few kilobytes per bucket instead of
a row each. The keys of two tables are brought together by bucket: their union less the parent's keys are the orphans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.operators.lookup import rows_without_partner
from platewise.workspace import materialise

KEYS = 32_768  # of a bucket
BROADCAST_BUCKETS = 100_000


@dataclass(frozen=True)
class Relation:
    """A foreign key."""

    name: str
    child: DataFrame
    key: str
    parent: DataFrame
    parent_key: str

    def of_integers(self) -> bool:
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        return all(isinstance(df.schema[key].dataType, whole) for df, key in ((self.child, self.key), (self.parent, self.parent_key)))


def key_bitmaps(relations: Sequence[Relation]) -> DataFrame:
    """For each relation, side and bucket the bitmap (``bits``) of its keys and its ``rows``; missing keys have a bucket of their own, null.

    A table is scanned once, however many keys it has.
    """
    wanted: dict[int, tuple[DataFrame, list[Column]]] = {}
    for relation in relations:
        for is_child, df, key in ((True, relation.child, relation.key), (False, relation.parent, relation.parent_key)):
            one = F.struct(F.lit(relation.name).alias("relation"), F.lit(is_child).alias("child"), F.col(key).cast("bigint").alias("key"))
            wanted.setdefault(id(df), (df, []))[1].append(one)
    keys = reduce(DataFrame.unionByName, [df.select(F.inline(F.array(*columns))) for df, columns in wanted.values()])
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("key"))
    return keys.groupBy("relation", "child", F.bitmap_bucket_number("key").alias("bucket")).agg(bits.alias("bits"), F.count(F.lit(1)).alias("rows"))


def orphan_buckets(relations: Sequence[Relation]) -> DataFrame:
    """Buckets in which a child has keys that its parent hasn't: ``relation``, ``bucket``, the child's ``rows`` and number of ``keys``, and ``orphans``."""
    size = F.bitmap_count("bits")
    both = key_bitmaps(relations).groupBy("relation", "bucket").agg(
        F.coalesce(F.max(F.when(F.col("child"), F.col("rows"))), F.lit(0)).alias("rows"),
        F.coalesce(F.max(F.when(F.col("child"), size)), F.lit(0)).alias("keys"),
        F.coalesce(F.max(F.when(~F.col("child"), size)), F.lit(0)).alias("_parent"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("_all"),
    )
    rows = both.select("relation", "bucket", "rows", "keys", (F.col("_all") - F.col("_parent")).alias("orphans"))
    return rows.where("rows > 0 AND (orphans > 0 OR bucket IS NULL)")


def _key_by_key(relation: Relation, mixed: DataFrame) -> DataFrame:
    """Orphan rows in the mixed buckets alone."""
    own = relation.child.where(F.col(relation.key).isNotNull()).select(F.col(relation.key).cast("bigint").alias("_key"))
    known = relation.parent.select(F.col(relation.parent_key).cast("bigint").alias("_key"))
    own, known = (rows.withColumn("bucket", F.bitmap_bucket_number("_key")).join(mixed, "bucket", "left_semi") for rows in (own, known))
    return rows_without_partner(own, ["_key"], known, "orphans")


def orphans(relations: Sequence[Relation]) -> DataFrame:
    """``name`` and ``orphans`` of every relation: the child rows whose foreign key is missing or unknown.

    Integer keys of all relations are checked together, and one row for each relation comes back. Bitmaps tell the buckets that have orphans. Where all keys of a
    bucket are orphans, so are all of its rows, which are counted already; only the rows of mixed buckets are looked at key by key, in a second step for the
    relations that have any. Keys of other types are counted per key and joined.
    """
    whole = [r for r in relations if r.of_integers()]
    parts = []
    if whole:
        spark = whole[0].child.sparkSession
        mixed = (F.col("orphans") > 0) & (F.col("orphans") < F.col("keys"))
        found = orphan_buckets(whole).groupBy("relation").agg(
            F.coalesce(F.sum(F.when(~mixed, F.col("rows"))), F.lit(0)).alias("rows"), F.count_if(mixed).alias("mixed")
        )
        seen = {row["relation"]: row for row in found.collect()}
        parts.append(spark.createDataFrame([(r.name, seen[r.name]["rows"] if r.name in seen else 0) for r in whole], "name string, orphans bigint"))
        for relation in whole:
            n = seen[relation.name]["mixed"] if relation.name in seen else 0
            if n:
                buckets = materialise(orphan_buckets([relation]).where(mixed).select("bucket"), "mixed-buckets")
                left = _key_by_key(relation, F.broadcast(buckets) if n <= BROADCAST_BUCKETS else buckets)
                parts.append(left.select(F.lit(relation.name).alias("name"), "orphans"))
    for relation in relations:
        if not relation.of_integers():
            keys = relation.parent.select(F.col(relation.parent_key).alias("_key"))
            left = rows_without_partner(relation.child.select(F.col(relation.key).alias("_key")), ["_key"], keys, "orphans")
            parts.append(left.select(F.lit(relation.name).alias("name"), "orphans"))
    return reduce(DataFrame.unionByName, parts).groupBy("name").agg(F.sum("orphans").alias("orphans"))


def rows_without_parent(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: the number of ``orphans`` of a foreign key."""
    return orphans([Relation("", child, key, parent, parent_key)]).select("orphans")
