"""Shared parts of the exact set-similarity joins: bounds, prefix-window join and components.

All bounds are integers.  For sets of sizes a and b with overlap o, the similarity
reaches ``per_cent`` / 100 when (100 + per_cent) * o >= per_cent * (a + b).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import staged

Test = Callable[[DataFrame, DataFrame], Column]


def prefix_length(n: int, per_cent: int) -> int:
    """Any two sets that reach the similarity share one of their first so many elements in a common order."""
    return n - -(-n * per_cent // 100) + 1


def sizes_fit(a: Column, b: Column, per_cent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * per_cent


def overlap_fits(overlap: Column, a: Column, b: Column, per_cent: int) -> Column:
    return overlap * (100 + per_cent) >= (a + b) * per_cent


def places_fit(a: DataFrame, b: DataFrame, per_cent: int) -> Column:
    """Positional filter: true where this shared element can be the first of enough shared ones."""
    rest = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return sizes_fit(a["n"], b["n"], per_cent) & overlap_fits(rest, a["n"], b["n"], per_cent)


def index_length(n: Column, per_cent: int) -> Column:
    """Of two sets that reach the similarity, the smaller one shares one of its first so many elements with the other's prefix."""
    return n - F.ceil(n * (2 * per_cent) / (100 + per_cent)).cast("int") + 1


def open_pairs(sets: DataFrame, per_cent: int, keep: Test, passes: int = 4) -> DataFrame:
    """(x, y): distinct pairs with an open set that share an element of their prefixes and pass ``keep``.

    ``sets``: id, n, prefix (array of elements in the common order), open and whatever ``keep`` compares.
    Two settled sets never meet: the prefixes of open sets are joined with the short prefixes of smaller open sets
    and with the prefixes of settled ones.  An element of u open and s settled sets costs u * (u + s) rows, not
    (u + s) ^ 2; the adaptive skew join splits an element that many prefixes hold.  Each pass joins a share of
    the elements, so that only a share of the entries lies in shuffle files at a time.
    """
    entries = sets.select("*", F.posexplode("prefix").alias("pos", "element")).drop("prefix")
    short = F.col("pos") < index_length(F.col("n"), per_cent)
    left, right = _side("a", entries), _side("b", entries)
    larger = (left["n"] > right["n"]) | ((left["n"] == right["n"]) & (left["id"] > right["id"]))

    def met(turn: int) -> DataFrame:
        mine = entries.where(F.pmod("element", F.lit(passes)) == turn)
        return (mine.where("open").drop("open").alias("a")
                .join(mine.where(~F.col("open") | short).alias("b"), F.col("a.element") == F.col("b.element"))
                .where((larger | ~right["open"]) & places_fit(left, right, per_cent) & keep(left, right))
                .select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).distinct())

    return reduce(DataFrame.unionByName, [staged(met(turn), "open-pairs") for turn in range(passes)]).distinct()


class _side(dict):
    """Columns of one side of a self-join, by name."""

    def __init__(self, name: str, df: DataFrame):
        super().__init__({c: F.col(f"{name}.{c}") for c in df.columns})


def leader_pairs(keys: DataFrame) -> DataFrame:
    """(x, y): each id with the first by ``rank`` of all ids that share a key with it, for each of its keys.

    ``keys``: id, rank, key.  Groups are aggregated before the shuffle; a hot group
    is split by the adaptive skew join.
    """
    first = (keys.groupBy("key").agg(F.min(F.struct("rank", "id")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("key", F.col("first.id").alias("y")))
    return keys.select(F.col("id").alias("x"), "key").join(first, "key").where("x <> y").select("x", "y").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) of every id in ``links`` (x, y): root is the smallest id reachable.

    Alternates two star operations until nothing changes: every id's larger
    neighbours are linked to its smallest one, then its smaller neighbours are.
    Only the remaining links are shuffled, and each round is checkpointed.
    """
    edges = staged(links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
                        .where("x <> y").distinct(), "step")
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("low")).select("x", F.least("x", "low").alias("low"))
        large = (both.where("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("low").alias("y"))
                 .distinct())
        large = staged(large.where("x <> y"), "step")
        low = large.groupBy("x").agg(F.min("y").alias("low"))
        small = (large.join(low, "x").where("y <> low").select(F.col("y").alias("x"), F.col("low").alias("y"))
                 .unionByName(low.select("x", F.col("low").alias("y"))).distinct())
        after = staged(small, "step")
        # done when every id has one link, to a root that has none
        loose = (after.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
                 and after.join(after.select(F.col("x").alias("y")).distinct(), "y", "left_semi").isEmpty())
        edges = after
        if loose:
            break
    roots = edges.select(F.col("y").alias("id"), F.col("y").alias("root")).distinct()
    return staged(edges.select(F.col("x").alias("id"), F.col("y").alias("root")).unionByName(roots), name)
