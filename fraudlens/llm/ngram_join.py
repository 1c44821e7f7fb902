"""Jaccard join of documents on word shingles, in the metric space of Jaccard distance.

1. Documents become sets of 64-bit hashes of ``width``-word shingles; equal sets become one
   point (id: its smallest document).  All later steps work on points.
2. Pivots: points that agree on a few minima of random orders propose the one among them with the
   most copies; the exact distance decides.  A point within the radius joins the Voronoi region of its nearest
   pivot; any other point is the pivot of its own region.  Links to pivots connect regions into cells.
   A group of near copies is settled here by a few comparisons a point, however large the group.
3. Candidate regions: two points within the radius share one of their first n - ceil(t n) + 1 shingles in
   rarity order, so regions of different cells meet where prefixes of theirs share a shingle.  Shingles of one
   cell leave before any shuffle of entries, by a bitmap of fixed size; at a shingle the largest cell does not meet itself.
4. Recursion: the pivots of two such regions are compared exactly, and one pair of members that share the rarest
   shingle.  Within the radius they link.  Where the pivots are farther apart
   than the radius and both regions' extents, the triangle inequality rules out all of their members.
5. Between the two, and only where the cells are still apart, the boundary documents are replicated: x and y
   meet where they share a shingle and their distances to their pivots add up to that of the pivots less
   the radius, at least.  The links of all rounds give the components.

Rarity comes from counters over all documents: ``COUNTERS`` hashed counters, so the
table sent to every task has a fixed size; shared passages get high counts and
stand at the end of the order.  Texts of points in candidate pairs are read again for
the verification; no other text is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import bitmap_of, bounded, discard, in_bitmap, staged
from fraudlens.llm.setjoin import components, leader_pairs, places_fit, prefix_length

WIDTH, PER_CENT = 5, 75
COUNTERS = 1 << 18
ORDERS, KEY_ORDERS = 8, 2          # random orders, and how many of them a pivot key joins

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
_SEEDS = (np.arange(1, ORDERS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS)), _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: words between white space, A-Z lower-cased.

    A text of fewer words, but not none, is one shingle.
    """
    data = np.frombuffer((text or "").encode().lower(), np.uint8)
    letters = np.flatnonzero(~_SPACE[data])
    if not len(letters):
        return np.zeros(0, np.uint64)
    heads = np.flatnonzero(np.r_[True, np.diff(letters) > 1])
    sizes = np.diff(np.r_[heads, len(letters)])
    place = np.arange(len(letters)) - np.repeat(heads, sizes)
    powers = _powers(int(sizes.max()))
    words = np.add.reduceat((data[letters].astype(np.uint64) + np.uint64(1)) * powers[place], heads)
    words = _mix(words + sizes.astype(np.uint64) * _BASE)
    k = min(width, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total = _mix(total * _BASE + words[i:len(words) - k + 1 + i])
    return np.unique(total)


def _minima(h: np.ndarray) -> list[int]:
    return [int((h * s).min()) for s in _SEEDS]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def rarity(rows: DataFrame, width: int) -> np.ndarray:
    """A rank from 0 (rare) to 255 for each of COUNTERS hash classes, by the documents that hold their shingles."""

    def count(batches):
        seen = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for t in b.column(0):
                at = (shingles(t.as_py(), width) >> np.uint64(46)).astype(np.int64)
                np.add.at(seen, at, 1)
        at = np.flatnonzero(seen)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[part])], names=["at", "n"])

    counts = (rows.select("text").mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))).toPandas()
    ranks = np.zeros(COUNTERS, np.uint8)
    if len(counts):
        n = counts["n"].to_numpy()
        ranks[counts["at"].to_numpy()] = np.minimum(255, n * 8 / max(1.0, n.sum() / COUNTERS)).astype(np.uint8)
    return ranks


def points(rows: DataFrame, ranks: np.ndarray, width: int, per_cent: int) -> DataFrame:
    """(doc_id, row, n, digest, keys, prefix, bits) of each document; the last three are empty for empty sets."""
    table = rows.sparkSession.sparkContext.broadcast(ranks.tobytes())

    def run(batches):
        ranks = np.frombuffer(table.value, np.uint8)
        for b in batches:
            n, digest, keys, prefix, bits = [], [], [], [], []
            for t in b.column(2):
                h = shingles(t.as_py(), width)
                n.append(len(h))
                digest.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                if not len(h):
                    keys.append([])
                    prefix.append([])
                    bits.append(b"")
                    continue
                bits.append(signature(h))
                low = _minima(h)
                keys.append([_signed(low[i:i + KEY_ORDERS], i) for i in range(0, ORDERS, KEY_ORDERS)])
                order = (ranks[(h >> np.uint64(46)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h & np.uint64((1 << 56) - 1))
                p = prefix_length(len(h), per_cent)
                prefix.append(np.sort(order)[:p].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["doc_id", "row", "n", "digest", "keys", "prefix", "bits"])

    return rows.mapInArrow(run, "doc_id bigint, row bigint, n bigint, digest binary, keys array<bigint>, "
                                "prefix array<bigint>, bits binary")


def _signed(values: list[int], salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(repr((salt, values)).encode(), digest_size=8).digest(), "little", signed=True)


def signature(h: np.ndarray) -> bytes:
    """A bit for each hash in a table of 2 to 4 bits a hash, from 256 to 2^16."""
    size = 1 << min(16, max(8, int(4 * len(h) - 1).bit_length() - 1))
    bits = np.zeros(size, bool)
    bits[(h & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_match(p: bytes, q: bytes, n: int, m: int, per_cent: float) -> bool:
    """False only where the similarity is out of reach: every bit that differs is a hash of one set alone."""
    p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
    while len(p) > len(q):                       # a table folds into the one of half its size
        p = p[:len(p) // 2] | p[len(p) // 2:]
    while len(q) > len(p):
        q = q[:len(q) // 2] | q[len(q) // 2:]
    shared = (n + m - int(np.bitwise_count(p ^ q).sum())) / 2
    return (100 + per_cent) * shared >= per_cent * (n + m)


SLACK = 1e-9                       # of distances compared as floating point numbers; links are decided on integers


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y, reach) whose signatures leave a distance up to ``reach`` possible."""
    a, b = (sets.select(F.col("id").alias(v), F.col("n").alias(f"n{v}"), F.col("bits").alias(f"b{v}")) for v in "xy")

    def test(batches):
        for c in batches:
            keep = [may_match(p.as_py(), q.as_py(), n, m, 100 * (1 - reach - SLACK))
                    for p, q, n, m, reach in zip(c.column(3), c.column(4), *(c.column(k).to_pylist() for k in (5, 6, 2)))]
            yield pa.RecordBatch.from_arrays(c.columns[:3], names=["x", "y", "reach"]).filter(pa.array(keep, pa.bool_()))

    return staged(pairs.join(a, "x").join(b, "y").select("x", "y", "reach", "bx", "by", "nx", "ny")
                  .mapInArrow(test, "x bigint, y bigint, reach double"), "possible")


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, width: int, per_cent: int) -> DataFrame:
    """(x, y, reach, d, link) of the pairs (x, y, reach) at a distance d up to ``reach``, from the texts of both.

    ``sets``: id, doc_id, row, n, bits of each point; pairs that the signatures rule out
    go first, and texts are read for points in a remaining pair only.
    """
    pairs = possible(pairs, sets)
    wanted = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct()
    at = staged(sets.select("id", "doc_id", "row").join(bounded(staged(wanted, "step")), "id"), "step")
    small = bounded(at)

    def hashes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([shingles(t.as_py(), width).tobytes() for t in b.column(1)], pa.binary())],
                names=["id", "h"])

    same = rows["doc_id"].eqNullSafe(small["doc_id"]) & (rows["row"] == small["row"])
    found = staged(rows.join(small, same).select("id", "text").mapInArrow(hashes, "id bigint, h binary")
                   .dropDuplicates(["id"]), "sets")

    def test(batches):
        for b in batches:
            far, link = [], []
            for p, q in zip(b.column(3), b.column(4)):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
                both = len(np.intersect1d(p, q, assume_unique=True))
                either = len(p) + len(q) - both
                far.append(1 - both / either)
                link.append(100 * both >= per_cent * either)
            out = pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(far, pa.float64()), pa.array(link, pa.bool_())],
                                             names=["x", "y", "reach", "d", "link"])
            keep = [i or d <= r + SLACK for i, d, r in zip(link, far, b.column(2).to_pylist())]
            yield out.filter(pa.array(keep, pa.bool_()))

    a = found.select(F.col("id").alias("x"), F.col("h").alias("hx"))
    b = found.select(F.col("id").alias("y"), F.col("h").alias("hy"))
    out = staged(pairs.join(a, "x").join(b, "y").select("x", "y", "reach", "hx", "hy")
                 .mapInArrow(test, "x bigint, y bigint, reach double, d double, link boolean"), "verified")
    discard(pairs, at, found)
    return out


def voronoi(sets: DataFrame, links: DataFrame, cells: DataFrame) -> DataFrame:
    """id, n, prefix, region (its pivot's id), away (distance to it) and cell of each point."""
    pivots = links.select(F.col("y").alias("id")).distinct().withColumn("pivot", F.lit(True))
    nearest = links.groupBy(F.col("x").alias("id")).agg(F.min(F.struct("d", "y")).alias("near"))
    member = F.col("near").isNotNull() & F.col("pivot").isNull()
    return staged(sets.select("id", "n", "prefix").join(nearest, "id", "left").join(pivots, "id", "left").join(cells, "id", "left").select(
        "id", "n", "prefix", F.when(member, F.col("near.y")).otherwise(F.col("id")).alias("region"),
        F.when(member, F.col("near.d")).otherwise(F.lit(0.0)).alias("away"), F.coalesce("root", "id").alias("cell")), "regions")


def mixed_entries(points: DataFrame) -> DataFrame:
    """element, id, pos, n, region, away, cell, main: prefix shingles that several cells hold; main: the one with most entries."""
    several = (points.select("cell", F.explode("prefix").alias("element")).groupBy("element")
               .agg(F.min("cell").alias("lo"), F.max("cell").alias("hi")).where("lo < hi"))
    table = points.sparkSession.sparkContext.broadcast(bitmap_of(several, "element"))

    def run(batches):
        seen = np.frombuffer(table.value, np.uint8)
        for b in batches:
            lists = b.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            elements = lists.flatten().to_numpy()
            own = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = np.flatnonzero(in_bitmap(seen, elements))
            rows = pa.array(own[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements[keep]), b.column(0).take(rows), pa.array(pos[keep].astype(np.int32)), b.column(1).take(rows),
                 *[b.column(k).take(rows) for k in (3, 4, 5)]], names=["element", "id", "pos", "n", "region", "away", "cell"])

    entries = staged(points.select("id", "n", "prefix", "region", "away", "cell").mapInArrow(
        run, "element bigint, id bigint, pos int, n bigint, region bigint, away double, cell bigint"), "entries")
    by_cell = entries.groupBy("element", "cell").agg(F.count(F.lit(1)).alias("c"))
    largest = (by_cell.groupBy("element").agg(F.max(F.struct("c", "cell")).alias("m"), F.count(F.lit(1)).alias("cells"))
               .where("cells > 1").select("element", F.col("m.cell").alias("of")))
    mixed = staged(entries.join(largest, "element").withColumn("main", F.col("cell") == F.col("of")).drop("of"), "mixed")
    discard(entries)
    return mixed


def met_regions(entries: DataFrame, extents: DataFrame, per_cent: int) -> DataFrame:
    """(element, i, j, reach, x, y): regions i < j of different cells whose members x and y share a shingle, and how far apart pivots may be."""
    held = (entries.groupBy("element", "region").agg(
        F.first("cell").alias("cell"), F.first("main").alias("main"), F.min("id").alias("id"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest")).join(extents, "region"))
    a, b = held.where("NOT main").alias("a"), held.alias("b")
    left, right = ({c: F.col(f"{s}.{c}") for c in held.columns} for s in "ab")
    # length and positional filters that hold for some members of the two, at this shingle
    fit = ((F.least(left["most"], right["most"]) * 100 >= F.greatest(left["least"], right["least"]) * per_cent)
           & (F.least(left["rest"], right["rest"]) * (100 + per_cent) >= (left["least"] + right["least"]) * per_cent))
    once = right["main"] | (left["region"] < right["region"])
    low, high = (F.when((left["region"] < right["region"]) == F.lit(first), F.struct(left["region"], left["id"]))
                 .otherwise(F.struct(right["region"], right["id"])) for first in (True, False))
    return staged(a.join(b, F.col("a.element") == F.col("b.element"))
                  .where((left["cell"] != right["cell"]) & once & fit)
                  .select(F.col("a.element").alias("element"), low.alias("low"), high.alias("high"),
                          (1 - per_cent / 100 + left["extent"] + right["extent"]).alias("reach"))
                  .select("element", "reach", F.col("low.region").alias("i"), F.col("high.region").alias("j"),
                          F.col("low.id").alias("x"), F.col("high.id").alias("y")), "met")


def boundary_pairs(apart: DataFrame, met: DataFrame, entries: DataFrame, per_cent: int) -> DataFrame:
    """(x, y): members of the regions of ``apart`` (i, j, d) that share a shingle and that the triangle inequality leaves within the radius."""
    a, b = (entries.select("element", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "pos", "region", "away")]) for s in "xy")
    left, right = ({c: F.col(f"{c}_{s}") for c in ("n", "pos")} for s in "xy")
    near = F.col("away_x") + F.col("away_y") >= F.col("d") - (1 - per_cent / 100) - SLACK
    return (met.select("element", "i", "j").join(apart, ["i", "j"])
            .join(a.withColumnRenamed("region_x", "i"), ["element", "i"]).join(b.withColumnRenamed("region_y", "j"), ["element", "j"])
            .where(near & places_fit(left, right, per_cent)).select(F.col("id_x").alias("x"), F.col("id_y").alias("y")).distinct())


def still_apart(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """The pairs (x, y, …) of points in different cells."""
    a, b = (cells.select(F.col("id").alias(v), F.col("root").alias(f"root_{v}")) for v in "xy")
    return (pairs.join(a, "x", "left").join(b, "y", "left")
            .where(F.coalesce("root_x", "x") != F.coalesce("root_y", "y")).drop("root_x", "root_y"))


def near_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    per_cent: int = PER_CENT) -> DataFrame:
    """One row per document: ``doc_id, row, n_shingles, component_id``.

    Documents are linked at a Jaccard similarity of ``per_cent`` / 100 or more of their
    shingle sets; ``component_id`` is the smallest doc_id reachable.  NULL, empty and
    white texts have no shingles and no links.  Texts of any length are read whole.  Rows that share an id count each by their
    own text (``row`` is a hash of it); a NULL id is never the smallest unless
    alone.  Empty tables give empty results; other columns are not read.
    """
    rows = _rows(documents, id_col, text_col)
    ranks = rarity(rows, width)
    docs = staged(points(rows, ranks, width, per_cent), "points")
    sets = staged(
        docs.where("n > 0").groupBy("digest", "n").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("m"),
            F.count(F.lit(1)).alias("copies"),
            F.first("keys").alias("keys"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
        .select("digest", "n", "m.doc_id", "m.row", F.struct(-F.col("copies"), "m.no_id", "m.doc_id").alias("rank"),
                "keys", "prefix", "bits")
        .withColumn("id", F.monotonically_increasing_id()), "point-sets")
    named_sets = staged(docs.select("doc_id", "row", "n", "digest"), "points-named")
    discard(docs)

    def compared(pairs: DataFrame) -> DataFrame:
        return verified(pairs, sets, rows, width, per_cent)

    radius = F.lit(1 - per_cent / 100)
    proposed = leader_pairs(sets.select("id", "rank", F.explode("keys").alias("key"))).withColumn("reach", radius)
    to_pivots = compared(proposed).where("link")
    links = to_pivots.select("x", "y")
    cells = components(links, "cells")

    regions = voronoi(sets, to_pivots, cells)
    entries = mixed_entries(regions)
    extents = staged(regions.groupBy("region").agg(F.max("away").alias("extent")), "extents")
    discard(regions)
    met = met_regions(entries, extents, per_cent)
    pairs = staged(met.groupBy("i", "j").agg(F.max("reach").alias("reach"), F.min(F.struct("element", "x", "y")).alias("m")), "region-pairs")
    tried = pairs.select(F.col("i").alias("x"), F.col("j").alias("y"), "reach").unionByName(pairs.select("m.x", "m.y", radius.alias("reach")))
    found = compared(tried.groupBy("x", "y").agg(F.max("reach").alias("reach")))
    links = links.unionByName(found.where("link").select("x", "y"))
    cells = components(links, "cells")
    pivots = found.where("NOT link").select("x", "y", "d").join(pairs.select(F.col("i").alias("x"), F.col("j").alias("y")), ["x", "y"])
    apart = staged(still_apart(pivots, cells).select(F.col("x").alias("i"), F.col("y").alias("j"), "d"), "apart")
    if not apart.isEmpty():
        rest = still_apart(boundary_pairs(apart, met, entries, per_cent), cells).withColumn("reach", radius)
        links = links.unionByName(compared(rest).where("link").select("x", "y"))
        cells = components(links, "cells")
    discard(entries, extents, met, pairs)

    named = sets.select("id", "digest", "n", "doc_id").join(cells, "id", "left").withColumn("root", F.coalesce("root", "id"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(smallest, "root").select("digest", "n", "component_id")
    return named_sets.join(of_set, ["digest", "n"], "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
