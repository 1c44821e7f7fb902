r"""Repeated-passage removal by sorting sampled suffixes and inducing the rest from them.

A byte goes when a ``LENGTH``-byte string that covers it also starts in a document with a smaller id.

1. Sample: of the 24-byte strings in a window of 50 bytes, the one with the least hash is its
   anchor, the leftmost of equals.  The choice depends on the window's bytes alone, so equal windows have
   equal anchors, and a text has about one anchor in 14 bytes.  Each anchor induces the run of
   windows that chose it: at most 27, and their bytes are one region.
2. Anchors are aggregated over all documents to the smallest and largest id that hold them.  Anchors of one
   document induce nothing and leave here; a bitmap of fixed size, in which a wrong bit only
   lets an anchor through, spares the shuffle most of them.
3. Suffix tuples (anchor, region, id, place) of the rest are grouped into classes of equal regions.  All
   windows of a class are settled for every document but its first: copies, however
   many, are one class, and no two of them are compared.
4. Recursion into the anchors with several classes: the first document of each class is read again, its
   region is taken apart into windows, and equal windows of different classes meet: inside a row for
   an anchor of up to ``ROW_CLASSES`` classes, by an aggregation of windows for one of more.  What the first
   document shares with a smaller one comes back as a bit mask of the class.
5. Tuples meet their class, and the windows of a document are united and cut out of its text.

The queues of an external induced sort are Spark's shuffles here: sorted and aggregated under a memory bound,
spilled to disk beyond it, and computed again when an executor is lost.  Suffixes are named by 64-bit hashes
of anchor and region together (128 bits) where a textbook sort ranks them; equality to 50 bytes is all that
common-prefix values are needed for, and equal window names say just that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import bitmap_of, discard, in_bitmap, staged

LENGTH, GRAM = 50, 24                  # bytes of a repeated string, and of an anchor
PLACES = LENGTH - GRAM + 1             # anchors to choose from in a window
ROW_CLASSES = 64                       # regions of one anchor that are compared in one row: at most 5 KB
CHUNK = 1 << 18                        # bytes that are hashed at once; longer documents come in overlapping parts

_TABLE = np.random.default_rng(50).integers(0, 1 << 64, 256, np.uint64)
_ODD = np.random.default_rng(16).integers(0, 1 << 64, 12, np.uint64) | np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 24 and of the 50 bytes from each place on."""
    of = {1: _TABLE[data]}
    for k, n in enumerate((1, 2, 4, 8, 16)):
        of[2 * n] = of[n][:-n] * _ODD[k] + of[n][n:]
    size = len(data) - LENGTH + 1
    window = _mix((of[32][:size] * _ODD[8] + of[16][32:32 + size]) * _ODD[9] + of[2][48:48 + size])
    return _mix(of[16][:-8] * _ODD[7] + of[8][16:]), window


def _least(key: np.ndarray) -> np.ndarray:
    """The least of each PLACES neighbours."""
    n, low = 1, key
    while 2 * n <= PLACES:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    return np.minimum(low[:len(low) - (PLACES - n)], low[PLACES - n:])


def anchors(data: np.ndarray, inside: np.ndarray):
    """Runs of windows with one anchor: (first window, windows, anchor's hash, region's hash) and the windows' hashes.

    ``inside``: False for windows that are none of a document.
    """
    gram, window = _grams(data)
    key = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    at = (_least(key) & _PLACE).astype(np.int64)
    at[~inside] = -1
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[first, len(at)])
    kept = at[first] >= 0
    first, count = first[kept], count[kept]
    # the first and last window of a run cover its region, which is shorter than both
    region = _mix(window[first] * _ODD[10] + window[first + count - 1] * _ODD[11] + count.astype(np.uint64))
    return first, count, gram[at[first]], region, window


def parts(texts):
    """(number of the text, offset, bytes) of texts long enough for a window, cut where longer than CHUNK."""
    for i, text in enumerate(texts):
        data = (text.as_py() or "").encode()
        for start in range(0, len(data) - LENGTH + 1, CHUNK):
            yield i, start, data[start:start + CHUNK + LENGTH - 1]


def chunks(texts):
    """Parts packed into chunks: (numbers, offsets, places, bytes, inside)."""
    held, size = [], 0

    def packed():
        data = np.frombuffer(b"".join(p[2] for p in held), np.uint8)
        sizes = np.array([len(p[2]) for p in held], np.int64)
        places = np.cumsum(sizes) - sizes
        marks = np.zeros(len(data) + 1, np.int8)          # windows that end in their own part
        np.add.at(marks, places, 1)
        np.add.at(marks, places + sizes - LENGTH + 1, -1)
        inside = np.cumsum(marks[:len(data) - LENGTH + 1]) > 0
        return np.array([p[0] for p in held]), np.array([p[1] for p in held], np.int64), places, data, inside

    for part in parts(texts):
        held.append(part)
        size += len(part[2])
        if size >= CHUNK:
            yield packed()
            held, size = [], 0
    if held:
        yield packed()


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def shared_anchors(rows: DataFrame) -> bytes:
    """The bitmap of anchors that more than one id holds."""

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for numbers, _, places, data, inside in chunks(b.column(2)):
                first, _, gram, _, _ = anchors(data, inside)
                holders = ids[numbers[np.searchsorted(places, first, "right") - 1]]
                yield pa.RecordBatch.from_arrays([_signed(gram), pa.array(holders)], names=["h", "id"])

    held = rows.mapInArrow(run, "h bigint, id bigint").groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    held = staged(held.select("h"), "suffix-shared")
    bitmap = bitmap_of(held, "h")
    discard(held)
    return bitmap


def suffix_tuples(rows: DataFrame, bitmap: bytes) -> DataFrame:
    """(h, r, id, row, x, m): anchor, region, document, first window and number of windows of each run whose anchor may be shared."""
    table = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        seen = np.frombuffer(table.value, np.uint8)
        for b in batches:
            ids, texts = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            for numbers, offsets, places, data, inside in chunks(b.column(2)):
                first, count, gram, region, _ = anchors(data, inside)
                keep = in_bitmap(seen, gram)
                first, count, gram, region = first[keep], count[keep], gram[keep], region[keep]
                part = np.searchsorted(places, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [_signed(gram), _signed(region), pa.array(ids[numbers[part]]), pa.array(texts[numbers[part]]),
                     pa.array(first - places[part] + offsets[part]), pa.array(count.astype(np.int32))],
                    names=["h", "r", "id", "row", "x", "m"])

    return staged(rows.mapInArrow(run, "h bigint, r bigint, id bigint, row bigint, x bigint, m int"), "suffix-tuples")


def regions(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(c, h, id, bytes, n): the region of each class that shares its anchor with n - 1 others, read from its first document."""
    spread = classes.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("least"), F.max("hi").alias("most"))
    several = spread.where("n > 1 AND least < most").select("h", "n")
    wanted = staged(classes.join(several, "h").groupBy(F.col("lo").alias("id"), "row")
                    .agg(F.collect_list(F.struct("c", "h", "x", "m", "n")).alias("runs")), "suffix-wanted")

    def run(batches):
        for b in batches:
            for doc_id, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                data = text.as_py().encode()
                c, h, x, m, n = (runs.values.field(name) for name in ("c", "h", "x", "m", "n"))
                cut = [data[s:s + k + LENGTH - 1] for s, k in zip(x.to_pylist(), m.to_pylist())]
                yield pa.RecordBatch.from_arrays([c, h, pa.array([doc_id] * len(cut), pa.int64()), pa.array(cut, pa.binary()), n],
                                                 names=["c", "h", "id", "bytes", "n"])

    found = staged(rows.join(wanted, ["id", "row"]).select("id", "text", "runs")
                   .mapInArrow(run, "c bigint, h bigint, id bigint, bytes binary, n bigint"), "suffix-regions")
    discard(wanted)
    return found


def windows_of(held: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the region, place in it, hash) of each window of the regions."""
    sizes = np.array([len(r) for r in held], np.int64)
    base, m = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
    own = np.repeat(np.arange(len(m)), m)
    j = np.arange(len(own)) - np.repeat(np.cumsum(m) - m, m)
    # regions lie side by side: windows that cross two of them are not read
    return own, j, _grams(np.frombuffer(b"".join(held), np.uint8))[1][base[own] + j]


def induced(regions: DataFrame, names: list[str]) -> DataFrame:
    """The windows of each region, their hash ``w`` and place ``j`` in it among the columns ``names``."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1 << 14):
                part = b.slice(at, 1 << 14)
                own, j, window = windows_of(part.column(3).to_pylist())
                of = {name: part.column(k).to_numpy()[own] for k, name in enumerate(("c", "h", "id"))}
                of |= {"w": window.view(np.int64), "j": j.astype(np.int32)}
                yield pa.RecordBatch.from_arrays([pa.array(of[n]) for n in names], names=names)

    return regions.mapInArrow(run, ", ".join(f"{n} {'int' if n == 'j' else 'bigint'}" for n in names))


def row_masks(regions: DataFrame) -> DataFrame:
    """(c, mask) for anchors of few classes: all of them meet in one row."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1 << 11):
                lists = b.column(0).slice(at, 1 << 11)
                held = lists.flatten()
                c, doc_id = held.field("c").to_numpy(), held.field("id").to_numpy()
                sizes = np.diff(lists.offsets.to_numpy())
                anchor = np.repeat(np.arange(len(sizes)), sizes)
                own, j, window = windows_of(held.field("bytes").to_pylist())
                order = np.lexsort((doc_id[own], window, anchor[own]))
                new = np.flatnonzero(np.r_[True, (np.diff(anchor[own[order]]) != 0) | (np.diff(window[order].view(np.int64)) != 0)])
                least = np.repeat(doc_id[own[order[new]]], np.diff(np.r_[new, len(order)]))
                gone = order[doc_id[own[order]] > least]
                mask = np.zeros(len(c), np.int64)
                np.bitwise_or.at(mask, own[gone], np.int64(1) << j[gone])
                some = np.flatnonzero(mask)
                yield pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(mask[some])], names=["c", "mask"])

    return (regions.groupBy("h").agg(F.collect_list(F.struct("c", "id", "bytes")).alias("held")).select("held")
            .mapInArrow(run, "c bigint, mask bigint"))


def class_masks(regions: DataFrame) -> DataFrame:
    """(c, mask): windows of a class's first document that a smaller document holds in another class; bit j is window j."""
    few, many = regions.where(F.col("n") <= ROW_CLASSES), regions.where(F.col("n") > ROW_CLASSES)
    first = staged(induced(many, ["h", "w", "id"]).groupBy("h", "w").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                   .where("lo < hi").select("h", "w", "lo"), "suffix-windows")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("j"))
    shared = (induced(many, ["c", "h", "w", "id", "j"]).join(first, ["h", "w"]).where("id > lo")
              .groupBy("c").agg(F.bit_or(one).alias("mask")))
    masks = staged(row_masks(few).unionByName(shared), "suffix-masks")
    discard(first)
    return masks


def repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, runs): runs of windows (x, bits) of each document that a smaller document holds; others are left out."""
    rows = _rows(documents, id_col, text_col).where("id IS NOT NULL")
    tuples = suffix_tuples(rows, shared_anchors(rows))
    classes = staged(tuples.groupBy("h", "r").agg(F.min(F.struct("id", "row", "x", "m")).alias("first"), F.max("id").alias("hi"))
                     .select("h", "r", F.col("first.id").alias("lo"), "hi", "first.row", "first.x", "first.m")
                     .withColumn("c", F.monotonically_increasing_id()), "suffix-classes")
    cut = regions(rows, classes)
    masks = class_masks(cut)
    decided = staged(classes.select("c", "h", "r", "lo", "hi").join(masks, "c", "left").where("hi > lo OR mask IS NOT NULL")
                     .select("h", "r", "lo", "mask"), "suffix-decided")
    discard(classes, cut, masks)
    whole = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("m")) - 1
    bits = F.when(F.col("id") > F.col("lo"), whole).otherwise(F.col("mask"))
    runs = staged(tuples.join(decided, ["h", "r"]).select("id", "row", "x", bits.alias("bits")).where("bits IS NOT NULL"), "suffix-runs")
    discard(tuples, decided)
    return runs.groupBy("id", "row").agg(F.collect_list(F.struct("x", "bits")).alias("runs"))


def _rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))


def covered(size: int, x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """True for each byte in one of the windows: window j of run (x, bits) starts at x + j where bit j is set."""
    starts = np.concatenate([x[(bits >> j) & 1 == 1] + j for j in range(PLACES)]) if len(x) else np.zeros(0, np.int64)
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + LENGTH, -1)
    return np.cumsum(marks[:-1]) > 0


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, spans, kept``.

    ``spans`` are (start, end) byte offsets of the maximal removed runs, ``kept`` the remaining bytes: they may end
    inside a character.  NULL counts as empty; texts of fewer than 50 bytes stay whole and remove nothing.
    Strings are judged on the input.  Only a smaller id removes: rows that share an id remove nothing from each other,
    rows that repeat an id and its text have one result, and a NULL id neither loses nor removes
    anything.  Texts of any length are read whole, in parts.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = _rows(documents, id_col, text_col)
    found = repeats(documents, id_col, text_col).select(F.col("id").alias("_id"), F.col("row").alias("_row"), "runs")
    joined = rows.join(found, (rows["id"] == found["_id"]) & (rows["row"] == found["_row"]), "left").select("id", "text", "runs")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("spans", pa.list_(span)), ("kept", pa.binary())])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for doc_id, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                data = text.as_py().encode()
                kept, spans = data, []
                if runs.is_valid:
                    gone = covered(len(data), *(runs.values.field(k).to_numpy() for k in ("x", "bits")))
                    edges = np.flatnonzero(np.diff(np.r_[False, gone, False])).tolist()
                    spans = [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])]
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                held.append((doc_id, len(data), len(data) - len(kept), len(spans), spans, kept))
                size += len(kept) + 16 * len(spans) + 64
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                  "spans array<struct<start: bigint, end: bigint>>, kept binary")
