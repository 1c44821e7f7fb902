"""Benchmark decontamination: prefix-filtered join of item-sized word windows with documents.

Every item gives its windows of ``window`` consecutive words (one window of all
its words where it has fewer).  A window occurs in a document only if all its
words do, so containment 1 leaves a necessary prefix of one token: the
window's rarest word, by its count over all documents.  Document words join on
that word; the word's place in the window gives the only possible start, which
must lie inside the document (positional and length bound); what is left is
verified word by word against the document's words at that place.

While the items' size, which is counted first, is under ``broadcast_bytes``, an
index of windows by their rarest word goes to every task and documents are matched
where they are read, in two passes (counts, matches) without a shuffle of
documents.  Larger benchmarks take the same steps as shuffled joins: word positions
against rarest words, then candidates back to the documents for verification.
"""

from __future__ import annotations

from collections import Counter
from itertools import compress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import ascii_lower, materialize

#: Maximal runs of what is neither an ASCII control, space nor punctuation; A-Z fold to a-z afterwards.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


#: The same on UTF-8 bytes: what is no part of a word becomes a space, A-Z become a-z.
TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, win): each item's windows, their words joined by one space."""
    words = F.split(ascii_lower(F.array_join(words_of(F.col(text_col)), " ")), " ")
    n = F.size("words")
    return (benchmark.select(F.col(item_col).alias("item_id"), words.alias("words"))
            .where("words[0] <> ''")
            .select("item_id", "words", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), n - window + 1))).alias("at"))
            .select("item_id", F.array_join(F.slice("words", F.col("at"), window), " ").alias("win"))
            .distinct())


def joined_hits(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, row, start, len, win) of every occurrence of a window, by shuffled joins; ``start`` counts words from 0."""
    docs = docs.select("doc_id", "row", words_of(F.col("text")).alias("words"))
    parts = wins.select("win", F.split("win", " ").alias("w"))
    counts = materialize(
        docs.select(F.explode("words").alias("word")).select(ascii_lower(F.col("word")).alias("word"))
        .join(parts.select(F.explode("w").alias("word")).distinct(), "word").groupBy("word").count())
    # a window with a word that no document has cannot occur
    places = parts.select("win", F.size("w").alias("len"), F.posexplode("w").alias("offset", "word"))
    prefix = (places.join(counts, "word", "left").groupBy("win", "len")
              .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word", "offset")).alias("rarest"))
              .where("rarest.n > 0").select("win", "len", "rarest.word", "rarest.offset"))
    spots = docs.select("doc_id", "row", F.size("words").alias("n_words"), F.posexplode("words").alias("pos", "w"))
    inside = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("len") <= F.col("n_words"))
    candidates = (spots.withColumn("word", ascii_lower(F.col("w"))).join(prefix, "word").where(inside)
                  .select(F.col("doc_id").alias("c_id"), F.col("row").alias("c_row"),
                          (F.col("pos") - F.col("offset")).alias("start"), "len", "win").distinct())
    same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("row") == F.col("c_row"))
    matches = ascii_lower(F.array_join(F.slice("words", F.col("start") + 1, F.col("len")), " ")) == F.col("win")
    return (candidates.join(docs.dropDuplicates(["doc_id", "row"]), same).where(matches)
            .select("doc_id", "row", "start", "len", "win"))


def split_words(data: bytes) -> list[bytes]:
    return data.translate(TO_WORDS).split()


def _word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of the benchmark occurs in all documents; bounded by the benchmark's vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known, seen = sent.value.__contains__, Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(filter(known, split_words(t.as_py())))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                             names=["word", "n"])

    rows = (docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    return {bytes(r["word"]): r["n"] for r in rows}


def rarest_index(wins: dict[bytes, list[str]], counts: dict[bytes, int]) -> dict[bytes, list[tuple]]:
    """Rarest word: (its place, words, item ids) of each window whose words all occur in documents."""
    index: dict[bytes, list[tuple]] = {}
    for win, items in wins.items():
        words = win.split(b" ")
        n, _, at = min((counts.get(w, 0), w, i) for i, w in enumerate(words))
        if n:
            index.setdefault(words[at], []).append((at, words, items))
    return index


def matched_windows(words: list[bytes], index: dict[bytes, list[tuple]]) -> tuple[list[tuple[int, int]], set[str]]:
    """Sorted (start, len) of every window that occurs in a document's words, and the ids of their items."""
    spans, items = set(), set()
    for pos in compress(range(len(words)), map(index.__contains__, words)):
        for at, win, owners in index[words[pos]]:
            start = pos - at
            if start >= 0 and words[start:start + len(win)] == win:
                spans.add((start, len(win)))
                items.update(owners)
    return sorted(spans), items


def _matched_where_read(docs: DataFrame, windows: list) -> DataFrame:
    """(doc_id, row, n_words, spans, item_ids) of each document, with the index of windows sent to every task."""
    wins: dict[bytes, list[str]] = {}
    for r in windows:
        held = wins.setdefault(r["win"].encode(), [])
        if r["item_id"] is not None:
            held.append(str(r["item_id"]))
    counts = _word_counts(docs, {w for win in wins for w in win.split(b" ")})
    sent = docs.sparkSession.sparkContext.broadcast(rarest_index(wins, counts))
    span = pa.list_(pa.struct([("start", pa.int32()), ("len", pa.int32())]))

    def run(batches):
        index = sent.value
        for b in batches:
            n, spans, items = [], [], []
            for t in b.column(1):
                words = split_words(t.as_py())
                found, owners = matched_windows(words, index)
                n.append(len(words))
                spans.append([{"start": s, "len": k} for s, k in found])
                items.append(sorted(owners))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "row", "n_words", "spans", "item_ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary"), "row").mapInArrow(
        run, f"doc_id {kind}, row bigint, n_words bigint, spans array<struct<start:int,len:int>>, item_ids array<string>")


def _matched_by_joins(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The same rows by shuffled joins."""
    hits = materialize(joined_hits(docs, windows.select("win").distinct()).distinct())
    spans = hits.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"))
    items = (hits.select("doc_id", "row", "win").distinct().join(windows, "win").groupBy("doc_id", "row")
             .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["row"] == right["row"])

    found = spans.join(items, same(spans, items)).select(spans["doc_id"], spans["row"], "spans", "item_ids")
    counted = docs.select("doc_id", "row", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    return counted.join(found, same(counted, found), "left").select(
        counted["doc_id"], counted["row"], "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,len:int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def covered(spans: Column) -> Column:
    """Number of places that sorted (start, len) spans cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def step(acc, s):
        end = s["start"] + s["len"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per document: ``doc_id, row, n_words, n_hit, item_ids, spans, contaminated``.

    ``spans``: (start, len) in words of every window that occurs, sorted;
    ``n_hit``: words inside any of them; ``item_ids``: items with such a
    window, sorted as strings.  NULL and empty texts have no words.  Items without
    words have no windows; items with a NULL id count for ``n_hit`` alone.
    Equal items and repeated windows count once for each item id.  Rows that
    share a doc_id are judged each by its own text (``row`` is a hash of it).  Empty tables give no hits
    or no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    windows = materialize(item_windows(benchmark, item_col, item_text_col, window))
    size = windows.agg(F.sum(F.octet_length("win") + 64)).first()[0] or 0
    found = _matched_where_read(docs, windows.collect()) if size <= broadcast_bytes else _matched_by_joins(docs, windows)
    return found.select("doc_id", "row", "n_words", covered(F.col("spans")).alias("n_hit"), "item_ids", "spans",
                        (F.size("spans") > 0).alias("contaminated"))
