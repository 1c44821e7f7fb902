r"""Line dedup: exact set-similarity join of lines, removing those that an earlier line matches.

A line is the set of its lower-cased words.  A line goes when any earlier line
(by doc_id, then line number) has a Jaccard similarity of ``per_cent`` / 100 or more
with it; the earlier line need not itself stay.

1. Lines with equal text form a class; its first line represents it, all others go.
2. A cheap round settles near copies: lines that agree on a few words at fixed places
   are compared with the earliest of them.  A line that matches is settled: it goes.
3. Words are ordered by rarity: a count over all distinct lines in ``COUNTERS`` hashed counters, a
   table of fixed size, then by hash.  The first n - ceil(t n) + 1 words are the prefix.
4. Lines are joined on prefix words, but for pairs of two settled lines, under the
   length filter, the positional filter and a bound on the overlap from bit signatures
   of the sets, none of which loses a match.  Of a pair the smaller set needs a shorter prefix.
5. Candidates are verified on the words themselves.  No hash decides a match.

DataFrame functions only.  The distinct lines are written once; every later step reads them, so documents are
read twice: here and when lines are removed.  The shuffle files of a step go when its table is written.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import bounded, discard, staged
from fraudlens.llm.setjoin import open_pairs, overlap_fits, sizes_fit

PER_CENT = 75
COUNTERS = 1 << 17
RANKS_A_DOUBLING = 2.5     # of the count: 63 stands for 2^25 lines and more
HASH_BITS = 57             # of a word's hash, below the 6 bits of its rarity: 63 bits name a word in the filters
LINE = ["doc_id", "row", "line_no"]
SPACES = "\t\r\x0b\x0c"    # white space inside a line, beside the blank
WORDED = r"[^ \t\r\x0b\x0c]"


def words_of(line: Column) -> Column:
    """All words of a line in order; white space other than line breaks parts them."""
    low = F.lower(line)
    other = reduce(Column.__or__, [F.contains(low, F.lit(c)) for c in SPACES])
    return F.array_remove(F.split(F.when(other, F.translate(low, SPACES, "    ")).otherwise(low), " "), "")


def distinct_lines(rows: DataFrame) -> DataFrame:
    """(id, LINE, line): each text of a line with words once, at its first place."""
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    first = lines.groupBy("line").agg(F.min(F.struct(*LINE)).alias("at")).where(F.col("line").rlike(WORDED))
    return staged(first.select("at.*", "line").withColumn("id", F.monotonically_increasing_id()), "lines", "zstd")


def rarity(lines: DataFrame) -> list[int]:
    """A rank from 0 (rare) to 63 for each of COUNTERS hash classes: the logarithm of how often their words occur in all lines."""
    # parted at blanks only: other white space makes an odd word here, which changes the order of rare words and no result
    at = lines.select(F.explode(F.split(F.lower("line"), " ")).alias("w")).select(_counter(F.xxhash64("w")).alias("at"))
    counts = at.groupBy("at").agg(F.count(F.lit(1)).alias("n")).select(
        "at", F.least(F.lit(63), (F.log2("n") * RANKS_A_DOUBLING).cast("int")).alias("rank")).toArrow()
    ranks = np.zeros(COUNTERS, np.int64)
    ranks[counts["at"].to_numpy()] = counts["rank"].to_numpy()  # one row a counter: COUNTERS fixes their number
    return ranks.tolist()


def _counter(h: Column) -> Column:
    return h.bitwiseAND(F.lit(COUNTERS - 1))


def line_sets(lines: DataFrame, ranks: list[int], per_cent: int) -> DataFrame:
    """id, LINE, n, k1, k2 (parities of the set's members by place), prefix and keys (of near_pairs) of each line."""
    # a constant: the optimizer parses it once, and a lookup is an array access; small numbers stay in the cache
    table = F.from_json(F.lit(str(ranks)), "array<tinyint>")

    def placed(h: Column) -> Column:
        return F.call_function("shiftleft", table[_counter(h)].cast("bigint"), F.lit(HASH_BITS)).bitwiseOR(F.shiftrightunsigned(h, 64 - HASH_BITS))

    def signature(half: int) -> Column:
        def add(acc: Column, h: Column) -> Column:
            one = (F.bitwise_not(h) if half else h).bitwiseAND(F.lit(1).cast("bigint"))
            return acc.bitwiseXOR(F.call_function("shiftleft", one, F.shiftright(h, 1).bitwiseAND(F.lit(63)).cast("int")))
        return F.aggregate("ordered", F.lit(0).cast("bigint"), add)

    read = _hashed(lines).select("id", *LINE, _near_keys().alias("keys"), F.sort_array(F.transform("hashes", placed)).alias("every"))
    # equal words stand side by side; a set of their own for each line would cost several times as much
    read = read.select("*", F.filter("every", lambda h, i: (i == 0) | (h != F.get("every", i - 1))).alias("ordered"))
    read = read.select("*", F.size("ordered").alias("n"))
    prefix = F.col("n") - F.ceil(F.col("n") * per_cent / 100).cast("int") + 1
    return read.select("id", *LINE, "n", signature(0).alias("k1"), signature(1).alias("k2"),
                       F.slice("ordered", F.lit(1), prefix).alias("prefix"), "keys")


def _hashed(lines: DataFrame) -> DataFrame:
    """id, LINE, hashes of all words in order, and their number."""
    # words are read twice, so that they are a column of their own and not parted again inside the lambda
    words = lines.select("id", *LINE, words_of(F.col("line")).alias("words")).select("*", F.size("words").alias("length"))
    return words.select("id", *LINE, "length", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))


def _near_keys() -> Column:
    """Hashes of the four words at the start, end and middle of a line."""
    length = F.col("length")

    def key(start: Column, salt: int) -> Column:
        return F.xxhash64(F.lit(salt), F.slice("hashes", start, F.lit(4)))

    return F.array(key(F.lit(1), 1), key(F.greatest(length - 3, F.lit(1)), 2),
                   key(F.greatest((length / 2).cast("int") - 1, F.lit(1)), 3))


def _may_match(a, b, per_cent: int) -> Column:
    """The bound on the overlap: behind each differing bit is a word that only one of the sets has."""
    differ = F.bit_count(a["k1"].bitwiseXOR(b["k1"])) + F.bit_count(a["k2"].bitwiseXOR(b["k2"]))
    return overlap_fits((a["n"] + b["n"] - differ) / 2, a["n"], b["n"], per_cent)


def near_pairs(lines: DataFrame) -> DataFrame:
    """(x, y): each line with the earliest line of a group that agrees on four words at its start, end or middle."""
    keys = lines if "keys" in lines.columns else _hashed(lines).select("id", *LINE, _near_keys().alias("keys"))
    keyed = keys.select("id", F.struct(*LINE, "id").alias("here"), F.explode("keys").alias("key"))
    first = (keyed.groupBy("key").agg(F.min("here").alias("first"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("key", F.col("first.id").alias("y")))
    return keyed.select(F.col("id").alias("x"), "key").join(first, "key").where("x <> y").select("x", "y").distinct()


def possible(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (x, y) that sizes and signatures leave within reach: no match is lost, and few others are verified."""
    a, b = (sets.select(F.col("id").alias(v), F.struct("n", "k1", "k2").alias(f"set_{v}")) for v in "xy")
    left, right = F.col("set_x"), F.col("set_y")
    return (pairs.join(a, "x").join(b, "y")
            .where(sizes_fit(left["n"], right["n"], per_cent) & _may_match(left, right, per_cent)).select("x", "y"))


def matched(pairs: DataFrame, lines: DataFrame, per_cent: int, passes: int = 2) -> DataFrame:
    """(id) of the later line of every staged pair (x, y) whose word sets reach the similarity; the pairs are used up.

    Each pass verifies a share of the pairs, so that only a share of the words lies in shuffle files at a time.
    """
    wanted = staged(pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct(), "line-wanted")
    words = staged(lines.join(bounded(wanted), "id").select(
        "id", F.struct(*LINE).alias("at"), F.array_distinct(words_of(F.col("line"))).alias("w")), "line-words", "zstd")
    a, b = (words.select(F.col("id").alias(v), F.col("at").alias(f"at_{v}"), F.col("w").alias(f"w_{v}")) for v in "xy")
    shared = F.size(F.array_intersect("w_x", "w_y"))
    later = F.when(F.col("at_x") > F.col("at_y"), F.col("x")).otherwise(F.col("y"))
    fits = overlap_fits(shared, F.size("w_x"), F.size("w_y"), per_cent)

    def verified(turn: int) -> DataFrame:
        mine, here = (df.where(F.pmod("x", F.lit(passes)) == turn) for df in (pairs, a))
        return staged(mine.join(here, "x").join(b, "y").where(fits).select(later.alias("id")).distinct(), "line-verified")

    found = [verified(turn) for turn in range(passes)]
    gone = staged(reduce(DataFrame.unionByName, found).distinct(), "line-matched")
    discard(wanted, words, pairs, *found)
    return gone


def kept_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = PER_CENT) -> DataFrame:
    """(doc_id, row, line_nos): the lines with words that each document keeps, counted from 0; documents that keep none are left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # rows that repeat an id and its text are one document and keep the same lines
    lines = distinct_lines(documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text")))
    sets_of = staged(line_sets(lines, rarity(lines), per_cent), "line-sets")
    near = staged(near_pairs(sets_of), "line-near")
    settled = matched(staged(possible(near, sets_of, per_cent), "line-possible"), lines, per_cent)
    discard(near)
    sets = sets_of.drop(*LINE, "keys").join(bounded(settled.withColumn("gone", F.lit(True))), "id", "left").withColumn("open", F.col("gone").isNull()).drop("gone")
    pairs = staged(open_pairs(sets, per_cent, lambda a, b: _may_match(a, b, per_cent)), "line-windows")
    discard(sets_of)
    gone = bounded(staged(settled.unionByName(matched(pairs, lines, per_cent)).distinct(), "line-gone"))
    return (lines.select("id", *LINE).join(gone, "id", "left_anti")
            .groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("line_no")).alias("line_nos")))


def dedup_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                per_cent: int = PER_CENT) -> DataFrame:
    """All columns of ``documents`` with ``text_col`` cleaned, plus ``_n_lines`` and ``_removed`` (line numbers from 0).

    Every input row gives a row.  Lines without words (blank ones included)
    are kept and match nothing.  A NULL text stays NULL; an empty one is one blank line.  Texts of any length are read
    whole, in time that grows with their lines and words.  Rows that
    repeat an id and its text are one document and share its result; rows
    that share an id with other texts are separate, in the order of a hash of their text.
    NULL ids come first.  Input columns with the names of the added ones are replaced.  A document all of whose lines go keeps an empty text.
    """
    documents = documents.drop("_n_lines", "_removed", "_doc_id", "_row", "_lines", "_kept")
    kept = staged(kept_lines(documents, id_col, text_col, per_cent).select(
        F.col("doc_id").alias("_doc_id"), F.col("row").alias("_row"), F.col("line_nos").alias("_kept")), "line-kept")
    size = kept.agg(F.sum(F.size("_kept") * 4 + 48)).first()[0] or 0
    small = F.broadcast(kept) if size <= 64 << 20 else kept
    text = F.coalesce(documents[text_col], F.lit(""))
    # lines are split below the join: above it an expression inside a lambda would split the text once for every line
    split = documents.select("*", F.split(text, "\n", -1).alias("_lines"), F.xxhash64(text).alias("_text"))
    same = split[id_col].eqNullSafe(small["_doc_id"]) & (split["_text"] == small["_row"])
    found = split.join(small, same, "left")
    worded = F.filter(F.transform("_lines", lambda l, i: F.when(l.rlike(WORDED), i)), lambda i: i.isNotNull())
    none = F.array().cast("array<int>")
    found = found.withColumn("_removed", F.array_except(worded, F.coalesce("_kept", none)))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_removed"))
    cleaned = F.when(F.size("_removed") == 0, F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n"))
    columns = [cleaned.alias(c) if c == text_col else F.col(c) for c in documents.columns]
    return found.select(*columns, F.size("_lines").alias("_n_lines"), "_removed")
