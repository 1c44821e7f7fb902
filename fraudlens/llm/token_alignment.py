r"""Cross-tokenizer alignment: two tokenizers' tokens of one text, cut into groups where both end.

1. One pass encodes each document with both tokenizers and cuts the tokens into groups at the
   byte offsets where an A and a B token end together.  The last tokens of a group are linked.
2. Identity map: an array gives for each A id the B id of the same bytes.  A group of one A
   and one B token that the array predicts needs no pair: it is counted in a vector of the length of
   A's vocabulary.  Only the links of all other groups are shuffled as pairs, summed map-side.
3. The counts of both ways give the highest count of each B id, a vector of the length of B's
   vocabulary.  Documents meet their predicted links' counts in broadcast vectors, and the
   counts of their other links in one join by pair; a frequent pair is split by the adaptive join.

Byte offsets come from the tokens themselves: A's entries decoded from the byte-level letters, B's
pieces with U+2581 as a space and <0xHH> as a byte.  Everything broadcast has a size fixed by the
two vocabularies.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm.bpe import WORDS, Bpe, byte_letters, tokenizer_spec
from fraudlens.llm.common import staged

B_BITS = 24                          # of a pair's key: the B id below, the A id above
CHUNK_BYTES, OUT_BYTES = 1 << 20, 8 << 20
SPACE = "▁"
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def entry_bytes(spec: bytes) -> list[bytes]:
    """The bytes of each A id; added tokens, which plain text never gives, have none."""
    data, letters = json.loads(spec), byte_letters()
    added = {t["content"] for t in data.get("added_tokens", [])}
    vocab = data["model"]["vocab"]
    out = [b""] * (1 + max(*vocab.values(), *(t["id"] for t in data.get("added_tokens", []))))
    for entry, i in vocab.items():
        if entry not in added:
            out[i] = bytes(letters[c] for c in entry)
    return out


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) and re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)]


def ranked(spec: bytes) -> tiktoken.Encoding:
    """A's encoder by the rank of merged bytes, which merges as the listed pairs do.

    That holds where later merges make larger ids and every entry encodes to itself: two symbols
    that together make an entry are then always the pair that is listed for it.  Checked here.
    """
    own, entries = Bpe(spec), entry_bytes(spec)
    merged = [i for _, i in own.merges.values()]
    if merged != sorted(merged) or max(own.symbol) >= min(merged, default=1 << 30):
        raise ValueError("the merges are not in the order of their ids")
    if any(own.word(e) != [i] for i, e in enumerate(entries) if e):
        raise ValueError("an entry does not encode to itself")
    return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks={e: i for i, e in enumerate(entries) if e}, special_tokens={})


class Aligner:
    """Both vocabularies, the identity map, and the cut of one text into groups."""

    def __init__(self, a_spec: bytes, b_spec: bytes, checked: bool = False):
        self.a_bytes = entry_bytes(a_spec)
        self.a = tiktoken.Encoding("a", pat_str=WORDS, special_tokens={},
                                   mergeable_ranks={e: i for i, e in enumerate(self.a_bytes) if e}) if checked else ranked(a_spec)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_spec)
        self.b_bytes = piece_bytes(self.b)
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # pieces stand after single bytes, so that of two B ids with the same bytes the piece is predicted
        at = {x: i for i, x in sorted(enumerate(self.b_bytes), key=lambda p: not self.b.is_byte(p[0])) if x}
        self.same = np.array([at.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        wide = len(str(max(len(self.a_bytes), len(self.b_bytes)))) + 1
        self.text = {(side, end): np.array([f"{i}{end}" for i in range(len(v))], f"S{wide}")
                     for side, v, ends in (("a", self.a_bytes, ",|"), ("b", self.b_bytes, ",;")) for end in ends}

    def cut(self, text: str | None, b_ids: list[int]):
        """(a ids, b ids, places of the last A and B token of each group), or None where the bytes differ."""
        whole = b" " + (text or "").encode()
        a = np.array(self.a.encode_ordinary(" " + text), np.int64)
        b = np.array(b_ids, np.int64)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole or b"".join(map(self.b_bytes.__getitem__, b_ids)) != whole:
            return None
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.searchsorted(b_end, a_end)
        a_last = np.flatnonzero(b_end[at] == a_end)
        return a, b, a_last, at[a_last]

    def written(self, a, b, a_last, b_last) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: ids of each group in order."""
        a_group = np.searchsorted(a_last, np.arange(len(a)))
        b_group = np.searchsorted(b_last, np.arange(len(b)))
        strings = self.text
        a_str, b_str = strings["a", ","][a], strings["b", ","][b]
        a_str[a_last], b_str[b_last] = strings["a", "|"][a[a_last]], strings["b", ";"][b[b_last]]
        out = np.empty(len(a) + len(b), a_str.dtype)
        out[np.arange(len(a)) + np.r_[0, b_last + 1][a_group]] = a_str
        out[np.arange(len(b)) + a_last[b_group] + 1] = b_str
        return out.tobytes().translate(None, b"\0")[:-1]

    def links(self, a, b, a_last, b_last):
        """(predicted A ids, times, other pairs, times) of a document's links."""
        x, y = a[a_last], b[b_last]
        single = (np.diff(a_last, prepend=-1) == 1) & (np.diff(b_last, prepend=-1) == 1) & (self.same[x] == y)
        same = np.unique(x[single], return_counts=True)
        other = np.unique((x[~single] << B_BITS) | y[~single], return_counts=True)
        return *same, *other


_LOADED: dict[tuple[int, int], Aligner] = {}   # what this Python worker has built, by checksums of both files


def _loaded(a_spec, b_spec) -> Aligner:
    key = zlib.crc32(a_spec.value), zlib.crc32(b_spec.value)
    if key not in _LOADED:
        _LOADED[key] = Aligner(a_spec.value, b_spec.value, checked=True)
    return _LOADED[key]


def _chunks(batches):
    """Rows (id, text) in lists of about CHUNK_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            held.append((i, text))
            size += len(text) + 64
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


_ROWS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_links", pa.int64()), ("groups", pa.binary()),
                   ("same", pa.binary()), ("pair", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def encoded(documents: DataFrame, a_spec, b_spec, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_links, groups, same, pair, times): ``same`` holds predicted A ids, then how often, as 32-bit integers."""

    def run(batches):
        aligner = _loaded(a_spec, b_spec)
        held, size = [], 0
        for chunk in _chunks(batches):
            b_ids = aligner.b.encode([t for _, t in chunk], out_type=int, num_threads=1)
            for (doc_id, text), ids in zip(chunk, b_ids):
                found = aligner.cut(text, ids) if text else None
                if found is None:
                    held.append((doc_id, 0, 0, 0, b"", b"", [], []))
                    size += 128
                    continue
                groups = hashlib.sha256(aligner.written(*found)).digest()
                x, nx, pair, times = aligner.links(*found)
                held.append((doc_id, len(found[0]), len(found[1]), len(found[2]), groups,
                             np.concatenate([x, nx]).astype("<i4").tobytes(), pair, times))
                size += 128 + 8 * len(x) + 16 * len(pair)
                if size >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ROWS)], schema=_ROWS)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ROWS)], schema=_ROWS)

    read = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_links bigint, groups binary, same binary, "
                                "pair array<bigint>, times array<bigint>")


def predicted_counts(docs: DataFrame, length: int) -> np.ndarray:
    """How often each A id is linked as predicted: a vector a task, summed over tasks."""

    def run(batches):
        seen = np.zeros(length, np.int64)
        for b in batches:
            for same in b.column(0):
                x = np.frombuffer(same.as_buffer(), "<i4")
                np.add.at(seen, x[:len(x) // 2], x[len(x) // 2:])
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["a", "n"])

    out = np.zeros(length, np.int64)
    for a, n in docs.select("same").mapInArrow(run, "a int, n bigint").groupBy("a").agg(F.sum("n")).collect():
        out[a] = n
    return out


def align(documents: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, COUNTS and ``groups_sha256``.

    ``n_best`` counts a document's links whose count over all documents is the highest of their B id, ties included;
    ``count_sum`` adds the counts of its links.  NULL and empty texts, and texts that either tokenizer changes
    (its tokens' bytes are not a space and the text), have no tokens: zeros and ''.  Strings of special tokens are
    plain text.  Texts are encoded whole, whatever their length.  Every row counts, those that repeat an id or a text
    too; a NULL id is kept.  An empty table gives an empty result.  Other columns are not read.
    """
    spark: SparkSession = documents.sparkSession
    a_spec, b_spec = tokenizer_spec(spark, a_path), tokenizer_spec(spark, b_path)
    aligner = Aligner(a_spec.value, b_spec.value)
    docs = staged(encoded(documents, a_spec, b_spec, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")

    predicted = predicted_counts(docs, len(aligner.a_bytes))
    uses = docs.select("row", F.explode(F.arrays_zip("pair", "times")).alias("u")).select("row", "u.pair", "u.times")
    pairs = staged(uses.groupBy("pair").agg(F.sum("times").alias("n")), "aligned-pairs")
    highest = np.zeros(len(aligner.b_bytes), np.int64)
    b_id = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    for b, n in pairs.groupBy(b_id).agg(F.max("n")).collect():          # at most a row for each B id
        highest[b] = n
    known = aligner.same >= 0
    np.maximum.at(highest, aligner.same[known], predicted[known])

    vectors = spark.sparkContext.broadcast((predicted, known & (predicted == highest[aligner.same])))
    tops = spark.createDataFrame(pa.table({"b": np.flatnonzero(highest), "top": highest[np.flatnonzero(highest)]}))
    best = pairs.join(F.broadcast(tops), b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    other = (uses.join(best, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("n")).alias("total")))

    def run(batches):
        count, is_best = vectors.value
        for b in batches:
            n_best, total = [], []
            for same in b.column(1):
                x = np.frombuffer(same.as_buffer(), "<i4").astype(np.int64)
                x, n = x[:len(x) // 2], x[len(x) // 2:]
                n_best.append(int(n[is_best[x]].sum()))
                total.append(int((n * count[x]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:1], *b.columns[2:], pa.array(n_best, pa.int64()), pa.array(total, pa.int64())],
                                             names=["row", *b.schema.names[2:], "same_best", "same_total"])

    rows = docs.select("row", "same", "doc_id", "n_a", "n_b", "n_links", "groups").mapInArrow(
        run, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_links bigint, groups binary, same_best bigint, same_total bigint")
    zero = F.lit(0).cast("bigint")
    return rows.join(other, "row", "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        (F.col("same_best") + F.coalesce("best", zero)).alias("n_best"), (F.col("same_total") + F.coalesce("total", zero)).alias("count_sum"),
        F.lower(F.hex("groups")).alias("groups_sha256"))
