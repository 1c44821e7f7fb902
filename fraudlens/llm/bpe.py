"""Byte-level BPE: encode by a priority queue over a linked symbol list, decode by concatenation.

The vocabulary file is read once on the driver and broadcast as bytes (its size
is fixed by the tokenizer, not by the data).  Texts are split into words by the
byte-level pattern; each word's bytes form a doubly linked list, pairs with a
merge rank enter a heap, and the lowest rank, leftmost first, is merged until the
heap is empty; entries whose pair has changed meanwhile are skipped.  Words of up to
``CACHE_WORD`` bytes are remembered, in a table that is emptied when full.
"""

from __future__ import annotations

import heapq
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Fixed value: the word pattern of byte-level BPE tokenizers.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHE_ROOM, CACHE_WORD = 200_000, 64
OUT_BYTES = 8 << 20          # output batches are cut at about this size
ENCODED = "doc_id bigint, n_tokens bigint, ids binary"
DECODED = ENCODED + ", decoded string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself where printable, else from U+0100 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A byte-level BPE vocabulary, read from the JSON of a tokenizer file."""

    def __init__(self, spec: bytes):
        data = json.loads(spec)
        vocab, letters = data["model"]["vocab"], byte_letters()
        for t in data.get("added_tokens", []):
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"added token {t['content']!r}: only plain ones are supported")
        added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.symbol = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.strings = {i: bytes(letters[c] for c in s) for s, i in vocab.items() if s not in added}
        self.strings |= {i: s.encode() for s, i in added.items()}
        self.added = {s: struct.pack("<I", i) for s, i in added.items()}
        longest_first = sorted(map(regex.escape, added), key=len, reverse=True)
        self.specials = regex.compile(f"({'|'.join(longest_first)})") if added else None
        self.words = regex.compile(WORDS)
        self.cache: dict[str, bytes] = {}

    def word(self, data: bytes) -> list[int]:
        """Ids of one word."""
        ids, n, merges = [self.symbol[b] for b in data], len(data), self.merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0:
                continue
            now = merges.get((ids[i], ids[j]))
            if now is None or now[0] != rank:
                continue  # this pair has been merged or changed since it was queued
            ids[i], ids[j], k = now[1], -1, after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                if (right := merges.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (right[0], i))
            h = before[i]
            if h >= 0 and (left := merges.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (left[0], h))
        return [i for i in ids if i >= 0]

    def _packed(self, word: str) -> bytes:
        got = self.cache.get(word)
        if got is None:
            data = word.encode()
            ids = self.word(data)
            got = struct.pack(f"<{len(ids)}I", *ids)
            if len(data) <= CACHE_WORD:
                if len(self.cache) >= CACHE_ROOM:
                    self.cache.clear()
                self.cache[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; strings of added tokens become these tokens."""
        pieces = self.specials.split(text) if self.specials else [text]
        out = []
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(self.added[piece])
            else:
                out.extend(map(self._packed, self.words.findall(piece)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_LOADED: dict[int, Bpe] = {}  # the vocabularies that this Python worker has built, by a checksum of the file


def _loaded(spec) -> Bpe:
    key = zlib.crc32(spec.value)
    if key not in _LOADED:
        _LOADED[key] = Bpe(spec.value)
    return _LOADED[key]


def _batches(rows, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (size in bytes, values) as batches of about OUT_BYTES."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n + 64
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def tokenizer_spec(spark, path: str):
    """Broadcast of a tokenizer's JSON file, read on the driver."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, spec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers).

    NULL counts as empty; an empty text has no tokens.  Rows are independent:
    repeated rows and repeated ids give a row each, an empty table an empty
    result.  Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        bpe = _loaded(spec)

        def rows():
            for b in batches:
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = bpe.encode(text.as_py() or "")
                    yield len(ids), (doc_id, len(ids) // 4, ids)

        yield from _batches(rows(), schema)

    return docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) doc_id", f"`{text_col}` text").mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, spec) -> DataFrame:
    """Adds ``decoded``: the vocabulary strings of ``ids``, concatenated; NULL ids decode to the empty string."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches):
        bpe = _loaded(spec)

        def rows():
            for b in batches:
                for doc_id, n, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    ids = ids.as_py()
                    text = bpe.decode(ids or b"")
                    yield 5 * len(text) + len(ids or b""), (doc_id, n, ids, text)

        yield from _batches(rows(), schema)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, DECODED)
