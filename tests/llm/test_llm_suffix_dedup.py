import random

import numpy as np
import pytest

from fraudlens.llm import suffix_dedup
from fraudlens.llm.suffix_dedup import LENGTH, remove_repeats


def brute(rows):
    """Every 50-byte string of every document against the smallest id that holds it."""
    least = {}
    for i, text in rows:
        data = (text or "").encode()
        for x in range(len(data) - LENGTH + 1) if i is not None else ():
            s = data[x:x + LENGTH]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for x in range(len(data) - LENGTH + 1) if i is not None else ():
            if least[data[x:x + LENGTH]] < i:
                gone[x:x + LENGTH] = b"\1" * LENGTH
        edges = [k for k, (a, b) in enumerate(zip([0, *gone], [*gone, 0])) if a != b]
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), list(zip(edges[::2], edges[1::2])), kept))
    return sorted(out, key=str)


def check(frame, rows):
    got = remove_repeats(frame(rows)).collect()
    assert all(r["n_spans"] == len(r["spans"]) for r in got)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got), key=str) == brute(rows)


def corpus(vocabulary, n, seed=1):
    """Documents that copy passages of each other, cut at any byte, with small edits."""
    r, texts = random.Random(seed), []
    for _ in range(n):
        text = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))
        for _ in range(r.randint(0, 3)):
            if texts:
                other = r.choice(texts)
                a = r.randint(0, len(other))
                text = text[:len(text) // 2] + other[a:a + r.choice([30, 49, 50, 51, 90, 400])] + text[len(text) // 2:]
        if texts and r.random() < 0.2:
            text = r.choice(texts)
            for _ in range(r.randint(0, 2)):
                k = r.randint(0, len(text))
                text = text[:k] + "é" + text[k + 1:]
        texts.append(text)
    ids = r.sample(range(1000), n)
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed, row_classes", [(1, 64), (2, 64), (3, 1), (4, 3)])
def test_equals_brute_force(frame, vocabulary, monkeypatch, seed, row_classes):
    monkeypatch.setattr(suffix_dedup, "ROW_CLASSES", row_classes)
    check(frame, corpus(vocabulary, 60, seed))


def test_periodic_and_exact_lengths(frame):
    r = random.Random(4)
    fifty = "".join(r.choice("abcdef") for _ in range(50))
    rows = [(1, "a" * 300), (2, "a" * 49), (3, "b" + "a" * 50 + "b"), (4, "ab" * 100), (5, "ba" * 30), (6, fifty), (7, "x" + fifty + "y"),
            (8, fifty[:-1]), (9, fifty + fifty), (10, "é" * 40), (11, "xé" * 10 + "é" * 25), (12, "0123456789" * 12), (13, "3456789012" * 7)]
    check(frame, rows)


def test_nulls_empty_repeated_rows_and_ids(frame, vocabulary):
    long = " ".join(vocabulary[:40])
    rows = [(1, None), (2, ""), (5, long), (5, long), (5, long[:80] + "!" + long), (4, long[30:120]), (None, long), (7, long), (7, long), (None, None)]
    check(frame, rows)


def test_a_long_text_comes_in_parts(frame, vocabulary, monkeypatch):
    r = random.Random(9)
    long = " ".join(r.choice(vocabulary) for _ in range(90_000))
    assert len(long) > suffix_dedup.CHUNK
    a = suffix_dedup.CHUNK - 30
    rows = [(1, long), (2, "start " + long[a:a + 70] + " end"), (3, long), (4, long[:1000] + "X" + long[1000:3000])]
    got = {r["doc_id"]: r for r in remove_repeats(frame(rows)).collect()}
    assert (got[1]["n_removed"], got[3]["n_removed"], got[3]["n_spans"]) == (0, len(long), 1)
    assert [tuple(s) for s in got[2]["spans"]] == [(6, 76)]
    assert bytes(got[4]["kept"]).decode() == "X"


def test_a_group_of_copies_is_one_class(spark, frame, vocabulary):
    text = " ".join(vocabulary[:200])
    rows = suffix_dedup._rows(frame([(i, text) for i in range(300)]), "doc_id", "text")
    tuples = suffix_dedup.suffix_tuples(rows, suffix_dedup.shared_anchors(rows))
    assert tuples.select("h", "r").distinct().count() == tuples.count() / 300


def test_empty_table(frame):
    assert remove_repeats(frame([])).collect() == []


def test_every_window_has_an_anchor_that_its_bytes_decide(vocabulary):
    r = random.Random(2)
    text = np.frombuffer(" ".join(r.choice(vocabulary) for _ in range(500)).encode(), np.uint8)
    whole = {}
    for data in (text, text[137:]):
        first, count, gram, _, window = suffix_dedup.anchors(data, np.ones(len(data) - LENGTH + 1, bool))
        assert count.max() <= suffix_dedup.PLACES and count.sum() == len(data) - LENGTH + 1
        for x, m, h in zip(first, count, gram):
            for w in window[x:x + m].tolist():
                assert whole.setdefault(w, h) == h
