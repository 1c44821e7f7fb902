import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from fraudlens.llm import filter_audit
from fraudlens.llm.filter_audit import FILTERS, MEASURES, audit


def fails(rows):
    """The set of failed filters of each row (id, text, part), read independently."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {f for f, yes in (("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
                                ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
                                ("E", i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows))) if yes}
        out.append(bad)
    return out


def brute(rows, good, toxic):
    bad, out = fails(rows), {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, b) for (i, _, p), b in zip(rows, bad) if (p or "") == part]
        lost = dict.fromkeys(FILTERS, 0)
        for order in map("".join, itertools.permutations(FILTERS)):
            left = mine
            for k, f in enumerate(order):
                gone, before = [x for x in left if f in x[1]], [x for x in mine if x not in left]
                left = [x for x in left if f not in x[1]]
                out[part, order, k + 1] = [
                    len(left), len(gone), sum(f in x[1] and bool(x[1] & set(order[:k])) for x in mine), sum(x[1] == {f} for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), f]
                lost[f] += len(gone)
        for key, row in out.items():
            if key[0] == part:
                row[-1] = lost[row[-1]]
    return out


def result(spark, rows, labels=()):
    docs = spark.createDataFrame([(i, t, p, "x", 1) for i, t, p in rows], "doc_id long, text string, source string, part string, n int")
    marks = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    got = audit(docs.repartition(3), marks.withColumn("part", F.lit(1))).collect()
    return {(r["part"], r["filter_order"], r["step"]): [r[m] for m in MEASURES] for r in got}


def texts(vocabulary, n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.choice([10, 49, 50, 51, 80]))]
        if r.random() < 0.3:
            words = words[:5] * (len(words) // 5)
        if r.random() < 0.3:
            words = [w.upper() for w in words]
        text = r.choice([" ", "\n", "\t", "\x0b"]).join(words) + (r.choice("#$%&*|") if r.random() < 0.3 else "")
        rows.append((i, text, r.choice(["a", "b", None, ""])))
    return rows + [(n + k, r.choice(rows)[1], "a") for k in range(n // 2)]


def test_equals_brute_force(spark, frame, vocabulary):
    rows = texts(vocabulary, 40)
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 60, 2)]
    good, toxic = {i for i, q, _ in labels if q}, {i for i, _, t in labels if t}
    assert result(spark, rows, labels) == brute(rows, good, toxic)


def test_nulls_empty_long_and_repeated(spark, frame):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, None), (2, "", ""), (3, long, "p"), (4, long, "p"), (4, long, "p"), (None, long, "p"), (5, "a\xa0b \x1c c", "p"),
            (6, " \n ", "q"), (3, long, "q")]
    labels = [(4, 1, None), (4, 0, 1), (None, 1, 1), (3, None, 0)]
    assert result(spark, rows, labels) == brute(rows, {4}, {4})


def test_empty_tables(spark, frame):
    assert result(spark, []) == {}


def test_words_part_at_ascii_space_only():
    text = "\x1c".join(["a"] * 49) + " b\x85c d"
    assert filter_audit.failures(text) == 1            # two words
    assert filter_audit.failures("é" * 20 + " A") == 1  # code points, not bytes: 1 capital of 22 is under 5 per cent
    assert filter_audit.failures("é" * 17 + " A") == 5


def test_selectors_take_pass_fail_or_all():
    one = np.zeros((1, 2, 2, 2, 2, 2), np.int64)
    one[0, 1, 0, 1, 0, 0] = 7                            # fails A and C
    got = filter_audit.measures(one, one, one)
    for (order, _, axis), removed in zip(filter_audit.steps(), got["removed"][0]):
        first = min("AC", key=order.index)
        assert removed == (7 if FILTERS[axis] == first else 0)
    assert not got["unique_fails"].any()
