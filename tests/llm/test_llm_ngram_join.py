import random
import re

import numpy as np

from fraudlens.llm.ngram_join import may_match, near_components, shingles, signature
from fraudlens.llm.setjoin import components


def shingle_set(t, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, per_cent=75):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def result(df, **kw):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_components(df, **kw).collect())


def test_matches_brute_force(frame, vocabulary):
    r = random.Random(5)
    passage = " ".join(r.choice(vocabulary) for _ in range(50))
    rows = []
    for i in range(40):
        w = [r.choice(vocabulary) for _ in range(r.randint(1, 120))]
        text = " ".join(w) + (" " + passage if i % 3 == 0 else "")
        rows.append((len(rows), text))
        for _ in range(r.randint(0, 4)):                       # chains of copies, each changed a little
            words = text.split()
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            text = r.choice([" ", "\n", " \t "]).join(words)
            rows.append((len(rows), text.upper() if r.random() < 0.1 else text))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "a b c"), (906, "é x"), (907, "É x"),
             (908, "long " * 20_000), (909, "long " * 15_000), (910, " x")]
    rows = [(1000 - i, t) for i, t in rows]                    # order of ids and of rows differ
    for per_cent in (75, 50):
        assert result(frame(rows), per_cent=per_cent) == brute(rows, per_cent)


def test_a_large_group_and_bridges_between_groups(frame, vocabulary):
    base = vocabulary[:60]
    rows = [(i, " ".join(base[:i % 50] + [f"v{i}"] + base[i % 50:])) for i in range(150)]
    rows += [(200 + k, " ".join(base[k:] + [f"t{j}" for j in range(k)])) for k in range(0, 60, 3)]   # each near the next
    assert result(frame(rows)) == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(frame):
    got = sorted(((r["doc_id"], r["component_id"]) for r in near_components(
        frame([(2, "a b c"), (2, "a b c"), (1, "a b c"), (None, "a b c"), (None, "alone"), (5, "z")])).collect()), key=str)
    assert got == sorted([(2, 1), (2, 1), (1, 1), (None, 1), (None, None), (5, 5)], key=str)
    assert near_components(frame([])).collect() == []


def test_shingle_hashes_follow_word_boundaries():
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a b")) == 1 and len(shingles(" \n")) == 0
    assert np.array_equal(shingles("A B\tc\nd e"), shingles("a b c d e"))
    assert not np.array_equal(shingles("ab c d e f"), shingles("a bc d e f"))
    assert not np.array_equal(shingles("É"), shingles("é"))


def test_signatures_never_rule_out_a_link():
    r = np.random.default_rng(4)
    ruled_out = 0
    for n in (1, 3, 20, 200, 3000):
        for _ in range(40):
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
            keep = a[r.random(len(a)) < r.choice([0.1, 0.7, 0.8, 0.9, 1.0])]
            b = np.unique(np.r_[keep, r.integers(0, 1 << 63, int(n * r.choice([0, 0.1, 0.3])), dtype=np.uint64)])
            if len(b):
                both = len(np.intersect1d(a, b))
                may = may_match(signature(a), signature(b), len(a), len(b), 75)
                assert may or 100 * both < 75 * (len(a) + len(b) - both)
                ruled_out += not may
    assert ruled_out > 50


def test_components_of_long_paths_and_stars(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (5, 5)]
    r.shuffle(edges)
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []
