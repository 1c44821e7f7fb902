import hashlib

from fraudlens.llm.exact_dedup import exact_groups


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def check(frame, rows, **kw):
    got = exact_groups(frame(rows), **kw).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_copies_prefixes_nulls_and_long_texts(frame):
    long = "ab" * 40_000
    rows = [(1, "a"), (2, "a"), (3, "ab"), (4, ""), (5, None), (6, long), (7, long), (8, long + "x"), (9, long[:-1]),
            (10, "x" * 64), (11, "x" * 64), (12, "x" * 65), (13, "x" * 576), (14, "x" * 576), (15, "é" * 32), (16, "é" * 32),
            (17, "a\x00"), (18, "a"), (None, "only"), (None, "ab")]
    check(frame, rows)


def test_runs_of_any_width_give_the_same_groups(frame, vocabulary):
    rows = [(i, " ".join(vocabulary[(i * k) % 7] for k in range(i % 5))) for i in range(60)]
    for width, growth in ((1, 2), (2, 3), (64, 8)):
        check(frame, rows, first_width=width, growth=growth)


def test_repeated_rows_and_ids(frame):
    check(frame, [(1, "a"), (1, "a"), (1, "b"), (2, "b")])


def test_empty_table(frame):
    assert exact_groups(frame([])).collect() == []
