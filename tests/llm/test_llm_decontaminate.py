import re

import pytest
from pyspark.sql import functions as F

from fraudlens.llm.decontaminate import WORD, find_contamination, split_words


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    out = {}
    wins = []
    for item, t in items:
        w = words(t)
        wins += [(item, w[i:i + window]) for i in range(max(1, len(w) - window + 1))] if w else []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if w[s:s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    ids |= {str(item)} if item is not None else set()
        out[i] = (len(w), len(hit), sorted(ids), bool(hit))
    return out


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_matches_brute_force_on_both_paths(frame, vocabulary, bound):
    v = vocabulary
    items = [(1, " ".join(v[:25])), (2, "Ab CD,ef"), (3, ""), (4, None), (10, " ".join(v[:25])), (None, "zz yy xx"),
             (5, " ".join(["rep"] * 14)), (6, "É ü " + " ".join(v[30:36]))]
    docs = [(1, "x " + " ".join(v[3:18]) + "! y"), (2, "ab-cd.EF ab cd ef"), (3, None), (4, ""), (5, "zz yy xx"),
            (6, " ".join(["rep"] * 30)), (7, " ".join(v[:9])), (8, "é ü " + " ".join(v[30:36])), (9, "É ü " + " ".join(v[30:36]).upper()),
            (10, " ".join(v * 40)), (11, ",;-"), (11, "other cd ef ab cd ef"), (12, "ab cd ef"), (12, "ab cd ef")]
    got = find_contamination(frame(docs), frame(items, id_col="item_id"), broadcast_bytes=bound).collect()
    for i in {i for i, _ in docs} - {11}:
        mine = {(r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in got if r["doc_id"] == i}
        n, hit, ids, bad = brute([d for d in docs if d[0] == i], items)[i]
        assert mine == {(n, hit, tuple(ids), bad)}, i
    assert sorted((r["n_words"], r["n_hit"]) for r in got if r["doc_id"] == 11) == [(0, 0), (6, 3)]
    assert len(got) == len(docs)


def test_empty_tables(frame):
    some = frame([(1, "ab cd")])
    assert find_contamination(frame([]), frame([(1, "ab")], id_col="item_id")).collect() == []
    (r,) = find_contamination(some, frame([], id_col="item_id")).collect()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (2, 0, False)


def test_both_word_patterns_agree(spark):
    text = "".join(map(chr, range(1, 0x250))) + " A1é-B　中文\U0001f600x"
    (r,) = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(WORD), 0).alias("w")).collect()
    assert [w.encode().lower() for w in r["w"]] == split_words(text.encode())
