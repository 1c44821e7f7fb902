import os

import numpy as np

from fraudlens.llm import quality
from fraudlens.llm.common import importable, table


def test_held_out_accuracy(spark):
    """No label is used in fitting, so all of them are held out."""
    importable(spark)
    sf = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")
    judged = quality.classify(table(spark, sf, "documents")).select("doc_id", "_keep")
    rows = judged.join(table(spark, sf, "labels"), "doc_id").collect()
    fine = [r["_keep"] for r in rows if r["quality"] == 1]
    junk = [r["_keep"] for r in rows if r["quality"] == 0]
    assert np.mean(fine) > 0.99 and np.mean(junk) < 0.05


def test_label_model_finds_the_accurate_labellers():
    r = np.random.default_rng(0)
    truth = r.random(4000) < 0.2
    votes = {}
    for t in truth:
        v = "".join("-" if r.random() < 0.1 else str(int(t if r.random() < acc else not t)) for acc in (0.95, 0.9, 0.9, 0.6))
        votes[v] = votes.get(v, 0) + 1
    post = quality.label_model(votes)
    assert post["1110"] > 0.9 > 0.1 > post["0001"]
    assert quality.label_model({}) == {}


def test_votes_and_features():
    assert quality.Votes.of("") == "-" * len(quality.Votes.BOUNDS)
    assert "1" not in quality.Votes.of("The plain text of a page, with some words.")
    assert "1" in quality.Votes.of("a | b | c | d | e | f") and "1" in quality.Votes.of("so so so so so so now now now now")
    at, value = quality.features("Ab cd 12")
    assert len(at) == len(set(at.tolist())) == len(value) and (at < quality.DIMENSIONS).all()


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "Plain words in a row."), (5, "x" * 100_000), (5, "x" * 100_000), (6, "word " * 30_000)]
    got = quality.classify(frame(rows)).collect()
    assert len(got) == len(rows)
    assert [(r["_keep"], r["_score"]) for r in got if r["doc_id"] in (1, 2, 3)] == [(False, 0.0)] * 3
    assert len({r["_score"] for r in got if r["doc_id"] == 5}) == 1
    assert {"id", "row", "n", "_removed"} <= set(got[0].asDict())
    assert quality.classify(frame([])).collect() == []


def test_scores_do_not_depend_on_partitions_or_repeated_rows(frame, vocabulary):
    r = np.random.default_rng(3)
    rows = [(None if i % 3 == 0 else i, " ".join(r.choice(vocabulary, 20 + i % 30)) + (" ||| ###" if i % 5 == 0 else "")) for i in range(200)]
    rows += [(7, "one text many times over and over again")] * 300

    def scores(n, sample):
        got = quality.classify(frame(rows).repartition(n), sample=sample).select("doc_id", "text", "_score").collect()
        return sorted(((x["doc_id"], x["text"], x["_score"]) for x in got), key=str)

    assert scores(3, 80) == scores(7, 80) != scores(3, 150)
