import random
import struct

import public_tokenizers
import pytest
from test_llm_decontaminate import brute as hits_of
from test_llm_line_dedup import brute as cleaned_of
from test_llm_ngram_join import brute as components_of
from tokenizers import Tokenizer

import corpus_pipeline
from fraudlens.llm.common import importable

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    """Documents with junk, repeated lines, near copies, a leaked item, insults, NULLs and repeated rows."""
    importable(spark)
    r = random.Random(9)
    words = ["".join(r.choice("aeioutrnsl") for _ in range(r.randint(2, 7))) for _ in range(500)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n)).capitalize() + "."

    notice = "All rights reserved by the owner of this page."
    item = prose(30)
    texts = {i: "\n".join([prose(r.randint(20, 60)) for _ in range(3)] + ([notice] if i % 4 == 0 else [])) for i in range(60)}
    copied = texts[3].replace("\n", " ")
    texts[60] = copied                                                        # one line: near 3, but no line repeats
    texts[61] = texts[5]                                                      # every line repeats: nothing is left
    texts[62] = prose(25) + " " + item + " " + prose(25)
    texts[63] = " | ".join(words[:80])
    texts[64] = " ".join(w.upper() + "!!" for w in words[80:160])
    texts[65] = " ".join(w for w in words[160:175] for _ in range(12))
    texts[66] = " ".join(w + "###" for w in words[175:260])
    texts[67], texts[68], texts[69] = None, "", prose(40) + " you idiot and moron " + prose(20)
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in texts.items()]
    rows.append(rows[7])                                                      # a repeated row
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, texts, item


def test_each_stage_matches_brute_force_on_its_own_input(spark, corpus):
    sf, texts, item = corpus
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = stages["quality_classifier"](spark, docs, sf)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted([*(set(range(63)) | {69}), 7])                       # junk, NULL and empty go, the rest stays

    lines = stages["line_dedup"](spark, kept, sf)
    assert lines.columns == docs.columns
    want = cleaned_of(sorted((i, texts[i]) for i in set(ids)))
    got = lines.collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: t for i, t in want.items() if t.strip()}
    assert 61 not in {r["doc_id"] for r in got} and all(r["n_chars"] == len(r["text"]) for r in got)

    near = stages["ngram_join"](spark, lines, sf)
    assert near.columns == docs.columns
    low = {d: c for d, _, c in components_of(sorted({(r["doc_id"], r["text"]) for r in got}))}
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(d for d, c in low.items() if d == c)
    assert low[60] == 3

    clean = stages["decontamination"](spark, near, sf)
    assert clean.columns == docs.columns
    hit = hits_of([(r["doc_id"], r["text"]) for r in near.collect()], [(1, item)])
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(left) == {i for i, h in hit.items() if not h[3]} and hit[62][3] and not hit[0][3]

    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in stages["bpe"](spark, clean, sf).collect():
        ids = list(struct.unpack(f"<{r['n_tokens']}I", r["ids"]))
        assert ids == theirs.encode(left.pop(r["doc_id"]), add_special_tokens=False).ids
    assert left == {}


def test_run_chains_the_stages(spark, corpus):
    sf, texts, _ = corpus
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(got) == sorted(set(range(60)) | {69})


def test_an_empty_table_passes_through(spark, corpus, tmp_path):
    sf, _, _ = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_null_and_shared_ids_among_near_copies(spark):
    importable(spark)
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (1, text + " more"), (2, text + " other"), (None, text + " none"), (None, "alone"), (3, "alone too")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS)
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t) for i, t in rows if i != 2)
