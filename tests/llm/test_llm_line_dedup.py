import random
import re

from pyspark.sql import functions as F

from fraudlens.llm import line_dedup
from fraudlens.llm.common import staged
from fraudlens.llm.line_dedup import dedup_lines


def word_set(line):
    return frozenset(w for w in re.split("[ \t\r\x0b\x0c]+", line.lower()) if w)


def brute(rows, per_cent=75):
    """Cleaned text of each (id, text); ids are distinct and rows sorted by id."""
    earlier, out = [], {}
    for i, t in rows:
        kept = []
        for line in (t or "").split("\n"):
            s = word_set(line)
            gone = bool(s) and any(100 * len(s & e) >= per_cent * len(s | e) for e in earlier)
            if s:
                earlier.append(s)
            if not gone:
                kept.append(line)
        out[i] = "\n".join(kept)
    return out


def cleaned(df, **kw):
    return {r["doc_id"]: r["text"] for r in dedup_lines(df, **kw).collect()}


def test_matches_brute_force(frame, vocabulary):
    r = random.Random(1)
    base = [[r.choice(vocabulary[:60]) for _ in range(r.randint(1, 30))] for _ in range(40)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(r.randint(0, 5)):
            w = list(r.choice(base))
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            lines.append(r.choice([" ", "  ", "\t"]).join(w).upper() if r.random() < 0.2 else " ".join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(500, ""), (501, "\n\n"), (502, "The"), (503, "the\nTHE the"), (504, "é É"), (505, "word " * 20_000),
             (506, "\n".join(f"only{k} line" for k in range(3000)))]
    for per_cent in (75, 50):
        assert cleaned(frame(rows), per_cent=per_cent) == brute(rows, per_cent)


def test_many_near_copies_of_one_line(frame, vocabulary):
    rows = [(i, " ".join(vocabulary[:30]) + f" unique{i} other{i}") for i in range(300)]
    assert cleaned(frame(rows)) == brute(rows)


def test_near_copies_are_not_joined_with_each_other(spark, frame, vocabulary):
    copies = 5_000
    text = " ".join(vocabulary[:40])
    docs = frame([(i, text.replace(vocabulary[i % 40], f"new{i}")) for i in range(copies)] + [(copies, "a line of its own")], clash=False)
    lines = line_dedup.distinct_lines(docs.select("doc_id", F.lit(0).cast("bigint").alias("row"), "text"))
    settled = line_dedup.matched(staged(line_dedup.near_pairs(lines), "near"), lines, 75)
    assert settled.count() == copies - 1
    sets = line_dedup.line_sets(lines, line_dedup.rarity(lines), 75).join(settled.withColumn("gone", F.lit(1)), "id", "left")
    met = (sets.select("gone", F.explode("prefix").alias("e")).groupBy("e")
           .agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("gone").isNull()).alias("open")).agg(F.sum(F.col("c") * F.col("open"))).first()[0])
    assert met < 40 * copies                          # all pairs would be 12 million a word
    pairs = line_dedup.open_pairs(sets.withColumn("open", F.col("gone").isNull()), 75, lambda a, b: line_dedup._may_match(a, b, 75))
    assert pairs.count() <= copies


def test_signatures_part_long_lines_that_share_common_words(frame):
    common = " ".join(f"common{k}" for k in range(90))
    docs = frame([(i, common + "".join(f" own{i}x{k}" for k in range(50))) for i in range(30)], clash=False)
    lines = line_dedup.distinct_lines(docs.select("doc_id", F.lit(0).cast("bigint").alias("row"), "text"))
    sets = line_dedup.line_sets(lines, line_dedup.rarity(lines), 75)
    a, b = ({c: F.col(f"{v}.{c}") for c in ("n", "k1", "k2")} for v in "ab")
    pairs = sets.alias("a").join(sets.alias("b"), F.col("a.id") < F.col("b.id"))
    assert pairs.count() == 435
    assert pairs.where(line_dedup._may_match(a, b, 75)).count() < 150          # their similarity is 0.47


def test_a_text_of_many_lines(frame):
    rows = [(1, "\n".join(f"line{k} of many" for k in range(60_000))), (2, "line5 of many\nnew words here")]
    got = cleaned(frame(rows))
    assert got[1] == rows[0][1] and got[2] == "new words here"


def test_nulls_repeated_rows_and_clashing_names(frame):
    got = dedup_lines(frame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, None), (None, "a b c d e"), (4, "x")]))
    assert {"id", "row", "n", "x", "y", "_removed"} <= set(got.columns)
    out = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    # the NULL id comes first, so its line is the one that stays
    assert out == sorted([(None, "a b c d e"), (1, ""), (1, ""), (2, ""), (3, None), (4, "x")], key=str)


def test_a_repeated_row_does_not_match_itself(frame):
    got = dedup_lines(frame([(1, "a b c d\ne f g"), (1, "a b c d\ne f g"), (2, "a b c d")]))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, "a b c d\ne f g")] * 2 + [(2, "")]


def test_rows_sharing_an_id_are_separate_texts(frame):
    got = sorted(r["text"] for r in dedup_lines(frame([(1, "a b c d\ne"), (1, "a b c d\nf")])).collect())
    assert got in (["a b c d\ne", "f"], ["a b c d\nf", "e"])


def test_empty_table(frame):
    assert dedup_lines(frame([])).collect() == []
