import random
import re

from pyspark.sql import functions as F

from fraudlens.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    d = [int(c) for c in value if c.isdigit() and c.isascii()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(sum(divmod(x * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def base(df, **kw):
    return [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "term"])
            for r in pii.find_pii(df, **kw).collect()]


def test_base_spans_match_the_plain_patterns(frame):
    r = random.Random(11)
    letters = list("a1.@+-_% ()5éB\n😀") + ["a@b.c", "1.2.3.4", "4539 1488-0343 6467", "+44 (20) 7946-0958", "..", "@@"]
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 40)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "0000255.1.1.001 256.1.1.1 1.2.3.4.5.6.7.8"), (1003, "x@y.z%d@e.f"),
             (1004, "4" * 50_000), (1005, "a" * 50_000), (1006, "1 " * 20_000), (1007, "+1" + " " * 20_000 + "+2 345 678 901"),
             (1008, "a@b." * 3000), (1009, "1." * 20_000), (1010, "\n".join(["me@x.org 😀"] * 500)), (1011, "4111111111111111 +12345678")]
    want = dict(rows)
    got = base(frame(rows))
    assert len(got) == len(rows)
    for i, spans in got:
        assert spans == brute(want[i]), (i, want[i][:100])


def test_disclosing_terms_and_sanitised_text(frame):
    fill = ["the weather is fine today", "we went to the market", "nothing to see here at all"]
    rows = [(i, f"{fill[i % 3]} note {i}") for i in range(300)]
    rows += [(1000 + i, f"{fill[i % 3]}\nthe falconer wrote from boss@corp.example about {fill[(i + 1) % 3]} {i}") for i in range(6)]
    rows += [(2000, "a falconer elsewhere"), (2001, "mail one@x.org the market"), (2002, "mail one@x.org the market")]
    df = frame(rows)
    found = pii.find_pii(df)
    got = {r["doc_id"]: {"term": [df_text(rows, r["doc_id"])[s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "term"],
                         "all": r["spans"]} for r in found.collect()}
    for i in range(6):
        assert "falconer" in got[1000 + i]["term"] and "the" not in got[1000 + i]["term"]
    assert got[2000]["term"] == got[5]["term"] == got[2001]["term"] == []          # far from the value; too little support
    clean = (df.join(found.select("doc_id", F.col("spans").alias("s")), "doc_id")
             .select("doc_id", pii.sanitise(F.col("text"), F.col("s")).alias("t")).collect())
    out = {r["doc_id"]: r["t"] for r in clean}
    assert "boss@" not in out[1003] and "[EMAIL]" in out[1003] and "falconer" not in out[1003]
    assert out[2000] == "a falconer elsewhere" and out[2001] == "mail [EMAIL] the market"


def df_text(rows, i):
    return dict(rows)[i]


def test_sanitise_overlaps_and_empty(spark):
    spans = "array(named_struct('kind','email','start',0L,'end',5L,'disclosure',1D), named_struct('kind','term','start',3L,'end',7L,'disclosure',0.5D), named_struct('kind','ip','start',8L,'end',9L,'disclosure',1D))"
    none = "CAST(array() AS array<struct<kind:string,start:bigint,end:bigint,disclosure:double>>)"
    df = spark.sql(f"SELECT '😀b@c.dee x' AS t, {spans} AS s, {none} AS e")
    (r,) = df.select(pii.sanitise(F.col("t"), F.col("s")).alias("a"), pii.sanitise(F.col("t"), F.col("e")).alias("b")).collect()
    assert (r["a"], r["b"]) == ("[EMAIL]e[IP]x", "😀b@c.dee x")


def test_repeated_rows_shared_ids_and_empty_table(frame):
    got = base(frame([(1, "a@b.c"), (1, "a@b.c"), (1, "x 1.2.3.4"), (None, "a@b.c"), (2, None)]))
    assert sorted(got, key=str) == sorted([(1, [("email", 0, 5)]), (1, [("email", 0, 5)]), (1, [("ip", 2, 9)]), (None, [("email", 0, 5)]), (2, [])], key=str)
    assert base(frame([])) == []


def terms_of(rows, found):
    text = dict(rows)
    return {r["doc_id"]: {text[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "term"} for r in found.collect()}


def test_a_value_of_a_single_document_is_disclosed(frame):
    rows = [(i, f"the weather is fine today note {i}") for i in range(300)]
    rows += [(1000 + i, f"a falconer was seen on day {i}") for i in range(5)] + [(1100 + i, f"an osprey on day {i}") for i in range(3)]
    rows += [(2000, "the falconer and the osprey: boss@corp.example today")]
    got = terms_of(rows, pii.find_pii(frame(rows)))
    assert got.pop(2000) == {"falconer"}                    # 6 texts hold it; 4 hold osprey, all texts the rest
    assert not any(got.values())


def test_words_meet_values_in_reach_across_lines_at_any_offset(frame):
    r = random.Random(5)

    def text():
        words = ["".join(r.choice("abé") for _ in range(r.choice((1, 4, 9, 130)))) for _ in range(r.randint(5, 40))]
        for _ in range(r.randint(1, 3)):
            words.insert(r.randint(0, len(words)), r.choice(("m@x.org", "1.2.3.4", "k" * 230 + "@x.org", "4539 1488 0343 6467")))
        return "".join(w + r.choice((" ", "\n", ". ", " " * r.randint(1, 120))) for w in words)

    rows = [(i, text()) for i in range(80)]
    docs = frame(rows, clash=False).select("doc_id", F.xxhash64("text").alias("row"), F.xxhash64(F.lit(17), "text").alias("twin"), "text")
    spans = pii.base_spans(docs)
    met = pii.meetings(pii.words_near(docs, spans, 100), spans, 100).collect()
    ids = {r["row"]: r["doc_id"] for r in docs.collect()}
    got = {(ids[m["row"]], m["start"], m["end"], e) for m in met for e in m["entities"]}
    want = set()
    for i, t in rows:
        values = [(f"{k}:{t[a:b]}", a, b) for k, a, b in brute(t)]
        for m in re.finditer(r"[^\W\d_]+", t):
            if not any(m.start() < b and m.end() > a for _, a, b in values):
                want |= {(i, m.start(), m.end(), e) for e, a, b in values if m.start() < b + 100 and m.end() > a - 100}
    assert len(want) > 500 and got == want


def test_copies_of_texts_change_no_disclosure(frame):
    rows = [(i, f"the weather is fine today note {i}") for i in range(200)]
    hot = [(1000 + i, f"the falconer wrote from boss@corp.example on day {i}") for i in range(5)]
    copied = rows + [(2000 + 100 * k + i, t) for k, (_, t) in enumerate(hot) for i in range(50)] + [(None, hot[0][1])]
    want = terms_of(rows + hot, pii.find_pii(frame(rows + hot)))
    got = terms_of(copied, pii.find_pii(frame(copied)))
    assert want[1000] == {"falconer", "wrote", "from", "on", "day"}
    assert got[None] == want[1000] and all(got[2000 + 100 * k + i] == want[1000 + k] for k in range(5) for i in range(50))
