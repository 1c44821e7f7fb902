import numpy as np

from fraudlens.llm.html import RUN, blocks_of, extract, main_texts, repeated


def one(page):
    return next(iter(main_texts([(1, None, page)])))


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
    <body class="has-sidebar"><nav><ul><li>Menu</li></ul></nav><!-- <article> no --><div class="ad">Buy</div><header>Site</header>
    <article><h1>A &amp; B</h1><p>One  <b>two</b>
    three.<br><p>Un<i>closed &lt;tag&gt; &eacute;&#8212;&nbsp;x
    <ul><li>i</li><li>j</li></ul><form><p>send</p></form><aside>side</aside><div id="cookie-notice">ok?</div><p>5 < 6 & 7</p>
    <section class="comments"><p>first!</p></section><p>Last</article><footer>&copy;</footer></body></html>"""
    assert one(page) == "A & B\nOne two three.\nUnclosed <tag> é— x\ni\nj\n5 < 6 & 7\nLast"


def test_broken_markup():
    assert one(None) == one("") == one("<p></p>") == ""
    assert one("plain &amp; simple") == "plain & simple"
    assert one("<article>a<p>b<footer>c") == "a\nb"
    assert one("<article>a<!-- open <p>b</p>") == "a"
    assert one("<article>a<script>b</article>") == "a"
    assert one("</div></article><article>a</p></p> b</article></article>c") == "a\nb"
    assert one("<article><p title='a > b'>x</p>a < b <3</article>") == "x\na < b <3"
    assert blocks_of("<article/><p>x") == [(0, ["x"])]


def test_repeated_runs_match_brute_force():
    r = np.random.default_rng(3)
    for run in (2, 3, 5, 7):
        tokens, page = [], []
        for k in range(12):
            n = int(r.integers(0, 25))
            tokens += [*r.integers(0, 4, n).tolist(), -1 - k]
            page += [k % 9] * (n + 1)
        want, at = [False] * len(tokens), {}
        for i in range(len(tokens) - run + 1):
            at.setdefault(tuple(tokens[i:i + run]), []).append(i)
        for places in at.values():
            if len({page[i] for i in places}) > 1:
                for i in places:
                    want[i:i + run] = [True] * run
        assert repeated(np.array(tokens), np.array(page), run).tolist() == want
    assert repeated(np.array([], int), np.array([], int)).tolist() == []


def test_runs_decide_where_a_page_has_no_article():
    shared = " ".join(f"w{i}" for i in range(RUN + 2))
    pages = [(i, None, f"<body><div>{shared}</div><p>own text of page {i} alone here {i}{i}</p></body>") for i in range(3)]
    assert list(main_texts(pages)) == [f"own text of page {i} alone here {i}{i}" for i in range(3)]
    inside = [(i, None, f"<article><p>{shared}</p></article>") for i in range(3)]
    assert list(main_texts(inside)) == [shared] * 3                 # copies of an article are no boilerplate


def test_table_with_a_hot_host_nulls_and_repeated_rows(frame):
    from pyspark.sql import functions as F
    rows = [(i, f"<nav>menu of the whole site here</nav><article><p>text {i}</p></article>") for i in range(60)] + [(7, None), (7, None), (None, "<p>x")]
    df = frame(rows, id_col="page_id", text_col="html").withColumn(
        "url", F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("http://hot.com/"), "page_id")).when(F.col("page_id") % 2 == 0, F.lit("http://b.com")))
    want = sorted([(i, f"text {i}") for i in range(60)] + [(7, ""), (7, ""), (None, "x")], key=str)
    for shard_bytes, broadcast_rows in ((8 << 20, 10), (300, 10), (300, 0)):
        got = extract(df, shard_bytes=shard_bytes, broadcast_rows=broadcast_rows).collect()
        assert sorted(((r["page_id"], r["text"]) for r in got), key=str) == want
        assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract(df.limit(0)).collect() == []


def test_host_size_leaves_results_equal_on_pages_without_article(frame):
    from pyspark.sql import functions as F
    r = np.random.default_rng(8)
    passages = [" ".join(f"p{k}w{j}" for j in range(6 + k % 5)) for k in range(40)]
    rows = []
    for i in range(80):
        parts = [passages[int(r.integers(0, 40))] for _ in range(3)] + [" ".join(f"own{i}x{j}" for j in range(8))]
        rows.append((i % 75, "".join(f"<p>{x}</p>" for x in parts) if i % 4 else f"<article><p>{parts[0]}</p></article>"))
    rows += [(None, f"<p>{passages[0]}</p><p>last of all these pages</p>"), (None, f"<p>{passages[0]}</p>"), (300, "<p>a b</p>")]
    df = frame(rows, id_col="page_id", text_col="html")
    want = sorted(zip([i for i, _ in rows], main_texts([(i, None, h) for i, h in rows])), key=str)
    for url in ("http://hot.com/", None):
        table = df.withColumn("url", F.lit(url).cast("string"))
        for shard_bytes, broadcast_rows in ((8 << 20, 10), (300, 10), (300, 100_000)):
            got = extract(table, shard_bytes=shard_bytes, broadcast_rows=broadcast_rows).collect()
            assert sorted(((p["page_id"], p["text"]) for p in got), key=str) == want
