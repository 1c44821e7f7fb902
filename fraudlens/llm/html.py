"""Main text of web pages: repeated runs of a host's pages by a suffix array, then the page's own structure.

A page is read into blocks of words with their place in the markup.  The pages of
a host are laid end to end as one token stream, each page closed by a token
of its own.  A suffix array sorted on the first ``RUN`` tokens (prefix
doubling) brings equal runs together; runs that occur on two or more pages cover
boilerplate, and blocks that they cover are dropped.  An exact check by the
markup follows: what stands inside the article stays even where pages share it
(copies are no boilerplate), and menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments go even where
they are unique.  In a page without article, blocks that are neither decide by
their runs alone.

A host whose pages exceed ``shard_bytes`` is not laid in one task.  Its repeated
runs are found exactly over the whole host: every page gives its runs of ``RUN`` tokens as 128-bit
hashes, which are aggregated by host before the shuffle and kept where two or more pages
hold them; pages whose blocks the markup leaves open get theirs back.  Both ways
decide alike.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import materialize, staged
from fraudlens.llm.url_filter import host_of

RUN = 5                   # tokens: the shortest run that counts as repeated
COVERED = 0.8             # share of a block's tokens that repeated runs must cover
SHARD_BYTES = 2 << 20
RESULT = "page_id bigint, url string, text string, n_chars bigint"

# Fixed values of HTML: elements without content, with raw text, and that break a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table "
    "tbody tfoot thead tr ul".split())
#: Elements, roles and words of a class or id that mark what is not the article.
AWAY = frozenset("nav header footer aside form head menu button select dialog search".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
AWAY_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo related replies respond share sidebar social sponsor sponsored subscribe toolbar "
    "widget".split())
MAIN = frozenset(("article", "main"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")
OPEN, IN_MAIN, OUT = 0, 1, 2


def _place(tag: str, attributes: str, parent: int) -> int:
    """Where an element's content stands, given its parent's place."""
    if parent == OUT or tag in AWAY:
        return OUT
    if attributes and tag not in ("html", "body", "main"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            words = _WORD.findall("".join(values).lower())
            if name.lower() == "role":
                if AWAY_ROLES.intersection(words):
                    return OUT
            elif tag == "article":
                if {"comment", "comments", "reply", "replies"}.intersection(words):
                    return OUT
            elif AWAY_WORDS.intersection(words):
                return OUT
    return IN_MAIN if tag in MAIN else parent


def blocks_of(page: str) -> list[tuple[int, list[str]]]:
    """(place, words) of each block with words, in page order."""
    stack: list[tuple[str, int]] = []
    out: list[tuple[int, list[str]]] = []
    held: list[str] = []
    at, place, size = 0, OPEN, len(page)

    def flush() -> None:
        if held:
            if words := "".join(map(html.unescape, held)).split():
                out.append((place, words))
            held.clear()

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        closing, tag = m[1], m[2].lower()
        if tag in RAW and not closing:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        breaks = tag in BLOCKS
        if closing:
            if breaks:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    inner = stack[k:]
                    if any(p != place for _, p in inner) or (k and stack[k - 1][1] != place):
                        flush()
                    del stack[k:]
                    place = stack[-1][1] if stack else OPEN
                    break
            continue
        if breaks:
            flush()
            if tag != "br":
                # a new block ends an open paragraph
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        place = stack[-1][1] if stack else OPEN
                        break
                    if stack[k][0] in BLOCKS:
                        break
        if tag not in VOID and not m[3].endswith("/"):
            new = _place(tag, m[3], place)
            if new != place:
                flush()
            stack.append((tag, new))
            place = new
    flush()
    return out


def repeated(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """True for tokens inside a run of ``run`` tokens that occurs on two or more pages.

    ``tokens``: the stream, with a distinct negative token after each page;
    ``page``: the page of each place.  Suffixes are ranked by their first 1, 2, 4, ...
    and at last ``run`` tokens; equal ranks are neighbours in the suffix array.
    """
    n = len(tokens)
    covered = np.zeros(n, bool)
    if n < run:
        return covered
    rank, length = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while length < run:
        step = min(length, run - length)
        pair = rank * (n + 1)
        pair[:n - step] += rank[step:] + 1
        rank, length = np.unique(pair, return_inverse=True)[1].astype(np.int64), length + step
    order = np.argsort(rank, kind="stable")           # the suffix array, cut at ``run`` tokens
    sorted_rank, sorted_page = rank[order], page[order]
    starts = np.flatnonzero(np.r_[True, sorted_rank[1:] != sorted_rank[:-1]])
    first, last = np.minimum.reduceat(sorted_page, starts), np.maximum.reduceat(sorted_page, starts)
    many = np.repeat(first != last, np.diff(np.r_[starts, n]))
    heads = order[many]
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, heads, 1)
    np.add.at(marks, np.minimum(heads + run, n), -1)
    return np.cumsum(marks[:n]) > 0


def main_texts(pages: list[tuple[int | None, str | None, str | None]]) -> Iterator[str]:
    """The main text of each page (id, url, html) of one host, in their order."""
    read = [blocks_of(h or "") for _, _, h in pages]
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__      # words are numbered as they come
    tokens, owner = [], []
    by_id: dict = {}
    for k, ((page_id, _, _), blocks) in enumerate(zip(pages, read)):
        who = by_id.setdefault((page_id,), len(by_id))   # rows that repeat an id are one page
        for _, words in blocks:
            tokens.extend(map(number.__getitem__, words))
            owner.extend([who] * len(words))
        tokens.append(-1 - k)
        owner.append(who)
    covered = repeated(np.array(tokens, np.int64), np.array(owner, np.int64))
    at = 0
    for blocks in read:
        n = sum(len(words) for _, words in blocks)
        yield main_text(blocks, covered[at:at + n])
        at += n + 1


def main_text(blocks: list[tuple[int, list[str]]], covered: np.ndarray) -> str:
    """The main text of a page, given which of its tokens repeated runs cover."""
    share, at = np.r_[0, np.cumsum(covered)], 0
    has_main = any(place == IN_MAIN for place, _ in blocks)
    kept = []
    for place, words in blocks:
        boilerplate = share[at + len(words)] - share[at] >= COVERED * len(words)
        at += len(words)
        if boilerplate and place == IN_MAIN:
            boilerplate = False          # exact check: shared passages and copies of an article stay
        elif place == OUT or (has_main and place == OPEN):
            boilerplate = True           # exact check: what the markup sets apart goes
        if not boilerplate:
            kept.append(" ".join(words))
    return "\n".join(kept)


def undecided(blocks: list[tuple[int, list[str]]]) -> bool:
    """True where the markup leaves blocks of a page to the runs."""
    places = {place for place, _ in blocks}
    return OPEN in places and IN_MAIN not in places


def run_hashes(blocks: list[tuple[int, list[str]]], run: int = RUN) -> np.ndarray:
    """Two 64-bit hashes of each run of ``run`` tokens of a page: an array of shape (2, runs)."""
    seen: dict[str, bytes] = {}
    tokens = [w for _, words in blocks for w in words]
    for w in tokens:
        if w not in seen:
            seen[w] = hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    x = np.frombuffer(b"".join(map(seen.__getitem__, tokens)), "<u8").reshape(-1, 2).T
    n = max(0, len(tokens) - run + 1)
    out = np.zeros((2, n), np.uint64)
    for j in range(run):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x[:, j:j + n]
    return out.view(np.int64)


def _hot_texts(rows: DataFrame, broadcast_rows: int) -> DataFrame:
    """``RESULT`` of hosts of any size; rows: page_id, url, html, host."""
    def small(df: DataFrame, n: int) -> DataFrame:
        return F.broadcast(df) if n <= broadcast_rows else df

    same = F.col("host").eqNullSafe(F.col("other"))
    names = ("page_id", "url", "html")
    page = F.struct(*names, *[F.col(c).isNull() for c in names])      # a hash skips NULL
    rows = rows.select("*", F.xxhash64(page).alias("k1"), F.xxhash64(F.lit(17), page).alias("k2"))

    def open_hosts(batches):
        for b in batches:
            keep = [undecided(blocks_of(h.as_py())) for h in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep, pa.bool_()))], names=["host"])

    def hashes(batches):
        for b in batches:
            for i in range(b.num_rows):
                blocks = blocks_of(b.column("html")[i].as_py())
                got = np.unique(run_hashes(blocks), axis=1)
                n = got.shape[1]
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b.column(c)[i].as_py()] * n, t) for c, t in kinds]
                        + [pa.array(got[0]), pa.array(got[1]), pa.array([undecided(blocks)] * n, pa.bool_())],
                        names=[*(c for c, _ in kinds), "w1", "w2", "open"])

    def texts(batches):
        for b in batches:
            found = []
            for h, r1, r2 in zip(b.column("html"), b.column("r1"), b.column("r2")):
                blocks = blocks_of(h.as_py())
                n = sum(len(words) for _, words in blocks)
                covered = np.zeros(n, bool)
                if r1.is_valid:
                    known = set(zip(r1.as_py(), r2.as_py()))
                    for j, w in enumerate(run_hashes(blocks).T.tolist()):
                        if tuple(w) in known:
                            covered[j:j + RUN] = True
                found.append(main_text(blocks, covered))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = [("host", pa.string()), ("page_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())]
    hosts = materialize(rows.select("host", "html").mapInArrow(open_hosts, "host string").distinct().toDF("other"))
    hosts = small(hosts, hosts.count())
    of_open = rows.join(hosts, same, "left_semi").select("host", "page_id", "k1", "k2", "html")
    held = staged(of_open.mapInArrow(hashes, "host string, page_id bigint, k1 bigint, k2 bigint, w1 bigint, w2 bigint, open boolean"),
                  "html-runs")
    none = F.col("page_id").isNull().cast("int")
    runs = staged(held.groupBy("host", "w1", "w2")
                  .agg(F.min("page_id").alias("a"), F.max("page_id").alias("b"), F.min(none).alias("c"), F.max(none).alias("d"))
                  .where("coalesce(a <> b, false) OR c <> d").select(F.col("host").alias("other"), F.col("w1").alias("x1"), F.col("w2").alias("x2")), "html-repeated")
    runs = small(runs, runs.count())
    needs = held.where("open").select("host", "w1", "w2", "k1", "k2")
    mine = staged(needs.join(runs, same & (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2")), "left_semi")
                  .groupBy("k1", "k2").agg(F.collect_set(F.struct("w1", "w2")).alias("r"))
                  .select("k1", "k2", F.col("r.w1").alias("r1"), F.col("r.w2").alias("r2")), "html-page-runs")
    many = mine.agg(F.sum(F.size("r1"))).first()[0] or 0
    return (rows.join(small(mine, many), ["k1", "k2"], "left").select("page_id", "url", "html", "r1", "r2")
            .mapInArrow(texts, RESULT))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            shard_bytes: int = SHARD_BYTES, broadcast_rows: int = 100_000) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points).

    NULL html is empty and gives an empty text.  Pages without a host, or with a NULL url,
    form one group like a host's.  Rows that repeat a page_id are one page to
    the run count and give a row each.  Unclosed elements, comments and raw text reach to
    their parent's end or the end of the page.  Empty tables give empty results; other columns
    are not read.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"))
    hot = materialize(rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes"))
                      .where(F.col("bytes") > shard_bytes)
                      .select(F.col("host").alias("other")))
    n_hot = hot.count()
    small = F.broadcast if n_hot <= broadcast_rows else (lambda df: df)
    hot = small(hot)
    same = F.col("host").eqNullSafe(F.col("other"))
    cold = rows.join(hot, same, "left_anti")

    def run(group: pa.Table) -> pa.Table:
        ids, urls, texts = (group.column(c).to_pylist() for c in ("page_id", "url", "html"))
        found = list(main_texts(list(zip(ids, urls, texts))))
        return pa.table({"page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()),
                         "text": pa.array(found, pa.string()),
                         "n_chars": pa.array([len(t) for t in found], pa.int64())})

    small_hosts = cold.groupBy("host").applyInArrow(run, RESULT)
    if not n_hot:
        return small_hosts
    return small_hosts.unionByName(_hot_texts(rows.join(hot, same, "left_semi"), broadcast_rows))
