import math
from collections import Counter

import pytest

from fraudlens.llm.url_filter import ALPHABET, RULES, calibrate, filter_urls


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def ruled(host, path):
    fit = [(len(t), t, v) for v, t in RULES for h, p in [t.split("/", 1)]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fit)[1:] if fit else (None, None)


def brute(urls, order=4):
    """The same models by direct recursion over counted contexts."""
    counts = {c: Counter() for c in ("allow", "block")}
    parsed = [parse(u) for u in urls]
    grams = {}
    for host, path in parsed:
        s = "\x02" * order + host + path + "\x03"
        grams[host, path] = [s[i:i + order + 1] for i in range(len(host + path) + 1)] if host + path else []
        _, verdict = ruled(host, path)
        if verdict:
            for g in grams[host, path]:
                for k in range(order + 1):
                    counts[verdict][g[order - k:]] += 1
    nexts = {c: {} for c in counts}
    for c in counts:
        for g, n in counts[c].items():
            total, kinds = nexts[c].get(g[:-1], (0, 0))
            nexts[c][g[:-1]] = total + n, kinds + 1

    def p(c, g):
        base = 1 / ALPHABET if len(g) == 1 else p(c, g[1:])
        total, kinds = nexts[c].get(g[:-1], (0, 0))
        return (counts[c][g] + kinds * base) / (total + kinds) if total else base

    def score(key):
        g = grams[key]
        return round(sum(math.log(p("allow", x)) - math.log(p("block", x)) for x in g) / len(g), 9)

    stats = {c: [0, 0.0, 0.0] for c in counts}
    for key in parsed:
        _, v = ruled(*key)
        if v:
            s = score(key)
            stats[v] = [stats[v][0] + 1, stats[v][1] + s, stats[v][2] + s * s]
    threshold = calibrate(tuple(stats["allow"]), tuple(stats["block"]))
    out = []
    for key in parsed:
        rule, v = ruled(*key)
        if v is None:
            v = "block" if key == ("", "") else "allow" if threshold is None or score(key) >= threshold else "block"
        out.append((*key, rule, v))
    return out


URLS = ["http://a.com/x", "http://www.EXAMPLE.com/en/1?q#f", "https://m.example.com/en/2", "https://m.example.com/fr/2",
        "http://shop.net/es/1", "http://shop.net/en/1", "http://shop.net/fr/zz", "http://ok.org/en/5", None, "", "nourl",
        "http://", "http://x.com", "http://com/", "http://notexample.com/en/7", "ftp://É.org/ü?x", "http://a.com/x",
        "http://Éa.net/es/" + "y" * 3000, "http://wwwexample.com/en/3", "http://example.com/en/", "://a.org#x/y", "http://b.org?x=/en/"]


def test_rules_and_models_match_brute_force(frame):
    rows = list(enumerate(URLS * 3 + [f"http://site{i % 7}.{'org' if i % 3 else 'net'}/p{i}" for i in range(40)]))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in filter_urls(frame(rows, id_col="page_id", text_col="url")).collect()}
    want = brute([u for _, u in rows])
    assert [got[i] for i, _ in rows] == want
    assert {v for *_, rule, v in want if rule is None} == {"allow", "block"}


def test_no_ruled_urls_and_empty_table(frame):
    got = filter_urls(frame([(1, "http://a.org/x"), (2, None)], id_col="page_id", text_col="url")).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "allow", 2: "block"}
    assert filter_urls(frame([], id_col="page_id", text_col="url")).collect() == []


@pytest.mark.parametrize("allowed,blocked,at", [((2, 4.0, 8.0), (2, 0.0, 0.0), 1.0), ((0, None, None), (1, 1.0, 1.0), None)])
def test_calibration(allowed, blocked, at):
    assert calibrate(allowed, blocked) == at
