"""URL filter: host and path rules, and a character language-model ratio for the rest.

URLs that a rule accepts or rejects train two character models of variable
order (contexts of 0 to ``order`` characters, Witten-Bell smoothing: each
context gives the weight of its distinct continuations to the next shorter
one, down to a uniform distribution).  Every other URL is accepted when the
mean log-likelihood ratio per character reaches a threshold, calibrated on the
ruled URLs as the point equally many standard deviations from both class means.
Rules and models judge host and path only: query string and fragment are not read,
so URLs that differ only there always get one verdict.

Everything is DataFrame expressions.  The counts are one aggregation over all
positions of all URLs with map-side combine; lower orders are derived from the
highest one; scores are one join of URL positions with the table of
log ratios, whose hot n-grams the adaptive skew join splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.common import ascii_lower, materialize, staged

#: Rules (verdict, "host/path prefix") of the production query.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
ALPHABET = 0x110000          # code points: the base distribution is uniform over these
PAD, END = "\x02", "\x03"    # stand for the places before and after a URL


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_match(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; both NULL where none fits."""
    rule = verdict = F.lit(None).cast("string")
    # of rules with equal text a block wins: it is tested first
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _log_ratios(grams: DataFrame, order: int) -> DataFrame:
    """(gram, llr): log P(last char | context) of the accepted minus the rejected model.

    ``grams``: gram of order + 1 characters, with counts ``a`` and ``r`` of the
    two classes (0 for grams that only unruled URLs have).
    """
    lower = None
    for k in range(order + 1):
        # characters order-k+1 ... order+1 of the gram: context of k characters and the next one
        level = (grams.groupBy(F.substring("gram", order - k + 1, k + 1).alias("gram"))
                 .agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
        ctx = Window.partitionBy(F.substring("gram", 1, k))
        cols = [F.col("gram")]
        for c in ("a", "r"):
            cols += [F.col(c),
                     F.sum(c).over(ctx).alias(f"{c}_all"),
                     F.sum((F.col(c) > 0).cast("bigint")).over(ctx).alias(f"{c}_kinds")]
        level = level.select(*cols)
        if lower is None:
            base_a = base_r = F.lit(1.0 / ALPHABET)
        else:
            level = level.withColumn("suffix", F.substring("gram", 2, k)).join(lower, "suffix")
            base_a, base_r = F.col("lower_a"), F.col("lower_r")

        def p(c: str, base: Column) -> Column:
            return (F.when(F.col(f"{c}_all") > 0,
                           (F.col(c) + F.col(f"{c}_kinds") * base) / (F.col(f"{c}_all") + F.col(f"{c}_kinds")))
                    .otherwise(base))

        lower = level.select(F.col("gram").alias("suffix"), p("a", base_a).alias("lower_a"),
                             p("r", base_r).alias("lower_r"))
    return lower.select(F.col("suffix").alias("gram"),
                        (F.log("lower_a") - F.log("lower_r")).alias("llr"))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: list[tuple[str, str]] = RULES, order: int = 4) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    ``verdict`` is the longest fitting rule's; else the models': allow when
    ``score`` (mean log ratio per character) reaches the calibrated threshold.
    ``score`` is NULL for ruled URLs.  NULL and URLs without ``://`` have empty
    host and path and are blocked: there is nothing to fetch.  When the rules
    accept no URL, or reject none, there is no ratio and unruled URLs are
    allowed.  Time grows in proportion to a URL's length.  Repeated rows get the same verdict each; an empty table gives an
    empty result; other columns are not read.
    """
    spark = pages.sparkSession
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    urls = urls.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))

    # a site may hold many pages of one address: score each address once
    known = staged(urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.first("ruled").alias("ruled"))
                   .withColumn("key", F.monotonically_increasing_id()), "urls")
    # an array of characters: a place in a string is found by walking from its start, a place in an array at once
    letters = F.split(F.concat(F.lit(PAD * order), "host", "path", F.lit(END)), "")
    gram = F.transform(F.sequence(F.lit(1), F.size("letters") - order), lambda i: F.array_join(F.slice("letters", i, F.lit(order + 1)), ""))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spots = (known.where("host <> '' OR path <> ''").repartition(parts, "key").select("key", "n", "ruled", letters.alias("letters"))
             .select("key", "n", "ruled", F.explode(gram).alias("gram")))
    grams = materialize(spots.groupBy("gram").agg(
        F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("r")))
    ratios = materialize(_log_ratios(grams, order))
    scores = staged(spots.join(ratios, "gram").groupBy("key", "n", "ruled")
                    .agg(F.round(F.avg("llr"), 9).alias("score")), "url-scores")

    fit = scores.groupBy().agg(*[
        agg.alias(f"{c}_{name}") for c in ("allow", "block") for name, agg in (
            ("n", F.sum(F.when(F.col("ruled") == c, F.col("n")))),
            ("s", F.sum(F.when(F.col("ruled") == c, F.col("n") * F.col("score")))),
            ("q", F.sum(F.when(F.col("ruled") == c, F.col("n") * F.col("score") * F.col("score")))))]).first()
    threshold = calibrate(*[(fit[f"{c}_n"], fit[f"{c}_s"], fit[f"{c}_q"]) for c in ("allow", "block")])

    judged = scores.where("ruled IS NULL").join(known.select("key", "host", "path"), "key").select("host", "path", "score")
    passes = F.lit(True) if threshold is None else F.col("score") >= F.lit(threshold)
    by_model = (F.when((F.col("host") == "") & (F.col("path") == ""), F.lit("block"))
                .when(passes, F.lit("allow")).otherwise(F.lit("block")))
    return urls.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")


def calibrate(allowed: tuple, blocked: tuple) -> float | None:
    """Threshold between two classes, each given as (count, sum, sum of squares) of its scores.

    The point equally many standard deviations from both means; half way
    where neither class spreads; None where a class is empty.
    """
    if not allowed[0] or not blocked[0]:
        return None
    stats = []
    for n, s, q in (allowed, blocked):
        mean = s / n
        stats.append((mean, math.sqrt(max(0.0, q / n - mean * mean))))
    (ma, sa), (mr, sr) = stats
    return round((ma + mr) / 2 if sa + sr == 0 else (ma * sr + mr * sa) / (sa + sr), 6)
