r"""Personal data: base patterns, and terms that disclose them by corpus co-occurrence.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of
each pattern that pass its check.  Around them the method looks for terms that give a
protected value away: with ``c`` counts of distinct texts, a term ``t`` near a value
``e`` discloses it by PMI / IC, where PMI = log2(c(t,e) N / (c(t) c(e))) and
IC = log2(N / c(e)); 1 means the term reveals the value as well as the value itself.
Terms at or above ``generalise`` become a placeholder, those at or above
``remove`` go.  A term needs ``support`` texts that hold it, anywhere in the corpus; a value
needs no more than the one text it stands in, as most values are unique.

DataFrame functions only.  Copies of a text are read as one.  Texts with a base match are grouped
(one exchange, which all later windows share) and cut into lines; matches get their places
from running sums of the lengths of pieces and matches, and so do the words of the texts that
hold a value.  A term meets a value when their places in the document are within ``reach``
characters, across line breaks: both are joined on all cells of that width that
they touch, so a text of many values and words does not pair all with all.  c(t) is one
pass over all distinct texts, aggregated before the shuffle and before candidate terms are picked.

The patterns are written with possessive quantifiers and, where a match can only
begin at a run's start or after the previous match, an anchor saying so; both keep
the meaning and make long runs linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.common import bounded, materialize, staged

KINDS = ["email", "ip", "card", "phone", "term"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}++"
SUPPORT, REACH, GENERALISE, REMOVE = 5, 100, 0.5, 0.8
KEY = ["row", "twin"]        # a text, by two hashes; copies of a text are one


def _passes(kind: Column, value: Column) -> Column:
    """The check of each kind on a match of its pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    parts = F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3)
                     & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    placed = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")

    def weighed(d: Column, i: Column) -> Column:
        twice = d.cast("int") * (1 + i % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    luhn = F.aggregate(F.transform(placed, weighed), F.lit(0), lambda a, d: a + d) % 10 == 0
    return (F.when(kind == "email", True).when(kind == "ip", parts)
            .when(kind == "card", F.when(F.length(digits).between(13, 19), luhn).otherwise(False))
            .otherwise(F.length(digits).between(9, 15)))


def _found(line: Column, pattern: str) -> Column:
    """(gap, value) of every match: the length of text before it, and the match."""
    values = F.regexp_extract_all(line, F.lit(pattern), 0)
    gaps = F.transform(F.split(line, pattern, -1), F.length)
    return F.arrays_zip(F.slice(gaps, 1, F.size(values)).alias("gap"), values.alias("value"))


def _placed(found: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``start`` and ``end``, code points of the text, from the gaps and values before them."""
    before = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("line_start") + F.sum(F.col("gap") + F.length("value")).over(before)
    return found.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))


def _lines(texts: DataFrame) -> DataFrame:
    """The lines of ``texts`` (KEY, text and others, one row a text), with ``line_no`` and ``line_start``."""
    rest = [c for c in texts.columns if c != "text"]
    lines = texts.select(*rest, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    before = Window.partitionBy(*KEY).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("line_start", F.sum(F.length("line") + 1).over(before) - F.length("line") - 1)


def base_spans(docs: DataFrame) -> DataFrame:
    """(KEY, kind, value, start, end) of the base spans of documents (KEY, text).

    No pattern matches a line break, so a line's matches are the document's.
    """
    some = F.lit(False)
    for p in PATTERNS.values():
        some = some | F.col("text").rlike(p)
    lines = _lines(docs.where(some).groupBy(*KEY).agg(F.first("text").alias("text"))).where(F.col("line").rlike("[0-9@]"))
    tries = F.array(*[F.struct(F.lit(k).alias("kind"), _found(F.col("line"), p).alias("found"))
                      for k, p in PATTERNS.items()])
    found = (lines.select(*KEY, "line_no", "line_start", F.explode(tries).alias("t"))
             .select(*KEY, "line_no", "line_start", "t.kind", F.posexplode("t.found").alias("at", "m"))
             .select(*KEY, "line_no", "line_start", "kind", "at", "m.gap", "m.value"))
    spans = _placed(found, [*KEY, "line_no", "kind"]).where(_passes(F.col("kind"), F.col("value")))
    return staged(spans.select(*KEY, "kind", "value", "start", "end"), "pii")


def words_near(docs: DataFrame, spans: DataFrame, reach: int) -> DataFrame:
    """(KEY, start, end, term) of the words in the lines from the first to the last value of a document, and ``reach`` beyond."""
    band = bounded(materialize(spans.groupBy(*KEY).agg((F.min("start") - reach).alias("low"),
                                                       (F.max("end") + reach).alias("high"))))
    texts = docs.join(band, KEY).groupBy(*KEY).agg(*[F.first(c).alias(c) for c in ("text", "low", "high")])
    lines = _lines(texts).where((F.col("line_start") < F.col("high"))
                                & (F.col("line_start") + F.length("line") > F.col("low")))
    words = (lines.select(*KEY, "line_no", "line_start", F.posexplode(_found(F.col("line"), WORD)).alias("at", "m"))
             .select(*KEY, "line_no", "line_start", "at", "m.gap", "m.value"))
    return _placed(words, [*KEY, "line_no"]).select(*KEY, "start", "end", F.lower("value").alias("term"))


def meetings(words: DataFrame, spans: DataFrame, reach: int) -> DataFrame:
    """(KEY, start, end, term, entities): words within ``reach`` characters of values, with those values.

    Parts of a protected value are no terms of their own.  A word and a value
    that share several cells meet in the first of them.
    """
    width = max(reach, 1)

    def cells(start: Column, end: Column) -> Column:
        return F.sequence(F.floor(start / width), F.floor((end - 1) / width))

    words = words.withColumn("cells", cells(F.col("start"), F.col("end")))
    words = words.select(*KEY, "start", "end", "term", F.col("cells")[0].alias("first"), F.explode("cells").alias("cell"))
    values = spans.select(*KEY, F.concat_ws(":", "kind", "value").alias("entity"), F.col("start").alias("v_start"),
                          F.col("end").alias("v_end"),
                          cells(F.col("start") - reach, F.col("end") + reach).alias("cells"))
    values = values.select(*KEY, "entity", "v_start", "v_end", F.col("cells")[0].alias("v_first"),
                           F.explode("cells").alias("cell"))
    near = (F.col("start") < F.col("v_end") + reach) & (F.col("end") > F.col("v_start") - reach)
    once = F.col("cell") == F.greatest("first", "v_first")
    inside = (F.col("start") < F.col("v_end")) & (F.col("end") > F.col("v_start"))
    return (words.join(values, [*KEY, "cell"]).where(near & once).groupBy(*KEY, "start", "end", "term")
            .agg(F.max(inside).alias("inside"), F.collect_set("entity").alias("entities")).where("NOT inside").drop("inside"))


def disclosing_terms(docs: DataFrame, spans: DataFrame, support: int, reach: int, generalise: float) -> DataFrame:
    """Occurrences of disclosing terms near the values they disclose: KEY, start, end, disclosure."""
    meets = staged(meetings(words_near(docs, spans, reach), spans, reach), "pii-meets")
    meets = meets.select(*KEY, "start", "end", "term", F.explode("entities").alias("entity"))
    together = materialize(meets.groupBy("entity", "term").agg(F.count_distinct(*KEY).alias("c_te")))
    terms = materialize(together.select("term").distinct())
    small = F.broadcast if terms.count() <= 1_000_000 else (lambda df: df)
    # lower case may put marks between letters, so words are found first; not so in ASCII
    found = F.when(F.octet_length("text") == F.char_length("text"), F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0)).otherwise(
        F.transform(F.regexp_extract_all("text", F.lit(WORD), 0), F.lower))
    texts = docs.groupBy(*KEY).agg(F.first("text").alias("text"))
    held = texts.select(F.explode(F.array_distinct(found)).alias("term"))
    c_t = (held.groupBy("term").agg(F.count(F.lit(1)).alias("c_t")).where(F.col("c_t") >= support)
           .join(small(terms), "term"))
    c_e = (spans.groupBy(F.concat_ws(":", "kind", "value").alias("entity"))
           .agg(F.count_distinct(*KEY).alias("c_e")))
    n = F.lit(docs.select(*KEY).distinct().count())
    ic = F.log2(n / F.col("c_e"))
    pmi = F.log2(F.col("c_te") * n / (F.col("c_t") * F.col("c_e")))
    told = (together.join(c_t, "term").join(c_e, "entity")
            .select("entity", "term", F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0)).alias("disclosure"))
            .where(F.col("disclosure") >= generalise))
    return (meets.join(told, ["entity", "term"]).groupBy(*KEY, "start", "end")
            .agg(F.max("disclosure").alias("disclosure")))


def find_pii(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
             reach: int = REACH, generalise: float = GENERALISE) -> DataFrame:
    """One row per document: ``doc_id, row, spans``, an array of (kind, start, end, disclosure).

    Places count code points, ``end`` is exclusive; spans are sorted by kind as in
    ``KINDS``, then start; ``disclosure`` is 1 for base spans.  NULL counts as empty,
    and documents without spans have an empty array.  Rows that share an id are judged
    each by its own text; ``row`` is a hash of it.  An empty table gives an empty
    result; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"),
                            F.xxhash64(F.lit(17), text).alias("twin"), text.alias("text"))
    spans = base_spans(docs)
    terms = disclosing_terms(docs, spans, support, reach, generalise)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    both = (spans.select(*KEY, "kind", "start", "end", F.lit(1.0).alias("disclosure"))
            .unionByName(terms.select(*KEY, F.lit("term").alias("kind"), "start", "end", "disclosure"))
            .groupBy(*KEY)
            .agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "start", "end", "kind", "disclosure"))).alias("s")))
    both = staged(both.select(*KEY, F.transform("s", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        x["disclosure"].alias("disclosure"))).alias("spans")), "pii-spans")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,disclosure:double>>")
    return (docs.select("doc_id", *KEY).join(both, KEY, "left")
            .select("doc_id", "row", F.coalesce("spans", none).alias("spans")))


def sanitise(text: Column, spans: Column, remove: float = REMOVE) -> Column:
    """The text with base spans as ``[EMAIL]`` etc., disclosing terms as ``[TERM]`` or removed.

    Where spans overlap, the one that starts first names the stretch.
    """
    s = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["disclosure"].alias("disclosure"))))
    text = F.coalesce(text, F.lit(""))

    def piece(x: Column, i: Column) -> Column:
        done = F.coalesce(F.array_max(F.transform(F.slice(s, F.lit(1), i), lambda y: y["end"])), F.lit(0)).cast("int")
        label = F.when((x["kind"] == "term") & (x["disclosure"] >= remove), F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.when(x["start"] >= done, F.concat(text.substr(done + 1, (x["start"] - done).cast("int")), label)).otherwise("")

    last = F.coalesce(F.array_max(F.transform(s, lambda x: x["end"])), F.lit(0)).cast("int")
    return F.concat(F.array_join(F.transform(s, piece), ""), text.substr(last + 1, F.length(text)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
