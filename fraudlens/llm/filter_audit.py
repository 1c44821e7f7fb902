r"""Filter interaction audit: what each filter of a chain removes, in every order, from one table of outcomes.

1. One pass reads each document once and gives its failure bits; equal texts meet by SHA-256,
   aggregated before the shuffle, so that filter E knows the smallest id of every text.
2. Documents are counted by (part, failure bits): at most 2^5 rows a part, summed map-side.
3. The counts of a part are a 2x2x2x2x2 tensor (all documents, good ones, toxic ones).  For every
   order and step, a selector for each axis takes pass, fail or all of it, and one ``einsum``
   contracts the tensor with the selectors of all 600 steps at once.

A part's tensor has a fixed size, so parts are contracted where they lie, many at a time;
the number of documents in a part matters to step 2 alone.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import staged

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PER_CENT, CAPITAL_PER_CENT, MARKS = 50, 65, 5, b"#$%&*|"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

_CAPITALS = bytes(range(0x41, 0x5B))


def failures(text: str | None) -> int:
    """Bits of the filters A to D that a text fails: A is bit 0."""
    text = text or ""
    data = text.encode()
    words = data.split()                       # bytes part at \x20 and \x09-\x0D alone
    few = len(words) < MIN_WORDS
    repeated = 100 * len(set(words)) < DISTINCT_PER_CENT * len(words)
    loud = 100 * (len(data) - len(data.translate(None, _CAPITALS))) > CAPITAL_PER_CENT * len(text)
    marked = any(m in data for m in MARKS)
    return few | repeated << 1 | loud << 2 | marked << 3


def judged(documents: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, fails, digest) of each document; the digest names its text."""

    def run(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256((t or "").encode()).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "fails", "digest"])

    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"),
                            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, part string, fails int, digest binary")


def outcomes(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and failure bits, at most 32 rows a part."""
    docs = staged(judged(documents, id_col, text_col, part_col), "audit-judged")
    # both joins keep documents on the left, where the adaptive join splits the copies of one text or id
    first = (docs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where("first < last").select("digest", "first"))
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic")
             .groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                                    F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
             .where("good OR toxic"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return (docs.join(first, "digest", "left").withColumn("fails", F.col("fails") + copy * 16)
            .select("doc_id", "part", "fails").join(marks, "doc_id", "left")
            .groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("good")).alias("good"),
                                          F.count_if(F.col("toxic")).alias("toxic")))


def steps() -> list[tuple[str, int, int]]:
    """(order, step from 1, axis of its filter) for every order of the filters."""
    return [("".join(o), k + 1, FILTERS.index(f)) for o in itertools.permutations(FILTERS) for k, f in enumerate(o)]


def selectors(of: dict[str, tuple[int, int]]) -> list[np.ndarray]:
    """For each axis a (600, 2) matrix: what ``of`` says for the filter of the step, those before and those after it."""
    rows = [[of["here"] if x == f else of["before"] if order.index(x) < order.index(f) else of["after"] for x in FILTERS]
            for order, f in ((o, FILTERS[axis]) for o, _, axis in steps())]
    both = np.array(rows, np.int64)
    return [both[:, axis] for axis in range(len(FILTERS))]


def contracted(tensors: np.ndarray, of: dict[str, tuple[int, int]]) -> np.ndarray:
    """(parts, 600): each part's tensor contracted with the selectors of every step."""
    return np.einsum("pabcde,ka,kb,kc,kd,ke->pk", tensors, *selectors(of), optimize="greedy")


def measures(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """MEASURES of each part and step, from tensors of shape (parts, 2, 2, 2, 2, 2)."""
    here = {"before": PASS, "here": FAIL, "after": ALL}
    removed = contracted(n, here)
    failing = contracted(n, {"before": ALL, "here": FAIL, "after": ALL})
    axes = np.array([axis for _, _, axis in steps()])
    shapley = np.zeros_like(removed)
    for axis in range(len(FILTERS)):
        shapley[:, axes == axis] = removed[:, axes == axis].sum(axis=1, keepdims=True)
    return {"kept": contracted(n, {"before": PASS, "here": PASS, "after": ALL}), "removed": removed, "redundant": failing - removed,
            "unique_fails": contracted(n, {"before": PASS, "here": FAIL, "after": PASS}),
            "good_lost": contracted(good, here), "toxic_lost": contracted(toxic, here), "shapley": shapley}


def audit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``part, filter_order, step`` and MEASURES: 600 rows for each part of ``documents``.

    A NULL text is an empty one, a NULL part the part ''.  A document is a copy (filter E) when its
    text stands in a row with a smaller id; rows that repeat one id are no copies of each other, and a
    NULL id neither is nor makes a copy.  Texts are read whole, whatever their length.  Several labels of an id count as one,
    good or toxic where any of them is; NULL labels are neither.  An empty table has no parts.  Other columns are not read.
    """
    cells = outcomes(documents, labels, id_col, text_col, part_col)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    plan = steps()
    names = ["part", "filter_order", "step", *MEASURES]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} bigint" for m in MEASURES)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                tensors = np.zeros((3, b.num_rows, 32), np.int64)
                for p, held in enumerate(b.column(1).to_pylist()):
                    for c in held:
                        tensors[:, p, c["fails"]] = c["n"], c["good"], c["toxic"]
                # bit 0 is the last axis of a reshape: turn the axes round, so that the first one is filter A
                shaped = tensors.reshape(3, b.num_rows, *[2] * 5).transpose(0, 1, 6, 5, 4, 3, 2)
                got = measures(*shaped)
                part = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), len(plan))))
                order = pa.array([o for o, _, _ in plan] * b.num_rows)
                step = pa.array(np.tile(np.array([k for _, k, _ in plan], np.int32), b.num_rows))
                yield pa.RecordBatch.from_arrays([part, order, step, *[pa.array(got[m].ravel()) for m in MEASURES]], names=names)

    return parts.mapInArrow(run, schema)
