"""Exact duplicates by distributed MSD radix partitioning of whole texts.

Documents are split into groups by successive runs of bytes: level 0 reads the
first ``first_width`` bytes, each further level a run ``growth`` times as long.
A group whose key (group so far, next bytes, ended?) is held by one document is
finished; a group whose texts end inside the run is finished as a set of equal
texts; only the rest goes to the next level.  Two documents end in one group
exactly when all their bytes agree, so no digest decides equality.

Each level is one aggregation with map-side combine (a group of copies costs
one row per map task) and one left join of the documents to the groups of two or
more.  Both sides of that join are plain exchanges, so a group that holds a large share of the
rows is split by the adaptive skew join.  Finished documents leave their text
behind at the level that finishes them; unfinished ones carry what is left of
theirs to the next level as Parquet in the shared checkpoint folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import materialize, staged


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 first_width: int = 64, growth: int = 8) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical byte by byte; NULL counts as empty, and all
    empty texts form one group.  The row with the largest id of a group stays.
    Rows that repeat one id with equal texts are counted each and share the
    decision of that id; rows that repeat an id with other texts are separate
    documents.  A NULL id is smaller than any other and stays only when its
    whole group has none.  Other columns are not read.  An empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        F.lit(0).cast("bigint").alias("grp"),
        text.cast("binary").alias("rest"),
    )
    finished, width, level = [], first_width, 0
    while True:
        run = F.substring("rest", 1, width)
        keyed = rows.select("id", "sha", "grp", run.alias("run"),
                            (F.octet_length("rest") <= width).alias("ended"),
                            F.expr(f"substring(rest, {width + 1})").alias("rest"))
        groups = materialize(
            keyed.groupBy("grp", "run", "ended")
            .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep"))
            .where("n > 1")
            .withColumn("next_grp", F.monotonically_increasing_id()))
        more = F.col("n").isNotNull() & ~F.col("ended")
        step = staged(
            keyed.join(groups, ["grp", "run", "ended"], "left")
            .select("id", "sha",
                    F.when(~more, F.coalesce("keep", "id")).alias("keep"),
                    F.when(~more, F.coalesce("n", F.lit(1))).alias("n"),
                    F.when(more, F.col("next_grp")).alias("grp"),
                    F.when(more, F.col("rest")).alias("rest")),
            f"radix-{level}")
        finished.append(step.where("grp IS NULL").select("id", "sha", "keep", "n"))
        if groups.where("NOT ended").isEmpty():
            break
        rows = step.where("grp IS NOT NULL").select("id", "sha", "grp", "rest")
        width, level = width * growth, level + 1
    return reduce(DataFrame.unionByName, finished).select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
