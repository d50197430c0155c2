"""References to records that do not exist, are deleted or arrive later.

References and parent keys are co-partitioned by key, sorted, and merged in one pass (Spark's
sort-merge join is that merge); hot keys are salted. Each parent key carries its validity
intervals, by which a reference without a live parent is told apart as

* missing: no row has that key,
* removed: a row was there at the reference's time and was deleted later,
* deleted: rows were there before, none at the reference's time, and none that is live,
* late:    rows came only after the reference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomleaf.runtime import counted, cut, hot_keys, lookup_join, union_all


@dataclass(frozen=True)
class Reference:
    """One referring field: df holds key (bigint), target (string) and at (timestamp)."""

    table: str
    field: str
    df: DataFrame


def parent_intervals(nodes: DataFrame, key: str = "id", created: str = "created_at", deleted: str = "deleted_at") -> DataFrame:
    """parent, live_since, first_since: one row per parent key, from its validity intervals.

    A row with null deleted_at is live from created_at on; one with null created_at is never
    live. Repeated rows change nothing.
    """
    live = F.when(F.col(deleted).isNull(), F.col(created))
    return (
        nodes.where(F.col(key).isNotNull())
        .select(F.col(key).alias("parent"), live.alias("live"), F.col(created).alias("since"))
        .groupBy("parent")
        .agg(F.min("live").alias("live_since"), F.min("since").alias("first_since"))
        .withColumn("always", F.lit(False))
    )


def orphan_references(references: list[Reference], parents: DataFrame, roots: DataFrame | None = None, lives: DataFrame | None = None) -> DataFrame:
    """ref_table, ref_key, ref_field, target_id, at, kind of each reference without a live parent.

    parents is what parent_intervals gives; roots (column parent) are keys that always exist;
    lives is what parent_lives gives, without it removed ones count as deleted.
    Null and empty targets are no references. A reference whose own time is null is never
    proved good, so it comes out. Distinct rows: an exact repeat of a reference counts once.
    Empty tables give no rows; an empty parent table makes every reference missing.
    """
    refs = union_all(
        [
            r.df.select(F.lit(r.table).alias("ref_table"), F.col("key").cast("bigint").alias("ref_key"), F.lit(r.field).alias("ref_field"), F.col("target").alias("target_id"), F.col("at"))
            for r in references
        ]
    ).where("target_id is not null and target_id <> ''")
    if roots is not None:
        known = roots.where("parent is not null").select("parent", F.lit(None).cast("timestamp_ntz").alias("live_since"), F.lit(None).cast("timestamp_ntz").alias("first_since"), F.lit(True).alias("always"))
        times = dict(parents.dtypes)["live_since"]
        known = known.select("parent", F.col("live_since").cast(times), F.col("first_since").cast(times), "always")
        parents = parents.unionByName(known).groupBy("parent").agg(F.min("live_since").alias("live_since"), F.min("first_since").alias("first_since"), F.max("always").alias("always"))
    counts = cut(refs.groupBy("target_id").count(), rows=F.sum("count"))
    hot = hot_keys(counts, "target_id", "count", counted(counts, "rows"))
    met = lookup_join(refs, parents, ("target_id", "parent"), hot, spread="ref_key")
    good = F.coalesce(F.col("always"), F.lit(False)) | F.coalesce(F.col("live_since") <= F.col("at"), F.lit(False))
    kind = (
        F.when(F.col("parent").isNull(), "missing")
        .when(F.col("first_since") <= F.col("at"), "deleted")
        .when(F.col("live_since").isNull() & (F.col("at").isNull() | F.col("first_since").isNull()), "deleted")
        .otherwise("late")
    )
    bad = met.where(~good).select("ref_table", "ref_key", "ref_field", "target_id", "at", kind.alias("kind")).distinct()
    return bad if lives is None else _told_apart(bad, lives)


def parent_lives(nodes: DataFrame, key: str = "id", created: str = "created_at", deleted: str = "deleted_at") -> DataFrame:
    """parent, since, until: the intervals in which deleted rows were there; repeated rows once."""
    return nodes.where(F.col(key).isNotNull() & (F.col(deleted) > F.col(created))).select(F.col(key).alias("parent"), F.col(created).alias("since"), F.col(deleted).alias("until")).distinct()


def _told_apart(bad: DataFrame, lives: DataFrame) -> DataFrame:
    """Orphans with those told as removed whose time lies in an interval of their parent.

    Only orphans of deleted parents are looked up, each key and time once.
    """
    asked = bad.where("kind = 'deleted'").select(F.col("target_id").alias("_t"), F.col("at").alias("_at")).distinct()
    within = asked.join(lives, (F.col("_t") == F.col("parent")) & (F.col("since") <= F.col("_at")) & (F.col("_at") < F.col("until")), "left_semi")
    out = bad.join(within, (F.col("target_id") == F.col("_t")) & (F.col("at") == F.col("_at")), "left")
    return out.select("ref_table", "ref_key", "ref_field", "target_id", "at", F.when(F.col("_t").isNotNull(), "removed").otherwise(F.col("kind")).alias("kind"))


def curriculum_references(edges: DataFrame, textbooks: DataFrame) -> list[Reference]:
    """The referring fields of the curriculum tables: both ends of edges, aligned codes of textbooks."""
    ends = edges.select("edge_id", "src", "dst", "added_at")
    codes = textbooks.select("textbook_id", "domain", "added_at", F.explode("aligned_codes").alias("code")).where("code <> ''")
    return [
        Reference("edges", "src", ends.select(F.col("edge_id").alias("key"), F.col("src").alias("target"), F.col("added_at").alias("at"))),
        Reference("edges", "dst", ends.select(F.col("edge_id").alias("key"), F.col("dst").alias("target"), F.col("added_at").alias("at"))),
        Reference("textbooks", "aligned_codes", codes.select(F.col("textbook_id").alias("key"), F.concat("domain", F.lit("/"), "code").alias("target"), F.col("added_at").alias("at"))),
    ]


def curriculum_orphans(edges: DataFrame, textbooks: DataFrame, nodes: DataFrame, domains: DataFrame) -> DataFrame:
    """orphan_references over the curriculum tables; the domains' top nodes always exist."""
    return orphan_references(curriculum_references(edges, textbooks), parent_intervals(nodes), domains.select(F.col("root_id").alias("parent")), parent_lives(nodes))


def orphans_by_period(orphans: DataFrame) -> DataFrame:
    """ref_table, period (yyyy-MM of the reference's time, null if unknown), kind, n_refs."""
    return orphans.groupBy("ref_table", F.date_format("at", "yyyy-MM").alias("period"), "kind").agg(F.count(F.lit(1)).alias("n_refs"))
