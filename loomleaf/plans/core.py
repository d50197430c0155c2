"""Queries of the core operators over links and references, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomleaf.operators import hierarchy as H
from loomleaf.operators import references as R
from loomleaf.runtime import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return R.curriculum_orphans(*(table(spark, d, t) for t in ("edges", "textbooks", "nodes", "domains")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("ref_table", "ref_key", "ref_field", "target_id").distinct()


def p2_by_period(spark: SparkSession, d: str) -> DataFrame:
    return R.orphans_by_period(_orphans(spark, d))


def _tree(spark: SparkSession, d: str, with_path: bool = False) -> DataFrame:
    return H.hierarchy(H.prerequisite_links(table(spark, d, "edges")), with_path)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).select(F.col("id").alias("node_id"), "root_id", "depth")


def p6_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """Every node with its path, depth, root and number of descendants."""
    return _tree(spark, d, True).select(F.col("id").alias("node_id"), "root_id", "depth", F.array_join("path", " > ").alias("path"), (F.col("rgt") - F.col("lft")).alias("n_descendants"))


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Every node with each of its descendants."""
    return H.descendants(_tree(spark, d)).select("node_id", "descendant_id", "distance")


def p6_cycles(spark: SparkSession, d: str) -> DataFrame:
    """The circles: their smallest id and how many nodes lie on or below them."""
    return _tree(spark, d).where("depth = -1").groupBy(F.col("root_id").alias("circle_id")).agg(F.count(F.lit(1)).alias("n_nodes"))


_REFS = """refs AS (
  SELECT 'edges' AS ref_table, edge_id AS ref_key, 'src' AS ref_field, src AS target_id, added_at AS seen FROM edges
  UNION ALL SELECT 'edges', edge_id, 'dst', dst, added_at FROM edges
  UNION ALL SELECT 'textbooks', textbook_id, 'aligned_codes', domain || '/' || code, added_at
  FROM (SELECT textbook_id, domain, added_at, unnest(aligned_codes) AS code FROM textbooks) WHERE code <> ''
), per AS (
  SELECT id, min(created_at) FILTER (WHERE deleted_at IS NULL) AS live_since, min(created_at) AS first_since FROM nodes GROUP BY id
), bad AS (
  SELECT DISTINCT r.ref_table, r.ref_key, r.ref_field, r.target_id, r.seen,
    CASE WHEN p.id IS NULL THEN 'missing'
      WHEN EXISTS (SELECT 1 FROM nodes n WHERE n.id = r.target_id AND n.deleted_at IS NOT NULL AND n.created_at <= r.seen AND r.seen < n.deleted_at) THEN 'removed'
      WHEN p.first_since <= r.seen OR p.live_since IS NULL AND (r.seen IS NULL OR p.first_since IS NULL) THEN 'deleted' ELSE 'late' END AS kind
  FROM refs r LEFT JOIN per p ON p.id = r.target_id
  WHERE r.target_id <> '' AND r.target_id NOT IN (SELECT root_id FROM domains WHERE root_id IS NOT NULL)
    AND (p.live_since IS NULL OR r.seen IS NULL OR p.live_since > r.seen)
)"""

_LINKS = r"""links AS (
  SELECT DISTINCT src, dst FROM edges
  WHERE lower(regexp_replace(relation, '^\s+|\s+$', '', 'g')) = 'prerequisite' AND src <> '' AND dst <> ''
), ids AS (SELECT src AS id FROM links UNION SELECT dst FROM links),
reach(id, anc) AS (
  SELECT dst, src FROM links UNION SELECT r.id, l.src FROM reach r JOIN links l ON l.dst = r.anc
), ring AS (SELECT id FROM reach WHERE id = anc),
low AS (SELECT r.id, min(g.id) AS circle_id FROM reach r JOIN ring g ON g.id = r.anc GROUP BY r.id),
tops AS (SELECT id FROM ids WHERE id NOT IN (SELECT dst FROM links)),
down(id, root_id, depth, path) AS (
  SELECT id, id, 0, id FROM tops
  UNION ALL SELECT l.dst, d.root_id, d.depth + 1, d.path || ' > ' || l.dst FROM down d JOIN links l ON l.src = d.id
), sizes AS (SELECT anc AS id, count(*) AS n FROM reach GROUP BY anc)"""

QUERIES = {f.__name__: f for f in (p2_found, p2_by_period, p6_found, p6_hierarchy, p6_descendants, p6_cycles)}

SQL = {
    "p2_found": f"WITH {_REFS} SELECT DISTINCT ref_table, ref_key, ref_field, target_id FROM bad",
    "p2_by_period": f"WITH {_REFS} SELECT ref_table, strftime(seen, '%Y-%m') AS period, kind, count(*) AS n_refs FROM bad GROUP BY ALL",
    "p6_found": f"WITH RECURSIVE {_LINKS} SELECT id AS node_id, root_id, depth::INTEGER AS depth FROM down UNION ALL SELECT id, circle_id, -1 FROM low",
    "p6_hierarchy": f"WITH RECURSIVE {_LINKS} SELECT d.id AS node_id, d.root_id, d.depth::INTEGER AS depth, d.path, coalesce(s.n, 0)::BIGINT AS n_descendants FROM down d LEFT JOIN sizes s ON s.id = d.id UNION ALL SELECT id, circle_id, -1, NULL, NULL FROM low",
    "p6_descendants": f"WITH RECURSIVE {_LINKS} SELECT a.id AS node_id, r.id AS descendant_id, (e.depth - a.depth)::INTEGER AS distance FROM reach r JOIN down a ON a.id = r.anc JOIN down e ON e.id = r.id",
    "p6_cycles": f"WITH RECURSIVE {_LINKS} SELECT circle_id, count(*)::BIGINT AS n_nodes FROM low GROUP BY circle_id",
}
