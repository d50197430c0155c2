"""Knowledge graphs: nodes from parsed files, next-stage links, first edge per key, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomleaf.functions.text import STAGES, stage_order


def build_nodes(files: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per code of every file: id, domain, code, stage, category, ordinal, type, source_file, section, index.

    Content codes come from their own table, performance codes from the file's array; repeated
    codes stay, since ids need not be unique. Files without codes give no rows.
    """
    perf = files.select("file_id", "domain", "source_file", F.posexplode("performance_codes").alias("index", "c")).select(
        "domain", "source_file", F.col("c.code").alias("code"), F.col("c.stage").alias("stage"), F.col("c.category").alias("category"), F.col("c.ordinal").alias("ordinal"), F.lit("performance").alias("type"), "index"
    )
    cont = codes.join(files.select("file_id", "source_file").distinct(), "file_id").select("domain", "source_file", "code", "stage", "category", "ordinal", F.lit("content").alias("type"), F.col("idx").alias("index"))
    return perf.unionByName(cont).where("code is not null and domain is not null").withColumn("id", F.concat("domain", F.lit("/"), "code"))


def link_next(nodes: DataFrame, position: str) -> DataFrame:
    """src, dst, domain: each node to the very next of its (domain, category, ordinal) in stage order, where the stage really rises.

    Equal stages are ordered by `position`: the last of one stage leads to the first of the next.
    So only the first and the last of each stage count; they are minima and maxima, combined
    before the shuffle, and the window runs over at most six stages of a group.
    """
    t = nodes.where("category is not null and ordinal is not null").withColumn("o", stage_order(F.col("stage")))
    at = F.struct(F.col(position), F.col("id"))
    ends = t.groupBy("domain", "category", "ordinal", "o").agg(F.min_by("id", at).alias("first"), F.max_by("id", at).alias("src"))
    w = Window.partitionBy("domain", "category", "ordinal").orderBy("o")
    ends = ends.withColumn("dst", F.lead("first").over(w)).withColumn("o2", F.lead("o").over(w))
    return ends.where("o < 99 and o2 < 99").select("src", "dst", "domain")


def automatic_edges(nodes: DataFrame, position: str) -> DataFrame:
    return link_next(nodes, position).select(
        "src", "dst", F.lit("prerequisite").alias("relation"), F.lit("recommended").alias("strength"), F.lit(None).cast("string").alias("note"), F.lit("auto").alias("source")
    )


def parse_manual_edges(lines: DataFrame, line: str, domain: str) -> DataFrame:
    """Edges from lines `from to [strength] [note ...]`; blank lines, comments and lines of one word give none.

    Ids get their domain only where it isn't written.
    """
    parts = F.split(F.trim(line), r"\s+")
    full = lambda c: F.when(F.contains(c, F.lit("/")), c).otherwise(F.concat(F.col(domain), F.lit("/"), c))
    good = lines.where((F.trim(line) != "") & ~F.startswith(F.trim(line), F.lit("#"))).withColumn("_p", parts).where("size(_p) >= 2")
    return good.select(
        full(F.col("_p")[0]).alias("src"),
        full(F.col("_p")[1]).alias("dst"),
        F.lit("prerequisite").alias("relation"),
        F.coalesce(F.try_element_at("_p", F.lit(3)), F.lit("recommended")).alias("strength"),
        F.nullif(F.array_join(F.slice("_p", F.lit(4), F.size("_p")), " "), F.lit("")).alias("note"),
        F.concat(F.lit("manual:"), F.col(domain)).alias("source"),
    )


def manual_edge_warnings(lines: DataFrame, line: str, domain: str) -> DataFrame:
    """domain, line, warning of each line of entered edges that has words but not both ends."""
    bare = F.trim(line)
    one = lines.where((bare != "") & ~F.startswith(bare, F.lit("#")) & (F.size(F.split(bare, r"\s+")) < 2))
    return one.select(domain, bare.alias("line"), F.lit("fewer than two ids").alias("warning"))


def first_edges(edges: DataFrame, rank: Column, position: str) -> DataFrame:
    """The first edge of each (src, dst, relation): by rank, then position.

    A minimum rather than a window, so a hot key is combined before the shuffle.
    """
    keep = [c for c in edges.columns if c not in ("src", "dst", "relation")]
    first = edges.groupBy("src", "dst", "relation").agg(F.min_by(F.struct(*keep), F.struct(rank, F.col(position))).alias("x"))
    return first.select("src", "dst", "relation", *[F.col(f"x.{c}").alias(c) for c in keep])


def domain_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """domain, counts of nodes by type, of distinct ids, categories and files, and of edges by origin."""
    n = nodes.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.count_if(F.col("type") == "performance").alias("n_performance"),
        F.count_if(F.col("type") == "content").alias("n_content"),
        F.countDistinct("id").alias("n_ids"),
        F.countDistinct("category").alias("n_categories"),
        F.countDistinct("source_file").alias("n_files"),
    )
    e = edges.groupBy(F.substring_index("src", "/", 1).alias("domain")).agg(F.count_if(F.col("source") == "auto").alias("n_auto"), F.count_if(F.col("source") != "auto").alias("n_manual"))
    return n.join(e, "domain", "left").fillna(0, ["n_auto", "n_manual"])


def sanitized(node_id: Column) -> Column:
    return F.regexp_replace(node_id, "[^A-Za-z0-9_一-鿿]", "_")


def mermaid(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """domain, diagram: a Mermaid text per domain, nodes before edges, each once.

    The text of one domain is one value, as the format has it; use mermaid_lines beyond that.
    """
    lines = mermaid_lines(nodes, edges)
    return lines.groupBy("domain").agg(F.concat(F.lit("graph LR\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda x: x["line"]), "\n")).alias("diagram"))


def mermaid_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """domain, rank (0 node, 1 edge), line."""
    local = lambda c: F.substring(c, F.instr(c, "/") + 1, F.length(c))
    n = nodes.select("domain", F.lit(0).alias("rank"), F.concat(F.lit("    "), sanitized(F.col("code")), F.lit('["'), "code", F.lit('"]')).alias("line")).distinct()
    a, b = local(F.col("src")), local(F.col("dst"))
    e = edges.where("src is not null and dst is not null").select(F.substring_index("src", "/", 1).alias("domain"), F.lit(1).alias("rank"), F.concat(F.lit("    "), sanitized(a), F.lit(" -->|"), "relation", F.lit("| "), sanitized(b)).alias("line")).distinct()
    return n.unionByName(e)


def search(nodes: DataFrame, stage: str | None = None, word: str | None = None) -> DataFrame:
    """Nodes of a stage that have a keyword, or the word in their title or description."""
    if stage is not None:
        nodes = nodes.where(F.col("stage") == stage)
    if word is not None:
        hit = F.array_contains("keywords", word) | F.contains("title", F.lit(word)) | F.contains("description", F.lit(word))
        nodes = nodes.where(F.coalesce(hit, F.lit(False)))
    return nodes


def stage_violations(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Automatic edges whose stages are not both known and rising."""
    per = nodes.groupBy("id").agg(F.max("stage").alias("stage"))
    a = per.select(F.col("id").alias("src"), F.col("stage").alias("src_stage"))
    b = per.select(F.col("id").alias("dst"), F.col("stage").alias("dst_stage"))
    t = edges.where("source = 'auto'").join(a, "src", "left").join(b, "dst", "left")
    known = F.col("src_stage").isin(*STAGES) & F.col("dst_stage").isin(*STAGES)
    return t.where(~F.coalesce(known, F.lit(False)) | (stage_order(F.col("src_stage")) >= stage_order(F.col("dst_stage")))).select("edge_id", "src", "dst", "src_stage", "dst_stage").distinct()
