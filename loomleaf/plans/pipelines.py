"""The stages put together: from files to tables, graphs, reports and findings. Everything stays lazy until a writer runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomleaf.functions import rules, text
from loomleaf.functions.charset import path_from_latin1
from loomleaf.functions.exams import RECORD_FIELDS, record_fields, subject_of_body, voted_subject
from loomleaf.operators import analyze, graph, hierarchy, quality
from loomleaf.runtime import stripped, union_all
from loomleaf.sources import readers, reports, writers


def parse_curriculum(spark: SparkSession, path: str, domains: list[str] | None = None) -> DataFrame:
    """Markdown files as parsed rows, see readers.parsed_markdown."""
    return readers.parsed_markdown(readers.markdown(spark, path, domains))


def aggregate_index(index: DataFrame, parsed: DataFrame) -> DataFrame:
    """The index's items (domain, title) with what was parsed of them; of repeated parsed rows the last path counts."""
    last = parsed.select("domain", F.try_element_at("frontmatter", F.lit("title")).alias("title"), "path", "structure_type", F.size("performance_codes").alias("n_performance"), F.size("content_codes").alias("n_content"))
    last = last.groupBy("domain", "title").agg(F.max_by(F.struct("structure_type", "n_performance", "n_content"), "path").alias("x"))
    return index.join(last, ["domain", "title"], "left").select(*index.columns, "x.structure_type", "x.n_performance", "x.n_content")


def build_graph(nodes: DataFrame, position: str, entered: DataFrame | None = None) -> DataFrame:
    """Automatic edges, and entered ones where no automatic edge has the same key."""
    auto = graph.automatic_edges(nodes, position).distinct().withColumn("_rank", F.lit(0)).withColumn("_pos", F.lit(0).cast("bigint"))
    if entered is None:
        return auto.drop("_rank", "_pos")
    given = entered.select("src", "dst", "relation", "strength", "note", "source").withColumn("_rank", F.lit(1)).withColumn("_pos", F.xxhash64("src", "dst", "source", "strength", "note"))
    return graph.first_edges(auto.unionByName(given), F.col("_rank"), "_pos").drop("_rank", "_pos")


def verify_graph(nodes: DataFrame, edges: DataFrame, declared: DataFrame | None = None, whole: tuple[DataFrame, DataFrame] | None = None, complete: bool = True) -> DataFrame:
    """Findings over a graph: declared counts, loose ends, circles, stage order, missing fields, and what differs from the whole graph's nodes and edges.

    Without complete, null ends and the fields that graph_findings' SQL leaves out aren't looked at.
    """
    ids = nodes.select("id").distinct()
    parts = []
    if declared is not None:
        actual = nodes.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
        j = declared.join(actual, "domain", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        parts.append(quality.finding(j, F.col("domain"), F.col("total_nodes") != F.col("n"), "node_count", "fail", F.col("n")))
    for end in ("src", "dst"):
        loose = (edges if complete else edges.where(F.col(end).isNotNull())).join(ids.withColumnRenamed("id", end), end, "left_anti")
        parts.append(quality.finding(loose, F.coalesce(F.col(end), F.lit("?")), F.lit(True), "dangling_" + end, "fail", F.col("relation")))
    tree = hierarchy.hierarchy(hierarchy.prerequisite_links(edges), with_path=False)
    parts.append(quality.finding(tree, F.col("id"), F.col("depth") < 0, "circle", "fail", F.col("root_id")))
    numbered = edges if "edge_id" in edges.columns else edges.withColumn("edge_id", F.xxhash64("src", "dst", "relation"))
    bad = graph.stage_violations(numbered, nodes)
    parts.append(quality.finding(bad, F.concat_ws(" ", "src", "dst"), F.lit(True), "stage_order", "fail", F.concat_ws(" ", "src_stage", "dst_stage")))
    lacking = quality.missing_fields(nodes.withColumn("_e", F.coalesce("id", F.lit("?"))), "_e", [c for c in ("id", "domain", "code", "stage", "category", "type", *(("code_format", "ordinal", "source_file") if complete else ())) if c in nodes.columns])
    parts.append(quality.finding(lacking, F.col("entity"), F.lit(True), "missing_fields", "fail", F.col("missing")))
    if complete:
        ends = F.concat_ws(" ", F.coalesce("src", F.lit("?")), F.coalesce("dst", F.lit("?")))
        lacking = quality.missing_fields(edges.withColumn("_e", ends), "_e", ["src", "dst", "relation"])
        parts.append(quality.finding(lacking, F.col("entity"), F.lit(True), "edge_fields", "fail", F.col("missing")))
    if whole is not None:
        for name, own, all_, columns in (("whole_nodes", nodes, whole[0], ["id"]), ("whole_edges", edges, whole[1], ["src", "dst", "relation"])):
            odd = analyze.symmetric_difference(own.select(*columns), all_.select(*columns))
            parts.append(quality.finding(odd, F.concat_ws(" ", *columns), F.lit(True), name, "fail", F.when(F.col("side") == "left", "missing").otherwise("extra")))
    return union_all(parts)


def graph_reports(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return reports.graph_report(graph.domain_summary(nodes, edges), nodes.groupBy("domain", "category").agg(F.count(F.lit(1)).alias("n")))


def extract_exams(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records of readable exam files with what their names tell, and the failures (path, reason)."""
    got = readers.extracted(readers.files(spark, path, ["pdf", "docx", "doc", "xlsx", "txt"]))
    name = F.element_at(F.split("path", "/"), -1)
    coded = rules.coded_name(name)
    kind = {f: c for f, c in zip(RECORD_FIELDS, record_fields(F.col("path")))}
    records = got.where("reason is null").select(
        "path",
        name.alias("original_filename"),
        "ext",
        "size",
        "sha256",
        F.coalesce(coded["subject"], kind["subject"], rules.first_match(name, rules.SUBJECT_BY_NAME), subject_of_body(F.col("text"))).alias("subject"),
        F.coalesce(coded["test_type"], rules.first_match(name, rules.TEST_BY_NAME)).alias("test_type"),
        F.coalesce(coded["semester"], F.when(F.contains(name, F.lit("上學期")), "上學期").when(F.contains(name, F.lit("下學期")), "下學期")).alias("semester"),
        F.coalesce(coded["year_roc"], text.nonempty(F.regexp_extract(name, r"^(\d{2,3})[-_]", 1))).alias("year_roc"),
        text.path_fields(F.col("path")).alias("p"),
        kind["source"],
        kind["license"],
        kind["variant"],
        kind["school"],
        F.col("text").alias("body"),
    )
    return records.select("*", "p.*").drop("p"), got.where("reason is not null").select("path", "reason")


def impute_subjects(exams: DataFrame) -> DataFrame:
    """exam_id, imputed, origin: the subject itself, else what the body tells, else the group's."""
    blank = F.nullif(F.trim("subject"), F.lit(""))
    t = exams.select("exam_id", "year_roc", "semester", "grade_num", "school", "body", blank.alias("subject"))
    return analyze.impute(t, ["year_roc", "semester", "grade_num", "school"], "subject", ("body", rules.first_match(F.regexp_replace("body", r"(?U)\s+", ""), rules.SUBJECT_BY_BODY))).select("exam_id", "imputed", "origin")


def unusable(exams: DataFrame, least: int = 200) -> tuple[DataFrame, DataFrame]:
    """Records whose body is long enough, and how many were left out by source and grade."""
    short = F.length(F.trim(F.coalesce("body", F.lit("")))) < least
    return exams.where(~short), exams.where(short).groupBy("source", "grade_num").agg(F.count(F.lit(1)).alias("n"))


def exam_documents(exams: DataFrame) -> DataFrame:
    """path, text: every record as a markdown document at its place."""
    fields = ["source", "year_roc", "stage", "grade_label", "grade_num", "subject", "semester", "test_type", "variant", "school", "version", "original_filename", "original_path", "sha256", "size", "ext", "license"]
    doc = writers.frontmatter_text([(f, F.col(f)) for f in fields if f in exams.columns], F.col("body"))
    where = writers.output_path([F.col("stage"), F.col("grade_label"), F.coalesce("subject", F.lit("未分"))], [F.col("year_roc"), F.col("semester"), F.col("test_type")], F.coalesce("sha256", F.lit("")))
    return writers.distinct_paths(exams.select("exam_id", where.alias("path"), doc.alias("text")), "path", "exam_id")


def relocated(exams: DataFrame, subjects: DataFrame) -> DataFrame:
    """exam_id, old_path, path, text: the documents whose subject was found later, at their new places with the subject and its origin in the frontmatter.

    subjects has exam_id, imputed, origin. Nothing is moved in place: a writer by folders replaces
    the old and the new ones.
    """
    found = subjects.where("imputed is not null and origin not in ('given', 'none')").select("exam_id", "imputed", "origin")
    t = exams.where("subject is null or trim(subject) = ''").dropDuplicates(["exam_id"]).join(found, "exam_id")
    old = exam_documents(t.drop("imputed", "origin")).select("exam_id", F.col("path").alias("old_path"))
    return exam_documents(t.withColumn("subject", stripped("imputed"))).join(old, "exam_id").select("exam_id", "old_path", "path", "text")


def reread(files: DataFrame, exams: DataFrame, reader: dict, least: int = 50) -> DataFrame:
    """exam_id, subject, reason: files of records with short bodies and no subject read again, by sight where the reader does so, and the subject voted on their text.

    files: what readers.files gives; reader: extractors by extension, readers.ocr for scanned ones.
    """
    short = exams.where(F.length(F.trim(F.coalesce("body", F.lit("")))) < least).where("subject is null or trim(subject) = ''").select("exam_id", F.col("original_path").alias("path"))
    got = readers.extracted(files.join(short.select("path").distinct(), "path", "left_semi"), reader)
    return short.join(got, "path").select("exam_id", voted_subject(F.col("text")).alias("subject"), "reason")


def renamed_originals(exams: DataFrame) -> DataFrame:
    """exam_id, original_path, fixed_path of the records whose file's path was read in a wrong encoding, part by part; the reference to it is patched alike."""
    fixed = path_from_latin1("original_path")
    return exams.select("exam_id", "original_path", fixed.alias("fixed_path")).where("fixed_path <> original_path").distinct()
