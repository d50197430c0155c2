"""Queries of reports, rewrites and checks of whole tables, each beside its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomleaf.functions import exams, text
from loomleaf.operators import analyze, quality
from loomleaf.plans import pipelines
from loomleaf.runtime import table
from loomleaf.sources import curricula, reports, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _one(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    return table(spark, d, name).dropDuplicates([key])


X = "x AS (SELECT DISTINCT ON (exam_id) * FROM exam_records)"


@query(
    """WITH c AS (SELECT domain, code, count(*) AS n FROM (SELECT DISTINCT ON (code_id) * FROM content_codes) WHERE code IS NOT NULL AND domain IS NOT NULL GROUP BY ALL),
w AS (SELECT code, sum(n)::BIGINT AS n, min(domain) AS domain FROM c GROUP BY code ORDER BY n DESC, code LIMIT 30),
d AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY n DESC, code) AS k FROM c WHERE domain IN ('數學', '英語文', '國語文', '社會', '自然科學'))
SELECT 'all' AS part, '## all' || chr(10) || chr(10) || string_agg('| ' || n || ' | `' || code || '` | ' || domain || ' |', chr(10) ORDER BY n DESC, code) AS report FROM w
UNION ALL SELECT domain, '## ' || domain || chr(10) || chr(10) || string_agg('| ' || n || ' | `' || code || '` |', chr(10) ORDER BY n DESC, code) FROM d WHERE k <= 10 GROUP BY domain"""
)
def report_frequencies(spark: SparkSession, d: str) -> DataFrame:
    c = _one(spark, d, "content_codes", "code_id").where("code is not null and domain is not null").groupBy("domain", "code").agg(F.count(F.lit(1)).alias("n"))
    return reports.frequency_report(c, ["數學", "英語文", "國語文", "社會", "自然科學"])


@query(
    f"""WITH {X}, t AS (SELECT coalesce(grade_label, '未分') AS grade, coalesce(subject, '未分') AS subject, count(*) AS n FROM x GROUP BY ALL), u AS (SELECT * FROM t UNION ALL SELECT grade, '總計', sum(n)::BIGINT FROM t GROUP BY grade)
SELECT CASE WHEN grade LIKE '%國小 1%' THEN 0 WHEN grade LIKE '%國小 2%' THEN 1 WHEN grade LIKE '%國小 3%' THEN 2 WHEN grade LIKE '%國小 4%' THEN 3 WHEN grade LIKE '%國小 5%' THEN 4 WHEN grade LIKE '%國小 6%' THEN 5
WHEN grade LIKE '%國中%' THEN 6 WHEN grade LIKE '%高中%' THEN 7 ELSE 9 END AS place, grade, subject, n FROM u"""
)
def exam_grade_table(spark: SparkSession, d: str) -> DataFrame:
    return reports.grade_table(_one(spark, d, "exam_records", "exam_id").select(F.col("grade_label").alias("grade"), "subject"))


@query(
    f"""WITH {X}, t AS (SELECT source, coalesce(grade_num::VARCHAR, '未分') AS grade, strlen(coalesce(body, '')) AS n FROM x) SELECT source, grade, count(*) AS n_documents, sum(n)::BIGINT AS n_bytes FROM t GROUP BY ALL"""
)
def exam_writes_planned(spark: SparkSession, d: str) -> DataFrame:
    """A dry run: what would be written of exam bodies, by source and grade."""
    t = _one(spark, d, "exam_records", "exam_id").select("source", F.coalesce(F.col("grade_num").cast("string"), F.lit("未分")).alias("grade"), F.coalesce("body", F.lit("")).alias("body"))
    return writers.planned(t, ["source", "grade"], "body")


@query(
    f"""WITH {X}, m AS (SELECT year, semester, grade, school, arg_min(subject, (-c, subject)) AS mode FROM (SELECT coalesce(year_roc, '?') AS year, coalesce(semester, '?') AS semester, coalesce(grade_num::VARCHAR, '?') AS grade, coalesce(school, '?') AS school, subject, count(*) AS c
FROM (SELECT * REPLACE (nullif(trim(subject, ' '), '') AS subject) FROM x) WHERE subject IS NOT NULL GROUP BY ALL) GROUP BY ALL),
t AS (SELECT exam_id, sha256, regexp_replace(coalesce(body, ''), '\\s|　', '', 'g') AS b, m.mode FROM x LEFT JOIN m ON m.year = coalesce(year_roc, '?') AND m.semester = coalesce(x.semester, '?') AND m.grade = coalesce(grade_num::VARCHAR, '?') AND m.school = coalesce(x.school, '?')
WHERE subject IS NULL OR trim(subject, ' ') = ''), u AS (SELECT *, coalesce(CASE WHEN regexp_matches(lower(b), '自然科|自然與生活科技|理化|物理科|化學科|生物科|地科') THEN '自然科學' WHEN regexp_matches(b, '健康與體育|體育科|健體|健康教育') THEN '健康與體育' WHEN regexp_matches(b, '國文|國語|國綜|國寫') THEN '國文'
WHEN regexp_matches(b, '英文|英語') THEN '英文' WHEN contains(b, '數學') THEN '數學' WHEN regexp_matches(b, '社會|歷史科|地理科|公民科') THEN '社會' END, mode) AS subject FROM t)
SELECT exam_id, regexp_replace(subject, '^[\\s　]+|[\\s　]+$', '', 'g') AS subject, left(coalesce(sha256, ''), 8) AS digest FROM u WHERE subject IS NOT NULL"""
)
def exam_relocated(spark: SparkSession, d: str) -> DataFrame:
    """Records whose subject was found later, with the subject in their new frontmatter and the digest in their new name."""
    e = _one(spark, d, "exam_records", "exam_id")
    t = pipelines.relocated(e, pipelines.impute_subjects(e))
    return t.select("exam_id", F.try_element_at(text.frontmatter("text"), F.lit("subject")).alias("subject"), F.regexp_extract("path", r"-([0-9a-f]*)(?:-\d+)?\.md$", 1).alias("digest"))


@query(
    f"""WITH {X}, t AS (SELECT exam_id, original_path, string_split(original_path, '/') AS p FROM x WHERE original_path IS NOT NULL), u AS (SELECT exam_id, original_path, list_filter(p, lambda s : regexp_matches(s, '[\\x{{80}}-\\x{{ff}}]{{3}}') AND NOT regexp_matches(s, '[^\\x{{00}}-\\x{{ff}}]')) AS odd FROM t)
SELECT exam_id, original_path FROM u WHERE len(list_filter(odd, lambda s : regexp_matches(s, '[\\x{{e3}}-\\x{{e9}}][\\x{{80}}-\\x{{bf}}][\\x{{80}}-\\x{{bf}}]'))) > 0"""
)
def exam_renamed_originals(spark: SparkSession, d: str) -> DataFrame:
    """Records whose file is to be renamed, as its path was read in a wrong encoding."""
    return pipelines.renamed_originals(_one(spark, d, "exam_records", "exam_id")).select("exam_id", "original_path")


@query(
    """WITH e AS (SELECT DISTINCT ON (edge_id) * FROM edges), b AS (SELECT DISTINCT coalesce(nullif(src, ''), '?') || ' ' || coalesce(nullif(dst, ''), '?') AS entity, CASE WHEN coalesce(src, '') = '' THEN 'src' ELSE 'dst' END AS detail FROM e WHERE coalesce(src, '') = '' OR coalesce(dst, '') = ''),
k AS (SELECT *, row_number() OVER (ORDER BY entity, detail) AS n FROM b) SELECT entity, detail FROM k WHERE n <= 20"""
)
def edge_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty findings on ends of edges that are missing, as a report shows them."""
    e = _one(spark, d, "edges", "edge_id")
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    entity = F.concat_ws(" ", F.coalesce(F.nullif("src", F.lit("")), F.lit("?")), F.coalesce(F.nullif("dst", F.lit("")), F.lit("?")))
    found = quality.finding(e, entity, blank(F.col("src")) | blank(F.col("dst")), "ends", "fail", F.when(blank(F.col("src")), "src").otherwise("dst")).distinct()
    return quality.samples(found, 20).select("entity", "detail")


@query("SELECT domain, CASE WHEN domain = '數學' THEN '數學領域課程綱要' WHEN domain = '社會' THEN '社會領域課程綱要' WHEN domain = '科技' THEN '科技領域課程綱要' END AS name, count(*) AS n_files FROM (SELECT DISTINCT ON (file_id) * FROM structured) WHERE domain IN ('數學', '社會', '科技') GROUP BY ALL")
def catalog_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the catalog with the numbers of parsed files of their domain."""
    c = curricula.curricula(spark).where("kind = 'document' and domain in ('數學', '社會', '科技')").select("domain", "name")
    n = _one(spark, d, "structured", "file_id").groupBy("domain").agg(F.count(F.lit(1)).alias("n_files"))
    return n.join(F.broadcast(c), "domain").select("domain", "name", "n_files")


@query(
    """WITH t AS (SELECT DISTINCT source_file FROM structured WHERE source_file IS NOT NULL), u AS (SELECT source_file, string_split(source_file, '/')[-1] AS n FROM t)
SELECT source_file, coalesce(nullif(regexp_extract(n, '(\\d{2,3})學(?:年|測)', 1), ''), 'unknown') AS year, regexp_replace(coalesce(nullif(regexp_extract(n, '(?:學年|學測)\\D*?(?:試卷|測驗)?\\D*?([一-鿿]+[A-Za-z]?)(?:試卷|試題|答案|\\.pdf)', 1), ''), nullif(regexp_extract(n, '([一-鿿]+[A-Za-z]?)', 1), ''), 'unknown'), '(?:試卷|試題|答案)$', '') AS subject FROM u"""
)
def file_link_subjects(spark: SparkSession, d: str) -> DataFrame:
    """The year and the subject that every file's address tells."""
    t = table(spark, d, "structured").where("source_file is not null").select("source_file").distinct()
    return t.select("source_file", exams.link_year_subject(F.col("source_file")).alias("x")).select("source_file", "x.year", "x.subject")


@query(
    """WITH b AS (SELECT DISTINCT ON (textbook_id) * FROM textbooks), n AS (SELECT DISTINCT ON (node_row) * FROM nodes) SELECT domain, count(*) FILTER (WHERE k = 'b') AS n_books, count(*) FILTER (WHERE k = 'n') AS n_nodes
FROM (SELECT domain, 'b' AS k FROM b UNION ALL SELECT domain, 'n' FROM n) WHERE domain BETWEEN '健' AND '自' GROUP BY domain"""
)
def domain_range(spark: SparkSession, d: str) -> DataFrame:
    """Textbooks and nodes of a range of domains."""
    both = _one(spark, d, "textbooks", "textbook_id").select("domain", F.lit("b").alias("k")).unionByName(_one(spark, d, "nodes", "node_row").select("domain", F.lit("n").alias("k")))
    return analyze.in_range(both, "domain", "健", "自").groupBy("domain").agg(F.count_if(F.col("k") == "b").alias("n_books"), F.count_if(F.col("k") == "n").alias("n_nodes"))
