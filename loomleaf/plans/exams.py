"""Queries of the full classifiers of exam files, each beside an SQL twin with values of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomleaf.functions import exams, rules, text
from loomleaf.operators import quality
from loomleaf.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _exams(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "exam_records").dropDuplicates(["exam_id"])


X = "x AS (SELECT DISTINCT ON (exam_id) * FROM exam_records)"


def _first(of: str, words: list[tuple[str, str]]) -> str:
    """SQL: the label of the first pattern that is found."""
    return "CASE " + " ".join(f"WHEN regexp_matches({of}, '{p}') THEN '{label}'" for label, p in words) + " END"


@query(
    f"""WITH {X}, t AS (SELECT exam_id, original_path AS path, string_split(original_path, '/')[-1] AS filename, size, lower(original_path) AS low FROM x WHERE original_path IS NOT NULL), u AS (
SELECT *, CASE WHEN contains(path, 'melances') THEN '米蘭老師 Drive' WHEN contains(path, 'ddes') THEN '大墩國小 ddes.tc.edu.tw' WHEN contains(path, 'studyark') THEN '學習方舟 studyark.org'
WHEN string_split(path, '/')[-2] IS NOT DISTINCT FROM 'exams' AND regexp_matches(filename, '^\\d{{2,3}}[-_].+\\.(pdf|docx)$') AND NOT contains(filename, 'text') THEN 'CEEC 大考中心（高中試題）'
WHEN contains(path, 'text') AND regexp_matches(filename, '\\.txt$') THEN 'CEEC 純文字 (pdftotext 轉檔)' ELSE '其他' END AS source, nullif(regexp_extract(low, 'grade(\\d+)', 1), '')::INTEGER AS g FROM t)
SELECT exam_id, path, filename, size, lower(regexp_extract(filename, '[^.]\\.([^.]+)$', 1)) AS ext, nullif(regexp_extract(filename, '^(\\d{{2,3}})[-_]', 1), '') AS year_roc,
CASE WHEN source LIKE 'CEEC 大考%' THEN '高中' WHEN g BETWEEN 1 AND 6 THEN '國小' WHEN g BETWEEN 7 AND 9 THEN '國中' WHEN g = 10 THEN '高中'
ELSE {_first("low", [("國小", "grade[1-6]|國小[1-6一二三四五六]|[一二三四五六]年級|上學期|下學期|期中考|期末考"), ("國中", "grade[7-9]|國中[7-9]|[七八九]年級"), ("高中", "學測|分科|指考|GSAT|grade10")])} END AS stage,
CASE WHEN source LIKE 'CEEC 大考%' THEN '高中' WHEN g BETWEEN 1 AND 6 THEN '國小 ' || g || ' 年級' WHEN g BETWEEN 7 AND 9 THEN '國中 ' || (g - 6) || ' 年級' WHEN g = 10 THEN '高中 1 年級' END AS grade,
coalesce(map {{'C':'國文','M':'數學','S':'社會','N':'自然科學','H':'健康與體育','E':'英文','A':'自然科學'}}[regexp_extract(filename, '^\\d([A-Z])', 1)],
{_first("filename", [("國文", "國文|國語|國綜|國寫"), ("英文", "英文|英語|english"), ("數學", "數學|數甲|數乙|數a|數b"), ("自然科學", "自然|理化|物理|化學|生物|地科|地球科學"), ("社會", "社會|歷史|地理|公民"), ("生活", "生活"), ("健康與體育", "健康|體育|健體")])}) AS subject,
list_filter(['南一', '康軒', '翰林', '何嘉仁', '龍騰', '泰宇', '全華', '五南', '旗立', '佳音'], lambda v : contains(filename, v))[1] AS version,
CASE WHEN contains(path, '期中考') THEN '期中考' WHEN contains(path, '期末考') THEN '期末考' WHEN contains(path, '段考') THEN '段考' WHEN regexp_matches(filename, '第一次|(?i:1st)') THEN '第一次段考' WHEN regexp_matches(filename, '第二次|(?i:2nd)') THEN '第二次段考'
WHEN regexp_matches(filename, '第三次|(?i:3rd)') THEN '第三次段考' END AS test_type, CASE WHEN contains(path, '上學期') THEN '上學期' WHEN contains(path, '下學期') THEN '下學期' END AS semester, source,
coalesce(nullif(regexp_extract(filename, '市立[一-鿿]{{1,5}}(國小|國中|高中)'), ''), nullif(regexp_extract(filename, '[一-鿿]{{2,5}}(國小|國中|高中)'), '')) AS school FROM u"""
)
def exam_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of exam files: 13 columns from path, name and size."""
    t = _exams(spark, d).where("original_path is not null")
    return t.select("exam_id", *exams.index_fields(F.col("original_path"), F.col("size")))


@query(
    f"""WITH {X}, t AS (SELECT exam_id, original_path AS path, string_split(original_path, '/')[-1] AS n FROM x WHERE original_path IS NOT NULL), u AS (
SELECT *, regexp_extract(n, '^(\\d)([A-Z])(\\d{{3}})(\\d)(\\d)([A-Z]?)\\.(doc|docx|pdf)$', ['g', 'l', 'y', 't', 'k', 'v']) AS c, regexp_matches(n, '^\\d[A-Z]\\d{{5}}[A-Z]?\\.(doc|docx|pdf)$') AS coded FROM t)
SELECT exam_id, CASE WHEN coded THEN try_cast(c.g AS INTEGER) END AS coded_grade, CASE WHEN coded THEN coalesce(map {{'C':'國文','M':'數學','S':'社會','N':'自然科學','H':'健康與體育','E':'英文','A':'自然科學'}}[c.l], '?') END AS coded_subject, CASE WHEN coded THEN c.y END AS coded_year,
CASE WHEN coded THEN CASE c.t WHEN '1' THEN '上學期' ELSE '下學期' END END AS coded_semester, CASE WHEN coded THEN CASE c.k WHEN '1' THEN '期中考' ELSE '期末考' END END AS coded_test, CASE WHEN coded THEN nullif(c.v, '') END AS coded_variant,
nullif(regexp_extract(path, 'grade(\\d+)', 1), '')::INTEGER AS path_grade, list_filter(string_split(path, '/'), lambda p : p IN ('上學期', '下學期'))[-1] AS path_semester,
list_filter(string_split(path, '/'), lambda p : p IN ('期中考', '期末考', '第一次段考', '第二次段考', '第三次段考'))[-1] AS path_test, nullif(regexp_extract(n, '10[89]|11[0-5]'), '') AS path_year,
coalesce({_first("n", [("國文", "國文"), ("英文", "英文"), ("數學", "數學"), ("社會", "社會"), ("自然科學", "自然"), ("生活", "生活"), ("健康與體育", "健康與體育")])}, CASE WHEN contains(lower(path), '/math') OR contains(lower(n), 'math') THEN '數學' WHEN contains(lower(path), '/english') OR contains(lower(n), 'eng') THEN '英文' END) AS path_subject FROM u"""
)
def exam_names(spark: SparkSession, d: str) -> DataFrame:
    """What the coded name and the path of every file tell, each by itself."""
    t = _exams(spark, d).where("original_path is not null")
    t = t.select("exam_id", rules.coded_name(exams.file_name(F.col("original_path"))).alias("c"), exams.path_record(F.col("original_path")).alias("p"))
    return t.select(
        "exam_id", *[F.col(f"c.{a}").alias(f"coded_{b}") for a, b in (("grade", "grade"), ("subject", "subject"), ("year_roc", "year"), ("semester", "semester"), ("test_type", "test"), ("variant", "variant"))],
        *[F.col(f"p.{a}").alias(f"path_{b}") for a, b in (("grade_num", "grade"), ("semester", "semester"), ("test_type", "test"), ("year_roc", "year"), ("subject", "subject"))],
    )  # fmt: skip


@query(
    f"""WITH {X}, k AS (SELECT exam_id, CASE WHEN exam_id % 4 = 0 THEN 'exams/ddes/' || original_filename WHEN exam_id % 4 = 1 THEN replace(original_path, 'exams/', 'exams/melances/') WHEN exam_id % 4 = 2 THEN 'exams/' || coalesce(year_roc, '99') || '-' || subject || '試題定稿.pdf' ELSE original_path END AS path FROM x), t AS (
SELECT exam_id, path, string_split(path, '/')[-1] AS n FROM k WHERE path IS NOT NULL), u AS (
SELECT *, CASE WHEN contains(path, 'ddes') THEN CASE WHEN regexp_matches(n, '^\\d[A-Z]\\d{{5}}[A-Z]?\\.(doc|docx|pdf)$') THEN 'ddes' ELSE 'ddes-未解析' END WHEN contains(path, 'melances') THEN 'melances'
WHEN string_split(path, '/')[-2] IS NOT DISTINCT FROM 'exams' AND regexp_matches(n, '^\\d{{2,3}}[-_].+\\.(pdf|docx)$') THEN 'CEEC' ELSE '其他' END AS source FROM t)
SELECT exam_id, source, CASE source WHEN 'melances' THEN '不明（米蘭老師 Drive，無明確授權 — 僅作 metadata 參考，不對外散佈）' WHEN 'ddes' THEN '教育部公開資料' WHEN 'CEEC' THEN 'CEEC 大考中心（依官方授權）' ELSE '不明' END AS license, CASE WHEN source = 'ddes' THEN '大墩國小' END AS school,
CASE source WHEN 'ddes' THEN n[3:5] WHEN 'melances' THEN nullif(regexp_extract(n, '10[89]|11[0-5]'), '') WHEN 'CEEC' THEN regexp_extract(n, '^(\\d{{2,3}})', 1) END AS year_roc,
CASE WHEN source = 'CEEC' THEN '高中' WHEN source = 'ddes' THEN CASE WHEN n[1]::INTEGER <= 6 THEN '國小' ELSE '國中' END WHEN source = 'melances' THEN CASE WHEN regexp_extract(path, 'grade(\\d+)', 1) = '' THEN NULL WHEN regexp_extract(path, 'grade(\\d+)', 1)::INTEGER <= 6 THEN '國小' WHEN regexp_extract(path, 'grade(\\d+)', 1)::INTEGER <= 9 THEN '國中' ELSE '高中' END END AS stage FROM u"""
)
def exam_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Every record's file put at the place of one of four kinds of sources, and classified by it."""
    k = F.col("exam_id") % 4
    path = F.when(k == 0, F.concat(F.lit("exams/ddes/"), "original_filename")).when(k == 1, F.replace("original_path", F.lit("exams/"), F.lit("exams/melances/")))
    path = path.when(k == 2, F.concat(F.lit("exams/"), F.coalesce("year_roc", F.lit("99")), F.lit("-"), "subject", F.lit("試題定稿.pdf"))).otherwise(F.col("original_path"))
    t = _exams(spark, d).select("exam_id", path.alias("_path")).where("_path is not null")
    return t.select("exam_id", *exams.record_fields(F.col("_path"))).select("exam_id", "source", "license", "school", "year_roc", "stage")


@query(
    f"""WITH {X}, t AS (SELECT exam_id, regexp_replace(body, '\\s|　', '', 'g') AS b FROM x WHERE body IS NOT NULL), v AS (SELECT exam_id, b, unnest([
{{'p': 1, 'label': '國文', 'n': len(regexp_extract_all(b, '國文科')) + len(regexp_extract_all(b, '國語文')) + len(regexp_extract_all(b, '國語科')) + len(regexp_extract_all(b, '國文')) + len(regexp_extract_all(b, '國語')) + len(regexp_extract_all(b, '國綜')) + len(regexp_extract_all(b, '國寫')) + len(regexp_extract_all(b, '語文領域'))}},
{{'p': 2, 'label': '英文', 'n': len(regexp_extract_all(b, '英文科')) + len(regexp_extract_all(b, '英語科')) + len(regexp_extract_all(b, '英文')) + len(regexp_extract_all(b, '英語')) + len(regexp_extract_all(b, 'English'))}},
{{'p': 3, 'label': '數學', 'n': len(regexp_extract_all(b, '數學科')) + len(regexp_extract_all(b, '數學')) + len(regexp_extract_all(b, '數'))}},
{{'p': 4, 'label': '自然科學', 'n': len(regexp_extract_all(b, '自然科')) + len(regexp_extract_all(b, '自然科學')) + len(regexp_extract_all(b, '自然與生活科技')) + len(regexp_extract_all(b, '理化')) + len(regexp_extract_all(b, '物理科|化學科')) + len(regexp_extract_all(b, '生物科')) + len(regexp_extract_all(b, '地科')) + len(regexp_extract_all(b, '自然科學領域')) + len(regexp_extract_all(b, '自然'))}},
{{'p': 5, 'label': '社會', 'n': len(regexp_extract_all(b, '社會科')) + len(regexp_extract_all(b, '社會')) + len(regexp_extract_all(b, '歷史科|地理科|公民科')) + len(regexp_extract_all(b, '社會領域'))}},
{{'p': 6, 'label': '健康與體育', 'n': len(regexp_extract_all(b, '健康與體育')) + len(regexp_extract_all(b, '體育科')) + len(regexp_extract_all(b, '健體')) + len(regexp_extract_all(b, '健康教育')) + len(regexp_extract_all(b, '體育')) + len(regexp_extract_all(b, '健康'))}},
{{'p': 7, 'label': '綜合活動', 'n': len(regexp_extract_all(b, '綜合活動')) + len(regexp_extract_all(b, '綜合活動領域'))}},
{{'p': 8, 'label': '藝術', 'n': len(regexp_extract_all(b, '表演藝術')) + len(regexp_extract_all(b, '視覺藝術')) + len(regexp_extract_all(b, '藝術|音樂|美術'))}},
{{'p': 9, 'label': '科技', 'n': len(regexp_extract_all(b, '科技')) + len(regexp_extract_all(b, '資訊')) + len(regexp_extract_all(b, '生活科技'))}}]) AS w FROM t)
SELECT exam_id, {_first("any_value(b)", [("自然科學", "自然科|自然與生活科技|理化|物理科|化學科|生物科|地科"), ("健康與體育", "健康與體育|體育科|健體|健康教育"), ("國文", "國文|國語|國綜|國寫"), ("英文", "英文|英語"), ("數學", "數學"), ("社會", "社會|歷史科|地理科|公民科")])} AS first_subject,
coalesce({_first("any_value(b)", [("國文", "國文科|國語科|語文領域"), ("英文", "英文科|英語科|English"), ("數學", "數學科|數學領域"), ("自然科學", "自然科|自然與生活科技"), ("社會", "社會科|社會領域"), ("健康與體育", "健體|健康與體育|體育科"), ("綜合活動", "綜合活動")])},
CASE WHEN max(w.n) >= 2 THEN arg_max(w.label, w.n * 100 - w.p) END) AS voted_subject FROM v GROUP BY exam_id"""
)
def exam_subjects(spark: SparkSession, d: str) -> DataFrame:
    """The subject that a body tells, by the first word and by vote."""
    return _exams(spark, d).where("body is not null").select("exam_id", exams.subject_of_body(F.col("body")).alias("first_subject"), exams.voted_subject(F.col("body")).alias("voted_subject"))


@query(
    f"""WITH {X}, t AS (SELECT exam_id, string_split_regex(replace(original_filename, '.txt', ''), '[-_]') AS p FROM x WHERE original_filename IS NOT NULL), u AS (SELECT exam_id, lower(coalesce(p[2], p[1])) AS s FROM t)
SELECT exam_id, {_first("s", [("數學", "數學|math"), ("英語文", "英文|eng"), ("國語文", "國文|國綜|國寫|chinese"), ("社會", "社會|歷史|地理|公民"), ("自然科學", "自然|理化|物理|化學|生物|地科")])} AS domain FROM u"""
)
def exam_domains(spark: SparkSession, d: str) -> DataFrame:
    return _exams(spark, d).where("original_filename is not null").select("exam_id", exams.domain_of_name(F.col("original_filename"), rules.DOMAIN_BY_NAME).alias("domain"))


@query(
    r"""WITH s AS (SELECT DISTINCT ON (file_id) * FROM structured), t AS (SELECT file_id, string_split(raw_section_5, chr(10)) AS l FROM s WHERE raw_section_5 IS NOT NULL), u AS (
SELECT file_id, l, list_filter(range(1, len(l) + 1), lambda i : regexp_matches(l[i], '^[ 	　]*伍、[ 	　]*(學習重點|學習階段)') AND NOT regexp_matches(l[i], '(學習重點|學習階段)[ .…·]*[.…]{3}'))[1] AS i FROM t), v AS (
SELECT *, list_filter(range(i + 1, len(l) + 1), lambda j : regexp_matches(l[j], '^[ 　	]*陸、') AND NOT regexp_matches(l[j], '[.…]{3}'))[1] AS j FROM u)
SELECT file_id, regexp_extract(l[i], '伍、[ 	　]*(學習重點|學習階段)') AS title, md5(regexp_replace(array_to_string(l[i:coalesce(j - 1, len(l))], chr(10)), '^[\s　]+|[\s　]+$', '', 'g')) AS section FROM v WHERE i IS NOT NULL"""
)
def text_sections(spark: SparkSession, d: str) -> DataFrame:
    """The title and the text (as its digest) of every file's fifth section."""
    t = table(spark, d, "structured").dropDuplicates(["file_id"]).where("raw_section_5 is not null")
    return t.select("file_id", text.section_title("raw_section_5").alias("title"), F.md5(text.section("raw_section_5")).alias("section")).where("title <> ''")


REQUIRED = ("source", "original_path", "sha256", "size")


@query(
    f"""WITH {X}, t AS (SELECT *, CASE WHEN coalesce(source, '') = '' OR coalesce(original_path, '') = '' OR coalesce(sha256, '') = '' OR size IS NULL THEN 'required_fields' WHEN NOT regexp_matches(sha256, '^[0-9a-f]{{64}}$') THEN 'sha256'
WHEN length(trim(coalesce(body, ''), ' ')) < 10 THEN 'body_empty' END AS fail FROM x)
SELECT exam_id, 'fail' AS severity, fail AS "check" FROM t WHERE fail IS NOT NULL UNION ALL SELECT exam_id, 'warn', 'source_invalid' FROM t WHERE fail IS NULL AND source NOT IN ('drive_collection', 'school_site', 'wiki_site')
UNION ALL SELECT exam_id, 'warn', 'dir_structure' FROM t WHERE fail IS NULL AND NOT regexp_matches(original_path, '^exams/[^/]+/grade[0-9]+/[^/]+$')"""
)
def exam_record_checks(spark: SparkSession, d: str) -> DataFrame:
    """The first failure of every record, and the warnings of records without one."""
    f = quality.record_findings(_exams(spark, d), REQUIRED, ("drive_collection", "school_site", "wiki_site"), "^exams/[^/]+/grade[0-9]+/[^/]+$")
    return f.select(F.col("entity").cast("bigint").alias("exam_id"), "severity", "check")
