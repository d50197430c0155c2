"""Quality checks: each gives findings as rows (entity, check, severity, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomleaf.functions.text import ACCENTED_CODE_IN_TEXT, CODE_IN_TEXT, STAGES
from loomleaf.runtime import union_all


def finding(df: DataFrame, entity: Column, when: Column, check: str, severity: str, detail: Column) -> DataFrame:
    return df.where(F.coalesce(when, F.lit(False))).select(entity.cast("string").alias("entity"), F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.cast("string").alias("detail"))


def first_failure(df: DataFrame, entity: Column, checks: list[tuple[str, Column, Column]], severity: str = "fail") -> DataFrame:
    """The first of the checks that each row fails, in the order given."""
    hit = F.coalesce(*[F.when(F.coalesce(w, F.lit(False)), F.struct(F.lit(name).alias("check"), d.cast("string").alias("detail"))) for name, w, d in checks])
    return df.select(entity.cast("string").alias("entity"), hit.alias("h")).where("h is not null").select("entity", "h.check", F.lit(severity).alias("severity"), "h.detail")


def missing_fields(df: DataFrame, entity: str, required: list[str]) -> DataFrame:
    """entity, missing: the required fields that are null or empty, as a sorted list; rows that lack none are left out."""
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in required]))
    return df.select(F.col(entity).cast("string").alias("entity"), F.array_join(F.array_sort(lacking), ",").alias("missing")).where("missing <> ''")


def structured_checks(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Findings over parsed files: version, type, text, counts and stages; file_findings has all checks."""
    f = files.dropDuplicates(["file_id"])
    e = F.col("file_id")
    parts = [
        finding(f, e, F.coalesce(F.col("schema_version"), F.lit("")) != "1.0", "version", "fail", F.col("schema_version")),
        finding(f, e, ~F.coalesce(F.col("structure_type"), F.lit("")).isin("A", "B", "none"), "structure_type", "fail", F.col("structure_type")),
        finding(f, e, F.coalesce(F.col("raw_section_5"), F.lit("")) == "", "raw_section", "fail", F.lit(None)),
        finding(f, e, F.coalesce(F.col("section_5_title"), F.lit("")) == "", "section_title", "warn", F.lit(None)),
        finding(f, e, F.col("performance_count") != F.coalesce(F.size("performance_codes"), F.lit(0)), "performance_count", "fail", F.col("performance_count")),
        finding(f, e, F.size(F.array_except("stages_present", F.array(*[F.lit(s) for s in STAGES]))) > 0, "stages_present", "fail", F.array_join("stages_present", ",")),
    ]
    n = contents.select("file_id", "code_id").distinct().groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
    counted = f.select("file_id", "content_count").join(n, "file_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    parts.append(finding(counted, e, F.col("content_count") != F.col("n"), "content_count", "fail", F.col("n")))
    return union_all(parts)


def codes_not_in_text(files: DataFrame) -> DataFrame:
    """file_id, code: performance codes that can't be extracted again from the file's text."""
    again = F.regexp_extract_all(F.coalesce("raw_section_5", F.lit("")), F.lit(CODE_IN_TEXT), 1)
    lost = F.array_except(F.transform("performance_codes", lambda c: c["code"]), again)
    return files.select("file_id", F.explode(lost).alias("code")).where("code is not null").distinct()


def codes_lost(files: DataFrame, contents: DataFrame) -> DataFrame:
    """file_id, kind, code: performance and content codes that can't be extracted again from the file's text, the mathematics pattern included."""
    raw = F.coalesce("raw_section_5", F.lit(""))
    # neighbours around one separator: each needs it
    again = F.concat(*[F.regexp_extract_all(raw, F.lit(p), 1) for p in (CODE_IN_TEXT, ACCENTED_CODE_IN_TEXT, "(?<![A-Za-z0-9])([A-Z]-[1-5]-[0-9]+)(?![A-Za-z0-9])")])
    held = files.select("file_id", F.explode(F.array_distinct(again)).alias("code"))
    performance = files.select("file_id", F.lit("performance").alias("kind"), F.explode(F.transform("performance_codes", lambda c: c["code"])).alias("code"))
    content = contents.select("file_id", F.lit("content").alias("kind"), "code").join(files.select("file_id").distinct(), "file_id", "left_semi")
    return performance.unionByName(content).where("code <> ''").distinct().join(held, ["file_id", "code"], "left_anti").select("file_id", "kind", "code")


FRONTMATTER = ("title", "domain", "source", "source_url", "published_date")
CODE_FIELDS = ("code", "stage", "category", "ordinal", "code_format")
TYPES = ("A", "B", "none", "unknown")
#: Least numbers of performance and content codes by a word of the file's name, else by its folder.
LEAST_CODES = {
    "數學": (80, 100), "國語文": (80, 100), "英語文": (150, 80), "第二外國語文": (100, 80), "閩南語文": (30, 50), "客家語文": (30, 50), "原住民族語文": (30, 50), "新住民語文": (30, 50), "臺灣手語": (30, 50),
    "閩東語文": (30, 50), "自然科學": (50, 200), "社會": (80, 400), "藝術": (50, 40), "健康與體育": (150, 200), "生活課程": (20, 15), "綜合活動": (30, 100), "科技": (30, 50), "全民國防教育": (15, 15),
}


def file_findings(files: DataFrame, contents: DataFrame) -> DataFrame:
    """All findings over parsed files. One with an unknown type gets no checks past that, one without codes only that its counts are 0."""
    f, c = files.dropDuplicates(["file_id"]), contents.dropDuplicates(["code_id"])
    e, blank = F.col("file_id"), lambda x: F.coalesce(x.cast("string"), F.lit("")) == ""
    known = F.coalesce(F.col("structure_type").isin(*TYPES), F.lit(False))
    none = F.coalesce("no_codes", F.lit(False))
    parts = [finding(f, e, F.coalesce("schema_version", F.lit("")) != "1.0", "version", "fail", F.col("schema_version"))]
    parts.append(f.select(e.cast("string").alias("entity"), F.lit("frontmatter").alias("check"), F.lit("fail").alias("severity"), F.explode(F.array_compact(F.array(*[F.when(blank(F.col(f"frontmatter.{k}")), F.lit(k)) for k in FRONTMATTER]))).alias("detail")))
    parts.append(finding(f, e, ~known, "structure_type", "fail", F.col("structure_type")))
    counts = ("performance_count", "content_count")
    parts += [finding(f, e, known & none & ~F.col(k).eqNullSafe(0), f"no_codes_{k}", "warn", F.col(k)) for k in counts]
    g = f.where(known & ~none)
    c = c.join(g.select("file_id"), "file_id", "left_semi")
    perf = F.coalesce(F.size("performance_codes"), F.lit(0))
    n = g.join(c.groupBy("file_id").agg(F.count(F.lit(1)).alias("n")), "file_id", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "n_perf": F.when(F.col("performance_codes").isNull(), 0).otherwise(perf)})
    stem, folder = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.md$", ""), F.try_element_at(F.split("source_file", "/"), F.lit(-2))
    rule = F.coalesce(*[F.when(F.contains(stem, F.lit(k)), F.struct(F.lit(a).alias("p"), F.lit(b).alias("c"))) for k, (a, b) in LEAST_CODES.items()], *[F.when(folder == k, F.struct(F.lit(a).alias("p"), F.lit(b).alias("c"))) for k, (a, b) in LEAST_CODES.items()])
    n = n.withColumn("rule", rule)
    parts += [
        finding(g, e, blank(F.col("section_5_title")), "section_title", "warn", F.lit(None)),
        finding(g, e, blank(F.col("raw_section_5")), "raw_section", "fail", F.lit(None)),
        finding(g, e, F.col("performance_codes").isNull(), "performance_codes", "fail", F.lit(None)),
        finding(n, e, ~F.col("performance_count").eqNullSafe(F.col("n_perf")), "performance_count", "fail", F.col("n_perf")),
        finding(n, e, ~F.col("content_count").eqNullSafe(F.col("n")), "content_count", "fail", F.col("n")),
        finding(n, e, F.col("n_perf") < F.col("rule.p"), "least_performance", "warn", F.col("n_perf")),
        finding(n, e, F.col("n") < F.col("rule.c"), "least_content", "warn", F.col("n")),
        finding(g, e, F.size(F.array_except("stages_present", F.array(*[F.lit(s) for s in STAGES]))) > 0, "stages_present", "fail", F.array_join("stages_present", ",")),
    ]
    codes = g.select("file_id", F.lit("performance").alias("kind"), F.posexplode("performance_codes").alias("idx", "x")).select("file_id", "kind", "idx", *[F.col(f"x.{k}").alias(k) for k in CODE_FIELDS])
    codes = codes.unionByName(c.select("file_id", F.lit("content").alias("kind"), "idx", *CODE_FIELDS))
    stages = codes.where((F.col("stage") != "") & ~F.col("stage").isin(*STAGES)).groupBy("file_id").agg(F.array_join(F.array_sort(F.collect_set("stage")), ",").alias("stages"))
    parts.append(finding(stages, e, F.lit(True), "code_stages", "fail", F.col("stages")))
    lacking = F.array_join(F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in CODE_FIELDS])), ",")
    parts.append(finding(codes.withColumn("lacking", lacking), e, F.col("lacking") != "", "code_fields", "fail", F.concat("kind", F.lit(" "), F.coalesce(F.col("idx").cast("string"), F.lit("?")), F.lit(" "), "lacking")))
    parts.append(finding(codes_lost(g.where("raw_section_5 <> ''"), c), e, F.lit(True), "round_trip", "fail", F.concat("kind", F.lit(" "), "code")))
    return union_all(parts)


def exam_checks(exams: DataFrame) -> DataFrame:
    """The first failure of each exam record: source, name, hash, body."""
    t = exams.dropDuplicates(["exam_id"])
    return first_failure(
        t,
        F.col("exam_id"),
        [
            ("source", F.coalesce(F.col("source"), F.lit("")) == "", F.lit(None)),
            ("original_filename", F.coalesce(F.col("original_filename"), F.lit("")) == "", F.lit(None)),
            ("sha256", ~F.coalesce(F.col("sha256"), F.lit("")).rlike("^[0-9a-f]{64}$"), F.col("sha256")),
            ("body", F.length(F.trim(F.coalesce("body", F.lit("")))) < 10, F.length(F.trim(F.coalesce("body", F.lit(""))))),
        ],
    )


def record_findings(exams: DataFrame, required: tuple[str, ...], sources: tuple[str, ...], places: str, originals: DataFrame | None = None) -> DataFrame:
    """Findings over exam records: the first failure of each (required fields, original there, hash, body), and warnings for records without one.

    sources are the known ones; places is a pattern of proper paths; originals has path and
    sha256 of the files that are there, without it only the form of the hash is checked.
    Records of a source without a test and with a coded name get a warning too.
    """
    t = exams.dropDuplicates(["exam_id"])
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    lacking = F.array_join(F.array_compact(F.array(*[F.when(blank(c), F.lit(c)) for c in required])), ",")
    n = F.length(F.trim(F.coalesce("body", F.lit(""))))
    checks = [("required_fields", lacking != "", lacking)]
    if originals is not None:
        there = originals.select(F.col("path").alias("_there"), F.col("sha256").alias("_sha")).dropDuplicates(["_there"])
        t = t.join(there, F.col("original_path") == F.col("_there"), "left")
        checks += [("original_exists", F.col("_there").isNull(), F.col("original_path")), ("sha256", ~F.col("sha256").eqNullSafe(F.col("_sha")), F.col("_sha"))]
    else:
        checks.append(("sha256", ~F.coalesce("sha256", F.lit("")).rlike("^[0-9a-f]{64}$"), F.col("sha256")))
    checks.append(("body_empty", n < 10, n))
    bad = F.lit(False)
    for _, w, _d in checks:
        bad = bad | F.coalesce(w, F.lit(False))
    good = t.where(~bad)
    coded = F.coalesce("original_filename", F.lit("")).rlike(r"^\d[A-Z]\d{5}[A-Z]?\.")
    return union_all(
        [
            first_failure(t, F.col("exam_id"), checks),
            finding(good, F.col("exam_id"), ~F.col("source").isin(*sources), "source_invalid", "warn", F.col("source")),
            finding(good, F.col("exam_id"), coded & (F.col("source") == "ddes") & blank("test_type"), "coded_test_type", "warn", F.col("original_filename")),
            finding(good, F.col("exam_id"), ~F.col("original_path").rlike(places), "dir_structure", "warn", F.col("original_path")),
        ]
    )


def samples(findings: DataFrame, most: int = 20) -> DataFrame:
    """The first findings of each check, by severity, check and entity: what a report prints; the rest stays in findings."""
    first = Window.partitionBy("severity", "check", F.pmod(F.xxhash64("entity"), F.lit(64))).orderBy("entity", "detail")
    few = findings.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most)
    last = Window.partitionBy("severity", "check").orderBy("entity", "detail")
    return few.withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= most).drop("_n")


def failure_reasons(log: DataFrame, reason: str, known: list[str]) -> DataFrame:
    """reason (what stands before the first colon), n, known."""
    r = F.trim(F.substring_index(reason, ":", 1))
    return log.where(F.col(reason).isNotNull()).groupBy(r.alias("reason")).agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.col("reason").isin(*known))


def status(findings: DataFrame, strict: bool = False) -> DataFrame:
    """One row: n_fail, n_warn, code (0 good, 1 failures, or warnings where strict)."""
    s = findings.agg(F.count_if(F.col("severity") == "fail").alias("n_fail"), F.count_if(F.col("severity") == "warn").alias("n_warn"))
    bad = (F.col("n_fail") > 0) | (F.lit(strict) & (F.col("n_warn") > 0))
    return s.withColumn("code", F.when(bad, 1).otherwise(0))
