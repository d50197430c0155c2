"""Reports as markdown text columns, built from aggregates: a row per report, with a line for each row of the aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def lines(df: DataFrame, by: list[str], line: Column, order: Column, name: str, most: int | None = None) -> DataFrame:
    """by, name: the lines of each group in their order, one under the other; all of them, or the first `most`."""
    from loomleaf.operators.analyze import top

    t = df.select(*by, line.alias("_line"), order.alias("_order"))
    if most is not None:
        t = top(t, most, [F.col("_order"), F.col("_line")], by)
    return t.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_order", "_line"))), lambda x: x["_line"]), "\n").alias(name))


def graph_report(summary: DataFrame, categories: DataFrame) -> DataFrame:
    """domain, report: counts of a domain's graph and its ten largest categories."""
    rows = lines(categories, ["domain"], F.concat(F.lit("| "), F.coalesce("category", F.lit("—")), F.lit(" | "), F.col("n").cast("string"), F.lit(" |")), -F.col("n"), "rows", 10)
    text = F.concat(
        F.lit("# "), "domain", F.lit("\n\n* nodes: "), F.col("n_nodes").cast("string"), F.lit(" ("), F.col("n_performance").cast("string"), F.lit(" performance, "), F.col("n_content").cast("string"),
        F.lit(" content)\n* edges: "), F.col("n_auto").cast("string"), F.lit(" automatic, "), F.col("n_manual").cast("string"), F.lit(" entered\n\n| category | nodes |\n|-|-|\n"), F.coalesce("rows", F.lit("")),
    )
    return summary.join(rows, "domain", "left").select("domain", text.alias("report"))


def index_report(counts: DataFrame) -> DataFrame:
    """dimension, report: each dimension's values by falling count."""
    rows = lines(counts, ["dimension"], F.concat(F.lit("* "), "value", F.lit(": "), F.col("n").cast("string")), -F.col("n"), "rows")
    return rows.select("dimension", F.concat(F.lit("## "), "dimension", F.lit("\n\n"), "rows").alias("report"))


def outline_report(outline: DataFrame) -> DataFrame:
    """domain, report: stages and categories of a domain with their numbers of codes."""
    rows = lines(outline, ["domain"], F.concat(F.lit("* "), F.coalesce("stage", F.lit("?")), F.lit(" "), F.coalesce("category", F.lit("?")), F.lit(": "), F.col("n").cast("string")), F.concat_ws(" ", "stage", "category"), "rows")
    return rows.select("domain", F.concat(F.lit("# "), "domain", F.lit("\n\n"), "rows").alias("report"))


def frequency_report(counts: DataFrame, domains: list[str], most: int = 30, each: int = 10) -> DataFrame:
    """part, report: the most frequent codes of all, with the first domain that has them, and of each domain asked for. counts: domain, code, n."""
    from loomleaf.operators.analyze import top

    whole = top(counts.groupBy("code").agg(F.sum("n").alias("n"), F.min("domain").alias("domain")), most, [F.desc("n"), F.col("code")])
    line = F.concat(F.lit("| "), F.col("n").cast("string"), F.lit(" | `"), "code", F.lit("` | "), "domain", F.lit(" |"))
    first = lines(whole.select(F.lit("all").alias("part"), "n", "code", "domain"), ["part"], line, F.struct(-F.col("n"), "code"), "rows")
    own = top(counts.where(F.col("domain").isin(domains)), each, [F.desc("n"), F.col("code")], ["domain"])
    short = F.concat(F.lit("| "), F.col("n").cast("string"), F.lit(" | `"), "code", F.lit("` |"))
    rest = lines(own.select(F.col("domain").alias("part"), "n", "code"), ["part"], short, F.struct(-F.col("n"), "code"), "rows")
    both = first.unionByName(rest)
    return both.select("part", F.concat(F.lit("## "), "part", F.lit("\n\n"), "rows").alias("report"))


def probe_report(probes: DataFrame) -> DataFrame:
    """outcome, n, report: what was found at the addresses probed (url, status, type, size, error), by outcome."""
    outcome = F.when(F.col("error").isNotNull(), "error").when(F.col("status") == 200, "ok").otherwise("other")
    t = probes.withColumn("outcome", outcome)
    line = F.concat(F.lit("| "), "url", F.lit(" | "), F.coalesce(F.col("status").cast("string"), F.lit("—")), F.lit(" | "), F.coalesce("type", F.lit("—")), F.lit(" | "), F.coalesce(F.col("size").cast("string"), F.lit("—")), F.lit(" | "), F.coalesce("error", F.lit("")), F.lit(" |"))
    n = t.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    return lines(t, ["outcome"], line, F.col("url"), "rows").join(n, "outcome").select("outcome", "n", F.concat(F.lit("| url | status | type | size | error |\n|-|-|-|-|-|\n"), "rows").alias("report"))


def grade_order(grade: Column) -> Column:
    """Places of grades in a table: the six of primary school, then the school levels, others last."""
    out = F.when(F.contains(grade, F.lit("國小 1")), 0)
    for i in range(2, 7):
        out = out.when(F.contains(grade, F.lit(f"國小 {i}")), i - 1)
    return out.when(F.contains(grade, F.lit("國中")), 6).when(F.contains(grade, F.lit("高中")), 7).otherwise(9)


def grade_table(exams: DataFrame) -> DataFrame:
    """place, grade, subject, n: how many exams each grade has of each subject, 未分 where unknown, with the grade's total as subject 總計, in the order of grades."""
    t = exams.select(F.coalesce("grade", F.lit("未分")).alias("grade"), F.coalesce("subject", F.lit("未分")).alias("subject")).groupBy("grade", "subject").agg(F.count(F.lit(1)).alias("n"))
    both = t.unionByName(t.groupBy("grade").agg(F.sum("n").alias("n")).withColumn("subject", F.lit("總計")))
    return both.select(grade_order(F.col("grade")).alias("place"), "grade", "subject", "n")


def schema_text(schema: StructType) -> str:
    """A table's schema as JSON."""
    return schema.json()


#: Failures in one part of the document, about.
FAILURES = 1_000


def failure_document(failures: DataFrame, total: DataFrame) -> DataFrame:
    """total, success, fail_count, part, fail: all failures (path, reason), in parts of about FAILURES of them by hash, each with the totals; one empty part without any."""
    f = failures.agg(F.count(F.lit(1)).alias("fail_count"))
    n = total.agg(F.count(F.lit(1)).alias("total")).join(F.broadcast(f)).withColumn("parts", F.greatest(F.ceil(F.col("fail_count") / FAILURES), F.lit(1)))
    own = failures.join(F.broadcast(n.select("parts"))).select(F.pmod(F.xxhash64("path", "reason"), F.col("parts")).alias("part"), "path", "reason")
    own = own.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("path", "reason"))).alias("fail"))
    every = n.select("total", (F.col("total") - F.col("fail_count")).alias("success"), "fail_count", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    return every.join(own, "part", "left").select("total", "success", "fail_count", "part", F.coalesce("fail", F.array().cast("array<struct<path:string,reason:string>>")).alias("fail"))
