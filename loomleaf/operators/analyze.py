"""Counting, matching and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomleaf.functions.text import ACCENTED_CODE_IN_TEXT, CODE_IN_TEXT


def match_codes(texts: DataFrame, key: str, text: str, codes: DataFrame, pattern: str = ACCENTED_CODE_IN_TEXT) -> DataFrame:
    """key, domain, code, n: how often each code of a text's domain stands in it as a whole code, which group 1 of the pattern is.

    texts has a column domain, codes has domain and code. Each text is read once and its codes are joined by equality,
    instead of looking for every code of the domain in it.
    """
    found = texts.select(key, "domain", F.explode(F.regexp_extract_all(text, F.lit(pattern), 1)).alias("code")).groupBy(key, "domain", "code").agg(F.count(F.lit(1)).alias("n"))
    return found.join(codes.select("domain", "code").distinct(), ["domain", "code"]).select(key, "domain", "code", "n")


def match_prefixes(texts: DataFrame, key: str, text: str, codes: DataFrame) -> DataFrame:
    """The same with the codes counted that a whole code begins with; those that stand elsewhere in it are left to match_substrings."""
    found = texts.select(key, "domain", F.explode(F.regexp_extract_all(text, F.lit(CODE_IN_TEXT), 1)).alias("whole")).groupBy(key, "domain", "whole").agg(F.count(F.lit(1)).alias("n"))
    starts = found.withColumn("code", F.explode(F.transform(F.sequence(F.lit(1), F.length("whole")), lambda i: F.left("whole", i))))
    hits = starts.join(codes.select("domain", "code").distinct(), ["domain", "code"])
    return hits.groupBy(key, "domain", "code").agg(F.sum("n").alias("n"))


def match_substrings(texts: DataFrame, key: str, text: str, codes: DataFrame) -> DataFrame:
    """The same with every occurrence of the code's letters counted, wherever it stands and whatever stands around it.

    A code lies within one run of characters that occur in codes. The substrings of these runs, as long as codes are, meet
    the codes by equality, so no text meets all codes. Occurrences that overlap others of the same code don't count.
    """
    known = codes.select("domain", "code").where("domain is not null and code <> ''").distinct()
    letters = F.array_distinct(F.flatten(F.collect_set(F.split("code", ""))))
    shape = known.agg(letters.alias("c"), F.min(F.length("code")).alias("_least"), F.max(F.length("code")).alias("_most"))
    # as numbers, since a hyphen or bracket means something in a class
    shape = shape.select("_least", "_most", F.concat(F.lit("(["), F.array_join(F.transform(F.filter("c", lambda x: x != ""), lambda x: F.concat(F.lit(r"\x{"), F.hex(F.ascii(x)), F.lit("}"))), ""), F.lit("]+)")).alias("_run")).where("_least is not null")
    runs = texts.crossJoin(F.broadcast(shape)).select(key, "domain", "_least", "_most", F.explode(F.regexp_extract_all(text, F.col("_run"), 1)).alias("run")).where(F.length("run") >= F.col("_least"))
    runs = runs.groupBy(key, "domain", "run", "_least", "_most").agg(F.count(F.lit(1)).alias("n"))
    # of each start, the substrings from the shortest code's length to the longest's
    lengths = lambda i: F.sequence(F.col("_least"), F.least(F.col("_most"), F.length("run") - i + 1))
    starts = F.sequence(F.lit(1), F.length("run") - F.col("_least") + 1)
    parts = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(lengths(i), lambda k: F.substring("run", i, k)))))
    hits = runs.select(key, "domain", "run", "n", F.explode(parts).alias("code")).join(known, ["domain", "code"])
    times = (F.length("run") - F.length(F.replace("run", "code", F.lit("")))) / F.length("code")
    return hits.groupBy(key, "domain", "code").agg(F.sum(F.col("n") * times.cast("bigint")).alias("n"))


def frequencies(matches: DataFrame, key: str) -> DataFrame:
    """Sums over all, by domain and by text, in one pass: level, domain, key, code, n."""
    sets = matches.groupingSets([["code"], ["domain", "code"], [key, "domain", "code"]], key, "domain", "code").agg(F.sum("n").alias("n"), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 0, "text").when(F.col("g") == 4, "domain").otherwise("all")
    return sets.select(level.alias("level"), "domain", key, "code", "n")


def top(df: DataFrame, n: int, by: list[Column], within: list[str] | None = None) -> DataFrame:
    """The first n rows, or the first n of each group, with their rank."""
    if within is None:
        w = Window.orderBy(*by)
        return df.orderBy(*by).limit(n).withColumn("rank", F.row_number().over(w))
    w = Window.partitionBy(*within).orderBy(*by)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def counts_by(df: DataFrame, columns: list[str]) -> DataFrame:
    """dimension, value, n for each column's values but nulls, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).where("p.value is not null").groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, none: str = "未分") -> DataFrame:
    """row, column, n with totals: a null row and column of the result stand for the totals."""
    t = df.select(F.coalesce(F.col(row).cast("string"), F.lit(none)).alias("row"), F.coalesce(F.col(column).cast("string"), F.lit(none)).alias("column"))
    return t.cube("row", "column").agg(F.count(F.lit(1)).alias("n"))


def mode_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, mode, n: the most frequent value of each group that isn't null; of equals the smallest.

    Null keys are the group '?'. Counts are combined before groups meet, so a hot group is no burden.
    """
    t = df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("?")).alias(k) for k in keys], F.col(value).alias("v")).where("v is not null")
    n = t.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*keys).agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"), F.max("n").alias("n"))


def impute(df: DataFrame, keys: list[str], value: str, *guesses: tuple[str, Column]) -> DataFrame:
    """df with imputed and origin: the value itself, else the first guess that isn't null, else its group's mode."""
    modes = mode_by(df, keys, value)
    named = modes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("mode").alias("_mode"))
    on = [F.coalesce(F.col(k).cast("string"), F.lit("?")) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    t = df.join(named, on, "left")
    value_c = F.col(value)
    out, origin = value_c, F.when(value_c.isNotNull(), "given")
    for name, g in guesses:
        origin = F.when(origin.isNotNull(), origin).when(g.isNotNull(), name)
        out = F.coalesce(out, g)
    origin = F.coalesce(origin, F.when(F.col("_mode").isNotNull(), "group"), F.lit("none"))
    return t.withColumn("imputed", F.coalesce(out, F.col("_mode"))).withColumn("origin", origin).drop("_mode", *[f"_k{i}" for i in range(len(keys))])


def coverage(all_: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Keys that are in all_ but not in covered."""
    return all_.select(key).distinct().join(covered.select(key).distinct(), key, "left_anti")


def in_range(df: DataFrame, column: str, low: object = None, high: object = None) -> DataFrame:
    """Rows whose value lies between both ends, those included; an end that is None is open. Nulls lie nowhere."""
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low))
    return df.where(F.col(column) <= F.lit(high)) if high is not None else df.where(F.col(column).isNotNull())


def holding(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Rows whose text holds every one of the words."""
    for w in words:
        df = df.where(F.contains(column, F.lit(w)))
    return df


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with side 'left' or 'right'."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def align_textbooks(textbooks: DataFrame, codes: DataFrame) -> DataFrame:
    """textbook_id, codes (distinct, sorted), n_performance, n_content: the codes of each textbook's domain and stage.

    A textbook without stage takes all stages of its domain. codes: domain, stage, code, type.
    Codes are gathered, sorted and counted per domain and stage first, so what is joined has a row for each of these.
    The result holds every list as often as textbooks have it; alignment_totals gives the numbers alone.
    """
    given = F.collect_set(F.when(F.col("code").isNotNull(), F.struct("code", "type")))
    per = codes.where("stage is not null").groupBy("domain", "stage").agg(given.alias("s"))
    whole = codes.groupBy("domain").agg(given.alias("s")).withColumn("stage", F.lit(None).cast("string"))
    lists = per.unionByName(whole).select(
        "domain",
        "stage",
        F.array_sort(F.array_distinct(F.transform("s", lambda x: x["code"]))).alias("codes"),
        F.size(F.filter("s", lambda x: x["type"] == "performance")).cast("bigint").alias("n_performance"),
        F.size(F.filter("s", lambda x: x["type"] == "content")).cast("bigint").alias("n_content"),
    )
    t = _aligned(textbooks, lists)
    return t.select("textbook_id", F.coalesce("codes", F.array().cast("array<string>")).alias("codes"), *_or_zero("n_performance", "n_content"))


def alignment_totals(textbooks: DataFrame, codes: DataFrame) -> DataFrame:
    """textbook_id, n_codes, n_performance, n_content, first_code of the codes that align_textbooks lists, without the lists.

    A type's number counts a null code too, as the SQL twin does. Every code counts once per domain and stage, and once per domain; both come from one pass, and a textbook meets one row of
    totals. So neither a hot domain nor the number of its codes weighs on a task or on a textbook.
    """
    kinds = [F.max(F.coalesce(F.col("type") == k, F.lit(False)).cast("int")).alias(f"n_{k}") for k in ("performance", "content")]
    known = codes.where("domain is not null")
    each = known.groupingSets([["domain", "stage", "code"], ["domain", "code"]], "domain", "stage", "code").agg(*kinds, F.grouping("stage").alias("whole"))
    totals = each.where("whole = 1 or stage is not null").groupBy("domain", "stage").agg(
        F.count("code").alias("n_codes"), F.sum("n_performance").alias("n_performance"), F.sum("n_content").alias("n_content"), F.min("code").alias("first_code")
    )
    return _aligned(textbooks, totals).select("textbook_id", *_or_zero("n_codes", "n_performance", "n_content"), "first_code")


def _aligned(textbooks: DataFrame, groups: DataFrame) -> DataFrame:
    """Each textbook with the row of its domain and stage; the row without stage is the whole domain's, for textbooks without one."""
    g = groups.withColumnsRenamed({"domain": "_domain", "stage": "_stage"})
    t = textbooks.select("textbook_id", "domain", "stage").distinct()
    return t.join(g, (F.col("domain") == F.col("_domain")) & F.col("stage").eqNullSafe(F.col("_stage")), "left")


def _or_zero(*names: str) -> list[Column]:
    return [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names]
