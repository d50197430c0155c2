"""Ordered keyword rules as Column expressions: first match, and vote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Mapping[str, Sequence[str]]

# Keywords by subject, in the order in which they are tried.
SUBJECT_BY_NAME: Rules = {
    "國文": ("國文", "國語", "國綜", "國寫"), "英文": ("英文", "英語", "english"), "數學": ("數學", "數甲", "數乙", "數a", "數b"),
    "自然科學": ("自然", "理化", "物理", "化學", "生物", "地科", "地球科學"), "社會": ("社會", "歷史", "地理", "公民"), "生活": ("生活",), "健康與體育": ("健康", "體育", "健體"),
}
DOMAIN_BY_NAME: Rules = {
    "數學": ("數學", "math"), "英語文": ("英文", "english", "eng"), "國語文": ("國文", "國綜", "國寫", "chinese"), "社會": ("社會", "歷史", "地理", "公民"), "自然科學": ("自然", "理化", "物理", "化學", "生物", "地科"),
}
TEST_BY_NAME: Rules = {"期中考": ("期中考",), "期末考": ("期末考",), "段考": ("段考",), "第一次": ("第一次", "1st"), "第二次": ("第二次", "2nd"), "第三次": ("第三次", "3rd")}
STAGE_BY_PATH: Rules = {"國小": ("國小", "小學", "elementary"), "國中": ("國中", "junior"), "高中": ("高中", "senior", "gsat")}
# Words of a paper's body that tell its subject, in the order in which subjects and words are tried.
SUBJECT_BY_BODY: Rules = {
    "自然科學": ("自然科", "自然科學", "自然與生活科技", "理化", "物理科", "化學科", "生物科", "地科"), "健康與體育": ("健康與體育", "體育科", "健體", "健康教育"), "國文": ("國文科", "國語文", "國語科", "國文", "國語", "國綜", "國寫"),
    "英文": ("英文科", "英語科", "英文", "英語"), "數學": ("數學科", "數學"), "社會": ("社會科", "社會", "歷史科", "地理科", "公民科"),
}
# The letters of coded file names.
SUBJECT_LETTERS = {"C": "國文", "M": "數學", "S": "社會", "N": "自然科學", "H": "健康與體育", "E": "英文", "A": "自然科學"}


def any_of(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w.lower()))
    return out


def first_match(text: Column, rules: Rules, default: str | None = None) -> Column:
    """The first label one of whose words the text contains, letter case aside."""
    low = F.lower(text)
    out = F.lit(default).cast("string")
    for label, words in reversed(list(rules.items())):
        out = F.when(any_of(low, words), label).otherwise(out)
    return out


def first_containing(text: Column, rules: Rules) -> Column:
    """The first label one of whose words the text contains, letter case included; null if none."""
    out = F.lit(None).cast("string")
    for label, words in reversed(list(rules.items())):
        met = F.lit(False)
        for w in words:
            met = met | F.contains(text, F.lit(w))
        out = F.when(met, label).otherwise(out)
    return out


def vote(text: Column, rules: Rules, least: int = 2) -> Column:
    """The label whose words occur most often, at least `least` times together; of equals the first; null else."""
    low = F.lower(text)
    scored = []
    for i, (label, words) in enumerate(rules.items()):
        n = sum(((F.length(low) - F.length(F.replace(low, F.lit(w.lower()), F.lit("")))) / len(w) for w in words), F.lit(0))
        scored.append(F.struct(n.cast("int").alias("n"), F.lit(-i).alias("at"), F.lit(label).alias("label")))
    best = F.array_max(F.array(*scored))
    return F.when(best["n"] >= least, best["label"])


def coded_name(name: Column | str) -> Column:
    """grade, subject, year, term, test and variant of a name such as 6C11411A.doc; null for others."""
    pattern = r"^(\d)([A-Z])(\d{3})(\d)(\d)([A-Z]?)\.(doc|docx|pdf)$"
    part = lambda i: F.regexp_extract(name, pattern, i)
    letters = F.create_map(*[F.lit(x) for kv in SUBJECT_LETTERS.items() for x in kv])
    return F.when(
        F.col(name).rlike(pattern) if isinstance(name, str) else name.rlike(pattern),
        F.struct(
            part(1).cast("int").alias("grade"),
            F.coalesce(F.element_at(letters, part(2)), F.lit("?")).alias("subject"),
            part(3).alias("year_roc"),
            F.when(part(4) == "1", "上學期").otherwise("下學期").alias("semester"),
            F.when(part(5) == "1", "期中考").otherwise("期末考").alias("test_type"),
            F.nullif(part(6), F.lit("")).alias("variant"),
        ),
    )


def exam_name(name: Column) -> Column:
    """year, subject, variant and test of a national paper's name such as 111-數學a.pdf."""
    stem = F.regexp_replace(name, r"\.[A-Za-z]+$", "")
    rest = F.regexp_replace(F.regexp_replace(stem, r"^\d{2,3}[-_]", ""), "(?:試卷|定稿|試題|題本|參考答案|答案)+$", "")
    year = F.nullif(F.regexp_extract(stem, r"^(\d{2,3})[-_]", 1), F.lit(""))
    variant = F.nullif(F.regexp_extract(rest, "([abAB甲乙])$", 1), F.lit(""))
    return F.struct(
        year.alias("year_roc"),
        F.coalesce(first_match(rest, SUBJECT_BY_NAME), F.regexp_replace(rest, "[abAB甲乙]$", "")).alias("subject"),
        variant.alias("variant"),
        F.when(F.contains(stem, F.lit("分科")), "分科測驗").when(F.contains(stem, F.lit("指考")), "指考").when(F.contains(stem, F.lit("學測")) | year.cast("int").between(108, 115), "學測").alias("test_type"),
    )


def grade_stage(n: Column) -> Column:
    return F.when(n.between(1, 6), "國小").when(n.between(7, 9), "國中").when(n.between(10, 12), "高中")
