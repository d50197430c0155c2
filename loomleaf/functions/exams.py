"""What an exam file's path and name tell: the index's fields, and the fields of an extracted record by the kind of its source.

All are built-in expressions over two columns, the path below the root and the file's name in it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomleaf.functions.rules import SUBJECT_LETTERS, SUBJECT_BY_BODY, coded_name, first_containing
from loomleaf.functions.text import nonempty

# Subjects by words of the file's name (letter case counts), stages by words of the path in lower case, publishers.
INDEX_SUBJECTS = {
    "國文": ("國文", "國語", "國綜", "國寫"), "英文": ("英文", "英語", "english"), "數學": ("數學", "數甲", "數乙", "數a", "數b"), "自然科學": ("自然", "理化", "物理", "化學", "生物", "地科", "地球科學"),
    "社會": ("社會", "歷史", "地理", "公民"), "生活": ("生活",), "健康與體育": ("健康", "體育", "健體"),
}
PUBLISHERS = ("南一", "康軒", "翰林", "何嘉仁", "龍騰", "泰宇", "全華", "五南", "旗立", "佳音")
INDEX_STAGES = {
    "國小": (*(f"grade{i}" for i in range(1, 7)), *(f"國小{i}" for i in range(1, 7)), *(f"國小{i}" for i in "一二三四五六"), *(f"{i}年級" for i in "一二三四五六"), "上學期", "下學期", "期中考", "期末考"),
    "國中": ("grade7", "grade8", "grade9", "國中7", "國中8", "國中9", "七年級", "八年級", "九年級"),
    "高中": ("學測", "分科", "指考", "GSAT", "grade10"),
}
# Labels of sources in the index, by what their paths hold; that of papers right below exams, and that of texts.
INDEX_SOURCES = {"米蘭老師 Drive": "melances", "大墩國小 ddes.tc.edu.tw": "ddes", "學習方舟 studyark.org": "studyark"}
NATIONAL, NATIONAL_TEXT, OTHER = "CEEC 大考中心（高中試題）", "CEEC 純文字 (pdftotext 轉檔)", "其他"
# Licences by source, and the one school of the coded names.
LICENCES = {"melances": "不明（米蘭老師 Drive，無明確授權 — 僅作 metadata 參考，不對外散佈）", "ddes": "教育部公開資料", "CEEC": "CEEC 大考中心（依官方授權）"}
CODED_SCHOOL = "大墩國小"
# Subjects in the order in which a record's name is searched, by the whole name or the name without 科學.
RECORD_SUBJECTS = {"國文": ("國文",), "英文": ("英文",), "數學": ("數學",), "社會": ("社會",), "自然科學": ("自然科學", "自然"), "生活": ("生活",), "健康與體育": ("健康與體育",)}
# Exact names and contained words of national papers.
NATIONAL_EXACT = {"chinese": "國文", "english": "英文", "eng": "英文", "math": "數學", "social": "社會", "science": "自然科學", "生活": "生活"}
NATIONAL_WORDS = {
    "國文": ("國文", "國語", "國綜", "國寫"), "英文": ("英文", "英語", "eng"), "數學": ("數學", "數甲", "數乙", "數a", "數b"), "自然科學": ("自然", "理化", "物理", "化學", "生物", "地科", "地球科學"),
    "社會": ("社會", "歷史", "地理", "公民"), "健康與體育": ("健康", "體育", "健體"),
}
ENDINGS = "試卷定稿|試卷|試題|定稿|docx檔|docx|doc|draft|科"

NATIONAL_NAME = r"^\d{2,3}[-_].+\.(pdf|docx)$"
INDEX_COLUMNS = ("path", "filename", "size", "ext", "year_roc", "stage", "grade", "subject", "version", "test_type", "semester", "source", "school")


def _has(c: Column, word: str) -> Column:
    return F.contains(c, F.lit(word))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """The file's extension in lower case without the point; empty without one."""
    return F.lower(F.regexp_extract(name, r"[^.]\.([^.]+)$", 1))


def school(name: Column) -> Column:
    """A municipal school, else any school of two to five characters."""
    return F.coalesce(nonempty(F.regexp_extract(name, "(市立[一-鿿]{1,5}(?:國小|國中|高中))", 1)), nonempty(F.regexp_extract(name, "([一-鿿]{2,5}(?:國小|國中|高中))", 1)))


def index_source(path: Column) -> Column:
    name = file_name(path)
    national = F.try_element_at(F.split(path, "/"), F.lit(-2)).eqNullSafe("exams") & name.rlike(NATIONAL_NAME) & ~_has(name, "text")
    out = F.when(national, NATIONAL).when(_has(path, "text") & name.rlike(r"\.txt$"), NATIONAL_TEXT).otherwise(OTHER)
    for label, word in reversed(INDEX_SOURCES.items()):
        out = F.when(_has(path, word), label).otherwise(out)
    return out


def index_fields(path: Column, size: Column) -> list[Column]:
    """The 13 columns of the index of exam files, INDEX_COLUMNS."""
    name, low, source = file_name(path), F.lower(path), index_source(path)
    national = source == NATIONAL
    n = nonempty(F.regexp_extract(low, r"grade(\d+)", 1)).try_cast("int")
    by_grade = F.when(n.between(1, 6), "國小").when(n.between(7, 9), "國中").when(n == 10, "高中")
    stage = F.when(national, "高中").otherwise(F.coalesce(by_grade, first_containing(low, INDEX_STAGES)))
    grade = F.when(national, "高中").when(n.between(1, 6), F.concat(F.lit("國小 "), n.cast("string"), F.lit(" 年級"))).when(n.between(7, 9), F.concat(F.lit("國中 "), (n - 6).cast("string"), F.lit(" 年級"))).when(n == 10, "高中 1 年級")
    letters = F.create_map(*[F.lit(x) for kv in SUBJECT_LETTERS.items() for x in kv])
    letter = F.element_at(letters, F.regexp_extract(name, r"^\d([A-Z])", 1))
    lower = F.lower(name)
    test = F.when(_has(path, "期中考"), "期中考").when(_has(path, "期末考"), "期末考").when(_has(path, "段考"), "段考")
    for word, other, label in (("第一次", "1st", "第一次段考"), ("第二次", "2nd", "第二次段考"), ("第三次", "3rd", "第三次段考")):
        test = test.when(_has(name, word) | _has(lower, other), label)
    out = {
        "path": path, "filename": name, "size": size, "ext": suffix(name), "year_roc": nonempty(F.regexp_extract(name, r"^(\d{2,3})[-_]", 1)), "stage": stage, "grade": grade,
        "subject": F.coalesce(letter, first_containing(name, INDEX_SUBJECTS)), "version": first_containing(name, {p: (p,) for p in PUBLISHERS}), "test_type": test,
        "semester": F.when(_has(path, "上學期"), "上學期").when(_has(path, "下學期"), "下學期"), "source": source, "school": school(name),
    }
    return [out[c].alias(c) for c in INDEX_COLUMNS]


def path_record(path: Column) -> Column:
    """What the folders and the name of a collected file tell; of several folders for one field the last counts."""
    parts, name = F.split(path, "/"), file_name(path)
    n = nonempty(F.regexp_extract(path, r"grade(\d+)", 1)).try_cast("int")
    last = lambda words: F.try_element_at(F.filter(parts, lambda p: p.isin(*words)), F.lit(-1))
    low = F.lower(path)
    ascii_ = F.when(_has(low, "/math") | _has(F.lower(name), "math"), "數學").when(_has(low, "/english") | _has(F.lower(name), "eng"), "英文")
    return F.struct(
        F.lit("melances").alias("source"),
        n.alias("grade_num"),
        F.when(n <= 6, "國小").when(n <= 9, "國中").when(n.isNotNull(), "高中").alias("stage"),
        F.when(n <= 6, F.concat(F.lit("國小 "), n.cast("string"), F.lit(" 年級"))).when(n <= 9, F.concat(F.lit("國中 "), (n - 6).cast("string"), F.lit(" 年級"))).when(n.isNotNull(), "高中 1 年級").alias("grade_label"),
        last(("上學期", "下學期")).alias("semester"),
        last(("期中考", "期末考", "第一次段考", "第二次段考", "第三次段考")).alias("test_type"),
        nonempty(F.regexp_extract(name, "(10[8-9]|11[0-5])", 1)).alias("year_roc"),
        F.coalesce(first_containing(name, RECORD_SUBJECTS), ascii_).alias("subject"),
    )


def national_record(name: Column) -> Column:
    """year, subject, variant and test of a national paper's name; its fields are null for other names."""
    pattern = r"^(\d{2,3})[-_](.+)\.(pdf|docx)$"
    year = nonempty(F.regexp_extract(name, pattern, 1))
    part = F.regexp_replace(F.regexp_extract(name, pattern, 2), f"(?:{ENDINGS})+$", "")
    variant = nonempty(F.regexp_extract(part, "([ab甲乙])$", 1))
    clean = F.trim(F.regexp_replace(part, "[ab甲乙]$", ""))
    exact = F.element_at(F.create_map(*[F.lit(x) for kv in NATIONAL_EXACT.items() for x in kv]), clean)
    test = F.when(_has(name, "分科"), "分科").when(_has(name, "指考"), "指考").when(_has(name, "學測") | _has(name, "國寫") | _has(name, "選擇題") | year.try_cast("int").between(108, 115), "學測")
    ok = year.isNotNull()
    return F.struct(
        year.alias("year_roc"),
        F.when(ok, F.coalesce(exact, first_containing(clean, NATIONAL_WORDS), clean)).alias("subject"),
        F.when(ok, variant).alias("variant"),
        F.when(ok, test).alias("test_type"),
    )


RECORD_FIELDS = ("source", "stage", "grade_num", "grade_label", "year_roc", "semester", "test_type", "subject", "variant", "school", "license")


def record_fields(path: Column) -> list[Column]:
    """source, stage, grade_num, grade_label, year_roc, semester, test_type, subject, variant, school, license of a file, by the kind of its path."""
    name = file_name(path)
    coded, by_path, national = coded_name(name), path_record(path), national_record(name)
    is_coded, is_path = _has(path, "ddes"), _has(path, "melances")
    is_national = F.try_element_at(F.split(path, "/"), F.lit(-2)).eqNullSafe("exams") & name.rlike(NATIONAL_NAME)
    g = coded["grade"]
    source = F.when(is_coded, F.when(coded.isNotNull(), "ddes").otherwise("ddes-未解析")).when(is_path, "melances").when(is_national, "CEEC").otherwise("其他")

    def of(c: Column | None, p: Column | None, n: Column | None) -> Column:
        none = F.lit(None)
        return F.when(is_coded, c if c is not None else none).when(is_path, p if p is not None else none).when(is_national, n if n is not None else none)

    label = F.when(g <= 6, F.concat(F.lit("國小 "), g.cast("string"), F.lit(" 年級"))).when(g <= 9, F.concat(F.lit("國中 "), (g - 6).cast("string"), F.lit(" 年級")))
    out = {
        "source": source,
        "stage": of(F.when(g <= 6, "國小").when(g <= 9, "國中"), by_path["stage"], F.lit("高中")),
        "grade_num": of(g, by_path["grade_num"], None).cast("int"),
        "grade_label": of(label, by_path["grade_label"], F.lit("高中")),
        "year_roc": of(coded["year_roc"], by_path["year_roc"], national["year_roc"]),
        "semester": of(coded["semester"], by_path["semester"], None),
        "test_type": of(coded["test_type"], by_path["test_type"], national["test_type"]),
        "subject": of(coded["subject"], by_path["subject"], national["subject"]),
        "variant": of(coded["variant"], None, national["variant"]),
        "school": F.when(is_coded & coded.isNotNull(), CODED_SCHOOL),
        "license": F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LICENCES.items() for x in kv]), source), F.lit("不明")),
    }
    return [nonempty(c).alias(k) if k != "grade_num" else c.alias(k) for k, c in out.items()]


def subject_of_body(body: Column) -> Column:
    """The first subject one of whose words the body holds, white space aside."""
    return first_containing(F.regexp_replace(body, r"(?U)\s+", ""), SUBJECT_BY_BODY)


# Words by which the subject of a body is voted, and phrases that settle it, in order.
VOTED = {
    "國文": ("國文科", "國語文", "國語科", "國文", "國語", "國綜", "國寫", "語文領域"), "英文": ("英文科", "英語科", "英文", "英語", "English"), "數學": ("數學科", "數學", "數"),
    "自然科學": ("自然科", "自然科學", "自然與生活科技", "理化", "物理科", "化學科", "生物科", "地科", "自然科學領域", "自然"), "社會": ("社會科", "社會", "歷史科", "地理科", "公民科", "社會領域"),
    "健康與體育": ("健康與體育", "體育科", "健體", "健康教育", "體育", "健康"), "綜合活動": ("綜合活動", "綜合活動領域"), "藝術": ("藝術", "音樂", "美術", "表演藝術", "視覺藝術"), "科技": ("科技", "資訊", "生活科技"),
}
SETTLED = {
    "國文": ("國文科", "國語科", "語文領域"), "英文": ("英文科", "英語科", "English"), "數學": ("數學科", "數學領域"), "自然科學": ("自然科", "自然與生活科技"), "社會": ("社會科", "社會領域"),
    "健康與體育": ("健體", "健康與體育", "體育科"), "綜合活動": ("綜合活動",),
}


def voted_subject(body: Column) -> Column:
    """The subject that a phrase of the body settles, else the one whose words occur most, twice at least; of equals the first."""
    clean = F.regexp_replace(body, r"(?U)\s+", "")
    scored = []
    for i, (label, words) in enumerate(VOTED.items()):
        n = sum((F.regexp_count(clean, F.lit(w)) for w in words), F.lit(0))
        scored.append(F.struct(n.alias("n"), F.lit(-i).alias("at"), F.lit(label).alias("label")))
    best = F.array_max(F.array(*scored))
    return F.coalesce(first_containing(clean, SETTLED), F.when(best["n"] >= 2, best["label"]))


def domain_of_name(name: Column, rules_: dict[str, tuple[str, ...]]) -> Column:
    """The domain that the part behind the first hyphen or underscore of a text's name tells, letter case aside; the whole name without one."""
    parts = F.split(F.replace(name, F.lit(".txt"), F.lit("")), "[-_]")
    return first_containing(F.lower(F.coalesce(F.try_element_at(parts, F.lit(2)), F.get(parts, F.lit(0)))), rules_)


def link_year_subject(url: Column) -> Column:
    """year and subject that an address's last part tells: digits before 學年 or 學測, and the words before 試卷, 試題 or 答案, else the first run of ideographs; unknown without."""
    last = F.substring_index(url, "/", -1)
    name = F.coalesce(F.try_url_decode(last), last)
    year = nonempty(F.regexp_extract(name, r"(\d{2,3})學(?:年|測)", 1))
    told = nonempty(F.regexp_extract(name, r"(?:學年|學測)\D*?(?:試卷|測驗)?\D*?([一-鿿]+[A-Za-z]?)(?:試卷|試題|答案|\.pdf)", 1))
    subject = F.coalesce(told, nonempty(F.regexp_extract(name, "([一-鿿]+[A-Za-z]?)", 1)), F.lit("unknown"))
    return F.struct(F.coalesce(year, F.lit("unknown")).alias("year"), F.regexp_replace(subject, "(?:試卷|試題|答案)$", "").alias("subject"))
