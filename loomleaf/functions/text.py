"""Column builders for semi-structured text: frontmatter, sections, codes, headings, names.

All are built-in expressions that stay inside code generation. Patterns whose white space or
digits must follow Unicode say so with (?U).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: code := up to two ideographs, prefix, "-", stage with an optional suffix, "-", digits; not behind a letter or digit.
PREFIX = "[a-z]{1,3}|[0-9][a-z]?|[A-Z]{1,2}[a-z]?"
STAGE = "[ⅠⅡⅢⅣⅤ]|I{1,3}|IV|V{1,3}|[1-5]"
CODE = f"(?:[一-鿿]{{0,2}})(?:{PREFIX})-(?:IV|{STAGE})[ca]?-[0-9]+"
#: The same with what stands before it, for engines without lookbehind; group 1 is the code.
CODE_IN_TEXT = f"(?:^|[^A-Za-z0-9])({CODE})"
#: The same for prefixes with accented letters, which nodes has too (Tâi-, Lô-, 3é-); CODE stays as it is, since the SQL twins are written with it.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏḀ-ỿ"
ACCENTED_CODE_IN_TEXT = f"(?:^|[^0-9{LATIN}])((?:[一-鿿]{{0,2}})(?:[0-9]?[{LATIN}]{{1,3}}|[0-9])-(?:IV|{STAGE})[ca]?-[0-9]+)"
MATH_CODE = "(?:^|[^A-Za-z0-9])([A-Z]-[1-5]-[0-9]+)(?:$|[^A-Za-z0-9])"
PARTS = f"^([一-鿿]{{0,2}})({PREFIX})-(IV|{STAGE})[ca]?-([0-9]+)$"

# Written forms of the five stages, and their order.
STAGE_NAMES = {"Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "1": "I", "2": "II", "3": "III", "4": "IV", "5": "V"}
STAGES = ("I", "II", "III", "IV", "V")


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def trimmed(c: Column | str) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def frontmatter_block(text: Column | str) -> Column:
    """What stands between the fences of a text that begins with one; null without a closing fence."""
    return F.nullif(F.regexp_extract(text, r"(?s)^---\n(.+?)\n---\n", 1), F.lit(""))


def frontmatter(text: Column | str) -> Column:
    """The frontmatter as a map of strings; empty without one.

    Blank, comment and colonless lines are skipped, a line splits at its first colon, matching
    quotes are taken off, and of a repeated key the last value counts.
    """
    block = frontmatter_block(text)
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\n"), lambda x: F.contains(x, F.lit(":")) & ~F.startswith(F.trim(x), F.lit("#")))
    pairs = F.transform(lines, lambda x: F.struct(trimmed(F.substring_index(x, ":", 1)).alias("k"), trimmed(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v")))
    bare = F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), F.when(p["v"].rlike(r"^(\".*\"|'.*')$") & (F.length(p["v"]) >= 2), F.substring(p["v"], F.lit(2), F.length(p["v"]) - 2)).otherwise(p["v"]).alias("v")))
    last = F.filter(bare, lambda p, i: ~F.exists(F.slice(bare, i + 2, F.greatest(F.size(bare) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def frontmatter_list(value: Column) -> Column:
    """A frontmatter value written as [a, "b"] as an array; null for others."""
    inner = F.regexp_extract(value, r"^\[(.*)\]$", 1)
    items = F.filter(F.transform(F.split(inner, ","), lambda x: F.regexp_replace(trimmed(x), r"^[\"']|[\"']$", "")), lambda x: x != "")
    return F.when(value.rlike(r"^\[.*\]$"), items)


def frontmatter_typed(value: Column) -> Column:
    """A value as a struct of its kinds: null words, truth values and whole numbers are told apart after unquoting."""
    v = F.lower(value)
    return F.struct(
        (v.isin("null", "") | v.isNull()).alias("is_null"), F.when(v == "true", True).when(v == "false", False).alias("as_boolean"), F.when(value.rlike("^-?[0-9]+$"), value.try_cast("bigint")).alias("as_long"), value.alias("as_string")
    )


def body(text: Column | str) -> Column:
    """The text behind the frontmatter; all of it without one."""
    return F.regexp_replace(text, r"(?s)^---\n.+?\n---\n", "")


def section_title(text: Column | str) -> Column:
    """The heading of the fifth section as written, lines of a table of contents aside."""
    return F.regexp_extract(text, r"(?:^|\n)[\f  　]*(伍、[  　]*(?:學習重點|學習階段))(?![ .…·]*[.…]{3})", 1)


def section(text: Column | str) -> Column:
    """The fifth section, from its heading to the sixth's or the end."""
    return trimmed(F.regexp_extract(text, r"(?s)(?:^|\n)[\f  　]*(伍、[  　]*(?:學習重點|學習階段)(?![ .…·]*[.…]{3}).*?)(?=\n[\f  　]*陸、(?![^\n]*[.…]{3})|$)", 1))


# The words of a line that heads the part of one school level, level by level, blanks around them.
_WHAT = "(?:學習重點|學習內容)?"
_LEVELS = (
    f"國民小學(?:教育階段)?{_WHAT}",
    f"國民中學(?:教育階段)?(?:及普通型(?:高級中等學校|高中))?(?:必修課程)?{_WHAT}",
    f"普通型(?:高級中等學校|高中)?(?:必修課程)?(?:加深加廣選修(?:課程)?)?{_WHAT}",
)
LEVEL_HEADING = f"[ \t]*(?:[一二三四五六七八九十]、)?[ \t　]*(?:{'|'.join(_LEVELS)})[ \t　]*"


def structure_type(raw: Column | str) -> Column:
    """B with at least two headings of school levels, else A."""
    return F.when(F.regexp_count(raw, F.lit(f"(?m)^{LEVEL_HEADING}$")) >= 2, "B").otherwise("A")


def level_chunks(raw: Column | str) -> Column:
    """The parts under each heading of a school level; the whole text as one part without any. What stands before the first is left out."""
    marked = F.regexp_replace(raw, f"(?m)^({LEVEL_HEADING})$", "\x01$1")
    parts = F.split(marked, "\x01")
    return F.when(F.size(parts) > 1, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)


def normal_stage(raw: Column) -> Column:
    """The stage in ASCII letters; unknown ones as they are."""
    return F.coalesce(F.element_at(_map(STAGE_NAMES), raw), raw)


def stage_order(stage: Column) -> Column:
    out = F.lit(99)
    for i, s in enumerate(STAGES, 1):
        out = F.when(stage == s, i).otherwise(out)
    return out


def codes(text: Column | str, math: Column | bool = False) -> Column:
    """All codes of the text in order of first occurrence; with math also those of capital, digit, digits."""
    general = F.array_distinct(F.regexp_extract_all(text, F.lit(CODE_IN_TEXT), 1))
    more = F.array_distinct(F.regexp_extract_all(text, F.lit(MATH_CODE), 1))
    return F.when(F.lit(math) if isinstance(math, bool) else math, F.array_union(general, more)).otherwise(general)


def code_parts(code: Column) -> Column:
    """code, stage, category, ordinal, code_format, kind of a code; the ideographs before the prefix belong to no part."""
    raw = F.regexp_extract(code, PARTS, 3)
    prefix = F.regexp_extract(code, PARTS, 2)
    return F.struct(
        code.alias("code"),
        normal_stage(raw).alias("stage"),
        prefix.alias("category"),
        F.regexp_extract(code, PARTS, 4).try_cast("int").alias("ordinal"),
        F.when(raw.rlike("^[1-5]$"), "numeric_phase").otherwise("roman_phase").alias("code_format"),
        F.when(prefix.rlike("^[A-Z]"), "content").otherwise("performance").alias("kind"),
    )


def sorted_stages(stages: Column) -> Column:
    """Distinct stages in school order, unknown ones last."""
    ranked = F.transform(F.array_distinct(stages), lambda s: F.struct(stage_order(s).alias("o"), s.alias("s")))
    return F.transform(F.array_sort(ranked), lambda x: x["s"])


# Words of headings that are none of chapters, and lines that begin a chapter or unit.
NO_CHAPTERS = "學習表現|學習內容|教學活動|評量|編碼分布|領域簡介|學習評量"
UNIT = "^第[一二三四五六七八九十百]+章|^【?[一二三四五六七八九十]?[上中下]?】?第?[一二三四五六七八九十]?[單課元章]"


def chapters(markdown: Column | str) -> Column:
    """title and raw_line of each heading of a chapter or unit."""
    lines = F.transform(F.split(markdown, "\n"), trimmed)
    lines = F.filter(lines, lambda x: x.rlike(r"^### [^—:]+$") & ~x.rlike(NO_CHAPTERS) | ~F.startswith(x, F.lit("### ")) & x.rlike(UNIT))
    return F.transform(lines, lambda x: F.struct(trimmed(F.regexp_replace(x, "^### ", "")).alias("title"), x.alias("raw_line")))


# Stages by the last part of a topic's address; math-N follows its number.
STAGE_SLUGS = {
    "I": "ele-c", "II": "coocele-t", "IV": "math-9to10 jun-c main-juni-ge middle-school-civics junyi-geography junyi-middle-school-biology middle-school-physics-chemistry junyi-middle-earth-science",
    "V": "sen-c eng-senior10 eng-senior11 eng-senior12 eng-senior-prep coocind",
}


def stage_of_slug(slug: Column) -> Column:
    n = F.nullif(F.regexp_extract(slug, "^math-([0-9]+)$", 1), F.lit("")).try_cast("int")
    out = F.when(n.between(1, 2), "I").when(n.between(3, 4), "II").when(n.between(5, 6), "III").when(n.between(7, 9), "IV").when(n.between(10, 12), "V")
    for stage, slugs in STAGE_SLUGS.items():
        out = out.when(slug.isin(*slugs.split()), stage)
    return out


def stage_from_path(url: Column, path: Column) -> Column:
    """The stage that the address of a topic tells, else, for such addresses, the file's name; without an address the name is the topic."""
    slug = F.nullif(F.regexp_extract(url, "/topics/([^/?#]+)", 1), F.lit(""))
    by_name = F.nullif(F.regexp_extract(path, "stage-([IV]+)-", 1), F.lit(""))
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.md$", "")
    return F.when(F.coalesce(url, F.lit("")) == "", stage_of_slug(name)).when(slug.isNotNull(), F.coalesce(stage_of_slug(slug), by_name))


def topic_hint(raw: Column, code: Column) -> Column:
    """The first run of ideographs, 4 to 40 of them, within 60 characters behind the code's first occurrence."""
    at = F.instr(raw, code)
    behind = F.substring(raw, at + F.length(code), F.lit(60))
    return F.when(at > 0, F.left(F.regexp_extract(behind, "[一-鿿]{4,40}", 0), F.lit(50))).otherwise("")


def slug(c: Column | str, most: int = 80) -> Column:
    return F.left(F.regexp_replace(c, r'[\\/:*?"<>|\s]+', "_"), F.lit(most))


def keyword_counts(text: Column, words: list[str]) -> Column:
    """A map of how often each word occurs, without those that don't."""
    n = [((F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w)).cast("int") for w in words]
    return F.map_filter(F.map_from_arrays(F.array(*[F.lit(w) for w in words]), F.array(*n)), lambda _, v: v > 0)


def header_filename(header: Column | str) -> Column:
    """The file name of a Content-Disposition header, decoded."""
    star = F.regexp_extract(header, r"filename\*=(?:UTF-8'')?([^;]+)", 1)
    plain = F.regexp_extract(header, r'filename="?([^";]+)"?', 1)
    return F.when(star != "", F.try_url_decode(star)).otherwise(F.nullif(plain, F.lit("")))


def absolute_url(url: Column, base: str) -> Column:
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(url, "^/+", "")))


# Domains, subjects and publishers of a title.
TITLE_DOMAINS = "語文領域|數學領域|自然科學領域|社會領域|綜合活動領域|健康與體育領域|藝術領域|科技領域"
TITLE_SUBJECTS = "國文 英文 數學 地理 歷史 公民 自然 理化 生物 物理 化學 地科 生活 健體".split()
TITLE_PUBLISHERS = "南一|康軒|翰林|何嘉仁|龍騰|泰宇|全華|五南|旗立|佳音"


def title_fields(title: Column | str) -> Column:
    """School, grade, year, term, domain, subject, test and publisher that a title tells; null where it doesn't."""
    t = F.col(title) if isinstance(title, str) else title

    def one(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))

    subject = one(r"領域\s+(.+?)\s+(?:第[一二三四]次段考|期中考|期末考)")
    return F.struct(
        one("(市立[一-鿿]{2,5}(?:國中|國小|高中)|[一-鿿]{2,5}(?:國中|國小|高中))").alias("school"),
        one("([一二三四五六七八九]年級)").alias("grade"),
        one("([0-9]{3})學年").alias("year"),
        one("([上下]學期)").alias("term"),
        one(f"({TITLE_DOMAINS})").alias("domain"),
        F.coalesce(subject, *[F.when(F.contains(t, F.lit(w)), w) for w in TITLE_SUBJECTS]).alias("subject"),
        one("(第[一二三四]次段考|期中考|期末考)").alias("test_type"),
        one(f"({TITLE_PUBLISHERS})").alias("publisher"),
    )


def nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def path_fields(path: Column) -> Column:
    """stage and grade of the last folder named gradeN, and the last folder that names a term."""
    parts = F.split(path, "/")
    grades = F.filter(parts, lambda p: p.rlike("^grade[0-9]{1,2}$"))
    n = F.regexp_extract(F.try_element_at(grades, F.lit(-1)), "([0-9]+)", 1).try_cast("int")
    stage = F.when(n.between(1, 6), "國小").when(n.between(7, 9), "國中").when(n.between(10, 12), "高中")
    terms = F.filter(parts, lambda p: p.rlike("[上下]學期"))
    return F.struct(n.alias("grade_num"), stage.alias("stage"), nonempty(F.regexp_extract(F.try_element_at(terms, F.lit(-1)), "([上下]學期)", 1)).alias("path_term"))


def year_subject(url: Column) -> Column:
    """year and subject that the last part of an encoded address tells."""
    last = F.coalesce(F.try_url_decode(F.substring_index(url, "/", -1)), F.substring_index(url, "/", -1))
    stem = F.regexp_replace(last, r"\.[A-Za-z0-9]+$", "")
    year = nonempty(F.regexp_extract(stem, "([0-9]{2,3})(?:學年|學測|分科)", 1))
    subject = F.regexp_replace(F.regexp_replace(stem, "[0-9]{2,3}(?:學年度?|學測|分科測驗)", ""), r"(?U)[^\w]+|試題|試卷|定稿|答案|卷$", "")
    return F.struct(year.alias("year"), nonempty(subject).alias("subject"))


# Words of links in menus and footers.
MENU_WORDS = "關於 捐款 粉絲 合作 政策 隱私 登入 搜尋".split()


def chapter_links(links: DataFrame, page: str, host: str, most: int = 3) -> DataFrame:
    """The first links of each page (page, href, text, position) that lead on: not to the page itself, on the host, and to no menu."""
    ok = useful_link(F.col("href"), F.col("text"), host, MENU_WORDS) & (F.col("href") != F.col(page))
    first = Window.partitionBy(page).orderBy("position")
    return links.where(ok).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).drop("_n")


def useful_link(href: Column, text: Column, host: str, stop: list[str]) -> Column:
    """Whether a link stays on the host, has words, and none of those of menus and footers."""
    inside = ~href.rlike("^https?://") | (F.try_parse_url(href, F.lit("HOST")) == host)
    return F.coalesce(inside, F.lit(False)) & (F.trim(text) != "") & ~F.exists(F.array(*[F.lit(s) for s in stop]), lambda s: F.contains(text, s))
