import pytest
from pyspark.sql import functions as F

from loomleaf.functions import rules, text
from loomleaf.functions.charset import decoded_utf8, name_from_charset, path_from_latin1, utf8_from_latin1

CODES = [
    ("n-I-1 理解一千以內數。", ["n-I-1"]), ("n-Ⅰ-2 理解加法。", ["n-Ⅰ-2"]), ("1-Ⅱ-1 listen", ["1-Ⅱ-1"]), ("ti-Ⅱ-1 reasoning", ["ti-Ⅱ-1"]), ("abcd-III-1 (4 chars, should skip)", []),
    ("Ab-Ⅱ-1 字音", ["Ab-Ⅱ-1"]), ("INa-Ⅱ-1 cross concept", ["INa-Ⅱ-1"]), ("歷Aa-IV-1 history", ["歷Aa-IV-1"]), ("I have a cat.", []), ("This is a 3-4-5 triple.", ["3-4-5"]), ("理解n-I-1", ["理解n-I-1"]), ("ti-Ⅴc-1", ["ti-Ⅴc-1"]), ("A-VV-3", ["A-VV-3"]), ("", []), (None, None),
]


def test_codes(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CODES)], "i int, t string").select("i", text.codes("t").alias("c")).collect()
    assert {r.i: r.c for r in rows} == {i: c for i, (_, c) in enumerate(CODES)}


@pytest.mark.parametrize("code, stage, category, kind", [("歷Aa-IV-1", "IV", "Aa", "content"), ("ti-Ⅴc-1", "V", "ti", "performance"), ("3-4-5", "IV", "3", "performance"), ("A-VV-3", "VV", "A", "content")])
def test_parts(spark, code, stage, category, kind):
    p = spark.range(1).select(text.code_parts(F.lit(code)).alias("p")).first().p
    assert (p.stage, p.category, p.kind) == (stage, category, kind)


def test_math_codes(spark):
    r = spark.range(1).select(text.codes(F.lit("N-1-1 一百以內的數。"), True).alias("c")).first()
    assert r.c == ["N-1-1"]


def test_frontmatter(spark):
    t = '---\ntitle: "T"\n# note\n\nurl: http://a:b\ntags: [curriculum, "108"]\ntitle: U\n---\n\nbody'
    r = spark.createDataFrame([(t,), ("no fence",), ("---\na: 1\n",)], "t string").select(text.frontmatter("t").alias("m"), text.body("t").alias("b")).collect()
    assert r[0].m == {"title": "U", "url": "http://a:b", "tags": '[curriculum, "108"]'}
    assert r[1].m == {} and r[2].m == {} and r[0].b.strip() == "body"
    assert spark.range(1).select(text.frontmatter_list(F.lit('[curriculum, "108"]')).alias("x")).first().x == ["curriculum", "108"]


def test_section(spark):
    t = "目次\n伍、學習重點 ............. 6\n\f伍、 學習重點\nn-I-1 數\n陸、實施要點\n完"
    r = spark.createDataFrame([(t,), ("none",)], "t string").select(text.section_title("t").alias("a"), text.section("t").alias("s")).collect()
    assert r[0].a == "伍、 學習重點" and r[0].s == "伍、 學習重點\nn-I-1 數"
    assert r[1].a == "" and r[1].s == ""


def test_levels(spark):
    t = "前言\n國民小學教育階段\na\n一、國民中學\nb"
    r = spark.range(1).select(text.structure_type(F.lit(t)).alias("s"), text.level_chunks(F.lit(t)).alias("c")).first()
    assert r.s == "B" and len(r.c) == 2 and r.c[0].startswith("國民小學教育階段")


def test_names(spark):
    r = spark.createDataFrame([("3E10812.doc",), ("6C11411A.doc",), ("5Z10922.doc",), ("x.doc",), (None,)], "n string").select(rules.coded_name("n").alias("c")).collect()
    assert (r[0].c.grade, r[0].c.subject, r[0].c.semester, r[0].c.test_type) == (3, "英文", "上學期", "期末考")
    assert r[1].c.variant == "A" and r[2].c.subject == "?" and r[3].c is None and r[4].c is None
    e = spark.range(1).select(rules.exam_name(F.lit("111-數學a.pdf")).alias("e")).first().e
    assert (e.year_roc, e.subject, e.variant, e.test_type) == ("111", "數學", "a", "學測")


def test_votes(spark):
    d = spark.createDataFrame([("理化 地科 英語",), ("英語",), ("",), (None,)], "b string")
    r = d.select(rules.vote(F.col("b"), rules.SUBJECT_BY_BODY).alias("v"), rules.first_match(F.col("b"), rules.SUBJECT_BY_BODY).alias("f")).collect()
    assert [x.v for x in r] == ["自然科學", None, None, None]
    assert [x.f for x in r] == ["自然科學", "英文", None, None]


def test_charsets(spark):
    bad = "國語文測驗".encode().decode("latin-1")
    d = spark.createDataFrame([(bad,), ("國語",), ("Café",), (None,), ("",)], "n string")
    assert [r[0] for r in d.select(utf8_from_latin1("n")).collect()] == ["國語文測驗", "國語", "Café", None, ""]
    assert d.select(path_from_latin1(F.concat(F.lit("a/"), "n"))).first()[0] == "a/國語文測驗"
    big5 = "國文".encode("big5").decode("latin-1")
    assert spark.range(1).select(name_from_charset(F.lit(big5), "big5")).first()[0] == "國文"
    assert spark.createDataFrame([(bytearray(b"\xe5\x9c\x8b\xff"),)], "b binary").select(decoded_utf8("b")).first()[0] == "國�"


def test_small_builders(spark):
    r = spark.range(1).select(
        text.slug(F.lit("a/b: c*d")).alias("slug"), text.header_filename(F.lit("attachment; filename*=UTF-8''%E5%9C%8B.pdf")).alias("file"), text.absolute_url(F.lit("/x"), "http://a.b/").alias("url"),
        text.stage_from_path(F.lit("/topics/math-1"), F.lit("")).alias("stage"), text.sorted_stages(F.array(F.lit("V"), F.lit("I"), F.lit("x"), F.lit("I"))).alias("st"), text.keyword_counts(F.lit("ababa"), ["ab", "z"]).alias("k"),
    ).first()
    assert (r.slug, r.file, r.url, r.stage, r.st, r.k) == ("a_b_c_d", "國.pdf", "http://a.b/x", "I", ["I", "V", "x"], {"ab": 2})
