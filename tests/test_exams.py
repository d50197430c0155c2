"""Names, paths and titles of exam files, pages, writers and record checks, by small cases."""

import pytest
from pyspark.sql import functions as F

from loomleaf.functions import exams, rules, text
from loomleaf.operators import graph, quality
from loomleaf.operators import references as R
from loomleaf.plans import pipelines
from loomleaf.sources import curricula, readers, reports, writers


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize(
    "name, want",
    [
        ("3E10812.doc", (3, "英文", "108", "上學期", "期末考", None)), ("5C10811.doc", (5, "國文", "108", "上學期", "期中考", None)), ("6C11411A.doc", (6, "國文", "114", "上學期", "期中考", "A")),
        ("5N10922.doc", (5, "自然科學", "109", "下學期", "期末考", None)), ("5Z10922.doc", (5, "?", "109", "下學期", "期末考", None)),
    ],
)
def test_coded_names(spark, name, want):
    assert tuple(one(spark, rules.coded_name(F.lit(name)))) == want


@pytest.mark.parametrize("name, want", [("111-數學a.pdf", ("111", "數學", "a", "學測")), ("108-國寫試卷定稿.pdf", ("108", "國文", None, "學測")), ("107-公民與社會.pdf", ("107", "社會", None, None)), ("110_分科物理試題.docx", ("110", "自然科學", None, "分科")), ("notes.pdf", (None, None, None, None))])
def test_national_names(spark, name, want):
    assert tuple(one(spark, exams.national_record(F.lit(name)))) == want


def test_index_fields(spark):
    paths = ["exams/melances/grade3/上學期/市立大樹國小 國語 期中考 翰林.pdf", "exams/110-英文.pdf", "exams/ddes/5C10811.doc", "exams/text/115-數學a.txt", "x/grade10/a.pdf", None]
    d = spark.createDataFrame([(p, 7) for p in paths], "p string, n long")
    rows = [tuple(r) for r in d.select(*exams.index_fields(F.col("p"), F.col("n"))).collect()]
    assert rows[0][1:] == ("市立大樹國小 國語 期中考 翰林.pdf", 7, "pdf", None, "國小", "國小 3 年級", "國文", "翰林", "期中考", "上學期", "米蘭老師 Drive", "市立大樹國小")
    assert rows[1][3:8] == ("pdf", "110", "高中", "高中", "英文") and rows[1][11].startswith("CEEC 大考")
    assert rows[2][7] == "國文" and rows[3][11].startswith("CEEC 純文字") and rows[4][5:7] == ("高中", "高中 1 年級") and rows[5][7] is None


def test_kinds_of_records(spark):
    d = spark.createDataFrame([("exams/ddes/5C10811.doc",), ("exams/ddes/odd.doc",), ("exams/melances/grade8/下學期/第一次段考/math 109.pdf",), ("exams/109-國綜.pdf",), ("else/x.pdf",)], "p string")
    r = d.select(*exams.record_fields(F.col("p"))).collect()
    assert [x.source for x in r] == ["ddes", "ddes-未解析", "melances", "CEEC", "其他"]
    assert (r[0].school, r[0].license, r[0].stage, r[0].grade_label, r[1].school) == ("大墩國小", "教育部公開資料", "國小", "國小 5 年級", None)
    assert (r[2].stage, r[2].grade_label, r[2].semester, r[2].test_type, r[2].year_roc, r[2].subject) == ("國中", "國中 2 年級", "下學期", "第一次段考", "109", "數學")
    assert (r[3].stage, r[3].subject, r[3].test_type) == ("高中", "國文", "學測") and r[4].license == "不明"


def test_subjects_of_bodies(spark):
    assert one(spark, exams.subject_of_body(F.lit("國　文\n科 理化"))) == "自然科學"
    assert one(spark, exams.voted_subject(F.lit("音樂與美術"))) == "藝術" and one(spark, exams.voted_subject(F.lit("數"))) is None and one(spark, exams.voted_subject(F.lit("社會科 數數數"))) == "社會"
    assert one(spark, exams.domain_of_name(F.lit("115-數學a.txt"), rules.DOMAIN_BY_NAME)) == "數學" and one(spark, exams.domain_of_name(F.lit("ENGLISH.txt"), rules.DOMAIN_BY_NAME)) == "英語文"


def test_title(spark):
    t = one(spark, text.title_fields(F.lit("市立大樹國中 七年級 109 上學期 社會領域 地理 第一次段考 期中考 翰林 試卷")))
    assert tuple(t) == ("市立大樹國中", "七年級", None, "上學期", "社會領域", "地理", "第一次段考", "翰林")
    assert tuple(one(spark, text.title_fields(F.lit("")))) == (None,) * 8


@pytest.mark.parametrize(
    "url, path, want", [("https://x.org/topics/math-1", "", "I"), ("/topics/ele-c", "", "I"), ("/topics/jun-c?x=1", "", "IV"), ("/topics/eng-senior10", "", "V"), ("/topics/other", "a/stage-II-9.md", "II"), ("/else", "stage-II-9.md", None), (None, "b/math-9to10.md", "IV"), ("", "stage-II-9.md", None)]
)
def test_stage_of_address(spark, url, path, want):
    assert one(spark, text.stage_from_path(F.lit(url).cast("string"), F.lit(path))) == want


def test_headings_and_chapters(spark):
    t = "國民中學教育階段及普通型高級中等學校必修課程學習重點\na\n 三、普通型高級中等學校必修課程加深加廣選修課程\nb"
    assert one(spark, text.structure_type(F.lit(t))) == "B"
    c = one(spark, text.chapters(F.lit("### 學習評量\n### 第1章 光\n### a: b\n第二章 聲\n第三單元\n其他\n【上】單元")))
    assert [x.title for x in c] == ["第1章 光", "第二章 聲", "第三單元", "【上】單元"]


@pytest.mark.parametrize("name, want", [("01-115學測國綜試卷.pdf", ("115", "國綜")), ("%E5%9C%8B%E6%96%87.pdf", ("unknown", "國文")), ("x.pdf", ("unknown", "unknown"))])
def test_link_subjects(spark, name, want):
    assert tuple(one(spark, exams.link_year_subject(F.lit("http://h/" + name)))) == want


def test_pages(spark):
    long = "正文" * 60
    pages = spark.createDataFrame([(1, f"<body><nav>menu</nav><article>short</article><div id='content'><p>{long}</p><script>x</script></div></body>"), (2, "<body>few</body>"), (3, None)], "k int, h string")
    got = {r.k: (r.text, r.error) for r in readers.main_text(pages, "k", "h", error_below=50).collect()}
    assert got == {1: (long, None), 2: ("few", "too short"), 3: ("", "too short")}
    links = readers.html_links(spark.createDataFrame([(1, "<h2>國文</h2><a href='/a/b/'>下載試題</a><h2>試題</h2><a href='/c/d?x=1'>試題</a>")], "k int, h string"), "k", "h")
    assert {(r.href, r.title) for r in readers.link_titles(readers.marked_links(links, "試題")).collect()} == {("/a/b/", "國文"), ("/c/d?x=1", "d")}
    assert one(spark, readers.embedded_folder(F.lit('<iframe src="u?id=F1"></iframe><a href="https://d/embeddedfolderview?id=A-2#list">x</a>'))) == "A-2"
    assert [tuple(x) for x in one(spark, readers.named_files(F.lit('<a href="/file/d/I1/view">甲.pdf</a><a href="/file/d/I1/view">乙</a>')))] == [("I1", "甲.pdf")]
    a = spark.createDataFrame([("p", "q"), ("p", "r")], "page string, href string")
    b = spark.createDataFrame([("q", "z", "t"), ("r", "z", "t"), ("s", "y", "u")], "page string, href string, text string")
    assert [tuple(x) for x in readers.two_levels(a, b).collect()] == [("p", "z", "q", "t")]
    c = spark.createDataFrame([("p", "p", "x", 0), ("p", "/1", "一", 1), ("p", "/2", "捐款", 2), ("p", "https://h/3", "三", 3), ("p", "https://o/4", "四", 4), ("p", "/5", "五", 5), ("p", "/6", "六", 6)], "page string, href string, text string, position int")
    assert [r.href for r in text.chapter_links(c, "page", "h").orderBy("position").collect()] == ["/1", "https://h/3", "/5"]


def test_readers_by_order(spark, tmp_path):
    for n in ("b.txt", "a.txt", "c.txt"):
        (tmp_path / n).write_text("x")
    assert [r.path[-5:] for r in readers.files(spark, str(tmp_path), ["txt"], 2).collect()] == ["a.txt", "b.txt"]
    fails = lambda b: (_ for _ in ()).throw(ValueError("first"))
    assert readers.first_text(fails, lambda b: "text")(b"") == "text"
    with pytest.raises(ValueError, match="first"):
        readers.first_text(fails, lambda b: " ")(b"")
    assert curricula.curricula(spark).where("kind = 'document'").count() == 20


def test_parsed_kinds(spark):
    docs = spark.createDataFrame([("a", "總綱", "x"), ("b", "社會", "x"), ("c", "社會", "伍、學習重點\nn-I-1 一")], "path string, domain string, text string")
    got = {r.path: (r.structure_type, len(r.warnings)) for r in readers.parsed_markdown(docs).collect()}
    assert got == {"a": ("none", 0), "b": ("unknown", 2), "c": ("A", 1)}


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([(1, "a/x.md", "0123456789"), (2, "a/x.md", "abcdefabcd"), (3, "b.md", "ffff"), (4, "a/x.md", None)], "k int, path string, sha string")
    assert {r.k: r.path for r in writers.digest_paths(d, "path", "sha").collect()} == {1: "a/x-0123.md", 2: "a/x-abcd.md", 3: "b.md", 4: "a/x.md"}
    links = F.array(*[F.struct(F.lit("a").alias("kind"), F.lit(f"/{i}").alias("href"), F.lit("t").alias("text")) for i in range(25)])
    doc = one(spark, writers.chapter_text(F.lit("光"), F.lit("u"), F.lit("正文"), links))
    assert doc.count("- a: [t](") == 20 and doc.startswith("---\ntitle: 光\n")
    assert [tuple(r) for r in writers.planned(d.withColumn("t", F.lit("正")), ["path"], "t").where("path = 'b.md'").collect()] == [("b.md", 1, 3)]
    out = writers.documents_in_files(d.where("k in (1, 3)").withColumn("t", F.lit("正文")), tmp_path.as_uri(), "path", "t")
    assert out.agg(F.sum("written")).first()[0] == 12 and (tmp_path / "a" / "x.md").read_text() == "正文"


def test_record_checks(spark):
    sha = "a" * 64
    rows = [(1, "s", "o/1", sha, 5, "body long enough"), (2, "s", "o/2", sha, 5, "body long enough"), (3, "t", "o/3", sha, 5, "body long enough"), (4, None, "o/4", sha, 5, None), (5, "s", "o/1", sha, 5, "x"), (5, "s", "o/1", sha, 5, "x")]
    e = spark.createDataFrame(rows, "exam_id long, source string, original_path string, sha256 string, size long, body string").withColumns({"original_filename": F.lit("5C10811.doc"), "test_type": F.lit(None).cast("string")})
    there = spark.createDataFrame([("o/1", sha), ("o/3", sha), ("o/2", "b" * 64)], "path string, sha256 string")
    got = {(r.entity, r.check, r.severity) for r in quality.record_findings(e, ("source", "original_path", "sha256", "size"), ("s",), "^o/", there).collect()}
    assert got == {("2", "sha256", "fail"), ("3", "source_invalid", "warn"), ("4", "required_fields", "fail"), ("5", "body_empty", "fail")}
    assert quality.samples(quality.record_findings(e, ("source",), ("none",), "^z"), 1).count() == 4


def test_kinds_of_orphans(spark):
    ts = "2024-01-{:02d} 00:00:00".format
    nodes = spark.createDataFrame([("a", ts(1), ts(5)), ("b", ts(20), None), ("c", ts(1), ts(3)), ("c", ts(8), ts(12)), ("a", ts(1), ts(5))], "id string, created_at string, deleted_at string")
    nodes = nodes.select("id", F.col("created_at").cast("timestamp_ntz").alias("created_at"), F.col("deleted_at").cast("timestamp_ntz").alias("deleted_at"))
    refs = spark.createDataFrame([(1, "a", ts(2)), (2, "a", ts(6)), (3, "b", ts(2)), (4, "z", ts(2)), (5, "c", ts(9)), (6, "c", ts(4)), (7, "a", None), (8, "", ts(1)), (9, None, ts(1)), (1, "a", ts(2))], "key long, target string, t string")
    refs = refs.select("key", "target", F.col("t").cast("timestamp_ntz").alias("at"))
    got = {r.ref_key: r.kind for r in R.orphan_references([R.Reference("t", "f", refs)], R.parent_intervals(nodes), None, R.parent_lives(nodes)).collect()}
    assert got == {1: "removed", 2: "deleted", 3: "late", 4: "missing", 5: "removed", 6: "deleted", 7: "deleted"}


def test_reports(spark):
    probes = spark.createDataFrame([("u1", 200, "pdf", 9, None), ("u2", 404, None, None, None), ("u3", None, None, None, "timeout")], "url string, status int, type string, size long, error string")
    assert {r.outcome: r.n for r in reports.probe_report(probes).collect()} == {"ok": 1, "other": 1, "error": 1}
    t = reports.grade_table(spark.createDataFrame([("國小 2 年級", "國文"), ("高中", None), (None, "國文")], "grade string, subject string")).orderBy("place").collect()
    assert [r.place for r in t] == [1, 1, 7, 7, 9, 9] and {r.subject for r in t} == {"國文", "未分", "總計"}


def test_rereading(spark):
    e = spark.createDataFrame([(1, None, "x", "p1"), (2, "國文", "x", "p2"), (3, None, "y" * 60, "p3"), (4, "", None, "p4")], "exam_id long, subject string, body string, original_path string")
    files = spark.createDataFrame([(p, "pdf", 1, "s", b"1") for p in ("p1", "p2", "p3", "p4")], "path string, ext string, size long, sha256 string, content binary")
    got = {r.exam_id: r.subject for r in pipelines.reread(files, e, {"pdf": lambda b: "數學科 試題"}).collect()}
    assert got == {1: "數學", 4: "數學"}


def test_entered_lines(spark):
    d = spark.createDataFrame([("a b recommended " + "w " * 1200,), ("lonely",), ("# no",), ("",)], "line string").withColumn("domain", F.lit("D"))
    assert len(graph.parse_manual_edges(d, "line", "domain").first().note.split()) == 1200
    assert [r.line for r in graph.manual_edge_warnings(d, "line", "domain").collect()] == ["lonely"]


def test_next_stage_of_a_hot_group(spark):
    rows = [(f"n{i:03d}", "D", "A", 1, ("I", "II", "IV", "x")[i % 4], i) for i in range(200)]
    n = spark.createDataFrame(rows, "id string, domain string, category string, ordinal int, stage string, at int")
    assert {(r.src, r.dst) for r in graph.link_next(n, "at").collect()} == {("n196", "n001"), ("n197", "n002")}
