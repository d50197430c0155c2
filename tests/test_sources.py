import io
import json
import zipfile

from pyspark.sql import functions as F

from loomleaf.sources import readers, writers
from loomleaf.streaming import ingest


def test_markdown(spark, tmp_path):
    (tmp_path / "數學").mkdir()
    (tmp_path / "數學" / "a.md").write_text("---\ntitle: T\n---\n\n伍、學習重點\nn-I-1 數\nN-1-1 量\nAb-Ⅱ-1 字", "utf-8")
    (tmp_path / "數學" / "_index.md").write_text("x", "utf-8")
    d = readers.markdown(spark, str(tmp_path))
    assert [(r.domain) for r in d.collect()] == ["數學"]
    p = readers.parsed_markdown(d).first()
    assert p.frontmatter == {"title": "T"} and p.structure_type == "A" and p.stages_present == ["I", "II"]
    assert [c.code for c in p.performance_codes] == ["n-I-1"] and [c.code for c in p.content_codes] == ["N-1-1", "Ab-Ⅱ-1"]
    assert readers.markdown(spark, str(tmp_path), ["無"]).count() == 0


def test_structured(spark, tmp_path):
    (tmp_path / "a.structured.json").write_text(json.dumps({"domain": "D", "performance_codes": [{"code": "n-I-1", "ordinal": 1}]}), "utf-8")
    (tmp_path / "b.structured.json").write_text("{broken", "utf-8")
    rows = readers.structured(spark, str(tmp_path)).orderBy("path").collect()
    assert rows[0].performance_codes[0].code == "n-I-1" and rows[1].domain is None and rows[1]._corrupt


def test_files(spark, tmp_path):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>甲</w:t><w:t>乙</w:t></w:p><w:p><w:t>丙</w:t></w:p></w:document>')
    (tmp_path / "a.docx").write_bytes(b.getvalue())
    (tmp_path / "b.docx").write_bytes(b"no zip")
    (tmp_path / "c.xlsx").write_bytes(b"x")
    (tmp_path / "d.txt").write_bytes("國".encode() + b"\xff")
    rows = {r.path.rsplit("/", 1)[1]: r for r in readers.extracted(readers.files(spark, str(tmp_path))).collect()}
    assert rows["a.docx"].text == "甲乙\n丙" and rows["a.docx"].reason is None
    assert rows["b.docx"].text is None and rows["b.docx"].reason.startswith("docx-skipped")
    assert rows["c.xlsx"].reason.startswith("xlsx-skipped") and rows["d.txt"].text == "國�"
    assert readers.files(spark, str(tmp_path), ["txt"]).count() == 1


def test_html(spark):
    html = '<h2>Part</h2><a href="/a">A</a><a href="/a">again</a><main><p>x &amp; y</p><script>no</script></main><iframe src="/v"></iframe>folders/abc-1 folders/abc-1'
    d = spark.createDataFrame([(1, html), (2, ""), (3, None)], "k int, h string")
    assert {(r.kind, r.href, r.text, r.heading) for r in readers.html_links(d, "k", "h").collect()} == {("a", "/a", "A", "Part"), ("iframe", "/v", "", "Part")}
    texts = {r.k: r.text for r in readers.html_text(d, "k", "h", 3).collect()}
    assert texts == {1: "x & y", 2: "", 3: ""}
    assert d.select(readers.folder_ids(F.col("h"))).first()[0] == ["abc-1"]


def test_failure_log(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"total": 3, "success": 1, "fail": [{"path": "a", "reason": "xlsx-skipped: x"}, {"path": "b", "reason": "pdf"}]}), "utf-8")
    assert readers.failure_log(spark, str(tmp_path / "f.json")).count() == 2


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([(1, "a: b", None, "x/y", "f" * 64), (2, "c", "d", "x/y", "f" * 64)], "i int, t string, u string, s string, h string")
    doc = d.select(writers.frontmatter_text([("t", F.col("t")), ("u", F.col("u"))], F.lit("body")).alias("d")).collect()
    assert doc[0].d == '---\nt: "a: b"\n---\n\nbody' and "u: d" in doc[1].d
    p = d.select("i", writers.output_path([F.col("s"), F.lit(None)], [F.lit("k")], F.col("h")).alias("p"))
    assert {r.p for r in writers.distinct_paths(p, "p", "i").collect()} == {"x_y/未分/k-ffffffff.md", "x_y/未分/k-ffffffff-2.md"}
    page = spark.range(1).select(writers.upsert_section(F.lit("# P\n\n## S\nold\n\n## T\nkept"), "S", F.lit("new")).alias("p")).first().p
    assert "old" not in page and page.endswith("## S\nnew\n") and "kept" in page
    out = str(tmp_path / "out")
    writers.write_documents(d.withColumn("x", writers.json_documents(d)), out, "x", ["i"])
    assert spark.read.json(out).count() == 2


def test_streams(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:00:01", "a"), (2, "2024-01-01 01:00:00", "b")], "k int, at string, t string").withColumn("at", F.to_timestamp("at"))
    rows.write.mode("append").parquet(src)
    run = lambda: ingest.run_available(ingest.once_each(ingest.new_rows(spark, src, "k int, at timestamp, t string"), "k", "at", "1 day"), out, ck)
    run()
    assert spark.read.parquet(out).count() == 2
    rows.limit(1).withColumn("k", F.lit(3)).write.mode("append").parquet(src)
    run()
    assert {r.k for r in spark.read.parquet(out).collect()} == {1, 2, 3}
    n = ingest.windowed_counts(ingest.new_rows(spark, src, "k int, at timestamp, t string"), "at", "t", "30 minutes", "5 minutes")
    ingest.run_available(n, str(tmp_path / "n"), str(tmp_path / "nck"))
    assert spark.read.parquet(str(tmp_path / "n")).count() >= 1


def test_listings(spark):
    html = '<div data-id="a1" class="x">\n Paper 1.pdf </div><div data-id="b2">Notes</div><div data-id="a1">again.pdf</div><div data-id="c3">x.DOCX</div>'
    rows = spark.createDataFrame([(html,), ("",), (None,)], "h string").select(readers.listed_files(F.col("h")).alias("f")).collect()
    assert [(p.id, p.name) for p in rows[0].f] == [("a1", "Paper 1.pdf"), ("c3", "x.DOCX")] and rows[1].f == [] and rows[2].f is None
    d = spark.createDataFrame([("k", 1, 404), ("k", 2, 200), ("k", 3, 200), ("z", 1, 500)], "k string, o int, status int")
    assert [tuple(r) for r in readers.first_valid(d, "k", "o", F.col("status") < 400).collect()] == [("k", 2, 200)]



def test_pipelines(spark, tmp_path):
    from loomleaf.plans import pipelines

    d = tmp_path / "drive" / "grade7" / "上學期"
    d.mkdir(parents=True)
    (d / "7N11421.txt").write_text("實驗 試管", "utf-8")
    (d / "109-無題.txt").write_text("社會科：史料與地圖", "utf-8")
    (d / "b.xlsx").write_bytes(b"x")
    records, failures = pipelines.extract_exams(spark, str(tmp_path))
    rows = {r.original_filename: r for r in records.collect()}
    assert rows["109-無題.txt"].subject == "社會" and rows["109-無題.txt"].year_roc == "109" and rows["109-無題.txt"].grade_num == 7 and rows["109-無題.txt"].path_term == "上學期"
    assert [r.reason.split(":")[0] for r in failures.collect()] == ["xlsx-skipped"]
    index = spark.createDataFrame([("D", "T"), ("D", "U")], "domain string, title string")
    parsed = spark.createDataFrame([("a", "D", {"title": "T"}, "A", [1], [2, 3]), ("b", "D", {"title": "T"}, "B", [1], [2])], "path string, domain string, frontmatter map<string,string>, structure_type string, performance_codes array<int>, content_codes array<int>")
    got = {r.title: r.structure_type for r in pipelines.aggregate_index(index, parsed).collect()}
    assert got == {"T": "B", "U": None}
    exams = spark.createDataFrame([(1, "高中", "x", "國文", "109", "f" * 64, "body"), (2, None, None, None, None, None, None)], "exam_id int, stage string, grade_label string, subject string, year_roc string, sha256 string, body string").withColumns({"semester": F.lit(None).cast("string"), "test_type": F.lit("期中考")})
    docs = {r.exam_id: r for r in pipelines.exam_documents(exams).collect()}
    assert docs[1].path == "高中/x/國文/109-期中考-ffffffff.md" and "subject: 國文" in docs[1].text and docs[2].path.startswith("未分/未分/未分/")


def test_whole_reports(spark):
    from loomleaf.sources import reports

    n = 2_500
    failures = spark.range(n).selectExpr("concat('p', id) AS path", "'r' AS reason")
    rows = reports.failure_document(failures, spark.range(3_000)).collect()
    assert sorted(x.path for r in rows for x in r.fail) == sorted(f"p{i}" for i in range(n))
    assert {(r.total, r.success, r.fail_count) for r in rows} == {(3_000, 500, n)} and [r.part for r in sorted(rows, key=lambda r: r.part)] == [0, 1, 2]
    none = reports.failure_document(failures.limit(0), spark.range(2)).collect()
    assert [(r.total, r.success, r.fail_count, r.part, r.fail) for r in none] == [(2, 2, 0, 0, [])]
    counts = spark.range(n).selectExpr("'d' AS dimension", "concat('v', id) AS value", "id AS n")
    assert reports.index_report(counts).first().report.split("\n") == ["## d", ""] + [f"* v{i}: {i}" for i in reversed(range(n))]
    outline = spark.range(n).selectExpr("'d' AS domain", "'I' AS stage", "cast(id as string) AS category", "1 AS n")
    assert reports.outline_report(outline).first().report.count("\n") == n + 1
