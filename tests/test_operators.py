import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomleaf.operators import analyze, graph, hierarchy, quality, references
from loomleaf import runtime
from loomleaf.runtime import running_total


def brute(links):
    par = {}
    for s, d in links:
        par[d] = min(par.get(d, s), s)
    ids = set(par) | set(par.values())
    out = {}
    for n in ids:
        seen, x = [], n
        while x in par and x not in seen:
            seen.append(x)
            x = par[x]
        if x in par:
            ring = seen[seen.index(x) :]
            out[n] = (min(ring), -1)
        else:
            out[n] = (x, len(seen))
    return out, par


def check_tree(spark, links):
    t = hierarchy.hierarchy(spark.createDataFrame(links, "src string, dst string"))
    rows = t.collect()
    want, par = brute(links)
    assert {r.id: (r.root_id, r.depth) for r in rows} == want
    good = [r for r in rows if r.depth >= 0]
    assert sorted(r.lft for r in good) == list(range(len(good)))
    for r in good:
        path, x = [r.id], r.id
        while x in par:
            x = par[x]
            path.append(x)
        assert r.path == path[::-1]
        inside = {q.id for q in good if r.lft < q.lft <= r.rgt}
        assert inside == {q.id for q in good if r.id in q.path[:-1]}
    return t


def test_hierarchy_shapes(spark):
    chain = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)]
    ring = [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("r2", "t1"), ("t1", "t2")]
    star = [("hub", f"s{i}") for i in range(30)]
    t = check_tree(spark, chain + ring + star + chain[:3] + [("self", "self")])
    d = hierarchy.descendants(t, spark.createDataFrame([("n000",), ("hub",)], "id string")).groupBy("node_id").count().collect()
    assert {r.node_id: r["count"] for r in d} == {"n000": 40, "hub": 30}
    a = hierarchy.ancestors(t, spark.createDataFrame([("n003",)], "id string")).collect()
    assert {(r.ancestor_id, r.distance) for r in a} == {("n000", 3), ("n001", 2), ("n002", 1)}


def test_hierarchy_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(runtime, "hot_limit", lambda n: 5)
    check_tree(spark, [("hub", f"s{i}") for i in range(30)] + [("s1", f"t{i}") for i in range(9)] + [("r1", "r2"), ("r2", "r1")] + [("r1", f"u{i}") for i in range(12)])


def test_hierarchy_empty(spark):
    assert hierarchy.hierarchy(spark.createDataFrame([], "src string, dst string")).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000))
def test_hierarchy_random(spark, seed):
    r = random.Random(seed)
    n = r.randint(2, 25)
    check_tree(spark, [(f"v{r.randrange(n):02}", f"v{i:02}") for i in range(n) if r.random() < 0.8] or [("a", "b")])


def test_prerequisite_links(spark):
    e = spark.createDataFrame([(" Prerequisite\t", "a", "b"), ("prerequisite", "a", "b"), ("related", "c", "d"), (None, "a", "c"), ("prerequisite", None, "b"), ("PREREQUISITE", "", "x")], "relation string, src string, dst string")
    assert [tuple(r) for r in hierarchy.prerequisite_links(e).collect()] == [("a", "b")]


def test_references(spark):
    t = lambda y: datetime(y, 1, 1)
    nodes = spark.createDataFrame([("a", t(2020), None), ("b", t(2020), t(2021)), ("c", t(2025), None), ("d", t(2019), t(2020)), ("d", t(2025), None), (None, t(2020), None)], "id string, created_at timestamp_ntz, deleted_at timestamp_ntz")
    edges = spark.createDataFrame([(1, "a", "b", t(2022)), (1, "a", "b", t(2022)), (2, "c", "zz", t(2022)), (3, "", None, t(2022)), (4, "root", "d", t(2022)), (5, "a", "a", None)], "edge_id bigint, src string, dst string, added_at timestamp_ntz")
    books = spark.createDataFrame([(7, "x", ["1", None, "", "1"], t(2022)), (8, "x", None, t(2022)), (9, None, ["1"], t(2022))], "textbook_id bigint, domain string, aligned_codes array<string>, added_at timestamp_ntz")
    domains = spark.createDataFrame([("root",), (None,)], "root_id string")
    got = references.curriculum_orphans(edges, books, nodes, domains)
    rows = {(r.ref_table, r.ref_key, r.ref_field, r.target_id, r.kind) for r in got.collect()}
    assert rows == {
        ("edges", 1, "dst", "b", "deleted"), ("edges", 2, "src", "c", "late"), ("edges", 2, "dst", "zz", "missing"), ("edges", 4, "dst", "d", "deleted"),
        ("edges", 5, "src", "a", "late"), ("edges", 5, "dst", "a", "late"), ("textbooks", 7, "aligned_codes", "x/1", "missing"),
    }
    assert got.count() == 7
    per = {(r.ref_table, r.period, r.kind): r.n_refs for r in references.orphans_by_period(got).collect()}
    assert per["edges", None, "late"] == 2 and per["textbooks", "2022-01", "missing"] == 1
    none = nodes.limit(0)
    assert references.curriculum_orphans(edges.limit(0), books.limit(0), none, domains.limit(0)).count() == 0


def test_hot_reference(spark, monkeypatch):
    monkeypatch.setattr(runtime, "hot_limit", lambda n: 10)
    t = datetime(2022, 1, 1)
    edges = spark.range(200).select(F.col("id").alias("edge_id"), F.lit("hot").alias("src"), F.lit("gone").alias("dst"), F.lit(t).cast("timestamp_ntz").alias("added_at"))
    nodes = spark.createDataFrame([("hot", datetime(2020, 1, 1), None)], "id string, created_at timestamp_ntz, deleted_at timestamp_ntz")
    books = spark.createDataFrame([], "textbook_id bigint, domain string, aligned_codes array<string>, added_at timestamp_ntz")
    got = references.curriculum_orphans(edges, books, nodes, spark.createDataFrame([], "root_id string"))
    assert got.count() == 200 and {r.ref_field for r in got.collect()} == {"dst"}


def test_running_total(spark):
    d = spark.createDataFrame([(g, f"k{i}", i) for g in ("a", None) for i in range(50)], "g string, k string, v int")
    rows = running_total(d, "g", "k", "v", "before", 100, per_bucket=10).collect()
    for g in ("a", None):
        own = sorted((r.before, r.v) for r in rows if r.g == g)
        assert len(own) == 50 and max(b + v for b, v in own) == sum(range(50))


def test_next_stage(spark):
    n = [("TEST/A-1-1", "I", "A", 1), ("TEST/A-2-1", "II", "A", 1), ("TEST/A-3-1", "III", "A", 1), ("TEST/B-1-1", "I", "B", 1), ("TEST/C-2-5", "II", "C", 5)]
    d = spark.createDataFrame([(*x, "TEST", i) for i, x in enumerate(n)], "id string, stage string, category string, ordinal int, domain string, pos int")
    assert {(r.src, r.dst) for r in graph.link_next(d, "pos").collect()} == {("TEST/A-1-1", "TEST/A-2-1"), ("TEST/A-2-1", "TEST/A-3-1")}
    two = spark.createDataFrame([("a1", "I"), ("a2", "I"), ("b1", "II"), ("b2", "II"), ("x", "?")], "id string, stage string").withColumns({"category": F.lit("A"), "ordinal": F.lit(1), "domain": F.lit("D"), "pos": F.lit(0)})
    assert [(r.src, r.dst) for r in graph.link_next(two, "pos").collect()] == [("a2", "b1")]


def test_mermaid(spark):
    n = spark.createDataFrame([("T/A-1-1", "T", "A-1-1"), ("T/A-1-1", "T", "A-1-1")], "id string, domain string, code string")
    e = spark.createDataFrame([("T/A-1-1", "T/A-2-1", "prerequisite")], "src string, dst string, relation string")
    text = graph.mermaid(n, e).first().diagram
    assert text.startswith("graph LR\n") and "A_1_1" in text and "-->|prerequisite|" in text and text.count("[") == 1


def test_manual_edges(spark):
    d = spark.createDataFrame([("A-1-1 A-2-1 required see  note", "T"), ("# no", "T"), ("", "T"), ("one", "T"), ("T/x y", "T")], "line string, domain string")
    rows = {(r.src, r.dst, r.strength, r.note) for r in graph.parse_manual_edges(d, "line", "domain").collect()}
    assert rows == {("T/A-1-1", "T/A-2-1", "required", "see note"), ("T/x", "T/y", "recommended", None)}


def test_modes_and_imputation(spark):
    d = spark.createDataFrame([(1, "k", "a"), (2, "k", "b"), (3, "k", None), (4, None, "c"), (5, None, None), (6, "z", None)], "i int, k string, v string")
    rows = {r.i: (r.imputed, r.origin) for r in analyze.impute(d, ["k"], "v").collect()}
    assert rows == {1: ("a", "given"), 2: ("b", "given"), 3: ("a", "group"), 4: ("c", "given"), 5: ("c", "group"), 6: (None, "none")}


def test_substring_codes(spark):
    t = spark.createDataFrame([(1, "D", "n-I-10、n-I-1")], "k int, domain string, t string")
    c = spark.createDataFrame([("D", "n-I-1"), ("D", "n-I-10"), ("E", "n-I-1")], "domain string, code string")
    assert {r.code: r.n for r in analyze.match_substrings(t, "k", "t", c).collect()} == {"n-I-1": 2, "n-I-10": 1}
    assert {r.code: r.n for r in analyze.match_codes(t, "k", "t", c).collect()} == {"n-I-1": 1, "n-I-10": 1}


def test_substrings_anywhere(spark):
    t = spark.createDataFrame([(1, "D", "見歷Aa-I-3、xTâi-V-1與Tâi-V-1。1-I-1-I-1"), (2, None, "Aa-I-3")], "k int, domain string, t string")
    c = spark.createDataFrame([("D", "Aa-I-3"), ("D", "歷Aa-I-3"), ("D", "Tâi-V-1"), ("D", "1-I-1"), ("D", "Z-I-1"), (None, "Aa-I-3"), ("D", None)], "domain string, code string")
    got = {(r.k, r.code): r.n for r in analyze.match_substrings(t, "k", "t", c).collect()}
    assert got == {(1, "Aa-I-3"): 1, (1, "歷Aa-I-3"): 1, (1, "Tâi-V-1"): 2, (1, "1-I-1"): 1}
    assert analyze.match_substrings(t, "k", "t", c.limit(0)).count() == 0
    assert {r.code: r.n for r in analyze.match_codes(t, "k", "t", c).collect()}["Tâi-V-1"] == 1


def test_file_findings(spark):
    code = "struct<code:string,stage:string,category:string,ordinal:int,code_format:string>"
    front = "frontmatter struct<title:string,domain:string,source:string,source_url:string,published_date:string>"
    full = ("t", "d", "s", "u", "p")
    rows = [
        (1, "1.0", "x/y/z.md", full, "A", False, "t", "n-I-1、N-1-1、N-1-2", [("n-I-1", "I", "n", 1, "f"), ("n-I-2", "I", None, 2, "f")], 2, 2, ["I"]),
        (2, "1.0", "x/y/z.md", ("t", "d", "s", None, "p"), "C", False, None, None, None, 9, 9, None),
        (3, "1.0", "x/y/z.md", full, "none", True, None, None, [], 1, 0, None),
    ]
    f = spark.createDataFrame(rows, f"file_id long, schema_version string, source_file string, {front}, structure_type string, no_codes boolean, section_5_title string, raw_section_5 string, performance_codes array<{code}>, performance_count int, content_count int, stages_present array<string>")
    c = spark.createDataFrame([(1, 1, 0, "N-1-2", "I", "N", 2, "f"), (2, 1, 1, "N-1-3", "Ⅰ", "N", 3, "f")], "code_id long, file_id long, idx int, code string, stage string, category string, ordinal int, code_format string")
    assert {tuple(r) for r in quality.codes_lost(f, c).collect()} == {(1, "performance", "n-I-2"), (1, "content", "N-1-3")}
    got = sorted((r.entity, r.check, r.severity, r.detail) for r in quality.file_findings(f, c).collect())
    assert got == [
        ("1", "code_fields", "fail", "performance 1 category"), ("1", "code_stages", "fail", "Ⅰ"), ("1", "round_trip", "fail", "content N-1-3"), ("1", "round_trip", "fail", "performance n-I-2"),
        ("2", "frontmatter", "fail", "source_url"), ("2", "structure_type", "fail", "C"), ("3", "no_codes_performance_count", "warn", "1"),
    ]


def test_verify_graph(spark):
    from loomleaf.plans import pipelines

    n = spark.createDataFrame([("D/a", "D", "a", "I", "c", "content", None, 1, "f")], "id string, domain string, code string, stage string, category string, type string, code_format string, ordinal int, source_file string")
    e = spark.createDataFrame([(1, "D/a", None, "related", "x"), (2, "D/a", "D/a", None, "x")], "edge_id long, src string, dst string, relation string, source string")
    got = sorted((r.check, r.entity, r.detail) for r in pipelines.verify_graph(n, e, whole=(n.limit(0), e)).collect())
    assert got == [("dangling_dst", "?", "related"), ("edge_fields", "D/a ?", "dst"), ("edge_fields", "D/a D/a", "relation"), ("missing_fields", "D/a", "code_format"), ("whole_nodes", "D/a", "missing")]


def test_checks(spark):
    d = spark.createDataFrame([(1, "s", "n", "0" * 64, "long enough text"), (2, None, None, "x", ""), (3, "s", "n", "x", "y")], "exam_id int, source string, original_filename string, sha256 string, body string")
    assert {(r.entity, r.check) for r in quality.exam_checks(d).collect()} == {("2", "source"), ("3", "sha256")}
    assert quality.status(quality.exam_checks(d)).first().code == 1


def test_alignment_of_a_large_domain(spark, tmp_path):
    """lists of codes went along with every textbook, so the work was their number times that of the textbooks."""
    import time

    import duckdb

    from loomleaf.plans import catalog

    odd = [("D", "I", "a", "content"), ("D", "I", "a", "performance"), ("D", None, "b", "performance"), ("D", "II", "b", "performance"), ("D", "II", None, "content"), ("D", "*", "0", None), (None, "I", "z", "content")]
    many = spark.range(60_000).selectExpr("'L' domain", "concat('s', id % 2) stage", "concat('c', id) code", "if(id % 3 = 0, 'content', 'performance') type")
    nodes = spark.createDataFrame(odd, "domain string, stage string, code string, type string").unionByName(many).selectExpr("*", "monotonically_increasing_id() node_row")
    books = spark.createDataFrame([(1, "D", "I"), (2, "D", None), (3, "D", "*"), (4, "D", "III"), (5, None, "I"), (6, None, None), (7, "E", None)], "textbook_id long, domain string, stage string")
    books = books.unionByName(spark.range(100, 6_100).selectExpr("id textbook_id", "'L' domain", "if(id % 4 = 0, null, 's1') stage"))
    nodes.write.parquet(f"{tmp_path}/nodes.parquet")
    books.write.parquet(f"{tmp_path}/textbooks.parquet")
    began = time.time()
    df = catalog.textbook_alignment(spark, str(tmp_path))
    got = sorted(tuple(r) for r in df.select("textbook_id", "n_codes", "n_performance", "n_content", "first_code").collect())
    assert time.time() - began < 30 and "collect_set" not in df._jdf.queryExecution().optimizedPlan().toString()
    con = duckdb.connect()
    for t in ("nodes", "textbooks"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    con.execute("CREATE TEMP TABLE few AS SELECT * FROM textbooks WHERE textbook_id < 104")
    con.execute("CREATE OR REPLACE VIEW textbooks AS SELECT * FROM few")
    assert got[:11] == sorted(con.execute(catalog.SQL["textbook_alignment"]).fetchall()) and len(got) == 6_007
    lists = {r.textbook_id: r for r in analyze.align_textbooks(books.where("textbook_id < 10"), nodes).collect()}
    assert all(len(lists[n[0]].codes) == n[1] and (lists[n[0]].codes or [None])[0] == n[4] for n in got[:7]) and lists[3].codes == ["0"]


@pytest.mark.parametrize("name", ["p2_found", "p2_by_period", "p6_found", "p6_cycles"])
def test_entry_runs(spark, name):
    import __spark_entry__

    assert __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
