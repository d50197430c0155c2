import random
import time
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomleaf.llm import canonical, encoding, leakage, mixing, scans, subjects, unify

# --- 1 -------------------------------------------------------------------------------------------


SLIPS = frozenset({("敷", "數")})


def distance(a, b):
    """Weighted edit distance with swaps, by the full table."""
    alike = SLIPS
    d = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i == 0 and j == 0:
                d[i, j] = 0.0
                continue
            best = 99.0
            if i:
                best = min(best, d[i - 1, j] + 1)
            if j:
                doubled = i and b[j - 1] == a[i - 1] or j > 1 and b[j - 1] == b[j - 2]
                best = min(best, d[i, j - 1] + (canonical.DOUBLED if doubled else 1))
            if i and j:
                c = 0 if a[i - 1] == b[j - 1] else canonical.SLIP if (b[j - 1], a[i - 1]) in alike else canonical.OTHER
                best = min(best, d[i - 1, j - 1] + c)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and a[i - 1] != a[i - 2]:
                best = min(best, d[i - 2, j - 2] + canonical.SWAPPED)
            d[i, j] = best
    return d[len(a), len(b)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc國文數", min_size=1, max_size=6), min_size=1, max_size=5), st.text("abc國文數敷", min_size=1, max_size=7))
def test_trie_finds_what_the_table_finds(entries, word):
    t = canonical.Trie([(e, i) for i, e in enumerate(entries)], SLIPS)
    latin = word.isascii()
    want = {i: distance(e, word) for i, e in enumerate(entries) if distance(e, word) <= canonical.limit(max(len(e), len(word)), latin)}
    got = t.search(word)
    assert {i: round(v, 6) for i, v in got.items()} == {i: round(v, 6) for i, v in want.items()}


ENTRIES = [("subject", 1, "國文", "Chinese", ["國語", None]), ("subject", 3, "數學", None, None), ("test_type", 1, "期中考", "Midterm", [])]
ENTRY = "field string, value_id int, canonical string, name_en string, aliases array<string>"


def test_mapping(spark):
    entries = spark.createDataFrame(ENTRIES, ENTRY)
    rows = [(1, "國文", "期中"), (2, "国文", None), (2, "国文", None), (3, " 國 語\n", ""), (4, "數數學", "  "), (5, "午餐", "模型"), (6, "文國", "mditerm"), (7, "x" * 5000, "期中考考"), (8, "??", "　"), (None, "國文x", None)]
    d = spark.createDataFrame(rows, "exam_id bigint, subject string, test_type string").withColumn("value", F.lit("clash")).withColumn("value_id", F.lit(1))
    got = canonical.map_to_entries(d, "exam_id", ["subject", "test_type"], entries)
    assert {(r.exam_id, r.field, r.value_id) for r in got.collect()} == {
        (1, "test_type", 0), (2, "subject", 1), (3, "subject", 1), (4, "subject", 3), (5, "subject", 0), (5, "test_type", 0), (6, "subject", 1), (6, "test_type", 1), (7, "subject", 0), (7, "test_type", 1), (8, "subject", 0),
    }
    assert got.count() == 11
    assert canonical.unmatched_values(got).where("value = '午餐'").first().n_rows == 1
    assert canonical.map_to_entries(d, "exam_id", ["subject"], entries.limit(0)).where("value_id <> 0").count() == 0
    assert canonical.map_to_entries(d.limit(0), "exam_id", ["subject"], entries).count() == 0


def test_all_entries_in_reach(spark):
    fold = canonical.folding(spark)
    paths = canonical.spellings(spark.createDataFrame([("f", 1, "abcdef", None, None), ("f", 2, "abcdeg", None, None), ("f", 3, "uvwxyz", None, ["abcdxf"])], ENTRY), fold)
    got = canonical.entries_in_reach(spark.createDataFrame([("f", "abcdef"), ("g", "abcdef"), ("f", "")], "field string, value string"), paths, fold)
    assert {(r.value_id, round(r.distance, 2)) for r in got.collect()} == {(1, 0), (2, 1.2), (3, 1.2)}


def learning(spark):
    """Records whose file names tell what a name, a mistaken character and words around a name stand for; one name that tells nothing."""
    rows = [(f"國綜 {i}", f"{i}_國文_練習.pdf") for i in range(9)] + [("國綜", "a 國文 b")] * 9 + [("敷學", "數學_1.doc")] * 9
    rows += [("卷甲" + n, "x") for n in ("國文", "數學", "英文")] + [("社團", ("國文", "數學", "英文")[i % 3] + " 1") for i in range(12)] + [("卷甲敷學", "y"), ("卷甲國綜", None)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "exam_id bigint, subject string, original_filename string")
    return d, spark.createDataFrame([*ENTRIES[:2], ("subject", 2, "英文", None, None)], ENTRY)


@pytest.mark.parametrize("block", [canonical.TRIE_PATHS, 1])
def test_learned_aliases(spark, monkeypatch, block):
    monkeypatch.setattr(canonical, "TRIE_PATHS", block)
    d, entries = learning(spark)
    got = {r.value: r.value_id for r in canonical.map_to_entries(d, "exam_id", ["subject"], entries, ["original_filename"]).collect()}
    assert got["國綜"] == 1 and got["敷學"] == 3 and got["社團"] == 0 and got["卷甲英文"] == 2 and got["卷甲敷學"] == 3 and got["卷甲國綜"] == 1
    without = {r.value: r.value_id for r in canonical.map_to_entries(d, "exam_id", ["subject"], entries).collect()}
    assert without["國綜"] == 0 and without["卷甲英文"] == 2


def test_mapping_with_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr("loomleaf.runtime.HOT_ROWS", 20)
    d = spark.range(300).selectExpr("id as exam_id", "if(id % 3 = 0, '国文', concat('數', id)) as subject")
    got = canonical.map_to_entries(d, "exam_id", ["subject"], spark.createDataFrame(ENTRIES, ENTRY))
    assert got.count() == 300 and got.where("value_id = 1").count() == 100


# --- 3 -------------------------------------------------------------------------------------------

PLAIN = "本階段的校園環境以記錄為主，不宜過度強調記憶。"
ENGLISH = "Teachers provide guidance for learners in the classroom"


def scanned(spark, extra):
    many = [(i, "數學", f"伍、學習重點\n{PLAIN}\n{ENGLISH}\n\n{i + 3}\n\f課程手冊．數學\n同學宜在真實情境中說明測量工具。\n{PLAIN}") for i in range(60)]
    return spark.createDataFrame(many + extra, "file_id bigint, domain string, raw_section_5 string").withColumn("text", F.lit("clash"))


def test_scans(spark):
    bad = f"伍、學習重點\n{PLAIN.replace('記憶', '記億')}\nTeachers provide guid-\nance for lcarners in the cla5sroom\n\n12\n\f課桯手冊．數學\n同學宜 在 真 實情境中說明測量工具。（參見 n-2-\n30、n-3-15）"
    d = scanned(spark, [(100, "數學", bad), (100, "數學", bad), (101, None, None), (102, "數學", ""), (103, None, "x" * 20_000), (104, "數學", "年級  1  2  3")])
    got = {(r.line_no, r.kind) for r in scans.scan_noise(d).where("file_id = 100").collect()}
    assert {(6, "remove"), (7, "remove"), (3, "join"), (8, "join"), (4, "char"), (8, "char")} <= got
    assert not {k for k in got if k[0] in (1, 5, 9)}
    kinds = {r.file_id for r in scans.scan_noise(d).collect()}
    assert 104 not in kinds and 101 not in kinds
    text = scans.repaired_text(d).where("file_id = 100").first().text
    assert "guidance for learners in the classroom" in text and "n-2-30、n-3-15" in text and "手冊" not in text and "宜在真實情境" in text
    assert scans.scan_noise(d.limit(0)).count() == 0


def test_glyph_edits_are_learned(spark):
    assert scans.glyph_edits("leamer", "learner") == ("m", "rn") and scans.glyph_edits("learners", "learner") is None and scans.glyph_edits("cat", "dog") is None
    assert "classroom" in scans.variants("cla5sr0om", {"5": ["s"], "0": ["o"]})
    extra = [(200 + i, "數學", "Teachers provide guidance for " + w) for i, w in enumerate(["lcarners in thc classroom", "1earners in the c1assroom", "learners in the classrooms"] * 2)]
    found = {(r.file_id, r.kind) for r in scans.scan_noise(scanned(spark, extra)).where("file_id >= 200").collect()}
    assert {(200, "char"), (201, "char")} <= found and (202, "char") not in found


def test_skip_gram_tells_words_of_one_use():
    r = np.random.default_rng(1)
    words, contexts = [f"w{i}" for i in range(12)], [f"c{i}" for i in range(30)]
    cells = [(w, c, int(1 + 50 * (i % 3 == j % 3) + r.integers(0, 5))) for i, w in enumerate(words) for j, c in enumerate(contexts)]
    model = scans.SkipGram(words, contexts, cells, dict.fromkeys(contexts, 1 / 30))
    n = np.array([[k for w2, _, k in cells if w2 == w] for w in words], float)
    v = model.vectors(n)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cos = v @ v.T
    same = np.array([[i % 3 == j % 3 for j in range(12)] for i in range(12)])
    assert cos[same].min() > cos[~same].max() and np.allclose(model.vectors(n), scans.SkipGram(words, contexts, cells, dict.fromkeys(contexts, 1 / 30)).vectors(n))


def test_rules_in_a_file(spark, monkeypatch):
    bad = f"伍、學習重點\n{PLAIN.replace('記憶', '記億')}\nguidance for lcarners in the cla5sroom"
    d = scanned(spark, [(100, "數學", bad)])
    both = []
    for block in (scans.BLOCK, 2):
        monkeypatch.setattr(scans, "BLOCK", block)
        both.append(({tuple(r) for r in scans.scan_noise(d).collect()}, {tuple(r) for r in scans.repaired_text(d).collect()}))
    assert both[0] == both[1] and "learners" in dict(both[1][1])[100]


@pytest.mark.parametrize("line, page", [("12", True), ("第 3 頁", True), ("— 4 —", True), ("[5]", True), ("．l2．", True), ("27 / 64", True), ("年級  1  2", False), ("n-1-2", False), ("", False), ("Ⅳ", False), ("o", False)])
def test_page_numbers(line, page):
    assert scans.is_page(line) == page


# --- 4 -------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs", "Co", "Cn"], max_codepoint=0x2FFFF), max_size=12)), max_size=8))
def test_composition_agrees_with_the_standard(texts):
    """Where no letter is a look-alike, code points of plain text come out as the standard's NFKC does."""
    odd = {ord(c) for v in unify.LOOKALIKES.values() for c in v}
    texts = [t if t is None or not any(ord(c) in odd or unicodedata.category(c) in ("Cf", "Cc") or 0xFE00 <= ord(c) <= 0xFE0F for c in t) else "ok" for t in texts]
    got = unify.unify_column(pa.array(texts, pa.string())).to_pylist()
    for t, g in zip(texts, got):
        if t is None:
            assert g is None
        else:
            want = unicodedata.normalize("NFKC", t)
            if not any(ord(c) in odd for c in unicodedata.normalize("NFKD", t)):
                assert g == " ".join(x for x in "".join(" " if unicodedata.category(c) in ("Zs", "Zl", "Zp") else c for c in want).split(" ") if x)


def test_words_of_other_alphabets_stay():
    got = unify.unify_column(pa.array(["Москва и Αθήνα", "Тest рaper", "naïve – tеxt", None, "а"])).to_pylist()
    assert got == ["Москва и Αθήνα", "Test paper", "naïve – text", None, "а"]


def test_codes(spark):
    rows = [(1, "D", "視Ｅ-ＩＩ-１", "II"), (2, "D", "Ka-IlI-10", "IIl"), (3, "D", "INa​–V–25", None), (4, "D", "Taî-I-1", "Ⅰ"), (5, "D", "A-I-1", "I"), (6, "D", None, None), (7, "D", "", ""), (8, None, "Ａ-I-1", "I"), (1, "D", "視Ｅ-ＩＩ-１", "II"), (9, "D", "歷Aa-II-3", "ӏI"), (10, "D", "Ａ" * 9000, "I")]
    d = spark.createDataFrame(rows, "code_id bigint, domain string, code string, stage string").withColumn("node_id", F.lit("clash"))
    got = {r.code_id: r.node_id for r in unify.content_code_nodes(d).collect()}
    assert got[1] == "D/視E-II-1" and got[2] == "D/Ka-III-10" and got[3] == "D/INa-V-25" and got[4] == "D/Taî-I-1" and got[9] == "D/歷Aa-II-3"
    assert 5 not in got and 6 not in got and 7 not in got and got[8] is None and got[10] == "D/" + "A" * 9000
    assert unify.content_code_nodes(d.limit(0)).count() == 0


# --- 5 -------------------------------------------------------------------------------------------

NAMES = ["市立鹿橋國中 七年級 國文 期中考.pdf", "自然科學_光合作用學習單12.docx", "Café閱讀測驗_3.pdf", "聖Noël高中", "堃老師講義 1.pdf", "plain.doc"]


def test_encodings(spark):
    wrong = {
        "utf8 as latin-1": lambda s: s.encode().decode("latin-1"), "utf8 as cp437": lambda s: s.encode().decode("cp437"), "utf8 as mac": lambda s: s.encode().decode("mac_roman"),
        "big5 as latin-1": lambda s: s.encode("big5").decode("latin-1"), "twice": lambda s: s.encode().decode("latin-1").encode().decode("latin-1"), "lost": lambda s: s.encode("big5").decode("utf-8", "replace"),
    }
    rows, want = [], {}
    for i, n in enumerate(NAMES * 20):
        rows.append((i, n))
    for how, f in wrong.items():
        k = len(rows)
        rows.append((k, f(NAMES[0])))
        want[k] = None if how == "lost" else NAMES[0]
    k = len(rows)
    rows += [(k, None), (k + 1, ""), (k + 2, "國" * 3000), (k + 3, "鹿橋國小 " + "七年級".encode().decode("latin-1")), (k + 3, "鹿橋國小 " + "七年級".encode().decode("latin-1"))]
    want[k + 3] = "鹿橋國小 七年級"
    d = spark.createDataFrame(rows, "exam_id bigint, name string").withColumn("original", F.lit("clash"))
    got = {r.exam_id: r.original for r in encoding.garbled_values(d, "exam_id", ["name"], []).collect()}
    assert got == want
    assert encoding.garbled_values(d.limit(0), "exam_id", ["name"], []).count() == 0


# --- 7 -------------------------------------------------------------------------------------------


def story(r):
    return "".join(r.choice(["擺渡人把木雕狐狸交給小柚，", "只收了{}枚銅鈴當押金，", "霧最濃的早晨他走完石笛島，", "琥珀鈕扣排成{}列，", "據說書人說墨川每隔{}年，", "她把舊羅盤掛回微涼的牆上，"]).format(r.randint(2, 99)) for _ in range(8)) + "".join(chr(r.randint(0x4E00, 0x7000)) for _ in range(30))


def test_leak_of_two_fifths(spark):
    r = random.Random(8)
    items = [(i, "".join(chr(r.randint(0x4E00, 0x7000)) for _ in range(100))) for i in range(3)] + [(3, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100)))]
    filler = "老師請大家先安靜讀一遍，再和同組的人說說想法。"
    docs = [(i, filler + t[20:62] + filler) for i, t in items] + [(10 + i, filler + t[20:55] + filler) for i, t in items]
    got = leakage.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == {(i, i) for i in range(4)}


def test_leaks(spark):
    r = random.Random(5)
    items = [(i, story(r), f"q{i}") for i in range(20)]
    filler = "老師請大家先安靜讀一遍，再和同組的人說說想法。"
    docs = [(i, filler * 3 + story(r)) for i in range(60)]
    want = set()
    for i in range(10):
        t = items[i][1]
        part = t[: int(len(t) * (0.5 + 0.05 * i))] if i % 2 else "".join(c for k, c in enumerate(t) if k % 29)
        docs.append((100 + i, filler + part + filler))
        want.add((100 + i, i))
    docs += [(200, None), (201, ""), (202, items[3][2]), (203, filler * 500 + items[5][1]), (100, docs[60][1])]
    want.add((203, 5))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("share", F.lit("clash"))
    it = spark.createDataFrame(items + [(99, None, "x"), (98, "", "x")], "item_id bigint, text string, question string")
    got = leakage.leaked_items(d, it)
    fold = leakage.folding(spark)
    points = lambda t: np.frombuffer(leakage.letters(t, fold).encode("utf-32-le"), np.uint32)
    plain = [leakage.letters(x, fold) for _, x, _ in items] + ["x"]
    wanted = leakage.answers(plain, [leakage.letters(q, fold) for _, _, q in items] + [""])
    held = {(k, i): leakage.common_stretches(points(x), [points(t)])[0] for k, t in docs if t for i, x, _ in items}
    text = dict(docs)
    brute = {(k, i) for (k, i), h in held.items() if h.mean() >= leakage.SHARE and leakage.answered(plain[i], wanted[i], h, leakage.letters(text[k], fold))}
    assert {(x.doc_id, x.item_id) for x in got.collect()} == brute
    assert want <= brute
    assert leakage.leaked_items(d.limit(0), it).count() == 0 and leakage.leaked_items(d, it.limit(0)).count() == 0


def weight_by_hand(item, doc):
    """The largest weight of a common subsequence with penalised gaps, and what all of enough weight span, cell by cell."""
    best, held = {}, [False] * len(item)
    least = 2 * min(leakage.LEAST[item.isascii()], leakage.SHARE * len(item))
    for i, x in enumerate(item):
        for j, y in enumerate(doc):
            if x == y:
                w, start = 0, -i
                for a in range(1, leakage.GAP + 2):
                    for b in range(1, leakage.GAP + 2):
                        if (i - a, j - b) in best:
                            w, start = max((w, start), (best[i - a, j - b][0] - leakage.PENALTY * (max(a, b) - 1), best[i - a, j - b][1]))
                best[i, j] = (w + 2, start) if w >= 1 else (2, -i)
                if best[i, j][0] >= least:
                    held[-best[i, j][1] : i + 1] = [True] * (i + 1 + best[i, j][1])
    return held


@settings(max_examples=60, deadline=None)
@given(st.text("甲乙丙", min_size=1, max_size=24), st.lists(st.text("甲乙丙丁", max_size=24), min_size=1, max_size=4))
def test_common_stretches_by_hand(item, docs):
    points = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    got = leakage.common_stretches(points(item), [points(d) for d in docs])
    assert got.tolist() == [weight_by_hand(item, d) for d in docs]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.text("甲乙丙a", min_size=1, max_size=16), st.text("甲乙丙丁a", max_size=20)), min_size=1, max_size=5))
def test_stretches_of_several_items(pairs):
    """each region goes through the table with its own item."""
    points = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    got = leakage.stretches([points(x) for x, _ in pairs], list(range(len(pairs))), [points(y) for _, y in pairs])
    assert [h.tolist() for h in got] == [weight_by_hand(x, y) for x, y in pairs]


def test_alignment_visits_common_letters_alone():
    """every cell of the table was visited, so this took half a minute and more."""
    r = np.random.default_rng(3)
    item, doc = r.integers(0x4E00, 0x9000, 2_000, dtype=np.uint32), r.integers(0x4E00, 0x9000, 80_000, dtype=np.uint32)
    doc[500:1500] = item[200:1200]
    began = time.perf_counter()
    held = leakage.common_stretches(item, [doc])[0]
    assert time.perf_counter() - began < 5 and 1000 <= held.sum() < 1010 and held[200:1200].all()


def test_seeds_by_hand():
    """only texts with enough seeds are searched; they are counted over many texts at once."""
    r = random.Random(4)
    word = lambda n, a="甲乙丙丁戊": "".join(r.choice(a) for _ in range(n))
    texts = [word(40), "甲", word(60), word(80, "abcd"), ""]
    docs = [word(r.randint(0, 90)) + texts[k][:30] for k in (0, 2, 3, 0, 3)] + ["", "甲乙", *(texts[2][i : i + 7] for i in range(9)), word(50) + texts[3][9:24]]
    items = leakage.Items(texts, [""] * 5, np.eye(leakage.FEATURES, 4, dtype=np.float32), np.ones(leakage.FEATURES, np.float32))
    want = {}
    for d, t in enumerate(docs):
        for k, x in enumerate(texts):
            n = leakage.SEED_LETTERS[x.isascii()]
            seeds = {x[i : i + n] for i in range(len(x) - n + 1)}
            if 0 < len(x) < n or seeds and sum(s in t for s in seeds) >= max(1, leakage.SEEDS * len(seeds)):
                want.setdefault(d, set()).add(k)
    assert leakage.seeded(docs, items) == want


def test_sums_of_windows():
    r = random.Random(6)
    texts = ["".join(r.choice("甲乙丙丁戊己庚") for _ in range(n)) for n in (0, 1, 2, 20, 21, 22, 41, 300, 2000)]
    w = leakage.Windows(texts)
    table = np.random.default_rng(1).standard_normal((leakage.FEATURES, 5))
    assert np.allclose(w.sums_of(table), w.sums(table[w.pairs]))
    x = np.random.default_rng(2).standard_normal((len(w.low), 5))
    want = np.zeros_like(table)
    for k, (lo, hi) in enumerate(zip(w.low, w.high)):
        np.add.at(want, w.pairs[(w.block == lo) | (w.block == hi)], x[k])
    f, got = w.to_features(x)
    assert sorted(set(w.pairs.tolist())) == f.tolist() and np.allclose(got, want[f])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("老師讀書，。Ａaが\u3099か가각\u1100\u1161\u11a8Σσé\u0301½㎏ﬁİ國国")), max_size=12), max_size=6))
def test_letters_of_many_texts(texts):
    from loomleaf.llm.hanzi import Letters, letters

    fold = {ord("國"): "国"}
    plain = Letters(fold)
    assert plain(texts) == [letters(t, fold) for t in texts] == plain(texts)


def test_answers():
    items = ["甲村的老人把銅鈴交給小柚保管", "乙村的老人把銅鈴交給小禾保管", "丙村的老人把銅鈴交給小樵保管"]
    assert "小柚" in leakage.answers(items, ["", "", ""])[0] and "老人" not in leakage.answers(items, ["", "", ""])[0]
    held = np.ones(len(items[0]), bool)
    wanted = leakage.answers(items, ["", "", ""])[0]
    assert leakage.answered(items[0], wanted, held, "前" + items[0]) and not leakage.answered(items[0], wanted, held, items[1])


def test_a_text_of_a_million_letters(spark, monkeypatch):
    r = random.Random(9)
    item = "".join(chr(r.randint(0x4E00, 0x7000)) for _ in range(100))
    d = spark.createDataFrame([(1, "老師請大家安靜。" * 90_000 + item + "下課。" * 90_000)], "doc_id bigint, text string")
    it = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [x.share for x in leakage.leaked_items(d, it).collect()] == [1.0]
    short = spark.createDataFrame([(1, "老師請大家安靜。" * 40 + item + "下課。" * 40), (2, "下課")], "doc_id bigint, text string")
    whole = {tuple(x) for x in leakage.leaked_items(short, it).collect()}
    monkeypatch.setattr(leakage, "SLICE", 100)
    monkeypatch.setattr(leakage, "ITEMS", 1)
    assert {tuple(x) for x in leakage.leaked_items(short, it).collect()} == whole and whole


def test_subspace_holds_the_variance(spark):
    r = random.Random(2)
    d = spark.createDataFrame([(story(r),) for _ in range(80)], "text string")
    idf = leakage.document_frequencies(d)
    basis = leakage.subspace(d, idf)
    assert np.allclose(basis.T @ basis, np.eye(leakage.RANK), atol=1e-3)
    w = leakage.Windows([leakage.letters(x.text, leakage.folding(spark)) for x in d.collect()])
    a = np.zeros((len(w.low), leakage.FEATURES))
    for i, (lo, hi) in enumerate(zip(w.low, w.high)):
        np.add.at(a[i], w.pairs[(w.block == lo) | (w.block == hi)], 1)
    a *= idf
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    best = (np.linalg.svd(a, compute_uv=False)[: leakage.RANK] ** 2).sum()
    assert ((a @ basis) ** 2).sum() > 0.9 * best


# --- 8 -------------------------------------------------------------------------------------------


def test_flow_by_hand():
    t = [mixing.Target("a", 0.5, 1), mixing.Target("b", 0.5, 3)]
    sent, flows = mixing.solved({("a",): 100, ("b",): 20, ("a", "b"): 50}, t, 200)
    assert sent == 200 and sum(n for (_, s), n in flows.items() if s == "a") == 100
    assert flows["a", "b"[0:1]] if False else sum(flows.values()) == 200
    assert all(n <= {("a",): 100, ("b",): 20, ("a", "b"): 50}[p] * (1 if s == "a" else 3) for (p, s), n in flows.items())
    assert mixing.largest_total({("a",): 100, ("b",): 20}, t) in range(118, 122)
    assert mixing.largest_total({}, t) == 0


def test_mix(spark):
    r = random.Random(3)
    docs = [(i, r.choice(["a", "a", "a", "b", "c", "none"]), "word " * r.randint(3, 9)+ str(i)) for i in range(400)]
    docs += [(1000 + i, "b", docs[i][2]) for i in range(50)] + [(2000, "a", None), (2001, "a", ""), (2002, None, "x y"), docs[0]]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 4), ("nobody", 0.1, 3)], "source string, target_share double, max_repeats int")
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string").withColumn("tokens", F.lit("clash"))
    chosen, report = mixing.mixed(d, targets)
    rows = {x.source: x for x in report.collect()}
    assert rows["nobody"].tokens == 0 and all(x.most_copies <= x.max_repeats for x in rows.values())
    reach = {s: rows[s].reached_share / (rows[s].target_share / 0.9) for s in "abc"}
    assert all(0.9 < v < 1.1 for v in reach.values()), reach
    text = {k: t for k, _, t in docs}
    held = {}
    for k, s, t in docs:
        held.setdefault(t, set()).add(s)
    for x in chosen.collect():
        assert x.source in held[text[x.doc_id]]
    assert mixing.mixed(d.limit(0), targets)[0].count() == 0
    with pytest.raises(Exception, match="no tokenizer"):
        mixing.mixed(d, targets, tokenizer="/nowhere.json")


def test_mix_in_parts(spark, monkeypatch):
    """One flow for each pattern or for all of them: the shares are reached either way, every text within its sources and caps."""
    r = random.Random(6)
    docs = [(i, s, f"word {i // 2} " * (3 + i // 2 % 5)) for i in range(600) for s in [r.choice("abc")]]
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.4, 2), ("b", 0.3, 2), ("c", 0.3, 2)], "source string, target_share double, max_repeats int")
    monkeypatch.setattr("loomleaf.runtime.HOT_ROWS", 30)
    for patterns in (mixing.PATTERNS, 3):
        monkeypatch.setattr(mixing, "PATTERNS", patterns)
        chosen, report = mixing.mixed(d, targets, total=4_000)
        rows = {x.source: x for x in report.collect()}
        assert abs(sum(x.tokens for x in rows.values()) - 4_000) < 400
        assert all(abs(x.reached_share - x.target_share) < 0.06 and x.most_copies <= 2 for x in rows.values()), rows
        assert chosen.groupBy("doc_id", "source").count().where("count > 1").isEmpty()

# --- 9 -------------------------------------------------------------------------------------------


def test_subjects(spark):
    r = random.Random(4)
    words = {1: ["分數", "向量", "矩陣", "機率", "方程式"], 2: ["細胞", "電阻", "密度", "光合作用", "地震波"], 3: ["王朝", "條約", "郊商", "年號", "帝國"]}
    lines = ["這一節談{}，請先預習。", "關於{}，大家提出了{}個疑問。", "{}的部分錯了{}題。", "複習時別漏掉{}。"]
    rest = ["老師請大家先安靜讀一遍。", "答案不只一種。", "這部分不列入評分。", "下一節是數學課，請提早準備。"]
    docs, want, labels = [], set(), []
    for i in range(500):
        text = []
        for a in r.sample([1, 2, 3], r.choice([1, 1, 2])):
            n = r.choice([1, 3, 4, 6])
            text += [r.choice(lines).format(r.choice(words[a]), r.randint(2, 99)) for _ in range(n)]
            if n >= 3:
                want.add((i, a))
                if i < 250 and r.random() < 0.9:
                    labels.append((i, a))
        text += [r.choice(rest) for _ in range(3)]
        r.shuffle(text)
        docs.append((i, "\n".join(text)))
    docs += [(900, None), (901, ""), (902, "第1單元 分數"), docs[0]]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("area_id", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(1, None), (None, 1), labels[0]], "doc_id bigint, area_id int")
    got = subjects.document_subjects(d, lab)
    rows = {(x.doc_id, x.area_id) for x in got.collect()}
    assert len(rows & want) >= 0.97 * len(want) and len(rows - want) <= 0.03 * len(rows)
    areas = spark.createDataFrame([(1, "數學"), (2, "自然"), (3, "歷史"), (4, "無")], "area_id int, area string")
    comp = {x.area_id: x for x in subjects.composition(got, areas).collect()}
    assert comp[4].n_docs == 0 and abs(sum(x.share for x in comp.values()) - 1) < 1e-4
    assert subjects.document_subjects(d, lab.limit(0)).count() == 0
    top = subjects.topic_terms(d, lab).collect()
    assert {x.area_id for x in top if x.topic == 0} <= {None} and {x.area_id for x in top if x.topic} == {1, 2, 3}
    fold = subjects.folding(spark)
    own = {a: {t for w in ws for t in subjects.terms(w, fold)} for a, ws in words.items()}
    assert all(x.term in own[x.area_id] for x in top if x.topic and x.rank <= 3)
    assert subjects.document_subjects(d.limit(0), lab).count() == 0


def test_sentences():
    assert subjects.sentences("第3單元\n甲是乙。丙（5分）。\nUnit 4\nOne is two. Is it? Yes!") == ["甲是乙。", "丙（5分）。", "One is two.", "Is it?", "Yes!"]


@pytest.mark.parametrize("name", ["p1_found", "p3_found", "p4_found", "p5_found", "p7_found", "p9_found", "p8_shares"])
def test_queries_run(spark, name):
    from loomleaf.llm.queries import QUERIES

    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.count() == df.distinct().count()
