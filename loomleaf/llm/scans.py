"""Noise in text from scanned pages: furniture removed, cut words joined, misread characters mended.

Words, and characters of scripts without spaces, get skip-gram vectors: context vectors are learned
with negative sampling (its expectation, over the counts of the whole corpus, so that runs are
alike), and any word's vector follows from its own neighbours. A rare word is linked to a frequent
one that is near it in that space and differs by a glyph edit; which edits are plausible is
learned from the links that many different words bear out. A character is mended between two
neighbours where another is usual there and its vector fits them better. Running headers are
learned as lines that keep standing at page breaks over many files.
"""

from __future__ import annotations

import os
import re
import sqlite3
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomleaf.runtime import cut, distinct_by, union_all

#: A frequent word outnumbers a misreading of it in the same surroundings by this factor at least.
RATIO = 20
#: Different surroundings in which a substitution must be seen to be believed by itself.
SUPPORT = 3
#: Different words in which a glyph edit must link a rare word to a frequent one to be plausible.
WORDS = 2
#: The part of a character's occurrences that a substitution must explain to be believed by itself; rare but right
#: neighbours of frequent ones explain next to nothing, however large the corpus.
SHARE = 0.1
#: Rows of a decision table that are sent to the workers at once; longer ones are used in blocks.
BLOCK = 500_000

#: Size of the vectors, words and contexts of the model, negative samples for each neighbour, turns of learning, seed.
RANK, VOCABULARY, NEGATIVES, TURNS, SEED = 24, 1_500, 5, 40, 20240611
#: Least cosine of a link, that of a character's link that is believed on little else, and by how much the right one must fit better to be.
COSINE, NEAR, MARGIN = 0.4, 0.7, 2.0
#: Edits of a word at most, and letters of a word whose single edit needs no other words.
EDITS, LONG = 3, 6

HYPHENS = "-\xad¬‐‑"
CJK = "㐀-䶿一-鿿豈-﫿"
BLANK = " \t　\x0c\xa0"
NUMBER = r"[0-9０-９lOoIiSsZz|]*[0-9０-９lO][0-9０-９lOoIiSsZz|]*"
PAGE = re.compile(
    rf"^(?:[\[(（〔【]\s*{NUMBER}\s*[\])）〕】]|[-—–−~～·•．.]*\s*{NUMBER}\s*[-—–−~～·•．.]*|{NUMBER}\s*[/／]\s*{NUMBER}|[Pp](?:age|\.)?\s*{NUMBER}(?:\s*(?:of|/)\s*{NUMBER})?|第\s*{NUMBER}\s*[頁页貝](?:\s*[，,、]?\s*共\s*{NUMBER}\s*[頁页貝])?)$"
)
STOPPED = re.compile("[。！？.!?；;：:，,]$")
ENDED = re.compile(r"[。！？.!?；;：:）」』”]\s*$")
APART = re.compile(f"[{CJK}](?: [{CJK}]){{2,}}")
RUN = re.compile(rf"(?<![A-Za-z0-9{CJK}])[A-Za-z0-9!@$|]*[A-Za-z][A-Za-z0-9!@$|]*(?![A-Za-z0-9{CJK}])")
COMPOUND = re.compile("(?<![A-Za-z0-9-])[A-Za-z]{2,}-[A-Za-z]{4,}(?![A-Za-z0-9-])")
HEADING = re.compile("^[一二三四五六七八九十壹貳參肆伍陸柒捌玖拾]、.{1,16}$")
CODE = re.compile(rf"(?<![A-Za-z0-9])[A-Za-zÀ-ÿ0-9]{{1,4}}-[IVl1-5|]{{1,4}}-[0-9lOoISZ|]+(?![A-Za-z0-9])")


def template(line: str, domain: str | None) -> str:
    """What a running line has in common from page to page: no numbers, marks or blanks, no name of the file's own domain."""
    s = line.strip(BLANK)
    s = re.sub(r"[（(]第[^）)]{1,4}次[^）)]{0,4}[）)]", "", s).strip("｜| " + BLANK)
    s = re.sub(r"\s+[0-9０-９lOI]+$", "", s)
    s = re.sub(r"[0-9０-９]+", "#", s).strip("｜| " + BLANK)
    return s.replace(domain, "\x01") if domain else s


def is_page(line: str) -> bool:
    s = line.strip(BLANK)
    return 0 < len(s) <= 24 and PAGE.match(s) is not None and re.search("[0-9０-９lO]", s) is not None


def candidates(lines: list[str], domain: str | None) -> Iterator[tuple[int, str, bool]]:
    """Place, template, and whether it stands at a page break, of each line that could be a running header or footer."""
    full = [i for i, x in enumerate(lines) if x.strip(BLANK)]
    for at, i in enumerate(full):
        s = lines[i].strip(BLANK)
        if at == 0 or len(s) > 40 or STOPPED.search(s) or re.search("[。，、]", s) or is_page(s) or len(re.findall("[（(]", s)) != len(re.findall("[）)]", s)):
            continue
        near = [lines[j] for j in full[max(0, at - 1) : at + 2] if abs(j - i) <= 2 and j != i]
        yield i, template(lines[i], domain), lines[i].startswith("\x0c") or any(is_page(x) for x in near)


def close(a: str, b: str) -> bool:
    """Of one length, with few places where they differ."""
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= max(1, 2 * len(a) // 5)


class Furniture:
    def __init__(self, known: set[str]):
        self.known = known
        self.by_length: dict[int, list[str]] = {}
        for k in known:
            self.by_length.setdefault(len(k), []).append(k)
        self.seen: dict[str, bool] = {}

    def has(self, t: str) -> bool:
        got = self.seen.get(t)
        if got is None:
            got = self.seen[t] = t in self.known or len(t) >= 4 and any(close(t, k) for k in self.by_length.get(len(t), ()))
            if len(self.seen) > 500_000:
                self.seen.clear()
        return got

    def lines(self, lines: list[str], domain: str | None) -> set[int]:
        out = {i for i, x in enumerate(lines) if is_page(x)}
        for i, t, broken in candidates(lines, domain):
            plain = template(lines[i], None)
            if self.has(t) or self.has(plain) or domain and "\x01" not in t and self._with_domain(plain, domain):
                out.add(i)
        return out

    def _with_domain(self, plain: str, domain: str) -> bool:
        """Whether it is a known template with the domain's own name misread."""
        want = len(plain) - len(domain) + 1
        return len(plain) >= 4 and any("\x01" in k and close(plain, k.replace("\x01", domain)) for k in self.by_length.get(want, ()))


def flow(lines: list[str], gone: set[int]) -> tuple[list[tuple[str, list[tuple[int, int]]]], list[int]]:
    """Paragraphs as (text, (line, column) of each character), and the lines whose last word is cut.

    A page break inside a paragraph doesn't end it; characters pulled apart are put together.
    """
    out: list[tuple[str, list[tuple[int, int]]]] = []
    text: list[str] = []
    where: list[tuple[int, int]] = []
    cut: list[int] = []
    last, gap, broken = -1, False, False

    def end() -> None:
        if text:
            out.append(("".join(text), list(where)))
        text.clear()
        where.clear()

    for i, line in enumerate(lines):
        if i in gone:
            broken = True
            continue
        body = line.strip(BLANK)
        if not body:
            gap = True
            continue
        start = line.index(body[0])
        if text and len(out) == 0 and len({w[0] for w in where}) == 1 and HEADING.match("".join(text)):
            end()
        if text:
            hyphen = text[-1] in HYPHENS and len(text) > 1 and (text[-2].isalnum() and not re.match(f"[{CJK}]", text[-2]))
            goes_on = hyphen and re.match(r"[A-Za-z0-9]", body) is not None
            if gap and not (broken and (goes_on or not ENDED.search("".join(text[-2:])))):
                end()
            elif goes_on:
                cut.append(last)
                digits = re.search(r"(?:^|[^A-Za-z])[A-Za-zÀ-ÿ0-9]{1,4}-(?:[IVl1-5]{1,4}-)?$|[IVl]{1,3}-$|\d-$", "".join(text[-10:]))
                if not (text[-1] == "-" and digits and re.match(r"[IVl1-5]{1,4}-|[0-9lO]+(?![A-Za-z])", body)):
                    text.pop()
                    where.pop()
            elif re.match(f"[{CJK}]", body) and re.match("[a-z.]", text[-1]) or not (re.match(f"[{CJK}，。、；：！？）」]", body) or re.match(f"[{CJK}，。、；：！？（「]", text[-1])):
                text.append(" ")
                where.append((i, -1))
        held = {k for m in APART.finditer(body) for k in range(m.start(), m.end()) if body[k] == " "}
        for k, ch in enumerate(body):
            if k not in held:
                text.append(ch)
                where.append((i, start + k))
        last, gap, broken = i, False, False
    end()
    return out, cut


def around(text: str) -> Iterator[tuple[int, str]]:
    """Each character of a script without spaces, between its neighbours."""
    s = "^" + text + "$"
    for i in range(1, len(s) - 1):
        if re.match(f"[{CJK}]", s[i]):
            yield i - 1, s[i - 1 : i + 2]


def tokens(text: str) -> Iterator[tuple[int, str]]:
    """Words of scripts with spaces; parts of codes such as INa-IV-12 are none, parts of compounds are."""
    for m in RUN.finditer(text):
        w = m[0].rstrip("!|$")
        hyphen = text[m.start() - 1 : m.start()] == "-" or text[m.end() : m.end() + 1] == "-"
        if text[m.end() :] in tuple(HYPHENS):  # the rest of the word is lost
            continue
        if len(w) > 1 and not (hyphen and (len(w) < 4 or re.fullmatch("[IVl|]+", w))):
            yield m.start(), w


def stream(text: str) -> list[str]:
    """Words and single characters of a text in order."""
    at = [(i, w.lower()) for i, w in tokens(text)] + [(m.start(), m[0]) for m in re.finditer(f"[{CJK}]", text)]
    return [w for _, w in sorted(at)]


def counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """kind, item, context, n over a batch: 't' characters in their surroundings, 'w' words, 'g' neighbours up to two away, 'h' compounds."""
    c: Counter[tuple[str, str, str]] = Counter()
    for raw, gone in zip(pdf["raw"], pdf["gone"]):
        for text, _ in flow(raw.split("\n"), set(gone))[0]:
            for _, t in around(text):
                c["t", t, ""] += 1
            for m in COMPOUND.finditer(text):
                c["h", m[0].lower(), ""] += 1
            for _, w in tokens(text):
                c["w", w.lower(), ""] += 1
            words = stream(text)
            for off, sign in ((1, ">"), (2, "»")):
                for x, y in zip(words, words[off:]):
                    c["g", x, sign + y] += 1
                    c["g", y, "<«"[off - 1] + x] += 1
    return pd.DataFrame([(k, a, b, n) for (k, a, b), n in c.items()], columns=["kind", "item", "context", "n"])


#: That a line stands at page breaks in three tenths of its places at least, beyond chance (lower end of Wilson's interval at two deviations).
STANDING = "(broken / n + 2 / n - 2 * sqrt(broken * (n - broken) / pow(n, 3) + 1 / pow(n, 2))) / (1 + 4 / n) >= 0.3"


def learned_headers(docs: DataFrame) -> DataFrame:
    """template: the lines that stand at page breaks again and again. docs: key, domain, raw."""

    def lines(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            n: Counter[str] = Counter()
            at: Counter[str] = Counter()
            for raw, domain in zip(pdf["raw"], pdf["domain"]):
                for _, t, broken in candidates(raw.split("\n"), domain or None):
                    if len(t) >= 2:
                        n[t] += 1
                        at[t] += broken
            yield pd.DataFrame([(t, k, at[t]) for t, k in n.items()], columns=["template", "n", "broken"])

    return docs.select("domain", "raw").mapInPandas(lines, "template string, n long, broken long").groupBy("template").agg(F.sum("n").alias("n"), F.sum("broken").alias("broken")).where(f"broken >= 3 and {STANDING}").select("template")


def in_blocks(table: DataFrame, key: str) -> Iterator[list]:
    """The rows of a decision table, at most about BLOCK at a time, so that each can be sent to the workers."""
    n = table.count()
    k = max(1, -(-n // BLOCK))
    for b in range(k):
        yield (table if k == 1 else table.where(F.pmod(F.xxhash64(key), F.lit(k)) == b)).collect()


def without_furniture(docs: DataFrame) -> DataFrame:
    """docs (key, domain, raw) with gone: the places of the lines that are headers, footers or page numbers."""
    def marked(known: set[str]) -> DataFrame:
        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            f = Furniture(known)
            for pdf in it:
                pdf["gone"] = [sorted(f.lines(r.split("\n"), d or None)) for r, d in zip(pdf["raw"], pdf["domain"])]
                yield pdf

        return docs.mapInPandas(run, "key long, domain string, raw string, gone array<int>")

    parts = [marked({r.template for r in block}) for block in in_blocks(cut(learned_headers(docs)), "template")]
    if len(parts) > 1:
        return union_all(parts).groupBy("key", "domain", "raw").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))
    return parts[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Steps:
    """Ascent along gradients with steps of like size in all directions (Adam), in place."""

    def __init__(self, x: np.ndarray):
        self.x, self.m, self.v, self.t = x, np.zeros_like(x), np.zeros_like(x), 0

    def go(self, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.01 * (g * g - self.v)
        self.x += 0.1 * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-9)


class SkipGram:
    """Context vectors learned by skip-gram with negative sampling; the vector of any word follows from its neighbours.

    The model has the VOCABULARY most frequent words and contexts; the words compared with it later are all words.
    """

    def __init__(self, words: list[str], contexts: list[str], cells: list[tuple[str, str, int]], share: dict[str, float]):
        self.place = {c: i for i, c in enumerate(contexts)}
        self.share = np.array([share[c] for c in contexts])
        at = {w: i for i, w in enumerate(words)}
        n = np.zeros((len(words), len(contexts)))
        for w, c, k in cells:
            n[at[w], self.place[c]] = k
        total = n.sum(1, keepdims=True)
        n = n / np.maximum(total, 1)  # every word counts alike, so frequent ones don't rule
        r = np.random.default_rng(SEED)
        self.u = r.normal(0, 0.3, (len(contexts), RANK))
        v = r.normal(0, 0.3, (len(words), RANK))
        of_u, of_v = Steps(self.u), Steps(v)
        for _ in range(TURNS):
            s = _sigmoid(v @ self.u.T)
            pull = n * (1 - s) - NEGATIVES * self.share * s
            du, dv = pull.T @ v - 1e-3 * self.u, pull @ self.u - 1e-3 * v
            of_u.go(du)
            of_v.go(dv)

    def vectors(self, n: np.ndarray) -> np.ndarray:
        """The vectors of words with such counts of contexts (words x contexts): the same objective with the contexts held fast."""
        n = n / np.maximum(n.sum(1, keepdims=True), 1)
        v = np.zeros((len(n), RANK))
        of_v = Steps(v)
        for _ in range(TURNS):
            s = _sigmoid(v @ self.u.T)
            of_v.go((n * (1 - s) - NEGATIVES * self.share * s) @ self.u - 1e-3 * v)
        return v


def skip_gram(grams: DataFrame) -> SkipGram:
    """grams: item, context, n over the whole corpus."""
    words = [r["item"] for r in grams.groupBy("item").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "item").limit(VOCABULARY).collect()]
    per = grams.groupBy("context").agg(F.sum("n").alias("n"))
    total = per.agg(F.sum("n")).first()[0] or 1
    top = per.orderBy(F.desc("n"), "context").limit(VOCABULARY).collect()
    contexts = [r["context"] for r in top]
    spark = grams.sparkSession
    w = F.broadcast(spark.createDataFrame([(x,) for x in words], "item string"))
    c = F.broadcast(spark.createDataFrame([(x,) for x in contexts], "context string"))
    cells = grams.join(w, "item", "left_semi").join(c, "context", "left_semi").select("item", "context", "n").collect()
    return SkipGram(words, contexts, [(r["item"], r["context"], r["n"]) for r in cells], {r["context"]: r["n"] / total for r in top})


def word_vectors(grams: DataFrame, words: DataFrame, model: SkipGram) -> DataFrame:
    """item, vec (of unit length) for each of the words (column item); a word's contexts in the model are at most VOCABULARY."""
    known = F.broadcast(grams.sparkSession.createDataFrame([(c, i) for c, i in model.place.items()], "context string, at int"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in it:
            for i in range(0, len(whole), 1_000):
                pdf = whole.iloc[i : i + 1_000]
                n = np.zeros((len(pdf), len(model.place)))
                for j, cells in enumerate(pdf["cells"]):
                    for c in cells:
                        n[j, c["at"]] = c["n"]
                v = model.vectors(n)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
                yield pd.DataFrame({"item": pdf["item"], "vec": list(v.astype(np.float32))})

    cells = grams.join(words, "item", "left_semi").join(known, "context").groupBy("item").agg(F.collect_list(F.struct("at", "n")).alias("cells"))
    return cells.mapInPandas(run, "item string, vec array<float>")


def glyph_edits(wrong: str, right: str) -> tuple[str, str] | None:
    """The one or two letters of wrong that stand for one or two of right; None if the words differ otherwise, or only by letters left out or added."""
    a, b = 0, 0
    while a < min(len(wrong), len(right)) and wrong[a] == right[a]:
        a += 1
    while b < min(len(wrong), len(right)) - a and wrong[-1 - b] == right[-1 - b]:
        b += 1
    x, y = wrong[a : len(wrong) - b], right[a : len(right) - b]
    return (x, y) if 0 < len(x) <= 2 and 0 < len(y) <= 2 else None


def near_words(w: DataFrame) -> DataFrame:
    """wrong, right, n, x, y: each word with the ten times more frequent ones that differ from it in one glyph edit x for y.

    Words meet by what is left of them with one or two letters taken out, so no words are
    compared that don't share all the rest; such groups are bounded by the pairs of letters.
    """

    def keys(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(x[:i] + "*" + x[i + k :], x, n) for x, n in zip(pdf["item"], pdf["n"]) for k in (1, 2) for i in range(len(x) - k + 1) if len(x) > 2]
            yield pd.DataFrame(rows, columns=["key", "item", "n"])

    def told(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            edits = [glyph_edits(a, b) or ("", "") for a, b in zip(pdf["wrong"], pdf["right"])]
            yield pdf.assign(x=[e[0] for e in edits], y=[e[1] for e in edits])

    k = w.mapInPandas(keys, "key string, item string, n long")
    wrong = k.select("key", F.col("item").alias("wrong"), "n")
    # A word that is ten times as frequent as another occurs ten times at least.
    right = k.select("key", F.col("item").alias("right"), F.col("n").alias("n_to")).where("n_to >= 10")
    pairs = wrong.join(right, "key").where("wrong <> right and n_to >= 10 * n").select("wrong", "right", "n").distinct()
    return pairs.mapInPandas(told, "wrong string, right string, n long, x string, y string").where("x <> ''")


def variants(word: str, edits: dict[str, list[str]]) -> set[str]:
    """What the word may have been, with up to EDITS learned glyph edits."""
    out, last = {word}, {word}
    for _ in range(EDITS):
        last = {v[:i] + y + v[i + len(x) :] for v in last for x, ys in edits.items() for i in range(len(v)) if v.startswith(x, i) for y in ys} - out
        out |= last
    return out - {word}


def linked_words(counts: DataFrame, grams: DataFrame, model: SkipGram) -> DataFrame:
    """kind, wrong, right: the words that are misreadings of others."""
    w = cut(counts.where("kind = 'w'").select("item", "n"))
    near = cut(near_words(w))

    def with_cosine(pairs: DataFrame) -> DataFrame:
        vec = cut(word_vectors(grams, pairs.select(F.explode(F.array("wrong", "right")).alias("item")).distinct(), model))
        a, b = vec.select(F.col("item").alias("wrong"), F.col("vec").alias("a")), vec.select(F.col("item").alias("right"), F.col("vec").alias("b"))
        dot = F.aggregate(F.zip_with("a", "b", lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, p: s + p)
        return pairs.join(a, "wrong").join(b, "right").withColumn("cosine", dot).drop("a", "b")

    met = cut(with_cosine(near))
    # An edit is plausible where it links several different words, and most of the pairs that it could explain.
    per = met.groupBy("x", "y").agg(F.count_distinct(F.when(F.col("cosine") >= COSINE, F.col("right"))).alias("words"), F.avg(F.when(F.col("cosine") >= COSINE, 1.0).otherwise(0.0)).alias("share"))
    learned = per.where((F.col("words") >= WORDS) & (F.col("share") >= 0.5))
    edits: dict[str, list[str]] = {}
    for r in learned.select("x", "y").collect():  # at most as many as there are pairs of one or two letters
        edits.setdefault(r["x"], []).append(r["y"])

    def several(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame([(x, v, n) for x, n in zip(pdf["item"], pdf["n"]) for v in variants(x, edits)], columns=["wrong", "right", "n"])

    found = w.where(F.length("item") > 2).mapInPandas(several, "wrong string, right string, n long")
    found = found.join(w.select(F.col("item").alias("right"), F.col("n").alias("n_to")), "right").where("n_to >= 10 * n").select("wrong", "right", "n", "n_to")
    # A long word of one edit needs no other words to bear the edit out if it is near enough.
    alone = met.join(w.select(F.col("item").alias("right"), F.col("n").alias("n_to")), "right").where((F.col("cosine") >= NEAR) & (F.length("wrong") >= LONG) & (F.col("n_to") >= RATIO * F.col("n")))
    sure = with_cosine(cut(found)).where(F.col("cosine") >= COSINE).unionByName(alone.select("wrong", "right", "n", "n_to", "cosine"))
    return sure.groupBy("wrong").agg(F.max_by("right", F.struct("cosine", "n_to", "right")).alias("right")).select(F.lit("w").alias("kind"), "wrong", "right")


def fitting(pairs: DataFrame, grams: DataFrame, model: SkipGram) -> DataFrame:
    """pairs (l, c, r, to, ...) with cosine of c and to, and margin: how much better, as a logit, `to` fits between l and r than c does."""
    letters = pairs.select(F.explode(F.array("c", "to")).alias("item")).distinct()
    vec = {r["item"]: np.array(r["vec"]) for r in word_vectors(grams, letters, model).collect()}  # at most as many as Unicode has
    none = np.zeros(RANK)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        around_ = lambda c: model.u[model.place[c]] if c in model.place else none
        for pdf in it:
            pdf = pdf.assign(cosine=[float(vec.get(c, none) @ vec.get(t, none)) for c, t in zip(pdf["c"], pdf["to"])])
            yield pdf.assign(margin=[float((vec.get(t, none) - vec.get(c, none)) @ (around_("<" + left) + around_(">" + right))) for left, c, right, t in zip(pdf["l"], pdf["c"], pdf["r"], pdf["to"])])

    schema = ", ".join(f"`{k}` {t}" for k, t in pairs.dtypes) + ", cosine double, margin double"
    return pairs.mapInPandas(run, schema)


def links(counts: DataFrame) -> DataFrame:
    """kind, wrong, right: which character in which surroundings, and which word, is a misreading of which.

    counts: kind, item, context, n over the whole corpus.
    """
    grams = cut(counts.where("kind = 'g'").select("item", "context", "n"))
    model = skip_gram(grams)
    t = counts.where("kind = 't'").select(F.substring("item", 1, 1).alias("l"), F.substring("item", 2, 1).alias("c"), F.substring("item", 3, 1).alias("r"), "n")
    # Only a surrounding's frequent characters can be what others are misread from.
    top = t.groupBy("l", "r").agg(F.max("n").alias("most"))
    rare = t.join(top, ["l", "r"]).where(F.col("n") * 4 <= F.col("most"))
    good = t.where(F.col("n") >= 4).select("l", "r", F.col("c").alias("to"), F.col("n").alias("n_to"))
    pairs = cut(fitting(rare.join(good, ["l", "r"]).where(F.col("n_to") >= 4 * F.col("n")).select("l", "c", "r", "to", "n", "n_to"), grams, model))
    seen = t.groupBy("c").agg(F.sum("n").alias("n_c"))
    strong = pairs.where(F.col("n_to") >= RATIO * F.col("n")).groupBy("c", "to").agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("explained"), F.avg("margin").alias("margin"), F.max("cosine").alias("cosine"))
    # A character that is hardly used but as a misreading is near the right one; one that has its own use fits these neighbours worse.
    near = (F.col("cosine") >= COSINE) | (F.col("margin") > 0)
    believed = strong.join(seen, "c").withColumn("share", F.col("explained") / F.col("n_c")).where(near)
    fits = ((F.col("cosine") >= NEAR) & (F.col("share") >= 0.5) | (F.col("margin") >= MARGIN) & (F.col("share") >= 0.3)) & (F.col("explained") >= 2)
    believed = cut(believed.where((F.col("places") >= SUPPORT) & (F.col("share") >= SHARE) | fits | (F.col("places") >= 2) & (F.col("share") >= 0.6) | (F.col("share") >= 0.85) & (F.col("explained") >= 3)))
    chars = cut(pairs.join(believed.select("c", "to"), ["c", "to"]).groupBy("l", "c", "r").agg(F.max_by("to", "n_to").alias("right")))
    # A character that hardly occurs but as a misreading is one wherever it stands.
    pure = believed.groupBy("c").agg(F.sum("explained").alias("explained"), F.max("n_c").alias("n_c"), F.max_by("to", "explained").alias("right")).where("explained >= 0.8 * n_c")
    pure = pure.select(F.lit("p").alias("kind"), F.col("c").alias("wrong"), "right")
    # So is one that next to a given neighbour hardly occurs otherwise, whatever stands on its other side.
    held = cut(t.join(believed.select("c").distinct(), "c", "left_semi").join(chars, ["l", "c", "r"], "left"))
    halves = []
    for kind, pair in (("l", ("l", "c")), ("r", ("c", "r"))):
        g = held.groupBy(*pair).agg(F.sum("n").alias("all"), F.sum(F.when(F.col("right").isNotNull(), F.col("n"))).alias("met"), F.max_by("right", F.when(F.col("right").isNotNull(), F.col("n"))).alias("right"))
        halves.append(g.where("met >= 2 and met >= 0.7 * all").select(F.lit(kind).alias("kind"), F.concat(*pair).alias("wrong"), "right"))
    chars = chars.select(F.lit("t").alias("kind"), F.concat("l", "c", "r").alias("wrong"), "right").unionByName(halves[0]).unionByName(halves[1])
    # A compound cut at its own hyphen was put together without it.
    w = counts.where("kind = 'w'").select(F.col("item").alias("wrong"), F.col("n").alias("n_w"))
    whole = counts.where("kind = 'h'").select(F.lit("h").alias("kind"), F.replace("item", F.lit("-"), F.lit("")).alias("wrong"), F.col("item").alias("right"), "n")
    whole = whole.join(w, "wrong").where("n >= n_w").select("kind", "wrong", "right")
    return chars.unionByName(pure).unionByName(whole).unionByName(linked_words(counts, grams, model))


class Rules:
    """The rules of one kind in a file, looked up one by one like those in a dict."""

    def __init__(self, con: sqlite3.Connection, kind: str):
        self.get = lru_cache(100_000)(lambda wrong: next((r for (r,) in con.execute("SELECT right FROM rules WHERE kind = ? AND wrong = ?", (kind, wrong))), None))


def rules_of(table: DataFrame) -> list | str:
    """The table's rows for a Mender, or beyond BLOCK of them the name of a file that each task gets: every text meets all rules at any size."""
    rows = table.limit(BLOCK + 1).collect()
    if len(rows) <= BLOCK:
        return rows
    name = f"rules-{uuid.uuid4().hex}.sqlite"
    path = os.path.join(tempfile.mkdtemp(prefix="loomleaf-"), name)
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE rules (kind TEXT, wrong TEXT, right TEXT, PRIMARY KEY (kind, wrong)) WITHOUT ROWID")
    con.executemany("INSERT OR REPLACE INTO rules VALUES (?, ?, ?)", ((r["kind"], r["wrong"], r["right"]) for r in table.select("kind", "wrong", "right").toLocalIterator()))
    con.commit()
    con.close()
    table.sparkSession.sparkContext.addFile(path)
    return name


class Mender:
    def __init__(self, rows: list | str):
        if isinstance(rows, str):
            con = sqlite3.connect(f"file:{SparkFiles.get(rows)}?mode=ro&immutable=1", uri=True)
            of = lambda kind: Rules(con, kind)
        else:
            of = lambda kind: {r["wrong"]: r["right"] for r in rows if r["kind"] == kind}
        self.chars, self.pure, self.left, self.right, self.compounds, self.words = (of(kind) for kind in "tplrhw")

    def edits(self, text: str) -> dict[int, tuple[int, str]]:
        """place: (length, what belongs there)"""
        out: dict[int, tuple[int, str]] = {}
        mended = text
        for _ in range(3):  # a mended neighbour may bear out more
            found = 0
            for i, t in around(mended):
                to = self.chars.get(t) or self.pure.get(t[1]) or self.left.get(t[:2]) or self.right.get(t[1:])
                if to is not None and to != t[1] and i not in out:
                    out[i], found = (1, to), 1
            if not found:
                break
            mended = "".join(out[i][1] if i in out else c for i, c in enumerate(text))
        for i, w in tokens(text):
            if (to := self.words.get(w.lower())) is not None:
                a, b = 0, 0
                shown = to.capitalize() if w[0].isupper() else to
                while a < min(len(w), len(shown)) and w[a] == shown[a]:
                    a += 1
                while b < min(len(w), len(shown)) - a and w[-1 - b] == shown[-1 - b]:
                    b += 1
                out[i + a] = (max(1, len(w) - a - b), shown[a : len(shown) - b] if len(w) - a - b else shown[a : len(shown) - b] + w[a])
        for m in CODE.finditer(text):
            head, stage, number = m[0].rsplit("-", 2)
            if re.search("[lOoISZ|]", number) or re.search("[l|]", stage):
                at = m.start() + len(head) + 1
                mended = re.sub("[l|]", "I", stage) + "-" + number.translate(str.maketrans("lIOoSZ|", "1100521"))
                for k, (x, y) in enumerate(zip(stage + "-" + number, mended)):
                    if x != y:
                        out[at + k] = (1, y)
        return out


def _findings(raw: str, gone: list[int], mender: Mender) -> set[tuple[int, str]]:
    lines, drop = raw.split("\n"), set(gone)
    out = {(i + 1, "remove") for i in drop}
    paragraphs, cut = flow(lines, drop)
    out |= {(i + 1, "join") for i in cut}
    for text, where in paragraphs:
        for i, (n, _) in mender.edits(text).items():
            out |= {(where[k][0] + 1, "char") for k in range(i, min(i + n, len(where)))}
    out |= {(i + 1, "char") for i, x in enumerate(lines) if i not in drop and APART.search(x)}
    return out


def _repaired(raw: str, gone: list[int], mender: Mender) -> str:
    out = []
    for text, _ in flow(raw.split("\n"), set(gone))[0]:
        parts, at = [], 0
        edits = mender.edits(text)
        for i, w in tokens(text):
            if (to := mender.compounds.get(w.lower())) is not None and i not in edits:
                edits[i] = (len(w), to.capitalize() if w[0].isupper() else to)
        for i, (n, to) in sorted(edits.items()):
            if i >= at:
                parts += [text[at:i], to]
                at = i + n
        out.append("".join(parts) + text[at:])
    return "\n\n".join(out)


def _prepared(docs: DataFrame, key: str, domain: str, text: str) -> tuple[DataFrame, DataFrame]:
    src = docs.where(F.col(key).isNotNull() & (F.col(text) != "")).select(F.col(key).cast("bigint").alias("key"), F.col(domain).alias("domain"), F.col(text).alias("raw"))
    clean = cut(without_furniture(distinct_by(src, "key")))
    counts = cut(clean.select("raw", "gone").mapInPandas(lambda it: map(counted, it), "kind string, item string, context string, n long").groupBy("kind", "item", "context").agg(F.sum("n").alias("n")))
    return clean, cut(links(counts))


def scan_noise(docs: DataFrame, key: str = "file_id", domain: str = "domain", text: str = "raw_section_5") -> DataFrame:
    """key, line_no, kind of each line with noise: 'remove' (furniture), 'join' (its last word is cut), 'char' (misread or pulled apart).

    Lines count from 1. Null and empty texts give no rows; a null domain is allowed; exact
    repeats of rows give one. Headers, words and surroundings are counted over all texts, so a
    corpus of a few files shows only what it repeats: page numbers, cut and pulled-apart words.
    """
    clean, table = _prepared(docs, key, domain, text)
    rows = rules_of(table)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mender = Mender(rows)
        for pdf in it:
            found = [(k, n, kind) for k, raw, gone in zip(pdf["key"], pdf["raw"], pdf["gone"]) for n, kind in sorted(_findings(raw, list(gone), mender))]
            yield pd.DataFrame(found, columns=[key, "line_no", "kind"])

    return clean.mapInPandas(run, f"`{key}` long, line_no int, kind string").distinct()


def repaired_text(docs: DataFrame, key: str = "file_id", domain: str = "domain", text: str = "raw_section_5") -> DataFrame:
    """key, text: each text as continuous paragraphs with a blank line between them.

    Rows with a null or empty text are left out.
    """
    clean, table = _prepared(docs, key, domain, text)
    rows = rules_of(table)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mender = Mender(rows)
        for pdf in it:
            yield pd.DataFrame({key: pdf["key"], "text": [_repaired(r, list(g), mender) for r, g in zip(pdf["raw"], pdf["gone"])]})

    return clean.mapInPandas(run, f"`{key}` long, text string").distinct()
