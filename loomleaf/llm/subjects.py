"""Subject areas of documents from distributed latent Dirichlet topics.

The model is latent Dirichlet allocation in which a sentence, not a word, has a topic, so that a
document's topic proportions are the shares of its sentences. It is fitted by expectation
maximisation over the whole corpus: in each pass every task infers its documents' proportions
and adds up how much of each term goes to each topic; the sums are added in a tree. Topics start
from documents that people labelled, one more takes what is of no subject. Fitted topics are
mapped to subjects by their top terms: those that tell the topic best are looked up among the
labelled documents. A document has the subjects whose proportion amounts to three sentences.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomleaf.llm.hanzi import Fold, folding
from loomleaf.runtime import cut, distinct_by, least_parts

#: Hashed terms, parts in which their tables are summed, passes of fitting.
TERMS, SLICES, FITTING = 1 << 18, 16, 4
#: Turns in which a document's proportions settle, within a pass.
INNER = 4
#: Labels used to start the topics and to name them, chosen by hash: at most about so many.
LABELLED = 200_000
#: Texts that start the topic of another kind, at most about so many.
OTHERS = 20_000
#: Sentences a subject needs; terms of a topic that are looked up to name it.
SENTENCES, TOP = 3, 200
#: Prior share of sentences of no subject, prior weight of each subject in a document.
NONE, ALPHA = 0.5, 0.1
#: Occurrences by which a term's share is smoothed, most that one term tells, and the share of a term's occurrences from which it starts a topic.
SMOOTH, MOST, STARTING = 3.0, 2.5, 0.55
#: Occurrences of terms handled at a time.
CHUNK = 400_000

_ENDS = re.compile(r"(?<=[。！？!?])(?![」』”）)])|(?<=[。！？!?][」』”）)])|\n+|(?<=[a-z0-9)]\.)\s+|(?<=[?!])\s+")
_CLOSED = re.compile(r"[。！？.!?][」』”）)]*$")
_CJK = re.compile("[一-鿿]+")
_GAP = re.compile("(?<=[一-鿿]) +(?=[一-鿿])")
_WORDS = re.compile("[a-z]+")


def sentences(text: str) -> list[str]:
    """The sentences of a text; headings and other lines without an end mark are none."""
    return [s.strip() for s in _ENDS.split(text) if s and _CLOSED.search(s.strip())]


def terms(sentence: str, fold: Fold) -> set[str]:
    """Pairs of characters of scripts without spaces; words and pairs of words of others."""
    s = _GAP.sub("", sentence.lower().translate(fold))
    out = {run[i : i + 2] for run in _CJK.findall(s) for i in range(len(run) - 1)}
    words = _WORDS.findall(s)
    out |= {w for w in words if len(w) > 2}
    return out | {f"{a} {b}" for a, b in zip(words, words[1:])}


@functools.lru_cache(maxsize=500_000)
def slots(term: str) -> tuple[int, int]:
    """Two places of a term in the tables, one in either half; what both say counts, so hardly any terms are mixed up."""
    d = hashlib.blake2b(term.encode(), digest_size=8).digest()
    half = TERMS // 2
    return int.from_bytes(d[:4], "little") % half, half + int.from_bytes(d[4:], "little") % half


def hashed(sentence: str, fold: Fold) -> list[tuple[int, int]]:
    return sorted({slots(t) for t in terms(sentence, fold)})


class Rows:
    """The rows of a table that aren't all zero, looked up by number: what of it is worth sending to the workers."""

    def __init__(self, table: np.ndarray):
        self.at = np.flatnonzero(table.any(1)).astype(np.int32)
        self.rows = np.concatenate([table[self.at], np.zeros((1, table.shape[1]))]).astype(np.float32)

    def __getitem__(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.zeros((len(numbers), self.rows.shape[1]), np.float32)
        p = np.minimum(np.searchsorted(self.at, numbers), len(self.at) - 1)
        return self.rows[np.where(self.at[p] == numbers, p, len(self.at))]


def chunks(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of a batch in parts small enough for tables of occurrences by topics."""
    parts = np.cumsum([len(x) for x in pdf["feats"]]) // (2 * CHUNK)
    for _, part in pdf.groupby(parts):
        yield part.reset_index(drop=True)


class Batch:
    """Documents of a batch as arrays: term, twin and sentence of each occurrence, document of each sentence."""

    def __init__(self, pdf: pd.DataFrame):
        sizes = [np.asarray(x, np.int64) for x in pdf["sizes"]]
        self.docs = len(pdf)
        both = np.concatenate([np.asarray(x, np.int64) for x in pdf["feats"]]) if len(pdf) else np.zeros(0, np.int64)
        self.term, self.twin = both[0::2], both[1::2]
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.sentences = len(size)
        self.first = np.cumsum(size) - size
        self.sentence = np.repeat(np.arange(len(size)), size)
        self.doc_of = np.repeat(np.arange(self.docs), [len(s) for s in sizes])

    def per_doc(self, of_sentences: np.ndarray) -> np.ndarray:
        out = np.zeros((self.docs, of_sentences.shape[1]), of_sentences.dtype)
        if self.sentences:
            starts = np.flatnonzero(np.concatenate([[True], self.doc_of[1:] != self.doc_of[:-1]]))
            out[self.doc_of[starts]] = np.add.reduceat(of_sentences, starts, axis=0)
        return out

    def add(self, acc: np.ndarray, of_occurrences: np.ndarray) -> None:
        """acc[term] and acc[twin] += the rows of of_occurrences."""
        for where in (self.term, self.twin):
            if len(where):
                order = np.argsort(where, kind="stable")
                t = where[order]
                starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                acc[t[starts]] += np.add.reduceat(of_occurrences[order], starts, axis=0)


def inferred(b: Batch, told: Rows, width: int, free: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Topic shares of every sentence and, in sentences, of every document, for fixed topics; the first and the last `free` are of no subject."""
    if not b.sentences:
        return np.zeros((0, width)), np.zeros((b.docs, width))
    one, two = told[b.term], told[b.twin]
    score = np.add.reduceat(np.where(np.abs(one) < np.abs(two), one, two), b.first, axis=0).astype(np.float64)
    q, held = score, np.zeros((b.docs, width))
    for _ in range(INNER):
        theta = held[:, 1 : width - free] + ALPHA
        none = np.full((b.docs, 1), NONE)
        prior = np.concatenate([none, (1 - NONE) * theta / np.maximum(theta.sum(1, keepdims=True), 1e-9), *[none] * free], 1)
        q = score + np.log(prior)[b.doc_of]
        q = np.exp(q - q.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        held = b.per_doc(q)
    return q, held


def _summed(docs: DataFrame, tasks: int, width: int, step: Callable[[np.ndarray, Batch, pd.DataFrame], None]) -> np.ndarray:
    """The sum over all batches of step(batch, pdf), a TERMS x width table, added in slices and by groups of tasks."""
    rows = TERMS // SLICES

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((TERMS, width), np.float32)
        for pdf in it:
            for part in chunks(pdf):
                step(acc, Batch(part), part)
        met = np.flatnonzero(acc.any(1)).astype(np.int32)  # only terms that occurred are sent on
        for k in range(SLICES):
            at = met[(met >= k * rows) & (met < (k + 1) * rows)]
            if len(at):
                yield pd.DataFrame({"part": [k], "at": [at.tobytes()], "m": [acc[at].tobytes()]})

    def total(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(key[0])
        acc = np.zeros((rows, width), np.float32)
        for at, m in zip(pdf["at"], pdf["m"]):
            at = np.frombuffer(at, np.int32) - k * rows
            acc[at] += np.frombuffer(m, np.float32).reshape(len(at), width)
        met = np.flatnonzero(acc.any(1)).astype(np.int32)
        return pd.DataFrame({"part": [k], "at": [(met + k * rows).astype(np.int32).tobytes()], "m": [acc[met].tobytes()]})

    kind = "part int, at binary, m binary"
    parts = docs.mapInPandas(run, kind)
    groups = max(1, int(max(tasks, least_parts(docs.sparkSession)) ** 0.5))
    parts = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups))).groupBy("part", "g").applyInPandas(total, kind)
    out = np.zeros((TERMS, width), np.float32)
    for r in parts.groupBy("part").applyInPandas(total, kind).collect():
        out[np.frombuffer(r.at, np.int32)] = np.frombuffer(r.m, np.float32).reshape(-1, width)
    return out


def _featured(docs: DataFrame, key: str) -> DataFrame:
    fold = folding(docs.sparkSession)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            found = [[h for h in (hashed(s, fold) for s in sentences(t)) if h] for t in pdf["text"]]
            yield pd.DataFrame({"key": pdf["key"], "feats": [[x for s in d for pair in s for x in pair] for d in found], "sizes": [[len(s) for s in d] for d in found]})

    src = docs.where(F.col(key).isNotNull() & (F.col("text") != "")).select(F.col(key).cast("bigint").alias("key"), "text")
    return cut(distinct_by(src, "key").mapInPandas(run, "key long, feats array<int>, sizes array<int>"))


class Model:
    """What each hashed term tells for each topic (log of its share there against its share overall), and the topics' areas."""

    def __init__(self, told: np.ndarray, areas: list[int | None], free: int = 0):
        self.told, self.areas, self.width, self.free = Rows(told), areas, told.shape[1], free


def telling(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log of how much likelier a topic is where a term occurs than anywhere; counts of each term by topic, n of all."""
    usual = (counts.sum(0) + 1e-9) / max(counts.sum(), 1e-9)
    share = (counts + SMOOTH * usual) / (n[:, None] + SMOOTH)
    return (np.clip(np.log(share / usual), -MOST, MOST) * (n > 0)[:, None]).astype(np.float32)


def named(counts: np.ndarray, told: np.ndarray, labelled: np.ndarray, areas: list[int]) -> list[int | None]:
    """The area of each topic: that whose labelled documents hold the topic's TOP most telling terms more than their usual share; none for the first topic."""
    usual = labelled.sum(0) / max(labelled.sum(), 1e-9)
    out: list[int | None] = [None]
    for t in range(1, counts.shape[1]):
        top = np.argsort(-(counts[:, t] * np.maximum(told[:, t], 0)), kind="stable")[:TOP]
        met = labelled[top].sum(0)
        lift = met / max(met.sum(), 1e-9) / np.maximum(usual, 1e-9)
        out.append(areas[int(lift.argmax())] if met.sum() and lift.max() > 1 else None)
    return out


def fit(feats: DataFrame, labels: DataFrame, other: list[str] | None = None, fold: Fold | None = None) -> Model:
    """feats: what _featured gives; labels: key, area_id; other: texts of a kind that is of no subject, which start one more topic."""
    labels = labels.where("key is not null and area_id is not null").select("key", "area_id").distinct()
    n_labels = labels.count()
    if n_labels > LABELLED:
        labels = labels.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(1_000_000 * LABELLED / n_labels))
    marks: dict[int, list[int]] = {}
    for r in labels.collect():
        marks.setdefault(r.key, []).append(r.area_id)
    areas = sorted({a for m in marks.values() for a in m})
    k = len(areas)
    if not k:
        return Model(np.zeros((TERMS, 1), np.float32), [None])
    place = {a: i for i, a in enumerate(areas)}
    tasks = feats.rdd.getNumPartitions()  # of a scan: nothing runs for it

    def counted(acc: np.ndarray, b: Batch, pdf: pd.DataFrame) -> None:
        by_doc = np.zeros((b.docs, k + 1), np.float32)
        by_doc[:, 0] = 1
        for j, key in enumerate(pdf["key"]):
            for a in marks.get(key, ()):
                by_doc[j, 1 + place[a]] = 1 / len(marks[key])
        b.add(acc, by_doc[b.doc_of[b.sentence]])

    first = _summed(feats, tasks, k + 1, counted).astype(np.float64)
    n, labelled = first[:, 0], first[:, 1:]
    there = labelled.sum(1)
    start = telling(labelled, there)
    start[(labelled + SMOOTH * labelled.sum(0) / max(labelled.sum(), 1e-9)) < STARTING * (there[:, None] + SMOOTH)] = 0
    start = np.concatenate([np.zeros((TERMS, 1), np.float32), start], 1)
    free = 0
    if other:
        # What such texts say more often than the corpus starts the topic, once two of their sentences have it.
        seen = np.zeros(TERMS)
        for t in other:
            for x in sentences(t):
                seen[[h for pair in hashed(x, fold or {}) for h in pair]] += 1
        lift = np.log((seen / max(seen.sum(), 1) + 1e-12) / (n / max(n.sum(), 1) + 1e-12))
        start = np.concatenate([start, (np.clip(lift, 0, MOST) * ((seen >= 2) & (n > 0)))[:, None].astype(np.float32)], 1)
        free = 1
    width = k + 1 + free
    told, areas_of = start, [None, *areas] + [None] * free
    for _ in range(FITTING):

        def expectation(acc: np.ndarray, b: Batch, pdf: pd.DataFrame, told: Rows = Rows(told)) -> None:  # noqa: B008
            b.add(acc, inferred(b, told, width, free)[0].astype(np.float32)[b.sentence])

        counts = _summed(feats, tasks, width, expectation).astype(np.float64)
        told = telling(counts, n)
        areas_of = named(counts[:, : k + 1], told, labelled, areas) + [None] * free
    return Model(told, areas_of, free)


def _texts(other: DataFrame | None) -> list[str]:
    """Texts that start the topic of another kind: all, or about OTHERS of them by hash."""
    if other is None:
        return []
    c = F.col(other.columns[0])
    other = other.where(c.isNotNull()).distinct()
    n = other.count()
    return [r[0] for r in (other if n <= OTHERS else other.where(F.pmod(F.xxhash64(c), F.lit(1_000_000)) < int(1_000_000 * OTHERS / n))).collect()]


def document_subjects(docs: DataFrame, labels: DataFrame, key: str = "doc_id", other: DataFrame | None = None) -> DataFrame:
    """key, area_id, n_sentences for each document and area whose topic proportion amounts to SENTENCES sentences.

    docs has key and text; labels has the key and area_id (human labels of a part of the
    documents); other has one column of texts of a kind that is of no subject. n_sentences is the proportion times the number of sentences, rounded. Null and
    empty texts and documents without sentences give no rows, repeated rows count once.
    Without labels there are no areas and no rows.
    """
    feats = _featured(docs, key)
    model = fit(feats, labels.select(F.col(key).cast("bigint").alias("key"), "area_id"), _texts(other), folding(docs.sparkSession))
    areas = sorted({a for a in model.areas if a is not None})
    place = np.array([[a == b for b in areas] for a in model.areas], np.float64).reshape(len(model.areas), len(areas))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (part for whole in it for part in chunks(whole)):
            out = []
            if areas:
                n = np.rint(inferred(Batch(pdf), model.told, model.width, model.free)[1] @ place).astype(np.int64)
                out = [(int(pdf["key"].iat[d]), int(areas[a]), int(n[d, a])) for d, a in zip(*np.nonzero(n >= SENTENCES))]
            yield pd.DataFrame(out, columns=[key, "area_id", "n_sentences"])

    return feats.mapInPandas(run, f"`{key}` long, area_id int, n_sentences long")


def topic_terms(docs: DataFrame, labels: DataFrame, key: str = "doc_id", most: int = 12, other: DataFrame | None = None) -> DataFrame:
    """topic, area_id, rank, term, n_docs: each topic's terms that tell it best, for inspection, with the area it was mapped to.

    Topic 0 takes what is of no subject. Terms are counted by documents over the whole corpus.
    """
    feats = _featured(docs, key)
    fold = folding(docs.sparkSession)
    model = fit(feats, labels.select(F.col(key).cast("bigint").alias("key"), "area_id"), _texts(other), fold)
    areas = docs.sparkSession.createDataFrame([(t, a) for t, a in enumerate(model.areas)], "topic int, area_id int")

    def met(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"term": [t for text in pdf["text"] for t in {x for s in sentences(text) for x in terms(s, fold)}]}, dtype=object)

    def told(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            both = np.array([slots(t) for t in pdf["term"]], np.int64).reshape(-1, 2)
            how = np.minimum(model.told[both[:, 0]], model.told[both[:, 1]])
            for t in range(model.width):
                yield pd.DataFrame({"topic": t, "term": pdf["term"], "n_docs": pdf["n_docs"], "told": how[:, t].astype(float) * np.log1p(pdf["n_docs"])})

    src = docs.where(F.col(key).isNotNull() & (F.col("text") != "")).select("text")
    per = src.mapInPandas(met, "term string").groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    per = per.mapInPandas(told, "topic int, term string, n_docs long, told double").where("told > 0")
    # The best of each part first, so that no task takes in all terms of a topic.
    part = Window.partitionBy("topic", F.pmod(F.xxhash64("term"), F.lit(64))).orderBy(F.desc("told"), "term")
    few = per.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= most)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("told"), "term"))).where(F.col("rank") <= most)
    return ranked.join(areas, "topic").select("topic", "area_id", "rank", "term", "n_docs")


def composition(subjects: DataFrame, areas: DataFrame) -> DataFrame:
    """area_id, area, n_docs, n_sentences, share of all subject sentences; areas without documents have zeros."""
    per = subjects.groupBy("area_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_sentences").alias("n_sentences"))
    all_ = per.agg(F.sum("n_sentences").alias("all"))
    return (
        areas.select("area_id", "area")
        .distinct()
        .join(per, "area_id", "left")
        .join(F.broadcast(all_))
        .select("area_id", "area", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"), F.round(F.coalesce(F.col("n_sentences") / F.col("all"), F.lit(0.0)), 6).alias("share"))
    )
