"""Text that was decoded with the wrong character encoding: found, and restored where possible.

A best-first search over texts: each step encodes with one character set and decodes with
another, or resolves escapes; visited texts are hashed. The cost of a text is how implausible
its characters are, learned from all texts of the corpus; the search goes on from the cheapest
text and ends when no cheaper one is in reach. A value is garbled where a much cheaper text is
reachable, wholly or for one of its words, or where it holds what no writer types: replacement
characters, C1 controls, private-use characters. The search ends by itself: every step must keep
the cost within ABOVE of the text's own, and no text is visited twice.
"""

from __future__ import annotations

import functools
import heapq
import html
import math
import re
import sys
import unicodedata
import urllib.parse
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomleaf.runtime import spread

ENCODERS = ("western", "cp437", "mac_roman", "gb18030", "cp950", "big5hkscs", "shift_jis", "cp850", "koi8_r")
DECODERS = ("utf-8", "cp950", "big5hkscs", "gb18030", "shift_jis")
#: What a step adds to the cost, by how much the text must get cheaper, and by how much a text on the way may be dearer.
STEP, GAIN, ABOVE = 1.5, 6.0, 10.0
#: Most that a letter with a mark costs inside a word of plain letters.
WORD_LETTER = 4.0
ODD = re.compile("[�\x80-\x9f-\U000f0000-\U0010ffff]")
ESCAPED = re.compile(r"&#?\w+;|%[0-9A-Fa-f]{2}|\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}")


@functools.lru_cache(maxsize=1)
def _western() -> dict[int, int]:
    """Windows-1252 with the undefined bytes as C1 controls, as browsers read it, for str.translate to Latin-1."""
    out = {}
    for b in range(0x80, 0xA0):
        try:
            out[ord(bytes([b]).decode("cp1252"))] = b
        except UnicodeDecodeError:
            pass
    return out


def encoded(text: str, how: str) -> bytes | None:
    try:
        return text.translate(_western()).encode("latin-1") if how == "western" else text.encode(how)
    except UnicodeEncodeError:
        return None


def unescaped(text: str) -> str:
    if not ESCAPED.search(text):
        return text
    text = re.sub(r"\\[ux]([0-9a-fA-F]{4}|(?<=x)[0-9a-fA-F]{2})", lambda m: chr(int(m[1], 16)), text)
    return urllib.parse.unquote(html.unescape(text))


@functools.lru_cache(maxsize=100_000)
def prior(ch: str) -> float:
    """How often a character counts as seen that the corpus doesn't have."""
    o = ord(ch)
    if o < 128:
        return 5.0
    if ODD.match(ch) or unicodedata.category(ch) in ("Cn", "Cc", "Cf"):
        return 1e-4
    if 0x3400 <= o <= 0x9FFF:
        try:
            b = ch.encode("big5")
            return 0.5 if b[0] < 0xC9 else 0.05
        except UnicodeEncodeError:
            return 0.05
    return 0.02


class Plausibility:
    """Costs of characters from their counts: minus the logarithm of their share."""

    def __init__(self, counts: dict[str, int]):
        self.counts, self.total = counts, sum(counts.values()) + 1_000
        self.known: dict[str, float] = {}

    def __call__(self, text: str) -> float:
        cost = 0.0
        for i, ch in enumerate(text):
            c = self.known.get(ch)
            if c is None:
                seen = 0 if ODD.match(ch) else self.counts.get(ch, 0)
                c = self.known[ch] = -math.log((seen + prior(ch)) / self.total)
            # A letter with a mark beside a plain letter makes a word of another language, however rare it is here.
            if c > WORD_LETTER and "\xc0" <= ch <= "\u024f" and ch.isalpha() and (text[i - 1 : i] + text[i + 1 : i + 2]).isascii() and any(x.isalpha() for x in (text[i - 1 : i], text[i + 1 : i + 2])):
                c = WORD_LETTER
            cost += c
        return cost


def cheapest(text: str, cost: Plausibility) -> tuple[str, float, float]:
    """The cheapest text in reach, its cost with the steps to it, and the cost of the text itself."""
    own = cost(text)
    best, low = text, own
    heap, visited = [(own, 0, text)], {text}
    while heap:
        at, steps, t = heapq.heappop(heap)
        if at < low:
            best, low = t, at
        reached = [unescaped(t)]
        for how in ENCODERS:
            if (raw := encoded(t, how)) is not None:
                for back in DECODERS:
                    if back != how:
                        try:
                            reached.append(raw.decode(back))
                        except UnicodeDecodeError:
                            pass
        for r in reached:
            if r not in visited and r:
                visited.add(r)
                if (c := cost(r) + STEP * (steps + 1)) <= own + ABOVE:
                    heapq.heappush(heap, (c, steps + 1, r))
    return best, low, own


RUN = re.compile(r"[^\x00-\x7f　-鿿＀-￯]{2,}")


def repaired(value: str, cost: Plausibility) -> tuple[bool, str | None]:
    """Whether the value is garbled, and the original text: null where it can't be recovered, the value itself where nothing is wrong."""
    if value.isascii() and not ESCAPED.search(value):
        return False, value
    if not ODD.search(value) or "�" not in value:
        text, low, own = cheapest(value, cost)
        if own - low >= GAIN and not ODD.search(text):
            return True, text
    words, changed = value.split(" "), False
    for i, w in enumerate(words):
        if w.isascii() and not ESCAPED.search(w) or "�" in w:
            continue
        text, low, own = cheapest(w, cost)
        if own - low < GAIN:
            text = _by_runs(w, cost)
        if text != w:
            words[i], changed = text, True
    whole = " ".join(words)
    if ODD.search(whole):
        return True, None
    return changed, whole


def _by_runs(word: str, cost: Plausibility) -> str:
    def one(m: re.Match[str]) -> str:
        text, low, own = cheapest(m[0], cost)
        return text if own - low >= GAIN else m[0]

    return RUN.sub(one, word)


def character_counts(records: DataFrame, columns: list[str]) -> dict[str, int]:
    """How often each character occurs in the columns over all rows.

    Counted in whole Arrow columns where the rows are; what a task sends on, and what reaches
    the driver, has a row for each different character, so at most as many as Unicode has.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(sys.maxunicode + 1, np.int64)
        for b in it:
            for column in b.columns:
                points = np.frombuffer("".join(column.drop_null().to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
                if len(points):
                    low = np.bincount(points)
                    n[: len(low)] += low
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["ch", "n"])

    per = records.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, "ch int, n long")
    return {chr(r.ch): r.n for r in per.groupBy("ch").agg(F.sum("n").alias("n")).collect()}


def garbled_values(records: DataFrame, key: str, fields: list[str], context: list[str]) -> DataFrame:
    """key, field, value, original for each garbled value of the fields; original is null where it is lost.

    context names further text columns from which plausibility is learned, with the fields
    themselves. Null and empty values are never garbled. Exact repeats of rows give one row.
    No shuffle but those of the counting and the final distinct.
    """
    src = records.select(key, *dict.fromkeys(fields + context))
    counts = character_counts(src, list(dict.fromkeys(fields + context)))

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cost, known = Plausibility(counts), {}
        for pdf in it:
            if len(known) > 200_000:
                known.clear()
            for f in fields:
                rows = []
                for k, v in zip(pdf[key], pdf[f]):
                    if v is None or v == "":
                        continue
                    if (got := known.get(v)) is None:
                        got = known[v] = repaired(v, cost)
                    if got[0]:
                        rows.append((k, f, v, got[1]))
                yield pd.DataFrame(rows, columns=[key, "field", "value", "original"])

    kind = records.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("field", T.StringType()), T.StructField("value", T.StringType()), T.StructField("original", T.StringType())])
    return spread(src.select(key, *fields).where(F.col(key).isNotNull())).mapInPandas(batches, schema).distinct()
