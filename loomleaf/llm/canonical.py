"""Freely typed values mapped to the entries of a reference list.

All spellings of the reference list (canonical names, English names, aliases) are paths of one
trie. A value is searched with a Levenshtein automaton: the row of edit costs against the
value is its state, moved along the trie's edges and given up where every cost is over the
limit, so all entries within a distance that depends on the length come out in one walk
(entries_in_reach). An edit costs 1, less where it is a usual slip: a character doubled, two
neighbours swapped, or a character that the corpus shows to be mistaken for another.

What the reference list lacks is learned from all rows, from other columns that name the entry
too (a file's name, say): further alias paths, characters mistaken for one another, and the
words that stand around names of any entry. Each must be borne out beyond chance.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomleaf.llm.hanzi import Fold, folding
from loomleaf.runtime import cut, hot_keys, lookup_join, spread, stripped, union_all

#: Costs of edits; one character missing or too many costs 1.
SLIP, DOUBLED, SWAPPED, OTHER = 0.5, 0.5, 0.8, 1.2
#: Largest number of reference spellings in one trie; longer lists are searched block by block.
TRIE_PATHS = 100_000
#: Different entries around which words must stand to be no part of a name, and the most letters of such words.
AROUND, AROUND_LETTERS = 3, 8
#: What is learned must hold in more than half of all cases, beyond chance: lower end of Wilson's interval at two deviations.
SURE = 0.5

CANDIDATES = "field string, value string, value_id int, distance double, stripped int"


def plain(value: str, fold: Fold) -> str:
    """Letters and digits of the value in one form: compatibility forms and variants of characters folded, lower case, no marks or blanks."""
    s = unicodedata.normalize("NFKC", value).casefold().translate(fold)
    return "".join(c for c in s if unicodedata.category(c)[0] in "LN")


def bared(value: str, before: frozenset[str], behind: frozenset[str]) -> list[str]:
    """The plain value, then all that is left when known words before and behind it are taken off, longest first."""
    out, waiting = {value: None}, [value]
    while waiting:
        v = waiting.pop(0)
        cuts = [v[n:] for n in range(1, min(AROUND_LETTERS, len(v) - 1) + 1) if v[:n] in before]
        cuts += [v[:-n] for n in range(1, min(AROUND_LETTERS, len(v) - 1) + 1) if v[-n:] in behind]
        for c in cuts:
            if c not in out:
                out[c] = None
                waiting.append(c)
    return sorted(out, key=lambda v: (-len(v), v))


def limit(length: int, latin: bool) -> float:
    """The distance up to which a value still stands for an entry; length is that of the longer of both."""
    if latin:
        return 0 if length < 4 else SWAPPED if length < 5 else OTHER if length < 8 else 2 * OTHER
    return 0 if length < 2 else SWAPPED if length < 4 else OTHER if length < 8 else 2 * OTHER


@dataclass
class Node:
    next: dict[str, "Node"] = field(default_factory=dict)
    ends: set[int] = field(default_factory=set)


class Trie:
    def __init__(self, paths: Iterable[tuple[str, int]], slips: frozenset[tuple[str, str]] = frozenset()):
        self.root, self.slips, self.longest = Node(), slips, 0
        for text, value_id in paths:
            node = self.root
            for c in text:
                node = node.next.setdefault(c, Node())
            if text:
                node.ends.add(value_id)
                self.longest = max(self.longest, len(text))

    def search(self, word: str) -> dict[int, float]:
        """value_id to its least distance, for every entry within the distance that both lengths allow."""
        found: dict[int, float] = {}
        n, slips, latin = len(word), self.slips, word.isascii()
        most = limit(n + 2, latin)
        if n > self.longest + most / DOUBLED:
            return found
        first = [0.0] * (n + 1)
        for j in range(1, n + 1):
            first[j] = first[j - 1] + (DOUBLED if j > 1 and word[j - 1] == word[j - 2] else 1)
        # Each item: a node, the path to it, the rows of its parent and of its parent's parent.
        stack: list[tuple[Node, str, list[float], list[float] | None]] = [(node, c, first, None) for c, node in self.root.next.items()]
        while stack:
            node, path, above, above2 = stack.pop()
            c = path[-1]
            row = [above[0] + 1]
            for j in range(1, n + 1):
                w = word[j - 1]
                best = above[j - 1] + (0 if w == c else SLIP if (w, c) in slips else OTHER)
                best = min(best, above[j] + 1, row[j - 1] + (DOUBLED if w == c or j > 1 and w == word[j - 2] else 1))
                if above2 is not None and j > 1 and w != c and w == path[-2] and word[j - 2] == c:
                    best = min(best, above2[j - 2] + SWAPPED)
                row.append(best)
            if node.ends and row[n] <= limit(max(n, len(path)), latin):
                for v in node.ends:
                    found[v] = min(found.get(v, 99.0), row[n])
            if min(row) <= most or min(above) <= most - SWAPPED:
                stack.extend((nxt, path + k, row, above) for k, nxt in node.next.items())
        return found

    def within(self, text: str) -> Iterator[tuple[int, int, int]]:
        """start, end, value_id of every path that stands in the text."""
        for i in range(len(text)):
            node, j = self.root, i
            while j < len(text) and (node := node.next.get(text[j])) is not None:
                j += 1
                for v in node.ends:
                    yield i, j, v

    def one_off(self, word: str) -> Iterator[tuple[str, str, int]]:
        """What is written, what would be right, value_id for every path of that length that differs in one character."""
        stack = [(self.root, 0, None)]
        while stack:
            node, i, changed = stack.pop()
            if i == len(word):
                if changed:
                    yield from ((*changed, v) for v in node.ends)
                continue
            for c, nxt in node.next.items():
                if c == word[i]:
                    stack.append((nxt, i + 1, changed))
                elif changed is None:
                    stack.append((nxt, i + 1, (word[i], c)))


def wilson(met: Column, n: Column) -> Column:
    """Lower end of the interval, at two deviations, for the part of n that met is."""
    p = met / n
    return (p + 2 / n - 2 * F.sqrt(p * (1 - p) / n + 1 / (n * n))) / (1 + 4 / n)


def spellings(entries: DataFrame, fold: Fold) -> DataFrame:
    """field, spelling, value_id: every plain spelling of every entry, one row each."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"field": pdf["field"], "spelling": [plain(s, fold) for s in pdf["given"]], "value_id": pdf["value_id"]})

    given = F.explode(F.array_compact(F.concat(F.array("canonical", "name_en"), F.coalesce("aliases", F.array().cast("array<string>")))))
    src = entries.where("canonical is not null and field is not null and value_id is not null").select("field", given.alias("given"), "value_id")
    return src.mapInPandas(run, "field string, spelling string, value_id int").where("spelling <> ''").distinct()


def blocks(paths: DataFrame) -> Iterator[dict[str, list[tuple[str, int]]]]:
    """The spellings by field, about TRIE_PATHS at a time."""
    k = max(1, -(-paths.count() // TRIE_PATHS))
    for b in range(k):
        out: dict[str, list[tuple[str, int]]] = {}
        for r in (paths if k == 1 else paths.where(F.pmod(F.xxhash64("spelling"), F.lit(k)) == b)).collect():
            out.setdefault(r["field"], []).append((r["spelling"], r["value_id"]))
        yield {f: sorted(p) for f, p in out.items()}


def surroundings(values: DataFrame, paths: DataFrame, fold: Fold) -> dict[str, tuple[frozenset[str], frozenset[str]]]:
    """By field the words before and the words behind names: what stands around spellings of AROUND different entries at least.

    A model of the corpus's habits that is sent to the workers: at most AROUND_LETTERS letters
    each, and each borne out by several entries.
    """

    def seen(block: dict) -> DataFrame:
        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tries = {f: Trie(p) for f, p in block.items()}
            for pdf in it:
                out = set()
                for f, v in zip(pdf["field"], pdf["value"]):
                    w = plain(v, fold)
                    for i, j, value_id in tries[f].within(w) if f in tries else ():
                        if j == len(w) and 0 < i <= AROUND_LETTERS:
                            out.add((f, "before", w[:i], value_id))
                        if i == 0 and 0 < len(w) - j <= AROUND_LETTERS:
                            out.add((f, "behind", w[j:], value_id))
                yield pd.DataFrame(sorted(out), columns=["field", "side", "words", "value_id"])

        return values.mapInPandas(run, "field string, side string, words string, value_id int")

    around = union_all([seen(b) for b in blocks(paths)]).groupBy("field", "side", "words").agg(F.count_distinct("value_id").alias("n")).where(F.col("n") >= AROUND)
    out: dict[str, dict[str, set[str]]] = {}
    for r in around.collect():
        out.setdefault(r["field"], {"before": set(), "behind": set()})[r["side"]].add(r["words"])
    return {f: (frozenset(x["before"]), frozenset(x["behind"])) for f, x in out.items()}


def told_entries(wanted: DataFrame, entries: DataFrame, told_by: list[str]) -> DataFrame:
    """field, value, value_id, n: how often records with that value name that entry in the columns told_by.

    Names are compared as whole words, letter case aside; a spelling of several entries tells none.
    wanted has field, value and those columns. Words are counted by value before they are looked up.
    """
    words = F.array_distinct(F.flatten(F.array(*[F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), r"[^\p{L}\p{N}]+|(?<=\D)(?=\d)|(?<=\d)(?=\D)") for c in told_by])))
    given = F.explode(F.array_compact(F.concat(F.array("canonical", "name_en"), F.coalesce("aliases", F.array().cast("array<string>")))))
    names = entries.select("field", given.alias("word"), "value_id").withColumn("word", F.lower("word")).where("word <> ''").groupBy("field", "word").agg(F.min("value_id").alias("value_id"), F.max("value_id").alias("_other")).where("value_id = _other").drop("_other")
    met = wanted.select("field", "value", F.explode(words).alias("word")).where("word <> ''").groupBy("field", "value", "word").count()
    return met.join(names, ["field", "word"]).groupBy("field", "value", "value_id").agg(F.sum("count").alias("n"))


def _with_core(values: DataFrame, around: dict, fold: Fold) -> DataFrame:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.assign(core=[bared(plain(v, fold), *around.get(f, (frozenset(), frozenset())))[-1] for f, v in zip(pdf["field"], pdf["value"])])

    return values.select("field", "value").mapInPandas(run, "field string, value string, core string").where("core <> ''")


def learned(values: DataFrame, told: DataFrame, paths: DataFrame, around: dict, fold: Fold) -> tuple[DataFrame, frozenset[tuple[str, str]]]:
    """Further alias paths (field, spelling, value_id), and the characters written for others, borne out by what records tell elsewhere."""
    by_core = told.join(_with_core(values, around, fold), ["field", "value"]).groupBy("field", "core", "value_id").agg(F.sum("n").alias("n"))
    top = cut(by_core.groupBy("field", "core").agg(F.max_by("value_id", F.struct("n", -F.col("value_id"))).alias("value_id"), F.max("n").alias("met"), F.sum("n").alias("n")))
    sure = top.where(wilson(F.col("met"), F.col("n")) >= SURE).select("field", F.col("core").alias("spelling"), "value_id")
    new = sure.join(paths.select("field", "spelling").distinct(), ["field", "spelling"], "left_anti")

    def votes(block: dict) -> DataFrame:
        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tries = {f: Trie(p) for f, p in block.items()}
            met: Counter[tuple[str, str]] = Counter()
            all_: Counter[tuple[str, str]] = Counter()
            for pdf in it:
                for f, core, value_id, k, n in zip(pdf["field"], pdf["core"], pdf["value_id"], pdf["met"], pdf["n"]):
                    said: dict[tuple[str, str], bool] = {}
                    for a, b, v in tries[f].one_off(core) if f in tries else ():
                        said[a, b] = said.get((a, b), False) or v == value_id
                    for pair, right in said.items():
                        all_[pair] += n
                        met[pair] += k * right
            yield pd.DataFrame([(a, b, met[a, b], n) for (a, b), n in all_.items()], columns=["a", "b", "met", "n"])

        return top.mapInPandas(run, "a string, b string, met long, n long")

    pairs = union_all([votes(b) for b in blocks(paths)]).groupBy("a", "b").agg(F.sum("met").alias("met"), F.sum("n").alias("n"))
    # At most as many as the list has characters times those written for them.
    slips = frozenset((r["a"], r["b"]) for r in pairs.where(wilson(F.col("met"), F.col("n")) >= SURE).collect())
    return new, slips


def entries_in_reach(values: DataFrame, paths: DataFrame, fold: Fold, around: dict | None = None, slips: frozenset[tuple[str, str]] = frozenset()) -> DataFrame:
    """field, value, value_id, distance, stripped: every entry within the distance that the value's length allows.

    values has field and value, paths has field, spelling and value_id. stripped is the number
    of letters taken off around the name; of several ways to an entry the nearest comes out.
    A list of more than TRIE_PATHS spellings is searched in blocks.
    """
    around = around or {}

    def searched(block: dict) -> DataFrame:
        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tries = {f: Trie(p, slips) for f, p in block.items()}
            for pdf in it:
                out = []
                for f, v in zip(pdf["field"], pdf["value"]):
                    if f not in tries or not (whole := plain(v, fold)):
                        continue
                    best: dict[int, tuple[float, int]] = {}
                    for word in bared(whole, *around.get(f, (frozenset(), frozenset()))):
                        for value_id, d in tries[f].search(word).items():
                            best[value_id] = min(best.get(value_id, (99.0, 0)), (d, len(whole) - len(word)))
                    out += [(f, v, value_id, d, s) for value_id, (d, s) in best.items()]
                yield pd.DataFrame(out, columns=["field", "value", "value_id", "distance", "stripped"])

        return values.select("field", "value").mapInPandas(run, CANDIDATES)

    return union_all([searched(b) for b in blocks(paths)])


def nearest(candidates: DataFrame) -> DataFrame:
    """field, value, value_id of the nearest entry, with the least taken off around it; 0 where two entries are equally near."""
    rank = F.struct(F.round("distance", 6).alias("d"), "stripped")
    best = candidates.withColumn("_rank", rank).groupBy("field", "value").agg(F.min("_rank").alias("_low"))
    met = candidates.withColumn("_rank", rank).join(best, ["field", "value"]).where("_rank = _low")
    return met.groupBy("field", "value").agg(F.min("value_id").alias("_a"), F.max("value_id").alias("_b")).select("field", "value", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(0).alias("value_id"))


def _needed(records: DataFrame, key: str, fields: list[str], entries: DataFrame, more: list[str]) -> DataFrame:
    """key, field, value and the columns `more`, for each value that is neither null nor blank nor a canonical of its field."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("_p")
    src = records.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *[F.col(c).alias(f"_m{i}") for i, c in enumerate(more)], pairs)
    src = src.select("key", F.col("_p.field").alias("field"), F.col("_p.value").alias("value"), *[f"_m{i}" for i in range(len(more))]).where(F.col("value").isNotNull() & (stripped("value") != ""))
    exact = entries.where("canonical is not null and field is not null").select("field", F.col("canonical").alias("value")).distinct()
    return src.join(exact, ["field", "value"], "left_anti")


def map_to_entries(records: DataFrame, key: str, fields: list[str], entries: DataFrame, told_by: list[str] | None = None) -> DataFrame:
    """key, field, value_id, value: one row for each record and field whose value needs mapping.

    entries has field, value_id, canonical, name_en, aliases. Values that are null, blank or
    already identical to a canonical of their field give no row; value_id is 0 for those that
    stand for no entry, or for two equally near ones. Exact repeats of records give one row.
    told_by names columns of records in which an entry's name may stand too; without them no
    aliases and mistaken characters are learned. Each different value is searched once, however
    often it occurs; its entry is then joined to the records, frequent values salted. All of
    the list is searched, in blocks. Without rows or entries nothing is learned.
    """
    fold = folding(records.sparkSession)
    told_by = told_by or []
    needed = _needed(records, key, fields, entries, told_by)
    values = cut(needed.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")))
    given = cut(spellings(entries, fold))
    around = surroundings(values, given, fold)
    aliases, slips = None, frozenset()
    if told_by:
        told = told_entries(needed.select("field", "value", *[F.col(f"_m{i}").alias(c) for i, c in enumerate(told_by)]), entries, told_by)
        aliases, slips = learned(values, told, given, around, fold)
    found = cut(nearest(entries_in_reach(spread(values), given, fold, around, slips)))
    if aliases is not None:
        # What the list leaves open is searched again along the learned alias paths.
        still = values.join(found.where("value_id <> 0"), ["field", "value"], "left_anti")
        paths = cut(aliases.join(_with_core(still, around, fold).select("field", F.col("core").alias("spelling")).distinct(), ["field", "spelling"], "left_semi"))
        more = nearest(entries_in_reach(still, paths, fold, around, slips))
        found = found.where("value_id <> 0").unionByName(more)
    ids = values.join(found, ["field", "value"], "left").select(F.concat_ws("\x01", "field", "value").alias("_name"), F.coalesce("value_id", F.lit(0)).alias("value_id"), "n")
    ids = cut(ids)
    rows = ids.agg(F.sum("n")).first()[0] or 0
    left = needed.select(F.col("key").alias(key), "field", "value", F.concat_ws("\x01", "field", "value").alias("_at"))
    out = lookup_join(left, ids.select("_name", "value_id"), ("_at", "_name"), hot_keys(ids.withColumnRenamed("_name", "_at"), "_at", "n", rows), spread=key, how="inner")
    return out.select(key, "field", F.col("value_id").cast("int").alias("value_id"), "value").distinct()


def unmatched_values(mapped: DataFrame) -> DataFrame:
    """field, value, n_rows of the values that stand for no entry."""
    return mapped.where("value_id = 0").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n_rows"))
