"""Records of several sources combined to target shares of the total size.

Copies of one text count once, with all sources that hold it. Texts are summed up by that
pattern of sources; how many tokens of which pattern go to which source is a minimum-cost flow
over patterns, in which a further copy of the same text costs more than the one before. Then
documents are picked in a seeded order until each flow is used up.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomleaf.runtime import cut, hot_keys, lookup_join, running_total, spread, union_all

#: The session's setting that names the tokenizer's file on every machine, and where that is if it isn't set.
SETTING, TOKENIZER = "spark.loomleaf.tokenizer", "/opt/tokenizers/byte_bpe_50k.json"
#: Patterns of sources that one flow takes on the driver; more make more flows, each of which meets the shares by itself.
PATTERNS = 20_000


class Flow:
    """Minimum-cost flow by successive cheapest paths, in whole tokens."""

    def __init__(self) -> None:
        self.heads: dict[object, list[int]] = {}
        self.to: list[object] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: object, b: object, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.heads.setdefault(x, []).append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, start: object, end: object) -> int:
        sent = 0
        while True:
            far, by, waiting, queued = {start: 0}, {}, deque([start]), {start}
            while waiting:
                x = waiting.popleft()
                queued.discard(x)
                for e in self.heads.get(x, ()):
                    y = self.to[e]
                    if self.room[e] > 0 and far[x] + self.cost[e] < far.get(y, 1 << 60):
                        far[y], by[y] = far[x] + self.cost[e], e
                        if y not in queued:
                            waiting.append(y)
                            queued.add(y)
            if end not in by:
                return sent
            path, y = [], end
            while y != start:
                path.append(by[y])
                y = self.to[by[y] ^ 1]
            n = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= n
                self.room[e ^ 1] += n
            sent += n


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    repeats: int


def solved(patterns: dict[tuple[str, ...], int], targets: list[Target], total: int) -> tuple[int, dict[tuple[tuple[str, ...], str], int]]:
    """Tokens placed, and how many of each pattern go to each source, for a mix of `total` tokens."""
    flow, arcs = Flow(), {}
    want = {t.source: t for t in targets}
    for p, tokens in patterns.items():
        laps = max((want[s].repeats for s in p if s in want), default=0)
        for k in range(laps):
            flow.arc("in", p, tokens, k)
        for s in p:
            if s in want:
                arcs[p, s] = flow.arc(p, ("to", s), tokens * want[s].repeats)
    for t in targets:
        flow.arc(("to", t.source), "out", int(t.share * total))
    sent = flow.run("in", "out")
    return sent, {k: flow.room[e ^ 1] for k, e in arcs.items() if flow.room[e ^ 1]}


def largest_total(patterns: dict[tuple[str, ...], int], targets: list[Target]) -> int:
    """The largest total at which every source that has any documents reaches its share."""
    there = {s for p in patterns for s in p}
    able = [t for t in targets if t.source in there and t.share > 0 and t.repeats > 0]
    if not able:
        return 0
    low, high = 0, int(sum(patterns.values()) * max(t.repeats for t in able) / min(t.share for t in able)) + 1
    while high - low > max(1, high // 100_000):
        mid = (low + high) // 2
        if solved(patterns, able, mid)[0] >= sum(int(t.share * mid) for t in able):
            low = mid
        else:
            high = mid
    return low


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """docs (key, source, text) as key, source, text_hash, tokens; a null text has no tokens.

    tokenizer is a file of the public tokenizers library; left out, the session's setting
    SETTING names it.
    """
    path = tokenizer or docs.sparkSession.conf.get(SETTING, TOKENIZER)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isfile(path):
            raise FileNotFoundError(f"no tokenizer at {path}; name one by {SETTING} or the argument tokenizer")
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        for pdf in it:
            texts = list(pdf.pop("text"))
            # Encodings hold far more than ids; a few hundred at a time keep them small.
            pdf["tokens"] = [len(e.ids) for i in range(0, len(texts), 256) for e in t.encode_batch(texts[i : i + 256], add_special_tokens=False)]
            yield pdf

    src = docs.where("text is not null").select("key", "source", F.sha2("text", 256).alias("text_hash"), "text")
    return spread(src).mapInPandas(run, "key long, source string, text_hash string, tokens long")


def _stretches(rows: list, wanted: list[Target], size: int | None) -> list[tuple[str, str, int, int]]:
    """pid, source, lo, hi: which stretch of a pattern's line goes to which source, lap by lap, by one flow over the patterns in rows."""
    patterns = {tuple(r.pattern): r.tokens for r in rows}
    ids = {tuple(r.pattern): r.pattern_id for r in rows}
    _, flows = solved(patterns, wanted, largest_total(patterns, wanted) if size is None else size)
    # Each pattern's texts lie on a line, over and over again; each source takes a stretch of it.
    out, used = [], {}
    for (p, s), n in sorted(flows.items()):
        a = used.get(p, 0)
        used[p] = a + n
        for lap in range(a // patterns[p], -(-(a + n) // patterns[p])):
            out.append((ids[p], s, max(a - lap * patterns[p], 0), min(a + n - lap * patterns[p], patterns[p])))
    return out


def mixed(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 7, key: str = "doc_id", tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (key, source, copies, tokens) and the report by source.

    docs has key, source and text; targets has source, target_share and max_repeats. total is
    the size wanted in tokens; left out, it is the largest at which every source with any
    documents reaches its share. Copies of a text are one document, the smallest key, which
    may serve any of its sources, each at most max_repeats times. Texts of sources without target are
    used only where another source with a target holds them too; null and empty texts are
    never used. Sources without documents are reported with no tokens. The report has source,
    target_share, reached_share, tokens, n_docs, most_copies, max_repeats.

    A pattern is the set of target sources that hold a text. More patterns than PATTERNS are
    split by hash into parts with a flow each; all of them are used, the shares hold in each
    part and so in all, only the number of repeats is the least within each part.
    """
    spark = docs.sparkSession
    src = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), "source", "text")
    counted = token_counts(src, tokenizer).where("tokens > 0 and source is not null")
    want = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    wanted = [Target(r.source, float(r.target_share or 0), int(r.max_repeats or 0)) for r in want.collect()]
    texts = counted.groupBy("text_hash").agg(F.min("key").alias("key"), F.max("tokens").alias("tokens"), F.collect_set("source").alias("sources"))
    known = F.array(*[F.lit(t.source) for t in wanted]).cast("array<string>")
    texts = texts.withColumn("pattern", F.array_sort(F.array_intersect("sources", known))).where(F.size("pattern") > 0)
    texts = cut(texts.select("key", "tokens", F.to_json("pattern").alias("pattern_id"), "pattern"))
    patterns = cut(texts.groupBy("pattern_id").agg(F.first("pattern").alias("pattern"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")))
    met = patterns.agg(F.count(F.lit(1)).alias("patterns"), F.sum("n").alias("texts"), F.sum("tokens").alias("tokens")).first()
    parts, plans = max(1, -(-met.patterns // PATTERNS)), []
    for b in range(parts):
        rows = patterns.where(F.pmod(F.xxhash64("pattern_id"), F.lit(parts)) == b).collect()
        share = sum(r.tokens for r in rows) / max(met.tokens or 0, 1)
        plan = spark.createDataFrame(_stretches(rows, wanted, None if total is None else int(total * share)), "pid string, source string, lo long, hi long")
        plans.append(plan if parts == 1 else cut(plan))
    # At most as many stretches for a pattern as there are sources and repeats.
    plan = union_all(plans).groupBy("pid").agg(F.collect_list(F.struct("source", "lo", "hi")).alias("stretches"))
    line = running_total(texts.withColumn("at", F.xxhash64(F.lit(seed), "key")), "pattern_id", "at", "tokens", "start", met.texts or 0)
    line = lookup_join(line, plan, ("pattern_id", "pid"), hot_keys(patterns, "pattern_id", "n", met.texts or 0), spread="key", how="inner")
    taken = F.filter("stretches", lambda x: (F.col("start") >= x["lo"]) & (F.col("start") < x["hi"]))
    chosen = line.select("key", "tokens", F.explode(taken).alias("s")).groupBy("key", F.col("s.source").alias("source"))
    chosen = chosen.agg(F.count(F.lit(1)).alias("copies"), F.max("tokens").alias("tokens")).withColumnRenamed("key", key)
    per = chosen.groupBy("source").agg(F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.count(F.lit(1)).alias("n_docs"), F.max("copies").alias("most_copies"))
    whole = per.agg(F.sum("tokens").alias("whole"))
    report = (
        want.join(per, "source", "left")
        .join(F.broadcast(whole))
        .select("source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)), 6).alias("reached_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats")
    )
    return chosen, report
