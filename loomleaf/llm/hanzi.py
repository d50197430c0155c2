"""Variants of Chinese characters and plain forms of text for comparison.

The table of simplified characters is not kept here: Spark brings the International Components
for Unicode, whose public Traditional-Simplified transform tells every variant.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
from pyspark.sql import SparkSession

#: The blocks of Chinese characters that the transform is asked about.
BLOCKS = ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00))

Fold = dict[int, str]


@functools.lru_cache(maxsize=1)
def _folding() -> tuple[tuple[int, str], ...]:
    jvm = SparkSession.active()._jvm
    there = [chr(c) for a, b in BLOCKS for c in range(a, b)]
    to = jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified").transliterate("\n".join(there)).split("\n")
    return tuple((ord(a), b) for a, b in zip(there, to) if a != b and len(b) == 1)


def folding(spark: SparkSession) -> Fold:
    """For str.translate: every traditional character and its simplified form, so that both written forms compare equal."""
    return dict(_folding())


def letters(text: str, fold: Fold) -> str:
    """Letters and digits alone, lower case, compatibility forms and variants of characters folded."""
    s = unicodedata.normalize("NFKC", text).lower().translate(fold)
    return "".join(c for c in s if c.isalnum())


@functools.lru_cache(maxsize=2)
def _table(fold: tuple[tuple[int, str], ...]) -> np.ndarray:
    """A table for Letters, which the tasks of one Python process share."""
    return np.full(0x110000, Letters.UNSEEN, np.uint32)


class Letters:
    """letters() of many texts at once, by a table of code points that fills as they come.

    Only texts whose code points each give one letter or none, whatever stands beside them, go by the table; the others,
    with marks, conjoining Jamo, a capital sigma or a form of several letters, go through letters().
    """

    UNSEEN, SLOW = 0xFFFFFFFF, 0xFFFFFFFE
    #: Characters looked up at a time (a longer text is by itself).
    AT_ONCE = 1_000_000

    def __init__(self, fold: Fold):
        self.fold = fold
        self.table = _table(tuple(sorted(fold.items())))

    def _one(self, cp: int) -> int:
        c = chr(cp)
        first, form = unicodedata.normalize("NFKD", c)[0], unicodedata.normalize("NFKC", c)
        jamo = "\u1160" <= first <= "\u11ff" or "\ud7b0" <= first <= "\ud7ff"
        if unicodedata.combining(first) or unicodedata.category(first)[0] == "M" or jamo or "Σ" in form:
            return self.SLOW
        to = letters(c, self.fold)
        return self.SLOW if len(to) > 1 else ord(to) if to else 0

    def __call__(self, texts: list[str]) -> list[str]:
        out: list[str] = []
        while len(out) < len(texts):
            i = j = len(out)
            size = 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= self.AT_ONCE):
                size += len(texts[j])
                j += 1
            out += self._some(texts[i:j])
        return out

    def _some(self, texts: list[str]) -> list[str]:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        to = self.table[points]
        if (new := to == self.UNSEEN).any():
            for cp in np.unique(points[new]).tolist():
                self.table[cp] = self._one(cp)
            to = self.table[points]
        ends = np.cumsum([len(t) for t in texts])
        slow = set(np.searchsorted(ends, np.flatnonzero(to == self.SLOW), side="right").tolist())
        kept = to != 0
        to[to == self.SLOW] = 32
        plain = to[kept].tobytes().decode("utf-32-le")
        at = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends]).astype(np.int64)].tolist()
        return [letters(t, self.fold) if d in slow else plain[at[d] : at[d + 1]] for d, t in enumerate(texts)]
