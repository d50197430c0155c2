"""Visually identical text brought to one written form, on code-point arrays.

A whole Arrow string column becomes one numpy array of code points. Characters are replaced by
gathers from lookup tables (with expansion offsets where one becomes several or none), then
combining marks are ordered and composed by searches in a table of pairs. Nothing is called
per row or per character.

The tables are built by rule from the Unicode data that Python carries: compatibility forms
(full-width letters, Roman numerals, CJK radicals, ligatures) by NFKD, spaces and invisible
characters by category. Look-alike letters are the one list that no rule gives.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Letters of other scripts that look like the ASCII letter they stand under.
LOOKALIKES = {
    "A": "ΑАᎪ", "B": "ΒВᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ΕЕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "ΗНᎻ", "I": "ΙІӀӏᏆ", "J": "ЈᎫ", "K": "ΚКᏦ", "L": "Ꮮ", "M": "ΜМᎷ",
    "N": "Ν", "O": "ΟОՕ", "P": "ΡРᏢ", "Q": "Ԛ", "R": "Ꭱ", "S": "ЅᏚ", "T": "ΤТᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ΧХ", "Y": "ΥҮ", "Z": "ΖᏃ",
    "a": "аɑα", "b": "Ь", "c": "сϲ", "d": "ԁɗ", "e": "еҽ", "f": "ƒ", "g": "ɡց", "h": "һհ", "i": "іɩι", "j": "јϳ", "k": "κк", "l": "ⅼ", "m": "м",
    "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛզ", "r": "г", "s": "ѕ", "t": "т", "u": "υս", "v": "ѵν", "w": "ѡԝ", "x": "хχ", "y": "уγ", "z": "ᴢ",
    "-": "‐‑‒–—―−⁃˗﹣－﹘",
}

SIZE = sys.maxunicode + 1


@functools.lru_cache(maxsize=4)
def _tables(code: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts, lengths, pool: what each code point turns into, decomposed. code: of codes, where no space belongs."""
    given = {ord(c): to for to, froms in LOOKALIKES.items() for c in froms}
    lengths, pool = np.ones(SIZE, np.int64), [np.arange(SIZE, dtype=np.uint32)]
    starts, end = np.arange(SIZE, dtype=np.int64), SIZE
    for cp in range(SIZE):
        if 0xD800 <= cp <= 0xDFFF or 0xE000 <= cp <= 0xF8FF or 0xF0000 <= cp or 0x30000 <= cp < 0xE0000:
            continue
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind == "Cf" or kind == "Cc" and (code or ch not in "\t\n\r\f") or 0xFE00 <= cp <= 0xFE0F:
            to = ""
        elif kind in ("Zs", "Zl", "Zp") or code and ch.isspace():
            to = "" if code else " "
        else:
            to = unicodedata.normalize("NFKD", ch)
            if code:
                to = given.get(cp) or "".join(given.get(ord(x), x) for x in to)
        if to != ch:
            out = np.array([ord(x) for x in to], np.uint32)
            starts[cp], lengths[cp] = end, len(out)
            pool.append(out)
            end += len(out)
    return starts, lengths, np.concatenate(pool)


@functools.lru_cache(maxsize=1)
def _pairs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys base << 21 | mark with what each pair composes to, and the combining class of every code point."""
    keys, made, classes = [], [], np.zeros(SIZE, np.uint8)
    for cp in range(SIZE):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        classes[cp] = unicodedata.combining(ch)
        parts = unicodedata.decomposition(ch).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.normalize("NFC", ch) == ch:
            keys.append(int(parts[0], 16) << 21 | int(parts[1], 16))
            made.append(cp)
    for cp in range(0xAC00, 0xD7A4):  # syllables, whose parts follow from their number
        s = cp - 0xAC00
        first, second = (cp - s % 28, 0x11A7 + s % 28) if s % 28 else (0x1100 + s // 588, 0x1161 + s % 588 // 28)
        keys.append(first << 21 | second)
        made.append(cp)
    order = np.argsort(np.array(keys, np.int64))
    return np.array(keys, np.int64)[order], np.array(made, np.uint32)[order], classes


def to_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """points, offsets of an Arrow string column; a null row is empty."""
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    _, raw_offsets, data = column.buffers()
    at = np.frombuffer(raw_offsets, np.int64, n + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, np.uint8, at[-1] - at[0], offset=at[0]) if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    if column.null_count:  # bytes under a null are no text
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        keep = np.repeat(valid, np.diff(at))
        raw, at = raw[keep], np.concatenate([[0], np.cumsum(np.where(valid, np.diff(at), 0))])
    first = (raw & 0xC0) != 0x80
    chars_before = np.concatenate([[0], np.cumsum(first)])
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, chars_before[at].astype(np.int64)


def from_points(points: np.ndarray, offsets: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """The Arrow string column of such arrays; rows not valid are null."""
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    ends = np.concatenate([[0], np.cumsum(width)])
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    bits = None if valid is None or valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends[offsets].astype(np.int64).tobytes()), pa.py_buffer(data), bits).cast(pa.string())


def _compose(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks put in canonical order and composed with their base, pass by pass over all rows at once."""
    keys, made, classes = _pairs()
    ccc = classes[points]
    if ccc.any():  # stable sort of each run of marks by class; starters keep their place
        run = np.cumsum(ccc == 0)
        order = np.lexsort((ccc, run, rows))
        points, rows, ccc = points[order], rows[order], ccc[order]
    while len(points) > 1:
        at = np.arange(len(points))
        start = ccc == 0
        before = np.concatenate([[-1], at[:-1]])
        # A mark belongs to the last starter, and reaches it past marks of lower classes; a starter only to one right before it.
        base = np.where(start, np.where(start[before] & (before >= 0), before, -1), np.maximum.accumulate(np.where(start, at, -1)))
        free = (base >= 0) & (rows[base] == rows) & ((base == before) | ~start & (ccc[before] < ccc))
        wanted = points[base].astype(np.int64) << 21 | points
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = np.flatnonzero(free & (keys[found] == wanted))
        if not len(hit):
            break
        # Of each base the first; none whose base is itself taken up in this pass.
        hit = hit[np.unique(base[hit], return_index=True)[1]]
        hit = hit[~np.isin(base[hit], hit)]
        points = points.copy()
        points[base[hit]] = made[found[hit]]
        keep = np.ones(len(points), bool)
        keep[hit] = False
        points, rows, ccc = points[keep], rows[keep], ccc[keep]
    return points, rows


@functools.lru_cache(maxsize=1)
def _scripts() -> tuple[np.ndarray, np.ndarray]:
    """What letter of ASCII each look-alike letter stands for (itself for others), and for each code point: 1 an ASCII letter, 2 a look-alike, 3 another letter or mark, 0 none."""
    to, kind = np.arange(SIZE, dtype=np.uint32), np.zeros(SIZE, np.uint8)
    for cp in range(0x250):
        if chr(cp).isalpha():
            kind[cp] = 1 if cp < 128 else 3
    for cp in range(0x250, 0x2000):
        if unicodedata.category(chr(cp))[0] in "LM":
            kind[cp] = 3
    for letter, froms in LOOKALIKES.items():
        if letter.isalpha():
            for c in froms:
                to[ord(c)], kind[ord(c)] = ord(letter), 2
    return to, kind


def _mixed_words(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Look-alike letters turned into ASCII in words that hold ASCII letters, and no letters of their script that look like none; genuine Greek or Cyrillic words stay."""
    to, kinds = _scripts()
    kind = kinds[points]
    word = np.cumsum(np.concatenate([[True], (kind[1:] == 0) | (kind[:-1] == 0) | (rows[1:] != rows[:-1])])) - 1 if len(points) else np.zeros(0, np.int64)
    n = int(word[-1]) + 1 if len(points) else 0
    ascii_, alike, other = (np.bincount(word[kind == k], minlength=n) for k in (1, 2, 3))
    mixed = (ascii_ > 0) & (alike > 0) & (other == 0)
    return np.where(mixed[word] & (kind == 2), to[points], points).astype(np.uint32) if len(points) else points


def unify_points(points: np.ndarray, offsets: np.ndarray, code: bool) -> tuple[np.ndarray, np.ndarray]:
    starts, lengths, pool = _tables(code)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    size = lengths[points]
    total = int(size.sum())
    first = np.cumsum(size) - size
    gather = np.repeat(starts[points] - first, size) + np.arange(total)
    points, rows = pool[gather], np.repeat(rows, size)
    if not code:
        points = _mixed_words(points, rows)
    points, rows = _compose(points, rows)
    if not code:  # runs of blanks to one, none at the ends of a row
        blank = points == 32
        before = np.concatenate([[True], blank[:-1] | (rows[1:] != rows[:-1])]) if len(points) else blank
        keep = ~(blank & before)
        points, rows = points[keep], rows[keep]
        last = np.concatenate([rows[1:] != rows[:-1], [True]]) if len(points) else np.zeros(0, bool)
        keep = ~((points == 32) & last)
        points, rows = points[keep], rows[keep]
    return points, np.searchsorted(rows, np.arange(len(offsets))).astype(np.int64)


def _stage_letters(points: np.ndarray, offsets: np.ndarray, whole: bool) -> np.ndarray:
    """Small l, digit 1 aside, read as I where a stage stands: in the whole value, or between the first two hyphens of a code.

    Elsewhere in a code no l is touched. A code's middle part that holds digits only is a stage number and stays.
    """
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if whole:
        inside = np.ones(len(points), bool)
    else:
        hyphen = points == 45
        count = np.cumsum(hyphen)
        start = np.concatenate([[0], count])[offsets[:-1]]
        inside = (count - start[rows] == 1) & ~hyphen
    wrong = inside & ((points == ord("l")) | (points == ord("i")) | (points == ord("|")))
    upper = inside & (points == ord("v"))
    out = points.copy()
    out[wrong], out[upper] = ord("I"), ord("V")
    return out


def unify_column(column: pa.Array, code: bool = False, stage: bool = False) -> pa.Array:
    """Each text of the column in its one written form; nulls stay null, a text of invisible characters becomes empty.

    code: for codes, where blanks vanish, every dash is a hyphen and look-alike letters turn ASCII;
    stage: for stage names, which are upper-case Roman numerals. Otherwise blanks of all kinds
    become single spaces, and look-alike letters turn ASCII only in words that hold ASCII letters too.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    points, offsets = to_points(column)
    points, offsets = unify_points(points, offsets, code or stage)
    if code or stage:
        points = _stage_letters(points, offsets, stage)
    return from_points(points, offsets, column.is_valid().to_numpy(zero_copy_only=False))


def unify(df: DataFrame, columns: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """df with a column more for each entry of columns (source -> name of the new one).

    kinds gives for a source 'code', 'stage' or 'text' (the default). No shuffle; every other
    column passes through. A new name that df already has replaces that column.
    """
    fields = [f for f in df.schema.fields if f.name not in columns.values()]
    schema = T.StructType(fields + [T.StructField(name, T.StringType()) for name in columns.values()])
    kept = [f.name for f in fields]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            new = [unify_column(b.column(b.schema.get_field_index(src)), kinds.get(src) == "code", kinds.get(src) == "stage") for src in columns]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(k)) for k in kept] + new, names=kept + list(columns.values()))

    return df.mapInArrow(batches, schema)


def content_code_nodes(codes: DataFrame) -> DataFrame:
    """code_id, node_id of the content codes whose code or stage is not written as nodes writes it."""
    src = codes.select("code_id", "domain", "code", "stage")
    out = unify(src, {"code": "unified_code", "stage": "unified_stage"}, {"code": "code", "stage": "stage"})
    odd = "unified_code <> code or (stage is not null and unified_stage <> stage)"
    return out.where(odd).selectExpr("code_id", "concat(domain, '/', unified_code) as node_id").distinct()
