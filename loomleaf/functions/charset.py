"""Legacy character sets, which the engine's own decode refuses: Arrow functions over whole columns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CJK = re.compile("[一-鿿]")


def _count(s: str) -> int:
    return len(_CJK.findall(s))


def _as_utf8(s: str) -> str | None:
    try:
        return s.encode("latin-1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None


@F.pandas_udf(T.StringType())
def utf8_from_latin1(values: pd.Series) -> pd.Series:
    """Texts whose UTF-8 bytes were read as Latin-1, mended where that gives at least three more ideographs."""
    out = []
    for v in values:
        got = _as_utf8(v) if v is not None else None
        out.append(got if got is not None and _count(got) >= _count(v) + 3 else v)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.StringType())
def path_from_latin1(values: pd.Series) -> pd.Series:
    """Paths mended segment by segment, where one has three such characters in a row."""

    def segment(s: str) -> str:
        got = _as_utf8(s) if re.search("[\x80-\xff]{3,}", s) else None
        return got if got is not None and _CJK.search(got) else s

    return pd.Series([None if v is None else "/".join(map(segment, v.split("/"))) for v in values], dtype=object)


@F.pandas_udf(T.StringType())
def decoded_utf8(content: pd.Series) -> pd.Series:
    """Bytes as UTF-8, what isn't replaced."""
    return pd.Series([None if b is None else bytes(b).decode("utf-8", "replace") for b in content], dtype=object)


def name_from_charset(name: Column, charset: str) -> Column:
    """A name whose bytes in `charset` were read as Windows-1252 or Latin-1, mended where ideographs come out."""

    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        out = []
        for v in values:
            got = v
            for wrong in ("latin-1", "cp1252"):
                if v is not None and not _CJK.search(v):
                    try:
                        t = v.encode(wrong).decode(charset)
                    except (UnicodeEncodeError, UnicodeDecodeError):
                        continue
                    if _CJK.search(t):
                        got = t
                        break
            out.append(got)
        return pd.Series(out, dtype=object)

    return run(name)
