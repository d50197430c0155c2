"""Writers: frontmatter documents, JSON, output paths, index sections, partitioned rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frontmatter_text(values: list[tuple[str, Column]], body: Column) -> Column:
    """A markdown document: its frontmatter in the order given, nulls left out, values quoted where they need it."""

    def line(name: str, c: Column) -> Column:
        v = c.cast("string")
        quoted = F.when(v.rlike(r"[:\n]|^[\[{'\"]"), F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(v)
        return F.when(v.isNotNull() & (v != ""), F.concat(F.lit(f"{name}: "), quoted))

    return F.concat(F.lit("---\n"), F.array_join(F.array_compact(F.array(*[line(n, c) for n, c in values])), "\n"), F.lit("\n---\n\n"), F.coalesce(body, F.lit("")))


def safe(c: Column, none: str = "未分") -> Column:
    return F.regexp_replace(F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")), F.lit(none)), r'[\\/:*?"<>|\s]+', "_")


def output_path(folders: list[Column], parts: list[Column], digest: Column, ext: str = "md") -> Column:
    """folders/part-part-sha8.ext with nothing in it that a file name can't hold."""
    stem = F.array_join(F.array_compact(F.array(*[F.when(p.isNotNull() & (p.cast("string") != ""), safe(p)) for p in parts])), "-")
    return F.concat(F.array_join(F.array(*[safe(f) for f in folders]), "/"), F.lit("/"), stem, F.lit("-"), F.left(digest, F.lit(8)), F.lit(f".{ext}"))


def distinct_paths(df: DataFrame, path: str, order: str) -> DataFrame:
    """df with its path made distinct: the second row of a path gets -2 before the extension, and so on."""
    n = F.row_number().over(Window.partitionBy(path).orderBy(order))
    return df.withColumn("_n", n).withColumn(path, F.when(F.col("_n") > 1, F.regexp_replace(path, r"(\.[A-Za-z0-9]+)$", F.concat(F.lit("-"), F.col("_n").cast("string"), F.lit("$1")))).otherwise(F.col(path))).drop("_n")


def upsert_section(page: Column, heading: str, section: Column) -> Column:
    """A page with the section of that heading replaced, or put at its end."""
    without = F.regexp_replace(page, rf"(?s)\n*## {heading}\n.*?(?=\n## |\z)", "")
    return F.concat(F.rtrim(without), F.lit(f"\n\n## {heading}\n"), section, F.lit("\n"))


def json_documents(df: DataFrame) -> Column:
    """Each row as a JSON text, nulls left out, nothing escaped beyond what JSON asks."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]))


def write_documents(df: DataFrame, path: str, text: str, by: list[str]) -> None:
    """Documents as JSON lines in folders by the columns `by`; a rerun replaces only the folders it has rows for."""
    df.select(*by, F.col(text).alias("text")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def digest_paths(df: DataFrame, path: str, digest: str) -> DataFrame:
    """df with paths that several rows share told apart by four more letters of the digest before the extension; a null digest has none.

    Which paths are shared is counted, not ranked, so a path that many rows share is no burden.
    """
    shared = df.groupBy(path).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(path).alias("_p"))
    t = df.join(shared, F.col(path) == F.col("_p"), "left")
    tail = F.concat(F.lit("-"), F.left(F.col(digest), F.lit(4)), F.lit("$1"))
    return t.withColumn(path, F.when(F.col("_p").isNotNull() & F.col(digest).isNotNull(), F.regexp_replace(path, r"(\.[A-Za-z0-9]+)$", tail)).otherwise(F.col(path))).drop("_p")


def planned(df: DataFrame, by: list[str], text: str) -> DataFrame:
    """What a writer would write, without writing: rows and bytes by folder."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.octet_length(text)).alias("n_bytes"))


def chapter_text(title: Column, url: Column, body: Column, links: Column, most: int = 20) -> Column:
    """A course or chapter as a markdown document with its first media links (kind, href, text)."""
    listed = F.transform(F.slice(links, 1, most), lambda x: F.concat(F.lit("- "), x["kind"], F.lit(": ["), F.coalesce(F.left(x["text"], F.lit(50)), F.lit("")), F.lit("]("), x["href"], F.lit(")")))
    media = F.when(F.size(links) > 0, F.concat(F.lit("\n\n## 媒體\n\n"), F.array_join(listed, "\n"))).otherwise("")
    return frontmatter_text([("title", title), ("source_url", url)], F.concat(F.coalesce(body, F.lit("")), media))


def documents_in_files(df: DataFrame, root: str, path: str, text: str) -> DataFrame:
    """path, written: every document in a file of its own below root, by the tasks that hold the rows. Paths must be distinct; existing files are replaced."""
    import posixpath
    from collections.abc import Iterator

    import pandas as pd
    from pyarrow import fs

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, base = fs.FileSystem.from_uri(root)
        for pdf in it:
            n = []
            for p, t in zip(pdf["path"], pdf["text"]):
                to = posixpath.join(base, p)
                where.create_dir(posixpath.dirname(to), recursive=True)
                data = (t or "").encode()
                with where.open_output_stream(to) as out:
                    out.write(data)
                n.append(len(data))
            yield pd.DataFrame({"path": pdf["path"], "written": n})

    return df.select(F.col(path).alias("path"), F.col(text).alias("text")).mapInPandas(run, "path string, written long")
