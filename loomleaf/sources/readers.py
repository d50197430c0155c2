"""Readers: whole-text markdown, parsed files, binary files with hashes, office documents, HTML, edge lists, failure logs.

Each returns a lazy DataFrame; formats that need a parser run it in Python over Arrow batches,
and say why a file gave nothing instead of failing the job.
"""

from __future__ import annotations

import io
import shutil
import subprocess
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomleaf.functions import text as T
from loomleaf.functions.charset import decoded_utf8

CODE_TYPE = "struct<code:string,stage:string,category:string,ordinal:int,code_format:string>"
STRUCTURED = (
    "schema_version string, domain string, source_file string, frontmatter struct<title:string,domain:string,source:string,source_url:string,published_date:string,downloaded_date:string>, "
    f"parsed_at string, structure_type string, no_codes boolean, section_5_title string, raw_section_5 string, performance_codes array<{CODE_TYPE}>, content_codes array<{CODE_TYPE}>, "
    "performance_count int, content_count int, stages_present array<string>, warnings array<string>"
)


def markdown(spark: SparkSession, path: str, domains: list[str] | None = None) -> DataFrame:
    """path, domain (the folder), text of each .md file whose name doesn't begin with an underscore."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    file = F.try_url_decode(F.col("_metadata.file_path"))
    df = df.select(file.alias("path"), F.element_at(F.split(file, "/"), -2).alias("domain"), F.col("value").alias("text"))
    df = df.where(~F.startswith(F.element_at(F.split("path", "/"), -1), F.lit("_")) & ~F.startswith("domain", F.lit("_")))
    return df if domains is None else df.where(F.col("domain").isin(domains))


def structured(spark: SparkSession, path: str) -> DataFrame:
    """Parsed files, one JSON document each, with their path; a broken one gives a row of nulls and its text in _corrupt."""
    df = spark.read.schema(STRUCTURED + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "*.structured.json").json(path)
    return df.withColumn("path", F.try_url_decode(F.col("_metadata.file_path")))


# What users of a domain's parsed files should know.
DOMAIN_HINTS = {"社會": "表格型：stage label 在 cell 內（非獨立 heading 行），parser 不切段。stages_present 欄位已標明實際 stage 分布。"}


def parsed_markdown(docs: DataFrame) -> DataFrame:
    """path, domain, text parsed: frontmatter, section, structure type, codes by kind, stages, warnings.

    Codes are explodable arrays in the order of the text; general guidelines are of type none, other files without the section unknown.
    """
    section = T.section("text")
    found = T.codes(section, math=F.col("domain") == "數學")
    all_ = F.transform(found, T.code_parts)
    typed = docs.select("path", "domain", T.frontmatter("text").alias("frontmatter"), T.section_title("text").alias("section_5_title"), section.alias("raw_section_5"), all_.alias("codes"))
    none = F.col("raw_section_5") == ""
    # General guidelines have no codes of their own; a file without the section is of unknown type otherwise.
    general = F.contains("domain", F.lit("總綱"))
    hints = F.coalesce(*[F.when(F.col("domain") == d, F.array(F.lit(h))) for d, h in DOMAIN_HINTS.items()], F.array().cast("array<string>"))
    return typed.select(
        "path", "domain", "frontmatter", "section_5_title", "raw_section_5",
        F.when(general, "none").when(none, "unknown").otherwise(T.structure_type("raw_section_5")).alias("structure_type"),
        F.filter("codes", lambda c: c["kind"] == "performance").alias("performance_codes"),
        F.filter("codes", lambda c: c["kind"] == "content").alias("content_codes"),
        T.sorted_stages(F.transform("codes", lambda c: c["stage"])).alias("stages_present"),
        F.array_compact(F.concat(F.array(F.when(none & ~general, F.lit("no section")), F.when(~none & (F.size("codes") == 0), F.lit("no codes"))), hints)).alias("warnings"),
    )


def files(spark: SparkSession, path: str, extensions: list[str] | None = None, first: int | None = None) -> DataFrame:
    """path, ext, size, sha256, content of every file below a folder; or of the first ones by path, if so many are asked for."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    df = df.select(F.try_url_decode("path").alias("path"), ext.alias("ext"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")
    df = df if extensions is None else df.where(F.col("ext").isin(extensions))
    return df if first is None else df.orderBy("path").limit(first)


def texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of .txt files as UTF-8, what isn't valid replaced."""
    return files(spark, path, ["txt"]).select("path", decoded_utf8("content").alias("text"))


def manual_edges(spark: SparkSession, path: str, domain: str) -> DataFrame:
    from loomleaf.operators.graph import parse_manual_edges

    return parse_manual_edges(spark.read.text(path).withColumn("domain", F.lit(domain)), "value", "domain")


def failure_log(spark: SparkSession, path: str) -> DataFrame:
    """generated_at, total, success, path, reason: a row for each failure of a log."""
    df = spark.read.schema("generated_at string, total long, success long, fail_count long, fail array<struct<path:string,reason:string>>").option("multiLine", True).json(path)
    return df.select("generated_at", "total", "success", F.explode_outer("fail").alias("f")).select("generated_at", "total", "success", "f.path", "f.reason")


def _docx(data: bytes) -> str:
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in root.iter(f"{w}p"))


def _program(*commands: list[str]) -> Callable[[bytes], str]:
    def run(data: bytes) -> str:
        for c in commands:
            if shutil.which(c[0]):
                return subprocess.run(c, input=data, capture_output=True, timeout=60, check=True).stdout.decode("utf-8", "replace")
        raise LookupError(f"{commands[0][0]} not installed")

    return run


def first_text(*extractors: Callable[[bytes], str]) -> Callable[[bytes], str]:
    """The text of the first extractor that gives any; the first one's reason if none does."""

    def run(data: bytes) -> str:
        why: Exception | None = None
        for f in extractors:
            try:
                if (text := f(data)).strip():
                    return text
            except Exception as e:  # the next one may read it
                why = why or e
        raise why or ValueError("no text")

    return run


#: What turns a file's bytes into text, by extension. Others are skipped with a reason.
EXTRACTORS: dict[str, Callable[[bytes], str]] = {
    "txt": lambda b: b.decode("utf-8", "replace"),
    "docx": _docx,
    "pdf": lambda b: first_text(_program(["pdftotext", "-layout", "-", "-"]), ocr(["chi_tra+eng", "eng"]))(b),
    "doc": _program(["antiword", "-"], ["catdoc", "-"]),
}


def extracted(found: DataFrame, extractors: dict[str, Callable[[bytes], str]] = EXTRACTORS) -> DataFrame:
    """path, ext, size, sha256, text, reason: the text of each file, or why there is none ('<ext>-skipped: ...')."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            text, why = [], []
            for ext, data in zip(pdf["ext"], pdf.pop("content")):
                try:
                    if ext not in extractors:
                        raise LookupError("no extractor")
                    text.append(extractors[ext](bytes(data)))
                    why.append(None)
                except Exception as e:  # a file that can't be read is a result, not an error of the job
                    text.append(None)
                    why.append(f"{ext}-skipped: {type(e).__name__}: {e}"[:300])
            yield pdf.assign(text=text, reason=why)

    return found.select("path", "ext", "size", "sha256", "content").mapInPandas(run, "path string, ext string, size long, sha256 string, text string, reason string")


class _Page(HTMLParser):
    """Links with the nearest heading before them, and the text of main parts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str, str, str]] = []
        self.heading, self.kind, self.href, self.text, self.skip = "", "", None, [], 0
        self.in_heading, self.main, self.depth = False, [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.in_heading, self.heading = True, ""
        elif tag == "a" and a.get("href"):
            self.href, self.text = a["href"], []
        elif tag in ("iframe", "source") and a.get("src"):
            self.links.append((tag, a["src"], "", self.heading))
        if tag in ("main", "article") or a.get("role") == "main" or a.get("id") == "content":
            self.depth += 1
        elif self.depth and tag not in ("br", "img", "hr", "input", "meta", "link", "source"):
            self.depth += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.in_heading = False
        elif tag == "a" and self.href is not None:
            self.links.append(("a", self.href, "".join(self.text).strip(), self.heading.strip()))
            self.href = None
        if self.depth and tag not in ("br", "img", "hr", "input", "meta", "link", "source"):
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if self.in_heading:
            self.heading += data
        if self.href is not None:
            self.text.append(data)
        if self.depth:
            self.main.append(data)


def html_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, kind, href, text, heading of the links of a page; of equal addresses the first counts."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for k, h in zip(pdf[key], pdf[html]):
                p, seen = _Page(), set()
                p.feed(h or "")
                for kind, href, text, heading in p.links:
                    if href not in seen:
                        seen.add(href)
                        rows.append((k, kind, href, text[:200], heading))
            yield pd.DataFrame(rows, columns=[key, "kind", "href", "text", "heading"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {dict(pages.dtypes)[key]}, kind string, href string, text string, heading string")


def html_text(pages: DataFrame, key: str, html: str, least: int = 100) -> DataFrame:
    """key, text of the main part of a page, where it has more than `least` characters; else of the whole page without tags."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for h in pdf[html]:
                p = _Page()
                p.feed(h or "")
                main = " ".join("".join(p.main).split())
                if len(main) <= least:
                    p = _Page()
                    p.depth = 1 << 20
                    p.feed(h or "")
                    main = " ".join("".join(p.main).split())
                out.append(main)
            yield pd.DataFrame({key: pdf[key], "text": out})

    return pages.select(key, html).mapInPandas(run, f"`{key}` {dict(pages.dtypes)[key]}, text string")


#: Where the main text of a page is looked for, one after the other: tag, attribute, value.
MAIN_PARTS = (("main", "", ""), ("article", "", ""), ("", "role", "main"), ("", "class", "course-content"), ("", "id", "content"), ("body", "", ""))


class _Parts(HTMLParser):
    """The text of the first element of each kind of main part."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[str] | None] = [None] * len(MAIN_PARTS)
        self.open: list[tuple[str, list[int]]] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in self.VOID:
            return
        self.skip += tag in ("script", "style")
        a = {k: (v or "").split() for k, v in attrs}
        starts = [i for i, (t, k, v) in enumerate(MAIN_PARTS) if self.found[i] is None and (t == tag if t else v in a.get(k, ()))]
        for i in starts:
            self.found[i] = []
        self.open.append((tag, starts))

    def handle_endtag(self, tag: str) -> None:
        self.skip -= self.skip > 0 and tag in ("script", "style")
        if any(t == tag for t, _ in self.open):
            while self.open and self.open.pop()[0] != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.skip:
            for _, starts in self.open:
                for i in starts:
                    self.found[i].append(data)


def main_text(pages: DataFrame, key: str, html: str, longer_than: int = 100, error_below: int | None = None) -> DataFrame:
    """key, text, error: the text of the first main part, in the order of MAIN_PARTS, that has more characters than longer_than; else what the last one has.

    error names texts that have fewer than error_below characters. A null page has no text.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            texts = []
            for h in pdf[html]:
                p = _Parts()
                p.feed(h or "")
                parts = [" ".join("".join(x).split()) for x in p.found if x is not None]
                texts.append(next((x for x in parts if len(x) > longer_than), parts[-1] if parts else ""))
            short = ["too short" if error_below is not None and len(t) < error_below else None for t in texts]
            yield pd.DataFrame({key: pdf[key], "text": texts, "error": short})

    return pages.select(key, html).mapInPandas(run, f"`{key}` {dict(pages.dtypes)[key]}, text string, error string")


def link_titles(links: DataFrame) -> DataFrame:
    """Links with title: the heading nearby if it says other than the link, else the last part of the address."""
    last = F.regexp_extract(F.regexp_replace("href", "[?#].*$|/+$", ""), "([^/]*)$", 1)
    heading = F.when((F.col("heading") != "") & (F.col("heading") != F.col("text")), F.col("heading"))
    return links.withColumn("title", F.coalesce(heading, F.nullif(last, F.lit("")), F.col("text")))


def marked_links(links: DataFrame, marker: str) -> DataFrame:
    """Links whose words hold the marker."""
    return links.where(F.contains("text", F.lit(marker)))


def two_levels(first: DataFrame, second: DataFrame) -> DataFrame:
    """first (page, href) followed to second's links, whose page is that address: page, via, href, text; each address of a page once."""
    a = first.select("page", F.col("href").alias("via")).distinct()
    b = second.select(F.col("page").alias("_page"), "href", "text")
    return a.join(b, F.col("via") == F.col("_page")).groupBy("page", "href").agg(F.min("via").alias("via"), F.min("text").alias("text"))


def embedded_folder(html: Column) -> Column:
    """The id of the folder that a page embeds, by link first, then by frame; null without one."""
    by_link = F.regexp_extract(html, r"""(?is)<a\b[^>]*href=["'][^"']*embeddedfolderview[^"']*?id=([\w-]+)""", 1)
    by_frame = F.regexp_extract(html, r"""(?is)<iframe\b[^>]*src=["'][^"']*?id=([\w-]+)""", 1)
    return F.coalesce(F.nullif(by_link, F.lit("")), F.nullif(by_frame, F.lit("")))


def named_files(html: Column) -> Column:
    """id and name of the files that a page links to; of equal ids the first counts."""
    links = F.regexp_extract_all(html, F.lit(r"(?s)(/file/d/[\w-]+[^>]*>[^<]*)"), 1)
    pairs = F.transform(links, lambda e: F.struct(F.regexp_extract(e, r"/file/d/([\w-]+)", 1).alias("id"), F.trim(F.regexp_extract(e, r"(?s)>([^<]*)$", 1)).alias("name")))
    return F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda q: q["id"] == p["id"]))


def paper_pairs(ids: DataFrame, key: str) -> DataFrame:
    """key, part: the two downloads of each paper, itself and its answer key."""
    return ids.select(key).distinct().select(key, F.explode(F.array(F.lit("paper"), F.lit("answer"))).alias("part"))


def folder_ids(html: Column) -> Column:
    """Ids of shared folders a page links to, each once."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"folders/([\w-]+)"), 1))


def file_ids(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"/file/d/([\w-]+)"), 1))


def valid_download(status: Column, size: Column, head: Column) -> Column:
    """Whether a response is worth keeping: good status, not tiny, no page of HTML."""
    return (status == 200) & (size >= 500) & ~F.lower(head).rlike(r"^\s*<(?:!doctype|html)")


def ocr(languages: list[str], dpi: int = 150, pages: int = 1) -> Callable[[bytes], str]:
    """An extractor for scanned PDF files: pages drawn at a resolution and read in the first language that gives text."""

    def run(data: bytes) -> str:
        import tempfile
        from pathlib import Path

        if not (shutil.which("pdftoppm") and shutil.which("tesseract")):
            raise LookupError("pdftoppm or tesseract not installed")
        with tempfile.TemporaryDirectory() as d:  # of one file, gone when it is read
            (Path(d) / "in.pdf").write_bytes(data)
            subprocess.run(["pdftoppm", "-r", str(dpi), "-l", str(pages), "-png", f"{d}/in.pdf", f"{d}/page"], check=True, timeout=60)
            for lang in languages:
                got = [subprocess.run(["tesseract", str(p), "-", "-l", lang], capture_output=True, timeout=60).stdout.decode("utf-8", "replace") for p in sorted(Path(d).glob("page*.png"))]
                if "".join(got).strip():
                    return "\n".join(got)
        raise ValueError("no text recognised")

    return run


def listed_files(html: Column) -> Column:
    """id and name of the office and PDF files of a folder listing, whose entries carry data-id; of equal ids the first counts."""
    entries = F.regexp_extract_all(html, F.lit(r'(?s)(data-id="[\w-]+"[^>]*>\s*[^<\n]+)'), 1)
    pairs = F.transform(entries, lambda e: F.struct(F.regexp_extract(e, 'data-id="([^"]+)"', 1).alias("id"), F.trim(F.regexp_extract(e, r">\s*([^<\n]+)$", 1)).alias("name")))
    good = F.filter(pairs, lambda p: F.lower(p["name"]).rlike(r"\.(?:pdf|docx?|pptx?|xlsx?)$"))
    return F.filter(good, lambda p, i: ~F.exists(F.slice(good, F.lit(1), i), lambda q: q["id"] == p["id"]))


def first_valid(responses: DataFrame, key: str, order: str, ok: Column) -> DataFrame:
    """The first response of each key, in the order of its variants, that is worth keeping."""
    keep = [c for c in responses.columns if c != key]
    return responses.where(ok).groupBy(key).agg(F.min_by(F.struct(*keep), order).alias("x")).select(key, "x.*")
