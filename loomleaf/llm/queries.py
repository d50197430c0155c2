"""Queries of the operators for training text, with their SQL twins where SQL can tell the result."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomleaf.llm import canonical, encoding, leakage, mixing, scans, subjects, unify
from loomleaf.runtime import table


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_to_entries(table(spark, d, "exam_records"), "exam_id", ["subject", "test_type"], table(spark, d, "canonical_values"), ["original_filename"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).select("exam_id", "field", "value_id").distinct()


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values that stand for no entry, with their numbers of exams."""
    return canonical.unmatched_values(_mapped(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.scan_noise(table(spark, d, "structured"))


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every text as continuous readable paragraphs."""
    return scans.repaired_text(table(spark, d, "structured"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.content_code_nodes(table(spark, d, "content_codes"))


def _garbled(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled_values(table(spark, d, "exam_records"), "exam_id", ["original_filename", "school"], ["subject", "test_type", "version", "body"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d).select("exam_id", "field").distinct()


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    """Every garbled value with its original, null where it can't be recovered."""
    return _garbled(spark, d)


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked, with the number of documents and the largest share held."""
    return _leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("share").alias("most"))


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mix, with the source they count for and how often they are repeated."""
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached."""
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def _passages(spark: SparkSession, d: str) -> DataFrame:
    """Reading passages, whose kind has no area."""
    return table(spark, d, "eval_items").select("text")


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "area_labels"), other=_passages(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "area_id")


def p9_topics(spark: SparkSession, d: str) -> DataFrame:
    """The terms that tell each topic best, with the area it was mapped to."""
    return subjects.topic_terms(table(spark, d, "documents"), table(spark, d, "area_labels"), other=_passages(spark, d))


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """How the corpus is made up by area."""
    return subjects.composition(_subjects(spark, d), table(spark, d, "subject_areas"))


QUERIES = {f.__name__: f for f in (p1_found, p1_unmatched, p3_found, p3_repaired, p4_found, p5_found, p5_restored, p7_found, p7_items, p8_documents, p8_shares, p9_found, p9_topics, p9_composition)}



# Fixed values of the SQL twin, kept apart from those of the operator: letters of other alphabets beside the ASCII letters they look like, and dashes.
SQL_LETTERS = {
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ": "ABEZHIKMNOPTYX", "αικνορυγ": "aikvopuy", "АВЕКМНОРСТХІЅЈӀӏ": "ABEKMHOPCTXISJII", "аеорсухіѕјкмт": "aeopcyxisjkmt", "ѴԌҮԜԚ": "VGYWQ", "ѵԁԛԝһ": "vdqwh", "ɑɡɩ": "agi",
}
SQL_DASHES = "‐‑‒–—―−⁃˗﹣－﹘"


def _written_form(column: str, stage: bool) -> str:
    """SQL that writes a code or stage as the node table does, by the standard's compatibility forms and the letters above."""
    ranges = [*range(0x2150, 0x2190), *range(0x2E80, 0x2FE0), *range(0xF900, 0xFB00), *range(0xFF01, 0xFF5F)]
    given = {c: to for froms, tos in SQL_LETTERS.items() for c, to in zip(froms, tos)} | dict.fromkeys(SQL_DASHES, "-")
    forms = {chr(cp): unicodedata.normalize("NFKC", chr(cp)) for cp in ranges if unicodedata.category(chr(cp)) != "Cn"} | given
    single = {a: b for a, b in forms.items() if len(b) == 1 and a != b and b not in "'\\"}
    quoted = lambda t: t.replace("'", "''")
    out = f"regexp_replace({column}, '[\\x{{00AD}}\\x{{180E}}\\x{{2000}}-\\x{{200F}}\\x{{202F}}\\x{{205F}}-\\x{{2064}}\\x{{3000}}\\x{{FEFF}}\\x{{A0}}\\s]', '', 'g')"
    out = f"translate({out}, '{quoted(''.join(single))}', '{quoted(''.join(single.values()))}')"
    for a, b in forms.items():
        if len(b) > 1 and b.isascii() and b.isalpha():
            out = f"replace({out}, '{a}', '{b}')"
    out = f"nfc_normalize({out})"
    if stage:
        return f"replace({out}, 'l', 'I')"
    return f"CASE WHEN regexp_matches({out}, '^[^-]*-[^-]*-[^-]*$') THEN split_part({out}, '-', 1) || '-' || replace(split_part({out}, '-', 2), 'l', 'I') || '-' || split_part({out}, '-', 3) ELSE {out} END"


SQL: dict[str, str] = {
    "p4_found": f"WITH t AS (SELECT code_id, domain, code, stage, {_written_form('code', False)} AS c, {_written_form('stage', True)} AS s FROM content_codes) SELECT DISTINCT code_id, domain || '/' || c AS node_id FROM t WHERE c <> code OR s <> stage",
}
