"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing extra columns."""
from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def tokens(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n=60, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.9)) % words}" for _ in range(n))


def awkward_docs():
    """(doc_id, text, lang, source, n_chars)"""
    base = prose(1, 80)
    words = base.split()
    rows = [
        (0, base, "en", "a", 0), (1, base.upper().replace("W", "w"), "en", "a", 0), (2, base, None, None, None),
        (3, " ".join(words[:-3]), "en", "b", 0), (4, " ".join(words[:40]), "en", "b", 0),
        (5, None, "en", "b", 0), (6, "", "en", "c", 0), (7, " \t\n\x0b\x0c\r ", "en", None, 0),
        (8, "one two three", "en", "c", 0), (9, "One  two\nthree", "en", "c", 0), (10, "one two", "en", "c", 0),
        (11, prose(2, 30_000), "en", "long", 0), (12, prose(3, 200), "en", "a", 0), (13, "x" * 70_000, "en", "d", 0),
        (14, "a\xa0b \x85c\x1c d　e f g", "en", "d", 0), (15, "same " * 300, "en", "d", 0),
        (16, prose(3, 200) + " tail", "en", "e", 0), (17, "line one here\nline one here\n\nother line", "en", "e", 0),
        (None, prose(4, 50), "en", "e", 0), (None, base, "en", "e", 0),
        (20, prose(5, 90), "en", "f", 0), (20, prose(5, 90), "en", "f", 0),
        (21, "Été \U0001f600 日本語 ### $$$ <b>", "fr", "f", 0),
    ]
    return rows


def docs_frame(spark, rows=None):
    return spark.createDataFrame(awkward_docs() if rows is None else rows, DDL)


def with_clashing_columns(df):
    """Extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(c) for c in ("node", "kept", "score", "held_out", "copies", "kept_id", "row", "size",
                                                 "label", "target", "block", "digest", "doc", "ids", "wrapper", "host")})
