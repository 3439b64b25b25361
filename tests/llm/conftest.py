from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, slot int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]); the other columns carry names that operators use themselves."""

    def make(rows):
        full = []
        for r in rows:
            doc, text, lang, source = (*r, *("en", "src")[len(r) - 2 :])
            full.append((doc, text, lang, source, None if text is None else len(text), "k", "r", 7))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture()
def words():
    """Random texts of n words that share nothing by chance."""
    rnd = random.Random(5)
    return lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))
