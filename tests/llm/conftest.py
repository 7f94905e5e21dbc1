"""Rows with every odd case that the operators promise to handle."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, spans int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, wordless, very long, repeated and plain rows, and columns with clashing names."""
    word = [f"w{i}x" for i in range(30_000)]
    texts = {
        1: None,
        2: "",
        3: " \n\t ",
        4: " ".join(word),
        5: "x" * 200_000,
        6: "the same text of more than five words",
        7: "the same text of more than five words",
        8: "one",
        9: "ONE",
        10: "write to a.b@c.de or +1 (212) 555-0100 from 10.0.0.1 with 4111 1111 1111 1111 \U0001f642",
        11: "漢字 und ein paar Wörter über Straßen\x00 und Flüsse",
        12: "1 " * 30_000,
        13: "a." * 30_000 + "b",
    }
    rows = [(i, t, None if i == 8 else "en", None, None, "clash", 7) for i, t in texts.items()]
    rows += [rows[5], (None, "no id here at all", "en", "s", 1, None, None)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
