"""Small awkward inputs shared by the operator tests."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, score double, shard string, fp string, block int, __n long"


def docs(spark, texts, source=lambda i: f"s{i % 3}"):
    """Rows ``(doc_id, text)`` with further columns, some named like the operators' own."""
    rows = [(i, t, "en", source(k), len(t or ""), "x", 0.5, "y", "z", k, k) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


LONG = "lorem ipsum dolor sit amet consectetur " * 20_000

AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "two words"), (None, "no id here at all"),
    (None, None), (7, LONG), (8, LONG + "x"), (9, "a\x00b  c d é ÀÉ \U0001f600 zwölf"), (10, "A B C D E F G H I J K L"),
    (11, "a b c d e f g h i j k l"), (12, "!!! ??? ..."), (13, "\r\n\r\n"),
]
