"""Fixtures of these tests. Not a conftest.py: the folder above has the one of that name."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators use for results or inside.
CLASHES = ("fingerprint", "component_id", "row", "number", "size", "ids", "shard", "group", "copies",
           "kept", "_text", "_own", "lang_pred", "rate")


@pytest.fixture(scope="session")
def make_docs(spark):
    """make_docs([(doc_id, text), ...]) or with lang and source as well."""
    def make(rows, clashes=False):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if clashes:
            from pyspark.sql import functions as F
            for name in CLASHES:
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def odd_texts():
    return [None, "", " ", "\n\n", "a", "one two", "A b  c\td\r\ne", "é ü 中文 🙂 ñ", "x" * 30_000,
            "word " * 20_000, "tie tie tie tie", "tie tie tie tie", "'re 's''ll!!",
            "\u00a0\u3000 \u2003"]
