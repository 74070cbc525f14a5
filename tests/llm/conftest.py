from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A maker of document tables: (doc_id, text) rows, with columns whose names clash with outputs."""

    def make(rows, extra: bool = False):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F

            for name in ("ids", "score", "predicted", "labels", "n_lines", "overlaps", "component_id", "lang_pred", "version", "features"):
                df = df.withColumn(name, F.lit("kept"))
        return df

    return make


ODD = [(1, None), (2, ""), (3, "  \n\n "), (4, "x" * 5000), (5, "one two three"), (5, "one two three"), (6, "é ü ß 😀   end\n" * 300), (None, "a text without an id here"), (7, "<|endoftext|> is text, too")]
