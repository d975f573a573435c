import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")

    return make


ODD = [
    (1, None, "a"), (2, "", "a"), (3, "only four words here", None), (4, "\n\n  \t", "b"), (5, "x" * 3000, "b"),
    (6, "The same long line of words is here again\n" * 3, "a"), (7, "the same long line of words is here again  ", "a"),
    (8, "word " * 4000, "c"), (9, "a b c d e f g h i j k l", "c"), (9, "a b c d e f g h i j k l", "c"), (9, "another text under the id nine", "c"),
    (None, "a text without any id at all in the table", None), (None, None, None), (10, "Ünïcödé ß 漢字 🙂 text with marks and more words", "d"),
]


@pytest.fixture(scope="session")
def odd_dir(spark, docs, tmp_path_factory):
    """Tables with nulls, empty and long texts, ties and repeated rows, and an extra column that clashes with outputs."""
    from pyspark.sql import functions as F

    root = tmp_path_factory.mktemp("odd")
    docs(ODD).withColumns({"score": F.lit(1), "kept": F.lit("x")}).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (5, 1, None), (9, 0, 1), (9, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, None, None), (2, "u\nv", "h" * 1500), (3, "w", "h" * 1500), (3, "w", "h" * 1500), (None, "n", "h" * 1500), (4, "x", "")], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, 0, None, None), (3, 5, "user", "tie"), (3, 5, "system", "tie"), (None, 0, "user", "lost")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
    return str(root)


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "pages", "conversations"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{root}/{name}.parquet")
    return str(root)
