import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that no operator may trip over.
EXTRA = "id long, key string, score string, node string, component string, whole string, left string, cut string, a string, b string"


def docs_frame(spark, rows):
    """documents from (doc_id, text[, lang[, source]]) rows, with columns of
    clashing names."""
    full = [(*r, *("en", "s1")[len(r) - 2:]) if len(r) < 4 else r for r in rows]
    full = [(*r, len(r[1] or ""), 1, "k", "x", "n", "c", "w", "l", "c", "a", "b") for r in full]
    return spark.createDataFrame(full, f"{DOCS}, {EXTRA}")


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30000))
    return [(1, ""), (2, None, None, None), (3, "  \n \t "), (4, "one"), (5, "same text of five words"),
            (5, "same text of five words"), (6, "same text of five words"), (None, "a text without any id here"),
            (None, None), (7, long), (8, long + " end"), (9, "\n\nline\n" * 3), (10, "été ÀÉ ß 中文 \U0001F600 naïve")]


@pytest.fixture()
def odd(spark):
    return docs_frame(spark, odd_rows())


@pytest.fixture()
def no_docs(spark):
    return docs_frame(spark, [(1, "x")]).limit(0)


def write_tables(path, **frames):
    """Write frames as the tables of a scale-factor folder."""
    for name, df in frames.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path
