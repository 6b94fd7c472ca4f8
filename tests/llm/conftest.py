import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that operators use inside, as extra columns of the input.
CLASHING = [
    "id", "ids", "k", "h", "y", "n", "r", "text_id", "class_id", "n_links", "spans", "secret_spans", "removed_spans", "kept_spans",
    "stratum", "n_words", "n_symbols", "kept", "base_failed", "score", "predicted", "held_out", "mix_slot", "mix_offset", "decoded",
    "_id", "_source", "_text", "_base", "digests", "found", "removed", "block", "component", "rank", "label", "quality", "toxic", "doc", "bands", "weight",
]


@pytest.fixture(scope="session")
def prose():
    """A few different texts of 80 words."""
    import random

    rng = random.Random(5)
    stems = ["".join(rng.choice("aeiou") + rng.choice("bdglmnrst") for _ in range(3)) for _ in range(400)]
    return [" ".join(rng.choice(stems) for _ in range(79)).capitalize() + " end." for _ in range(12)]


@pytest.fixture(scope="session")
def messy_rows(prose):
    """Nulls in every column, empty and long texts, ties, and repeated rows."""
    return [
        (1, prose[0], "en", "a", 1), (2, None, "en", "a", None), (3, "", None, "b", 0), (4, prose[1], None, None, 2),
        (None, prose[2], "de", "b", 3), (5, " ".join(prose) * 30, "en", "a", 4), (6, prose[0], "en", "b", 1), (6, prose[0], "en", "b", 1),
        (7, "  \n\t ", "de", "a", 1), (8, "x" * 50_000, "en", "a", 1), (None, None, None, None, None), (9, prose[3], "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, DOCUMENT)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def messy_labels(spark):
    rows = [(1, 1, 0), (1, 1, 1), (3, 0, 0), (4, None, None), (None, 1, 0), (5, 1, None), (9, 0, 1), (77, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def empty_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def crowded(messy):
    """The messy documents with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    return messy.withColumns({c: F.lit(f"extra {c}") for c in CLASHING if c not in messy.columns})


def rows(df, *columns):
    """Rows as a sorted list of tuples of strings."""
    return sorted(repr(tuple(r)) for r in (df.select(*columns) if columns else df).collect())
