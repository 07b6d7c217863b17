import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): literal rows (doc_id, text, lang, source) with the columns of the table and
    extra ones whose names the operators use inside."""

    def build(rows):
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, text_hash string, words int, "
            "dropped string, print string, _id string, places double, row int"
        )
        full = []
        for row in rows:
            doc_id, text, lang, source = (tuple(row) + (None,) * 4)[:4]
            full.append((doc_id, text, lang, source, len(text or ""), "x", 1, "y", "z", "i", 1.0, 7))
        return spark.createDataFrame(full, schema)

    return build


#: rows that every operator has to bear: nulls, empty and white texts, repeats, ties, a long text
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
ODD = [
    (None, None),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "same words here in all of these copies of one text, over and over"),
    (4, "same words here in all of these copies of one text, over and over"),
    (4, "another text under the same id, which is a document of its own then"),
    (5, "same words here in all of these copies of one text, over and over"),
    (None, "a text without an id, which is kept as it is"),
    (6, LONG),
    (7, "über straße 日本語 \U0001f600 naïve"),
]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)
