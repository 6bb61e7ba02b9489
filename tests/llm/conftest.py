import pytest

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ivy juniper kauri larch maple nutmeg oak pine quince rowan spruce teak".split()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with the names that
    operators use inside."""
    sentence = " ".join(WORDS)
    rows = [
        (1, sentence, "en", "b"),
        (2, sentence + " " + sentence, "en", "b"),
        (2, sentence + " " + sentence, "en", "b"),
        (2, "another text under the same id", None, None),
        (3, None, "en", "a"),
        (4, "", "fr", None),
        (5, " \n\t ", None, "a"),
        (None, sentence, "en", "b"),
        (None, None, None, None),
        (-7, "start " + sentence + " end", "fr", "c"),
        (9, "\u00e9t\u00e9 <|im_end|> &lt; \U0001f600 " * 400, "fr", "c"),
        (10, "x" * 9000 + " " + sentence, "en", "a"),
        (11, "12 34 ?!", "en", "a"),
    ]
    names = ["n", "fp", "cell", "gram", "draw", "bucket", "copies", "score"]
    return spark.createDataFrame(
        [(*r, *[i] * len(names)) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in names)
    ).repartition(3)
