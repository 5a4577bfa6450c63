import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc(i, text, source="s"):
    return (i, text, "en", source, None if text is None else len(text))


def phrase(seed, n):
    """n made-up words, equal for equal seeds."""
    return " ".join(f"w{(seed * 7919 + k * 104729) % 1000003}" for k in range(n))


@pytest.fixture
def documents(spark):
    """Copies, near copies, empties, nulls, a long text, repeated rows."""
    base, near = phrase(1, 120), phrase(1, 118) + " x y"
    rows = [
        doc(1, base), doc(2, base), doc(3, near), doc(4, phrase(2, 60)), doc(5, "intro here " + phrase(2, 60) + " outro"),
        doc(6, ""), doc(7, None), doc(8, " \t\n "), doc(9, phrase(3, 30_000), "big"), doc(10, "one two"), doc(11, "one two"),
        doc(12, phrase(4, 40), None), doc(12, phrase(4, 40), None), doc(None, phrase(5, 50), None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def sf(request):
    return "/root/testdata/sf0.001"
