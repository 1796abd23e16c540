import pytest

# Names that operators use inside, as columns of a caller's table.
CLASHING = (
    "digest possible chunk bitmap row cell fp word hub flip component_id least joint root node "
    "score threshold held_out label n ids token vector host place page payload refers_to"
).split()


@pytest.fixture
def documents(spark):
    """Documents with ids 0, 1, ... or as given, and columns that clash."""

    def build(texts, ids=None, lang="en"):
        rows = [
            (i, t, lang, "src", len(t or ""), *["x"] * len(CLASHING))
            for i, t in zip(range(len(texts)) if ids is None else ids, texts)
        ]
        extra = "".join(f", {c} string" for c in CLASHING)
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long{extra}")

    return build
