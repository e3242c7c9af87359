import pytest

PROSE = ("the quick brown fox jumps over a lazy dog while seven wizards box with five liquid jugs "
         "and many more words follow so that this text is long enough to be kept by every rule ")

CLASHING = ("h", "key", "block", "host", "label", "tokens", "score", "n", "rep", "held_out", "gone_id", "text_hash")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, very long, tied and repeated rows, and columns named like the operators' own."""
    rows = [(None, PROSE, "s1"), (1, None, "s1"), (2, "", None), (3, PROSE * 400, "s2"), (4, "again " + PROSE, "s2"),
            (4, "again " + PROSE, "s2"), (5, "again " + PROSE, "s1"), (6, "\x0b \t\n \n", "s1"), (7, "one", "s3"),
            (8, "Straße ñandú 世界 😀   \x1c naïve", "s3")]
    rows = [(i, t, "en", s, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
