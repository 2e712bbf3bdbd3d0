import pytest

SF = "/root/testdata/sf0.001"
CLASHES = ["th", "n", "h", "rk", "block", "component", "quality", "lines", "spans", "gone", "score", "keep", "seq", "node", "key"]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def scratch(spark):
    from fleetcast.llm.common import Scratch

    def make(label="test"):
        return Scratch(spark, label)
    return make


LONG = "word " * 9000 + "end. " + "x" * 40_000
PASSAGE = ("One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen. "
           "Seventeen eighteen nineteen twenty again and more words here now. ")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    base = [(1, PASSAGE + "Own tail of the first document.", "en", "a", 90), (2, None, "en", "a", None), (3, "", None, None, 0),
            (4, LONG, "de", "b", 85005), (5, PASSAGE + "Another tail, of the fifth.", "en", "a", 90),
            (5, PASSAGE + "Another tail, of the fifth.", "en", "a", 90), (None, "a null id with text", "en", "a", 19),
            (6, "two words", "fr", None, 9), (7, "two words", "fr", "c", 9), (8, " \n\t ", "en", "a", 4),
            (9, "naïve café — “quoted” 12³   tab\there\r\nnew  line   ", "en", "z", 50), (10, LONG, "de", "b", 85005)]
    rows = [(*r, *[f"x{i}" for i in range(len(CLASHES))]) for r in base]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
