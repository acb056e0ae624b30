import pytest

#: Names that the operators use inside, or used to.
CLASHING = "_key _nth _copy _t copies nth s last kept hit cover spans found start end key value parts part ids sizes n comp x y hash place source_size taken score predicted prefix hashes shard dim floor block c0 links epoch length".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of every awkward kind, with columns whose names clash with those the operators use inside."""
    words = " ".join(f"word{i % 97} and{i % 31}" for i in range(30_000))
    same = "the quick brown fox jumps over the lazy dog again and again until it sleeps"
    rows = [
        (1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (3, same.upper(), "en", "b"), (4, same + " well", "en", None),
        (5, None, None, "a"), (6, "", "en", None), (7, " \n\t ", "de", "b"), (8, words, "en", "a"), (None, "no id here at all, none", "en", "a"),
        (9, "x", "fr", "c"), (10, "é\x00ß 漢字 😀 <|endoftext|> <s>", "fr", "c"), (11, "x", "fr", "c"),
    ]
    df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], SCHEMA)
    return df.selectExpr("*", "'clash' as size", "1 as row", "2 as rank", "'h' as _h", "'k' as kind", "3 as class", "4 as slot", "5 as target", *[f"'{c}' as `{c}`" for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
