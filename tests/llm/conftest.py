import pytest

# Every special case in one table: nulls in any column, empty and white texts, ties, repeated rows, a very long text,
# an id that two texts share, and columns whose names the operators use inside.
LONG = "lorem ipsum dolor sit amet " * 60_000
PROSE = "the quick brown fox jumps over the lazy dog and runs away from the hunters in the dark wood"
ROWS = [
    (1, PROSE),
    (2, PROSE),
    (2, PROSE),
    (3, PROSE + " at night"),
    (4, ""),
    (5, None),
    (None, PROSE),
    (None, None),
    (6, " \n\t "),
    (7, "one two"),
    (8, "ONE  two"),
    (9, LONG),
    (10, "mail A.B@x.org or call +1 (988) 555-2485 <|endoftext|>  now"),
    (10, "another text under the same id"),
]
CLASHES = ["key", "label", "score", "shard", "slot", "digest", "number", "row", "text_key", "dropped_id", "kept", "ids", "bands"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def odd_documents(spark):
    rows = [
        (i, text, None, "s", None if text is None else len(text), *[f"own {c}" for c in CLASHES]) for i, text in ROWS
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def scratch(spark):
    from quillrank.storage import Scratch

    with Scratch(spark) as scratch:
        yield scratch
