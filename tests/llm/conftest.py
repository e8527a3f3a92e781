import pytest

SF = "/root/testdata/sf0.001"
PROSE = (
    "The quick brown fox jumps over the lazy dog while seven wizards quietly mix bright potions. "
    "Nobody in the village, not even the old miller, had ever seen such a strange evening before. "
)


def prose(n, seed=0):
    """``n`` words that look random but are the same in every run."""
    state, words = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        words.append("w" + format(state // 65536 % 5000, "x"))
    return " ".join(words)


LONG = prose(30_000, 99)
COPY = prose(120, 1)
NEAR = COPY.split(" ")
NEAR = " ".join([*NEAR[:60], "changed", *NEAR[61:]])
PASSAGE = prose(70, 5)

# id, text: nulls, blanks, ties, repeats, copies, near copies, a shared passage, a very long text.
ROWS = [
    (1, COPY),
    (2, "  " + COPY.replace(" ", "  ")),
    (3, NEAR),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, LONG),
    (8, LONG + " end"),
    (9, "one"),
    (10, "One"),
    (11, "é É Ω 日本 😀 <|endoftext|> x's"),
    (12, prose(50, 7) + " " + PASSAGE + " " + prose(40, 8)),
    (13, prose(30, 9) + " " + PASSAGE + " " + prose(60, 10)),
    (14, "you idiot, what a stupid loser " + prose(12, 11)),
    (15, "a b c d"),
    (16, "A b  c d"),
    (None, COPY),
    (None, None),
    (9, "one"),
    (9, "another text"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """The rows above with extra columns whose names operators might use themselves."""
    extra = [(i, t, "x", 1, 2, "y", 0.5) for i, t in ROWS]
    schema = "doc_id long, text string, id string, n long, range int, node string, score double"
    return spark.createDataFrame(extra, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
