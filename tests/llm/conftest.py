"""Small corpora: planted copies, lines, passages and odd rows."""

import pytest
from planted import VOCABULARY, edited, lines, prose

@pytest.fixture(scope="session")
def corpus() -> list[tuple[int, str | None, str | None]]:
    """(doc_id, text, lang): prose, exact and near copies, shared lines, tiny and empty texts, nulls."""
    rows = [(i, lines(i, 1 + i % 6), "en" if i % 3 else "fr") for i in range(60)]
    rows += [(100 + i, rows[i][1], "en") for i in range(5)]
    rows += [(200 + i, edited(rows[10 + i][1], i, 0.01), "en") for i in range(20)]
    big = prose(77, 120)
    rows += [(300 + i, edited(big, i, 0.008), "de") for i in range(90)]
    shared = prose(5, 30)
    rows += [(500 + i, lines(900 + i, 2) + "\n" + shared, None) for i in range(12)]
    rows += [(700 + n, " ".join(VOCABULARY[:n]), "en") for n in range(1, 14)]
    rows += [(720, "", "en"), (721, None, "en"), (722, " \n\t ", "en"), (723, "one two", "en"), (724, "one two", "fr"), (725, prose(3, 4000), "en"), (726, "spam " * 300, "en")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame([(i, t, g, "x", 0) for i, t, g in corpus], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, repeated rows, and columns named like results."""
    rows = [(None, prose(1, 40)), (None, None), (1, prose(1, 40)), (1, prose(1, 40)), (1, prose(2, 40)), (2, ""), (3, "x" * 5000), (4, "\n\n"), (5, "é ü\x1c日本 \x85")]
    names = "doc_id long, text string, lang string, n_tokens long, kept boolean, node long, line string, sim long, stratum string, row string, pos int, first long, label long, limits string"
    return spark.createDataFrame([(i, t, None, None, None, 1, "x", 2, "s", "r", 1, 2, 3, "l") for i, t in rows], names)
