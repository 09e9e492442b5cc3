import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, fp long, _row int"


def make_docs(spark, rows):
    """Documents with the usual columns and some whose names the operators use inside."""
    full = [(i, t, lang, "s", None if t is None else len(t), "k", 7, 1) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    """Small texts of a small vocabulary, so that passages repeat; copies, nulls, blanks and one long text among them."""
    rng = random.Random(3)
    vocabulary = ["the", "Red", "bolt", "été", "de", "x9", "Über", "ring", "a", "B", "steel's", "№5", "end."]
    passages = [[rng.choice(vocabulary) for _ in range(14)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 9))]
        rows.append((i * 3 + 1, rng.choice([" ", "\n", "  ", "\t "]).join(words), rng.choice(["en", "fr", None])))
    rows += [(500, None, "en"), (501, "", "en"), (502, " \n\t", None), (None, rows[5][1], "en"), (503, rows[5][1], "fr"), (2, rows[7][1], "en"), (503, rows[5][1], "fr"), (504, " ".join(passages[0] * 300), "de")]
    return rows
