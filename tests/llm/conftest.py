import random

import pytest

from tests_llm_helpers import frame

def corpus(seed=3, n=60):
    """Random documents with copies, near copies, shared lines, hot rows and odd cases."""
    rng = random.Random(seed)
    vocab = {"en": ["the", "of", "and", "Thing", "wood.", "river", "house", "blue", "walks", "often"],
             "fr": ["le", "de", "été", "forêt", "maison,", "rivière", "marche", "où", "Ça", "très"]}
    line = "This very long line is shared by many documents of the set"
    rows = []
    for i in range(n):
        lang = "fr" if i % 3 == 0 else "en"
        words = [rng.choice(vocab[lang]) + (str(rng.randrange(40)) if rng.random() < .5 else "") for _ in range(rng.randrange(5, 90))]
        text = " ".join(words)
        if i % 4 == 0:
            text += "\n  " + (line if i % 8 else line.upper()) + "\t\n" + text[:30]
        if i % 7 == 0 and rows:
            text = rows[-1][1] + ("" if i % 2 else " tail")
        rows.append((i, text, lang, f"src{min(i % 9, 4)}"))
    rows += [(100, "", "en", None), (101, None, None, "src1"), (102, "\n\n \t", None, None), (103, "123 !!", "en", "src2"),
             (104, " ".join(["word"] * 900), "en", "src0"), (105, "x" * 70000 + " y", "en", "src0"),
             (106, rows[0][1], "en", "src0"), (107, rows[0][1], "en", "src0"), (None, rows[0][1], "en", "src0"), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
