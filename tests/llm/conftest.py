import random

import pytest

WORDS = [a + b for a in "ba ce di fo gu ha je ki lo mu".split() for b in "n r s t lm nd rt st x z".split()]

#: Name, text: the cases that every operator must take.
ODD_TEXTS = {
    "null": None,
    "empty": "",
    "blank": " \t\n\x0b\x0c\r ",
    "one": "word",
    "marks": "..., !!! ###",
    "wide": "日本語 テスト 😀 é ﬁ Σς",
    "long": " ".join(WORDS) * 60,
    "run": "x" * 50_000,
    "digits": "1 " * 8_000,
}


def odd_documents(spark):
    """Odd texts with ties and repeated rows, beside columns whose names clash with the operators' own."""
    texts = list(ODD_TEXTS.values())
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, "word"), (50, "word"), (51, None), (52, "a b c d e f g h"), (53, "a b c d e f g h")]
    clash = ["keep_id", "kept", "n", "rep", "root", "band", "block", "_row", "_t", "length", "start", "recipe", "slot", "label"]
    table = spark.createDataFrame([(i, t, *["x"] * len(clash)) for i, t in rows], f"doc_id long, text string, {', '.join(c + ' string' for c in clash)}")
    return table, rows


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def some_words(seed, count):
    draw = random.Random(seed)
    return [draw.choice(WORDS) for _ in range(count)]


@pytest.fixture(scope="session")
def odd(spark):
    return odd_documents(spark)
