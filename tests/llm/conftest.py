import random

import pytest

SF = "/root/testdata/sf0.001"

#: Texts with nulls, blanks, ties, repeats, long words and long texts.
EDGE_TEXTS = [
    None, "", " \n\t ", "one", "a b c d", "a b c d e", "A B C D E", "a b c d e", "x" * 3000, "ab" * 900, "é" * 400,
    "line one is here now\nline one is here now\n\nline one is here now!", "word " * 4000, "\x0b\x0c\r",
    "mail me a.b@c.de or +1 (555) 010-9999, 10.0.0.1 and 4111 1111 1111 1111 now",
    "under the MIT license. Apache License, Version 2.0; CC-BY-NC",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls in any column, a repeated doc_id and columns whose names the operators use themselves."""
    rows = [(k, t, "en", "src0", len(t or ""), f"r{k}", k, "x") for k, t in enumerate(EDGE_TEXTS)]
    rows += [(3, "again the same number with other words", None, None, None, None, None, None), rows[5],
             (None, "no number at all but some words", None, "src1", 1, "r", 0, None), (None, None, None, None, None, None, 0, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, row string, "
                                       "doc long, key string")


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def near_docs(spark):
    """Groups of exact and near copies, one of them large, beside texts of their own."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, base = [], text(60)
    for k in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append(" ".join(words))
    for _ in range(40):
        words = text(rng.randint(3, 80))
        rows += [" ".join(words)] * rng.randint(1, 4)
        rows.append(" ".join(words[:-1] + ["z"]))
    rng.shuffle(rows)
    return spark.createDataFrame([(10 * k, t) for k, t in enumerate(rows)], "doc_id long, text string")
