"""Small documents with every odd case, shared by the tests of the text operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lines string, score string, n_words string, shingles string, items string, ids string, range string, guest string"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_texts():
    rng = random.Random(7)
    long = "\n".join(sentence(rng, 12) for _ in range(3000))
    base = sentence(rng, 200)
    near = base.replace(base.split()[100], "changed", 1)
    return [None, "", " ", "\n\n\n", "one", "two words", "!!! ???", "é ﬁ ▁ ∑", base, base, near, sentence(rng, 90), long, "x" * 5000, "a\nb\nc\nd", "a\nb\nc\nz", "A\tB\r\nC"]


def odd_rows(ids=True):
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    rows += [rows[8], (None, "no id"), (None, None)] if ids else []
    return [(i, t, None if i is None or i % 5 == 0 else "xx", "s", None if t is None else len(t), "l", "s", "w", "h", "i", "d", "r", "g") for i, t in rows]


def odd_docs(spark, ids=True):
    return spark.createDataFrame(odd_rows(ids), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
