import random

import pytest
from pyspark.sql import Row

WORDS = "the of and shore tide reed marsh heron creek silt bank dune gull kelp wrack ebb flood salt pool sand".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", "en", "er"]) + str(rng.randrange(40)) for _ in range(n))


def change(rng, text, share):
    return " ".join(w if rng.random() > share else "x" + str(rng.randrange(10**6)) for w in text.split(" "))


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Documents with nulls, empty and very long texts, copies, near copies, repeated rows, a hot source, and
    columns named like internal ones."""
    rng = random.Random(5)
    base = [prose(rng, 160) for _ in range(12)]
    shared = prose(rng, 70)
    texts = [None, "", " \n\t ", "one", "One", "a b c d", "a b c d", "don't 'tis 123  x\n\n", "<|endoftext|> é日本 😀́", "w " * 30]
    for i, t in enumerate(base):
        texts += [t, t.upper(), change(rng, t, 0.02), change(rng, t, 0.04), change(rng, t, 0.5)]
        texts.append(prose(rng, 60) + " " + shared + " " + prose(rng, 40))
        texts.append("\n".join(["Subscribe to our news letter", prose(rng, 9), "  SUBSCRIBE to our news letter\t", "short", prose(rng, 3), ""]))
    texts += [base[0]] * 40 + [prose(rng, 60_000), "x" * 100_000, "Released under the MIT License.\n" + prose(rng, 30)]
    rows = [Row(doc_id=i, text=t, lang="en", source=None if i % 17 == 3 else f"src{0 if i % 3 else i % 5}", n_chars=len(t or ""),
                key=f"k{i}", size=i, hub=-i, label="z", component=7, name="n", weight=3, slot=1, good=None, a=1, b=2, k=9, doc=4)
            for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], Row(**{**rows[15].asDict(), "doc_id": None}), Row(**{**rows[0].asDict(), "doc_id": None})]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, key string, size long, hub long, label string, "
              "component long, name string, weight long, slot long, good boolean, a long, b long, k long, doc long")
    return spark.createDataFrame(rows, schema).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.limit(0)


@pytest.fixture(scope="session")
def plain(hard_docs):
    """(doc_id, text) of all rows."""
    return [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
