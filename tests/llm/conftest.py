import os
import random

import pytest

# Workers import the package from the repository.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

WORDS = "the a of stone river walks under over green light and then where nobody counts house garden idiot moon".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n)).capitalize() + "."


def corpus(seed=3, n=60):
    """(doc_id, text): unlike texts, exact copies, near copies, shared passages, repeated lines, and odd texts."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    texts = ["\n".join(sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    texts += [texts[i] for i in (0, 1, 1, 5)]
    for i in (2, 3, 4, 4, 6):
        words = texts[i].split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [sentence(rng, 12) + "\n" + passage + "\n" + sentence(rng, 9) for _ in range(4)]
    texts += ["\n".join([sentence(rng, 4)] * 6), "x" * 400, "ab " * 300, "Ünïcode žluťoučký kůň. " * 9]
    texts += [None, "", " \n\t", "one", "one", "One two three", "ONE two three", "\n\n\n", "a\nb\nc\nd\na\nb\nc\nd", "字 " * 120]
    texts.append("\n".join(sentence(rng, 25) for _ in range(600)))
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def pairs():
    return corpus()


@pytest.fixture(scope="session")
def documents(spark, pairs):
    """The corpus as documents, with a repeated row, a row without a key, and columns whose names operators use inside."""
    rows = [(i, t, "en", "src0", len(t or ""), "x", 7) for i, t in pairs]
    rows += [rows[0], (None, pairs[0][1], None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, n long"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
