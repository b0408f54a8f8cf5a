import os
import random

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, key long, `a.b` string, h string, gone string"


@pytest.fixture(autouse=True)
def few_blocks(monkeypatch):
    from tidelog.llm import common

    monkeypatch.setattr(common, "MIN_BLOCKS", 3)


def rows(seed: int = 0) -> list[tuple]:
    """Small texts with every odd case: nulls, empty and very long texts, ties, repeated rows, near and exact copies."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(vocabulary).capitalize() + ("." if r.random() < 0.15 else "") for _ in range(n))
    common_line, passage = "Read our terms of use and all cookies.", say(60)
    texts = [None, "", " \n\t", "one", "A a a\x00b", "日本語 \U0001f9ff word", "x" * 60, "ab " * 400]
    base = [say(r.randint(20, 150)) for _ in range(25)]
    texts += base + base[:6] + [base[0]] * 5
    for t in base[:8]:
        w = t.split()
        for _ in range(2):
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += [say(10) + "\n" + common_line + "\n" + say(12) for _ in range(14)]
    texts += [say(15) + ". " + passage + ". " + say(15) for _ in range(4)]
    texts += [" ".join([say(2000)] * 3), say(30000)]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    out = [(i, t, r.choice(["en", "de", None]), f"s{k % 12}" if k % 9 else None, None, 1, 2, "c", "d", "e") for k, (i, t) in enumerate(zip(ids, texts))]
    return out + [out[9], out[9]]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nulls(spark):
    """Rows without ids, and an empty table of the same columns."""
    some = [(None, "a b c d e f", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (1, "a b c d e f", "en", "s", 3, 1, 1, "", "", "")]
    return spark.createDataFrame(some, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
