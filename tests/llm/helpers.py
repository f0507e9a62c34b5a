"""Small documents with the odd cases that every operator must take."""

import os
import random

import pytest

TOKENIZERS = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")
needs_tokenizers = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizer files")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, copy string, part string, size string"


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


def odd_texts(seed=5):
    rng = random.Random(seed)
    base, passage = words(rng, 300), words(rng, 60)
    out = [base, base, None, "", " \n\t ", "one", "one two three four", "a" * 3000, "ab " * 700, words(rng, 20000), "Ünï çødé 漢字 " * 40]
    for _ in range(12):
        w = base.split(" ")
        for _ in range(rng.randrange(1, 12)):
            w[rng.randrange(len(w))] = words(rng, 1)
        out.append(" ".join(w))
    # A chain: each document is near its neighbours only.
    long_ = words(rng, 600).split(" ")
    out += [" ".join(long_[i : i + 200]) for i in range(0, 400, 12)]
    out += [words(rng, 100) + "\n" + passage + " " + words(rng, rng.randrange(5, 200)) for _ in range(10)]
    out += ["line one here\nline one here\nother\n" + words(rng, 80), "x y z x y z x y z " * 30]
    return out


def documents(spark, texts=None, ids=None):
    texts = odd_texts() if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None if k % 9 == 0 else f"s{k % 4}", 0, "k", "c", "p", "z") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
