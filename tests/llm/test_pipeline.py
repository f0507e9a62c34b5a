"""The pipeline against plain Python, DuckDB and the tokenizers library on a small corpus; no operator is called here."""

import random
import re
from hashlib import sha256

import numpy as np

import corpus_pipeline
from aircascade.llm import mixing, quality

from .helpers import documents, needs_tokenizers, odd_texts, words
from .test_minhash import brute as near
from .test_native import in_duckdb

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(8)
    return odd_texts() + [words(rng, 80) + f" mail u{i}@mail.example.com" for i in range(10)]


@needs_tokenizers
def test_run(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = corpus()
    docs = documents(spark, texts)  # with further columns, kept, copy, part and size among them
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)

    kept = [r[0] for r in in_duckdb(docs, f"SELECT doc_id FROM ({quality.sql()}) WHERE kept")]
    kept.sort()
    first = [kept[r[0]] for r in near([texts[i] for i in kept]) if r[3]]
    # An address is one word before and after, so the mix can be found from the texts as they came.
    of = {r.doc_id: r.source for r in docs.collect()}
    left = spark.createDataFrame([(i, texts[i], of[i]) for i in first], "doc_id long, text string, source string")
    times = {i: taken // size for i, size, taken in in_duckdb(left, f"SELECT doc_id, size, taken FROM ({mixing.SQL})")}
    assert [r.doc_id for r in got] == sorted(i for i, n in times.items() for _ in range(n))

    lib, replaced = Tokenizer.from_file(corpus_pipeline.TOKENIZER), {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        text = lib.decode(ids, skip_special_tokens=False)
        assert lib.encode(text, add_special_tokens=False).ids == ids and r.n_tokens == len(ids)
        assert (r.ids_sha256, r.decoded_sha256) == (sha256(r.ids).hexdigest(), sha256(text.encode()).hexdigest())
        before, mail, _ = texts[r.doc_id].partition(" mail u")
        if not mail:
            assert text == texts[r.doc_id]
        else:
            address = re.fullmatch(re.escape(before) + r" mail (\S+@\S+)", text)[1]
            assert replaced.setdefault(r.doc_id, address) == address and address not in texts[r.doc_id]
    assert len(set(replaced.values())) == len(replaced) > 1 and len({r.doc_id for r in got}) > 15


def test_stages_leave_clashing_columns_as_they_are(spark):
    """Columns named like those that the operators add come through with their own values."""
    texts = corpus()
    names = ["kept", "n_words", "base_failed", "component_id", "row_key", "n_email", "mentions", "place", "target", "source_size", "copies", "below", "_s", "_host", "_gone", "_copy", "row"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), *[f"{c}{i}" for c in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [*COLUMNS, *names]
    out = docs.collect()
    assert len({r.doc_id for r in out}) > 15
    for r in out:
        assert [r[c] for c in names] == [f"{c}{r.doc_id}" for c in names] and r.n_chars == len(r.text)


def test_empty(spark, tmp_path):
    documents(spark, []).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
