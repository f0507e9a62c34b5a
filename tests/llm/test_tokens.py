import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from aircascade.llm import bpe, pieces, token_codes

from .helpers import TOKENIZERS, documents, needs_tokenizers, odd_texts

pytestmark = needs_tokenizers
WORD, BYTE = f"{TOKENIZERS}/word_bpe_49k.json", f"{TOKENIZERS}/byte_bpe_50k.json"


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def strange(n, seed=1):
    rng = random.Random(seed)
    chars = "aab  \n\t.,é'sstTR1 2ñ…　 <|>_-"
    out = []
    for k in range(n):
        x = "".join(rng.choice(chars) for _ in range(rng.randint(0, 200)))
        out.append(x + "<|endoftext|>" + x[:9] if k % 7 == 0 else x)
    return out


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_equal_the_library(path):
    enc, lib = pieces.encoder(path), library(path)
    for text in [*strange(600), *(t for t in odd_texts() if t)]:
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


def test_joins_equal_the_library():
    enc, dec, lib = pieces.encoder(BYTE), pieces.decoder(BYTE), library(BYTE)
    rng = random.Random(2)
    for text in [*strange(400, 3), "ab" * 3000 + "a" * 4000, " " * 900 + "x" + "\n" * 500]:
        size = rng.randint(5, 60) if len(text) < 500 else 700
        parts = [np.frombuffer(enc.ids(text[i : i + size]), "<u4") for i in range(0, len(text), size)]
        if parts:
            assert bpe.join(parts, enc, dec).tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("leaf", [1 << 16, 200])
def test_encode_and_decode(spark, leaf):
    texts, lib = odd_texts() + strange(40), library(BYTE)
    got = bpe.digests(bpe.encode(documents(spark, texts), BYTE, leaf), BYTE)
    want = []
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_null_and_repeated_ids_and_empty(spark):
    got = bpe.digests(bpe.encode(documents(spark, ["a", "a", None], [None, 3, 3]), BYTE), BYTE)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 1), (3, 0), (3, 1)]
    assert bpe.encode(documents(spark, []), BYTE).count() == 0


def test_codes_give_any_token():
    ids = np.array([1, 300, 70000, 2**32 - 1, 5] * 700 + [2], "<u4")
    levels, bitmaps, ranks = token_codes.pack(ids)
    assert (token_codes.unpack(levels, bitmaps, len(ids)) == ids).all()
    assert [token_codes.token_at(levels, bitmaps, ranks, i) for i in range(len(ids))] == ids.tolist()


def test_files(spark, tmp_path):
    texts, lib = odd_texts(), library(WORD)
    path = str(tmp_path / "tokens")
    token_codes.write_tokens(documents(spark, texts), path, WORD, 2, segment=500)
    want, flat = [], []
    for i, t in enumerate(texts):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, len(flat), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        flat += ids
    from pyspark.sql import functions as F

    got = token_codes.read_documents(spark, path, crc=F.crc32)
    assert sorted(tuple(r) for r in got.collect()) == want
    asked = [0, 1, 499, 500, 501, len(flat) - 1, len(flat), 777, 777]
    found = token_codes.read_tokens(spark, path, spark.createDataFrame([(a,) for a in [*asked, None]], "position long"))
    assert sorted((r.position, r.token) for r in found.collect() if r.position is not None) == sorted((a, flat[a] if a < len(flat) else None) for a in asked)


def test_file_order_and_empty(spark, tmp_path):
    docs = documents(spark, ["b", "a", "c", "d"], [5, 5, None, -1])
    got = sorted((r.start, r.doc_id) for r in token_codes.encoded_documents(docs, WORD).collect())
    assert got == [(0, None), (2, -1), (4, 5), (6, 5)]
    assert token_codes.encoded_documents(documents(spark, []), WORD).count() == 0
