"""BPE encoding and decoding by tree concatenation.

A text longer than ``leaf`` characters is halved again and again into leaves
that are encoded as rows of their own, in parallel.  Leaves of one text are then
joined pairwise up the tree.  At each join a window of tokens on both sides is
encoded anew, and grows until its outer tokens are those that both sides have
already: then every neighbouring pair of tokens is one that the encoding itself
makes, so the joined ids are those of the whole text.  A window that reaches
both ends is the whole text, so the result is exact in any case.

Defined results: a null text counts as empty (no ids, empty text); null or
repeated doc_ids are kept row by row; a very long text is encoded in leaves and
only its ids and text are put together in one task; an empty table gives no rows.  Columns
other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune
from .pieces import Decoder, Encoder, decoder, encoder

LEAF = 1 << 16
#: Tokens that a window takes from each side at first, and that must agree at each of its ends.
WINDOW, AGREE = 16, 4


def _window(left: np.ndarray, right: np.ndarray, enc: Encoder, dec: Decoder) -> tuple[int, np.ndarray, int]:
    """Tokens to keep of the left, the ids between, tokens to skip of the right."""
    w = WINDOW
    while True:
        a, b = max(0, len(left) - w), min(len(right), w)
        raw = dec.raw(left[a:].tobytes() + right[:b].tobytes())
        w *= 2
        try:
            text = raw.decode()
        except UnicodeDecodeError:  # an end lies inside a character
            if a == 0 and b == len(right):
                raise
            continue
        new = np.frombuffer(enc.library(text), "<u4")
        fits = lambda n, x, y: len(x) >= n and len(y) >= n and np.array_equal(x, y)
        before = a == 0 or fits(AGREE, new[:AGREE], left[a : a + AGREE])
        after = b == len(right) or fits(AGREE, new[len(new) - AGREE :], right[b - AGREE : b])
        if before and after:
            return a, new, b


def join(parts: list[np.ndarray], enc: Encoder, dec: Decoder) -> np.ndarray:
    """The ids of the whole text from those of its leaves, pair by pair up the tree."""
    while len(parts) > 1:
        up = []
        for i in range(0, len(parts) - 1, 2):
            left, right = parts[i], parts[i + 1]
            a, mid, b = _window(left, right, enc, dec)
            up.append(np.concatenate([left[:a], mid, right[b:]]))
        parts = up + parts[len(parts) & ~1 :]
    return parts[0]


def halves(length: int, leaf: int) -> int:
    """Into how many leaves a text is cut: halved until none is longer than ``leaf``."""
    n = 1
    while -(-length // n) > leaf:
        n *= 2
    return n


def encode(docs: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, text, ids (little-endian unsigned 32-bit integers) of every row."""
    tune(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def short(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            ids = [enc.ids(x.as_py()) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], [*b.schema.names, "ids"])

    def joined(t):
        enc, dec = encoder(tokenizer), decoder(tokenizer)
        t = t.sort_by("part")
        ids = join([np.frombuffer(x.as_py(), "<u4") for x in t["ids"]], enc, dec).tobytes()
        text = "".join(t["text"].to_pylist())
        return pa.table({"doc_id": t["doc_id"][:1], "text": pa.array([text]), "ids": pa.array([ids], pa.binary())})

    small = rows.where(F.length("text") <= leaf).mapInArrow(short, "doc_id long, text string, ids binary")
    n = F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.length("text") / leaf)))).cast("int")
    size = F.ceil(F.length("text") / n).cast("int")
    leaves = (
        rows.where(F.length("text") > leaf)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("size", size)
        .withColumn("part", F.explode(F.sequence(F.lit(0), n - 1)))
        .select("doc_id", F.expr("substring(text, part * size + 1, size)").alias("text"), "row", "part")
        .repartition("row", "part")
        .mapInArrow(short, "doc_id long, text string, row long, part int, ids binary")
    )
    large = leaves.groupBy("row").applyInArrow(joined, "doc_id long, text string, ids binary")
    return small.unionByName(large)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids, decoded: the texts of ``encoded`` (doc_id, ids)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = decoder(tokenizer)
        for b in batches:
            texts = [dec.text(x.as_py()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(encoded: DataFrame, tokenizer: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and with ``ids`` the ids) of ``encoded`` (doc_id, ids)."""
    return decode(encoded, tokenizer).select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
        *["ids"] * ids,
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
