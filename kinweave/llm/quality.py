"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's counts are hashed byte trigrams, trigrams of character classes and binned shares (capitals,
marks, repeated words, distinct words; length). The labelled sample's tf-idf matrix is factored, and its rows, projected to COMPONENTS
dimensions, are broadcast. Every document's cosine to every labelled row is computed exactly, in blocks, and
its NEIGHBOURS nearest vote with their similarity to the power of SHARPNESS.

The labelled sample is bounded: about PER_CLASS rows of each label, chosen by a hash of the id among rows that are not
held out; so the broadcast has at most about 2 x PER_CLASS rows. Every document is scored.

Defined results: null texts are empty; an empty text has only its length, so that the shortest labelled texts vote on it; a text without a similar one gets the
sample's share of label 1, and where nothing is labelled, every text 0.5; rows with several
labels count with the larger one; null labels are ignored; repeated rows give repeated rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import held_out, released, text_batches, text_slices

PER_CLASS, NEIGHBOURS, COMPONENTS, SHARPNESS = 1500, 15, 48, 8
SHAPES, GRAMS, BINS = 512, 1536, 8
SHARES = 5
WIDTH = SHAPES + GRAMS + SHARES * BINS
ROWS = 256

# character classes of bytes: letters by case, digits, white space, other bytes by themselves
_class = np.arange(256, dtype=np.int64) + 8
for _bytes, _value in ((range(97, 123), 1), (range(128, 256), 1), (range(65, 91), 2), (range(48, 58), 3), ((9, 10, 11, 12, 13, 32), 4)):
    _class[list(_bytes)] = _value
_lower = np.arange(256, dtype=np.int64)
_lower[65:91] += 32


def counts(texts: list[str | None]) -> np.ndarray:
    """A row of WIDTH counts for each text."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for a in range(0, len(texts), ROWS):
        raw = [(t or "").encode("utf-8", "replace") for t in texts[a : a + ROWS]]
        size = np.array([len(r) for r in raw])
        b = np.frombuffer(b"".join(raw), np.uint8)
        doc = np.repeat(np.arange(len(raw)), size)
        block = out[a : a + len(raw)]
        if len(b) > 2:
            inside = doc[2:] == doc[:-2]
            d = doc[2:][inside]
            for table, base, width in ((_class, 0, SHAPES), (_lower, SHAPES, GRAMS)):
                c = table[b]
                code = ((c[:-2] * 263 + c[1:-1]) * 269 + c[2:])[inside]
                code = ((code * 0x9E3779B1) >> 7) % width
                block[:, base : base + width] = np.bincount(d * width + code, minlength=len(raw) * width).reshape(len(raw), width)
        k = _class[b]
        upper, marks = (np.bincount(doc, x, len(raw)) / np.maximum(size, 1) for x in (k == 2, k >= 8))
        for i, r in enumerate(raw):
            length = SHAPES + GRAMS + 4 * BINS
            block[i, length : length + 1 + min(BINS - 1, len(r).bit_length() // 2)] = 20  # a short text's are among a longer one's
            if words := r.split():
                again = sum(map(bytes.__eq__, words, words[1:])) / len(words)
                for j, share in enumerate((upper[i], marks[i], again, 1 - len(set(words)) / len(words))):
                    block[i, SHAPES + GRAMS + j * BINS + min(BINS - 1, int(share * 2 * BINS))] = 20
    return out


@dataclass(frozen=True)
class Space:
    """The projection and the labelled vectors."""

    idf: np.ndarray
    basis: np.ndarray  # WIDTH x COMPONENTS
    vectors: np.ndarray  # labelled rows x COMPONENTS, of length one
    labels: np.ndarray

    def project(self, c: np.ndarray) -> np.ndarray:
        x = np.log1p(c) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        v = x @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), 0.5)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(texts), ROWS):
            part = texts[a : a + ROWS]
            cosine = self.project(counts(part)) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[a : a + len(part)] = np.where(total > 0, vote, self.labels.mean())
        return np.clip(out, 0, 1)


def fit(c: np.ndarray, labels: np.ndarray) -> Space:
    """Factors the labelled rows' tf-idf matrix; the basis are its leading right singular vectors."""
    if not len(labels):
        return Space(np.ones(WIDTH, np.float32), np.zeros((WIDTH, COMPONENTS), np.float32), np.zeros((0, COMPONENTS), np.float32), labels)
    idf = (np.log((1 + len(c)) / (1 + (c > 0).sum(axis=0))) + 1).astype(np.float32)
    x = np.log1p(c) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    _, v = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = np.ascontiguousarray(v[:, ::-1][:, :COMPONENTS]).astype(np.float32)
    empty = Space(idf, basis, np.zeros((0, COMPONENTS), np.float32), labels)
    return Space(idf, basis, empty.project(c), labels)


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Space:
    """Fits the space on the bounded sample; the sample's counts, not its texts, go to the driver."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id_")).agg(F.max(F.col(label_col).cast("int")).alias("label_"))
    sizes = known.groupBy("label_").count().collect()  # one row for each label
    if not sizes:
        return fit(np.zeros((0, WIDTH), np.float32), np.zeros(0))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r[0], per_class / r[1])])
    draw = F.pmod(F.xxhash64(F.lit("labelled"), F.col("id_")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(F.element_at(share, F.col("label_")) > draw)
    rows = documents.select(F.col(id_col).alias("id_"), F.col(text_col).cast("string").alias("text_")).join(F.broadcast(picked), "id_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(0)):
                c = counts(texts)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([r.tobytes() for r in c], pa.binary())], names=["id", "label", "counts"])

    kind = rows.schema["id_"].dataType.simpleString()
    got = sorted(text_batches(rows.select("text_", "id_", "label_")).mapInArrow(run, f"id {kind}, label int, counts binary").collect(), key=lambda r: (r[0], r[2]))
    c = np.stack([np.frombuffer(bytes(r[2]), np.float32) for r in got]) if got else np.zeros((0, WIDTH), np.float32)
    return fit(c, np.array([min(1, max(0, r[1])) for r in got], np.float64))


def score(documents: DataFrame, space: Space, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score for every row of documents; partitions stay as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(shared.value.score(texts), pa.float64())], names=[id_col, "score"])

    kind = documents.schema[id_col].dataType.simpleString()
    rows = text_batches(documents.select(id_col, F.col(text_col).cast("string").alias("text_")))
    return rows.mapInArrow(lambda batches: released(run(batches)), f"`{id_col}` {kind}, score double")
