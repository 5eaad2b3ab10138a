"""Language identification of words by a linear-chain conditional random field.

Words are runs of letters, lower-cased; a line of a text is one sequence. A word's features are
its spelling (the lexicon), its affixes and its character trigrams, hashed; the field has a weight for each
feature and language and a learned matrix of transitions. Forward-backward gives each word's
language probabilities, so that code-switched text is labelled word by word; a document's prediction
is the language with the largest sum over its words, and its score is that sum's share.

Training: about TRAIN_DOCS documents of each language, chosen by a hash of the id among those that are
not held out and have a language, and a run of TRAIN_WORDS words of each; half of the training
sequences join the runs of two documents, so that transitions between languages occur. Every value that a language column
holds is learned, and every letter of a word counts.

Defined results: ``und`` with score 0 for null texts and texts without a letter, and for all texts where
no language can be learned; ties go to the first language in order; repeated rows give repeated rows;
extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import CHUNK_CHARS, held_out, released, text_batches, text_slices

TRAIN_DOCS, TRAIN_WORDS = 500, 60
BUCKETS = 1 << 16
EPOCHS, BATCH, RATE, DECAY = 4, 64, 0.2, 1e-6
KEEP_WORDS = 120_000
#: Weights that are gathered at once, and languages from which on fewer words and texts are held at a time.
GATHER, MANY = 1 << 22, 16
UNKNOWN = "und"
_words = re.compile(r"[^\W\d_]+").findall


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, word after word, and how many each has: the lexicon entry, three prefixes, three suffixes, the character trigrams."""
    padded = [f"<{w}>" for w in words]
    c = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(p) for p in padded], np.int64)
    start = np.cumsum(size) - size
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.full(size.max(), base))
    at = np.arange(len(c)) - np.repeat(start, size)
    whole = np.add.reduceat(c * power[at], start)
    fixed = [whole]
    n = size - 2
    for k in (1, 2, 3):
        k_ = np.minimum(k, n)
        for kind, first in ((1, start + 1), (2, start + 1 + n - k_)):
            h = np.full(len(words), kind * 16 + k, np.uint64)
            for i in range(k):
                h = np.where(i < k_, h * base + c[np.minimum(first + i, len(c) - 1)], h)
            fixed.append(h)
    three = c[:-2] * base * base + c[1:-1] * base + c[2:] + np.uint64(77)
    own = np.repeat(np.arange(len(words)), size)
    inside = own[:-2] == own[2:]
    counts = 7 + n
    out = np.empty(int(counts.sum()), np.int64)
    first = np.cumsum(counts) - counts
    for j, h in enumerate(fixed):
        out[first + j] = _bucket(h + np.uint64(j))
    grams = np.ones(len(out), bool)
    grams[(first[:, None] + np.arange(7)).reshape(-1)] = False
    out[grams] = _bucket(three[inside])
    return out, counts


def groups(words: list[str], letters: int) -> Iterator[list[str]]:
    """Runs of words with about so many letters; a longer word stands alone."""
    part, held = [], 0
    for w in words:
        if part and held + len(w) > letters:
            yield part
            part, held = [], 0
        part.append(w)
        held += len(w)
    if part:
        yield part


def summed(weights: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each word's weights; those of a very long word are added up in slices."""
    step = GATHER // weights.shape[1]
    if len(counts) == 1 and len(flat) > step:
        return sum(weights[flat[a : a + step]].sum(axis=0, dtype=np.float64) for a in range(0, len(flat), step))[None]
    return np.add.reduceat(weights[flat], np.cumsum(counts) - counts, axis=0)


@dataclass(frozen=True)
class Field:
    """The learned model."""

    languages: tuple[str, ...]
    weights: np.ndarray  # BUCKETS x languages
    transitions: np.ndarray  # languages x languages, logarithms


def fewer(n: int, languages: int) -> int:
    """n, or less for more than MANY languages, so that tables of words by languages keep their size."""
    return max(1, n * MANY // max(MANY, languages))


class Tagger:
    """Emission scores of words, remembered, and forward-backward over many sequences at once."""

    def __init__(self, field: Field):
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.field.languages)))

    def emissions(self, words: list[str]) -> np.ndarray:
        k = len(self.field.languages)
        if len(self.index) > fewer(KEEP_WORDS, k):
            self.forget()
        new = [w for w in set(words) if w not in self.index]
        if new:
            sums = [summed(self.field.weights, *word_features(part)) for part in groups(new, GATHER // k)]
            self.index.update(zip(new, range(len(self.scores), len(self.scores) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, *sums])
        return self.scores[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        languages = self.field.languages
        words, length, owner = [], [], []
        letters = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            for line in (t or "").split("\n"):
                if found := _words(line.lower()):
                    words += found
                    length.append(len(found))
                    owner.append(i)
            letters[i] = any(map(str.isalpha, t or ""))
        if not words or not languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        length = np.array(length)
        p = posteriors(self.emissions(words), length, self.field.transitions)
        doc = np.repeat(np.array(owner), length)
        mass = np.stack([np.bincount(doc, p[:, k], len(texts)) for k in range(len(languages))], axis=1)
        total = mass.sum(axis=1)
        best = mass.argmax(axis=1)
        score = np.where(letters & (total > 0), mass[np.arange(len(texts)), best] / np.maximum(total, 1e-300), 0.0)
        return [languages[b] if ok else UNKNOWN for b, ok in zip(best, letters & (total > 0), strict=True)], np.clip(score, 0, 1).tolist()


def posteriors(emission: np.ndarray, length: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Each position's label probabilities, for all sequences at once (scaled forward-backward)."""
    start = np.cumsum(length) - length
    order = np.argsort(-length, kind="stable")
    start, size = start[order], length[order]
    e = np.exp(emission - emission.max(axis=1, keepdims=True))
    a = np.exp(transitions)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # sequences that have a t-th word
    now = e[start]
    now /= now.sum(axis=1, keepdims=True)
    alpha[start] = now
    for t in range(1, size[0]):
        at = start[: active[t]] + t
        now = (now[: active[t]] @ a) * e[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    for t in range(size[0] - 2, -1, -1):
        at = start[: active[t + 1]] + t
        now = (e[at + 1] * beta[at + 1]) @ a.T
        beta[at] = now / now.sum(axis=1, keepdims=True)
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True)


def fit(examples: list[tuple[list[str], str]], seed: int = 5) -> Field:
    """Learns a field from (words, language) by stochastic gradient steps with adaptive rates."""
    languages = tuple(sorted({y for _, y in examples}))
    rng = np.random.default_rng(seed)
    k = len(languages)
    weights, squares = np.zeros((BUCKETS, k)), np.full((BUCKETS, k), 1e-6)
    trans, trans_sq = np.zeros((k, k)), np.full((k, k), 1e-6)
    if k == 0:
        return Field(languages, weights.astype(np.float32), trans)
    coded = [(ws, languages.index(y)) for ws, y in examples]
    for _ in range(EPOCHS):
        order = rng.permutation(len(coded))
        pairs, i = [], 0
        while i < len(order):  # half alone, half as the second of a code-switched pair
            ws, y = coded[order[i]]
            xs, ys = list(ws), [y] * len(ws)
            if i + 1 < len(order) and rng.random() < 0.5:
                i += 1
                ws, y = coded[order[i]]
                xs, ys = xs + ws, ys + [y] * len(ws)
            pairs.append((xs, ys))
            i += 1
        for b in range(0, len(pairs), BATCH):
            part = pairs[b : b + BATCH]
            length = np.array([len(x) for x, _ in part])
            y = np.array([v for _, x in part for v in x])
            flat, counts = word_features([w for x, _ in part for w in x])
            emission = np.add.reduceat(weights[flat], np.cumsum(counts) - counts, axis=0)
            p, pair_p = _expected(emission, length, trans)
            g = p.copy()
            g[np.arange(len(y)), y] -= 1
            used, where = np.unique(flat, return_inverse=True)
            rows = np.repeat(g, counts, axis=0)
            grad = np.stack([np.bincount(where, rows[:, j], len(used)) for j in range(k)], axis=1) / len(part) + DECAY * weights[used]
            squares[used] += grad**2
            weights[used] -= RATE * grad / np.sqrt(squares[used])
            inner = np.ones(len(y), bool)
            inner[np.cumsum(length) - 1] = False
            at = np.flatnonzero(inner)
            seen = np.bincount(y[at] * k + y[at + 1], minlength=k * k).reshape(k, k)
            grad = (pair_p - seen) / len(part)
            trans_sq += grad**2
            trans -= RATE * grad / np.sqrt(trans_sq)
    return Field(languages, weights.astype(np.float32), trans)


def _expected(emission: np.ndarray, length: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities, and the sum of pair probabilities, under the model."""
    p = posteriors(emission, length, trans)
    # pair probabilities from scaled messages: proportional to alpha_t a e_{t+1} beta_{t+1}
    inner = np.ones(len(emission), bool)
    inner[np.cumsum(length) - 1] = False
    at = np.flatnonzero(inner)
    e = np.exp(emission - emission.max(axis=1, keepdims=True))
    a = np.exp(trans)
    alpha, beta = _messages(e, length, a)
    left, right = alpha[at], e[at + 1] * beta[at + 1]
    return p, a * ((left / ((left @ a) * right).sum(axis=1, keepdims=True)).T @ right)


def _messages(e: np.ndarray, length: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.cumsum(length) - length
    alpha, beta = np.empty_like(e), np.ones_like(e)
    most = int(length.max())
    for t in range(most):
        at = start[length > t] + t
        now = e[at] if t == 0 else (alpha[at - 1] @ a) * e[at]
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(most - 2, -1, -1):
        at = start[length > t + 1] + t
        now = (e[at + 1] * beta[at + 1]) @ a.T
        beta[at] = now / now.sum(axis=1, keepdims=True)
    return alpha, beta


def training_runs(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> list[tuple[list[str], str]]:
    """The bounded training sample: a run of words from about TRAIN_DOCS documents of each language."""
    known = df.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull())
    sizes = known.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).collect()
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r[0], TRAIN_DOCS / r[1])])
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(F.element_at(share, F.col(lang_col)) > draw)
    picked = picked.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.lit("run"), F.col(id_col)).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(0)):
                words = [_words((t or "").lower()) for t in texts]
                first = [h % max(1, len(w) - TRAIN_WORDS + 1) for w, h in zip(words, batch.column(2).slice(a, b - a).to_pylist(), strict=True)]
                runs = [w[i : i + TRAIN_WORDS] for w, i in zip(words, first, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(runs, pa.list_(pa.string())), batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a)], names=["words", "lang", "h"])

    kind = picked.schema["lang"].dataType.simpleString()
    rows = text_batches(picked).mapInArrow(run, f"words array<string>, lang {kind}, h long").where("size(words) > 0").collect()
    return [(list(r[0]), r[1]) for r in sorted(rows, key=lambda r: (r[1], r[2], r[0]))]


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Field:
    return fit(training_runs(df, id_col, text_col, lang_col))


def predict(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score for every row of df; partitions stay as they are."""
    shared = df.sparkSession.sparkContext.broadcast(field)  # BUCKETS x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        field_languages = shared.value.languages
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), fewer(CHUNK_CHARS, len(field_languages))):
                names, scores = tagger.label(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = text_batches(df.select(id_col, F.col(text_col).cast("string").alias("text_")))
    return rows.mapInArrow(lambda batches: released(run(batches)), f"`{id_col}` {kind}, lang_pred string, score double")


def label_words(text: str, field: Field) -> list[tuple[str, str]]:
    """Every word of a text with its most probable language."""
    tagger, out = Tagger(field), []
    for line in text.split("\n"):
        if found := _words(line.lower()):
            p = posteriors(tagger.emissions(found), np.array([len(found)]), field.transitions)
            out += zip(found, (field.languages[k] for k in p.argmax(axis=1)), strict=True)
    return out
