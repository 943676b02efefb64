"""Quality classifier on random-indexing word vectors.

Every word has a sparse random index vector; a word's context vector is the
sum of the index vectors of its neighbours over the whole corpus, of unit
length once the direction that all words share is taken off.  A document is
pooled from its words' context vectors alone (their mean, their spread and
the product of neighbours, frequent words damped), and a two-layer network
in numpy, its probabilities calibrated by a temperature, judges it.

The marks of a word (``%%%``, ``|``, ``!!``) and its capitals are words of
their own beside its letters, so that they have contexts too.  Vectors stand
in hashed rows: a word's own contexts outweigh those of the rare words in its
row when its share of the corpus passes the share of the rare ones divided by
the number of rows, whatever the size of the corpus.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cairn.llm.folds import crc_fold
from cairn.llm.labelled import FOLDS, HELD_OUT, labelled_sample
from cairn.llm.words import Words, hash_words, split_words

ROWS, DIM = 1 << 16, 32     # hashed vocabulary and length of its vectors: 8 MB
NONZERO = 4                 # of an index vector
REACH = 2                   # neighbours on each side
SLICE = 1 << 8              # rows of the vector table that travel together
DAMPING = 1e-3              # share of the corpus at which a word's weight is half
PART_BYTES = 1 << 20        # text handled at once inside a task, whole documents
POOLED = 3 * DIM
HIDDEN = 32
PER_CLASS = 4000            # labelled texts of each class that the network is fitted on
EPOCHS, BATCH, RATE, DECAY = 60, 64, 0.01, 1e-3
CALIBRATION = 5             # every fifth text is kept from the fit, for the temperature

NOT_MARKS, MARKS, DIGITS = r"[\p{L}\p{M}\p{N}]+", r"[^\p{L}\p{M}\p{N}]+", r"\p{N}+"
RUNS = re.compile(r"(.)\1+", re.DOTALL)
CAPITALS, LETTERS, SIGNS = range(3)     # kinds of pieces, hashed apart


def _hashed(words: pa.Array, kind: int) -> np.ndarray:
    return (hash_words(words, kind) % np.uint64(ROWS)).astype(np.int64)


def piece_rows(part: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row of every piece, text offsets): each word is a sign of capitals if it has two or more and no small letter,
    its letters and digits (runs of digits alike), and its marks (equal ones in a row as two)."""
    vocab = part.vocab
    bare = pc.replace_substring_regex(vocab, MARKS, "")
    core = pc.replace_substring_regex(pc.utf8_lower(bare), DIGITS, "0").dictionary_encode()
    marks = pc.replace_substring_regex(vocab, NOT_MARKS, "").dictionary_encode()
    kinds = pa.array([RUNS.sub(r"\1\1", m) for m in marks.dictionary.to_pylist()], pa.string())
    each = np.stack([np.full(len(vocab), _hashed(pa.array(["^"]), CAPITALS)[0]),
                     _hashed(core.dictionary, LETTERS)[core.indices.to_numpy()] if len(vocab) else np.empty(0, np.int64),
                     _hashed(kinds, SIGNS)[marks.indices.to_numpy()] if len(vocab) else np.empty(0, np.int64)], axis=1)
    letters = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    there = np.stack([pc.utf8_is_upper(bare).to_numpy(zero_copy_only=False).astype(bool) & (letters > 1), letters > 0,
                      pc.not_equal(marks.dictionary, "").to_numpy(zero_copy_only=False).astype(bool)[marks.indices.to_numpy()]
                      if len(vocab) else np.empty(0, bool)], axis=1)
    n = there.sum(axis=1)
    first = np.concatenate([[0], np.cumsum(n)])
    size = n[part.codes]
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(ends[-1]) + np.repeat(first[part.codes] - ends[:-1], size)
    return each[there][at], ends[part.offsets]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the entries of all rows' sparse random vectors, the same in every task."""
    r = np.random.default_rng(11)
    return r.integers(0, DIM, (ROWS, NONZERO)), r.choice(np.array([-1.0, 1.0], np.float32), (ROWS, NONZERO))


def add_contexts(table: np.ndarray, count: np.ndarray, rows: np.ndarray, offsets: np.ndarray, index) -> None:
    """Adds the index vectors of each piece's neighbours within its text to the piece's row, and counts the pieces."""
    places, signs = index
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for d in range(1, REACH + 1):
        same = doc[d:] == doc[:-d]
        left, right = rows[:-d][same], rows[d:][same]
        for word, near in ((left, right), (right, left)):
            table += np.bincount((word[:, None] * DIM + places[near]).ravel(), signs[near].ravel(), ROWS * DIM).reshape(ROWS, DIM).astype(np.int64)
    count += np.bincount(rows, minlength=ROWS)


def _contexts(batches):
    """What the task's texts add to the context vectors: the rows that it met, those of a slice of the table together."""
    index = index_vectors()
    table, count = np.zeros((ROWS, DIM), np.int64), np.zeros(ROWS, np.int64)
    for batch in batches:
        for part in split_words(batch.column(0), lower=False, limit=PART_BYTES):
            rows, offsets = piece_rows(part)
            if len(rows):
                add_contexts(table, count, rows, offsets, index)
    met = np.flatnonzero(count)
    for some in np.split(met, np.flatnonzero(np.diff(met // SLICE)) + 1):
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array([int(some[0]) // SLICE]), pa.array([some.tobytes()], pa.binary()),
                                              pa.array([np.column_stack([count[some], table[some]]).tobytes()], pa.binary())],
                                             names=["slice", "rows", "part"])


def _summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = np.zeros((SLICE, 1 + DIM), np.int64)
    for rows, part in zip(table.column("rows").to_pylist(), table.column("part").to_pylist(), strict=True):
        total[np.frombuffer(rows, np.int64) % SLICE] += np.frombuffer(part, np.int64).reshape(-1, 1 + DIM)
    return pa.table({"slice": [key[0].as_py()], "part": pa.array([total.tobytes()], pa.binary())})


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def finished(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, weights) of all rows from their counts and context sums."""
    share = total[:, 0] / max(1, total[:, 0].sum())
    vectors = unit(total[:, 1:].astype(np.float64))
    vectors = np.where(total[:, :1] > 0, unit(vectors - share @ vectors), 0)
    return vectors.astype(np.float32), (DAMPING / (DAMPING + share)).astype(np.float32)


def word_vectors(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Context vectors of unit length over all texts of ``docs`` and pooling weights, one per row of the hashed vocabulary
    (a fixed size).  Sums are of integers: the same for any partitioning."""
    found = (docs.select(F.col(text_col).alias("text")).mapInArrow(_contexts, "slice long, rows binary, part binary")
             .groupBy("slice").applyInArrow(_summed, "slice long, part binary"))
    total = np.zeros((ROWS, 1 + DIM), np.int64)
    for r in found.toLocalIterator():
        total[r.slice * SLICE:(r.slice + 1) * SLICE] = np.frombuffer(r.part, np.int64).reshape(SLICE, 1 + DIM)
    return finished(total)


def pooled(texts: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A row per text: weighted mean of its pieces' vectors, their spread, and the mean product of neighbours."""
    vectors, weights = table
    out = [np.empty((0, POOLED), np.float32)]
    for part in split_words(texts, lower=False, limit=PART_BYTES):
        rows, offsets = piece_rows(part)
        full = np.flatnonzero(np.diff(offsets))
        x = np.zeros((len(offsets) - 1, POOLED), np.float32)
        if len(full):
            starts, w, each = offsets[:-1][full], weights[rows][:, None], vectors[rows]
            near = np.zeros_like(each)
            near[:-1] = each[:-1] * each[1:]
            near[offsets[1:][full] - 1] = 0
            total = np.add.reduceat(w, starts, axis=0)
            mean, square, product = (np.add.reduceat(v * w, starts, axis=0) / total for v in (each, each * each, near))
            x[full] = np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0)), product], axis=1)
        out.append(x)
    return np.concatenate(out)


class Network:
    """Two layers, fitted by Adam on standardised inputs, with a temperature."""

    def __init__(self, inputs: int, seed: int = 3):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.w1, self.b1 = r.normal(0, inputs ** -0.5, (inputs, HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = r.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)
        self.temperature, self.prior = 1.0, 0.0

    @classmethod
    def of(cls, weights: dict) -> Network:
        net = cls.__new__(cls)
        vars(net).update(weights)
        return net

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature + self.prior, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        weights = [self.w1, self.b1, self.w2, self.b2]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        z = (x - self.mean) / self.scale
        for _ in range(EPOCHS):
            order = r.permutation(len(y))
            for i in range(0, len(order), BATCH):
                some = order[i:i + BATCH]
                a = z[some] @ self.w1 + self.b1
                h = np.maximum(a, 0)
                err = (1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -30, 30))) - y[some]) / len(some)
                back = err[:, None] * self.w2 * (a > 0)
                grads = [z[some].T @ back + DECAY * self.w1, back.sum(axis=0), h.T @ err + DECAY * self.w2, err.sum(keepdims=True)]
                step += 1
                for w, m, v, g in zip(weights, first, second, grads, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on texts that were kept from the fit."""
        z = self.logits(x)

        def loss(t):
            return np.logaddexp(0, np.where(y == 1, -z, z) / t).mean()

        self.temperature = float(min(np.geomspace(0.25, 16, 97), key=loss)) if len(y) else 1.0


def fit_quality(docs: DataFrame, labels: DataFrame, table: tuple[np.ndarray, np.ndarray], target: str = "quality", per_class: int = PER_CLASS,
                id_col: str = "doc_id", text_col: str = "text") -> Network:
    """The network, fitted on a bounded sample of labelled texts that weighs both classes as they are labelled."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            x = pooled(batch.column(0), shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float32())), batch.column(1)], names=["x", "label"])

    found = (labelled_sample(docs, labels, target, per_class, id_col, text_col)
             .mapInArrow(run, "x array<float>, label int").collect())   # 2 * per_class rows at most
    x = np.array([r.x for r in found], np.float64).reshape(len(found), POOLED)
    y = np.array([r.label for r in found], np.float64)
    net = Network(POOLED)
    if len(np.unique(y)) < 2:
        net.w2[:], net.b2[:] = 0, 4 if y.all() else -4
        return net
    apart = np.arange(len(y)) % CALIBRATION == 0
    net.fit(x[~apart], y[~apart])
    net.calibrate(x[apart], y[apart])
    # The sample may hold more of one class than the labelled rows do; the difference in log odds is put back.
    kinds = dict(labels.where(crc_fold(id_col, FOLDS) != HELD_OUT).groupBy(target).count().where(f"{target} in (0, 1)").collect())
    net.prior = float(np.log(kinds.get(1, 1) / kinds.get(0, 1)) - np.log(max(1, y.sum()) / max(1, len(y) - y.sum())))
    return net


def score_quality(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every whole text of ``docs``.

    Word vectors come from all texts, labels only from the learning folds.
    A null or empty text is scored as a document without words.  Without
    labelled texts of both classes all texts have one class.  Repeated rows
    and null ids (the fold of an empty id) are scored one by one; other
    columns are ignored; an empty table gives none.
    """
    table = word_vectors(docs, text_col)
    net = fit_quality(docs, labels, table, target, per_class, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((vars(net), table))

    def run(batches):
        weights, vectors = shared.value
        model = Network.of(weights)
        for batch in batches:
            score = model.probability(pooled(batch.column(1), vectors).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        (crc_fold(id_col, FOLDS) == HELD_OUT).alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
