"""Toxicity by a convolutional text classifier in numpy.

Words are hashed, with their prefixes, into an embedding table; filters of
several widths run over the embedded text, the strongest response of each
filter is pooled, and a linear layer gives a logit.  All weights start at
random and are learnt together by gradient steps, with dropout on the pooled
responses; a feature that too few texts hold has the embedding zero, so that
rare words are not learnt by heart.  The model learns from all labelled
texts: they are dealt to partitions, which go over their texts in steps of
their own, and after some passes the weights are averaged.  Thresholds are calibrated by the language that the text's function words show, so that
0.7 is the threshold of every language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from cairn.llm.folds import crc_fold
from cairn.llm.labelled import FOLDS, HELD_OUT, known_labels, labelled_sample, labelled_texts
from cairn.llm.words import small_batches, split_words
from cairn.session import shared_dir

ROWS, DIM, FILTERS, WIDTHS = 1 << 18, 16, 16, (1, 2, 3)
PREFIXES = (3, 4, 5)
PER_CLASS = 3000            # texts of each class in a sample, where one is asked for
SAMPLE_WORDS = 4_000_000    # words of each class in such a sample; one text has at most a 64th of them
TEXTS_PER_PART, PARTS = 1 << 16, 64  # labelled texts that learn one after the other between two averages, and the most such parts
PASSES = 2                  # of the epochs between two averages
BROADCAST_LABELS = 2_000_000    # ids with their labels that are broadcast to the scan of the texts; more are joined by a shuffle
SHARDS = 16                 # tasks that average the embeddings
LOGIT_STEPS = 256           # steps a unit in which the logits of calibration texts are counted
BATCH_WORDS = 1 << 20       # words after which a batch ends early
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.05, 1e-4
DROPOUT = 0.5               # of the pooled responses, while fitting
MIN_TEXTS = 5               # fitted texts that hold a feature before it has an embedding
CALIBRATION = 5             # every fifth text is kept from the fit, for the thresholds
MIN_POSITIVE = 8            # toxic calibration texts of a language before it has a threshold of its own
THRESHOLD = 0.7
FALSE_ALARM = 2             # calibration errors that one clean text above the threshold counts as

# Function words that tell languages apart.
LANGUAGES = {
    "en": "the of and to is was that for it with as on by he are this from or at not",
    "de": "der die und den das von zu mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "le les des est et du dans que pour qui une sur au pas avec par plus il ce ne",
    "es": "el los las y que del se por con su para como una lo más pero sus al es un",
}


MARKS = ".,;:!?\"'()[]{}«»“”„…-*_"


def word_features(word: str) -> list[int]:
    """Embedding rows of a word and its prefixes, without case and the marks around it."""
    return vocab_features(pa.array([word], pa.string()))[0].tolist()


def _hashed(strings: pa.Array, kind: str) -> np.ndarray:
    """Embedding row of each string, hashed once per distinct one."""
    coded = strings.dictionary_encode()
    f, kind = xxhash.xxh32_intdigest, kind.encode()
    rows = np.array([f(kind + x) for x in coded.dictionary.cast(pa.binary()).to_pylist()], np.int64) % ROWS
    return rows[coded.indices.to_numpy()]


def vocab_features(vocab: pa.Array) -> np.ndarray:
    """``word_features`` of every word, a row each."""
    if not len(vocab):
        return np.empty((0, 1 + len(PREFIXES)), np.int64)
    plain = pc.string_is_ascii(vocab)
    low = pc.ascii_lower(vocab)
    if not pc.all(plain).as_py():
        others = pc.invert(plain)
        low = pc.replace_with_mask(low, others, pa.array([w.lower() for w in vocab.filter(others).to_pylist()], vocab.type))
    core = pc.utf8_trim(low, characters=MARKS)
    size = pc.utf8_length(core).to_numpy()
    out = np.repeat(_hashed(core, "w ")[:, None], 1 + len(PREFIXES), axis=1)
    for at, k in enumerate(PREFIXES, 1):
        longer = np.flatnonzero(size > k)
        out[longer, at] = _hashed(pc.utf8_slice_codeunits(core.take(pa.array(longer)), 0, k), f"p{k} ")
    return out


class Featurised:
    """Rows of every word and language of every text of a batch."""

    def __init__(self):
        index = {w: i + 1 for i, ws in enumerate(LANGUAGES.values()) for w in ws.split()}
        self.known, self.tongue = pa.array(index, pa.string()), np.array([*index.values(), 0], np.int64)     # 0 for all others

    def parts(self, texts: pa.Array):
        """(part, rows per distinct word, language per text)."""
        for part in split_words(texts):
            rows = vocab_features(part.vocab)
            found = pc.index_in(pc.utf8_trim(part.vocab, characters=".,;:"), self.known.cast(part.vocab.type))
            tongue = self.tongue[pc.fill_null(found, len(self.known)).to_numpy(zero_copy_only=False)][part.codes]
            n = part.stop - part.start
            doc = np.repeat(np.arange(n), np.diff(part.offsets))
            votes = np.bincount(doc * (len(LANGUAGES) + 1) + tongue, minlength=n * (len(LANGUAGES) + 1)).reshape(n, -1)
            votes[:, 0] = 0
            yield part, rows, np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), 0)


class TextCNN:
    """Weights, forward pass over distinct words, and training by Adagrad steps."""

    def __init__(self, seed: int = 7, widths: tuple[int, ...] = WIDTHS):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.1, (ROWS, DIM)).astype(np.float32)
        self.conv = [r.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in widths]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in widths]
        self.out = r.normal(0, 0.3, FILTERS * len(widths)).astype(np.float32)
        self.const = np.zeros(1, np.float32)

    @classmethod
    def of(cls, weights: dict) -> TextCNN:
        """A model with given weights, those of ``vars(model)``."""
        model = cls.__new__(cls)
        vars(model).update(weights)
        return model

    def _pooled(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Strongest response of each filter per text and its place; words are followed by padding inside the array."""
        best, where = [], []
        for kernel, b in zip(self.conv, self.bias, strict=True):
            response = np.zeros((len(words), kernel.shape[2]), words.dtype)
            for j, k in enumerate(kernel):
                response[:len(words) - j] += words[j:] @ k
            at = np.array([response[s:e].argmax(axis=0) + s for s, e in zip(starts, ends, strict=True)])
            where.append(at)
            best.append(np.take_along_axis(response, at, axis=0) + b)
        return np.concatenate(best, axis=1), where

    def gradients(self, docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, mask: np.ndarray | float = 1.0):
        """Mean weighted log loss of texts given the embedding rows of each word, and what it changes by.

        (loss, embedding rows, their gradients, gradients of kernels, biases,
        output weights and constant); ``mask`` multiplies the pooled responses.
        """
        pad = np.full((max(len(k) for k in self.conv), 1 + len(PREFIXES)), -1, np.int64)
        rows = np.concatenate([x for d in docs for x in (d, pad)])
        size = np.array([len(d) for d in docs])
        starts = np.cumsum(size + len(pad)) - size - len(pad)
        words = sum(self.embed[r] for r in rows.T) * (rows[:, :1] >= 0)
        raw, where = self._pooled(words, starts, starts + np.maximum(size, 1))
        hidden = np.maximum(raw, 0) * mask
        z = hidden @ self.out + self.const
        loss = float((weights * np.logaddexp(0, np.where(labels == 1, -z, z))).mean())
        err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weights / len(docs)).astype(words.dtype)
        back = err[:, None] * self.out[None, :] * (raw > 0) * mask
        kernels, biases, word_at, word_grad, first = [], [], [], [], 0
        for kernel, at in zip(self.conv, where, strict=True):
            g = back[:, first:first + kernel.shape[2]].astype(words.dtype)
            first += kernel.shape[2]
            biases.append(g.sum(axis=0))
            kernels.append(np.stack([np.einsum("nfd,nf->df", words[at + j], g) for j in range(len(kernel))]))
            for j, k in enumerate(kernel):
                word_at.append((at + j).ravel())
                word_grad.append((g[:, :, None] * k.T[None]).reshape(-1, DIM))
        touched, which = np.unique(np.concatenate(word_at), return_inverse=True)
        per_word = np.zeros((len(touched), DIM), words.dtype)
        np.add.at(per_word, which, np.concatenate(word_grad))
        real = rows[touched][:, 0] >= 0
        table_rows, which = np.unique(rows[touched][real], return_inverse=True)
        per_row = np.zeros((len(table_rows), DIM), words.dtype)
        np.add.at(per_row, which.ravel(), np.repeat(per_word[real], rows.shape[1], axis=0))
        return loss, table_rows, per_row, kernels, biases, hidden.T @ err, err.sum(keepdims=True)

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        count = np.zeros(ROWS, np.int64)
        for rows in docs:
            count[np.unique(rows)] += 1
        known = count >= MIN_TEXTS
        self.embed[~known] = 0
        seen = self.unseen()
        weight = len(labels) / (2 * np.maximum(1, np.bincount(labels, minlength=2)))
        for _ in range(epochs):
            self.learn(docs, labels, weight, known, seen, r)

    def slots(self) -> list[np.ndarray]:
        """All weights but the embeddings."""
        return [*self.conv, *self.bias, self.out, self.const]

    def unseen(self) -> list[np.ndarray]:
        """Squared gradients before the first step: of each slot, then of the embeddings."""
        return [np.full_like(x, 1e-4) for x in [*self.slots(), self.embed]]

    def learn(self, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, known: np.ndarray, seen: list[np.ndarray],
              r: np.random.Generator) -> None:
        """One pass over texts by steps; ``weight`` is that of each label, ``seen`` goes on from step to step."""
        slots, seen_rows = self.slots(), seen[-1]
        order, size = r.permutation(len(docs)), np.array([len(d) for d in docs])
        i = 0
        while i < len(order):
            some = order[i:i + BATCH]
            some = some[:max(1, int(np.searchsorted(np.cumsum(size[some]), BATCH_WORDS, side="right")))]
            i += len(some)
            mask = (r.random((len(some), len(self.out))) >= DROPOUT) / (1 - DROPOUT)
            _, at, per_row, kernels, biases, out, const = self.gradients([docs[d] for d in some], labels[some], weight[labels[some]],
                                                                          mask.astype(np.float32))
            at, per_row = at[known[at]], per_row[known[at]]
            seen_rows[at] += per_row ** 2
            self.embed[at] -= RATE * per_row / np.sqrt(seen_rows[at])
            decayed = [g + DECAY * k for g, k in zip(kernels, self.conv, strict=True)]
            for x, s, g in zip(slots, seen, [*decayed, *biases, out + DECAY * self.out, const], strict=False):
                s += g ** 2
                x -= RATE * g / np.sqrt(s)

    def logits(self, rows: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of texts given the embedding rows of distinct words, word codes and text offsets."""
        n = len(offsets) - 1
        vocab = np.concatenate([self.embed[rows].sum(axis=1), np.zeros((1, DIM), np.float32)])
        size = np.diff(offsets)
        tail = max(len(k) for k in self.conv)
        starts = offsets[:-1] + tail * np.arange(n)
        padded = np.full(len(codes) + tail * n + tail, len(vocab) - 1, np.int64)     # each text is followed by padding
        padded[np.arange(len(codes)) + tail * np.repeat(np.arange(n), size)] = codes
        pooled = []
        for kernel, b in zip(self.conv, self.bias, strict=True):
            reply = (vocab @ kernel[0]).take(padded[:len(padded) - tail], axis=0)
            for j, k in enumerate(kernel[1:], 1):
                reply += (vocab @ k).take(padded[j:len(padded) - tail + j], axis=0)
            # reduceat over (text, its padding): the odd slices are dropped
            edges = np.stack([starts, starts + np.maximum(size, 1)], axis=1).ravel()
            pooled.append(np.maximum.reduceat(reply, edges[edges < len(reply)], axis=0)[::2] + b if n else np.empty((0, len(b))))
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        return hidden @ self.out + self.const[0]


def _thresholds(logits: np.ndarray, labels: np.ndarray, tongue: np.ndarray, texts: np.ndarray | None = None) -> np.ndarray:
    """Logit per language that parts the calibration texts at the least cost, two thirds up where a range does.

    ``texts`` is how many texts an entry stands for (default: one)."""
    texts = np.ones(len(labels), np.int64) if texts is None else texts

    def best(z, y, n):
        order = np.argsort(z, kind="stable")
        z, y, n = z[order], y[order], n[order]
        edges = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
        missed, alarms = np.concatenate([[0], np.cumsum(n * (y == 1))]), np.concatenate([np.cumsum((n * (y == 0))[::-1])[::-1], [0]])
        cost = missed + FALSE_ALARM * alarms
        good = np.flatnonzero(cost == cost.min())
        low, high = z[max(good[0] - 1, 0)], z[min(good[-1], len(z) - 1)]
        return float(edges[good[-1]] if high <= low else low + 2 * (high - low) / 3)

    every = best(logits, labels, texts) if len(labels) else 0.0
    out = np.full(len(LANGUAGES) + 1, every)
    for t in range(len(out)):
        here = tongue == t
        if all(texts[here & (labels == y)].sum() >= MIN_POSITIVE for y in (0, 1)):
            out[t] = best(logits[here], labels[here], texts[here])
    return out


BLOCK = "vocab binary, codes binary, offsets binary, label binary, tongue binary, apart binary"


def _blocks(texts: DataFrame, parts: int):
    """An RDD of at most ``parts`` partitions of blocks of featurised texts, read from a checkpoint."""
    def run(batches):
        maker = Featurised()
        for batch in small_batches(batches, "text"):
            for part, rows, tongue in maker.parts(batch.column("text")):
                of = [batch.column(c).to_numpy(zero_copy_only=False)[part.start:part.stop].astype(t) for c, t in (("label", np.int32), ("apart", bool))]
                arrays = (rows.astype(np.uint32), part.codes.astype(np.uint32), part.offsets, of[0], tongue.astype(np.int32), of[1])
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays],
                                                 names=["vocab", "codes", "offsets", "label", "tongue", "apart"])

    # equal texts meet in the one shuffle
    dealt = (texts.select("text", "label", F.xxhash64("text").alias("h")).repartition(parts, "h").distinct().sortWithinPartitions("h", "label", "text")
             .select("text", "label", (F.pmod(F.xxhash64("h"), F.lit(CALIBRATION)) == 0).alias("apart")))
    shared_dir(texts.sparkSession)

    def decode(r):
        vocab = np.frombuffer(r.vocab, np.uint32).reshape(-1, 1 + len(PREFIXES)).astype(np.int64)
        return (vocab, *(np.frombuffer(x, t) for x, t in ((r.codes, np.uint32), (r.offsets, np.int64), (r.label, np.int32), (r.tongue, np.int32), (r.apart, bool))))

    return dealt.mapInArrow(run, BLOCK).checkpoint().rdd.coalesce(parts).map(decode)


def _counted(blocks):
    """Fitted texts that hold each feature, then texts per label: of the fitted ones, and of all."""
    held, n = np.zeros(ROWS, np.int32), np.zeros(4, np.int64)
    for vocab, codes, offsets, label, _, apart in blocks:
        for d in np.flatnonzero(~apart):
            held[np.unique(vocab[np.unique(codes[offsets[d]:offsets[d + 1]])])] += 1
        n += np.concatenate([np.bincount(label[~apart], minlength=2), np.bincount(label, minlength=2)])
    yield held, n


def _averaged(parts, old: np.ndarray) -> np.ndarray:
    """The weighted mean of what the partitions learnt, in their order; what none of them touched stays."""
    total, weights = np.zeros(old.shape), np.zeros(old.shape[1])
    for _, weight, x in sorted(parts, key=lambda p: p[0]):
        total += x * weight[:, None]
        weights += weight
    return np.where(weights[:, None] > 0, total / np.maximum(weights, 1e-9)[:, None], old).astype(np.float32)


def _fit_all(texts: DataFrame, parts: int, widths: tuple[int, ...]) -> tuple[TextCNN, np.ndarray]:
    """(model, threshold per language) learnt from all ``texts``, every fifth of them for the thresholds only.

    The partitions learn side by side from the same weights; after PASSES
    passes a task per share of the known embeddings, and one for the other weights,
    averages what they have learnt.
    """
    context = texts.sparkSession.sparkContext
    blocks, model = _blocks(texts, parts), TextCNN(widths=widths)
    if not blocks.getNumPartitions():
        return model, np.full(len(LANGUAGES) + 1, np.inf)
    held, n = blocks.mapPartitions(_counted).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    if not n[:2].all():
        return model, np.full(len(LANGUAGES) + 1, -np.inf if n[3] else np.inf)
    known = held >= MIN_TEXTS
    rows, weight = np.flatnonzero(known), n[:2].sum() / (2 * np.maximum(1, n[:2]))
    model.embed[~known] = 0
    seen = model.unseen()
    cuts = np.linspace(0, len(rows), SHARDS + 1).astype(int)

    def flat(arrays):
        return np.concatenate([x.ravel() for x in arrays])

    def rebuilt(sent):
        table, other = sent
        copy = TextCNN(widths=widths)
        copy.embed[:] = 0
        copy.embed[rows] = table[0]
        state = copy.unseen()
        state[-1][rows] = table[1]
        at = 0
        for x in [*copy.slots(), *state[:-1]]:
            x.flat[:] = other[at:at + x.size]
            at += x.size
        return copy, state

    for epoch in range(0, EPOCHS, PASSES):
        sent = context.broadcast((np.stack([model.embed[rows], seen[-1][rows]]), flat([*model.slots(), *seen[:-1]])))

        def learn(index, some, sent=sent, epoch=epoch):
            mine, state = rebuilt(sent.value)
            before, texts_here = state[-1][rows, 0].copy(), 0
            for at, (vocab, codes, offsets, label, _, apart) in enumerate(some):
                docs = [vocab[codes[offsets[d]:offsets[d + 1]]] for d in np.flatnonzero(~apart)]
                for turn in range(epoch, min(epoch + PASSES, EPOCHS)):      # a block at a time, so that no part is held
                    mine.learn(docs, label[~apart], weight, known, state, np.random.default_rng((7, turn, index, at)))
                texts_here += len(docs)
            if texts_here:
                table, touched = np.stack([mine.embed[rows], state[-1][rows]]), (state[-1][rows, 0] != before).astype(float)
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    yield k, (index, touched[a:b], table[:, a:b])
                yield SHARDS, (index, np.array([texts_here], float), flat([*mine.slots(), *state[:-1]]))

        def average(item, sent=sent):
            k, found = item
            table, other = sent.value
            if k == SHARDS:
                return k, _averaged([(i, w, x[None, None]) for i, w, x in found], other[None, None])[0, 0]
            return k, _averaged([(i, np.repeat(w[None], 2, 0).ravel(), x.reshape(1, -1, DIM)) for i, w, x in found],
                                table[:, cuts[k]:cuts[k + 1]].reshape(1, -1, DIM))[0].reshape(2, -1, DIM)

        found = dict(blocks.mapPartitionsWithIndex(learn).groupByKey(SHARDS + 1, lambda k: k).map(average).collect())
        model, seen = rebuilt((np.concatenate([found[k] for k in range(SHARDS)], axis=1), found[SHARDS]))
        sent.unpersist()
    last = context.broadcast(vars(model))

    def calibrate(some):
        mine = TextCNN.of(last.value)
        for vocab, codes, offsets, label, tongue, apart in some:
            z = np.clip(mine.logits(vocab, codes.astype(np.int64), offsets), -30, 30)
            for key in zip(np.rint(z * LOGIT_STEPS).astype(int)[apart].tolist(), label[apart].tolist(), tongue[apart].tolist(), strict=True):
                yield key, 1

    found = blocks.mapPartitions(calibrate).reduceByKey(int.__add__, SHARDS).collect()     # at most 60 x LOGIT_STEPS a label and language
    z, y, tongue, count = (np.array(x, np.int64) for x in zip(*sorted((*k, v) for k, v in found), strict=True)) if found else [np.empty(0, np.int64)] * 4
    return model, _thresholds(z / LOGIT_STEPS, y, tongue, count)


def fit_toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text", sample_words: int | None = None,
                 widths: tuple[int, ...] = WIDTHS) -> tuple[TextCNN, np.ndarray]:
    """(model, threshold per language) from all labelled whole texts.

    Where ``per_class`` or ``sample_words`` is given, from a sample instead,
    which has at most so many texts and words of each label; a text of more
    than a 64th of those words, or one that would pass the bound, is not in it.
    """
    if per_class is None and sample_words is None:
        known = known_labels(labels, target, id_col)
        n = known.count()
        texts = labelled_texts(docs, F.broadcast(known) if n <= BROADCAST_LABELS else known, id_col, text_col)
        return _fit_all(texts, max(1, min(PARTS, -(-n // TEXTS_PER_PART))), widths)
    per_class, sample_words = per_class or PER_CLASS, sample_words or SAMPLE_WORDS

    def run(batches):
        maker = Featurised()
        for batch in batches:
            for part, rows, tongue in maker.parts(batch.column(0)):
                some = np.flatnonzero(np.diff(part.offsets) <= sample_words // 64)
                rows_of = [rows[part.codes[part.offsets[r]:part.offsets[r + 1]]].astype(np.uint32).tobytes() for r in some]
                yield pa.RecordBatch.from_arrays([pa.array(rows_of, pa.binary()), batch.column(1).take(pa.array(some + part.start)),
                                                  pa.array(tongue[some], pa.int32())], names=["rows", "label", "tongue"])

    found = labelled_sample(docs, labels, target, per_class, id_col, text_col).mapInArrow(
        run, "rows binary, label int, tongue int")
    texts, y, tongue, left = [], [], [], [sample_words] * 2
    for r in found.toLocalIterator():       # a partition at a time, so that what is left out is not held
        rows = np.frombuffer(r.rows, np.uint32).reshape(-1, 1 + len(PREFIXES))
        if len(rows) <= left[r.label]:
            left[r.label] -= len(rows)
            texts.append(rows)
            y.append(r.label)
            tongue.append(r.tongue)
    y, tongue = np.array(y, np.int64), np.array(tongue, np.int64)
    model = TextCNN(widths=widths)
    apart = np.arange(len(y)) % CALIBRATION == 0
    fit_on = np.flatnonzero(~apart)
    if len(np.unique(y[fit_on])) < 2:
        return model, np.full(len(LANGUAGES) + 1, np.inf if not y.any() else -np.inf)
    model.fit([texts[i] for i in fit_on], y[fit_on])
    z = np.array([model.logits(texts[i], np.arange(len(texts[i])), np.array([0, len(texts[i])]))[0] for i in np.flatnonzero(apart)])
    return model, _thresholds(z, y[apart], tongue[apart])


def score_toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text of ``docs``, by a model of all labelled texts (see ``fit_toxicity``).

    The score is the logistic of the logit's distance from the threshold of
    the text's language, set so that the threshold has the score 0.7.  A
    null or empty text has the score of no response at all.  Without
    labelled texts of both classes all texts have one class.  Repeated rows
    and null ids (the fold of an empty id) are scored one by one; other
    columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    fitted, limits = fit_toxicity(docs, labels, target, per_class, id_col, text_col)
    shared = spark.sparkContext.broadcast((vars(fitted), limits))       # plain arrays of a fixed size
    shift = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def run(batches):
        weights, thresholds = shared.value
        model = TextCNN.of(weights)
        maker = Featurised()
        for batch in batches:
            scores = [np.empty(0)]
            for part, rows, tongue in maker.parts(batch.column(1)):
                z = model.logits(rows, part.codes, part.offsets) - thresholds[tongue] + shift
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        (crc_fold(id_col, FOLDS) == HELD_OUT).alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
