"""Random-indexing vectors: pieces and sums against plain loops, layouts, and what the vectors add to the classifier."""

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from llm_data import docs_of, documents, odd_rows  # noqa: F401

from cairn.llm import quality_model as q
from cairn.llm.folds import crc_fold
from cairn.llm.labelled import FOLDS, HELD_OUT
from cairn.llm.words import hash_words, split_words

LARGE = "/root/testdata/sf0.1"
TEXTS = ["The cat, THE cat -- A X12%%% 007 ||| naïve", "", " \n", None, "one", "WOW!!! wow!! ... é́té 日本 \U0001f600\U0001f600", "a b a b a b c"]


def plain_pieces(text):
    """Kind and text of the pieces of each word, one character at a time."""
    out = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        letter = [unicodedata.category(c)[0] in "LMN" for c in word]
        bare = "".join(c for c, is_letter in zip(word, letter, strict=True) if is_letter)
        if len(bare) > 1 and bare.isupper():
            out.append((q.CAPITALS, "^"))
        if bare:
            out.append((q.LETTERS, re.sub(r"(?:0)+", "0", "".join("0" if unicodedata.category(c)[0] == "N" else c for c in bare.lower()))))
        marks = "".join(c for c, is_letter in zip(word, letter, strict=True) if not is_letter)
        if marks:
            kept = [c for i, c in enumerate(marks) if i < 2 or not marks[i] == marks[i - 1] == marks[i - 2]]
            out.append((q.SIGNS, "".join(kept)))
    return out


def plain_rows(text):
    return [int(hash_words(pa.array([p]), kind)[0] % np.uint64(q.ROWS)) for kind, p in plain_pieces(text)]


def test_pieces_as_by_hand():
    for texts in (TEXTS, [], [None], ["", ""]):
        got = []
        for part in split_words(pa.array(texts, pa.string()), lower=False, limit=40):
            rows, offsets = q.piece_rows(part)
            got += [rows[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert got == [plain_rows(t) for t in texts]


def test_vectors_as_by_hand_for_any_layout(spark, docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] not in (7, 8)] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    places, signs = q.index_vectors()
    total = np.zeros((q.ROWS, 1 + q.DIM), np.int64)
    for _, text in rows:
        seq = plain_rows(text)
        for i, r in enumerate(seq):
            total[r, 0] += 1
            for j in range(max(0, i - q.REACH), min(len(seq), i + q.REACH + 1)):
                if j != i:
                    for place, sign in zip(places[seq[j]], signs[seq[j]], strict=True):
                        total[r, 1 + place] += int(sign)
    want = q.finished(total)
    for parts in (1, 5):
        got = q.word_vectors(docs_of(rows).repartition(parts))
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert not q.word_vectors(docs_of([]))[0].any()


def test_pooling_as_by_hand():
    r = np.random.default_rng(0)
    vectors, weights = r.normal(0, 1, (q.ROWS, q.DIM)).astype(np.float32), r.uniform(0.1, 1, q.ROWS).astype(np.float32)
    got = q.pooled(pa.array(TEXTS), (vectors, weights))
    for text, x in zip(TEXTS, got, strict=True):
        seq = plain_rows(text)
        if not seq:
            assert not x.any()
            continue
        w, v = weights[seq][:, None].astype(float), vectors[seq].astype(float)
        near = np.vstack([v[:-1] * v[1:], np.zeros((1, q.DIM))])
        mean = (w * v).sum(0) / w.sum()
        spread = np.sqrt(np.maximum((w * v * v).sum(0) / w.sum() - mean ** 2, 0))
        assert np.allclose(x, np.concatenate([mean, spread, (w * near).sum(0) / w.sum()]), atol=2e-3)


def held_out(x, y, held):
    net = q.Network(q.POOLED)
    net.fit(x[~held], y[~held])
    return ((net.logits(x[held]) >= 0) == y[held]).mean()


def random_like(table):
    """Vectors of random directions for the same rows, with the same weights."""
    return q.unit(np.random.default_rng(5).normal(0, 1, table[0].shape)).astype(np.float32), table[1]


def test_context_vectors_beat_random_ones(spark):
    docs, labels = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")
    table = q.word_vectors(docs)
    some = (docs.join(labels, "doc_id").where("text is not null")
            .select("text", "quality", (crc_fold("doc_id", FOLDS) == HELD_OUT).alias("held")).orderBy("doc_id").toArrow())
    y, held = some.column(1).to_numpy().astype(float), some.column(2).to_numpy().astype(bool)
    texts = some.column(0)
    own, other = (held_out(q.pooled(texts, t).astype(float), y, held) for t in (table, random_like(table)))
    assert own >= 0.995 and own > other


def test_words_without_labels_are_known_by_their_contexts(spark, docs_of):
    """Labelled texts hold one half of the good and bad words, held-out texts the other; only contexts tie the halves."""
    r = np.random.default_rng(1)
    kinds = {k: [f"{k}{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(5)] for k in ("good", "bad")}

    def text(kind, words):
        frame = {"good": ["calm", "clear", "kind"], "bad": ["loud", "messy", "rude"]}[kind]
        return " ".join(w for x in r.choice(words, 12) for w in (frame[r.integers(3)], x, frame[r.integers(3)]))

    corpus = [(i, text(k, kinds[k])) for i, k in enumerate(["good", "bad"] * 400)]
    table = q.word_vectors(docs_of(corpus))
    y = np.arange(200) % 2.0
    held = np.arange(200) >= 100
    texts = pa.array([" ".join(r.choice(kinds["good" if k else "bad"][20 * h:20 * h + 20], 6)) for k, h in zip(y, held, strict=True)])
    own, other = (held_out(q.pooled(texts, t).astype(float), y, held) for t in (table, random_like(table)))
    assert own > 0.95 and other < 0.75


def test_network_gradient_lowers_the_loss_and_temperature_calibrates():
    r = np.random.default_rng(4)
    x = r.normal(0, 1, (600, 5))
    y = (r.random(600) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = q.Network(5)
    net.fit(x[:300], y[:300])

    def loss(t):
        z = net.logits(x[300:]) / t
        return np.logaddexp(0, np.where(y[300:] == 1, -z, z)).mean()
    net.calibrate(x[300:], y[300:])
    assert loss(net.temperature) <= min(loss(t) for t in (0.25, 0.5, 1, 2, 4, 8, 16)) + 1e-3
    assert net.temperature > 1 and loss(net.temperature) < np.log(2)
    assert pytest.approx(loss(1e9)) == np.log(2)
