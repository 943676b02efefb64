"""Language-model scoring with a log-frequency Bloom filter.

Every chunk of texts sends its distinct unigrams and bigrams, with their
counts in training texts, to the bucket of their hash.  There the counts of
all chunks are summed and kept as their logarithm: the bucket's segment of
the filter holds (n-gram, 1) ... (n-gram, q) for the quantised count q, so
probing level after level until one is missing gives q back.  A segment is
sized by its own entries, so the filter grows with the corpus and holds
every n-gram, those seen once included.

The filter is broadcast to the workers, which probe it for every text's
n-grams and score from smoothed probabilities.  Its size is worked out
before it is built, from an exact count in one SLICE-th of the hash space; beyond
``broadcast_bytes`` each bucket probes its segment for the chunks' n-grams
and sends the levels back instead.  The segments are the same, and so are the scores.

The add-one base score needs exact counts; the buckets send those of the
words along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cairn.llm.components import kept
from cairn.llm.folds import crc_fold
from cairn.llm.words import hash_words, mix, split_words

FOLDS, HELD_OUT = 7, 2
BITS_PER_ENTRY = 10
PROBES = 3
PRIOR = 200.0               # pseudo-counts of the unigram model in a bigram probability
BROADCAST_BYTES = 32 << 20  # of the filter; a larger one is probed where it is built
SLICE = 64                  # the filter's entries are counted beforehand in one of so many parts of the hash space
COUNTED_AT_ONCE = 3_200_000  # n-grams of the texts that are handled as one chunk
PART_BITS = 36              # a chunk's key is its partition and, in so many bits, its place there
BUCKET_BYTES = 16 << 20     # text whose n-grams meet in one counting group

END = np.uint64(0x5DEECE66D1CE4E5B)         # the token that closes a text
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _bigrams(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _PAIR + second)


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.empty(0, np.int64)


def _batch(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], names=list(schema))


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Compressed byte planes with the length before them; ascending unsigned values as their differences."""
    if ascending:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _opened(data: bytes, dtype, ascending: bool = False) -> np.ndarray:
    n, dtype = int.from_bytes(data[:8], "little"), np.dtype(dtype)
    planes = np.frombuffer(pa.decompress(data[8:], n * dtype.itemsize, codec="zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if ascending else values


CHUNKS = "chunk long, doc_ids array<long>, folds array<long>, sizes array<long>, vocab binary, codes binary"
_CHUNK = {"chunk": pa.int64(), "doc_ids": pa.list_(pa.int64()), "folds": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()),
          "vocab": pa.binary(), "codes": pa.binary()}


def _chunks(batches):
    """Texts as word codes: a row for each chunk, with the sorted hashes of its words and every text's number of tokens."""
    chunk = TaskContext.get().partitionId() << PART_BITS
    ids, folds, sizes, words = [], [], [], []
    tokens = 0

    def flush():
        vocab, codes = np.unique(np.concatenate(words), return_inverse=True)
        row = (chunk, sum(ids, []), sum(folds, []), np.concatenate(sizes), _packed(vocab, True), _packed(codes.astype("<u4")))
        for x in (ids, folds, sizes, words):
            x.clear()
        return _batch(_CHUNK, [row])

    for batch in batches:
        for part in split_words(batch.column("text")):
            texts = part.stop - part.start
            size = np.diff(part.offsets) + 1
            w = np.full(size.sum(), END)            # every text is followed by its closing token
            w[np.arange(len(part.codes)) + np.repeat(np.arange(texts), size - 1)] = hash_words(part.vocab, 11)[part.codes]
            ids.append(batch.column("doc_id").slice(part.start, texts).to_pylist())
            folds.append(batch.column("fold").slice(part.start, texts).to_pylist())
            sizes.append(size)
            words.append(w)
            tokens += len(w)
            if 2 * tokens >= COUNTED_AT_ONCE:
                yield flush()
                chunk += 1
                tokens = 0
    if tokens:
        yield flush()


def _unpacked(sizes, vocab: bytes, codes: bytes) -> tuple[np.ndarray, ...]:
    """Tokens of each text, word hashes, word code of every token, the tokens that start a text, and those with one before them."""
    sizes = np.asarray(sizes, np.int64)
    vocab = _opened(vocab, np.uint64, True)
    w = _opened(codes, "<u4").astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    after = np.ones(len(w), bool)
    after[starts] = False
    return sizes, vocab, w, starts, np.flatnonzero(after)


GRAMS = "chunk long, bucket int, kind int, grams binary, counts binary"
_GRAM = {"chunk": pa.int64(), "bucket": pa.int32(), "kind": pa.int32(), "grams": pa.binary(), "counts": pa.binary()}


def _grams(shift: int, held_out: int):
    """Distinct n-grams of each chunk in the order of their hashes, with their counts in training texts, a row per bucket: kind 1 unigrams, 2 bigrams."""
    def run(batches):
        for batch in batches:
            for chunk, folds, sizes, vocab, codes in zip(*(batch.column(c).to_pylist() for c in ("chunk", "folds", "sizes", "vocab", "codes")),
                                                         strict=True):
                sizes, vocab, w, _, after = _unpacked(sizes, vocab, codes)
                learns = np.repeat(np.asarray(folds) != held_out, sizes)
                pairs, which = np.unique(_bigrams(vocab[w[after - 1]], vocab[w[after]]), return_inverse=True)
                rows = []
                for kind, grams, counts in ((1, vocab, np.bincount(w[learns], minlength=len(vocab))),
                                            (2, pairs, np.bincount(which[learns[after]], minlength=len(pairs)))):
                    counts = counts.astype("<u4")
                    buckets = _segment(grams, shift).astype(np.int64)
                    cuts = [*_runs(buckets), len(grams)]
                    rows += [(chunk, int(buckets[a]), kind, _packed(grams[a:b], True), _packed(counts[a:b]))
                             for a, b in zip(cuts, cuts[1:], strict=False)]
                yield _batch(_GRAM, rows)
    return run


def _levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 for 1, 2 for 2 and 3, 3 for 4 to 7, ..."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def _count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level, 0 for none."""
    return np.where(level > 0, 1.5 * 2.0 ** (level - 1) - 0.5, 0.0)


def _segment(grams: np.ndarray, shift: int) -> np.ndarray:
    """Counting bucket of each n-gram: the top bits of its hash."""
    return grams >> np.uint64(shift) if shift < 64 else np.zeros(len(grams), np.uint64)


def _positions(grams: np.ndarray, kind: int, level: int, probe: int, width: int) -> np.ndarray:
    """Bit that a probe of (n-gram, level) reads, in the ``width`` bits of the n-gram's segment."""
    salt = ((kind << 56) | (level << 48) | (probe << 40) | 0x5BD1E995) * int(_PAIR) % (1 << 64)
    return mix(grams ^ np.uint64(salt)) & np.uint64(width - 1)


def _levels_in(table: np.ndarray, shift: int, grams: np.ndarray, kind: int, least: int = 1) -> np.ndarray:
    """Quantised counts by repeated membership probes, level by level until one is missing."""
    width = 8 * len(table) >> (64 - shift)
    out = np.zeros(len(grams), np.int64)
    alive = np.arange(len(grams))
    base = _segment(grams, shift) * np.uint64(width)
    level = least
    while len(alive):
        for probe in range(PROBES):
            at = base[alive] + _positions(grams[alive], kind, level, probe, width)
            alive = alive[(table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        out[alive] = level
        level += 1
    return out


def _fill(width: int, least: int):
    """The segment of each bucket's n-grams, and the byte of the filter where it lies."""
    def run(batches):
        for batch in batches:
            at, parts = [], []
            for bucket, kind, grams, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "grams", "counts")),
                                                   strict=True):
                grams = np.frombuffer(grams, np.uint64)
                levels = _levels(np.frombuffer(counts, np.int64))
                bits = np.zeros(width, bool)
                for level in range(1 if kind == 1 else least, int(levels.max(initial=0)) + 1):
                    some = grams[levels >= level]
                    for probe in range(PROBES):
                        bits[_positions(some, kind, level, probe, width)] = True
                at.append(bucket * width // 8)
                parts.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(parts, pa.binary())], names=["at", "part"])
    return run


ANSWERED = "chunk long, bucket int, kind int, levels binary, counts binary, segment binary, tokens long, distinct long"
_ANSWER = {"chunk": pa.int64(), "bucket": pa.int32(), "kind": pa.int32(), "levels": pa.binary(), "counts": pa.binary(),
           "segment": pa.binary(), "tokens": pa.int64(), "distinct": pa.int64()}
SEGMENT = -1                # the chunk of a row that holds a segment and the bucket's sums


def _answer(probe: bool):
    """A bucket's segment of the filter, with the bucket's sums, and for each chunk the exact counts of its words and, if ``probe``,
    what the segment gives for its n-grams; otherwise the segment itself goes out."""
    def run(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
        bucket, kind = (k.as_py() for k in key)
        parts = [_opened(x, np.uint64, True) for x in asked.column("grams").to_pylist()]
        counts = np.concatenate([_opened(x, "<u4") for x in asked.column("counts").to_pylist()])
        grams, which = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(which, counts).astype(np.int64)
        entries = int(_levels(counts).sum())
        width = 1 << max(3, (entries * BITS_PER_ENTRY - 1).bit_length())
        whole = _batch({c: _GRAM[c] for c in ("bucket", "kind", "grams", "counts")}, [(0, kind, grams.tobytes(), counts.tobytes())])
        segment = next(_fill(width, 1)([whole])).column("part")[0].as_py()
        rows = [(SEGMENT, bucket, kind, None, None, None if probe else segment, int(counts.sum()), int((counts > 0).sum()))]
        levels = _levels_in(np.frombuffer(segment, np.uint8), 64, grams, kind).astype(np.uint8) if probe else None
        a = 0
        for chunk, part in zip(asked.column("chunk").to_pylist(), parts, strict=True):
            mine = which[a:a + len(part)]
            a += len(part)
            if probe or kind == 1:
                rows.append((chunk, bucket, kind, _packed(levels[mine]) if probe else None, _packed(counts[mine]) if kind == 1 else None, None, 0, 0))
        return pa.Table.from_batches([_batch(_ANSWER, rows)])
    return run


def _probed(filters: dict, shift: int, grams: np.ndarray, kind: int) -> np.ndarray:
    """Levels of sorted n-grams from the broadcast segments."""
    buckets = _segment(grams, shift).astype(np.int64)
    cuts = [*_runs(buckets), len(grams)]
    return np.concatenate([np.empty(0, np.int64), *(_levels_in(filters[kind, int(buckets[a])], 64, grams[a:b], kind)
                                                    for a, b in zip(cuts, cuts[1:], strict=False))])


def _sliced(held_out: int):
    """N-grams of one part of the hash space, with their counts in each chunk's training texts."""
    def run(batches):
        for batch in batches:
            for folds, sizes, vocab, codes in zip(*(batch.column(c).to_pylist() for c in ("folds", "sizes", "vocab", "codes")), strict=True):
                sizes, vocab, w, _, after = _unpacked(sizes, vocab, codes)
                learns = np.repeat(np.asarray(folds) != held_out, sizes)
                found = []
                for kind, grams in ((1, vocab[w[learns]]), (2, _bigrams(vocab[w[after - 1]], vocab[w[after]])[learns[after]])):
                    some, n = np.unique(grams[mix(grams) < np.uint64((1 << 64) // SLICE)], return_counts=True)
                    found.append((np.full(len(some), kind, np.int32), some.view(np.int64), n))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["kind", "gram", "n"])
    return run


def filter_bytes(chunks: DataFrame, held_out: int) -> int:
    """About the size of the filter, before its segments are rounded up to powers of two."""
    counts = chunks.mapInArrow(_sliced(held_out), "kind int, gram long, n long").groupBy("kind", "gram").agg(F.sum("n").alias("n"))
    return SLICE * (counts.agg(F.sum(F.length(F.bin("n")))).first()[0] or 0) * BITS_PER_ENTRY // 8


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(total: int, distinct: int, held_out: int, shift: int, sent=None):
    """Every text of a chunk: levels by probing the broadcast filter ``sent``, or from the answers to its n-grams."""
    floor = np.log10(total + distinct + 1)

    def run(key, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        ids, folds, sizes, vocab, codes = (chunk.column(c)[0].as_py() for c in ("doc_ids", "folds", "sizes", "vocab", "codes"))
        sizes, vocab, w, starts, after = _unpacked(sizes, vocab, codes)
        found = sorted(zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "levels", "counts")), strict=True), key=lambda x: x[:2])

        def joined(kind, column, dtype):    # buckets are ranges of the hash, so in their order the answers follow the sorted n-grams
            return np.concatenate([np.empty(0, dtype), *(_opened(x[column], dtype) for x in found if x[0] == kind)])

        def levels(kind, grams):
            return _probed(sent.value, shift, grams, kind) if sent else joined(kind, 2, np.uint8).astype(np.int64)

        exact = joined(1, 3, np.int64)
        smooth = _count_of(levels(1, vocab))
        uni = np.log10(smooth + 1) - floor
        grams, which = np.unique(_bigrams(vocab[w[after - 1]], vocab[w[after]]), return_inverse=True)
        pairs = _count_of(levels(2, grams))[which]
        log_p = uni[w]
        before = np.maximum(smooth[w[after - 1]], pairs)
        log_p[after] = np.log10((pairs + PRIOR * (10.0 ** uni)[w[after]]) / (before + PRIOR))
        known_log = np.add.reduceat(np.log10(exact + 1)[w], starts)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(np.asarray(folds) == held_out), "n_tokens": sizes,
                         "n_known": np.add.reduceat((exact > 0)[w].astype(np.int64), starts),
                         "train_tokens": np.full(len(sizes), total, np.int64),
                         "base_score": known_log - sizes * floor, "score": np.add.reduceat(log_p, starts)})
    return run


def score_texts(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, id_col: str = "doc_id",
                text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Learns from the rows whose crc32 of the id as text, modulo ``folds``, is
    not ``held_out``.  A-Z are lower-cased; tokens are the words and one
    closing token, so a null or empty text has one.  base_score is the
    add-one unigram log10 probability from exact counts, score that of the
    smoothed bigram model.  A null id counts as an empty one for the fold.
    Repeated rows are counted and scored each.  Without training rows
    nothing is known.  Other columns are ignored; an empty table gives none.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), crc_fold(id_col, folds).alias("fold"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shift = 64 - max(0, (size // BUCKET_BYTES).bit_length())
    chunks = kept(docs.mapInArrow(_chunks, CHUNKS))
    packets = chunks.mapInArrow(_grams(shift, held_out), GRAMS).groupBy("bucket", "kind")
    sent = None
    if filter_bytes(chunks, held_out) <= broadcast_bytes:
        answers = kept(packets.applyInArrow(_answer(False), ANSWERED))
        parts = answers.where("segment is not null").select("kind", "bucket", "segment")
        if (parts.agg(F.sum(F.octet_length("segment"))).first()[0] or 0) <= 2 * broadcast_bytes:    # the rounding at most doubles it
            sent = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["bucket"]): np.frombuffer(r["segment"], np.uint8) for r in parts.collect()})
    if sent is None:
        answers = kept(packets.applyInArrow(_answer(True), ANSWERED))
    total, distinct = (x or 0 for x in answers.where(f"kind = 1 and chunk = {SEGMENT}").agg(F.sum("tokens"), F.sum("distinct")).first())
    replies = answers.where(f"chunk != {SEGMENT}").select("chunk", "bucket", "kind", "levels", "counts")
    return (chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_score(total, distinct, held_out, shift, sent), SCORED))
