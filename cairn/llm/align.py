"""Alignment of two tokenizers' tokens over the same bytes by diagonal run skipping.

Both token sequences become arrays of byte ends.  While tokens correspond
one to one, the arrays are equal along a diagonal (a fixed shift between the
indices), so after a few single steps exponential probing compares ever
longer stretches and jumps them.  Where they part, the irregular group is resolved locally, token by
token, up to the next common end, which gives the new shift.

A task aligns chunks of texts and sends, of each chunk, only its distinct
linked id pairs with their counts.  Counts are summed over the corpus, every
B id's highest is marked, and the answers return to their chunks.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cairn.llm.components import kept, shared_folder
from cairn.llm.words import byte_letters, small_batches, text_chunks

STEPS = 16                                      # tokens of a diagonal compared one by one before stretches are
TOGETHER = 1 << 18                              # bytes of short texts aligned at once
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")     # such texts go to the tokenizer whose merging isn't quadratic


def stretches(a: list[int], b: list[int]) -> list[int]:
    """Three numbers for each stretch of groups, in order: its first index in ``a`` and its ends (exclusive) in ``a`` and ``b``.

    A stretch is a run of corresponding tokens, each a group, or what is skipped up to a common end and the token before it."""
    out: list[int] = []
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            first, width = i, 1
            i += 1
            j += 1
            near = min(first + STEPS, n)
            while i < near and a[i] == b[j]:                        # most runs are short
                i += 1
                j += 1
            if i == near:
                width = STEPS
                while i < n and a[i:i + width] == b[j:j + width]:   # probe along the diagonal, twice as far each time
                    step = min(width, n - i)
                    i += step
                    j += step
                    width *= 2
            while width > 1 and i < n:                              # the stretch that failed, by halves
                width //= 2
                if i + width <= n and a[i:i + width] == b[j:j + width]:
                    i += width
                    j += width
            out += first, i, j
        else:
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            out += i - 1, i, j
    return out


def group_ends(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive token indices in ``a`` and in ``b``) of the groups between common byte ends; the last ends are equal."""
    found = stretches(a, b)
    first, end_a, end_b = np.fromiter(found, np.int64, len(found)).reshape(-1, 3).T
    size = end_a - first
    ga = np.arange(1, size.sum() + 1) + np.repeat(end_a - np.cumsum(size), size)
    return ga, ga + np.repeat(end_b - end_a, size)


def align(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """``group_ends`` as lists."""
    ga, gb = group_ends(a, b)
    return ga.tolist(), gb.tolist()


class ByteLevel:
    """Ids of a byte-level vocabulary (side A), special strings as plain text, and every id's bytes.

    With the vocabulary's ``pattern`` for splitting texts, a faster library merges by rank, to the same ids; this
    needs ids in the order of the merges, as byte-level vocabularies have them."""

    def __init__(self, path: str, pattern: str | None = None):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        alphabet = byte_letters()
        vocab = self.whole.get_vocab(with_added_tokens=False)
        added = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        self.bytes = [b""] * (max(self.whole.get_vocab().values()) + 1)
        for piece, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in piece) if piece not in added else piece.encode()
        self.fast = None
        if pattern:
            import tiktoken
            ranks = {x: i for i, x in enumerate(self.bytes) if x and self.whole.id_to_token(i) not in added}
            self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or len(text) > 2000 and LONG_RUN.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Ids of a sentence-piece vocabulary (side B), which adds the leading space itself, and every id's bytes."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in range(n))]

    def ids(self, text: str) -> np.ndarray:
        return self.model.encode_as_numpy(text)


class Aligner:
    """Groups and linked id pairs of texts."""

    def __init__(self, path_a: str, path_b: str, pattern_a: str | None = None):
        self.a, self.b = ByteLevel(path_a, pattern_a), Pieces(path_b)
        self.size = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        names = [[str(i) for i in range(len(side.bytes))] for side in (self.a, self.b)]
        # A token as text with the sign after it, inside a group, then at its end; zeros fill it up to a common width.
        signs = [f"{x}{sign}".encode() for side, ends in zip(names, (",|", ",;"), strict=True) for sign in ends for x in side]
        width = -(-max(map(len, signs)) // 8)
        self.signs = np.array(signs, f"S{8 * width}").view(np.uint64).reshape(-1, width)
        self.begin = 2 * len(names[0])

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or nothing where a side's bytes aren't those of space + text."""
        if not text:
            return None
        whole = f" {text}".encode()
        a, b = self.a.ids(f" {text}"), self.b.ids(text)
        if b"".join(map(self.b.bytes.__getitem__, b.tolist())) != whole:
            return None
        a = np.fromiter(a, np.int64, len(a))
        # Byte-level tokens are cut from the text, so only a character without a token can be missing.
        if self.size[0][a].sum() != len(whole):
            return None
        return a, b.astype(np.int64)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return group_ends(*(np.cumsum(size[ids]).tolist() for size, ids in zip(self.size, (a, b), strict=True)))

    def coded(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> np.ndarray:
        """Every token's place among the signs, those of B after those of A in each group."""
        where = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ga - 1], last_b[gb - 1] = 1, 1
        of_a, of_b = (np.cumsum(last) - last for last in (last_a, last_b))
        where[np.arange(len(a)) + np.concatenate([[0], gb])[of_a]] = a + last_a * len(self.size[0])
        where[np.arange(len(b)) + ga[of_b]] = self.begin + b + last_b * len(self.size[1])
        return where

    def text_of(self, where: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` with decimal ids."""
        return self.signs.take(where, axis=0).tobytes().translate(None, b"\0")[:-1]

    def rows(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray]:
        """n_a, n_b, n_groups and groups_sha256 of each text, and the links of all as pairs, aligned as one long text:
        its parts end together on both sides, so no group is in two of them."""
        found = [self.tokens(text) for text in texts]
        full = [x for x in found if x is not None]
        if not full:
            return [(0, 0, 0, "")] * len(texts), np.empty(0, np.int64)
        a, b = (np.concatenate(side) for side in zip(*full, strict=True))
        ga, gb = self.groups(a, b)
        where = self.coded(a, b, ga, gb)
        out, at_a, at, done = [], 0, 0, 0
        for x in found:
            if x is None:
                out.append((0, 0, 0, ""))
                continue
            n_a, n_b = map(len, x)
            at_a += n_a
            groups = int(np.searchsorted(ga, at_a, side="right"))
            text = self.text_of(where[at:at + n_a + n_b])
            out.append((n_a, n_b, groups - done, hashlib.sha256(text).hexdigest()))
            at, done = at + n_a + n_b, groups
        return out, a[ga - 1] * len(self.size[1]) + b[gb - 1]


CHUNK = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
         "codes binary, pairs array<long>, counts array<long>")


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str, pattern_a: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """A row per chunk of texts: the documents' own columns, their links as codes in order, and the chunk's distinct
    pairs (A id * B vocabulary + B id) with counts, the commonest first."""
    def run(batches):
        aligner = None
        number = 0
        for batch in small_batches(batches, 1):
            aligner = aligner or Aligner(path_a, path_b, pattern_a)
            rows: dict[str, list] = {"doc_id": batch.column(0).to_pylist(), "n_a": [], "n_b": [], "n_groups": [], "groups_sha256": []}
            links = []
            for start, stop in text_chunks(batch.column(1), TOGETHER):
                found, pairs = aligner.rows(batch.column(1).slice(start, stop - start).to_pylist())
                links.append(pairs)
                for c, values in zip(("n_a", "n_b", "n_groups", "groups_sha256"), zip(*found, strict=True), strict=True):
                    rows[c] += values
            pairs, codes, counts = np.unique(np.concatenate([*links, np.empty(0, np.int64)]), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), "<u4")
            rank[order] = np.arange(len(order))
            packed = zstandard.ZstdCompressor(level=3).compress(rank[codes].tobytes())
            values = [[(TaskContext.get().partitionId() << 32) + number], *([c] for c in rows.values()),
                      [packed], [pairs[order]], [counts[order]]]
            number += 1
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()), pa.binary(), *[pa.list_(pa.int64())] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)],
                                             names=[c.split(" ")[0] for c in CHUNK.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, CHUNK)


def _sums(_key, chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """Per document of a chunk the number of links at their B id's highest count, and the sum of counts."""
    row = {c: chunk.column(c)[0] for c in chunk.column_names}
    codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["codes"].as_py()), "<u4")
    at = answers.column("code").to_numpy()
    total, best = np.zeros((2, len(at)), np.int64)
    total[at], best[at] = answers.column("total").to_numpy(), answers.column("best").to_numpy()
    n = np.array(row["n_groups"].as_py(), np.int64)
    ends = np.cumsum(n)

    def summed(values):
        s = np.concatenate([[0], np.cumsum(values[codes])])
        return pa.array(s[ends] - s[ends - n])

    plain = {c: pa.array(row[c].as_py(), pa.string() if c == "groups_sha256" else pa.int64())
             for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
    return pa.table({**plain, "n_links": plain["n_groups"], "n_best": summed(best), "count_sum": summed(total)}).select(
        [c.split(" ")[0] for c in RESULT.split(", ")])


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def linked_counts(chunks: DataFrame, width: int) -> DataFrame:
    """(pair, total, best): every linked pair's count over all chunks, best 1 where it is its B id's highest."""
    pairs = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    counts = kept(pairs.groupBy("pair").agg(F.sum("n").alias("total")))
    b = (F.col("pair") % width).alias("b")
    top = counts.groupBy(b).agg(F.max("total").alias("top"))        # a row per B id at most: the vocabulary's size
    return (counts.withColumn("b", b).join(F.broadcast(top), "b")
            .select("pair", "total", (F.col("total") == F.col("top")).cast("long").alias("best")))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, pattern_a: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """A row per document: tokens of both sides, groups, links, their counts over the corpus, and a digest of the groups.

    Side A is a byte-level vocabulary on space + text, side B a
    sentence-piece model on the text; ``pattern_a`` is A's splitting pattern,
    for speed only.  Groups lie between byte offsets where
    tokens of both sides end; the two tokens that end a group are linked.  No
    token is empty, so a group has one link.

    A null or empty text, or one whose bytes a side does not give back, has no
    tokens: zeros and an empty digest.  Texts of any length are taken whole; rows
    with the same id or text count each; a null id stays null; other columns
    are ignored; an empty table gives none.
    """
    path = shared_folder(docs.sparkSession, "aligned")
    aligned_chunks(docs, path_a, path_b, pattern_a, id_col, text_col).write.parquet(path)
    chunks = docs.sparkSession.read.parquet(path)
    marked = linked_counts(chunks, len(Pieces(path_b).bytes))
    asked = (chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "x"))
             .select("chunk", "code", F.col("x.pairs").alias("pair")))
    answers = asked.join(marked, "pair").select(F.col("chunk").alias("of"), F.col("code").cast("long").alias("code"), "total", "best")
    narrow = chunks.drop("pairs", "counts")
    return narrow.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_sums, RESULT)
