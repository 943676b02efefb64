"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes.  Failure links name the state that
remains when the longest token at the front of a state's string is popped,
again and again, and each link keeps how many tokens are popped.  One pass
over a word's bytes then gives the length of its greedy longest-match
segmentation, and no piece is ever built.
"""

from __future__ import annotations

import json
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cairn.llm.words import split_words

WORD_START = "Ġ"       # fixed value: how the vocabulary writes the blank before a word


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in that a byte-level vocabulary uses for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """(tokens that begin a word, tokens that go on with one) of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["model"]["vocab"]
    alphabet = _byte_alphabet()
    starts, inner = [], []
    for t in tokens:
        body = t.removeprefix(WORD_START)
        if body and all(c in alphabet for c in body):
            (starts if body != t else inner).append(bytes(alphabet[c] for c in body))
    return starts, inner


class LongestMatch:
    """Greedy longest-match lengths of words.

    A word's first token is taken from ``starts``, the others from
    ``inner``; where no token of ``starts`` fits, the word's first token is
    the blank alone and the rest is matched from ``inner``.  A byte without
    a token of its own counts as one token.
    """

    ROOT = 0                # of inner tokens

    def __init__(self, starts: list[bytes], inner: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        token = [False]

        def add(root: int, string: bytes, is_token: bool = True):
            v = root
            for c in string:
                if c not in self.next[v]:
                    self.next[v][c] = len(self.next)
                    self.next.append({})
                    token.append(False)
                v = self.next[v][c]
            token[v] = token[v] or is_token

        for t in sorted(set(inner)):
            add(self.ROOT, t)
        for c in range(256):
            add(self.ROOT, bytes([c]))
        self.start = len(self.next)     # stands for the blank, a token
        self.next.append({})
        token.append(True)
        for t in sorted(set(starts)):
            add(self.start, t)

        # Links in breadth-first order: a token pops itself; any other state goes on from its parent's link.
        self.fail = [0] * len(self.next)
        self.pops = [0] * len(self.next)
        self.fail[self.start], self.pops[self.start] = self.ROOT, 1
        todo = deque((u, c, v) for u in (self.ROOT, self.start) for c, v in self.next[u].items())
        while todo:
            u, c, v = todo.popleft()
            if token[v]:
                self.fail[v], self.pops[v] = self.ROOT, 1
            else:
                w, popped = self.fail[u], self.pops[u]
                while c not in self.next[w]:    # the root has every byte
                    popped += self.pops[w]
                    w = self.fail[w]
                self.fail[v], self.pops[v] = self.next[w][c], popped
            todo.extend((v, d, x) for d, x in self.next[v].items())

    def count(self, word: bytes) -> int:
        """Tokens of one word."""
        if not word:
            return 0
        nexts, fail, pops = self.next, self.fail, self.pops
        v, n = self.start, 0
        for c in word:
            while (u := nexts[v].get(c)) is None:
                n += pops[v]
                v = fail[v]
            v = u
        while v != self.ROOT:
            n += pops[v]
            v = fail[v]
        return n


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_bytes (of words) and n_tokens of every whole text of ``docs``.

    A null or empty text has none of each.  Repeated rows and null ids are
    counted one by one; other columns are ignored; an empty table gives none.
    The vocabulary is a file of fixed size, broadcast as its tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches):
        automaton = LongestMatch(*shared.value)
        for batch in batches:
            out = {"n_words": [], "n_bytes": [], "n_tokens": []}
            for part in split_words(batch.column(1), lower=False):
                size = pc.binary_length(part.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
                tokens = np.fromiter((automaton.count(w) for w in part.vocab.cast(pa.binary()).to_pylist()), np.int64, len(part.vocab))
                for c, each in (("n_words", np.ones_like(size)), ("n_bytes", size), ("n_tokens", tokens)):
                    total = np.concatenate([[0], np.cumsum(each[part.codes])])
                    out[c].append(total[part.offsets[1:]] - total[part.offsets[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.concatenate([np.empty(0, np.int64), *v])) for v in out.values())],
                names=["doc_id", *out])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_bytes long, n_tokens long"))
