"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bounded-space online best-fit: a packer keeps a fixed number of open bins.
A bitset keyed by free space finds the fullest bin that still takes a
piece; when none does and the bins are all open, the fullest closes.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairn.llm.components import kept
from cairn.llm.words import byte_letters, small_batches

CAPACITY = 2048
OPEN_BINS = 512
PIECES_PER_PACKER = 50_000  # narrow rows that one task packs; a task leaves at most OPEN_BINS bins unfilled
MARK = "\x80"              # ends a word for the rank tables; two bytes
LATIN = 0x250               # code points before this, but for MARK and these, have one lower case, normal form and class in all libraries
PLAIN = re.compile(rf"[\x1c-\x1f{MARK}\x85\u0130{chr(LATIN)}-\U0010ffff]")
# Fixed value: how word vocabularies of this kind split texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _latin_split() -> re.Pattern:
    """SPLIT for Latin texts, with classes spelt out and letters, the commonest, first; no two alternatives share a start but the last."""
    of = {k: "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    return re.compile(rf"[{of['L']}]+|'s|'t|'re|'ve|'m|'ll|'d|[{of['N']}]|[^\s{of['L']}{of['N']}]+")


class WordEncoder:
    """Token ids of texts, equal to those of the tokenizer at ``path``.

    A vocabulary of lower-cased words with a closing suffix is turned into
    byte ranks, the suffix being a mark that merges before all else, and Latin texts
    are encoded by the faster rank merging.  All else, and any other kind of
    tokenizer, is encoded as it is.  Nothing is remembered between texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.split = self._pattern(spec)
        if not self.split:
            return
        import tiktoken
        letter = byte_letters()
        suffix = spec["model"]["end_of_word_suffix"]
        self.special = special = {t["content"] for t in spec["added_tokens"]}

        def as_bytes(piece: str) -> bytes:
            core = piece.removesuffix(suffix)
            return bytes(letter[c] for c in core) + (MARK.encode() if core != piece else b"")

        single = [bytes([b]) for b in range(256)]
        mark = MARK.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        order = single + [mark[:k] for k in range(2, len(mark) + 1)] + [x + mark for x in single] + [as_bytes(x + y) for x, y in pairs]
        ids = {as_bytes(p): i for p, i in spec["model"]["vocab"].items() if p not in special}
        self.ids = np.array([ids.get(x, 0) for x in order], "<u4")
        self.ranks = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks={x: r for r, x in enumerate(order)},
                                       special_tokens={})

    @staticmethod
    def _pattern(spec: dict):
        """The splitting pattern, if the file is of the kind that ranks can express."""
        normal = [(x["type"], x.get("pattern"), x.get("content")) for x in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (normal != [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
                or [x["type"] for x in steps] != ["Split", "ByteLevel"] or steps[0]["behavior"] != "Removed" or not steps[0]["invert"]
                or steps[1]["add_prefix_space"] or steps[1]["use_regex"] or not spec["model"].get("end_of_word_suffix")):
            return None
        return _latin_split() if steps[0]["pattern"] == {"Regex": SPLIT} else None

    def __call__(self, text: str) -> np.ndarray:
        if not self.split or PLAIN.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        words = self.split.findall(text.lower())
        return self.ids[self.ranks.encode_ordinary(MARK.join(words) + MARK)] if words else np.empty(0, "<u4")


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder; its size is the vocabulary's."""
    return WordEncoder(path)


def _ids(texts: pa.Array, path: str):
    """Token ids of every text and its closing id 0, as uint32 arrays."""
    encode = word_encoder(path)
    for text in texts:
        yield np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4")


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's ids, then id 0, cut only where longer than ``capacity``."""
    def run(batches):
        for batch in small_batches(batches, 1):
            out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, ids in zip(batch.column(0).to_pylist(), _ids(batch.column(1), tokenizer_path), strict=True):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    for c, v in zip(out, (doc, piece, start, len(part), zlib.crc32(part.tobytes()),
                                          part.tolist() if with_ids else None), strict=True):
                        out[c].append(v)
            kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
            if with_ids:
                kinds["ids"] = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in kinds.items()], names=list(kinds))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, PIECES + (", ids array<long>" if with_ids else "")))


class BestFit:
    """Online packer with at most ``open_bins`` bins open; ``place`` gives (bin, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0           # bit f is set when an open bin has f free places
        self.open = self.bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1     # the fullest bin that takes it
            b = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)   # the fullest bin of all closes
            b, free = self.bins, self.capacity
            self.bins += 1
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.bits |= 1 << left
            self.open += 1
        return b, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         per_packer: int = PIECES_PER_PACKER) -> DataFrame:
    """``pieces`` with sequence_id and offset.  Pieces are dealt to packers by a hash, as many as their count asks for."""
    packers = max(1, -(-pieces.count() // per_packer))

    def run(key, frame):
        packer = BestFit(capacity, open_bins)
        frame = frame.sort_values(["ids_crc32", "doc_id", "piece"], ignore_index=True)     # a fixed, shuffled order
        places = [packer.place(n) for n in frame["length"].tolist()]
        return frame.drop(columns="packer").assign(
            sequence_id=[int(key[0]) * (1 << 32) + b for b, _ in places], offset=[o for _, o in places])

    dealt = pieces.withColumn("packer", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(packers)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("packer").applyInPandas(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and with ``with_ids`` the ids).

    A document is its token ids and then id 0; only one longer than
    ``capacity`` is cut.  Pieces of a sequence lie from offset 0 without
    gaps.  A packer takes its pieces in the order of a checksum, so as they
    come, whatever the table's order.  A null or empty text is the single
    id 0.  Repeated rows are packed each; a null id stays
    null.  Other columns are ignored, and an empty table gives none.
    """
    return pack(kept(token_pieces(docs, tokenizer_path, capacity, id_col, text_col, with_ids)), capacity, open_bins)
