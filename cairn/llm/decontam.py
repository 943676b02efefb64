"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a text with at most e edits, cut into e + 1
pieces, has one piece there unchanged.  An automaton finds the pieces; the
stretch of text around each hit is verified with Myers' bit-parallel edit
distance.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairn.llm.words import small_batches

ERROR_SHARE = 0.05          # edits allowed per character of an item
LEAST_CHARS = 20            # items shorter than this, normalised, are searched without edits and as whole words
GROUP_BYTES = 32 << 20      # item text that one pass broadcasts; more items are searched in further passes


def normalised(text: str | None) -> str:
    """Lower case, runs of white space as one space, trimmed."""
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): the item cut into errors + 1 pieces of almost the same length."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end): the least edit distance of the whole pattern to any substring of text, and where the first such ends."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def whole_words(text: str, start: int, end: int) -> bool:
    """Neither end of the stretch parts two letters or digits."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum() for at in (start, end))


class Matcher:
    """Finds items with at most their error budget in normalised texts; short ones have none and match whole words."""

    def __init__(self, items: list[tuple[int, str]], error_share: float = ERROR_SHARE):
        self.items = [(i, t, int(len(t) * error_share) if len(t) >= LEAST_CHARS else 0) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t, errors) in enumerate(self.items):
            for offset, piece in pieces(t, errors):
                where.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Stretches of text that may hold each item, overlapping ones merged."""
        hits: dict[int, list[tuple[int, int]]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                _, item, errors = self.items[k]
                start = last + 1 - size - offset
                if len(item) < LEAST_CHARS and not whole_words(text, start, last + 1):
                    continue
                hits.setdefault(k, []).append((max(0, start - errors), min(len(text), start + len(item) + errors)))
        out = {}
        for k, found in hits.items():
            merged: list[list[int]] = []
            for a, b in sorted(found):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            out[k] = merged
        return out

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best place of every item that occurs, the first such place."""
        if self.empty or not text:
            return []
        out = []
        for k, stretches in self.windows(text).items():
            item_id, item, errors = self.items[k]
            best = min(((*myers(item, text[a:b]), a) for a, b in stretches), key=lambda x: (x[0], x[2]))
            if best[0] <= errors:
                end = best[2] + best[1]
                low = max(0, end - len(item) - errors)
                _, back = myers(item[::-1], text[low:end][::-1])
                out.append((item_id, best[0], end - back, end))
        return out


def _item_groups(benchmark: DataFrame, item_col: str, text_col: str):
    """Lists of (item_id, normalised text), each within the broadcast bound."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    groups = -(-size // GROUP_BYTES)
    for g in range(groups):
        some = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(groups)) == g) if groups > 1 else items
        found = sorted({(r.i if r.i is not None else -1, normalised(r.t)) for r in some.collect()})
        yield [x for x in found if x[1]]


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_share: float = ERROR_SHARE, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, start, end): a row for each benchmark item that a document's whole text holds.

    Texts are compared in lower case with single spaces; start and end are
    places in such a text, of the occurrence with the fewest edits (of
    equal ones the first).  Items of fewer than LEAST_CHARS characters are
    found only as whole words without edits; null and empty items are left out; an item without id counts as item -1.  Null
    and empty texts hold nothing; repeated rows and rows without id are
    searched each.  Either table may be empty.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, distance int, start int, end int"
    found = []
    for items in _item_groups(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, error_share)
            for batch in small_batches(batches, 1):
                rows = [(doc, *m) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                        for m in matcher.matches(normalised(text))]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), *[pa.int32()] * 3], strict=True)],
                    names=["doc_id", "item_id", "distance", "start", "end"])

        found.append(texts.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_share: float = ERROR_SHARE, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, without the rows whose text holds a benchmark item; cases as in ``find_leaks``."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    for items in _item_groups(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, error_share)
            for batch in small_batches(batches, at):
                clean = [not matcher.matches(normalised(t)) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
