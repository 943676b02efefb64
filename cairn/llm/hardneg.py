"""Hard negatives of anchor vectors by exact integer scores with the method of the Four Russians.

Components become integers.  Every row keeps them as packed bit planes: a
byte holds one bit of eight neighbouring components.  For an anchor and a
group of eight components a table holds the sums of all 256 subsets of its
components, so a plane's bytes look their share of the inner product up,
and the planes are added by shifts.  The scores are exact, no pair of an
anchor and a row is left out, and a task keeps only the best of what it saw.

Anchors come in blocks of ANCHORS, the bound of what is broadcast; each
block passes over the packed rows twice, for its positives and then, with
their scores, for its negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cairn.llm.components import kept

SCALE = 256
ANCHORS = 16_384        # anchors of a block: 1.2 MB of planes at 64 components of 9 bits
TILE_ROWS, TILE_ANCHORS = 256, 512
CHUNK_ROWS = 8192       # rows that meet a tile's tables before the next tile's are built


def pack_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits, groups) bytes: bit j of byte g of plane p is bit p of component 8 g + j in two's complement."""
    planes = (values[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """The integers of ``pack_planes``, padded to whole groups."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.tensordot(weights, bits, axes=(0, 1))


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the anchor's components at its set bits."""
    groups = anchors.shape[1] // 8
    table = np.zeros((groups, 256, len(anchors)), dtype)
    parts = anchors.astype(dtype).reshape(len(anchors), groups, 8)
    for j in range(8):
        table[:, 1 << j:2 << j] = table[:, :1 << j] + parts[:, :, j].T[:, None, :]
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products: lookups per plane, planes added from the sign down by shifts."""
    total = np.zeros((len(planes), table.shape[2]), table.dtype)
    found = np.empty_like(total)
    for p in range(planes.shape[1] - 1, -1, -1):
        total += total
        for g in range(table.shape[0]):
            np.take(table[g], planes[:, p, g], axis=0, out=found)
            total += found
        if p == planes.shape[1] - 1:
            np.negative(total, out=total)
    return total


class Best:
    """The first ``k`` (score descending, id ascending) of every slot; ``bar`` is a full slot's last score."""

    def __init__(self, slots: int, k: int):
        self.k, self.bar = k, np.full(slots, np.iinfo(np.int64).min)
        self.slot = self.score = self.id = np.empty(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot = np.concatenate([self.slot, slot])
        score = np.concatenate([self.score, score.astype(np.int64)])
        ids = np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        some = rank < self.k
        self.slot, self.score, self.id = slot[some], score[some], ids[some]
        last = rank[some] == self.k - 1
        self.bar[self.slot[last]] = self.score[last]


def _integers(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v array<long>) of the rows that take part."""
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & sound)
            .withColumn("v", F.transform(v, lambda x: F.floor(SCALE * x))))


def _packed(ints: DataFrame, dim: int, bits: int) -> DataFrame:
    width = -(-dim // 8) * 8

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, len(batch), CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                values = np.zeros((len(part), width), np.int64)
                row = np.repeat(np.arange(len(part)), sizes)
                values[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
                planes = pack_planes(values, bits)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([p.tobytes() for p in planes], pa.binary())],
                                                 names=["id", "label", "planes"])

    return ints.mapInArrow(run, "id long, label long, planes binary")


def _chunks(batches, bits: int, groups: int):
    """(ids, labels, planes) of up to CHUNK_ROWS rows, sorted by label, small batches joined."""
    held: list[pa.RecordBatch] = []

    def out():
        t = pa.Table.from_batches(held)
        ids, labels = t.column("id").to_numpy(), t.column("label").to_numpy()
        planes = np.frombuffer(b"".join(t.column("planes").to_pylist()), np.uint8).reshape(len(ids), bits, groups)
        order = np.argsort(labels, kind="stable")
        return ids[order], labels[order], planes[order]

    for batch in batches:
        for at in range(0, len(batch), CHUNK_ROWS):
            held.append(batch.slice(at, CHUNK_ROWS))
            if sum(map(len, held)) >= CHUNK_ROWS:
                yield out()
                held.clear()
    if sum(map(len, held)):
        yield out()


def _anchor_tiles(label: np.ndarray, planes: np.ndarray, dtype, by_label: bool):
    """(first, stop, table) of anchor ranges, of one label each if ``by_label``; anchors are sorted by label."""
    edges = [0, len(label)]
    if by_label:
        edges = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), len(label)]
    for first, stop in zip(edges, edges[1:], strict=False):
        for at in range(first, stop, TILE_ANCHORS):
            end = min(at + TILE_ANCHORS, stop)
            yield at, end, subset_sums(unpack_planes(planes[at:end]), dtype)


def _best_of_tasks(df: DataFrame, slot: str, k: int) -> DataFrame:
    w = Window.partitionBy(slot).orderBy(F.col("score").desc(), "other")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _block(packed: DataFrame, block: list, bits: int, groups: int, dtype, positives: int, negatives: int,
           low: int, high: int) -> DataFrame:
    """Result rows of one block of anchors, given as (id, label, planes) rows."""
    sc = packed.sparkSession.sparkContext
    block = sorted(block, key=lambda r: r[1])
    ids, label = (np.array([r[c] for r in block], np.int64) for c in (0, 1))
    planes = np.frombuffer(b"".join(bytes(r[2]) for r in block), np.uint8).reshape(len(block), bits, groups)
    sent = sc.broadcast((ids, label, planes))

    def find_positives(batches):
        a_id, a_label, a_planes = sent.value
        best = Best(len(a_id), positives)
        for c_id, c_label, c_planes in _chunks(batches, bits, groups):
            for first, stop, table in _anchor_tiles(a_label, a_planes, dtype, True):
                lo, hi = np.searchsorted(c_label, [a_label[first], a_label[first] + 1])
                for at in range(lo, hi, TILE_ROWS):
                    end = min(at + TILE_ROWS, hi)
                    s = scores(table, c_planes[at:end])
                    r, a = np.nonzero((s >= best.bar[None, first:stop]) & (c_id[at:end, None] != a_id[None, first:stop]))
                    best.add(a + first, s[r, a], c_id[at:end][r])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.score, best.id)], names=["slot", "score", "other"])

    found = _best_of_tasks(packed.mapInArrow(find_positives, "slot long, score long, other long"), "slot", positives)
    p_score, p_id = np.zeros((2, len(block), positives), np.int64)
    known = np.zeros((len(block), positives), bool)
    for r in found.collect():       # at most ``positives`` rows an anchor of this block
        at = r["slot"], r["rank"] - 1
        p_score[at], p_id[at], known[at] = r["score"], r["other"], True
    least, most = -(-low * p_score // 100), high * p_score // 100
    least[~known], most[~known] = 1, 0
    windows = sc.broadcast((p_id, p_score, least, most))

    def find_negatives(batches):
        a_id, a_label, a_planes = sent.value
        p_id, p_score, least, most = windows.value
        best = Best(len(a_id) * positives, negatives)
        for c_id, c_label, c_planes in _chunks(batches, bits, groups):
            for first, stop, table in _anchor_tiles(a_label, a_planes, dtype, False):
                for at in range(0, len(c_id), TILE_ROWS):
                    end = min(at + TILE_ROWS, len(c_id))
                    s = scores(table, c_planes[at:end])
                    other = c_label[at:end, None] != a_label[None, first:stop]
                    for j in range(positives):
                        slots = np.arange(first, stop) * positives + j
                        bar = np.maximum(best.bar[slots], least[first:stop, j])
                        r, a = np.nonzero((s >= bar) & (s <= most[None, first:stop, j]) & other)
                        best.add(slots[a], s[r, a], c_id[at:end][r])
        a, j = np.divmod(best.slot, positives)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.score, best.id, a_id[a], p_id[a, j], p_score[a, j])],
                                         names=["slot", "score", "other", "anchor_id", "positive_id", "positive_score"])

    out = packed.mapInArrow(find_negatives, "slot long, score long, other long, anchor_id long, positive_id long, positive_score long")
    return kept(_best_of_tasks(out, "slot", negatives).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   anchors_per_block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x is floor(256 x); a score is the integer inner product.
    Anchors are the rows where ``anchors`` (on the column ``id``) holds.  An
    anchor's positives are its first ``positives`` rows of the same label
    and another id; each has as negatives the first ``negatives`` rows of
    another label whose score is from ``low`` to ``high`` percent of its
    own.  Higher scores come first, then smaller ids; fewer rows give fewer.

    A null id, label, vector or component, NaN or infinity keeps a row out.
    Shorter vectors count as padded with zeros, an empty one scores 0.
    Repeated rows count each, as anchors too.  Other columns are ignored.  An
    empty table or one without anchors gives none.  Components so large that a
    score may pass 63 bits raise.
    """
    spark = rows.sparkSession
    ints = _integers(rows, id_col, label_col, vector_col)
    dim, least, most = ints.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if not dim:
        if dim is None:
            return spark.createDataFrame([], RESULT)
        dim, least, most = 1, 0, 0          # empty vectors only
    bits = max(int(most).bit_length(), int(-least - 1).bit_length() if least < 0 else 0) + 1
    bound = dim * (1 << (2 * bits - 2))
    if bound >= 1 << 62:
        raise ValueError(f"{dim} components of {bits} bits: a score may pass 63 bits")
    dtype = np.int32 if bound < 1 << 30 else np.int64
    groups = -(-dim // 8)
    packed = kept(_packed(ints, dim, bits))
    out, block = [], []

    def close():
        out.append(_block(packed, list(block), bits, groups, dtype, positives, negatives, low, high))
        block.clear()

    for row in packed.where(anchors).toLocalIterator():     # the driver holds one block
        block.append(tuple(row))
        if len(block) >= anchors_per_block:
            close()
    if block:
        close()
    result = spark.createDataFrame([], RESULT)
    for part in out:
        result = result.unionByName(part)
    return result
