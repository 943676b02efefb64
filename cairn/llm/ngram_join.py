"""N-gram Jaccard join by vertical partitioning.

The distinct word shingles of a document are its set.  All shingles have a
global order: first a part of the hash space, the counted range, by how
many sets hold a shingle; then the rest by hash, common ones last.
Candidate pairs share a shingle among the first of their order (prefix
filter); the order is cut into fragments, and for each candidate the
overlap is counted separately in every fragment and summed.  Similar
documents are grouped into components.

The counted range is wide enough to hold the prefix of nearly every set, so
only that part of the corpus is shuffled to be counted; a set with fewer
members there goes on with the rest.

Documents with equal sets are one node, and a group of near copies is
joined through hubs: rounds compare every member of a posting list with a
hub of the list, then those outside the list's largest component with
a member of it, and at last only the pairs of a list that are still in
different components.  No link between components can be missed, because
each pair that could reach the threshold shares a posting list and is
either counted or already joined.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cairn.llm.components import connected_components, kept, kept_sized, sized
from cairn.llm.words import hash_words, shingle_hashes, small_batches, split_words

FRAGMENTS = 4               # the counted range, and equal ranges of the rest of the order
COUNTED = 5 / 3             # width of the counted range, as a multiple of the share of a set that is its prefix
SLOTS = 1 << 22             # of the table of common shingles: 512 KB as bits, whatever the input
COMMON_SHARE = 0.001        # of a task's documents; with COMMON_LEAST, what makes a shingle common
COMMON_LEAST = 8
SALT = 64                   # parts of a posting list of a common shingle while shingles are counted
SIGNATURE = 8               # longs of the parity signature that bounds an overlap from above
SKETCH = 32                 # lists of a set by which the last round knows a pair that it has met before
BROADCAST_ROWS = 1_000_000  # ids (8 bytes each) that a semi-join may broadcast; more are shuffled

SETS = "doc_id long, n long, counted long, node long, " + ", ".join(f"s{i} long" for i in range(SIGNATURE)) + ", slots binary"


def _sets(texts: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) of every text."""
    for part in split_words(texts):
        hashes = hash_words(part.vocab)[part.codes]
        for r in range(part.stop - part.start):
            a, b = part.offsets[r], part.offsets[r + 1]
            yield part.start + r, np.unique(shingle_hashes(hashes[a:b], k))


def _node(s: np.ndarray) -> int:
    """One 64-bit id for equal sets (two unequal ones among a billion share it with a chance of 3 %)."""
    import xxhash
    return xxhash.xxh3_64_intdigest(s.tobytes(), 7) - (1 << 63)


def _signature(s: np.ndarray) -> np.ndarray:
    """Parity of the set's members per bit: differing bits are at most the members that two sets don't share."""
    bits = np.bincount((s & np.uint64(64 * SIGNATURE - 1)).astype(np.int64), minlength=64 * SIGNATURE) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)


def _counted_limit(percent: int) -> int:
    """Hashes below this are the counted range."""
    return min((1 << 64) - 1, int((100 - percent) / 100 * COUNTED * 2 ** 64))


def _describe(k: int, limit: int):
    """A row for each document, and one with the slots that are common among the task's documents."""
    def run(batches):
        seen, docs = set(), 0
        counts = np.zeros(SLOTS, np.int32)
        for batch in small_batches(batches, 1):
            ids = batch.column(0)
            n, counted, node, sig = [], [], [], []
            for _, s in _sets(batch.column(1), k):
                n.append(len(s))
                counted.append(int(np.searchsorted(s, np.uint64(limit))))
                if not len(s):
                    node.append(None)
                    sig.append(np.zeros(SIGNATURE, np.int64))
                    continue
                node.append(_node(s))
                sig.append(_signature(s))
                if node[-1] not in seen:
                    if len(seen) < 1 << 20:
                        seen.add(node[-1])
                    docs += 1
                    counts[np.unique(_slot(s))] += 1
            sig = np.array(sig, np.int64).reshape(-1, SIGNATURE)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(counted, pa.int64()), pa.array(node, pa.int64()), *(pa.array(sig[:, i]) for i in range(SIGNATURE)),
                 pa.nulls(len(ids), pa.binary())],
                names=[c.split()[0] for c in SETS.split(", ")])
        slots = np.flatnonzero(counts >= max(COMMON_LEAST, math.ceil(docs * COMMON_SHARE))).astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64())] * (4 + SIGNATURE) + [pa.array([slots.tobytes()], pa.binary())],
            names=[c.split()[0] for c in SETS.split(", ")])
    return run


def _least_overlap(n: int, percent: int) -> int:
    """Of a set of n with any set similar to it."""
    return -(-percent * n // 100)


SIGNATURES = [f"s{i}" for i in range(SIGNATURE)]
POSTINGS = "gram long, salt int, node long, late int"


def _postings(k: int, percent: int, limit: int, common):
    """The counted range of each set and, where that is shorter than the set's prefix, what comes next in the order.

    late is the place in the order of the latter, -1 for the former, whose
    place depends on the counts; salt parts the lists of common shingles.
    """
    def run(batches):
        seen = set()
        flags = np.unpackbits(np.frombuffer(common.value, np.uint8), bitorder="little").astype(bool)
        for batch in small_batches(batches, 0):
            out = []
            for _, s in _sets(batch.column(0), k):
                if not len(s):
                    continue
                node = _node(s)
                if node in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(node)
                m = int(np.searchsorted(s, np.uint64(limit)))
                late = np.full(m, -1, np.int32)
                hot = flags[_slot(s)]
                more = len(s) - _least_overlap(len(s), percent) + 1 - m
                if more > 0:
                    rest, rest_hot = s[m:], hot[m:]
                    order = np.argsort(rest_hot, kind="stable")[:more]
                    grams, hot = np.concatenate([s[:m], rest[order]]), np.concatenate([hot[:m], rest_hot[order]])
                    late = np.concatenate([late, m + np.arange(more, dtype=np.int32)])
                else:
                    grams, hot = s[:m], hot[:m]
                out.append((grams, np.where(hot, 1 + node % SALT, 0).astype(np.int32), node, late))
            if out:
                sizes = np.array([len(x[0]) for x in out])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([x[0] for x in out]).view(np.int64)), pa.array(np.concatenate([x[1] for x in out])),
                    pa.array(np.repeat(np.array([x[2] for x in out], np.int64), sizes)),
                    pa.array(np.concatenate([x[3] for x in out]))], names=["gram", "salt", "node", "late"])
    return run


def _prefixes(postings: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(gram, salt, node, n, pos, shared, alone): the prefix of every set in the global order, without shingles that one set alone holds.

    pos is the place in the whole order, those shingles included: they are
    the first of a set, and where they fill its prefix the set has no
    similar one.  alone counts those of the counted range, shared the others
    of that range.
    """
    one_list = Window.partitionBy("gram", "salt")
    held = (postings.withColumn("first", F.min("node").over(one_list)).withColumn("last", F.max("node").over(one_list))
            .withColumn("sets", F.when(F.col("salt") > 0, F.lit(1 << 40)).otherwise(F.count(F.lit(1)).over(one_list)))
            .where((F.col("salt") > 0) | (F.col("first") != F.col("last")))
            .select("gram", "salt", "node", "late", "sets").dropDuplicates(["gram", "salt", "node"]))
    of_set = Window.partitionBy("node")
    in_order = of_set.orderBy((F.col("late") >= 0).asc(), "sets", "gram")
    ranked = (held.withColumn("rank", F.row_number().over(in_order))
              .withColumn("shared", F.sum((F.col("late") < 0).cast("int")).over(of_set))
              .join(nodes.select("node", "n", "counted"), "node"))
    pos = F.when(F.col("late") < 0, F.col("counted") - F.col("shared") + F.col("rank") - 1).otherwise(F.col("late").cast("long"))
    size = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return ranked.withColumn("pos", pos).where(F.col("pos") < size).select(
        "gram", "salt", "node", "n", "pos", "shared", (F.col("counted") - F.col("shared")).alias("alone"))


SEGMENTS = "node long, fragment int, members binary"


def _segments(k: int, limit: int):
    """The set cut at the fragments of the global order."""
    bounds = np.array([limit + (2 ** 64 - limit) * i // (FRAGMENTS - 1) for i in range(FRAGMENTS - 1)], np.uint64)

    def run(batches):
        for batch in small_batches(batches, 0):
            node, fragment, members = [], [], []
            for _, s in _sets(batch.column(0), k):
                cuts = [0, *np.searchsorted(s, bounds).tolist(), len(s)]
                for f, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if b > a:
                        node.append(_node(s))
                        fragment.append(f)
                        members.append(s[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(fragment, pa.int32()),
                                              pa.array(members, pa.binary())], names=["node", "fragment", "members"])
    return run


def _partial_overlaps(batches):
    """Members that two segments of one fragment share."""
    for batch in batches:
        a, b = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        shared = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                  for x, y in zip(a, b)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64())],
                                         names=["a", "b", "shared"])


def _reaches(shared, na, nb, percent: int):
    """100 * intersection >= percent * union, in integers."""
    return (100 + percent) * shared >= percent * (na + nb)


def _can_reach(percent: int):
    """Length and position filters on two entries (a, b) of a posting list, as if it were the first that they share."""
    a = lambda c: F.col(f"a{c}")
    b = lambda c: F.col(f"b{c}")
    most = F.least(a("n") - a("pos"), b("n") - b("pos"))
    return _reaches(most, a("n"), b("n"), percent)


def _signatures_can_reach(percent: int):
    differ = sum((F.bit_count(F.col(f"as{i}").bitwiseXOR(F.col(f"bs{i}"))) for i in range(SIGNATURE)), F.lit(0))
    most = F.floor((F.col("an") + F.col("bn") - differ) / 2)
    return _reaches(most, F.col("an"), F.col("bn"), percent)


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}{c}") for c in df.columns])


def semi_join_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str = "left_semi") -> DataFrame:
    """Semi- or anti-join on a narrow table of ids, broadcast only when its counted size allows."""
    ids = kept(ids.select(id_col).where(F.col(id_col).isNotNull()).distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, id_col, how)


def _links(docs, nodes, pairs, k, percent) -> DataFrame:
    """Of the pairs (a, b) of nodes those that reach the threshold, by partial overlaps per fragment, summed per pair."""
    sig = nodes.drop("rep", "counted")
    pairs, n_pairs = kept_sized(pairs.join(_side(sig, "a").withColumnRenamed("anode", "a"), "a")
                                .join(_side(sig, "b").withColumnRenamed("bnode", "b"), "b")
                                .where(_signatures_can_reach(percent)).select("a", "b", "an", "bn"))
    wanted = sized(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 2 * n_pairs)
    ids = nodes.join(wanted, "node", "left_semi").select(F.col("rep").alias("doc_id"))
    segments = (semi_join_ids(docs, ids, "doc_id").select("text")
                .mapInArrow(_segments(k, _counted_limit(percent)), SEGMENTS).dropDuplicates(["node", "fragment"]))
    both = (pairs.join(segments.select(F.col("node").alias("a"), "fragment", F.col("members").alias("sa")), "a")
            .join(segments.select(F.col("node").alias("b"), "fragment", F.col("members").alias("sb")), ["b", "fragment"])
            .select("a", "b", "sa", "sb"))
    total = both.mapInArrow(_partial_overlaps, "a long, b long, shared long").groupBy("a", "b").agg(
        F.sum("shared").alias("shared"))
    return kept_sized(sized(total, n_pairs).join(pairs, ["a", "b"])
                      .where(_reaches(F.col("shared"), F.col("an"), F.col("bn"), percent)).select("a", "b"))[0]


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of every node: the smallest document id of its component."""
    rep = nodes.select("node", "rep")
    ends = (links.join(rep.select(F.col("node").alias("a"), F.col("rep").alias("x")), "a")
            .join(rep.select(F.col("node").alias("b"), F.col("rep").alias("y")), "b"))
    found = connected_components(ends, "x", "y")
    return kept_sized(rep.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                      .select("node", F.coalesce("label", "rep").alias("label")))[0]


def _open_lists(entries: DataFrame, nodes: DataFrame, label: DataFrame) -> DataFrame:
    """Entries of the lists that hold more than one component, with the largest of each list as main."""
    entries = entries.join(label, "node")
    main = (entries.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("size")).groupBy("gram")
            .agg(F.max_by("label", "size").alias("main"), F.count(F.lit(1)).alias("labels"))
            .where("labels > 1").select("gram", "main"))
    return kept_sized(entries.join(main, "gram").join(nodes.select("node", *SIGNATURES), "node"))[0]


def _with_earlier(entries: DataFrame) -> DataFrame:
    """Entries with the lists of their set's sketch that come before their own in the global order.

    The sketch is a set's SKETCH lists of the smallest hash, so similar sets
    have most of it in common.  A list in both sketches and before this one
    for one set is so for both.
    """
    sketch = entries.groupBy("node").agg(
        F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("gram").alias("h"), "pos", "gram"))), 1, SKETCH).alias("sketch"))
    return (entries.join(sketch, "node")
            .withColumn("earlier", F.transform(F.filter("sketch", lambda x: x["pos"] < F.col("pos")), lambda x: x["gram"])).drop("sketch"))


def _candidates(outside: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of two components that share a list and pass the filters; of two outside the main one, each once.

    With ``earlier``, a pair counts where none of the lists in both sketches
    comes before: always in the first list that both sets are in, whose
    positions are those of the filter, and in few others.
    """
    a = _side(outside, "a").withColumnRenamed("agram", "gram")
    b = _side(others, "b").withColumnRenamed("bgram", "gram")
    new = ~F.arrays_overlap("aearlier", "bearlier") if "earlier" in outside.columns else F.lit(True)
    return (a.join(b, "gram")
            .where((F.col("alabel") != F.col("blabel")) & ((F.col("blabel") == F.col("bmain")) | (F.col("anode") > F.col("bnode")))
                   & _can_reach(percent) & _signatures_can_reach(percent) & new)
            .select(F.greatest("anode", "bnode").alias("a"), F.least("anode", "bnode").alias("b")).distinct())


def ngram_components(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Words are runs of characters other than U+0020 and U+0009..U+000D,
    A-Z lower-cased; the set has the distinct k-word shingles, or the whole
    sequence when it is shorter.  Two documents link when 100 * intersection
    >= percent * union; component_id is the smallest id reachable, the
    document's own included.

    Null or wordless texts have n_shingles 0, link with nothing and keep
    their own id.  Rows that repeat an id each give a row.  A null id takes
    no part in the minimum; it has a null component unless another document
    shares its set.  Other columns are ignored.  An empty table gives none.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    limit = _counted_limit(percent)
    described = kept(docs.mapInArrow(_describe(k, limit), SETS))
    flags = np.zeros(SLOTS, bool)
    for row in described.where("slots is not null").select("slots").toLocalIterator():   # at most SLOTS set bits in all
        flags[np.frombuffer(row[0], "<u4")] = True
    common = spark.sparkContext.broadcast(np.packbits(flags, bitorder="little").tobytes())
    described = described.where("slots is null").drop("slots")

    nodes, _ = kept_sized(described.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("counted").alias("counted"),
        *[F.min(f"s{i}").alias(f"s{i}") for i in range(SIGNATURE)]).where("rep is not null"))

    prefixes, _ = kept_sized(_prefixes(docs.select("text").mapInArrow(_postings(k, percent, limit, common), POSTINGS), nodes, percent))

    # First round: every member of a list with a hub (a grouped minimum, so of lists of any length): the set with the
    # fewest shingles of its own and the most others, which of near copies is the least changed.  What decides is the
    # node's alone: near copies share most of their lists and meet the same hub in them, so pairs go with members.
    entry = F.struct("pos", "n", "node")
    hub = prefixes.groupBy("gram").agg(F.min_by(entry, F.struct("alone", -F.col("shared"), F.xxhash64("node"))).alias("hub"))
    stars = prefixes.join(hub, "gram").select(
        F.col("node").alias("anode"), F.col("n").alias("an"), F.col("pos").alias("apos"),
        F.col("hub.node").alias("bnode"), F.col("hub.n").alias("bn"), F.col("hub.pos").alias("bpos"))
    pair = [F.greatest("anode", "bnode").alias("a"), F.least("anode", "bnode").alias("b")]
    first, _ = kept_sized(stars.where((F.col("anode") != F.col("bnode")) & _can_reach(percent))
                          .select(*pair).distinct())
    links = _links(docs, nodes, first, k, percent)
    label = _labelled(nodes, links)

    # Second round: who is outside the largest component of a list with a member of that, another in each list.
    left = _open_lists(prefixes.select("gram", "node", "n", "pos"), nodes, label)
    inside = left.where(F.col("label") == F.col("main")).groupBy("gram").agg(
        F.min_by(F.struct("node", "n", "pos", "label", "main", *SIGNATURES), F.xxhash64("gram", "node", F.lit(2))).alias("m"))
    second = _candidates(left.where(F.col("label") != F.col("main")), inside.select("gram", "m.*"), percent)
    second, _ = kept_sized(second.join(first, ["a", "b"], "left_anti"))
    links = links.unionByName(_links(docs, nodes, second, k, percent))
    label = _labelled(nodes, links)

    # Last: all pairs of a list that are still apart.
    left = _open_lists(left.select("gram", "node", "n", "pos"), nodes, label)
    left = _with_earlier(left)
    third = _candidates(left.where(F.col("label") != F.col("main")), left, percent)
    third, _ = kept_sized(third.join(first.unionByName(second), ["a", "b"], "left_anti"))
    label = _labelled(nodes, links.unionByName(_links(docs, nodes, third, k, percent)))
    return (described.select("doc_id", F.col("n").alias("n_shingles"), "node").join(label, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id")))


def keep_representatives(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, with one row of each group of similar documents: that of the smallest id.

    Rows that repeat an id are one document, of which one row stays.  Rows
    without id and documents without words are kept.  Other cases are as in
    ``ngram_components``.
    """
    parts = kept(ngram_components(docs, k, percent, id_col, text_col).where("doc_id is not null"))
    gone = parts.where("doc_id != component_id").select(F.col("doc_id").alias(id_col))
    repeated = parts.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(id_col))
    out = semi_join_ids(docs, gone, id_col, "left_anti")
    if repeated.isEmpty():
        return out.select(docs.columns)
    once = semi_join_ids(out, repeated, id_col, "left_anti")
    return once.unionByName(semi_join_ids(out, repeated, id_col).dropDuplicates([id_col])).select(docs.columns)
