"""Personal data by bootstrapped contextual extraction.

Four fixed patterns give the seed entities.  The words around them are
lexical patterns, and a bipartite graph links lexical patterns with the
instances (normalised identifiers) that stand in them anywhere in the
corpus.  Spark scores the two sides in turn: a pattern by the share of its
instances that are known to be of a kind, an instance by the patterns it stands in.
Instances that reach the bar count as known in the next round, and every
mention of a known instance becomes a span.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from cairn.llm.components import kept, shared_folder
from cairn.llm.words import small_batches

# The kinds in the order of the contract and their seed patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The lookbehind only spares starts inside a run of digits, where no match begins; a card needs 14 digits at least, so shorter
# runs aren't matched at all instead of being dropped.
IPS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARDS = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){13,}")
PHONES = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, range(14, 20), range(10, 16)

# What may be an identifier though no seed pattern matches it; \x00 stands where a seed was found.
SPELT = (r"(?<![\w.%+-])[\w.%+-]+(?:\s?[\[(]\s?at\s?[\])]\s?[\w-]+(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s|\.)[A-Za-z][\w-]*)+"
         r"|\sat\s[\w-]+(?:\sdot\s[A-Za-z][\w-]*)+)")
CANDIDATE = re.compile(rf"(?P<spelt>{SPELT})|(?P<at>(?<![^\s@\x00])[^\s@\x00]+@[^\s@\x00]+)"
                       r"|(?P<groups>(?<![0-9A-Za-z])[0-9A-Fa-f]+(?:[.:][0-9A-Fa-f]+){2,}(?![0-9A-Za-z]))"
                       r"|(?P<number>(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20().\-/]{0,3}[0-9])*(?![A-Za-z]))"
                       r"|(?P<other>(?<![0-9A-Za-z])[A-Za-z]*[0-9][0-9A-Za-z]*)")
MAYBE = re.compile(r"[0-9@]|[\[(]\s?at\s?[\])]|\sdot\s")
LOOSE_CARD, LOOSE_PHONE = range(12, 25), range(7, 18)      # digits that a number of unknown kind may have
EDGE = "\"'()[]{}<>.,;!?*|"
NO_KIND = -1

MIN_SUPPORT = 5         # distinct known instances that a pattern needs
MIN_CONFIDENCE = 0.8   # share of a pattern's decided instances, one more counted against it
MIN_SCORE = 0.8        # of an instance
ROUNDS = 5


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, by start and kind."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            last = m.end()
            out.append((start, EMAIL, last))
        at = text.find("@", at + 1)
    for m in IPS.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and (not p or int(p) <= MAX_PART) for p in parts):
            out.append((m.start(), IP, m.end()))
    for m in CARDS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) in CARD_DIGITS and luhn(digits):
            out.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in PHONES.finditer(text):
            if sum(map(str.isdigit, m.group())) in PHONE_DIGITS:
                out.append((m.start(), PHONE, m.end()))
    out.sort()
    return out


def _short(word: str) -> str:
    """A key of bounded length; distinct words stay distinct."""
    return word if len(word) <= 64 else f"#{xxhash.xxh3_128_hexdigest(word.encode())}"


def _normal_email(s: str) -> str:
    s = re.sub(r"\s?(?:[\[(]\s?at\s?[\])]|\sat\s)\s?", "@", s)
    return re.sub(r"\s?(?:[\[(]\s?dot\s?[\])]|\sdot\s)\s?", ".", s).lower()


def instance(s: str, kind: int) -> str:
    """One identifier however it is written: digits for numbers, an address in lower case, groups as they are."""
    if kind == EMAIL:
        return "e:" + _short(_normal_email(s))
    if kind == IP:
        return "i:" + _short(s.lower())
    return "n:" + _short("".join(c for c in s if c in "0123456789"))


def _candidates(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, end, bits of the kinds it may be, instance) of identifier-like strings outside the seeds."""
    if not MAYBE.search(text):
        return []
    parts, at = [], 0
    for start, _, end in found:
        if end > at:
            parts += [text[at:max(start, at)], "\0" * (end - max(start, at))]
            at = end
    masked = "".join([*parts, text[at:]])
    out = []
    for m in CANDIDATE.finditer(masked):
        what, s = m.lastgroup, m.group()
        start = m.start() + len(s) - len(s.lstrip(EDGE if what == "at" else " "))
        s = s.strip(EDGE if what == "at" else " ")
        digits = sum(c in "0123456789" for c in s)
        if what in ("spelt", "at"):
            fits, key = 1 << EMAIL, instance(s, EMAIL)
        elif what == "groups" and digits:
            fits, key = 1 << IP, instance(s, IP)
        elif what == "number":
            fits, key = (digits in LOOSE_CARD) << CARD | (digits in LOOSE_PHONE) << PHONE, instance(s, CARD)
        else:
            fits, key = 0, "o:" + _short(s.lower())
        if s and (digits or fits):
            out.append((start, start + len(s), fits, key))
    return out


def _context(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    """The lexical patterns of every span: words before it, and the word on each side; ``_`` is a span.

    Words end at blanks and at spans, so the parts that are read of a long word with many spans don't overlap."""
    words = [m.span() for m in re.finditer(r"\S+", text)] if spans else []
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    firsts, lasts = sorted(s for s, _ in spans), sorted(e for _, e in spans)
    known: dict[int, str] = {}

    def normal(piece: str) -> str:
        core = piece.strip(EDGE) or piece
        return _short(re.sub("[0-9]+", "0", core.lower()))

    def word(k: int, beyond: str) -> str:
        if not 0 <= k < len(words):
            return beyond
        if k not in known:
            known[k] = normal(text[slice(*words[k])])
        return known[k]

    out = []
    for start, end in spans:
        k = bisect_right(starts, start) - 1         # the word that holds the span's start, and the one with its last character
        j = bisect_left(ends, end)
        p, n = bisect_right(lasts, start) - 1, bisect_left(firsts, end)
        head_from = max(starts[k], lasts[p] if p >= 0 else 0)
        tail_to = min(ends[j], firsts[n] if n < len(firsts) else len(text))
        before = [word(k - 2, "^"), word(k - 1, "^")]
        head = text[head_from:start].strip("\"'([{<|")
        if head_from > starts[k] and not head:
            before = before[1:] + ["_"]
        elif head:
            before = before[1:] + [normal(head)]
        tail = text[end:tail_to].strip(EDGE)
        after = normal(tail) if tail else "_" if tail_to < ends[j] else word(j + 1, "$")
        first, near = before
        out.append([f"{near} _", f"{first} {near} _", f"{near} _ {after}"])
    return out


SCAN = ("uid long, doc_id long, base array<struct<start:long,kind:int,end:long>>, "
        "mentions array<struct<start:long,end:long,kind:int,fits:int,instance:string,patterns:array<string>>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its base spans, and all mentions (seeds with their kind, candidates without) with their patterns."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    mention = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("fits", pa.int32()),
                         ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches):
        number = 0
        for batch in small_batches(batches, 1):
            base, mentions = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                found = seeds(text)
                all_of = [(s, e, k, 1 << k, instance(text[s:e], k)) for s, k, e in found]
                all_of += [(s, e, NO_KIND, fits, key) for s, e, fits, key in _candidates(text, found)]
                patterns = _context(text, [(m[0], m[1]) for m in all_of])
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                mentions.append([{"start": s, "end": e, "kind": k, "fits": f, "instance": key, "patterns": p}
                                 for (s, e, k, f, key), p in zip(all_of, patterns, strict=True)])
            uid = (TaskContext.get().partitionId() << 32) + number
            number += len(batch)
            yield pa.RecordBatch.from_arrays([pa.array(range(uid, uid + len(batch)), pa.int64()), batch.column(0),
                                              pa.array(base, pa.list_(span)), pa.array(mentions, pa.list_(mention))],
                                             names=["uid", "doc_id", "base", "mentions"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCAN)


def _fits(kind: Column | int) -> Column:
    return F.getbit("fits", F.lit(kind) if isinstance(kind, int) else kind) == 1


def pattern_scores(edges: DataFrame, known: DataFrame, min_support: float = MIN_SUPPORT,
                   min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that reach both bounds.

    ``edges`` holds each (pattern, instance) once with the kinds it may be,
    ``known`` (instance, kind, score).  For a kind, instances known to be of
    another and those that cannot be of it count against the pattern; unknown
    ones that could be of it count neither way."""
    e = edges.join(known, "instance", "left")
    of = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(f"of{k}") for k in range(len(KINDS))]
    no = [F.count_if(F.col("kind").isNull() & ~_fits(k)).alias(f"no{k}") for k in range(len(KINDS))]
    every = sum((F.col(f"of{k}") for k in range(len(KINDS))), F.lit(0.0))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"of{k}").alias("support"),
                                        (F.col(f"of{k}") / (every + F.col(f"no{k}") + 1)).alias("confidence"))
                               for k in range(len(KINDS))])).alias("x")
    return (e.groupBy("pattern").agg(*of, *no).select("pattern", rows).select("pattern", "x.*")
            .where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)))


def instance_scores(edges: DataFrame, patterns: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(instance, kind, score) of instances in accepted patterns: one less the chance that all its patterns err;
    the likeliest kind, ties by the order of KINDS."""
    hits = edges.join(patterns, "pattern").where(_fits(F.col("kind")))
    scored = hits.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
    return (scored.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("x"))
            .select("instance", (-F.col("x.k")).alias("kind"), F.col("x.score").alias("score")).where(F.col("score") >= min_score))


def bootstrap(mentions: DataFrame, rounds: int = ROUNDS, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
              min_score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """Known instances (instance, kind, score; seeds have score 1) and the patterns that were accepted last.

    ``mentions`` has kind, fits, instance and patterns.  Ends when a round
    finds no other instances or after ``rounds``."""
    known_seeds = kept(mentions.where(F.col("kind") != NO_KIND).groupBy("instance")
                       .agg(F.min("kind").alias("kind"), F.lit(1.0).alias("score")))
    edges = kept(mentions.select(F.explode("patterns").alias("pattern"), "instance", "fits")
                 .groupBy("pattern", "instance").agg(F.bit_or("fits").alias("fits")))
    open_edges = edges.join(known_seeds.select("instance"), "instance", "left_anti").where(F.col("fits") > 0)
    open_edges = kept(open_edges)
    known, before = known_seeds, None
    while True:
        patterns = kept(pattern_scores(edges, known, min_support, min_confidence))
        found = kept(instance_scores(open_edges, patterns, min_score))
        rounds -= 1
        known = known_seeds.unionByName(found)
        mark = tuple(found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("instance", "kind").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0] or rounds <= 0:
            return known, patterns
        before = mark


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, min_support: float = MIN_SUPPORT,
             min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE) -> DataFrame:
    """A row per document: doc_id, base matches per kind, their digest, and all spans, found ones included.

    Spans are kind:start:end in code points, by start and then kind.  The
    counts and base_sha256 are of the base matches; added spans never overlap
    those.  A null or empty text has no spans: zeros, an empty string and the
    digest of the empty string.  Texts of any length are taken whole.  Repeated
    rows count once as instances and give a row each; a null id stays null;
    other columns are ignored; an empty table gives none.
    """
    path = shared_folder(docs.sparkSession, "pii")
    scan(docs, id_col, text_col).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    mentions = rows.select("uid", F.explode("mentions").alias("m")).select("uid", "m.*")
    known, _ = bootstrap(mentions, rounds, min_support, min_confidence, min_score)
    added = (mentions.where(F.col("kind") == NO_KIND).drop("kind").join(known.select("instance", "kind"), "instance")
             .where(_fits(F.col("kind"))).groupBy("uid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")))
    base = F.col("base")
    n = [_count(base, k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = F.array_sort(F.concat(base, F.coalesce(F.col("added"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))))
    return (rows.select("uid", "doc_id", "base").join(added, "uid", "left")
            .select("doc_id", *n, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(every).alias("spans")))
