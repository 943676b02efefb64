"""Rules, line dedup, decontamination, packing and the pipeline that joins them."""

import random
import zlib

import numpy as np
import public_tokenizers
from llm_data import docs_of, documents, odd_rows  # noqa: F401
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from cairn.llm import decontam, linededup, packing, rules

BPE = public_tokenizers.path("word_bpe_49k.json")


# --- quality rules -------------------------------------------------------------
def test_line_faults():
    assert rules.line_fault("We use cookies to make this site work well for you.") == "boilerplate"
    assert rules.line_fault("Home | News | Sport | Weather | About") == "navigation"
    assert rules.line_fault("Menu") == "navigation"
    assert rules.line_fault("THE!! OF!! AND!! TO!!") == "punctuation"
    assert rules.line_fault("It was the best of times, it was the worst of times.") is None
    assert rules.line_fault("") is None and rules.line_fault(" \t ") is None


def test_figures_as_brute_force(spark, docs_of):
    r = random.Random(1)
    rows = [(i, "\n".join(" ".join(r.choice("a b c d é".split()) for _ in range(r.randrange(9))) for _ in range(r.randrange(12)))) for i in range(60)]
    for x in rules.judge(docs_of(rows)).collect():
        text = dict(rows)[x.doc_id]
        w = text.split()
        wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        covered = {i + k for i, g in enumerate(wins) if wins.count(g) > 1 for k in range(3)}
        lines = [t for t in text.split("\n") if t.split()]
        assert (x.n_words, x.word_chars, x.n_repeat_words, x.n_dup_lines) == (len(w), sum(map(len, w)), len(covered), len(lines) - len(set(lines)))


def test_rules_on_odd_rows(spark, docs_of, odd_rows):
    out = rules.judge(docs_of(odd_rows), with_text=True).collect()
    assert len(out) == len(odd_rows)
    first = next(x for x in out if x.doc_id == 1)
    assert (first.n_words, first.word_chars, first.base_failed, first.kept, first.clean) == (0, 0, True, False, "")
    assert next(x for x in out if x.doc_id == 6).n_words == 1
    assert next(x for x in out if x.doc_id == 9 and x.n_words != 6).n_words == 3
    assert rules.judge(docs_of([])).collect() == []
    assert rules.keep_clean(docs_of([])).collect() == []


def test_rejects_what_loses_too_much_and_cleans_the_rest(spark, docs_of):
    good = [" ".join(f"w{i}x{j}" for j in range(14)) + "." for i in range(8)]
    menu = "Home | News | Sport | Weather | About | More | Things | To | Click"
    rows = [(1, "\n".join(good)), (2, "\n".join([*good, "Menu"])), (3, "\n".join(good[:4] + [menu] * 6))]
    df = docs_of(rows)
    kept = rules.keep_clean(df)
    got = {x.doc_id: x for x in kept.collect()}
    assert kept.columns == df.columns and set(got) == {1, 2}
    assert got[2].text == "\n".join(good) and got[2].n_chars == len(got[2].text) and got[2].gram == "gram"


# --- line dedup ------------------------------------------------------------------
def brute_dedup(rows, width=3):
    seen, out = set(), []
    bare = lambda x: x.strip(" \t\r")
    first = {}
    for i, t in sorted(rows):
        lines = [x for x in t.split("\n") if bare(x)]
        for at in range(len(lines) - width + 1):
            first.setdefault(tuple(map(bare, lines[at:at + width])), (i, at))
    for i, t in rows:
        lines = [x for x in t.split("\n") if bare(x)]
        gone = {at + k for at in range(len(lines) - width + 1) if first[tuple(map(bare, lines[at:at + width]))] != (i, at) for k in range(width)}
        out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in gone) if gone else t))
    assert not seen
    return out


def test_line_dedup_as_brute_force(spark, docs_of):
    r = random.Random(4)
    for alphabet in (3, 12):
        rows = [(i, "\n".join(r.choice(["", " \t", *[f" line {j}\r" for j in range(alphabet)], "line 1"]) for _ in range(r.randrange(14)))) for i in range(40)]
        df = docs_of(rows)
        out = linededup.dedup_lines(df)
        assert out.columns == df.columns and out.schema == df.schema
        assert sorted((x.doc_id, x.text) for x in out.collect()) == sorted(brute_dedup(rows))
        assert all(x.n_chars == len(x.text) for x in out.collect())


def test_line_dedup_on_odd_rows(spark, docs_of, odd_rows):
    many = "\n".join(f"line {i}" for i in range(5000))
    rows = [*odd_rows, (20, many), (20, many), (21, many), (None, many), (22, "x\ny\nz\nx\ny\nz\nx\ny\nz")]
    out = linededup.dedup_lines(docs_of(rows)).collect()
    assert len(out) == len(rows)
    texts = sorted(((x.doc_id or 0, x.text) for x in out if x.doc_id in (20, 21, 22, None)), key=str)
    assert [t for i, t in texts if i == 20] == [many, many] and [t for i, t in texts if i == 21] == [""]
    assert many in [t for i, t in texts if i == 0] and [t for i, t in texts if i == 22] == ["x\ny\nz"]
    assert next(x for x in out if x.doc_id == 1).text is None
    assert linededup.dedup_lines(docs_of([])).collect() == []


def test_line_dedup_of_short_texts(spark, docs_of):
    rows = [(1, "a passage"), (2, " a passage\r"), (3, "one\n\ntwo"), (4, "one\ntwo"), (5, "one"), (6, "one\ntwo\nthree"), (7, ""), (8, None)]
    got = {x.doc_id: x.text for x in linededup.dedup_lines(docs_of(rows), whole_short=True).collect()}
    assert got == dict(rows) | {2: "", 4: ""}


def test_line_dedup_of_rows_that_share_an_id(spark, docs_of):
    again, clean = "a\nb\nc", "d\ne\nf\ng"
    got = sorted((x.doc_id, x.text) for x in linededup.dedup_lines(docs_of([(1, again), (2, again), (2, clean), (2, ""), (3, "x\n" + again)])).collect())
    assert got == [(1, again), (2, ""), (2, ""), (2, clean), (3, "x")]


# --- decontamination ---------------------------------------------------------------
def distance(p, t):
    """Least edit distance of p to a substring of t, the plain table."""
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_myers_is_the_edit_distance(p, t):
    assert decontam.myers(p, t)[0] == distance(p, t)


def test_finds_all_edits_within_the_budget():
    r = random.Random(9)
    items = [(i, "".join(r.choice("abcdefg ") for _ in range(100)).strip().replace("  ", "ab")) for i in range(5)]
    m = decontam.Matcher([(i, decontam.normalised(t)) for i, t in items])
    for edits in range(9):
        for i, t in items:
            t = list(decontam.normalised(t))
            for _ in range(edits):
                at = r.randrange(1, len(t) - 1)
                what = r.random()
                t[at:at + 1] = [] if what < 0.3 else [t[at], r.choice("xyz")] if what < 0.6 else [r.choice("xyz")]
            text = "before it " + "".join(t) + " after it"
            budget = int(len(m.items[i][1]) * decontam.ERROR_SHARE)
            want = {k for k, (_, item, e) in enumerate(m.items) if distance(item, text) <= e}
            assert {x[0] for x in m.matches(text)} == want
            assert (i in want) or edits > budget


def test_leaks_on_odd_rows(spark, docs_of, odd_rows):
    item = "What is the capital of the country that lies north of the sea, and why?"
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (None, "the of and the of and w17 the of and"), (11, "short")], "item_id long, text string")
    rows = [*odd_rows, (30, f"So: {item.upper()} Yes."), (31, "x " + item.replace("capital", "capitol") + item), (32, item[:30])]
    df = docs_of(rows)
    got = decontam.find_leaks(df, bench).collect()
    assert {(x.doc_id, x.item_id, x.distance) for x in got if x.item_id == 7} == {(30, 7, 0), (31, 7, 0)}
    where = next(x for x in got if x.doc_id == 30)
    assert decontam.normalised(rows[-3][1])[where.start:where.end] == decontam.normalised(item)
    kept = decontam.drop_leaks(df, bench.where("item_id = 7"))
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    assert decontam.find_leaks(docs_of([]), bench).collect() == []
    assert decontam.find_leaks(df, bench.limit(0)).collect() == [] and decontam.drop_leaks(df, bench.limit(0)).count() == len(rows)


def test_short_items_as_whole_words(spark, docs_of):
    bench = spark.createDataFrame([(1, "Red Fox"), (2, "why?"), (3, " "), (4, "")], "item_id long, text string")
    rows = [(1, "A red  fox."), (2, "bred fox red foxes"), (3, "red fax"), (4, "Why? red foxes, red fox"), (5, "")]
    got = {(x.doc_id, x.item_id, x.distance, x.start, x.end) for x in decontam.find_leaks(docs_of(rows), bench, error_share=0.3).collect()}
    assert got == {(1, 1, 0, 2, 9), (4, 1, 0, 16, 23), (4, 2, 0, 0, 4)}
    assert sorted(x.doc_id for x in decontam.drop_leaks(docs_of(rows), bench).collect()) == [2, 3, 5]


def test_items_in_several_passes(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontam, "GROUP_BYTES", 100)
    items = [(i, f"item {i} is about something that no other item is about {i * 7919}") for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, f"see {t} there") for i, t in items]
    assert {(x.doc_id, x.item_id) for x in decontam.find_leaks(docs_of(rows), bench).collect()} >= {(i, i) for i in range(8)}
    assert decontam.drop_leaks(docs_of([*rows, (99, "clean")]), bench).select("doc_id").collect() == [(99,)]


# --- packing -------------------------------------------------------------------------
def check_packed(rows, out, capacity):
    tok = Tokenizer.from_file(BPE)
    left = {}
    for i, t in rows:
        left.setdefault(i, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 0])
    bins = {}
    for x in out:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
        ids = [d for d in left[x.doc_id] if zlib.crc32(np.array(d[x.start:x.start + capacity], "<u4").tobytes()) == x.ids_crc32]
        assert ids and x.length == len(ids[0][x.start:x.start + capacity]) and x.start == x.piece * capacity
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert sum(x.length for x in out) == sum(len(d) for ds in left.values() for d in ds)
    return len(bins), sum(x.length for x in out)


def test_packing_holds_every_token_and_is_dense(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    n, tokens = check_packed(rows, packing.pack_documents(documents(spark), BPE).collect(), 2048)
    assert n <= 1.02 * -(-tokens // 2048) + 1


def test_packing_on_odd_rows(spark, docs_of, odd_rows):
    rows = [*odd_rows, (40, "don't <|endoftext|> İstanbul'll ΑΣ. x́! naïve... 12,3 ʼn_a ﬁ é.")]
    check_packed(rows, packing.pack_documents(docs_of(rows), BPE, capacity=64).collect(), 64)
    assert packing.pack_documents(docs_of([]), BPE).collect() == []
    with_ids = packing.pack_documents(docs_of(rows[:5]), BPE, with_ids=True).collect()
    assert all(len(x.ids) == x.length and zlib.crc32(np.array(x.ids, "<u4").tobytes()) == x.ids_crc32 for x in with_ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120), st.integers(1, 6))
def test_best_fit_takes_the_fullest_bin(lengths, open_bins):
    packer, free, closed = packing.BestFit(32, open_bins), {}, 0
    for n in lengths:
        b, offset = packer.place(n)
        fits = [f for f in free.values() if f >= n]
        if fits:
            assert free[b] == min(fits) == 32 - offset
            free[b] -= n
        else:
            assert offset == 0 and b not in free
            if len(free) >= open_bins:
                fullest = min(free, key=free.get)
                low = [k for k in free if free[k] == free[fullest]]
                del free[low[-1]]
            free[b] = 32 - n
        free = {k: f for k, f in free.items() if f}
        assert packer.open == len(free) <= open_bins and sorted(x for i, bs in enumerate(packer.by_free) for x in [i] * len(bs)) == sorted(free.values())
    assert closed == 0


# --- pipeline ------------------------------------------------------------------------
def test_pipeline_stages_as_brute_force(spark):
    from test_ngram_join import brute
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    docs, kept = documents(spark), None
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.01")
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept = sorted((r.doc_id, r.text) for r in docs.collect())
        if name == "quality_rules":
            m = rules.judge(documents(spark), with_text=True).where("kept").collect()
            assert kept == sorted((x.doc_id, x.clean) for x in m) and 0.6 * len(rows) < len(kept) < len(rows)
        elif name == "line_dedup":
            was = dict(rows)
            assert kept == sorted((i, t) for i, t in brute_dedup(rows) if t or not was[i]) and len(kept) < len(rows)
        elif name == "near_duplicates":
            assert [i for i, _ in kept] == sorted({c for _, c in brute(rows, 5, 80).values()})
        else:
            leaks = {i for i, t in rows if any(decontam.normalised(b) in decontam.normalised(t) for _, b in bench)}
            assert leaks and {i for i, _ in kept} == {i for i, _ in rows} - leaks
        rows = kept
    check_packed(rows, corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.01").collect(), 2048)


def test_ids_equal_the_plain_tokenizer():
    """Rank merging against the library: Latin words by the million letters, and texts that go to the library itself."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from cairn.llm.packing import MARK, WordEncoder
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, fast = Tokenizer.from_file(path), WordEncoder(path)
    assert fast.split
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCéüñçßŁőÿæ'.,-!?0123456789 \t\n\xa0"
    texts = ["".join(r.choice(letters) for _ in range(2000)) for _ in range(200)]
    texts += ["It's the dogs' 12 o'clock, they'LL've!", "İı ſ ΑΣ ά é中文\U0001f600", "a\x1cb\x85c\x1fd", f"x{MARK}y", "<|endoftext|>", " ", "\xa0\xad", "don’t"]
    for t in texts:
        assert fast(t).tolist() == plain.encode(t, add_special_tokens=False).ids, t[:60]
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not WordEncoder(other).split
    assert WordEncoder(other)("Some text").tolist() == Tokenizer.from_file(other).encode("Some text", add_special_tokens=False).ids
