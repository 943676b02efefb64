"""Token counts, LM scoring, classifiers and HTML extraction."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from llm_data import SF, docs_of, documents, odd_rows  # noqa: F401
from hypothesis import given, settings, strategies as st

from cairn.llm import htmltext, lm, quality_model, tokencount, toxicity
from cairn.llm.words import split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
VOCAB = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB \t\n\x0b\x0c\r\x1c\x85\xa0é ")))), st.integers(1, 40))
def test_words(texts, limit):
    got = []
    for part in split_words(pa.array(texts, pa.string()), limit=limit):
        vocab = part.vocab.to_pylist()
        got += [[vocab[c] for c in part.codes[a:b]] for a, b in zip(part.offsets, part.offsets[1:])]
    assert got == [WORD.findall((t or "").translate(LOWER)) for t in texts]


# --- token counts -------------------------------------------------------------------
def greedy(word, starts, inner):
    n, i = 1, next((e for e in range(len(word), 0, -1) if word[:e] in starts), 0)
    while i < len(word):
        i = next((e for e in range(len(word), i, -1) if word[i:e] in inner), i + 1)
        n += 1
    return n


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=25),
       st.sets(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=25),
       st.binary(min_size=1, max_size=40).map(lambda b: bytes(x % 3 for x in b)))
def test_automaton_is_greedy_longest_match(starts, inner, word):
    assert tokencount.LongestMatch(list(starts), list(inner)).count(word) == greedy(word, starts, inner)


def test_token_counts_as_brute_force(spark, docs_of, odd_rows):
    starts, inner = map(set, tokencount.read_vocabulary(VOCAB))
    rows = odd_rows[:9] + odd_rows[10:]
    out = tokencount.count_tokens(docs_of(rows), VOCAB).collect()
    want = Counter((i, len(w := (t or "").encode().split()), sum(map(len, w)), sum(greedy(x, starts, inner) for x in w)) for i, t in rows)
    assert Counter(map(tuple, out)) == want
    assert tokencount.count_tokens(docs_of([]), VOCAB).collect() == []


# --- LM scoring ---------------------------------------------------------------------
def base_scores(rows):
    docs = [(i, [*WORD.findall((t or "").translate(LOWER)), None], zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t in rows]
    c = Counter(w for _, ws, held in docs if not held for w in ws)
    n, v = sum(c.values()), len(c)
    return Counter((i, held, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 5)) for i, ws, held in docs)


def scored(df):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in df.collect())


def test_base_scores_as_brute_force(spark, docs_of, odd_rows):
    assert scored(lm.score_texts(docs_of(odd_rows))) == base_scores(odd_rows)
    assert lm.score_texts(docs_of([])).collect() == []
    only = [(i, "a b") for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert scored(lm.score_texts(docs_of(only))) == base_scores(only)


def test_rare_words_through_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 18)
    monkeypatch.setattr(lm, "COUNTED_AT_ONCE", 20_000)
    out = lm.score_texts(documents(spark))
    assert scored(out) == base_scores([(r.doc_id, r.text) for r in documents(spark).collect()])
    held = [r for r in out.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)     # bigrams help on texts not learned from
    assert all(r.score < 0 for r in held)


def test_filter_holds_bigrams_seen_once(spark, docs_of, monkeypatch):
    """Scores as from quantised counts of all n-grams, but for the filter's few false positives."""
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 10)
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdefghijklmnopqrstuvwxyz") + r.choice("abcdef") for _ in range(8))) for i in range(400)]
    texts = {i: [*t.split(), None] for i, t in rows}
    learned = [w for i, w in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    uni, bi = Counter(w for t in learned for w in t), Counter(p for t in learned for p in zip(t, t[1:]))
    assert sum(c == 1 for c in bi.values()) > len(bi) / 4
    floor = uni.total() + len(uni) + 1

    def middle(count):
        return 1.5 * 2.0 ** (count.bit_length() - 1) - 0.5 if count else 0.0

    def score(t):
        p = [(middle(uni[w]) + 1) / floor for w in t]
        out = math.log10(p[0])
        for a, b, q in zip(t, t[1:], p[1:]):
            n = middle(bi[a, b])
            out += math.log10((n + lm.PRIOR * q) / (max(middle(uni[a]), n) + lm.PRIOR))
        return out

    got = {x.doc_id: x.score for x in lm.score_texts(docs_of(rows)).collect()}
    assert sum(abs(got[i] - score(t)) < 1e-9 for i, t in texts.items()) > 0.7 * len(texts)


def test_broadcast_and_shuffled_filters_score_alike(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 16)
    monkeypatch.setattr(lm, "COUNTED_AT_ONCE", 40_000)
    docs = documents(spark, "/root/testdata/sf0.001")
    sent, found = [], spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: sent.append(v) or found(v))
    rows = [sorted(map(tuple, lm.score_texts(docs, broadcast_bytes=n).collect())) for n in (1 << 30, 0)]
    assert rows[0] == rows[1]
    filters, = [v for v in sent if isinstance(v, dict)]        # of the first only
    assert len(filters) > 4 and all(len(x) & (len(x) - 1) == 0 for x in filters.values())


def test_the_broadcast_filter_gives_the_scores(spark, monkeypatch):
    """Emptied on its way to the workers, the filter knows nothing: bigrams no longer lift the scores."""
    docs = documents(spark, "/root/testdata/sf0.001")
    right = {r.doc_id: r.score for r in lm.score_texts(docs).collect()}
    found = spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: found({k: x * 0 for k, x in v.items()}))
    blank = {r.doc_id: r.score for r in lm.score_texts(docs).collect()}
    assert all(blank[i] < right[i] for i in right if right[i] < -10)


def test_size_of_the_filter_is_foretold(spark):
    docs = documents(spark).selectExpr("doc_id", "text", "0 as fold")
    chunks = docs.mapInArrow(lm._chunks, lm.CHUNKS).cache()
    entries = sum(lm._levels(np.array(list(Counter(g).values()))).sum() for g in _grams_of([r.text for r in docs.collect()]))
    assert 0.8 < lm.filter_bytes(chunks, 2) / (entries * lm.BITS_PER_ENTRY / 8) < 1.25


def _grams_of(texts):
    words = [[*WORD.findall((t or "").translate(LOWER)), None] for t in texts]
    return [w for ws in words for w in ws], [p for ws in words for p in zip(ws, ws[1:])]


def test_filter_gives_quantised_counts_back():
    r = np.random.default_rng(1)
    grams, counts = np.unique(r.integers(0, 2**63, 4000).astype(np.uint64)), None
    counts = r.integers(1, 5000, len(grams))
    shift, width = 62, 1 << 19
    table = np.zeros(4 * width // 8, np.uint8)
    for b in range(4):
        mine = lm._segment(grams, shift) == b
        batch = pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([1], pa.int32()), pa.array([grams[mine].tobytes()]),
                                            pa.array([counts[mine].astype(np.int64).tobytes()])], names=["bucket", "kind", "grams", "counts"])
        for out in lm._fill(width, 2)([batch]):
            part = np.frombuffer(out.column(1)[0].as_py(), np.uint8)
            at = out.column(0)[0].as_py()
            table[at:at + len(part)] |= part
    levels = lm._levels_in(table, shift, grams, 1)
    assert (levels >= lm._levels(counts)).all() and (levels == lm._levels(counts)).mean() > 0.98
    assert (lm._levels_in(table, shift, ~grams, 1) == 0).mean() > 0.97
    assert lm._levels(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]


# --- classifiers ----------------------------------------------------------------------
def learned(spark, score, target, sf="/root/testdata/sf0.1"):
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    return score(docs, labels), labels.select("doc_id", target)


def test_toxicity_on_held_out_rows(spark):
    out, labels = learned(spark, toxicity.score_toxicity, "toxic")
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.02 * len(held)


def test_quality_on_held_out_rows(spark):
    out, labels = learned(spark, quality_model.score_quality, "quality")
    held = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_classifiers_on_odd_rows(spark, docs_of, odd_rows):
    words = "good fine kind bad vile nasty".split()
    rows = [(100 + i, " ".join(random.Random(i).choices(words[:3] if i % 2 else words[3:], k=30))) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i, _ in rows] + [(None, 1, 1), (4, None, None), (101, 1, 0), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for f in (toxicity.score_toxicity, quality_model.score_quality):
        out = f(docs_of([*odd_rows, *rows]), labels).collect()
        assert len(out) == len(odd_rows) + len(rows) and all(0 <= r.score <= 1 for r in out)
        assert f(docs_of([]), labels).collect() == []
        assert len(f(docs_of(odd_rows), labels.limit(0)).collect()) == len(odd_rows)
        assert len(f(docs_of(rows), labels.where("toxic = 1")).collect()) == len(rows)


def test_convolution_on_distinct_words_is_the_plain_one():
    model, r = toxicity.TextCNN(), np.random.default_rng(0)
    rows = r.integers(0, toxicity.ROWS, (30, 1 + len(toxicity.PREFIXES)))
    lengths = [5, 0, 1, 2, 17, 0]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    codes = r.integers(0, 30, offsets[-1])
    got = model.logits(rows, codes, offsets)
    for i in range(len(lengths)):
        x = np.concatenate([model.embed[rows[codes[offsets[i]:offsets[i + 1]]]].sum(axis=1), np.zeros((3, toxicity.DIM))])
        pooled = [np.maximum(max(sum(x[t + j] @ k for j, k in enumerate(kernel))[f] for t in range(max(1, lengths[i]))) + b[f], 0)
                  for kernel, b in zip(model.conv, model.bias) for f in range(toxicity.FILTERS)]
        assert abs(got[i] - (np.array(pooled) @ model.out + model.const[0])) < 1e-3


# --- HTML -----------------------------------------------------------------------------
LONG = "It was the best of times and it was the worst of times, and that is what they said in the book that we had on the table."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style><script>var a = "<p>{LONG}</p>";</script></head><body>
<header class="site-header"><a href="/">Home of the site</a></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
<div id="cookie-notice">{LONG}</div><div class="ad">{LONG}</div>{{}}
<aside><p>{LONG}</p></aside><form><label>Name</label><input></form><section class="comments"><p>{LONG}</p></section><footer>&copy; x</footer></body></html>"""


def test_article_with_and_without_its_element():
    body = f"<h2>Title &amp; more</h2><p>{LONG}\n  <b>A&eacute;</b></p><p>Short one.</p><p>{LONG}</p>"
    want = f"Title & more\n\n{LONG} Aé\n\nShort one.\n\n{LONG}"
    assert htmltext.main_text(PAGE.replace("{}", body)) == want
    assert htmltext.main_text(PAGE.replace("{}", f"<article>{body}</article>")) == want
    assert htmltext.main_text(PAGE.replace("{}", "<article><p>Tiny.</p></article>")) == "Tiny."


def test_broken_markup_and_odd_pages():
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<p></p>") == ""
    assert htmltext.main_text("<article><p><b>One &amp; two &am<br><p>Three</article><p>") == "One & two &am\n\nThree"
    assert htmltext.main_text("<article><p>a<br><br>b</p><p class=ad>c</p>") == "a\n\nb"
    assert htmltext.main_text("plain text") == "plain text"
    assert htmltext.main_text("<" * 5000 + "<a " * 3000 + "\"" * 999) is not None


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("<>/pabdivnrtcle \"'=&;!-"), max_size=200))
def test_any_markup_is_read(page):
    htmltext.main_text(page)


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (2, None, ""), (None, "v", f"<main><p>{LONG}</p></main>")], "page_id long, url string, html string")
    out = htmltext.extract(pages.selectExpr("*", "'x' as text", "1 as n_chars"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "u", "", 0), (2, None, "", 0), (2, None, "", 0), (None, "v", LONG, len(LONG))], key=str)
    assert htmltext.extract(pages.limit(0)).collect() == []


def test_articles_of_the_table(spark):
    import html
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in htmltext.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>", " ", re.sub(r"(?:</?(?:p|h1)>)+", "\n\n", body)).split("\n\n")
        assert got[r.page_id] == "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
