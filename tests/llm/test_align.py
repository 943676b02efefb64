import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from llm_data import docs_of, documents, odd_rows  # noqa: F401
from tokenizers import Tokenizer

from cairn.llm import align as al

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(rows):
    """By sets of byte ends, with the plain tokenizers and every pair of occurrences that end together."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    letter, n = {chr(x): x for x in plain}, 256
    for x in range(256):
        if x not in plain:
            letter[chr(n)], n = x, n + 1
    out, links, count = [], [], Counter()
    for doc, text in rows:
        mine, row = [], [doc, 0, 0, 0, ""]
        if text:
            ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ba = [bytes(letter[c] for c in a.id_to_token(i)) for i in ia]
            bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
            if b"".join(ba) == b"".join(bb) == (" " + text).encode():
                ea, eb = ([sum(map(len, x[:k + 1])) for k in range(len(x))] for x in (ba, bb))
                both = sorted(set(ea) & set(eb))
                sides = []
                for e, ids in ((ea, ia), (eb, ib)):
                    parts = defaultdict(list)
                    for end, i in zip(e, ids):
                        parts[min(x for x in both if x >= end)].append(str(i))
                    sides.append(parts)
                text_of = ";".join(",".join(sides[0][x]) + "|" + ",".join(sides[1][x]) for x in both)
                mine = [(x, y) for ex, x in zip(ea, ia) for ey, y in zip(eb, ib) if ex == ey]
                row = [doc, len(ia), len(ib), len(both), hashlib.sha256(text_of.encode()).hexdigest()]
        count.update(mine)
        out.append(row)
        links.append(mine)
    top = defaultdict(int)
    for (x, y), c in count.items():
        top[y] = max(top[y], c)
    return sorted(((d, na, nb, ng, len(m), sum(count[p] == top[p[1]] for p in m), sum(count[p] for p in m), h)
                   for (d, na, nb, ng, h), m in zip(out, links)), key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.lists(st.booleans(), min_size=180, max_size=180))
@settings(max_examples=300, deadline=None)
def test_align_finds_every_common_end(sizes, cut):
    """Any two ways to cut the same bytes, long equal stretches included."""
    a = [sum(sizes[:k + 1]) for k in range(len(sizes))]
    b = sorted({x for x, c in zip(range(1, a[-1]), cut) if (x in a) != (c and x % 7 == 0)} | {a[-1]})
    ga, gb = al.align(a, b)
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in ga] == common and [b[j - 1] for j in gb] == common


def test_align_jumps_long_stretches():
    class Probed(list):
        slices = 0

        def __getitem__(self, k):
            Probed.slices += isinstance(k, slice)
            return super().__getitem__(k)

    a = Probed(range(1, 100_001))
    assert al.align(a, list(range(1, 100_001)))[0] == list(range(1, 100_001))
    assert Probed.slices < 40


def test_shift_updates_after_irregular_groups():
    assert al.align([1, 2, 5, 6, 7, 9], [1, 2, 3, 4, 5, 6, 7, 8, 9]) == ([1, 2, 3, 4, 5, 6], [1, 2, 5, 6, 7, 9])


def test_against_brute_force(spark, docs_of):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in documents(spark, "/root/testdata/sf0.001").where("length(text) < 1500").collect()]
    rows += [(-1, "<|endoftext|> and <s> </s> <unk>"), (-2, "a▁b"), (-3, "tabs\t and  blanks \n\n"), (-4, "\U0001f600́ \x00 \x85")]
    assert got(al.align_tokenizers(docs_of(rows), A, B, P.PATTERN)) == brute(rows)


def test_odd_rows(spark, docs_of, odd_rows):  # noqa: F811
    rows = [(i, t) for i, t in odd_rows if not t or len(t) < 5000]
    assert got(al.align_tokenizers(docs_of(rows), A, B, P.PATTERN)) == brute(rows)
    assert got(al.align_tokenizers(docs_of([]), A, B, P.PATTERN)) == []
    long = al.align_tokenizers(docs_of(odd_rows), A, B, P.PATTERN).collect()
    assert len(long) == len(odd_rows) and {r.n_a > 50_000 for r in long if r.doc_id in (7, 8)} == {True}


def test_run_without_blanks_takes_the_other_library():
    x = al.Aligner(A, B, P.PATTERN)
    text = "abcdefghij" * 5000
    assert x.a.ids(text) == x.a.whole.encode(text, add_special_tokens=False).ids and x.tokens(text) is not None


@pytest.mark.parametrize("text", ["plain words, 12 345.", "éß中文 \U0001f600", " x  y ", "\n\nA's b"])
def test_fast_ids_equal_the_plain_tokenizer(text):
    x = al.ByteLevel(A, P.PATTERN)
    assert x.ids(text) == al.ByteLevel(A).ids(text) and b"".join(x.bytes[i] for i in x.ids(text)).decode() == text


def test_short_runs_are_compared_without_stretches():
    class Probed(list):
        slices = 0

        def __getitem__(self, k):
            Probed.slices += isinstance(k, slice)
            return super().__getitem__(k)

    b = list(range(1, 10_001))
    a = Probed(x for x in b if x % 8)                                # a run of seven, then two tokens against one
    ga, gb = al.align(a, b[:-1])
    assert [a[i - 1] for i in ga] == list(a) and [b[j - 1] for j in gb] == list(a)
    assert Probed.slices < 10


def test_texts_aligned_together_are_those_aligned_alone(monkeypatch):
    x = al.Aligner(A, B, P.PATTERN)
    texts = ["plain words, 12 345.", None, "a▁b", "", " x  y ", "tabs\t and  blanks \n\n", "éß中文 \U0001f600", "plain words", "unterscheidbar " * 40]
    calls, real = [], al.group_ends
    monkeypatch.setattr(al, "group_ends", lambda a, b: calls.append(len(a)) or real(a, b))
    rows, links = x.rows(texts)
    assert len(calls) == 1 and calls[0] == sum(r[0] for r in rows)
    alone = [x.rows([t]) for t in texts]
    assert rows == [r for one, _ in alone for r in one] and links.tolist() == [k for _, some in alone for k in some.tolist()]
    assert len(links) == sum(r[2] for r in rows) and [i for i, r in enumerate(rows) if r == (0, 0, 0, "")] == [1, 2, 3]
    assert x.rows([None, ""])[1].tolist() == []
