"""Line-first quality rules.

Every line is judged by punctuation, navigation and boilerplate rules;
failing lines are removed, and a document that loses too much of its text
by that is rejected.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cairn.llm.words import small_batches, split_words

MIN_WORDS = 50              # fewer: rejected
MAX_REPEATED = 50           # percent of words in repeated three-word windows
MIN_KEPT = 70               # percent of the words that the kept lines must hold
SHORT_LINE = 3              # words; a shorter line without closing punctuation is a menu entry or a label

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
CLOSING = (".", "!", "?", ":", ";", ",", "\"", "'", ")", "]", "…", "”", "’", "»", "。", "！", "？")
MARKS = re.compile(r"[#*$%&|<>{}\[\]=~^_\\@+/]|!{2,}|\?{2,}")
SEPARATORS = re.compile(r"[ \t][|»›•·>][ \t]")
# Phrases of page furniture and notices, in lower case.
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|we use cookies|accept (?:all )?cookies"
    r"|enable javascript|javascript is (?:disabled|required)|sign in to|log in to|subscribe to our|click here"
    r"|^\W*licen[sc]ed under|^\W*copyright\b|^\W*©|lorem ipsum|read more\W*$|share (?:this|on) ",
    re.ASCII)


def _n_words(text: str) -> int:
    return len(text.encode().split())       # bytes part at the same blanks as words do


def line_fault(line: str) -> str | None:
    """Why a line is removed (punctuation, navigation, boilerplate), or None; a line without words has no fault."""
    words = _n_words(line)
    if not words:
        return None
    if BOILERPLATE.search(line.lower()):
        return "boilerplate"
    if len(SEPARATORS.findall(line)) >= 3:
        return "navigation"
    if words < SHORT_LINE and not line.rstrip(BLANKS).endswith(CLOSING):
        return "navigation"
    if 2 * len(MARKS.findall(line)) >= words >= SHORT_LINE:
        return "punctuation"
    return None


def clean_text(text: str) -> tuple[str, int]:
    """The text without failing lines, and the number of lines removed."""
    lines = text.split("\n")
    good = [x for x in lines if line_fault(x) is None]
    return ("\n".join(good), len(lines) - len(good)) if len(good) < len(lines) else (text, 0)


def _repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words covered by three-word windows that occur twice or more."""
    if len(codes) < 4:
        return 0
    pairs = np.unique(codes[:-1] * distinct + codes[1:], return_inverse=True)[1].astype(np.int64)
    _, which, count = np.unique(pairs[:-1] * distinct + codes[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(codes), bool)
    for i in range(3):
        covered[i:len(codes) - 2 + i] |= again
    return int(covered.sum())


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(texts: pa.Array) -> dict[str, list]:
    """Figures, verdicts and cleaned texts of a batch of whole texts."""
    out: dict[str, list] = {c: [] for c in [*FIGURES, "base_failed", "kept", "n_removed_lines", "clean"]}
    raw = pc.fill_null(texts, "")
    for part in split_words(raw, lower=False):
        texts_here = raw.slice(part.start, part.stop - part.start)
        chars = pc.utf8_length(part.vocab).to_numpy(zero_copy_only=False).astype(np.int64)[part.codes]
        total = np.concatenate([[0], np.cumsum(chars)])
        for r, text in enumerate(texts_here.to_pylist()):
            a, b = part.offsets[r], part.offsets[r + 1]
            n = int(b - a)
            codes, local = np.unique(part.codes[a:b], return_inverse=True)
            repeated = _repeated_words(local.astype(np.int64), len(codes))
            failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n
            clean, removed = clean_text(text)
            kept = not failed and (not removed or 100 * _n_words(clean) >= MIN_KEPT * n)
            for c, v in zip(out, (n, int(total[b] - total[a]), sum(text.count(s) for s in SYMBOLS), _dup_lines(text),
                                  repeated, failed, kept, removed, clean), strict=True):
                out[c].append(v)
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_removed_lines, and with ``with_text`` the cleaned text.

    A null or empty text has no words, fails the base rules and is not kept.
    Repeated rows and null ids are judged one by one.  Other columns are
    ignored, and an empty table gives none.
    """
    types = {**dict.fromkeys(FIGURES, pa.int64()), "base_failed": pa.bool_(), "kept": pa.bool_(), "n_removed_lines": pa.int64()}
    if with_text:
        types["clean"] = pa.string()

    def run(batches):
        for batch in small_batches(batches, 1):
            m = measured(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(m[c], t) for c, t in types.items())],
                                             names=["doc_id", *types])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in FIGURES), "base_failed boolean", "kept boolean",
                        "n_removed_lines long", *(["clean string"] if with_text else [])])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` without rejected rows, the kept ones with their cleaned text and all their columns.

    ``size_col``, where there is such a column, becomes the length of the
    cleaned text.  The other cases are as in ``judge``.
    """
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches):
        for batch in small_batches(batches, at):
            m = measured(batch.column(at))
            arrays = list(batch.columns)
            arrays[at] = pa.array(m["clean"], pa.string())
            if size_at is not None:
                arrays[size_at] = pc.utf8_length(arrays[at]).cast(batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema).filter(pa.array(m["kept"]))

    return docs.mapInArrow(run, docs.schema)
