"""Passages of held-out test items inside a training corpus, found through suffix arrays of the corpus."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookalike import INVISIBLE, LOOKALIKES

#: Words of a shard: a suffix array holds about this many, and a task works through its shards one after the other.
SHARD_WORDS = 1_000_000
#: Most words of all test items together: they are broadcast.
MAX_TEST_WORDS = 1_000_000
#: Matches of a shard that are looked at together.
MATCHES_AT_ONCE = 2_000_000

# a tag ends before the next bracket, so that a text is read once however long its tags are
_INLINE = re.compile(r"</?(?:a|b|i|u|s|em|strong|span|code|mark|sub|sup|small|big|font|tt|kbd|q|cite)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\([nrtbfv])|\\(.)|%([0-9A-Fa-f]{2})", re.S)
_INVISIBLE = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: "\\U%08x" % int(m[1], 16), INVISIBLE))
_WORD = re.compile(r"[^\W_]+")
_FOLDED = str.maketrans({k.casefold(): v.casefold() for k, v in LOOKALIKES.items() if len(k.casefold()) == 1})


def _unescape(m: re.Match) -> str:
    if m[1] or m[2]:
        return chr(int(m[1] or m[2], 16))
    if m[5]:
        c = int(m[5], 16)
        return chr(c) if 32 <= c < 127 else " "
    return " " if m[3] else m[4]


def without_comments(text: str) -> str:
    """Without <!-- ... -->, each as a blank; a comment that is never closed stays."""
    out, at = [], 0
    while (start := text.find("<!--", at)) >= 0 and (end := text.find("-->", start + 4)) >= 0:
        out += [text[at:start], " "]
        at = end + 3
    return "".join([*out, text[at:]]) if out else text


def words(text: str | None) -> list[str]:
    """The words of a text apart from case, punctuation, layout, mark-up, escapes, look-alike and invisible characters."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", without_comments(text)))
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text or "%" in text:
        text = _ESCAPE.sub(_unescape, text)
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
        text = unicodedata.normalize("NFKC", text.translate(str.maketrans(LOOKALIKES)).casefold().translate(_FOLDED))
        return _WORD.findall(text)
    return _WORD.findall(text.lower())


class Passages:
    """The test passages as word ids: ids from 1, in one array, with where each starts and whose it is."""

    def __init__(self, items: list[tuple], min_words: int):
        self.min_words = min_words
        self.ids: dict[str, int] = {}
        seqs, self.owner = [], []
        for key, field, text in items:
            ws = words(text)
            if len(ws) >= min_words:
                seqs.append(np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in ws], dtype=np.int32))
                self.owner.append((key, field))
        self.text = np.concatenate([x for s in seqs for x in (s, [0])]).astype(np.int32) if seqs else np.zeros(0, np.int32)
        self.starts = np.cumsum([0] + [len(s) + 1 for s in seqs])[:-1].astype(np.int64) if seqs else np.zeros(0, np.int64)
        lengths = np.array([len(s) for s in seqs], dtype=np.int64)
        # every suffix of at least min_words words
        self.suffix = np.concatenate([s + np.arange(n - min_words + 1) for s, n in zip(self.starts, lengths)]) if seqs else np.zeros(0, np.int64)
        self.suffix_owner = np.repeat(np.arange(len(seqs)), np.maximum(0, lengths - min_words + 1))
        # the different beginnings of suffixes, and which of them each suffix has
        self.grams, self.gram_of = np.unique(_gather(self.text, self.suffix, min_words), axis=0, return_inverse=True)
        self.gram_of = self.gram_of.reshape(-1)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes in the order of their first ``depth`` words or more (prefix doubling)."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        top = np.int64(rank.max()) + 2
        further = np.zeros(len(rank), np.int64)
        further[: len(rank) - step] = rank[step:] + 1
        rank = np.unique(rank * top + further, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


def _gather(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Words at+0..at+n-1 of each suffix; -1 beyond the end."""
    i = at[:, None] + np.arange(n)[None, :]
    out = np.full(i.shape, -1, np.int32)
    ok = i < len(text)
    out[ok] = text[i[ok]]
    return out


def _bound(text: np.ndarray, sa: np.ndarray, queries: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of all queries at once: the first suffix whose first words are >= (upper: >) the query's."""
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(sa), np.int64)
    n = queries.shape[1]
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        got, q = _gather(text, sa[mid], n), queries[open_]
        differs = got != q
        first = differs.argmax(axis=1)
        rows = np.arange(len(open_))
        a, b = got[rows, first], q[rows, first]
        less = np.where(differs.any(axis=1), a < b, upper)
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


def search_shard(tests: Passages, text: np.ndarray, at_once: int = MATCHES_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index into tests.suffix, position in the shard, words) of every match of min_words words or more that can be extended
    on neither side.

    The first min_words words of every test suffix are searched once each, however many suffixes begin with them; the matches of
    all suffixes are looked at at_once at a time, and only those that begin where no longer match does are kept."""
    m = tests.min_words
    sa = suffix_array(text, m)
    lo, hi = _bound(text, sa, tests.grams, False), _bound(text, sa, tests.grams, True)
    count = (hi - lo)[tests.gram_of]
    ends = np.cumsum(count)
    for first in range(0, int(ends[-1]) if len(ends) else 0, at_once):
        k = np.arange(first, min(first + at_once, int(ends[-1])))
        q = np.searchsorted(ends, k, side="right")
        at = sa[lo[tests.gram_of[q]] + k - (ends - count)[q]]
        t = tests.suffix[q]
        # only where the words before differ: the others are inside a longer match
        before_t = np.where(t > 0, tests.text[np.maximum(t - 1, 0)], 0)
        before_c = np.where(at > 0, text[np.maximum(at - 1, 0)], 0)
        left = (before_t == 0) | (before_t != before_c)
        q, at, t = q[left], at[left], t[left]
        n = np.full(len(q), m, np.int64)
        live = np.arange(len(q))
        while len(live):
            i, j = t[live] + n[live], at[live] + n[live]
            ok = (i < len(tests.text)) & (j < len(text))
            live, i, j = live[ok], i[ok], j[ok]
            same = (tests.text[i] == text[j]) & (tests.text[i] != 0)
            live = live[same]
            n[live] += 1
        if len(q):
            yield q, at, n


def find_leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, fields: list[str], min_words: int = 12, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, item_id, field, item_word, doc_word, n_words): every longest verbatim run of at least min_words consecutive words
    of an item's field in a document, with the places of its first word.

    Words are compared apart from case, punctuation, line layout, mark-up, escapes, look-alike and invisible characters.  The
    corpus is never shuffled: each task cuts its documents into shards, builds a suffix array of each and searches every suffix
    of the test passages in it by binary search.  Only runs of min_words words that all occur in the test items enter the arrays,
    since no match can leave such a run.  Null and empty texts match nothing; a field of fewer than min_words words can't leak;
    repeated documents or items give the same rows once.  The test items are broadcast: more than MAX_TEST_WORDS words of them
    are taken in several passes.
    """
    spark = docs.sparkSession
    flat = [items.select(F.col(item_id).alias("_item"), F.lit(f).alias("_field"), F.col(f).alias("_text")) for f in fields]
    tests = flat[0]
    for x in flat[1:]:
        tests = tests.unionByName(x)
    tests = tests.where(F.col("_text").isNotNull()).distinct()
    total = tests.agg(F.sum(F.length("_text"))).first()[0] or 0
    passes = max(1, -(-int(total) // (4 * MAX_TEST_WORDS)))
    d = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    schema = T.StructType([
        T.StructField("_doc", d.schema["_doc"].dataType), T.StructField("_item", tests.schema["_item"].dataType), T.StructField("field", T.StringType()),
        T.StructField("item_word", T.LongType()), T.StructField("doc_word", T.LongType()), T.StructField("n_words", T.LongType()),
    ])
    out = None
    for k in range(passes):
        part = tests if passes == 1 else tests.where(F.pmod(F.xxhash64("_item"), F.lit(passes)) == k)
        shared = spark.sparkContext.broadcast(Passages([tuple(r) for r in part.collect()], min_words))
        found = d.mapInPandas(_scan(shared, shard_words), schema)
        out = found if out is None else out.unionByName(found)
    return out.distinct().withColumnsRenamed({"_doc": doc_id, "_item": item_id})


def _scan(shared, shard_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tests: Passages = shared.value
        m, ids = tests.min_words, tests.ids
        runs: list[np.ndarray] = []
        where: list[tuple[object, int]] = []
        held = 0

        def flush() -> Iterator[pd.DataFrame]:
            starts = np.cumsum([0] + [len(r) + 1 for r in runs])[:-1]
            text = np.concatenate([x for r in runs for x in (r, [0])]).astype(np.int32)
            for q, at, n in search_shard(tests, text):
                run_of = np.searchsorted(starts, at, side="right") - 1
                owner = tests.suffix_owner[q]
                yield pd.DataFrame({
                    "_doc": [where[r][0] for r in run_of],
                    "_item": [tests.owner[o][0] for o in owner],
                    "field": [tests.owner[o][1] for o in owner],
                    "item_word": tests.suffix[q] - tests.starts[owner],
                    "doc_word": [where[r][1] for r in run_of] + (at - starts[run_of]),
                    "n_words": n,
                })
            runs.clear()
            where.clear()

        if not len(tests.suffix):
            for _ in batches:
                pass
            return
        for pdf in batches:
            for doc, text in zip(pdf["_doc"], pdf["_text"]):
                a = np.array([ids.get(w, 0) for w in words(text)], dtype=np.int32)
                if len(a) < m:
                    continue
                cut = np.flatnonzero(np.r_[True, a == 0, True])  # just before each stretch of known words
                for s, e in zip(cut[:-1], cut[1:] - 1):
                    if e - s >= m:
                        runs.append(a[s:e])
                        where.append((doc, int(s)))
                        held += int(e - s)
                if held >= shard_words:
                    yield from flush()
                    held = 0
        if runs:
            yield from flush()

    return run


def leaked_items(leaks: DataFrame, item_id: str, doc_id: str) -> DataFrame:
    """(item_id, n_docs, longest): the test items that leaked, in how many documents, and the longest run in words."""
    return leaks.groupBy(item_id).agg(F.count_distinct(doc_id).alias("n_docs"), F.max("n_words").alias("longest"))


def remove_leaked(docs: DataFrame, leaks: DataFrame, doc_id: str) -> DataFrame:
    """The documents in which nothing leaked; a document with a null id stays."""
    return docs.join(leaks.select(doc_id).distinct(), doc_id, "left_anti")
