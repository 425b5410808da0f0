"""Matching of one typed value against a reference list by a symmetric-delete dictionary: pure Python, no Spark.

Every reference entry gets a few forms (whole, words sorted, each word without vowels, its head, its initials); each form is
stored under all its deletions of up to ``max_edits`` characters.  A value is looked up under its own deletions, so that the
candidates within the bound are found without comparing with the list.  Candidates are ranked by a weighted
Damerau-Levenshtein distance, then by how often the entry is used.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass

from .address_parse import fold, within_one

# Words that companies and operators add to a name, and short forms of common words.
LEGAL = {"llc", "inc", "ltd", "co", "corp", "gmbh", "plc", "company", "incorporated", "limited", "official", "store", "tm", "r", "the"}
SHORT_WORDS = {"ctr": "center", "centre": "center", "cntr": "center", "clb": "club", "fit": "fitness", "ftns": "fitness", "mkt": "market",
               "std": "studio", "trng": "training", "ath": "athletic", "jr": "junior", "exp": "express", "n": "and", "u": "and"}
LEET = str.maketrans("013457", "oleast")
VOWELS = set("aeiouy")
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEXT = {(a, b) for r in ROWS for a, b in zip(r, r[1:])} | {(a, b) for r, t in zip(ROWS, ROWS[1:]) for i, a in enumerate(r) for b in t[max(0, i - 1) : i + 1]}
#: What it costs to take one letter for another, where that is less than 1: neighbouring keys, and vowels.
_CHEAP = {x + y: 0.8 for a, b in _NEXT for x, y in ((a, b), (b, a))} | {a + b: 0.8 for a in VOWELS for b in VOWELS}
MISSING = {"", "null", "n/a", "na", "-", "none"}
FOUND_LIMIT = 200_000
_CUT = re.compile(r"\s+[-–—|•·]\s+|[|(,;:]|\s+[-–—]$")
_WORD = re.compile(r"[^\W_]+")


def is_missing(value: str | None) -> bool:
    return value is None or fold(value).strip() in MISSING


def words_of(value: str) -> list[str]:
    """Folded words; digits between letters as the letters they look like; & as and."""
    out = []
    for w in _WORD.findall(fold(value).replace("&", " and ")):
        if not w.isalpha() and sum(c.isalpha() for c in w) >= 3:
            w = w.translate(LEET)
        out.append(w)
    return out


def distance(a: str, b: str, bound: float = 9.0) -> float:
    """Weighted Damerau-Levenshtein (optimal string alignment): a swap of neighbours, a doubled or dropped repeat, a
    neighbouring key and a lost vowel cost less than 1."""
    prev2: list[float] = []
    prev = [0.0]
    for j in range(1, len(b) + 1):
        prev.append(prev[-1] + (0.8 if b[j - 1] in VOWELS else 1.0))
    less = [0.0] + [0.7 if j and b[j - 1] == y else 0.8 if y in VOWELS else 1.0 for j, y in enumerate(b)]
    for i in range(1, len(a) + 1):
        x = a[i - 1]
        more = 0.7 if i > 1 and a[i - 2] == x else 1.0
        row = [prev[0] + 1.0]
        for j in range(1, len(b) + 1):
            y = b[j - 1]
            if x == y:
                best = prev[j - 1]
            else:
                best = prev[j - 1] + _CHEAP.get(x + y, 1.0)
            extra = prev[j] + more
            if extra < best:
                best = extra
            lost = row[j - 1] + less[j]
            if lost < best:
                best = lost
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                best = min(best, prev2[j - 2] + 0.8)
            row.append(best)
        if min(row) > bound:
            return bound + 1
        prev2, prev = prev, row
    return prev[-1]


def deletions(word: str, edits: int) -> set[str]:
    out = {word}
    last = {word}
    for _ in range(edits):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


def allowed(form: str) -> int:
    return 0 if len(form) <= 3 else 1 if len(form) <= 6 else 2


@dataclass(frozen=True)
class Form:
    text: str
    entry: int
    cost: float
    kind: str


def initials_of(ws: list[str]) -> str:
    return "".join(w[0] for w in ws if w != "and")


def head_of(ws: list[str], generic: set[str]) -> str:
    """The words before the first one that other families use as well."""
    n = next((i for i, w in enumerate(ws) if i and w in generic), len(ws))
    return "".join(ws[:n])


def keys_of(f: Form, max_edits: int) -> set[str]:
    return deletions(f.text, min(max_edits, allowed(f.text)) if f.kind != "initials" else 0)


def readings(value: str) -> list[list[str]]:
    """The words of a value up to its first separator, and of the whole value."""
    s = unicodedata.normalize("NFKC", value).strip()
    out = []
    for part in dict.fromkeys([p for p in _CUT.split(s) if p and p.strip()][:1] + [s]):
        ws = [SHORT_WORDS.get(w, w) for w in words_of(re.sub(r"#\s*\w+", " ", part))]
        while len(ws) > 1 and ws[0] == "the":
            ws = ws[1:]
        if re.fullmatch(r"\s*(?:\w\s*\.\s*){2,6}", part):
            ws = ["".join(ws)]
        while len(ws) > 1 and (ws[-1] in LEGAL or ws[-1].isdigit()):
            ws = ws[:-1]
        if ws:
            out.append(ws)
    return out


def lookup_keys(value: str | None, longest: int, max_edits: int) -> set[str]:
    """Every key under which a form that the value may mean is stored, for forms of at most ``longest`` characters."""
    out: set[str] = set()
    for ws in [] if is_missing(value) else readings(value):
        for n in range(1, len(ws) + 1):
            if sum(map(len, ws[:n])) > longest + max_edits:
                break
            for text in {"".join(ws[:n]), "".join(sorted(ws[:n]))}:
                out |= deletions(text, min(max_edits, allowed(text)))
    return out


class ReferenceIndex:
    """entries: id -> text; used: id -> how often the entry occurs as it is written (0 if absent)."""

    def __init__(self, entries: dict[int, str], used: dict[int, int] | None = None, max_edits: int = 2, generic: set[str] | None = None, shared: set[str] | None = None):
        """generic: words that entries of different first words share; shared: initials of several entries.  Both are those of the
        whole list; they are found from the entries unless the entries are only some families of a longer list."""
        self.entries, self.used, self.max_edits = entries, used or {}, max_edits
        self.words = {k: words_of(v) for k, v in entries.items()}
        if generic is None:
            firsts = defaultdict(set)
            for ws in self.words.values():
                for w in ws:
                    firsts[w].add(ws[0])
            generic = {w for w, f in firsts.items() if len(f) > 1}
        self.generic = generic
        if shared is None:
            shared = {x for x, n in Counter(initials_of(ws) for ws in self.words.values()).items() if n > 1}
        self.heads = {k: head_of(ws, generic) for k, ws in self.words.items()}
        forms: set[Form] = set()
        family = defaultdict(list)
        for k, h in self.heads.items():
            family[h].append(k)
        # the base of a family of sub-entries: the shortest
        self.base = {h: min(ks, key=lambda k: (len(self.words[k]), -self.used.get(k, 0), k)) for h, ks in family.items()}
        self.extra = {k: [w for w in self.words[k] if w not in self.words[self.base[self.heads[k]]]] for k in entries}
        self.family = dict(family)
        for k, ws in self.words.items():
            forms.add(Form("".join(ws), k, 0.0, "whole"))
            plain = [w for w in ws if w != "and"]
            if len(plain) < len(ws):
                forms.add(Form("".join(plain), k, 0.1, "whole"))
            forms.add(Form("".join(sorted(ws)), k, 0.2, "sorted"))
            for i, w in enumerate(ws):
                bare = w[0] + "".join(c for c in w[1:] if c not in VOWELS)
                if bare != w and len(bare) >= 2:
                    forms.add(Form("".join([*ws[:i], bare, *ws[i + 1 :]]), k, 0.4, "whole"))
            if self.base[self.heads[k]] == k and len(self.heads[k]) >= 4:
                forms.add(Form(self.heads[k], k, 0.5, "head"))
            short = initials_of(ws)
            if len(short) >= 3 and short not in shared:
                forms.add(Form(short, k, 0.3, "initials"))
        self.forms = forms
        self.memo: dict = {}
        self.found: dict = {}
        self.longest = max((len(f.text) for f in forms), default=0)
        self.index: dict[str, list[Form]] = defaultdict(list)
        for f in sorted(forms, key=lambda f: (f.text, f.entry, f.cost)):
            for d in keys_of(f, max_edits):
                self.index[d].append(f)
        self.index = dict(self.index)
        self.exact = {"".join(ws): k for k, ws in sorted(self.words.items(), reverse=True)}

    def _near(self, text: str, kinds: tuple[str, ...]) -> dict[int, tuple[float, str]]:
        """entry -> (cost, kind) of the forms within the bound.  Values share their first words, so what was found is kept."""
        if len(text) > self.longest + self.max_edits:
            return {}
        if (text, kinds) not in self.found:
            if len(self.found) >= FOUND_LIMIT:
                self.found.clear()
            self.found[text, kinds] = self._search(text, kinds)
        return self.found[text, kinds]

    def _search(self, text: str, kinds: tuple[str, ...]) -> dict[int, tuple[float, str]]:
        out: dict[int, tuple[float, str]] = {}
        seen = set()
        for d in deletions(text, min(self.max_edits, allowed(text))):
            for f in self.index.get(d, ()):
                if f.kind not in kinds or f in seen:
                    continue
                seen.add(f)
                if f.kind == "initials" and f.text != text:
                    continue
                bound = allowed(min(text, f.text, key=len))
                x = distance(text, f.text, bound)
                if x <= bound:
                    cost = (x + f.cost, f.kind)
                    if f.entry not in out or cost < out[f.entry]:
                        out[f.entry] = cost
        return out

    def _is_extra(self, word: str, entry: int) -> bool:
        return any(word == x or (len(word) >= 4 and distance(word, x, 2) <= (1 if len(x) < 6 else 1.7)) for x in self.extra[entry])

    def _settle(self, entry: int, rest: list[str]) -> int:
        """The sub-entry of the same family that the words left over name, else the entry."""
        for k in self.family[self.heads[entry]]:
            if k != entry and self.extra[k] and not self.extra[entry] and any(self._is_extra(w, k) for w in rest):
                return k
        return entry

    def match(self, value: str | None) -> tuple[int, float]:
        """(entry id, cost), or (0, inf) if no entry is meant."""
        return self.explain(value)[:2]

    def explain(self, value: str | None) -> tuple[int, float, bool]:
        """(entry id, cost, short): short if the value is no more than the head that several entries share.

        The words of the value up to its first separator are tried as a whole, then without words at the end (a town, a
        company form), then as a head followed by common words; less cost wins, then more words, then more use."""
        if is_missing(value):
            return 0, float("inf"), False
        best = None
        for ws in readings(value):
            found = self._match_words(ws)
            if found and (best is None or found[0] < best[0]):
                best = found
            if best:
                break
        return (best[1], best[0][0], best[2]) if best else (0, float("inf"), False)

    def _match_words(self, ws: list[str]) -> tuple[tuple, int, bool] | None:
        best = None
        for n in range(len(ws), 0, -1):  # costs nothing, so nothing can be better
            k = self.exact.get("".join(ws[:n]))
            if k is not None:
                e = self._settle(k, ws[n:])
                return (0.0, -n, -self.used.get(e, 0), e), e, False
        for n in range(len(ws), 0, -1):
            text, rest = "".join(ws[:n]), ws[n:]
            kinds = ("whole", "head", "initials") if n == 1 else ("whole", "head")
            tried = [(self._near(text, kinds), 0.0)]
            if n > 1:
                tried.append((self._near("".join(sorted(ws[:n])), ("sorted",)), 0.0))
            for got, more in tried:
                for k, (cost, kind) in got.items():
                    if kind == "initials" and rest:
                        continue
                    if kind == "head" and rest and not self._follows_head(k, rest):
                        cost += 0.6
                    e = self._settle(k, rest)
                    key = (round(cost + more, 3), -n, -self.used.get(e, 0), e)
                    if best is None or key < best[0]:
                        best = (key, e, kind == "head" and e == k and len(self.family[self.heads[k]]) > 1 and not (rest and self._follows_head(k, rest)))
        return best

    def _follows_head(self, entry: int, rest: list[str]) -> bool:
        own = self.words[entry]
        return any(rest[0] == w or (len(w) >= 4 and within_one(rest[0], w)) for w in own if w in self.generic)
