"""Parsing of one postal address into components: pure Python, no Spark.

An address is cut into tokens; unit, country, postcode, region and town are taken out by dictionary; what stays around the
house number is the street.  Street words are expanded by the locale's dictionaries, so that ``4300 N.E. Ft Elm Vly Rd #3``
and ``Fort Elm Valley Road NE 4300`` give the same components in the same order.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

MISSING = {"", "null", "n/a", "na", "-", "none"}
#: Region of places in locales whose addresses name none.
NO_REGION = "--"


def _invert(d: dict[str, str]) -> dict[str, str]:
    return {alias: full for full, aliases in d.items() for alias in aliases.split()}


@dataclass(frozen=True)
class Locale:
    """The dictionaries and habits of a country's addresses; all words folded.

    types, terms, directions: short form -> full form of kinds of street, of words within names, of points of the compass;
    units, signs: words before a unit and before a house number; numbers, ordinals: spelled numbers; routes: words of a numbered
    route -> its full form; type_first: the kind of street comes before its name; endings: short endings of street names ->
    full ones; saint: a first word of a name that stands for saint; tail: the end of an address, with the numbers of its groups
    for town, region (0 if there is none), postcode and country."""

    types: dict[str, str]
    terms: dict[str, str] = field(default_factory=dict)
    directions: dict[str, str] = field(default_factory=dict)
    units: frozenset[str] = frozenset()
    signs: frozenset[str] = frozenset()
    numbers: dict[str, str] = field(default_factory=dict)
    ordinals: dict[str, str] = field(default_factory=dict)
    routes: dict[tuple[str, ...], str] = field(default_factory=dict)
    type_first: bool = False
    endings: dict[str, str] = field(default_factory=dict)
    saint: str = ""
    tail: str = r",?\s*(\d{5})\s+([^,;\d]+?)\s*(?:,\s*([^,;\d]+))?$"
    groups: tuple[int, int, int, int] = (2, 0, 1, 3)


# Abbreviations of an English-language address locale.
STREET_TYPES = {
    "avenue": "av ave aven avenue", "boulevard": "blvd boul boulevard", "circle": "cir circ circle", "court": "ct crt court",
    "drive": "dr drv drive", "lane": "ln lane", "parkway": "pkwy pky parkway", "place": "pl place", "road": "rd road",
    "street": "st str street", "terrace": "ter terr terrace", "trail": "trl trail", "way": "wy way", "highway": "hwy highway",
    "square": "sq square", "alley": "aly alley", "plaza": "plz plaza", "loop": "lp loop", "pike": "pike", "cove": "cv cove",
    "crescent": "cres crescent", "expressway": "expy expressway", "freeway": "fwy freeway", "turnpike": "tpke turnpike", "row": "row",
    "walk": "walk", "path": "path", "bend": "bnd bend", "bypass": "byp bypass", "causeway": "cswy causeway", "close": "close", "mews": "mews",
}
NAME_TERMS = {
    "bridge": "brg bridge", "creek": "crk creek", "crossing": "xing crossing", "ferry": "fry ferry", "hill": "hl hill",
    "hollow": "holw hollow", "mill": "ml mill", "point": "pt point", "ridge": "rdg ridge", "springs": "spg spgs spring springs",
    "station": "sta stn station", "valley": "vly valley", "heights": "hts heights", "lake": "lk lake", "mount": "mt mtn mount",
    "fort": "ft fort", "saint": "saint sainte", "beach": "bch beach", "island": "is island", "harbor": "hbr harbor harbour", "junction": "jct junction",
}
DIRECTIONS = {
    "n": "n north", "s": "s south", "e": "e east", "w": "w west", "ne": "ne northeast", "nw": "nw northwest",
    "se": "se southeast", "sw": "sw southwest",
}
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve"
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth"
ROUTES = {"highway": "hwy highway", "state route": "sr|state route|state rte|state rt|st rt|st rte", "county road": "cr|county road|county rd|co rd|co road", "route": "rte rt route"}

ENGLISH = Locale(
    types=_invert(STREET_TYPES), terms=_invert(NAME_TERMS), directions=_invert(DIRECTIONS),
    units=frozenset("ste suite unit apt apartment rm room fl floor bldg building".split()), signs=frozenset("no num number".split()),
    numbers={w: str(i) for i, w in enumerate(NUMBER_WORDS.split(), 1)},
    ordinals={w: f"{i}{'st' if i == 1 else 'nd' if i == 2 else 'rd' if i == 3 else 'th'}" for i, w in enumerate(ORDINALS.split(), 1)},
    routes={tuple(alias.split()): full for full, s in ROUTES.items() for alias in (s.split("|") if "|" in s else s.split())},
    saint="st", tail=r",\s*([^,;]+),\s*([\p{L}]+)\.?\s+(\d{5})\s*(?:,\s*([^,;\d]+))?$", groups=(1, 2, 3, 4),
)
# The same of three further locales, whose addresses end with postcode and town.
SPANISH = Locale(
    types=_invert({"calle": "c cl calle", "avenida": "av avd avda avenida", "plaza": "pl pza plaza", "paseo": "po pso paseo", "carretera": "ctra carretera", "camino": "cno camino", "ronda": "rda ronda", "travesia": "trv travesia", "glorieta": "gta glorieta"}),
    terms=_invert({"san": "s san", "santa": "sta santa", "doctor": "dr doctor", "general": "gral general", "virgen": "vgen virgen"}),
    units=frozenset("piso planta puerta local bajo esc escalera portal oficina".split()), signs=frozenset("n no num numero".split()), type_first=True,
)
FRENCH = Locale(
    types=_invert({"rue": "r rue", "avenue": "av ave avenue", "boulevard": "bd bld boul boulevard", "place": "pl place", "chemin": "ch chem chemin", "impasse": "imp impasse", "allee": "all allee", "quai": "quai", "route": "rte route", "cours": "crs cours"}),
    terms=_invert({"saint": "st saint", "sainte": "ste sainte", "general": "gal general", "docteur": "dr docteur", "faubourg": "fbg faubourg"}),
    units=frozenset("appt apt etage bat batiment bureau".split()), signs=frozenset("n no num numero".split()), type_first=True,
)
GERMAN = Locale(
    types=_invert({"strasse": "str strasse", "platz": "pl platz", "allee": "allee", "weg": "weg", "gasse": "g gasse", "ring": "ring", "ufer": "ufer", "damm": "damm"}),
    terms=_invert({"sankt": "st skt sankt", "doktor": "dr doktor"}), units=frozenset("whg wohnung etage stock zimmer".split()), signs=frozenset("nr nummer".split()),
    endings={"str": "strasse", "pl": "platz"},
)
LOCALES = {"en": ENGLISH, "es": SPANISH, "fr": FRENCH, "de": GERMAN}
TYPE_OF = ENGLISH.types

_SPLIT = re.compile(r"\s*[,;|\n\t]+\s*|\s+[-–—]+\s+")
TOKEN = re.compile(r"#\s*\w+|\w+(?:['’]\w+)*")
_DOTTED = re.compile(r"\b([nsew])\.\s?([nsew]?)\.?(?=\W|$)")
_KEEP_LATIN = {"ß": "ss", "æ": "ae", "ø": "o", "đ": "d", "ł": "l", "œ": "oe"}


def fold(text: str) -> str:
    """Lower case, compatibility forms as plain letters, no accents, no invisible characters."""
    out = unicodedata.normalize("NFKD", text).casefold()
    if not out.isascii():
        out = "".join(_KEEP_LATIN.get(c, c) for c in out if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return out


@dataclass
class Gazetteer:
    """What is known of towns: all keys folded. ``towns``: name -> regions; ``zips``: postcode -> (town, region);
    ``regions``: abbreviation or full name -> abbreviation; ``countries``: names to leave out."""

    towns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    zips: dict[str, tuple[str, str]] = field(default_factory=dict)
    regions: dict[str, str] = field(default_factory=dict)
    countries: frozenset[str] = frozenset()

    def __post_init__(self):
        self.longest = max((t.count(" ") + 1 for t in self.towns), default=1)
        self._near: dict[str, list[str]] = {}
        for t in self.towns:
            for v in deletes(t):
                self._near.setdefault(v, []).append(t)
        self._memo: dict[str, str | None] = {}

    def near(self, words: str) -> str | None:
        """The one town within one edit of the words, if there is exactly one."""
        if words not in self._memo:
            if len(self._memo) > 200_000:
                self._memo.clear()
            found = {t for v in deletes(words) for t in self._near.get(v, ()) if within_one(words, t)} if len(words) >= 4 else set()
            self._memo[words] = found.pop() if len(found) == 1 else None
        return self._memo[words]


def deletes(word: str) -> set[str]:
    """The word and every form of it with one character deleted."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def within_one(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or swap of neighbours (or nothing) makes a into b."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (i + 1 < len(a) and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


@dataclass
class Address:
    """number, name: filled if the text holds a street; street_type, pre, post, town, region, zip: '' where missing."""

    number: str = ""
    name: str = ""
    street_type: str = ""
    pre: str = ""
    post: str = ""
    town: str = ""
    region: str = ""
    zip: str = ""

    @property
    def is_street(self) -> bool:
        return bool(self.number and self.name)


def parse(text: str | None, gaz: Gazetteer, town: str | None = None, region: str | None = None, zip: str | None = None, locale: Locale = ENGLISH) -> Address:
    """Components of an address. town, region, zip: further columns of the record, used where the text has none."""
    out = Address()
    segments = segments_of(text, locale)
    if not segments:
        return out
    _take_place(segments, gaz, out)
    _from_columns(out, gaz, town, region, zip)
    for k, seg in enumerate(segments):  # "County Road 5, No. 70": the house number stands apart
        if len(seg) == 2 and seg[0] in locale.signs and seg[1].isdigit() and len(segments) > 1:
            segments[k - 1 if k else 1][:] = [seg[1], *segments[k - 1 if k else 1]]
            seg[:] = []
    if locale.type_first:  # "5, rue X" and "Calle X, 5": a house number between commas belongs to the street beside it
        for k, seg in enumerate(segments):
            beside = [x for x in (segments[k + 1 : k + 2] + segments[max(k - 1, 0) : k]) if x and x[0] in locale.types]
            if len(seg) == 1 and re.fullmatch(r"\d{1,4}[a-z]?", seg[0]) and beside:
                beside[0][:0], seg[:] = seg[:], []
    best = None
    for seg in segments:
        seg[:] = [t for i, t in enumerate(seg) if not (t in locale.signs and i + 1 < len(seg) and seg[i + 1].isdigit())]
        found = _street(seg, locale)
        if found and (best is None or found[0] > best[0]):
            best = found
    if best:
        _, out.number, words = best
        _name(words, out, locale)
    return out


def segments_of(text: str | None, locale: Locale = ENGLISH) -> list[list[str]]:
    """The folded tokens of each part of an address, without units; nothing for a missing text."""
    s = fold(text or "").strip()
    if s in MISSING:
        return []
    s = _DOTTED.sub(lambda m: m[1] + m[2] + " ", s)
    segments = [[t.replace(" ", "") for t in TOKEN.findall(x)] for x in _SPLIT.split(s)]
    segments = [_without_units(x, locale) for x in segments if x]
    return [x for x in segments if x]


def _without_units(seg: list[str], locale: Locale) -> list[str]:
    out, i = [], 0
    while i < len(seg):
        t = seg[i]
        if t[0] == "#":
            i += 1
        elif t in locale.units and i + 1 < len(seg) and (len(seg[i + 1]) <= 2 or seg[i + 1].isdigit() or seg[i + 1][0] == "#"):
            i += 2
        else:
            out.append(t)
            i += 1
    return out


def _take_place(segments: list[list[str]], gaz: Gazetteer, out: Address) -> None:
    """Takes country, postcode, region and town out of the segments."""
    for seg in segments:
        seg[:] = [t for t in seg if t not in gaz.countries] if len(seg) > 1 or seg[0] in gaz.countries else seg
    fives = [(k, i, t) for k, seg in enumerate(segments) for i, t in enumerate(seg) if len(t) == 5 and t.isdigit()]
    if fives:
        k, i, t = next((x for x in reversed(fives) if x[2] in gaz.zips), fives[-1])
        out.zip = t
        segments[k][i] = "\0"
    regions = [(k, i, t) for k, seg in enumerate(segments) for i, t in enumerate(seg) if t in gaz.regions]
    if regions:
        # beside the postcode, else alone in its segment, else the last one
        k, i, t = max(regions, key=lambda x: ((x[1] + 1 < len(segments[x[0]]) and segments[x[0]][x[1] + 1] == "\0"), len(segments[x[0]]) == 1, x[0], x[1]))
        out.region = gaz.regions[t]
        segments[k][i] = "\0"
    known = gaz.zips.get(out.zip)
    hits = []
    for k, seg in enumerate(segments):
        taken = [0]
        for t in seg:
            taken.append(taken[-1] + (t == "\0"))
        left = len(seg) - taken[-1]
        for n in range(min(gaz.longest, len(seg)), 0, -1):
            for i in range(len(seg) - n + 1):
                if taken[i + n] != taken[i]:
                    continue
                words = seg[i] if n == 1 else " ".join(seg[i : i + n])
                exact = words in gaz.towns
                whole = left == n
                edge = i == 0 or i + n == len(seg) or seg[i - 1] == "\0" or seg[i + n] == "\0"
                name = words
                if not exact:
                    if n > 2 or not edge:
                        continue
                    name = gaz.near(words)
                    if name is None and n == 2 and words.replace(" ", "") in gaz.towns:
                        name = words.replace(" ", "")
                    if name is None or (not whole and not ((known and known[0] == name) or (out.region and out.region in gaz.towns[name]))):
                        continue
                score = (exact, (known is not None and known[0] == name) + (out.region in gaz.towns[name] if out.region else 0), whole, edge, n, k, i)
                hits.append((score, k, i, n, name))
    if hits:
        _, k, i, n, out.town = max(hits)
        segments[k][i : i + n] = ["\0"] * n
    for seg in segments:
        seg[:] = [t for t in seg if t != "\0"]
    segments[:] = [x for x in segments if x]


def _from_columns(out: Address, gaz: Gazetteer, town: str | None, region: str | None, zip: str | None) -> None:
    town, region, zip = (fold(x or "").strip() for x in (town, region, zip))
    if not out.town and town not in MISSING:
        town = " ".join(TOKEN.findall(town))
        out.town = town if town in gaz.towns else gaz.near(town) or ""
    if not out.region and region not in MISSING:
        out.region = gaz.regions.get(region, "")
    if not out.zip and zip not in MISSING:
        out.zip = zip
    known = gaz.zips.get(out.zip)
    if out.town:
        own = gaz.towns[out.town]
        if out.region not in own:
            out.region = own[0] if len(own) == 1 else known[1] if known and known[0] == out.town else ""
    elif known and (not out.region or known[1] == out.region):
        out.town, out.region = known


def _street(seg: list[str], locale: Locale) -> tuple[tuple, str, list[str]] | None:
    """(score, house number, street words) of a segment, if it holds a street."""
    words, i = [], 0
    while i < len(seg):  # numbered routes first: their number is no house number
        for n in (2, 1):
            r = locale.routes.get(tuple(seg[i : i + n]))
            if r and i + n < len(seg) and re.fullmatch(r"\d{1,3}[a-z]?", seg[i + n]):
                words.append(f"={r} {seg[i + n]}")
                i += n + 1
                break
        else:
            words.append(seg[i])
            i += 1
    numbers = [i for i, t in enumerate(words) if re.fullmatch(r"\d{1,6}[a-z]?", t) and not re.fullmatch(r"\d+(st|nd|rd|th)", t)]
    digits = bool(numbers)
    if not numbers:
        numbers = [i for i, t in enumerate(words) if t in locale.numbers and (i == 0 or i == len(words) - 1 or i + 1 < len(words))]
    best = None
    for i in numbers:
        after, before = words[i + 1 :], words[:i]
        number = locale.numbers.get(words[i], words[i].lstrip("0") or "0")
        if after:
            s = (digits, i == 0, _streetness(after, locale), 1)
            best = max(best or (s, number, after), (s, number, after), key=lambda x: x[0])
        elif before and (_streetness(before, locale) or len(before) <= 4):
            s = (digits, True, _streetness(before, locale), 0)
            best = max(best or (s, number, before), (s, number, before), key=lambda x: x[0])
    return best


def _streetness(words: list[str], locale: Locale) -> int:
    return sum(w in locale.types or w in locale.directions or w in locale.terms or w[0] == "=" or w in locale.ordinals or any(w.endswith(x) and w != x for e in locale.endings.items() for x in e) for w in words)


def _name(words: list[str], out: Address, locale: Locale) -> None:
    words = list(words)
    route = next((i for i, w in enumerate(words) if w[0] == "="), None)
    if len(words) > 1 and words[0] in locale.directions and not (len(words) == 2 and words[1] in locale.types):
        out.pre = locale.directions[words.pop(0)]
    # two words written apart: north east
    if len(words) > 2 and words[-1] in ("east", "west") and words[-2] in ("north", "south"):
        words[-2:] = [words[-2] + words[-1]]
    if len(words) > 1 and words[-1] in locale.directions:
        out.post = locale.directions[words.pop()]
    if locale.type_first:
        if len(words) > 1 and words[0] in locale.types:
            out.street_type = locale.types[words.pop(0)]
    elif route is None and len(words) > 1 and words[-1] in locale.types:
        out.street_type = locale.types[words.pop()]
        if len(words) > 1 and words[-1] in locale.directions and not out.post:
            out.post = locale.directions[words.pop()]
    name = []
    for i, w in enumerate(words):
        if w[0] == "=":
            name.append(w[1:])
        elif locale.saint and w == locale.saint and i == 0 and len(words) > 1:
            name.append("saint")
        else:
            w = locale.ordinals.get(w) or locale.terms.get(w) or w
            short = next((e for e in locale.endings if w.endswith(e) and len(w) > len(e) + 2), None)
            name.append(w[: -len(short)] + locale.endings[short] if short else w)
    out.name = " ".join(name)
