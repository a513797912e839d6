"""Parts of Italian postal addresses written as free text.

An address is split at its street type; what stands between that and the civic
number is the street, the rest the municipality. Staircases, floors, interiors and
care-of parts are dropped, suffixes of civic numbers stay.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from tabularium.functions.fold import strip_accents

#: Street types of Italian addresses with their usual abbreviations.
STREET_TYPES = {
    "via": "via", "v": "via", "viale": "viale", "vle": "viale", "corso": "corso", "cso": "corso", "c so": "corso",
    "piazza": "piazza", "pza": "piazza", "pzza": "piazza", "pz": "piazza", "piazzale": "piazzale", "ple": "piazzale", "pzle": "piazzale", "piazzetta": "piazzetta",
    "largo": "largo", "lgo": "largo", "vicolo": "vicolo", "vlo": "vicolo", "vic": "vicolo", "traversa": "traversa", "trav": "traversa", "tr": "traversa",
    "contrada": "contrada", "cda": "contrada", "contr": "contrada", "ctr": "contrada", "localita": "localita", "loc": "localita", "frazione": "frazione", "fraz": "frazione", "fr": "frazione",
    "strada": "strada", "str": "strada", "salita": "salita", "vico": "vico", "lungomare": "lungomare",
    "sp": "sp", "ss": "ss", "sr": "sr",
}
#: Words that qualify the name of a municipality.
QUALIFIERS = {"superiore", "inferiore", "marina", "vecchia", "nuova", "alta", "bassa", "terme", "sotto", "sopra", "piano", "colle", "monte", "mare", "lago"}
#: Shortened first parts of municipality names.
MUNICIPALITY_SHORT = {("b", "go"): "borgo", ("p", "tra"): "pietra", ("c", "llo"): "castello", ("m", "te"): "monte", ("s", "ta"): "santa", ("s", "to"): "santo"}
#: Number words and months of street names that are dates, and the words that begin a part outside the location.
NUMBER_WORDS = {"uno": 1, "primo": 1, "due": 2, "tre": 3, "quattro": 4, "cinque": 5, "sei": 6, "sette": 7, "otto": 8, "nove": 9, "dieci": 10, "undici": 11, "dodici": 12, "tredici": 13, "quattordici": 14, "quindici": 15, "sedici": 16, "diciassette": 17, "diciotto": 18, "diciannove": 19, "venti": 20, "ventuno": 21, "ventidue": 22, "ventitre": 23, "ventiquattro": 24, "venticinque": 25, "ventisei": 26, "ventisette": 27, "ventotto": 28, "ventinove": 29, "trenta": 30, "trentuno": 31}
MONTHS = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")
_SPELT = {
    "loc.ta": "localita", "loc.": "localita", "v.le": "viale", "v.lo": "vicolo", "c.so": "corso", "p.zza": "piazza", "p.za": "piazza", "p.le": "piazzale", "l.go": "largo", "c.da": "contrada", "s.p.": "sp", "s.s.": "ss", "s.r.": "sr",
}
# the first letter comes before the look behind it, so that the search can skip to it
_SPELT_RE = re.compile("|".join(rf"{k[0]}(?<![a-z0-9].){re.escape(k[1:])}" for k in sorted(_SPELT, key=len, reverse=True)))
_ROAD = re.compile(r"\bstr(?:ada|\.)? ?(p)rov(?:inciale|\.)?(?![a-z])|\bstr(?:ada|\.)? ?(s)tat(?:ale|\.)?(?![a-z])|\bstr(?:ada|\.)? ?(r)eg(?:ionale|\.)?(?![a-z])")
_INSIDE = re.compile(
    r"[\s,;–-]*\b(?:(?:scala|sc|interno|int|palazzina|pal|edificio|ed|lotto|stanza|app)\.?\s*(?:[a-z]\s*[/.-]?\s*\d*|\d+\s*[°^]?\s*[/-]?\s*[a-z]?)(?![a-z0-9])|(?:piano|p\.no|capannone)\s*\d+(?![a-z0-9])|piano (?:terra|primo|secondo|rialzato)\b)"
)
_CARE = re.compile(r"\b(?:c/o|presso|at(?:t)?n\.?|alla c\.?a\.? di)\s+(?:[a-z.'’]+\s*){1,3}\d*\s*(?:[,–]|\s-\s)\s*|\b(?:c/o|presso)\s+(?:studio|capannone)\s+(?:[a-z.]+|\d+)\s*")
_SEDE = re.compile(r"^\s*(?:sede(?: legale| operativa)?|indirizzo)\s*:\s*")
_NONE = re.compile(r"[\s,]*(?:\b(?:s\s*\.\s*n\s*\.\s*c\s*\.?|s\s*\.\s*n\s*\.|snc|senza (?:numero(?: civico)?|n\.?)|s/n|sn)(?![a-z0-9]))")
_MARK = r"(?:n(?:r|um|umero)?\s*[.°º]?|civ(?:ico|\.)?\s*(?:n\s*[.°º]?)?|nÂ°|#)"
_KM = re.compile(r"[\s,]*\b(?:al\s+)?km\.?\s*(\d+)\s*(?:[,.+]\s*(\d+))?")
_CIVIC = re.compile(rf"[\s,]*(?:{_MARK}\s*)?(?<![a-z0-9])(\d{{1,4}})(?:(?:\s*/\s*|-|\s*)(bis|ter|quater|[a-z])(?![a-z0-9.'])|\s*[/-]\s*(bis|ter|quater)(?![a-z0-9]))?(?![\d])")
_ROAD_NO = re.compile(rf"\b(sp|ss|sr)\s*(?:{_MARK}\s*)?(\d+)")
_CAP = re.compile(r"(?<!\d)\d{5}(?!\d)")
_PROVINCE = re.compile(r"\(\s*([a-z]{2})\s*\)|(?:[\s,–-])([a-z]{2})\s*[\s,:;–-]*$")
_WORDS = re.compile(r"[a-z0-9']+")
_LEAD = re.compile(rf"\s*(?:\d{{1,2}}|[xvi]+)\s+(?:{'|'.join(MONTHS)})\b")
_LETTERS = re.compile("[a-z]{3}")
_CUT = re.compile(r"\s*(?:,|;|:|\s[–-]\s|#####|\bin\b|(?<!\d)\d{5}(?!\d))")
_BREAK = re.compile(r",|;|\s[–-]\s")
_TYPE = re.compile(r"(?<![a-z0-9.'])(" + "|".join(sorted((re.escape(t) for t in STREET_TYPES), key=len, reverse=True)) + r")(?![a-z0-9])['.]?")
_ROMAN = re.compile(r"(x{0,3})(ix|iv|v?i{0,3})\Z")
_ENDINGS = ("in", "di", "al", "del", "della", "d")


#: Stands for the kind of an address without a street type; all its words are then in ``municipality``, sorted.
UNTYPED = "-"


class Address(NamedTuple):
    """Parts of an address; an empty text where one is missing."""

    municipality: str
    kind: str
    street: str
    civic: str
    postcode: str
    province: str


def roman(word: str) -> int:
    """The value of a Roman number below 40; 0 if it is none."""
    m = _ROMAN.match(word)
    return (10 * len(m[1]) + ({"ix": 9, "iv": 4}.get(m[2]) or 5 * m[2].count("v") + m[2].count("i"))) if m and word else 0


def flat(text: str) -> str:
    """Lower case without accents, one kind of dash and apostrophe, single spaces."""
    return " ".join(strip_accents(text.replace("Â°", "°").replace("°", " ° ")).replace("’", "'").replace("‘", "'").replace("—", "–").split())


def street_words(text: str) -> str:
    """A street name without its type: number words and Roman days as digits, punctuation dropped."""
    words = _WORDS.findall(text.replace(".", ". ").replace("'", " "))
    if len(words) == 2 and words[1] in MONTHS:
        day = NUMBER_WORDS.get(words[0]) or roman(words[0]) or (int(words[0]) if words[0].isdigit() else 0)
        return f"{day} {words[1]}" if day else " ".join(words)
    return " ".join(words)


def civic_number(text: str) -> str:
    """A civic number with its suffix; empty for none."""
    t = flat(text)
    if m := _KM.search(t):
        return f"km{int(m[1])}+{(m[2] or '').ljust(3, '0')}"
    m = _CIVIC.search(t)
    return f"{int(m[1])}{m[2] or m[3] or ''}" if m else ""


def municipality_words(text: str) -> tuple[str, str]:
    """The municipality's words and the province, of what is left of an address."""
    text = " " + _CAP.sub(" ", text).strip(" ,:;–-.") + " "
    province = ""
    if m := _PROVINCE.search(text.rstrip()):
        province = m[1] or m[2]
        text = text[: m.start()] + " " + text[m.end() :]
    words = _WORDS.findall(text.replace("'", " "))
    for short, long in MUNICIPALITY_SHORT.items():
        if words[: len(short)] == list(short) and len(words) > len(short):
            words = [long + words[len(short)], *words[len(short) + 1 :]]
    while words and words[0] in ("in", "a", "di", "comune"):
        words = words[1:]
    while words and words[-1] in _ENDINGS:
        words = words[:-1]
    return " ".join(words), province


def _street_start(text: str) -> re.Match | None:
    """Where the street begins: the first street type that begins the text or follows a separator, else any."""
    found = [m for m in _TYPE.finditer(text) if m.end() < len(text)]
    for m in found:
        before = text[: m.start()].rstrip()
        if not before or before[-1] in ",:;–-)" or before[-1].isdigit() or before.endswith(" in"):
            return m
    return next((m for m in found if len(m[1]) > 2 or text[m.end() - 1] == "." or _ROAD_NO.match(text, m.start())), None)


def parse_address(text: str | None, street_only: bool = False) -> Address:
    """The parts of an address given as one text; NULL or blank gives empty parts. street_only: it names no municipality."""
    if not text or not text.strip():
        return Address("", "", "", "", "", "")
    t = _SEDE.sub("", flat(text))
    t = _CARE.sub(" ", t, count=1)
    t = _ROAD.sub(lambda m: "s" + (m[1] or m[2] or m[3]), t)
    t = _SPELT_RE.sub(lambda m: _SPELT[m[0]] + " ", t)
    t = _INSIDE.sub(" ", t)
    cap = _CAP.search(t)
    start = _street_start(t)
    if not start:
        number = _KM.search(t) or _CIVIC.search(_CAP.sub("#####", t))
        words, province = municipality_words(t[: number.start()] + " " + t[number.end() :] if number else t)
        return Address(" ".join(sorted(words.split())), UNTYPED if words else "", "", civic_number(number[0]) if number else "", cap[0] if cap else "", province)
    kind, head, tail = STREET_TYPES[start[1]], t[: start.start()], t[start.end() :]
    if kind in ("sp", "ss", "sr"):
        m = _ROAD_NO.match(t[start.start() :].replace(".", " ", 1) if t[start.end() - 1] == "." else t[start.start() :])
        number, rest = (m[2], t[start.start() :][m.end() :]) if m else ("", tail)
        km = _KM.search(rest)
        none = _NONE.search(rest)
        if km:
            civic, rest = f"km{int(km[1])}+{(km[2] or '').ljust(3, '0')}", rest[: km.start()] + " " + rest[km.end() :]
        else:
            civic, rest = "", rest[: none.start()] + " " + rest[none.end() :] if none else rest
        muni, province = municipality_words(head + " " + rest)
        return Address(muni, kind, number, civic, cap[0] if cap else "", province)
    plain = _CAP.sub(lambda m: "#####", tail)
    name_end, rest, civic = len(tail), "", ""
    lead = _LEAD.match(plain)
    none, km, number = _NONE.search(plain), _KM.search(plain), _CIVIC.search(plain, lead.end() if lead else 0)
    ends = [m for m in (none, km, number) if m]
    if ends:
        m = min(ends, key=lambda x: x.start())
        name_end, rest = m.start(), tail[m.end() :]
        if m is number:
            civic = f"{int(m[1])}{m[2] or m[3] or ''}"
        elif m is km:
            civic = f"km{int(m[1])}+{(m[2] or '').ljust(3, '0')}"
    name = tail[:name_end]
    if not head.strip(" ,:;–-") or not _LETTERS.search(head):
        # the municipality follows; without a number it begins after a separator
        cut = _CUT.search(name)
        if cut:
            name, rest = name[: cut.start()], name[cut.end() :] + " " + rest
        muni, province = municipality_words(rest)
    else:
        muni, province = municipality_words(head)
        name = _BREAK.split(name.strip(" ,;–-"), maxsplit=1)[0]
    words = street_words(name).split()
    if not muni and len(words) > 1 and not street_only:
        if len(words) > 2 and len(words[-1]) == 2:
            province = words.pop()
        at = len(words) - 1
        while at > 1 and (words[at] in QUALIFIERS or words[at] in _ENDINGS):
            at -= 1
        muni, words = " ".join(words[at:]), words[:at]
    return Address(muni, kind, " ".join(words), civic, cap[0] if cap else "", province)


def parse_review(municipality: str | None, street: str | None, civic: str | None) -> Address:
    """The parts of an address given in three columns."""
    if not street:
        return Address("", "", "", "", "", "")
    a = parse_address(f"{street}, {civic}" if civic else f"{street}, snc", True)
    muni, province = municipality_words(flat(municipality or ""))
    return a._replace(municipality=muni, province=province)
