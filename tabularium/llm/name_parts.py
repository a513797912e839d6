"""Names of companies and persons as typed: core words, legal form, phonetic codes, comparison."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

from tabularium.functions.fold import strip_accents
from tabularium.llm.distances import distance, jaro_winkler, within

#: Legal forms and other additions that do not tell one subject from another, in the order in which they are taken out.
LEGAL_FORMS = (
    (r"societa a responsabilita limitata semplif\w*|soc a r l semplif\w*|s ?r ?l ?semplif\w*|s ?r ?l ?s", "srls"),
    (r"societa a responsabilita limitata|soc a resp lim\w*|soc a r ?l|s ?r ?l", "srl"),
    (r"societa per azioni|soc per az\w*|s ?p ?a", "spa"),
    (r"societa in accomandita semplice|soc in acc semplice|s ?a ?s", "sas"),
    (r"societa in nome collettivo|(?:soc |societa )?in nome coll\w*|s ?n ?c", "snc"),
    (r"societa cooperativa(?: sociale)?(?: a ?r ?l)?|soc(?:ieta)? coop\w*(?: a ?r ?l)?|scarl|coop(?: a ?r ?l)?|s ?c", "coop"),
    (r"societa semplice|s s", "ss"),
)
ADDITIONS = r"in liquidazione|in concordato(?: preventivo)?|concordato preventivo|in amministrazione straordinaria|unipersonale|a socio unico|con socio unico|mandataria|mandante|capogruppo|sede secondaria|detto \w+|in a t i|ati"
INDIVIDUAL = r"ditta individuale|impresa individuale|impresa edile|imp ind(?:ividuale)?|imp edile|ditta ind|d i|ditta|impresa|imp"
#: Words without weight, and usual short forms of whole words.
STOP = {"di", "e", "ed", "a", "c", "figli", "dei", "del", "della"}
LOOSE = {"nuova", "nuovo", "gruppo", "group", "eredi", "italiana", "italia", "fratelli", "holding", "a", "2", "0"}
LEGAL_WORDS = ("societa", "responsabilita", "limitata", "semplificata", "cooperativa", "accomandita", "semplice", "individuale", "impresa", "unipersonale", "consorzio", "fratelli", "azioni", "detto")
SHORT = {"flli": "fratelli", "czio": "consorzio", "cons": "consorzio", "cls": "calcestruzzi", "soc": "societa"}
#: Given names and their usual short forms.
NICKNAMES = {
    "agostino": "tino ago", "alessandro": "sandro ale alex", "andrea": "drea", "anna": "annina nina annetta", "antonietta": "tonia etta nietta tonina", "antonio": "tonino nino toni totonno tony",
    "barbara": "barbarina babi", "bartolomeo": "meo bartolo", "caterina": "rina cate katia titina", "concetta": "cettina tina concettina titina", "cristina": "cri cristi tina", "davide": "david", "domenico": "mimmo mico menico nico",
    "elena": "lena ele", "elisabetta": "betta lisa elisa betty", "emanuele": "manuele lele manu", "ernesto": "erno", "eugenio": "genio gegio", "federico": "fede rico chicco", "ferdinando": "nando ferdi", "filippo": "pippo fil",
    "francesca": "franca cesca checca", "francesco": "franco ciccio checco cesco", "gaetano": "tano nino", "giacomo": "mino giacomino mimmo", "giovanna": "gianna vanna giovannina", "giovanni": "gianni nanni vanni giovannino",
    "giuseppe": "beppe peppe pino peppino bepi geppe", "giuseppina": "pina giusy peppina pinuccia", "immacolata": "imma tina", "leonardo": "leo nardo", "loredana": "dana lori", "lorenzo": "renzo enzo lori", "luigi": "gigi gino luigino",
    "margherita": "rita marghe", "maria": "mary mariuccia", "mario": "marietto", "matteo": "teo", "michele": "michi lino chele", "nicola": "nico cola nicolino", "pasquale": "lino pasqualino pascal", "raffaele": "lello raffa raf",
    "roberto": "berto robi roby", "rosaria": "sara rosa saretta rosy", "salvatore": "totò toto tore turi salvo", "silvia": "silvietta", "stefano": "ste fano stefanino", "teresa": "tere resi terry sina", "tommaso": "masino tom maso tommy",
    "umberto": "berto umbe", "valentina": "vale tina", "vincenzo": "enzo cenzo vincenzino",
}
_NICK = {}
for _name, _short in NICKNAMES.items():
    for _s in _short.split():
        _NICK.setdefault(_s, set()).add(_name)
_FORMS = [(re.compile(rf"(?<![a-z0-9])(?:{p})(?![a-z0-9])"), f) for p, f in LEGAL_FORMS]
_ADD = re.compile(rf"(?<![a-z0-9])(?:{ADDITIONS})(?![a-z0-9])")
_IND = re.compile(rf"^(?:nuova )?(?:{INDIVIDUAL})(?![a-z0-9])")
_LEGAL_SHORT = re.compile(r"(?<![a-z0-9])(soc|imp|ind|az|coop|resp|lim|acc|semplif)\.")
_CONTRACTED = re.compile(r"(?<![a-z.])([a-z]{1,7})\.([a-z]{1,4})\b(?!\.)")
_ABBREVIATED = re.compile(r"(?<![a-z.])([a-z]{1,8})\.(?=[\s,)]|$)")
_GLUED_FORM = re.compile(r"(?<=[a-z]{3})(s\. ?(?:r\. ?l\.|p\. ?a\.|n\. ?c\.|a\. ?s\.)(?: ?s\.)?|s r l(?: s)?\b|s n c\b|s a s\b|s p a\b|srls?\b|snc\b)")
_SOUNDS = (("ch", "k"), ("gh", "g"), ("ph", "f"), ("qu", "k"), ("sch", "sk"), ("c", "k"), ("q", "k"), ("z", "s"), ("y", "i"), ("w", "v"), ("x", "s"), ("j", "i"))


#: Least Jaro–Winkler similarity of two words that agree, and of two words that few edits lie between.
ALIKE, EDITED = 0.94, 0.75


class Name(NamedTuple):
    """A name's core words (a word cut short ends in ``.``, one contracted has ``.`` inside), its legal form and whether it is marked as a sole trader's."""

    words: tuple[str, ...]
    form: str
    sole: bool


def _mended(word: str) -> str:
    """A legal word with a typo, put right; any other word as it is."""
    if len(word) < 6 or word in LEGAL_WORDS or word == "collettiva":
        return word
    return next((w for w in LEGAL_WORDS if word[0] == w[0] and within(word, w, 1)), word)


@lru_cache(maxsize=500_000)
def parse_name(text: str) -> Name:
    """The parts of a name; a name without any core word keeps all its words."""
    t = strip_accents(text).replace("’", "'")
    t = _GLUED_FORM.sub(r" \1", t)
    t = re.sub(r"[&+]\s*c\b\.?", " ", t)
    t = re.sub(r"(?<![a-z0-9])(f|c)[. ]+(lli|zio)(?![a-z0-9])", r"\1\2", t)
    t = re.sub(r"(?<![a-z0-9.])(?:[a-z]\.){2,}(?:[a-z](?![a-z0-9]))?", lambda m: " " + m[0].replace(".", "") + " ", t)
    t = _LEGAL_SHORT.sub(r"\1 ", t)
    t = re.sub(r"(?<![a-z0-9])(?:f\.lli|flli)(?=[a-z])", "fratelli ", t)
    t = re.sub(r"(?<=[a-z]{4})f\. ?lli(?![a-z])", " fratelli ", t)
    t = re.sub(r"(?<![a-z0-9])(?:c\. ?zio|czio)(?=[a-z]{3})", "consorzio ", t)
    t = re.sub(r"(?<![a-z0-9])([a-z]{2,})\.(?=[a-z]{5}|[a-z]{3,}\.)", r"\1. ", t)
    t = _CONTRACTED.sub(lambda m: f"{m[1]}_{m[2]}", t)
    t = _ABBREVIATED.sub(lambda m: m[1] + "__ ", t)
    words = re.sub(r"[^a-z0-9_]+", " ", t.replace("'", "")).split()
    marked = " ".join(map(_mended, words))
    form = ""
    for pattern, f in _FORMS:
        marked, n = pattern.subn(" ", marked)
        if n and not form:
            form = f
        marked = " ".join(marked.split())
    marked = " ".join(_ADD.sub(" ", marked).split())
    rest = _IND.sub("", marked).removeprefix("__").strip()
    sole = rest != marked and bool(rest)
    core = []
    for w in (rest or marked or t).split():
        w = SHORT.get(w.replace("_", ""), w)
        if w not in STOP:
            core.append(w.replace("__", ".").replace("_", "."))
    return Name(tuple(core) or tuple((t or text).split()), form, sole)


@lru_cache(maxsize=500_000)
def phonetic(word: str) -> str:
    """Code of a word by its sound: first letter and the consonants after it, doubled letters and like sounds merged."""
    w = word.replace(".", "")
    for a, b in _SOUNDS:
        w = w.replace(a, b)
    w = re.sub(r"(.)\1+", r"\1", w)
    return w[:1] + re.sub("[aeiouh]", "", w[1:])


def code_keys(word: str) -> set[str]:
    """The phonetic code and the codes with one letter less, so that words one sound apart share a key."""
    code = phonetic(word)
    return {code, *(code[:i] + code[i + 1 :] for i in range(len(code)))} if len(code) > 3 else {code}


def _initial(letter: str, word: str) -> float:
    """How well an initial fits a word: given names before other words."""
    if word[0] == letter or any(n[0] == letter for n in _NICK.get(word, ())):
        return 0.62 if word in NICKNAMES or word in _NICK else 0.6
    return 0.0


def unjoined(core: str, common: frozenset[str]) -> str:
    """Core words with those taken apart that begin or end with a common word written together with another."""
    out = []
    for word in core.split(" "):
        plain = word.strip(".")
        if len(plain) > 8 and word not in common:
            cut = next((n for n in range(len(plain) - 3, 3, -1) if plain[:n] in common or plain[:n] in ("consorzio", "fratelli", "flli")), 0)
            if not cut:
                cut = next((n for n in range(3, len(plain) - 3) if plain[n:] in common or plain[n:] in ("consorzio", "fratelli", "flli")), 0)
            if cut:
                out += [SHORT.get(w, w) for w in (word[:cut], word[cut:]) if w not in STOP]
                continue
        out.append(word)
    return " ".join(out)


@lru_cache(maxsize=1_000_000)
def word_score(a: str, b: str) -> float:
    """How well two words agree: 1 equal, less for typos, nicknames and short forms, 0 for different words."""
    if a == b:
        return 1.0
    x, y = a.replace(".", ""), b.replace(".", "")
    if x == y:
        return 1.0
    if "." in a or "." in b:
        short, full = (a, b) if "." in a and ("." not in b or len(a) <= len(b)) else (b, a)
        head, _, tail = short.partition(".")
        full_plain = full.replace(".", "")
        if "." in full and len(head) > 2:
            other, _, end = full.partition(".")
            if len(other) > 2 and (head.startswith(other) or other.startswith(head)) and (not tail or not end or tail == end):
                return 0.8
        if len(head) == 1 and not tail:
            return _initial(head, full_plain)
        if full_plain.startswith(head) and (not tail or full_plain.endswith(tail)):
            return 0.9
        if len(head) > 2 and within(full_plain[: len(head)], head, 1) and (not tail or full_plain.endswith(tail)):
            return 0.8
        return 0.8 if len(head) > 3 and full_plain.startswith(head) and tail[-1:] == full_plain[-1:] else 0.0
    if x.isdigit() or y.isdigit():
        return 0.0
    if len(x) == 1 or len(y) == 1:
        return _initial(min(x, y, key=len), max(x, y, key=len))
    if y in _NICK.get(x, ()) or x in _NICK.get(y, ()):
        return 0.85
    if x in NICKNAMES and y in NICKNAMES:
        return 0.0
    for short_name, full_name in ((x, y), (y, x)):
        if any(within(full_name, n, 1) for n in _NICK.get(short_name, ())):
            return 0.8
        if len(short_name) > 5 and full_name in NICKNAMES and any(len(n) > 4 and within(short_name, n, 1) for n in NICKNAMES[full_name].split()):
            return 0.78
    short = min(len(x), len(y))
    if short < 3:
        return 0.0
    if len(x) != len(y) and max(len(x), len(y)) > 6 and (x.startswith(y) or y.startswith(x)):
        return 0.7
    if short > 7 and (x.endswith(y) or y.endswith(x)):
        return 0.8
    if short < 4:
        return 0.0
    few = within(x, y, 1 if short < 8 else 2)
    if not few and x[0] != y[0]:
        return 0.0
    j = jaro_winkler(x, y)
    if j >= (EDITED if few else ALIKE):
        return j
    return 0.76 if (x in NICKNAMES) != (y in NICKNAMES) and x[0] == y[0] and within(x, y, 2) else 0.0


@lru_cache(maxsize=200_000)
def run_together(word: str, first: str, second: str) -> bool:
    """Whether a word is two others written together, the second perhaps cut short, with up to two typos, and not the first one alone."""
    w, head, whole = (t.replace(".", "") for t in (word, first, first + second))
    if len(w) < 6 or head[:1] != w[:1]:
        return False
    if len(second.replace(".", "")) < 4 and len(w) > len(whole):
        w = w[: len(whole)]
    least = min((distance(w, whole[:n]) for n in range(max(len(head) + 1, len(w) - 2), min(len(whole), len(w) + 2) + 1)), default=9)
    return least <= (2 if len(w) > 8 else 1) and least < distance(w, head)


def _written_together(word: str, parts: Sequence[str]) -> bool:
    return len(parts) == 2 and (run_together(word, *parts) or run_together(word, *parts[::-1]))


def align(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[list[tuple[float, str, str]], list[str], list[str]]:
    """Greedy one-to-one matching of words: matches with scores, words of a left over, words of b left over."""
    scored = sorted(((s, -i, -j) for i, x in enumerate(a) for j, y in enumerate(b) if (s := word_score(x, y))), reverse=True)
    used_a, used_b, met = set(), set(), []
    for s, i, j in scored:
        if i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            met.append((s, a[-i], b[-j]))
    return met, [w for i, w in enumerate(a) if -i not in used_a], [w for j, w in enumerate(b) if -j not in used_b]


def same_name(a: Name, b: Name, weak: frozenset[str] = frozenset()) -> float:
    """Likeness of two names from 0 to 1; 0 means different names.

    All words of one must be found in the other; what the other has more may only be words of ``weak``
    (lines of business and the like). At least one long word must agree as a whole.
    """
    return compared(a.words, b.words, weak)[0]


@lru_cache(maxsize=500_000)
def compared(a: tuple[str, ...], b: tuple[str, ...], weak: frozenset[str]) -> tuple[float, bool]:
    """The likeness of two names by their words, and whether they share a word beside ``weak`` ones while both have others that differ."""
    met, rest_a, rest_b = align(a, b)
    likeness = _likeness(a, b, met, rest_a, rest_b, weak)
    return likeness, not likeness and bool(rest_a and rest_b) and any(s >= 0.75 and w not in weak for s, w, _ in met)


def _likeness(words_a: tuple[str, ...], words_b: tuple[str, ...], met: list[tuple[float, str, str]], rest_a: list[str], rest_b: list[str], weak: frozenset[str]) -> float:
    if (rest_a or rest_b) and not any(w in NICKNAMES and len(rest_a) == len(rest_b) for w in rest_a + rest_b):
        x, y = "".join(words_a).replace(".", ""), "".join(words_b).replace(".", "")
        turned = "".join(words_b[1:] + words_b[:1]).replace(".", "")
        if len(words_a) != len(words_b) and len(x) > 9 and (within(x, y, 2) or within(x, turned, 2)):
            return 0.9
    strong = [s for s, x, y in met if s >= 0.75 and min(len(x), len(y)) > 3 and "." not in x + y]
    if strong and (_written_together(rest_a[0], rest_b) if len(rest_a) == 1 else len(rest_b) == 1 and _written_together(rest_b[0], rest_a)):
        return 0.8
    if len(met) > 1 and len(rest_a) + len(rest_b) == 1:
        pairs = [(y, (x, *rest_a)) if rest_a else (x, (y, *rest_b)) for _, x, y in met]
        if any(_written_together(word, parts) and any(s >= 0.75 for m, (s, _, _) in enumerate(met) if m != n) for n, (word, parts) in enumerate(pairs)):
            return 0.8
    if not strong or (rest_a and rest_b):
        return 0.0
    left = rest_a or rest_b
    if left:
        person = any(min(len(x.strip(".")), len(y.strip("."))) == 1 or x in NICKNAMES or y in NICKNAMES or x in _NICK or y in _NICK for _, x, y in met)
        if len(met) < 2 or any(w not in weak for w in left) or not (person or all(w.strip(".") in LOOSE for w in left)):
            return 0.0
    return sum(s for s, _, _ in met) / (len(met) + 0.5 * len(left))
