"""Texts that were decoded with a wrong character encoding, and their repair.

Round trip: what a wrong decoder made of bytes is encoded again with that encoding and decoded
strictly with the intended one. A candidate is accepted only if the cost of the text, a sum
over its characters in their context, drops; accepted layers are taken off until none helps.

The cost follows the language a text shows: letters of an alphabet cost little where the text has letters of it that no
confusion of western encodings makes, and letters of another script where whole words are written in it. So
a correct Czech, Polish or Russian text is as cheap as it can be and never rewritten, and its garbled form comes back.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import shipped

#: Encodings that UTF-8 bytes are wrongly decoded with, and pairs of (wrong, intended) single-byte encodings.
WIDE = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1250", "cp1254")
NARROW = (
    ("cp850", "cp1252"), ("cp437", "cp1252"), ("mac_roman", "cp1252"), ("cp1250", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1251", "cp1252"), ("iso8859-2", "cp1252"),
    ("cp1252", "cp1250"), ("cp1252", "iso8859-2"), ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1252", "cp866"), ("cp1252", "cp1253"), ("cp1252", "cp1254"), ("cp1252", "cp1257"), ("cp1250", "iso8859-2"), ("iso8859-2", "cp1250"),
)
#: Encodings of western European texts.
WESTERN = ("cp1252", "mac_roman", "cp850", "cp437")
#: Least drop of cost for a layer of single-byte confusion, most layers, and least cost of one character that marks a text whose original is lost.
MIN_DROP, MAX_LAYERS, LOST = 4.0, 6, 6.0

#: Letters and signs that western European texts use.
LOWER = "àâäçèéêëìîïñòôöùûüßœ"
UPPER = "ÀÂÄÇÈÉÊËÌÎÏÑÒÔÖÙÛÜŒ"
RARE = "áãåæíóõøúýÿÁÃÅÆÍÓÕØÚÝŸ"
SIGNS = "’‘“”„–—«»€°§²³ªº±…•·½¼¾×÷©®™¿¡  ’µ£†‡‰¶"
COMMON = frozenset(LOWER + UPPER + RARE + "’‘“”„–—«»€°§²³ªº±…•·½©®™¿¡ ")
_ELIDED = frozenset(("l", "d", "un", "dell", "nell", "all", "sull", "dall", "coll", "quell", "c", "s", "n", "m", "j", "qu", "t", "jusqu", "lorsqu", "puisqu", "quest", "sant", "grand", "anch", "com", "dov", "cos"))
_VOWELS = frozenset("aeiouhyàèéêâîôAEIOUH")
#: Letters beyond ASCII of languages other than the western ones above, and after a blank those that can be words.
ALPHABETS = {
    "czech": "áčďéěíňóřšťúůýž", "slovak": "áäčďéíĺľňóôŕšťúýž", "polish": "ąćęłńóśźż", "hungarian": "áéíóöőúüű ő", "romanian": "ăâîșțşţ", "croatian": "čćđšž", "turkish": "çğıöşüâîûİ", "spanish": "áéíñóúü óéú",
    "portuguese": "áâãàçéêíóôõú éàóá", "danish": "æøå åø", "swedish": "åäöé åö", "icelandic": "áæðéíóöþúý áí", "lithuanian": "ąčęėįšųūž", "latvian": "āčēģīķļņšūž", "estonian": "äõöšüž", "maltese": "àċġħż",
}
#: Least share of a text's letters foreign to western languages that an alphabet must hold, that only it explains, what the choice of an alphabet costs, and each letter outside it.
COVERED, TELLING, CHOICE, OTHER = 0.8, 0.1, 2.0, 0.25
#: Signs beside a letter that is spoken of as a letter.
_CITED = frozenset(",;/()[]\"'’‘“”«»-")


def _byte_map(encoding: str) -> dict[str, int]:
    """The character a lenient decoder makes of each byte; bytes without meaning become control characters."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


@lru_cache(maxsize=16)
def _wide(encoding: str) -> tuple[re.Pattern, dict[str, int]]:
    back = _byte_map(encoding)
    group = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in back.items() if lo <= b < hi) + "]"
    tail = group(0x80, 0xC0)
    if 0xA0 == back.get(" "):
        tail = tail[:-1] + " ]"
    solid = group(0x80, 0xC0)
    pattern = f"{group(0xC2, 0xE0)}{tail}|{group(0xE0, 0xF0)}{solid}{tail}|{group(0xF0, 0xF5)}{solid}{{2}}{tail}"
    return re.compile(pattern), back


@lru_cache(maxsize=64)
def _narrow(wrong: str, intended: str) -> dict[int, str]:
    table = {}
    for c, b in _byte_map(wrong).items():
        try:
            table[ord(c)] = bytes([b]).decode(intended)
        except UnicodeDecodeError:
            continue
    return table


def _unwrap(text: str, encoding: str, any_letter: bool = False) -> str:
    """``text`` with every run that is UTF-8 under ``encoding`` decoded, where the outcome is a usual character, or any letter."""
    pattern, back = _wide(encoding)

    def decode(m: re.Match) -> str:
        s = m[0]
        blank = s[-1] == " "
        try:
            c = bytes([*(back[x] for x in s[:-1]), 0xA0 if blank else back[s[-1]]]).decode("utf-8", "strict")
        except (UnicodeDecodeError, KeyError):
            return s
        if blank:
            return c if c in "à" and (m.start() == 0 or text[m.start() - 1].isalpha() or text[m.start() - 1] == " ") and s[0] == "Ã" else s
        return c if c in COMMON or c in back or (any_letter and c.isalpha()) else s

    return pattern.sub(decode, text)


@lru_cache(maxsize=200_000)
def char_cost(before: str, c: str, after: str) -> float:
    """The cost of one character beyond ASCII between its neighbours: 1 for usual ones, up to 10 for signs of garbling."""
    code = ord(c)
    if code == 0xFFFD or 0x80 <= code < 0xA0:
        return 10.0
    letter_before, letter_after = before.isalpha(), after.isalpha()
    if c in LOWER:
        if letter_before or letter_after or c in "àèéìòù":
            return 1.0
        return 6.0 if c in "çëïñß" else 1.0 if before in _CITED or after in _CITED else 5.0
    if c in UPPER or c in RARE:
        if c.isupper():
            if before.islower() or (before.isalpha() and before.isupper() and after.islower() and code < 0x100):
                return 6.0 if before.islower() else 3.0
            if not letter_before and not letter_after:
                return 1.0 if c in "ÀÈÉÌÒÙ" else 5.0
            return 1.0 if c in UPPER else 2.0
        if not letter_before and not letter_after:
            return 6.0
        return 2.0
    if c in "²³":
        return 1.0 if before in "mMc" and not letter_after else 6.0 if letter_before or letter_after else 3.0
    if c in "ªº°":
        return 1.0 if (before.isdigit() or before in " nN") and not (letter_after and c != "°") else 4.0
    if c in "’‘":
        return 1.0
    if c in "“”«»–—€§±…•· ":
        return 1.0 if not (letter_before and letter_after) else 4.0
    if c in "¿¡":
        return 1.0 if letter_after and not letter_before else 6.0 if letter_before and letter_after else 3.0
    if c in "½¼¾":
        return 6.0 if letter_before or letter_after else 2.0
    if c in SIGNS:
        return 6.0 if letter_before or letter_after else 3.0
    if c.isalpha():
        if code >= 0x250:
            return 6.0 if before.isascii() and letter_before or after.isascii() and letter_after else 3.0
        if not letter_after:
            return 5.0
        return 3.0 if not c.isupper() or not before.islower() else 6.0
    return 6.0


@lru_cache(maxsize=20_000)
def script(c: str) -> str:
    """The script of a letter beyond the Latin ones; empty for Latin letters and for what is no letter."""
    if ord(c) < 0x250 or not c.isalpha():
        return ""
    first = unicodedata.name(c, "").split(" ")[0]
    return "" if first == "LATIN" else first


@lru_cache(maxsize=1)
def _telling_letters() -> dict[str, frozenset[str]]:
    """Letters of each alphabet that neither western texts have nor a confusion of western letters makes."""
    made = set()
    for wrong, intended in NARROW:
        if intended in WESTERN:
            made |= {c for code, to in _narrow(wrong, intended).items() if to in LOWER + UPPER and (c := chr(code)).islower() == to.islower()}
    return {name: frozenset(c for x in letters.split(" ")[0] for c in (x, x.upper()) if c not in LOWER + UPPER and c not in made and len(c) == 1) for name, letters in ALPHABETS.items()}


@lru_cache(maxsize=64)
def _alphabet(name: str) -> tuple[frozenset[str], frozenset[str]]:
    letters, _, alone = ALPHABETS[name].partition(" ")
    return frozenset(letters + letters.upper()), frozenset(alone + alone.upper())


Contexts = Counter


def _contexts(text: str) -> Contexts:
    padded = f" {text} "
    return Counter(padded[m.start() - 1 : m.start() + 2] for m in _BEYOND.finditer(padded))


_BEYOND = re.compile(r"[^\x00-\x7f]")
_WORD = re.compile(r"[^\W\d_]{3,}")


def shown(text: str, contexts: Contexts) -> tuple[str, ...]:
    """What a text is written in besides western languages: names of alphabets it can be of, and scripts that whole words are in.

    A capital inside a word speaks for no alphabet, and neither does a single letter among the western ones.
    """
    foreign: Counter = Counter()
    for w, n in contexts.items():
        if w[1].isalpha() and w[1] not in LOWER and w[1] not in UPPER:
            foreign[w[1] if not (w[1].isupper() and w[0].islower()) else ""] += n
    if not foreign:
        return ()
    scripts = {script(c) for c in foreign if c} - {""}
    if scripts:
        scripts = {s for m in _WORD.finditer(text) if (s := script(m[0][0])) in scripts and all(script(c) == s for c in m[0])}
    latin = {c: n for c, n in foreign.items() if not c or not script(c)}
    all_letters = {w[1] for w in contexts if w[1].isalpha()}
    least, out = sum(latin.values()), sorted(scripts)
    for name, telling in _telling_letters().items() if latin else ():
        letters, _ = _alphabet(name)
        explained, only = (sum(n for c, n in latin.items() if c in known) for known in (letters, telling))
        several = len({c.lower() for c in latin if c in letters}) > 1 or (all_letters <= letters and len({c.lower() for c in all_letters}) > 1)
        if explained >= COVERED * least and only >= max(1, TELLING * least) and several:
            out.append(name)
    return tuple(out)


@lru_cache(maxsize=500_000)
def _cost_in(before: str, c: str, after: str, language: str, scripts: tuple[str, ...]) -> float:
    """``char_cost`` in a text that shows a language and scripts besides the western ones."""
    if s := script(c):
        latin = (before.isalpha() and not script(before)) or (after.isalpha() and not script(after))
        return 6.0 if latin else (4.0 if c.isupper() and before.islower() else 1.0) if s in scripts else char_cost(before, c, after)
    if language:
        letters, alone = _alphabet(language)
        if c in letters and (before.isalpha() or after.isalpha() or c in alone) and not (c.isupper() and before.islower()):
            return 1.0
        return char_cost(before, c, after) + OTHER * c.isalpha()
    return char_cost(before, c, after)


def _costs(text: str) -> tuple[float, str, tuple[str, ...], Contexts]:
    """A text's least cost, the alphabet (empty for the western ones) and the scripts it is reckoned with, and the contexts of its characters."""
    contexts = _contexts(text)
    seen = shown(text, contexts)
    scripts = tuple(s for s in seen if s not in ALPHABETS)
    least, language = min((sum(n * _cost_in(*w, a, scripts) for w, n in contexts.items()) + CHOICE * bool(a), a) for a in ("", *(a for a in seen if a in ALPHABETS)))
    return least + _elision_cost(text), language, scripts, contexts


def _elision_cost(text: str) -> float:
    if not any(c in text for c in "íÕÆ"):
        return 0.0
    return sum(5.0 for m in re.finditer(r"(?<![^\W\d_])([a-zA-Z]{1,7})[íÕÆ](?=\w)", text) if m[1].lower() in _ELIDED and text[m.end()] in _VOWELS)


def cost(text: str) -> float:
    """Cost of a text's characters beyond ASCII in their contexts."""
    return _costs(text)[0]


#: A text without any of these holds no UTF-8 sequence read as single bytes: two characters beyond ASCII side by side, or one that can begin ``à`` before a blank.
_SEQUENCE = re.compile(r"[^\x00-\x7f]{2}|[Ã├√Ă] ")


def repair(text: str | None) -> tuple[str | None, int, bool]:
    """The restored text, the number of layers taken off, and whether garbled characters remain.

    NULL stays NULL. A text without signs of garbling comes back as it is, with 0 layers.
    """
    if text is None or text.isascii():
        return text, 0, False
    layers = 0
    now, language, scripts, contexts = _costs(text)
    while True:
        best, lowest = None, now
        if layers < MAX_LAYERS and _SEQUENCE.search(text):
            for encoding in WIDE:
                for any_letter in (False, True):
                    if (tried := _unwrap(text, encoding, any_letter)) != text and (c := cost(tried)) < lowest:
                        best, lowest = tried, c
        worst = max((_cost_in(*w, language, scripts) for w in contexts), default=0)
        elided = _elision_cost(text)
        if layers < MAX_LAYERS and best is None and (worst >= 3 or elided):
            least = MIN_DROP if worst >= 4 or elided else 2 * MIN_DROP
            for wrong, intended in NARROW:
                for tried in _confused(text, wrong, intended, language, scripts):
                    if tried != text and (c := cost(tried)) <= now - least and c < lowest:
                        best, lowest = tried, c
        if best is None:
            return text, layers, worst >= LOST
        text, layers = best, layers + 1
        now, language, scripts, contexts = _costs(text)


_TOKEN = re.compile(r"[\x00-\x20]?[^\s]*[^\x00-\x7f][^\s]*")


def _confused(text: str, wrong: str, intended: str, language: str, scripts: tuple[str, ...]) -> tuple[str, ...]:
    """``text`` with a single-byte confusion undone: word by word where that lowers the word's cost, and before that throughout if it then shows another language or script.

    A word as it stands is reckoned in what the text shows, an altered one in what the text shows when altered throughout.
    """
    table = _narrow(wrong, intended)
    whole, then = (), (language, scripts)
    if intended not in WESTERN:
        throughout = text.translate(table)
        then = _costs(throughout)[1:3]
        if throughout == text:
            return ()
        whole = (throughout,)

    def undo(m: re.Match) -> str:
        tried = m[0].translate(table)
        return tried if tried != m[0] and _word_cost(tried, *then) < _word_cost(m[0], language, scripts) else m[0]

    return (*whole, _TOKEN.sub(undo, text))


@lru_cache(maxsize=200_000)
def _word_cost(word: str, language: str, scripts: tuple[str, ...]) -> float:
    return sum(n * _cost_in(*w, language, scripts) for w, n in _contexts(word).items()) + _elision_cost(word)


#: Every character of a garbled passage can also stand in a correct text, so only texts of ASCII alone need no look.
SUSPECT = "[^\\x00-\\x7F]"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = [repair(t) for t in batch.column("text").to_pylist()]
        texts, layers, lost = zip(*results, strict=True) if results else ((), (), ())
        out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(layers, pa.int32()), pa.array(lost, pa.bool_())], ["doc_id", "restored", "layers", "lost"])
        yield out.filter(pa.array([n > 0 or gone for n, gone in zip(layers, lost, strict=True)], pa.bool_()))


def garbled_texts(documents: DataFrame) -> DataFrame:
    """Documents with a garbled passage: ``doc_id``, ``restored`` text, ``layers`` taken off, ``lost``: whether some garbled characters remain.

    Only texts with a character beyond ASCII leave the JVM. NULL texts and texts without such a character are no case; texts are read
    whole; every copy of a text is reported, and a repeated row as often as it stands.
    """
    shipped(documents.sparkSession)
    return documents.filter(F.col("text").rlike(SUSPECT)).select("doc_id", "text").mapInArrow(_repaired, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, restored string, layers int, lost boolean")
