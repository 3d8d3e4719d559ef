"""Personal data in texts, disguised or not, at exact source offsets.

Plain identifiers (``base``) are found on the text as it is, leftmost and without overlap for each kind:
email, ip (parts up to 255), card (14 to 19 digits that pass Luhn) and phone (10 to 15 digits).
For disguised ones the text goes through three transducers, each of which turns (character, source
span) sequences into others: homoglyphs, wide forms and foreign digits become ASCII and invisible characters vanish;
runs of spelled digits (English, German, French, Spanish) become digits; spelled or bracketed at, dot and plus
become signs. The same detectors run on the result, and each hit is mapped back to the source characters it
came from. Hits that lie inside a plain identifier of their kind add nothing.
Behind a spelled or spaced sign a domain may have any end, with the exceptions for prose that stand beside the rules.

Every text is read whole; a text in which no transducer's rule matches is left at its plain hits.
Plain matching takes time in proportion to the text (an email is matched outwards from its ``@``).

Defined cases: a null or empty text has no spans; offsets are code points, end exclusive; equal rows are each
reported; an empty table gives an empty result; other columns are kept by ``redact`` and not read by
``find``, except that columns named like its results give way to them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from moneytrail.llm.common import filled, input_columns, map_texts

KINDS = ("email", "ip", "card", "phone")

# --------------------------------------------------------------------------- plain identifiers

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the plain identifiers."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:  # an email's local part is all of its characters before the sign, up to the last match
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# --------------------------------------------------------------------------- transducers

# Letters of other scripts that look like ASCII ones, in the order of the ASCII letters.
_LOOKALIKES = (
    ("Cyrillic", "АВСЕНІЈКМОРЅТХУавсеһіјкморԛѕтхуԁԝь", "ABCEHIJKMOPSTXYabcehijkmopqstxydwb"),
    ("Greek", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχ", "ABEZHIKMNOPTYXaikvoptux"),
    ("other", "ɑɡıⅼօոսᴏ․﹒。٠‐‑‒–—−⁄﹫", "agilonuo...0------/@"),
)
# Digits zero to nine as spelled in each language.
_SPELLED = (
    ("English", "zero one two three four five six seven eight nine"),
    ("German", "null eins zwei drei vier fünf sechs sieben acht neun"),
    ("French", "zéro un deux trois quatre cinq six sept huit neuf"),
    ("Spanish", "cero uno dos tres cuatro cinco seis siete ocho nueve"),
)
# Ends of domains that are accepted after any spelled signs.
_TOP_DOMAINS = "com org net edu gov mil int info biz dev app io ai eu uk de fr es nl ch pl ru se cz pt br mx jp cn example test".split()
_LOOK = {ord(a): b for _, x, y in _LOOKALIKES for a, b in zip(x, y, strict=True)}
_VALUE = {w: str(i) for _, words in _SPELLED for i, w in enumerate(words.split())}


class _Fold(dict):
    """Code point -> ASCII look-alike, '' for invisible characters, or itself; filled as it is used."""

    def __missing__(self, code: int):
        c = chr(code)
        if code in _LOOK:
            out = _LOOK[code]
        elif code < 128:
            out = c
        elif unicodedata.category(c) in ("Cf", "Mn", "Me"):
            out = ""
        elif (digit := unicodedata.decimal(c, None)) is not None:
            out = str(digit)
        else:
            wide = unicodedata.normalize("NFKC", c)
            out = wide if len(wide) == 1 and " " <= wide <= "~" else c
        self[code] = out
        return out


_FOLD = _Fold()
_WORD = "|".join(sorted(_VALUE, key=len, reverse=True))
_SIGN_DOT, _SIGN_AT = "dot|punkt|punto", "at|arroba|arobase"
_TOP = "|".join(sorted(_TOP_DOMAINS, key=len, reverse=True))
_DIGIT_RUN = re.compile(rf"\b(?:{_WORD})(?:[\s-]{{1,2}}(?:{_WORD}))+\b", re.I)
#: Two spelled digits in lower case: each match of the rule above holds them, and this is found faster.
_TWO_DIGITS = re.compile(rf"(?:{_WORD})[\s-]{{1,2}}(?:{_WORD})")
_DOT_DIGIT = re.compile(rf"(?<=[0-9])\s{{1,2}}(?:{_SIGN_DOT}|point)\s{{1,2}}({_WORD})\b", re.I)
_ONE_WORD = re.compile(_WORD, re.I)
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OolI]+(?=[0-9])")
_DOTS = (*_SIGN_DOT.split("|"), "point")
# Words behind a plain 'at' that begin prose, not a domain, and two-letter words that end it.
_PROSE = "a|an|the|this|that|these|those|some|any|one|each|every|no|which|what|my|your|his|her|its|our|their|here|there"
_SHORT = "am|an|as|at|be|by|do|go|he|if|in|is|it|me|my|no|of|on|or|so|to|up|us|we"
_LABEL, _END = "[A-Za-z0-9-]{1,63}", r"[A-Za-z]{2,63}\b"
_SPELLED_DOT, _ANY_DOT = rf"\s{{1,2}}(?:{_SIGN_DOT})\s{{1,2}}", rf"\s{{1,2}}(?:{_SIGN_DOT}|point)\s{{1,2}}"
_ADDRESS_DOT = re.compile(rf"{_ANY_DOT}|\s{{1,2}}\.", re.I)
_BRACKETS = tuple("[({<")
#: Letters or signs of which every match holds one (in lower case: most texts need no search), the rule, and what it gives.
_SIGNS = (
    (_BRACKETS, re.compile(rf"\s{{0,2}}[\[({{<]\s{{0,2}}(?:{_SIGN_AT}|@)\s{{0,2}}[\])}}>]\s{{0,2}}", re.I), "@"),
    (_BRACKETS, re.compile(rf"\s{{0,2}}[\[({{<]\s{{0,2}}(?:{_SIGN_DOT}|point|\.)\s{{0,2}}[\])}}>]\s{{0,2}}", re.I), "."),
    # a spelled or spaced sign needs a whole domain behind it
    (_DOTS, re.compile(rf"(?<=[A-Za-z0-9])\s{{1,2}}(?:{_SIGN_AT})\s{{1,2}}(?=[A-Za-z0-9-]{{1,63}}(?:(?:\.|\s{{1,2}}(?:{_SIGN_DOT})\s{{1,2}})[A-Za-z0-9-]{{1,63}}){{0,6}}(?:\s{{1,2}}(?:{_SIGN_DOT})\s{{1,2}})(?:{_TOP})\b)", re.I), "@"),
    (("@",), re.compile(rf"(?<=[A-Za-z0-9])(?:\s{{1,2}}@\s{{0,2}}|\s{{0,2}}@\s{{1,2}})(?=[A-Za-z0-9-]{{1,63}}(?:(?:\s{{0,2}}\.\s{{0,2}}|\s{{1,2}}(?:{_SIGN_DOT})\s{{1,2}})[A-Za-z0-9-]{{1,63}}){{0,6}}(?:\s{{0,2}}\.\s{{0,2}}|\s{{1,2}}(?:{_SIGN_DOT})\s{{1,2}})(?:{_TOP})\b)", re.I), "@"),
    # domains of any end: behind a plain 'at' with spelled dots and no word of prose, behind other signs as they come
    (_DOTS, re.compile(rf"(?<=[A-Za-z0-9])\s{{1,2}}at\s{{1,2}}(?!(?:{_PROSE})\b)(?={_LABEL}(?:(?:\.|{_SPELLED_DOT}){_LABEL}){{0,6}}{_SPELLED_DOT}{_END})", re.I), "@"),
    # ('at some point in', 'at boiling point it': an 'at' with 'point' needs a listed end or one of two letters that is no word)
    (("point",), re.compile(rf"(?<=[A-Za-z0-9])\s{{1,2}}at\s{{1,2}}(?!(?:{_PROSE})\b)(?={_LABEL}(?:(?:\.|{_ANY_DOT}){_LABEL}){{0,6}}{_ANY_DOT}(?:{_TOP}|(?!(?:{_SHORT})\b)[A-Za-z]{{2}})\b)", re.I), "@"),
    (("point",), re.compile(rf"(?<=[A-Za-z0-9])(?<!\b(?:ce|le|un|au))\s{{1,2}}point\s{{1,2}}(?=[A-Za-z0-9_%+-]{{1,63}}(?:\s{{1,2}}point\s{{1,2}}[A-Za-z0-9_%+-]{{1,63}}){{0,3}}\s{{1,2}}(?:arroba|arobase)\s{{1,2}}{_LABEL}(?:\.|{_ANY_DOT}))", re.I), "."),
    (("arroba", "arobase"), re.compile(rf"(?<=[A-Za-z0-9])\s{{1,2}}(?:arroba|arobase)\s{{1,2}}(?={_LABEL}(?:(?:\.|{_ANY_DOT}){_LABEL}){{0,6}}(?:\.|{_ANY_DOT}){_END})", re.I), "@"),
    (("@",), re.compile(rf"(?<=[A-Za-z0-9])\s{{0,2}}@\s{{1,2}}(?={_LABEL}(?:(?:\s{{0,2}}\.|{_ANY_DOT}){_LABEL}){{0,6}}(?:(?:\s{{0,2}}\.|{_ANY_DOT}){_END}|\s{{1,2}}\.\s{{1,2}}(?!(?:{_SHORT})\b)[A-Za-z]{{2}}\b))", re.I), "@"),
    # a name behind a space and '@' may be a handle ('thanks @jane.doe')
    (("@",), re.compile(rf"(?<=[A-Za-z0-9])\s{{1,2}}@(?={_LABEL}(?:(?:\s{{0,2}}\.|{_ANY_DOT}){_LABEL}){{0,6}}(?:\s{{0,2}}\.[A-Za-z]{{2}}\b|{_ANY_DOT}{_END}))", re.I), "@"),
    # spelled dots and dots behind a space, unless the domain is whole before them ('jane@example.com point final')
    (("@",), re.compile(rf"@{_LABEL}(?:(?:\.(?!(?:{_TOP}|[A-Za-z]{{2}})\s)|\s{{1,2}}\.|{_ANY_DOT}){_LABEL}){{0,6}}(?:\s{{1,2}}\.|{_ANY_DOT}){_END}", re.I), lambda m: _ADDRESS_DOT.sub(".", m[0])),
    (_DOTS, re.compile(rf"(?<=[A-Za-z0-9])\s{{1,2}}(?:{_SIGN_DOT})\s{{1,2}}(?=[A-Za-z0-9])", re.I), "."),
    (("point",), re.compile(r"(?<=[0-9])\s{1,2}point\s{1,2}(?=[0-9])", re.I), "."),
    (("@",), re.compile(r"(?<=@)([A-Za-z0-9-]{1,63})\s{1,2}\.\s{0,2}" rf"(?={_TOP}\b)", re.I), lambda m: m[1] + "."),
    (("@",), re.compile(rf"(?<=@)({_LABEL})\s{{1,2}}\.\s{{1,2}}(?=(?!(?:{_SHORT})\b)[A-Za-z]{{2}}\b)", re.I), lambda m: m[1] + "."),
    (("plus",), re.compile(r"\bplus\s{0,2}(?=[0-9])", re.I), "+"),
)
#: The rules besides runs of digits.
_RULES = ((_DOTS, _DOT_DIGIT), (tuple("0123456789"), _LETTER_DIGIT), *((needs, rule) for needs, rule, _ in _SIGNS))


def _lower(text: str) -> str:
    """The text in lower case as the rules see it: they take the dotted capital I for an i."""
    return text.replace("\u0130", "i").lower()


def _disguised(text: str) -> bool:
    """Whether any rule matches; without a match none changes the text, so no later one does either."""
    low = _lower(text)
    if _TWO_DIGITS.search(low) and _DIGIT_RUN.search(text):
        return True
    return any(any(n in low for n in needs) and rule.search(text) for needs, rule in _RULES)


class Tape:
    """A text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, pattern: re.Pattern, change) -> None:
        """Replace each match by ``change(match)``; what replaces it spans all its source."""
        parts, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new, a, b = change(m), m.start(), m.end()
            parts += [self.text[at:a], new]
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        if at:
            self.text = "".join(parts) + self.text[at:]
            self.starts = starts + self.starts[at:]
            self.ends = ends + self.ends[at:]

    def fold(self) -> None:
        """The homoglyph transducer."""
        folded = [(f, a, b) for c, a, b in zip(self.text, self.starts, self.ends, strict=True) if (f := _FOLD[ord(c)])]
        self.text = "".join(f for f, _, _ in folded)
        self.starts, self.ends = [a for _, a, _ in folded], [b for _, _, b in folded]


def normalise(text: str) -> Tape | None:
    """The text behind its disguises, or None where there are none."""
    folded = text if text.isascii() else text.translate(_FOLD)
    if folded == text and not _disguised(text):
        return None
    return rewritten(text)


def rewritten(text: str) -> Tape:
    """The text after all rules."""
    tape = Tape(text)
    if not text.isascii():
        tape.fold()
    tape.rewrite(_DIGIT_RUN, lambda m: "".join(_VALUE[_lower(w)] for w in _ONE_WORD.findall(m[0])))
    for _ in range(3):  # one spelled digit between spelled dots
        tape.rewrite(_DOT_DIGIT, lambda m: "." + _VALUE[_lower(m[1])])
    tape.rewrite(_LETTER_DIGIT, lambda m: "".join("0" if c in "Oo" else "1" for c in m[0]))
    for _, pattern, sign in _SIGNS:
        tape.rewrite(pattern, sign if callable(sign) else lambda m, s=sign: s)
    return tape


def identifiers(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind number, end, plain) by start, then kind."""
    base = plain(text)
    found = [(*x, True) for x in base]
    tape = normalise(text)
    if tape is not None and tape.text != text:
        own = [[(a, b) for a, k, b in base if k == kind] for kind in range(len(KINDS))]
        for a, kind, b in plain(tape.text):
            start, end = tape.starts[a], tape.ends[b - 1]
            if not any(x <= start and end <= y for x, y in own[kind]):
                found.append((start, kind, end, False))
    return sorted(found)


# --------------------------------------------------------------------------- on tables

_SPAN = "struct<kind:string,start:bigint,end:bigint,plain:boolean>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))
    for batch in batches:
        spans = [[{"kind": KINDS[k], "start": a, "end": b, "plain": p} for a, k, b, p in identifiers(t.as_py())] for t in filled(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.nulls(len(spans), pa.string()), pa.array(spans, kind)], ["row", "text", "spans"])


def find(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The columns besides the text, and ``spans``, an array of kind, start, end and plain."""
    return map_texts(docs, text, _find, f"spans array<{_SPAN}>").select(*input_columns(docs, text, ("spans", text)), "spans")


def redact(docs: DataFrame, *, text: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The input rows with each span of ``kinds`` replaced by its kind in angle brackets (of overlapping spans, the first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("text").to_pylist():
                parts, at = [], 0
                for a, k, b, _ in identifiers(value) if value else ():
                    if a >= at and KINDS[k] in kinds:
                        parts += [value[at:a], f"<{KINDS[k]}>"]
                        at = b
                out.append("".join(parts) + value[at:] if at else value)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string()), pa.nulls(len(out), pa.int32())], ["row", "text", "none"])

    return map_texts(docs, text, run, "none int").select(*input_columns(docs, text))
