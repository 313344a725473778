"""Personal data, also where it is disguised, with offsets in the text as it stands.

Base matches come from four patterns. For disguised ones a chain of transducers rewrites the text: look-alike
letters and digits of other scripts become ASCII, invisible characters go, "[at]" and "dot" in brackets or words
become signs, spelled digits and digit groups among them become figures. Each match is decided by itself and the words
right before it, never by what else the document holds. Each transducer keeps a map of segments from its output to its
input, so a match in the rewritten text maps back to the span of source characters it stands for. Base spans
always stay; a mapped span that overlaps a base span of its kind is not new and is left out.

All patterns run in linear time on long texts: e-mail addresses are found from their at signs, and the others
never start twice in one run of digits. Texts without a trigger are not rewritten.

Edge cases: a null or empty text has no spans; repeated rows are returned as they come; extra columns are ignored
by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lensmill.llm.common import small_batches, whole_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, number of the kind, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Look-alikes of ASCII letters and signs; fixed values.
_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "ο": "o", "α": "a", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "τ": "t", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ο": "O",
    "ı": "i", "ɑ": "a", "ɡ": "g", "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹫": "@",
    "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
}
_ALIKE |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}  # full-width forms
for _zero in (0x660, 0x6F0, 0x966, 0x9E6, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):  # decimal digits of other scripts
    _ALIKE |= {chr(_zero + k): str(k) for k in range(10)}
_INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
_STRANGE = re.compile("[" + re.escape("".join(_ALIKE)) + _INVISIBLE + "]+")

_AT_WORD, _DOT_WORD = r"(?:at|arroba|arobase|klammeraffe)", r"(?:dot|punkt|punto|point)"
_BRACKETED = re.compile(
    rf"(?<!\s)\s*[\[({{<]\s*(?:(?P<at>@|{_AT_WORD})|\.|{_DOT_WORD})\s*[\])}}>]\s*", re.IGNORECASE
)
# Where the sign is a word, the last name must be one of these; fixed values.
_TOP_NAMES = frozenset(
    "com org net edu gov mil int info biz io co app dev me tv uk de fr es it nl eu us ca au ch at be pl pt br mx ar cl in jp cn kr ru se no"
    " dk fi ie cz gr example test".split()
)
_DOT = rf"(?:\s+{_DOT_WORD}\s+|\.)"
_KNOWN_HOST = rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}(?:{'|'.join(sorted(_TOP_NAMES))})(?![A-Za-z0-9-])"
# Only as a whole address: name at host dot end. Whether a match counts is seen from the match and the words before it.
_AT_IN_WORDS = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?P<name>[A-Za-z0-9._%+-]+)\s+{_AT_WORD}\s+"
    rf"(?P<host>{_KNOWN_HOST})",
    re.IGNORECASE,
)
_HAS_AT_WORD = re.compile(rf"\s{_AT_WORD}\s+[A-Za-z0-9-]+{_DOT}", re.IGNORECASE)
_DOT_IN_WORDS = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?P<name>[A-Za-z0-9._%+-]+)@(?P<host>{_KNOWN_HOST}|[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+)",
    re.IGNORECASE,
)
# Words that stand before "at host" in prose and are no names; fixed values.
_NO_NAMES = frozenset(
    "i me you he him she her it we us they them this that here there now today online only more out up back not and or is are was were be been"
    " live look looks looking shop shops shopping buy bought order orders sell sells sold sale visit see seen find found available start meet"
    " join read learn apply book work works worked working stay hosted posted published listed store stores site page down arrive arrived".split()
)
# What asks for an address before a name that may be any word; fixed values.
_ASKS = re.compile(
    r"(?<!\w)(?:write(?:\s+to)?|(?:e-?)?mail(?:\s+(?:to|is))?|contact|reach|message|address(?:\s+is)?|schreib\w*(?:\s+an)?|kontakt\w*"
    r"|escrib\w*(?:\s+a)?|correo|écri\w*(?:\s+à)?|courriel|contact\w*)\s*:?\s*\Z",
    re.IGNORECASE,
)
_WORDED_DOT = re.compile(rf"\s+{_DOT_WORD}\s+", re.IGNORECASE)
# Digits as words in English, German, French and Spanish; fixed values.
_SPELLED = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_NUMBER = "|".join(sorted(_SPELLED, key=len, reverse=True))
_NUMBERS = rf"(?:{_NUMBER}|[0-9]+)"
_SPOKEN = re.compile(
    rf"(?<!\w)(?P<plus>(?:plus|más)\s+|\+\s*)?(?P<digits>{_NUMBERS}(?:[\s,.()-]+{_NUMBERS})+)(?!\w)", re.IGNORECASE
)
_HAS_SPOKEN = re.compile(rf"(?<!\w)(?:{_NUMBER})[\s,.()-]+{_NUMBERS}|[0-9][\s,.()-]+(?:{_NUMBER})(?!\w)", re.IGNORECASE)
_SPOKEN_PART = re.compile(rf"{_NUMBER}|[0-9]+", re.IGNORECASE)
# Four numbers of up to three digits, in figures or digit by digit in words.
_BYTE = rf"(?:[0-9]{{1,3}}|(?:{_NUMBER})(?:[\s-]+(?:{_NUMBER})){{0,2}})"
_IP_IN_WORDS = re.compile(rf"(?<![\w.]){_BYTE}(?:{_DOT}{_BYTE}){{3}}(?!\w)", re.IGNORECASE)
_HAS_IP_WORD = re.compile(rf"[0-9]\s+{_DOT_WORD}\s|(?<!\w)(?:{_NUMBER}){_DOT}|[0-9]\.(?:{_NUMBER})", re.IGNORECASE)


def _small(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        d = int(digit) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each begins with the run of local characters before its at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        if at > done and text[at - 1] in _LOCAL and (domain := _DOMAIN.match(text, at)):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns, by start, then kind."""
    spans: list[Span] = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(spans)


class Rewritten:
    """A text and, for its segments, where they come from in the source."""

    def __init__(self, text: str):
        self.text, self.maps = text, []

    def apply(self, pattern: re.Pattern, replace: Callable[[re.Match], str | None]) -> None:
        """Replaces matches; None leaves a match as it is."""
        out: list[str] = []
        starts, segments = [0], [(0, True)]  # output start; input start, copied as it is
        at = size = 0
        for m in pattern.finditer(self.text):
            new = replace(m)
            if new is None:
                continue
            out += [self.text[at : m.start()], new]
            size += m.start() - at
            starts += [size, size + len(new)]
            segments += [(m.start(), False), (m.end(), True)]
            size += len(new)
            at = m.end()
        if out:
            ends = [(b, copied) for (b, copied) in segments[1:]] + [(len(self.text), True)]
            self.maps.append((starts, segments, [e[0] for e in ends]))
            self.text = "".join(out) + self.text[at:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters that the characters from start to end stand for."""
        for starts, segments, ends in reversed(self.maps):
            k = bisect_right(starts, start) - 1
            j = bisect_right(starts, end - 1) - 1
            start = segments[k][0] + (start - starts[k] if segments[k][1] else 0)
            end = segments[j][0] + (end - starts[j]) if segments[j][1] else ends[j]
        return start, end


def _address(m: re.Match) -> str | None:
    """An address if its dots are words, its name is no plain word, or the words before ask for one."""
    name = m["name"]
    if name.lower() in _NO_NAMES:
        return None
    told = _WORDED_DOT.search(m["host"]) or not name.isalpha() or _ASKS.search(m.string[max(0, m.start() - 40) : m.start()])
    return f"{name}@{_WORDED_DOT.sub('.', m['host'])}" if told else None


def _figures(text: str) -> str:
    return "".join(d if d.isdigit() else str(_SPELLED[d.lower()]) for d in _SPOKEN_PART.findall(text))


def _spoken_ip(m: re.Match) -> str | None:
    if m[0].replace(".", "").isdigit():
        return None
    return ".".join(map(_figures, re.split(_DOT, m[0], flags=re.IGNORECASE)))


def _spoken(m: re.Match) -> str | None:
    """Single digits, or groups of them among words: after a plus, or with three words and no commas or full stops."""
    parts = _SPOKEN_PART.findall(m["digits"])
    words = sum(not d.isdigit() for d in parts)
    singly = len(parts) >= 8 and all(len(d) == 1 or not d.isdigit() for d in parts)
    if not words or not (singly or m["plus"] or (words >= 3 and not re.search("[,.]", m["digits"]))):
        return None
    digits = _figures(m["digits"])
    return ("+" if m["plus"] else "") + digits if len(digits) >= 8 else None


#: Patterns, in their order; each runs where the text as rewritten so far has what every match of it has.
_TRANSDUCERS = (
    (_STRANGE, _STRANGE, lambda m: "".join(_ALIKE.get(c, "") for c in m[0])),
    (_BRACKETED, _BRACKETED, lambda m: "@" if m["at"] else "."),
    (re.compile(rf"@[A-Za-z0-9.-]+\s+{_DOT_WORD}\s", re.IGNORECASE), _DOT_IN_WORDS, lambda m: f"{m['name']}@{_WORDED_DOT.sub('.', m['host'])}"),
    (_HAS_AT_WORD, _AT_IN_WORDS, _address),
    (_HAS_IP_WORD, _IP_IN_WORDS, _spoken_ip),
    (_HAS_SPOKEN, _SPOKEN, _spoken),
)


def rewrite(text: str) -> Rewritten | None:
    """The text after all transducers; None where nothing in it is disguised."""
    out = Rewritten(text)
    for needed, pattern, replace in _TRANSDUCERS:
        if needed.search(out.text):
            out.apply(pattern, replace)
    return out if out.maps else None


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with the disguised ones added, both sorted."""
    base = base_spans(text)
    rewritten = rewrite(text)
    if rewritten is None:
        return base, base
    added: list[Span] = []
    for start, kind, end in base_spans(rewritten.text):
        a, b = rewritten.source(start, end)
        if not any(k == kind and a < e and s < b for s, k, e in base):
            added.append((a, kind, b))
    return base, sorted(base + added)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first one names all."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, base matches per kind, their digest, all spans, and how many are disguised ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(text) for text in batch.column("text").to_pylist()]
            counts = [pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *counts,
                    pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    pa.array([_joined(spans) for _, spans in found], pa.string()),
                    pa.array([len(spans) - len(base) for base, spans in found], pa.int64()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"
    )


def redact(documents: DataFrame) -> DataFrame:
    """The documents with personal data replaced in ``text``; ``n_chars``, where there is one, follows."""
    at = documents.columns.index("text")
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and redacted(t, all_spans(t)[1]) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = documents.mapInArrow(run, documents.schema)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return out
