"""Personal identifiers in one text: the strict forms, and looser ones that only context can decide."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pulsemill.llm import words as W

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_ANY = re.compile(r"[0-9@]|[(\[{]at[)\]}]", re.I)
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its start only: what fails there fails from every later digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT = re.compile(r"@|\x20?[(\[{]at[)\]}]\x20?", re.I)
_LOOSE_DOMAIN = re.compile(
    r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]++)*+", re.I)
_DOT = re.compile(r"\x20?[(\[{]dot[)\]}]\x20?", re.I)
_GROUPS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}+(?![0-9A-Za-z:])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9])++(?![0-9A-Za-z])")
_LETTER = re.compile(rb"[0-9A-Za-z\x80-\xff]")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    doubled = sum(sum(divmod(2 * int(c), 10)) for c in number[-2::-2])
    return (doubled + sum(int(c) for c in number[-1::-2])) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """The part before each @ reaches back to the last match or to a character that can't belong to it."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append((start, domain.end()))
        free = max(at + 1, domain.end() if start < at and domain else 0)
        at = text.find("@", free)
    return found


def strict(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, leftmost and non-overlapping per kind; failing matches consume their text."""
    if not _ANY.search(text):
        return []
    found = [(EMAIL, *span) for span in _emails(text)]
    found += [(IP, *m.span()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    found += [(CARD, *m.span()) for m in _CARD.finditer(text)
              if 14 <= len(n := digits(m[0])) <= 19 and luhn(n)]
    found += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return found


def loose(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of identifier shape that overlap no ``taken`` one, nor each other.

    Written-out or dotless addresses, colon groups and dotted quads out of range, and
    numbers of 7 to 19 digits: a card from 13 digits without a plus on, else a phone.
    """
    if not _ANY.search(text):
        return []
    found = []
    free = 0
    for at in _AT.finditer(text):
        start = free + len(text[free:at.start()].rstrip(_LOCAL))
        domain = _LOOSE_DOMAIN.match(text, at.end())
        if start < at.start() and domain:
            found.append((EMAIL, start, domain.end()))
        free = at.end()
    found += [(IP, *m.span()) for m in _IP.finditer(text)]
    found += [(IP, *m.span()) for m in _GROUPS.finditer(text)]
    for m in _NUMBER.finditer(text):
        n = len(digits(m[0]))
        if 7 <= n <= 19:
            found.append((CARD if n >= 13 and "+" not in m[0] else PHONE, *m.span()))
    used = sorted((s, e) for _, s, e in taken)
    kept, ends = [], 0
    place = 0
    reach = 0  # where the taken spans that begin before a candidate end
    for kind, start, end in sorted(found, key=lambda x: (x[1], x[0], -x[2])):
        while place < len(used) and used[place][0] < end:
            reach = max(reach, used[place][1])
            place += 1
        if start >= ends and start >= reach:
            kept.append((kind, start, end))
            ends = end
    return kept


def value(kind: int, written: str) -> str:
    """What an identifier is, however it is written."""
    if kind in (CARD, PHONE):
        return digits(written)
    if kind == IP:
        return written.lower()
    return _DOT.sub(".", _AT.sub("@", written)).lower()


def _contexts_alphabet() -> W.Alphabet:
    folded = W.random_values(256, 7)
    folded[65:91] = folded[97:123]
    folded[48:58] = folded[48]
    return W.Alphabet(W.SPACED.inside, folded)


#: Words between white space; A-Z count as a-z, digits as one another.
CONTEXT = _contexts_alphabet()


def single(words: np.ndarray) -> np.ndarray:
    return W.mix(words + np.uint64(1))


def double(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(first + np.uint64(2)) + second)


@dataclass
class Context:
    """Hashes of the one and two words on each side of a span; None where there is none."""

    left: tuple[int | None, int | None]
    right: tuple[int | None, int | None]


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[Context]:
    """Lexical context of each span.

    A side has none if the identifier's own word goes on there with letters or digits.
    """
    w = W.words(pa.array([text]), CONTEXT)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    place = np.concatenate(([0], np.cumsum(width)))
    one, two = single(w.hash), double(w.hash[:-1], w.hash[1:])

    def hashes(first: int, second: int, pair: int) -> tuple[int | None, int | None]:
        return (_long(one[first]) if 0 <= first < len(one) else None,
                _long(two[pair]) if 0 <= first < len(one) and 0 <= second < len(one) else None)

    out = []
    for _, start, end in spans:
        start, end = int(place[start]), int(place[end])
        i = int(np.searchsorted(w.start, start, "right")) - 1
        j = int(np.searchsorted(w.start, end - 1, "right")) - 1
        before = w.data[w.start[i]:start].tobytes()
        behind = w.data[end:w.end[j]].tobytes()
        out.append(Context(
            (None, None) if _LETTER.search(before) else hashes(i - 1, i - 2, i - 2),
            (None, None) if _LETTER.search(behind) else hashes(j + 1, j + 2, j + 1)))
    return out


def _long(x: np.uint64) -> int:
    return int(x.astype(np.int64))
