"""The base patterns for personal data; each kind's matches are leftmost and do not overlap.

Written so that no text, however long or adverse, takes more than linear time: an address is found from its ``@`` outwards,
and a run of digits is only entered at its start.
"""

from __future__ import annotations

import re
from itertools import chain

# Kinds in the order in which spans at one start are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    double = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in double)) % 10 == 0


def _emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", m.start(), m.end()


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield "phone", m.start(), m.end()


def order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def base_spans(text: str) -> list[Span]:
    """All spans by start, then kind; positions in code points, end exclusive."""
    digits = _DIGIT.search(text) is not None
    found = chain(_emails(text), *((_ips(text), _cards(text), _phones(text) if "+" in text else ()) if digits else ()))
    return sorted(found, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
