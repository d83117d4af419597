"""Spans of one text that may be personal data, and what the labelers say about them.

Exact spans follow fixed patterns; wider candidates are what people write instead: addresses with
a spelled-out sign, numbers without a plus or with other separators, longer internet addresses.
All searches take time in proportion to the text, whatever it holds.
"""

from __future__ import annotations

import ipaddress
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("regex", "shape", "gazetteer", "context", "border")
YES, NO, ABSTAIN = 1, -1, 0
CONTEXT = 32  # code points before a span in which a key word speaks for or against it

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_ZONE = re.compile(r"[0-9][0-9 ()./_-]*")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CHAIN = re.compile(r"[0-9](?:[ ()./_-]{0,2}[0-9])+")
_SIGN = re.compile(r"[\[({<] ?(?:at|AT|@) ?[\])}>]")
_SPELLED = re.compile(r" ?([A-Za-z0-9-]+(?:(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?)[A-Za-z0-9-]+)*)")
_COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
_HEX = string.hexdigits + ":"
_WORD = re.compile(r"[^\W\d_]+")

# Key words before personal data, in four languages.
_KEY_WORDS = {
    EMAIL: "mail email mails contact write correo correio courriel kontakt contacto contactez escriba schreiben".split(),
    IP: "ip ips host server address adresse serveur servidor direccion dirección rechner login client".split(),
    CARD: "card visa mastercard amex credit debit karte kreditkarte carte tarjeta crédito bancaire pan".split(),
    PHONE: "phone tel telephone call fax mobile cell handy telefon telefono teléfono téléphone appelez llame móvil rufen whatsapp".split(),
}
# Words before numbers that are something else.
_OTHER_WORDS = """version release build isbn issn order invoice token key hash id serial page pages chapter section
bestellung rechnung seite fassung commande facture jeton clé pedido factura página versión ean sku ticket part
""".split()
# Last labels of hosts that are in wide use, and endings of file names.
_TOP_LABELS = "com org net edu gov info io eu uk de fr es it nl ch at be pl pt se us ca br mx jp cn in au".split()
_FILE_ENDINGS = "png jpg jpeg gif svg js css py java txt json xml html pdf zip".split()
# Calling codes of countries with their own one or two digits.
_CALLING_CODES = """1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66
81 82 84 86 90 91 92 93 94 95 98""".split()
# First digits of card numbers by issuer, and their lengths.
_ISSUERS = ((range(4, 5), (13, 16, 19)), (range(51, 56), (16,)), (range(2221, 2721), (16,)), (range(34, 35), (15,)),
            (range(37, 38), (15,)), (range(6011, 6012), (16, 19)), (range(65, 66), (16, 19)), (range(35, 36), (16,)),
            (range(62, 63), (16, 17, 18, 19)), (range(30, 31), (14,)), (range(36, 37), (14,)))

_FOR = {word: kind for kind, words in _KEY_WORDS.items() for word in words}
_AGAINST = frozenset(_OTHER_WORDS)


class Span(NamedTuple):
    start: int
    kind: int
    end: int


class Candidate(NamedTuple):
    span: Span
    exact: bool
    votes: tuple[int, ...]  # of LABELERS
    traits: str  # further marks of the span, for the classifier


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        total += (value * 2 - 9 if value > 4 else value * 2) if n % 2 else value
    return total % 10 == 0


def _zones(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold all numbers: digits with what may separate them."""
    return (m.span() for m in _ZONE.finditer(text) if m.end() - m.start() > 1)


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Start, end and whether the host has a dot, of every sign with a name and a host around it."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        if start < at:
            host = _HOST.match(text, at + 1)
            short = host or _LABEL.match(text, at + 1)
            if short:
                yield start, short.end(), bool(host)
            if host:
                done = host.end()
        at = text.find("@", at + 1)


def exact_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping within a kind, in order of start and kind."""
    found = [Span(start, EMAIL, end) for start, end, dotted in _emails(text) if dotted]
    for lo, hi in _zones(text):
        for m in _QUAD.finditer(text, lo, hi):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append(Span(m.start(), IP, m.end()))
        for m in _CARD.finditer(text, lo, hi):
            digits = digits_of(m.group())
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(Span(m.start(), CARD, m.end()))
        if lo and text[lo - 1] == "+":
            m = _PHONE.match(text, lo - 1, hi)
            if m and 9 <= len(digits_of(m.group())) <= 15:
                found.append(Span(m.start(), PHONE, m.end()))
    return sorted(found)


def _wide_spans(text: str) -> Iterator[Span]:
    """What may be personal data beside the exact spans."""
    for start, end, dotted in _emails(text):
        if not dotted:
            yield Span(start, EMAIL, end)
    done = 0
    for sign in _SIGN.finditer(text):
        before = text[max(done, sign.start() - 65) : sign.start()]
        name = before[:-1] if before.endswith(" ") else before
        start = sign.start() - len(before) + len(name.rstrip(_LOCAL))
        host = _SPELLED.match(text, sign.end())
        if len(name.rstrip(_LOCAL)) < len(name) and host:
            done = host.end()
            yield Span(start, EMAIL, done)
    for lo, hi in _zones(text):
        for m in _QUAD.finditer(text, lo, hi):
            yield Span(m.start(), IP, m.end())
        for m in _CHAIN.finditer(text, lo, hi):
            count = len(digits_of(m.group()))
            if 12 <= count <= 19:
                yield Span(m.start(), CARD, m.end())
            if 7 <= count <= 15:
                # A bracket before the area code, or a plus, is part of the number.
                start = m.start() - (text[m.start() - 1 : m.start()] == "(")
                yield Span(start - (text[start - 1 : start] == "+"), PHONE, m.end())
    done = 0
    for m in _COLONS.finditer(text):
        if m.start() >= done:
            lead = text[max(done, m.start() - 40) : m.start()]
            start = m.start() - len(lead) + len(lead.rstrip(_HEX))
            tail = text[m.end() : m.end() + 40]
            done = m.end() + len(tail) - len(tail.lstrip(_HEX))
            yield Span(start, IP, done)


def candidates(text: str) -> list[Candidate]:
    """All exact spans, and the wider ones that overlap none of them."""
    exact = exact_spans(text)
    out = [_judged(text, span, True) for span in exact]
    starts = [span.start for span in exact]
    reaches = list(accumulate((span.end for span in exact), max))
    for span in sorted(set(_wide_spans(text))):
        before = bisect_left(starts, span.end)  # exact spans that begin before the end of this one
        if not before or reaches[before - 1] <= span.start:
            out.append(_judged(text, span, False))
    return out


def _judged(text: str, span: Span, exact: bool) -> Candidate:
    start, kind, end = span
    body = text[start:end]
    left, right = text[start - 1 : start], text[end : end + 1]
    digits = digits_of(body)
    shape, listed = _SHAPES[kind](body, digits)
    regex = YES if exact else NO if _PATTERNED[kind](body) else ABSTAIN
    inside = left.isalnum() or right.isalnum() or (left == '"' and right == '"' and kind != EMAIL)
    context = _context(text[max(0, start - CONTEXT) : start], kind)
    marks = {c for c in body if not c.isalnum()}
    length = min(len(digits) // 4, 4) if kind != EMAIL else min(len(body) // 10, 4)
    traits = f"{_side(left)}{_side(right)}{length}{'+' if '+' in marks else '('if '(' in marks else '-' if marks else '.'}"
    votes = (regex, shape, listed, context, NO if inside else YES if not left.strip() and not right.strip(" .,;:!?)\n") else ABSTAIN)
    return Candidate(span, exact, votes, traits)


def _side(char: str) -> str:
    return "a" if char.isalnum() else "s" if not char.strip() else "p"


def _context(before: str, kind: int) -> int:
    """The nearest key word decides."""
    for word in reversed(_WORD.findall(before.lower())):
        if word in _AGAINST:
            return NO
        if word in _FOR:
            return YES if _FOR[word] == kind else NO
    return ABSTAIN


def _email(body: str, digits: str) -> tuple[int, int]:
    last = re.split(r"[^A-Za-z0-9-]+", body)[-1].lower()
    shape = YES if last.isalpha() and len(last) > 1 and re.search(r"[.]|dot|DOT", body) else NO
    return shape, YES if last in _TOP_LABELS else NO if last in _FILE_ENDINGS else ABSTAIN


def _ip(body: str, digits: str) -> tuple[int, int]:
    try:
        found = ipaddress.ip_address(body)
    except ValueError:
        return NO, ABSTAIN
    small = found.version == 4 and all(int(p) < 10 for p in body.split("."))
    return YES, NO if small else YES if found.is_global else ABSTAIN


def _card(body: str, digits: str) -> tuple[int, int]:
    issued = any(int(digits[: len(str(first.start))]) in first and len(digits) in lengths for first, lengths in _ISSUERS)
    return YES if passes_luhn(digits) else NO, YES if issued else NO


def _phone(body: str, digits: str) -> tuple[int, int]:
    bare = body == digits
    shape = NO if bare or not 7 <= len(digits) <= 13 else YES
    if not body.startswith("+"):
        return shape, ABSTAIN
    return shape, YES if digits[:1] in _CALLING_CODES or digits[:2] in _CALLING_CODES else NO


_SHAPES = {EMAIL: _email, IP: _ip, CARD: _card, PHONE: _phone}
#: Whether a span that is not exact has the form of the fixed pattern, and so failed its check.
_PATTERNED = {
    EMAIL: lambda body: False,
    IP: lambda body: "." in body,
    CARD: lambda body: bool(_CARD.fullmatch(body)),
    PHONE: lambda body: bool(_PHONE.fullmatch(body)),
}
