"""Made lines of numbers with known entities, to teach the field of personal data what the fixed
patterns miss: national telephone numbers, cards in other groups or behind other numbers, addresses
with colons. Half of what the lines hold are numbers that are nobody's: tables, dates, versions,
prices, codes.

Nothing here is read from a corpus; the lines depend on the seed alone.
"""

from __future__ import annotations

import ipaddress

import numpy as np

EMAIL, IP, CARD, PHONE = range(4)

# Forms of telephone numbers (d a digit, N one from 2 to 9) that numbers are made by.
PHONE_FORMS = [
    "(Ndd) Ndd-dddd", "(Ndd)Ndd-dddd", "Ndd-Ndd-dddd", "Ndd.Ndd.dddd", "1-Ndd-Ndd-dddd", "1 (Ndd) Ndd-dddd",
    "(0NN) dddd dddd", "0NN dddd dddd", "0Nddd dddddd", "0NN/ddddddd", "0NN-dddddddd", "0N dd dd dd dd",
    "00NN dd dddddddd", "+NN dd dddd dddd", "+1 (Ndd) Ndd-dddd", "+NNddddddddd"]
# Lengths of the groups a card number is written in, and the digits it begins with.
CARD_FORMS = [((4, 4, 4, 4), "4"), ((4, 4, 4, 4), "5"), ((16,), "4"), ((4, 6, 5), "37"), ((15,), "34"), ((4, 6, 4), "36")]
CARD_SIGNS = [" ", "-", ".", "/", "  ", "_"]
# Forms of numbers that are no personal data (h a hexadecimal digit, w a letter).
PLAIN_FORMS = [
    "d", "dd", "ddd", "dddd", "ddddd", "ddddddd", "dddddddddd", "dddddddddddd", "d.d", "d.dd", "dd.dd", "ddd.dddd", "-d.ddd",
    "d,ddd.dd", "ddd,ddd", "d.d.d", "dd.d.dd", "2NNd-0N-1d", "1d/0N/2NNd", "1d.0N.2NNd", "1d:NN", "1d:NN:NN", "2NNd-0N-1dT1d:NN:NNZ",
    "19dd-20dd", "dd%", "$dd.dd", "#dddd", "wdd", "ww-ddddd", "www-dddd-ddd", "978-d-dd-dddddd-d", "hhhhhhhh-hhhh-hhhh-hhhh-hhhhhhhhhhhh",
    "hhhhhhhhhhhhhhhhhhhh", "0xhhhhhhhh", "dddd dddd", "ddd ddd ddd", "dd ddd ddd", "dddddddddddddddd", "dddd-dddd-dddd-dddd",
    "ww::ww2", "hh:hh:hh:hh:hh:hh", "@wwww", "ddd-dd", "dddd-dddd", "(ddd)", "(dddd)", "[dd]", "dd-dd-dd", "ddxddd"]
_SIGNS_BETWEEN = [" ", " ", " ", " ", ", ", "; ", " - ", " / ", ": "]
_EDGES = ["", "", "", "", ".", ",", "!", ")", "###"]


def filled(form: str, rng: np.random.Generator) -> str:
    """The form with its letters d, N, h and w replaced by random digits and letters."""
    return "".join(
        str(rng.integers(10)) if c == "d" else str(rng.integers(2, 10)) if c == "N" else "0123456789abcdef"[rng.integers(16)]
        if c == "h" else chr(97 + rng.integers(26)) if c == "w" else c for c in form)


def card_number(length: int, begin: str, rng: np.random.Generator) -> str:
    """Random digits whose last one is the Luhn check digit of the others."""
    digits = begin + filled("d" * (length - 1 - len(begin)), rng)
    doubled = [(int(c) * 2 - 9 * (c > "4")) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(digits))]
    return digits + str(-sum(doubled) % 10)


def entity(kind: int, rng: np.random.Generator) -> str:
    if kind == PHONE:
        return filled(PHONE_FORMS[rng.integers(len(PHONE_FORMS))], rng)
    if kind == CARD:
        groups, begin = CARD_FORMS[rng.integers(len(CARD_FORMS))]
        digits, sign, parts = card_number(sum(groups), begin, rng), CARD_SIGNS[rng.integers(len(CARD_SIGNS))], []
        for size in groups:
            parts.append(digits[:size])
            digits = digits[size:]
        return sign.join(parts)
    if kind == IP:
        if rng.random() < 0.4:
            return ".".join(str(rng.integers(256)) for _ in range(4))
        short = rng.random() < 0.7
        value = [0x2001 if rng.random() < 0.5 else 0xfe80] + [
            0 if short and 1 < i < 6 or rng.random() < 0.1 else int(rng.integers(1, 65536)) >> int(4 * rng.integers(4)) for i in range(7)]
        address = ipaddress.IPv6Address(b"".join(v.to_bytes(2, "big") for v in value))
        return address.compressed if rng.random() < 0.8 else address.exploded
    name = filled("wwww"[:rng.integers(1, 5)] + ["", ".ww", "_dd", ".dd", "dd"][rng.integers(5)], rng)
    return f"{name}@{filled('wwwww', rng)}{['', rng.integers(10)][rng.integers(2)]}.{['com', 'org', 'de', 'co.uk'][rng.integers(4)]}"


def made_line(rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A line of one to five numbers, and (kind, start, end) of the entities among them."""
    line, spans = ["", "(", "\"", "["][rng.choice(4, p=[0.85, 0.05, 0.05, 0.05])], []
    table = rng.random() < 0.25
    form = PLAIN_FORMS[rng.integers(len(PLAIN_FORMS))]
    if rng.random() < 0.25:
        # Rows of numbers of any size.
        sign, most = _SIGNS_BETWEEN[rng.integers(len(_SIGNS_BETWEEN))], int(rng.integers(2, 10))
        return sign.join(filled("d" * rng.integers(1, most), rng) for _ in range(rng.integers(2, 10))), []
    for n in range(rng.integers(1, 6)):
        if n:
            line += _SIGNS_BETWEEN[rng.integers(len(_SIGNS_BETWEEN))]
        if table or rng.random() < 0.45:
            # Columns of a table are alike.
            line += filled(form if table and rng.random() < 0.8 else PLAIN_FORMS[rng.integers(len(PLAIN_FORMS))], rng)
        else:
            kind = int(rng.choice(4, p=[0.1, 0.25, 0.25, 0.4]))
            start = len(line)
            line += entity(kind, rng)
            spans.append((kind, start, len(line)))
    return line + _EDGES[rng.integers(len(_EDGES))], spans
