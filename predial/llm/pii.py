"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Four base kinds are found by fixed patterns and checks, and always stand. Beyond them,
generators of high recall propose spans, which may overlap each other: each run of digit
groups whose digits suit a kind, document numbers of letters and digits, written-out
addresses in any case of letters, account numbers (spaced or not), colon-separated
addresses. Boosted trees score each proposal by its format and its context; proposals at or
above the threshold of their kind, which is calibrated on rows held back from the trees,
are accepted, the best first, unless they overlap a base span or one accepted before.

The trees learn from generated examples and then go on with every proposal of the whole
table that the base rules tell to be personal, or that a date, a checksum or the words around
speak against; what neither tells is no example. A third of them, by their features, is held
back for calibration and thresholds, in which all of that third count. Positions are in code
points, the end exclusive.

Defined results: null text counts as empty; texts without findings have no spans. Each
kind's base matches are found on their own, so spans of two kinds may overlap; where they
do, redaction replaces the union once, under the kind that is listed first. Texts are
searched whole, in time linear in their length. Repeated rows get equal results.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predial.llm import boosting, continued
from predial.llm.support import forget_others, full_text

# The kinds in the order in which spans are listed. Base ones come first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "id", "iban", "document")

SAMPLE_PER_DOC = 20  # labelled proposals of each kind that are shown of a text
LEAST_PRECISION = 0.99
LEAST_THRESHOLD = 0.8
CONTEXT = 40  # characters before a span that are searched for words
WRONG_PER_EXAMPLE = 4  # wrong proposals taken from a made sentence
BLOCK = 4096  # proposals scored at once

Span = tuple[str, int, int]

# The patterns of the base kinds. They start only where the plain pattern
# could (a match begins at the start of its run of digits), so long runs are read once.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Proposals.
_SPLIT_GROUPS = re.compile(r"[0-9]+")
_SEPARATORS, _LETTERS = re.compile(r"[\W_]"), re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"[ ().\-/]+")
_ASCII_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_SUITS = (("phone", 7, 15), ("id", 7, 12), ("card", 13, 19))  # digits, both ends included
_AT = re.compile(r"@|\(at\)|\[at\]| at(?= )", re.I)
_WRITTEN_LOCAL = re.compile(r"[\w.+-]")
_WRITTEN_HOST = re.compile(r"(?:@|\(at\)|\[at\]| at ) ?[\w-]++", re.I)
_WRITTEN_LABEL = re.compile(r" ?(?:\.|\(dot\)|\[dot\]| dot ) ?[\w-]++", re.I)
_COLONS = re.compile(r"(?<![\w:])[0-9A-Fa-f:]++(?!\w)")
_ACCOUNT_HEAD = re.compile(r"(?<!\w)[A-Za-z]{2}[0-9]{2}")
_SIGNS = re.compile(r"[A-Za-z0-9]{0,31}")
_DOCUMENT_NUMBER = re.compile(r"(?<!\w)(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{6,12}(?!\w)")

# The labels of a domain name, the groups of a colon-separated address, the
# signs of an account number (the least is below that of any country).
NAME_LABELS = 127
ADDRESS_GROUPS = 8
ACCOUNT_SIGNS = (12, 34)

# Words whose presence before a span speaks for a kind, or for none.
_WORDS = (
    re.compile(r"e-?mail|correo|courriel|contact|write to|mailto", re.I),
    re.compile(r"phone|tel\b|tel[.:]|call|mobile|fax|tél|teléfono|telefon|handy", re.I),
    re.compile(r"card|visa|master|carte|tarjeta|karte|amex", re.I),
    re.compile(r"\bip\b|address|host|server|adresse", re.I),
    re.compile(r"ssn|social|passport|dni|iban|account|konto|cuenta|compte|\bid\b", re.I),
    re.compile(r"order|page|isbn|version|price|date|year|total|seite|nr\.|no\.|section|vol", re.I),
)
_DOCUMENT_WORD = re.compile(r"passport|pasaporte|passeport|reisepass|ausweis|dni|licen[cs]e|identity|ssn", re.I)
_TRUNK = re.compile(r"00[1-9]|1[-. ]")
_ACCOUNT_WORD = re.compile(r"iban|account|konto|cuenta|compte", re.I)
_ISBN_WORD = re.compile(r"isbn", re.I)
_PRICE_BEFORE = re.compile(r"(?:[$€£]|\b(?:price|total|precio|preis|prix|eur|usd)\b[:=]?) ?$", re.I)
_PRICE_AFTER = re.compile(r" ?(?:[$€£%]|(?:eur|usd|euros?|dollars?)\b)", re.I)
_DOT_WRITTEN = re.compile(r"\(dot\)|\[dot\]| dot ", re.I)
_SENTENCE = re.compile(r"\. +[A-ZÀ-ÖØ-Þ]")
_LAST_LABEL = re.compile(r"[\w-]+\Z")
_ENDINGS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv eu us uk de es fr it pt nl be ch at pl se no dk fi"
    " ie ru cz gr ro hu br mx ar cl pe au nz ca in jp cn kr za".split()
)
_CALENDAR = re.compile(
    r"(?<![0-9])(?:(?:19|20)[0-9]{2}([-./])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([-./])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})(?![0-9])"
)
_ISSUER = re.compile(
    r"4(?:.{12}|.{15}|.{18})|(?:5[1-5].{2}|222[1-9]|22[3-9].|2[3-6]..|27[01].|2720).{12}|3[47].{13}"
    r"|(?:6011|64[4-9].|65..|35[2-8].).{12}|3(?:0[0-5]|[68].).{11}"
)
_FOUR_GROUPS = re.compile(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}")
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}")


# Each digit doubled, less 9 where that has two digits.
_DOUBLED = str.maketrans("0123456789", "0246813579")


def passes_luhn(digits: str) -> bool:
    return (sum(map(int, digits[::-2])) + sum(map(int, digits[-2::-2].translate(_DOUBLED)))) % 10 == 0


def passes_97(account: str) -> bool:
    """The check digits of an account number, its first four signs being moved to the end."""
    signs = [c for c in account.upper() if c.isalnum()]
    return int("".join(str(int(c, 36)) for c in signs[4:] + signs[:4])) % 97 == 1


def _looks_issued(part: str) -> bool:
    digits = _digits(part)
    return bool(_FOUR_GROUPS.fullmatch(part) and _ISSUER.fullmatch(digits)) and passes_luhn(digits)


def is_isbn(digits: str) -> bool:
    return (len(digits) == 13 and digits[:3] in ("978", "979")
            and sum(int(d) * (1 + 2 * (i % 2)) for i, d in enumerate(digits)) % 10 == 0)


def _digits(text: str) -> str:
    return "".join(_SPLIT_GROUPS.findall(text))


def _emails(text: str) -> Iterator[Span]:
    """Left of each domain the run of local characters; `@` itself isn't one of them."""
    free = 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            yield "email", start, match.end()
            free = match.end()


def base_spans(text: str) -> list[Span]:
    """The matches of the fixed rules, by kind, then start."""
    spans = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for match in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in
               (q.lstrip("0") or "0" for q in match.group().split("."))):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _digits(match.group())
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            spans.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match.group())) <= 15:
                spans.append(("phone", *match.span()))
    return spans


def _chains(text: str) -> Iterator[list[tuple[int, int]]]:
    """The digit groups of each chain, a chain being groups with nothing but separators between."""
    chain: list[tuple[int, int]] = []
    for match in _SPLIT_GROUPS.finditer(text):
        if chain:
            gap = _GAP.match(text, chain[-1][1], match.start())
            if gap is None or gap.end() < match.start():
                yield chain
                chain = []
        chain.append(match.span())
    if chain:
        yield chain


def _runs(text: str, chain: list[tuple[int, int]]) -> Iterator[Span]:
    """Each run of consecutive groups whose digits suit a kind; at most 19 start at a group."""
    longest = max(most for _, _, most in _SUITS)
    for i, (start, _) in enumerate(chain):
        if start and text[start - 1] in _ASCII_WORD:
            continue
        if start and text[start - 1] in "(+" and text[start - 2 : start - 1] not in _ASCII_WORD:
            start -= 1
        digits = 0
        for j in range(i, len(chain)):
            a, end = chain[j]
            digits += end - a
            if digits > longest:
                break
            if text[end : end + 1] not in _ASCII_WORD:
                for kind, least, most in _SUITS:
                    if least <= digits <= most:
                        yield kind, start, end


def _written(text: str) -> Iterator[Span]:
    """Written-out addresses: local characters, a host and its labels, as many as a name may have.

    The local characters of one sign end where the sign before ended, so they are read once.
    """
    for match in _AT.finditer(text):
        host = _WRITTEN_HOST.match(text, match.start())
        last = match.start() - (text[match.start() - 1 : match.start()] == " ")
        start = last
        while start > 0 and _WRITTEN_LOCAL.match(text, start - 1):
            start -= 1
        if host is None or start >= last:
            continue
        end = host.end()
        for _ in range(NAME_LABELS - 1):
            label = _WRITTEN_LABEL.match(text, end)
            if label is None:
                break
            end = label.end()
            yield "email", start, end


def _colons(text: str) -> Iterator[Span]:
    """Groups of up to four signs between colons: four to eight, or fewer around one `::`."""
    for match in _COLONS.finditer(text):
        part = match.group()
        if part.endswith(":") and not part.endswith("::"):
            part = part[:-1]  # a colon of the sentence
        groups = part.split(":")
        filled = [g for g in groups if g]
        if len(groups) < 3 or not filled or max(map(len, filled)) > 4 or ":::" in part:
            continue
        if part.count("::") == 1 and len(filled) < ADDRESS_GROUPS:
            whole = part.startswith("::") or not part.startswith(":")
        else:
            whole = len(filled) == len(groups) and 4 <= len(groups) <= ADDRESS_GROUPS
        if whole:
            yield "ip", match.start(), match.start() + len(part)


def _accounts(text: str) -> Iterator[Span]:
    """Two letters, two digits and further signs, also in groups; an end after each group."""
    least, most = ACCOUNT_SIGNS
    for head in _ACCOUNT_HEAD.finditer(text):
        end, signs = head.end(), 4
        while True:
            group = _SIGNS.match(text, end)
            end, signs = group.end(), signs + group.end() - group.start()
            following = text[end : end + 1]
            if signs > most or following == "_" or following.isalnum():
                break
            if signs >= least:
                yield "iban", head.start(), end
            if following not in (" ", "-") or text[end + 1 : end + 2] not in _ASCII_WORD:
                break
            end += 1


def _proposed(text: str) -> Iterator[Span]:
    yield from _written(text)
    if ":" in text:
        yield from _colons(text)
    if _DIGIT.search(text):
        for chain in _chains(text):
            yield from _runs(text, chain)
        for match in _DOCUMENT_NUMBER.finditer(text):
            yield "document", *match.span()
        yield from _accounts(text)


def proposals(text: str) -> list[Span]:
    """Spans that may be personal, overlapping each other and those of the base rules."""
    return sorted(_proposed(text), key=_listed)


def _listed(span: Span) -> tuple[int, int, int]:
    return KINDS.index(span[0]), span[1], span[2]


def _neighbour(text: str, at: int, step: int) -> tuple[str, int]:
    """The separators from `at` on, at most 8, and how many digits, up to 8, stand behind them."""
    stop = at
    while 0 <= stop < len(text) and abs(stop - at) < 8 and text[stop] in " ().-/":
        stop += step
    digits = 0
    while 0 <= stop + digits * step < len(text) and digits < 8 and "0" <= text[stop + digits * step] <= "9":
        digits += 1
    gap = text[at:stop] if step > 0 else text[stop + 1 : at + 1]
    return (gap, digits) if digits else ("", 0)


@lru_cache(1024)
def _words_in(before: str) -> tuple[float, ...]:
    return tuple(float(bool(word.search(before))) for word in _WORDS)


@lru_cache(2)  # the kinds of one run of groups follow each other
def _common(text: str, start: int, end: int) -> tuple[float, ...]:
    part, before = text[start:end], text[max(0, start - CONTEXT) : start]
    groups = [len(g) for g in _SPLIT_GROUPS.findall(part)]
    digits = _digits(part)
    separators = _SEPARATORS.findall(part)
    left, right = text[start - 1 : start], text[end : end + 1]
    near = text[max(0, start - 30) : start] + text[end : end + 30]
    gaps = _GAP.findall(part)
    (gap_before, before_digits), (gap_after, after_digits) = _neighbour(text, start - 1, -1), _neighbour(text, end, 1)
    return (
        float(end - start),
        float(len(digits)),
        float(len(groups)),
        float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0),
        float(max(groups, default=0)),
        float(len(separators)),
        float(len(set(separators))),
        float(part[:1] == "+"),
        float("(" in part),
        float("@" in part or "at" in part.lower()),
        float(13 <= len(digits) <= 19 and passes_luhn(digits)),
        float(bool(_DATE.search(part))),
        float(sum(map(len, _LETTERS.findall(part)))),
        float(left.isalnum()),
        float(right.isalnum() or right in ("%", "€", "$")),
        float(len(_digits(near))),
        *_words_in(before),
        float(max(map(len, gaps), default=0)),
        float(len(set(gaps))),
        float(len(gap_before)),
        float(before_digits),
        float(gap_before in gaps),
        float(len(gap_after)),
        float(after_digits),
        float(gap_after in gaps),
        float(digits[:1] or -1),
        float(bool(_ISSUER.fullmatch(digits))),
        float(is_isbn(digits)),
        float(". " in part),
        float(part.count(" ")),
        float("::" in part),
        float(part.isupper()),
        float(bool(_DOCUMENT_WORD.search(before))),
        float(bool(_TRUNK.match(part))),
    )


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span, as numbers."""
    kind, start, end = span
    part = text[start:end]
    written = (0.0,) * 6
    if kind == "email":
        last_label, next_label = _LAST_LABEL.search(part), _WRITTEN_LABEL.match(text, end)
        written = (
            float(last_label is not None and last_label.group().lower() in _ENDINGS),
            float(len(last_label.group()) if last_label else 0),
            float(next_label is not None),
            float(next_label is not None and _LAST_LABEL.search(next_label.group()).group().lower() in _ENDINGS),
            float(next_label is not None and " " in next_label.group()),
            float(bool(_DOT_WRITTEN.search(part))),
        )
    return [float(KINDS.index(kind)), *_common(text, start, end), float(kind == "iban" and passes_97(part)), *written]


# -- examples ---------------------------------------------------------------------


def generated_examples(rows: int = 12000, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Proposals in made sentences, of which half hold a personal case, by whether they are one."""
    rng = np.random.default_rng(seed)

    def n(count: int) -> str:
        return "".join(map(str, rng.integers(0, 10, count)))

    def one(of: Sequence[str]) -> str:
        return of[int(rng.integers(len(of)))]

    def card(size: int = 16) -> str:
        first = one(("4", "51", "55", "2221", "6011", "")) if size == 16 else one(("34", "37"))
        first += n(size - 1 - len(first))
        return next(first + d for d in "0123456789" if passes_luhn(first + d))

    def cut(digits: str, sep: str, *sizes: int) -> str:
        parts, at = [], 0
        for size in sizes:
            parts.append(digits[at : at + size])
            at += size
        return sep.join(parts)

    def account() -> str:
        rest = one(("DE", "ES", "FR", "GB", "NL")), n(int(rng.integers(11, 25)))
        valid = next(c for c in range(2, 99) if passes_97(f"{rest[0]}{c:02d}{rest[1]}"))
        check = valid if rng.random() < 0.7 else int(rng.integers(2, 99))
        made = f"{rest[0]}{check:02d} {' '.join(map(''.join, batched(rest[1], 4)))}"
        if check != valid:
            return made
        made = made.replace(" ", one(("", "", " ", "-")))
        return made.lower() if rng.random() < 0.2 else made

    def colons() -> str:
        groups = [one((f"{rng.integers(0, 65536):x}", f"{rng.integers(0, 65536):x}", n(1))) for _ in range(int(rng.integers(2, 8)))]
        at = int(rng.integers(1, len(groups)))
        return f"{one(('fe80', '2001', '2a02', 'fd00'))}:{':'.join(groups[:at])}::{':'.join(groups[at:])}"

    def document_number() -> str:
        made = n(int(rng.integers(6, 10)))
        for at in (one((0, 0, len(made) - 1)), *rng.integers(0, len(made) - 1, int(rng.integers(0, 4)))):
            made = made[:at] + one("ABCDEFGHKLMNPRTVXYZ") + made[at + 1 :]
        return made

    names = ("john", "ann", "ann.b", "maria_g", "p.lopez", "kurt", "info", "li-wei", "sales", "x", "at.home", "jean")
    hosts = ("mail", "example", "web-mail", "acme", "uni", "gmx", "post", "mail.example", "office")
    ends = ("com", "org", "net", "de", "es", "fr", "co", "edu", "io", "co.uk")
    words = ("look", "arrive", "he", "stay", "noon", "home", "this", "that", "once", "place", "end", "work", "night",
             "again", "point", "she", "went", "seven", "table", "we", "met", "school", "store")
    ats, dots = (" at ", "(at)", " (at) ", "[at]", "@"), (" dot ", "(dot)", " (dot) ", "[dot]", " [dot] ", ".")

    def written() -> str:
        name = one(names) + (n(int(rng.integers(1, 4))) if rng.random() < 0.5 else "")
        if rng.random() < 0.1:
            name = ".".join([name, *(one(names) for _ in range(int(rng.integers(1, 12))))])
        host = ".".join([*(one(hosts) for _ in range(int(rng.choice([1, 1, 1, 1, 2, 5])))), one(ends)])
        made = name + one(ats) + host.replace(".", one(dots))
        return made if rng.random() < 0.8 else re.sub(r"(?i)(?:at|dot)", lambda m: m.group().upper(), made)

    def sentence() -> str:
        last = one(words) if rng.random() < 0.5 else one(words).capitalize()
        made = f"{one(words)} at {one(words)}" + one((". ", ". ", " dot ", ".")) + last
        return made.upper() if rng.random() < 0.1 else made

    def phone() -> str:
        sep = one(("-", "-", ".", " "))
        return one((f"({n(3)}) {n(3)}-{n(4)}", cut(n(10), sep, 3, 3, 4), f"0{n(2)} {n(3)} {n(2)} {n(2)}",
                    f"+{n(1)} ({n(3)}) {n(3)}-{n(4)}", f"+{n(2)} {n(3)} {n(3)} {n(3)}"))

    def prefixed() -> str:
        country = one(("1", "34", "44", "49", "351"))
        return one((f"1-{n(3)}-{n(3)}-{n(4)}", f"1.{n(3)}.{n(3)}.{n(4)}",
                    f"00{country} {n(3)} {n(7)}", f"00{country} {n(3)} {n(3)} {n(3)}", f"00{country}-{n(3)}-{n(6)}"))

    def date() -> str:
        y, m, d = rng.integers(1900, 2030), rng.integers(1, 13), rng.integers(1, 29)
        sep = one("-./")
        return one((f"{y}{sep}{m:02d}{sep}{d:02d}", f"{d:02d}{sep}{m:02d}{sep}{y}"))

    def table() -> str:
        most = int(rng.integers(2, 7))
        return one((" ", " ", "  ", " - ")).join(
            n(int(rng.integers(1, most))) + one(("", "", "." + n(1))) for _ in range(int(rng.integers(4, 20))))

    def lucky(maker) -> str:
        """No card, but as many digits as one, mostly with a checksum that happens to be right."""
        for _ in range(20):
            made = maker()
            if 13 <= len(_digits(made)) <= 19 and passes_luhn(_digits(made)):
                break
        return made

    phones: list[str] = []  # those of `two`: no card, yet personal

    def two() -> str:
        phones[:] = phone(), phone()
        first, second = one((phones[0], date(), n(int(rng.integers(1, 4))))), one((phones[1], date(), cut(n(12), " ", 4, 4, 4)))
        return first + one((" ", "  ", " / ", "/", " - ")) + second

    personal = (
        lambda: ("phone", f"({n(3)}) {n(3)}-{n(4)}", "call me at "),
        lambda: ("phone", f"{n(3)}-{n(3)}-{n(4)}", "phone: "),
        lambda: ("phone", f"0{n(2)} {n(3)} {n(2)} {n(2)}", "tel. "),
        lambda: ("phone", f"{n(3)}.{n(3)}.{n(4)}", "mobile "),
        lambda: ("phone", phone(), "tel. "),
        lambda: ("phone", prefixed(), one(("tel. ", "call me at ", "fax "))),
        lambda: ("card", cut(card(), one(" -"), 4, 4, 4, 4), "card "),
        lambda: ("card", one((card(), cut(card(15), " ", 4, 6, 5))), "visa "),
        lambda: ("email", written(), "write to "),
        lambda: ("email", written(), "contact "),
        lambda: ("ip", ":".join(f"{rng.integers(0, 65536):x}" for _ in range(8)), "host "),
        lambda: ("ip", colons(), "host "),
        lambda: ("id", f"{n(3)}-{n(2)}-{n(4)}", "SSN "),
        lambda: ("document", document_number(), one(("passport ", "passport no. ", "DNI ", "Ausweis ", "licence "))),
        lambda: ("iban", account(), "IBAN "),
    )
    other = (
        lambda: ("phone", f"{rng.integers(1900, 2030)}-{rng.integers(1, 13):02d}-{n(2)}", "date "),
        lambda: ("id", f"{rng.integers(1, 29):02d}.{rng.integers(1, 13):02d}.{rng.integers(1900, 2030)}", "on "),
        lambda: ("phone", n(int(rng.integers(7, 16))), "order no. "),
        lambda: ("card", n(int(rng.integers(13, 20))), "total "),
        lambda: ("id", n(int(rng.integers(7, 13))), "page "),
        lambda: ("phone", cut(n(40), " ", *[int(rng.integers(1, 5))] * int(rng.integers(4, 9))), "rows "),
        lambda: ("card", lucky(table), "rows "),
        lambda: ("card", lucky(two), ""),
        lambda: ("card", lucky(two), "on "),
        lambda: ("card", f"{n(4)} {n(4)} {n(4)} {n(4)} {n(3)}", ""),
        lambda: ("phone", f"978-{n(1)}-{n(3)}-{n(5)}-{n(1)}", "ISBN "),
        lambda: ("id", f"{n(3)}.{n(3)}.{n(3)}", "price "),
        lambda: ("email", sentence(), "they "),
        lambda: ("email", sentence(), ""),
        lambda: ("ip", ":".join([n(2)] * 4), "time "),
        lambda: ("ip", f"{one(('a', 'add', 'face', 'dead', 'c', 'abc'))}::{one(('b', 'bad', 'feed', 'de', 'f1'))}", "use "),
        lambda: ("document", document_number(), one(("order no. ", "version ", "model ", "part ", "see ", ""))),
        lambda: ("document", one(words) + n(int(rng.integers(2, 5))), one(("", "", "passport ", "licence "))),
        lambda: ("iban", f"AB{n(2)} {n(4)} {n(4)}", "version "),
        lambda: ("iban", f"{one(('ab', 'Mk', 'XP'))}{n(2)} {one(words)} {one(words)} {one(words)}", "model "),
    )
    # What may stand beside a number, in one chain with it: another case, or nothing personal.
    beside = (
        lambda: ("phone", phone()), lambda: ("card", cut(card(), " ", 4, 4, 4, 4)),
        lambda: (None, date()), lambda: (None, date()), lambda: (None, n(1)), lambda: (None, n(2)),
        lambda: (None, cut(n(40), " ", *[int(rng.integers(3, 5))] * int(rng.integers(1, 6)))),
        lambda: (None, table()),
    )
    fillers = ("the ", "and of it ", "a la de ", "und die ", "Re that. ")
    x, y = [], []
    for i in range(rows):
        makers = personal if i % 2 else other
        phones.clear()
        kind, part, word = makers[int(rng.integers(len(makers)))]()
        filler = fillers[int(rng.integers(len(fillers)))]
        # A document number is one by the word before it alone.
        said = rng.random() < 0.65 or kind == "document"
        pieces = [(None, filler * int(rng.integers(0, 3)) + (word if said else "")), (kind if i % 2 else None, part)]
        if kind in ("phone", "card", "id"):
            sep = one((" ", "  ", " / ", "/", " - "))
            if rng.random() < 0.35:
                pieces[1:1] = [beside[int(rng.integers(len(beside)))](), (None, sep)]
            if rng.random() < 0.35:
                pieces += [(None, sep), beside[int(rng.integers(len(beside)))]()]
        text, true = "", set()
        for own, piece in pieces:
            if own:
                true.add((own, len(text), len(text) + len(piece)))
            text += piece
        text += one((" ", ". ", ", ")) + filler
        for known in phones:
            if (at := text.find(known)) >= 0:
                true.add(("phone", at, at + len(known)))
        found = proposals(text)
        # Digits that happen to be a card in every respect teach nothing.
        wrong = [p for p in found if p not in true and not (p[0] == "card" and _looks_issued(text[p[1] : p[2]]))]
        # Those that pass the checksum first, as they are the hardest to tell.
        luck = [not (p[0] == "card" and passes_luhn(_digits(text[p[1] : p[2]]))) for p in wrong]
        for at in sorted(rng.permutation(len(wrong)), key=luck.__getitem__)[:WRONG_PER_EXAMPLE]:
            x.append(features(text, wrong[at]))
            y.append(0.0)
        for p in found:
            if p in true:
                x.append(features(text, p))
                y.append(1.0)
    return np.array(x), np.array(y)


def against(text: str, span: Span) -> bool:
    """Whether a date, a checksum or the words around speak against a proposal."""
    kind, start, end = span
    part, before = text[start:end], text[max(0, start - CONTEXT) : start]
    if kind == "email":
        return bool(_SENTENCE.search(part))
    if kind == "ip":  # a time
        return len(groups := part.split(":")) == 4 and all(len(g) <= 2 and g.isdigit() for g in groups)
    if kind == "iban":
        return not passes_97(part) and not _ACCOUNT_WORD.search(before)
    return bool(
        (kind == "card" and not passes_luhn(_digits(part)))
        or _CALENDAR.search(part)
        or is_isbn(_digits(part))
        or _ISBN_WORD.search(before)
        or _PRICE_BEFORE.search(before)
        or _PRICE_AFTER.match(text, end)
    )


def labelled(text: str) -> Iterator[tuple[Span, float]]:
    """Every proposal that is known: 1 for a base span, 0 where something speaks against."""
    base = base_spans(text)
    known, occupied = set(base), _Occupied(base)
    for p in _proposed(text):
        if p in known:
            yield p, 1.0
        elif occupied.clear(p[1], p[2]) and against(text, p):
            yield p, 0.0


def _weak_examples(text: str) -> list[list[float]]:
    """To look at: some labelled proposals of a text, features and, last, the label. Of each
    kind those with the smallest hash, wherever they stand in the text. Training takes all."""
    of: dict[str, list[tuple[Span, float]]] = {kind: [] for kind in KINDS}
    for p, label in labelled(text):
        of[p[0]].append((p, label))
    return [[*features(text, p), label] for of_kind in of.values()
            for p, label in heapq.nsmallest(SAMPLE_PER_DOC, of_kind, key=lambda x: _sample_order(text, x[0]))]


def _sample_order(text: str, span: Span) -> tuple[int, int, int]:
    return zlib.crc32(f"{span[1]} {text[span[1] : span[2]]}".encode("utf-8", "surrogatepass")), span[1], span[2]


class _Occupied:
    """Disjoint stretches of a text, in order."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted((s, e) for _, s, e in spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def clear(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, start)
        return not (i and self.ends[i - 1] > start) and not (i < len(self.starts) and self.starts[i] < end)

    def add(self, start: int, end: int) -> None:
        """Only where it is clear."""
        i = bisect_right(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


# -- model ------------------------------------------------------------------------


@dataclass
class ByKind:
    """Trees for each kind, which is the first feature."""

    boosters: list[boosting.Booster]

    def raw(self, x: np.ndarray) -> np.ndarray:
        raw = np.zeros(len(x))
        for k, booster in enumerate(self.boosters):
            mine = x[:, 0] == k
            if mine.any():
                raw[mine] = booster.raw(x[mine])
        return raw

    def probability(self, x: np.ndarray) -> np.ndarray:
        p = np.zeros(len(x))
        for k, booster in enumerate(self.boosters):
            mine = x[:, 0] == k
            if mine.any():
                p[mine] = booster.probability(x[mine])
        return p


@dataclass
class Model:
    booster: ByKind
    thresholds: np.ndarray  # by kind

    def accepted(self, text: str, base: list[Span]) -> list[tuple[Span, float]]:
        """Base spans with probability 1 and accepted proposals, as listed."""
        return self.accepted_in([text], [base])[0]

    def accepted_in(self, texts: Sequence[str], bases: Sequence[list[Span]]) -> list[list[tuple[Span, float]]]:
        """`accepted` of each text; the proposals of all are scored in blocks, only good ones stay."""
        occupied = [_Occupied(base) for base in bases]
        good: list[list[tuple[Span, float]]] = [[] for _ in texts]
        found = ((i, p) for i, text in enumerate(texts) for p in _proposed(text) if occupied[i].clear(p[1], p[2]))
        for block in batched(found, BLOCK):
            x = np.array([features(texts[i], p) for i, p in block])
            scores = self.booster.probability(x)
            for at in np.flatnonzero(scores >= self.thresholds[x[:, 0].astype(int)]):
                i, p = block[at]
                good[i].append((p, float(scores[at])))
        listed = []
        for i, base in enumerate(bases):
            accepted = [(span, 1.0) for span in base]
            # The best first; of equal ones the longest, then the first listed.
            for span, score in sorted(good[i], key=lambda x: (-x[1], x[0][1] - x[0][2], _listed(x[0]))):
                if occupied[i].clear(span[1], span[2]):
                    occupied[i].add(span[1], span[2])
                    accepted.append((span, score))
            listed.append(sorted(accepted, key=lambda x: _listed(x[0])))
        return listed


def _grown(x: np.ndarray, y: np.ndarray) -> tuple[ByKind, np.ndarray]:
    """Trees on two thirds of the rows, and which ones were held back."""
    held = np.arange(len(x)) % 3 == 0
    mine = [(x[:, 0] == k) & ~held for k in range(len(KINDS))]
    return ByKind([boosting.fit(x[own], y[own]) for own in mine]), held


def _calibrated(booster: ByKind, kind: np.ndarray, raw: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> Model:
    """Calibration and thresholds, by scores of rows that the trees weren't grown on."""
    thresholds = np.ones(len(KINDS))
    for k, own in enumerate(booster.boosters):
        mine = kind == k
        own.calibrate_scores(raw[mine], truth[mine], weight[mine])
        p = own.calibrated(raw[mine])
        order = np.argsort(-p, kind="stable")
        right = np.cumsum((weight * truth)[mine][order])
        good = np.flatnonzero(right >= LEAST_PRECISION * np.cumsum(weight[mine][order]))
        if len(good):
            thresholds[k] = max(LEAST_THRESHOLD, p[order][good[-1]])
    return Model(booster, thresholds)


def fit_model(x: np.ndarray, y: np.ndarray) -> Model:
    """Trees on two thirds of the rows, calibration and thresholds on the rest."""
    booster, held = _grown(x, y)
    return _calibrated(booster, x[held][:, 0], booster.raw(x[held]), y[held], np.ones(held.sum()))


def _row(x: np.ndarray, kind: int) -> np.ndarray:
    return np.insert(x, 0, float(kind), axis=1)


def examples(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All labelled proposals of `df`; those of a batch of texts that are alike in one row.

    A third is held back, by the features, so that like ones are never on both sides.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("pii")
        for batch in batches:
            counts: dict[tuple[int, int, bytes], int] = {}
            found = ((t, p, label) for t in batch["text"].to_pylist() for p, label in labelled(t))
            for block in batched(found, BLOCK):
                x = np.array([features(t, p) for t, p, _ in block])
                for own, (_, _, label), kind in zip(continued.as_bytes(x[:, 1:]), block, x[:, 0]):
                    key = int(kind), int(label), own.tobytes()
                    counts[key] = counts.get(key, 0) + 1
            kinds, labels, xs = zip(*counts) if counts else ((), (), ())
            held = [zlib.crc32(own) % 3 == 0 for own in xs]
            columns = [pa.array(kinds, pa.int32()), pa.array(labels, pa.int32()), pa.array(held, pa.bool_()),
                       pa.array(xs, pa.binary()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "label", "held", "x", "n"])

    return df.select(full_text(text).alias("text")).mapInArrow(run, continued.EXAMPLES)


def train(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from generated examples and all labelled proposals of `df`."""
    x, y = generated_examples()
    booster, held = _grown(x, y)
    kind, raw = x[:, 0].astype(int), booster.raw(x)
    grown = ~held
    made = continued.Examples(continued.as_bytes(x[grown, 1:]), kind[grown], y[grown], raw[grown], np.ones(grown.sum(), int))
    learnt = continued.learn(examples(df, doc_id, text), booster.boosters, made, _row)
    if learnt is None:
        return _calibrated(booster, kind[held], raw[held], y[held], np.ones(held.sum()))
    for own, more in zip(booster.boosters, learnt.trees):
        own.trees += [boosting.Tree(tree.feature + 1, tree.limit, tree.value) for tree in more]
    parts = zip((kind[held], booster.raw(x[held]), y[held], np.ones(held.sum())), learnt.held[:, [0, 2, 1, 3]].T)
    return _calibrated(booster, *(np.concatenate(own) for own in parts))


# -- on tables --------------------------------------------------------------------

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                            ("score", pa.float64())]))


def _as_structs(spans: Iterable[tuple[Span, float]]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e, "score": p} for (k, s, e), p in spans]


def find(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, `base` (the base spans) and `spans` (all spans), each as they are listed."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[doc_id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("pii")
        for batch in batches:
            texts = batch["text"].to_pylist()
            bases = [base_spans(value) for value in texts]
            base = [_as_structs((span, 1.0) for span in own) for own in bases]
            spans = [_as_structs(own) for own in shared.value.accepted_in(texts, bases)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(base, _SPAN), pa.array(spans, _SPAN)],
                names=["doc_id", "base", "spans"],
            )

    rows = df.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, base {SPANS}, spans {SPANS}")


def redacted(text: str, spans: Iterable[Span]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and start < merged[-1][2]:
            last = merged[-1]
            last[0] = min(last[0], kind, key=KINDS.index)
            last[2] = max(last[2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with personal data in `text` replaced by `[EMAIL]` and the like; null stays null."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        forget_others("pii")
        values = texts.to_pylist()
        full = [value or "" for value in values]
        found = shared.value.accepted_in(full, [base_spans(value) for value in full])
        return pa.array(
            [redacted(value, [s for s, _ in spans]) if spans else value for value, spans in zip(values, found)],
            pa.string(),
        )

    return df.withColumn(text, clean(F.col(text).cast("string")))
