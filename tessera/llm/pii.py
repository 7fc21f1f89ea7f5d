"""Personal data: base rules, high-recall candidate spans, and boosted trees that choose among them.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always
stand.  Besides, generators propose overlapping spans of looser shape: numbers
without a country code, other separators, spelled-out addresses.  Gradient
boosted trees score all of them by features of format and context, and alone
decide.  They learn from base spans, from base spans rewritten in a looser
shape (1) or spoiled (0), from look-alikes of sound form put in their place
(book numbers, versions, dates, coordinates, order numbers, number lists,
sentences that say "at" and "dot"; 0), and from the texts' own candidates that
fail the check of their kind (0), in every document.  A sound candidate of
the texts that no base rule takes may be personal data and has no label.  Per
kind, the threshold is the lowest that keeps the wanted precision on the
held-out documents (those whose id's crc32 mod 10 is 7 or more), look-alikes
included.  Cuts are exact quantiles, trees grow level by level from histograms
that Spark adds up over all examples, and counts of integers set the threshold.
Chosen spans that touch no base span are added.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: Look-alikes made of each base span.
LOOKALIKES = 3
TREES, DEPTH, BINS, RATE = 50, 4, 32, 0.3
#: Examples in an Arrow batch, and about as many as a task of the training holds (in bytes of bins).
BATCH_ROWS, TASK_ROWS = 10_000, 1 << 16
#: Sums of gradients are of integers, so the order of addition doesn't matter; log-odds are told apart to 1 / STEPS.
UNIT, STEPS = 1 << 30, 1 << 10

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _base_emails(text: str) -> list[Span]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        run = text[floor:at]
        start = floor + len(run.rstrip(_LOCAL))
        floor = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            floor = m.end()
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[Span]:
    """The base spans, by kind as listed, then by start."""
    out = _base_emails(text)
    if not _HAS_DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_HAS_DIGIT = re.compile("[0-9]")
_LOOSE_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9]){6,22}(?![0-9A-Za-z])")
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,4}(?: ?\. ?[0-9]{1,4}){3}(?![0-9.])")
_LOOSE_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_SPELLED_AT = re.compile(r"(?:at|AT)(?![A-Za-z0-9])|@ ")
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?: ?[\[({] ?(?:dot|DOT) ?[\])}] ?| (?:dot|DOT) |\.)[A-Za-z0-9-]+)+")


def candidates(text: str) -> list[Span]:
    """Overlapping spans that might be personal data, at high recall."""
    out: list[Span] = []
    floor = 0
    for m in _SPELLED_AT.finditer(text):
        start, end, seen, floor = m.start(), m.end(), floor, m.start()
        while start and text[start - 1] in " [({" and m.start() - start < 3:
            start -= 1
        if start == m.start():  # part of a word
            continue
        while text[end : end + 1] in (" ", "]", ")", "}") and end - m.end() < 3:
            end += 1
        after = _SPELLED_DOMAIN.match(text, end)
        # A local part of any length, looked for no further back than the last "at": each character is read once.
        run = text[min(seen, start) : start]
        if after and len(name := run.rstrip(_LOCAL)) < len(run):
            out.append(("email", start - len(run) + len(name), after.end()))
    if _HAS_DIGIT.search(text):
        for m in _LOOSE_NUMBER.finditer(text):
            n = len(_digits(m.group()))
            if n >= 12:
                out.append(("card", *m.span()))
            if n <= 15:
                out.append(("phone", *m.span()))
        out += [("ip", *m.span()) for m in _LOOSE_IP.finditer(text)]
        out += [("ip", *m.span()) for m in _LOOSE_IP6.finditer(text)]
    return out


_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}[ ./-][01]?[0-9][ ./-][0-3]?[0-9]|[0-3]?[0-9][ ./-][0-3]?[0-9][ ./-](?:19|20)[0-9]{2})(?![0-9])")
_SAID_DOT = re.compile(r"[\[({] ?(?:dot|DOT)| (?:dot|DOT) ")
_MARKED_AT = re.compile(r"[\[({] ?(?:at|AT)|@")


def well_formed(text: str, span: Span) -> bool:
    """Whether a candidate passes the check of its own kind, so that it may well be personal data.

    Cards: 13 to 19 digits that pass Luhn.  IP: four octets, or eight groups.
    Phones: 9 to 15 digits, in groups that are no date, decimal or dotted quad,
    or after + or 00, or after a word that speaks for phones.  Emails: an alphabetic last label,
    and a spelled dot, a marked at, or a word before it that speaks for emails.
    """
    kind, start, end = span
    s = text[start:end]
    d, hinted = _digits(s), bool(HINTS[kind].search(text[max(0, start - 40) : start]))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "ip":
        return s.count(":") == 7 if ":" in s else all(map(_small, re.split(r" ?\. ?", s)))
    if kind == "phone":
        groups = _GROUPS.findall(s)
        grouped = len(groups) > 1 and max(map(len, groups)) <= 5 and not _DATE.match(s) and not _LOOSE_IP.fullmatch(s) and not (len(groups) == 2 and "." in s)
        return 9 <= len(d) <= 15 and (grouped or hinted or s.startswith(("+", "00")))
    label = re.split("[^A-Za-z0-9-]+", s)[-1]
    return label.isalpha() and 2 <= len(label) <= 24 and (hinted or bool(_SAID_DOT.search(s)) or bool(_MARKED_AT.search(s)))


#: Words before a span that speak for a kind.
HINTS = {
    "email": re.compile(r"(?i)e-?mail|contact|write|address"),
    "ip": re.compile(r"(?i)\bip\b|server|host|address"),
    "card": re.compile(r"(?i)card|visa|credit|payment|account"),
    "phone": re.compile(r"(?i)phone|call|tel\b|mobile|fax|contact|whatsapp"),
}
#: Words before a span that speak against personal data.
AGAINST = {
    "book": re.compile(r"(?i)\bis[bs]n|\bean\b|barcode"),
    "version": re.compile(r"(?i)\bv\.? ?$|version|build|release|firmware|kernel|driver|section|chapter"),
    "place": re.compile(r"(?i)\blat\b|\blon|latitude|longitude|coordinat|position|grid"),
    "number": re.compile(r"(?i)order|invoice|ticket|tracking|serial|part|batch|\bref|\bids?\b|\bno\.|\bcase\b|#"),
    "time": re.compile(r"(?i)dated|since|until|between|period|logged|\bon $"),
    "sum": re.compile(r"(?i)total|\bsum|price|usd|eur|population|amount|count|[$\u20ac]"),
    "code": re.compile(r"(?i)\bmac\b|checksum|fingerprint|\bsha|\bmd5|digest|hash"),
}
#: Words that say "at" of places and times, not of mailboxes.
PLACE_WORDS = frozenset("look looking see you us me them it meet met here there available hosted found visit visiting live lives work works working starts ends arrives arrived open opens closes stay stayed arrive is are was were be".split())
_GROUPS = re.compile("[0-9]+")
_NUMBER_BEFORE, _NUMBER_AFTER = re.compile(r"[0-9] ?[,;:/] ?$"), re.compile(r" ?[,;:] ?[0-9]")


def book_number(digits: str) -> bool:
    """Thirteen digits with a book's prefix and check digit."""
    return len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(c) * (1, 3)[i % 2] for i, c in enumerate(digits)) % 10 == 0


def span_features(text: str, span: Span) -> list[float]:
    """Format and context of one candidate."""
    kind, start, end = span
    s, left, right = text[start:end], text[max(0, start - 40) : start], text[end : end + 1]
    groups = [len(g) for g in _GROUPS.findall(s)]
    d = _digits(s)
    octets = re.split(r" ?\. ?", s)
    last = left[-1:]
    return [
        KINDS.index(kind), len(s), len(d), len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        s.count(" "), s.count("-"), s.count("."), s.count("/"), s.count("("), s.count(":"), s.count("@"), float(s[0] == "+"), float(s[0] == "0"),
        float(len(d) > 11 and luhn(d)), float(len(octets) == 4 and all(o.isdigit() and _small(o) for o in octets)),
        float(bool(re.search(r"[\[({]", s))), sum(c.isalpha() for c in s), len(s.rsplit(".", 1)[-1].rsplit(" ", 1)[-1]),
        float(last.isalnum()), float(last in "=\"'#$"), float(right.isalnum()), float(right in "%$\"'"),
        *[float(bool(h.search(left))) for h in HINTS.values()], float(d[:1] in ("3", "4", "5", "6")) if d else 0.0, len(set(d)),
        *[float(bool(h.search(left[-24:]))) for h in AGAINST.values()], float(book_number(d)), float(bool(_DATE.match(s))),
        float(bool(_NUMBER_BEFORE.search(left))), float(bool(_NUMBER_AFTER.match(text, end))), float(well_formed(text, span)),
        groups[0] if groups else 0, float(bool(_SAID_DOT.search(s))), float(bool(_MARKED_AT.search(s))),
        *_local_features(s if kind == "email" else ""),
    ]


def _local_features(s: str) -> list[float]:
    """Of a spelled address: is its local part a word that goes before "at" in prose, has it digits or marks, is the domain dotted only."""
    local = s[: len(s) - len(s.lstrip(_LOCAL))]
    return [float(local.lower() in PLACE_WORDS), float(bool(re.search("[0-9._%+-]", local))), len(local), float("." in s[len(local) :])]


def loosened(text: str, span: Span, rng) -> tuple[str, Span]:
    """The same base span in a looser shape, in its context or after it."""
    kind, start, end = span
    s = text[start:end]
    d = _digits(s)
    if kind == "email":
        at, dot = [(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) ")][rng.integers(3)]
        name, domain = s.split("@", 1)
        plain = re.split("[^A-Za-z]", name)[0]  # mailboxes may have plain names
        name = plain if plain and plain.lower() not in PLACE_WORDS and rng.integers(2) else name
        labels = domain.split(".")
        new = name + at + dot.join(labels[-2:] if rng.integers(2) else labels)
    elif kind == "phone":
        local = d[-10:] if len(d) >= 10 else d
        shapes = [f"{local[:3]}-{local[3:6]}-{local[6:]}", f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}", f"00{d[:2]} {d[2:5]} {d[5:]}"]
        new = shapes[rng.integers(len(shapes))]
    elif kind == "card":
        sep = " .-/"[rng.integers(4)]
        new = sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    else:
        new = [s, " . ".join(s.split(".")), ":".join(f"{g:x}" for g in rng.integers(0, 1 << 16, 8))][rng.integers(3)]
    return _replaced(text, span, new, rng)


def spoiled(text: str, span: Span, rng) -> tuple[str, Span]:
    """A look-alike that fails the check of the kind, in the span's context or after it."""
    kind, start, end = span
    s = text[start:end]
    d = _digits(s)
    if kind == "email":
        new = f"{s.split('@', 1)[0]} at {rng.integers(100)}.{rng.integers(100)}"
    elif kind == "phone":
        new = d[: rng.integers(7, 9)]
    elif kind == "card":
        d = d[:-1] + str((int(d[-1]) + rng.integers(1, 10)) % 10)
        new = ["", *" .-/"][rng.integers(5)].join(d[i : i + 4] for i in range(0, len(d), 4))
    else:
        new = [f"{s.rsplit('.', 1)[0]}.{rng.integers(256, 1000)}", ":".join(f"{g:02x}" for g in rng.integers(0, 256, rng.integers(4, 8)))][rng.integers(2)]
    return _replaced(text, span, new, rng)


def lookalike(text: str, span: Span, rng) -> tuple[str, int, int]:
    """A text with something of sound form that is no personal data in the span's place: (text, start, end of it)."""
    kind = span[0]
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    some = lambda *choices: choices[rng.integers(len(choices))]
    order = lambda: some("order ", "order no. ", "invoice ", "ticket ", "tracking ", "serial ", "part ", "batch ", "ref ", "case ", "id ", "#")
    tail = ""
    if kind == "email":
        words, verb, dot = ("noon", "home", "school", "example", "github", "the-site", "work", "night"), some(*sorted(PLACE_WORDS)), some(" dot ", ".")
        new = f"{verb} at " + dot.join([*(some(*words) for _ in range(rng.integers(1, 3))), some("org", "com", "net", "io")])
        intro = some("", "please ", "we ", "it is ")
    elif kind == "ip":
        if rng.integers(2):
            new, intro = ":".join(f"{g:02x}" for g in rng.integers(0, 256, 8)), some("mac ", "checksum ", "fingerprint ", "sha1 ", "hash ")
        else:
            new, intro = some(".", " . ").join(map(str, rng.integers(0, 30, 4))) + ".x"[: rng.integers(2)], some("version ", "section ", "chapter ", "build ", "v")
    elif kind == "card":
        d = num(15)
        d += next(c for c in "0123456789" if luhn(d + c))
        new, intro = some("", " ", "-", ".").join(d[i : i + 4] for i in range(0, 16, 4)), order()
        if rng.integers(3) == 0:
            intro, tail = f"{num(3)}, {num(4)}, ", f", {num(4)}"
    else:
        shape = rng.integers(7)
        if shape == 0:
            d = some("978", "979") + num(9)
            d += next(c for c in "0123456789" if book_number(d + c))
            cut = sorted(rng.choice(np.arange(4, 12), 3, replace=False).tolist())
            new, intro = some("-", " ").join([d[:3], d[3 : cut[0]] or "0", d[cut[0] : cut[1]], d[cut[1] : 12], d[12:]]), some("ISBN ", "ISBN-13: ", "isbn ", "")
        elif shape == 1:
            new, intro = f"{some('19', '20')}{num(2)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02} {rng.integers(24):02}", some("on ", "dated ", "since ", "logged ", "")
            tail = f":{rng.integers(60):02}:{rng.integers(60):02}" * int(rng.integers(2))
        elif shape == 2:
            new, intro = f"{rng.integers(1, 20)}.{rng.integers(20)}.{num(5)}.{num(4)}", some("version ", "build ", "release ", "firmware ", "driver ", "v")
        elif shape == 3:
            new, intro = f"{num(2)} {num(3)} {num(2)} {num(3)}", some("lat ", "lon ", "latitude ", "coordinates ", "position ")
        elif shape == 4:
            new, intro = some("-", " ", "/").join([num(4), num(4), num(int(rng.integers(2, 5)))]), order()
        elif shape == 5:
            new, intro, tail = f"{num(2)} {num(3)} {num(2)} {num(3)}", f"{num(2)} {num(3)}, ", f", {num(3)}"
        else:
            new, intro = f"{rng.integers(1, 999)} {num(3)} {num(3)} {num(3)}", some("total ", "a population of ", "price ", "amount ", "USD ")
    other, (_, at, _) = _replaced(text, span, intro + new + tail, rng)
    return other, at + len(intro), at + len(intro) + len(new)


def _replaced(text: str, span: Span, new: str, rng) -> tuple[str, Span]:
    """``new`` in the span's place, half of the time after the words that follow it: loose data need no word that speaks for them."""
    kind, start, end = span
    left, right = text[end : end + 60] + " " if rng.integers(2) else text[max(0, start - 60) : start], text[end : end + 20]
    return left + new + right, (kind, len(left), len(left) + len(new))


@dataclass
class BoostedTrees:
    """Gradient boosting on the logistic loss with small histogram trees; prediction needs only numpy."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, bin, value by heap place
    floor: dict[str, float] = field(default_factory=dict)  # per kind: least probability that is chosen

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1) if len(x) else np.zeros((0, len(self.cuts)), int)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        b = self.bins(x)
        self.grow(y.mean(), lambda tree, level: self.level_sums(b, y, tree, level))

    def grow(self, share: float, sums) -> None:
        """All trees, level by level; ``sums(tree, level)`` gives ``level_sums`` over all examples."""
        share = np.clip(share, 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        for _ in range(TREES):
            size = 2 ** (DEPTH + 1)
            tree = feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
            for level in range(DEPTH):
                if level and not (feature[2 ** (level - 1) : 2**level] >= 0).any():
                    break
                for node, own in enumerate(sums(tree, level), 2**level):
                    self._split(tree, node, own)
            self.trees.append(tree)

    def level_sums(self, b: np.ndarray, y: np.ndarray, tree, level: int) -> np.ndarray:
        """Of the examples in each node of a level, per feature and bin (as many as it has): gradients, Hessians (both in units of 1 / UNIT), examples."""
        score, nodes = self._scores(b), 2**level
        place = self._places(tree, b, level) - nodes
        here = place >= 0
        place, b, p = place[here], b[here].astype(int), 1 / (1 + np.exp(-score[here]))
        weights = [np.rint((y[here] - p) * UNIT), np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT), None]
        parts = []
        for f, c in enumerate(self.cuts):
            width = len(c) + 1
            slot = place * width + b[:, f]
            parts.append(np.stack([np.bincount(slot, w, nodes * width).reshape(nodes, width) for w in weights], axis=1))
        return np.concatenate(parts, axis=2).astype(np.int64)  # node, sum, slot

    def _split(self, tree, node: int, sums: np.ndarray) -> None:
        """The node's value and, where one gains, its best split, with the values of its children."""
        feature, cut, value = tree
        first = np.cumsum([0, *(len(c) + 1 for c in self.cuts)])
        g, h, n = sums[0] / UNIT, sums[1] / UNIT, sums[2]
        own = slice(first[0], first[1])
        gs, hs = g[own].sum(), h[own].sum()
        value[node] = gs / (hs + 1.0)
        if n[own].sum() < 20:
            return
        best = (1e-3, -1, 0)
        for f in range(len(self.cuts)):
            gb, hb = np.cumsum(g[first[f] : first[f + 1]]), np.cumsum(h[first[f] : first[f + 1]])
            gain = gb**2 / (hb + 1) + (gs - gb) ** 2 / (hs - hb + 1) - gs**2 / (hs + 1)
            k = int(gain.argmax())
            best = max(best, (float(gain[k]), f, k))
        if best[1] >= 0:
            _, f, k = best
            feature[node], cut[node] = f, k
            left_g, left_h = g[first[f] : first[f] + k + 1].sum(), h[first[f] : first[f] + k + 1].sum()
            value[2 * node], value[2 * node + 1] = left_g / (left_h + 1.0), (gs - left_g) / (hs - left_h + 1.0)

    def _places(self, tree, b, levels: int):
        """The node each example reaches."""
        feature, cut, _ = tree
        node, at = np.ones(len(b), int), np.arange(len(b))
        for _ in range(levels):
            f = feature[node]
            goes = 2 * node + (b[at, np.maximum(f, 0)] > cut[node])
            node = np.where(f >= 0, goes, node)
        return node

    def _scores(self, b):
        score = np.full(len(b), self.base)
        for tree in self.trees:
            score += RATE * tree[2][self._places(tree, b, DEPTH)]
        return score

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.rint(self._scores(self.bins(x)) * STEPS) / STEPS))

    def calibrate(self, kind: np.ndarray, p: np.ndarray, y: np.ndarray, precision: float, count: np.ndarray | None = None) -> None:
        """Per kind the lowest threshold (halfway to the next lower candidate, 0.5 at least) at and above which ``precision`` of the held-out candidates are right.

        A row may stand for ``count`` candidates of one kind and probability, ``y`` of them right.
        """
        count = np.ones(len(p), int) if count is None else count
        for k, name in enumerate(KINDS):
            own = kind == k
            self.floor[name] = 2.0
            order = np.argsort(-p[own], kind="stable")
            ps, right, every = p[own][order], np.cumsum(y[own][order]), np.cumsum(count[own][order])
            good = np.flatnonzero((right >= precision * every) & (ps >= 0.5) & (np.append(ps[1:], -1) < ps))
            if len(good) and right[good[-1]] >= 20:
                self.floor[name] = max(0.5, float(ps[good[-1]] + np.append(ps, 0.0)[good[-1] + 1]) / 2)


def examples(text: str, seed: int) -> Iterator[tuple[list[float], int]]:
    """(features, label) of one text's base spans, their looser and spoiled shapes, look-alikes, and the candidates that fail their check."""
    rng = np.random.default_rng(seed)
    base = base_spans(text)
    taken = [(s, e) for _, s, e in base]
    for span in base:
        yield span_features(text, span), 1
        other, at = loosened(text, span, rng)
        yield span_features(other, at), 1
        other, at = spoiled(text, span, rng)
        yield span_features(other, at), 0
        for _ in range(LOOKALIKES):
            other, start, end = lookalike(text, span, rng)
            around = [(s, e) for _, s, e in base_spans(other)]
            for c in candidates(other):
                if c[1] < end and c[2] > start and all(c[2] <= s or c[1] >= e for s, e in around):
                    yield span_features(other, c), 0
    for span in candidates(text):
        if all(span[2] <= s or span[1] >= e for s, e in taken) and not well_formed(text, span):
            yield span_features(text, span), 0


def all_examples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``x`` (features), ``y`` (label) and ``part`` (0 to 9, by document) of every row's examples; a null text is empty."""

    def scan(batches):
        for batch in batches:
            held = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = zlib.crc32((doc or "").encode())
                for x, y in examples(text or "", seed):
                    held.append((x, y, seed % 10))
                    if len(held) == BATCH_ROWS:
                        yield batch_of(held)
                        held = []
            if held:
                yield batch_of(held)

    def batch_of(held):
        x, y, part = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32()), pa.array(part, pa.int32())], ["x", "y", "part"])

    return docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(scan, "x array<double>, y int, part int")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> BoostedTrees:
    """Trees learned from the examples of all rows of ``docs``.

    To the driver come the cuts, per level the sums of each node, feature and
    bin, and the held-out counts of each kind and probability.
    """
    ship_package(docs.sparkSession)
    rows = store(all_examples(docs, id_col, text_col), "pii")
    trees = BoostedTrees()
    sizes = {(r["fit"], r["y"]): r["n"] for r in rows.groupBy((F.col("part") < 7).alias("fit"), "y").agg(F.count("*").alias("n")).collect()}
    if len({y for _, y in sizes}) < 2:
        trees.floor = dict.fromkeys(KINDS, 2.0)  # nothing to tell apart: base spans only
        return trees
    split = (True, 0) in sizes and (True, 1) in sizes
    learned = rows.where("part < 7") if split else rows
    held_out = rows.where("part >= 7") if split and any(not fit for fit, _ in sizes) else learned
    n = {label: sum(c for (fit, y), c in sizes.items() if y == label and (fit or not split)) for label in (0, 1)}

    width = len(span_features("0", ("ip", 0, 1)))
    places = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
    cuts = learned.agg(*[F.percentile(F.col("x")[f], F.array(*map(F.lit, places))).alias(f"f{f}") for f in range(width)]).first()
    trees.cuts = [np.unique(c) for c in cuts]

    def binned(batches):
        for batch in batches:
            if len(batch):
                b, y = trees.bins(_matrix(batch.column(0))).astype(np.uint8), batch.column(1).to_numpy().astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes()]), pa.array([y.tobytes()])], ["b", "y"])

    def block(row):
        return np.frombuffer(row["b"], np.uint8).reshape(-1, width), np.frombuffer(row["y"], np.uint8).astype(float)

    tasks = (n[0] + n[1]) // TASK_ROWS + 1
    blocks = learned.select("x", "y").coalesce(tasks).mapInArrow(binned, "b binary, y binary").rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)

    def sums(tree, level):
        def part(own):
            total = None
            for b, y in own:
                one = trees.level_sums(b, y, tree, level)
                total = one if total is None else total + one
            return [] if total is None else [total]

        return blocks.mapPartitions(part).treeReduce(np.add)

    trees.grow(n[1] / (n[0] + n[1]), sums)
    blocks.unpersist()

    def scored(batches):
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype(np.int32)), pa.array(trees.predict(x)), batch.column(1)], ["kind", "p", "y"])

    counts = held_out.select("x", "y").mapInArrow(scored, "kind int, p double, y int").groupBy("kind", "p").agg(F.sum("y").alias("right"), F.count("*").alias("n")).toArrow()
    kind, p, right, every = (counts.column(c).to_numpy() for c in ("kind", "p", "right", "n"))
    trees.calibrate(kind, p, right, PRECISION, every)
    return trees


def added_spans(text: str, base: list[Span], trees: BoostedTrees) -> list[Span]:
    """Chosen candidates that touch no base span and no better candidate; the trees alone choose."""
    taken = [(s, e) for _, s, e in base]
    free = [c for c in candidates(text) if trees.floor[c[0]] <= 1 and all(c[2] <= s or c[1] >= e for s, e in taken)]
    if not free:
        return []
    p = trees.predict(np.array([span_features(text, c) for c in free]))
    out = []
    for i in np.argsort(-p, kind="stable"):
        kind, s, e = free[i]
        if p[i] >= trees.floor[kind] and all(e <= a or s >= b for a, b in taken):
            out.append(free[i])
            taken.append((s, e))
    return out


def spell(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets (overlapping spans become one)."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, trees: BoostedTrees, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans`` (and ``redacted``) for every row of ``docs``.

    The counts and ``base_spans`` are those of the base rules, ``spans`` has the
    chosen ones too; both read kind:start:end in code points, end exclusive.  A
    null text is empty.  Repeated rows are read each for itself, other columns
    are ignored.
    """
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(trees)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_spans", "spans", *["redacted"] * with_text]

    def scan(batches):
        own = model.value
        for batch in batches:
            rows = [[] for _ in names[1:]]
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                every = base + added_spans(text, base, own)
                found = [*[sum(k == kind for kind, _, _ in base) for k in KINDS], spell(base), spell(every), *[redact(text, every)] * with_text]
                for col, v in zip(rows, found, strict=True):
                    col.append(v)
            kinds = [pa.int64()] * len(KINDS) + [pa.string()] * (2 + with_text)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(scan, f"doc_id long, {counts}, base_spans string, spans string" + ", redacted string" * with_text)
