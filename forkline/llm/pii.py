"""Personal data: generators propose overlapping spans, boosted trees judge them by format and context, calibrated thresholds choose."""

from __future__ import annotations

import functools
import hashlib
import random
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .boosting import BoostedTrees, platt, sigmoid
from .common import add_columns, documents

#: Kinds, in the order that breaks ties of place.
KINDS = ("email", "ip", "card", "phone")
#: The base patterns; a match that fails its kind's rule is dropped.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: High-recall generators of what the base patterns miss.
WIDE = (
    ("email", re.compile(r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\sat\s)\s?[\w-]{1,63}(?:(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\sdot\s)[A-Za-z][\w-]{1,62})+")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])|(?<![0-9])[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./-]{1,2}[0-9]{4}){2}[ ./-]{1,2}[0-9]{3,7}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:00[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9A-Za-z])")),
)
WIDE_AT = re.compile(r"@|\(at\)|\[at\]|\sdot\s|\(dot\)|\[dot\]")
#: Context words that speak for a kind, and those that speak against all.
CUES = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel", "reply"),
    "ip": ("ip", "host", "server", "address", "login", "adresse", "from"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte", "payment", "amex"),
    "phone": ("call", "tel", "phone", "fax", "mobile", "telefon", "teléfono", "téléphone", "ring"),
}
AGAINST = ("version", "release", "order", "invoice", "isbn", "id", "no.", "section", "page", "date", "total", "sum", "build", "chapter")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if not i & 1 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, leftmost and non-overlapping within a kind, sorted by place and kind."""
    out = []
    if "@" in text:
        after, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > after and text[start - 1] in EMAIL_LOCAL:
                start -= 1
            m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append(("email", start, m.end()))
                after = m.end()
            at = text.find("@", max(at + 1, after))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def wide_spans(text: str) -> list[tuple[str, int, int]]:
    """Overlapping candidates of the high-recall generators."""
    digits, at = DIGIT.search(text) is not None, WIDE_AT.search(text) is not None
    return [(kind, *m.span()) for kind, p in WIDE if (at if kind == "email" else digits) for m in p.finditer(text)]


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s, before, after = text[start:end], text[max(0, start - 40) : start].lower(), text[end : end + 20].lower()
    digits = "".join(c for c in s if "0" <= c <= "9")
    runs = re.findall(r"[0-9]+", s)
    names = set(re.findall(r"[^\W\d_]+\.?", before)) | set(re.findall(r"[^\W\d_]+\.?", after))
    near = lambda cues: float(any(x == c or x.startswith(c) for x in names for c in cues))
    return [
        float(KINDS.index(kind)),
        len(s),
        len(digits),
        len(digits) / len(s),
        len(runs),
        max(map(len, runs), default=0),
        float(max((int(x[:9]) for x in runs), default=0) <= 255),
        float(12 <= len(digits) <= 19 and luhn(digits)),
        float(s[:2] == "00" or s[:1] == "+" or before[-1:] == "+"),
        float("(" in s),
        float(sum(c in " ./" for c in s)),
        float("@" in s),
        float(s.count(":")),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in ".,-/$€#"),
        near(CUES[kind]),
        near(AGAINST),
        len(re.split(r"\W+", s)[-1]),
    ]


# ---- training -----------------------------------------------------------------------------------


def _examples(n: int, seed: int) -> list[tuple[str, str, int, int, int]]:
    """(text, kind, start, end, label): every wide candidate in n invented lines; a candidate is positive where it covers what was planted."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "au", "que")) for _ in range(r.randint(1, 4)))
    octets = lambda: [str(r.randint(1, 255)) for _ in range(4)]

    def good(kind: str) -> str:
        if kind == "email":
            at, dot = r.choice((("@", "."), (" at ", " dot "), ("(at)", "."), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" @ ", ".")))
            return f"{word()}.{word()}{at}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'fr', 'es'))}"
        if kind == "ip":
            return r.choice((" . ", "[.]", ".", "(.)")).join(octets()) if r.random() < 0.6 else ":".join("%x" % r.randint(0x100, 0xFFFF) for _ in range(8))
        if kind == "card":
            sep = r.choice((".", "/", " ", "-", " - "))
            d = "4" + num(14)
            d += next(c for c in "0123456789" if luhn(d + c))
            return sep.join(d[i : i + 4] for i in range(0, 16, 4))
        a, b, c = num(3), num(3), num(4)
        return r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"0049 {a} {b} {c}", f"{a}.{b}.{c}", f"00{r.randint(1, 99)} {a} {b}{c}"))

    def bad(kind: str) -> str:
        if kind == "email":
            return r.choice((f"{word()} at {word()} dot {word()}", f"{word()} at {word()}.{word().capitalize()}", f"{word()} @ {word()} . {word()}", f"{word()} at {word()}. {word().capitalize()}", f"{word()} at {word()} . {word()}"))
        if kind == "ip":
            return r.choice((f"{r.randint(1, 20)}.{r.randint(0, 30)}.{r.randint(0, 900)}.{r.randint(256, 999)}", "%d . %d . %d . %d" % tuple(r.randint(256, 999) for _ in range(4)), "12:30:45:10"))
        if kind == "card":
            return "-".join(num(4) for _ in range(4))
        return r.choice((f"20{num(2)}-{num(3)}-{num(3)}", f"{num(2)}.{num(3)}.{num(3)}", f"{num(3)}/{num(4)}/{num(2)}", f"{num(4)} {num(4)} {num(4)} {num(4)}"))

    out = []
    for _ in range(n):
        kind, label = r.choice(KINDS), r.random() < 0.5
        span = good(kind) if label else bad(kind)
        cue = ""
        if r.random() < (0.6 if label else 0.15):
            cue = r.choice(CUES[kind]) + r.choice((" ", ": "))
        elif r.random() < (0.05 if label else 0.6):
            cue = r.choice(AGAINST) + " "
        head = " ".join(word() for _ in range(r.randint(2, 8))) + " " + cue
        text = head + span + r.choice((" ", ". ", ", ")) + " ".join(word() for _ in range(r.randint(2, 8)))
        lo, hi = len(head), len(head) + len(span)
        for k, s, e in wide_spans(text):
            same = k == kind and min(e, hi) - max(s, lo) >= 0.7 * (max(e, hi) - min(s, lo))
            out.append((text, k, s, e, int(bool(label) and same)))
    return out


class Taken:
    """Places of a text that spans hold, as disjoint intervals in order, so that a long text's spans aren't compared in pairs."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return not i or self.ends[i - 1] <= start

    def add(self, start: int, end: int) -> None:
        """Take an interval that is free, or that starts at or after all others' starts."""
        i = bisect_left(self.starts, end)
        if i and self.ends[i - 1] > start:
            self.ends[i - 1] = max(self.ends[i - 1], end)
        else:
            self.starts.insert(i, start)
            self.ends.insert(i, end)


@dataclass
class Detector:
    """A fitted model: trees, calibration, and each kind's least probability."""

    model: BoostedTrees
    slope: float
    intercept: float
    least: dict[str, float]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.model.margin(x) + self.intercept)

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans, and all selected spans, which hold the base ones.

        Added spans overlap no span chosen before; they are chosen by falling probability.
        """
        base = base_spans(text)
        wide = sorted(set(wide_spans(text)) - set(base))
        taken = Taken()
        for _, s, e in sorted(base, key=lambda b: b[1:]):
            taken.add(s, e)
        wide = [w for w in wide if taken.free(w[1], w[2])]
        if not wide:
            return base, base
        p = self.probabilities(np.array([features(text, *w) for w in wide]))
        chosen: list[tuple[str, int, int]] = []
        for i in np.argsort(-p, kind="stable"):
            k, s, e = wide[i]
            if p[i] >= self.least[k] and taken.free(s, e):
                taken.add(s, e)
                chosen.append(wide[i])
        return base, sorted([*base, *chosen], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@functools.lru_cache(4)
def train(examples: int = 4000, seed: int = 7, precision: float = 0.98) -> Detector:
    """Fit on invented lines (the documents have no span labels), calibrate on others, and set each kind's threshold to the least with that precision."""
    rows = _examples(examples, seed)
    x, y = np.array([features(*e[:4]) for e in rows]), np.array([e[4] for e in rows], float)
    model = BoostedTrees().fit(x, y)
    held = _examples(examples // 2, seed + 1)
    hx, hy = np.array([features(*e[:4]) for e in held]), np.array([e[4] for e in held], float)
    slope, intercept = platt(model.margin(hx), hy)
    p = sigmoid(slope * model.margin(hx) + intercept)
    least = {}
    for k, kind in enumerate(KINDS):
        own = hx[:, 0] == k
        order = np.argsort(-p[own])
        right = np.cumsum(hy[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= precision)
        least[kind] = float(max(0.5, p[own][order][good[-1]])) if len(good) else 2.0
    return Detector(model, slope, intercept, least)


# ---- columns ------------------------------------------------------------------------------------

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _found(values: list, detector: Detector) -> list[tuple[list, list]]:
    return [detector.spans(v or "") for v in values]


def find_personal_data(docs: DataFrame, text_col: str = "text", detector: Detector | None = None) -> DataFrame:
    """Append base_spans and spans, arrays of (kind, start, end) in code points, end exclusive.

    Null and empty texts have none. Texts are taken whole, other columns stay, rows are independent, so there is no shuffle.
    """
    detector = detector or train()
    as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]

    def make():
        def f(values: list) -> list[list]:
            both = _found(values, detector)
            return [[as_rows(b) for b, _ in both], [as_rows(a) for _, a in both]]

        return f

    return add_columns(docs, text_col, [T.StructField("base_spans", SPANS), T.StructField("spans", SPANS)], make)


def redact(docs: DataFrame, text_col: str = "text", detector: Detector | None = None) -> DataFrame:
    """Replace every selected span by its kind in brackets, in the text column itself; a null text stays null.

    Where base spans of two kinds overlap, the first one's name stands for both.
    """
    detector = detector or train()

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for kind, start, end in detector.spans(text)[1]:
            if start >= at:
                parts += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    made = add_columns(docs, text_col, [T.StructField("__redacted", T.StringType())], lambda: lambda values: [[one(v) for v in values]])
    return made.select(*(made["__redacted"].alias(c) if c == text_col else made[c] for c in docs.columns))


DIGESTS = [*(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans and all selected spans of every document."""
    detector = train()
    text_of = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)

    def make():
        def f(values: list) -> list[list]:
            both = _found(values, detector)
            counts = [[sum(s[0] == k for s in b) for b, _ in both] for k in KINDS]
            return [*counts, [hashlib.sha256(text_of(b).encode()).hexdigest() for b, _ in both], [text_of(a) for _, a in both]]

        return f

    return add_columns(documents(spark, sf_dir), "text", DIGESTS, make).drop("text")
