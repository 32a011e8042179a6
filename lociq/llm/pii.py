"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds.

Base spans (e-mail addresses, IPv4 addresses, card numbers that pass the Luhn check, international phone numbers) are always kept;
they may overlap each other. Further generators propose overlapping candidates of more kinds. Boosted trees score each from its
format and the words around it; of those whose calibrated probability reaches their kind's threshold, and that overlap no base
span, the likeliest wins where they overlap. The trees are trained on candidates of documents (a bounded sample: max_train of those outside fold 0 that may hold any,
by a hash of the id), where loose generators of the base kinds propose base spans and near misses and the base rules label them, and on sentences made by rule from a
fixed seed for the kinds that documents have no labels of. A third of both, held out by document and sentence, calibrates the trees and sets each kind's threshold to reach the
precision asked for. quality_by_kind measures precision and recall on other documents.
Places are in code points, ends exclusive. Null and empty texts hold nothing. Repeated rows give repeated results.
"""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, boost, calibrate
from .common import byte_chunks, fold, id_text, map_arrow

BASE = ("email", "ip", "card", "phone")
#: Kinds that only the method adds, with their generators.
MORE = {
    "email_spelt": re.compile(r"[A-Za-z0-9._%+-]{2,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63} ?(?:(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,20})+"),
    "phone_local": re.compile(r"(?<![0-9.+])\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+])0[0-9]{1,4}[ /-][0-9][0-9 -]{4,10}[0-9]"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ipv6": re.compile(r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}(?::?[0-9A-Fa-f]{1,4}){1,2}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}))(?![0-9A-Za-z:])"),
    "birth_date": re.compile(r"(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2})(?![0-9./-])"),
}
KINDS = (*BASE, *MORE)
#: What may be a base kind: near misses too, which the base rules tell apart.
LOOSE = {
    "email": re.compile(r"[^\s<>()\[\]\",;]{1,64}@[^\s<>()\[\]\",;]{1,100}"), "ip": re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){2,5}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){10,21}(?![0-9])"), "phone": re.compile(r"\+?[0-9][ ().0-9-]{6,24}[0-9]"),
}
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
#: What the IPv6 generator needs, which may be without digits.
COLONS = re.compile("[A-Fa-f]:[A-Fa-f]{1,4}:|::[A-Fa-f]")
#: Words before a candidate that speak for each group of kinds, and words that speak against all.
HINTS = (
    re.compile(r"mail|contact|write|reach", re.I), re.compile(r"phone|tel|call|mobile|fax|cell|ring", re.I), re.compile(r"ssn|social|security no", re.I),
    re.compile(r"iban|account|bank|transfer", re.I), re.compile(r"\bip\b|host|address|ping|server", re.I), re.compile(r"born|birth|dob|age", re.I),
    re.compile(r"order|invoice|ref|part|item|serial|isbn|version|ticket|model|batch|build|code|doi|rfc|page", re.I), re.compile(r"price|total|cost|usd|eur|\$|amount|score", re.I),
)

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @, as the local part holds none: back over its characters, no further than the last match, then the domain."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base(text: str, digits: bool = True) -> list[Span]:
    out: list[Span] = [(a, 0, b) for a, b in emails(text)]
    if digits:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
        for m in CARD.finditer(text):
            number = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(number) <= 19 and luhn(number):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def candidates(text: str) -> list[Span]:
    return [(m.start(), KINDS.index(kind), m.end()) for kind, pattern in MORE.items() for m in pattern.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    start, kind, end = span
    s, before, after = text[start:end], text[max(0, start - 30) : start], text[end : end + 12]
    groups = re.findall("[0-9]+", s)
    digits = sum(map(len, groups))
    marks = [c for c in s if not c.isalnum()]
    return [
        kind, len(s), digits, digits / len(s), len(groups), max(map(len, groups), default=0), len(marks), len(set(marks)), float(sum(c.isupper() for c in s)),
        float(mod97(s)) if kind == KINDS.index("iban") else float(luhn("".join(groups))) if kind == KINDS.index("card") else -1.0, float(plausible_date(groups)), int(groups[0]) if groups and len(groups[0]) < 5 else -1.0,
        float(before[-1:].isalnum()), float(before[-1:] in "$€£#=/"), float(after[:1].isalnum()), float(after[:1] in "%/="), float(bool(before) and before[-1:] == "\n"), *(float(bool(h.search(before))) for h in HINTS),
    ]


def mod97(s: str) -> bool:
    """The check of account numbers."""
    x = s.replace(" ", "")
    return len(x) >= 15 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def plausible_date(groups: list[str]) -> bool:
    if len(groups) != 3:
        return False
    year = [int(g) for g in groups if len(g) == 4]
    return len(year) == 1 and 1920 <= year[0] <= 2015


def examples(n: int, seed: int) -> Iterator[tuple[str, int, int]]:
    """Made sentences with the place of a real entry, or (0, 0) where the number in it is something else."""
    rng = np.random.default_rng(seed)
    d = lambda k: "".join(str(x) for x in rng.integers(0, 10, k))
    pick = lambda *x: x[rng.integers(len(x))]
    word = lambda: "".join(pick(*"abcdefghilmnoprstu") for _ in range(rng.integers(3, 9)))
    filler = lambda: " ".join(word() for _ in range(rng.integers(0, 4)))

    def iban() -> str:
        body = pick("DE", "FR", "ES", "GB") + "00" + d(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
        body = f"{body[:2]}{check:02d}{body[4:]}"
        return " ".join(body[i : i + 4] for i in range(0, len(body), 4)) if rng.random() < 0.5 else body

    real = {
        "email_spelt": (lambda: f"{word()}{pick(' at ', ' [at] ', '(at)')}{word()}{pick(' dot ', ' [dot] ')}{pick('com', 'org', 'de')}", ("contact", "mail me:", "write to", "")),
        "phone_local": (lambda: pick(f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)} {d(6)}", f"{d(3)}.{d(3)}.{d(4)}"), ("call", "phone:", "tel.", "mobile", "my number is")),
        "ssn": (lambda: f"{d(3)}-{d(2)}-{d(4)}", ("SSN", "social security number", "ssn:", "")),
        "iban": (iban, ("IBAN", "account", "transfer to", "")),
        "ipv6": (lambda: (lambda g, k: pick(":".join(g), f"{':'.join(g[:k])}::{':'.join(g[-k:])}"))(["%x" % x for x in rng.integers(0, 65536, 8)], int(rng.integers(1, 4))), ("host", "from ip", "address", "")),
        "birth_date": (lambda: pick(f"{rng.integers(1, 29)}.{rng.integers(1, 13)}.{rng.integers(1930, 2012)}", f"{rng.integers(1930, 2012)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}"), ("born", "date of birth", "DOB:")),
    }
    other = (
        (lambda: f"{d(3)} {d(3)} {d(4)}", ("order", "invoice no", "ref", "serial", "part", "total")), (lambda: f"{d(3)}-{d(3)}-{d(4)}", ("order", "ticket", "model", "batch", "isbn")), (lambda: f"{d(3)}-{d(2)}-{d(4)}", ("part", "item", "model", "serial")),
        (lambda: pick("AB", "XK", "QT") + d(2) + pick(" ", "") + d(4) + pick(" ", "") + d(4), ("serial", "batch", "code", "item")), (lambda: ":".join(f"{x:02d}" for x in rng.integers(0, 60, 4)), ("build", "at", "score", "")),
        (lambda: f"{rng.integers(1, 29)}.{rng.integers(1, 13)}.{rng.integers(2000, 2026)}", ("version", "invoice", "page", "released", "on", "since")), (lambda: f"{rng.integers(1930, 2026)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", ("published", "build", "rfc", "on", "updated")), (lambda: f"0{d(3)}-{d(6)}", ("part", "order", "code")),
        (lambda: f"{word()} at {word()} dot {word()}", ("look", "the", "a")), (lambda: f"{pick('a', 'be', 'std', 'fa')}::{pick('c', 'add', 'dead', 'b')}", ("call", "use", "class", "namespace")),
    )
    for _ in range(n):
        positive = rng.random() < 0.5
        make, hints = real[pick(*real)] if positive else pick(*other)
        lead, entry = f"{filler()} {pick(*hints)} ", make()
        yield f"{lead}{entry} {filler()}.", len(lead) * positive, (len(lead) + len(entry)) * positive


@dataclass
class Model:
    trees: Trees
    thresholds: np.ndarray

    def select(self, text: str, taken: list[Span]) -> list[Span]:
        found = candidates(text)
        found = [s for s in found if not any(s[0] < t[2] and t[0] < s[2] for t in taken)]
        if not found:
            return []
        p = self.trees.probability(np.array([features(text, s) for s in found]))
        out: list[Span] = []
        for i in sorted(range(len(found)), key=lambda i: (-p[i], found[i][0] - found[i][2], found[i])):
            s = found[i]
            if p[i] >= self.thresholds[s[1]] and not any(s[0] < t[2] and t[0] < s[2] for t in out):
                out.append(s)
        return out


def loose_candidates(text: str) -> Iterator[tuple[Span, float]]:
    """What may be a base span, and whether the base rules say so."""
    spans = base(text)
    for name, pattern in LOOSE.items():
        kind = KINDS.index(name)
        mine = [s for s in spans if s[1] == kind]
        for m in pattern.finditer(text):
            a, b = m.span()
            yield (a, kind, b), float(any(min(b, s[2]) - max(a, s[0]) >= 0.8 * max(b - a, s[2] - s[0]) for s in mine))


def train(texts: Iterable[str] = (), n: int = 6000, precision: float = 0.95, seed: int = 3) -> Model:
    """Trees of n made sentences and of the candidates in texts."""
    x, y, out = [], [], []
    for i, (text, a, b) in enumerate(examples(n, seed)):
        for s in candidates(text):
            overlap = min(b, s[2]) - max(a, s[0])
            x.append(features(text, s))
            y.append(float(b > a and overlap >= 0.8 * max(b - a, s[2] - s[0])))
            out.append(i % 3 == 0)
    for i, text in enumerate(texts):
        for s, label in loose_candidates(text):
            x.append(features(text, s))
            y.append(label)
            out.append(i % 3 == 0)
    x, y, out = np.array(x), np.array(y), np.array(out)
    trees = boost(x[~out], y[~out])
    calibrate(trees, x[out], y[out])
    p, thresholds = trees.probability(x[out]), np.full(len(KINDS), 2.0)  # over 1: never
    for kind in np.unique(x[:, 0]).astype(int):
        mine = x[out][:, 0] == kind
        for t in np.unique(np.append(p[mine].round(3), 0.5)):
            chosen = mine & (p >= t)
            if t >= 0.5 and chosen.any() and y[out][chosen].mean() >= precision:
                thresholds[kind] = t
                break
    return Model(trees, thresholds)


def training_texts(docs: DataFrame, max_train: int, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """At most max_train texts outside fold 0 that may hold candidates, of at most a million letters, by a hash of the id."""
    some = id_text(docs, id_col, text_col).where((fold("doc_id", 5) != 0) & F.col("text").rlike("@|[0-9]{3}|[0-9][.][0-9]") & (F.length("text") < 1_000_000))
    chosen = some.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    found = some.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    return [r.text for r in sorted(found.toLocalIterator(), key=lambda r: r.doc_id)]


def fit(docs: DataFrame, max_train: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return train(training_texts(docs, max_train, id_col, text_col))


def quality_by_kind(model: Model, texts: Iterable[str]) -> dict[str, tuple[int, float, float]]:
    """Of each base kind: candidates that are one, and precision and recall of the trees at the kind's threshold, on texts that weren't trained on."""
    kinds: dict[int, list[tuple[float, float]]] = {}
    for text in texts:
        found = list(loose_candidates(text))
        p = model.trees.probability(np.array([features(text, s) for s, _ in found])) if found else []
        for (s, label), q in zip(found, p):
            kinds.setdefault(s[1], []).append((label, float(q >= model.thresholds[s[1]])))
    out = {}
    for k, rows in kinds.items():
        real, said, both = sum(a for a, _ in rows), sum(b for _, b in rows), sum(a * b for a, b in rows)
        out[KINDS[k]] = (int(real), both / said if said else 1.0, both / real if real else 1.0)
    return out


def find(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, spans of every row: arrays of structs (kind, start, end) by start, then kind as in KINDS."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs, id_col=id_col, text_col=text_col))

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        m, struct = sent.value, lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)]
        for at, texts in byte_chunks(batch.column(1)):
            first, every = [], []
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                digits = bool(DIGIT.search(text))
                spans = base(text, digits)
                first.append(struct(spans))
                every.append(struct(spans + m.select(text, spans)) if digits or "at" in text and "dot" in text or COLONS.search(text) else first[-1])
            yield {"doc_id": batch.column(0).slice(at, len(texts)), "base": first, "spans": every}

    span = "array<struct<kind: string, start: long, end: long>>"
    return map_arrow(id_text(docs, id_col, text_col), f, f"doc_id long, base {span}, spans {span}")
