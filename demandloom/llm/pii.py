"""Personal data by weak supervision.

Labelers of three sorts (regular expressions, gazetteers, context) vote on
candidate spans. Expectation-maximisation over the counts of vote patterns
estimates each labeler's reliability without any true label; the posteriors
train a logistic span classifier, which decides. Spans of the four base kinds
that meet the fixed rules are always kept; the method adds spans.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban", "secret", "name")
ORDER = {kind: k for k, kind in enumerate(KINDS)}

# Shapes, and lists of the gazetteer and context labelers.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SECRET = re.compile(r"[:=][ \t]*[\"']?([A-Za-z0-9+/_=-]{16,}+)")
DIGIT = re.compile(r"[0-9]")
NAME = re.compile(r"(?<!\w)(?!(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?)\b)[A-ZÀ-ÖØ-Þ][\w'-]+ [A-ZÀ-ÖØ-Þ][\w'-]+")
GIVEN = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth Barbara "
    "Susan Jessica Sarah Karen Daniel Matthew Anthony Mark Paul Steven Andrew Emily Emma Olivia Sophia Peter Hans Klaus "
    "Jürgen Wolfgang Stefan Sabine Ursula Petra Monika Jean Pierre Michel François Marie Isabelle Nathalie José Juan "
    "Carlos Luis Miguel María Carmen Ana Lucía Sofía".split())
HINTS = {
    "email": ("mail", "contact", "write to", "reach"), "ip": ("ip", "address", "server", "host", "login from"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp"),
    "ssn": ("ssn", "social security", "tax id"), "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "auth", "credential"),
    "name": ("mr", "mrs", "ms", "dr", "prof", "name", "by", "herr", "frau", "señor", "señora", "signed", "contact"),
}
AGAINST = ("version", "isbn", "order no", "page", "section", "chapter", "release", "build", "sha256", "checksum")
SECRET_NAMES = frozenset("token secret password passwd pwd key apikey api_key auth credential access_token".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
MAIL_HOSTS = ("gmail.", "yahoo.", "hotmail.", "outlook.", "icloud.", "mail")
LABELERS = ("shape", "checksum", "gazetteer", "context", "border")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost search for local@domain: the part before an @ starts where its characters do."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                last = domain.end()
                yield start, last
        at = text.find("@", at + 1)


def _octets_valid(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four base kinds, by kind as listed, then start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if _octets_valid(m[0])]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                      if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def _before_words(text: str, start: int) -> set[str]:
    return set(re.findall(r"\w+", text[max(0, start - 32):start].lower()))


def _more(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates beyond the base rules."""
    if DIGIT.search(text):
        for kind, shape in (("phone", LOCAL_PHONE), ("ssn", SSN), ("iban", IBAN)):
            for m in shape.finditer(text):
                yield kind, m.start(), m.end()
        if "=" in text or ":" in text:
            for m in SECRET.finditer(text):
                yield "secret", m.start(1), m.end(1)
    for m in NAME.finditer(text):
        # The span's own cue decides, never what stands elsewhere: a listed name in it, or a title or hint before it.
        if not GIVEN.isdisjoint(m[0].split(" ")) or not _before_words(text, m.start()).isdisjoint(HINTS["name"]):
            yield "name", m.start(), m.end()


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """Each labeler's vote: 1 personal data, -1 not, 0 no opinion."""
    value = text[start:end]
    digits = "".join(c for c in value if c.isdigit() and c.isascii())
    before = text[max(0, start - 32):start].lower()
    shape = 1 if base or kind in ("ssn", "iban") else 0
    checksum = 0
    if kind == "card":
        checksum = 1 if luhn(digits) else -1
    elif kind == "iban":
        checksum = 1 if _iban_valid(value) else -1
    elif kind == "ssn":
        checksum = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 1
    elif kind == "secret":
        mixed = len(set(value)) >= 8 and digits and any(c.isalpha() for c in value)
        checksum = 1 if mixed else -1
    gazetteer = 0
    if kind == "email":
        gazetteer = 1 if value.partition("@")[2].lower().startswith(MAIL_HOSTS) else 0
    elif kind == "card":
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    elif kind == "ip":
        gazetteer = -1 if value.startswith(("0.", "127.", "255.")) else 0
    elif kind == "secret":
        words = re.findall(r"[a-z_]+", before)
        gazetteer = 1 if words and any(w in SECRET_NAMES or w.endswith(("_token", "_key", "_secret")) for w in words[-2:]) else -1
    elif kind == "name":
        gazetteer = 1 if value.split()[0] in GIVEN else -1
    words = _before_words(text, start)
    hinted = any((h in words) if kind == "name" else (h in before) for h in HINTS[kind])
    context = 1 if hinted else (-1 if any(a in before for a in AGAINST) else 0)
    left, right = text[start - 1:start], text[end:end + 1]
    border = -1 if (left.isalnum() and left.isascii()) or (right.isalnum() and right.isascii()) else 1
    if kind == "name" and left == "":
        border = 0
    return shape, checksum, gazetteer, context, border


def pattern(text: str, kind: str, start: int, end: int, base: bool) -> tuple:
    """What the classifier sees of a candidate: kind, votes, length class."""
    return (kind, *votes(text, kind, start, end, base), min((end - start) // 8, 4))


def candidates(text: str) -> tuple[list, list]:
    """(base spans, further spans that touch none of them), each (kind, start, end)."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    more: list[tuple[str, int, int]] = []
    for kind, a, b in _more(text):
        if not any(x < b and a < y for x, y in taken) and not any(x < b and a < y for _, x, y in more):
            more.append((kind, a, b))
    return base, more


# --- label model and classifier ---------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Reliabilities by kind and labeler, and the weights of the span classifier."""

    reliability: dict[str, tuple[float, ...]]
    weights: tuple[float, ...]

    def score(self, one: tuple) -> float:
        return float(1 / (1 + np.exp(-(_features([one]) @ np.array(self.weights))[0])))


def _features(patterns: list[tuple]) -> np.ndarray:
    """Bias, kind, and for each labeler whether it says yes or no, and the length class."""
    rows = np.zeros((len(patterns), 1 + len(KINDS) + 2 * len(LABELERS) + 5))
    for r, (kind, *vote, size) in enumerate(patterns):
        rows[r, 0] = rows[r, 1 + ORDER[kind]] = 1
        for k, v in enumerate(vote):
            if v:
                rows[r, 1 + len(KINDS) + 2 * k + (v < 0)] = 1
        rows[r, 1 + len(KINDS) + 2 * len(LABELERS) + size] = 1
    return rows


def expectation_maximisation(counts: dict[tuple, int], rounds: int = 30) -> tuple[dict, dict[tuple, float]]:
    """Labeler reliabilities by kind, and the posterior of every pattern.

    One coin per kind and labeler: it is right with its reliability whenever it
    votes. Two pseudo-votes at 0.8 and a prior share of 0.5 keep kinds with few
    candidates, or labelers that never vote, defined.
    """
    reliability = {kind: np.full(len(LABELERS), 0.8) for kind in KINDS}
    share = {kind: 0.5 for kind in KINDS}
    posterior: dict[tuple, float] = {}
    by: dict[str, list[tuple]] = {}
    for one in sorted(counts):
        by.setdefault(one[0], []).append(one)
    for kind, own in by.items():
        vote, n = np.array([p[1:-1] for p in own], float), np.array([counts[p] for p in own], float)
        for _ in range(rounds):
            odds = np.log(share[kind] / (1 - share[kind])) + vote @ np.log(reliability[kind] / (1 - reliability[kind]))
            p = 1 / (1 + np.exp(-odds))
            right = (n[:, None] * np.where(vote > 0, p[:, None], 1 - p[:, None]) * (vote != 0)).sum(0)
            cast = (n[:, None] * (vote != 0)).sum(0)
            # A labeler is better than a coin by assumption; this fixes which class is which.
            reliability[kind] = np.clip((right + 20 * 0.8) / (cast + 20), 0.55, 0.99)
            share[kind] = float(np.clip((n @ p + 1) / (n.sum() + 2), 0.05, 0.95))
        posterior.update(zip(own, p.tolist()))
    return {k: tuple(v.tolist()) for k, v in reliability.items()}, posterior


def train(counts: dict[tuple, int], rounds: int = 400) -> Model:
    """Fit the label model, then the logistic classifier to its posteriors. Deterministic."""
    reliability, posterior = expectation_maximisation(counts)
    patterns = sorted(posterior)
    x = _features(patterns) if patterns else np.zeros((1, _features([(KINDS[0], 0, 0, 0, 0, 0, 0)]).shape[1]))
    y = np.array([posterior[p] for p in patterns] or [0.5])
    n = np.array([np.sqrt(counts[p]) for p in patterns] or [1.0])  # so that one frequent pattern does not drown the rest
    n = n / n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= 4.0 * (x.T @ (n * (p - y)) + 1e-4 * w)
    return Model(reliability, tuple(w.tolist()))


def fit(docs: DataFrame) -> Model:
    """The model of a corpus, from the counts of the vote patterns of every candidate in every text.

    There are at most kinds x 3^5 x 5 patterns, so what reaches the driver is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch):
                base, more = candidates(text)
                seen.update(pattern(text, *s, True) for s in base)
                seen.update(pattern(text, *s, False) for s in more)
        yield pa.RecordBatch.from_pydict({"pattern": [",".join(map(str, p)) for p in seen], "n": list(seen.values())},
                                         schema=pa.schema([("pattern", pa.string()), ("n", pa.int64())]))

    rows = docs.select("text").mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()

    def parsed(text: str) -> tuple:
        kind, *rest = text.split(",")
        return (kind, *map(int, rest))

    return train({parsed(r["pattern"]): r["n"] for r in rows})


def find(text: str, model: Model, known: dict[tuple, bool]) -> tuple[list, list]:
    """(base spans, all spans by kind and start). ``known`` keeps the decision for each pattern."""
    base, more = candidates(text)
    added = []
    for span in more:
        one = pattern(text, *span, False)
        if one not in known:
            known[one] = model.score(one) >= 0.5
        if known[one]:
            added.append(span)
    return base, sorted(base + added, key=lambda s: (ORDER[s[0]], s[1]))


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The spans of every document; offsets in code points, ends exclusive.

    Null text is empty and has none. Null doc_ids and repeated rows stay. An
    empty table gives no rows, and a model that keeps the base spans.
    """
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, bool] = {}
        for batch in batches:
            found = [find(text, model, known) for text in texts_of(batch)]
            counted = [Counter(k for k, _, _ in base) for base, _ in found]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *[pa.array([c[k] for c in counted], pa.int64()) for k in BASE],
                pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([_joined(spans) for _, spans in found], pa.string()),
            ], ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, SPANS)


def masked(text: str, spans: list) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one mark."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with personal data masked; n_chars, where it is a column, follows. Null text stays null."""
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, bool] = {}
        for batch in batches:
            texts = [None if t is None else masked(t, find(t, model, known)[1]) for t in batch.column("text").to_pylist()]
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, docs.schema)
