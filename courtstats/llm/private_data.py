"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Candidates come from patterns wider than the certain ones: written-out addresses, national phone forms, cards
grouped by other signs, addresses with bracketed dots. Five labelers (usual form, checksum or range,
gazetteer, cue words before the span, its neighbours) vote for, against or not at all; whether a span
is certain is no vote. The gazetteer joins fixed lists with what the certain spans of all documents have in common:
domains, issuer prefixes and number shapes that make up a stated share of them, so it is small at any size of the corpus.
Votes are counted by pattern over all documents in one scan. Expectation-maximisation over this table
estimates how reliable each labeler is and how likely each pattern is personal data; a logistic classifier over
features of the span and its surroundings is fitted to these probabilities and decides on every candidate.
Spans of the certain patterns stay whatever it says.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.session import materialize

from .common import query, read, small_batches

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "check", "gazetteer", "cue", "neighbours")
ACCEPT = 0.5
#: Share of the certain spans of a kind, and number of them, that make a key an entry of the gazetteer.
KEY_SHARE = 0.005
KEY_ROWS = 2
#: What is held of the labelers before any vote is seen (share of right votes), weighed as this part of the votes:
#: only cards have a check that is known beforehand to be good.
HELD_RIGHT = {"card": (0.7, 0.99, 0.7, 0.8, 0.7)}
HELD_WEIGHT = 0.3

#: Characters of the local part of an address, and the pattern behind its at-sign (fixed values).
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Wider patterns: written-out at-signs, phone numbers without a country or with a trunk zero, cards grouped by
#: other signs, colon-separated addresses and bracketed dots.
SPELT = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z0-9-]{1,63}){1,4}",
    re.IGNORECASE,
)
LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
SAID = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{1,63}){1,4}",
    re.IGNORECASE,
)
TRUNK_PHONE = re.compile(r"(?<![0-9A-Za-z+().:/-])0[0-9]{1,4}(?:[\x20./-][0-9]{2,8}){1,5}(?![0-9-])")
GROUPED = re.compile(
    r"(?<![0-9])[0-9]{4}(?:(?:\x20?[-./_\u2013]\x20?|[\t\u00a0]|\x20{2})[0-9]{4}){3}(?![0-9])"
)
BRACKETED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}(?![0-9])")
COLONS = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
#: Cue words before a span, top-level domains and issuer prefixes (fixed values).
CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt", "reach"),
    "ip": ("ip", "host", "server", "address", "client", "login", "from"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta", "iban"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "llame", "appel"),
}
DOMAINS = frozenset(("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu"))
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36")
CUE_REACH = 32
#: Numbers that describe a span.
FEATURES = 9


# --- Certain patterns -------------------------------------------------------------------


def luhn(digits: str) -> bool:
    """Whether a string of digits has a right check digit."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from at-sign to at-sign: linear in the text."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            out.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def quads(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs of four dotted numbers and whether all are at most 255.

    A maximal chain of dotted numbers is consumed four at a time, as a leftmost search does.
    """
    for chain in NUMBERS.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            yield at, end, all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four)
            at = end + 1


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    #: What the gazetteer is asked for: a domain's last label, an issuer prefix, a number's shape, a first octet.
    key: str
    votes: tuple[int, ...]
    features: tuple[int, ...]


def base_and_wider(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(certain spans, other candidates that overlap none of them)."""
    base: list[tuple[str, int, int]] = []
    wider: list[tuple[str, int, int]] = []
    if "@" in text:
        base += [("email", a, b) for a, b in emails(text)]
    if "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
        wider += [("email", m.start(), m.end()) for m in SPELT.finditer(text)]
    if " dot " in text or " DOT " in text:
        wider += [("email", m.start(), m.end()) for m in SAID.finditer(text)]
    if DIGIT.search(text):
        for a, b, fits in quads(text):
            if fits:
                base.append(("ip", a, b))
            elif all(len(part) <= 3 for part in text[a:b].split(".")):
                wider.append(("ip", a, b))
        for m in CARD.finditer(text):
            if m.end() - m.start() < 12:
                continue
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19:
                (base if luhn(digits) else wider).append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                (base if 9 <= len(digits_of(m[0])) <= 15 else wider).append(("phone", m.start(), m.end()))
        wider += [("phone", m.start(), m.end()) for m in LOCAL_PHONE.finditer(text)]
        wider += [
            ("phone", m.start(), m.end()) for m in TRUNK_PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15
        ]
        wider += [("card", m.start(), m.end()) for m in GROUPED.finditer(text)]
        if ".]" in text or ".)" in text:
            wider += [("ip", m.start(), m.end()) for m in BRACKETED.finditer(text)]
    if text.count(":") >= 7:
        wider += [("ip", m.start(), m.end()) for m in COLONS.finditer(text)]
    base.sort(key=_place)
    taken = sorted((a, b) for _, a, b in base)
    out, at, reach = [], 0, 0
    for kind, a, b in sorted(wider, key=_place):
        while at < len(taken) and taken[at][0] < b:
            reach = max(reach, taken[at][1])
            at += 1
        if a >= reach:
            out.append((kind, a, b))
            reach = b  # candidates don't overlap each other either
    return base, out


def _place(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


# --- Labelers ---------------------------------------------------------------------------


def key_of(kind: str, body: str, digits: str) -> str:
    """What the gazetteer knows a span by."""
    if kind == "card":
        return f"{digits[:2]}:{len(digits)}"
    if kind == "phone":
        # The country, if any, is left out: national and international forms then have one shape.
        local = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", body)
        return re.sub("[0-9]", "9", local)
    if kind == "ip":
        return "v6" if ":" in body else body[: re.search("[^0-9]", body).start()].lstrip("0")[:4]
    return re.split(r"[^a-z0-9-]+", body.lower().rstrip(")]"))[-1]


def describe(text: str, kind: str, start: int, end: int, base: bool) -> Candidate:
    """Votes of the labelers (1 for, -1 against, 0 none), the gazetteer's by fixed lists only, and features of a span."""
    body = text[start:end]
    digits = digits_of(body)
    key = key_of(kind, body, digits)
    before, after = text[start - 1 : start], text[end : end + 1]
    lead = text[max(0, start - CUE_REACH) : start].lower()
    cue = any(word in lead for word in CUES[kind])
    other = any(word in lead for k in KINDS if k != kind for word in CUES[k])
    inside = (before.isalnum() or before in ("_", "/")) or (after.isalnum() or after in ("_", "/"))
    groups = [len(g) for g in re.findall("[0-9]+", body)]
    listed = -1
    if kind == "card":
        check = luhn(digits)
        form = groups in ([4, 4, 4, 4], [4, 6, 5], [15], [16])
        listed = 1 if digits.startswith(ISSUERS) and len(digits) in (15, 16) else -1
    elif kind == "phone":
        check = 9 <= len(digits) <= 15
        form = len(groups) > 1 and max(groups) <= 8 and groups[-1] >= 2 and body.count("(") == body.count(")") <= 1
    elif kind == "ip":
        octets = [int(p[-4:]) for p in re.findall("[0-9]+", body)]
        check = ":" in body or (len(octets) == 4 and max(octets) <= 255)
        form = ":" in body or not re.search(r"(?<![0-9])0[0-9]", body)
        listed = -1 if ":" not in body and (octets[0] == 0 or octets[0] >= 240) else 0
    else:
        check = 2 <= len(key) <= 24 and key.isalpha()
        form = bool(re.search(r"[A-Za-z0-9]\s?(?:@|[(\[]at)", body, re.IGNORECASE))
        listed = 1 if key in DOMAINS else -1
    votes = (
        1 if form else -1,
        1 if check else -1,
        listed,
        1 if cue else (-1 if other else 0),
        -1 if inside else 1,
    )
    features = (
        min(len(digits), 20) // 4,
        int(any(c in body for c in "()[]")),
        int(any(c in body for c in " -")),
        int("." in body),
        int(body[0] == "+"),
        int(inside),
        int(cue),
        int(form),
        int(check),
    )
    return Candidate(kind, start, end, base, key, votes, features)


def candidates(text: str) -> list[Candidate]:
    """All candidates of a text in the order of their place."""
    base, wider = base_and_wider(text)
    found = [describe(text, *s, True) for s in base] + [describe(text, *s, False) for s in wider]
    return sorted(found, key=lambda c: _place((c.kind, c.start, c.end)))


# --- Reliabilities and classifier -------------------------------------------------------


def estimate(
    votes: np.ndarray,
    counts: np.ndarray,
    rounds: int = 50,
    held_right: tuple[float, ...] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each vote pattern, reliability of each labeler) by expectation-maximisation.

    A labeler votes 1, -1 or 0 with probabilities that depend on the truth only; counts are
    smoothed by one vote each and, if ``held_right`` is given, by ``HELD_WEIGHT`` times the votes cast, divided as it says.
    It starts from the share of votes for.
    """
    right_votes = None if held_right is None else np.array(held_right)
    p = np.clip(0.5 + votes.sum(1) / (2 * votes.shape[1]), 0.05, 0.95)
    likelihood = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        prior = np.clip((counts * p).sum() / counts.sum(), 0.01, 0.99)
        for truth, weight in ((0, counts * (1 - p)), (1, counts * p)):
            for v in (-1, 0, 1):
                likelihood[truth, :, v + 1] = (weight[:, None] * (votes == v)).sum(0) + 1
                if v and right_votes is not None:
                    held = right_votes if (v > 0) == (truth > 0) else 1 - right_votes
                    likelihood[truth, :, v + 1] += HELD_WEIGHT * weight.sum() * held
            likelihood[truth] /= likelihood[truth].sum(1, keepdims=True)
        odds = np.full(len(votes), np.log(prior / (1 - prior)))
        for k in range(votes.shape[1]):
            odds += np.log(likelihood[1, k, votes[:, k] + 1] / likelihood[0, k, votes[:, k] + 1])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    right = likelihood[1, :, 2] * prior + likelihood[0, :, 0] * (1 - prior)
    voted = (likelihood[1, :, 2] + likelihood[1, :, 0]) * prior + (likelihood[0, :, 2] + likelihood[0, :, 0]) * (1 - prior)
    return p, right / voted


def design(kind: np.ndarray, listed: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Inputs of the classifier: constant, digit class, gazetteer and the flags, for each kind of its own."""
    one = np.ones((len(kind), 1))
    lengths = features[:, :1] == np.arange(6)
    own = np.concatenate([one, lengths, listed[:, None] > 0, features[:, 1:]], 1).astype(float)
    return np.concatenate([own * (kind == k)[:, None] for k in range(len(KINDS))], 1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton steps on the log loss against probabilities ``y``, with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


@dataclass
class SpanModel:
    weights: np.ndarray
    reliability: dict[str, dict[str, float]]
    #: (kind, key) pairs that the certain spans of the corpus have in common.
    gazetteer: frozenset[tuple[str, str]]

    def accepts(self, found: list[Candidate]) -> list[bool]:
        if not found:
            return []
        listed = [1 if (c.kind, c.key) in self.gazetteer else c.votes[LABELERS.index("gazetteer")] for c in found]
        x = design(
            np.array([KINDS.index(c.kind) for c in found]), np.array(listed), np.array([c.features for c in found])
        )
        return [c.base or bool(z > np.log(ACCEPT / (1 - ACCEPT))) for c, z in zip(found, x @ self.weights)]


def fit(docs: DataFrame, text: str = "text") -> SpanModel:
    """Count the patterns of all documents, learn the gazetteer, estimate, and fit the classifier.

    The documents are scanned once. What reaches the driver is the gazetteer (every entry has at least
    ``KEY_SHARE`` of its kind's certain spans, so 200 a kind at most) and a row per distinct pattern (kind, votes,
    features): a few thousand at most. The counts by key stay in a table.
    """
    width, at = len(LABELERS), LABELERS.index("gazetteer")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for value in batch.column(0).to_pylist():
                for c in candidates(value or ""):
                    seen[(c.kind, c.key, c.base, (*c.votes, *c.features))] += 1
            kind, key, base, pattern = zip(*seen) if seen else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kind, pa.string()),
                    pa.array(key, pa.string()),
                    pa.array(base, pa.bool_()),
                    pa.array([list(p) for p in pattern], pa.list_(pa.int32())),
                    pa.array(list(seen.values()), pa.int64()),
                ],
                names=["kind", "key", "base", "pattern", "n"],
            )

    counted = materialize(
        docs.select(text)
        .transform(small_batches).mapInArrow(count, "kind string, key string, base boolean, pattern array<int>, n long")
        .groupBy("kind", "key", "base", "pattern")
        .agg(F.sum("n").alias("n"))
    )
    certain = counted.where("base").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    totals = {r["kind"]: r["n"] for r in certain.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    least = F.coalesce(
        *[F.when(F.col("kind") == k, F.lit(max(KEY_ROWS, KEY_SHARE * n))) for k, n in sorted(totals.items())],
        F.lit(float(KEY_ROWS)),
    )
    entries = materialize(certain.where(F.col("n") >= least).select("kind", "key", F.lit(1).alias("common")))
    gazetteer = frozenset((r["kind"], r["key"]) for r in entries.collect())
    # A broadcast of at most 200 entries a kind.
    listed = F.coalesce("common", F.get("pattern", F.lit(at)))
    rows = (
        counted.join(F.broadcast(entries), ["kind", "key"], "left")
        .groupBy(
            "kind",
            F.transform("pattern", lambda v, i: F.when(i == at, listed).otherwise(v)).alias("pattern"),
        )
        .agg(F.sum("n").alias("n"))
        .orderBy("kind", "pattern")
        .collect()
    )
    if not rows:
        nothing = design(np.zeros(0, int), np.zeros(0, int), np.zeros((0, FEATURES), int))
        return SpanModel(np.zeros(nothing.shape[1]), {}, gazetteer)
    table = np.array([r["pattern"] for r in rows])
    counts = np.array([r["n"] for r in rows], float)
    kind = np.array([KINDS.index(r["kind"]) for r in rows])
    votes, features = table[:, :width], table[:, width:]
    truth, reliability = np.zeros(len(table)), {}
    for k, name in enumerate(KINDS):
        own = kind == k
        if own.any():
            truth[own], right = estimate(
                votes[own], counts[own], held_right=HELD_RIGHT.get(name)
            )
            reliability[name] = dict(zip(LABELERS, right.round(4).tolist()))
    return SpanModel(logistic(design(kind, votes[:, at], features), truth, counts), reliability, gazetteer)


def find(docs: DataFrame, model: SpanModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and spans, an array of (kind, start, end, base), by start, then kind.

    Places are code points, the end is exclusive. Null and empty texts have no spans. Repeated rows
    and null keys are kept. Other columns are dropped.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    row = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("text").to_pylist():
                found = candidates(value or "")
                out.append(
                    [
                        {"kind": c.kind, "start": c.start, "end": c.end, "base": c.base}
                        for c, yes in zip(found, model.accepts(found))
                        if yes
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(out, pa.list_(row))], names=["key", "spans"]
            )

    return source.transform(small_batches).mapInArrow(
        run, f"key {kind}, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
    ).withColumnRenamed("key", key)


def mask(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """All rows and columns, every span in the text replaced by its kind in angle brackets.

    Null texts stay null.
    """

    def cover(value: str | None) -> str | None:
        if not value:
            return value
        found = candidates(value)
        out, at = [], 0
        for c, yes in zip(found, model.accepts(found)):
            if yes and c.end > at:
                out += [value[at : max(at, c.start)], f"<{c.kind}>"]
                at = c.end
        return "".join([*out, value[at:]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = pa.array([cover(v) for v in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at), covered)

    at = docs.columns.index(text)
    return docs.transform(small_batches).mapInArrow(run, docs.schema)


@query("op5_private_spans")
def op5_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = read(spark, sf_dir, "documents")
    found = find(docs, fit(docs))

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
        for kind in ("email", "ip", "card", "phone")
    ]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans")
    )
