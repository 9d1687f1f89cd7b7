"""Secret scans: base rules, and a character convolutional network over every candidate.

Base rules find assignments, access keys and long runs of hexadecimal digits; their spans
always stay. Candidates are all runs of ``[A-Za-z0-9+/_=.-]`` of at least ``SHORTEST``
characters with a letter and a digit. The network reads each with ``CONTEXT`` characters on
either side: an embedding of characters, one convolution, the maximum over places, one hidden
layer; a candidate's score is the highest of its windows of ``BODY`` characters.

The network is to find what the rules miss, so it doesn't learn from what rules see. It is
trained here, on all different findings of the corpus: the values that base rules found, respelled so that no rule meets them
(other letters of the same make, groups, vendors' prefixes) and put behind other words or into
other candidates' surroundings, are secrets; candidates that no base span meets and that are
made of plain words and numbers, and such candidates made up from words of the corpus, are
not. Other candidates may be secrets and are left out. Scores are calibrated on held-out
findings, all windows of a candidate counted as when scanning; the threshold is one that finds
``RECALL`` of the held-out secrets, and lies above all but ``FALSE`` of the others if it may.

Findings are dealt to groups of some ``FINDINGS`` of each label, by a hash of what they are; where
one label has fewer groups, its groups serve several of the other's. Every group trains the
network by itself, and the weights are averaged over the groups after each of up to ``ROUNDS``
rounds; the sums are of whole numbers, so their order doesn't matter. Calibration and threshold
are sums and ranks over the held-out findings of all groups; with several groups and labels apart,
the threshold lies halfway between them. Candidates at or above it that no base span
meets are added as spans of kind ``cnn``.

Offsets are code points, ends exclusive. Defined cases: a null or empty text has no spans;
rows with equal ids are scanned each on its own; where the corpus has too few findings to
train on, nothing is added to the base spans. Other columns stay, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.order import nth_highest
from clickloom.llm.textbytes import Texts, byte_set, slices, text_udf
from clickloom.session import scratch_path

KINDS = ("assign", "access", "hex")
SHORTEST = 12
CONTEXT = 16
BODY = 48
FINDINGS = 1500  # of a label in a group
LONGEST = 256  # of longer values that training needn't spell out, it gets a digest
ROUNDS = 8
RECALL = 0.98
FALSE = 0.002
HELD_OUT = 4  # every fourth finding
SPELLINGS = 3  # of each value

# What stands before secrets, and vendors' prefixes, that no base rule asks for.
LEADS = ("pwd: ", "pass: ", 'passphrase "', "Authorization: Bearer ", "auth=", "credential=", "key: ", "private key ", "login with ", "x-auth: ", "")
PREFIXES = ("sk-", "ghp_", "xoxb-", "glpat-", "pk_live_", "AIza", "")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_WORDS = tuple(w.encode() for w in ("password", "passwd", "secret", "token", "apikey", "api_key"))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_RUN = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), *((ord(c), ord(c)) for c in "+/_=.-"))
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
_DIGIT = byte_set((0x30, 0x39))
_HEXES = byte_set((0x30, 0x39), (0x61, 0x66))


def _runs(texts: Texts, members: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of runs of at least ``least`` member bytes within a text."""
    inside = members[texts.data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = texts.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _rule_spans(text: str, lower: bytes, has_hex: bool) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the base rules."""
    spans = []
    if any(w in lower for w in _WORDS):
        spans += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"akia" in lower:
        spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if has_hex:
        spans += [(m.start(), m.end(), 2) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def found(texts: Texts) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int]], str]]:
    """Base spans and candidates of each text, with the text where it has any."""
    starts, ends = _runs(texts, _RUN, SHORTEST)
    letters, digits = (np.cumsum(np.append(0, t[texts.data])) for t in (_LETTER, _DIGIT))
    both = (letters[ends] > letters[starts]) & (digits[ends] > digits[starts])
    starts, ends = starts[both], ends[both]
    points = np.cumsum(np.append(0, (texts.data & 0xC0) != 0x80))
    hexes = np.searchsorted(_runs(texts, _HEXES, 24)[0], texts.offsets)
    firsts = np.searchsorted(starts, texts.offsets)
    for i in range(len(texts)):
        a, b = int(texts.offsets[i]), int(texts.offsets[i + 1])
        raw = texts.data[a:b].tobytes()
        lower = raw.translate(_LOWER)
        has_hex = hexes[i + 1] > hexes[i]
        own = slice(firsts[i], firsts[i + 1])
        candidates = list(zip((points[starts[own]] - points[a]).tolist(), (points[ends[own]] - points[a]).tolist()))
        if candidates or has_hex or b"akia" in lower or any(w in lower for w in _WORDS):
            text = raw.decode()
            yield _rule_spans(text, lower, has_hex), candidates, text
        else:
            yield [], [], ""


# The network


SYMBOLS = 40


def _symbol(char: str) -> int:
    """Case folds into a class of its own; characters beyond ASCII are one symbol."""
    if char.isascii():
        if char.isdigit():
            return 1
        if char.islower():
            return 2 if char in "abcdef" else 3
        if char.isupper():
            return 4 if char in "ABCDEF" else 5
        if char in " \t\n\r\x0b\x0c":
            return 6
        return 7 + ord(char) % 32
    return 39


_TABLE = np.array([_symbol(chr(i)) for i in range(128)], np.int64)


def encoded(text: str, start: int, end: int) -> np.ndarray:
    """Symbols of a candidate and its surroundings; a long candidate has a window for each ``BODY`` characters."""
    body = text[start:end]
    parts = [body[at : at + BODY] for at in range(0, len(body), BODY)]
    return np.array([_window(text[max(0, start - CONTEXT) : start], p, text[end : end + CONTEXT]) for p in parts])


def _window(before: str, body: str, after: str) -> list[int]:
    chars = before.rjust(CONTEXT, "\0") + body.ljust(BODY, "\0") + after.ljust(CONTEXT, "\0")
    return [0 if c == "\0" else int(_TABLE[ord(c)]) if ord(c) < 128 else 39 for c in chars]


@dataclass(frozen=True)
class Network:
    weights: dict[str, np.ndarray]
    scale: float
    shift: float
    threshold: float

    def probability(self, windows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * forward(self.weights, windows)[0] + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


SEED, STEPS = 7, 400
WIDTH, FILTERS, HIDDEN, EMBED = 5, 24, 16, 8
PLACES = 3  # the maxima are taken before, in and after the candidate


def initial(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    return {
        "embed": draw.normal(0, 0.5, (SYMBOLS, EMBED)),
        "filters": draw.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)),
        "filter_bias": np.zeros(FILTERS),
        "hidden": draw.normal(0, 1 / np.sqrt(PLACES * FILTERS), (PLACES * FILTERS, HIDDEN)),
        "hidden_bias": np.zeros(HIDDEN),
        "out": draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "out_bias": np.zeros(1),
    }


_PARTS = ((0, CONTEXT), (CONTEXT, CONTEXT + BODY - WIDTH + 1), (CONTEXT + BODY - WIDTH + 1, 2 * CONTEXT + BODY - WIDTH + 1))


def forward(w: dict[str, np.ndarray], windows: np.ndarray):
    """Logits, and what the backward pass needs."""
    n, length = windows.shape
    embedded = w["embed"][windows]
    places = length - WIDTH + 1
    patches = np.concatenate([embedded[:, k : k + places] for k in range(WIDTH)], axis=2)
    convolved = np.maximum(patches @ w["filters"] + w["filter_bias"], 0)
    at = np.stack([a + convolved[:, a:b].argmax(axis=1) for a, b in _PARTS], axis=1)
    pooled = np.take_along_axis(convolved, at, axis=1).reshape(n, -1)
    hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
    return hidden @ w["out"] + w["out_bias"][0], (patches, convolved, at, pooled, hidden)


def gradients(w: dict[str, np.ndarray], windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    logits, (patches, convolved, at, pooled, hidden) = forward(w, windows)
    n, places, _ = patches.shape
    d_out = (_sigmoid(logits) - labels) / n
    d_hidden = np.outer(d_out, w["out"]) * (hidden > 0)
    d_pooled = (d_hidden @ w["hidden"].T).reshape(n, PLACES, FILTERS)
    d_convolved = np.zeros_like(convolved)
    np.put_along_axis(d_convolved, at, d_pooled, axis=1)
    d_convolved *= convolved > 0
    d_patches = d_convolved @ w["filters"].T
    d_embedded = np.zeros((n, windows.shape[1], EMBED))
    for k in range(WIDTH):
        d_embedded[:, k : k + places] += d_patches[:, :, k * EMBED : (k + 1) * EMBED]
    d_embed = np.zeros_like(w["embed"])
    np.add.at(d_embed, windows, d_embedded)
    return {
        "embed": d_embed,
        "filters": np.einsum("npi,npj->ij", patches, d_convolved),
        "filter_bias": d_convolved.sum((0, 1)),
        "hidden": pooled.T @ d_hidden,
        "hidden_bias": d_hidden.sum(0),
        "out": hidden.T @ d_out,
        "out_bias": np.array([d_out.sum()]),
    }


def train(
    windows: np.ndarray, labels: np.ndarray, seed: int = SEED, steps: int = STEPS, batch: int = 64, start: dict[str, np.ndarray] | None = None
) -> dict[str, np.ndarray]:
    """Adam over batches with as many secrets as others, from the weights given, or else initial ones."""
    w, draw = dict(start or initial(seed)), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    yes, no = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    for step in range(1, steps + 1):
        own = np.concatenate([draw.choice(yes, batch // 2), draw.choice(no, batch // 2)])
        for k, g in gradients(w, windows[own], labels[own].astype(float)).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def calibrated(logits: np.ndarray, labels: np.ndarray, recall: float) -> tuple[float, float, float]:
    """Scale and shift of the logits by Newton steps on the log loss, and the threshold.

    It is low enough for the recall; where secrets and others lie apart, it is just above the others.
    """
    targets = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * logits + b)
        g = np.array([((p - targets) * logits).sum(), (p - targets).sum()])
        v = p * (1 - p) + 1e-6
        h = np.array([[(v * logits * logits).sum(), (v * logits).sum()], [(v * logits).sum(), v.sum()]]) + 1e-3 * np.eye(2)
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    scores = _sigmoid(a * logits + b)
    finds = float(np.quantile(scores[labels == 1], 1 - recall, method="lower"))
    spares = float(np.quantile(scores[labels == 0], 1 - FALSE, method="higher")) if (labels == 0).any() else 1.0
    return float(a), float(b), min(finds, float(np.nextafter(spares, 2)))


# What it is trained on


@dataclass(frozen=True)
class Finding:
    """A value of the corpus and what stands about it."""

    value: str
    before: str
    after: str


def plain(value: str) -> bool:
    """Whether a candidate is words and numbers: within each part between separators, at most one change of their kinds."""
    return all(len(_KINDS_OF_CHARS.findall(part)) <= 2 for part in re.split(r"[+/_=.-]", value))


_KINDS_OF_CHARS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def respelled(finding: Finding, draw: random.Random) -> str:
    """Another value of the same make: as hard to guess, and spelled so that the base rules don't ask for it."""
    value = finding.value
    noise = hashlib.sha512(f"{value}{draw.random()}".encode()).digest()
    size = max(16, min(len(value), 64))
    form = draw.randrange(5)
    if form == 0:
        return noise.hex().upper()[:size]
    if form == 1:
        step = draw.choice([4, 6, 8])
        return "-".join(noise.hex()[at : at + step] for at in range(0, size, step))
    letters = base64.b64encode(noise).decode()
    if form == 2:
        return letters[:size].replace("+", "-").replace("/", "_")
    if form == 3:
        return draw.choice(PREFIXES) + re.sub("[+/=]", "", letters)[:size]
    return letters[:size]


def shown(findings: list[Finding], others: list[Finding], seed: int) -> list[list[tuple[str, int, int]]]:
    """Texts with a respelled value of each finding, and where it stands. Base rules meet none of them."""
    draw, out = random.Random(seed), []
    contexts = findings + others
    for finding in findings:
        own = []
        for _ in range(20):
            value, about = respelled(finding, draw), draw.choice(contexts)
            lead = draw.choice(LEADS)
            before = f"{about.before[:-1]} {lead}" if draw.random() < 0.7 else f" {about.before[-6:]} "
            text = f"{before}{value}{draw.choice([about.after, ' ', '.', chr(34)])}"
            start = len(before)
            if not _meets((start, start + len(value)), _rules_in(text)):
                own.append((text, start, start + len(value)))
            if len(own) == SPELLINGS:
                break
        out.append(own)
    return out


def ordinary(findings: list[Finding], words: list[str], count: int, seed: int) -> list[list[tuple[str, int, int]]]:
    """Texts with plain candidates: those found, and as many as are wanting made from words and numbers."""
    draw = random.Random(seed)
    out = [[(f.before + f.value + f.after, len(f.before), len(f.before) + len(f.value))] for f in findings if plain(f.value)]
    words = words or ["word"]
    while len(out) < count:
        parts = [draw.choice([draw.choice(words), draw.choice(words).title(), str(draw.randrange(10 ** draw.randrange(1, 5)))]) for _ in range(draw.randrange(2, 7))]
        parts[draw.randrange(len(parts))] += str(draw.randrange(1, 3000))
        value = draw.choice(["-", "_", ".", "/", "/"]).join(parts)
        dated = draw.random() < 0.15
        if dated:
            value = _dated(draw)
        lead = draw.choice([*LEADS, " see ", " at ", "https://", "file "])
        text = f" {draw.choice(words)} {lead}{value} {draw.choice(words)}"
        start = len(text) - len(value) - 1 - len(text.rsplit(" ", 1)[1])
        if (dated or plain(value)) and not _meets((start, start + len(value)), _rules_in(text)):
            out.append([(text, start, start + len(value))])
    return out[: max(count, 1)]


def _dated(draw: random.Random) -> str:
    """A time, or a version."""
    a, b, c, d = (draw.randrange(1, 29) for _ in range(4))
    time = f"{draw.randrange(1970, 2040)}{draw.choice(['-', '_', '.', '/'])}{a:02}-{b:02}T{c:02}.{d:02}"
    return draw.choice([time, f"v{a}.{b}.{c}-rc{d}", f"release-{a}.{b}.{c}", f"{time}Z"])


def _rules_in(text: str) -> list[tuple[int, int, int]]:
    return _rule_spans(text, text.encode().translate(_LOWER), True)


def _windows_of(shown_texts: list[list[tuple[str, int, int]]]) -> list[np.ndarray]:
    """The windows of the candidates that scanning finds at the places given; one array for each candidate."""
    out = []
    flat = [x for own in shown_texts for x in own]
    rows = [row for part in slices(pa.array([t for t, _, _ in flat], pa.string())) for row in found(part)]
    for (text, start, end), (_, candidates, _) in zip(flat, rows):
        out += [encoded(text, a, b) for a, b in candidates if a < end and start < b]
    return out


def _highest(weights: dict[str, np.ndarray], candidates: list[np.ndarray]) -> np.ndarray:
    """The highest logit of each candidate's windows."""
    logits = forward(weights, np.concatenate(candidates))[0]
    return np.maximum.reduceat(logits, np.cumsum([0, *map(len, candidates[:-1])]))


def _examples(secret: list[Finding], other: list[Finding], seed: int) -> dict[tuple[bool, int], list[np.ndarray]]:
    """Windows of respelled values and plain candidates, by whether they are held out and their label."""
    words = sorted({w for f in (*secret, *other) for w in re.findall(r"[A-Za-z]{3,}", f"{f.before} {f.after}")})
    sides = {1: shown(secret, other, seed), 0: ordinary(other, words, max(len(other), 2 * len(secret)), seed)}
    return {
        (held, label): _windows_of([own for k, own in enumerate(side) if (k % HELD_OUT == 0) == held])
        for label, side in sides.items()
        for held in (True, False)
    }


def fit(secret: list[Finding], other: list[Finding], recall: float = RECALL, seed: int = 11) -> Network | None:
    """One group's network by itself; None where there are no values to respell."""
    if len(secret) < HELD_OUT:
        return None
    parts = _examples(secret, other, seed)
    if not all(parts.values()):
        return None
    labels = np.repeat([1, 0], [sum(map(len, parts[False, label])) for label in (1, 0)])
    weights = train(np.concatenate(parts[False, 1] + parts[False, 0]), labels)
    labels = np.repeat([1, 0], [len(parts[True, label]) for label in (1, 0)])
    scale, shift, threshold = calibrated(_highest(weights, parts[True, 1] + parts[True, 0]), labels, recall)
    return Network(weights, scale, shift, threshold)


# Spark


def _meets(span: tuple[int, int], others: list[tuple[int, int, int]]) -> bool:
    """Whether a span meets one of others, which are ordered by their starts. Of some that overlap it takes the union."""
    return Union(others).meets(*span)


class Union:
    """What ordered spans cover, as spans that don't meet."""

    def __init__(self, spans: list[tuple]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end, *_ in spans:
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start


def _value(text: str, span: tuple[int, int, int]) -> tuple[int, int]:
    """Where the secret of a base span stands: an assignment's value, else all of it."""
    start, end, kind = span
    return (end - len(_ASSIGN.fullmatch(text, start, end)[2]), end) if kind == 0 else (start, end)


def _spelled(label: int, value: str) -> str:
    """Secrets are respelled, and others that are not plain are no examples: of long ones a digest will do."""
    if len(value) <= LONGEST or (label == 0 and plain(value)):
        return value
    return hashlib.sha256(value.encode()).hexdigest()


def _findings():
    fields = [("label", pa.int32()), ("value", pa.string()), ("before", pa.string()), ("after", pa.string())]

    def make():
        def findings(texts: pa.Array) -> pa.Array:
            out = []
            for part in slices(texts):
                for spans, candidates, text in found(part):
                    base = Union(spans)
                    places = [(1, *_value(text, s)) for s in spans]
                    places += [(0, *c) for c in candidates if not base.meets(*c)]
                    out.append(
                        [
                            {"label": label, "value": _spelled(label, text[a:b]), "before": text[max(0, a - CONTEXT) : a], "after": text[b : b + CONTEXT]}
                            for label, a, b in places
                        ]
                    )
            return pa.array(out, pa.list_(pa.struct(fields)))

        return findings

    return make


def train_secrets(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> Network | None:
    """Fit on all findings; those of a group are in the order of their hashes, and every fourth is held out."""
    kind = "array<struct<label: int, value: string, before: string, after: string>>"
    rows = documents.select(text_udf(_findings(), kind)(F.col(text)).alias("f")).select(F.inline("f")).distinct()
    rows = _stored(rows.withColumn("key", F.xxhash64("value", "before", "after")), "findings")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if counts.get(1, 0) < HELD_OUT:
        return None
    groups = {label: max(1, -(-counts.get(label, 0) // FINDINGS)) for label in (1, 0)}
    n = max(groups.values())
    own = F.when(F.col("label") == 1, groups[1]).otherwise(groups[0])
    dealt = rows.withColumn("group", F.explode(F.sequence(F.pmod("key", own).cast("int"), F.lit(n - 1), own)))
    made = dealt.repartition(n, "group").groupBy("group").applyInPandas(_made(groups), _MADE)
    made = _stored(made.filter("octet_length(yes) > 0 and octet_length(no) > 0"), "examples")
    weights, rounds = initial(SEED), min(ROUNDS, n)
    for k in range(rounds):
        found = made.select("group", "yes", "no").mapInPandas(_trained(weights, k, STEPS // rounds), "weights array<bigint>")
        sums = found.select(F.posexplode("weights").alias("at", "w")).groupBy("at").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
        mean = [r["w"] / r["n"] / _UNIT for r in sums.orderBy("at").collect()]
        if not mean:
            return None
        weights = _unpacked(weights, np.array(mean))
    held = _stored(made.select("held", "sizes", "labels").mapInPandas(_logits(weights), "label int, logit double"), "held")
    found = _calibrated(held, recall, averaged=n > 1)
    return found and Network(weights, *found)


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written below the shared folder and read again."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


_UNIT = 2**36  # weights are summed as whole multiples of its inverse
_MADE = "group int, yes binary, no binary, held binary, sizes array<int>, labels array<int>"


def _made(groups: dict[int, int]):
    """Windows of one group's examples. What serves several groups is held out for the first of them."""

    def made(found: pd.DataFrame) -> pd.DataFrame:
        group = int(found["group"].iloc[0])
        found = found.sort_values(["key", "value", "before", "after"])
        secret, other = ([Finding(r.value, r.before, r.after) for r in found[found.label == k].itertuples()] for k in (1, 0))
        parts = _examples(secret, other, 11 + group)
        held = [(label, w) for label in (1, 0) if group < groups[label] for w in parts[True, label]]
        yes, no, out = (_bytes(ws) for ws in (parts[False, 1], parts[False, 0], [w for _, w in held]))
        return pd.DataFrame(
            {"group": [group], "yes": [yes], "no": [no], "held": [out], "sizes": [[len(w) for _, w in held]], "labels": [[label for label, _ in held]]}
        )

    return made


def _bytes(windows: list[np.ndarray]) -> bytes:
    return np.concatenate(windows).astype(np.uint8).tobytes() if windows else b""


def _windows(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).astype(np.int64).reshape(-1, 2 * CONTEXT + BODY)


def _unpacked(like: dict[str, np.ndarray], flat: np.ndarray) -> dict[str, np.ndarray]:
    """Weights of the same shapes."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: part.reshape(v.shape) for (k, v), part in zip(like.items(), np.split(flat, ends[:-1]))}


def _trained(weights: dict[str, np.ndarray], turn: int, steps: int):
    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yes, no = _windows(row.yes), _windows(row.no)
                labels = np.repeat([1, 0], [len(yes), len(no)])
                own = train(np.concatenate([yes, no]), labels, SEED + 1000 * row.group + turn, steps, start=weights)
                flat = np.concatenate([v.ravel() for v in own.values()])
                yield pd.DataFrame({"weights": [np.round(flat * _UNIT).astype(np.int64)]})

    return trained


def _logits(weights: dict[str, np.ndarray]):
    """The logit of each held-out candidate, all its windows counted."""

    def logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if len(row.sizes):
                    windows = np.split(_windows(row.held), np.cumsum(row.sizes)[:-1])
                    yield pd.DataFrame({"label": np.asarray(row.labels, np.int32), "logit": _highest(weights, windows)})

    return logits


def _calibrated(held: DataFrame, recall: float, averaged: bool) -> tuple[float, float, float] | None:
    """As ``calibrated``, by sums and ranks over rows ``label, logit``; None if a label has none.

    Averaged weights set the labels far apart; of such, the threshold is halfway between them.
    """
    counts = {r["label"]: r["n"] for r in held.groupBy("label").agg(F.count("*").alias("n")).collect()}
    yes, no = counts.get(1, 0), counts.get(0, 0)
    if not (yes and no):
        return None
    x, target = F.col("logit"), F.when(F.col("label") == 1, (yes + 1) / (yes + 2)).otherwise(1 / (no + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.least(F.greatest(a * x + b, F.lit(-40.0)), F.lit(40.0))))
        sums = held.select(x, (p - target).alias("d"), (p * (1 - p) + 1e-6).alias("v"))
        g0, g1, h00, h01, h11 = sums.agg(F.sum(F.col("d") * x), F.sum("d"), F.sum(F.col("v") * x * x), F.sum(F.col("v") * x), F.sum("v")).first()
        step = np.clip(np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + 1e-3 * np.eye(2), np.array([g0, g1])), -1, 1)
        a, b = a - float(step[0]), b - float(step[1])
        if np.abs(step).max() < 1e-9:
            break
    own = held.withColumn("one", F.lit(1))
    finds = nth_highest(own.filter("label = 1"), "logit", "one", yes - math.floor((yes - 1) * (1 - recall)))
    spares = nth_highest(own.filter("label = 0"), "logit", "one", no - math.ceil((no - 1) * (1 - FALSE)))
    spares = max(spares, (finds + spares) / 2) if averaged else spares
    finds, spares = (float(_sigmoid(np.array([a * logit + b]))[0]) for logit in (finds, spares))
    return a, b, min(finds, float(np.nextafter(spares, 2)))


SPANS = "array<struct<start: int, end: int, kind: string, score: double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))


_ORDER = {kind: k for k, kind in enumerate((*KINDS, "cnn"))}


def _scan(network: Network | None):
    def make():
        def scan(texts: pa.Array) -> pa.Array:
            out = []
            for part in slices(texts):
                rows = list(found(part))
                scores = _scores(network, rows)
                for (spans, candidates, _), own in zip(rows, scores):
                    base = Union(spans)
                    all_spans = [(a, b, KINDS[k], 1.0) for a, b, k in spans]
                    for c, score in zip(candidates, own):
                        if network and score >= network.threshold and not base.meets(*c):
                            all_spans.append((*c, "cnn", score))
                    all_spans.sort(key=lambda s: (s[0], _ORDER[s[2]]))
                    out.append([dict(zip(("start", "end", "kind", "score"), s)) for s in all_spans])
            return pa.array(out, _SPANS)

        return scan

    return make


def _scores(network: Network | None, rows: list) -> list[list[float]]:
    """Each candidate's score: the highest of its windows'."""
    windows = [encoded(text, *c) for _, candidates, text in rows for c in candidates] if network else []
    if not windows:
        return [[0.0] * len(candidates) for _, candidates, _ in rows]
    counts = [len(w) for w in windows]
    flat = np.concatenate(windows)
    p = np.concatenate([network.probability(flat[i : i + 512]) for i in range(0, len(flat), 512)])
    best = iter(np.maximum.reduceat(p, np.cumsum([0, *counts[:-1]])).tolist())
    return [[next(best) for _ in candidates] for _, candidates, _ in rows]


def secret_spans(text: Column, network: Network | None) -> Column:
    """Base spans and those the network adds, by start, as a column ``SPANS``."""
    return text_udf(_scan(network), SPANS)(text)


def secrets(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id and the ``spans``."""
    network = train_secrets(documents, doc_id, text, **options)
    return documents.select(F.col(doc_id).alias("doc_id"), secret_spans(F.col(text), network).alias("spans"))
