"""Personal data: base patterns, and a linear-chain conditional random field over word shapes for what they miss.

1. Base spans are those of four patterns (e-mail, IP, card, phone) that pass their tests; they always stay.
2. Where a text has a digit, an at sign or a spelled-out one outside of base spans, the CONTEXT characters on both sides are cut out
   (overlapping cuts are one, of any length) and split into tokens. The CRF labels these sequences: O, or the beginning
   or the inside of a kind. Its features are shapes and short words of a token and its neighbours, hashed.
3. The best labelling is found by Viterbi for a batch of sequences at a time, in numpy. Its spans are added where they meet no base span.

The CRF is trained here on a small labelled table (``labelled``: MOST_LABELLED rows at most, a documented bound) by gradient ascent of the
conditional likelihood, with the forward-backward recursion over padded batches. The tables have no labelled personal data, so
the registered query learns from invented lines.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import chunks, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{x}-{k}" for k in KINDS for x in "BI"])
#: Characters around what may be personal data that the CRF sees.
CONTEXT = 60
#: Hashed features.
FEATURES = 1 << 15
#: Rows of the labelled table that are learned from at most.
MOST_LABELLED = 5_000
EPOCHS, BATCH, RATE, SHRINK = 5, 48, 0.4, 1e-3
#: Tokens of a batch that is decoded together, padding included.
TOGETHER = 60_000

FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"

Span = tuple[int, int, int]  # start, kind, end

# --------------------------------------------------------------- base patterns

_AT = re.compile("@")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only match from its first one, so others aren't tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """The leftmost matches of the pattern, from their at signs, so that a long run without one is read once."""
    out, end = [], 0
    for m in _AT.finditer(text):
        at = begin = m.start()
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and at >= end and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            out.append((begin, end))
        else:
            end = max(end, at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def is_ip(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s.split("."))


def is_card(s: str) -> bool:
    digits = s.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(s: str) -> bool:
    return 10 <= len(_DIGIT.findall(s)) <= 15


def base_spans(text: str) -> list[Span]:
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for kind, pattern, good in ((1, _IP, is_ip), (2, _CARD, is_card), (3, _PHONE, is_phone)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if good(m[0])]
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# -------------------------------------------------------- sequences and features

_TRIGGER = re.compile(r"[0-9@]|[(\[{] ?(?:at|AT)\b|\b(?:dot|DOT)\b")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")


def windows(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """What of a text the CRF labels: CONTEXT around every digit, at sign and the like outside of the spans."""
    out: list[list[int]] = []
    covered = sorted((a, b) for a, _, b in spans)
    i = reach = 0
    for m in _TRIGGER.finditer(text):
        at = m.start()
        while i < len(covered) and covered[i][0] <= at:
            reach = max(reach, covered[i][1])
            i += 1
        if at < reach:
            continue
        if out and at - CONTEXT <= out[-1][1]:
            out[-1][1] = min(len(text), at + CONTEXT)
        else:
            out.append([max(0, at - CONTEXT), min(len(text), at + CONTEXT)])
    return [(a, b) for a, b in out]


@functools.lru_cache(100_000)
def shape(token: str) -> str:
    c = token[0]
    if c.isdigit():
        return f"d{min(len(token), 20)}"
    if not c.isalpha():
        return token
    case = "X" if token.isupper() else "x" if token.islower() else "Xx" if token[1:].islower() else "xX"
    return f"{case}{'1' if len(token) == 1 else '4' if len(token) <= 4 else '9'}"


@functools.lru_cache(200_000)
def slot(feature: str) -> int:
    return zlib.crc32(feature.encode(errors="replace")) % FEATURES


N_FEATURES = 22


def features(text: str, begin: int = 0, end: int | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(places of the tokens, slots [token, N_FEATURES]; FEATURES where there is none)."""
    found = list(_TOKEN.finditer(text, begin, len(text) if end is None else end))
    places = [m.span() for m in found]
    words = [m[0] for m in found]
    n = len(words)
    shapes = ["", "", *[shape(w) for w in words], "", ""]
    lower = [w.lower() if w[0].isalpha() and len(w) <= 10 else "" for w in words]
    glued = [i > 0 and places[i - 1][1] == places[i][0] for i in range(n)] + [False]
    out = np.full((n, N_FEATURES), FEATURES, np.int32)
    recent: list[str] = []
    for i in range(n):
        b2, b1, s, a1, a2 = shapes[i : i + 5]
        g, h = "_" if glued[i] else " ", "_" if glued[i + 1] else " "
        made = [f"s{s}", f"g{g}{s}{h}", f"b{b1}{g}{s}", f"a{s}{h}{a1}", f"B{b2}|{b1}", f"A{a1}|{a2}", f"t{b1}{g}{s}{h}{a1}", f"u{b2}{b1}{g}{s}", f"v{s}{h}{a1}{a2}", f"w{lower[i]}|{s}"]
        made.append(f"x{b2}{b1}{g}{s}{h}{a1}{a2}")
        if i:
            made.append(f"p{lower[i - 1]}|{s}")
        if i + 1 < n:
            made.append(f"n{lower[i + 1]}|{s}")
        kind = s[0] if s[:1] in ("d",) else "x" if words[i][0].isalpha() else "."
        made += [f"c{w}|{kind}" for w in recent]
        out[i, : len(made)] = list(map(slot, made))
        if lower[i]:
            recent = [*recent[-(N_FEATURES - 14) :], lower[i]][-(N_FEATURES - 13) :]
    return places, out


# ----------------------------------------------------------------------- CRF


def _padded(rows: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows)), *rows[0].shape[1:]), fill, rows[0].dtype)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Crf:
    """Weights of features by label [FEATURES + 1, L] (the last row is none), of a label after a label, and of first labels."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray, first: np.ndarray):
        self.weights, self.steps, self.first = weights, steps, first

    def emissions(self, slots: np.ndarray) -> np.ndarray:
        return self.weights[slots].sum(-2)

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(label) [B, T, L], P(label, next label) summed over a batch [L, L])."""
        b, t, n = scores.shape
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + self.first
        inside = np.arange(t)[None, :] < lengths[:, None]
        for i in range(1, t):
            step = _logsumexp(forward[:, i - 1, :, None] + self.steps, 1) + scores[:, i]
            forward[:, i] = np.where(inside[:, i, None], step, forward[:, i - 1])
        for i in range(t - 2, -1, -1):
            step = _logsumexp(self.steps + (scores[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
            backward[:, i] = np.where(inside[:, i + 1, None], step, backward[:, i])
        total = _logsumexp(forward[:, -1], 1)
        single = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
        joint = np.zeros((n, n))
        for i in range(1, t):
            both = np.exp(forward[:, i - 1, :, None] + self.steps + (scores[:, i] + backward[:, i])[:, None, :] - total[:, None, None])
            joint += (both * inside[:, i, None, None]).sum(0)
        return single, joint

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best labels [B, T] of a batch, by Viterbi; what is past a sequence's length is 0."""
        b, t, n = scores.shape
        best = scores[:, 0] + self.first
        came = np.zeros((t, b, n), np.int8)
        ends = np.zeros((b,), np.int64)
        last = np.where((lengths == 1)[:, None], best, 0)
        for i in range(1, t):
            ways = best[:, :, None] + self.steps
            came[i] = ways.argmax(1)
            best = ways.max(1) + scores[:, i]
            last = np.where((lengths == i + 1)[:, None], best, last)
        ends = last.argmax(1)
        out = np.zeros((b, t), np.int8)
        at = ends.copy()
        rows = np.arange(b)
        for i in range(t - 1, -1, -1):
            started = i < lengths
            at = np.where(i == lengths - 1, ends, at)
            out[:, i] = np.where(started, at, 0)
            at = np.where(started & (i > 0), came[i][rows, at], at)
        return out


def allowed() -> np.ndarray:
    """0, or a large loss where a label can't follow: the inside of a kind needs the same kind before it."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            out[:, j] = [0 if a[2:] == b[2:] and a != "O" else -1e4 for a in LABELS]
    return out


def label_tokens(places: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    out = np.zeros(len(places), np.int64)
    for a, k, b in spans:
        inside = [i for i, (x, y) in enumerate(places) if x >= a and y <= b]
        for i in inside:
            out[i] = 2 + 2 * k
        if inside:
            out[inside[0]] = 1 + 2 * k
    return out


def fit(labelled: DataFrame, most: int = MOST_LABELLED, epochs: int = EPOCHS, seed: int = 11) -> Crf:
    """Trains on labelled(text string, spans array<struct<start, kind, end>>), at most ``most`` rows of it: a small table, learned in one place."""
    rows = sorted((r.text, [(s.start, KINDS.index(s.kind), s.end) for s in r.spans]) for r in labelled.limit(most).collect() if r.text)
    examples = [(f, label_tokens(p, spans)) for (text, spans) in rows for p, f in [features(text)] if p]
    n = len(LABELS)
    fixed = allowed()
    weights, steps, first = np.zeros((FEATURES + 1, n)), np.zeros((n, n)), np.zeros(n)
    squares, step_squares, first_squares = np.full_like(weights, 1e-6), np.full_like(steps, 1e-6), np.full_like(first, 1e-6)
    start = np.array([-1e4 if x[0] == "I" else 0.0 for x in LABELS])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        # Sequences of like length are in one batch, batches in random order.
        order = sorted(range(len(examples)), key=lambda i: (len(examples[i][1]), i))
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            some = [examples[i] for i in batches[k]]
            slots, truth = _padded([x for x, _ in some], FEATURES), _padded([y for _, y in some], 0)
            lengths = np.array([len(y) for _, y in some])
            inside = np.arange(truth.shape[1])[None, :] < lengths[:, None]
            crf = Crf(weights, steps + fixed, first + start)
            single, joint = crf.marginals(crf.emissions(slots), lengths)
            one = np.eye(n)[truth] * inside[..., None]
            gap = (one - single)[inside]
            flat = slots[inside].ravel()
            by_slot = np.argsort(flat, kind="stable")
            begin = np.flatnonzero(np.diff(flat[by_slot], prepend=-1))
            used = flat[by_slot[begin]]
            change = np.add.reduceat(gap[by_slot // N_FEATURES], begin)
            change -= SHRINK * weights[used]
            squares[used] += change**2
            weights[used] += RATE * change / np.sqrt(squares[used])
            weights[FEATURES] = 0
            seen = np.einsum("bti,btj->ij", one[:, :-1], one[:, 1:]) - joint
            step_squares += seen**2
            steps += RATE * seen / np.sqrt(step_squares)
            begun = (one[:, 0] - single[:, 0]).sum(0)
            first_squares += begun**2
            first += RATE * begun / np.sqrt(first_squares)
    return Crf(weights.astype(np.float32), (steps + fixed).astype(np.float32), (first + start).astype(np.float32))


# ------------------------------------------------------------------ detection


def spans_of(labels: np.ndarray, places: list[tuple[int, int]]) -> list[Span]:
    out: list[list[int]] = []
    for (a, b), label in zip(places, labels.tolist(), strict=True):
        if label == 0:
            continue
        kind = (label - 1) // 2
        if label % 2 == 0 and out and out[-1][3]:
            out[-1][2] = b
        else:
            out.append([a, kind, b, 1])
        out[-1][3] = 1
    return [(a, k, b) for a, k, b, _ in out]


def plausible(text: str, span: Span) -> bool:
    """A found span's content can be of its kind at all."""
    a, k, b = span
    digits = len(_DIGIT.findall(text, a, b))
    if k == 0:
        return any(c.isalpha() for c in text[a:b]) and b - a >= 5
    return {1: digits >= 1, 2: 12 <= digits <= 19, 3: 7 <= digits <= 15}[k]


def found_by(crf: Crf, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """The CRF's spans of each text that meet none of its base spans, by start."""
    work: list[tuple[int, list[tuple[int, int]], np.ndarray]] = []
    out: list[list[Span]] = [[] for _ in texts]

    def label() -> None:
        work.sort(key=lambda x: len(x[1]))
        at = 0
        while at < len(work):
            end = at + 1
            while end < len(work) and (end + 1 - at) * len(work[end][1]) <= TOGETHER:
                end += 1
            some = work[at:end]
            scores = _padded([crf.emissions(f) for _, _, f in some], 0)
            best = crf.decode(scores, np.array([len(p) for _, p, _ in some]))
            for (i, places, _), row in zip(some, best, strict=True):
                if row.any():
                    out[i] += spans_of(row[: len(places)], places)
            at = end
        work.clear()

    held = 0
    for i, (text, base) in enumerate(zip(texts, bases, strict=True)):
        for a, b in windows(text, base):
            places, slots = features(text, a, b)
            if places:
                work.append((i, places, slots))
                held += len(places)
            if held > TOGETHER:
                label()
                held = 0
    label()
    for i, found in enumerate(out):
        if found:
            out[i] = _apart(texts[i], sorted(found), bases[i])
    return out


def _apart(text: str, found: list[Span], base: list[Span]) -> list[Span]:
    kept, j, reach = [], 0, 0
    for span in found:
        while j < len(base) and base[j][0] < span[2]:
            reach = max(reach, base[j][2])
            j += 1
        if reach <= span[0] and plausible(text, span):
            kept.append(span)
    return kept


def find_personal(df: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base, spans (``kind:start:end``, comma-joined) of every row of df.

    Places count code points, ends are exclusive. A null text is empty; equal rows give equal rows; an empty table gives none; columns other
    than doc_id and text are ignored. Texts of any length are read whole.
    """
    shared = df.sparkSession.sparkContext.broadcast(crf)  # FEATURES * labels numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, raw in chunks(batches):
            texts = [x.decode(errors="replace") for x in raw]
            bases = [base_spans(x) for x in texts]
            more = found_by(shared.value, texts, bases)
            counts = [[sum(k == kind for _, k, _ in spans) for spans in bases] for kind in range(len(KINDS))]
            columns = [pa.array(c, pa.int64()) for c in counts]
            strings = [pa.array(x, pa.string()) for x in ([joined(s) for s in bases], [joined(sorted(a + b)) for a, b in zip(bases, more, strict=True)])]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns, *strings], [x.split()[0] for x in FOUND.split(", ")])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


# --------------------------------------------------------------- labelled lines

# Words that introduce personal data, everyday words, and endings of addresses.
_CUES = {"email": ["email", "e-mail", "mail", "contact", "write to", "reach me at", "correo", "courriel"], "ip": ["ip", "address", "host", "server", "from", "client"], "card": ["card", "visa", "mastercard", "card number", "credit card", "tarjeta", "carte", "karte"], "phone": ["phone", "tel", "tel.", "call", "mobile", "fax", "telefon", "telefono", "whatsapp", "cell"]}
_WORDS = "the of and to in is for on with at by from this that it as are was be or an we you they have not can will der die das und ist ein mit von les des est une pour dans que los las del por con una para see next page version section order item total about after year price time chapter line model room step".split()
_ENDINGS = ["com", "org", "net", "de", "fr", "es", "io", "edu"]


def _word(rng: random.Random) -> str:
    if rng.random() < 0.4:
        return rng.choice(_WORDS)
    w = "".join(rng.choice("bcdfghlmnprstvw") + rng.choice("aeiou") + rng.choice(["", "", "n", "r", "s", "th"]) for _ in range(rng.randint(1, 4)))
    return w.capitalize() if rng.random() < 0.15 else w


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _positive(rng: random.Random) -> tuple[str, str, bool]:
    """(kind, text, whether it needs a cue before it)."""
    d = functools.partial(_digits, rng)
    kind = rng.choice(KINDS)
    if kind == "email":
        name = rng.choice([_word(rng), f"{_word(rng)}.{_word(rng)}", f"{_word(rng)}{d(2)}", f"{_word(rng)}_{_word(rng)}"]).lower()
        host, end = _word(rng).lower() + rng.choice(["", d(1)]), rng.choice(_ENDINGS)
        a, b = rng.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}"), ("(at)", "."), ("[at]", "."), ("(AT)", "(DOT)"), ("@", "(dot)"), ("@", "[dot]")])
        s = rng.choice(["", " "])
        if rng.random() < 0.25:
            return kind, f"{name} at {host} dot {end}", False
        return kind, f"{name}{s}{a}{s}{host}{s}{b}{s}{end}" if b != "." else f"{name}{s}{a}{s}{host}.{end}", False
    if kind == "ip":
        if rng.random() < 0.6:
            groups = ["%x" % rng.randrange(1, 65536) for _ in range(8)]
            return kind, rng.choice([":".join(groups), f"{groups[0]}:{groups[1]}::{groups[2]}", f"fe80::{groups[1]}:{groups[2]}:{groups[3]}:{groups[4]}"]), True
        parts = [str(rng.randrange(256)) for _ in range(4)]
        return kind, rng.choice(["[.]".join(parts), "(.)".join(parts), " . ".join(parts)]), False
    if kind == "card":
        groups = [d(4) for _ in range(4)]
        return kind, rng.choice([".", "/", "_", "  ", " - "]).join(groups), rng.random() < 0.5
    a, b, c = d(3), d(3), d(4)
    strong = [f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"{a}.{b}.{c}"]
    weak = [f"{a} {b} {c}", f"0{d(3)} {d(7)}", f"0{d(3)}/{d(6)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"{b}-{c}", f"00{d(2)} {d(3)} {d(6)}", f"{a}{b}{c}", f"{d(3)} {d(2)} {d(2)} {d(2)}"]
    return (kind, rng.choice(strong), False) if rng.random() < 0.5 else (kind, rng.choice(weak), True)


def _negative(rng: random.Random) -> str:
    d = functools.partial(_digits, rng)
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    made = [
        lambda: f"{rng.randint(1, 12)}.{rng.randint(0, 9)}",
        lambda: f"{rng.choice(['version', 'v', 'section'])} {d(1)}.{d(1)}.{d(2)}",
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(1, 12)}/{rng.randint(1, 28)}/{rng.randint(1990, 2030)}",
        lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}",
        lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
        lambda: f"${d(1)},{d(3)}.{d(2)}",
        lambda: f"{d(2)} {d(3)} {d(3)}",
        lambda: f"{rng.randint(1900, 1999)}-{rng.randint(2000, 2030)}",
        lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}",
        lambda: f"order {d(rng.randint(6, 12))}",
        lambda: f"AKIA{''.join(rng.choice('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') for _ in range(16))}",
        lambda: f"password={h(18)}",
        lambda: f'token = "{h(40)}"',
        lambda: f"sha256:{h(64)}",
        lambda: f"{h(8)}-{h(4)}-{h(4)}-{h(4)}-{h(12)}",
        lambda: f"@{_word(rng).lower()}{rng.choice(['', d(2)])}",
        lambda: f"{_word(rng)} @ {d(2)} {_word(rng)}",
        lambda: d(rng.randint(1, 20)),
        lambda: f"{d(2)}.{d(4)}, {d(1)}.{d(4)}",
        lambda: f"pages {d(3)}-{d(3)}",
        lambda: f"{d(1)} + {d(1)} = {d(2)}",
        lambda: f"{_word(rng)} dot {_word(rng)}",
        lambda: f"look at {_word(rng)} dot {_word(rng)} at",
        lambda: f"x{d(3)}y{d(2)}",
        lambda: f"{d(3)}-{d(2)}",
        lambda: f"{d(4)} {d(4)}",
        lambda: f"{d(1)}.{d(3)}.{d(3)},{d(2)}",
    ]
    return rng.choice(made)()


def invented(n: int, seed: int) -> list[tuple[str, list[tuple[int, str, int]]]]:
    """(text, spans) of labelled lines: personal data in forms that the base patterns miss, and what only looks like it."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(_word(rng) for _ in range(rng.randint(1, 8))) + rng.choice([" ", " ", ", ", ". ", ": ", "\n"])
            if rng.random() < 0.5:
                kind, what, needs = _positive(rng)
                if needs or rng.random() < 0.5:
                    text += rng.choice(_CUES[kind]).lower() + rng.choice([": ", " ", " is ", " = "]) if rng.random() < 0.7 else rng.choice(_CUES[kind]).capitalize() + ": "
                spans.append((len(text), kind, len(text) + len(what)))
                text += what
            else:
                text += _negative(rng)
            text += rng.choice([" ", " ", ". ", ", ", "\n"])
        text += " ".join(_word(rng) for _ in range(rng.randint(0, 6)))
        out.append((text, spans))
    return out


def labelled(spark: SparkSession, n: int = 2_000, seed: int = 11) -> DataFrame:
    """A small labelled table: text, spans."""
    rows = [(t, [{"start": a, "kind": k, "end": b} for a, k, b in s]) for t, s in invented(n, seed)]
    return spark.createDataFrame(rows, "text string, spans array<struct<start: int, kind: string, end: int>>")


_MODEL: dict[int, Crf] = {}


def default_crf(spark: SparkSession) -> Crf:
    """The CRF of the invented labels, trained once in a driver's life."""
    if not _MODEL:
        _MODEL[0] = fit(labelled(spark))
    return _MODEL[0]


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    found = find_personal(table(spark, sf_dir, "documents"), default_crf(spark))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def brute_force(text: str | None) -> tuple[list[int], str]:
    """(counts, digest) of the base spans by the patterns as they are written; for tests."""
    text = text or ""
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    good = (lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")), is_card, is_phone)
    spans = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, text) if good[k](m[0]))
    return [sum(x == k for _, x, _ in spans) for k in range(4)], hashlib.sha256(joined(spans).encode()).hexdigest()
