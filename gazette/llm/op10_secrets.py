"""Secret scans: pattern candidates, and a random forest that removes false positives.

1. Candidates are what may be a secret: long runs of key characters with a digit, values assigned to a
   name, quoted values, what follows a word like 'password', passwords in URLs, and private key blocks.
2. Each gets features: length, character classes, transitions between characters (mean log probability
   under a bigram model of dictionary words, and changes of class), the share that dictionary words cover, words
   before and after it, the name it is assigned to, and its path.
3. A random forest (pyspark.ml) learns from labelled findings which candidates are secrets. The
   fitted forest is a small table of nodes that is broadcast to the tasks that scan.

The findings that the query learns from are made by ``labelled_findings``: TRAIN_FINDINGS rows
of known formats, placeholders, checksums, ids and so on, since the tables hold no labelled ones.
``train`` takes any table of labelled findings, of which at most TRAIN_FINDINGS are used.
"""

from __future__ import annotations

import functools
import json
import math
import random
import re
import string
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.shared import chunks, fresh, scratch_path, table

#: Labelled findings that a forest is fitted on at most.
TRAIN_FINDINGS = 6_000
TREES, DEPTH, SEED = 30, 9, 10
#: Share of the trees from which a candidate is a secret.
THRESHOLD = 0.5
#: Characters before and after a candidate in which neighbouring words are looked for.
CONTEXT = 48
REDACTED = "[SECRET]"

_RUN = rb"[A-Za-z0-9+/=_\-.~]"
#: A private key up to its END line; one that is cut off, up to a dash.
_BLOCK = re.compile(
    rb"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:(?!-----BEGIN ).)*?-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----|[^-]*)", re.S
)
_RUNS = re.compile(rb"(?<![A-Za-z0-9+/=_\-.~])" + _RUN + rb"{16,}")
#: A password between a user and a host in a URL.
_LOGIN = re.compile(rb"://[^\s:/@\"'`]*:([^\s/\"'`]+)@")
_SIGN = re.compile(rb"[=:](?<![=!<>:][=:])[=>]?(?<!==)(?!=)")
#: What is assigned: up to its quote, else to white space, a quote, or the next assignment after a separator.
_VALUE = re.compile(
    rb"\s*(?:bearer\s+|basic\s+)?"
    rb"(?:\"([^\"\n]+)\"|'([^'\n]+)'|`([^`\n]+)`|[\"'`]?((?:(?![?&;,][A-Za-z_][A-Za-z0-9_.\-]*[=:])[^\s\"'`])+))",
    re.I,
)
_NAME = re.compile(rb"([A-Za-z_][A-Za-z0-9_.\-]*)[\"']?\s*$")
#: An assignment that begins a value.
_INNER = re.compile(rb"\s*[A-Za-z_][A-Za-z0-9_.\-]*=[^\s=]")
#: A quoted value without white space that nothing is assigned to.
_QUOTED = re.compile(rb"[\"'`](?<![A-Za-z0-9].)([^\s\"'`]{8,})[\"'`]")
_HOST = re.compile(rb"[A-Za-z0-9][A-Za-z0-9.\-]*(?:[:/].*)?")
#: A name and an assignment sign right before a candidate.
_ASSIGNED = re.compile(rb"([A-Za-z_][A-Za-z0-9_.\-]*)[\"']?\s*(?::=|=>|=|:)\s*(?:bearer\s+|basic\s+)?[\"'`]?$", re.I)
_WORDS = re.compile(rb"[A-Za-z]+")

# Words and formats that speak for or against a secret.
SECRET_WORDS = set("access api apikey auth authorization bearer client credential credentials key login pass passphrase passwd password private pwd pw secret signing token webhook".split())
BENIGN_WORDS = set("author build checksum class color commit digest example file hash href icon id image img integrity isbn md5 order phone placeholder revision sample sha sha1 sha256 sha512 src style test tracking url uuid version".split())
#: A value that a secret's word speaks of without an assignment; looked for in lower case.
_TOLD = re.compile(rb"(?:" + "|".join(sorted(SECRET_WORDS, key=lambda w: (-len(w), w))).encode() + rb")\s+(?:is\s+|was\s+)?(?=([^\s\"'`=:][^\s\"'`]*[^\s\"'`.,;:)~\-]))")
PLACEHOLDER_WORDS = set("changeme dummy example fake insert placeholder redacted replace sample some test todo xxx xxxx your".split())
TEST_PATHS = set("demo doc docs example examples fixture fixtures mock mocks sample samples spec test tests vendor".split())
CONFIG_PATHS = set("conf config credentials deploy env ini pem properties secrets settings terraform toml yaml yml".split())
KNOWN_PREFIXES = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "xoxa-", "sk_live_", "rk_live_", "pk_live_", "sk-", "SG.", "eyJ", "npm_", "pypi-", "dop_v1_", "hf_", "shpat_", "ya29.")
_PREFIXES = tuple(x.encode() for x in KNOWN_PREFIXES)

FEATURES = (
    "length", "digit_share", "upper_share", "lower_share", "symbol_share", "hex_only", "distinct_share", "entropy", "class_changes", "transition", "dictionary",
    "known_prefix", "private_key", "assigned", "quoted", "secret_name", "benign_name", "secret_before", "benign_before", "secret_after", "benign_after", "placeholder", "uuid", "digits_only", "longest_repeat", "dots", "slashes", "test_path", "config_path",
)


@dataclass(frozen=True)
class Dictionary:
    """Words of four letters or more, and the log probabilities of letter pairs in them."""

    words: frozenset[str]
    pairs: np.ndarray
    longest: int

    @classmethod
    def from_vocabulary(cls, path: str) -> Dictionary:
        """The whole words of a word-level BPE vocabulary file; its size bounds the dictionary's."""
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        words = {w.removesuffix("</w>") for w in vocabulary if w.endswith("</w>")}
        words = {w for w in words if 4 <= len(w) <= 20 and w.isascii() and w.isalpha()}
        counts = np.ones((27, 27))
        for w in words:
            at = [26, *[ord(c) - 97 for c in w.lower()], 26]
            for a, b in zip(at[:-1], at[1:], strict=True):
                counts[a, b] += 1
        return cls(frozenset(words), np.log(counts / counts.sum(axis=1, keepdims=True)), max(map(len, words)))

    def coverage(self, text: str) -> float:
        """The share of a text's characters that dictionary words cover, longest first from the left."""
        low, covered = text.lower(), 0
        for part in re.findall("[a-z]{4,}", low):
            i = 0
            while i < len(part) - 3:
                for n in range(min(self.longest, len(part) - i), 3, -1):
                    if part[i : i + n] in self.words:
                        covered += n
                        i += n
                        break
                else:
                    i += 1
        return covered / max(1, len(text))

    def transition(self, text: str) -> float:
        """The mean log probability of a text's character pairs; what is no letter counts as one symbol."""
        at = [ord(c) - 97 if "a" <= c <= "z" else 26 for c in text.lower()]
        return float(self.pairs[at[:-1], at[1:]].mean()) if len(at) > 1 else 0.0


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def describe(value: str, before: bytes, after: bytes, path: str, dictionary: Dictionary) -> list[float]:
    """The FEATURES of one candidate."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    counts = [value.count(c) for c in set(value)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    assigned = _ASSIGNED.search(before)
    name = {x.decode().lower() for x in re.findall(rb"[A-Z]?[a-z0-9]+|[A-Z0-9]+", assigned[1])} if assigned else set()
    near_before = {x.decode().lower() for x in _WORDS.findall(before)}
    near_after = {x.decode().lower() for x in _WORDS.findall(after)}
    low = value.lower()
    parts = {x for x in re.split(r"[^a-z0-9]+", path.lower()) if x}
    longest = max(len(m[0]) for m in re.finditer(r"(.)\1*", value, re.S))
    return [
        min(n, 200), share[0], share[1], share[2], share[3],
        float(bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", value))), len(counts) / n, entropy,
        sum(a != b for a, b in zip(kinds[:-1], kinds[1:], strict=True)) / n, dictionary.transition(value), dictionary.coverage(value),
        float(value.startswith(KNOWN_PREFIXES)), float("PRIVATE KEY-----" in value), float(bool(assigned)), float(before[-1:] in (b'"', b"'", b"`")),
        float(bool(name & SECRET_WORDS)), float(bool(name & BENIGN_WORDS)),
        float(bool(near_before & SECRET_WORDS)), float(bool(near_before & BENIGN_WORDS)), float(bool(near_after & SECRET_WORDS)), float(bool(near_after & BENIGN_WORDS)),
        float(any(w in low for w in PLACEHOLDER_WORDS)), float(bool(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", low))), float(share[0] == 1), longest / n,
        value.count(".") / n, value.count("/") / n, float(bool(parts & TEST_PATHS)), float(bool(parts & CONFIG_PATHS)),
    ]


def _runs(text: bytes) -> Iterator[tuple[int, int]]:
    """(begin, end) of the runs of 16 key characters or more, digits and others or with a known prefix."""
    for m in _RUNS.finditer(text):
        begin, end = m.span()
        # Punctuation at the ends belongs to the sentence.
        while end > begin and text[end - 1 : end] in (b".", b"-", b"~"):
            end -= 1
        digits = sum(48 <= b <= 57 for b in text[begin:end])
        if end - begin >= 16 and (0 < digits < end - begin or text.startswith(_PREFIXES, begin)):
            yield begin, end


def _assigned_values(text: bytes) -> Iterator[tuple[int, int, bool]]:
    """(begin, end, whether the name speaks of a secret) of the values assigned to a name."""
    at = 0
    while sign := _SIGN.search(text, at):
        at = sign.end()
        # The name first: only then is a value read, and each once.
        name = _NAME.search(text[max(0, sign.start() - CONTEXT) : sign.start()])
        if name is None:
            continue
        secret = bool({x.decode().lower() for x in re.findall(rb"[A-Z]?[a-z0-9]+|[A-Z0-9]+", name[1])} & SECRET_WORDS)
        if not secret and _INNER.match(text, at):
            continue
        m = _VALUE.match(text, at)
        if m is None:
            continue
        begin, end = m.span(m.lastindex)
        at = end
        if m.lastindex == 4:
            while end > begin and text[end - 1 : end] in (b".", b"-", b"~", b",", b";", b":", b")"):
                end -= 1
            host = text.rfind(b"@", begin, end)
            if not secret and host > begin and _HOST.fullmatch(text, host + 1, end):
                end = host
        if end > begin:
            yield begin, end, secret


def candidates(text: bytes) -> list[tuple[int, int]]:
    """(begin, end) of the candidates in a text, in order and apart: private keys, passwords in URLs, assigned values
    of any characters and length, quoted ones without white space, what follows a secret's word, and long runs with a digit.

    What several kinds hold is taken by the first. A value gives way to the long runs in it if its name doesn't
    speak of a secret or it holds white space.
    """
    found = [m.span() for m in _BLOCK.finditer(text)] if b"PRIVATE KEY" in text else []
    if b"://" in text:
        found += [m.span(1) for m in _LOGIN.finditer(text)]
    runs = list(_runs(text))
    for a, b, secret in _assigned_values(text):
        inner = runs[bisect_left(runs, (a,)) : bisect_left(runs, (b,))]
        if not inner or (secret and len(text[a:b].split()) == 1):
            found.append((a, b))
    found += [m.span(1) for m in _QUOTED.finditer(text)]
    found += [m.span(1) for m in _TOLD.finditer(text.lower())]
    found += runs
    out: list[tuple[int, int]] = []
    for a, b in found:
        i = bisect_left(out, (a, b))
        if (i == 0 or out[i - 1][1] <= a) and (i == len(out) or out[i][0] >= b):
            out.insert(i, (a, b))
    return out


def context(text: bytes, begin: int, end: int) -> tuple[bytes, bytes]:
    return text[max(0, begin - CONTEXT) : begin], text[end : end + CONTEXT]


def seen(before: bytes, value: bytes, after: bytes) -> tuple[int, int] | None:
    """The candidate of a text that holds most of a value in it; None: a scan sees none there."""
    begin, end = len(before), len(before) + len(value)
    held = [(min(b, end) - max(a, begin), a, b) for a, b in candidates(before + value + after)]
    most = max(held, default=(0, 0, 0))
    return most[1:] if most[0] > 0 else None


def describe_in(text: bytes, span: tuple[int, int], path: str, dictionary: Dictionary) -> list[float]:
    return describe(text[slice(*span)].decode(errors="replace"), *context(text, *span), path, dictionary)


# ---------------------------------------------------------- labelled findings


def labelled_findings(n: int = TRAIN_FINDINGS, seed: int = SEED) -> list[tuple[str, str, str, str, int]]:
    """(path, before, value, after, is_secret) of n invented findings, half of them secrets."""
    rng = random.Random(seed)
    hexa, alnum, b64 = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    pick = lambda letters, k: "".join(rng.choices(letters, k=k))
    prose = "the of and to in is that for with was are this from have not which their more into these".split()
    filler = lambda: " ".join(rng.choices(prose, k=rng.randrange(0, 6)))
    plain_path = lambda: rng.choice(["src", "app", "lib", "server", "web", "data"]) + "/" + rng.choice(["main", "index", "util", "page"]) + rng.choice([".py", ".js", ".txt", ".md", ""])
    config_path = lambda: rng.choice(["config", "deploy", "conf"]) + "/" + rng.choice(["settings.yml", ".env", "app.ini", "prod.properties"])
    test_path = lambda: rng.choice(["tests", "examples", "docs", "fixtures"]) + "/" + rng.choice(["readme.md", "sample.json", "test_login.py"])
    names = ["token", "api_key", "apiKey", "secret", "SECRET_KEY", "access_token", "auth_token", "client_secret", "password", "db_password", "private_key", "AWS_SECRET_ACCESS_KEY"]
    assign = lambda names: rng.choice(names) + rng.choice([" = ", "=", ": ", '": ']) + rng.choice(['"', "'", ""])
    secret_values = [
        lambda: pick(hexa, rng.choice([32, 40, 48, 64])),
        lambda: pick(alnum, rng.randrange(20, 48)),
        lambda: pick(b64, rng.choice([40, 43, 44, 64])),
        lambda: rng.choice(["ghp_", "gho_", "npm_"]) + pick(alnum, 36),
        lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16),
        lambda: "AIza" + pick(alnum + "_-", 35),
        lambda: "sk_live_" + pick(alnum, 24),
        lambda: f"xoxb-{pick(string.digits, 12)}-{pick(alnum, 24)}",
        lambda: f"eyJ{pick(alnum, 30)}.eyJ{pick(alnum, 60)}.{pick(alnum + '_-', 43)}",
    ]
    passwords = [lambda: pick(alnum + "_-", rng.randrange(10, 18)), lambda: rng.choice(prose).title() + pick(string.digits, 4) + pick(alnum, 6)]
    passwords += [lambda: pick(alnum + "@$!%&*#^?", rng.randrange(6, 18)), lambda: rng.choice(prose).title() + rng.choice("@$!#") + pick(alnum, rng.randrange(4, 8)) + pick(string.digits, 2), lambda: pick(string.ascii_lowercase, 3) + pick(string.digits, rng.randrange(3, 6))]
    words = "customer invoice delivery station mountain summer window market garden picture history science teacher program service".split()
    benign = [
        lambda: (rng.choice(["sha256", "checksum", "md5", "integrity", "digest"]) + rng.choice([": ", "=", " "]), pick(hexa, rng.choice([32, 40, 64]))),
        lambda: (rng.choice(["commit ", "revision ", "build ", "commit: "]), pick(hexa, rng.choice([16, 40]))),
        lambda: (assign(names), rng.choice(["your_api_key_here", "YOUR-TOKEN-HERE", "changeme123", "example-secret-value", "xxxxxxxxxxxxxxxx", "<redacted>", "REPLACE_ME_NOW1", "test_token_123", "dummy-password-1", "placeholder_key"])),
        lambda: (assign(["id", "uuid", "order", "request_id", "trace"]), str(uuid.UUID(int=rng.getrandbits(128)))),
        lambda: (rng.choice(["", filler() + " "]), str(uuid.UUID(int=rng.getrandbits(128)))),
        lambda: (rng.choice(["phone ", "card ", "order ", "isbn ", filler() + " "]), pick(string.digits, rng.choice([10, 13, 16]))),
        lambda: (assign(["version", "build", "file", "url", "src", "class", "name", "title", "path", "value", "count"]), rng.choice(["-", "_", "/", "."]).join(rng.choices(words, k=rng.randrange(2, 4))) + pick(string.digits, rng.randrange(0, 3))),
        lambda: (filler() + " ", "".join(rng.choices(words, k=rng.randrange(2, 4))) + pick(string.digits, rng.randrange(1, 5))),
        lambda: (assign(names), "os.environ.get" if rng.random() < 0.3 else rng.choice(["config.", "settings.", "self.", "request.headers."]) + rng.choice(names)),
        lambda: (filler() + " ", rng.choice(["www.", "", "mail."]) + ".".join(rng.choices(words, k=2)) + rng.choice([".example.com/", ".org/page/"]) + pick(string.digits, rng.randrange(1, 6))),
        lambda: (filler() + " ", f"20{pick('012', 1)}{pick(string.digits, 1)}-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}T{rng.randrange(10, 24)}.{rng.randrange(10, 60)}"),
        lambda: (rng.choice(["note: ", "time: ", "see: ", "price: "]), rng.choice(words) + rng.choice(["", "-", "."]) + rng.choice(words)),
        lambda: (assign(["password", "token", "secret", "key"]), rng.choice(["required", "undefined", "optional", "disabled", "expired", "authentication", "management"])),
        lambda: (rng.choice(["note: ", "time: ", "page: ", "count = ", "color=", "see: ", "at ", "x = ", "mailto:"]), rng.choice([pick(string.digits, rng.randrange(1, 5)), rng.choice(prose), rng.choice(words), f"{rng.randrange(24)}:{pick(string.digits, 2)}", f"({rng.choice(words)})"])),
        lambda: (filler() + rng.choice([" ", ' "', " ("]), rng.choice(words) + rng.choice(["", ".", "_"]) + rng.choice(words + [""]) + pick(string.digits, rng.randrange(0, 4)) + f"@{rng.choice(words)}{pick(string.digits, 1)}.example.com"),
        lambda: (filler() + rng.choice([" password ", " the token is ", " key ", " client ", " private ", " secret "]), rng.choice(prose + words) + rng.choice(["", "s", ",", "."])),
        lambda: (rng.choice(['said: "', 'title = "', 'note: "']), " ".join(rng.choices(prose + words, k=rng.randrange(2, 12))) + '"'),
    ]
    out = []
    for i in range(n):
        if i % 2:
            value = rng.choice(secret_values)() if rng.random() < 0.85 else None
            known = value is not None and value.startswith(KNOWN_PREFIXES)
            if rng.random() < 0.03:
                out.append((plain_path(), filler() + "\n", f"-----BEGIN {rng.choice(['', 'RSA ', 'EC '])}PRIVATE KEY-----\n{pick(b64, 64)}\n{pick(b64, 64)}\n", "\n" + filler(), 1))
                continue
            before = filler() + " " if known and rng.random() < 0.4 else filler() + " " + (assign(names) if rng.random() < 0.9 else rng.choice(["Authorization: Bearer ", "the token is ", "password ", "api key "]))
            out.append((rng.choice([plain_path, config_path])(), before, value or rng.choice(passwords)(), rng.choice(['"', "'", "", "\n", " "]) + filler(), 1))
        else:
            before, value = rng.choice(benign)()
            path = rng.choice([plain_path, plain_path, config_path, test_path])()
            out.append((path, filler() + " " + before, value, rng.choice(['"', "", "\n", " ", ","]) + filler(), 0))
    return out


# -------------------------------------------------------------------- forest


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees: feature (-1: a leaf), threshold, children and share of secrets."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots.tolist():
            at = np.full(len(x), root)
            while (live := self.feature[at] >= 0).any():
                f = np.where(live, self.feature[at], 0)
                down = np.where(x[rows, f] <= self.threshold[at], self.left[at], self.right[at])
                at = np.where(live, down, at)
            total += self.share[at]
        return total / max(1, len(self.roots))


def train(findings: DataFrame, dictionary: Dictionary, limit: int = TRAIN_FINDINGS) -> Forest:
    """A forest from findings(path, before, value, after, is_secret), at most ``limit`` of them by a hash of the row.

    A finding is described as a scan would see it: by its candidate in the text. One without a candidate teaches nothing.

    The fitted model's node table has at most TREES * 2 ** (DEPTH + 1) rows.
    """
    spark = findings.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["value"] or "", (r["before"] or "").encode(), (r["after"] or "").encode(), r["path"] or "") for r in batch.to_pylist()]
            spans = [seen(b, v.encode(), a) for v, b, a, _ in rows]
            made = [describe_in(b + v.encode() + a, s, p, shared.value) for (v, b, a, p), s in zip(rows, spans, strict=True) if s]
            labels = [float(y) for y, s in zip(batch.column("is_secret").to_pylist(), spans, strict=True) if s]
            yield pa.RecordBatch.from_pydict({"label": pa.array(labels, pa.float64()), "x": pa.array(made, pa.list_(pa.float64()))})

    known = findings.where("value is not null and is_secret is not null").select("path", "before", "value", "after", "is_secret")
    chosen = known.orderBy(F.xxhash64("path", "before", "value", "after")).limit(limit)
    rows = chosen.mapInArrow(run, "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)
    path = scratch_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select("treeID", *[node[c].alias(c) for c in ("id", "leftChild", "rightChild", "impurityStats")], node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"))
    found = nodes.orderBy("treeID", "id").collect()
    size: dict[int, int] = {}
    for r in found:
        size[r.treeID] = size.get(r.treeID, 0) + 1
    begin, at = {}, 0
    for t in sorted(size):
        begin[t], at = at, at + size[t]
    return Forest(
        np.array([begin[t] for t in sorted(size)]),
        np.array([r.feature if r.leftChild >= 0 else -1 for r in found]),
        np.array([r.threshold if r.leftChild >= 0 else 0.0 for r in found]),
        np.array([begin[r.treeID] + max(0, r.leftChild) for r in found]),
        np.array([begin[r.treeID] + max(0, r.rightChild) for r in found]),
        np.array([r.impurityStats[1] / max(1e-9, sum(r.impurityStats)) for r in found]),
    )


# ---------------------------------------------------------------------- scan

SPAN = T.StructType().add("begin", "long").add("end", "long").add("score", "double")
SCAN = T.StructType().add("n_candidates", "long").add("secrets", T.ArrayType(SPAN)).add("redacted", "string")
_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scan(df: DataFrame, forest: Forest, dictionary: Dictionary, path: str | None = None, at: str = "_secrets") -> DataFrame:
    """df's rows with a struct column ``at``: n_candidates, secrets (byte spans of the UTF-8 text, with their score) and redacted.

    ``redacted`` is the text with REDACTED for each secret, null where there is none. ``path``: a column that
    holds the file's path. Null and empty texts have no candidates; whole texts of any length; equal
    rows get equal findings; an empty table gives none. ``at`` must not be a column of df; all other columns stay as they are.
    """
    if at.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"{at} is a column already")
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((forest, dictionary))
    names = df.columns
    where = names.index(path) if path else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, dictionary = shared.value
        kept = functools.lru_cache(20_000)(lambda v, b, a, p: describe(v, b, a, p, dictionary))
        describe_one = lambda v, b, a, p: kept(v, b, a, p) if len(v) <= 256 else describe(v, b, a, p, dictionary)
        for piece, texts in chunks(batches):
            paths = [x or "" for x in piece.column(where).cast(pa.string()).to_pylist()] if where is not None else [""] * len(texts)
            spans = [candidates(t) for t in texts]
            rows = [describe_one(t[a:b].decode(errors="replace"), *context(t, a, b), p) for t, s, p in zip(texts, spans, paths, strict=True) for a, b in s]
            scores = forest.score(np.array(rows)) if rows else np.zeros(0)
            n, found, redacted = 0, [], []
            for text, own in zip(texts, spans, strict=True):
                hits = [(a, b, float(s)) for (a, b), s in zip(own, scores[n : n + len(own)], strict=True) if s >= THRESHOLD]
                n += len(own)
                found.append([{"begin": a, "end": b, "score": s} for a, b, s in hits])
                if not hits:
                    redacted.append(None)
                    continue
                out, last = [], 0
                for a, b, _ in hits:
                    out += [text[last:a], REDACTED.encode()]
                    last = b
                redacted.append(b"".join([*out, text[last:]]).decode(errors="replace"))
            made = pa.StructArray.from_arrays([pa.array([len(s) for s in spans], pa.int64()), pa.array(found, _SPAN), pa.array(redacted, pa.string())], ["n_candidates", "secrets", "redacted"])
            yield pa.RecordBatch.from_arrays([*piece.columns, made], [*names, at])

    plain = df.select(*[F.col(f"`{c}`") for c in names])
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(at, SCAN)]))


@functools.cache
def default_dictionary() -> Dictionary:
    import public_tokenizers

    return Dictionary.from_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def default_forest(spark: SparkSession) -> Forest:
    findings = spark.createDataFrame(labelled_findings(), "path string, before string, value string, after string, is_secret int")
    return train(findings, default_dictionary())


def redact(df: DataFrame, forest: Forest, dictionary: Dictionary) -> DataFrame:
    """df with secrets replaced in ``text`` (and ``n_chars`` made to fit); rows without secrets are unchanged."""
    at = fresh(df, "_secrets")
    found = scan(df, forest, dictionary, "source" if "source" in df.columns else None, at)
    new = F.col(f"{at}.redacted")
    out = found.withColumn("text", F.coalesce(new, F.col("text")))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(new.isNotNull(), F.length(new).cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: candidates, secrets, and the checksum of the redacted text (null: nothing to redact)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = scan(docs, default_forest(spark), default_dictionary(), "source").select("doc_id", "_secrets.*")
    places = F.array_join(F.transform("secrets", lambda x: F.concat_ws("-", x["begin"].cast("string"), x["end"].cast("string"))), ",")
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), places.alias("places"), F.crc32(F.col("redacted").cast("binary")).alias("redacted_crc32"))


def checksum(text: str) -> int:
    """What redacted_crc32 holds for a redacted text."""
    return zlib.crc32(text.encode())
