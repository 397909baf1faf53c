"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder is an agenda: every adjacent pair of symbols whose union is in the
vocabulary waits, ordered by the union's score, then from the left; the
best pair is merged and its new neighbours join the agenda. Symbols outside the vocabulary
become byte pieces. The agendas of many short strings go on together in numpy, each as a row of ranks; a long
string has a heap, whose stale entries are skipped.

A merge can never span two neighbouring characters that are adjacent in no
piece of the vocabulary, so a text is cut there (at word starts, line ends,
most punctuation) without changing its ids, and each different part is encoded
once in a task. In every Arrow batch the new parts are also encoded with the
sentencepiece library, and any difference stops the job.
"""

from __future__ import annotations

import contextlib
import gc
import heapq
import itertools
import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import AgingCache, Lent, chunks, table, trim

SPACE = "▁"
#: Atoms whose agendas go on together, and their greatest length.
TOGETHER, SHORT = 16_384, 48
#: Parts whose ids a codec keeps; of atoms a third as many. What is dropped is just made again.
KEPT_PARTS = 600_000
#: Bytes of text that are cut into parts at a time, and new parts that are encoded at a time.
AT_ONCE, NEW_AT_ONCE = 1_000_000, 8_192
NO_RANK = np.iinfo(np.int32).max
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class MergeVocabulary:
    """Pieces, scores and byte pieces of a model; raises ValueError for kinds it can't reproduce."""

    def __init__(self, model_path: str, kept_atoms: int = KEPT_PARTS // 3):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        rules = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only merge-type models with an identity normalizer and a dummy prefix are supported")
        if not proto.trainer_spec.byte_fallback or any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError("only models with byte pieces and no user-defined or unused pieces are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.cost = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.end_id = self.pieces.index("</s>")
        self.pairs = {x + y for p in self.id for x, y in itertools.pairwise(p)}
        self.atoms: dict[str, list[int]] = {}
        self.kept_atoms = kept_atoms
        self._merges()
        self.surfaces = [self._surface_of(i) for i in range(len(self.pieces))]
        self.decimals = [str(i).encode() for i in range(len(self.pieces))]

    def merge(self, text: str) -> list[str]:
        """The agenda over one part."""
        symbols, cost = list(text), self.cost
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []
        for i in range(n - 1):
            union = symbols[i] + symbols[i + 1]
            if union in cost:
                agenda.append((cost[union], i, i + 1, union))
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, left, right, union = pop(agenda)
            # A merged symbol is longer or empty, so a stale pair's union is no longer that of its symbols.
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != union:
                continue
            symbols[left], symbols[right] = union, ""
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                wider = union + symbols[follow]
                if wider in cost:
                    push(agenda, (cost[wider], left, follow, wider))
            lead = before[left]
            if lead >= 0:
                wider = symbols[lead] + union
                if wider in cost:
                    push(agenda, (cost[wider], lead, left, wider))
        return [x for x in symbols if x]

    def _merges(self) -> None:
        """Symbols by number, and the table of the pairs whose union is in the vocabulary: keys, unions, and ranks by score."""
        chars = sorted({c for p in self.id for c in p})
        self.symbols = [*chars, *[p for p in self.id if len(p) > 1]]
        number = {x: i for i, x in enumerate(self.symbols)}
        self.of_char = np.full(0x110000, -1, np.int32)
        self.of_char[[ord(c) for c in chars]] = np.arange(len(chars))
        rank = {c: i for i, c in enumerate(sorted(set(self.cost.values())))}  # equal scores are one rank
        found = [(number[p[:i]] * len(number) + number[p[i:]], number[p], rank[self.cost[p]]) for p in self.id for i in range(1, len(p)) if p[:i] in number and p[i:] in number]
        found.sort()
        self.pair_keys, self.unions, self.ranks = (np.array(x, t) for x, t in zip(zip(*found, strict=True), (np.int64, np.int32, np.int32), strict=True))
        self.symbol_ids = [self._ids_of(x) for x in self.symbols]

    def _ids_of(self, symbol: str) -> list[int]:
        i = self.id.get(symbol)
        return [i] if i is not None else [self.byte_id[b] for b in symbol.encode()]

    def _pairs_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, union) of pairs of symbols; NO_RANK where there is none."""
        key = left.astype(np.int64) * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NO_RANK), self.unions[at]

    def merge_all(self, atoms: list[str]) -> list[list[int]]:
        """The symbols of atoms of two characters or more: their agendas go on together, a merge of each atom at a time.

        An atom's agenda is the row of its adjacent pairs' ranks. The least rank, and of equal ones the leftmost, is merged; the pairs
        around it are ranked anew.
        """
        out: list[list[int]] = [[]] * len(atoms)
        order = sorted(range(len(atoms)), key=lambda i: len(atoms[i]))
        for begin in range(0, len(order), TOGETHER):
            which = np.array(order[begin : begin + TOGETHER])
            some = [atoms[i] for i in which.tolist()]
            lengths = np.array([len(x) for x in some])
            width = int(lengths.max())
            symbols = np.full((len(some), width), -1, np.int32)
            symbols[np.arange(width)[None, :] < lengths[:, None]] = self.of_char[np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)]
            ranks, unions = self._pairs_of(symbols[:, :-1], symbols[:, 1:])
            while len(which):
                at = ranks.argmin(1)
                row = np.arange(len(which))
                going = ranks[row, at] != NO_RANK
                if not going.all():
                    done = ~going
                    for i, x in zip(which[done].tolist(), symbols[done].tolist(), strict=True):
                        out[i] = x[: x.index(-1)] if x[-1] == -1 else x
                    which, symbols, ranks, unions, at = (x[going] for x in (which, symbols, ranks, unions, at))
                    row = np.arange(len(which))
                    if not len(which):
                        break
                symbols[row, at] = unions[row, at]
                # The right one of the pair goes, and what follows moves up.
                after = np.arange(symbols.shape[1] - 1)[None, :] > at[:, None]
                symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
                symbols[:, -1] = -1
                ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
                unions[:, :-1] = np.where(after[:, :-1], unions[:, 1:], unions[:, :-1])
                ranks[:, -1] = NO_RANK
                for first in (at, at - 1):
                    ok = (first >= 0) & (first < symbols.shape[1] - 1)
                    r, f = row[ok], first[ok]
                    ranks[r, f], unions[r, f] = self._pairs_of(symbols[r, f], symbols[r, f + 1])
        return out

    def atoms_of(self, part: str) -> list[str]:
        """A part, whose spaces are SPACE already, cut where no piece can reach across."""
        pairs = self.pairs
        cuts = [i for i, pair in enumerate(map(operator.add, part, part[1:]), 1) if pair not in pairs]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)] if cuts else [part]

    def ids_of_all(self, parts: list[str]) -> list[list[int]]:
        """Ids of each part. Atoms are kept; long ones have an agenda of their own."""
        cut = [self.atoms_of(x) for x in parts]
        if len(self.atoms) > self.kept_atoms:
            self.atoms.clear()
        atoms = self.atoms
        new = [x for x in dict.fromkeys(itertools.chain.from_iterable(cut)) if x not in atoms]
        ids = self.symbol_ids
        for x in new:
            if not 2 <= len(x) <= SHORT:
                atoms[x] = [i for symbol in self.merge(x) for i in self._ids_of(symbol)]
        short = [x for x in new if 2 <= len(x) <= SHORT]
        for x, symbols in zip(short, self.merge_all(short), strict=True):
            atoms[x] = ids[symbols[0]] if len(symbols) == 1 else [i for y in symbols for i in ids[y]]
        out = [atoms[x[0]] if len(x) == 1 else [i for atom in x for i in atoms[atom]] for x in cut]
        for x in new:
            if len(x) > SHORT:
                del atoms[x]
        return out

    def ids(self, part: str) -> list[int]:
        return self.ids_of_all([part])[0]

    def _surface_of(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if self.kinds[i] == CONTROL else self.pieces[i].replace(SPACE, " ").encode()

    def surface(self, ids: list[int]) -> bytes:
        """The text of ids, with a space for each SPACE; control pieces have none."""
        return b"".join(map(self.surfaces.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of a whole document's ids: the dummy prefix's space goes."""
        return self.surface(ids).removeprefix(b" ").decode(errors="replace")


_PARTS = re.compile(rb"\n| *[^ \n]+| +")


def parts_of(text: bytes) -> list[bytes]:
    """Cuts a text, dummy prefix included, before the space runs and at line ends.

    A part is written as its text after one space (a word after a single space, the usual
    case), or begins with a line end, or, where spaces are doubled, is marked with a NUL and holds its own.
    """
    if not text:
        return []
    marked = text.replace(b"\n", b" \n")
    if b"  " in marked or marked[:1] == b" " or marked[-1:] == b" " or b"\0" in marked:
        return [b"\0" + x for x in _PARTS.findall(b" " + text)]
    return marked.split(b" ")


def part_text(part: bytes) -> str:
    """The characters that a part stands for."""
    if part[:1] == b"\0":
        return part[1:].decode().replace(" ", SPACE)
    return part.decode() if part[:1] == b"\n" else SPACE + part.decode()


def surface_of(part: bytes) -> bytes:
    """The text that a part stands for."""
    return part[1:] if part[:1] == b"\0" else part if part[:1] == b"\n" else b" " + part


class PieceCodec:
    """Encodes and decodes whole texts; the values of parts are kept."""

    def __init__(self, model_path: str, check: bool = True, kept: int = KEPT_PARTS):
        self.vocabulary = MergeVocabulary(model_path, kept // 3)
        self.library = None
        if check:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        # Stands before a part in a check: it is in no pair of characters that a piece holds, so nothing merges across it.
        joined = {c for pair in self.vocabulary.pairs for c in pair}
        self.anchor = next(c for c in map(chr, range(10, 0x110000)) if c not in joined and c != "\r")
        self.anchor_ids = self.vocabulary.ids(SPACE + self.anchor)
        self.cache = AgingCache(self._make, kept, size=lambda part, made: len(part) + len(made))
        #: Parts whose ids don't decode to the part itself.
        self.odd: dict[bytes, bytes] = {}

        if self.library is not None:
            self.check_surfaces()

    def _make(self, parts: list[bytes]) -> list[bytes]:
        """Decimal ids of parts. Their decoded text is held against the parts, so that it need not be kept for most."""
        collecting = gc.isenabled()
        gc.disable()  # many small lists and no cycles
        try:
            return [x for i in range(0, len(parts), NEW_AT_ONCE) for x in self._make_some(parts[i : i + NEW_AT_ONCE])]
        finally:
            if collecting:
                gc.enable()
            trim()  # else the C library keeps what the encoding took for a moment

    def _make_some(self, parts: list[bytes]) -> list[bytes]:
        texts = [part_text(x) for x in parts]
        found = self.vocabulary.ids_of_all(texts)
        if self.library is not None:
            self.check(texts, found)
        for part, ids in zip(parts, found, strict=True):
            if (made := self.vocabulary.surface(ids)) != surface_of(part):
                self.odd[part] = made
        decimals = self.vocabulary.decimals.__getitem__
        return [b" ".join(map(decimals, x)) for x in found]

    def check(self, texts: list[str], found: list[list[int]]) -> None:
        """Holds ids of parts against the library.

        It puts a space before what it encodes. So a part that begins with a space is given without it, and any other
        behind the anchor.
        """
        spaced = [x[0] == SPACE for x in texts]
        plain = [x[1:].replace(SPACE, " ") if s else self.anchor + x.replace(SPACE, " ") for s, x in zip(spaced, texts, strict=True)]
        prefix, lead = [self.vocabulary.id[SPACE]], self.anchor_ids
        for text, own, other, s in zip(texts, found, self.library.encode(plain, num_threads=1), spaced, strict=True):
            if other != (own if s else lead + own) and (other or not s or own != prefix):
                raise ValueError(f"the agenda and the library differ on {text!r}")

    def check_surfaces(self) -> None:
        """Holds the decoded text of every piece, behind the anchor, against the library; a text's is theirs one after the other."""
        ids = [i for i, kind in enumerate(self.vocabulary.kinds) if kind != BYTE]
        lead = self.vocabulary.surface(self.anchor_ids).removeprefix(b" ")
        for i, other in zip(ids, self.library.decode([[*self.anchor_ids, i] for i in ids], num_threads=1), strict=True):
            if other.encode() != lead + self.vocabulary.surfaces[i]:
                raise ValueError(f"the decoded text and the library's differ on piece {i}")

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(decimal ids with the end id, decoded text) of each text."""
        plain = [x.replace(SPACE.encode(), b" ") for x in texts]
        parts = [parts_of(x) for x in plain]
        self.cache.fill(set(itertools.chain.from_iterable(parts)))
        end, ids_of = str(self.vocabulary.end_id).encode(), self.cache.__getitem__
        out = []
        for text, x in zip(plain, parts, strict=True):
            # A text whose parts all decode to themselves decodes to itself, less the dummy prefix's space.
            if self.odd and not self.odd.keys().isdisjoint(x):
                text = b"".join([self.odd.get(part, surface_of(part)) for part in x]).removeprefix(b" ")
            out.append((b" ".join([*map(ids_of, x), end]), text))
        return out


_CODEC = Lent(PieceCodec)


def codec_of_worker(model_path: str, check: bool, kept: int = KEPT_PARTS) -> contextlib.AbstractContextManager[PieceCodec]:
    """One codec for all tasks of a Python worker, so that its parts are made once; PieceCodec bounds them. It goes when no task uses it."""
    return _CODEC.lend(model_path, check, kept)


def encode_decode(df: DataFrame, model_path: str, check: bool = True, kept: int = KEPT_PARTS) -> DataFrame:
    """Adds n_tokens long, ids string (decimal, one space between, end id last) and decoded string.

    Works on the column ``text`` (null: empty; only the end id) and keeps doc_id. Whole texts of
    any length; equal rows get equal results; an empty table gives none. Other columns are dropped.
    ``F.split("ids", " ").cast("array<int>")`` gives the ids as an array. ``kept``: parts whose ids a worker keeps; fewer take less memory and more time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec_of_worker(model_path, check, kept) as codec:
            for piece, texts in chunks(batches, limit=AT_ONCE):
                made = codec.encode(texts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": piece.column("doc_id"),
                        "n_tokens": pa.array([x.count(b" ") + 1 for x, _ in made], pa.int64()),
                        "ids": pa.array([x for x, _ in made], pa.binary()).cast(pa.string()),
                        "decoded": pa.array([x for _, x in made], pa.binary()).cast(pa.string()),
                    }
                )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: encode, decode, and the digests of both."""
    import public_tokenizers

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))
