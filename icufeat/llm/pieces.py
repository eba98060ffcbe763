"""Encoding and decoding with a merge-type SentencePiece vocabulary.

Encoding does not replay the merges over a text. The pieces that merging can
produce are matched by an Aho-Corasick automaton, which gives the longest piece
at each place. A text is then walked from left to right: a piece may follow the
one before if merging the two together again gives just these two; otherwise the
next shorter piece is tried, and where none fits, the walk steps back and the place
is marked in a bit field as failed. As the merge encoding of a prefix is unique, a
failed place needs no second visit, so the walk is linear in the text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icufeat.llm.common import and_then, in_slices

SPACE = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Segments (a word with the spaces before it) whose ids a task remembers, pairs of pieces likewise, and the longest remembered.
REMEMBERED, REMEMBERED_CHARS = 200_000, 40


class PieceCodec:
    """Encoder and decoder of one model file (merge type, byte fallback, identity normalisation)."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if (
            train.model_type != 2
            or not train.byte_fallback
            or train.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or USER in kinds
            or UNUSED in kinds
        ):
            raise ValueError("needs a merge-type model with byte fallback, a dummy prefix and no normalisation")
        self.rank = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.opening = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.high = {i for b, i in self.bytes.items() if b >= 0x80}
        self.numbers = [str(i) for i in range(len(model.pieces))]
        self.surface = [
            "" if p.type == CONTROL
            else train.unk_surface if p.type == UNKNOWN
            else chr(self.byte_of[i]) if p.type == BYTE
            else p.piece.replace(SPACE, " ")
            for i, p in enumerate(model.pieces)
        ]
        # No piece goes on past the start of a run of spaces, so no merge does either. Where none goes on past
        # the end of a word of letters, texts are cut there too, and fewer different segments come.
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank):
            raise ValueError("pieces that span words are not supported")
        ends = not any(re.search(rf"[{LETTERS}][^\w{SPACE}]", p) for p in self.rank)
        word = rf"{SPACE}*[{LETTERS}]+(?!\w)|" if ends else ""
        self.segments = re.compile(f"{word}{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.fits: dict[tuple[str, str], bool] = {}
        self.seen: dict[str, bytes] = {}
        self.joins: dict[str, list[tuple[float, str, str]]] = {}
        for p in self.rank:
            parts, joins = self.merge(p)
            if len(parts) == 1:
                self.joins[p] = joins
        # Where several pieces have one score, the place decides and a pair alone cannot tell: such runs are re-merged whole.
        scores: dict[float, int] = {}
        for s in self.rank.values():
            scores[s] = scores.get(s, 0) + 1
        self.tied = {p for p, s in self.rank.items() if scores[s] > 1 and len(p) > 1}
        if any(set(p) != {SPACE} for p in self.tied):
            raise ValueError("only runs of spaces may share a score")
        self.widest = max(map(len, self.joins), default=1)
        self.shorter: dict[str, str] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.joins:
            self.automaton.add_word(p, p)
            cut = next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in self.joins), p[0])
            if len(p) > 1:
                self.shorter[p] = cut
        self.automaton.make_automaton()

    def merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The pieces of a short text, by joining the best pair (leftmost of equals) until none is left.

        With them comes a list of the joins: score, first piece and last piece after it.
        """
        parts, joins, rank = list(text), [], self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            joins.append((best, parts[0], parts[-1]))
        return parts, joins

    def may_follow(self, left: str, right: str) -> bool:
        """Whether merging the two together gives the two again.

        Each half repeats its own joins in its own order, the better score first,
        until the pieces at the border would rather join each other.
        """
        mine, other, rank = self.joins.get(left, ()), self.joins.get(right, ()), self.rank
        a, b, i, j = left[-1], right[0], 0, 0
        across = rank.get(a + b)
        while True:
            s = mine[i][0] if i < len(mine) else None
            t = other[j][0] if j < len(other) else None
            if across is not None and (s is None or across > s) and (t is None or across >= t):
                return False
            if s is not None and (t is None or s >= t):
                if mine[i][2] is not a:
                    a = mine[i][2]
                    across = rank.get(a + b)
                i += 1
            elif t is not None:
                if other[j][1] is not b:
                    b = other[j][1]
                    across = rank.get(a + b)
                j += 1
            else:
                return True

    def walk(self, text: str) -> list[str]:
        """The pieces of one segment by backtracking."""
        n, at, out, last = len(text), 0, [], None
        fits, shorter, matches = self.fits, self.shorter, self.automaton.iter_long
        # As long as each longest match may follow the one before, one pass of the automaton does.
        for end, piece in matches(text):
            if end - len(piece) + 1 != at:
                break
            if last is not None:
                fit = fits.get((last, piece))
                if not (self.fit(last, piece) if fit is None else fit):
                    break
            out.append(piece)
            at, last = end + 1, piece
        if at == n:
            return out
        failed = bytearray((n >> 3) + 1)
        piece = self.longest(text, at)
        while True:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    fit = fits.get((last, piece))
                    if self.fit(last, piece) if fit is None else fit:
                        break
                piece = shorter.get(piece)
            if piece is not None:
                out.append(piece)
                at, last = end, piece
                if at == n:
                    return out
                piece = self.longest(text, at)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None

    def longest(self, text: str, at: int) -> str:
        """The longest piece at this place; a character that the vocabulary lacks stands for itself."""
        for end, piece in self.automaton.iter_long(text[at : at + self.widest]):
            return piece if end - len(piece) == -1 else text[at]
        return text[at]

    def fit(self, left: str, right: str) -> bool:
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        known = self.fits[left, right] = self.may_follow(left, right)
        return known

    def segment_ids(self, segment: str) -> list[int]:
        pieces = self.runs(segment) if segment.startswith(SPACE * 2) and self.tied else self.walk(segment)
        out: list[int] = []
        for p in pieces:
            known = self.ids.get(p)
            if known is None:
                out.extend(self.bytes[b] for b in p.encode())
            else:
                out.append(known)
        return out

    def runs(self, segment: str) -> list[str]:
        """A segment that holds pieces of equal score: merged whole, by a heap, in the order the scores and places give."""
        parts: list[str | None] = list(segment)
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n:
                joined = parts[i] + parts[j]
                score = self.rank.get(joined)
                if score is not None:
                    heapq.heappush(heap, (-score, i, j, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != joined or right[i] != j:
                continue
            parts[i], parts[j] = joined, None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin or end ids."""
        if not text:
            return []
        seen = self.seen
        segments = self.segments((SPACE + text).replace(" ", SPACE))
        try:  # most texts hold remembered segments only
            return array("i", b"".join(map(seen.__getitem__, segments))).tolist()
        except KeyError:
            pass
        parts: list[bytes] = []
        for s in segments:
            raw = seen.get(s)
            if raw is None:
                raw = array("i", self.segment_ids(s)).tobytes()
                if len(s) <= REMEMBERED_CHARS:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[s] = raw
            parts.append(raw)
        return array("i", b"".join(parts)).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids: spaces back, runs of byte ids read as UTF-8 (a wrong byte becomes U+FFFD)."""
        if not ids:
            return ""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.surface.__getitem__, ids))
        else:
            parts: list[str] = []
            run = bytearray()
            for i in ids:
                b = self.byte_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    parts.append(_utf8(bytes(run)))
                    run.clear()
                parts.append(self.surface[i])
            parts.append(_utf8(bytes(run)))
            text = "".join(parts)
        # The space that encoding puts in front goes, if a piece of the vocabulary brings it.
        first = next((i for i in ids if self.surface[i]), None)
        return text[1:] if first in self.opening else text


    def forget(self) -> None:
        """Gives back what a task has remembered; Python workers outlive their tasks."""
        self.seen.clear()
        self.fits.clear()


def _utf8(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + k].decode())
            except UnicodeDecodeError:
                continue
            at += k
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One codec per model file and Python worker."""
    return PieceCodec(model_file)


def encode_texts(docs: DataFrame, model_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token_ids, decoded) of every row; texts whole, a null text as the empty one.

    An empty table gives no rows; repeated rows are encoded each; other columns are
    not read. The model file has to lie at `model_file` on every machine.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for part in in_slices(batches):
            ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
            texts = pa.array([own.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), texts], [key, "token_ids", "decoded"])

    return docs.select(key, text).mapInArrow(lambda batches: and_then(run(batches), codec(model_file).forget), schema)


def token_digests(docs: DataFrame, model_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): `encode_texts` with its results digested in the same task."""
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        sha = hashlib.sha256
        for part in in_slices(batches):
            counts, digests, decoded = [], [], []
            for t in part.column(1).to_pylist():
                ids = own.encode(t or "")
                counts.append(len(ids))
                digests.append(sha(",".join(map(own.numbers.__getitem__, ids)).encode()).hexdigest())
                decoded.append(sha(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                schema.names,
            )

    return docs.select(F.col(key), F.col(text)).mapInArrow(lambda batches: and_then(run(batches), codec(model_file).forget), schema)

