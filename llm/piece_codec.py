"""Exact encoding and decoding with a merge-type SentencePiece model, by backtracking instead of merging.

A sequence of pieces is the encoding of a text if every two neighbours are what merging their joined characters gives.
So the encoder goes from left to right: the longest piece at a position first (from one Aho-Corasick pass), shorter ones
if the piece isn't compatible with the one before, one step back if none is. A bitfield keeps the positions from which
nothing led on; none is tried twice. Compatibility of two pieces is found by merging them again, once per pair.

No piece holds a space mark behind another character, so texts fall into words that are encoded by themselves; within a
word, two neighbouring characters that are neighbours in no piece are a boundary too. Characters outside the model become
byte pieces.

Defined results: null is the empty text; begin and end ids frame every text; the space mark itself reads as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words, and pairs of pieces, whose result a worker keeps at most.
KEPT = 250_000
_NORMAL, _CONTROL, _BYTE = 1, 3, 6
_WORD = re.compile(f"{MARK}+[^{MARK}]*")


class PieceCodec:
    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as spm

        model = spm.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("a merge-type model with a dummy prefix and without normalisation is needed")
        self.begin, self.end = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.packed_byte = {int(p.piece[3:5], 16): i.to_bytes(4, "little") for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.bytes_of = [
            b"" if p.type == _CONTROL else bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(MARK, " ").encode()
            for p in model.pieces
        ]
        unknown = model.trainer_spec.unk_id
        self.bytes_of[unknown] = model.trainer_spec.unk_surface.encode()
        self.marked = {i for p, i in self.ids.items() if p.startswith(MARK)}
        self.neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) == 1 or self.merged(piece) == [piece]:  # others never come out of merging
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """What merging the best-scored neighbours, the leftmost of equal ones, makes of a few characters."""
        symbols = list(text)
        while len(symbols) > 1:
            best, where = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if best is None:
                break
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            found = self.merged(left + right) == [left, right]
            if len(self.pairs) < KEPT:
                self.pairs[left, right] = found
        return found

    def backtracked(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all pieces."""
        matches: list[list[int]] = [[] for _ in text]  # lengths of the pieces at each position, rising
        for last, length in self.automaton.iter(text):
            matches[last - length + 1].append(length)
        failed = 0  # bit p: nothing leads on from position p
        pieces: list[str] = []
        tried: list[int] = []  # choices left at the position of each piece
        at, n = 0, len(text)
        choices = len(matches[0])
        while at < n:
            chosen = 0
            while choices:
                choices -= 1
                length = matches[at][choices]
                if not failed >> (at + length) & 1 and (not pieces or self.compatible(pieces[-1], text[at : at + length])):
                    chosen = length
                    break
            if chosen:
                pieces.append(text[at : at + chosen])
                tried.append(choices)
                at += chosen
                choices = len(matches[at]) if at < n else 0
            else:
                failed |= 1 << at
                if not pieces:
                    raise ValueError("no encoding")
                at -= len(pieces.pop())
                choices = tried.pop()
        return pieces

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if part in self.ids or len(part) > 1:
                found = b"".join([self.packed[p] for p in self.backtracked(part)])
            else:
                found = b"".join([self.packed_byte[b] for b in part.encode()])
            if len(self.parts) < KEPT:
                self.parts[part] = found
        return found

    def _word(self, rest: str) -> bytes:
        """A word, given without its first mark."""
        word = MARK + rest
        cuts = [0]
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.neighbours:
                cuts.append(i)
        cuts.append(len(word))
        found = b"".join([self._part(word[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
        if len(self.words) < KEPT:
            self.words[rest] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids, begin and end included, as little-endian unsigned 32-bit integers."""
        ids: list[bytes] = []
        if text:
            words = text.replace(MARK, " ").split(" ")
            if "" in words:
                words = [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]
            ids = list(map(self.words.get, words))
            if None in ids:
                ids = [self._word(w) if found is None else found for w, found in zip(words, ids, strict=True)]
        return b"".join([self.begin.to_bytes(4, "little"), *ids, self.end.to_bytes(4, "little")])

    def decode(self, ids: bytes) -> str:
        """The text: pieces joined, without the space in front; each byte that is no UTF-8 is a replacement character."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        joined = b"".join(map(self.bytes_of.__getitem__, numbers))
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = _patched(joined)
        first = next((i for i in numbers if self.bytes_of[i]), None)
        return text[1:] if first in self.marked else text


def _patched(data: bytes) -> str:
    out, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


_codecs: dict[str, PieceCodec] = {}


def codec(model_path: str) -> PieceCodec:
    """One for each worker process and model."""
    if model_path not in _codecs:
        _codecs[model_path] = PieceCodec(model_path)
    return _codecs[model_path]


def encode_texts(documents: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of each document: ids as little-endian unsigned 32-bit integers, decoded from them again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            held, texts, size, start = [], [], 0, 0
            for i, text in enumerate(batch.column(1)):
                ids = own.encode(text.as_py() or "")
                held.append(ids)
                texts.append(own.decode(ids))
                size += len(ids)
                if size > 1 << 23 or i + 1 == len(batch):
                    yield pa.record_batch(
                        [batch.column(0).slice(start, len(held)), pa.array(held, pa.binary()), pa.array(texts, pa.string())],
                        names=[id_col, "ids", "decoded"],
                    )
                    held, texts, size, start = [], [], 0, i + 1

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded string")

