"""SentencePiece encoding that keeps offsets, and decoding.

The text is normalised by longest prefixes through the model's compiled character map, recording from which bytes
each piece of normalised text comes. Merging (byte-pair encoding) then runs on the normalised text, and every
piece is projected back to its bytes in the original. No piece of a model with split words holds a space mark
after another character, so text between such marks is encoded once and remembered, with the places of its pieces
from the start of that text on. The digests are made from the same ids, begins and ends, once these are checked.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
from pyspark.sql import DataFrame

from tradelake.llm.common import add_columns
from tradelake.llm.merging import Merger, some

MARK = "▁"
# Chunks of text a Python worker remembers.
CACHE = 600_000
# Symbols from here on are characters that are no piece.
OTHER = 2**24


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 prefixes, and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes | None]:
        """Length of the longest prefix of raw[at:] in the trie, and its replacement."""
        units, node, best, value = self.units, 0, 0, -1
        if units:
            unit = units[0]
            node = (unit >> 10) << ((unit & 512) >> 6)
            for i in range(at, len(raw)):
                node ^= raw[i]
                unit = units[node]
                if unit & 0x800000FF != raw[i]:
                    break
                node ^= (unit >> 10) << ((unit & 512) >> 6)
                if unit >> 8 & 1:
                    best, value = i - at + 1, units[node] & 0x7FFFFFFF
        if value < 0:
            return 0, None
        return best, self.texts[value : self.texts.index(b"\0", value)]


class Model:
    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        spec = proto.normalizer_spec
        self.charmap = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.names = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == 1}
        byte = [i for i, p in enumerate(proto.pieces) if p.type == 6]
        self.first_byte = byte[0] if byte else None
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.unknown_surface = proto.trainer_spec.unk_surface
        if proto.trainer_spec.model_type != 2 or any(p.type in (4, 5) for p in proto.pieces):
            raise ValueError("only models of merges without user-defined or unused pieces are supported")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with a space mark inside are not supported")
        # Characters that no merged piece holds: text can be cut around them.
        self.line_is_apart = not any("\n" in p for p in self.ids if len(p) > 1)
        self.identity = not self.charmap.units and not self.trim
        self.plain = self.identity and self.prefix and self.line_is_apart
        self.merger = self._pairs()
        self.decimal = list(map(str, range(len(self.names))))
        self.surface = [name.replace(MARK, " ").encode() for name in self.names]
        self.surface[self.unknown] = self.unknown_surface.encode()
        for i in byte:
            self.surface[i] = bytes([i - self.first_byte])
        self.of_point = np.arange(0x110000, dtype=np.int32) + OTHER
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_point[ord(piece)] = i
        self.forget()

    def forget(self) -> None:
        # Number of each chunk; of each number where its ids lie, how many they are, and how many characters it has.
        self.known: dict[str, int] = {"": 0}
        self.at, self.count, self.chars = (np.zeros(1024, np.int64) for _ in range(3))
        # Of each id: its first and last character, counted from the start of the chunk.
        self.flat, self.first, self.last = (np.zeros(8192, np.int32) for _ in range(3))
        self.used = 0

    # Normalising

    def normalise(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """Normalised text, and for each of its characters the original bytes it comes from: begin, end."""
        if self.identity:
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            lead = int(self.prefix and bool(text))
            end = np.zeros(len(points) + lead, np.int64)
            np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=end[lead:])
            begin = np.zeros_like(end)
            begin[1:] = end[:-1]
            return MARK * lead + text.replace(" ", MARK), begin, end
        raw, out, begin, end, at = text.encode(), [], [], [], 0

        def put(chars: str, a: int, b: int) -> None:
            for c in chars:
                c = MARK if c == " " else c
                if self.trim and c == MARK and (not out or out[-1] == MARK):
                    continue
                out.append(c)
                begin.append(a)
                end.append(b)

        while at < len(raw):
            size, new = self.charmap.longest(raw, at) if self.charmap.units else (0, None)
            if new is None:
                size = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                new = raw[at : at + size]
            put(new.decode(), at, at + size)
            at += size
        if self.trim and out and out[-1] == MARK:
            out.pop(), begin.pop(), end.pop()
        if self.prefix and out:
            out.insert(0, MARK), begin.insert(0, 0), end.insert(0, 0)
        return "".join(out), np.array(begin, np.int64), np.array(end, np.int64)

    # Merging

    def _pairs(self) -> Merger:
        """Every way to put a piece together from two symbols; pieces of one score share a rank."""
        ranks = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        symbol = lambda part: self.ids[part] if part in self.ids else OTHER + ord(part)
        found = [
            (symbol(p[:i]), symbol(p[i:]), ranks[self.scores[p]], self.ids[p])
            for p in self.ids
            for i in range(1, len(p))
            if (i == 1 or p[:i] in self.ids) and (i == len(p) - 1 or p[i:] in self.ids)
        ]
        return Merger(*map(list, zip(*found, strict=True)))

    def merge(self, chunks: list[str]) -> list[list[int]]:
        """Symbols of each chunk, ids of pieces or OTHER plus a code point: the best-scored pair first, the leftmost among equals."""
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")
        merged, counts = self.merger.merge(self.of_point[points], np.array([len(c) for c in chunks], np.int64))
        flat, ends = merged.tolist(), np.cumsum(counts).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def symbol_ids(self, symbol: int) -> list[int]:
        """One id for a piece; a character that is no piece is spelt in bytes, or unknown."""
        if symbol < OTHER:
            return [symbol]
        if self.first_byte is None:
            return [self.unknown]
        return [self.first_byte + b for b in chr(symbol - OTHER).encode()]

    def chunks(self, normal: str) -> list[str]:
        cut = re.findall(f"{MARK}+[^{MARK}]*|^[^{MARK}]+", normal)
        return [x for c in cut for x in re.split("(\n)", c) if x] if self.line_is_apart else cut

    def encode(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, and for each the original bytes it stands for: begin, end. The parts of a character spelt in bytes share its bytes."""
        return tuple(x.tolist() for x in next(self.spans([text])))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined and read as UTF-8, space marks as spaces, without the space put before the text."""
        out, pending = [], bytearray()
        for i in ids:
            if self.first_byte is not None and self.first_byte <= i < self.first_byte + 256:
                pending.append(i - self.first_byte)
                continue
            out.append(pending.decode(errors="replace"))
            pending.clear()
            out.append(self.unknown_surface if i == self.unknown else self.names[i].replace(MARK, " "))
        out.append(pending.decode(errors="replace"))
        joined = "".join(out)
        return joined[1:] if self.prefix and ids and self.names[ids[0]].startswith(MARK) else joined

    # Whole texts, with memory

    def _learn(self, chunks: list[str]) -> None:
        ids, first, last, counts = [], [], [], []
        for symbols in self.merge(chunks):
            at, before = 0, len(ids)
            for symbol in symbols:
                size = len(self.names[symbol]) if symbol < OTHER else 1
                for i in self.symbol_ids(symbol):
                    ids.append(i)
                    first.append(at)
                    last.append(at + size - 1)
                at += size
            counts.append(len(ids) - before)
        n, m = len(self.known), self.used
        while n + len(chunks) > len(self.at):
            self.at, self.count, self.chars = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.count, self.chars))
        while m + len(ids) > len(self.flat):
            self.flat, self.first, self.last = (np.concatenate([x, np.zeros_like(x)]) for x in (self.flat, self.first, self.last))
        self.known.update(zip(chunks, range(n, n + len(chunks)), strict=True))
        ends = np.cumsum(counts)
        self.count[n : n + len(chunks)], self.at[n : n + len(chunks)] = counts, m + ends - counts
        self.chars[n : n + len(chunks)] = [len(c) for c in chunks]
        self.flat[m : m + len(ids)], self.first[m : m + len(ids)], self.last[m : m + len(ids)] = ids, first, last
        self.used = m + len(ids)

    def _parts(self, text: str, normal: str) -> list[str]:
        if self.plain and text and "  " not in text and text[0] != " " and MARK not in text:
            return f"{MARK}{text.replace(' ', f' {MARK}')}".replace("\n", " \n ").split(" ")
        return self.chunks(normal)

    def spans(self, texts: list[str]):
        """Arrays ids, begins, ends of each text, one after the other."""
        for run in some(texts):
            if len(self.known) > CACHE:
                self.forget()
            known, aligned = self.known, [self.normalise(t) for t in run]
            parts = [self._parts(t, normal) for t, (normal, _, _) in zip(run, aligned, strict=True)]
            if new := {c for p in parts for c in p if c not in known}:
                self._learn(list(new))
            for p, (normal, begin, end) in zip(parts, aligned, strict=True):
                which = np.array([known[c] for c in p], np.int64)
                counts, chars = self.count[which], self.chars[which]
                if chars.sum() != len(normal):
                    raise ValueError("the parts are not the whole text")
                upto = np.cumsum(counts)
                place = np.repeat(self.at[which] - upto + counts, counts) + np.arange(counts.sum())
                start = np.repeat(np.cumsum(chars) - chars, counts)
                yield self.flat[place], begin[start + self.first[place]], end[start + self.last[place]]

    def check_spans(self, text: str, begins: np.ndarray, ends: np.ndarray) -> None:
        """Spans lie in the text and run forwards; where nothing is replaced or trimmed, they leave out and repeat nothing."""
        size = len(text.encode())
        if not len(begins):
            right = not size or not self.identity
        else:
            right = begins[0] >= 0 and ends[-1] <= size and (begins <= ends).all() and (np.diff(begins) >= 0).all() and (np.diff(ends) >= 0).all()
            if self.identity:
                same = (begins[1:] == begins[:-1]) & (ends[1:] == ends[:-1])  # one character spelt in bytes
                right = right and begins[0] == 0 and ends[-1] == size and (same | (begins[1:] == ends[:-1])).all()
        if not right:
            raise ValueError("pieces do not cover the text they stand for")

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: number of ids, SHA-256 of the ids as decimals, SHA-256 of the decoded text. The spans are checked."""
        out, word, surface = [], self.decimal.__getitem__, self.surface.__getitem__
        for text, (ids, begins, ends) in zip(texts, self.spans(texts), strict=True):
            self.check_spans(text, begins, ends)
            flat = ids.tolist()
            decoded = b"".join(map(surface, flat))  # characters spelt in bytes are whole
            if self.prefix and decoded[:1] == b" " and self.names[flat[0]].startswith(MARK):
                decoded = decoded[1:]
            out.append((len(flat), hashlib.sha256(",".join(map(word, flat)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return out

    def encode_all(self, texts: list[str]) -> list[tuple]:
        return [tuple(x.tolist() for x in found) for found in self.spans(texts)]


_models: dict[bytes, Model] = {}


def model_of(blob: bytes) -> Model:
    """The model, read once per Python worker, which keeps what it has learned from task to task."""
    key = hashlib.sha256(blob).digest()
    if key not in _models:
        _models[key] = Model(blob)
    return _models[key]


def _with_model(blob: bytes, each):
    def compute(batch: list[str | None]) -> list:
        return list(zip(*each(model_of(blob), [t or "" for t in batch]), strict=True))

    return compute


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes) -> tuple[DataFrame, str]:
    """All rows with one more struct column (ids, begins, ends), and its name; offsets are bytes of the original text.

    A null text is an empty one and has no ids. `model` is the content of a model file; executors need no such file.
    """
    return add_columns(docs, _with_model(model, Model.encode_all), "ids array<int>, begins array<int>, ends array<int>")


def digests(docs: DataFrame, model: bytes) -> tuple[DataFrame, str]:
    """All rows with one more struct column of digests of the ids and of the text decoded from them, and its name."""
    return add_columns(docs, _with_model(model, Model.digests), "n_tokens long, ids_sha256 string, decoded_sha256 string")
