"""Ids of a word-level byte-pair tokenizer (lower case, white space dropped), as the tokenizers library gives them.

Words are found here and merged by tiktoken, in time that grows with the text also inside very long words. In the
vocabulary the last byte of a word is a symbol of its own; tiktoken knows bytes only, so a mark is put behind every
word, which its first merge ties to the last byte. Chunks between spaces with characters whose normalisation depends
on Unicode tables go to the tokenizers library. Nothing is remembered from text to text.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import groupby

import numpy as np
import regex

# Characters below this one are the same after NFC, and Python and the library lower them alike.
SIMPLE = "ƀ"
# Behind every word; chunks that hold it go to the library.
MARK = "\0"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def _is_simple(text: str) -> bool:
    if MARK in text:
        return False
    try:
        text.encode("latin-1")  # much faster than a look at every character
        return True
    except UnicodeEncodeError:
        return max(text) < SIMPLE


def _for_simple(pattern: str) -> re.Pattern:
    """The pattern for simple characters only, with its classes spelt out, which the faster `re` can read."""
    characters = list(map(chr, range(ord(SIMPLE))))
    spelt = lambda cls: "".join(re.escape(c) for c in characters if regex.match(cls, c))
    for cls in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(cls, spelt(cls))
    return re.compile(pattern)


class WordTokenizer:
    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        parsed = json.loads(spec)
        model, special = parsed["model"], {t["id"] for t in parsed["added_tokens"]}
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        if max(vocabulary.values()) >= 2**16:
            raise ValueError("ids are kept in 16 bits")
        merged = [vocabulary[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        if merged != sorted(merged) or len(merged) + 512 != len(set(vocabulary.values()) - special):
            raise ValueError("only vocabularies whose ids are in the order of their merges are supported")
        self.pattern = _for_simple(parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        byte_of, mark = {c: b for b, c in enumerate(byte_symbols())}, MARK.encode()
        pieces = {}
        for piece, i in vocabulary.items():
            if i not in special:
                inner = piece.removesuffix(suffix)
                pieces[bytes([byte_of[c] for c in inner]) + mark * (piece != inner)] = i
        if len(pieces) != len(merged) + 512:
            raise ValueError("a piece holds the mark")
        self.coder = tiktoken.Encoding("words", pat_str="[^\\x00]*\\x00", mergeable_ranks=pieces, special_tokens={})

    def _simple(self, text: str) -> np.ndarray:
        words = self.pattern.findall(text.lower())
        if not words:
            return np.zeros(0, np.uint32)
        return self.coder.encode_to_numpy(MARK.join(words) + MARK, disallowed_special=())

    def _ids(self, text: str) -> np.ndarray:
        if _is_simple(text):
            return self._simple(text)
        chunks = groupby(text.replace("\n", " ").split(" "), lambda c: not _is_simple(c))
        found = [
            np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, np.uint32) if other else self._simple(" ".join(some))
            for other, some in chunks
        ]
        return np.concatenate(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 16-bit numbers."""
        return [self._ids(t).astype("<u2").tobytes() for t in texts]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_of(spec: str) -> WordTokenizer:
    """The tokenizer, built once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _tokenizers:
        _tokenizers[key] = WordTokenizer(spec)
    return _tokenizers[key]
