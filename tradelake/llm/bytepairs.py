"""Ids of a byte-level byte-pair vocabulary, given as a file of the tokenizers library.

The merges are run by tiktoken from the pieces and ids of that file, in time that grows with the text also where it
has no spaces. Pieces are merged in order of their ids, so the ids are those of the tokenizers library; a vocabulary
whose ids are in another order is refused.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np

from tradelake.llm.words import byte_symbols

# Fixed value: how byte-level vocabularies of this kind split text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteCoder:
    def __init__(self, spec: str):
        import tiktoken

        parsed = json.loads(spec)
        model, special = parsed["model"], {t["id"] for t in parsed["added_tokens"]}
        if parsed["normalizer"] or parsed["pre_tokenizer"]["type"] != "ByteLevel" or parsed["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level vocabularies without normalising are supported")
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        pieces = {bytes([byte_of[c] for c in piece]): i for piece, i in model["vocab"].items() if i not in special}
        merged = [model["vocab"][a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        if merged != sorted(merged) or len(merged) + 256 != len(pieces):
            raise ValueError("only vocabularies whose ids are in the order of their merges are supported")
        # Strings of special tokens inside a text are ordinary text: they are not known here.
        self.coder = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=pieces, special_tokens={})
        self.size = max(model["vocab"].values()) + 1
        self.pieces = pieces

    def encode(self, text: str) -> np.ndarray:
        return self.coder.encode_to_numpy(text, disallowed_special=())

    def lengths(self) -> np.ndarray:
        """Bytes of each id."""
        out = np.zeros(self.size, np.int64)
        for piece, i in self.pieces.items():
            out[i] = len(piece)
        return out


_coders: dict[str, ByteCoder] = {}


def coder_of(spec: str) -> ByteCoder:
    """The coder, built once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _coders:
        _coders[key] = ByteCoder(spec)
    return _coders[key]
