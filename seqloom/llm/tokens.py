"""Token ids of whole texts, by the public byte-level BPE vocabulary.

Two libraries hold this vocabulary. The one that defines the ids is several times slower; texts of
characters on which both split alike go to the faster one, all others to the first.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from pathlib import Path

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Latin texts without separators that the libraries may class differently.
_alike = re.compile("[\x00-\x1b\x20-\x84\x86-ɏ‐-‧€]*")
_special = "<|endoftext|>"


class Tokens:
    """Encodes texts to arrays of unsigned 32-bit ids, without special tokens of its own."""

    def __init__(self, folder: str | None = None):
        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = lambda name: str(Path(folder) / name) if folder else public_tokenizers.path(name)
        with open(self.path(RANKS), "rb") as f:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
        fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fast = fast.encode_ordinary
        self.slow = None

    def reference(self, text: str) -> array:
        """The library that defines the ids; a special token that stands in a text keeps its id."""
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path(VOCABULARY))
        return array("I", self.slow.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> array:
        if _special in text or not _alike.fullmatch(text):
            return self.reference(text)
        return array("I", self.fast(text))


_own: dict[str | None, Tokens] = {}


def tokens(folder: str | None = None) -> Tokens:
    """The encoder of this worker; ``folder`` holds the vocabulary files if not the installed package."""
    if folder not in _own:
        _own[folder] = Tokens(folder)
    return _own[folder]
