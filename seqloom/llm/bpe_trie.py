"""Byte-level BPE by last-token states on a trie of words, and the way back to text.

An encoding is fixed by its last token: cut that token off and the rest is the encoding of the text
before it. So each prefix of a word needs one state only, the last token of the prefix. A token that
ends the prefix is that state if it may follow the state of the shorter prefix; exactly one does. Words
go into a trie in sorted order, which visits its nodes depth first; a node's state comes from the states
on its path, so a prefix that words share is encoded once, also across texts and batches of a task.

Two tokens may stand side by side if no merge across their border would have come first. The merges
inside each token are known, so the parts that touch the border at any time are the right-hand parts of
the left token and the left-hand parts of the right one; a pair of such parts with a merge of its own,
older than the merges that use up either part, rules the pair out.

Texts are cut into words as the tokenizers library does: by the pattern of the vocabulary where all
characters are ones that need no newer character tables, else by the library's own splitter. A special
token in a text is an id of its own. Decoding joins the bytes of the ids; what is no UTF-8 becomes U+FFFD.

Memory of a task: the trie and the words seen are dropped at ``MOST_NODES`` and ``MOST_WORDS``; words
over ``LONGEST_SHARED`` bytes are encoded in place, in time in proportion to their length, and not kept.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ready_for_python

VOCABULARY = "byte_bpe_50k.json"
MOST_NODES = 1_000_000
MOST_WORDS = 400_000
MOST_PAIRS = 500_000
LONGEST_SHARED = 256
ENDLESS = 1 << 60
#: Characters of text that a task encodes at a time (or one text, if that is longer).
PART_CHARS = 1 << 22

#: Characters whose class is the same in all versions of the character tables: Latin letters, their
#: punctuation and the plain white space.
_settled = "\x00-\x1b\x20-\x84\x86-ɏ‐-‧€"
_plain = re.compile(f"[{_settled}]*")


def _class_of(kinds: str, below: int = 0x250) -> str:
    return "".join(re.escape(chr(c)) for c in range(below) if unicodedata.category(chr(c))[0] in kinds)


def _splitter() -> re.Pattern:
    """The pattern of the vocabulary (fixed value), its letters and digits listed for settled characters."""
    letter, number, space = _class_of("L"), _class_of("N"), "\\t-\\r \\xa0"
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, to the byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merges:
    """The vocabulary: bytes of each id, the parts it is merged from, and which ids may be neighbours."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        letters = byte_letters()
        vocab = stored["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.pieces: dict[int, bytes] = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.pieces |= {i: text.encode() for text, i in self.special.items()}
        self.sizes = {i: len(piece) for i, piece in self.pieces.items()}
        self.born = dict.fromkeys(vocab.values(), -1)  # the merge that makes an id; single bytes have none
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[int, dict[int, int]] = {}  # left part to right part to rank
        for rank, pair in enumerate(stored["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole, both = vocab[left + right], (vocab[left], vocab[right])
            self.merged.setdefault(both[0], {})[both[1]] = rank
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = both, rank
        self.borders: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.known: dict[int, bool] = {}
        #: Every ending of a token, to the token if it is one that its own bytes encode to, else -1.
        self.endings: dict[bytes, int] = {}
        whole: set[int] = set()
        for token in sorted(vocab.values(), key=self.born.__getitem__):
            both = self.parts.get(token)
            if both is None or (both[0] in whole and both[1] in whole and self._apart(*both, self.born[token])):
                whole.add(token)
                self.endings[self.pieces[token]] = token
        for token in whole:
            piece = self.pieces[token]
            for k in range(1, len(piece)):
                self.endings.setdefault(piece[k:], -1)

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Whether no merge older than ``until`` joins parts of the two across their border."""
        rights = self.borders[0].get(right) or self._border(right, 0)
        for joins, x_used in self.borders[1].get(left) or self._border(left, 1):
            for y, y_used in rights:
                rank = joins.get(y, until)
                # of equal merges the one further left comes first: the inner one of the left token
                if rank < until and rank < x_used and rank <= y_used:
                    return False
        return True

    def _border(self, token: int, side: int) -> list[tuple]:
        """Parts of a token that touch its left (0) or right (1) border, each with the merge that uses
        it up; of parts at a right border those that merge with anything, and with what."""
        found, used, part = [], ENDLESS, token
        while True:
            joins = self.merged.get(part)
            if side == 0:
                found.append((part, used))
            elif joins:
                found.append((joins, used))
            if part not in self.parts:
                break
            used, part = self.born[part], self.parts[part][side]
        self.borders[side][token] = found
        return found

    def may_follow(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.known.get(pair)
        if known is None:
            if len(self.known) >= MOST_PAIRS:
                self.known.clear()
            known = self.known[pair] = self._apart(left, right, ENDLESS)
        return known


class Trie:
    """Words as paths; each node holds the last token of the encoding of its prefix."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.child: dict[int, int] = {}
        self.last = array("i", [-1])

    def encode(self, word: bytes) -> array:
        """Ids of a word. Words given in sorted order visit the trie depth first."""
        endings, may_follow, shared = self.merges.endings.get, self.merges.may_follow, len(word) <= LONGEST_SHARED
        lasts, node, child = [-1], 0, self.child  # the last token of each prefix of the word
        if shared:
            for byte in word:
                below = child.get(node << 8 | byte)
                if below is None:
                    break
                node = below
                lasts.append(self.last[node])
        for depth in range(len(lasts), len(word) + 1):
            found, state = [], -1
            for start in range(depth - 1, -1, -1):
                token = endings(word[start:depth])
                if token is None:
                    break
                if token >= 0:
                    found.append((token, start))
            for token, start in reversed(found):
                if start == 0 or may_follow(lasts[start], token):
                    state = token
                    break
            lasts.append(state)
            if shared:
                edge = node << 8 | word[depth - 1]
                node = child[edge] = len(self.last)
                self.last.append(state)
        ids, depth = array("i"), len(word)
        while depth:
            ids.append(lasts[depth])
            depth -= self.merges.sizes[lasts[depth]]
        ids.reverse()
        return ids


class Codec:
    """Encodes and decodes texts; one per worker process and vocabulary."""

    def __init__(self, path: str):
        self.path = path
        self.merges = Merges(path)
        self.split = _splitter().findall
        names = sorted(self.merges.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.library = None
        self.forget()

    def forget(self) -> None:
        self.trie = Trie(self.merges)
        self.words: dict[str, bytes] = {name: array("i", [i]).tobytes() for name, i in self.merges.special.items()}

    def words_of(self, text: str) -> list[str]:
        if _plain.fullmatch(text):
            return self.split(text)
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; the words that are new go into the trie together."""
        special = self.merges.special
        split = []
        for text in texts:
            parts = self.cut.split(text) if self.cut else [text]
            split.append([w for part in parts if part for w in ([part] if part in special else self.words_of(part))])
        if len(self.words) > MOST_WORDS or len(self.trie.last) > MOST_NODES:
            self.forget()
        fresh = {w for words in split for w in words if w not in self.words}
        own: dict[str, bytes] = {}
        for raw, word in sorted((w.encode(), w) for w in fresh):
            kept = self.words if len(raw) <= LONGEST_SHARED else own
            kept[word] = self.trie.encode(raw).tobytes()
        ids = (b"".join([self.words.get(w) or own[w] for w in words]) for words in split)
        return [np.frombuffer(x, np.int32) for x in ids]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        return b"".join(map(self.merges.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


_own: dict[str, Codec] = {}


def codec(folder: str | None = None) -> Codec:
    """The codec of this worker; ``folder`` holds the vocabulary file if not the installed package."""
    if folder is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    else:
        path = str(Path(folder) / VOCABULARY)
    if path not in _own:
        _own[path] = Codec(path)
    return _own[path]


def parts_of(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of about ``PART_CHARS`` characters; null texts are empty."""
    first, texts, chars = 0, [], 0
    for row, text in enumerate(column):
        texts.append(text.as_py() or "")
        chars += len(texts[-1])
        if chars >= PART_CHARS:
            yield first, texts
            first, texts, chars = row + 1, [], 0
    if texts:
        yield first, texts


def encode_documents(docs: DataFrame, keep: list[str], folder: str | None = None) -> DataFrame:
    """The columns ``keep`` with ``ids`` of the whole text and ``decoded``, the text of those ids.

    A null text is empty and has no ids; equal and repeated rows are each encoded; an empty table gives
    none. Kept columns named like a result give way to it.
    """
    ready_for_python(docs.sparkSession)
    keep = [c for c in keep if c not in ("ids", "decoded")]
    text = "text" if "text" not in keep else "_" + max(keep, key=len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(folder)
        for batch in batches:
            for first, texts in parts_of(batch.column(0)):
                found = own.encode(texts)
                bounds = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(found)))
                decoded = pa.array([own.decode(x) for x in found], pa.string())
                rest = [c.slice(first, len(found)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*rest, ids, decoded], names=[*batch.schema.names[1:], "ids", "decoded"])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(F.col("text").alias(text), *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, f"{fields}ids array<int>, decoded string")
