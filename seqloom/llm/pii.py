"""Personal data in whole texts, by anchors that an Aho-Corasick automaton finds.

The automaton reports at-signs, plus signs, digits, schemes and identifier cues in one pass. At each
anchor a small parser expands to both sides, finds the boundaries of the address, number or account,
and validates it. No regular expression runs over a text, so no text makes a parser backtrack.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``; the anchors add ``url`` (an address after a
scheme that names a user or leads to a profile: ``scheme://user[:secret]@host``, ``mailto:`` and
``tel:``), ``iban`` (validated by its remainder modulo 97) and ``account`` (a number of 6 to 17
digits after a cue such as "account no").
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ready_for_python

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")

#: The characters of each part.
_DIGITS = frozenset("0123456789")
_ALPHA = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOCAL = _ALPHA | _DIGITS | frozenset("._%+-")
_LABEL = _ALPHA | _DIGITS | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_USERINFO = _ALPHA | _DIGITS | frozenset("-._~!$&'()*+,;=:%")
_SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "tel:")
_CUES = ("account no", "account number", "acct no", "konto", "kontonummer", "numéro de compte", "número de cuenta", "cuenta no")
_IBAN_LAND = "IBAN"
#: Lower case of letters one by one, so that places stay: A-Z and the accented letters of the cues.
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZÉÚ", "abcdefghijklmnopqrstuvwxyzéú")


def automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for c in _DIGITS:
        made.add_word(c, ("digit", 1))
    made.add_word("@", ("at", 1))
    made.add_word("+", ("plus", 1))
    for word in _SCHEMES:
        made.add_word(word, ("scheme", len(word)))
    for word in _CUES:
        made.add_word(word.translate(_LOWER), ("cue", len(word)))
    made.add_word(_IBAN_LAND.translate(_LOWER), ("iban", len(_IBAN_LAND)))
    made.make_automaton()
    return made


def _run(text: str, at: int, members: frozenset) -> int:
    """End of the run of members that starts at ``at``."""
    end = len(text)
    while at < end and text[at] in members:
        at += 1
    return at


def _domain(text: str, at: int) -> int:
    """End of two labels or more with dots between, or ``at``."""
    end = _run(text, at, _LABEL)
    if end == at:
        return at
    last = at
    while end < len(text) and text[end] == ".":
        after = _run(text, end + 1, _LABEL)
        if after == end + 1:
            break
        last = end = after
    return last


def email_at(text: str, sign: int, free: int) -> tuple[int, int] | None:
    """The address around an at-sign, no part of it before ``free``."""
    start = sign
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    end = _domain(text, sign + 1)
    return (start, end) if start < sign and end > sign + 1 else None


def ip_at(text: str, at: int) -> tuple[int, int, bool] | None:
    """Four numbers with dots between, and whether each is 255 at most."""
    fine, place = True, at
    for k in range(4):
        if k:
            if place >= len(text) or text[place] != ".":
                return None
            place += 1
        end = _run(text, place, _DIGITS)
        if end == place:
            return None
        part = text[place:end].lstrip("0")
        fine &= len(part) <= 3 and int(part or "0") <= 255
        place = end
    return at, place, fine


def number_end(text: str, at: int) -> int:
    """End of digits with single spaces or dashes between."""
    place = _run(text, at, _DIGITS)
    while place + 1 < len(text) and text[place] in " -" and text[place + 1] in _DIGITS:
        place = _run(text, place + 1, _DIGITS)
    return place


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def phone_at(text: str, plus: int) -> int:
    """End of the number after a plus sign, or the sign's place if there is none."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return plus
    end = _run(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    return end if end >= plus + 4 and text[end - 1] in _DIGITS else plus


def url_at(text: str, start: int, end: int) -> tuple[int, int] | None:
    """An address after a scheme that holds personal data."""
    if text[end - 2] != "/":
        if text[start] == "m":
            found = email_at(text, _run(text, end, _LOCAL), end) if _run(text, end, _LOCAL) < len(text) and text[_run(text, end, _LOCAL)] == "@" else None
            return (start, found[1]) if found else None
        stop = _run(text, end, _PHONE | {"+"})
        while stop > end and text[stop - 1] not in _DIGITS:
            stop -= 1
        return (start, stop) if 7 <= sum(c in _DIGITS for c in text[end:stop]) <= 15 else None
    sign = _run(text, end, _USERINFO)
    if sign == end or sign >= len(text) or text[sign] != "@":
        return None
    stop = _run(text, sign + 1, _LABEL | {"."})
    return (start, stop) if stop > sign + 1 else None


def iban_at(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN within a few separators after its cue, validated."""
    while at < len(text) and text[at] in " :#\t":
        at += 1
    place, kept = at, []
    while place < len(text) and len(kept) < 34:
        if text[place] in _ALPHA or text[place] in _DIGITS:
            kept.append((text[place].upper(), place + 1))
        elif text[place] != " ":
            break
        place += 1
    for size in range(len(kept), 14, -1):
        code = "".join(c for c, _ in kept[:size])
        if not (code[:2].isalpha() and code[2:4].isdigit()):
            return None
        if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return at, kept[size - 1][1]
    return None


def account_at(text: str, at: int) -> tuple[int, int] | None:
    """A number of 6 to 17 digits within a few separators after its cue."""
    while at < len(text) and text[at] in " .:#\t":
        at += 1
    end = number_end(text, at)
    digits = sum(c in _DIGITS for c in text[at:end])
    return (at, end) if 6 <= digits <= 17 else None


def find_spans(text: str, machine) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, ordered by kind as in ``KINDS`` and start.

    Matches of a kind do not overlap and are taken from the left; a match that fails its validation
    is dropped as a whole.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)
    lower = text.translate(_LOWER)
    for last, (what, size) in machine.iter(lower):
        at = last + 1 - size
        if what == "digit":
            if at and text[at - 1] in _DIGITS and free["ip"] != at and free["card"] != at:
                continue  # inside a run that was looked at from its first digit
            if at >= free["ip"]:
                span = ip_at(text, at)
                if span:
                    free["ip"] = span[1]
                    if span[2]:
                        found["ip"].append(span[:2])
            if at >= free["card"]:
                end = number_end(text, at)
                free["card"] = end
                digits = [c for c in text[at:end] if c in _DIGITS]
                if 13 <= len(digits) <= 19 and luhn("".join(digits)):
                    found["card"].append((at, end))
        elif what == "at":
            span = email_at(text, at, free["email"])
            if span:
                free["email"] = span[1]
                found["email"].append(span)
        elif what == "plus":
            if at >= free["phone"]:
                end = phone_at(text, at)
                if end > at:
                    free["phone"] = end
                    if 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                        found["phone"].append((at, end))
        else:
            kind = {"scheme": "url", "cue": "account", "iban": "iban"}[what]
            if at >= free[kind]:
                span = url_at(lower, at, last + 1) if kind == "url" else iban_at(text, last + 1) if kind == "iban" else account_at(text, last + 1)
                if span:
                    free[kind] = span[1]
                    found[kind].append(span)
    return [(k, a, b) for k in KINDS for a, b in found[k]]


_own = None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    global _own
    _own = _own or automaton()
    for batch in batches:
        kinds, starts, ends, at = [], [], [], [0]
        for text in batch.column(0).to_pylist():
            for kind, start, end in find_spans(text or "", _own):
                kinds.append(kind)
                starts.append(start)
                ends.append(end)
            at.append(len(kinds))
        flat = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["kind", "start", "end"])
        spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], spans], names=[*batch.schema.names[1:], "_spans"])


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with ``_spans``, an array of (kind, start, end).

    Positions are code points of the whole text, the end exclusive. Null and empty texts have no
    spans; rows that repeat are all returned; an empty table gives an empty result.
    """
    ready_for_python(docs.sparkSession)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{fields}, _spans array<struct<kind: string, start: int, end: int>>"
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(_scan, schema)
