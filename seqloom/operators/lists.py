"""Lists of numbered terms in Arrow batches: rows of one key together, equal numbers met by one sort."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries that are sorted at a time, about, so that they stay in the cache, and that wait for the end of one key at most.
BLOCK_ENTRIES, MOST_HELD = 1 << 17, 1 << 24


def _starts(keys: pa.Array) -> np.ndarray:
    """Positions from 1 on whose key differs from the one before; null equals null."""
    a, b = keys.slice(0, len(keys) - 1), keys.slice(1)
    differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b)))
    return np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1


def whole_groups(
    batches: Iterable[pa.RecordBatch], key: str, codes: str = "codes", shrink: Callable[[pa.Table], pa.Table] | None = None
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold all rows of their keys, and the number of each row's key in the table. Rows come sorted by ``key``.

    Rows of a key that goes on wait for its end; ``shrink`` folds them where they hold many entries.
    """
    held: list[pa.Table] = []
    n_held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = batch.column(key)
        if held:
            keys = pa.concat_arrays([held[-1].column(key).combine_chunks().slice(held[-1].num_rows - 1), keys])
        starts = _starts(keys) - (1 if held else 0)
        if len(starts):
            whole = pa.concat_tables([*held, table.slice(0, starts[-1])]).combine_chunks()
            yield _numbered(whole, key)
            held, n_held, table = [], 0, table.slice(starts[-1])
        held.append(table)
        n_held += len(pc.list_flatten(table.column(codes)))
        if shrink is not None and n_held > MOST_HELD:
            held = [shrink(pa.concat_tables(held).combine_chunks())]
            n_held = len(pc.list_flatten(held[0].column(codes))) // 2  # next time when as many have come again
    if held:
        yield _numbered(pa.concat_tables(held).combine_chunks(), key)


def _numbered(table: pa.Table, key: str) -> tuple[pa.Table, np.ndarray]:
    at = np.zeros(table.num_rows, np.int64)
    at[_starts(table.column(key).combine_chunks())] = 1
    return table, np.cumsum(at)


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def entries(table: pa.Table, name: str) -> np.ndarray:
    return pc.list_flatten(table.column(name)).combine_chunks().to_numpy(zero_copy_only=False)


def lengths(table: pa.Table, name: str) -> np.ndarray:
    return pc.list_value_length(table.column(name)).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def blocks(group: np.ndarray, lens: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with whole groups and about ``BLOCK_ENTRIES`` entries each."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    before = np.r_[0, np.cumsum(lens)]
    cuts = first[np.flatnonzero(np.r_[True, np.diff(before[first] // BLOCK_ENTRIES) > 0])]
    yield from zip(cuts, np.r_[cuts[1:], len(group)], strict=True)


def meet(group: np.ndarray, lens: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, entries by group and code, where a new pair of these begins, its group). Codes are positive."""
    row = np.repeat(np.arange(len(lens)), lens)
    key = (group[row] << 31) | codes
    bits = len(codes).bit_length()
    if int(group[-1] + 1).bit_length() + 31 + bits <= 63:  # the place of an entry goes along with its key
        both = np.sort((key << bits) | np.arange(len(codes)))
        order, key = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return row, order, heads, key[heads] >> 31


def list_array(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values))
