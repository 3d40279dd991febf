"""Best-fit packing of token pieces into sequences, improved by swaps between underfull ones."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import settle
from kinweave.llm.tokens import cut_pieces

#: Pieces packed together in one task, about; sequence numbers of one group lie below GROUP_SPAN.
GROUP_PIECES, GROUP_SPAN = 8_000, 1 << 32


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that takes it; bins as lists of indices."""
    order = np.argsort(-lengths, kind="stable")
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []  # (room left, bin), ascending
    for i in order.tolist():
        n = int(lengths[i])
        at = bisect_left(free, (n, -1))
        if at == len(free):
            bins.append([i])
            left, b = room - n, len(bins) - 1
        else:
            left, b = free.pop(at)
            bins[b].append(i)
            left -= n
        if left > 0:
            insort(free, (left, b))
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, room: int) -> list[list[int]]:
    """Local search over all underfull bins: squared fill grows with every step until bins empty.

    Donors go from the emptiest bin on. A step moves a piece to another bin, exchanges a piece for a shorter
    one of another bin, or two pieces for one that is shorter than both together; of all steps to all other
    underfull bins, the one that moves most is taken. A step counts only if it raises the sum of squared fills,
    so the search ends: when no donor has a step, or when the number of bins is the least possible.
    """
    least = -(-int(lengths.sum()) // room)
    held = [list(b) for b in bins]
    search = _Search(held, lengths, room)
    moved = True
    while moved and np.count_nonzero(search.fill) > least:
        moved = False
        for donor in np.argsort(search.fill, kind="stable").tolist():
            while 0 < search.fill[donor] < room and (step := search.step(donor)):
                search.take(donor, *step)
                moved = True
    return [b for b in held if b]


class _Search:
    """Bins, their fills, and all pieces from short to long."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, room: int):
        self.bins, self.lengths, self.room = bins, lengths, room
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        self.bin_of = np.empty(len(lengths), np.int64)
        for k, own in enumerate(bins):
            self.bin_of[own] = k
        self.sorted = np.argsort(lengths, kind="stable")

    def step(self, donor: int) -> tuple[list[int], list[int], int] | None:
        """The pieces to give, those to take back, and the bin, that move most; None without a step."""
        fill, lengths = self.fill, self.lengths
        takers = (fill > 0) & (fill < self.room)
        takers[donor] = False
        lead = fill[donor] - fill  # a step to a bin must move more than this to raise the squares
        piece_of = {int(lengths[i]): i for i in self.bins[donor]}  # pieces of one length are alike
        best, found = 0, None
        free = np.where(takers, self.room - fill, -1)
        for n, i in piece_of.items():
            if n > best:
                fits = np.flatnonzero((free >= n) & (lead < n))
                if len(fits):
                    best, found = n, ([i], [], int(fits[np.argmin(free[fits])]))
        # in the order of length, the first piece whose place and its bin's room together take what is given
        back = self.sorted[takers[self.bin_of[self.sorted]]]
        sizes, owners = lengths[back], self.bin_of[back]
        reach = sizes + free[owners]
        most = np.maximum.accumulate(reach)
        gives = {n: [i] for n, i in piece_of.items()}
        for a, b in combinations(self.bins[donor] if len(piece_of) == len(self.bins[donor]) else self._twice(donor), 2):
            gives.setdefault(int(lengths[a] + lengths[b]), [a, b])
        amounts = np.fromiter(gives, np.int64, len(gives))
        at = np.searchsorted(most, amounts)
        gains = np.where(at < len(sizes), amounts - sizes[np.minimum(at, len(sizes) - 1)], 0) if len(sizes) else np.zeros(len(amounts), np.int64)
        for k in np.argsort(-gains, kind="stable").tolist():
            if gains[k] <= best:
                break
            n, j = int(amounts[k]), int(at[k])
            if gains[k] <= lead[owners[j]]:  # that bin is too empty: the longest way that raises the squares
                fits = np.flatnonzero((sizes < n) & (reach >= n) & (n - sizes > lead[owners]))
                if not len(fits):
                    continue
                j = int(fits[0])
            if n - sizes[j] > best:
                best, found = n - int(sizes[j]), (gives[n], [int(back[j])], int(owners[j]))
        return found

    def _twice(self, donor: int) -> list[int]:
        """The donor's pieces, at most two of each length."""
        seen: dict[int, int] = {}
        out = []
        for i in self.bins[donor]:
            n = int(self.lengths[i])
            seen[n] = seen.get(n, 0) + 1
            if seen[n] <= 2:
                out.append(i)
        return out

    def take(self, donor: int, give: list[int], back: list[int], taker: int) -> None:
        gain = int(self.lengths[give].sum() - self.lengths[back].sum()) if back else int(self.lengths[give].sum())
        self.bins[donor][:] = [i for i in self.bins[donor] if i not in give] + back
        self.bins[taker][:] = [i for i in self.bins[taker] if i not in back] + give
        self.bin_of[give], self.bin_of[back] = taker, donor
        self.fill[donor] -= gain
        self.fill[taker] += gain


def pack(pieces: DataFrame, room: int = 4096, group: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces that have doc_id, piece and length, none longer than ``room``.

    Pieces are dealt by a hash into groups of about ``group`` rows, each packed in one task;
    repeated rows are dealt by a salt, so no id swells a group. Every group leaves less than one
    sequence's worth of room more than one packing of all would. Sequences are filled from offset 0.
    """
    pieces = settle(pieces)
    groups = max(1, math.ceil(pieces.count() / group))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    dealt = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).alias("_group")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["_group"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = rows["length"].to_numpy().astype(np.int64)
        bins = improve(best_fit(lengths, room), lengths, room)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for s, own in enumerate(bins):
            own = np.array(own)
            sequence[own] = s
            offset[own] = np.cumsum(lengths[own]) - lengths[own]
        sequence += key[0].as_py() * GROUP_SPAN
        return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return pieces.select("*", dealt).groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, room: int = 4096) -> DataFrame:
    """Tokenize documents, cut what is longer than ``room`` and pack the pieces.

    Result: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is one
    piece of one id. Repeated rows are packed each; an empty table gives no rows.
    """
    return pack(cut_pieces(docs, path, room), room)
