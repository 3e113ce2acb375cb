"""Suffix order and common-prefix values by external induced sorting.

Suffixes that are smaller than the next one are S-type, others L-type; an S-type suffix after
an L-type one is a seed. Seeds are sorted by recursion: an induced sort of the seeds orders
the substrings between them, these get names, and the string of names - a third of the text
or less - is sorted. From sorted seeds a scan over the alphabet induces all L-type suffixes,
and a scan back all S-type ones.

The scans take suffix tuples (position, common prefix with the tuple before) from a priority
queue by first byte and order of arrival. Its buckets are files beyond a small buffer, so a
shard may be far larger than memory; tuples are handled `CHUNK` at a time. The common prefix
of two induced neighbours is one more than the least value between the tuples that induced
them, which each byte's running minimum carries from chunk to chunk.
"""

from __future__ import annotations

import tempfile

import numpy as np

CHUNK = 1 << 16
#: Bytes of tuples that a queue holds in memory; more go to a file of the task.
BUFFER = 16 << 20
TUPLE = np.dtype([("at", np.int64), ("lcp", np.uint16)])


class Queue:
    """A queue of tuples for each byte; the buffer spills to one unlinked temporary file."""

    def __init__(self, buffer: int = BUFFER):
        self.parts: list[list] = [[] for _ in range(256)]
        self.held, self.buffer, self.file = 0, buffer, None

    def push(self, byte: int, tuples: np.ndarray) -> None:
        self.parts[byte].append(tuples)
        self.held += tuples.nbytes
        if self.held > self.buffer:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    where = self.file.tell()
                    part.tofile(self.file)
                    parts[k] = (where, len(part))
        self.held = 0

    def _load(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part
        self.file.seek(part[0])
        return np.fromfile(self.file, TUPLE, part[1])

    def pop(self, byte: int):
        """The tuples of a byte in order of arrival, chunk by chunk; it may grow meanwhile."""
        parts, k = self.parts[byte], 0
        while k < len(parts):
            batch, size = [], 0
            while k < len(parts) and size < CHUNK:
                loaded = self._load(parts[k])
                if isinstance(parts[k], np.ndarray):
                    self.held -= loaded.nbytes
                parts[k] = None
                batch.append(loaded)
                size += len(loaded)
                k += 1
            joined = np.concatenate(batch)
            for a in range(0, len(joined), CHUNK):
                yield joined[a : a + CHUNK]
        self.parts[byte] = []

    def pop_back(self, byte: int):
        """The tuples of a byte from the last to the first, chunk by chunk, each reversed."""
        for part in reversed(self.parts[byte]):
            loaded = self._load(part)[::-1]
            for a in range(0, len(loaded), CHUNK):
                yield loaded[a : a + CHUNK]
        self.parts[byte] = []


class Carry:
    """Least common prefix since the last tuple that was pushed to each byte."""

    def __init__(self, cap: int):
        self.cap = cap
        self.low = np.full(256, cap, np.uint16)
        self.begun = np.zeros(256, bool)

    def pushed(self, lcp: np.ndarray, at: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Common prefixes of tuples induced at `at` (by byte, then in order) of a chunk."""
        table = [lcp]
        while (1 << len(table)) <= len(lcp):
            last, half = table[-1], 1 << (len(table) - 1)
            table.append(np.minimum(last[: len(last) - half], last[half:]))
        width = max(map(len, table))
        flat = np.full((len(table), width), self.cap, np.uint16)
        for k, row in enumerate(table):
            flat[k, : len(row)] = row

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:  # over [a, b], a <= b
            k = np.frexp(b - a + 1)[1] - 1
            return np.minimum(flat[k, a], flat[k, b - (1 << k) + 1])

        first = np.diff(byte, prepend=-1) != 0
        out = np.zeros(len(at), np.int64)
        rest = np.flatnonzero(~first)
        out[rest] = least(at[rest - 1] + 1, at[rest])
        heads = np.flatnonzero(first)
        known = self.begun[byte[heads]]
        out[heads] = np.minimum(self.low[byte[heads]], least(np.zeros(len(heads), np.int64), at[heads]))
        out = np.minimum(out + 1, self.cap)
        out[heads[~known]] = 0
        self.low = np.minimum(self.low, lcp.min())
        ends = np.append(heads[1:], len(at)) - 1
        tail = np.full(len(ends), self.cap, np.uint16)
        more = at[ends] + 1 < len(lcp)
        tail[more] = least(at[ends][more] + 1, np.full(more.sum(), len(lcp) - 1))
        self.low[byte[heads]] = tail
        self.begun[byte[heads]] = True
        return out.astype(np.uint16)

    def passed(self, lcp: np.ndarray) -> None:
        self.low = np.minimum(self.low, lcp.min())


class Text:
    """A byte string with the types of its suffixes."""

    def __init__(self, text: np.ndarray):
        self.bytes, n = text, len(text)
        ends = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, n)  # of runs
        starts = np.append(0, ends[:-1])
        rising = np.append(text[starts[1:]] > text[starts[:-1]], False)
        self.small = np.repeat(rising, ends - starts)
        self.run_ends = ends
        self.seeds = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1

    def run(self, at: int) -> int:
        return int(self.run_ends[np.searchsorted(self.run_ends, at, side="right")]) - at


def _induce(text: Text, seeds: np.ndarray, lcp: np.ndarray, cap: int, see, buffer: int) -> None:
    """Sort all suffixes from sorted seeds; see(positions, common prefixes, descending)."""
    t, small = text.bytes, text.small
    ups, downs = Queue(buffer), Queue(buffer)  # L-type ones as scanned, and for the way back
    by_byte = np.append(np.searchsorted(t[seeds], np.arange(256)), len(seeds))

    def send(queue: Queue, carry: Carry, chunk: np.ndarray, kind: bool) -> None:
        at = chunk["at"] - 1
        use = at >= 0
        use[use] = small[at[use]] == kind
        of = np.flatnonzero(use)
        if not len(of):
            carry.passed(chunk["lcp"])
            return
        byte = t[at[of]].astype(np.int64)
        order = np.argsort(byte.astype(np.uint8), kind="stable")
        of, byte = of[order], byte[order]
        out = np.empty(len(of), TUPLE)
        out["at"], out["lcp"] = at[of], carry.pushed(chunk["lcp"], of, byte)
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(out, cuts):
            queue.push(int(t[part["at"][0]]), part)

    carry = Carry(cap)
    send(ups, carry, np.array([(len(t), 0)], TUPLE), False)
    last_of = np.full(256, -1)
    for c in range(256):
        for chunk in ups.pop(c):
            send(ups, carry, chunk, False)
            downs.push(c, chunk)
            see(chunk["at"], chunk["lcp"], False)
            last_of[c] = chunk["at"][-1]
        a, b = by_byte[c], by_byte[c + 1]
        for k in range(a, b, CHUNK):
            chunk = np.empty(min(CHUNK, b - k), TUPLE)
            chunk["at"], chunk["lcp"] = seeds[k : k + CHUNK][: b - k], lcp[k : k + CHUNK][: b - k]
            if k == a:
                seam = min(text.run(int(last_of[c])), text.run(int(seeds[a]))) if last_of[c] >= 0 else 0
                chunk["lcp"][0] = min(seam, cap)
            send(ups, carry, chunk, False)

    carry, ups = Carry(cap), Queue(buffer)
    for c in range(255, -1, -1):
        least = -1
        for chunk in ups.pop(c):
            send(ups, carry, chunk, True)
            see(chunk["at"], chunk["lcp"], True)
            least = int(chunk["at"][-1])
        # L-type ones follow, from the largest; their prefixes are known to the smaller side.
        above = None
        for part in downs.pop_back(c):
            chunk = part.copy()
            if above is None:
                top = int(part["at"][0])
                seam = min(text.run(top), text.run(least), cap) if least >= 0 else 0
                if seam:
                    see(np.array([top, least]), np.array([0, seam]), False)
            else:
                seam = above
            chunk["lcp"][0] = seam
            chunk["lcp"][1:] = part["lcp"][:-1]
            above = int(part["lcp"][-1])
            send(ups, carry, chunk, True)


def _order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by doubling the length that ranks cover."""
    rank, k, n = names.astype(np.int64), 1, len(names)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - k, 0)] = rank[k:] + 1
        values, rank = np.unique(rank * (n + 1) + after, return_inverse=True)
        if len(values) == n:
            return np.argsort(rank)
        k *= 2


def _prefixes(t: np.ndarray, hash_of, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffix pairs up to cap, by bisection over hashes of substrings."""
    most = np.minimum(cap, len(t) - np.maximum(a, b))
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        same = hash_of(a, a + mid) == hash_of(b, b + mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)
    return low


def sort_suffixes(t: np.ndarray, hash_of, cap: int, see, buffer: int = BUFFER) -> None:
    """see(positions, common prefixes, descending) for all suffixes of `t`, in runs of order.

    Within a run each value is the common prefix (at most `cap`) with the suffix before it;
    the first one's refers to the last of the run before with the same first byte and type.
    hash_of(starts, ends) tells equal substrings of `t`.
    """
    if not len(t):
        return
    text = Text(t)
    seeds = text.seeds
    if len(seeds) > 1:
        # Order the substrings between seeds: induce from seeds ordered by first byte only.
        rough = seeds[np.argsort(t[seeds], kind="stable")]
        is_seed = np.zeros(len(t), bool)
        is_seed[seeds] = True
        found: list[np.ndarray] = []

        def keep(at, _, descending):
            if descending:
                found.append(at[is_seed[at]])

        _induce(text, rough, np.zeros(len(rough), np.uint16), 1, keep, buffer)
        order = np.concatenate(found)[::-1]
        place = np.searchsorted(seeds, order)
        ends = np.append(seeds[1:] + 1, len(t))[place]
        size = ends - order
        h = hash_of(order, ends)
        new = np.append(True, (h[1:] != h[:-1]) | (size[1:] != size[:-1]))
        names = np.empty(len(seeds), np.int64)
        names[place] = np.cumsum(new) - 1
        seeds = seeds[_order_names(names)]
    lcp = np.zeros(len(seeds), np.int64)
    for a in range(1, len(seeds), 1 << 20):
        part = seeds[a - 1 : a + (1 << 20)]
        lcp[a : a + len(part) - 1] = _prefixes(t, hash_of, part[:-1], part[1:], cap)
    _induce(text, seeds, lcp.astype(np.uint16), cap, see, buffer)


def repeated_starts(t: np.ndarray, hash_of, length: int, buffer: int = BUFFER) -> np.ndarray:
    """Positions whose next `length` bytes begin at another position too."""
    marks = np.zeros(len(t), bool)
    before = {False: {}, True: {}}  # last suffix seen of each first byte, by direction

    def see(at, lcp, descending):
        far = np.flatnonzero(lcp[1:] >= length) + 1
        marks[at[far]] = True
        marks[at[far - 1]] = True
        last = before[descending]
        byte = int(t[at[0]])
        if lcp[0] >= length and byte in last:
            marks[at[0]] = True
            marks[last[byte]] = True
        last[byte] = int(at[-1])

    sort_suffixes(t, hash_of, length, see, buffer)
    return marks
