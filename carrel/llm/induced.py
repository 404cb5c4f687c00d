"""External induced sorting of the suffixes of a shard, with common-prefix values.

Suffixes are sorted by their first ``cap`` bytes, which is all that repeats of
that length need. Sampled suffixes (a smaller one behind a larger one) are
named by induction, the string of their names is ordered, and the order of all
others is induced from theirs in two passes over the bytes' values.

The passes run on priority queues: what a suffix induces goes to the queue of
the byte in front of it, in order, as blocks of tuples (place, common prefix
with the one before it in the queue). Queues hold a bounded number of bytes in
memory; beyond that their blocks go to a file and come back when their byte is
due. Common prefixes of induced suffixes are those of their inducers, plus one.
"""

import tempfile

import numpy as np

GAP = 0  # separates strings; bytes are held as 1 to 256
VALUES = 257


class Queues:
    """One queue of blocks per byte value; blocks beyond ``budget`` bytes in memory are kept in a file."""

    def __init__(self, folder, budget):
        self.blocks = [[] for _ in range(VALUES)]
        self.budget, self.held = budget, 0
        self.file = tempfile.TemporaryFile(dir=folder)
        self.spilled = 0

    def push(self, value, places, common):
        block = (places, common)
        self.blocks[value].append(block)
        self.held += places.nbytes + common.nbytes
        if self.held > self.budget:
            self._spill()

    def _spill(self):
        for queue in self.blocks:
            for i, block in enumerate(queue):
                if isinstance(block[0], np.ndarray):
                    places, common = block
                    at = self.file.seek(0, 2)
                    self.file.write(places.tobytes())
                    self.file.write(common.tobytes())
                    queue[i] = (at, len(places), places.dtype, common.dtype)
                    self.held -= places.nbytes + common.nbytes
                    self.spilled += 1

    def _load(self, block):
        if isinstance(block[0], np.ndarray):
            self.held -= block[0].nbytes + block[1].nbytes
            return block
        at, count, kind, other = block
        self.file.seek(at)
        places = np.frombuffer(self.file.read(count * kind.itemsize), kind)
        return places, np.frombuffer(self.file.read(count * other.itemsize), other)

    def take(self, value, most=1 << 20):
        """What a queue holds, in the order it was pushed, as blocks of about ``most`` places; it is empty then."""
        blocks, self.blocks[value] = self.blocks[value], []
        held, count = [], 0
        for block in blocks:
            held.append(self._load(block))
            count += len(held[-1][0])
            if count >= most:
                yield self._joined(held)
                held, count = [], 0
        if held:
            yield self._joined(held)

    @staticmethod
    def _joined(blocks):
        if len(blocks) == 1:
            return blocks[0]
        return np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])

    def close(self):
        self.file.close()


class Shard:
    """Strings of one shard and the suffixes that share ``cap`` bytes with another.

    ``text`` holds strings that aren't empty as values 1 to 256 with a gap behind each; it
    may be a memory-mapped file. ``budget`` bounds the queues in memory.
    """

    def __init__(self, text, cap, folder=None, budget=256 << 20):
        self.text, self.cap, self.folder, self.budget = text, cap, folder, budget
        n = len(text)
        self.kind = np.int32 if n < 2**31 - 2 else np.int64
        # A suffix is smaller than the next one if its byte is, or is equal and the next one is.
        changes = np.flatnonzero(text[:-1] != text[1:])
        rising = text[changes] < text[changes + 1]
        self.small = np.ones(n, bool)
        if len(changes):
            runs = np.diff(np.concatenate([[-1], changes]))
            self.small[: changes[-1] + 1] = np.repeat(rising, runs)
            self.small[changes[-1] + 1 : n - 1] = False  # equal bytes up to the end
        else:
            self.small[: n - 1] = False
        self.sampled = np.flatnonzero(self.small[1:] & ~self.small[:-1]).astype(self.kind) + 1

    # Induction

    def _induce(self, places, common, queues, open_min, small):
        """Pushes what a block of sorted suffixes induces; ``common`` is the prefix shared with the one before."""
        front = places - 1
        fits = places > 0
        fits[fits] = self.small[front[fits]] == small
        where = np.flatnonzero(fits)
        if common is None:
            target = self.text[front[where]]
            for value in np.unique(target):
                own = front[where[target == value]]
                queues.push(value, own, np.zeros(0, np.int16))
            return
        lowest = common.min() if len(common) else self.cap
        if not len(where):
            np.minimum(open_min, lowest, out=open_min)
            return
        target = self.text[front[where]]
        order = np.argsort(target, kind="stable")
        values, begins = np.unique(target[order], return_index=True)
        untouched = np.ones(VALUES, bool)
        untouched[values] = False
        for value, own in zip(values, np.split(where[order], begins[1:])):
            cuts = np.concatenate([[0], own + 1])
            tail = cuts[-1] == len(common)
            mins = np.minimum.reduceat(common, cuts[:-1] if tail else cuts)
            shared = mins[: len(own)].copy()
            shared[0] = min(shared[0], open_min[value])
            open_min[value] = self.cap if tail else mins[-1]
            if not self.begun[value]:
                self.begun[value] = True
                shared[0] = -1
            queues.push(value, front[own], np.minimum(shared + 1, self.cap).astype(np.int16))
        open_min[untouched] = np.minimum(open_min[untouched], lowest)

    def _seam(self, a, b):
        """Common prefix of two suffixes, by looking."""
        x, y = self.text[a : a + self.cap], self.text[b : b + self.cap]
        m = min(len(x), len(y))
        differ = np.flatnonzero(x[:m] != y[:m])
        return int(differ[0]) if len(differ) else m

    def _pass(self, seeds, small, with_common, out):
        """One pass over the byte values. ``seeds(value)`` yields the blocks that are known already and come behind
        what is induced within a value; ``out(value, places, common, seed)`` gets every block in the order of the pass."""
        queues = Queues(self.folder, self.budget)
        open_min = np.full(VALUES, self.cap, np.int64)
        self.begun = np.zeros(VALUES, bool)
        try:
            for value in range(VALUES - 1, -1, -1) if small else range(VALUES):
                last = None
                while queues.blocks[value]:
                    for places, common in queues.take(value):
                        out(value, places, common, False)
                        self._induce(places, common.astype(np.int64) if with_common else None, queues, open_min, small)
                        last = places[-1] if len(places) else last
                first = True
                for places, common in seeds(value):
                    if not len(places):
                        continue
                    if with_common and first:
                        common = common.copy()
                        common[0] = 0 if last is None else self._seam(last, places[0])
                    first = False
                    out(value, places, common, True)
                    self._induce(places, common.astype(np.int64) if with_common else None, queues, open_min, small)
        finally:
            queues.close()

    def _by_value(self, places, common):
        """Sorted suffixes cut by their first byte."""
        first = self.text[places]
        edges = np.searchsorted(first, np.arange(VALUES + 1))
        return lambda v: [(places[edges[v] : edges[v + 1]], common[edges[v] : edges[v + 1]] if common is not None else None)]

    def _both_passes(self, places, common, out):
        """Induces the larger suffixes from the sampled ones, then the smaller ones from those.

        ``out`` gets (value, places, common, larger) in descending order, each
        block descending too, ``common`` shared with the suffix before it.
        """
        with_common = common is not None
        larger = Queues(self.folder, self.budget)

        def keep(value, block, shared, seed):
            if not seed:
                larger.push(value, block, shared if with_common else np.zeros(0, np.int16))

        def backwards(value):
            blocks = list(larger.take(value))
            if not blocks:
                return
            places = np.concatenate([b[0] for b in blocks])[::-1]
            shared = None
            if with_common:
                ahead = np.concatenate([b[1] for b in blocks])
                shared = np.concatenate([[0], ahead[1:][::-1]]).astype(np.int16)
            yield places, shared

        try:
            self._pass(self._by_value(places, common), False, with_common, keep)
            # The last suffix, a gap with nothing behind, is the smallest of all and has no one to induce it.
            self._pass(backwards, True, with_common, out)
        finally:
            larger.close()

    # Order of the sampled suffixes

    def _named(self):
        """Names of the sampled substrings in order of place, and whether all differ."""
        sampled, n = self.sampled, len(self.text)
        unsorted = sampled[np.argsort(self.text[sampled], kind="stable")]
        found = []
        self._both_passes(unsorted, None, lambda v, p, c, seed: found.append(p[self._is_sampled[p]]) if not seed else None)
        order = np.concatenate(found)[::-1] if found else np.zeros(0, self.kind)
        order = np.concatenate([np.array([n - 1], self.kind)[self._is_sampled[[n - 1]]], order[order != n - 1]])
        ends = np.append(sampled[1:], n - 1)
        length = np.zeros(n, np.int64)
        length[sampled] = np.minimum(ends - sampled + 1, self.cap + 1)
        a, b = order[:-1], order[1:]
        differ = (length[a] != length[b]) | (b == n - 1) | (a == n - 1)
        left = np.flatnonzero(~differ)
        step = 0
        while len(left):
            unlike = self.text[a[left] + step] != self.text[b[left] + step]
            differ[left[unlike]] = True
            left = left[~unlike]
            step += 1
            left = left[length[a[left]] > step]
        names = np.zeros(n, np.int64)
        names[order] = np.concatenate([[0], np.cumsum(differ)])
        return names[sampled]

    def _sampled_order(self):
        """The sampled suffixes in order of their first ``cap`` bytes.

        The string of names is ordered by doubling ranks: a name spans at least
        two bytes, so ranks over ``cap / 2`` names settle the order.
        """
        rank = self._named()
        span = 1
        while len(rank) and rank.max() < len(rank) - 1 and 2 * span <= self.cap + 2:
            behind = np.zeros(len(rank), np.int64)
            behind[:-span] = rank[span:] + 1
            pair = rank * (len(rank) + 2) + behind
            order = np.argsort(pair, kind="stable")
            step = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
            rank = np.empty_like(step)
            rank[order] = step
            span *= 2
        return self.sampled[np.argsort(rank, kind="stable")]

    def _common(self, order):
        """Bytes that neighbours of a sorted list of suffixes share, up to ``cap``."""
        shared = np.zeros(len(order), np.int16)
        n, width = len(self.text), 32
        left = np.arange(1, len(order))
        rows = np.lib.stride_tricks.sliding_window_view(self.text, width) if n >= width else None
        step = 0
        while len(left) and rows is not None and step < self.cap:
            at = np.maximum(order[left - 1], order[left]).astype(np.int64) + step
            edge = at + width > n
            self._common_at_edge(order, left[edge], step, shared)
            left = left[~edge]
            full = np.empty(len(left), bool)
            for low in range(0, len(left), 1 << 16):
                own = left[low : low + (1 << 16)]
                unlike = rows[order[own - 1] + step] != rows[order[own] + step]
                differs = unlike.any(1)
                shared[own] += np.where(differs, unlike.argmax(1), width).astype(np.int16)
                full[low : low + (1 << 16)] = ~differs
            left = left[full]
            step += width
        if rows is None:
            self._common_at_edge(order, left, 0, shared)
        return np.minimum(shared, self.cap)

    def _common_at_edge(self, order, left, step, shared):
        n = len(self.text)
        while len(left) and step < self.cap:
            a, b = order[left - 1] + step, order[left] + step
            inside = (a < n) & (b < n)
            left, a, b = left[inside], a[inside], b[inside]
            left = left[self.text[a] == self.text[b]]
            shared[left] += 1
            step += 1

    def repeated(self):
        """For every place whether another place begins with the same ``cap`` bytes."""
        n = len(self.text)
        marked = np.zeros(n, bool)
        if n < 2:
            return marked
        self._is_sampled = np.zeros(n, bool)
        self._is_sampled[self.sampled] = True
        order = self._sampled_order()
        last = [None, None]

        def mark(value, places, common, seed):
            if last[0] == value:
                if common[0] >= self.cap:
                    marked[last[1]] = marked[places[0]] = True
            same = np.flatnonzero(common[1:] >= self.cap)
            marked[places[same]] = True
            marked[places[same + 1]] = True
            if len(places):
                last[:] = [value, places[-1]]

        self._both_passes(order, self._common(order), mark)
        return marked


def repeated_starts(strings, cap, folder=None, budget=256 << 20):
    """For each string the places (bool array) where ``cap`` bytes begin that begin elsewhere too.

    The text is built in a file and mapped, so that it needn't fit in memory.
    """
    full = [s for s in strings if s]
    lengths = np.array([len(s) for s in full], np.int64)
    with tempfile.TemporaryFile(dir=folder) as file:
        for s in full:
            (np.frombuffer(s, np.uint8).astype(np.uint16) + 1).tofile(file)
            np.array([GAP], np.uint16).tofile(file)
        file.flush()
        if not full:
            return [np.zeros(0, bool) for _ in strings]
        text = np.memmap(file, np.uint16, "r") if int(lengths.sum()) > budget else None
        if text is None:
            file.seek(0)
            text = np.frombuffer(file.read(), np.uint16)
        marked = Shard(text, cap, folder, budget).repeated()
    starts = np.cumsum(lengths + 1) - lengths - 1
    found = iter([marked[a : a + max(0, m - cap + 1)] for a, m in zip(starts, lengths)])
    return [next(found) if s else np.zeros(0, bool) for s in strings]
