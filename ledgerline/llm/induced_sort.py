"""Suffix sorting by external induced sorting, with common-prefix lengths.

The suffixes that start a rise after a fall (the leftmost of each rise) are sorted first, by naming the
substrings between them and sorting the string of names in the same way, or, once it takes a small part of
the memory, by doubling the compared length; all others are induced from them, falling ones in a pass from
the smallest symbol up, rising ones in a pass back down. A pass pops tuples (position, common prefix with
the tuple before) from a priority queue and pushes the tuples of the positions before them.

The queue is one lane per range of symbols. Pushes into a lane arrive in order, so a lane is a run of
tuples that goes to disk when the queue outgrows its memory and is read back when the pass gets there.
The common prefix of two pushed tuples is one more than the least one between the tuples that pushed them.
Large arrays are mapped to files that vanish with the task; nothing that others read is kept there.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Common prefixes are cut off here, unless the caller names another length.
CLIP = 200
#: Tuples a queue, and elements an array, may hold in memory.
MEMORY = 1 << 22
_BATCH = 1 << 16
_LANES = 256


def _array(n: int, dtype, memory: int) -> np.ndarray:
    if n <= memory:
        return np.zeros(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))


class Queue:
    """Lanes of tuples (position, prefix), popped lane by lane in the order they were pushed."""

    def __init__(self, n_lanes: int, memory: int):
        self.held = [[] for _ in range(n_lanes)]
        self.size = [0] * n_lanes
        self.total = 0
        self.files: dict[int, list] = {}
        self.memory = memory

    def push(self, lane: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self.held[lane].append((position, prefix))
        self.size[lane] += len(position)
        self.total += len(position)
        if self.total > self.memory:
            self._spill(max(range(len(self.size)), key=self.size.__getitem__))

    def _spill(self, lane: int) -> None:
        file, runs = self.files.setdefault(lane, [tempfile.TemporaryFile(), []])
        for position, prefix in self.held[lane]:
            file.write(position.astype(np.int64).tobytes())
            file.write(prefix.astype(np.uint8).tobytes())
            runs.append(len(position))
        self.total -= self.size[lane]
        self.held[lane], self.size[lane] = [], 0

    def pop(self, lane: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """All tuples of a lane, in runs; pushes of a few tuples are joined to larger runs."""
        held = _joined(self.held[lane])
        self.total -= self.size[lane]
        self.held[lane], self.size[lane] = [], 0
        if lane not in self.files:
            return held
        file, runs = self.files.pop(lane)
        file.seek(0)
        back = [(np.frombuffer(file.read(8 * n), np.int64), np.frombuffer(file.read(n), np.uint8)) for n in runs]
        return _joined(back) + held


def _joined(runs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same tuples in runs of at least ``_BATCH``, but for the last."""
    out, part, size = [], [], 0
    for i, run in enumerate(runs):
        part.append(run)
        size += len(run[0])
        if size >= _BATCH or i == len(runs) - 1:
            out.append(part[0] if len(part) == 1 else tuple(np.concatenate(x) for x in zip(*part)))
            part, size = [], 0
    return out


def _rises(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the suffix at each position is smaller than the next one, and how long its symbol runs."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    following = np.repeat(np.arange(len(change)), np.diff(change, prepend=-1))
    rise = np.ones(n, bool)
    rise[:-1] = (text[change] < text[change + 1])[following]
    run = np.ones(n, np.int64)
    run[:-1] = change[following] - np.arange(n - 1) + 1
    return rise, run


def _names(text: np.ndarray, at: np.ndarray, n_symbols: int) -> np.ndarray:
    """The rank of each substring from one position to the next, ends included; equal ones share a rank.

    They are refined a few symbols at a time, only where they still tie. Where one begins another the
    longer one comes first, as it goes on falling where the other rises.
    """
    bits = max(int(n_symbols + 1).bit_length(), 1)
    width = 63 // bits
    pad = (1 << bits) - 1
    length = np.append(np.diff(at) + 1, 1)
    rank = np.zeros(len(at), np.int64)
    active, shift = np.arange(len(at)), 0
    while len(active):
        key = np.zeros(len(active), np.int64)
        for i in range(shift, shift + width):
            symbol = np.where(i < length[active], text[np.minimum(at[active] + i, len(text) - 1)], pad)
            key = (key << bits) | symbol
        order = np.lexsort((key, rank[active]))
        active, key = active[order], key[order]
        old = rank[active]
        new_group = np.append(True, old[1:] != old[:-1])
        new_part = new_group | np.append(True, key[1:] != key[:-1])
        index = np.arange(len(active))
        group = np.maximum.accumulate(np.where(new_group, index, 0))
        part = np.maximum.accumulate(np.where(new_part, index, 0))
        rank[active] = old + part - group
        starts = np.flatnonzero(new_part)
        sizes = np.diff(np.append(starts, len(active)))
        shift += width
        # A substring that ends here still has to go behind the longer ones it ties with.
        open_ = (sizes > 1) & (np.maximum.reduceat(length[active], starts) > shift)
        active = active[np.repeat(open_, sizes)]
    return np.unique(rank, return_inverse=True)[1]


class _Least:
    """Least values of ranges of an array, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (1 << (len(self.levels) - 1)) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Over both ends; 255 for an empty range."""
        out = np.full(len(first), 255, np.uint8)
        size = last - first + 1
        power = np.zeros(len(first), np.int64)
        power[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64)
        for p in np.unique(power[size > 0]).tolist():
            of = np.flatnonzero((power == p) & (size > 0))
            level = self.levels[p]
            out[of] = np.minimum(level[first[of]], level[last[of] - (1 << p) + 1])
        return out


class _Pass:
    """One induction pass over lanes; ``wanted`` tells which suffixes it places."""

    def __init__(self, text, wanted, lane_of, single, clip, memory, sign):
        self.text, self.single, self.clip, self.sign = text, single, clip, sign
        # The lane of each position, in few bytes, as a stable sort of those is a counting one.
        self.none = len(single)
        self.lane_at = np.where(wanted, lane_of.astype(np.min_scalar_type(self.none))[text], np.min_scalar_type(self.none).type(self.none))
        self.queue = Queue(len(single), memory)
        self.least = np.zeros(len(single), np.uint8)  # since the last push, into each lane
        self.fresh = np.ones(len(single), bool)

    def scan(self, position: np.ndarray, prefix: np.ndarray, own: int) -> None:
        """Pushes what the scanned tuples induce; into the lane ``own`` only if it has one symbol."""
        for a in range(0, len(position), _BATCH):
            part, least = position[a : a + _BATCH], prefix[a : a + _BATCH]
            before = np.maximum(part - 1, 0)
            lane = self.lane_at[before]
            use = (part > 0) & (lane != self.none)
            if not self.single[own]:
                use &= lane != own
            index = np.flatnonzero(use)
            order = np.argsort(lane[index], kind="stable")
            index = index[order]
            lanes = lane[index]
            first = np.append(True, lanes[1:] != lanes[:-1])[: len(lanes)]
            common = np.zeros(len(index), np.uint8)
            starts = np.flatnonzero(first)
            touched = lanes[starts]
            if self.clip:
                table = _Least(least)
                since = np.where(first, 0, np.append(-1, index[:-1])[: len(index)] + 1)
                common = table(since, index)
                common[starts] = np.minimum(common[starts], self.least[touched])
                common = np.minimum(common.astype(np.int64) + 1, self.clip).astype(np.uint8)
                common[starts[self.fresh[touched]]] = 0
                self.fresh[touched] = False
                self.least = np.minimum(self.least, least.min())
                last = index[np.append(starts[1:], len(index)) - 1] if len(index) else index
                self.least[touched] = table(last + 1, np.full(len(last), len(least) - 1))
            pushed = before[index]
            for lane_, i, j in zip(touched.tolist(), starts.tolist(), np.append(starts[1:], len(index)).tolist()):
                self.queue.push(lane_, pushed[i:j], common[i:j])

    def settle(self, lane: int, ext: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scan order of a lane of several symbols: what was pushed into it, the seeds, and what these
        induce within it. Also whether each is placed by this pass."""
        position = np.concatenate([ext, seeds]).astype(np.int64)
        seed = np.repeat([0, 1], [len(ext), len(seeds)])
        within = np.zeros(len(position), np.int64)
        source = np.concatenate([np.arange(len(ext)), np.arange(len(seeds))]).astype(np.int64)
        parent = np.full(len(position), -1)
        frontier = np.arange(len(position))
        while True:
            order = np.lexsort((source, within, seed, self.sign * self.text[position].astype(np.int64)))
            before = np.maximum(position[frontier] - 1, 0)
            use = (position[frontier] > 0) & (self.lane_at[before] == lane)
            if not use.any():
                return position[order], seed[order] == 0
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            old = len(position)
            position = np.concatenate([position, before[use]])
            more = int(use.sum())
            seed = np.concatenate([seed, np.zeros(more, np.int64)])
            within = np.concatenate([within, np.ones(more, np.int64)])
            parent = np.concatenate([parent, frontier[use]])
            source = np.where(within == 1, rank[np.maximum(parent, 0)], np.append(source, np.zeros(more, np.int64)))
            frontier = np.arange(old, len(position))


def _lanes(text: np.ndarray, n_symbols: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """The lane of every symbol, and whether the lane has that symbol alone."""
    if n_symbols <= 2 * _LANES:
        return np.arange(n_symbols), np.ones(n_symbols, bool)
    counts = np.bincount(text, minlength=n_symbols)
    most = max(1, len(text) // _LANES, min(_BATCH, memory) // 128)
    hot = counts > most
    step = np.cumsum(counts) // most
    new = hot | np.append(True, hot[:-1]) | np.append(True, step[1:] != step[:-1])
    lane = np.cumsum(new) - 1
    return lane, np.bincount(lane) == 1


def _seed_prefix(text: np.ndarray, position: np.ndarray, n_symbols: int, clip: int) -> np.ndarray:
    """The common prefix of each sorted seed with the one before, several symbols compared at a time."""
    common = np.zeros(len(position), np.uint8)
    if len(position) < 2 or not clip:
        return common
    symbol = np.dtype(np.min_scalar_type(n_symbols - 1))
    step = 8 // symbol.itemsize
    # The last symbol occurs once, so no two suffixes are equal beyond it, and what follows it does not matter.
    packed = np.zeros(len(text) + clip + 2 * step, symbol)
    packed[: len(text)] = text
    words = np.ndarray(len(text) + clip + step, "<u8", packed, strides=(symbol.itemsize,))
    a, b, on = position[:-1], position[1:], np.arange(len(position) - 1)
    for depth in range(0, clip, step):
        other = words[a[on] + depth] ^ words[b[on] + depth]
        equal = other == 0
        low = other & (~other + np.uint64(1))
        same = np.where(equal, step, np.bitwise_count(low - np.uint64(1)) // (8 * symbol.itemsize))
        common[on + 1] = np.minimum(depth + same, clip)
        on = on[equal]
        if not len(on):
            break
    return common


def _sorted_in_memory(names: np.ndarray) -> np.ndarray:
    """All positions of a string of names in the order of its suffixes; the last name occurs nowhere else.

    Suffixes that tie in their first symbols are compared by the rank of what follows these, so the compared
    length doubles each time, and only what still ties is looked at again.
    """
    n = len(names)
    counts = np.bincount(names)
    rank = (np.cumsum(counts) - counts)[names]  # the place of the first suffix of each group of ties
    active = np.flatnonzero(counts[names] > 1)
    step = 1
    while len(active):
        # What ties does not reach the last name, so there is always a rank to compare by.
        key = rank[active] * n + rank[active + step]
        order = np.argsort(key)
        active, key = active[order], key[order]
        old = rank[active]
        index = np.arange(len(active))
        new_part = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), index, 0))
        part = np.maximum.accumulate(np.where(new_part, index, 0))
        rank[active] = old + part - group
        active = active[~(new_part & np.append(new_part[1:], True))]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def sort_suffixes(text: np.ndarray, n_symbols: int, clip: int = CLIP, memory: int = MEMORY):
    """All positions of ``text`` in the order of their suffixes, and each one's common prefix with the one
    before, cut off at ``clip``, 254 at most; with 0 it is not worked out. The last symbol must be 0 and
    occur nowhere else."""
    n = len(text)
    rise, run = _rises(text)
    seeds = np.flatnonzero(rise[1:] & ~rise[:-1]) + 1
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.uint8)
    names = _names(text, seeds, n_symbols)
    n_names = int(names.max()) + 1
    if n_names == len(seeds):
        order = np.argsort(names)
    elif 4 * len(names) <= memory:
        order = _sorted_in_memory(names)
    else:
        order = sort_suffixes(names, n_names, 0, memory)[0]
    seeds = seeds[order]
    seed_prefix = _seed_prefix(text, seeds, n_symbols, clip)
    lane_of, single = _lanes(text, n_symbols, memory)
    n_lanes = len(single)
    seed_edges = np.searchsorted(lane_of[text[seeds]], np.arange(n_lanes + 1))

    def meet(a: int, b: int) -> int:
        """The common prefix of a falling and a rising suffix of one symbol."""
        return min(int(run[a]), int(run[b]), clip) if text[a] == text[b] else 0

    up = _Pass(text, ~rise, lane_of, single, clip, memory, 1)
    falling = Queue(n_lanes, memory)
    for lane in range(n_lanes):
        own, own_prefix = (x[seed_edges[lane] : seed_edges[lane + 1]] for x in (seeds, seed_prefix))
        if single[lane]:
            last = None
            while runs := up.queue.pop(lane):
                for position, prefix in runs:
                    falling.push(lane, position, prefix)
                    up.scan(position, prefix, lane)
                    last = int(position[-1])
            if len(own):
                own_prefix = own_prefix.copy()
                own_prefix[0] = meet(last, int(own[0])) if last is not None else 0
                up.scan(own, own_prefix, lane)
        else:
            runs = up.queue.pop(lane)
            ext = np.concatenate([p for p, _ in runs] or [np.zeros(0, np.int64)])
            position, placed = up.settle(lane, ext, own)
            up.scan(position, np.zeros(len(position), np.uint8), lane)
            falling.push(lane, position[placed], np.zeros(int(placed.sum()), np.uint8))

    down = _Pass(text, rise, lane_of, single, clip, memory, -1)
    order, common = _array(n, np.int64, memory), _array(n, np.uint8, memory)
    end = n
    for lane in range(n_lanes - 1, -1, -1):
        fell = falling.pop(lane)
        low = np.concatenate([p for p, _ in fell] or [np.zeros(0, np.int64)])
        low_prefix = np.concatenate([c for _, c in fell] or [np.zeros(0, np.uint8)])
        if single[lane]:
            high, high_prefix = [], []
            while runs := down.queue.pop(lane):
                for position, prefix in runs:
                    down.scan(position, prefix, lane)
                    high.append(position)
                    high_prefix.append(prefix)
            if lane == lane_of[0]:  # the last position, which nothing induces
                high, high_prefix = [np.array([n - 1])], [np.zeros(1, np.uint8)]
            high = np.concatenate(high or [np.zeros(0, np.int64)])
            high_prefix = np.concatenate(high_prefix or [np.zeros(0, np.uint8)])
            border = meet(int(low[-1]), int(high[-1])) if len(low) and len(high) else 0
            if len(low):
                back = np.append(low_prefix[1:], border)[::-1].astype(np.uint8)
                down.scan(low[::-1], back, lane)
            ascending = np.concatenate([low, high[::-1]])
            prefixes = np.concatenate([low_prefix, np.append(border, high_prefix[:0:-1])[: len(high)]])
        else:
            runs = down.queue.pop(lane)
            ext = np.concatenate([p for p, _ in runs] or [np.zeros(0, np.int64)])
            if lane == lane_of[0]:
                ext = np.append(ext, n - 1)
            position, _ = down.settle(lane, ext, low[::-1])
            down.scan(position, np.zeros(len(position), np.uint8), lane)
            ascending, prefixes = position[::-1], np.zeros(len(position), np.uint8)
        order[end - len(ascending) : end] = ascending
        common[end - len(ascending) : end] = prefixes
        end -= len(ascending)
    return order, common
