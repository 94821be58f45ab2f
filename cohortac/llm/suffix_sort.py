"""External induced suffix sorting with common-prefix values.

A text is a row of symbols whose last symbol is 0 and the only 0. A suffix is S-type if it is
smaller than the next suffix and L-type if larger; an S-type suffix after an L-type one is
S*. The S* suffixes are sorted first: the substrings between them get names in sorted order,
and the string of names is sorted by recursion. Two inductions then give all other suffixes:
taking suffixes from a priority queue in ascending order, the suffix one to the left is put
into the queue with its first symbol if it is L-type; from the L-type suffixes, in descending
order, the S-type ones follow the same way.

* Queue entries carry the suffix's place and its common prefix with the entry put into the
  queue before it under the same symbol: one symbol more than the least common prefix of
  all suffixes taken since. Common prefixes of suffixes with different first symbols come
  from a range minimum over the common prefixes of adjacent symbols, which are the common
  prefixes of the substrings that the symbols name. So all values are in bytes at every level.
* The recursion ends when all names differ or a string of names is short enough to be sorted in
  memory.
* The queue is monotone. Its keys are cut into ranges of about ``BLOCK`` entries; entries of
  later ranges are appended to their range's list, and lists go to disk when together they
  exceed ``MEMORY`` bytes. Only the range at the head is held sorted. Entries are taken in
  batches: the longest run at the head which no entry it puts into the queue can precede.
"""

from __future__ import annotations

import tempfile

import numpy as np

BLOCK = 1 << 15
MEMORY = 1 << 26
DIRECT = 1 << 20


def _whole(most: int) -> type:
    """The type of whole numbers below ``most``: of 4 bytes where they fit."""
    return np.int32 if most < np.iinfo(np.int32).max else np.int64


class RangeMinimum:
    """Minimum of values[a + 1 .. b] for arrays of a < b, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.table = np.empty((max(1, len(values).bit_length()), len(values)), values.dtype)
        self.table[0] = values
        for p in range(1, len(self.table)):
            half, n = 1 << p - 1, len(values) + 1 - (1 << p)
            np.minimum(self.table[p - 1, :n], self.table[p - 1, half : half + n], out=self.table[p, :n])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        power = np.frexp((b - a).astype(np.float64))[1] - 1
        return np.minimum(self.table[power, a + 1], self.table[power, b + 1 - np.left_shift(1, power)])


class Queue:
    """Entries (key, place, common prefix) by ranges of keys, spilled to disk when large."""

    def __init__(self, ranges: int, memory: int = MEMORY, kind: type = np.int64):
        self.lists: list[list] = [[] for _ in range(ranges)]
        self.kind, self.memory, self.held, self.file, self.spills = kind, memory, 0, None, 0

    def put(self, at: np.ndarray, entries: np.ndarray) -> None:
        """Append the columns of ``entries`` (3 x n) to the ranges ``at`` in their order."""
        order = np.argsort(at, kind="stable")
        at, entries = at[order], entries[:, order]
        cuts = np.flatnonzero(np.diff(at)) + 1
        for r, part in zip(at[np.concatenate(([0], cuts))].tolist(), np.split(entries, cuts, axis=1)):
            self.lists[r].append(part)
        self.held += entries.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        # The running task's own scratch, gone when it is closed; nothing else reads it.
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        self.spills += 1
        for parts in self.lists:
            if held := [p for p in parts if isinstance(p, np.ndarray)]:
                block = np.concatenate(held, axis=1)
                parts[:] = [p for p in parts if not isinstance(p, np.ndarray)] + [(self.file.tell(), block.shape[1])]
                self.file.write(np.ascontiguousarray(block).tobytes())
        self.held = 0

    def take(self, r: int) -> np.ndarray:
        parts, self.lists[r] = self.lists[r], []
        out = [np.zeros((3, 0), self.kind)]
        for p in parts:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                out.append(np.frombuffer(self.file.read(3 * out[0].itemsize * p[1]), self.kind).reshape(3, -1))
            else:
                self.held -= p.nbytes
                out.append(p)
        return np.concatenate(out, axis=1)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _run_ends(text: np.ndarray, kind: type) -> np.ndarray:
    """For every place the place after its run of equal symbols."""
    change = np.flatnonzero(text[1:] != text[:-1]) + 1
    ends = np.append(change, len(text)).astype(kind)
    return np.repeat(ends, np.diff(np.concatenate(([0], ends))))


class Level:
    """A text at one level of the recursion: symbols 0 .. n_symbols - 1, the bytes each stands for,
    and the common prefix in bytes of each symbol with the one before it (None: zero)."""

    def __init__(self, text: np.ndarray, n_symbols: int, sizes: np.ndarray | None, steps: np.ndarray | None, memory: int):
        # Places, keys and common prefixes are of one type.
        self.kind = _whole(max(2 * n_symbols, len(text) if sizes is None else int(sizes[text].sum())) + 1)
        self.none = np.iinfo(self.kind).max
        self.text, self.n_symbols, self.memory = text, n_symbols, memory
        self.sizes = None if sizes is None else sizes.astype(self.kind)
        if steps is not None and len(steps) and steps.max() <= np.iinfo(np.int32).max:
            steps = steps.astype(np.int32)  # the table has a row for every power of two
        self.least_step = None if steps is None else RangeMinimum(steps)
        self.ends = _run_ends(text, self.kind)
        follow = text[np.minimum(self.ends, len(text) - 1)]
        self.s_type = text < follow
        self.s_type[-1] = True
        self.queue_spills = 0

    def size(self, symbols: np.ndarray):
        return 1 if self.sizes is None else self.sizes[symbols]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix in bytes of different symbols."""
        if self.least_step is None:
            return np.zeros(len(a), np.int64)
        return self.least_step(np.minimum(a, b), np.maximum(a, b))

    def at_border(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes a and b that are of different type or first symbol."""
        text = self.text
        x, y = text[a], text[b]
        out = np.zeros(len(a), np.int64)
        other = x != y
        out[other] = self.apart(x[other], y[other])
        same = np.flatnonzero(~other)
        if len(same):  # one symbol, different types: they differ where the shorter run ends
            a, b = a[same], b[same]
            run = np.minimum(self.ends[a] - a, self.ends[b] - b)
            out[same] = run * self.size(x[same]) + self.apart(text[a + run], text[b + run])
        return out

    def induce(self, wanted: np.ndarray, seeds: np.ndarray, prefixes: np.ndarray, flip: bool) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes of the ``wanted`` type in order and their common prefixes with the one
        before. ``seeds`` are the sorted suffixes of the other type that a wanted one comes before.
        ``flip``: everything in descending order."""
        text, top, kind, none = self.text, self.n_symbols - 1, self.kind, self.none
        seeds, prefixes = seeds.astype(kind), prefixes.astype(kind)

        def key(places: np.ndarray) -> np.ndarray:  # wanted ones come before seeds of their symbol
            symbols = text[places].astype(kind)
            return 2 * (top - symbols if flip else symbols)

        counts = np.bincount(text[wanted], minlength=self.n_symbols) + np.bincount(text[seeds], minlength=self.n_symbols)
        if flip:
            counts = counts[::-1]
        range_of = (np.cumsum(counts) - counts) // BLOCK
        range_of = np.unique(range_of, return_inverse=True)[1]  # symbol (in order of taking) -> range
        n_ranges = int(range_of[-1]) + 1
        queue = Queue(n_ranges, self.memory, kind)
        seed_keys = key(seeds) + 1
        seed_cuts = np.searchsorted(range_of[seed_keys >> 1], np.arange(n_ranges + 1))
        # By symbol: the batch of its last entry and the least prefix taken in that batch since;
        # by batch: the least prefix taken in all batches after it.
        last_batch, rest_least = np.full(self.n_symbols, -1), np.full(self.n_symbols, none, kind)
        after, batch = np.full(1024, none, kind), 0
        out_places, out_prefixes = [], []
        last = last_key = -1  # the suffix taken last
        since_wanted = none
        width = 1 << 12
        for r in range(n_ranges):
            own = slice(seed_cuts[r], seed_cuts[r + 1])
            waiting = np.concatenate([queue.take(r), np.stack([seed_keys[own], seeds[own], prefixes[own]])], axis=1)
            waiting = waiting[:, np.argsort(waiting[0], kind="stable")]
            later: list[np.ndarray] = []  # entries put into this range past the sorted head
            begun = 0
            while begun < waiting.shape[1] or later:
                head, begun = waiting[:, begun : begun + width], begun + width
                bound = waiting[0, begun] if begun < waiting.shape[1] else none
                if later:
                    new = np.concatenate(later, axis=1)
                    now = new[0] < bound
                    later = [] if now.all() else [new[:, ~now]]
                    head = _inserted(head, new[:, now])
                done, window, batches = 0, 1 << 12, 0
                while done < head.shape[1]:
                    keys, places, prefix = head[:, done : done + window]
                    left = np.maximum(places - 1, 0)
                    puts = wanted[left] & (places > 0)
                    put_keys = np.where(puts, key(left), kind(none))
                    # Nothing taken may have a larger key than something put in before it was taken.
                    stop = keys > np.minimum.accumulate(put_keys)
                    n = int(stop.argmax()) or len(keys)
                    if n < len(keys):
                        keys, places, prefix, puts, put_keys, left = keys[:n], places[:n], prefix[:n], puts[:n], put_keys[:n], left[:n]
                    window = min(max(4 * n, 256), 1 << 16)
                    done, batches = done + n, batches + 1
                    # Common prefix with the suffix taken before; carried values hold between entries of one key.
                    prefix = prefix.copy()
                    border = np.flatnonzero(keys[1:] != keys[:-1]) + 1
                    if keys[0] != last_key:
                        border = np.concatenate(([0], border))
                    if len(border):
                        before = places[border - 1]
                        if border[0] == 0:
                            before[0] = last
                        if last < 0:
                            border, before = border[1:], before[1:]
                            prefix[0] = 0
                        if len(border):
                            prefix[border] = self.at_border(before, places[border])
                    # Results: the prefix between consecutive wanted ones is the least over those between.
                    is_wanted = np.flatnonzero((keys & 1) == 0)
                    if len(is_wanted):
                        final = is_wanted[-1] + 1
                        values = np.minimum.reduceat(prefix[:final], np.concatenate(([0], is_wanted[:-1] + 1)))
                        values[0] = min(values[0], since_wanted)
                        out_places.append(places[is_wanted])
                        out_prefixes.append(values)
                        since_wanted = prefix[final:].min() if final < n else none
                    else:
                        since_wanted = min(since_wanted, prefix.min())
                    at = np.flatnonzero(puts)
                    if len(at):
                        entries = self._entries(left[at], put_keys[at], at, prefix, last_batch, rest_least, after, batch)
                        near = entries[0] < bound
                        if not near.all():
                            far, entries = entries[:, ~near], entries[:, near]
                            ranges = range_of[far[0] >> 1]
                            here = ranges == r
                            if here.any():
                                later.append(far[:, here])
                                far, ranges = far[:, ~here], ranges[~here]
                            if len(ranges):
                                queue.put(ranges, far)
                        if entries.shape[1]:
                            other = range_of[entries[0] >> 1] != r  # past the range's last waiting entry
                            if other.any():
                                queue.put(range_of[entries[0, other] >> 1], entries[:, other])
                                entries = entries[:, ~other]
                            if entries.shape[1]:
                                head, done = _inserted(head[:, done:], entries), 0
                    np.minimum(after[:batch], prefix.min(), out=after[:batch])
                    batch += 1
                    if batch == len(after):
                        after = np.concatenate([after, np.full(batch, none, kind)])
                    last, last_key = int(places[-1]), int(keys[-1])
                width = min(2 * width, 1 << 16) if batches < 4 else max(width // 2, 1 << 11)
        self.queue_spills += queue.spills
        queue.close()
        if not out_places:
            return np.zeros(0, kind), np.zeros(0, kind)
        found = np.concatenate(out_prefixes)
        found[0] = 0
        return np.concatenate(out_places), found

    def _entries(self, left, keys, at, prefix, last_batch, rest_least, after, batch) -> np.ndarray:
        """Queue entries of the suffixes ``left``, which are one left of those taken at ``at`` in
        this batch, with the common prefix each has with its symbol's entry before."""
        symbols, none = self.text[left], self.none
        order = np.argsort(symbols, kind="stable")
        by, at = symbols[order], at[order]
        change = by[1:] != by[:-1]
        first, final = np.concatenate(([True], change)), np.concatenate((change, [True]))
        # Least common prefix since the symbol's last entry, in this batch or in one before it.
        since = np.empty(len(at), self.kind)
        opening, again = by[first], np.flatnonzero(~first)
        known = last_batch[opening]
        within = np.minimum.accumulate(prefix)[at[first]]
        since[first] = np.where(known < 0, none, np.minimum(np.minimum(rest_least[opening], after[known]), within))
        if len(again):
            since[again] = RangeMinimum(prefix)(at[again - 1], at[again])
        # A symbol's first entry ever has none before it; its prefix is found when it is taken.
        carried = np.where(since == none, 0, since + self.size(by))
        to_end = np.append(np.minimum.accumulate(prefix[::-1])[::-1], none)
        last_batch[by[final]], rest_least[by[final]] = batch, to_end[at[final] + 1]
        common = np.empty(len(order), self.kind)
        common[order] = carried
        return np.stack([keys, left, common])

def _inserted(entries: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``entries``, sorted by key, with ``new`` ones after those of the same key."""
    both = np.concatenate([entries, new[:, np.argsort(new[0], kind="stable")]], axis=1)
    return np.take(both, np.argsort(both[0], kind="stable"), axis=1)


def _names(level: Level, stars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the substrings at S* places, in sorted order, and the common prefix in bytes of
    each name with the one before. A substring goes on to the symbol after the run that the next
    S* place begins, so it differs from every other one by a symbol that both have."""
    text = level.text
    ends = np.append(level.ends[stars[1:]], len(text) - 1)
    ends = np.minimum(ends, len(text) - 1)
    lengths = ends - stars + 1
    bits = max(1, int(level.n_symbols).bit_length())
    per = max(1, 62 // bits)
    rank = np.zeros(len(stars), np.int64)
    active = np.arange(len(stars))
    depth = 0
    while len(active):
        word = np.zeros(len(active), np.int64)
        for k in range(per):
            inside = depth + k < lengths[active]
            symbol = text[np.minimum(stars[active] + depth + k, len(text) - 1)].astype(np.int64) + 1
            word = word << bits | np.where(inside, symbol, 0)
        order = np.lexsort((word, rank[active]))
        active, word = active[order], word[order]
        old = rank[active]
        group = np.concatenate(([True], old[1:] != old[:-1]))
        start = np.maximum.accumulate(np.where(group, np.arange(len(active)), 0))
        fresh = group | np.concatenate(([True], word[1:] != word[:-1]))
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))
        rank[active] = old + first - start
        depth += per
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(active)))
        alone = np.repeat(sizes, sizes) == 1
        active = active[~alone & (lengths[active] > depth)]
    ranks, places, names = np.unique(rank, return_index=True, return_inverse=True)
    steps = np.zeros(len(ranks), np.int64)
    steps[1:] = _walk(level, stars[places[:-1]], stars[places[1:]])
    return names, steps


def _sorted_directly(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """Base of the recursion: a short text of names, sorted in memory by doubling."""
    text, n = level.text, len(level.text)
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[:-width] = rank[width:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        width *= 2
    common = np.zeros(n, np.int64)
    common[1:] = _walk(level, order[:-1], order[1:])
    return order, common


def _walk(level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefixes in bytes of different suffixes, symbol by symbol."""
    text, out = level.text, np.zeros(len(a), np.int64)
    todo, depth = np.arange(len(a)), 0
    while len(todo):
        x, y = text[a[todo] + depth], text[b[todo] + depth]
        same = x == y
        out[todo[~same]] += level.apart(x[~same], y[~same])
        todo = todo[same]
        out[todo] += level.size(x[same])
        depth += 1
    return out


def suffix_order(
    text: np.ndarray,
    n_symbols: int,
    sizes: np.ndarray | None = None,
    steps: np.ndarray | None = None,
    memory: int = MEMORY,
    direct: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(places of all suffixes in ascending order, common prefix in bytes of each with the one
    before). ``text`` ends with its only 0."""
    if len(text) == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    level = Level(text, n_symbols, sizes, steps, memory)
    direct = DIRECT if direct is None else direct
    if sizes is not None and len(text) <= direct:
        return _sorted_directly(level)
    s_type = level.s_type
    stars = np.flatnonzero(s_type & np.concatenate(([False], ~s_type[:-1]))).astype(level.kind)
    names, name_steps = _names(level, stars)
    if len(name_steps) == len(stars):
        order = np.argsort(names)
        common = name_steps
    else:
        ends = np.append(stars[1:], len(text))
        name_sizes = np.zeros(len(name_steps), np.int64)
        if sizes is None:
            name_sizes[names] = ends - stars
        else:
            total = np.concatenate(([0], np.cumsum(sizes[text])))
            name_sizes[names] = total[ends] - total[stars]
        order, common = suffix_order(names.astype(_whole(len(name_steps))), len(name_steps), name_sizes, name_steps, memory, direct)
    del names, name_steps
    l_places, l_common = level.induce(~s_type, stars[order], common, flip=False)
    # Seeds of the second induction, from the largest down: L-type suffixes after an S-type one.
    after_s = s_type[l_places - 1] & (l_places > 0)
    at = np.flatnonzero(after_s)[::-1]
    common = np.zeros(len(at), np.int64)
    if len(at) > 1:
        common[1:] = np.minimum.reduceat(l_common[: at[0] + 1], at[:0:-1] + 1)[::-1]
    wanted = s_type.copy()
    wanted[-1] = False
    s_places, s_common = level.induce(wanted, l_places[at], common, flip=True)
    # Ascending, with the last suffix first; then merged with the L-type ones, which come first
    # under their symbol.
    s_places = np.concatenate(([len(text) - 1], s_places[::-1]))
    s_common = np.concatenate(([0, 0], s_common[:0:-1]))
    places = np.concatenate([l_places, s_places], dtype=level.kind)
    common = np.concatenate([l_common, s_common], dtype=level.kind)
    del l_places, l_common, s_places, s_common
    keys = 2 * text[places].astype(level.kind) + s_type[places]
    order = np.argsort(keys, kind="stable").astype(level.kind)
    places = places[order]
    common = common[order]
    keys = keys[order]
    border = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    common[border] = level.at_border(places[border - 1], places[border])
    common[0] = 0
    return places, common
