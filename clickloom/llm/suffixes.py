"""Suffix order of a shard of text by induced sorting, with disk-backed queues.

The suffixes that start a rise after a fall (S*) are ordered first: the pieces
between them are named in order and the string of names is sorted in turn, by
the same induction, until it is short enough for prefix doubling in memory.
From them the order of all suffixes is induced, smallest first character first
for falling suffixes, then largest first for rising ones.  What is induced goes
to a priority queue whose runs lie on disk: tuples of first character, suffix
and the length of the prefix it shares with the tuple before it, which follows
from the shared lengths met since.  All tuples of one character leave the queue
together, so each step is a few array operations.

Shared lengths are cut off at ``depth``; suffixes alike so far are in any order.
The text and the ranks of the S* suffixes of the level at hand are whole arrays in
memory; the queues hold a bounded part.  Queues spill above ``QUEUE_TUPLES`` and
names are induced again above ``BASE_NAMES``, far more than an ordinary shard of
``substrings.SHARD_BYTES`` has: such a shard is sorted in memory, in one level.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples a queue keeps in memory, and names that are sorted in memory.
QUEUE_TUPLES = 4_000_000
BASE_NAMES = 16_000_000


def stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of keys that are no negative numbers; small ones are sorted by digits."""
    top = int(keys.max(initial=0))
    narrow = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int64
    return np.argsort(keys.astype(narrow), kind="stable")


class BucketQueue:
    """Rows of integers by a bucket number, given back a bucket at a time in the order they came.

    Beyond ``limit`` rows the buffer is sorted by bucket and becomes a run on
    disk.  Buckets are asked for in one direction only, so every run is read
    from one end to the other.
    """

    def __init__(self, width: int, limit: int = QUEUE_TUPLES):
        self.width, self.limit = width, limit
        self.buffer: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.runs: list[tuple] = []
        self.waiting: dict[int, list[np.ndarray]] = {}

    def push(self, buckets: np.ndarray, rows: np.ndarray) -> None:
        if not len(buckets):
            return
        order = stable_order(buckets)
        buckets, rows = buckets[order], rows[order]
        cuts = np.concatenate(([0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            self.waiting.setdefault(int(buckets[a]), []).append(rows[a:b])
        self.held += len(buckets)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        # The file has no name: it goes with the task, however that ends.
        file = tempfile.TemporaryFile()
        places, at = {}, 0
        for bucket in sorted(self.waiting):
            rows = np.concatenate(self.waiting[bucket])
            file.write(rows.astype(np.int64).tobytes())
            places[bucket] = (at, len(rows))
            at += len(rows)
        self.runs.append((file, places))
        self.waiting, self.held = {}, 0

    def pop(self, bucket: int) -> np.ndarray:
        found = []
        for file, places in self.runs:
            if bucket in places:
                at, n = places.pop(bucket)
                file.seek(at * self.width * 8)
                found.append(np.frombuffer(file.read(n * self.width * 8), np.int64).reshape(n, self.width))
        mine = self.waiting.pop(bucket, [])
        self.held -= sum(map(len, mine))
        found += mine
        return np.concatenate(found) if found else np.zeros((0, self.width), np.int64)

    def close(self) -> None:
        for file, _ in self.runs:
            file.close()


def rises(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one is not (the end is smallest)."""
    n = len(text)
    way = np.zeros(n, np.int8)
    way[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    way[-1] = -1
    at = np.where(way != 0, np.arange(n), n)
    return way[np.minimum.accumulate(at[::-1])[::-1]] > 0


def doubling(names: np.ndarray, steps: int) -> np.ndarray:
    """Ranks of the suffixes of ``names``, compared over ``2**steps`` names."""
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    for k in range(steps):
        if rank.max(initial=0) == len(rank) - 1:
            break
        ahead = np.full(len(rank), -1, np.int64)
        ahead[: max(0, len(rank) - (1 << k))] = rank[1 << k :]
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
    return rank


class Words8:
    """Eight bytes at a time from any place of a byte text, as one number."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        self.content = np.concatenate([text, np.zeros(64, np.uint8)])
        self.at8 = np.ndarray((self.n + 56,), ">u8", self.content, strides=(1,))

    def __call__(self, places: np.ndarray) -> np.ndarray:
        return self.at8[np.minimum(places, self.n + 48)].astype(np.uint64)

    def shared(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Equal leading bytes of the suffixes at ``a`` and ``b``, at most ``depth``."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for k in range(0, depth, 8):
            differ = self(a[live] + k) ^ self(b[live] + k)
            # Equal leading bytes are zero bytes at the top of the difference.
            same = np.zeros(len(live), np.int64)
            for byte in range(8):
                same += differ < np.uint64(1 << (8 * byte))
            out[live] += same
            live = live[same == 8]
        return np.minimum(np.minimum(out, depth), self.n - np.maximum(a, b))


def piece_names(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Names, in order, of the pieces between S* places.

    A piece that another continues is the larger of the two, since the other
    falls on where it rises; so pieces are filled up with the largest value.
    The last piece is followed by the end and smaller than all that it equals.
    """
    sizes = np.diff(np.append(places, len(text) - 1)) + 1
    if text.dtype == np.uint8:
        read, step, name = Words8(text), 8, np.zeros(len(places), np.int64)
        live = np.arange(len(places))
        for k in range(0, depth + 8, step):
            word = read(places[live] + k)
            more = np.clip(sizes[live] - k, 0, step).astype(np.uint64)
            fill = np.where(more >= 8, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(np.uint64(8) * more, np.uint64(63)))
            word = np.where(live == len(places) - 1, word & ~fill, word | fill)
            # Names so far are spread so that those of one name are told apart by the next bytes.
            pair = np.unique(np.stack([name[live].astype(np.uint64), word]), axis=1, return_inverse=True)[1].ravel() if k else np.unique(word, return_inverse=True)[1]
            if k:
                name = name * (len(places) + 2)
                low = np.zeros(len(places), np.int64)
                low[live] = pair + 1
                # A finished piece of the same first bytes is larger than those that go on, but for the last.
                low[sizes <= k] = len(places) + 1
                low[-1] = low[-1] if sizes[-1] > k else 0
                name = np.unique(name + low, return_inverse=True)[1].astype(np.int64)
            else:
                name[live] = pair
            live = np.flatnonzero(sizes > k + step)
            if not len(live):
                break
        return _last_first(name)
    longest = min(int(sizes.max(initial=1)), depth + 1)
    name = np.zeros(len(places), np.int64)
    top = int(text.max(initial=0)) + 1
    for k in range(longest):
        value = np.where(k < sizes, text[np.minimum(places + k, len(text) - 1)].astype(np.int64) + 1, top + 1)
        value[-1] = value[-1] if k < sizes[-1] else 0
        name = np.unique(name * (top + 2) + value, return_inverse=True)[1].astype(np.int64)
    return _last_first(name)


def _last_first(name: np.ndarray) -> np.ndarray:
    name = 2 * name + 1
    name[-1] -= 1
    return np.unique(name, return_inverse=True)[1].astype(np.int64)


def star_order(text: np.ndarray, rising: np.ndarray, depth: int, base: int, limit: int) -> np.ndarray:
    """The S* places in the order of their suffixes."""
    places = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if len(places) < 2:
        return places
    names = piece_names(text, places, depth)
    # A piece has two characters or more, so half as many names reach the depth.
    need = depth // 2 + 1
    if len(names) <= base:
        rank = doubling(names, int(np.ceil(np.log2(max(2, need)))))
        return places[np.argsort(rank, kind="stable")]
    order = np.concatenate([np.concatenate([low, high]) for _, low, _, high, _ in buckets(names, need, base, limit)])
    return places[order]


def _carried(symbols: np.ndarray, at: np.ndarray, shared: np.ndarray, since: dict[int, int]) -> np.ndarray:
    """Smallest shared length since the last tuple for the same symbol, for each new tuple.

    ``shared``: of each scanned suffix with the one before it; ``at``: which of
    them gave a tuple for which of ``symbols``.  ``since`` has the symbols met in
    this bucket so far.
    """
    order = stable_order(symbols)
    mine, place = symbols[order], at[order]
    first = np.concatenate(([True], mine[1:] != mine[:-1]))
    before = np.where(first, -1, np.concatenate(([-1], place[:-1])))
    # Minimum over (before, place]: intervals of one symbol follow one another.
    bounds = np.stack([before + 1, place + 1], axis=1).ravel()
    padded = np.append(shared, np.iinfo(np.int64).max)
    least = np.minimum.reduceat(padded, bounds)[::2]
    starts = np.flatnonzero(first)
    least[starts] = [min(int(v), since.get(int(c), 0)) for v, c in zip(least[starts], mine[starts])]
    rest_low = int(shared.min(initial=np.iinfo(np.int64).max))
    for c in since:
        since[c] = min(since[c], rest_low)
    last = np.append(starts[1:], len(mine)) - 1
    suffix_min = np.append(np.minimum.accumulate(shared[::-1])[::-1], np.iinfo(np.int64).max)
    for k in last.tolist():
        since[int(mine[k])] = int(suffix_min[place[k] + 1])
    out = np.empty(len(symbols), np.int64)
    out[order] = least
    return out


def buckets(text: np.ndarray, depth: int, base: int = BASE_NAMES, limit: int = QUEUE_TUPLES) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Suffixes by first character, smallest character first.

    (character, falling suffixes in order, their shared lengths, rising ones in
    order, their shared lengths); a shared length is that with the one before,
    the first of a list has 0.
    """
    rising = rises(text)
    stars = star_order(text, rising, depth, base, limit)
    read = Words8(text) if text.dtype == np.uint8 else None

    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if read is not None:
            return read.shared(a, b, depth)
        return np.zeros(len(a), np.int64)

    star_shared = np.concatenate(([0], pair(stars[:-1], stars[1:]))) if len(stars) else np.zeros(0, np.int64)
    symbols = np.unique(text)
    star_cut = np.searchsorted(text[stars], np.append(symbols, int(symbols[-1]) + 1)) if len(stars) else np.zeros(len(symbols) + 1, np.int64)
    queue, fallen = BucketQueue(2, limit), BucketQueue(2, limit)
    # The last suffix is the first falling one of its character.
    queue.push(text[-1:].astype(np.int64), np.array([[len(text) - 1, 0]]))

    def scan(c: int, places: np.ndarray, shared: np.ndarray, since: dict[int, int], falling: bool, out: BucketQueue) -> tuple[np.ndarray, np.ndarray]:
        """Induce from scanned suffixes; what belongs to ``c`` itself is given back."""
        at = np.flatnonzero(places > 0)
        before = places[at] - 1
        use = (rising[before] != falling) & ((text[before] >= c) if falling else (text[before] <= c))
        at, before = at[use], before[use]
        if not len(at):
            low = int(shared.min(initial=np.iinfo(np.int64).max))
            for x in since:
                since[x] = min(since[x], low)
            return before, before
        head = text[before].astype(np.int64)
        common = np.minimum(_carried(head, at, shared, since) + 1, depth)
        own = head == c
        out.push(head[~own], np.stack([before[~own], common[~own]], axis=1))
        return before[own], common[own]

    for i, c in enumerate(symbols.tolist()):
        since: dict[int, int] = {}
        rows = queue.pop(c)
        places, shared = rows[:, 0], rows[:, 1].copy()
        shared[:1] = 0
        kept, met = [], [places]
        while len(places):
            kept.append(np.stack([places, shared], axis=1))
            last = places[-1:]
            more, common = scan(c, places, shared, since, True, queue)
            if len(more):
                # The first of this round against the last of the one before.
                common[0] = pair(last, more[:1])[0]
            places, shared = more, common
            met.append(more)
        fall = np.concatenate(kept) if kept else np.zeros((0, 2), np.int64)
        fallen.push(np.full(len(fall), c), fall)
        seeds, lengths = stars[star_cut[i] : star_cut[i + 1]], star_shared[star_cut[i] : star_cut[i + 1]].copy()
        if len(seeds):
            lengths[0] = pair(fall[-1:, 0], seeds[:1])[0] if len(fall) else 0
            scan(c, seeds, lengths, since, True, queue)
    queue.close()

    queue, done = BucketQueue(2, limit), BucketQueue(2, limit)
    found: list = []
    for c in symbols[::-1].tolist():
        since = {}
        rows = queue.pop(c)
        places, shared = rows[:, 0], rows[:, 1].copy()
        shared[:1] = 0
        kept = []
        while len(places):
            kept.append(np.stack([places, shared], axis=1))
            last = places[-1:]
            more, common = scan(c, places, shared, since, False, queue)
            if len(more):
                common[0] = pair(last, more[:1])[0]
            places, shared = more, common
        rise = np.concatenate(kept) if kept else np.zeros((0, 2), np.int64)
        fall = fallen.pop(c)
        back = fall[::-1, 0]
        # Seen from the largest: each against the one after it.
        lengths = np.concatenate(([0], fall[:0:-1, 1])) if len(fall) else np.zeros(0, np.int64)
        if len(back):
            lengths[0] = pair(rise[-1:, 0], back[:1])[0] if len(rise) else 0
            scan(c, back, lengths, since, False, queue)
        up = np.stack([rise[::-1, 0], np.concatenate(([0], rise[:0:-1, 1])) if len(rise) else rise[:, 1]], axis=1)
        if read is None:
            found.append((c, fall[:, 0], fall[:, 1], up[:, 0], up[:, 1]))
        else:
            yield c, fall[:, 0], fall[:, 1], up[:, 0], up[:, 1]
    queue.close(), fallen.close(), done.close()
    yield from reversed(found)


def repeated(text: np.ndarray, size: int, base: int = BASE_NAMES, limit: int = QUEUE_TUPLES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, group number) of suffixes, in order; two are in one group when their first ``size`` bytes agree.

    Groups are numbered anew in every part, and no group is in two parts.
    """
    read = Words8(text)
    for _, fall, fall_shared, rise, rise_shared in buckets(text, size, base, limit):
        if len(fall) and len(rise):
            rise_shared = rise_shared.copy()
            rise_shared[0] = read.shared(fall[-1:], rise[:1], size)[0]
        places, shared = np.concatenate([fall, rise]), np.concatenate([fall_shared, rise_shared])
        if len(places):
            shared[0] = 0
            yield places, np.cumsum(shared < size) - 1
