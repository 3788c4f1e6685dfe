"""Language-model scores by a hierarchical Pitman-Yor model of the bytes of words.

A text is its words, lower-cased in A-Z and joined by single spaces, then an end symbol. Every byte
is a customer in the restaurant of the six bytes before it. A restaurant's parent forgets the
oldest byte of the context, so restaurants that end alike share one; the last parent is uniform
over 256 bytes. With c customers and t tables for a byte and C, T in the whole restaurant,

    P(byte) = (c - d t + (s + d T) P_parent(byte)) / (s + C)

and every table is a customer of the parent. Seating is sampled by Gibbs: all customers of a byte
get up and sit down again, each at a table in proportion to its customers less d, or at a new one
in proportion to (s + d T) P_parent. As predictions only know how many tables there are, who sits
where is summed out and the tables of the whole row are drawn at once, so a sweep moves every
customer, however many a row has. The numbers of seatings are exact up to 512 customers and right
to about one part in a hundred beyond. The probability of a byte is averaged over several seatings
after a burn-in.

How the work is dealt: chunks of documents send the distinct seven-byte strings they hold, with
training counts, to buckets by the two bytes before the last. All restaurants whose contexts end
in those two bytes are in that bucket, so a bucket seats its whole subtree by itself, given the
256 x 256 probabilities of the trunk (contexts of one and no byte); tables of the bucket's topmost
restaurants are the customers of the trunk. Buckets and trunk are seated in turn: what the trunk
says changes the tables below it, and those seat the trunk anew. The trunk is sampled like the
rest, so each of the averaged seatings of a bucket stands on another seating of the trunk. A bucket
returns the probability of every string that a chunk asked for, also of those that no training text
has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_strings, store, text_slices

ORDER = 7                 # bytes of a string: context and byte
SHARED = 3                # shortest strings of a bucket: two context bytes and the byte
DISCOUNT = (0.0, 0.2, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8)  # by length of the string
STRENGTH = 1.0
BURN_IN, SAMPLES, BETWEEN = 8, 3, 2
FIRST_ROUND = 3           # sweeps of a round that only feeds the trunk
ROUNDS = 2                # such rounds, the first over a uniform trunk
BUCKET_BYTES = 16 << 20   # of text for each bucket
AT_ONCE = 1 << 18         # bytes of text in work at a time; some dozen arrays of eight bytes each
PENDING = 1 << 19         # keys that wait to be merged
SPACE, END = 32, 10
SEED = 11
EXACT = 512               # customers up to whom the ways to seat them are tabulated
FEW = 32                  # customers up to whom all numbers of tables are weighed
STEPS = 2                 # Metropolis steps of a row with more
PASSES = 2                # draws of all rows in a step, each under new gamma numbers
ROWS_AT_ONCE = 1 << 15    # rows weighed at a time


# ---- strings of a text ---------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each begins; nulls are empty."""
    texts = plain_strings(column)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seven-byte string at every byte, the text it is in, and the tokens of each text.

    The last byte is lowest; before the start of a text stand zeros.
    """
    raw, offsets = text_bytes(column)
    n = len(column)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    # A text takes its bytes, one end symbol, and zeros that keep it from the one before.
    pad = ORDER
    out = np.zeros(len(raw) + n * (pad + 1), np.uint8)
    out[np.arange(len(raw)) + owner * (pad + 1) + pad] = _LOWER[raw]
    ends = np.cumsum(size + pad + 1) - 1
    holder = np.repeat(np.arange(n), size + pad + 1)
    head = np.arange(len(out)) - np.repeat(ends - size - pad, size + pad + 1)
    blank = _BLANK[out]
    inside = head >= pad
    inside[ends] = False
    word = inside & ~blank
    before = np.zeros(len(out), bool)
    before[1:] = word[:-1]
    n_words = np.bincount(holder[word & ~before], minlength=n)
    out[blank & inside] = SPACE
    out[ends] = END
    keep = ~inside | word | before
    out, holder, inside = out[keep], holder[keep], inside[keep]
    # A space is only between words: the one before an end goes.
    trailing = np.zeros(len(out), bool)
    trailing[:-1] = (out[:-1] == SPACE) & inside[:-1] & (out[1:] == END) & ~inside[1:]
    out, holder, inside = out[~trailing], holder[~trailing], inside[~trailing]
    symbol = inside | (out == END)
    return _rolled(out)[symbol], holder[symbol], n_words + 1


def _rolled(out: np.ndarray) -> np.ndarray:
    """Each byte with the six before it, by doubling."""
    one = out.astype(np.uint64)
    two = one.copy()
    two[1:] |= one[:-1] << np.uint64(8)
    four = two.copy()
    four[2:] |= two[:-2] << np.uint64(16)
    seven = four.copy()
    seven[4:] |= (four[:-4] & np.uint64(0xFFFFFF)) << np.uint64(32)
    return seven


def bucket_of(found: np.ndarray, buckets: int) -> np.ndarray:
    """By the two bytes before the last, mixed."""
    key = (found >> np.uint64(8)) & np.uint64(0xFFFF)
    mixed = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Sorted strings by their differences."""
    return zlib.compress(np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
                         .tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class Gathered:
    """Distinct keys with summed counts, of arrays that come one after another.

    Those pending are merged whenever they are many, so little more than the distinct is held.
    """

    def __init__(self):
        self.keys, self.counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.pending = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.pending += len(keys)
        if self.pending > max(PENDING, len(self.keys[0]) // 2):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        self.keys, self.counts = [], []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        del order
        new = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        first = np.flatnonzero(new)
        del new
        self.keys = [keys[first]]
        self.counts = [np.add.reduceat(counts, first) if len(first) else counts]
        self.pending = 0
        return self.keys[0], self.counts[0]


# ---- seating -------------------------------------------------------------------------------


@lru_cache(maxsize=None)
def _exact_ways(discount: float) -> np.ndarray:
    """log S(c, t) for up to EXACT customers: the ways to seat c at t tables, each weighted by its
    tables' sizes (generalised Stirling numbers). -inf where there is none."""
    ways = np.full((EXACT + 1, EXACT + 2), -np.inf)
    ways[1, 1] = 0.0
    t = np.arange(1, EXACT + 2)
    with np.errstate(divide="ignore"):
        for c in range(1, EXACT):
            stay = np.log(np.maximum(c - discount * t, 0)) + ways[c, 1:]
            ways[c + 1, 1:] = np.logaddexp(ways[c, :-1], stay)
    return ways


def _saddle_ways(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log S(c, t) / c! by a saddle point of ((1 - (1 - x)^d) / d)^t / t! in x, with its width."""
    target = np.log(c / t)
    low, high = target / (1 - d), (target - np.log(d)) / (1 - d)
    y = (low + high) / 2  # -log(1 - x)
    for _ in range(6):
        e, f = np.exp(-y), np.exp(-d * y)
        value = np.log(d) + np.log1p(-e) - np.log1p(-f) + (1 - d) * y
        slope = e / (1 - e) + (1 - d) - d * f / (1 - f)
        y = np.clip(y - (value - target) / slope, np.maximum(low, 1e-9), high)
    e, f = np.exp(-y), np.exp(-d * y)
    slope = e / (1 - e) + (1 - d) - d * f / (1 - f)
    width = c * slope * (1 - e) / e
    return t * np.log((1 - f) / d) - c * np.log1p(-e) - 0.5 * np.log(width) - _log_factorial(t)


LOG_FACTORIALS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 256)))])


def _log_factorial(n: np.ndarray) -> np.ndarray:
    n = n.astype(float)
    many = np.maximum(n, 255)
    series = (many + 0.5) * np.log(many) - many + 0.5 * np.log(2 * np.pi) + 1 / (12 * many) - 1 / (360 * many ** 3)
    return np.where(n < 256, LOG_FACTORIALS[np.minimum(n, 255).astype(np.int64)], series)


@lru_cache(maxsize=None)
def _saddle_error(discount: float) -> np.ndarray:
    """What the saddle point lacks at EXACT customers, by tables; it hardly moves beyond."""
    t = np.arange(1, EXACT // 2 + 1)
    error = _exact_ways(discount)[EXACT, t] - _saddle_ways(np.full(len(t), float(EXACT)), t, discount)
    return np.concatenate([error[:1], error]) - error[-1]


def log_ways(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) up to a term of c alone, for 1 <= t <= c."""
    out = np.empty(len(c))
    few = c <= EXACT
    out[few] = _exact_ways(discount)[c[few], t[few]]
    lacks = _saddle_error(discount)
    c, t = c[~few], t[~few]
    # Everybody alone has no saddle point and no choice either.
    inner = np.minimum(t, c - 1)
    out[~few] = _saddle_ways(c.astype(float), inner, discount) + lacks[np.minimum(t, len(lacks) - 1)]
    return out


class Seating:
    """Tables of the rows (context, byte) of one length. Rows of a restaurant are neighbours."""

    def __init__(self, restaurant: np.ndarray, parent: np.ndarray, discount: float):
        self.restaurant, self.parent, self.discount = restaurant, parent, discount
        self.n_restaurants = restaurant.max(initial=-1) + 1
        self.c = np.zeros(len(restaurant), np.int64)
        self.size = np.zeros(0, np.int64)
        self._index(np.zeros(0, np.int64))

    def _index(self, owner: np.ndarray) -> None:
        self.owner = owner
        self.t = np.bincount(owner, minlength=len(self.c))
        self.first = np.concatenate([[0], np.cumsum(self.t)])

    def open(self, c: np.ndarray, t: np.ndarray, random: np.random.Generator) -> None:
        """Seat everybody anew: t tables of c customers, the sizes drawn at random."""
        self.c = c.copy()
        self._index(np.repeat(np.arange(len(c)), t))
        weight = random.gamma(1 - self.discount, size=len(self.owner)) + 1e-12
        share = weight / np.bincount(self.owner, weight, len(c))[self.owner]
        self.size = 1 + np.floor(share * (c - t)[self.owner]).astype(np.int64)
        left = c - np.bincount(self.owner, self.size, len(c)).astype(np.int64)
        some = t > 0
        self.size[self.first[:-1][some]] += left[some]

    def probability(self, above: np.ndarray) -> np.ndarray:
        """Predictive probability of every row, given that of its byte in the parent."""
        whole_c = np.bincount(self.restaurant, self.c, self.n_restaurants)[self.restaurant]
        whole_t = np.bincount(self.restaurant, self.t, self.n_restaurants)[self.restaurant]
        d = self.discount
        return (self.c - d * self.t + (STRENGTH + d * whole_t) * above) / (STRENGTH + whole_c)

    def stand_up(self, rows: np.ndarray, random: np.random.Generator) -> None:
        """A random customer of each of these rows leaves."""
        upto = np.cumsum(self.size)
        start = np.concatenate([[0], upto])[self.first[rows]]
        pick = start + (random.random(len(rows)) * self.c[rows]).astype(np.int64)
        self.size[np.searchsorted(upto, pick, side="right")] -= 1
        self.c[rows] -= 1
        open_ = self.size > 0
        if not open_.all():
            self.size = self.size[open_]
            self._index(self.owner[open_])

    def sit_down(self, rows: np.ndarray, above: np.ndarray, random: np.random.Generator) -> None:
        """A customer comes to each of these rows."""
        d = self.discount
        whole_t = np.bincount(self.restaurant, self.t, self.n_restaurants)[self.restaurant[rows]]
        at_table = self.c[rows] - d * self.t[rows]
        new = (STRENGTH + d * whole_t) * above[rows]
        draw = random.random(len(rows)) * (at_table + new)
        fresh = (draw >= at_table) | (self.t[rows] == 0)
        old = rows[~fresh]
        if len(old):
            upto = np.cumsum(self.size - d)
            start = np.concatenate([[0], upto])[self.first[old]]
            at = np.searchsorted(upto, start + draw[~fresh], side="right")
            at = np.clip(at, self.first[old], self.first[old + 1] - 1)
            self.size[at] += 1
        self.c[rows] += 1
        opened = rows[fresh]
        if len(opened):
            self.size = np.insert(self.size, self.first[opened + 1], 1)
            self._index(np.insert(self.owner, self.first[opened + 1], opened))

    def follow(self, c: np.ndarray, above: np.ndarray, random: np.random.Generator) -> None:
        """Customers come and go until every row has c of them: tables below opened or closed."""
        while len(rows := np.flatnonzero(self.c < c)):
            self.sit_down(rows, above, random)
        while len(rows := np.flatnonzero(self.c > c)):
            self.stand_up(rows, random)

    def reseat(self, above: np.ndarray, random: np.random.Generator) -> None:
        """One Gibbs step in every row that has a choice."""
        rows = np.flatnonzero(self.c > 1)
        if len(rows):
            self.stand_up(rows, random)
            self.sit_down(rows, above, random)


class Seating:
    """Tables of the rows (context, byte) of one length. Rows of a restaurant are neighbours.

    Who sits where is summed out: t tables for the c customers of a row have a probability in
    proportion to S(c, t) times (s + d T') P_parent for each table, T' being those there before it.
    """

    def __init__(self, restaurant: np.ndarray, parent: np.ndarray, discount: float):
        self.restaurant, self.parent, self.discount = restaurant, parent, discount
        self.n_restaurants = restaurant.max(initial=-1) + 1
        self.c = np.zeros(len(restaurant), np.int64)
        self.t = np.zeros(len(restaurant), np.int64)

    @property
    def owner(self) -> np.ndarray:
        """The row of every table."""
        return np.repeat(np.arange(len(self.c)), self.t)

    @property
    def size(self) -> np.ndarray:
        """Customers of every table in one of the seatings that are summed out."""
        size = np.ones(self.t.sum(), np.int64)
        some = self.t > 0
        size[(np.cumsum(self.t) - self.t)[some]] += (self.c - self.t)[some]
        return size

    def open(self, c: np.ndarray, t: np.ndarray, random: np.random.Generator) -> None:
        """t tables for c customers, whatever was there."""
        self.c, self.t = c.copy(), t.copy()

    def probability(self, above: np.ndarray) -> np.ndarray:
        """Predictive probability of every row, given that of its byte in the parent."""
        whole_c = np.bincount(self.restaurant, self.c, self.n_restaurants)[self.restaurant]
        whole_t = np.bincount(self.restaurant, self.t, self.n_restaurants)[self.restaurant]
        d = self.discount
        return (self.c - d * self.t + (STRENGTH + d * whole_t) * above) / (STRENGTH + whole_c)

    def follow(self, c: np.ndarray) -> None:
        """Every row has c customers now: tables below opened or closed. `reseat` comes next."""
        self.c, self.t = c, np.clip(self.t, np.minimum(c, 1), c)

    def reseat(self, above: np.ndarray, random: np.random.Generator) -> None:
        """One Gibbs step: all customers of every row get up and sit down again.

        A gamma number for each restaurant, given its tables, makes its rows independent (the
        rising factorial of s / d is its integral); then t tables of a row weigh S(c, t) z^t.
        """
        d = self.discount
        rows = np.flatnonzero(self.c > 1)
        kind = np.minimum(self.c[rows], FEW + 1).astype(np.int8)
        order = np.argsort(kind, kind="stable")
        rows, kind = rows[order], kind[order]
        c, own, given = self.c[rows], self.restaurant[rows], above[rows]
        ends = np.searchsorted(kind, np.arange(2, FEW + 2))
        for _ in range(PASSES):
            whole = np.bincount(self.restaurant, self.t, self.n_restaurants)
            z = (d * random.gamma(STRENGTH / d + whole))[own] * given
            for many, (start, end) in enumerate(zip(ends[:-1], ends[1:]), 2):
                for at in range(start, end, ROWS_AT_ONCE):
                    some = slice(at, min(end, at + ROWS_AT_ONCE))
                    self.t[rows[some]] = _drawn(many, z[some], d, random)
            for at in range(ends[-1], len(rows), ROWS_AT_ONCE):
                some = slice(at, at + ROWS_AT_ONCE)
                self.t[rows[some]] = _proposed(c[some], self.t[rows[some]], z[some], d, random)


def _drawn(c: int, z: np.ndarray, d: float, random: np.random.Generator) -> np.ndarray:
    """Tables of rows that have c customers each, in proportion to S(c, t) z^t."""
    weight = np.empty((len(z), c))
    weight[:, 0] = 1.0
    weight[:, 1:] = z[:, None] * np.exp(np.diff(_exact_ways(d)[c, 1:c + 1]))
    np.cumprod(weight, axis=1, out=weight)
    np.cumsum(weight, axis=1, out=weight)
    draw = random.random(len(z)) * weight[:, -1]
    return np.minimum(1 + (weight <= draw[:, None]).sum(axis=1), c)


def _proposed(
    c: np.ndarray, t: np.ndarray, z: np.ndarray, d: float, random: np.random.Generator
) -> np.ndarray:
    """The same by Metropolis steps from t, proposals being logistic about where the weight lies."""
    # Tables are a Poisson number z (1 - w^d) / d of parts, given that the parts sum to c; w is 1 - x.
    y = np.zeros(len(c))  # -log w
    target = np.log(c / z)
    for _ in range(12):  # log(1 - w) + (1 - d) y = target rises in y
        e = np.exp(-np.maximum(y, 1e-9))
        value, slope = np.log1p(-e) + (1 - d) * y - target, e / (1 - e) + 1 - d
        y = np.maximum(y - np.clip(value / slope, -4.0 - y, 4.0 + y), 1e-9)
    w = np.exp(-y)
    mean = z * -np.expm1(-d * y) / d
    spread = np.sqrt(np.maximum(mean - c * w / (w + (1 - w) * (1 - d)), 0.25)) * 0.7
    mean = np.clip(mean, 1, c)

    def log_proposal(n: np.ndarray) -> np.ndarray:
        """Of what is rounded to n."""
        low, high = (n - 0.5 - mean) / spread, (n + 0.5 - mean) / spread
        a, b = np.abs(low), np.abs(high)
        apart = np.where(
            low * high < 0, np.log1p(-np.exp(-a - b)), np.log(-np.expm1(-1 / spread)) - np.minimum(a, b)
        )
        return apart - np.log1p(np.exp(-a)) - np.log1p(np.exp(-b))

    log_z = np.log(z)

    def worth(n: np.ndarray) -> np.ndarray:
        return log_ways(c, n, d) + n * log_z - log_proposal(n)

    now = worth(t)
    for _ in range(STEPS):
        u = random.random(len(c))
        draw = np.rint(mean + spread * (np.log(np.maximum(u, 1e-300)) - np.log1p(-u)))
        inside = (draw >= 1) & (draw <= c)
        other = np.where(inside, draw, t).astype(np.int64)
        new = worth(other)
        taken = np.log(np.maximum(random.random(len(c)), 1e-300)) < new - now
        t, now = np.where(taken, other, t), np.where(taken, new, now)
    return t


class Tree:
    """Restaurants for strings of some lengths, the longest first."""

    def __init__(self, keys: np.ndarray, lengths: range, seed: int):
        self.random = np.random.default_rng(seed)
        self.levels: list[Seating] = []
        for length in lengths:
            shorter, parent = np.unique(
                keys & np.uint64((1 << 8 * (length - 1)) - 1), return_inverse=True
            )
            # Keys are sorted, so those of a restaurant are neighbours.
            context = keys >> np.uint64(8)
            restaurant = np.cumsum(np.diff(context, prepend=context[:1]) != 0)
            self.levels.append(Seating(restaurant, parent, DISCOUNT[length]))
            keys = shorter
        self.above_top = keys  # what the topmost rows are called in the parent

    def start(self, counts: np.ndarray, above: np.ndarray) -> None:
        """First everybody of a row at one table, then all of them are seated by the predictions."""
        c = counts
        for k, level in enumerate(self.levels):
            level.open(c, (c > 0).astype(np.int64), self.random)
            if k + 1 < len(self.levels):
                c = np.bincount(level.parent, level.t, len(self.levels[k + 1].c)).astype(np.int64)
        for _ in range(2):
            self.sweep(above)

    def chances(self, above: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Probability of every longest string, and what each level's rows get from above."""
        given = []
        for level in reversed(self.levels):
            above = above if not given else above[level.parent]
            given.append(above)
            above = level.probability(above)
        return above, given[::-1]

    def sweep(self, above: np.ndarray) -> None:
        """One Gibbs step everywhere, from the longest contexts up."""
        given = self.chances(above)[1]
        for k, level in enumerate(self.levels):
            level.reseat(given[k], self.random)
            if k + 1 < len(self.levels):
                up = self.levels[k + 1]
                c = np.bincount(level.parent, level.t, len(up.c)).astype(np.int64)
                up.follow(c)

    def samples(self, above: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Burn in, then the probability of every longest string in one seating for each `above`."""
        for _ in range(BURN_IN):
            self.sweep(above[0])
        for given in above:
            for _ in range(BETWEEN):
                self.sweep(given)
            yield self.chances(given)[0]

    def averaged(self, *above: np.ndarray) -> np.ndarray:
        """The mean of some samples, over one and the same `above` or each over its own."""
        each = list(above) if len(above) > 1 else list(above) * SAMPLES
        return sum(self.samples(each)) / len(each)


# One row of probabilities for each seating of the trunk.
UNIFORM_TRUNK = np.full((1, 1 << 16), 1 / 256)


def seat_trunk(keys: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """256 x 256 probabilities of a byte after a byte in each of some seatings of the trunk.

    Its customers are the tables of the buckets; `keys` are two-byte strings, at most 65,536.
    """
    every = np.arange(1 << 16, dtype=np.uint64)
    counts = np.bincount(keys.astype(np.int64), tables, 1 << 16).astype(np.int64)
    tree = Tree(every, range(2, 0, -1), SEED)
    uniform = np.full(256, 1 / 256)
    tree.start(counts, uniform)
    return np.stack(list(tree.samples([uniform] * SAMPLES)))


# ---- Spark ---------------------------------------------------------------------------------

STRINGS, WORDS = 0, 1
PARTS = "chunk int, kind int, bucket int, keys binary, counts binary"
ANSWERS = "chunk int, kind int, keys binary, answers binary"
# The end of a text as a word; no word's hash is kept below 1.
END_WORD = np.uint64(0)
# A random number for every byte, and an odd one by which places in a word are told apart.
BYTE_NUMBERS = np.random.default_rng(SEED + 1).integers(0, 1 << 64, 256, dtype=np.uint64)
PLACE_STEP = np.uint64(0x9E3779B97F4A7C15)
# Odd multipliers for hashing keys to slots.
FACTORS = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, different ones staying different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for every token, ends included, and the text it is in.

    A word's hash is the sum of a random number of each byte times one of its place in the word.
    """
    raw, offsets = text_bytes(column)
    raw = _LOWER[raw]
    inside = ~_BLANK[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begin = offsets[:-1][np.diff(offsets) > 0]
    start[begin] = inside[begin]
    at = np.flatnonzero(inside)
    first = np.flatnonzero(start[at])
    starts = at[first]
    place = at - np.repeat(starts, np.diff(first, append=len(at)))
    places = _mixed(np.arange(1, place.max(initial=-1) + 2, dtype=np.uint64) * PLACE_STEP) | np.uint64(1)
    value = BYTE_NUMBERS[raw[at]] * places[place]
    hashes = np.add.reduceat(value, first) if len(first) else value
    keys = np.maximum(_mixed(hashes), np.uint64(1))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.arange(len(column))
    return np.concatenate([keys, np.full(len(ends), END_WORD)]), np.concatenate([owner, ends])


def _home(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    if kind == WORDS:
        return (keys % np.uint64(buckets)).astype(np.int64)
    return bucket_of(keys, buckets)


def _chunk_parts(chunked: DataFrame, buckets: int) -> DataFrame:
    """Per chunk, kind and bucket the distinct keys and how often training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {kind: Gathered() for kind in (STRINGS, WORDS)}
        chunk = None
        for part in text_slices(batches, limit=AT_ONCE):
            chunk = part.column(3)[0].as_py()
            trained = part.column(2).to_numpy(zero_copy_only=False)
            for kind, (found, owner) in (
                (STRINGS, strings(part.column(1))[:2]), (WORDS, word_keys(part.column(1)))
            ):
                for chosen, weight in ((trained[owner], 1), (~trained[owner], 0)):
                    some, n = np.unique(found[chosen], return_counts=True)
                    held[kind].add(some, n * weight)
        for kind in list(held) if chunk is not None else ():
            key, count = held.pop(kind).merged()
            home = _home(kind, key, buckets)
            for bucket in np.unique(home):
                some = home == bucket
                yield pa.record_batch([
                    pa.array([chunk], pa.int32()), pa.array([kind], pa.int32()),
                    pa.array([bucket], pa.int32()), pa.array([pack(key[some])], pa.binary()),
                    pa.array([zlib.compress(count[some].astype("<i8").tobytes(), 1)], pa.binary()),
                ], ["chunk", "kind", "bucket", "keys", "counts"])

    return chunked.mapInArrow(run, PARTS)


def _asked(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All distinct keys that chunks ask for, with their counts."""
    held = Gathered()
    for keys, counts in zip(group.column("keys"), group.column("counts")):
        held.add(unpack(keys.as_py()), np.frombuffer(zlib.decompress(counts.as_py()), "<i8"))
    return held.merged()


def _answered(group: pa.Table, keys: np.ndarray, values: np.ndarray, encode=bytes) -> pa.Table:
    """To every chunk the values of the keys it asked for, which are read again one by one."""
    found = [
        encode(values[np.searchsorted(keys, unpack(asked.as_py()))].tobytes())
        for asked in group.column("keys")
    ]
    return pa.table({
        "chunk": group.column("chunk"), "kind": group.column("kind"),
        "keys": group.column("keys"), "answers": pa.array(found, pa.binary()),
    })


def _started(keys: np.ndarray, count: np.ndarray, trunk: np.ndarray) -> tuple[Tree, list[np.ndarray]]:
    """A bucket's tree, and what each seating of the trunk gives its topmost rows."""
    tree = Tree(keys, range(ORDER, SHARED - 1, -1), SEED)
    at = tree.above_top.astype(np.int64)[tree.levels[-1].parent]
    above = [seating[at] for seating in trunk]
    tree.start(count, above[0])
    return tree, above


def _trunk_customers(parts: DataFrame, trunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the buckets' topmost restaurants by two-byte string: at most 65,536 sums."""
    shared = parts.sparkSession.sparkContext.broadcast(trunk)

    def run(group: pa.Table) -> pa.Table:
        keys, count = _asked(group)
        tree, above = _started(keys, count, shared.value)
        for _ in range(FIRST_ROUND):
            tree.sweep(above[-1])
        top = tree.levels[-1]
        tables = np.bincount(top.parent, top.t, len(tree.above_top)).astype(np.int64)
        return pa.table({"string": tree.above_top.astype(np.int64), "tables": tables})

    rows = parts.where(F.col("kind") == STRINGS).groupBy("bucket").applyInArrow(
        run, "string bigint, tables bigint"
    ).groupBy("string").agg(F.sum("tables").alias("tables")).collect()
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def _string_answers(parts: DataFrame, trunk: np.ndarray) -> DataFrame:
    """For every chunk and bucket the log10 probabilities of the chunk's strings, in order."""
    shared = parts.sparkSession.sparkContext.broadcast(trunk)

    def run(group: pa.Table) -> pa.Table:
        keys, count = _asked(group)
        tree, above = _started(keys, count, shared.value)
        log = np.log10(tree.averaged(*above)).astype("<f4")
        return _answered(group, keys, log)

    return parts.where(F.col("kind") == STRINGS).groupBy("bucket").applyInArrow(run, ANSWERS)


def _word_answers(parts: DataFrame) -> DataFrame:
    """For every chunk and bucket the training counts of the chunk's words, in order."""

    def run(group: pa.Table) -> pa.Table:
        keys, count = _asked(group)
        return _answered(group, keys, count.astype("<i8"), lambda raw: zlib.compress(raw, 1))

    return parts.where(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(run, ANSWERS)


def _word_totals(parts: DataFrame) -> tuple[int, int]:
    """Training tokens and different ones among them, ends included."""

    def run(group: pa.Table) -> pa.Table:
        _, count = _asked(group)
        return pa.table({"tokens": [int(count.sum())], "words": [int((count > 0).sum())]})

    sums = parts.where(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(
        run, "tokens bigint, words bigint"
    ).agg(F.sum("tokens"), F.sum("words")).first()
    return sums[0] or 0, sums[1] or 0


class Lookup:
    """Values by key: hash tables, each for the keys whose slot in the one before was taken."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.tables = []
        left = np.arange(len(keys))
        while len(left):
            bits = max(4, (2 * len(left)).bit_length())
            factor = FACTORS[len(self.tables) % len(FACTORS)]
            slots = np.full(1 << bits, -1, np.int32 if len(left) < 1 << 31 else np.int64)
            at = ((keys[left] * factor) >> np.uint64(64 - bits)).astype(np.int64)
            slots[at] = left
            # An empty slot repeats a key that belongs elsewhere, so it never matches.
            slots[slots < 0] = slots[at[0]]
            self.tables.append((factor, np.uint64(64 - bits), keys[slots], values[slots]))
            left = left[slots[at] != left]

    def of(self, found: np.ndarray) -> np.ndarray:
        """Values of keys; one that isn't there is an error."""
        out, todo = np.empty(len(found)), None
        for factor, shift, keys, values in self.tables:
            some = found if todo is None else found[todo]
            at = (some * factor) >> shift
            hit = keys[at] == some
            if todo is None:
                out[:] = values[at]
                todo = np.flatnonzero(~hit)
            else:
                out[todo[hit]] = values[at[hit]]
                todo = todo[~hit]
            if not len(todo):
                return out
        if len(found):
            raise ValueError("a chunk changed between two readings; store the table first")
        return out


def _table(answers: pa.Table, kind: int) -> Lookup:
    """What a chunk asked, by key."""
    some = answers.filter(pa.array([k.as_py() == kind for k in answers.column("kind")], pa.bool_()))
    keys = [unpack(b.as_py()) for b in some.column("keys")] + [np.zeros(0, np.uint64)]
    raw = [b.as_py() for b in some.column("answers")]
    if kind == WORDS:
        values = [np.frombuffer(zlib.decompress(b), "<i8") for b in raw]
    else:
        values = [np.frombuffer(b, "<f4") for b in raw]
    return Lookup(np.concatenate(keys), np.concatenate(values) if values else np.zeros(0))


RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def score(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    stored: bool = False,
) -> DataFrame:
    """Every row's score, learning from the rows where `held_out` is not true.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): `score` is the model's
    log10 probability of the text, words and end; `base_score` is that of a unigram model with
    half a count added to every word of the training texts and one unknown. Tokens are words and
    the end, known ones occur in training texts. Null and empty texts are one end; a null
    `held_out` learns. Rows repeat as they are. An empty table gives no rows.

    A chunk is a partition of a stored table, which stays the same however often it is read:
    `stored` says that `docs` is a plain scan of files, otherwise it is written first.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(~held_out, F.lit(True)).alias("trained"),
    )
    rows = rows if stored else store(rows, "scored-texts")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    chunked = rows.withColumn("chunk", F.spark_partition_id())
    parts = store(_chunk_parts(chunked, buckets), "strings")
    n, v = _word_totals(parts)
    whole = np.log10(n + 0.5 * (v + 1))
    trunk = UNIFORM_TRUNK
    for _ in range(ROUNDS):
        trunk = seat_trunk(*_trunk_customers(parts, trunk))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        logs, counts = _table(answers, STRINGS), _table(answers, WORDS)
        out = []
        for part in text_slices(texts.to_batches(), limit=AT_ONCE):
            size = part.num_rows
            found, owner, n_tokens = strings(part.column(1))
            scores = np.bincount(owner, logs.of(found), size)
            found, owner = word_keys(part.column(1))
            count = counts.of(found)
            out.append(pa.table({
                "doc_id": part.column(0),
                "held_out": pa.array(~part.column(2).to_numpy(zero_copy_only=False)),
                "n_tokens": n_tokens.astype(np.int64),
                "n_known": np.bincount(owner[count > 0], minlength=size).astype(np.int64),
                "train_tokens": np.full(size, n, np.int64),
                "base_score": np.bincount(owner, np.log10(count + 0.5) - whole, size),
                "score": scores,
            }))
        return pa.concat_tables(out) if out else EMPTY

    answers = _string_answers(parts, trunk).union(_word_answers(parts))
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, RESULT)


EMPTY = pa.table({
    "doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()),
    **{name: pa.array([], pa.int64()) for name in ("n_tokens", "n_known", "train_tokens")},
    **{name: pa.array([], pa.float64()) for name in ("base_score", "score")},
})


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, perplexity, base_perplexity) per token, over all rows of a side."""
    def of(column: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(
        of("score").alias("perplexity"), of("base_score").alias("base_perplexity")
    )
