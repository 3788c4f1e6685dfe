"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text that isn't empty gets a leading space; among all ways to cut it into pieces (their mark
U+2581 read as a space) the one with the best path is taken, of equals the one whose last piece,
and then the one before, is shortest. A character outside the vocabulary, the mark itself
included, falls back to its UTF-8 bytes, so decoding gives back every text.

The best path of a unigram model has the largest sum of scores. Scores of a BPE model are merge
ranks, whose sum means nothing: there a path may only hold neighbours that the merges of the two
alone would leave as they are. Merges only look at neighbours, so exactly one path to each
boundary is without a fault: it is what merging the text up to there gives.

Spaces are only ever at the start of a piece, so paths always meet before a run of them: that cuts
a text into units that don't depend on each other. All distinct units of a slice, whatever their
length, are searched side by side, one position after the other. The search keeps a window of
backpointers; every few positions those of all boundaries that a later piece can still begin at
are followed back, and the ids before the boundary where they meet are final: they are committed,
and the window goes on from there.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, plain_strings, text_slices

SPACE = "▁"
# Boundaries that are searched at once, padding and room for the longest piece included.
CELLS = 1 << 19
UNSEEN = -1e18
BPE = 2
# Numbers of no piece: the start of a unit, a character that is written by its bytes, no path.
START, BYTES, NONE = -1, -2, -3
# Most pieces that may be made of the characters of those that share a rank.
MOST_TIED = 256
# No rank: greater than all of them.
NEVER = np.int64(1 << 40)


class Table:
    """Whole numbers from 0 up to whole numbers, looked up for whole arrays (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(int(2 * len(keys)).bit_length(), 4)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -1)
        at = np.flatnonzero((held != keys) & (held >= 0))
        slot = slot[at]
        while len(at):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot]
            hit = held == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (held >= 0)
            at, slot = at[on], slot[on]
        return out


def merged(text: str, ranks: dict[str, float], least: int = 1) -> list[str]:
    """A text after its merges: of all neighbours that join, those of least rank first, leftmost of
    equals. With `least` 2 a text that merges to one piece gives the two that made it."""
    parts = list(text)
    while len(parts) > least:
        joined = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        best = min(joined)
        if best == NEVER:
            break
        at = joined.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


@dataclass
class Vocabulary:
    """Pieces (with spaces for marks) with ids and scores, the ids of the 256 bytes, the bytes each
    id stands for, and whether scores are merge ranks."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    decoded: list[bytes]
    bpe: bool = False
    longest: int = field(init=False)

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        """Read a SentencePiece model file. Nothing is trained."""
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        byte_ids = [0] * 256
        pieces, decoded = {}, [b""] * size
        for i in range(size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(text[3:5], 16)
                byte_ids[value], decoded[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = text.replace(SPACE, " ")
                pieces[text], decoded[i] = (i, model.get_score(i)), text.encode()
        if len(set(byte_ids)) < 256:
            raise ValueError("the model has no byte pieces to fall back on")
        proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        return cls(pieces, byte_ids, decoded, proto.trainer_spec.model_type == BPE)

    @property
    def byte_score(self) -> float:
        """Of a byte; dearer than any piece, so that bytes are only for what no piece covers."""
        return 10 * min(min((score for _, score in self.pieces.values()), default=-1.0), -1.0)


class Encoder:
    """Searches many units at once.

    Pieces are numbered: characters first, then by falling score, so that of two merged pieces the
    one with the smaller number was made first. `ids` are -1 for characters that are no pieces.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        pieces = vocabulary.pieces
        self.byte_score = vocabulary.byte_score
        chars = sorted(set("".join(pieces)))
        merges = sorted((t for t in pieces if len(t) > 1), key=lambda t: (-pieces[t][1], t))
        symbols = chars + merges
        number = {text: k for k, text in enumerate(symbols)}
        self.size = len(symbols)
        self.ids = np.array([pieces.get(t, (-1,))[0] for t in symbols], np.int64)
        self.scores = np.array([pieces.get(t, (0, UNSEEN))[1] for t in symbols], float)
        self.alphabet = np.array([ord(c) for c in chars], np.int32)
        usable = np.array([t in pieces for t in symbols], bool)
        if vocabulary.bpe:
            usable[:len(chars)] = True
            self._index_merges(symbols, number, len(chars), usable)
        self._index_prefixes([t if keep else None for t, keep in zip(symbols, usable)])

    def _index_merges(self, symbols, number, n_chars: int, usable: np.ndarray) -> None:
        """For each two neighbours the piece they make; for each piece the two that make it.

        A piece that merging its own text does not give is never in a path. The others have to be
        of a later rank than their parts, as they are where merges were learnt one after another.
        """
        pairs, made = [], []
        ranked = {t: -self.scores[k] for t, k in number.items() if k >= n_chars}
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        for k in range(n_chars, self.size):
            text = symbols[k]
            for at in range(1, len(text)):
                if text[:at] in number and text[at:] in number:
                    pairs.append(number[text[:at]] * self.size + number[text[at:]])
                    made.append(k)
            parts = merged(text, ranked, 2)
            usable[k] = len(parts) == 2
            if usable[k]:
                self.left[k], self.right[k] = number[parts[0]], number[parts[1]]
                if max(self.left[k], self.right[k]) >= k:
                    raise ValueError(f"the model ranks {text!r} before its parts")
        self.joined = Table(np.array(pairs, np.int64), np.array(made, np.int64))
        # Pieces that share a rank (runs of spaces do) are merged by place: what is made of their
        # characters alone is looked up, each pair tried once.
        worst = max(ranked.values(), default=0)
        alike = [t for t, rank in ranked.items() if rank == worst]
        if len(set(ranked.values())) != len(ranked) - len(alike) + bool(alike):
            raise ValueError("pieces before the last rank share one")
        letters = set("".join(alike)) if len(alike) > 1 else set()
        tied = [k for k, t in enumerate(symbols) if usable[k] and set(t) <= letters]
        if len(tied) > MOST_TIED:
            raise ValueError(f"{len(tied)} pieces share a rank")
        self.tied = np.zeros(self.size + 1, bool)
        self.tied[tied] = True
        keys, apart = [], []
        for a in tied:
            for b in tied:
                keys.append(a * self.size + b)
                apart.append(merged(symbols[a] + symbols[b], ranked) == [symbols[a], symbols[b]])
        self.tied_apart = Table(np.array(keys, np.int64), np.array(apart, np.int64))

    def _index_prefixes(self, symbols: list[str | None]) -> None:
        """Prefixes of pieces as states: (state, character) to state, and the piece a state is."""
        states, steps, ends = {"": 0}, [], {}
        place = {int(p): k for k, p in enumerate(self.alphabet)}
        for k, text in enumerate(symbols):
            for end in range(1, len(text or "") + 1):
                if text[:end] not in states:
                    states[text[:end]] = len(states)
                    steps.append((states[text[:end - 1]] * len(place) + place[ord(text[end - 1])],
                                  states[text[:end]]))
            if text:
                ends[states[text]] = k
        keys, values = zip(*steps) if steps else ((), ())
        self.step = Table(np.array(keys, np.int64), np.array(values, np.int64))
        self.piece = np.full(len(states), -1, np.int64)
        self.piece[list(ends)] = list(ends.values())

    def left_alone(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the text of two pieces gives those two again.

        Merges are undone from the last one back. As long as the neighbours at the seam were not
        to be merged before the piece that is undone was made, the seam holds. Of two merges of
        one rank the left one comes first.
        """
        out = np.ones(len(left), bool)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        tied = at[self.tied[left[at]] & self.tied[right[at]]]
        out[tied] = self.tied_apart.get(left[tied] * self.size + right[tied]) > 0
        at = at[~(self.tied[left[at]] & self.tied[right[at]])]
        left, right = left[at], right[at]
        limit = np.full(len(at), NEVER)
        while len(at):
            made = self.joined.get(left * self.size + right)
            broken = (made >= 0) & (made < limit)
            out[at[broken]] = False
            # The younger of the two is undone; a character cannot be, then the other one is.
            undo_left = left > right
            undo_left = np.where(undo_left, self.right[left] != left, self.left[right] == right)
            whole = (self.right[left] == left) & (self.left[right] == right)
            limit = np.where(undo_left, left, right + 1)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
            on = ~broken & ~whole
            at, left, right, limit = at[on], left[on], right[on], limit[on]
        return out

    def search(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids of all units in order, ids per unit, widest window), units not empty and in order of
        their lengths, which share an array of characters."""
        lengths = np.array([len(u) for u in units])
        width, longest = int(lengths.max()), self.v.longest
        points = np.zeros((len(units), width), np.int32)
        inside = np.arange(width)[None, :] < lengths[:, None]
        flat = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int32)
        place = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        char = np.full((len(units), width), -1, np.int32)
        points[inside], char[inside] = flat, np.where(self.alphabet[place] == flat, place, -1)
        start = np.zeros(len(units), np.int64)     # boundary up to which ids are committed
        low, widest = 0, 0                         # first boundary of the window
        # Per boundary of the window: its last piece, that piece's length, the best score.
        last = np.full((len(units), 1), START, np.int32)
        back = np.zeros((len(units), 1), np.int32)
        best = np.zeros((len(units), 0 if self.v.bpe else 1))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        stride = 2 * longest
        for block in range(0, width, stride):
            # Room for the boundaries that pieces beginning in this block can reach.
            high = min(block + stride, width)
            more = high + longest - low + 1 - last.shape[1]
            last = np.pad(last, ((0, 0), (0, more)), constant_values=NONE)
            back = np.pad(back, ((0, 0), (0, more)))
            best = best if self.v.bpe else np.pad(best, ((0, 0), (0, more)), constant_values=UNSEEN)
            widest = max(widest, last.shape[1])
            for begin in range(block, high):
                self._extend(begin, begin - low, lengths, points, char, last, back, best)
            done = (lengths > block) & (lengths <= high)
            self._trace(np.flatnonzero(done), lengths[done], start, low, last, back, found)
            rows = np.flatnonzero(lengths > high)
            if not len(rows):
                break
            meet = self._meeting(rows, high, start, low, back)
            self._trace(rows, meet, start, low, last, back, found)
            start[rows] = meet
            first = int(meet.min())
            last, back, best = (part[:, first - low:] for part in (last, back, best))
            low = first
        row, end, number = (np.concatenate(part) for part in zip(*found))
        order = np.lexsort((end, row))
        row, end, number = row[order], end[order], number[order]
        return *self._as_ids(row, number, points[row, end - 1], len(units)), widest

    def _extend(self, begin: int, here: int, lengths, points, char, last, back, best) -> None:
        """All pieces that begin at a boundary (column `here` of the window), letter by letter."""
        from_row = int(np.searchsorted(lengths, begin, side="right"))
        rows = np.arange(from_row, len(lengths))
        state = np.zeros(len(rows), np.int64)
        for size in range(1, self.v.longest + 1):
            if size > 1:
                on = lengths[rows] >= begin + size
                rows, state = rows[on], state[on]
            if not len(rows):
                return
            letter = char[rows, begin + size - 1].astype(np.int64)
            state = np.where(letter >= 0, self.step.get(state * len(self.alphabet) + np.maximum(letter, 0)), -1)
            piece = np.where(state >= 0, self.piece[state], -1)
            if size == 1:
                # A character that is no piece by itself can always be written by its bytes.
                bare = rows[piece < 0]
                cost = self.byte_score * _utf8_length(points[bare, begin])
                self._arrive(bare, np.full(len(bare), BYTES), cost, here, 1, last, back, best)
            known = piece >= 0
            self._arrive(rows[known], piece[known], self.scores[piece[known]], here, size, last, back, best)
            on = state >= 0
            rows, state = rows[on], state[on]

    def _arrive(self, rows, piece, score, here: int, size: int, last, back, best) -> None:
        """Paths to a boundary by one more piece, kept where they are the best so far."""
        if self.v.bpe:
            keep = self.left_alone(last[rows, here].astype(np.int64), piece)
            rows, piece = rows[keep], piece[keep]
        else:
            total = best[rows, here] + score
            # Later beginnings are shorter last pieces and win ties.
            keep = total >= best[rows, here + size]
            rows, piece = rows[keep], piece[keep]
            best[rows, here + size] = total[keep]
        last[rows, here + size], back[rows, here + size] = piece, size

    @staticmethod
    def _trace(rows, ends, start, low: int, last, back, found) -> None:
        """Follow paths from `ends` to the committed boundaries; adds (unit, end, piece)."""
        at = ends.copy()
        while len(rows):
            on = at > start[rows]
            rows, at = rows[on], at[on]
            found.append((rows, at, last[rows, at - low]))
            at = at - back[rows, at - low]

    def _meeting(self, rows, high: int, start, low: int, back) -> np.ndarray:
        """Per unit the last boundary that the paths to all open boundaries share."""
        open_ends = high - np.arange(self.v.longest)
        at = np.maximum(np.broadcast_to(open_ends, (len(rows), len(open_ends))), start[rows][:, None]).copy()
        left = np.arange(len(rows))
        while len(left):
            top = at[left].max(axis=1)
            apart = at[left].min(axis=1) < top
            left, top = left[apart], top[apart]
            before = top - back[rows[left], top - low]
            at[left] = np.where(at[left] == top[:, None], before[:, None], at[left])
        return at[:, 0]

    def _as_ids(self, row, number, point, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids in order and how many each unit has, with bytes for what is no piece."""
        ids = np.where(number >= 0, self.ids[np.maximum(number, 0)], -1)
        bare = ids < 0
        size = np.where(bare, _utf8_length(point), 1)
        flat = np.repeat(ids, size)
        if bare.any():
            raw = np.frombuffer("".join(map(chr, point[bare])).encode("utf-8", "surrogatepass"), np.uint8)
            flat[np.repeat(bare, size)] = np.array(self.v.byte_ids, np.int64)[raw]
        return flat, np.bincount(row, weights=size, minlength=n).astype(np.int64)

    def unit_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, ids per unit); units are runs of spaces and what follows up to
        the next, and not empty."""
        sizes = np.array([len(u) for u in units], np.int64)
        order = np.argsort(sizes, kind="stable")
        counts, parts, at = np.zeros(len(units), np.int64), [], 0
        while at < len(units):
            # As many as fill the cells, at least one; sorted, so the last is the longest.
            room = np.arange(1, len(units) - at + 1) * (sizes[order[at:]] + self.v.longest) <= CELLS
            end = at + max(int(room.sum()), 1)
            some = order[at:end]
            flat, counts[some], _ = self.search([units[k] for k in some])
            parts.append(flat)
            at = end
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        sorted_counts = counts[order]
        starts = np.zeros(len(units), np.int64)
        starts[order] = np.cumsum(sorted_counts) - sorted_counts
        return _gathered(flat, starts, counts), counts


def _utf8_length(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + size] one after the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class Decoder:
    """The bytes of ids, gathered for whole arrays."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = np.frombuffer(b"".join(vocabulary.decoded), np.uint8)
        self.size = np.array([len(b) for b in vocabulary.decoded], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def texts(self, lists: pa.Array) -> pa.Array:
        """The texts of lists of ids: their bytes as UTF-8, without the leading space; of nulls empty.

        Bytes that are no UTF-8 (ids that no text gives) become U+FFFD.
        """
        lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        ids = values[offsets[0]:offsets[-1]]
        raw = _gathered(self.bytes, self.start[ids], self.size[ids])
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])[offsets - offsets[0]]
        # The leading space goes.
        begins, size = ends[:-1], np.diff(ends)
        lead = size > 0
        lead[lead] = raw[begins[lead]] == 32
        raw, size = _gathered(raw, begins + lead, size - lead), size - lead
        edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        whole = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(edges), pa.py_buffer(raw.tobytes())]
        )
        try:
            return whole.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in whole.to_pylist()], pa.large_string())


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of some ids."""
    return Decoder(vocabulary).texts(pa.array([list(ids)], pa.list_(pa.int32())))[0].as_py()


def _units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units, the number of units per text, and the order of texts they stand in.

    One space between words is the rule, where Arrow's split gives the units; other texts go
    through a pattern.
    """
    led = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
    odd = pc.or_(pc.match_substring(led, "  "), pc.equal(texts, ""))
    odd = odd.to_numpy(zero_copy_only=False)
    even, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
    split = pc.split_pattern(texts.take(pa.array(even)), " ")
    found = [
        re.findall(" +[^ ]*", text) if text != " " else [] for text in led.take(rest).to_pylist()
    ]
    first = split.offsets.to_numpy()
    plain = split.values.slice(first[0], first[-1] - first[0])
    plain = pc.binary_join_element_wise(
        pa.scalar(" ", texts.type), plain, pa.scalar("", texts.type)
    )
    others = pa.array([unit for units in found for unit in units], texts.type)
    counts = np.concatenate([np.diff(first), np.array([len(u) for u in found], np.int64)])
    return pa.concat_arrays([plain, others]), counts, np.concatenate([even, rest])


def _encode_slice(column: pa.Array, encoder: Encoder) -> pa.Array:
    units, counts, order = _units(plain_strings(column))
    coded = units.dictionary_encode()
    flat, size = encoder.unit_ids(coded.dictionary.to_pylist())
    code = coded.indices.to_numpy()
    lengths = size[code]
    gathered = _gathered(flat.astype(np.int32), (np.cumsum(size) - size)[code], lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gathered))
    return lists.take(pa.array(np.argsort(order)))


def encode(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids) of every row's whole text; null and empty texts have no ids.

    Repeated rows and null ids stay, other columns don't matter, and an empty table gives no rows.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for part in text_slices(batches):
            encoder = encoder or Encoder(vocabulary.value)
            yield pa.record_batch([part.column(0), _encode_slice(part.column(1), encoder)], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, text): the texts of encoded rows; null ids give an empty text.

    Repeated rows and null ids stay, and an empty table gives no rows.
    """
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = decoder.texts(part.column(1)).cast(pa.string())
                yield pa.record_batch([part.column(0), part.column(1), texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, text string"
    )
