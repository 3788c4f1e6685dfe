"""Statistics of a document as a vector: sizes, character classes, repetition."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import plain_strings, words_of

CHARACTER_CLASSES = (
    "upper", "lower", "digit", "blank", "line end", "sentence mark", "shout mark", "bar",
    "symbol", "beyond ascii",
)
REPETITION = (
    "distinct words", "commonest word", "distinct word pairs", "repeated lines", "line length",
    "one-letter words",
)
BASIC = ("characters", "words", "word length", "longest word") + CHARACTER_CLASSES
FULL = BASIC + REPETITION


def _byte_class() -> np.ndarray:
    table = np.full(256, CHARACTER_CLASSES.index("symbol"), np.uint8)
    groups = {
        "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58),
        "blank": (9, 11, 12, 13, 32), "line end": (10,), "sentence mark": b".,;:'\"()-",
        "shout mark": b"!?", "bar": b"|", "beyond ascii": range(128, 256),
    }
    for name, members in groups.items():
        table[list(members)] = CHARACTER_CLASSES.index(name)
    return table


BYTE_CLASS = _byte_class()


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct_and_most(owner: np.ndarray, code: np.ndarray, codes: int, n: int):
    """Per owner how many different codes it has and how often its commonest occurs."""
    key, count = np.unique(owner * codes + code, return_counts=True)
    holder = key // codes
    most = np.zeros(n, np.int64)
    np.maximum.at(most, holder, count)
    return np.bincount(holder, minlength=n), most


def vectors(column: pa.Array, full: bool = True):
    """One row of numbers per text, and the words they came from (owner, place, distinct words).

    Null and empty texts give zeros.
    """
    texts = plain_strings(column)
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    kind = BYTE_CLASS[raw[offsets[0]:offsets[-1]]]
    size = np.diff(offsets)
    holder = np.repeat(np.arange(n), size)
    n_kinds = len(CHARACTER_CLASSES)
    classes = np.bincount(holder * n_kinds + kind, minlength=n * n_kinds).reshape(n, n_kinds)

    words = owner, place, distinct = words_of(texts)
    n_words = np.bincount(owner, minlength=n)
    length = pc.binary_length(distinct).to_numpy()[place] if len(place) else place
    letters = np.bincount(owner, weights=length, minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    parts = [np.log1p(size), np.log1p(n_words), _share(letters, n_words), np.log1p(longest)]
    parts += list(_share(classes, size[:, None]).T)
    if full:
        different, most = _distinct_and_most(owner, place, max(len(distinct), 1), n)
        inside = owner[1:] == owner[:-1]
        pair = place[:-1].astype(np.int64) * max(len(distinct), 1) + place[1:]
        _, pair = np.unique(pair[inside], return_inverse=True)
        pairs, _ = _distinct_and_most(owner[1:][inside], pair, pair.max(initial=0) + 1, n)
        split = pc.split_pattern(texts, "\n")
        first = split.offsets.to_numpy()
        n_lines = np.diff(first)
        line = split.values.slice(first[0], first[-1] - first[0]).dictionary_encode().indices
        lines, _ = _distinct_and_most(
            np.repeat(np.arange(n), n_lines), line.to_numpy(), len(line) + 1, n
        )
        parts += [
            _share(different, n_words), _share(most, n_words),
            _share(pairs, np.maximum(n_words - 1, 0)), 1 - _share(lines, n_lines),
            np.log1p(_share(n_words, n_lines)),
            _share(np.bincount(owner[length == 1], minlength=n), n_words),
        ]
    return np.stack(parts, axis=1), words
