"""Sets of word shingles as sorted 64-bit hashes, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SHINGLE_WORDS = 5
#: Texts are hashed together in blocks of at most this many bytes; a longer text is cut at white space into pieces of
#: this size, so the work on it needs some bytes per word besides. Only a longer single word is hashed in one go.
BLOCK_BYTES = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIERS = [_U(m) for m in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACES = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")

_powers: dict[str, np.ndarray] = {}


def _geometric(name: str, base: int, count: int) -> np.ndarray:
    """The powers of ``base`` modulo 2**64; those for a block are kept from call to call."""
    if count <= BLOCK_BYTES:
        if name not in _powers or len(_powers[name]) < BLOCK_BYTES:
            _powers[name] = _new_powers(base, BLOCK_BYTES)
        return _powers[name][:count]
    return _new_powers(base, count)


def _new_powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits; one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in ``data``, which ends with white space."""
    joined = np.frombuffer(data, dtype=np.uint8)
    inside = ~_SPACE[joined]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=np.int8(0)))
    starts, ends = edges[0::2], edges[1::2]
    terms = (_LOWER[joined].astype(np.uint64) + _U(1)) * _geometric("up", _BASE, len(joined))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    down = _geometric("down", _INVERSE, len(joined))
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _U(0x2545F4914F6CDD1D))
    return words, starts


def _long_words(data: bytes) -> np.ndarray:
    """The hashes of the words of a long text, piece by piece."""
    found, start = [], 0
    while start < len(data):
        end = start + BLOCK_BYTES - 1
        if end < len(data):
            cut = max(data.rfind(space, start, end) for space in _SPACES)
            if cut < 0:  # one word fills the piece
                ahead = [data.find(space, end) for space in _SPACES]
                cut = min((x for x in ahead if x >= 0), default=len(data))
            end = cut + 1
        found.append(_words(data[start:end] + b"\n")[0])
        start = end
    return np.concatenate(found)


def _runs(words: np.ndarray) -> np.ndarray:
    """The hash of the shingle that starts at each word, as far as there are enough words."""
    count = max(0, len(words) - SHINGLE_WORDS + 1)
    runs = np.zeros(count, np.uint64)
    for k in range(SHINGLE_WORDS):
        runs += words[k : k + count] * _MULTIPLIERS[k]
    return mix(runs)


def _set(words: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The set of one text from its words and the shingles among them."""
    n = len(words)
    if n >= SHINGLE_WORDS:
        return np.unique(runs)
    if not n:
        return np.empty(0, np.uint64)
    short = sum((words[k] * _MULTIPLIERS[k] for k in range(n)), _U(0x632BE59BD9B4E019) * _U(n))
    return mix(np.array([short], np.uint64))


def _block_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    if len(texts) == 1 and len(texts[0]) >= BLOCK_BYTES:
        words = _long_words(texts[0])
        yield _set(words, _runs(words))
        return
    words, starts = _words(b"\n".join(texts) + b"\n")
    bounds = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in texts]]))
    runs = _runs(words)
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        yield _set(words[first:last], runs[first : max(first, last - SHINGLE_WORDS + 1)])


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles; empty without words.

    Words are what lies between ASCII white space, with A-Z folded; a text with fewer words than a
    shingle has one, its whole sequence.
    """
    block, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "replace") if text else b""
        if block and size + len(data) + 1 > BLOCK_BYTES:
            with np.errstate(over="ignore"):
                yield from _block_sets(block)
            block, size = [], 0
        block.append(data)
        size += len(data) + 1
    if block:
        with np.errstate(over="ignore"):
            yield from _block_sets(block)


def set_key(hashes: np.ndarray) -> int:
    """A signed 64-bit hash of a set; with the set's size it names a class of equal sets."""
    with np.errstate(over="ignore"):
        total = mix(np.array([mix(hashes ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64))
    return int(total.view(np.int64)[0])
