"""SimHash of the chunks of one text at many chunk lengths, each word hashed once.

The bit votes of a chunk are the difference of two running sums over the words of the
text; only words that a chunk's edge cuts are hashed anew, and those only in chunks that may be wanted.  Bits equal those of
``functions.simhash`` (md5, single words): words are ``[a-z0-9_]+`` of the bytes with ASCII
letters lower-cased.  A text is handled in slices, so its length doesn't bound memory.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np

from .simhash import NO_FEATURES_HASH

_WORD = re.compile(rb"[a-z0-9_]+")
SLICE_BYTES = 1 << 20
BLOCK_CHUNKS = 1 << 14    # chunks whose votes are taken at a time (4 MB of counts)
CACHE_WORDS = 200_000

try:  # ship the code with the tasks
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass


class WordBits:
    """The 64 bits of a word's hash, lowest first; remembers words until it is full."""

    def __init__(self):
        self.known: dict[bytes, bytes] = {}

    def rows(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        get, out = self.known.get, []
        for w in words:
            h = get(w)
            if h is None:
                h = self.known[w] = hashlib.md5(w).digest()[7::-1]
            out.append(h)
        raw = np.frombuffer(b"".join(out), np.uint8).reshape(len(words), 8)
        return np.unpackbits(raw, axis=1, bitorder="little")

    def signs(self, words: list[bytes]) -> np.ndarray:
        """1 for a set bit, -1 for another."""
        return 2 * self.rows(words).view(np.int8) - 1


def _vote(lead: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Fingerprints from the words for each bit less those against it, and the number of words."""
    return np.where(n > 0, _packed(lead >= 0).view(np.int64), NO_FEATURES_HASH)


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def _edges(text: bytes, which: np.ndarray, lo: np.ndarray, hi: np.ndarray, votes: np.ndarray, words: np.ndarray,
           bits: WordBits) -> None:
    """Add the parts ``text[lo:hi]`` of cut words to the votes of the chunks ``which`` (each once)."""
    if len(which):
        votes[which] += bits.signs([text[a:b] for a, b in zip(lo.tolist(), hi.tolist())])
        words[which] += 1


def chunk_hashes(content: bytes, lengths: np.ndarray, bits: WordBits,
                 maybe: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(numbers of lengths, chunk numbers, fingerprints)`` of the chunks at all ``lengths`` (ascending,
    distinct), in blocks of ``BLOCK_CHUNKS``.

    All lengths from the text's own on have the same single chunk: it comes once, with the number of
    the first of them.  The others are answered together from one running sum, so the cost follows
    the number of chunks, not the number of lengths.

    ``maybe(numbers of lengths, ones, zeros)`` says which chunks (but for the whole text) are wanted, from the bits that
    are 1, and 0, whatever the at most two cut words of a chunk add; the others are left out, their cut words unhashed.
    """
    text = content.lower()  # of bytes: ASCII letters only
    n = len(text)
    below = int(np.searchsorted(lengths, n))
    whole = below < len(lengths)          # the text as one chunk
    all_lead, all_words = np.zeros(64, np.int64), 0
    steps = lengths[:below].astype(np.int64)
    longest = int(steps[-1]) if below else 0
    for a in range(0, n, SLICE_BYTES):
        b = min(n, a + SLICE_BYTES)       # chunks that start in [a, b)
        end = min(n, b + longest)
        found = list(_WORD.finditer(text, _word_start(text, a), _word_end(text, end)))
        starts = np.array([m.start() for m in found], np.int64)
        ends = np.array([m.end() for m in found], np.int64)
        kind = np.int16 if len(found) < 32_000 else np.int32      # a chunk has the slice's words at most, and two
        sums = np.zeros((len(found) + 1, 64), kind)
        if found:
            np.cumsum(bits.signs([m[0] for m in found]), axis=0, out=sums[1:], dtype=kind)
        if whole:                         # words that start in [a, b)
            x, y = np.searchsorted(starts, [a, b]) if b < n else (np.searchsorted(starts, a), len(found))
            all_lead += sums[y] - sums[x]
            all_words += int(y - x)
        first = -(-a // steps)
        upto = np.cumsum(-(-b // steps) - first)
        for at in range(0, int(upto[-1]) if below else 0, BLOCK_CHUNKS):
            row = np.arange(at, min(at + BLOCK_CHUNKS, int(upto[-1])))
            number = np.searchsorted(upto, row, "right")
            chunk = row - np.where(number > 0, upto[number - 1], 0) + first[number]
            lo = chunk * steps[number]
            hi = np.minimum(lo + steps[number], n)
            i = np.searchsorted(starts, lo, "left")      # words from here on start inside
            j = np.searchsorted(ends, hi, "right")       # words before this end inside
            words = np.maximum(j - i, 0)
            votes = sums[np.maximum(i, j)] - sums[i]
            if maybe is not None:
                keep = np.nonzero(maybe(number, _packed(votes >= 2), _packed(votes < -2)))[0]
                if not len(keep):
                    continue
                number, chunk, lo, hi, i, j, words, votes = (v[keep] for v in (number, chunk, lo, hi, i, j, words, votes))
            if found:
                # what an edge cuts: a word that goes on from before, or beyond the end
                last = np.maximum(i - 1, 0)
                left = np.nonzero((i > 0) & (ends[last] > lo))[0]
                _edges(text, left, lo[left], np.minimum(ends[last[left]], hi[left]), votes, words, bits)
                # a word that starts before the chunk (one longer than it) is no right part
                after = np.minimum(j, len(found) - 1)
                right = np.nonzero((j < len(found)) & (starts[after] < hi) & (j >= i))[0]
                _edges(text, right, starts[after[right]], hi[right], votes, words, bits)
            yield number, chunk, _vote(votes, words)
    if whole and n:
        yield np.array([below]), np.array([0]), _vote(all_lead[None, :], np.array([all_words]))


def _word_start(text: bytes, at: int) -> int:
    while 0 < at < len(text) and _WORD.match(text, at - 1, at):
        at -= 1
    return at


def _word_end(text: bytes, at: int) -> int:
    m = _WORD.match(text, at) if at < len(text) else None
    return m.end() if m else at
