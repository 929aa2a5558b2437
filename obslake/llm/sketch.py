"""Word shingles and their fast similarity sketch (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

SHINGLE = 5
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
LONG = 64
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of 8 bytes


class Hashes(dict):
    """Word -> 64-bit hash, kept for the task; forgets all once it holds `most` words."""

    def __init__(self, most: int = 1 << 17):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) < 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = h
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: dict[bytes, int], k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text whose A-Z are lower-cased; with
    fewer than k words the whole sequence is one; without words there is none. hashes: a Hashes."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(k, len(h))
    out = np.full(len(h) - size + 1, np.uint64(size))
    for i in range(size):
        out = mixed(out * _GOLDEN + h[i:len(h) - size + 1 + i])
    return np.unique(out)


def fast_sketch(items: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set: t coordinates, two sets agree in one with
    probability equal to their Jaccard similarity.

    Round i < t throws every item into a hashed bin, with a hashed value; round t + j throws all
    items into bin j, so that every bin fills in the end. A bin keeps its least (round, value), so
    rounds past the one that fills the last bin change nothing; they are run in blocks.
    """
    out = np.full(t, _EMPTY)
    block = int(t * (np.log(t) + 2) / len(items)) + 1
    first = 0
    while first < 2 * t:
        rounds = np.arange(first, min(first + block, 2 * t), dtype=np.uint64)
        x = mixed(items[None, :] + (rounds[:, None] + np.uint64(1)) * _GOLDEN)
        bins = ((x & np.uint64(0xFFFFFFFF)) * np.uint64(t)) >> np.uint64(32)
        late = rounds >= t
        if late.any():
            bins[late] = (rounds[late] - np.uint64(t))[:, None]
        values = (rounds[:, None] << np.uint64(32)) | (x >> np.uint64(32))
        np.minimum.at(out, bins.ravel().astype(np.intp), values.ravel())
        if not (out == _EMPTY).any():
            break
        first += block
    return out


def band_keys(items: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` coordinates; the band's number is part of the key."""
    coords = fast_sketch(items, bands * rows).reshape(bands, rows)
    key = mixed((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)
    for j in range(rows):
        key = mixed(key * _GOLDEN + coords[:, j])
    return key.view(np.int64)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text in bytes, and their 64-bit hashes, all words at once: a
    round takes the next 8 bytes of each word that has some left. Words of LONG bytes or more, which
    would make many rounds, are hashed one by one."""
    space = _SPACE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[0::2], edges[1::2]
    eights = np.ndarray(len(text) + 1, "<u8", text + bytes(8), strides=(1,))  # from every byte on
    sizes = ends - starts
    out = mixed(sizes.astype(np.uint64) * _GOLDEN)
    some = np.flatnonzero(sizes < LONG)
    at, left = starts[some], sizes[some]
    while len(some):
        out[some] = mixed(out[some] * _GOLDEN + (eights[at] & _KEPT[np.minimum(left, 8)]))
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(sizes >= LONG):
        out[k] = xxhash.xxh64_intdigest(text[starts[k]:ends[k]])
    return starts, ends, out


class Words:
    """The words (A-Z lower-cased) of some texts, one text after another: their hashes, and where words,
    lines and texts begin and end, in code points of all texts joined by line feeds."""

    def __init__(self, texts: Sequence[str]):
        joined = "\n".join(texts)
        text = joined.encode("utf-8", "surrogatepass").lower()
        raw = np.frombuffer(text, np.uint8)
        starts, ends, self.hashes = word_hashes(text)
        feeds = np.flatnonzero(raw == 10)
        line_starts, line_ends = np.append(0, feeds + 1), np.append(feeds, len(raw))
        self.n = len(starts)
        self.line_first = np.searchsorted(starts, line_starts)  # the first word of each line
        self.line_count = np.diff(self.line_first, append=self.n)
        places = [starts, ends, line_starts, line_ends]
        if len(text) > len(joined):  # bytes that begin a code point, before each byte
            points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
            places = [points[p] for p in places]
        self.starts, self.ends, self.line_starts, self.line_ends = places
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offset = np.cumsum(sizes) - sizes  # the first code point of each text
        self.first = np.searchsorted(self.starts, self.offset)  # the first word of each text
        self.count = np.diff(self.first, append=self.n)


def shingle_sets(h: np.ndarray, counts: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of some runs of words, given by their hashes one after another, and the sizes of
    the sets; a run of fewer than k words is one shingle."""
    long = np.minimum(counts, k)
    many = counts - long + 1
    starts = np.cumsum(many) - many
    at = np.arange(many.sum()) + np.repeat(np.cumsum(counts) - counts - starts, many)
    words = np.repeat(long, many)
    items = words.astype(np.uint64)
    for i in range(k):
        items = np.where(i < words, mixed(items * _GOLDEN + h[np.minimum(at + i, len(h) - 1)]), items)
    for a, n in zip(starts.tolist(), many.tolist()):
        items[a:a + n].sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[starts] = True
    return items[new], np.add.reduceat(new, starts, dtype=np.int64)


def band_keys_of(items: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """band_keys() of some sets, given one after another, a row for each; rounds go on for the sets
    whose bins are not yet full."""
    t = bands * rows
    out = np.full((len(sizes), t), _EMPTY)
    owner, r = np.repeat(np.arange(len(sizes)), sizes), 0
    while len(items):
        x = mixed(items + np.uint64(((r + 1) * int(_GOLDEN)) & 0xFFFFFFFFFFFFFFFF))
        bins = ((x & np.uint64(0xFFFFFFFF)) * np.uint64(t)) >> np.uint64(32) if r < t else np.uint64(r - t)
        np.minimum.at(out.reshape(-1), owner * t + np.asarray(bins).astype(np.int64), np.uint64(r << 32) | (x >> np.uint64(32)))
        r += 1
        if r % 2 == 0:
            left = (out == _EMPTY).any(axis=1)[owner]
            items, owner = items[left], owner[left]
    key = np.broadcast_to(mixed((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _GOLDEN), (len(sizes), bands))
    coords = out.reshape(len(sizes), bands, rows)
    for j in range(rows):
        key = mixed(key * _GOLDEN + coords[:, :, j])
    return key.view(np.int64)


def set_id(items: np.ndarray) -> bytes:
    """128-bit identity of a set."""
    return xxhash.xxh3_128_digest(items.tobytes())
