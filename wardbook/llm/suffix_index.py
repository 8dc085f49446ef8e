"""The parts of repeat removal that work on bytes: anchors, and the logarithmic family of suffix arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash

#: Length of a repeat in bytes, and of the strings whose smallest hash anchors it.
LENGTH = 400
ANCHOR = 64
#: Window starts worked at once.
PIECE = 1 << 18
_PLACE = (1 << 20) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BIG = np.uint64((1 << 64) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


class Anchors:
    """Cuts texts into stretches of windows that share an anchor.

    A window is `length` bytes. Its anchor is the `anchor`-byte string in it with the smallest hash (the leftmost of equal ones), so
    equal windows have equal anchors at equal places, wherever they stand. A stretch is a run of neighbouring windows with the
    same anchor; its bytes are those of all its windows. All places and lengths are in units of `unit` bytes (1, or 4 for coded words).
    """

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR, piece: int = PIECE, unit: int = 1):
        self.length, self.anchor = length, anchor
        self.unit = unit
        self.kind = np.dtype({1: np.uint8, 4: "<u4"}[unit])
        self.width = length - anchor + 1
        self.piece = min(piece, _PLACE - length)
        self.power, self.inverse = (_powers(b, self.piece + length) for b in (_BASE, _INVERSE))

    def stretches(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(first window, windows, the anchor's place, its hash) for each stretch."""
        size = len(text) // self.unit
        for start in range(0, size - self.length + 1, self.piece):
            part = np.frombuffer(text, self.kind, min(self.piece + self.length - 1, size - start), start * self.unit)
            yield from ((start + a, n, start + p, h) for a, n, p, h in self._part(part))

    def _part(self, part: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.power[: len(part)], out=sums[1:])
        n = len(part) - self.anchor + 1
        hashes = (sums[self.anchor :] - sums[:n]) * self.inverse[:n]
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        least = self._least((hashes & ~np.uint64(_PLACE)) | np.arange(n, dtype=np.uint64))
        starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        counts = np.diff(np.append(starts, len(least)))
        places = (least[starts] & np.uint64(_PLACE)).astype(np.int64)
        return zip(starts.tolist(), counts.tolist(), places.tolist(), hashes[places].view(np.int64).tolist(), strict=True)

    def _least(self, values: np.ndarray) -> np.ndarray:
        """The smallest of each `width` values in a row, by minima towards both ends of blocks."""
        w, n = self.width, len(values)
        blocks = np.append(values, np.full(-n % w, _BIG)).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """Texts as one 32-bit hash per word; a word is a run of bytes other than 20 and 09 to 0D."""

    def __init__(self, piece: int = PIECE):
        self.piece = piece
        self.power = self.inverse = np.zeros(0, np.uint64)

    def codes(self, text: bytes) -> bytes:
        raw = np.frombuffer(text, np.uint8)
        out, start = [], 0
        while start < len(raw):
            end = min(start + self.piece, len(raw))
            if end < len(raw):  # up to the next blank, so that no word is cut
                found = _NEXT_BLANK.search(text, end)
                end = found.start() if found else len(raw)
            out.append(self._piece(raw[start:end]))
            start = end
        return b"".join(out)

    def _piece(self, part: np.ndarray) -> bytes:
        if len(self.power) < len(part):
            self.power, self.inverse = (_powers(b, len(part)) for b in (_BASE, _INVERSE))
        word = np.concatenate([[False], ~_BLANK[part], [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        first, end = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.power[: len(part)], out=sums[1:])
        hashes = (sums[end] - sums[first]) * self.inverse[first]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        return (hashes >> np.uint64(32)).astype("<u4").tobytes()


_NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def identity(content: bytes) -> tuple[int, int]:
    """128 bits that stand for a stretch's bytes, as two signed numbers."""
    digest = xxhash.xxh3_128_digest(content)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


@dataclass(slots=True)
class Entry:
    """A stretch as a suffix from its anchor on, with what stands before the anchor read backwards."""

    anchor: int
    right: bytes
    left: bytes
    place: int
    windows: int
    key: tuple[int, int]
    #: Bit t: the t-th window stands elsewhere too.
    found: int = 0

    @property
    def order(self) -> tuple[int, bytes]:
        return self.anchor, self.right

    def mark(self, left: int, right: int, length: int) -> None:
        """Another suffix agrees on `left` units before the anchor and `right` units from it on."""
        first, last = max(0, self.place - left), min(self.windows - 1, self.place + right - length)
        if first <= last:
            self.found |= ((1 << (last - first + 1)) - 1) << first


def entry(anchor: int, key: tuple[int, int], copies: int, place: int, windows: int, content: bytes, unit: int = 1) -> Entry:
    """copies: how often the stretch stands in the corpus; a second one makes all its windows repeats."""
    return Entry(anchor, content[place * unit :], content[: place * unit][::-1], place, windows, key, (1 << windows) - 1 if copies > 1 else 0)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    apart = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return n if not apart else ((apart & -apart).bit_length() - 1) >> 3


@dataclass
class Level:
    """A suffix array: entries in the order of their anchors and suffixes."""

    entries: list[Entry]
    anchors: np.ndarray = field(init=False)

    def __post_init__(self):
        self.anchors = np.fromiter((e.anchor for e in self.entries), np.int64, len(self.entries))

    def of(self, anchor: int) -> list[Entry]:
        start = int(np.searchsorted(self.anchors, anchor, "left"))
        return self.entries[start : int(np.searchsorted(self.anchors, anchor, "right"))]


class IndexFamily:
    """Suffix arrays of geometrically growing size.

    A new batch is sorted to a suffix array, merge-scanned against itself and every level for matches of `length` bytes, and
    becomes a level; while the last two levels are of the same size class, they are merged. So an entry is compared with
    log(n) levels and moved log(n) times.
    """

    #: Groups up to this size are compared pair by pair, larger ones class by class.
    PAIRS = 40

    def __init__(self, length: int = LENGTH, unit: int = 1):
        self.length, self.unit = length, unit
        self.levels: list[Level] = []

    def add(self, batch: list[Entry]) -> None:
        if not batch:
            return
        new = Level(sorted(batch, key=lambda e: e.order))
        for anchor in np.unique(new.anchors).tolist():
            fresh = new.of(anchor)
            for level in self.levels:
                if old := level.of(anchor):
                    self._match(fresh, old)
            if len(fresh) > 1:
                self._match(fresh, None)
        self.levels.append(new)
        while len(self.levels) > 1 and self._size(-2) <= self._size(-1):
            last, before = self.levels.pop(), self.levels.pop()
            # Two sorted runs: the sort merges them in one pass.
            self.levels.append(Level(sorted(before.entries + last.entries, key=lambda e: e.order)))

    def _size(self, at: int) -> int:
        return len(self.levels[at].entries).bit_length()

    def repeats(self) -> Iterator[Entry]:
        for level in self.levels:
            yield from (e for e in level.entries if e.found)

    def _match(self, fresh: list[Entry], old: list[Entry] | None) -> None:
        if len(fresh) + len(old or []) > self.PAIRS:
            self._classes(fresh + (old or []))
            return
        for i, a in enumerate(fresh):
            for b in old if old is not None else fresh[i + 1 :]:
                left, right = common(a.left, b.left) // self.unit, common(a.right, b.right) // self.unit
                if left + right >= self.length:
                    a.mark(left, right, self.length)
                    b.mark(left, right, self.length)

    def _classes(self, group: list[Entry]) -> None:
        """Windows of many suffixes with one anchor, without comparing all pairs.

        A window that starts d bytes before the anchor is repeated if another suffix agrees on d bytes to the left and on
        length - d to the right. Sorted suffixes that agree on that many bytes are neighbours, so the places where
        neighbours agree on less cut each sorted list into classes.
        """

        def cuts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            order = sorted(range(len(parts)), key=parts.__getitem__)
            agree = [0] + [common(parts[a], parts[b]) // self.unit for a, b in zip(order, order[1:], strict=False)]
            return np.array(order), np.array(agree)

        def classes(order: np.ndarray, agree: np.ndarray, least: int) -> np.ndarray:
            out = np.empty(len(order), np.int64)
            out[order] = np.cumsum(agree < least)
            return out

        lefts, rights = cuts([e.left for e in group]), cuts([e.right for e in group])
        far = np.array([e.place for e in group])
        near = far - np.array([e.windows for e in group]) + 1
        for d in range(max(0, int(near.min())), int(far.max()) + 1):
            inside = np.flatnonzero((near <= d) & (d <= far))
            if len(inside) < 2:
                continue
            both = classes(*lefts, d)[inside] * (len(group) + 1) + classes(*rights, self.length - d)[inside]
            _, which, counts = np.unique(both, return_inverse=True, return_counts=True)
            for i in inside[counts[which] > 1].tolist():
                group[i].found |= 1 << (group[i].place - d)


def runs(found: int) -> list[int]:
    """The runs of set bits as first, end, first, end, ..."""
    out, at = [], 0
    while found:
        skip = (found & -found).bit_length() - 1
        found >>= skip
        size = ((found + 1) & ~found).bit_length() - 1
        out += [at + skip, at + skip + size]
        found >>= size
        at += skip + size
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans (first, end) without overlaps; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out
