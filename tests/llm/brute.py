"""Plain versions of the text operators, one document after the other and pair by pair."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter

import xxhash

BLANKS = " \t\n\v\f\r"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text: str | None) -> int:
    found = words(lower(text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def components(ids: list, codes: list[int], distance: int = 3) -> list:
    """For each row the smallest id of its component (None if it has none)."""
    label = list(range(len(codes)))

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                label[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(codes))]


def warc(pages: list[tuple]) -> list[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) for rows (page_id, html)."""
    groups: dict[bytes, list] = {}
    for page, html in pages:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, html in pages:
        payload = (html or "").encode()
        known = [p for p in groups[payload] if p is not None]
        revisit = len(groups[payload]) > 1 and known and page != max(known)
        out.append(
            (page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", max(known) if revisit else None)
        )
    return out


def repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, sha256 of the rest)."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def repeated_words(texts: list[str | None], length: int) -> list[int]:
    """Words in runs of `length` words that start anywhere else too."""
    cut = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in cut for i in range(len(w) - length + 1))
    return [len({k for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for k in range(i, i + length)}) for w in cut]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def joined(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def rules(text: str | None) -> tuple:
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    seen = Counter(windows)
    hit = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(found) < 50 or 100 * len(hit) > 50 * len(found)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(hit), failed


def grams(text: str | None) -> list[int]:
    raw = (text or "").encode()
    return [(int.from_bytes(raw[i : i + 4], "big") * 2654435761 % 2**32) >> 16 for i in range(len(raw) - 3)]


def ratio_scores(texts: list[str | None], trusted: list[bool]) -> list[float]:
    bags = [Counter(grams(t)) for t in texts]
    raw, target = Counter(), Counter()
    for bag, good in zip(bags, trusted, strict=True):
        raw += bag
        if good:
            target += bag
    if not target:
        return [0.0] * len(texts)
    n_raw, n_target = sum(raw.values()) + 0.5 * 65536, sum(target.values()) + 0.5 * 65536

    def score(bag: Counter) -> float:
        total = sum(n * (math.log((target[g] + 0.5) / n_target) - math.log((raw[g] + 0.5) / n_raw)) for g, n in bag.items())
        return total / sum(bag.values()) if bag else 0.0

    return [score(bag) for bag in bags]


def test_words(text: str | None) -> list[tuple[str, int, int]]:
    """(word, start, end) of the words that contamination is told by."""
    return [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))]


test_words.__test__ = False


def windows_of(items: list[tuple], size: int = 10) -> dict[tuple, set]:
    out: dict[tuple, set] = {}
    for item, text in items:
        found = [w for w, _, _ in test_words(text)]
        for i in range(max(1, len(found) - size + 1) if found else 0):
            out.setdefault(tuple(found[i : i + size]), set()).add(item)
    return out


def contamination(text: str | None, windows: dict[tuple, set]) -> tuple[int, list[int], list]:
    """(number of words, places of hit words, ids of items)."""
    found = [w for w, _, _ in test_words(text)]
    hit, items = set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(found) - size + 1):
            if (which := windows.get(tuple(found[i : i + size]))) is not None:
                hit |= set(range(i, i + size))
                items |= which
    return len(found), sorted(hit), sorted((i for i in items if i is not None), key=str)


def cleaned(text: str | None, windows: dict[tuple, set]) -> str | None:
    places = test_words(text)
    _, hit, _ = contamination(text, windows)
    gone = set()
    for k in hit:
        gone |= set(range(places[k][1], places[k][2]))
        if k + 1 in hit:
            gone |= set(range(places[k][2], places[k + 1][1]))
    return "".join(c for i, c in enumerate(text) if i not in gone) if hit else text


def chats(rows: list[tuple]) -> list[tuple]:
    """(conv_id, n_turns, n_copies, turns) of maximal conversations, from rows (conv_id, turn, role, text)."""
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text))
    first = lambda v: (v is not None, v if v is not None else 0)
    lists = {c: tuple((r, t) for _, r, t in sorted(v, key=lambda x: (first(x[0]), (x[1] is not None, x[1] or "")))) for c, v in by.items()}
    out = []
    for conv, turns in lists.items():
        equal = [c for c, t in lists.items() if t == turns]
        known = [c for c in equal if c is not None]
        longer = any(len(t) > len(turns) and t[: len(turns)] == turns for t in lists.values())
        if not longer and conv == (min(known) if known else None):
            out.append((conv, len(turns), len(equal), turns))
    return out
