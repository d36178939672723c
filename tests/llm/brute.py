"""The same results by plain Python on one machine, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(folder, name, *columns):
    table = pq.read_table(f"{folder}/{name}.parquet", columns=list(columns))
    return list(zip(*(table.column(c).to_pylist() for c in columns), strict=True))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def mix_targets(rows):
    sizes = Counter()
    for source, n in rows:
        sizes[source] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    target = dict.fromkeys(order, 0.0)
    open_ = set(order)
    left = total
    while open_ and left > 1e-9:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + share * weight[s] >= 2 * sizes[s]}
        if not full:
            for s in open_:
                target[s] += share * weight[s]
            break
        for s in open_:
            gain = share * weight[s]
            target[s] = min(2 * sizes[s], target[s] + gain)
        left = total - sum(target.values())
        open_ -= full
    return sizes, target


def nearest(rows, k=20):
    good, seen = {}, set()
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        seen.add(len(v))
        good[i] = np.array(v, np.float32).astype(np.float64)
    if not good:
        return {}
    dim = Counter(len(v) for v in good.values()).most_common(1)[0][0]
    good = {i: v for i, v in good.items() if len(v) == dim}
    ids = np.array(sorted(good))
    matrix = np.array([good[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        scores = matrix @ good[q]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def judge_url(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = lower(host)
    fits = [
        (len(h) + len(p), len(h), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def records(rows):
    least = {}
    for page, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            least[raw] = min(page, least.get(raw, page))
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        first = least.get(raw) if len(raw) >= 100 and page is not None else page
        again = page is not None and first is not None and first != page
        out.append(
            (page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None)
        )
    return out


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(5)), strict=False))


def near_groups(rows, percent=85):
    """{doc_id: component} and the set sizes of the rows; rows of one id are one vertex."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    holders = defaultdict(list)
    for at, (_, s) in enumerate(known):
        for x in s:
            holders[x].append(at)
    for at, (i, s) in enumerate(known):
        shared = Counter(j for x in s for j in holders[x] if j < at)
        for j, both in shared.items():
            other, t = known[j]
            if 100 * both >= percent * (len(s) + len(t) - both):
                a, b = root(i), root(other)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}, [(i, len(s)) for i, s in sets]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def leaf_digest(*values):
    parts = []
    for v in values:
        raw = None if v is None else str(v).encode()
        parts.append(b"-" if raw is None else str(len(raw)).encode() + b":" + raw)
    return hashlib.sha256(b"".join(parts)).hexdigest()


def joined_digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_root(leaves, at=None, new=None, arity=8):
    """Root of a list of digests; with ``at``, also the siblings of that leaf and the root if it were ``new``."""
    proof, now = [], new
    while len(leaves) > 1:
        if at is not None:
            lo = at - at % arity
            run = leaves[lo : lo + arity]
            others = run[: at - lo], run[at - lo + 1 :]
            proof += others[0] + others[1]
            now = joined_digest([*others[0], now, *others[1]])
            at //= arity
        leaves = [joined_digest(leaves[i : i + arity]) for i in range(0, len(leaves), arity)]
    return leaves[0], proof, now


def manifest(rows):
    """Rows of op11 from ``doc_id, source, lang, n_chars, text``."""
    trees = defaultdict(list)
    for doc, source, lang, n, text in rows:
        leaf = leaf_digest(doc, source, lang, n, text)
        chosen = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        other = leaf_digest(doc, source, lang, n, None if text is None else lower(text)) if chosen else leaf
        trees[lang].append((doc is not None, doc or 0, leaf, doc, other))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    leaves = {t: sorted(trees[t]) for t in order}
    subroots = [merkle_root([x[2] for x in leaves[t]])[0] for t in order]
    out = []
    for k, t in enumerate(order):
        for i, (_, _, leaf, doc, other) in enumerate(leaves[t]):
            _, low, now = merkle_root([x[2] for x in leaves[t]], i, other)
            root, high, now = merkle_root(subroots, k, now)
            out.append((doc, leaf, subroots[k], root, joined_digest(low + high), now, now == root))
    return out


def planted(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def runs(words):
    """All runs by trying every period."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p) and j > i:
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def periodic(doc, text):
    words = planted(doc, WORD.findall(text or ""))
    all_ = runs(words)
    gone = {i for s, length, p in all_ for i in range(s + p, s + length)}
    best = min(all_, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in all_)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = best[0] is not None and 1000 * best[1] // best[2]
    return doc, len(all_), *best, None if best[0] is None else milli, joined_digest([listed]), joined_digest([kept])


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    grams = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def print_groups(rows, radius=3):
    """``doc_id, fingerprint, component`` of ``doc_id, text`` by comparing all fingerprints."""
    prints = [fingerprint(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, p) for (i, _), p in zip(rows, prints, strict=True) if i is not None]
    for at, (i, p) in enumerate(known):
        for j, q in known[:at]:
            if (p ^ q).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [(i, f"{p:016x}", None if i is None else root(i)) for (i, _), p in zip(rows, prints, strict=True)]
