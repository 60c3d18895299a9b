"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def judged_url(url, rules=RULES, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, action)
        for action, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fits, default=(0, None, default))
    return host, path, rule, verdict


def edit_distance_within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def deduplicated_rows(docs, min_chars=32):
    """docs: list of (doc_id, text); every line against every earlier one. Result by (doc_id, text)."""

    def place(row):
        digest = xxhash.xxh64_intdigest((row[1] or "").encode(), seed=42)
        return row[0] is not None, row[0] or 0, digest - (1 << 64) * (digest >> 63)

    exact: set[str] = set()
    seen: list[str] = []
    out = {}
    for doc_id, text in sorted(dict.fromkeys(docs), key=place):
        kept = []
        lines = (text or "").split("\n")
        for line in lines:
            judged, near = line.strip(" \t\r") != "", len(line) >= min_chars
            gone = judged and (line in exact or near and any(edit_distance_within_one(line, s) for s in seen))
            if judged and near and line not in exact:
                seen.append(line)
            exact.add(line)
            if not gone:
                kept.append(line)
        out[doc_id, text] = (len(kept), len(lines) - len(kept), "\n".join(kept))
    return out


def deduplicated_lines(docs, min_chars=32):
    """As above for distinct ids: result by doc_id."""
    return {doc_id: found for (doc_id, _), found in deduplicated_rows(docs, min_chars).items()}


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def simhash64(text, n=3):
    w = words(text)
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_components(prints, radius=3):
    """prints: list of (doc_id, fp). Component id by id, all pairs compared."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) for i in range(len(prints))]


def edited(docs):
    """docs: list of (doc_id, text) with distinct ids. Edited text by id."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        cut = len(text) // 3
        out[doc_id] = text[: len(text) - cut] + following[:cut]
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint128(text):
    """(high, low) of weighted word pairs, a vote at a time."""
    w = words(text)
    terms = list(zip(w, w[1:], strict=False)) or [(x,) for x in w]
    out = []
    for half in (1, 2):
        votes = [0] * 64
        for term in terms:
            h = xxhash.xxh64_intdigest(half.to_bytes(4, "little"), seed=42)
            for word in term:
                h = xxhash.xxh64_intdigest(word.encode(), seed=h)
            weight = 1 + min(len("".join(term)) // 4, 7)
            for bit in range(64):
                votes[bit] += weight if h >> bit & 1 else -weight
        out.append(sum(1 << bit for bit in range(64) if votes[bit] > 0))
    return tuple(out)
