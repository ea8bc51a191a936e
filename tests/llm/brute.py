"""Plain single-process versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np


def tokens(tokenizer, text: str | None) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def roots(nodes, links) -> dict:
    """The smallest node that each node reaches."""
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {node: find(node) for node in nodes}


def shingles(text: str | None) -> frozenset:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_groups(rows: list[tuple]) -> dict:
    """(n_shingles, component) by doc_id, from all pairs that share a shingle."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    having = defaultdict(list)
    for doc_id, found in sets.items():
        for shingle in found:
            having[shingle].append(doc_id)
    shared: dict = defaultdict(int)
    for docs in having.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                shared[a, b] += 1
    links = [
        pair for pair, n in shared.items()
        if 100 * n >= 75 * (len(sets[pair[0]]) + len(sets[pair[1]]) - n)
    ]
    component = roots(sets, links)
    return {doc_id: (len(sets[doc_id]), component[doc_id]) for doc_id in sets}


def exact_groups(rows: list[tuple]) -> dict:
    """(keep_id, group_size, digest) by doc_id."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id))
    found = {}
    for text, members in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        for _, doc_id in members:
            found[doc_id] = (min(members)[1], len(members), digest)
    return found


def similar_vectors(rows: list[tuple], cosine: float = 0.95) -> dict:
    """(n_links, component) by vec_id."""
    valid = [
        (i, np.array(v, dtype=np.float64)) for i, v in rows
        if v and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all() and any(v)
    ]
    links = []
    for k, (i, v) in enumerate(valid):
        for j, w in valid[k + 1 :]:
            if len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= cosine:
                links.append((i, j))
    component = roots([i for i, _ in rows], links)
    n_links = defaultdict(int)
    for i, j in links:
        n_links[i] += 1
        n_links[j] += 1
    return {i: (n_links[i], component[i]) for i, _ in rows}


_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    doubled = [sum(divmod(2 * d, 10)) for d in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def base_spans(text: str | None) -> str:
    found = []
    text = text or ""
    for kind, pattern in (("email", _EMAIL), ("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for match in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and not all(int(part) <= 255 for part in match[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{match.start()}:{match.end()}")
    return ",".join(found)


def url_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def url_rule(host: str, path: str, rules) -> tuple[str | None, str | None]:
    fitting = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fitting, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


def whole(vector) -> list[int] | None:
    """floor(256 * c) of a usable vector."""
    if vector is None or any(c is None or not np.isfinite(c) for c in vector):
        return None
    return [int(np.floor(256 * np.float64(np.float32(c)))) for c in vector]


def _scored(rows, query):
    """(score, id, label) of all other rows of the query's length, best first."""
    vec_id, x = query
    found = [
        (sum(a * b for a, b in zip(x, y, strict=True)), other, kind)
        for other, y, kind in rows
        if other != vec_id and len(x) == len(y)
    ]
    return sorted(found, key=lambda f: (-f[0], f[1]))


def top_k(rows: list[tuple], k: int = 5) -> list[tuple]:
    """(query_id, rank, vec_id, score) from rows (vec_id, vector)."""
    usable = [(i, whole(v), None) for i, v in rows if i is not None and whole(v) is not None]
    return sorted(
        (i, rank, other, score)
        for i, x, _ in usable if i % 50 == 0
        for rank, (score, other, _) in enumerate(_scored(usable, (i, x))[:k], 1)
    )


def hard_negatives(rows: list[tuple]) -> list[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from (vec_id, vector, label)."""
    usable = [(i, whole(v), c) for i, v, c in rows if i is not None and c is not None and whole(v) is not None]
    found = []
    for i, x, label in usable:
        if i % 50:
            continue
        scored = _scored(usable, (i, x))
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p]
            found += [(i, positive, rank, n, p, s) for rank, (s, n, _) in enumerate(fits[:3], 1)]
    return sorted(found)
