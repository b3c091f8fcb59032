"""Plain Python versions of the operators, over lists of (doc_id, text, ...)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def jump(key: int, shards: int) -> int:
    state, shard, ahead = key & (2**64 - 1), 0, 0
    while ahead < shards:
        shard = ahead
        state = (state * 2862933555777941757 + 1) % 2**64
        ahead = int((shard + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return shard


def shards(docs, n):
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        out.append((doc_id, len(data) + 1, zlib.crc32(data), jump(doc_id or 0, n), jump(doc_id or 0, n + 1)))
    return out


def line_key(line: str) -> str:
    return line.strip(SPACES).translate(LOWER)


def dedup(docs):
    holders = defaultdict(set)
    ids = [doc if doc is not None else float("inf") for doc, _ in docs]
    for doc, (_, text) in zip(ids, docs):
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add(doc)
    out = []
    for doc, (doc_id, text) in zip(ids, docs):
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(line_key(x)) < 10 or min(holders[line_key(x)]) == doc]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return out


def base_quality(docs):
    out = []
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = set()
        for i, window in enumerate(zip(words, words[1:], words[2:])):
            if windows[window] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        n = len(words)
        out.append(
            (
                doc_id,
                n,
                sum(map(len, words)),
                sum(c in "#*$%&|<>" for c in text),
                len(lines) - len(set(lines)),
                len(covered),
                n < 50 or 100 * len(covered) > 50 * n,
            )
        )
    return out
