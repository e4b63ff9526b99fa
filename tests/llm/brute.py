"""Plain versions of the operators, for small tables."""

import hashlib
import re

import numpy as np
import xxhash

find = re.compile(r"[^\x20\x09-\x0D]+").findall


def quality_counts(text):
    words = find(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if find(line):
            duplicates += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), duplicates,
            len(repeated))


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = find(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=4):
    """{index: smallest id reachable} for (id, fingerprint) rows."""
    values = np.array([f for _, f in rows], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label, done = list(range(len(rows))), False
    while not done:
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(rows))]
        done, label = new == label, new
    ids = {}
    for i, root in enumerate(label):
        if rows[i][0] is not None:
            ids[root] = min(ids.get(root, rows[i][0]), rows[i][0])
    return [ids.get(root) for root in label]


def remove_repeated(docs, window=20):
    """[(id, number of words, removed, kept text)] for (id, text) rows with distinct ids."""
    first, out = {}, []
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        words = find(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in first:
                gone.update(range(i, i + window))
            else:
                first[key] = (doc, i)
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc, len(words), len(gone), " ".join(kept)))
    return out


def remove_repeated_by_place(docs, window=20):
    """[((id, text), (removed, kept text))] for rows whose ids may repeat or be missing."""
    listed = [((i is not None, i or 0), find(t or "")) for i, t in docs]
    first = {}
    for doc, words in listed:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for row, (doc, words) in zip(docs, listed):
        gone = {j for i in range(len(words) - window + 1)
                if first[tuple(words[i : i + window])] != (doc, i) for j in range(i, i + window)}
        out.append((row, (len(gone), " ".join(w for j, w in enumerate(words) if j not in gone))))
    return out


def edit_distance(pattern, text):
    """Smallest edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        previous, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(previous[j] + 1, row[j - 1] + 1, previous[j - 1] + (p != t))
    return min(row)


def permuted_digits(digits, key, tweak, rounds=8):
    """Feistel network over the two halves of a string of digits."""
    head = len(digits) // 2
    halves = [int(digits[:head]), int(digits[head:])]
    sizes = [10**head, 10 ** (len(digits) - head)]
    for number in range(rounds):
        side = number % 2
        said = f"{key}:{tweak}:{len(digits)}:{number}:{halves[1 - side]}"
        word = int(hashlib.sha256(said.encode()).hexdigest()[:15], 16)
        halves[side] = (halves[side] + word) % sizes[side]
    return f"{halves[0]:0{head}d}{halves[1]:0{len(digits) - head}d}"


def card_pseudonym(number, key):
    def check(digits):
        doubled = [int(d) * (1 + at % 2) for at, d in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10

    if check(number):
        return number
    body = permuted_digits(number[:-1], key, "card")
    return body + str(-check(body + "0") % 10)
