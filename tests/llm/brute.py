"""Plain versions of the operators over lists of (doc_id, text), for comparison."""

import hashlib
import math
from collections import Counter

import xxhash


def words(text):
    return (text or "").encode().split()


def lm_scores(texts, alpha=0.4, least=2):
    one, two = Counter(), Counter()
    for _, t in texts:
        w = words(t)
        one.update(w)
        two.update(zip(w, w[1:]))
    total = sum(one.values())
    for doc, t in texts:
        w, score, lower = words(t), 0.0, 0
        for i, x in enumerate(w):
            if i and two[w[i - 1], x] >= least:
                score += math.log(two[w[i - 1], x] / one[w[i - 1]])
            else:
                score += math.log(one[x] / total) + (math.log(alpha) if i else 0)
                lower += i > 0
        yield doc, len(w), lower, round(score, 4)


def fingerprint(text, shingle=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = lower.encode().split()
    shingles = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    """Smallest id reachable from each of {id: value} over links of values."""
    label = {i: i for i in values}
    changed = True
    near = {i: [j for j in values if linked(values[i], values[j])] for i in values}
    while changed:
        changed = False
        for i in values:
            least = min(label[j] for j in near[i])
            if least < label[i]:
                label[i], changed = least, True
    return label


def repeats_removed(texts, size=13):
    first = {}
    for doc, t in sorted(texts):
        w = words(t)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), doc)
    for doc, t in texts:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < doc:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        yield doc, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()


def shingle_counts(text, size=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)), len(w)


def contaminated(texts, items, similarity=0.8):
    """(doc, item) with an item-sized window whose weighted shingles are similar enough."""
    found = {}
    held = {doc: set(shingle_counts(text)[0]) for doc, text in texts}
    for item, t in items:
        wanted, n = shingle_counts(t)
        for doc, text in texts:
            # Without a common shingle no window is similar at all.
            if not held[doc] & set(wanted):
                continue
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
            for i in range(max(1, len(w) - n + 1)):
                have, _ = shingle_counts(b" ".join(w[i : i + n]).decode())
                union = sum((wanted | have).values())
                if union and sum((wanted & have).values()) / union >= similarity:
                    likeness = sum((wanted & have).values()) / union
                    found[doc, item] = max(likeness, found.get((doc, item), 0))
    return found
