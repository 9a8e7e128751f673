"""Plain versions of the exact-repeat operators, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def first_seen(sequences, window):
    """Smallest document each window starts in; sequences: (doc_id, units) in any order."""
    seen = {}
    for doc, units in sequences:
        for i in range(len(units) - window + 1):
            key = units[i : i + window]
            seen[key] = min(seen.get(key, doc), doc)
    return seen


def covered(doc, units, window, seen):
    mask = [False] * len(units)
    for i in range(len(units) - window + 1):
        if seen[units[i : i + window]] < doc:
            mask[i : i + window] = [True] * window
    return mask


def bytes_removed(rows, window=50):
    rows = [(d, (t or "").encode()) for d, t in rows]
    seen = first_seen(rows, window)
    out = []
    for doc, data in rows:
        mask = covered(doc, data, window, seen)
        spans = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        kept = bytes(b for b, m in zip(data, mask) if not m)
        out.append((doc, len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def words_removed(rows, window=13):
    rows = [(d, tuple(WORD.findall(t or ""))) for d, t in rows]
    seen = first_seen(rows, window)
    out = []
    for doc, words in rows:
        mask = covered(doc, words, window, seen)
        kept = " ".join(w for w, m in zip(words, mask) if not m)
        out.append((doc, len(words), sum(mask), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines_removed(rows, edits=2, least=24):
    """A line goes if the same one stands earlier, or one within ``edits`` edits, both long enough."""
    rows = sorted((d, (t or "").split("\n") if t else []) for d, t in rows)
    first = {}
    for doc, lines in rows:
        for i, line in enumerate(lines):
            if line:
                first.setdefault(line, (doc, i))
    by_length = {}
    for line in first:
        by_length.setdefault(len(line), []).append(line)

    def gone(line, place):
        if first[line] < place:
            return True
        for n in range(len(line) - edits, len(line) + edits + 1) if len(line) >= least else ():
            for other in by_length.get(n, ()) if n >= least else ():
                if first[other] < place and sum(a != b for a, b in zip(sorted(line), sorted(other))) < len(line):
                    if near(line, other, edits):
                        return True
        return False

    out = []
    for doc, lines in rows:
        stay = [line for i, line in enumerate(lines) if not line or not gone(line, (doc, i))]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def near(a, b, edits):
    """Edit distance at most ``edits``, after equal ends are cut off."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return max(len(a), len(b)) <= 60 and edit_distance(a, b) <= edits if a and b else max(len(a), len(b)) <= edits
