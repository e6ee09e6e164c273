"""Plain restatements of the contracts, for comparison on small tables."""

import re


def closure(ids, links):
    """Smallest id reachable from each id over ``links``."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def ngram_groups(docs):
    sets = {i: shingles(t) for i, t in docs}
    ids, by = sorted(sets), {}
    for i in ids:
        for s in sets[i]:
            by.setdefault(s, []).append(i)
    both = {}
    for group in by.values():
        for x, a in enumerate(group):
            for b in group[x + 1:]:
                both[a, b] = both.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    root = closure(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    """(kind number, start, end) of the base entities, by the contract's patterns as they stand."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m[0])]
