"""Plain versions of the operators' rules, for small tables."""

import re


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, n=5):
    found = words(text, lower=True)
    if len(found) < n:
        return {tuple(found)} if found else set()
    return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)}


def near_components(rows, n=5):
    """{row index: smallest id of its component} by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    tested = set()
    for group in holders.values():
        for k, i in enumerate(group):
            for j in group[k + 1:]:
                if (i, j) not in tested:
                    tested.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                        parent[find(j)] = find(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        if key is not None:
            least[root] = min(least.get(root, key), key)
    return {i: least.get(find(i)) if sets[i] else rows[i][0] for i in range(len(rows))}


def repeated_words(texts, window=35):
    """(n_words, kept words) of each text."""
    split = [words(t) for t in texts]
    starts = {}
    for i, found in enumerate(split):
        for a in range(len(found) - window + 1):
            starts.setdefault(tuple(found[a:a + window]), []).append((i, a))
    gone = [set() for _ in split]
    for places in starts.values():
        if len(places) > 1:
            for i, a in places:
                gone[i].update(range(a, a + window))
    return [(len(f), [w for k, w in enumerate(f) if k not in g]) for f, g in zip(split, gone)]


def quality_counts(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def contaminated(docs, items):
    """{(doc_id, item_id): (first word, similarity)} over all windows of all documents."""
    from collections import Counter

    out = {}
    for doc_id, text in docs:
        found = words((text or "").lower())
        grams = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
        for item_id, sought in items:
            item = words((sought or "").lower())
            if len(item) < 5 or not grams:
                continue
            wanted = Counter(tuple(item[i:i + 5]) for i in range(len(item) - 4))
            for start in range(max(len(found) - len(item), 0) + 1):
                window = Counter(grams[start:start + len(item) - 4])
                both = sum((window & wanted).values())
                similarity = both / (sum(window.values()) + sum(wanted.values()) - both)
                if similarity >= 0.8 and similarity > out.get((doc_id, item_id), (0, 0))[1]:
                    out[doc_id, item_id] = (start, similarity)
    return out


BASE_RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def luhn(digits):
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    keep = {
        "email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        "phone": lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    return [(kind, *m.span()) for kind, rule in BASE_RULES.items() for m in re.finditer(rule, text or "") if keep[kind](m[0])]
