"""Plain versions of the operators, for tests."""

import re


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_components(texts, n, percent):
    sets, root = {i: shingles(t, n) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def contaminated(text, items, span=8):
    words = plain_words(text)
    grams = {n: {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} for n in range(1, span + 1)}
    for item in items:
        y = plain_words(item)
        n = min(span, len(y))
        if n and any(tuple(y[j : j + n]) in grams[n] for j in range(len(y) - n + 1)):
            return True
    return False
