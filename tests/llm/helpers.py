"""Plain Python against which the operators are held."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(UPPER))
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def grouped(ids, linked):
    """Smallest id of each component."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_texts(seed, n_groups=12, size=25):
    """Documents in groups of copies with ever more words changed, and some odd ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "of", "and", "é", "ÉT"]
    common = [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \n\t", "One", "one", "a b c d", "A B C D", "a b c d e"]
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((30, 80, 150, 300)))]
        for k in range(size):
            new = list(base)
            for _ in range(rng.randrange(1 + k % 8)):
                new[rng.randrange(len(new))] = rng.choice(vocabulary)
            texts.append((" " if k % 3 else "\n").join(common + new if k % 2 else new))
    rng.shuffle(texts)
    return texts
