"""Plain Python versions that the operators are held against."""

import re

W = re.compile("[^\x20\x09-\x0D]+")


def fold(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeimnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def brute_contamination(text, items):
    term = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, hit, found = term.findall(fold(text)), set(), set()
    for item, t in items:
        v = term.findall(fold(t))
        for s in range(max(1, len(v) - 12) if v else 0):
            g = v[s:s + 13]
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)
