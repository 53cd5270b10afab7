"""Plain versions of the operators, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(rows, percent=85):
    """id -> smallest id of its component."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (a, left) in enumerate(sets):
        for b, right in sets[n + 1 :]:
            both = len(left & right)
            if both and 100 * both >= percent * len(left | right):
                low, high = sorted((find(a), find(b)))
                up[high] = low
    return {i: find(i) for i, _ in rows}


def without_repeats(rows, size):
    """id -> (words, removed, text kept)."""
    docs = sorted((i, WORD.findall(t or "")) for i, t in rows)
    first = {}
    for i, words in docs:
        for s in range(len(words) - size + 1):
            first.setdefault(tuple(words[s : s + size]), (i, s))
    out = {}
    for i, words in docs:
        gone = set()
        for s in range(len(words) - size + 1):
            if first[tuple(words[s : s + size])] < (i, s):
                gone |= set(range(s, s + size))
        out[i] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return out


ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|"""
    r"""(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def base_digest(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text)).encode()).hexdigest()


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contamination(docs, items, size):
    """[(id, words, hit, items, ids)] in the order of ``docs``."""
    windows = {}
    for item, text in items:
        words = item_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = []
    for i, text in docs:
        words, hit, named = item_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                found = windows.get(tuple(words[s : s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    named |= found
        ids = sorted(str(x) for x in named if x is not None)
        out.append((i, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def runs(words, exponent, length):
    """[(start, end, period)]: every maximal stretch for every period, the smallest period of equal stretches."""
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= (exponent - 1) * q and j - i + q >= length:
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def without_runs(words, found):
    gone = {k for s, e, q in found for k in range(s + q, e)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)
