"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def base_quality(text):
    text = text or ""
    ws = words(text)
    n = len(ws)
    held = [line for line in text.split("\n") if WORD.search(line)]
    runs = Counter(zip(ws, ws[1:], ws[2:]))
    covered = [False] * n
    for i in range(n - 2):
        if runs[ws[i], ws[i + 1], ws[i + 2]] > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = True
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(held) - len(set(held)), sum(covered),
            n < 50 or 100 * sum(covered) > 50 * n)


def without_repeats(docs, size=13):
    """{id: (n_words, n_removed, kept text)} of (id, text) rows."""
    least = {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        w = words(text)
        for k in range(len(w) - size + 1):
            least.setdefault(tuple(w[k:k + size]), i)
    out = {}
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if least[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out[i] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    return out


def without_lines(docs, min_chars=20, min_documents=3):
    """{id: (n_lines, n_dropped, text)} of (id, text) rows with different ids."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    held = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < min_documents or max(held[key(x)]) == i]
        out[i] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) >= size:
        return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def similar_groups(docs, size, percent):
    """{id: (n_shingles, smallest id reachable)} of (id, text) rows with different ids."""
    sets = {i: shingles(text, size) for i, text in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal_data(text):
    text = text or ""

    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    return {"email": [m.span() for m in EMAIL.finditer(text)],
            "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
            "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
            "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]}


def char_classes(text):
    """The class of each character, for texts of ASCII lower letters, digits and spaces."""
    return ["space" if c == " " else "digit" if c.isdigit() else "lower" for c in text]


def reference_distance(text, corpus, split, common):
    """Jensen-Shannon distance of a text from the other texts of a corpus; ``common`` bins and one for the rest."""
    total = Counter(x for t in corpus for x in split(t))
    bins = {x for x, _ in total.most_common(common)}
    rest = Counter(x if x in bins else None for t in corpus if t != text for x in split(t))
    own = Counter(x if x in bins else None for x in split(text))
    m, n, out = sum(own.values()), sum(rest.values()), 0.0
    for x in set(own) | set(rest):
        p, q = own[x] / m, rest[x] / n
        out += sum(a * math.log2(2 * a / (p + q)) / 2 for a in (p, q) if a)
    return math.sqrt(max(out, 0))


def cuts(text, pattern, h1, h2):
    """(units, code points before the first cut, before the second)."""
    units = re.findall(pattern, text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, sum(map(len, units[:a])), sum(map(len, units[:b]))


def infilled(doc_id, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output) by lines."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n, a, b = cuts(text, r"[^\n]*\n|[^\n]+", h[0], h[1])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 50:
        return doc_id, n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return doc_id, n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def collocations(docs, longest, least, drop, top):
    """[(lang, rank, phrase, a, l, r, n, score)] of (lang, text) rows."""
    count, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        held = {p: c for p, c in f.items() if len(p) >= 2 and c >= least}
        rows = []
        for p, a in held.items():
            if any(100 * c >= drop * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, c in held.items()):
                continue
            score, cut = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out
