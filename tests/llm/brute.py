"""Plain Python versions of what the text operators compute, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(texts, width=35):
    """(words, removed, kept text) of each text."""
    split = [words(t) for t in texts]
    places = defaultdict(list)
    for d, w in enumerate(split):
        for i in range(len(w) - width + 1):
            places[tuple(w[i:i + width])].append((d, i))
    gone = [set() for _ in split]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d].update(range(i, i + width))
    return [(len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for w, g in zip(split, gone)]


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def near_classes(texts, threshold=0.8):
    """(number of the first text in the class, links to other sets, copies) of each text."""
    sets = [shingles(t) for t in texts]
    n = len(texts)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links, copies = [set() for _ in sets], [1] * n
    for i in range(n):
        for j in range(n):
            if i == j or not sets[i] or not sets[j]:
                continue
            if sets[i] == sets[j]:
                copies[i] += 1
            elif len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-12:
                links[i].add(frozenset(sets[j]))
            else:
                continue
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(find(i), len(links[i]), copies[i]) for i in range(n)]


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def runs(w):
    """(start, length, period) of the longest stretches with smallest period q and length >= max(6, 4q), by definition."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w):
    gone = {i for s, n, q in runs(w) for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def cheapest_repair(codes):
    """(cost, audit) of the cheapest, then least, edits that make the role initials (s?(ua)+)?, by grammar state.

    `codes`: s, u, a, o (other) per turn, upper case if truncated, x if it must be deleted.
    """
    best = {("B", 0): (0, "")}

    def offer(state, i, cost, audit):
        if (state, i) not in best or (cost, audit) < best[state, i]:
            best[state, i] = cost, audit

    moves = {"B": "su", "S": "u", "A": "u", "U": "a"}
    after = {"s": "S", "u": "U", "a": "A"}
    for i in range(len(codes) + 1):
        for _ in range(3):  # inserts lead from state to state
            for state in "BSUA":
                if (state, i) in best:
                    cost, audit = best[state, i]
                    for letter in moves[state].replace("s", ""):
                        offer(after[letter], i, cost + 3, audit + "I")
        if i == len(codes):
            break
        turn = codes[i]
        for state in "BSUA":
            if (state, i) not in best:
                continue
            cost, audit = best[state, i]
            offer(state, i + 1, cost + 4, audit + "D")
            if turn == "x":
                continue
            late = 3 if turn.isupper() else 0
            for letter in moves[state]:
                if letter == turn.lower():
                    offer(after[letter], i + 1, cost + late, audit + "K")
                elif letter != "s":
                    offer(after[letter], i + 1, cost + late + 3, audit + "R")
    return min(best[state, len(codes)] for state in "BA" if (state, len(codes)) in best)
