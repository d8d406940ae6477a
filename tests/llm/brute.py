"""Plain forms of the operators' contracts."""

import re
from collections import defaultdict


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def components(nodes, links):
    """Smallest reachable node of each node."""
    home = {x: x for x in nodes}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        home[max(a, b)] = min(a, b)
    return {x: find(x) for x in home}


def shingle_links(texts, width, percent):
    """Sets by id, and all linked pairs, found by shared shingles."""
    sets = {}
    for key, text in texts:
        words = spaced(text)
        sets[key] = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    holders = defaultdict(list)
    for key, own in sets.items():
        for shingle in own:
            holders[shingle].append(key)
    shared = defaultdict(int)
    for keys in holders.values():
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return sets, links


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
