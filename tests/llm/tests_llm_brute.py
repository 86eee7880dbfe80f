"""Near-duplicate groups by comparing all pairs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def groups(rows):
    """(doc_id, n_shingles, component_id, kept) of each row, in the rows' order."""
    sets = [frozenset(plain_set(t)) for _, t in rows]
    parent = {s: s for s in sets if s}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    different = list(parent)
    for i, a in enumerate(different):
        for b in different[:i]:
            common = len(a & b)
            if 100 * common >= 75 * (len(a) + len(b) - common):
                parent[root(a)] = root(b)
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            least[root(s)] = min(doc, least.get(root(s), doc))
    out = []
    for (doc, _), s in zip(rows, sets):
        component = least.get(root(s)) if s else doc
        out.append((doc, len(s), component, doc == component))
    return out
