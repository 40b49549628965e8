"""Plain Python versions of the operators, for small inputs."""
import hashlib
import re
from collections import defaultdict


def lower_az(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard(docs):
    """{doc_id: (n_shingles, component_id)} of [(doc_id, text)] with distinct ids."""
    sets, u = [(i, shingles(t)) for i, t in docs], Union()
    holders = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(n)
    for n, (i, s) in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for m in holders[x]:
                if m < n:
                    common[m] += 1
        for m, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[m][1]) - c):
                u.join(sets[m][0], i)
    return {i: (len(s), u.find(i)) for i, s in sets}


def decontaminate(docs, items):
    """[(n_words, n_hit, n_items, sha, contaminated)] in the order of docs."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(t))
    win = defaultdict(set)
    for item, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            win[tuple(w[k:k + n])].add("" if item is None else str(item))
    sizes, out = {len(k) for k in win}, []
    for _, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                got = win.get(tuple(w[a:a + n]))
                if got:
                    hit |= set(range(a, a + n))
                    found |= got
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def dropped_lines(docs, min_words=8):
    """[dropped line numbers] in the order of docs; null ids last, one text per id."""
    lines = []
    for n, (i, t) in enumerate(docs):
        for k, x in enumerate((t or "").split("\n")):
            w = x.split()
            if w:
                lines.append(((i is None, i or 0, k), n, k, w))
    out = [[] for _ in docs]
    for o, n, k, w in lines:
        if any(p < o and (v == w or (min(len(v), len(w)) >= min_words and one_edit(v, w))) for p, _, _, v in lines):
            out[n].append(k)
    return out


def passages(docs, n=51):
    """Ids of documents with n words in a row that an earlier document holds."""
    holders = defaultdict(set)
    for i, t in docs:
        w = (t or "").split()
        for k in range(len(w) - n + 1):
            holders[tuple(w[k:k + n])].add(i)
    return {i for ids in holders.values() for i in ids if i != min(ids)}


_BASE = (("assign", re.compile(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                               r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
          lambda m: len(m[2]) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))


def base_secrets(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(_BASE) for m in p.finditer(text or "") if ok(m)]
    return [(name, a, b) for a, _, name, b in sorted(found)]


def best_fit(items, capacity):
    """Bin of each (size, source, cluster), searched over all open bins."""
    bins, out = [], []
    for size, source, cluster in items:
        fit = [(b["left"], n) for n, b in enumerate(bins)
               if b["left"] >= size and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        if fit:
            n = min(fit)[1]
        else:
            n = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        bins[n]["left"] -= size
        bins[n]["s"].add(source)
        bins[n]["c"].add(cluster)
        out.append(n)
    return out
