"""Plain Python forms of the operators, for small tables."""

import collections
import hashlib
import re
import zlib

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def line_dedup(rows):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line).translate(UPPER)

    below = -1 << 70
    held, keeper = collections.Counter(), {}
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            held[k] += 1
            keeper[k] = max(keeper.get(k, below), below if doc_id is None else doc_id)
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not (
            len(key(line)) >= 20 and held[key(line)] >= 3 and keeper[key(line)] != (below if doc_id is None else doc_id))]
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        found.append((doc_id, len(lines), len(lines) - len(kept), sha))
    return found


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def contaminated(rows, items, size=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add(str(item) if item is not None else None)
    found = []
    for doc_id, text in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                if k in windows:
                    hit.update(range(i, i + n))
                    names |= windows[k]
        found.append((doc_id, len(w), len(hit), sorted(names - {None})))
    return found


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def similar(a, b, percent=80):
    return 100 * len(a & b) >= percent * len(a | b)


def near_components(rows, percent=80):
    """(doc_id, size, component) by comparing all pairs; rows are nodes."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and similar(a, sets[j], percent):
                root[top(i)] = top(j)
    least = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)].append(doc_id)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(doc_id, len(s), smallest[top(i)] if s else doc_id) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def tries(rows, family=5, heads=9):
    """Rows of the prefix trie, from (conv_id, turn, role, text)."""
    def mark(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), mark(role, text), (role, text)))
    own = {c: [t for _, _, t in sorted(turns)] for c, turns in own.items()}
    members, told = collections.defaultdict(list), {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % heads
        head = c - (abs(c) % family) * (1 if c >= 0 else -1)
        path = tuple(own.get(head, [])[:h] + own[c][h:])
        told[c] = path
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, ids in members.items():
        size = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(ids) - 1) * size
            leaves[path[:d]] += path not in children
    return [(ids[0], len(path), members[path[:-1]][0] if path else None, len(ids), children[path], leaves[path], saved[path],
             hashlib.sha256(",".join(str(c) for c in ids if told[c] == path).encode()).hexdigest())
            for path, ids in members.items()]


def phrases(rows, min_count, top, longest=5, share=100):
    """(lang, rank, phrase, a, l, r, n, score) from (lang, text)."""
    total, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    found = collections.defaultdict(list)
    frequent = {key: a for key, a in f.items() if a >= min_count and len(key[1]) > 1}
    most = collections.Counter()
    for (lang, p), a in frequent.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                most[lang, p[i:i + size]] = max(most[lang, p[i:i + size]], a)
    for (lang, p), a in frequent.items():
        if most[lang, p] * 100 >= a * share:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [(lang, i, p.decode(), -a, l, r, total[lang], -score)
            for lang, all_of in found.items() for i, (score, a, p, l, r) in enumerate(sorted(all_of)[:top], 1)]


def judged_urls(pages, outcomes, two_label=("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "org.uk")):
    """(page_id, host, path, rule, verdict) from (page_id, url) and (page_id, bad)."""
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

    def parts(url):
        _, mark, rest = (url or "").partition("://")
        if not mark:
            return "", ""
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        return host.translate(UPPER), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]

    def levels(host):
        host = re.sub(r":\d*$", "", host)
        labels = host.split(".")
        if not host or re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}|\[.*\]", host):
            return host, host, host
        long = ".".join(labels[-2:]) in two_label
        return host, ".".join(labels[-3:] if long else labels[-2:]), ".".join(labels[-2:] if long else labels[-1:])

    split = [(page, *parts(url)) for page, url in pages]
    bad_of = collections.defaultdict(list)
    for page, bad in outcomes:
        bad_of[page].append(bad)
    seen = [(levels(host), max(known)) for page, host, _ in split
            if page is not None and (known := [b for b in bad_of.get(page, []) if b is not None])]
    mean = (sum(b for _, b in seen) + 1) / (len(seen) + 2)

    def shrink(at, prior_of):
        n, bad, prior = collections.Counter(), collections.Counter(), {}
        for names, b in seen:
            if names[0]:
                n[names[at]] += 1
                bad[names[at]] += b
                prior[names[at]] = prior_of(names)
        excess = sum(n[k] * (bad[k] / n[k] - prior[k]) ** 2 - prior[k] * (1 - prior[k]) for k in n)
        room = sum((n[k] - 1) * prior[k] * (1 - prior[k]) for k in n)
        rho = excess / room if room > 0 else 0
        strength = min(max(1 / rho - 1 if rho > 0 else 100.0, 1.0), 100.0)
        return {k: ((bad[k] + strength * prior[k]) / (n[k] + strength), n[k] + strength) for k in n}, strength

    suffix, s2 = shrink(2, lambda names: mean)
    domain, s1 = shrink(1, lambda names: suffix[names[2]][0])
    host_rates, s0 = shrink(0, lambda names: domain[names[1]][0])
    found = []
    for page, host, path in split:
        fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        rule = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
        named, dom, suf = levels(host)
        p, w = (host_rates[named] if named in host_rates and named else (domain[dom][0], s0) if dom in domain and named
                else (suffix[suf][0], min(s0, s1)) if suf in suffix and named else (mean, min(s0, s1, s2)))
        blocked = p - 1.96 * (p * (1 - p) / (w + 1)) ** 0.5 > 0.5
        found.append((page, host, path, rule and rule[0] + rule[1], rule[2] if rule else "block" if blocked else "allow"))
    return found
