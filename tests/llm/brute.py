"""Plain one-machine versions of the operators, to hold them against."""

import hashlib
import math
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def white_words(text):
    return WHITE_WORD.findall(text or "")


def measured(text):
    """n_words, word_chars, n_symbols, n_marks, n_lines, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = white_words(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WHITE_WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(re.findall(r"[!?]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(hit),
    )


def deduplicated(docs, least=50):
    """{id: text without the lines of later copies} for {id: text}; ids in order, texts may be None."""
    places = defaultdict(list)
    for d, text in docs.items():
        if text is None:
            continue
        lines = text.split("\n")
        n = [len(white_words(line)) for line in lines]
        runs = set()
        for i in range(len(lines)):
            for step in (1, -1):
                total, j = 0, i
                while 0 <= j < len(lines):
                    total += n[j]
                    if total >= least:
                        runs.add((min(i, j), max(i, j)))
                        break
                    j += step
        for i, j in runs:
            places["\n".join(lines[i : j + 1])].append((d, i, j))
    gone = defaultdict(set)
    order = {d: k for k, d in enumerate(docs)}
    for found in places.values():
        first = min((order[d], i) for d, i, _ in found)
        for d, i, j in found:
            if (order[d], i) > first:
                gone[d].update(range(i, j + 1))
    return {
        d: text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[d])
        for d, text in docs.items()
    }


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, size=10):
    """n_words, n_hit, sorted item ids for a text and [(item id, text)]."""
    words = item_words(text)
    hit, found = set(), set()
    for item, own in items:
        own = item_words(own)
        for k in range(max(1, len(own) - size + 1)) if own else ():
            window = own[k : k + size]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)
KINDS = ("assign", "access", "hex", "owned")


def secrets(docs):
    """Per row (id, source, text): base spans and all spans as text."""
    base, more, owners = [], [], defaultdict(set)
    for _, source, text in docs:
        text = text or ""
        own = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        own += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        own += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        own.sort()
        base.append(own)
        more.append([
            (m.start(), 3, m.end(), m[0])
            for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text)
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
            and not any(m.start() < x[2] and x[0] < m.end() for x in own)
        ])
        for x in base[-1] + more[-1]:
            owners[x[3]].add(source)
    listed = lambda spans: ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e, _ in sorted(spans))
    return [
        (
            *(sum(x[1] == k for x in own) for k in range(3)),
            hashlib.sha256(listed(own).encode()).hexdigest(),
            listed(own + [x for x in extra if len(owners[x[3]]) == 1]),
        )
        for own, extra in zip(base, more)
    ]


def shingles(text):
    words = white_words((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_groups(rows):
    """Per row (id, text): set size and least id of the component, by all pairs that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    holders = defaultdict(list)
    for n, own in enumerate(sets):
        for x in own:
            holders[x].append(n)
    shared = Counter((a, b) for own in holders.values() for i, b in enumerate(own) for a in own[:i])
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(b)] = root(a)
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(n)] = min(doc_id, least.get(root(n), doc_id))
    return [(len(own), least.get(root(n))) for n, own in enumerate(sets)]


def backoff(texts, order=2, least=2, alpha=0.4):
    """Summed logarithms per text."""
    counts = Counter()
    texts = [white_words((t or "").translate(LOWER)) for t in texts]
    for words in texts:
        for n in range(1, order + 1):
            counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    total = sum(map(len, texts))

    def score(words, i):
        penalty = 0.0
        for n in range(min(order, i + 1), 1, -1):
            gram = tuple(words[i - n + 1 : i + 1])
            if counts[gram] >= least:
                return penalty + math.log(counts[gram] / counts[gram[:-1]])
            penalty += math.log(alpha)
        return penalty + math.log(counts[(words[i],)] / total)

    return [sum(score(words, i) for i in range(len(words))) for words in texts]
