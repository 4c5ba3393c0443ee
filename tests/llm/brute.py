"""Plain Python versions of the operators' contracts, for comparison on small tables."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

S = re.compile(r"[^\x20\x09-\x0D]+")
DW = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EMPTY = hashlib.sha256(b"").hexdigest()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def simhash(text):
    w = S.findall((text or "").translate(LOW))
    if not w:
        return 0
    g = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op1(docs):
    fps = [simhash(t) for _, t in docs]
    comp = list(range(len(docs)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                comp[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return [(d, f"{fps[i]:016x}", low.get(root(i))) for i, (d, _) in enumerate(docs)]


def op2(docs, items, n=10):
    win = {}
    for item, text in items:
        w = DW.findall((text or "").translate(LOW))
        if w:
            k = min(n, len(w))
            for i in range(len(w) - k + 1):
                win.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for d, text in docs:
        w = DW.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for k in {len(x) for x in win}:
            for i in range(len(w) - k + 1):
                if (t := tuple(w[i : i + k])) in win:
                    hit |= set(range(i, i + k))
                    found |= win[t]
        found.discard(None)
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def op3(docs, n=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone) if not g))))
    return out


def op4(docs):
    out = []
    for d, text in docs:
        text = text or ""
        w = S.findall(text)
        lines = [x for x in text.split("\n") if S.search(x)]
        g = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        c = Counter(g)
        rep = {i + k for i, x in enumerate(g) if c[x] > 1 for k in range(8)}
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w)))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def op5(docs):
    out = []
    for d, text in docs:
        text = text or ""
        a = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        k = [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        h = [m.span() for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        spans = sorted((s, i, e) for i, x in enumerate((a, k, h)) for s, e in x)
        out.append((d, len(a), len(k), len(h), sha(",".join(f"{('assign', 'access', 'hex')[i]}:{s}:{e}" for s, i, e in spans))))
    return out


def op5_spans(text, scope=200):
    """All spans and links of one text, every part against every other."""
    kinds = [
        ("assign", ASSIGN, lambda m: len(m[2]) >= 6, "secret", True),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20, "identifier", True),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24, "secret", True),
        ("identity", re.compile(r"""(?:user(?:_?name)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]+""", re.I | re.A), lambda m: len(m[0]) >= 6, "identifier", False),
        ("key", re.compile("[A-Za-z0-9+/]{24,}={0,2}"), lambda m: re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]), "secret", False),
        ("endpoint", re.compile(r"""(?:https?|jdbc:[a-z]+|ftp|redis|amqp|mongodb)://[^\x00-\x20"'<>]+"""), lambda m: len(m[0]) >= 8, "endpoint", False),
    ]
    parts = sorted((m.start(), k, m.end()) for k, (_, p, ok, _, _) in enumerate(kinds) for m in p.finditer(text) if ok(m))
    names = [k[0] for k in kinds]
    value = {x for i, x in enumerate(parts) if names[x[1]] == "key" and any(names[y[1]] == "identity" and y[2] > x[0] for y in parts[:i])}

    def near(x, role):
        i, best = parts.index(x), None
        others = [(j, y) for j, y in enumerate(parts) if j != i and y not in value and kinds[y[1]][3] == role]
        back = max(((y[2], y[0]) for j, y in others if j < i), default=None)
        ahead = min((y for j, y in others if j > i), default=None)
        if back is not None:
            best = (x[0] - back[0], back[1])
        if ahead is not None and (best is None or ahead[0] - x[2] < best[0]):
            best = (ahead[0] - x[2], ahead[0])
        return best[1] if best and best[0] <= scope else None

    told, links = [], []
    for x in parts:
        _, _, _, role, base = kinds[x[1]]
        by = {r: near(x, r) for r in ("identifier", "secret", "endpoint")}
        over = any(kinds[y[1]][4] and y != x and y[0] < x[2] and x[0] < y[2] for y in parts)
        found = by["identifier"] is not None or by["endpoint"] is not None if role == "secret" else by["secret"] is not None
        if base or (x not in value and found and not over):
            told.append(x)
            if role == "secret" and (by["identifier"] is not None or by["endpoint"] is not None):
                links.append(":".join("-" if y is None else str(y) for y in (x[0], by["identifier"], by["endpoint"])))
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in told), ",".join(links)


def redacted(text):
    out, at = "", 0
    for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in op5_spans(text)[0].split(",") if x):
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def op6(docs, tokenizer):
    out, start = [], 0
    for d, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def op9(docs, encoding):
    out = []
    for d, text in docs:
        ids = encoding.encode_ordinary(text or "")
        out.append((d, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(text or "")))
    return out


def op8(docs, unit, least, reach=4):
    """(doc_id, removed, kept text) of each document: units are found by walking over characters and words."""
    def sentences(text):
        out, cur = [], ""
        for i, c in enumerate(text):
            cur += c
            if c == "\n" or (unit != "line" and c in ".!?…" and text[i + 1 : i + 2].isspace()):
                out.append(cur)
                cur = ""
        return [*out, cur]

    def parts(sentence):
        if unit != "piece":
            return [sentence]
        w = list(re.finditer(r"[^\W_]+", sentence))
        h = [zlib.crc32(m[0].casefold().encode()) for m in w]
        cuts, last = [0], None
        for i in range(reach, len(w) - reach):
            if h[i] < min(h[i - reach : i] + h[i + 1 : i + reach + 1]):
                cuts.append(w[i].start())
        return [sentence[a:b] for a, b in zip(cuts, [*cuts[1:], len(sentence)])]

    def norm(x):
        return " ".join(re.findall(r"[^\W_]+", x.casefold()))

    every = []
    for d, text in docs:
        found, at = [], 0
        for u in (p for s in sentences(text or "") for p in parts(s)):
            if norm(u):
                found.append((at, at + len(u), norm(u)))
            at += len(u)
        every.append(found)
    rank = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, xx(docs[i][1])))
    first = {}
    for i in rank:
        for s, _, x in every[i]:
            first.setdefault(x, (docs[i][0], docs[i][1] or "", s))
    out = []
    for (d, text), found in zip(docs, every):
        text, runs, run = text or "", [], []
        for u in [*found, None]:
            if u is not None and first[u[2]] != (d, text, u[0]):
                run.append(u)
                continue
            if run and sum(x.count(" ") + 1 for *_, x in run) >= least:
                runs.append((run[0][0], run[-1][1]))
            run = []
        kept, at = "", 0
        for a, b in runs:
            kept, at = kept + text[at:a], b
        out.append((d, ",".join(f"{a}:{b}" for a, b in runs), kept + text[at:]))
    return out


def xx(text):
    """Spark's xxhash64 of a text, signed: it ranks documents of one doc_id."""
    x = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return x - (1 << 64) if x >> 63 else x


def kept(text):
    """The verdict of the quality rules."""
    (_, n, chars, symbols, dup, _, failed), = op4([(0, text)])
    w = S.findall(text or "")
    lines = [x for x in (text or "").split("\n") if S.search(x)]
    letters = sum(any(c.isalpha() for c in x) for x in w)
    bad = 2 * symbols > n or chars < 2 * n or chars > 15 * n or (len(lines) >= 4 and 2 * dup > len(lines)) or 50 * len(set(w)) < n or 2 * letters < n
    return not failed and not bad


def feistel(x, n, key, rounds):
    """A permutation of 0..n-1: a balanced network over twice as many bits as half the domain needs, walked until the value is below n."""
    bits = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low, word = (1 << bits) - 1, (1 << 64) - 1

    def f(v, k):
        v = (v + k) * 0x9E3779B97F4A7C15 & word
        v ^= v >> 31
        v = v * 0xBF58476D1CE4E5B9 & word
        return v ^ v >> 29

    while True:
        left, right = x >> bits, x & low
        for r in range(rounds):
            left, right = right, left ^ (f(right, key * 31 + r) & low)
        x = left << bits | right
        if x < n:
            return x


def toxic_score(text, model):
    """Maximal segments by definition: the best interval, then the best ones on either side of it."""
    import math

    w = (text or "").lower().split()
    s = [sum(model.lexicon.get(t, 0.0) for t in re.findall(r"[^\W\d_]+", x)) or model.rest for x in w]

    def segments(a, b):
        best = max(((sum(s[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 1e-12:
            return []
        i = -best[2]
        j = i - best[1]
        return [*segments(a, i), best[0], *segments(j, b)]

    base = math.log(model.k * len(w)) if w else 0.0
    evidence = sum(max(0.0, model.lam * x - base) for x in segments(0, len(w)))
    return 1 / (1 + math.exp(-(model.a + model.b * evidence)))
