"""Plain, slow versions of the operators, written apart from them."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
SECRET = {
    "assign": re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    for kind, pattern in SECRET.items():
        for m in pattern.finditer(text):
            if kind == "assign" and len(m[2]) < 6 or kind == "access" and len(m[0]) < 20 or kind == "hex" and len(m[0]) < 24:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(SECRET).index(s[0])))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PERSONAL.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)} if len(set(windows)) < len(windows) else set()
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


LETTERS = string.ascii_letters + string.digits + "+/_=-"
TOKEN = re.compile("[A-Za-z0-9+/_=-]{16,}")


def _steps(data: bytes) -> list[tuple[str, str]]:
    marks = [chr(b) if chr(b) in LETTERS else " " for b in data]
    return list(zip(marks, marks[1:], strict=False))


def reads_as_identifier(token: str) -> bool:
    """Parts between separators are digits, or words with at most four digits behind: small letters, a capital and small letters, or 2 to 12 capitals."""
    parts = [p for p in re.split("[+/_=-]+", token) if p]
    for part in parts:
        if part.isdigit():
            continue
        word = part.rstrip("0123456789")
        if len(part) - len(word) > 4 or not word:
            return False
        at = 0
        while at < len(word):
            small = re.match("[A-Z]?[a-z]+", word[at:])
            capitals = re.match("[A-Z]+", word[at:])[0] if word[at].isupper() else ""
            if small:
                if len(small[0]) < 2 + small[0][0].isupper():
                    return False
                at += len(small[0])
            else:
                own = capitals[: 12]
                if len(own) == len(capitals) and word[at + len(own) :][:1].islower():
                    own = own[:-1]
                if len(own) < 2:
                    return False
                at += len(own)
    return bool(parts)


def markov_spans(texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
    """Base spans and likely secrets of each text, with models counted step by step over all of them."""
    seen = {0: Counter(), 1: Counter()}
    for text in (t or "" for t in texts):
        rest, at = [], 0
        for kind, start, end in secret_spans(text):
            value = SECRET["assign"].match(text, start)[2] if kind == "assign" else text[start:end]
            seen[1].update(_steps(f" {value} ".encode()))
            rest.append(text[at : max(at, start)])
            at = max(at, end)
        rest.append(text[at:])
        seen[0].update(_steps((" " + TOKEN.sub(lambda m: m[0] if reads_as_identifier(m[0]) else " ", " ".join(rest)) + " ").encode()))
    marks = LETTERS + " "

    def chance(y: int, a: str, b: str) -> float:
        single = {m: 0.5 for m in marks}
        for (_, m), n in seen[y].items():
            single[m] += n
        back = single[b] / sum(single.values())
        return (seen[y][a, b] + 8 * back) / (sum(n for (x, _), n in seen[y].items() if x == a) + 8)

    known: dict = {}
    out = []
    for text in (t or "" for t in texts):
        base = secret_spans(text)
        more = []
        for m in TOKEN.finditer(text):
            if any(s < m.end() and m.start() < e for _, s, e in base):
                continue
            total = sum(known.setdefault(x, math.log(chance(1, *x) / chance(0, *x))) if x not in known else known[x] for x in _steps(f" {m[0]} ".encode()))
            if total >= math.log(1e6):
                more.append(("markov", m.start(), m.end()))
        out.append(sorted(base + more, key=lambda s: (s[1], [*SECRET, "markov"].index(s[0]))))
    return out


def quality_features(text: str | None) -> dict[int, float]:
    """Slot -> relative frequency times 16, of words, shapes, word pairs and shape pairs; the bias last."""
    bits, mix, step, full = 18, 0x9E3779B97F4A7C15, 0x100000001B3, (1 << 64) - 1
    words = (text or "").encode().split()
    shape_of = lambda b: "A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b > 127 else "9" if 48 <= b <= 57 else chr(b)
    shapes = ["".join(map(shape_of, w)).encode("latin-1") for w in words]
    h = [zlib.crc32(w) for w in words]
    s = [zlib.crc32(x[-4:]) ^ (min(len(x), 31) >> 2) for x in shapes]
    found = [(x, 1) for x in h] + [(x, 2) for x in s]
    found += [(7 if a == b else (a * step & full) ^ b, 3) for a, b in zip(h, h[1:], strict=False)]
    found += [((a * step & full) ^ b, 4) for a, b in zip(s, s[1:], strict=False)]
    slots = Counter((((x + salt) * mix) & full) >> (64 - bits) for x, salt in found)
    return {k: 16 * n / len(found) for k, n in slots.items()} | {1 << bits: 1.0}


def _ftrl_weight(z: float, n: float) -> float:
    return 0.0 if abs(z) <= 1e-3 else -(z - math.copysign(1e-3, z)) / ((1 + math.sqrt(n)) / 0.5 + 1e-3)


def ftrl(rows: list[tuple[str | None, int]], epochs: int = 3) -> dict[int, float]:
    """Plain follow-the-regularised-leader over the rows in order: alpha 0.5, beta 1, l1 and l2 0.001."""
    z: dict = {}
    n: dict = {}
    ones = sum(y for _, y in rows)
    weigh = {1: len(rows) / (2 * max(ones, 1)), 0: len(rows) / (2 * max(len(rows) - ones, 1))}
    for _ in range(epochs):
        for text, y in rows:
            x = quality_features(text)
            w = {k: _ftrl_weight(z.get(k, 0.0), n.get(k, 0.0)) for k in x}
            p = 1 / (1 + math.exp(-min(max(sum(w[k] * v for k, v in x.items()), -30), 30)))
            for k, v in x.items():
                g = weigh[y] * (p - y) * v
                sigma = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / 0.5
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = n.get(k, 0.0) + g * g
    return {k: _ftrl_weight(z[k], n[k]) for k in z}


def quality_score(models: list[dict[int, float]], text: str | None) -> float:
    """Of the mean of the models."""
    total = sum(sum(m.get(k, 0.0) for m in models) / len(models) * v for k, v in quality_features(text).items()) if models else 0.0
    return 1 / (1 + math.exp(-min(max(total, -30), 30)))


_WORDS = "phone|telephone|tel|mobile|cell|call|fax|contact|ssn|social security|passport|licen[cs]e no|account|iban|card|id|e-?mail|mail|ip|address|telefon|handy|t[eé]l[eé]phone|tel[eé]fono|m[oó]vil|correo|konto"
_OTHER = r"version|isbn|issn|doi|page|pages|chapter|section|figure|table|year|vol|no\.|\$|€|£|%"
HINT = re.compile(rf"(?:{_WORDS})[ .:#=-]*\Z", re.I | re.A)
AGAINST = re.compile(rf"(?:{_OTHER})[ .:#=-]*\Z", re.I | re.A)
NUMBER = re.compile(r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,5}){1,3}(?![0-9A-Za-z-])")
SHAPE = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9-]+\.)+[A-Za-z]{2,}\Z", "ip": r"(?!0)[0-9]{1,3}(\.[0-9]{1,3}){3}\Z", "card": r"[3-6][0-9]{3}([ -]?[0-9]){9,15}\Z", "phone": r"\+[1-9][0-9]{0,2}[ (.-]",
    "number": r"(\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})\Z",
}


def all_personal_spans(texts: list[str | None]) -> list[str]:
    """Base spans and the numbers that voting, expectation-maximisation and naive Bayes over all texts accept."""
    rows = []  # text number, kind, start, end, votes, features
    for no, text in enumerate(t or "" for t in texts):
        base = personal_spans(text)
        for kind, pattern in {**PERSONAL, "card": re.compile(r"[0-9]([\x20-]?[0-9]){12,}"), "number": NUMBER}.items():
            hits = list(pattern.finditer(text))
            for i, m in enumerate(hits):
                start, end = m.span()
                if kind == "number" and (not 7 <= len(re.sub("[^0-9]", "", m[0])) <= 12 or any(s < end and start < e for _, s, e in base)):
                    continue
                if kind != "number" and (kind, start, end) not in base:
                    continue
                left = text[hits[i - 1].start() if i else 0 : start][-24:]
                right = text[end : hits[i + 1].end() if i + 1 < len(hits) else len(text)][:24]
                strict = bool(re.match(SHAPE[kind], m[0]))
                alone = (not left or left[-1] in " \n\"'(:=") and (not right or right[0] in " \n\"'),;.!?")
                joined_on = bool(re.search(r"[A-Za-z0-9_/.,-]\Z", left) or re.match("[A-Za-z0-9_/]", right))
                vote = lambda good, bad: -1 if bad else 1 if good else 0
                votes = (vote(strict, not strict), vote(HINT.search(left), AGAINST.search(left)), vote(alone, joined_on))
                marks = "".join(dict.fromkeys(c for c in m[0] if c in " ().@-"))
                word = "word" if HINT.search(left) else "start" if not left else "space" if left[-1] in " \n" else "other"
                rows.append((no, kind, start, end, votes, (("size", kind, min((end - start) // 4, 8)), ("marks", kind, marks), ("left", kind, word), ("shape", kind, strict))))
    counts = Counter(r[4] for r in rows)
    post = {v: min(max(0.5 + 0.15 * sum(v), 0.05), 0.95) for v in counts}
    for _ in range(50):
        weight = lambda v, y: counts[v] * (post[v] if y else 1 - post[v])
        mass = [sum(weight(v, y) for v in counts) for y in (0, 1)]
        rate = {(y, i, x): 0.1 + sum(weight(v, y) for v in counts if v[i] == x) for y in (0, 1) for i in range(3) for x in (-1, 0, 1)}
        chance = lambda v, y: math.log(max(mass[y], 0.5)) + sum(math.log(rate[y, i, v[i]] / sum(rate[y, i, x] for x in (-1, 0, 1))) for i in range(3))
        post = {v: 1 / (1 + math.exp(min(max(chance(v, 0) - chance(v, 1), -50), 50))) for v in counts}
    yes, no = sum(post[v] * n for v, n in counts.items()) + 1, sum((1 - post[v]) * n for v, n in counts.items()) + 1
    tally: dict = {}
    for *_, votes, features in rows:
        for f in features:
            a, b = tally.get(f, (0.0, 0.0))
            tally[f] = (a + post[votes], b + 1 - post[votes])
    log_odds = {f: math.log((a + 0.5) / (yes + 1)) - math.log((b + 0.5) / (no + 1)) for f, (a, b) in tally.items()}
    out: list[list] = [[] for _ in texts]
    for at, kind, start, end, _, features in rows:
        if kind != "number" or math.log(yes / no) + sum(log_odds[f] for f in features) >= math.log(9):
            out[at].append(([*PERSONAL, "number"].index(kind), start, end))
    return [joined([([*PERSONAL, "number"][k], s, e) for k, s, e in sorted(spans)]) for spans in out]


def buckets(text: str | None) -> list[int]:
    """crc32 modulo 10000 of each word of op13."""
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [zlib.crc32(w.encode()) % 10000 for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)]


def resampled(docs: list[tuple[int, str | None]], target: list[str | None]) -> list[tuple]:
    """(doc_id, n_features, weight, score, rank) by one sort; equal keys in the order given."""
    found = [buckets(t) for _, t in docs]
    s, t = Counter(b for f in found for b in f), Counter(b for x in target for b in buckets(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    rows = []
    for (i, _), f in zip(docs, found, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: 10 * len(able) // 100], 1):
        r[4] = rank
    return [tuple(r) for r in rows]


def aligned(docs: list[tuple[int, str | None]], a, b) -> list[tuple]:
    """Rows of op11, from whole texts encoded at once by the two libraries."""
    own = [n for n in range(256) if 33 <= n <= 126 or 161 <= n <= 172 or 174 <= n <= 255]
    letters = {chr(n): n for n in own} | {chr(256 + k): n for k, n in enumerate(n for n in range(256) if n not in own)}

    def piece(i: int) -> bytes:
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode()

    def placed(ids: list[int], of) -> list[tuple[int, int, int]]:
        out, at = [], 0
        for i in ids:
            out.append((at, at := at + len(of(i)), i))
        return out

    rows, held = [], Counter()
    for doc_id, text in docs:
        left = placed(a.encode(f" {text}", add_special_tokens=False).ids if text else [], lambda i: bytes(letters[c] for c in a.id_to_token(i)))
        right = placed(b.encode(text) if text else [], piece)
        whole = f" {text}".encode()
        if not text or b"".join(bytes(letters[c] for c in a.id_to_token(i)) for *_, i in left) != whole or b"".join(piece(i) for *_, i in right) != whole:
            rows.append((doc_id, 0, 0, [], None))
            continue
        links, groups, p, q, at = [], [], 0, 0, 0
        for s, e, i in left:
            while right[at][1] <= s:
                at += 1
            k = at
            while k < len(right) and right[k][0] < e:
                links.append((i, right[k][2]))
                k += 1
        for end in sorted({e for _, e, _ in left} & {e for _, e, _ in right}):
            x, y = p, q
            while p < len(left) and left[p][1] <= end:
                p += 1
            while q < len(right) and right[q][1] <= end:
                q += 1
            groups.append(",".join(str(i) for *_, i in left[x:p]) + "|" + ",".join(str(i) for *_, i in right[y:q]))
        held.update(set(links))
        rows.append((doc_id, len(left), len(right), links, groups))
    top: Counter = Counter()
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return [
        (i, n_a, n_b, len(groups or ()), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), "" if groups is None else sha(";".join(groups)))
        for i, n_a, n_b, links, groups in rows
    ]
