"""Documents with nulls, empty and long texts, ties, repeated rows and clashing columns; plain versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _text string, kept string, size double, n_words long"
BLANK = " \t\n\x0b\x0c\r"


def rows(texts, sources=None):
    """Rows of (id, text)."""
    out = []
    for k, (i, text) in enumerate(texts):
        source = sources[k % len(sources)] if sources else f"s{k % 3}"
        out.append((i, text, None if k % 5 == 0 else "en", source, None if text is None else len(text), -k, "other", "kept?", 0.5, k))
    return out


def frame(spark, texts, sources=None):
    return spark.createDataFrame(rows(texts, sources), SCHEMA).repartition(3)


def sentence(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=5, n=60):
    """Random prose with copies, near copies, shared passages, repeated lines, odd characters."""
    draw = random.Random(seed)
    passage, line = sentence(draw, 60), "A common line of several words, ÄÖ!"
    texts = []
    for i in range(n):
        text = "\n".join(sentence(draw, draw.randrange(3, 40)) for _ in range(draw.randrange(1, 5)))
        kind = i % 10
        if kind == 1 and texts:
            text = texts[draw.randrange(len(texts))][1] or ""
        elif kind in (2, 3) and texts:
            words = (texts[draw.randrange(len(texts))][1] or "x").split(" ")
            words[draw.randrange(len(words))] = "Edited"
            text = " ".join(words)
        elif kind == 4:
            text = sentence(draw, 8) + " " + passage + " " + sentence(draw, 9)
        elif kind == 5:
            text = f"{text}\n  {line} \t\n{line.lower()}\nshort\nshort"
        texts.append((3 * i, text))
    base = sentence(draw, 60).split(" ")
    for i in range(12):  # a chain: neighbours are similar, ends are not
        shifted = base[i * 2 :] + [f"n{k}" for k in range(i * 2)]
        texts.append((1000 + i, " ".join(shifted)))
    texts += [
        (2000, None), (2001, ""), (2002, "   \n\t "), (2003, "one"), (2004, "ONE"), (2005, "a b c d"), (2006, "a b c d e"),
        (2007, "x" * 350), (2008, "ab" * 300), (2009, "\U0001f600é " * 200), (2010, sentence(draw, 6000, 3000)),
        (2011, "the same words " * 400), (2012, "\n\n\n"), (2013, "é" * 120 + "\x00\x07 z"),
    ]
    texts.append(texts[7])  # a repeated row
    texts.append((texts[8][0], texts[8][1]))
    return texts


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def first_rows(texts):
    """Distinct rows, in order of id."""
    return sorted(dict.fromkeys(texts), key=lambda t: t[0])


def removed(texts, width=100):
    seen, out = set(), {}
    for i, text in first_rows(texts):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            window = data[p : p + width]
            if window in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    places = defaultdict(list)
    for k in range(len(w) - 2):
        places[tuple(w[k : k + 3])].append(k)
    repeated = {k + j for found in places.values() if len(found) > 1 for k in found for j in range(3)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "base_failed": len(w) < 50 or 100 * len(repeated) > 50 * len(w),
    }


def shingles(text):
    w = words(lower(text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts):
    """(id, set size) -> least id reachable."""
    found = [(i, shingles(t)) for i, t in first_rows(texts)]
    parent = {i: i for i, _ in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(found):
        for j, b in found[:k]:
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in found}


def line_dedup(texts):
    def key(line):
        return lower(line.strip(BLANK))

    holders = defaultdict(set)
    for i, text in texts:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = {}
    for i, text in first_rows(texts):
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(item))
    out = {}
    for i, text in first_rows(texts):
        w, hit, met = alnum(text), set(), set()
        for m in range(1, 11):
            for k in range(len(w) - m + 1):
                if found := windows.get(tuple(w[k : k + m])):
                    hit |= set(range(k, k + m))
                    met |= found
        out[i] = (len(w), len(hit), sorted(met))
    return out


def targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """Size by source -> target by source, by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    free, total = set(order), budget * sum(sizes.values())
    while free:
        rest = total - sum(cap * sizes[s] for s in sizes if s not in free)
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not over:
            return {s: level * weight[s] if s in free else cap * sizes[s] for s in sizes}
        free -= over
    return {s: cap * sizes[s] for s in sizes}
