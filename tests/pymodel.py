"""Plain-Python model of the feature and domain semantics, for checking the
Spark expressions row by row."""

from __future__ import annotations

import math
from collections import Counter


def entropy(s: str) -> float:
    if not s:
        return 0.0
    n = len(s)
    return abs(-sum(c / n * math.log2(c / n) for c in Counter(s).values()))


def name_features(qname: str, domain: str | None) -> list:
    if domain is None:
        return [None] * 8
    x = qname.replace(domain + ".", "")
    n = len(x)
    lens = [len(p) for p in x.split(".")]
    if n == 0:
        return [0, 0.0, 0.0, 0.0, 0.0, 0, 0.0, 0.0]
    return [n, entropy(x), sum(lens) / len(lens), float(min(lens)), float(max(lens)), x.count("."),
            sum(c.isupper() for c in x) / n, sum(c.isdecimal() for c in x) / n]


def answer_features(items: list | None) -> list:
    if items is None:
        return [None] * 5
    if len(items) == 0:
        return [0.0] * 5
    lens = [None if i is None else len(i) for i in items]
    avg_len = None if None in lens else sum(lens) / len(items)
    present = [v for v in lens if v is not None]
    max_len = float(max(present)) if present else None

    def share(pred):
        vals = []
        for i in items:
            if i is None or len(i) == 0:
                return None
            vals.append(sum(pred(c) for c in i) / len(i))
        return sum(vals) / len(items)

    ents = [None if i is None else entropy(i) for i in items]
    ent = None if None in ents else sum(ents) / len(items)
    return [avg_len, max_len, share(str.isupper), share(str.isdecimal), ent]


def registrable(name, rules, fallback=False):
    """Public-suffix semantics of SURVEY 2.11 over (suffix, kind) rules."""
    if name is None:
        return None
    stripped = name[:-1] if name.endswith(".") else name
    if stripped == "":
        return None
    labels = stripped.lower().split(".")
    n = len(labels)
    kinds = {}
    for suffix, kind in rules:
        kinds.setdefault(suffix.lower(), set()).add(kind)
    exc, best = [], []
    for k in range(1, n + 1):
        cand = ".".join(labels[n - k:])
        ks = kinds.get(cand, set())
        if "exception" in ks:
            exc.append(k - 1)
        if "exact" in ks:
            best.append(k)
        if "wildcard" in ks and n >= k + 1:
            best.append(k + 1)
    length = max(exc) if exc else (max(best) if best else (1 if fallback else None))
    if length is None or n < length + 1:
        return None
    return ".".join(labels[n - length - 1:])
