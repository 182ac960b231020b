"""Secret scan: known forms, and high-entropy windows within candidate strings."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .spans import Intervals, map_spans

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
BASE_KINDS = ["assign", "access", "hex"]
KIND_ORDER = {k: i for i, k in enumerate([*BASE_KINDS, "entropy"])}

#: Character classes from narrow to wide, with the entropy (bits) that a window within the class must reach.
CLASSES = (
    ("hex", frozenset("0123456789abcdef"), 3.1),
    ("hex", frozenset("0123456789ABCDEF"), 3.1),
    ("base64", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"), 3.7),
)
#: Allow-list of windows that are words, alone or run together (paths, identifiers of programs), or dates and numbers. From any place
#: no two kinds of pieces and no two lengths of one can match, so pieces are taken whole and never given back: linear time.
ALLOW = (
    r"(?:[A-Za-z]?[a-z]{0,2}(?=[A-Z0-9_/=+-]))?"  # the end of a word that the window cuts
    r"(?>[A-Z]?[a-z]{3,}+|[A-Z][a-z]{1,2}+(?=[A-Z_/=+-])|[A-Z]{2,}+(?![a-z])|[A-Z]{2,}(?=[A-Z][a-z])|(?<=[a-z]{3})[0-9]{1,2}+(?![0-9])"
    r"|(?<![A-Za-z0-9])(?:[A-Za-z0-9]{1,2}|[0-9]{1,4})(?![A-Za-z0-9])|[-_/=+])++"
    r"(?:[A-Z][a-z]{0,2}|[a-z]{1,2})?",
    r"[0-9]++(?:[-_/][0-9]++)*+",
)
#: Allow-listed wherever they stand in a candidate string (placeholders, public identifiers); what is left of it is judged by itself.
CUT = (
    r"(?<![0-9a-zA-Z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-zA-Z])",
    r"[Ee]xample|EXAMPLE|placeholder|PLACEHOLDER|[Xx]{6,}|0123456789|abcdefgh|ABCDEFGH",
    r"=(?=[A-Za-z0-9+/_-])",
)


@dataclass(frozen=True)
class EntropyRule:
    window: int = 20
    classes: tuple = CLASSES
    allow: tuple[str, ...] = ALLOW
    cut: tuple[str, ...] = CUT


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the known forms, leftmost and non-overlapping for each; a match that is too short is dropped without a retry."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def window_entropies(s: str, w: int) -> list[float]:
    """Shannon entropy (bits) of each window of w characters; a step changes two counts only."""
    gain = [0.0] + [n * math.log2(n) for n in range(1, w + 1)]
    count: dict[str, int] = {}
    total, out, bits = 0.0, [], math.log2(w)
    for i, c in enumerate(s):
        if i >= w:
            o = s[i - w]
            n = count[o]
            total += gain[n - 1] - gain[n]
            count[o] = n - 1
        n = count.get(c, 0)
        total += gain[n + 1] - gain[n]
        count[c] = n + 1
        if i >= w - 1:
            out.append(bits - total / w)
    return out


def remainders(text: str, known: Intervals, cut: re.Pattern):
    """(start, string) of what known spans and cut substrings leave of each candidate string."""
    for m in CANDIDATE.finditer(text):
        lo, hi = m.span()
        at = lo
        for a, b in sorted(known.within(lo, hi) + [(lo + c.start(), lo + c.end()) for c in cut.finditer(m.group())]):
            if a > at:
                yield at, text[at:a]
            at = max(at, b)
        if at < hi:
            yield at, text[at:hi]


def entropy_spans(text: str, rule: EntropyRule, allow: re.Pattern, cut: re.Pattern, known: list[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Unions of the windows, within one character class and outside known spans, whose entropy reaches that class's threshold
    and that the allow-list does not match."""
    out: list[tuple[int, int]] = []
    for start, s in remainders(text, Intervals(known), cut):
        if len(s) < rule.window:
            continue
        taken: list[tuple[int, int]] = []
        for _, members, least in rule.classes:
            lo = 0
            while lo < len(s):
                hi = lo
                while hi < len(s) and s[hi] in members:
                    hi += 1
                if hi - lo >= rule.window:
                    for i, bits in enumerate(window_entropies(s[lo:hi], rule.window), lo):
                        if bits >= least and not allow.fullmatch(s[i : i + rule.window]):
                            taken.append((start + i, start + i + rule.window))
                lo = hi + 1
        found = Intervals(taken)
        out += zip(found.start, found.end, strict=True)
    return out


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: EntropyRule = EntropyRule()) -> DataFrame:
    """(id, spans) of each document, in one pass without a shuffle.

    Kinds ``assign``, ``access`` and ``hex`` are the known forms; ``entropy`` adds windows of high entropy in what
    they and allow-listed substrings leave of each candidate string. Spans are by start, then kind in that order. A null
    or empty text has none; a repeated row is repeated in the result; other columns are not read. Time is linear in a
    text's length.
    """
    patterns = ["|".join(f"(?:{p})" for p in ps) for ps in (rule.allow, rule.cut)]

    def find(text: str):
        allow, cut = (re.compile(p, re.S) for p in patterns)
        spans = base_spans(text)
        spans += [("entropy", s, e) for s, e in entropy_spans(text, rule, allow, cut, [(s, e) for _, s, e in spans])]
        return sorted(spans, key=lambda x: (x[1], KIND_ORDER[x[0]]))

    return map_spans(docs, find, id_col, text_col)
