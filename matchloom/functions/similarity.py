"""String similarity in [0, 1] from longest common subsequences, computed for a whole Arrow batch at once.

The bit-parallel recurrence runs over all pairs (or all windows of all pairs) as lanes of one NumPy array; patterns beyond
64 characters use several words with carries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
#: Lanes handled at a time.
LANES = 1 << 15
#: Characters of both strings of the pairs whose windows are compared at a time.
CELLS = 1 << 16


def _numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters that occur, in order, and each one's number among them; by a table where they are few next to the text."""
    top = int(codes.max(initial=0)) + 1
    if top > max(4096, len(codes)):
        return np.unique(codes, return_inverse=True)
    known = np.zeros(top, bool)
    known[codes] = True
    return np.flatnonzero(known), (np.cumsum(known) - 1)[codes]


class Texts:
    """Strings as one padded matrix of character numbers (0 pads)."""

    def __init__(self, strings: list[str], alphabet: dict[str, int]):
        self.length = np.fromiter(map(len, strings), np.int64, len(strings))
        width = int(self.length.max(initial=0))
        self.codes = np.zeros((len(strings), width + 1), np.int32)
        found, at = _numbered(np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32))
        number = np.fromiter((alphabet.setdefault(chr(c), len(alphabet) + 1) for c in found.tolist()), np.int32, len(found))
        row = np.repeat(np.arange(len(strings)), self.length)
        self.codes[row, np.arange(len(at)) - np.repeat(np.cumsum(self.length) - self.length, self.length)] = number[at]


def _masks(p: Texts, n_codes: int, words: int) -> np.ndarray:
    """Bit j % 64 of [word j // 64, pattern, code]: the pattern has that code at j."""
    m = np.zeros((words, len(p.length), n_codes), U64)
    for j in range(int(p.length.max(initial=0))):
        rows = np.flatnonzero(p.length > j)
        m[j // 64, rows, p.codes[rows, j]] |= U64(1 << (j % 64))
    m[:, :, 0] = 0
    return m


def _lanes(masks: np.ndarray, m: np.ndarray, pattern: np.ndarray, t: Texts, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """LCS of pattern[lane] with text[lane][start : start + length]."""
    words = len(masks)
    s = np.full((words, len(pattern)), ~U64(0), U64)
    flat, first = masks.reshape(words, -1), pattern * masks.shape[2]
    for j in range(int(length.max(initial=0))):
        code = first + np.where(j < length, t.codes[text, np.minimum(start + j, t.codes.shape[1] - 1)], 0)
        carry = np.zeros(len(pattern), U64)
        for w in range(words):
            u = s[w] & flat[w].take(code)
            a = s[w] + u
            b = a + carry
            carry = ((a < s[w]) | (b < a)).astype(U64)
            s[w] = b | (s[w] - u)
    out = np.zeros(len(pattern), np.int64)
    for w in range(words):
        bits = np.clip(m[pattern] - 64 * w, 0, 64)
        inside = np.where(bits == 64, ~U64(0), (U64(1) << (bits % 64).astype(U64)) - U64(1))
        out += np.bitwise_count(~s[w] & inside).astype(np.int64)
    return out


def lcs(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    out = np.zeros(len(a), np.int64)
    sizes = np.fromiter((-(-max(1, len(x)) // 64) for x in a), np.int64, len(a))
    for words in np.unique(sizes):
        for rows in np.array_split(np.flatnonzero(sizes == words), -(-int((sizes == words).sum()) // LANES)):
            alphabet: dict[str, int] = {}
            p, t = Texts([a[i] for i in rows], alphabet), Texts([b[i] for i in rows], alphabet)
            lane = np.arange(len(rows))
            out[rows] = _lanes(_masks(p, len(alphabet) + 1, int(words)), p.length, lane, t, lane, np.zeros(len(rows), np.int64), t.length)
    return out


def ratio(a: list[str], b: list[str]) -> np.ndarray:
    """2 LCS / (|a| + |b|); 1 for two empty strings."""
    both = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    return np.where(both == 0, 1.0, 2.0 * lcs(a, b) / np.maximum(both, 1))


def token_sort_ratio(a: list[str], b: list[str]) -> np.ndarray:
    return ratio([" ".join(sorted(x.split())) for x in a], [" ".join(sorted(x.split())) for x in b])


def token_set_ratio(a: list[str], b: list[str]) -> np.ndarray:
    """Best of three comparisons of the common tokens with either side's rest; 0 if either has no token."""
    n = len(a)
    rest_a, rest_b, common = [""] * n, [""] * n, np.zeros(n, np.int64)
    fixed = np.full(n, np.nan)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        s, t = set(x.split()), set(y.split())
        if not s or not t:
            fixed[i] = 0.0
            continue
        inter = s & t
        rest_a[i], rest_b[i] = " ".join(sorted(s - t)), " ".join(sorted(t - s))
        common[i] = len(" ".join(sorted(inter)))
        if inter and (not rest_a[i] or not rest_b[i]):
            fixed[i] = 1.0
    la, lb = np.fromiter(map(len, rest_a), np.int64, n), np.fromiter(map(len, rest_b), np.int64, n)
    gap = (common > 0).astype(np.int64)
    full_a, full_b = common + gap + la, common + gap + lb
    apart = la + lb - 2 * lcs(rest_a, rest_b)
    best = 1.0 - apart / np.maximum(full_a + full_b, 1)
    with_a = np.where(common > 0, 1.0 - (1 + la) / np.maximum(common + full_a, 1), 0.0)
    with_b = np.where(common > 0, 1.0 - (1 + lb) / np.maximum(common + full_b, 1), 0.0)
    return np.where(np.isnan(fixed), np.maximum(best, np.maximum(with_a, with_b)), fixed)


def _ends(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Of pairs of strings (columns of character numbers, the first one's backwards): for each place of the second one, the place at which the
    strand that ends there began, negative if that is no place of it. LCS(a, b[i:j]) is j - i less the strands that begin at i or after
    and end before j, for all i and j at once.

    Strands enter from the left and above the table of both strings; in a cell of equal characters they part, in any other two that have not
    crossed do. A diagonal of the table is one step for all pairs.
    """
    m, k, n = len(short), *long.shape
    kind = np.uint16 if m + k < 1 << 16 else np.uint32
    h = np.repeat(np.arange(m, dtype=kind)[:, None], n, 1)
    v = np.repeat(np.arange(m, m + k, dtype=kind)[:, None], n, 1)
    same, least = np.empty((min(m, k), n), bool), np.empty((min(m, k), n), kind)
    for d in range(m + k - 1):
        j, size = max(0, d - m + 1), min(d, k - 1) - max(0, d - m + 1) + 1
        i = m - 1 - d + j
        x, y, low, equal = h[i : i + size], v[j : j + size], least[:size], same[:size]
        np.equal(short[i : i + size], long[j : j + size], out=equal)
        np.minimum(x, y, out=low)
        np.copyto(low, y, where=equal)
        y += x
        y -= low
        x[:] = low
    return v.astype(np.int64) - m


def _best_window(short: list[str], long: list[str]) -> np.ndarray:
    """Best ratio of each first string, no longer than the second, with any window of the second one of its length or cut
    off at an end."""
    n = len(short)
    m, k = np.fromiter(map(len, short), np.int64, n), np.fromiter(map(len, long), np.int64, n)
    out = np.where(k == 0, 1.0, 0.0)
    todo = np.flatnonzero(m > 0)
    # pairs of like lengths together, as shorter ones are padded
    todo = todo[np.lexsort((k[todo], m[todo] // 8))]
    for rows in np.split(todo, np.flatnonzero(np.diff(np.cumsum(m[todo] + k[todo]) // CELLS)) + 1) if len(todo) else []:
        alphabet: dict[str, int] = {}
        p, t = Texts([short[i] for i in rows], alphabet), Texts([long[i] for i in rows], alphabet)
        kind = np.uint16 if len(alphabet) < 1 << 15 else np.int32
        columns = lambda x: np.ascontiguousarray(x.T, dtype=kind)
        b = t.codes[:, :-1]
        # what pads one side is not what pads the other
        ends = _ends(columns(p.codes[:, -2::-1]), columns(np.where(np.arange(b.shape[1]) < t.length[:, None], b, len(alphabet) + 1)))
        own, width = p.length, int((p.length + t.length).max()) + 1
        # windows end at 1, 2, ... k + m - 1; what lies outside the longer string is cut off. A strand from s to r lies in those that end at
        # r + 1 to s + m, if there are any
        r, lane = np.nonzero((ends >= 0) & (np.arange(len(ends))[:, None] < t.length))
        count = lambda at: np.bincount(lane * width + at, minlength=len(rows) * width)
        inside = (count(r + 1) - count(np.minimum(np.maximum(ends[r, lane] + own[lane], r) + 1, width - 1))).reshape(len(rows), width).cumsum(1)
        end = np.arange(width)[None, :]
        length = np.minimum(end, t.length[:, None]) - np.maximum(end - own[:, None], 0)
        real = (end >= 1) & (end < (own + t.length)[:, None])
        out[rows] = np.where(real, 2.0 * (length - inside) / np.maximum(own[:, None] + length, 1), 0.0).max(1)
    return out


def partial_ratio(a: list[str], b: list[str]) -> np.ndarray:
    """Best ratio of the shorter string with any window of the longer one, cut windows at its ends included; of two equally
    long ones, either is slid along the other."""
    out = _best_window([x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)], [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)])
    same = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if len(x) == len(y) and x]
    if same:
        out[same] = np.maximum(out[same], _best_window([b[i] for i in same], [a[i] for i in same]))
    return out


def _list(s: pd.Series) -> list[str]:
    return s.fillna("").tolist()


@F.pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(ratio(_list(a), _list(b)))


@F.pandas_udf(T.DoubleType())
def token_set_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(token_set_ratio(_list(a), _list(b)))


@F.pandas_udf(T.DoubleType())
def token_sort_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(token_sort_ratio(_list(a), _list(b)))


@F.pandas_udf(T.DoubleType())
def partial_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(partial_ratio(_list(a), _list(b)))


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType()) for c in names])


def cut_similarities_udf(floor: float):
    """(name, addr): the token-set ratios of names and of addresses, the latter only where the former reaches ``floor``. One crossing to Python;
    marked so that a filter on it does not make Spark compute it twice."""

    @F.pandas_udf(_doubles("name", "addr"))
    def both(name: pd.Series, other: pd.Series, addr: pd.Series, other_addr: pd.Series) -> pd.DataFrame:
        n = token_set_ratio(_list(name), _list(other))
        rows = np.flatnonzero(n >= floor)
        x, y = _list(addr), _list(other_addr)
        a = np.zeros(len(n))
        a[rows] = token_set_ratio([x[i] for i in rows], [y[i] for i in rows])
        return pd.DataFrame({"name": n, "addr": a})

    return both.asNondeterministic()


def pair_similarities_udf(token_sets: bool):
    """All that the features need of two names and two addresses, in one crossing to Python; with ``token_sets`` their token-set ratios too."""
    kinds = ["lev", "token_sort", "partial", *(["token_set"] if token_sets else [])]
    by_kind = {"lev": ratio, "token_sort": token_sort_ratio, "partial": partial_ratio, "token_set": token_set_ratio}

    @F.pandas_udf(_doubles(*(f"{field}_{kind}" for field in ("name", "addr") for kind in kinds)))
    def every(name: pd.Series, other: pd.Series, addr: pd.Series, other_addr: pd.Series) -> pd.DataFrame:
        sides = {"name": (_list(name), _list(other)), "addr": (_list(addr), _list(other_addr))}
        return pd.DataFrame({f"{field}_{kind}": by_kind[kind](*pair) for field, pair in sides.items() for kind in kinds})

    return every.asNondeterministic()


#: Bits of a word of ``lcs_column``: two words and a carry add up to less than 2 ** 63.
WORD = 60


def lcs_column(a: Column, b: Column) -> Column:
    """LCS length by adding bits, a JVM twin of ``lcs``: a bit for each character of ``a``, in words of ``WORD`` bits; each character of
    ``b`` takes one step over the words. The places of a letter in ``a`` are found once for each distinct letter."""
    zero, ones = F.lit(0).cast("long"), F.lit((1 << WORD) - 1)
    letters = lambda c: F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda i: c.substr(i, F.lit(1)))
    words = F.ceil(F.char_length(a) / WORD).cast("int")
    numbers = F.sequence(F.lit(0), words - 1)

    def of_letter(x: Column, own: Column) -> Column:
        bit = lambda y, i: F.when(y == x, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(zero)
        word = lambda w: F.aggregate(F.transform(F.slice(own, w * WORD + 1, F.lit(WORD)), bit), zero, lambda t, y: t.bitwiseOR(y))
        return F.transform(numbers, word)

    def step(v: Column, k: Column) -> Column:
        """One character: bits of ``v`` and of the letter's places ``k``, word by word with the carry."""

        def word(s: Column, w: Column) -> Column:
            x, u = v[w], v[w].bitwiseAND(k[w])
            total = x + u + s["carry"]
            return F.struct(F.shiftrightunsigned(total, WORD).alias("carry"), F.concat(s["v"], F.array(total.bitwiseAND(ones).bitwiseOR(x - u))).alias("v"))

        return F.aggregate(numbers, F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("v")), word)["v"]

    def one_word(v: Column, k: Column) -> Column:
        u = v.bitwiseAND(k[0])
        return (v + u).bitwiseAND(ones).bitwiseOR(v - u)

    # lambda variables of one-element arrays name what is used more than once, so that it is computed once
    named = lambda value, then: F.transform(F.array(value), then)[0]
    places = lambda own: F.map_from_entries(F.transform(F.array_distinct(own), lambda x: F.struct(x, of_letter(x, own))))
    none = F.transform(numbers, lambda _: zero)
    steps = lambda table: F.transform(letters(b), lambda x: F.coalesce(F.try_element_at(table, x), none))
    left = lambda ks: F.when(words == 1, F.bit_count(F.aggregate(ks, ones, one_word))).otherwise(
        F.aggregate(F.aggregate(ks, F.transform(numbers, lambda _: ones), step), F.lit(0), lambda t, x: t + F.bit_count(x))
    )
    full = named(letters(a), lambda own: named(places(own), lambda table: named(steps(table), lambda ks: words * WORD - left(ks))))
    return F.when((F.char_length(a) == 0) | (F.char_length(b) == 0), 0).otherwise(full)
