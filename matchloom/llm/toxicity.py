"""Toxicity: maximal scoring segments over token log-odds, aggregated by extreme-value calibration."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import carried, restored, stage, unstage
from .textbuf import NON_WORD, U64, Words, mix, pieces, signed

#: Digits split words here too: a word is a run of letters and non-ASCII characters.
LETTERS = NON_WORD.copy()
LETTERS[0x30:0x3A] = True


SEGMENTS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


@dataclass(frozen=True)
class Fit:
    """rows: labelled rows that are learned from, at most (the first by hash of the id; their whole texts); stem: length in
    bytes of the word beginnings that back off unseen words; strength: of the Dirichlet priors, in rows; z: candidates for
    the least z-score of a token that counts (many tokens need a higher one), chosen on held-out texts; cost: mean score of
    a token of a clean text; most: highest score of a token; folds: by hash of the id, for texts that a fit has not seen."""

    rows: int = 4_000
    stem: int = 4
    strength: float = 1.0
    z: tuple[float, ...] = (2.0, 2.5, 3.0, 3.5, 4.0)
    cost: float = -0.3
    most: float = 6.0
    folds: int = 3


#: Token scores are kept to so many digits, so that their distribution is a small table and reruns agree.
DIGITS = 3


@dataclass
class Model:
    """Token scores by name (sorted), then stem scores, the score of all other tokens, the extreme-value parameters and
    the calibration from evidence to probability."""

    word: np.ndarray
    word_score: np.ndarray
    stem: np.ndarray
    stem_score: np.ndarray
    other: float
    decay: float
    size: float
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    stem_length: int = 4


def stems(w: Words, length: int) -> np.ndarray:
    """Names of the first ``length`` bytes of each word (A-Z lower-cased); short words are their own."""
    raw = w.bytes
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    h = np.full(len(w.start), 7, U64)
    for j in range(length):
        at = w.start + j
        inside = at < w.end
        b = np.where(inside, lower[np.minimum(at, max(0, len(raw) - 1))], 0).astype(U64) if len(raw) else np.zeros(len(at), U64)
        h = h * U64(257) + b + inside.astype(U64)
    return mix(h)


class Tokens:
    """What scoring needs of the words of some texts: names ``h``, names of their stems, ``doc``, ``first`` and ``count``."""

    def __init__(self, h: np.ndarray, stem: np.ndarray, doc: np.ndarray, rows: int):
        self.h, self.stem, self.doc = h, stem, doc
        self.count = np.bincount(doc, minlength=rows)
        self.first = np.cumsum(self.count) - self.count

    @classmethod
    def of(cls, column: pa.Array, length: int) -> Tokens:
        """Tokens of a text column, cut piece by piece to bound memory."""
        h, stem, doc, rows = [np.empty(0, U64)], [np.empty(0, U64)], [np.empty(0, np.int32)], 0
        for piece in pieces(pa.RecordBatch.from_arrays([column], ["text"])):
            w = Words(piece.column("text"), LETTERS, lower=True)
            h.append(w.h)
            stem.append(stems(w, length))
            doc.append((w.doc + rows).astype(np.int32))
            rows += len(piece)
        return cls(np.concatenate(h), np.concatenate(stem), np.concatenate(doc), rows)

    def rows(self, keep: np.ndarray) -> Tokens:
        """Those of the texts whose places are in ``keep`` (sorted), renumbered."""
        new = np.full(len(self.count), -1, np.int32)
        new[keep] = np.arange(len(keep))
        use = new[self.doc] >= 0
        return Tokens(self.h[use], self.stem[use], new[self.doc[use]], len(keep))


def token_scores(model: Model, w: Tokens) -> np.ndarray:
    """Score of each token: its own, else its stem's, else that of all others."""

    def look(keys, values, h):
        if not len(keys):
            return np.full(len(h), np.nan)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, values[at], np.nan)

    s = look(model.word, model.word_score, w.h)
    unseen = np.isnan(s)
    if unseen.any():
        s[unseen] = look(model.stem, model.stem_score, w.stem[unseen])
    return np.where(np.isnan(s), model.other, s)


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments (Ruzzo and Tompa), in linear time.

    Only positive tokens are visited; what lies between them is one step of the running sum.
    """
    total = np.concatenate([[0.0], np.cumsum(score)])
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, earlier one with a smaller sum before
    for i in np.flatnonzero(score > 0).tolist():
        start, end, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, end, left, right, j))
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, b - a) for s, e, a, b, _ in stack]


def evidence(model: Model, score: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """Features of one text and its significant segments: -log p of the best segment, of the sum of significant ones, and
    the share of the text that they cover. p is the chance of such a maximum among as many clean tokens (Gumbel)."""
    n = len(score)
    segments = maximal_segments(score)
    if not segments:
        return np.array([1.0, 0.0, 0.0, 0.0]), []
    level = math.log(max(model.size * n, 1e-12)) / model.decay
    best = max(s for *_, s in segments)
    significant = [x for x in segments if x[2] > level]

    def surprise(x: float) -> float:
        e = math.exp(min(50.0, -model.decay * (x - level)))
        return min(60.0, -math.log(max(-math.expm1(-e), 1e-26)))

    over = sum(x[2] - max(level, 0.0) for x in significant)
    return np.array([1.0, math.log1p(surprise(best)), math.log1p(max(0.0, over)), sum(e - s for s, e, _ in significant) / n]), significant


def extreme_values(maxima: np.ndarray, lengths: np.ndarray, values: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """(decay, size) of P(max > x) = 1 - exp(-size * n * exp(-decay * x)) for clean texts: the decay solves
    mean(exp(decay * score)) = 1 over token scores (values, counts), the size fits the maxima by maximum likelihood."""
    lo, hi = 1e-3, 20.0
    if not (values > 0).any():
        return 1.0, 1e-3
    for _ in range(60):
        mid = (lo + hi) / 2
        if np.average(np.exp(np.minimum(mid * values, 50)), weights=counts) > 1:
            hi = mid
        else:
            lo = mid
    decay = (lo + hi) / 2
    size = len(maxima) / max(1e-9, float((lengths * np.exp(-decay * maxima)).sum()))
    return decay, size


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; all but the first are kept non-negative."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _split(score: np.ndarray, w: Tokens) -> list[np.ndarray]:
    return [score[a : a + n] for a, n in zip(w.first, w.count, strict=True)]


def labelled_sample(docs: DataFrame, labels: DataFrame, rule: Fit, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(fold, y, text), staged: the whole texts of the first rule.rows labelled ids by hash, one for each id (of several texts
    under one id the first by hash), so a bounded broadcast; the classes keep their shares, so probabilities stay true."""
    wanted = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    first = wanted.orderBy(F.xxhash64(F.lit("fit"), "id"), "id").limit(rule.rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(first), "id")
    one = texts.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(rule.folds)).cast("int")
    return stage(one.select(fold.alias("fold"), "y", "text").repartition(8), "tox-sample")


def token_counts(sample: DataFrame, rule: Fit) -> DataFrame:
    """(kind, name, stem, r0.., o0..) of words (kind 0) and stems (1): rows that hold the name by fold and label (r of
    2 * fold + label), and how often clean texts of a fold hold it (o of fold). Counted in the tasks first."""

    def counted(kind, names, w, stem, cell):
        order = np.lexsort((w.doc, cell[w.doc], names))
        n, d = names[order], w.doc[order]
        c = cell[d]
        group = np.append(True, (n[1:] != n[:-1]) | (c[1:] != c[:-1])) if len(n) else np.empty(0, bool)
        at = np.flatnonzero(group)
        pair = (group | np.append(True, d[1:] != d[:-1])) if len(n) else group
        rows = np.add.reduceat(pair.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
        columns = [pa.array(np.full(len(at), kind, np.int32)), signed(n[at]), signed(stem[order][at]), pa.array(c[at].astype(np.int32)), pa.array(rows), pa.array(np.diff(np.append(at, len(n))))]
        return pa.RecordBatch.from_arrays(columns, ["kind", "name", "stem", "cell", "rows", "occ"])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Tokens.of(piece.column("text"), rule.stem)
                cell = 2 * np.asarray(piece.column("fold")) + np.asarray(piece.column("y"))
                yield counted(0, w.h, w, w.stem, cell)
                yield counted(1, w.stem, w, w.stem, cell)

    rows = sample.mapInArrow(run, "kind int, name long, stem long, cell int, rows long, occ long")
    of = lambda i, c: F.sum(F.when(F.col("cell") == i, F.col(c)).otherwise(0))
    return rows.groupBy("kind", "name").agg(
        F.max("stem").alias("stem"), *(of(i, "rows").alias(f"r{i}") for i in range(2 * rule.folds)), *(of(2 * k, "occ").alias(f"o{k}") for k in range(rule.folds))
    )


def log_odds(counts: DataFrame, totals: dict[tuple[int, int], int], models: list[int], rule: Fit) -> tuple[DataFrame, DataFrame]:
    """Words and stems with odds_m, z_m (and share_m of stems) for each model m: 0 learns from all folds, k + 1 from all but k.

    Counts are rows that hold a name, scaled to equal classes, so an uneven sample does not tilt them. The prior of a name
    is ``strength`` rows, split as the rows that hold its stem are; evenly for a stem. z is 0 for a name that the model's
    rows do not hold.
    """

    def columns(m, share):
        folds = [k for k in range(rule.folds) if k != m - 1]
        n = [max(1.0, float(sum(totals.get((k, y), 0) for k in folds))) for y in (0, 1)]
        c, t = (sum((F.col(f"r{2 * k + y}") for k in folds), F.lit(0.0)) for y in (0, 1))
        held = 1 / (1 / F.greatest(t, F.lit(0.5)) + 1 / F.greatest(c, F.lit(0.5)))  # of the variance: rows as counted, not as scaled
        t_, c_ = t * (sum(n) / (2 * n[1])) + rule.strength * share, c * (sum(n) / (2 * n[0])) + rule.strength * (1 - share)
        odds = F.log(t_) - F.log(c_)
        z = F.when(t + c > 0, F.abs(odds) * F.sqrt(held + rule.strength / 4)).otherwise(0.0)
        return {f"odds_{m}": F.least(F.round(odds, DIGITS), F.lit(rule.most)), f"z_{m}": z, f"share_{m}": t_ / (t_ + c_)}

    def with_columns(df, share):
        return df.withColumns({k: v for m in models for k, v in columns(m, share(m)).items()})

    stems = with_columns(counts.where("kind = 1").drop("kind", "stem"), lambda m: F.lit(0.5))
    of_stem = stems.select(F.col("name").alias("stem"), *(F.col(f"{c}_{m}").alias(f"stem_{c}_{m}") for m in models for c in ("odds", "z", "share")))
    words = with_columns(counts.where("kind = 0").join(of_stem, "stem"), lambda m: F.col(f"stem_share_{m}"))
    return words, stems


@dataclass
class Table:
    """Scores and z of all names that count under any model and any cut, and the shift of each (model, cut). Each name is in
    several labelled rows, or its z would be lower, so the table is smaller than the rows that are learned from."""

    word: np.ndarray
    word_score: dict
    word_z: dict
    stem: np.ndarray
    stem_score: dict
    stem_z: dict
    shift: dict
    stem_length: int

    def model(self, m: int, z: float) -> Model:
        """Names that reach the cut. Other tokens say nothing; every token costs the same on top, so that the drift over
        clean text is negative."""
        k, sk, by = self.word_z[m] >= z, self.stem_z[m] >= z, self.shift[m, z]
        return Model(self.word[k], self.word_score[m][k] + by, self.stem[sk], self.stem_score[m][sk] + by, by, 1.0, 1.0, stem_length=self.stem_length)


def token_table(sample: DataFrame, rule: Fit) -> tuple[Table, list[int]]:
    """The table of token scores and the models that there are: one without each fold that has rows, if others have too."""
    totals = {(r["fold"], r["y"]): r["count"] for r in sample.groupBy("fold", "y").count().collect()}
    there = sorted({k for k, _ in totals})
    models = [0] + ([k + 1 for k in there] if len(there) > 1 else [])
    counts = stage(token_counts(sample, rule), "tox-counts")
    words, stems = log_odds(counts, totals, models, rule)
    words = stage(words, "tox-words")

    def clean(m):
        return sum((F.col(f"o{k}") for k in range(rule.folds) if k != m - 1), F.lit(0))

    def raw(m, z):
        return F.when(F.col(f"z_{m}") >= z, F.col(f"odds_{m}")).when(F.col(f"stem_z_{m}") >= z, F.col(f"stem_odds_{m}")).otherwise(0.0)

    sums = words.agg(*(F.sum(clean(m)).alias(f"n_{m}") for m in models), *(F.sum(clean(m) * raw(m, z)).alias(f"s_{m}_{i}") for m in models for i, z in enumerate(rule.z))).first()
    shift = {(m, z): round(min(rule.cost, rule.cost - (sums[f"s_{m}_{i}"] or 0.0) / max(1, sums[f"n_{m}"] or 0)), DIGITS) for m in models for i, z in enumerate(rule.z)}

    def known(df):
        some = F.greatest(*(F.col(f"z_{m}") for m in models), F.lit(0.0)) >= min(rule.z)
        t = df.where(some).select("name", *(f"{c}_{m}" for m in models for c in ("odds", "z"))).toArrow()
        name = np.asarray(t["name"], np.int64).view(U64)
        order = np.argsort(name)
        get = lambda c: {m: np.asarray(t[f"{c}_{m}"], np.float64)[order] for m in models}
        return name[order], get("odds"), get("z")

    table = Table(*known(words), *known(stems), shift, rule.stem)
    unstage(counts, words)
    return table, models


def _columns(df: DataFrame) -> np.ndarray:
    """All rows as doubles, sorted, so that sums over them do not depend on the order of tasks."""
    x = np.column_stack([np.asarray(c, np.float64) for c in df.toArrow().columns])
    return x[np.lexsort(x.T[::-1])]


def train(docs: DataFrame, labels: DataFrame, rule: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of labelled rows. Extreme values, calibration and the choice among ``rule.z`` use texts that
    the token scores, learned without their fold, have not seen.

    No text reaches the driver: it gets the token table, the maximum and length of each labelled row, the distribution of
    scores of clean tokens, and at last three features of each labelled row.
    """
    sample = labelled_sample(docs, labels, rule, id_col, text_col, label_col)
    table, models = token_table(sample, rule)
    context = docs.sparkSession.sparkContext
    shipped = context.broadcast(table)

    def unseen(piece):
        """(cut, rows, model, scores of each row) for every cut and fold."""
        w = Tokens.of(piece.column("text"), rule.stem)
        fold = np.asarray(piece.column("fold"))
        for k in np.unique(fold):
            if k + 1 in models:
                keep = np.flatnonzero(fold == k)
                v = w.rows(keep)
                for z in rule.z:
                    model = shipped.value.model(int(k) + 1, z)
                    yield z, keep, model, _split(token_scores(model, v), v)

    def maxima(batches):
        for batch in batches:
            for piece in pieces(batch):
                y = np.asarray(piece.column("y"))
                for z, keep, _, rows in unseen(piece):
                    clean = [s for i, s in zip(keep, rows, strict=True) if not y[i] and len(s)]
                    top = [max((g[2] for g in maximal_segments(s)), default=0.0) for s in clean]
                    value, n = np.unique(np.round(np.concatenate([*clean, np.empty(0)]), DIGITS), return_counts=True)
                    kind = np.repeat([0, 1], [len(top), len(value)]).astype(np.int32)
                    x, count = np.concatenate([top, value]), np.concatenate([np.array([len(s) for s in clean], np.int64), n])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), z)), pa.array(kind), pa.array(x), pa.array(count)], ["z", "kind", "x", "n"])

    found = stage(sample.mapInArrow(maxima, "z double, kind int, x double, n long"), "tox-maxima")
    tops = _columns(found.where("kind = 0").select("z", "x", "n"))
    values = _columns(found.where("kind = 1").groupBy("z", "x").agg(F.sum("n").alias("n")))
    fitted = {}
    for z in rule.z:
        t, v = tops[tops[:, 0] == z], values[values[:, 0] == z]
        fitted[z] = extreme_values(t[:, 1], t[:, 2], v[:, 1], v[:, 2]) if len(t) else (1.0, 1.0)

    def features(batches):
        for batch in batches:
            for piece in pieces(batch):
                y = np.asarray(piece.column("y"))
                for z, keep, model, rows in unseen(piece):
                    model.decay, model.size = fitted[z]
                    x = np.array([evidence(model, s)[0] for s in rows])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), z)), pa.array(y[keep].astype(np.int32)), *(pa.array(x[:, i]) for i in (1, 2, 3))], ["z", "y", "a", "b", "c"])

    held = _columns(sample.mapInArrow(features, "z double, y int, a double, b double, c double"))
    best: tuple[float, Model] | None = None
    for z in rule.z:
        model = table.model(0, z)
        model.decay, model.size = fitted[z]
        own = held[held[:, 0] == z]
        loss = 0.0
        if len(own):
            x, y = np.column_stack([np.ones(len(own)), own[:, 2:]]), own[:, 1]
            model.weights = logistic(x, y)
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -40, 40)))
            loss = float(-(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9)).mean())
        if best is None or loss < best[0]:
            best = (loss, model)
    unstage(sample, found)
    shipped.unpersist()
    return best[1]


def probability(model: Model, features: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(features @ model.weights, -40, 40))))


def score_toxicity(docs: DataFrame, labels: DataFrame, rule: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", carry: list[str] = ()) -> DataFrame:
    """(id, score, segments) of every document: the calibrated probability of label 1, and every significant toxic passage
    as (start, end, score) in words. Learned from ``labels`` (id, label) that join ``docs``; scored on texts alone.

    Null and empty texts score as texts without any segment; so do texts in a language never seen. Without labels the
    score is 0.5 for all; of z cuts with equal loss the lowest is taken. An id with several labels is toxic if one of them
    says so. Repeated rows score alike; other columns are not read but for those to ``carry``, which
    follow the result. One pass, no shuffle of texts.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rule, id_col, text_col, label_col).__dict__)

    def run(batches):
        model = Model(**shipped.value)
        for batch in batches:
            for piece in pieces(batch):
                w = Tokens.of(piece.column("text"), model.stem_length)
                p, found = [], []
                for s in _split(token_scores(model, w), w):
                    features, segments = evidence(model, s)
                    p.append(probability(model, features))
                    found.append([{"start": a, "end": b, "score": float(x)} for a, b, x in segments])
                own = [piece.column("id"), pa.array(p, pa.float64()), pa.array(found, SEGMENTS)]
                yield pa.RecordBatch.from_arrays(own + [piece.column(c) for c in names], ["id", "score", "segments", *names])

    source, names, schema = carried(docs, id_col, text_col, list(carry))
    out = source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, score double, segments array<struct<start:int,end:int,score:double>>{schema}")
    return restored(out, id_col, text_col, list(carry), ["score", "segments"])
