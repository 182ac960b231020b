"""Personal data: known forms, and bootstrapped contexts that discover unseen identifiers."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import carried, restored, stage, unstage
from .spans import Intervals, map_spans

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match starts with its first digits whole and takes all of its last ones: no place within a run of digits is tried
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE_KINDS = ["email", "ip", "card", "phone"]
KIND_ORDER = {k: i for i, k in enumerate([*BASE_KINDS, "context"])}
DIGIT = re.compile(r"[0-9]")
#: An identifier-like token: at least three digits in five or more characters.
TOKEN = re.compile(r"(?<!\S)[#(\"']?([A-Za-z0-9](?:[A-Za-z0-9_/-]{3,})[A-Za-z0-9])(?=[)\"'.,;:!?]?(?:\s|$))", re.A)
WORD = re.compile(r"\S+")
OPENING, CLOSING = frozenset("#([\"'"), frozenset(")]\"'.,;:!?")


@dataclass(frozen=True)
class Bootstrap:
    """least confidence of a pattern; least distinct instances that support it; what an unknown instance weighs against a
    pattern, as it may be an identifier itself; bytes of patterns up to which all of them are shipped to the tasks (beyond
    that identifiers are joined with their table by their contexts)."""

    confidence: float = 0.8
    support: int = 4
    doubt: float = 0.1
    shipped: int = 1 << 22


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, sought from each @ so that long runs stay linear."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the known forms by kind, then start; leftmost and non-overlapping for each, failing matches dropped."""
    out = emails(text)
    if not DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) < 3 or len(q) == 3 and q <= "255" for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(DIGIT.findall(m.group())) <= 15]
    return out


def name(*parts: str) -> bytes:
    """A 128-bit name, so that neither patterns nor instances need a bound on their length."""
    return blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=16).digest()


class Contexts:
    """The patterns around places of a text: the two words before and the two words after, lower-cased."""

    def __init__(self, text: str):
        self.text = text
        self.words = [m.span() for m in WORD.finditer(text)]
        self.starts = [s for s, _ in self.words]

    def around(self, start: int, end: int) -> list[bytes]:
        """Names of the patterns: one or none for each side. A span must begin its word but for an opening sign, and end it
        but for closing ones; each word is read for few spans, so a whole text takes linear time."""
        word = lambda i: self.text[slice(*self.words[i])].lower()
        out = []
        i = bisect_right(self.starts, start) - 1
        lead = start - self.words[i][0]
        if i >= 2 and (lead == 0 or lead == 1 and self.text[start - 1] in OPENING):
            out.append(name("before", word(i - 2), word(i - 1)))
        j = bisect_right(self.starts, end - 1) - 1
        tail = self.words[j][1] - end
        if j + 2 < len(self.words) and tail <= 3 and all(c in CLOSING for c in self.text[end : self.words[j][1]]):
            out.append(name("after", word(j + 1), word(j + 2)))
        return out


def unknown_tokens(text: str, known: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens that touch no known span."""
    if not DIGIT.search(text):
        return []
    taken = Intervals((s, e) for _, s, e in known)
    return [m.span(1) for m in TOKEN.finditer(text) if len(DIGIT.findall(m[1])) >= 3 and not taken.touch(*m.span(1))]


def pattern_edges(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(pattern, instance, seed, n): how often an instance stands in a pattern, over all texts; counted in the tasks first."""

    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for t in batch.column(0):
                text = t.as_py() or ""
                known = base_spans(text)
                unknown = unknown_tokens(text, known)
                if known or unknown:
                    at = Contexts(text)
                    for kind, s, e in known:
                        for p in at.around(s, e):
                            seen[p, name(kind, text[s:e]), True] += 1
                    for s, e in unknown:
                        for p in at.around(s, e):
                            seen[p, name("token", text[s:e]), False] += 1
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())],
                ["pattern", "instance", "seed", "n"],
            )

    edges = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "pattern binary, instance binary, seed boolean, n long")
    return edges.groupBy("pattern", "instance", "seed").agg(F.sum("n").alias("n"))


def score_patterns(edges: DataFrame, rule: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, confidence, support) of the patterns that qualify, staged.

    A seed's score is 1, that of an unknown instance the noisy-or of the confidences of the qualified patterns it stands in
    (0 at first). A pattern's confidence is the sum of w * score over one plus that of w * (score + doubt * (1 - score));
    w = log2(1 + n), so repetition counts, but copies of one text do not rule. A pattern qualifies by the rule's confidence and by its number of
    instances whose score reaches that confidence: found instances are seeds of the next round. Rounds go on until
    none adds a pattern; scores only grow, so patterns stay qualified. Sums are rounded before they are compared.
    """
    edges = stage(edges.withColumn("w", F.log2(F.col("n") + 1.0)), "pii-edges")
    good, scores, size = None, None, 0
    while True:
        if scores is None:
            scored = edges.withColumn("score", F.col("seed").cast("double"))
        else:
            scored = edges.join(scores, "instance", "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("s", F.lit(0.0))))
        against = F.col("score") + rule.doubt * (1 - F.col("score"))
        confidence = F.round(F.sum(F.col("w") * F.col("score")) / (F.sum(F.col("w") * against) + 1), 9)
        per = scored.groupBy("pattern").agg(confidence.alias("confidence"), F.count_if(F.col("score") >= rule.confidence).alias("support"))
        now = stage(per.where((F.col("confidence") >= rule.confidence) & (F.col("support") >= rule.support)), "pii-patterns")
        if good is not None:
            unstage(good, scores)
        good, n = now, now.count()
        if n == size:
            unstage(edges)
            return good
        size = n
        reach = edges.where("NOT seed").join(good, "pattern")
        scores = stage(reach.groupBy("instance").agg(F.round(1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))), 9).alias("s")), "pii-scores")


def learn(docs: DataFrame, rule: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text") -> tuple[frozenset | None, DataFrame]:
    """The patterns that all texts of ``docs`` teach, as a set and as a staged table; no set where they exceed the rule's bytes."""
    table = score_patterns(pattern_edges(docs, id_col, text_col), rule).select("pattern")
    return (frozenset(table.toArrow()["pattern"].to_pylist()) if table.count() * 32 <= rule.shipped else None), table


def finder(docs: DataFrame, patterns: frozenset):
    """A function from a text to its spans, given all patterns; they are shipped to the tasks once."""
    shipped = docs.sparkSession.sparkContext.broadcast(patterns)

    def find(text: str) -> list[tuple[str, int, int]]:
        known, patterns = base_spans(text), shipped.value
        unknown = unknown_tokens(text, known) if patterns else []
        if not unknown:
            return known
        at = Contexts(text)
        return known + [("context", s, e) for s, e in unknown if not patterns.isdisjoint(at.around(s, e))]

    return find


def names_of(text: str) -> list:
    """Two names of a text, of equal texts alike."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("_n1"), F.xxhash64(F.lit(1), whole).alias("_n2")]


def context_spans(docs: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """(_n1, _n2, found) of the texts with spans after patterns of a table of any size, by their names and in order.

    Identifier-like tokens meet the table by their contexts in a shuffle; no text takes part in it.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for n1, n2, t in zip(*(batch.column(i) for i in range(3)), strict=True):
                text = t.as_py() or ""
                if unknown := unknown_tokens(text, base_spans(text)):
                    at = Contexts(text)
                    rows += [(n1.as_py(), n2.as_py(), s, e, p) for s, e in unknown for p in at.around(s, e)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["_n1", "_n2", "start", "end", "pattern"])

    source = docs.select(*names_of(text_col), F.col(text_col).alias("text"))
    places = stage(source.mapInArrow(run, "_n1 long, _n2 long, start int, end int, pattern binary"), "pii-places")
    met = places.join(patterns, "pattern", "left_semi").select("_n1", "_n2", "start", "end").distinct()
    span = F.struct(F.lit("context").alias("kind"), "start", "end")
    return stage(met.groupBy("_n1", "_n2").agg(F.sort_array(F.collect_list(span)).alias("found")), "pii-found")


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Bootstrap = Bootstrap()) -> DataFrame:
    """(id, spans) of each document: known forms, then ``context`` spans, identifier-like tokens within high-confidence
    patterns (two words before or after).

    Spans are by kind (email, ip, card, phone, context), then start. Two passes over the texts: one gathers contexts of
    all seeds and identifier-like tokens, counted before they are shuffled; one finds spans. Patterns are learned from
    all texts. A null or empty text has no spans; repeated rows are repeated; other columns are not read. Time is linear in
    a text's length.

    Every pattern that qualifies takes part: all are shipped up to ``rule.shipped`` bytes, beyond it they are joined.
    """
    patterns, table = learn(docs, rule, id_col, text_col)
    if patterns is not None:
        return map_spans(docs, finder(docs, patterns), id_col, text_col)
    # the names of a text travel as a part of its id
    named = docs.select(F.struct(F.col(id_col).alias("id"), *names_of(text_col)).alias("row"), F.col(text_col).alias("text"))
    known = map_spans(named, base_spans, "row", "text").select(F.col("row.id").alias(id_col), "row._n1", "row._n2", "spans")
    both = known.join(context_spans(docs, text_col, table), ["_n1", "_n2"], "left")
    return both.select(id_col, F.when(F.col("found").isNull(), F.col("spans")).otherwise(F.concat("spans", "found")).alias("spans"))


#: What redaction puts in place of a span.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "context": "[ID]"}


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its mask; of spans that overlap, the whole stretch by the first one's."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], KIND_ORDER[x[0]])):
        if s >= at:
            out += [text[at:s], MASKS[kind]]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Bootstrap = Bootstrap()) -> DataFrame:
    """All columns of ``docs``, the text with its spans masked. A null text stays null, an empty one empty; repeated rows are
    masked alike; an empty table gives an empty one."""
    patterns, table = learn(docs, rule, id_col, text_col)
    source, names, schema = carried(docs, id_col, text_col, docs.columns)
    find = base_spans if patterns is None else finder(docs, patterns)
    joined = source if patterns is not None else source.select("*", *names_of("text")).join(context_spans(docs, text_col, table), ["_n1", "_n2"], "left").drop("_n1", "_n2")

    def run(batches):
        for batch in batches:
            found = batch.column("found").to_pylist() if "found" in batch.schema.names else [None] * len(batch)
            masked = pa.array(
                [t if t is None else redact(t, find(t) + [(x["kind"], x["start"], x["end"]) for x in more or ()]) for t, more in zip(batch.column("text").to_pylist(), found, strict=True)], pa.string()
            )
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(masked if c == "text" else batch.column(c) for c in names)], ["id", *names])

    out = joined.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}{schema}")
    return restored(out, id_col, text_col, docs.columns, []).select(*docs.columns)
