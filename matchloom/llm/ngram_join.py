"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, verified once per pair."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .base import BROADCAST_ROWS, components, semi_join, stage, unstage
from .textbuf import SPACE, U64, Words, mix, pieces, shingle_sets, signed


@dataclass(frozen=True)
class JoinRule:
    """Words of a shingle; the similarity as a fraction; entries of the table of frequent shingles that is shipped to the
    tasks to order shingles (16 bytes each; all others count as equally rare, which changes speed only); documents from
    which a shingle is hot, so that its rows are dealt to many tasks; shingles a task gathers before it counts them;
    partners of a set that are verified together; sets of a component, and their shingles, that are compared as a block
    when links are counted; parts of the space of names by which the suffix filter bounds an intersection."""

    words: int = 5
    num: int = 80
    den: int = 100
    frequent: int = 1 << 17
    hot: int = 1000
    shares: int = 997
    flush: int = 2_000_000
    group: int = 64
    block_sets: int = 512
    block_shingles: int = 1 << 16
    parts: int = 16


def set_names(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """A name of each row's set, whatever its order."""
    c = np.concatenate([np.zeros(1, U64), np.cumsum(mix(h ^ U64(0x2545F4914F6CDD1D)))])
    n = np.bincount(row, minlength=n_rows)
    last = np.cumsum(n)
    return mix(c[last] - c[last - n] + n.astype(U64) * U64(0x369DEA0F31A53F85))


def describe(docs: DataFrame, rule: JoinRule) -> DataFrame:
    """Two kinds of rows from one pass: (id, key, n, sid, parts) of each document, and (token, n) counts of the shingles that
    are frequent within what a task gathers. ``parts``: how many shingles the set has in each part of the space of names."""
    id_type = docs.schema["id"].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def counts():
            h = np.sort(np.concatenate(held)) if held else np.empty(0, U64)
            at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
            n = np.diff(np.append(at, len(h)))
            at, n = at[n > 2], n[n > 2]
            none = lambda t: pa.nulls(len(at), t)
            return pa.RecordBatch.from_arrays([none(arrow_id), none(pa.int64()), pa.array(n.astype(np.int64)), none(pa.int64()), signed(h[at]), none(pa.list_(pa.int32()))], ["id", "key", "n", "sid", "token", "parts"])

        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), SPACE, lower=True)
                row, h = shingle_sets(w, rule.words)
                sid = set_names(row, h, len(w.count))
                n = np.bincount(row, minlength=len(w.count))
                part = np.bincount(row * rule.parts + (h >> U64(40)).astype(np.int64) % rule.parts, minlength=len(n) * rule.parts).astype(np.int32)
                parts = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * rule.parts), pa.array(part))
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("key"), pa.array(n.astype(np.int64)), signed(sid), pa.nulls(len(n), pa.int64()), parts], ["id", "key", "n", "sid", "token", "parts"])
                held.append(h)
                size += len(h)
                if size >= rule.flush:
                    yield counts()
                    held, size = [], 0
        yield counts()

    return docs.mapInArrow(run, f"id {id_type}, key long, n long, sid long, token long, parts array<int>")


def postings(docs: DataFrame, rule: JoinRule, tokens: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(token, share, sid, n, pos, end_count, end_name): the prefix of each set in rare-first order (count in the table, then
    name). A set of n shingles meets any partner within its first n - ceil(n * similarity) + 1 shingles.

    One more row for each set, of share -1, has the last place in that order that its prefix reaches.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((tokens, counts))

    def run(batches):
        tokens, counts = shipped.value
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), SPACE, lower=True)
                row, h = shingle_sets(w, rule.words)
                if not len(row):
                    continue
                sid = set_names(row, h, len(w.count))
                n = np.bincount(row, minlength=len(w.count))
                first = np.cumsum(n) - n
                seen = np.zeros(len(h), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
                    seen = np.where(tokens[at] == h, counts[at], 0)
                # rows hold their shingles by name already: a stable sort by count within rows is rare-first order
                order = np.argsort(row * (1 << 32) + np.minimum(seen, (1 << 32) - 1), kind="stable")
                pos = np.arange(len(h)) - first[row]
                use = pos < (n - (rule.num * n + rule.den - 1) // rule.den + 1)[row]
                h, seen, row, pos = h[order][use], seen[order][use], row[use], pos[use]
                ends = np.flatnonzero(np.append(row[1:] != row[:-1], True))
                share = np.where(seen >= rule.hot, 1 + (sid[row] % U64(rule.shares)).astype(np.int64), 0)
                # copies within the piece are one
                one = np.unique(mix(h + sid[row] * U64(0x9E3779B97F4A7C15)), return_index=True)[1]
                last = sid[row[ends]]
                none = pa.nulls(len(one), pa.int64())
                both = lambda x, y, t: pa.array(np.concatenate([x, y]).astype(t))
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(np.concatenate([h[one], last])), both(share[one], np.full(len(ends), -1), np.int32), signed(np.concatenate([sid[row[one]], last])),
                        both(n[row[one]], n[row[ends]], np.int32), both(pos[one], np.full(len(ends), -1), np.int32),
                        pa.concat_arrays([none, pa.array(seen[ends])]), pa.concat_arrays([none, signed(h[ends] ^ U64(1 << 63))]),
                    ],
                    ["token", "share", "sid", "n", "pos", "end_count", "end_name"],
                )

    return docs.select("text").mapInArrow(run, "token long, share int, sid long, n int, pos int, end_count long, end_name long")


def dealt_postings(rows: DataFrame, rule: JoinRule) -> DataFrame:
    """``rows`` (staged) with the rows of every token dealt to ``rule.shares`` that ``rule.hot`` of them or more hold, whether the table of
    frequent shingles has it or not: exact counts, summed in the tasks first. There is one hot token for each ``hot`` rows at most."""
    hot = stage(rows.where("share = 0").groupBy("token").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= rule.hot), "ngram-hot")
    many = hot.count()
    if not many:
        return rows
    marked = rows.join(F.broadcast(hot) if many <= BROADCAST_ROWS else hot, "token", "left")
    share = F.when((F.col("share") == 0) & F.col("held").isNotNull(), 1 + F.pmod("sid", F.lit(rule.shares))).otherwise(F.col("share"))
    return marked.withColumn("share", share.cast("int")).drop("held")


def shared_postings(rows: DataFrame) -> DataFrame:
    """(token, sid, n, pos, some, rest, reach) of the tokens in prefixes of two different sets or more, once for each set; a hot
    token is known to be frequent, so its rows stay without being brought together.

    ``some`` is the number of such tokens in the set's prefix, ``rest`` that from this one on, ``reach`` the end of the prefix in
    the global order.
    """
    by = W.partitionBy("token", "share")
    both = rows.withColumns({"lo": F.min("sid").over(by), "hi": F.max("sid").over(by)}).where("lo <> hi OR share <> 0")
    once = both.dropDuplicates(["token", "sid"])
    mine = W.partitionBy("sid")
    told = once.withColumns(
        {
            "rest": F.row_number().over(mine.orderBy(F.desc("pos"))),
            "some": F.count_if(F.col("share") >= 0).over(mine).cast("int"),
            "reach": F.max(F.struct("end_count", "end_name")).over(mine),
        }
    )
    return told.where("share >= 0").select("token", "sid", "n", "pos", "some", "rest", "reach")


def passes(rule: JoinRule, n1, n2, shared1, shared2, reach1, reach2):
    """Length filter, and positional filter.

    Of two sets, take the one whose prefix ends earlier. Those of its prefix tokens that no other prefix has cannot be in the
    other set: they would be in its prefix. So it can share its ``shared`` prefix tokens and what lies behind the prefix.
    """
    behind = lambda n: F.floor((n * rule.num + rule.den - 1) / rule.den) - 1
    most = F.when(reach1 <= reach2, behind(n1) + shared1).otherwise(behind(n2) + shared2)
    return (F.greatest(n1, n2) * rule.num <= F.least(n1, n2) * rule.den) & (most * (rule.num + rule.den) >= (n1 + n2) * rule.num)


def open_lists(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of tokens that sets of different components hold, with the set's component c."""
    marked = stage(lists.join(found.withColumnRenamed("id", "sid"), "sid", "left").withColumn("c", F.coalesce("component", "sid")).drop("component"), "ngram-marked")
    mixed = stage(marked.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token"), "ngram-mixed")
    out = stage(marked.join(mixed, "token", "left_semi"), "ngram-open")
    unstage(marked, mixed)
    return out


def meeting(rows: DataFrame, rule: JoinRule) -> DataFrame:
    """(a, b) of sets of different components, each once.

    Each shared token is taken for the first one: what lies before it would then not be common, which the positional filter
    uses. Two similar sets pass at the token that is; at later ones the bound is only lower.
    """
    x, y = rows.alias("x"), rows.alias("y")
    side = lambda c: (F.col(f"x.{c}"), F.col(f"y.{c}"))
    ahead = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) * (rule.num + rule.den) >= (F.col("x.n") + F.col("y.n")) * rule.num
    here = (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c")) & ahead & passes(rule, *side("n"), *side("rest"), *side("reach"))
    return x.join(y, here).select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")).distinct()


def rebuilt(docs: DataFrame, keys: DataFrame, rule: JoinRule) -> DataFrame:
    """(sid, shingles) of the documents with one of the keys, from their texts."""

    def build(batches):
        for batch in batches:
            for piece in pieces(batch):
                w = Words(piece.column("text"), SPACE, lower=True)
                row, h = shingle_sets(w, rule.words)
                sid = set_names(row, h, len(w.count))
                n = np.bincount(row, minlength=len(w.count))
                last = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([signed(sid), pa.array([h[e - m : e].tobytes() for e, m in zip(last, n, strict=True)], pa.binary())], ["sid", "shingles"])

    return semi_join(docs, keys, ["key"]).select("text").mapInArrow(build, "sid long, shingles binary")


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, rule: JoinRule) -> DataFrame:
    """(a, b) of the pairs of sets that reach the similarity.

    First the suffix filter: fixed pivots cut the space of names in ``rule.parts`` parts, and two sets share no more than the
    smaller number of shingles in each part; this needs the numbers only. Only sets in pairs that pass are rebuilt from
    their texts. Each set travels once for each pair in which it is ``b``; the sets of ``a`` travel once for each
    group of about ``rule.group`` partners, so no task gets all partners of one set.
    """
    side = lambda s: sets.select(F.col("sid").alias(s), F.col("n").alias(f"n{s}"), F.col("parts").alias(f"p{s}"))
    most = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    pairs = stage(pairs.join(side("a"), "a").join(side("b"), "b").where(most * (rule.num + rule.den) >= (F.col("na") + F.col("nb")) * rule.num).select("a", "b"), "ngram-near")
    sizes = stage(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m")), "ngram-sizes")
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / rule.group)).alias("share"))
    members = dealt.select(F.col("b").alias("sid"), "a", "share")
    wanted = stage(members.union(dealt.select(F.col("a").alias("sid"), "a", "share").distinct()), "ngram-wanted")
    keys = stage(sets.join(wanted.select("sid").distinct(), "sid").select("key"), "ngram-keys")
    built = rebuilt(docs, keys, rule)
    placed = built.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, "sid").withColumn("member", F.col("sid") != F.col("a"))
    grouped = placed.repartition("a", "share").sortWithinPartitions("a", "share", "member")

    def check(batches):
        group, y = None, None
        for batch in batches:
            out_a, out_b = [], []
            for a, share, sid, member, x in zip(*(batch.column(c).to_pylist() for c in ("a", "share", "sid", "member")), batch.column("shingles"), strict=True):
                x = np.frombuffer(x.as_buffer(), U64)
                if not member:
                    group, y = (a, share), x
                elif group == (a, share) and similar(x, y, rule):
                    out_a.append(a)
                    out_b.append(sid)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    links = stage(grouped.select("a", "share", "sid", "member", "shingles").mapInArrow(check, "a long, b long"), "ngram-links")
    unstage(pairs, sizes, wanted, keys)
    return links


def similar(x: np.ndarray, y: np.ndarray, rule: JoinRule) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(x) > len(y):
        x, y = y, x
    inter = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return rule.den * inter >= rule.num * (len(x) + len(y) - inter)


def shared_counts(x: np.ndarray, i: np.ndarray, n: int, y: np.ndarray, j: np.ndarray, m: int) -> np.ndarray:
    """How many shingles each of n sets shares with each of m: shingles x of sets i, shingles y of sets j.

    A shingle that many sets of both sides hold counts by a product of 0-1 matrices, another one by its pairs.
    """
    both = np.intersect1d(x, y)

    def of(h, row):
        at = np.searchsorted(both, h)
        at[at == len(both)] = 0
        keep = both[at] == h if len(both) else np.zeros(len(h), bool)
        order = np.argsort(at[keep], kind="stable")
        return at[keep][order], row[keep][order]

    (tx, i), (ty, j) = of(x, i), of(y, j)
    cx, cy = np.bincount(tx, minlength=len(both)), np.bincount(ty, minlength=len(both))
    much = cx * cy * 64 > n * m
    out = np.zeros((n, m), np.float32)
    dense = np.flatnonzero(much)
    place = np.cumsum(much) - 1
    for lo in range(0, len(dense), 2048):
        part = much & (place >= lo) & (place < lo + 2048)
        a, b = np.zeros((n, 2048), np.float32), np.zeros((m, 2048), np.float32)
        a[i[part[tx]], place[tx[part[tx]]] - lo] = 1
        b[j[part[ty]], place[ty[part[ty]]] - lo] = 1
        out += a @ b.T
    count = out.astype(np.int64).ravel()
    # the other shingles: each row of x meets all of y with its shingle
    few = np.flatnonzero(~much[tx])
    starts = np.cumsum(cy) - cy
    for lo in range(0, len(few), 8192):
        k = few[lo : lo + 8192]
        reps = cy[tx[k]]
        at = np.repeat(starts[tx[k]] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        np.add.at(count, np.repeat(i[k], reps) * m + j[at], 1)
    return count.reshape(n, m)


def link_counts(docs: DataFrame, sets: DataFrame, found: DataFrame, links: DataFrame, rule: JoinRule) -> DataFrame:
    """(sid, n): the rows of other sets that each set links with, for sets (sid, key, n, copies) in components of several sets.

    Links lie within components. In one of two sets the link is known. Sets of a larger one are dealt to blocks by size class
    and name; two sets in classes that are not neighbours are too unlike in size. Every pair of blocks is compared once, in
    a task that gives counts only.
    """
    mine = stage(sets.join(found.withColumnRenamed("id", "sid"), "sid"), "ngram-members")
    large = stage(mine.groupBy("component").agg(F.count(F.lit(1)).alias("m")).where("m > 2").select("component"), "ngram-large")
    copies = mine.select("sid", "copies")
    ends = links.select("a", "b").distinct()
    ends = ends.union(ends.select("b", "a")).join(mine.join(large, "component", "left_anti").select(F.col("sid").alias("a")), "a")
    twos = ends.join(copies.withColumnRenamed("sid", "b"), "b").select(F.col("a").alias("sid"), F.col("copies").alias("n"))
    width = float(np.log(rule.den / rule.num)) * 1.001 if rule.num < rule.den else 1e-9
    classed = mine.join(large, "component", "left_semi").withColumn("class", F.floor(F.log(F.col("n").cast("double")) / width))
    need = F.greatest(F.ceil(F.sum("n") / rule.block_shingles), F.ceil(F.count(F.lit(1)) / rule.block_sets))
    shares = stage(classed.groupBy("component", "class").agg(need.alias("blocks")), "ngram-blocks")
    dealt = classed.join(shares, ["component", "class"]).withColumn("share", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    dealt = stage(dealt.select("component", "class", "share", "sid", "key", "copies"), "ngram-dealt")
    where = ["component", "class", "share"]
    placed = rebuilt(docs, dealt, rule).dropDuplicates(["sid"]).join(dealt.drop("key"), "sid")

    def gather(batches):
        held, at = [], None

        def done():
            sid, copies, n = (np.array([r[k] for r in held], np.int64) for k in (0, 1, 2))
            return pa.RecordBatch.from_arrays(
                [*(pa.array([v], pa.int64()) for v in at), *(pa.array([v.tobytes()], pa.binary()) for v in (sid, copies, n)), pa.array([b"".join(r[3] for r in held)], pa.binary())],
                [*where, "sids", "copies", "sizes", "shingles"],
            )

        for batch in batches:
            for *here, sid, copies, x in zip(*(batch.column(c).to_pylist() for c in [*where, "sid", "copies", "shingles"]), strict=True):
                if held and at != here:
                    yield done()
                    held = []
                at = here
                held.append((sid, copies, len(x) // 8, x))
        if held:
            yield done()

    rows = placed.repartition(*where).sortWithinPartitions(*where).select(*where, "sid", "copies", "shingles")
    blocks = stage(rows.mapInArrow(gather, "component long, class long, share long, sids binary, copies binary, sizes binary, shingles binary"), "ngram-gathered")
    one, two = (shares.select("component", F.col("class").alias(f"class_{s}"), F.col("blocks").alias(f"blocks_{s}")) for s in "ab")
    met = one.join(two, "component").where("class_b - class_a BETWEEN 0 AND 1")
    met = met.withColumn("share_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks_a") - 1))).withColumn("share_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks_b") - 1)))
    met = stage(met.where("class_a < class_b OR share_a <= share_b").select("component", "class_a", "share_a", "class_b", "share_b"), "ngram-met")
    side = lambda s: blocks.select("component", *(F.col(c).alias(f"{c}_{s}") for c in ("class", "share", "sids", "copies", "sizes", "shingles")))
    joined = met.join(side("a"), ["component", "class_a", "share_a"]).join(side("b"), ["component", "class_b", "share_b"])

    def compare(batches):
        for batch in batches:
            for r in batch.to_pylist():
                (sa, ca, na, xa), (sb, cb, nb, xb) = ([np.frombuffer(r[f"{c}_{s}"], U64 if c == "shingles" else np.int64) for c in ("sids", "copies", "sizes", "shingles")] for s in "ab")
                same = r["class_a"] == r["class_b"] and r["share_a"] == r["share_b"]
                both = shared_counts(xa, np.repeat(np.arange(len(sa)), na), len(sa), xb, np.repeat(np.arange(len(sb)), nb), len(sb))
                linked = rule.den * both >= rule.num * (na[:, None] + nb[None, :] - both)
                if same:
                    np.fill_diagonal(linked, False)
                sid, n = (sa, linked @ cb) if same else (np.concatenate([sa, sb]), np.concatenate([linked @ cb, linked.T @ ca]))
                yield pa.RecordBatch.from_arrays([pa.array(sid[n > 0]), pa.array(n[n > 0])], ["sid", "n"])

    counted = joined.select(*(f"{c}_{s}" for s in "ab" for c in ("class", "share", "sids", "copies", "sizes", "shingles"))).mapInArrow(compare, "sid long, n long")
    return stage(counted.union(twos).groupBy("sid").agg(F.sum("n").alias("links")), "ngram-counts")


def similar_documents(docs: DataFrame, rule: JoinRule = JoinRule(), id_col: str = "doc_id", text_col: str = "text", with_key: bool = False, with_links: bool = False) -> DataFrame:
    """(id, n_shingles, component) of each row: the size of its set, and the smallest id reachable by links, itself included.

    A set is the distinct shingles of ``rule.words`` words (A-Z lower-cased, ASCII whitespace apart); a text with fewer
    words has its whole sequence as one. Two rows link when their sets' Jaccard similarity reaches num / den. Rows without
    words have 0 shingles and link with nothing. Equal sets are one set with many rows; repeated rows fall together. A null
    id counts as no smallest id (a component of null ids alone has a null component). Other columns are not read.
    ``with_key`` adds the row's key, xxhash64(id, text), and the root of its component, a name that all its rows share (null
    without shingles). ``with_links`` adds n_links, the number of other rows that the row
    links with, copies among them.

    Candidates come in rounds. First every set in a token's list meets only the list's leader, so a group of near copies
    costs as many pairs as it has members; verified links join sets into components. Lists that still hold several
    components are joined with themselves: sets of different components meet where they first share a token.
    Each pair is verified once in all. No pair that could join two components is left out, so components are exact.
    """
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    told = stage(describe(source, rule), "ngram-told")
    rows = told.where("token IS NULL").select("id", "key", "n", "sid", "parts")
    top = told.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(rule.frequent).toArrow()
    tokens, counts = np.asarray(top["token"], np.int64).view(U64), np.asarray(top["n"], np.int64)
    order = np.argsort(tokens)
    held = stage(postings(source, rule, tokens[order], counts[order]), "ngram-postings")
    lists = stage(shared_postings(dealt_postings(held, rule)), "ngram-lists")
    unstage(held)
    sets = stage(rows.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), F.max("n").alias("n"), F.min("parts").alias("parts")), "ngram-reps")

    # a list's leader is a set that holds few shingles rarer than the token: the least edited one of a group of near copies
    lead = stage(lists.groupBy("token").agg(F.min(F.struct(F.col("pos").alias("p"), F.xxhash64("sid").alias("r"), F.col("sid"), F.col("n"), F.col("some"), F.col("reach"))).alias("l")), "ngram-leaders")
    met = lists.join(lead, "token").where("sid <> l.sid").where(passes(rule, F.col("n"), F.col("l.n"), F.col("some"), F.col("l.some"), F.col("reach"), F.col("l.reach")))
    pairs = stage(met.select(F.least("sid", "l.sid").alias("a"), F.greatest("sid", "l.sid").alias("b")).distinct(), "ngram-pairs")
    links = verified(pairs, source, sets, rule)
    found = stage(components(links), "ngram-components")

    open_ = open_lists(lists, found)
    more = stage(meeting(open_, rule).join(pairs, ["a", "b"], "left_anti"), "ngram-pairs")
    if more.limit(1).count():
        late = verified(more, source, sets, rule)
        if late.limit(1).count():
            links = links.union(late)
            unstage(found)
            found = stage(components(links), "ngram-components")
    unstage(lists, lead, pairs, open_, more, sets)

    if with_links:
        members = stage(rows.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "ngram-copies")
        told_links = members.join(link_counts(source, members, found, links, rule), "sid", "left").select("sid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        rows = stage(rows.join(told_links, "sid", "left"), "ngram-counted")

    roots = stage(rows.where("n > 0").groupBy("sid").agg(F.min("id").alias("least")), "ngram-sids")
    rooted = stage(roots.join(found.withColumnRenamed("id", "sid"), "sid", "left").select("sid", "least", F.coalesce("component", "sid").alias("root")), "ngram-rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component")), "ngram-least")
    named = stage(rooted.join(least, "root").select("sid", "component", "root"), "ngram-named")
    unstage(roots, rooted, least, found)
    out = rows.join(named, "sid", "left")
    counted = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if with_links else []
    least = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component")
    return out.select(*(["key", "root"] if with_key else []), F.col("id").alias(id_col), F.col("n").alias("n_shingles"), *counted, least)
