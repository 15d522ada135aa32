"""Jaccard join on word shingles by signature trees.

Documents with the same shingle set form a class and are joined as one. A
class can only link to one with which it shares SPARE % of its shingles inside
the prefixes of both: of n shingles, the first n - ceil(0.8 n) and as many more
as must be shared, in an order common to all, in which the most frequent ones
come last. Classes with too few shared ones go; the others meet in the groups of
the tokens that they share. First each member is compared with its neighbour and with
the first of the group, which settles groups of near copies with few
comparisons. Then members of different components are searched by signature
trees: a node holds the OR of its members' token bitmaps and the range of their
sizes, and a pair of nodes is left out when the overlap that these allow falls
short of the one that the similarity asks for. What is left is compared shingle
by shingle. No link is lost: prefixes, sizes and bitmaps only leave out pairs
that cannot link, and pairs inside one component change nothing.

Defined results: documents without words, and null texts, have no shingles and
link with nothing; fewer than five words are one shingle. A component's id is
the smallest id in it that is not null. Repeated rows link with each other like
any copies. A very long text is a portion of its own, takes a hash per word, and
travels with the pairs that it is compared in. An empty table gives no rows. Columns other than id and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, portions, stored, texts, with_row
from txnlake.llm.components import components

SHINGLE = 5
#: Two documents link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles, in percent, by which a prefix is longer than a single common one needs.
SPARE = 6
#: Rounds in which classes with too few shared shingles go.
ROUNDS = 2
#: The most frequent shingles, at most so many, which come last in the common order.
FREQUENT = 1 << 16
#: Counters of a task's Misra-Gries summary.
COUNTERS = 1 << 18
#: Rows of the table per part of a frequent token's rows.
PART = 1 << 20
#: Members of a group that meet in one task; larger groups meet block by block.
BLOCK = 4096
#: Children of a tree node, and bits of a bitmap per shingle, within limits.
FANOUT, BITS_PER_SHINGLE, LEAST_BITS, MOST_BITS = 8, 4, 512, 1 << 15
#: Pairs that are looked at together.
AT_ONCE = 1 << 14

#: Odd multipliers, one for each place of a shingle.
_A = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
_SHORT = np.uint64(0xE7037ED1A0B428DB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its different shingles."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column.cast(pa.string()), "")))
    words = split.flatten()
    filled = pc.greater(pc.binary_length(words), 0)
    upto = np.r_[0, np.cumsum(filled.to_numpy(zero_copy_only=False))]
    offsets = upto[np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy())]]
    coded = words.filter(filled).dictionary_encode()
    different = coded.dictionary
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in different), np.uint64, len(different))
    h = hashes[coded.indices.to_numpy()]
    n_runs = max(len(h) - SHINGLE + 1, 0)
    runs = np.zeros(n_runs, np.uint64)
    for k in range(SHINGLE):
        runs += h[k : k + n_runs] * _A[k]
    runs = _mixed(runs)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            n = b - a
            out.append(_mixed((h[a:b] * _A[:n]).sum(keepdims=True) + _SHORT * np.full(1, n, np.uint64)))
        else:
            out.append(h[:0])
    return out


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that a set of n shares at least with any set it links to."""
    return (PERCENT * n + 99) // 100


def prefix(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """The first tokens in the common order, and how many of them are not frequent.

    Of the tokens that two linked sets share, the first max(1, SPARE % of n) stand
    so far in front that a set of n has them in its prefix.
    """
    n = plain = len(tokens)
    if n and len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        is_frequent = frequent[at] == tokens
        tokens = np.concatenate([tokens[~is_frequent], tokens[is_frequent]])
        plain -= int(is_frequent.sum())
    first = tokens[: n - least_overlap(n) + max(1, SPARE * n // 100)]
    return first, min(plain, len(first))


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of at most FREQUENT shingles that stand in the most documents.

    Each task keeps a Misra-Gries summary. Only the order of the shingles depends
    on it, never a result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in portions(batches):
            sets = shingle_sets(batch.column(1))
            new, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (keys[:0], counts[:0])
            # A shingle of one document in the portion is no heavy hitter yet.
            new, n = new[n > 1], n[n > 1]
            keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
            if len(keys) > COUNTERS:
                counts = counts - np.partition(counts, len(counts) - COUNTERS)[len(counts) - COUNTERS]
                keys, counts = keys[counts > 0], counts[counts > 0]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "n"])

    top = (
        map_arrow(texts(docs), count, "token bigint, n bigint")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(FREQUENT)
        .select("token")
        .toArrow()
    )
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def sets(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, text_hash, n, digest of the shingle set (null if empty), its prefix, and plain.

    `plain` is how many tokens of the prefix, the first ones, are not frequent.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            own = shingle_sets(batch.column(1))
            cut = [prefix(x, frequent) for x in own]
            first = [x.view(np.int64) for x, _ in cut]
            offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in first])].astype(np.int32))
            digests = [
                hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in own
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(x) for x in own], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *first]))),
                    pa.array([plain for _, plain in cut], pa.int32()),
                ],
                names=["doc_id", "text_hash", "n", "digest", "prefix", "plain"],
            )

    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id bigint, text_hash bigint, n bigint, digest binary, prefix array<bigint>, plain int"
    made = map_arrow(rows, make, schema)
    return made.withColumn("uid", F.monotonically_increasing_id())


# Signature trees ----------------------------------------------------------


def bitmap(tokens: np.ndarray) -> bytes:
    """The tokens as bits; the width follows their number."""
    wide = BITS_PER_SHINGLE * max(len(tokens), 1)
    bits = min(max(LEAST_BITS, 1 << (wide - 1).bit_length()), MOST_BITS)
    out = np.zeros(bits, np.uint8)
    out[(tokens % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps of one width as rows of words: wider ones are folded, so that a token keeps its bit."""
    width = min(len(m) for m in maps) // 8
    rows = [np.frombuffer(m, np.uint64).reshape(-1, width) for m in maps]
    return np.stack([np.bitwise_or.reduce(r, axis=0) for r in rows])


class Level:
    """Nodes of one level: OR of bitmaps, size range, most tokens beyond bits, and the component if it is one."""

    def __init__(self, bits, low, high, beyond, comp):
        self.bits, self.low, self.high, self.beyond, self.comp = bits, low, high, beyond, comp

    def above(self) -> Level:
        at = np.arange(0, len(self.low), FANOUT)
        least, most = np.minimum.reduceat(self.comp, at), np.maximum.reduceat(self.comp, at)
        return Level(
            np.bitwise_or.reduceat(self.bits, at, axis=0),
            np.minimum.reduceat(self.low, at),
            np.maximum.reduceat(self.high, at),
            np.maximum.reduceat(self.beyond, at),
            np.where(least == most, least, -1),
        )


def tree(bits: np.ndarray, n: np.ndarray, comp: np.ndarray) -> list[Level]:
    """Levels from the members up to one node."""
    beyond = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    levels = [Level(bits, n, n, beyond, comp)]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].above())
    return levels


def possible(a: Level, b: Level, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether some member below node p and some below node q may link and are not in one component.

    A shared token has its bit in both bitmaps, and a set has at most `beyond`
    tokens more than bits, so sets overlap in at most that many plus the common bits.
    """
    fits = (100 * a.high[p] >= PERCENT * b.low[q]) & (100 * b.high[q] >= PERCENT * a.low[p])
    fits &= (a.comp[p] != b.comp[q]) | (a.comp[p] < 0)
    at = np.flatnonzero(fits)
    common = np.bitwise_count(a.bits[p[at]] & b.bits[q[at]]).sum(axis=1, dtype=np.int64)
    overlap = common + np.minimum(a.beyond[p[at]], b.beyond[q[at]])
    overlap = np.minimum(overlap, np.minimum(a.high[p[at]], b.high[q[at]]))
    # intersection >= PERCENT % of union, with union = n_a + n_b - intersection
    fits[at] = (100 + PERCENT) * overlap >= PERCENT * (a.low[p[at]] + b.low[q[at]])
    return fits


def dual_traversal(a: list[Level], b: list[Level], same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members that may link; with `same`, the trees are one and each pair comes once."""
    todo = [(len(a) - 1, len(b) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        i, j, p, q = todo.pop()
        if len(p) > AT_ONCE:
            half = len(p) // 2
            todo += [(i, j, p[:half], q[:half]), (i, j, p[half:], q[half:])]
            continue
        may = possible(a[i], b[j], p, q)
        p, q = p[may], q[may]
        if not len(p):
            continue
        if i == j == 0:
            yield p, q
            continue
        # Both sides go down where they can; then pairs of children.
        down_a, down_b = i > 0 and i >= j, j > 0 and j >= i
        kids_a = p[:, None] * FANOUT + np.arange(FANOUT) if down_a else p[:, None]
        kids_b = q[:, None] * FANOUT + np.arange(FANOUT) if down_b else q[:, None]
        i, j = i - down_a, j - down_b
        p = np.repeat(kids_a, kids_b.shape[1], axis=1).ravel()
        q = np.tile(kids_b, (1, kids_a.shape[1])).ravel()
        there = (p < len(a[i].low)) & (q < len(b[j].low))
        if same:
            there &= (p <= q) if i or j else (p < q)
        todo.append((i, j, p[there], q[there]))


def _tree_pairs(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ids within a group, or between its two blocks; visitors don't meet each other."""
    uid, n, comp, home, side = (group.column(c).to_numpy() for c in ("uid", "n", "comp", "home", "side"))
    order = np.lexsort((n, comp, side))
    uid, n, comp, home, side = (x[order] for x in (uid, n, comp, home, side))
    maps = group.column("bits").take(pa.array(order)).to_pylist()
    bits = folded(maps)
    tokens, token = group.column("tokens").take(pa.array(order)).to_pylist(), group.column("token")[0].as_py()

    @cache
    def held(member: int) -> frozenset[int]:
        return frozenset(tokens[member])

    if (side == side[0]).all():
        one = tree(bits, n, comp)
        found = dual_traversal(one, one, True)
        left = right = np.arange(len(uid))
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        one, other = (tree(bits[at], n[at], comp[at]) for at in (left, right))
        found = dual_traversal(one, other, False)
    for p, q in found:
        p, q = left[p], right[q]
        meet = (home[p] | home[q]) & (comp[p] != comp[q])
        p, q = p[meet], q[meet]
        # Members that share several tokens are told in the group of the first one only.
        both = zip(p.tolist(), q.tolist(), strict=True)
        told = np.array([next(x for x in tokens[a] if x in held(b)) == token for a, b in both], dtype=bool)
        yield uid[p[told]], uid[q[told]]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that come sorted by keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*held, batch]) if held else pa.Table.from_batches([batch])
        table = table.combine_chunks()
        if not table.num_rows:
            continue
        codes = [table.column(k).to_numpy() for k in keys]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
        bounds = np.r_[0, new, table.num_rows]
        for s, e in zip(bounds[:-2], bounds[1:-1], strict=True):
            yield table.slice(s, e - s)
        held = table.slice(bounds[-2]).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


GROUP = ["token", "size_class", "i", "j"]


def tree_candidates(members: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Pairs a, b of uids of different components that share a prefix token and may link.

    `members` has token, uid, n and comp; `bitmaps` has uid and bits. Sizes are
    classed so that linked sets are in one class or in adjacent ones; a member is
    at home in its own class and a visitor in the next. A group of more than BLOCK
    members is dealt into blocks, and each pair of blocks meets in a task of its
    own. Bitmaps join last, when it is known who meets whom.
    """
    # 1.26 instead of 100 / PERCENT = 1.25, so that rounding cannot part two classes.
    own = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.26))).cast("long")
    at = F.array(
        F.struct(own.alias("size_class"), F.lit(True).alias("home")),
        F.struct((own + 1).alias("size_class"), F.lit(False).alias("home")),
    )
    placed = members.select("token", "uid", "n", "comp", F.inline(at))
    sizes = (
        placed.groupBy("token", "size_class")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("home").alias("met"),
            F.min("comp").alias("c0"),
            F.max("comp").alias("c1"),
        )
        .filter("met and c0 <> c1")
        .select("token", "size_class", F.ceil(F.col("rows") / BLOCK).cast("long").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("uid"), F.col("blocks"))
    dealt = placed.join(sizes, ["token", "size_class"]).withColumn("block", block)
    dealt = dealt.select("*", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other")).select(
        "token",
        "size_class",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "uid",
        "n",
        "comp",
        "home",
        (F.col("block") > F.col("other")).cast("long").alias("side"),
    )
    dealt = stored(dealt, "tree-members")
    # The tokens of a uid, by which a pair is told once however many it shares.
    tokens = dealt.groupBy("uid").agg(F.sort_array(F.collect_set("token")).alias("tokens"))
    dealt = dealt.join(tokens.join(bitmaps, "uid"), "uid").select(*dealt.columns, "bits", "tokens")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, GROUP):
            found = list(_tree_pairs(group))
            if found:
                p, q = (np.concatenate(side) for side in zip(*found, strict=True))
                columns = [pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    sorted_rows = dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return map_arrow(sorted_rows, search, "a bigint, b bigint")


# The join -----------------------------------------------------------------


def links(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """The pairs a, b that link, by their shingles; `of` has uid and text."""
    left = of.select(F.col("uid").alias("a"), F.col("text").alias("text_a"))
    right = of.select(F.col("uid").alias("b"), F.col("text").alias("text"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            x, y = shingle_sets(batch.column(2)), shingle_sets(batch.column(3))
            linked = []
            for p, q in zip(x, y, strict=True):
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(p) + len(q) - both))
            ids = [batch.column(k).filter(pa.array(linked, pa.bool_())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ids, names=["a", "b"])

    return map_arrow(joined, compare, "a bigint, b bigint")


def with_bitmaps(of: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            maps = pa.array([bitmap(x) for x in shingle_sets(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), maps], names=["uid", "text", "bits"])

    return map_arrow(of.select("uid", "text"), make, "uid bigint, text string, bits binary")


def _as_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _shared(postings: DataFrame) -> DataFrame:
    """uid, n, token, part, of tokens that several classes have.

    A frequent token's rows come in parts of bounded size and are shared in any case.
    """
    rows = postings.withColumn("rows", F.count(F.lit(1)).over(Window.partitionBy("token", "part")))
    return rows.filter("rows > 1 or part >= 0").select("uid", "n", "token", "part")


def class_components(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """u and v: a class's uid and the smallest uid of its component, for classes that link.

    `rows` are the stored sets; a class goes by the smallest uid in it.
    """
    copies = rows.groupBy("digest").agg(F.min("uid").alias("first"), F.count(F.lit(1)).alias("rows"))
    copies = copies.filter("rows > 1 and digest is not null").select("digest", "first")
    losers = rows.select("uid", "digest").join(copies, "digest").filter("uid <> first")
    classes = rows.filter("n > 0").join(losers.select("uid"), "uid", "left_anti")
    # All rows of a token that is not frequent are few; those of a frequent one are dealt into parts.
    parts = -(-rows.count() // PART)
    postings = classes.select("uid", "n", "plain", F.posexplode("prefix").alias("at", "token"))
    part = F.when(F.col("at") < F.col("plain"), -1).otherwise(F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    met = stored(_shared(postings.select("uid", "n", "token", part.alias("part"))), "shared-tokens")
    for _ in range(ROUNDS):
        # A linked set has at least 80 % of n shingles, and shares at least SPARE % of those.
        least = F.greatest(F.lit(1), F.expr(f"{SPARE} * (({PERCENT} * n + 99) div 100) div 100"))
        able = met.groupBy("uid", "n").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= least)
        met = stored(_shared(met.join(able.select("uid"), "uid", "left_semi")), "shared-tokens")
    by_size = Window.partitionBy("token", "part").orderBy("n", "uid")
    placed = met.select(
        "uid",
        "n",
        F.lag(F.struct("uid", "n")).over(by_size).alias("before"),
        F.first(F.struct("uid", "n")).over(by_size).alias("first"),
    )

    known = rows.join(met.select("uid").distinct(), "uid", "left_semi").select("uid", "doc_id", "text_hash")
    plain = texts(docs).withColumn("hash", F.xxhash64("text")).withColumnRenamed("doc_id", "id")
    found = plain.join(known, (plain["hash"] == known["text_hash"]) & plain["id"].eqNullSafe(known["doc_id"]))
    of = stored(with_bitmaps(found.select("uid", "text").dropDuplicates(["uid"])), "candidates")

    near = placed.filter("before is not null")
    near = near.select("uid", "n", F.explode(F.array("before", "first")).alias("other"))
    # The parts of a token meet by their first members.
    heads = met.filter("part >= 0").groupBy("token", "part").agg(F.min(F.struct("n", "uid")).alias("head"))
    head = F.min("head").over(Window.partitionBy("token"))
    heads = heads.select("head.uid", "head.n", F.struct(head["uid"].alias("uid"), head["n"].alias("n")).alias("other"))
    near = near.unionByName(heads.filter("uid <> other.uid"))
    near = near.filter(100 * F.col("other.n") >= PERCENT * F.col("n"))
    ends = (F.least("uid", "other.uid").alias("a"), F.greatest("uid", "other.uid").alias("b"))
    pairs = near.select(*ends).distinct()
    first = stored(links(pairs, of), "first-links")
    comps = components(_as_edges(first))

    named = met.select("token", "uid", "n").join(comps.select(F.col("u").alias("uid"), "v"), "uid", "left")
    named = named.select("token", "uid", "n", F.coalesce("v", "uid").alias("comp"))
    # Groups of one component are settled. Of groups with the same members one is enough;
    # members are compared by count and two sums of independent hashes.
    apart = (
        named.groupBy("token")
        .agg(
            F.min("comp").alias("c0"),
            F.max("comp").alias("c1"),
            F.count(F.lit(1)).alias("rows"),
            F.bit_xor(F.xxhash64("uid")).alias("h0"),
            F.bit_xor(F.xxhash64(F.lit("second"), "uid")).alias("h1"),
        )
        .filter("c0 <> c1")
        .groupBy("rows", "h0", "h1")
        .agg(F.min("token").alias("token"))
    )
    members = named.join(apart.select("token"), "token", "left_semi")
    more = stored(links(tree_candidates(members, of.select("uid", "bits")), of), "tree-links")
    return components(_as_edges(more).unionByName(comps))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_shingles and component_id.

    Also text_hash, and component, which tells components apart even where ids
    repeat (null for documents without shingles).
    """
    rows = stored(sets(docs, frequent_shingles(docs)), "shingle-sets")
    comps = class_components(rows, docs)
    classes = (
        rows.filter("n > 0")
        .groupBy("digest")
        .agg(F.min("uid").alias("u"), F.min("doc_id").alias("least_id"))
        .join(comps, "u", "left")
        .select("digest", "least_id", F.coalesce("v", "u").alias("component"))
    )
    classes = stored(classes, "classes")
    least = classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = classes.join(least, "component").select("digest", "component", "component_id")
    return rows.join(of_class, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_hash",
        "component",
    )


def keep_one_of_each_component(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Documents without shingles all stay. Of rows with equal id and text one stays.
    """
    found = jaccard_components(docs)
    key = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash").alias("hash"))
    first = found.filter("n_shingles > 0").groupBy("component").agg(F.min(key).alias("k"))
    first = first.select("k.doc_id", "k.hash")
    empty = found.filter("n_shingles = 0").select("doc_id", F.col("text_hash").alias("hash"))
    keys = ["hash", "id", "no_id"]

    def keyed(rows: DataFrame, *rest: str) -> DataFrame:
        known = F.coalesce("doc_id", F.lit(0)).cast("long").alias("id")
        return rows.select("hash", known, F.col("doc_id").isNull().alias("no_id"), *rest)

    whole = keyed(with_row(docs).withColumn("hash", F.xxhash64("text")), "doc")
    stay = whole.join(keyed(first.unionByName(empty)), keys, "left_semi")
    return stay.groupBy(*keys).agg(F.first("doc").alias("doc")).select("doc.*")
