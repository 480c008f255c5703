"""N-gram Jaccard join: prefix-tree join over globally ordered shingle sets.

Every text is its set of distinct 5-word shingles (64-bit hashes). Texts of
equal sets are one node. Shingles have one global order: by the count of their
bucket in a fixed-size table of counts over all documents, then by hash, so
what many documents share comes last.

Two sets of similarity t or more share one of their first n - ceil(t n) + 1
shingles (prefixes), and the smaller set has the first of these among its first
n (1 - t) / (1 + t) (its inner prefix; an outer entry alone can link nothing).
Prefix entries meet by shingle:

1. Each entry's node is paired with the inner node that has the shingle earliest
   in its order (hot shingles in slices, whose firsts meet in a second step). No
   group's pairs are all made. Sizes and places in the order rule out pairs.
2. Parity bitmaps of about a bit a shingle bound the difference of two sets from
   below; pairs whose bound is too large go, the others' sets are fetched.
3. They are compared by the prefix-tree join: the sets that meet one set are
   stored in a trie in the global order, and a walk shares the partial overlap
   of their common beginnings and leaves subtrees whose overlap cannot reach the
   bound with the shingles that remain.
4. Pairs that pass are links; their connected components are found.
5. What is left are nodes of different components that share a prefix shingle:
   all those pairs that steps 1 and 2 cannot rule out are compared too, so no
   link is lost. Of shingles that the same nodes hold, the first in the order
   stands for all. Pairs inside a component need no comparison for the
   components, which keeps large groups of near copies linear.
6. Links are counted inside components: a component's sets are dealt into blocks
   of bounded size, and each two blocks meet in a task that counts the overlaps
   of all their pairs by a product of 0/1 matrices. Rows are (set, block); pairs
   only exist as numbers inside a task. ``one_of_each`` leaves this step out.

Defined results: null texts, and texts without words, have no shingles and are
alone (``one_of_each`` keeps them all); a text of fewer words than a shingle is
one shingle; rows that repeat a doc_id, and rows without one, are judged by
their own texts each, and link like any other; a component whose rows have no
doc_id has a null id. ``one_of_each`` keeps the row of the smallest doc_id
(null last) of each component; where texts of one component repeat it, that of
the smallest set name, then text hash; of rows equal in both, the smallest. An
empty table gives an empty result. Texts of any length are whole sets. Further
columns are passed on by ``one_of_each`` and left out by ``components_of``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch.llm.common import free_prefix, give_back, shared_table, small_batches
from partnerwatch.llm.components import connected_components
from partnerwatch.llm.grams import WordHashes, shingle_set

SHINGLE, PERCENT = 5, 75
COUNTS = 1 << 20
CHUNK = 1 << 10  # counted buckets that a row carries from the tasks to their sums
SLICE = 20_000  # entries of a hot shingle in one slice, as its bucket's count suggests
PARTNERS = 64  # sets that one trie holds on average
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 18  # of a component's sets in one block, on average
WIDTH = 1 << 12  # columns of a matrix at a time


def digest(shingles: np.ndarray) -> int:
    """Name of a set: 64 bits, signed."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


@dataclass(frozen=True)
class Order:
    """The global order of shingles: the rank of their bucket's count, then the
    hash; and in how many slices a shingle of a bucket is dealt."""

    ranks: np.ndarray
    slices: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Order:
        ranks = np.unique(counts, return_inverse=True)[1]
        small = np.uint16 if ranks.max(initial=0) < 1 << 16 else np.int64  # small integers sort faster
        return cls(ranks.astype(small), np.minimum(counts // SLICE + 1, 32_000).astype(np.int16))

    def sort(self, shingles: np.ndarray) -> np.ndarray:
        """An ascending set in the global order."""
        return shingles[np.argsort(self.ranks[shingles & np.uint64(COUNTS - 1)], kind="stable")]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def similar(overlap: int, n: int, m: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n + m - overlap)


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the counts of shingles by their low bits, one to two bits a shingle."""
    size = 1 << max(6, (len(shingles) - 1).bit_length())
    at = np.bincount((shingles & np.uint64(size - 1)).view(np.int64), minlength=size)
    return np.packbits((at & 1).astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets by their bitmaps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


class SetTrie:
    """Ordered sets in a compressed trie; nodes hold [tokens, children by first
    token, smallest and largest set below, names of the sets that end here]."""

    def __init__(self) -> None:
        self.root: list = [np.empty(0, np.uint64), {}, 1 << 62, 0, []]

    def add(self, name: int, tokens: np.ndarray) -> None:
        node, n = self.root, len(tokens)
        while True:
            node[2], node[3] = min(node[2], n), max(node[3], n)
            if not len(tokens):
                node[4].append(name)
                return
            child = node[1].get(tokens[0])
            if child is None:
                node[1][tokens[0]] = [tokens, {}, n, n, [name]]
                return
            both = min(len(child[0]), len(tokens))
            differ = np.flatnonzero(child[0][:both] != tokens[:both])
            common = int(differ[0]) if len(differ) else both
            if common < len(child[0]):
                rest = [child[0][common:], child[1], child[2], child[3], child[4]]
                child[0], child[1], child[4] = child[0][:common], {rest[0][0]: rest}, []
            node, tokens = child, tokens[common:]

    def search(self, tokens: np.ndarray, percent: int) -> list[int]:
        """Names of the sets whose similarity with ``tokens`` reaches ``percent``."""
        n, order = len(tokens), np.argsort(tokens)
        by_hash, found = tokens[order], []
        stack = [(child, 0, 0, 0) for child in self.root[1].values()]
        while stack:
            (own, children, least, most, names), depth, overlap, used = stack.pop()
            k = np.minimum(np.searchsorted(by_hash, own), n - 1)
            hit = by_hash[k] == own
            overlap, depth = overlap + int(hit.sum()), depth + len(own)
            if hit.any():
                used = max(used, int(order[k[hit]].max()) + 1)  # no shingle before it can still be shared
            found += [x for x in names if similar(overlap, n, depth, percent)]
            reach = overlap + min(n - used, most - depth)
            if children and similar(reach, n, max(least, reach), percent):
                stack += [(child, depth, overlap, used) for child in children.values()]
        return found


def text_sets(docs: DataFrame) -> tuple[DataFrame, Order]:
    """(doc_id, key: hash of the text, n, node, bits) of every document, and the
    global order. A task emits the counts of the buckets that it saw."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(COUNTS, np.int64)
        names = ["doc_id", "key", "n", "node", "bits", "buckets", "counts"]
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for b in batches:
            rows, at = [], [np.empty(0, np.uint64)]
            for text in b["text"].to_pylist():
                s = shingle_set(hashes.of(text), SHINGLE)
                at.append(s & np.uint64(COUNTS - 1))
                rows.append((len(s), digest(s), parity_bitmap(s)) if len(s) else (0, None, None))
            counts += np.bincount(np.concatenate(at).view(np.int64), minlength=COUNTS)
            own = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((), (), ()), kinds[2:5])]
            yield pa.record_batch([b["doc_id"], b["key"], *own, *(pa.nulls(len(rows), k) for k in kinds[5:])], names)
        seen = np.flatnonzero(counts)
        if len(seen):
            ends = np.append(np.arange(0, len(seen), CHUNK), len(seen)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (seen.astype(np.int32), counts[seen])]
            yield pa.record_batch([*(pa.nulls(len(ends) - 1, k) for k in kinds[:5]), *lists], names)
            del lists
        del hashes, counts, seen
        give_back()

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    rows = texts.mapInArrow(run, "doc_id long, key long, n long, node long, bits binary, buckets array<int>, counts array<long>")
    table = shared_table(rows, "shingle-sets")
    each = table.where("buckets is not null").select(F.inline(F.arrays_zip("buckets", "counts")))
    sums = each.groupBy("buckets").agg(F.sum("counts").alias("count")).toArrow()
    counts = np.zeros(COUNTS, np.int64)  # as many numbers whatever the corpus
    counts[sums["buckets"].to_numpy()] = sums["count"].to_numpy()
    return table.where("buckets is null").select("doc_id", "key", "n", "node", "bits"), Order.of(counts)


def prefix_entries(docs: DataFrame, order: Order, percent: int) -> DataFrame:
    """shingle, slice, slices, node, n, place of every prefix entry; texts of one
    set that a task sees again add none."""
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, hashes, seen = sent.value, WordHashes(), set()
        for b in batches:
            parts = []
            for text in b["text"].to_pylist():
                s = shingle_set(hashes.of(text), SHINGLE)
                node = digest(s)
                if not len(s) or node in seen:
                    continue
                seen.add(node)
                first = order.sort(s)[: prefix_length(len(s), percent)]
                parts.append((first, np.full(len(first), node), np.full(len(first), len(s) << 32) + np.arange(len(first))))
            if parts:
                shingles, nodes, sizes = (np.concatenate(x) for x in zip(*parts))
                slices = order.slices[shingles & np.uint64(COUNTS - 1)]
                yield pa.record_batch([shingles.view(np.int64), (mixed(nodes) % slices).astype(np.int16), slices, nodes, sizes], ["shingle", "slice", "slices", "node", "at"])
        del hashes, seen
        give_back()

    return docs.select("text").mapInArrow(run, "shingle long, slice short, slices short, node long, at long")


def mixed(nodes: np.ndarray) -> np.ndarray:
    return ((nodes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)


def _could_link(a: str, b: str, percent: int) -> Column:
    """Sizes and places (size << 32 | place) that allow the similarity."""
    size = lambda x: F.shiftright(F.col(x), 32)
    left = lambda x: size(x) - F.col(x).bitwiseAND(F.lit((1 << 32) - 1))
    return F.least(left(a), left(b)) * (100 + percent) >= (size(a) + size(b)) * percent


def _largest_partner(at: str, percent: int) -> Column:
    """The largest set that can be similar, if this is the first shared shingle."""
    size = F.shiftright(F.col(at), 32)
    left = size - F.col(at).bitwiseAND(F.lit((1 << 32) - 1))
    return F.floor(left * (100 + percent) / percent) - size


def _inner(at: str, percent: int) -> Column:
    """Whether an entry is in the inner prefix: a set of at least its size can be similar."""
    size = F.shiftright(F.col(at), 32)
    return (size - F.col(at).bitwiseAND(F.lit((1 << 32) - 1))) * (100 + percent) >= size * 2 * percent


def _pairs_with_first(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Entries of shingles that more than one node has, and the pairs of their
    nodes with the first node of the shingle (or of its slice)."""
    entries = entries.withColumn("inner", _inner("at", percent))
    # a text that others are edited from has few rare shingles of its own: what it shares comes early in its order
    central = [F.desc("inner"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)), F.col("node")]
    order = Window.partitionBy("shingle", "slice").orderBy(*central)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = entries.select(
        "shingle", "slices", "node", "at", "inner",
        F.first("node").over(so_far).alias("first"),
        F.first("at").over(so_far).alias("first_at"),
        F.first("inner").over(so_far).alias("first_inner"),
        F.lead("node").over(order).alias("after"),
    )
    # a node that two tasks saw has equal rows, next to each other: the last counts, which sees what follows
    last = F.col("after").isNull() | (F.col("after") != F.col("node"))
    met = (F.col("first") != F.col("node")) | F.col("after").isNotNull()
    kept = run.where(last & ((met & F.col("first_inner")) | (F.col("slices") > 1)))
    kept = shared_table(kept.drop("after", "first_inner"), "prefix-entries")
    firsts = kept.where((F.col("first") == F.col("node")) & (F.col("slices") > 1))
    over = Window.partitionBy("shingle").orderBy(*central).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    second = firsts.select("node", "at", F.first("node").over(over).alias("first"), F.first("at").over(over).alias("first_at"))
    both = kept.select("node", "at", "first", "first_at").unionByName(second)
    fit = both.where((F.col("node") != F.col("first")) & _could_link("at", "first_at", percent))
    return kept, fit.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that their bitmaps do not rule out."""

    @F.pandas_udf("boolean")
    def possible(a: pd.Series, b: pd.Series, sizes: pd.Series) -> pd.Series:
        least = np.array([least_difference(x, y) for x, y in zip(a, b)], np.int64)
        return pd.Series(least * (100 + percent) <= sizes.to_numpy() * (100 - percent))

    side = lambda c: nodes.select(F.col("node").alias(c), F.col("bits").alias(f"{c}_bits"), F.col("n").alias(f"{c}_n"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.where(possible("a_bits", "b_bits", F.col("a_n") + F.col("b_n"))).select("a", "b")


def _sets_of(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, order: Order) -> DataFrame:
    """(node, tokens: the set in the global order) of the nodes in ``pairs``, from
    one document each, or from the rows without doc_id. A doc_id may repeat with
    other texts, whose sets no pair names."""
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, hashes = sent.value, WordHashes()
        for b in batches:
            sets = [shingle_set(hashes.of(t), SHINGLE) for t in b["text"].to_pylist()]
            tokens = pa.array([order.sort(s).tobytes() for s in sets], pa.binary())
            yield pa.record_batch([pa.array([digest(s) for s in sets], pa.int64()), tokens], ["node", "tokens"])
        del hashes
        give_back()

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = shared_table(nodes.join(ends, "node").select("node", F.col("one").alias("wanted")), "wanted-documents")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.select("wanted").distinct(), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    found = texts.select("text").mapInArrow(run, "node long, tokens binary")
    return shared_table(found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "ordered-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity: a's partners, in parts
    of bounded size, are a trie that a's set walks."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    dealt = shared_table(dealt.select("a", "b", "part"), "dealt-pairs")
    probes = dealt.select("a", "part").distinct().join(sets.select(F.col("node").alias("a"), "tokens"), "a")
    partners = dealt.select("b", F.col("a").alias("of"), F.col("part").alias("of_part")).join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("set")), "b")

    def join(probe: pd.DataFrame, partner: pd.DataFrame) -> pd.DataFrame:
        if not len(probe) or not len(partner):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        trie = SetTrie()
        for name, tokens in zip(partner["b"], partner["set"]):
            trie.add(name, np.frombuffer(tokens, np.uint64))
        found = trie.search(np.frombuffer(probe["tokens"][0], np.uint64), percent)
        return pd.DataFrame({"a": probe["a"][0], "b": np.array(found, np.int64)})

    grouped = probes.groupBy("a", "part").cogroup(partners.groupBy("of", "of_part"))
    return grouped.applyInPandas(join, "a long, b long")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared shingles of each of the sets ``left`` with each of the sets ``right``."""
    names, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    everywhere = held == len(sets)  # the same for all pairs
    both = np.full((len(left), len(right)), int(everywhere.sum()), np.int64)
    some = (held > 1) & ~everywhere
    place, used = np.cumsum(some) - 1, some[column]
    row, column = row[used], place[column[used]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(some.sum()), WIDTH):
        a, b = np.searchsorted(column, (low, low + WIDTH))
        has = np.zeros((len(sets), WIDTH), np.float32)
        has[row[a:b], column[a:b] - low] = 1
        both += (has[left] @ has[right].T).astype(np.int64)
    return both


def _link_counts(places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n_links) of the nodes in ``places`` (node, component, blocks) that
    are similar to others of their component."""
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("other")
    met = places.withColumn("own", own).join(sets, "node")
    met = met.select("node", "tokens", "component", "own", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other"))

    def count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in group["tokens"]]
        own, n = group["own"].to_numpy(), np.array([len(x) for x in sets], np.int64)
        left, right = np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2])
        both = overlaps(sets, left, right)
        linked = similar(both, n[left][:, None], n[right][None, :], percent)
        if key[1] == key[2]:
            np.fill_diagonal(linked, False)
            found, counts = left, linked.sum(1)
        else:
            found, counts = np.append(left, right), np.append(linked.sum(1), linked.sum(0))
        return pd.DataFrame({"node": group["node"].to_numpy()[found], "n_links": counts.astype(np.int64)})

    pairs = met.groupBy("component", F.least("own", other).alias("i"), F.greatest("own", other).alias("j"))
    return pairs.applyInPandas(count, "node long, n_links long").groupBy("node").agg(F.sum("n_links").alias("n_links"))


def _pairs_between(entries: DataFrame, labels: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components that share a prefix shingle and
    were not compared yet; the smaller set's entry is inner."""
    named = entries.select("shingle", "node", "at", "inner").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = shared_table(named, "named-entries")
    place = F.col("at").bitwiseAND(F.lit((1 << 32) - 1))
    groups = named.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.max("inner").alias("inner"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"), F.min(F.struct("node", place.alias("place"))).alias("least"),
    )
    # of shingles with the same nodes, the first in the global order, which all these nodes see first
    mixed = groups.where("inner and low < high").groupBy("n", "x", "y").agg(F.min(F.struct("least.place", "shingle")).alias("m")).select("m.shingle")
    open_ = shared_table(named.join(mixed, "shingle"), "open-entries")
    # components meet only where some entries' sizes and caps let them
    sized = open_.withColumns({"size": F.shiftright("at", 32), "cap": _largest_partner("at", percent)})
    own = lambda c: F.when(F.col("inner"), F.col(c))
    held = sized.groupBy("shingle", "component").agg(
        F.min(own("size")).alias("inner_size"), F.max(own("cap")).alias("inner_cap"),
        F.min("size").alias("least_size"), F.max("size").alias("most_size"), F.max("cap").alias("most_cap"),
    )
    other = held.select("shingle", F.col("component").alias("other"), *(F.col(c).alias(f"other_{c}") for c in ("least_size", "most_size", "most_cap")))
    meet = "component <> other and inner_size <= least(other_most_cap, other_most_size) and other_least_size <= inner_cap"
    between = held.where("inner_cap is not null").join(other, "shingle").where(meet).drop("least_size", "most_size", "most_cap")
    left = sized.where("inner").select("shingle", "component", F.col("node").alias("x"), F.col("at").alias("x_at"), F.col("size").alias("x_size"), F.col("cap").alias("x_cap"))
    left = left.join(between, ["shingle", "component"]).where("x_size <= least(other_most_cap, other_most_size) and other_least_size <= x_cap")
    right = sized.select("shingle", F.col("component").alias("other"), F.col("node").alias("y"), F.col("at").alias("y_at"))
    met = left.join(right, ["shingle", "other"]).where(_could_link("x_at", "y_at", percent) & (F.shiftright("x_at", 32) <= F.shiftright("y_at", 32)))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    turned = seen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(turned, ["a", "b"], "left_anti")


def _judged(docs: DataFrame, percent: int, count: bool) -> DataFrame:
    """doc_id, key, node, n_shingles, component_id, root (a node of the component)
    and n_links of every document; links are only counted if asked for."""
    table, order = text_sets(docs)
    entries, first_pairs = _pairs_with_first(prefix_entries(docs, order, percent), percent)
    first_pairs = shared_table(first_pairs, "first-pairs")
    keyed = table.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("one"), F.max("n").alias("n"), F.max("bits").alias("bits"))
    keyed = shared_table(keyed, "nodes")

    def compared(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        near = shared_table(_possible(pairs, keyed, percent), "possible-pairs")
        sets = _sets_of(near, keyed, docs, order)
        return shared_table(_verified(near, sets, percent), "links-found"), sets

    links, sets = compared(first_pairs)
    labels = shared_table(connected_components(links), "labels")
    rest = shared_table(_pairs_between(entries, labels, first_pairs, percent), "rest-pairs")
    more, more_sets = compared(rest) if rest.take(1) else (rest, None)
    if more.take(1):
        joined = labels.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more)
        labels = shared_table(connected_components(joined), "labels")
        sets = sets.unionByName(more_sets.join(sets.select("node"), "node", "left_anti"))
    named = labels.join(keyed.select("node", "one", "n"), "node")
    groups = named.groupBy("component").agg(F.min("one").alias("component_id"), F.count("*").alias("size"), F.sum("n").alias("shingles"))
    names = named.join(groups, "component")
    if count:
        blocks = F.ceil(F.greatest(F.col("size") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES))
        names = shared_table(names.select("node", "component", "component_id", "size", blocks.alias("blocks")), "dealt-nodes")
        degrees = _link_counts(names.where("size > 2").select("node", "component", "blocks"), sets, percent)
        names = names.join(degrees, "node", "left").withColumn("n_links", F.when(F.col("size") == 2, F.lit(1)).otherwise(F.col("n_links")).cast("long"))
    else:
        names = names.withColumn("n_links", F.lit(None).cast("long"))
    linked = shared_table(names.select("node", "component_id", F.col("component").alias("root"), "n_links"), "linked-nodes")
    whole = keyed.select("node", "one").join(linked, "node", "left")
    whole = whole.select("node", F.coalesce("component_id", "one").alias("component_id"), F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = table.join(whole, "node", "left")
    alone = F.col("node").isNull()
    return out.select("doc_id", "key", "node", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def components_of(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every document; ``n_links``
    counts the other sets that its set is linked with."""
    return _judged(docs, percent, count=True).select("doc_id", "n_shingles", "component_id", "n_links")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one document of each component, see above;
    documents without shingles all stay. Columns must be orderable."""
    judged = shared_table(_judged(docs, percent, count=False).select("doc_id", "key", "node", "root"), "judged-documents")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "key"))
    kept = judged.where("root is not null").groupBy("root").agg(first.alias("f")).select("f.doc_id", "f.key")
    rows_of = judged.where("root is not null").groupBy("doc_id", "key").agg(F.count("*").alias("rows"))
    p = free_prefix(docs)
    same = rows_of["doc_id"].eqNullSafe(kept["doc_id"]) & (rows_of["key"] == kept["key"])
    kept = kept.join(rows_of, same).select(kept["doc_id"].alias(f"{p}id"), kept["key"].alias(f"{p}key"), (F.col("rows") > 1).alias(f"{p}repeats"))
    kept = shared_table(kept, "kept-documents")
    met = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{p}id")) & (F.xxhash64("text") == F.col(f"{p}key"))
    found = docs.join(kept, met)
    names = [F.col(f"`{c}`") for c in docs.columns]
    once = found.where(~F.col(f"{p}repeats")).select(*names)
    least = found.where(f"{p}repeats").groupBy(f"{p}id", f"{p}key").agg(F.min(F.struct(*names)).alias("f")).select("f.*")
    wordless = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return once.unionByName(least).unionByName(wordless)
