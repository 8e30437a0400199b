"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

A document is the set of its distinct k-word shingles. Two link when the
Jaccard similarity reaches ``threshold_pct`` per cent; a link therefore needs
T = ceil(p (|x| + |y|) / (100 + p)) common shingles.

1. ``shingle_sets``: one pass over the texts gives size, a 128-bit fingerprint
   of the set, its ``n - T + 1`` first shingles in a global order (longest
   first: long shingles are the rare ones, then by hash) and a parity bitmap.
   Documents with equal sets are one node.
2. Short lists, spread by Spark: the postings of those first shingles. A pair
   that links shares at least one of them (all other lists may be skipped:
   DivideSkip with the T - 1 longest lists set aside). Each (shingle, size
   class) list is a star to its smallest member; a pair stays if the bitmaps
   allow it: the number of differing parity bits never exceeds the true
   symmetric difference, so no link is lost. Lists whose members are not
   one component then are searched for other pairs, members of one component
   left out; these pairs join components, not documents.
3. The components of that candidate graph are blocks. Each block gets its
   whole texts and is searched exactly with ``DivideSkip``: heap-merge of the
   short lists, binary probes of the long ones. A task that has the whole
   block has its components too. A block beyond ``block_shingles`` is dealt over several tasks: first its smallest document
   is the query against all, then every document that it did not link is a
   query against all; documents linked by the first are connected already.

Shingles are compared by 64-bit hash. Null or wordless text: empty set, linked
with nothing. Rows that repeat a doc_id are one node. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sparkretail.llm.components import components, stored
from sparkretail.llm.textops import hash_texts, mix64
from sparkretail.session import scratch_path, temporary

_U = np.uint64

SETS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("fp1", T.LongType()), T.StructField("fp2", T.LongType()),
    T.StructField("head", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()),
])


def required_overlap(nx, ny, p: int):
    """Common shingles that 100 * i >= p * union asks for."""
    return -(-(p * (nx + ny)) // (100 + p))


def ordered_sets(arr: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, set)`` of every text: distinct shingle keys, ascending. A key
    is 6 bits of shingle length (long ones first) and 58 bits of hash."""
    for a, b, h, first, length in hash_texts(arr, k):
        key = ((63 - np.minimum(length, 63)).astype(np.uint64) << _U(58)) | (h >> _U(6))
        for d in range(b - a):
            s = np.sort(key[first[d]:first[d + 1]])
            yield a + d, s if len(s) < 2 else s[np.concatenate([[True], s[1:] != s[:-1]])]


def parity_bits(s: np.ndarray) -> bytes:
    """Parity bitmap of a set, at least two bits a member, a power of two."""
    size = max(64, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 64
    at = (mix64(s) & _U(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8)).tobytes()


def fold(bits: bytes, size: int) -> np.ndarray:
    """The bitmap of ``size`` bytes as words; a longer one is folded (parity
    of the halves' sum), which keeps the bound."""
    a = np.frombuffer(bits, np.uint8)
    while len(a) > size:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a.view(np.uint64)


def shingle_sets(docs: DataFrame, k: int, p: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            n, f1, f2, heads, bits = [], [], [], [], []
            for _, s in ordered_sets(batch.column(1), k):
                n.append(len(s))
                f1.append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)))
                f2.append(int(mix64(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))
                heads.append(s[:len(s) - -(-p * len(s) // 100) + 1].astype(np.int64))
                bits.append(parity_bits(s))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=SETS_SCHEMA.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, SETS_SCHEMA)


def _may_link(nx: np.ndarray, ny: np.ndarray, differ: np.ndarray, p: int) -> np.ndarray:
    """Whether sizes and differing parity bits allow a link."""
    return (differ <= nx + ny - 2 * required_overlap(nx, ny, p)) \
        & (100 * np.minimum(nx, ny) >= p * np.maximum(nx, ny))


def _possible_pairs(pairs: DataFrame, p: int) -> DataFrame:
    """Pairs ``(a, na, ba, b, nb, bb)`` whose bitmaps allow a link."""
    def run(batches):
        for t in batches:
            na, nb = t.column("na").to_numpy(), t.column("nb").to_numpy()
            ba, bb = t.column("ba").to_pylist(), t.column("bb").to_pylist()
            differ = np.zeros(len(na), np.int64)
            for i, (x, y) in enumerate(zip(ba, bb)):
                size = min(len(x), len(y))
                differ[i] = np.bitwise_count(fold(x, size) ^ fold(y, size)).sum()
            keep = pa.array(_may_link(na, nb, differ, p))
            yield pa.RecordBatch.from_arrays([t.column("a").filter(keep), t.column("b").filter(keep)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def join_forest(n: np.ndarray, comp: np.ndarray, bits: list[bytes], p: int) -> list[tuple[int, int]]:
    """Edges that connect whatever the sizes and bitmaps of one list allow to
    link, beyond the components known already. Members of the largest
    component are compared only with the others."""
    names, counts = np.unique(comp, return_counts=True)
    if len(names) < 2:
        return []
    size = min(map(len, bits))
    m = np.stack([fold(b, size) for b in bits])
    label, main, out = comp.copy(), names[np.argmax(counts)], []
    for x in np.flatnonzero(comp != main):
        y = np.flatnonzero(label != label[x])
        if len(y) == 0:
            continue
        y = y[_may_link(n[x], n[y], 0, p)]
        if len(y) == 0:
            continue
        y = y[_may_link(n[x], n[y], np.bitwise_count(m[y] ^ m[x]).sum(axis=1, dtype=np.int64), p)]
        for z in y:
            if label[z] != label[x]:
                out.append((int(x), int(z)))
                label[label == label[z]] = label[x]
    return out


def _rest_of_lists(rows: DataFrame, p: int) -> DataFrame:
    """Further candidate pairs, of the components of their members, from lists
    that are not one component. Lists are many and small: they pass as sorted
    runs through one task each."""
    def run(batches):
        rest = None
        for t in batches:
            t = pa.Table.from_batches([t] if rest is None else [rest, t])
            key, part = t.column("list").to_numpy(), t.column("part").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
            # the last run may go on in the next batch
            yield _forests(t.slice(0, cut[-1]), cut, p)
            rest = t.slice(cut[-1]).combine_chunks().to_batches()[0]
        if rest is not None:
            yield _forests(pa.Table.from_batches([rest]), np.array([0, rest.num_rows]), p)

    return (rows.select("list", "part", "n", "comp", "bits").repartition("list", "part")
            .sortWithinPartitions("list", "part").mapInArrow(run, "a long, b long"))


def _forests(t: pa.Table, cut: np.ndarray, p: int) -> pa.RecordBatch:
    n, comp = (t.column(c).to_numpy() for c in ("n", "comp"))
    bits, a, b = t.column("bits").to_pylist(), [], []
    for lo, hi in zip(cut, cut[1:]):
        for x, y in join_forest(n[lo:hi], comp[lo:hi], bits[lo:hi], p):
            a.append(comp[lo + x])
            b.append(comp[lo + y])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class DivideSkip:
    """Inverted lists over a block of sets and exact T-occurrence search."""

    MU = 0.0085  # weight of the long-list count, as published for DivideSkip
    HEAP_MOST = 4096  # postings merged through the heap; beyond, the same merge by counting

    def __init__(self, sets: list[np.ndarray], p: int):
        self.p, self.sets = p, sets
        self.n = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(tokens, kind="stable")  # owners stay ascending in each list
        self.posting = owner[order]
        t = tokens[order]
        cut = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
        self.token, self.start = t[cut], np.append(cut, len(t))

    def search(self, q: np.ndarray) -> np.ndarray:
        """Rows of the block whose Jaccard similarity with ``q`` reaches the
        threshold."""
        none = np.zeros(0, np.int64)
        if len(q) == 0 or len(self.token) == 0:
            return none
        at = np.minimum(np.searchsorted(self.token, q), len(self.token) - 1)
        at = at[self.token[at] == q]
        least = -(-self.p * len(q) // 100)  # T for the smallest partner
        if len(at) < least:
            return none
        size = self.start[at + 1] - self.start[at]
        order = np.argsort(size, kind="stable")
        at, size = at[order], size[order]
        skip = min(least - 1, int(least / (self.MU * math.log2(max(2, size[-1])) + 1)))
        short, long_ = at[:len(at) - skip], at[len(at) - skip:]
        lists = [self.posting[self.start[i]:self.start[i + 1]] for i in short]
        if size[:len(short)].sum() <= self.HEAP_MOST:
            rows, counts, last = [], [], -1
            for r in heapq.merge(*[x.tolist() for x in lists]):
                if r == last:
                    counts[-1] += 1
                else:
                    rows.append(r)
                    counts.append(1)
                    last = r
            rows, counts = np.array(rows, np.int64), np.array(counts, np.int64)
        else:
            c = np.bincount(np.concatenate(lists), minlength=len(self.sets))
            rows = np.flatnonzero(c)
            counts = c[rows]
        need = required_overlap(len(q), self.n[rows], self.p)
        keep = (counts >= need - skip) & (need <= np.minimum(len(q), self.n[rows]))
        rows, counts, need = rows[keep], counts[keep], need[keep]
        for left, i in zip(range(len(long_), 0, -1), long_):
            if len(rows) == 0:
                break
            one = self.posting[self.start[i]:self.start[i + 1]]
            pos = np.minimum(np.searchsorted(one, rows), len(one) - 1)
            counts = counts + (one[pos] == rows)
            if left % 16 == 1:  # drop those that the lists left cannot bring to T
                keep = counts + left - 1 >= need
                rows, counts, need = rows[keep], counts[keep], need[keep]
        return rows[counts >= need]


def block_links(ids: np.ndarray, sets: list[np.ndarray], p: int) -> list[tuple[int, int]]:
    """Edges that make up the components of one block. Rows found by the first
    query are one component; the others are all queries, against every row."""
    index = DivideSkip(sets, p)
    out: list[tuple[int, int]] = []
    done: set[int] = set()
    order = np.argsort(ids, kind="stable")
    label = np.arange(len(ids))
    main = order[0] if len(order) else 0
    for i in order:
        if label[i] == label[main] and i != main:
            continue  # linked to the main component: its edges inside it add nothing, others come from the other end
        for j in index.search(sets[i]):
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                old, new = (label[i], label[j]) if label[j] == label[main] else (label[j], label[i])
                label[label == old] = new
        done.add(int(i))
    return out


def smallest_linked(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Every node of the edges with the smallest one it is connected to, but
    for that one itself."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in edges:
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    return [(x, root(x)) for x in up if root(x) != x]


def _search_blocks(rows: DataFrame, k: int, p: int) -> DataFrame:
    """Linked documents and the smallest of their component, in blocks that fit
    one task: ``(block, doc_id, text)``."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        sets = [s for _, s in ordered_sets(table.column("text"), k)]
        e = smallest_linked(block_links(ids, sets, p))
        return pa.table({"a": pa.array([x for x, _ in e], pa.int64()), "b": pa.array([y for _, y in e], pa.int64())})

    return rows.select("block", "doc_id", "text").groupBy("block").applyInArrow(run, "a long, b long")


def _search_queries(rows: DataFrame, k: int, p: int) -> DataFrame:
    """Links of the query rows of each (block, part) with its data rows:
    ``(block, part, is_query, doc_id, text)``."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        query = table.column("is_query").to_numpy(zero_copy_only=False)
        sets = [s for _, s in ordered_sets(table.column("text"), k)]
        data = np.flatnonzero(~query)
        index = DivideSkip([sets[i] for i in data], p)
        a, b = [], []
        for i in np.flatnonzero(query):
            hit = ids[data[index.search(sets[i])]]
            a.append(np.full(len(hit), ids[i]))
            b.append(hit)
        z = [np.zeros(0, np.int64)]
        return pa.table({"a": pa.array(np.concatenate(z + a), pa.int64()), "b": pa.array(np.concatenate(z + b), pa.int64())})

    return (rows.select("block", "part", "is_query", "doc_id", "text").groupBy("block", "part")
            .applyInArrow(run, "a long, b long"))


def candidate_blocks(sets: DataFrame, p: int, list_rows: int = 4096) -> DataFrame:
    """``(doc_id, block)`` of every set representative that may link with
    another one. ``sets``: one row per distinct set (doc_id, n, head, bits)."""
    step = -math.log(p / 100) * 1.001
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(step))
    by_token = W.partitionBy("token").orderBy("doc")
    shared = stored(
        sets.select("doc_id", "n", F.explode("head").alias("token"))
        .select("token", F.col("doc_id").alias("doc"), F.col("n").cast("int").alias("n"))
        .withColumn("x", F.lead("doc").over(by_token)).withColumn("y", F.lag("doc").over(by_token))
        .where("x is not null or y is not null").drop("x", "y"), "postings")
    lists = (shared.withColumn("c", size_class)
             .withColumn("g", F.explode(F.array(F.col("c"), F.col("c") + 1)))
             .select(F.xxhash64("token", "g").alias("list"), "doc", "n"))
    heads = (lists.groupBy("list")
             .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("rows"),
                  F.sum(F.xxhash64("doc").cast("decimal(20,0)")).alias("members"))
             .where("low < high")
             .groupBy("low", "high", "rows", "members").agg(F.min("list").alias("list")))  # one of equal lists
    heads = stored(heads.select("list", "low", "rows"), "lists")
    lists = stored(lists.join(heads, "list"), "members")
    bits = sets.select(F.col("doc_id").alias("doc"), F.col("n").cast("long").alias("n"), "bits")
    star = lists.where("doc <> low").select(F.col("doc").alias("a"), F.col("low").alias("b")).distinct()
    pairs = (star.join(bits.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), "a")
             .join(bits.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb")), "b"))
    first = stored(_possible_pairs(pairs.select("a", "na", "ba", "b", "nb", "bb"), p), "star")
    comp = stored(components(first, "a", "b"), "stars")
    known = (lists.select("list", "rows", "doc").join(comp.withColumnRenamed("node", "doc"), "doc", "left")
             .select("list", "rows", "doc", F.coalesce("component", "doc").alias("comp")))
    mixed = known.groupBy("list").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                      F.max("rows").alias("r")).where("x < y and r > 2").select("list")
    parts = F.ceil(F.col("rows") / F.lit(list_rows)).cast("int")
    rest = (known.join(mixed, "list").join(bits, "doc")
            .withColumn("m", parts).withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("m")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
            .withColumn("part", F.least("mine", "o") * F.col("m") + F.greatest("mine", "o")))
    top = components(_rest_of_lists(rest, p), "a", "b").select(F.col("node").alias("top"), F.col("component").alias("block"))
    alone = top.join(comp, top["top"] == comp["node"], "left_anti")  # in no star
    return (comp.join(top, comp["component"] == top["top"], "left")
            .select(F.col("node").alias("doc_id"), F.coalesce("block", "component").alias("block"))
            .union(alone.select("top", "block")))


def _search_big_blocks(texts: DataFrame, kept: DataFrame, k: int, p: int, block_shingles: int) -> DataFrame:
    """Links in blocks that are dealt over ``parts`` tasks: ``(block, parts,
    doc_id, text)``."""
    big = texts.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    everywhere = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cols = ["block", "part", "is_query", "doc_id", "text"]
    data = big.withColumn("is_query", F.lit(False))
    lead = big.where("doc_id = block").withColumn("is_query", F.lit(True)).withColumn("part", everywhere)
    led = stored(_search_queries(data.select(cols).union(lead.select(cols)), k, p), "led")
    other = big.join(led.select(F.col("b").alias("doc_id")).distinct(), "doc_id", "left_anti")
    rounds = (other.join(kept, "doc_id").groupBy("block")
              .agg(F.ceil(F.sum("n_shingles") / F.lit(block_shingles)).cast("int").alias("rounds")))
    other = (other.join(rounds, "block").withColumn("round", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("rounds")))
             .withColumn("is_query", F.lit(True)).withColumn("at", everywhere))
    data = (data.join(rounds, "block").withColumn("round", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)))
            .withColumn("at", F.col("part")))
    both = [x.select("block", (F.col("round") * F.col("parts") + F.col("at")).cast("int").alias("part"), "is_query",
                     "doc_id", "text") for x in (data, other)]
    found = _search_queries(both[0].union(both[1]), k, p)
    return led.union(found)


def ngram_jaccard_join(docs: DataFrame, k: int = 5, threshold_pct: int = 80,
                       block_shingles: int = 1_500_000) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id,
    text): the size of its shingle set and the smallest doc_id reachable by
    links, its own included."""
    p = threshold_pct
    sets = stored(shingle_sets(docs, k, p), "sets")
    same = (sets.where("n_shingles > 0").groupBy("n_shingles", "fp1", "fp2")
            .agg(F.min("doc_id").alias("rep")))
    member = stored(sets.select("doc_id", "n_shingles", "fp1", "fp2")
                    .join(same, ["n_shingles", "fp1", "fp2"], "left")
                    .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), "classes")
    kept = member.where("doc_id = rep and n_shingles > 0").select("doc_id", "n_shingles").distinct()
    one = sets.join(kept, ["doc_id", "n_shingles"]).withColumnRenamed("n_shingles", "n")
    blocks = stored(candidate_blocks(one, p), "blocks")

    weight = blocks.join(kept, "doc_id").groupBy("block").agg(F.sum("n_shingles").alias("weight"))
    many = F.ceil(F.col("weight") / F.lit(block_shingles)).cast("int")
    where = blocks.join(weight.select("block", many.alias("parts")), "block")
    texts = stored(docs.select(F.col("doc_id").cast("long"), "text").join(where, "doc_id")
                   .select("block", "parts", "doc_id", "text"), "texts")
    low = stored(_search_blocks(texts.where("parts = 1"), k, p), "links")
    edges = low
    root = low.select(F.col("a").alias("rep"), F.col("b").alias("component"))
    if texts.where("parts > 1").select("parts").limit(1).count():
        links = stored(_search_big_blocks(texts.where("parts > 1"), kept, k, p, block_shingles), "links")
        edges = low.union(links)
        root = root.union(components(links, "a", "b"))

    repeats = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # equal sets hang on their representative: one join, no further rounds, unless a doc_id has several sets
    several = (member.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y"))
               .where("x < y").limit(1).count())
    if several:
        root = components(edges.union(repeats), "a", "b").select(F.col("node").alias("doc_id"), "component")
        return member.join(root, "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return member.join(root, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def one_of_each_group(docs: DataFrame, k: int = 5, threshold_pct: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked rows: that of the smallest
    doc_id (null last), of the rows of one doc_id the first. Every row is a
    document of its own, so rows that share a doc_id and not the text both stay."""
    number = "row_number"
    while number in docs.columns:
        number += "_"
    spark = docs.sparkSession
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    gone = scratch_path(spark, "gone")
    with temporary(spark):  # what the join stores is read no more once the rows to drop are written
        groups = ngram_jaccard_join(rows.select(F.col(number).alias("doc_id"), "text"), k, threshold_pct)
        place = F.struct(F.col("id").isNull().alias("last"), "id", "row")
        members = (groups.select(F.col("doc_id").alias("row"), "component_id")
                   .join(rows.select(F.col(number).alias("row"), F.col("doc_id").alias("id")), "row"))
        first = members.groupBy("component_id").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
        (members.join(first, "component_id").where(F.col("row") != F.col("first.row"))
         .select(F.col("row").alias(number)).write.parquet(gone))
    return rows.join(spark.read.parquet(gone), number, "left_anti").select(*docs.columns)
