"""Document fingerprints by MinHash.

``Hasher`` applies ``permutations`` universal hash functions (multiply, add,
keep the high half) to the k-word shingles of each text in numpy and keeps the
smallest value of each. A fingerprint is the hex text of these 32-bit minima;
the share of equal minima estimates the Jaccard similarity of two shingle sets.

``near_duplicates`` joins bands of the signature in Spark and verifies by exact
Jaccard similarity of the shingle sets. Null or wordless texts have an empty
set, the fingerprint of all ones, and are never near duplicates.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretail.llm.components import components, stored
from sparkretail.llm.textops import hash_texts

_U = np.uint64


class Hasher:
    def __init__(self, permutations: int = 64, k: int = 5, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.k, self.m = k, permutations
        self.a = rng.integers(1, 2**63, permutations, dtype=np.uint64) | _U(1)
        self.b = rng.integers(0, 2**63, permutations, dtype=np.uint64)

    def signatures(self, arr: pa.Array) -> np.ndarray:
        """uint32 matrix, one row per text."""
        out = np.full((len(arr), self.m), 0xFFFFFFFF, np.uint32)
        for a, b, h, first, _ in hash_texts(arr, self.k):
            full = np.flatnonzero(np.diff(first))
            if len(full) == 0:
                continue
            cuts = first[full]
            # runs of documents that stay in the processor's cache
            at = 0
            while at < len(full):
                to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 32768)))
                lo, hi = cuts[at], first[full[to - 1] + 1]
                part, rows = h[lo:hi], a + full[at:to]
                for j in range(self.m):
                    out[rows, j] = np.minimum.reduceat((part * self.a[j] + self.b[j]) >> _U(32), cuts[at:to] - lo)
                at = to
        return out


def to_text(sig: np.ndarray) -> list[str]:
    return [row.astype("<u4").tobytes().hex() for row in sig]


def successor_blocks(docs: DataFrame, rows_per_block: int = 1000) -> tuple[DataFrame, int]:
    """``docs`` dealt into ranges of doc_id, plus the first row of the next
    range with each one (after the last range, the first row of all): columns
    ``block, extra, doc_id, text``; each text is shuffled once."""
    ids = docs.select("doc_id").where("doc_id is not null")
    n = ids.count()
    blocks = max(1, -(-n // rows_per_block))
    cuts = np.zeros(0, np.int64)
    if blocks > 1:
        share = [i / blocks for i in range(1, blocks)]
        cuts = np.unique(np.array(ids.agg(F.percentile_approx("doc_id", share, 100 * blocks)).first()[0], np.int64))

    def block(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, x.to_numpy(), "left").astype(np.int32))

    block_of = F.pandas_udf(block, "int")
    firsts = sorted((r.block, r.low) for r in ids.withColumn("block", block_of("doc_id")).groupBy("block")
                    .agg(F.min("doc_id").alias("low")).collect())
    number = np.array([b for b, _ in firsts], np.int32)
    low = np.array([x for _, x in firsts], np.int64)

    def before(x: pd.Series) -> pd.Series:
        """The range before the one that a doc_id begins, or -1."""
        at = np.searchsorted(low, x.to_numpy())
        begins = (at < len(low)) & (low[np.minimum(at, len(low) - 1)] == x.to_numpy())
        return pd.Series(np.where(begins, number[at - 1], -1).astype(np.int32))

    before_of = F.pandas_udf(before, "int")
    places = F.array(F.struct(F.lit(False).alias("extra"), F.col("block").alias("to")),
                     F.struct(F.lit(True).alias("extra"), F.col("before").alias("to")))
    dealt = (docs.where("doc_id is not null").withColumn("block", block_of("doc_id")).withColumn("before", before_of("doc_id"))
             .withColumn("c", F.explode(F.filter(places, lambda c: c["to"] >= 0))))
    return dealt.select(F.col("c.to").alias("block"), F.col("c.extra").alias("extra"), "doc_id", "text"), len(firsts)


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or
    all) of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FINGERPRINT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def fingerprints(docs: DataFrame, permutations: int = 64, k: int = 5, seed: int = 1) -> DataFrame:
    """``doc_id, fingerprint`` of every row; null text counts as empty."""
    def run(batches):
        hasher = Hasher(permutations, k, seed)
        for t in batches:
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(to_text(hasher.signatures(t.column(1))))],
                                             names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def edit_fingerprints(docs: DataFrame, permutations: int = 64, k: int = 5, seed: int = 1) -> DataFrame:
    """Fingerprints of every text and of its edit by the next document in
    ascending doc_id. A null doc_id has no place in that order: no row. Rows
    that repeat a doc_id follow each other in order of their text."""
    rows, blocks = successor_blocks(docs.select(F.col("doc_id").cast("long"), "text"))

    def run(batches):
        hasher = Hasher(permutations, k, seed)
        left = None  # the block's last row so far waits for its successor
        for t in batches:
            block, ids = t.column("block").to_pylist(), t.column("doc_id").to_pylist()
            extra, texts = t.column("extra").to_pylist(), t.column("text")
            sig, text = hasher.signatures(texts), [x or "" for x in texts.to_pylist()]
            out, size = [], 0
            for i in range(len(ids)):
                if left is not None and left[0] == block[i]:
                    e = edited(left[2], text[i])
                    out.append((left[1], len(left[2]), hashlib.sha256(e.encode()).hexdigest(), left[3], sig[i], e))
                    size += len(e)
                left = None if extra[i] else (block[i], ids[i], text[i], sig[i])
                if size > 1 << 21:
                    yield _result(out, hasher)
                    out, size = [], 0
            if out:
                yield _result(out, hasher)

    # the copied first row of the next range sorts last: it is larger, or after the last range
    return (rows.repartition(max(1, blocks // 4), "block").sortWithinPartitions("block", "extra", "doc_id", "text")
            .mapInArrow(run, FINGERPRINT_SCHEMA))


def _result(out: list, hasher: Hasher) -> pa.RecordBatch:
    own, nxt = np.stack([r[3] for r in out]), np.stack([r[4] for r in out])
    new = hasher.signatures(pa.array([r[5] for r in out], pa.large_string()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
         pa.array([r[2] for r in out]), pa.array(to_text(own)), pa.array(to_text(new)),
         pa.array((own == new).mean(axis=1)), pa.array((own == nxt).mean(axis=1))],
        names=FINGERPRINT_SCHEMA.names)


def near_duplicates(docs: DataFrame, threshold_pct: int = 80, permutations: int = 128, bands: int = 32,
                    k: int = 5, seed: int = 1) -> DataFrame:
    """``doc_id, class_id``: near-duplicate classes of ``docs``.

    Texts with equal signatures are one node. Each band of the signature is a
    bucket whose members are compared with its smallest one; a member that
    fails there is compared with the smallest one left in the next round, until
    every bucket is used up. Pairs are verified by the exact Jaccard similarity
    of the shingle sets (``threshold_pct`` per cent of the union). class_id is
    the smallest doc_id reachable."""
    rows = permutations // bands

    def run(batches):
        hasher = Hasher(permutations, k, seed)
        for t in batches:
            sig, sets = hasher.signatures(t.column(1)), {}
            for a, b, h, first, _ in hash_texts(t.column(1), k):
                for d in range(b - a):
                    sets[a + d] = np.unique(h[first[d]:first[d + 1]])
            key = [[hashlib.blake2b(bytes([j]) + s[j * rows:(j + 1) * rows].tobytes(), digest_size=12).hexdigest()
                    for j in range(bands)] if len(sets[i]) else [] for i, s in enumerate(sig)]
            yield pa.RecordBatch.from_arrays(
                [t.column(0), pa.array([hashlib.blake2b(sets[i].tobytes(), digest_size=16).hexdigest()
                                        for i in range(len(sig))]),
                 pa.array(key, pa.list_(pa.string())),
                 pa.array([sets[i].astype(np.int64) for i in range(len(sig))], pa.list_(pa.int64()))],
                names=["doc_id", "same", "bands", "shingles"])

    sets = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, same string, bands array<string>, shingles array<long>"), "minhash")
    member = sets.select("doc_id", "same", F.when(F.size("shingles") == 0, F.col("doc_id"))
                         .alias("alone"))
    low = member.where("alone is null").groupBy("same").agg(F.min("doc_id").alias("rep"))
    member = stored(member.join(low, "same", "left").select("doc_id", F.coalesce("alone", "rep").alias("rep")), "reps")
    one = sets.join(member.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    left = stored(one.select(F.explode("bands").alias("bucket"), "doc_id"), "bands")
    edges = None
    sh = one.select("doc_id", "shingles")
    while True:
        heads = left.groupBy("bucket").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).where("n > 1")
        turn = stored(left.join(heads, "bucket").where("doc_id <> head").select("bucket", "doc_id", "head"), "turn")
        if turn.isEmpty():
            break
        pairs = turn.select("doc_id", "head").distinct()
        i = F.size(F.array_intersect("shingles", "other")).cast("long")
        u = F.size("shingles") + F.size("other") - i
        ok = stored(pairs.join(sh, "doc_id").join(sh.select(F.col("doc_id").alias("head"), F.col("shingles").alias("other")), "head")
                    .where(i * 100 >= u * threshold_pct).select("doc_id", "head"), "verified")
        edges = ok if edges is None else edges.union(ok)
        comp = stored(components(edges, "doc_id", "head"), "classes")
        # buckets that are one class by now need no further round
        lab = turn.select("bucket", "doc_id").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
            .select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("c"))
        headc = turn.select("bucket", F.col("head").alias("doc_id")).distinct() \
            .join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
            .select("bucket", F.coalesce("component", "doc_id").alias("c"))
        mixed = lab.groupBy("bucket").agg(F.min("c").alias("x"), F.max("c").alias("y")).join(headc, "bucket") \
            .where("least(x, c) < greatest(y, c)").select("bucket").distinct()
        left = stored(lab.join(mixed, "bucket", "left_semi").select("bucket", "doc_id"), "left")
    if edges is None:
        return member.select("doc_id", F.col("rep").alias("class_id"))
    comp = components(edges, "doc_id", "head").withColumnRenamed("node", "rep")
    return member.join(comp, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("class_id"))
