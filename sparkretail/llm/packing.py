"""Best-fit packing of token pieces into sequences, after Martello-Toth
dominance reduction.

Spark tokenises once and counts pieces by length. That histogram has at most
``capacity`` rows however large the corpus, so the packing plan is made on it:
``reduce_dominated`` fixes sets of one, two or three lengths that provably
dominate every other way to fill a sequence with their largest member,
``best_fit`` packs what is left, longest first, each length as a block of equal
pieces. The plan is a bounded table of runs (length, count, first sequence,
per sequence, offset); Spark numbers the pieces of each length and reads their
sequence and offset from it.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from array import array
from collections import defaultdict
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sparkretail.llm.components import stored

PIECE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("copy", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TokenBytes:
    """Token ids of texts as little-endian uint32 bytes, those of
    ``tokenizers`` with the byte-level BPE file at ``path``.

    Texts of plain characters without very long words go through ``tiktoken``
    built from the same file (merge order equals id order there), several times
    faster; all others, and those with the text of a special token, go through
    ``tokenizers`` itself."""

    OTHER = re.compile("[^\t\n\r -~\u00c0-\u024f\u2013\u2014\u2018-\u201d]|\\S{2000}")

    def __init__(self, path: str):
        import tiktoken

        self.path, self.whole = path, None
        spec = json.loads(Path(path).read_text("utf-8"))
        self.special, model = [t["content"] for t in spec.get("added_tokens", [])], spec["model"]
        # the printable stand-ins of byte-level vocabularies, in byte order
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in self.special}
        merged = [a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        self.fast = None
        if [vocabulary[t] for t in merged] == list(range(256, 256 + len(merged))):
            import public_tokenizers

            self.fast = tiktoken.Encoding("plan", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
                bytes(byte[c] for c in t): i for t, i in vocabulary.items()})

    def __call__(self, text: str) -> bytes:
        if self.fast is None or self.OTHER.search(text) or any(x in text for x in self.special):
            if self.whole is None:  # loaded by the first text that needs it
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.fast.encode_ordinary(text)).tobytes()


def pieces(docs: DataFrame, capacity: int, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Every piece of every row: ids of the whole text, then ``end_id``; a
    longer document is cut into pieces of ``capacity``, the first may be
    shorter. ``copy`` tells rows of one doc_id apart."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        tokens, end = TokenBytes(path), end_id.to_bytes(4, "little")
        for t in batches:
            texts = t.column("text").to_pylist()
            for a in range(0, len(texts), 200):
                cols: list[list] = [[] for _ in PIECE_SCHEMA.names]
                part = [x or "" for x in texts[a:a + 200]]
                for doc, copy, ids in zip(t.column("doc_id")[a:a + 200].to_pylist(),
                                          t.column("copy")[a:a + 200].to_pylist(), map(tokens, part)):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        for c, v in zip(cols, (doc, copy, k, x, y - x, zlib.crc32(ids[4 * x:4 * y]))):
                            c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if name == "piece" else pa.int64()) for name, c in zip(PIECE_SCHEMA.names, cols)],
                    names=PIECE_SCHEMA.names)

    return (docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("copy"))
            .mapInArrow(run, PIECE_SCHEMA))


Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it) in one sequence


def reduce_dominated(count: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Dominance reduction on a histogram of lengths: the fixed patterns with
    their number of sequences, and the lengths left.

    For the largest length s: if not even the smallest piece fits beside it, it
    stands alone; a piece that fills the rest exactly, or the largest piece t
    that fits when no two or more pieces together exceed t within the rest,
    dominates every other set; so does the pair that fills the rest exactly
    when no three pieces fit, no single piece above its larger member fits and
    no two pieces above its smaller member fit. Otherwise the next smaller length is tried."""
    left = {s: c for s, c in count.items() if c > 0}
    sizes = sorted(left)
    fixed: dict[Pattern, int] = defaultdict(int)

    def use(pattern: dict[int, int], times: int) -> None:
        fixed[tuple(sorted(pattern.items(), reverse=True))] += times
        for s, c in pattern.items():
            left[s] -= c * times
            if left[s] == 0:
                del left[s]
                sizes.remove(s)

    def largest_pair(rest: int, s: int) -> tuple[int, tuple[int, int]]:
        """The largest sum of two pieces beside one of length s within rest."""
        have = lambda x, extra: left[x] - (x == s) - extra
        best, pair, hi = 0, (0, 0), len(sizes) - 1
        for x in sizes:
            if 2 * x > rest or have(x, 0) < 1:
                if 2 * x > rest:
                    break
                continue
            while hi >= 0 and x + sizes[hi] > rest:
                hi -= 1
            for j in range(hi, -1, -1):
                y = sizes[j]
                if y < x:
                    break
                if have(y, y == x) >= 1:
                    if x + y > best:
                        best, pair = x + y, (x, y)
                    break
        return best, pair

    i = len(sizes) - 1
    while i >= 0:
        i = min(i, len(sizes) - 1)
        if i < 0:
            break
        s = sizes[i]
        rest = capacity - s
        have = lambda x: left.get(x, 0) - (x == s)

        def above(b: int, room: int) -> bool:
            """Whether two other pieces longer than b fit."""
            two = []
            for x in sizes[bisect.bisect_right(sizes, b):]:
                two += [x] * min(2, max(0, have(x)))
                if len(two) >= 2 or x > room:
                    break
            return len(two) >= 2 and two[0] + two[1] <= room

        low = [x for x in sizes[:3] for _ in range(min(3, max(0, have(x))))][:3]  # the three smallest others
        if not low or low[0] > rest:
            use({s: 1}, left[s])
        else:
            j = bisect.bisect_right(sizes, rest) - 1
            while j >= 0 and have(sizes[j]) < 1:
                j -= 1
            t = sizes[j]
            exact = t == rest
            pair, which = (0, (0, 0)) if exact or len(low) < 2 or low[0] + low[1] > rest else largest_pair(rest, s)
            three = len(low) == 3 and sum(low) <= rest
            if exact or (pair <= t and not three):
                use({s: 2} if s == t else {s: 1, t: 1}, left[s] // 2 if s == t else min(left[s], left[t]))
            elif pair == rest and not three and t <= max(which) and not above(min(which), rest):
                one: dict[int, int] = defaultdict(int)
                for x in (s, *which):
                    one[x] += 1
                use(dict(one), min(left[x] // c for x, c in one.items()))
            else:
                i -= 1
                continue
        # the same length may be gone; go on from the largest not yet passed
        i = min(i, len(sizes) - 1)
    return [(p, n) for p, n in fixed.items()], left


def best_fit(count: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, on a histogram: groups of equal sequences."""
    groups: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)  # by room left
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if n:
            if room not in groups:
                bisect.insort(rooms, room)
            groups[room].append((pattern, n))

    for s in sorted(count, reverse=True):
        c = count[s]
        while c:
            at = bisect.bisect_left(rooms, s)
            if at == len(rooms):
                q = capacity // s
                put(capacity - q * s, ((s, q),), c // q)
                if c % q:
                    put(capacity - (c % q) * s, ((s, c % q),), 1)
                c = 0
                break
            room = rooms[at]
            pattern, n = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            q = room // s
            full = min(n, c // q)
            put(room - q * s, (*pattern, (s, q)), full)
            n, c = n - full, c - full * q
            if n and c:  # fewer than q are left for the next one
                put(room - c * s, (*pattern, (s, c)), 1)
                n, c = n - 1, 0
            put(room, pattern, n)
    return [g for r in sorted(groups) for g in groups[r]]


def plan(count: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first rank, pieces, first sequence, per sequence,
    offset)``: at most as many as patterns times their distinct lengths."""
    fixed, left = reduce_dominated(count, capacity)
    runs, rank, sequence = [], defaultdict(int), 0
    for pattern, n in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for s, k in pattern:
            runs.append((s, rank[s], n * k, sequence, k, offset))
            rank[s] += n * k
            offset += s * k
        sequence += n
    return runs


#: pieces of one length that one task numbers
NUMBERED_PIECES = 250_000


def pack(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of
    every piece. A null text counts as empty (its end token alone); rows that
    repeat a doc_id, or have none, are packed each; extra columns are not read;
    an empty table gives no piece."""
    spark = docs.sparkSession
    rows = stored(pieces(docs, capacity, tokenizer), "pieces")
    # rank within a length: number within (length, salt), after the salts before it
    salts = 64 + rows.count() // NUMBERED_PIECES
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(salts)).cast("int"))
    counts = stored(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows
    earlier = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("before"))
    steps = spark.createDataFrame(plan(histogram, capacity),
                                  "length long, first long, pieces long, sequence long, per long, at long")
    # the runs of one length in order of rank: one array a length
    steps = steps.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("first", "pieces", "sequence", "per", "at"))).alias("runs"))
    number = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "copy", "piece"))
    return (salted.withColumn("number", number)
            .join(offsets, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("number") - 1)
            .join(F.broadcast(steps), "length")
            .withColumn("run", F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1))
            .withColumn("k", F.col("rank") - F.col("run.first"))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("run.sequence") + F.floor(F.col("k") / F.col("run.per"))).cast("long").alias("sequence_id"),
                    (F.col("run.at") + F.pmod("k", "run.per") * F.col("length")).cast("long").alias("offset")))
