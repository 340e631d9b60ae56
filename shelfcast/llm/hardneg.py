"""Hard negatives by rotated one-bit codes, interval bounds and exact integer scores.

A vector is rotated and coded by the signs of its components. The code is a unit
vector; its alignment with the vector is stored, and what the code leaves over
is coded again by another rotation, ``LEVELS`` times. The length of the last
remainder is stored too. A query's components are rounded to eight bits, so the
product of a code and a query is a few popcounts. These estimates are off by at
most remainder times query length (Cauchy-Schwarz) and the rounding, so each
pair has an interval that is sure to hold its score. Pairs whose interval cannot
reach a place among the best are left out; the others are scored in integers.

Anchors and rows meet in blocks of bounded size, and each block passes on its
best few. Rows of one label and vector are told apart by id only, so as many of
the smallest ids as could be asked for stand for all of them, and equal anchors
are searched for once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.texts import checkpointed
from shelfcast.session import broadcast_up_to

LEVELS = 6
QUERY_BITS = 8
MOST = 1 << 56  # squared length from which a row takes no part, so that any score fits its integer type
ROWS, ANCHORS = 8192, 1024  # that meet in a block
SLICE = 1 << 20  # pairs whose estimates are held at a time
MOST_LABELS = 100_000  # whose block counts are broadcast; more are joined by shuffle


class Rotations:
    """Random sign flips and Hadamard steps: rotations that need no matrix, the same in every task."""

    def __init__(self, dim: int):
        self.size = max(64, 1 << max(0, dim - 1).bit_length())
        rng = np.random.default_rng(7)
        self.signs = rng.choice([-1.0, 1.0], (LEVELS, 2, self.size))

    def _hadamard(self, x: np.ndarray) -> np.ndarray:
        step = 1
        while step < self.size:
            x = x.reshape(len(x), -1, 2, step) if len(x) else x.reshape(0, self.size // (2 * step), 2, step)
            x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
            step *= 2
        return x.reshape(len(x), self.size) / np.sqrt(self.size)

    def turn(self, x: np.ndarray, level: int) -> np.ndarray:
        return self._hadamard(self._hadamard(x * self.signs[level, 0]) * self.signs[level, 1])

    def back(self, x: np.ndarray, level: int) -> np.ndarray:
        return self._hadamard(self._hadamard(x) * self.signs[level, 1]) * self.signs[level, 0]

    def padded(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.size))
        out[:, : x.shape[1]] = x
        return out


def codes(vectors: np.ndarray, turned: Rotations) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the sign bits by level, the alignment by level, and the length of the remainder."""
    rest = turned.padded(vectors)
    bits = np.zeros((len(rest), LEVELS, turned.size // 64), np.uint64)
    align = np.zeros((len(rest), LEVELS))
    for level in range(LEVELS):
        own = turned.turn(rest, level)
        up = own >= 0
        bits[:, level] = np.packbits(up, axis=1, bitorder="little").view(np.uint64)
        align[:, level] = np.abs(own).sum(axis=1) / np.sqrt(turned.size)
        code = np.where(up, 1.0, -1.0) / np.sqrt(turned.size)
        rest = rest - turned.back(align[:, level, None] * code, level)
    return bits, align, np.linalg.norm(rest, axis=1)


class Queries:
    """Anchors with their components rounded to a few bits at each level, bit by bit."""

    def __init__(self, vectors: np.ndarray, turned: Rotations):
        self.size = turned.size
        padded = turned.padded(vectors)
        self.length = np.linalg.norm(padded, axis=1)
        n, words = len(vectors), turned.size // 64
        self.planes = np.zeros((n, LEVELS, QUERY_BITS, words), np.uint64)
        self.low, self.step, self.total, self.rounding = (np.zeros((n, LEVELS)) for _ in range(4))
        for level in range(LEVELS):
            own = turned.turn(padded, level)
            low = own.min(axis=1)
            step = (own.max(axis=1) - low) / ((1 << QUERY_BITS) - 1)
            step[step == 0] = 1.0
            units = np.rint((own - low[:, None]) / step[:, None])
            self.low[:, level], self.step[:, level], self.total[:, level] = low, step, units.sum(axis=1)
            self.rounding[:, level] = np.linalg.norm(own - low[:, None] - step[:, None] * units, axis=1)
            whole = units.astype(np.uint8)
            for bit in range(QUERY_BITS):
                self.planes[:, level, bit] = np.packbits(whole >> bit & 1, axis=1, bitorder="little").view(np.uint64)

    def bounds(self, at: slice, bits: np.ndarray, align: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest score that each of some queries can have with each row."""
        middle = np.zeros((len(self.length[at]), len(bits)))
        for level in range(LEVELS):
            ones = np.bitwise_count(bits[:, level]).sum(axis=1, dtype=np.int64)
            both = np.zeros(middle.shape, np.int64)
            for bit in range(QUERY_BITS):
                for word in range(bits.shape[2]):
                    shared = np.bitwise_count(bits[None, :, level, word] & self.planes[at, level, bit, word][:, None])
                    both += shared.astype(np.int64) << bit
            low, step, total = (x[at, level][:, None] for x in (self.low, self.step, self.total))
            product = (step * (2 * both - total) + low * (2 * ones - self.size)) / np.sqrt(self.size)
            middle += align[:, level] * product
        off = self.length[at][:, None] * rest + self.rounding[at] @ align.T
        norms = np.sqrt((align**2).sum(axis=1) + rest**2)
        off += 1e-9 * (1 + self.length[at][:, None] * norms)  # floating point
        return middle - off, middle + off


def survivors(lower: np.ndarray, upper: np.ndarray, low: float, high: float, k: int) -> np.ndarray:
    """Pairs that may be among the ``k`` best scores from ``low`` to ``high``."""
    alive = (upper >= low) & (lower <= high)
    sure = lower[(lower >= low) & (upper <= high)]
    if len(sure) > k:
        alive &= upper >= np.partition(sure, len(sure) - k)[len(sure) - k]
    return np.flatnonzero(alive)


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact products: in doubles where no sum can leave their integers, else in 64-bit integers."""
    if len(rows) and float(np.abs(rows).max()) * float(np.abs(anchor).sum()) < 2**52:
        return np.rint(rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return np.concatenate([(rows[i : i + 4096] * anchor).sum(axis=1) for i in range(0, len(rows), 4096)] or [np.zeros(0, np.int64)])


def _matrix(column: pa.ChunkedArray, dim: int, kind) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), dim)


def _coded(dim: int):
    turned = Rotations(dim)

    def run(batches):
        for batch in batches:
            vectors = _matrix(pa.chunked_array([batch.column("vector")]), dim, np.int64)
            bits, align, rest = codes(vectors, turned)
            packed = [b.tobytes() for b in bits]
            cols = [pa.array(packed, pa.binary()), pa.array(align.tolist(), pa.list_(pa.float64())), pa.array(rest)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, "bits", "align", "rest"])

    return run


FOUND = pa.schema([("anchor", pa.string()), ("vec_id", pa.int64()), ("key", pa.string()), ("score", pa.int64())])
FOUND_SQL = "anchor string, vec_id bigint, key string, score bigint"


def _met(dim: int, k: int, negatives: bool):
    """The function of a block: the rows that may be among the best of each anchor, scored.

    Positives: the ``k`` best rows of the block. Negatives: those of another label, the ``k`` best of each of the
    anchor's ranges. Rows that two ranges want are returned once.
    """
    turned = Rotations(dim)

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(anchors) or not len(rows):
            return FOUND.empty_table()
        vectors, wanted = (_matrix(t.column("vector"), dim, np.int64) for t in (rows, anchors))
        bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(len(rows), LEVELS, -1)
        align, rest = _matrix(rows.column("align"), LEVELS, np.float64), rows.column("rest").to_numpy()
        labels, ids = rows.column("label").to_numpy(), rows.column("vec_id").to_numpy()
        own, names = anchors.column("label").to_numpy(), anchors.column("key").to_pylist()
        ranges = anchors.column("ranges").to_pylist() if negatives else [[{"low": None, "high": None}]] * len(names)
        queries, out = Queries(wanted, turned), []
        for low in range(0, len(names), step := max(1, SLICE // len(rows))):
            lower, upper = queries.bounds(slice(low, low + step), bits, align, rest)
            for i in range(len(lower)):
                a = low + i
                fit = np.flatnonzero(labels != own[a]) if negatives else np.arange(len(labels))
                below, above = lower[i, fit], upper[i, fit]
                picked = set()
                for r in ranges[a]:
                    least, most = (-np.inf, np.inf) if r["low"] is None else (r["low"], r["high"])
                    some = fit[survivors(below, above, least, most, k)]
                    exact = scores(vectors[some], wanted[a])
                    good = np.flatnonzero((exact >= least) & (exact <= most))
                    best = good[np.lexsort((ids[some[good]], -exact[good]))[:k]]
                    picked.update(zip(some[best].tolist(), exact[best].tolist()))
                out += [(names[a], row, score) for row, score in sorted(picked)]
        places = np.array([o[1] for o in out], np.int64)
        cols = [pa.array([o[0] for o in out], pa.string()), pa.array(ids[places], pa.int64())]
        cols += [rows.column("key").take(pa.array(places)).combine_chunks(), pa.array([o[2] for o in out], pa.int64())]
        return pa.Table.from_arrays(cols, schema=FOUND)

    return run


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, vector, key`` of the rows that take part: components are ``floor(scale * x)``.

    No part take rows with a null id, label or vector, with a null or non-finite component, or longer than ``MOST``
    allows. Identical rows count once. ``key`` names a label and vector.
    """
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = vectors.select("vec_id", "label", "embedding").dropna()
    # NaN and infinity compare as greater than every number; a null makes the whole test null.
    rows = rows.where(F.forall("embedding", lambda x: F.abs(x.cast("double")) < float(1 << 40)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.where(squares < float(MOST))
    key = F.md5(F.concat_ws(" ", F.col("label").cast("string"), F.array_join("vector", " ")))
    return rows.select("vec_id", "label", "vector", key.alias("key")).dropDuplicates(["vec_id", "key"])


def _blocks(anchors: DataFrame, rows: DataFrame, by: list[str], dim: int, k: int, negatives: bool, sizes: tuple[int, int]) -> DataFrame:
    """Scored pairs out of all blocks: rows are dealt to blocks of a group ``by`` by their key, and so are anchors.

    A group's blocks follow its counts, so none is large, whatever group most rows are in.
    """
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("r")).join(anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("a")), by)
    parts = counts.select(
        *by, F.ceil(F.col("r") / F.lit(sizes[0])).cast("int").alias("row_blocks"), F.ceil(F.col("a") / F.lit(sizes[1])).cast("int").alias("anchor_blocks")
    )
    # A row per label; sent to all tasks if its size is proven small, so that the rows need not be shuffled for it.
    parts = broadcast_up_to(checkpointed(parts, "blocks"), MOST_LABELS)
    met = []
    for side, own, other in ((anchors, "anchor", "row"), (rows, "row", "anchor")):
        dealt = side.join(parts, by).withColumn(f"{own}_block", F.pmod(F.xxhash64("key", "vec_id"), F.col(f"{own}_blocks").cast("long")))
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks").cast("long") - 1))
        met.append(dealt.withColumn(f"{other}_block", others).drop("row_blocks", "anchor_blocks"))
    keys = [*by, "row_block", "anchor_block"]
    return met[0].groupBy(*keys).cogroup(met[1].groupBy(*keys)).applyInArrow(_met(dim, k, negatives), FOUND_SQL)


def _best(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    """The ``k`` best of each group, numbered from 1: higher scores first, then smaller ids."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "key")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    sizes: tuple[int, int] = (ROWS, ANCHORS),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors(vec_id, embedding, label)``.

    An anchor is a row for which ``anchor``, an expression of ``vec_id`` and ``label``, is true. Its positives are the
    first ``positives`` rows of its label and another id; for each, the first ``negatives`` rows of other labels whose
    score is ``least`` to ``most`` hundredths of the positive's, all ends included. Scores are inner products of the
    integer vectors; higher come first, ties by smaller id. Fewer rows than asked for are all returned.

    Which rows take part, see ``prepared``. A vector that is shorter than the longest has zeros in the missing places.
    Anchors that share an id, with different vectors or labels, are each searched for; rows of an anchor's own id are
    no positives of it. Other columns are not read. An empty table gives no rows.
    """
    all_rows = checkpointed(prepared(vectors, scale), "vectors")
    dim = max(1, all_rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vector"))
    wide = all_rows.withColumn("vector", F.concat("vector", padding))
    # An anchor's own id is no positive, so one more than asked for; equal scores come by id.
    held = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    few = wide.withColumn("copy", held).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy")
    kinds = "vec_id bigint, label bigint, vector array<bigint>, key string, bits binary, align array<double>, rest double"
    rows = checkpointed(few.mapInArrow(_coded(dim), kinds), "codes")
    marked = all_rows.where(anchor).select("vec_id", "key", "label")
    distinct = rows.join(marked.select("key").distinct(), "key", "left_semi")
    anchors = distinct.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    anchors = checkpointed(anchors, "anchors")

    met = _blocks(anchors, rows, ["label"], dim, positives + 1, False, sizes)
    near = checkpointed(_best(met, ["anchor"], positives + 1, "place"), "positives")
    p = F.col("score")
    # 100 n >= least p and 100 n <= most p in whole numbers.
    low, high = (F.expr(f"CAST(-floor(-CAST({least} AS DECIMAL(38,0)) * score / 100) AS BIGINT)"), F.expr(f"CAST(floor(CAST({most} AS DECIMAL(38,0)) * score / 100) AS BIGINT)"))
    ranges = near.where(p >= 0).select("anchor", low.alias("low"), high.alias("high")).where(F.col("low") <= F.col("high")).distinct()
    listed = ranges.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("ranges"))  # one for each positive at most
    asking = anchors.join(listed.withColumnRenamed("anchor", "key"), "key").withColumn("all", F.lit(0))
    far = _blocks(asking, rows.withColumn("all", F.lit(0)), ["all"], dim, negatives, True, sizes)
    far = checkpointed(far, "negatives")
    spans = near.select("anchor", "place", F.col("vec_id").alias("positive_id"), p.alias("positive_score"), low.alias("low"), high.alias("high"))
    in_range = spans.join(far, "anchor").where((F.col("score") >= F.col("low")) & (F.col("score") <= F.col("high")))
    ranked = _best(in_range, ["anchor", "place"], negatives, "rank")
    # One row for each distinct anchor, so that the anchors that share a vector, however many, meet one row.
    one = ranked.select("anchor", "place", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    hits = one.groupBy("anchor", "place", "positive_id").agg(F.collect_list(F.struct("rank", "negative_id", "positive_score", "negative_score")).alias("hits"))
    places = near.select("anchor", "place", F.col("vec_id").alias("positive_id")).join(hits, ["anchor", "place", "positive_id"], "left")
    whole = places.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "hits"))).alias("found"))
    joined = marked.select(F.col("vec_id").alias("anchor_id"), F.col("key").alias("anchor")).join(whole, "anchor")
    others = F.slice(F.filter("found", lambda f: f["positive_id"] != F.col("anchor_id")), 1, positives)
    rows_out = joined.select("anchor_id", F.explode(others).alias("f")).select("anchor_id", "f.positive_id", F.explode("f.hits").alias("h"))
    return rows_out.select("anchor_id", "positive_id", "h.rank", "h.negative_id", "h.positive_score", "h.negative_score")


ORACLE = """
WITH rows_ AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), pairs AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM rows_ a JOIN rows_ r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
