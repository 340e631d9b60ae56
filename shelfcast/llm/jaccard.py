"""N-gram Jaccard join by prefix filters under several global token orders.

Two sets with Jaccard similarity ``t`` or more share a token among the first
``n - ceil(t * n) + 1`` tokens of each, under any one order of all tokens. Three
orders are used: one by hash, and two that put frequent tokens last. A pair is
verified only if it shares a prefix token under each of them.

The orders form a cascade. Documents that share a prefix token under the first
order are indexed under the second, which is the first with all tokens last that
several documents had in their prefixes: documents that share a passage and no
more drop out, copies meet again in their next tokens. A short list there gives
all its pairs. The documents of long lists (large families of copies) are
counted token by token and indexed under the third order, with all their
frequent tokens last: a document far from all others then has only rare tokens
in its prefix and drops out, and a long list is mostly one family.
Its members are linked to the list's most central one, that with the fewest
rare tokens, so pairs grow with the list and not with its square. Lists that
still hold several components then give all their pairs between components whose
frequent tokens alone could suffice, so that no link between components is lost; two
that meet in several of these lists are a pair in the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.masks import in_mask, mask_of, passing
from shelfcast.llm.texts import U64, chain, checkpointed, mix, present, row_groups, row_key, signed, slices, split_words, string_buffer

SHORT = 32  # a list up to this length gives all its pairs
FIRST_LISTS = 64  # of a node's unsettled lists so many are looked through for an earlier meeting
TOKEN_BITS = 24  # size of the filter of tokens that occur more than once: 2 MB
PAIR = ("a", "b", "n_a", "n_b", "rare_a", "rare_b")
SALTS = (0x0, 0x0, 0xE7037ED1A0B428DB)  # the second order only moves the first one's shared tokens


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def overlap_needed(n: int, m: int, percent: int) -> int:
    """The least intersection with which 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, bounds = string_buffer(column)
    for low, high in row_groups(bounds):
        own = bounds[low : high + 1] - bounds[low]
        words = split_words(raw[bounds[low] : bounds[high]], own, fold=True)
        runs = chain(words.hash, size)
        for a, b in zip(words.first[:-1], words.first[1:]):
            if b - a >= size:
                yield np.unique(runs[a : b - size + 1])
            elif b > a:  # a short text is one shingle
                yield chain(words.hash[a:b], int(b - a), salt=1)
            else:
                yield np.zeros(0, U64)


def set_key(tokens: np.ndarray) -> int:
    """One 64-bit key for a set; documents with equal sets are one node of the join."""
    with np.errstate(over="ignore"):
        return int(signed(mix(np.array([tokens.sum(dtype=U64) * U64(31) + mix(tokens).sum(dtype=U64)])))[0])


def prefix(tokens: np.ndarray, order: int, frequent: np.ndarray | None, percent: int) -> np.ndarray:
    """The first tokens of a set under one order: by a salted hash, with frequent tokens last."""
    if not len(tokens):
        return tokens
    rank = mix(tokens ^ U64(SALTS[order])) >> U64(1)
    if frequent is not None:
        rank |= in_mask(tokens, frequent).astype(U64) << U64(63)
    length = prefix_length(len(tokens), percent)
    return tokens[np.argpartition(rank, length - 1)[:length]]


def _nodes(percent: int, size: int):
    """Each document's node, set size and prefix under the first order."""

    def run(batches):
        for batch in slices(batches):
            keys, counts, heads = [], [], []
            for tokens in shingle_sets(batch.column("text"), size):
                keys.append(set_key(tokens) if len(tokens) else None)
                counts.append(len(tokens))
                heads.append(signed(prefix(tokens, 0, None, percent)))
            own = [batch.column("doc_id"), batch.column("row_key"), pa.array(keys, pa.int64())]
            own += [pa.array(counts, pa.int64()), pa.array([0] * len(counts), pa.int64()), pa.array(heads, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(own, ["doc_id", "row_key", "node", "n", "rare", "head"])

    return run


def _sets(size: int, mask_value):
    """Node and set of the rows whose key passes the mask."""

    def run(batches):
        for batch in slices(batches):
            wanted = batch.filter(pa.array(in_mask(batch.column("row_key").to_numpy(), mask_value.value)))
            sets = [t for t in shingle_sets(wanted.column("text"), size) if len(t)]
            cols = [pa.array([set_key(t) for t in sets], pa.int64()), pa.array([len(t) for t in sets], pa.int64())]
            cols.append(pa.array([signed(t) for t in sets], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, ["node", "n", "tokens"])

    return run


def _stored(batch: pa.RecordBatch, name: str = "tokens") -> list[np.ndarray]:
    """The sets of a column."""
    column = batch.column(name)
    bounds, flat = column.offsets.to_numpy(), column.values.to_numpy().view(U64)
    return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _of_nodes(mask_value):
    """The stored sets whose node passes the mask."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_mask(batch.column("node").to_numpy(), mask_value.value)))

    return run


def _prefix_row(key: int, tokens: np.ndarray, order: int, frequent: np.ndarray | None, percent: int) -> tuple:
    rare = 0 if frequent is None else int(len(tokens) - in_mask(tokens, frequent).sum())
    return key, len(tokens), rare, signed(prefix(tokens, order, frequent, percent))


def _prefix_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
    return pa.RecordBatch.from_arrays([*cols, pa.array([r[3] for r in rows], pa.list_(pa.int64()))], ["node", "n", "rare", "head"])


def _second_prefixes(size: int, percent: int, mask_value, frequent_value):
    """Prefixes under the second order, of the texts whose node passes the mask."""

    def run(batches):
        for batch in slices(batches):
            sets = [(set_key(t), t) for t in shingle_sets(batch.column("text"), size) if len(t)]
            fine = in_mask(np.array([k for k, _ in sets], np.int64), mask_value.value)
            yield _prefix_batch([_prefix_row(k, t, 1, frequent_value.value, percent) for (k, t), f in zip(sets, fine) if f])

    return run


def _stored_prefixes(percent: int, order: int, mask_value=None, frequent_value=None):
    """Prefixes of stored sets under an order; with a mask, of the chosen ones."""

    def run(batches):
        frequent = frequent_value.value if frequent_value else None
        for batch in slices(_of_nodes(mask_value)(batches) if mask_value else batches):
            keys = batch.column("node").to_pylist()
            yield _prefix_batch([_prefix_row(k, t, order, frequent, percent) for k, t in zip(keys, _stored(batch))])

    return run


def _verified(percent: int, frequent: list):
    """Keep pairs that share a prefix token under the later orders, too, then those that are similar enough."""

    def run(batches):
        masks = list(enumerate((f.value for f in frequent), 1))
        known: dict[int, list] = {}

        def heads(node: int, tokens: np.ndarray) -> list:
            if node not in known:
                if len(known) > 1000:
                    known.clear()
                known[node] = [frozenset(prefix(tokens, o, m, percent).tolist()) for o, m in masks]
            return known[node]

        for batch in slices(batches):
            keep = []
            nodes = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), _stored(batch, "x_tokens"), _stored(batch, "y_tokens"))
            for a, b, x, y in nodes:
                if any(p.isdisjoint(q) for p, q in zip(heads(a, x), heads(b, y))):
                    keep.append(False)
                    continue
                same = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            fine = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(fine), batch.column("b").filter(fine)], ["a", "b"])

    return run


def _could_match(percent: int):
    """The smaller set must hold ``percent`` of the larger one."""
    return F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) AND a <> b")


def _could_overlap(percent: int):
    """For pairs of a long list: their frequent tokens alone must suffice.

    Rare tokens come first, so a set that is in a long list has all of them in its
    prefix, and a rare token that two sets share gives the pair in a short list.
    """
    return F.expr(f"{100 + percent} * least(n_a - rare_a, n_b - rare_b) >= {percent} * (n_a + n_b)")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _list_pairs(lists: DataFrame) -> DataFrame:
    """All pairs ``a, b`` of each list between different components, with the columns of both."""
    own = [c for c in lists.columns if c not in ("token", "node")]
    one, two = (lists.select("token", F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in own]) for x in "ab")
    return one.join(two, "token").where("a < b AND root_a <> root_b")


def _with_lists(lists: DataFrame) -> DataFrame:
    """``lists`` with the node's first lists in the order of their tokens."""
    own = lists.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FIRST_LISTS).alias("lists"))
    return lists.join(own, "node")


def _meet_first():
    """For pairs of ``_with_lists``: no list before this one is known to hold both, so members of many lists are not paired in each.

    Spark puts the conditions of a join in its own order; the case keeps the arrays from being compared for pairs that drop out anyway.
    """
    meet = "coalesce(array_min(array_intersect(lists_a, lists_b)) >= token, true)"
    return F.expr(f"CASE WHEN a < b AND root_a <> root_b THEN {meet} ELSE false END")


def _shared_lists(heads: DataFrame) -> DataFrame:
    """The token lists with two nodes or more, one row per node, with the list's length ``m``.

    ``heads(node, n, rare, head)``. Copies of a set are one row before its tokens
    are dealt out, and those move once: what moves follows the prefixes, whatever
    share of their tokens occurs more than once.
    """
    one = heads.groupBy("node").agg(F.first(F.struct("n", "rare", "head")).alias("one"))
    rows = one.select(F.explode("one.head").alias("token"), "node", "one.n", "one.rare")
    held = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return checkpointed(rows.withColumn("m", held).where("m > 1"), "lists")


def _stars(lists: DataFrame) -> DataFrame:
    """Each member of a list with the list's most central one."""
    best = lists.groupBy("token").agg(F.min(F.struct("rare", "node", "n", "root")).alias("c"))
    pairs = lists.join(best, "token").where("root <> c.root")
    columns = {"a": "node", "b": "c.node", "n_a": "n", "n_b": "c.n", "rare_a": "rare", "rare_b": "c.rare"}
    return pairs.select(*[F.col(columns[k]).alias(k) for k in PAIR])


def jaccard_components(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """``doc_id, row_key, n_shingles, node, root`` per row of ``docs(doc_id, text)``.

    ``node`` names the document's set (equal sets share it), ``root`` its
    component over links with ``100 * intersection >= percent * union``. Both are
    null for a text without words, which is linked with nothing. Texts are cut
    at ASCII white space with A-Z lowered; one with fewer words than ``size`` is
    one shingle. Rows that repeat and rows whose ids repeat each get their own
    result; other columns of ``docs`` are not read. Shingles and sets are known
    by 64-bit hashes.
    """
    send = docs.sparkSession.sparkContext.broadcast
    text = present(docs, "doc_id").select("doc_id", row_key(), "text")
    schema = "doc_id bigint, row_key bigint, node bigint, n bigint, rare bigint, head array<bigint>"
    members = checkpointed(text.mapInArrow(_nodes(percent, size), schema), "shingles")
    heads = "node bigint, n bigint, rare bigint, head array<bigint>"

    first = _shared_lists(members.where("n > 0").select("node", "n", "rare", "head"))
    some, often = send(mask_of(first, "node")), send(mask_of(first, "token", TOKEN_BITS))
    second = _shared_lists(checkpointed(text.mapInArrow(_second_prefixes(size, percent, some, often), heads), "heads"))
    pairs = _list_pairs(_labelled(second.where(F.col("m") <= SHORT), None)).where(_could_match(percent)).select("a", "b")
    pairs = checkpointed(pairs.distinct(), "pairs")

    # The sets that the rest needs, read from one document of each node.
    wanted = second.where(F.col("m") > SHORT).select("node").unionAll(pairs.select(F.explode(F.array("a", "b")))).distinct()
    copies = members.where("n > 0").groupBy("node").agg(F.min("row_key").alias("row_key")).join(wanted, "node")
    sets = text.mapInArrow(_sets(size, send(mask_of(copies, "row_key"))), "node bigint, n bigint, tokens array<bigint>")
    sets = checkpointed(sets, "sets")

    family = send(mask_of(second.where(F.col("m") > SHORT), "node"))
    # Only the sets of long lists are counted and indexed: the second order has given all pairs of the others.
    tokens = sets.mapInArrow(_of_nodes(family), sets.schema).select(F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("docs"))
    frequent = send(mask_of(counts.where(F.col("docs") > SHORT), "token"))
    third = _shared_lists(checkpointed(sets.mapInArrow(_stored_prefixes(percent, 2, family, frequent), heads), "heads"))
    fronts = checkpointed(sets.mapInArrow(_stored_prefixes(percent, 0), heads), "fronts")
    short = _list_pairs(_labelled(third.where(F.col("m") <= SHORT), None)).where(_could_match(percent)).select("a", "b")
    # A document with too few frequent tokens has no partner in a long list.
    rest = third.where((F.col("m") > SHORT) & (100 * (F.col("n") - F.col("rare")) >= percent * F.col("n")))
    of_long = lambda pairs: pairs.where(_could_match(percent) & _could_overlap(percent))
    verify = lambda pairs, labels: _extend(sets, fronts, pairs, labels, percent, [often, frequent])
    labels = verify(pairs.unionAll(short).unionAll(of_long(_stars(_labelled(rest, None))).select("a", "b")), None)
    rest = _unsettled(rest, labels)
    if not rest.isEmpty():
        open_ = _list_pairs(_with_lists(_labelled(rest, labels)))
        labels = verify(of_long(open_).where(_meet_first()).select("a", "b"), labels)
    found = members.select("doc_id", "row_key", "node", F.col("n").alias("n_shingles"))
    return _labelled(found, labels)


def _unsettled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The lists that still hold nodes of several components."""
    rows = _labelled(lists, labels)
    open_ = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return checkpointed(lists.join(open_.select("token"), "token", "left_semi"), "rest")


def _sharing_enough(pairs: DataFrame, fronts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes under the first order share as many tokens as similar sets must.

    Tokens that both sets hold outside the shared part of the prefixes lie behind
    one of the prefixes, so there are no more than the longer rest has.
    """
    x = fronts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("head").alias("head_a"))
    y = fronts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("head").alias("head_b"))
    both = pairs.join(x, "a").join(y, "b")
    rest = F.expr(f"ceil({percent} * greatest(n_a, n_b) / 100) - 1")
    need = F.expr(f"ceil({percent} * (n_a + n_b) / {100 + percent})")
    shared = F.size(F.array_intersect("head_a", "head_b"))
    return both.where((shared > 0) & (shared + rest >= need)).select("a", "b")


def _extend(sets, fronts, pairs, labels, percent, frequent):
    """The components after the pairs that hold have been added as links."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = checkpointed(_sharing_enough(pairs, fronts, percent).distinct(), "pairs")
    # Without Python, so that a task that verifies needs one worker and not two: idle ones keep their memory.
    sets = passing(sets, pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x_tokens"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y_tokens"))
    checked = pairs.join(x, "a").join(y, "b").select("a", "b", "x_tokens", "y_tokens")
    new = checked.mapInArrow(_verified(percent, frequent), "a bigint, b bigint").distinct()
    if labels is not None:
        new = new.unionAll(labels.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return checkpointed(components(new), "roots")


def jaccard_classes(docs: DataFrame, percent: int = 85, size: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    ``component_id`` is the least document id of the component; a text without
    words has its own id. Null ids never name a component unless all are null.
    """
    found = checkpointed(jaccard_components(docs, percent, size), "found")
    names = found.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = found.join(names, "root", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id")


def keep_one_per_class(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least id stays.

    Rows with words are compared; rows without words all stay. Null ids come
    last; among rows that tie on the id the least key of (id, text) stays, and
    one of identical rows. All columns are returned, whatever their names.
    """
    found = checkpointed(jaccard_components(docs, percent, size), "found")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    best = found.where("root IS NOT NULL").groupBy("root").agg(F.min(rank).alias("best"))
    stays = found.where("root IS NULL").select("row_key", F.lit(True).alias("bare"))
    stays = stays.unionAll(best.select(F.col("best.row_key").alias("row_key"), F.lit(False))).distinct()
    rows = docs.select(F.struct("*").alias("whole"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"))
    turn = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    kept = rows.join(stays, "row_key").withColumn("turn", turn).where("bare OR turn = 1")
    return kept.select("whole.*")
