"""Operator 5: near-duplicate components by a multi-index Hamming join.

1. Every document gets its set of distinct word shingles (by hash), a
   fingerprint of the set and a signature of ``VALUES`` b-bit MinHash values
   (b = 16).  Documents with equal sets are one class.
2. Multi-index join: a signature is split into ``CHUNKS`` chunks of four
   values.  Two signatures that differ in at most ``DISTANCE`` = 2 * CHUNKS - 1
   values differ in at most one value of some chunk (pigeonhole), so a class is
   listed under every chunk with each of its four values left out, and all
   pairs under the distance share a list.  At a similarity of exactly 0.75 the
   distance is 12 of 48 on average, and over the threshold for 2 of 10,000
   pairs; above 0.8 for less than 1 in a million.
3. Bounds: a class keeps in common with another at most its shingles that
   any other listed class has.  With c such shingles out of n, the similarity
   to a set of m shingles is at most min(c, m) / (n + m - min(c, m)); classes
   and pairs under the threshold by this are not compared.
4. First round: every class is compared with the most central member (fewest
   shingles of its own) of its lists.  Close pairs are confirmed on whole
   shingle sets and joined to components.
5. Second round: what is left of lists whose members are still in different
   components, with the bound taken among such members only, forms clusters
   (members that share a list).  Inside a cluster all members of different
   components are compared on whole sets, in pairs of blocks of ``BLOCK``
   members, so that no task holds a cluster that grows with the input; a block
   pair returns a spanning forest of its links at most, never all pairs.

Components are found by label propagation with pointer jumping over the
confirmed links; all rounds are DataFrame joins on written tables.

Cases: null text and texts without words have an empty set and are linked with
nothing; a text of fewer than five words is one shingle; equal texts and
repeated rows share a class; rows with one doc_id and different texts are
linked each by its own text; a null doc_id is linked like others, but gives a
component no id (a component of such rows alone has the id null); extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidy, written
from .shingles import batches_of, mix, shingle_sets

WORDS = 5
PERCENT = 75
VALUES, CHUNKS = 48, 12
DISTANCE = 2 * CHUNKS - 1
TEN_19 = 10**19  # over any id
BLOCK = 1024  # members of a block
COLUMNS = 8192  # shingles multiplied at a time
ODD = np.random.default_rng(5).integers(1, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)


def signature(items: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of a non-empty set."""
    best = None
    for at in range(0, len(items), 4096):
        least = (items[None, at : at + 4096] * ODD[:, None]).min(1)
        best = least if best is None else np.minimum(best, least)
    return (mix(best) >> np.uint64(48)).astype("<u2")


def text_hash(text: str = "text") -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def base(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), text_hash().alias("row"))


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, row (hash of the text), n, s1, s2 (fingerprint of the set), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in batches_of(texts):
                sets = shingle_sets(texts[a:b], words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(2).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                        pa.array(np.array([mix(s * ODD[0]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "row", "n", "s1", "s2", "sig"],
                )

    return base(docs).mapInArrow(tidy(run), "doc_id long, row long, n long, s1 long, s2 long, sig binary")


def listed(classes: DataFrame) -> DataFrame:
    """(key, id) of every list that a class is in: chunk, place left out and
    the three other values, packed into one long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, CHUNKS, 4).astype(np.int64)
            keys = np.empty((len(sig), CHUNKS, 4), np.int64)
            for out in range(4):
                x, y, z = (sig[:, :, i] for i in range(4) if i != out)
                keys[:, :, out] = (np.arange(CHUNKS) * 4 + out)[None, :] << 48 | x << 32 | y << 16 | z
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), 4 * CHUNKS))], ["key", "id"])

    return classes.select("id", "sig").mapInArrow(tidy(run), "key long, id long")


def distance(a: list[bytes], b: list[bytes]) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(s), "<u2").reshape(-1, VALUES) for s in (a, b))
    return (x != y).sum(1)


def whole_sets(docs: DataFrame, chosen: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, items): the shingle sets of the classes in ``chosen`` (id, doc, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in batches_of(texts):
                sets = [s.view(np.int64) for s in shingle_sets(texts[a:b], words)]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))], ["id", "items"]
                )

    # The same join at every size: texts are shuffled once.
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("d.row") == F.col("c.row"))
    texts = base(docs).alias("d").join(chosen.select("id", "doc", "row").alias("c").hint("merge"), same).select("id", "text")
    return written(texts.mapInArrow(tidy(run), "id long, items array<long>"), "sets")


def common_counts(sets: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(id, c): how many shingles of a set another of the sets has (only
    those in ``ids``, if given)."""
    if ids is not None:
        sets = sets.join(ids.hint("merge"), "id", "left_semi")
    own = sets.select("id", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    private = own.groupBy("id").agg(F.count("*").alias("private"))
    sizes = sets.select("id", F.size("items").alias("n")).join(private, "id", "left")
    return written(sizes.select("id", (F.col("n") - F.coalesce("private", F.lit(0))).cast("long").alias("c")).distinct(), "common")


def may_link(n1, c1, n2, c2, percent: int = PERCENT):
    """Whether sets of n1 and n2 shingles, c1 and c2 of them shared with
    anyone, can be similar enough (columns or arrays)."""
    both = F.least(c1, c2) if not isinstance(n1, np.ndarray) else np.minimum(c1, c2)
    return 100 * both >= percent * (n1 + n2 - both)


def close(pairs: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) within the signature distance that may be linked."""
    left, right = (members.select(*[F.col(x).alias(f"{x}{c}" if x != "id" else c) for x in ("id", "n", "c", "sig")]) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, VALUES) for i in (2, 3))
                near = pa.array((x != y).sum(1) <= DISTANCE)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    both = pairs.join(left, "a").join(right, "b").where(may_link(F.col("na"), F.col("ca"), F.col("nb"), F.col("cb"), percent))
    return both.select("a", "b", "siga", "sigb").mapInArrow(tidy(run), "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that are linked, judged on whole shingle sets."""
    left, right = (sets.select(F.col("id").alias(c), F.col("items").alias(f"i{c}")) for c in "ab")
    both = F.size(F.array_intersect("ia", "ib"))
    return (
        pairs.join(right.hint("merge"), "b")
        .join(left.hint("merge"), "a")
        .where(100 * both >= percent * (F.size("ia") + F.size("ib") - both))
        .select("a", "b")
    )


def connected(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the links (a, b)."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        closer = written(labels.join(near, "id").select("id", F.least("component", "near").alias("component"), F.col("component").alias("was")), "labels")
        # Pointer jumping: the label of the label.
        up = closer.select(F.col("id").alias("component"), F.col("component").alias("up"))
        jumped = written(closer.join(up, "component").select("id", F.col("up").alias("component"), "was"), "labels")
        labels = jumped.drop("was")
        if jumped.where("component <> was").isEmpty():
            return labels


def open_members(lists: DataFrame, component: DataFrame) -> DataFrame:
    """(key, id, component): members of lists that are still in different
    components."""
    held = written(lists.join(component, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "members")
    open_ = held.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return written(held.join(open_.select("key"), "key", "left_semi"), "open-members")


def clusters_of(rows: DataFrame) -> DataFrame:
    """(id, component, cluster, blocks): members that share lists, directly or
    by others, in clusters of more than one component."""
    first = rows.groupBy("key").agg(F.min("id").alias("a"))
    shared = rows.join(first, "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    cluster = connected(shared).select("id", F.col("component").alias("cluster"))
    held = written(rows.select("id", "component").distinct().join(cluster, "id"), "clusters")
    sizes = held.groupBy("cluster").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low <> high")
    return held.join(sizes.select("cluster", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "cluster")


def spanning(pairs: tuple[np.ndarray, np.ndarray], left: list[int], right: list[int]) -> Iterator[tuple[int, int]]:
    """Of linked pairs (positions in left and right, which hold components),
    those that join components not joined yet."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for i, j in zip(*(p.tolist() for p in pairs)):
        x, y = root(left[i]), root(right[j])
        if x != y:
            parent[x] = y
            yield i, j


def linked_in_block(left: list[np.ndarray], right: list[np.ndarray], unlike: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of linked sets among the pairs marked in ``unlike``.
    Sizes of intersections are products of 0/1 matrices over the shingles
    that more than one of the sets has, some columns at a time."""
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    every = np.concatenate(left + right)
    shared, n = np.unique(every, return_counts=True)
    shared = shared[n > 1]
    both = np.zeros((len(left), len(right)), np.float32)
    owner = [np.repeat(np.arange(len(side)), size) for side, size in zip((left, right), sizes)]
    place = []
    for side in (left, right):
        flat = np.concatenate(side)
        at = np.searchsorted(shared, flat)
        at[at == len(shared)] = 0
        place.append(np.where(shared[at] == flat, at, -1) if len(shared) else np.full(len(flat), -1))
    for low in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - low)
        cells = []
        for side, own, at in zip((left, right), owner, place):
            chosen = (at >= low) & (at < low + width)
            m = np.zeros((len(side), width), np.float32)
            m[own[chosen], at[chosen] - low] = 1
            cells.append(m)
        both += cells[0] @ cells[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - both
    return np.nonzero(unlike & (100 * both >= percent * union))


def links_in_clusters(clusters: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between components, judged on whole sets; for every block
    pair no more than join its components."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = clusters.join(sets.hint("merge"), "id").withColumn("mine", block).withColumn("other", other).select(
        "cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "id", "component", "items"
    )

    def compare(group: list[tuple]) -> list[tuple[int, int]]:
        _, i, j = group[0][0]
        left = [r for r in group if r[1] == i]
        right = [r for r in group if r[1] == j]
        if not left or not right:
            return []
        ids, ids2 = (np.array([r[2] for r in side]) for side in (left, right))
        comp, comp2 = ([r[3] for r in side] for side in (left, right))
        unlike = np.array(comp)[:, None] != np.array(comp2)[None, :]
        if not unlike.any():
            return []
        found = linked_in_block([r[4] for r in left], [r[4] for r in right], unlike, percent)
        return [(int(ids[x]), int(ids2[y])) for x, y in spanning(found, comp, comp2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def done() -> pa.RecordBatch:
            pairs = compare(group) if group else []
            return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())], ["a", "b"])

        for batch in batches:
            items = batch.column(6)
            flat, ends = items.values.to_numpy(), items.offsets.to_numpy()
            head = zip(*(batch.column(c).to_pylist() for c in range(6)))
            for k, (cluster, i, j, mine, doc, component) in enumerate(head):
                if group and group[0][0] != (cluster, i, j):
                    yield done()
                    group = []
                group.append(((cluster, i, j), mine, doc, component, flat[ends[k] : ends[k + 1]].copy()))
        yield done()

    return dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(tidy(run), "a long, b long")


def links_of(docs: DataFrame, classes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Components (id, component) of the classes that are linked."""
    # Sets of one or two shingles are linked with equal sets only.  Lists are
    # counted and summed up on the map side first, and joined with written
    # tables, so that a list with a third of all classes can be split.
    every = listed(classes.where("n > 2"))
    several = written(every.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key"), "several")
    lists = written(every.join(several, "key", "left_semi"), "lists")
    sets = whole_sets(docs, classes.join(lists.select("id").distinct(), "id", "left_semi"), words)

    def with_common(common: DataFrame) -> DataFrame:
        """Classes that may be linked with any other."""
        some = classes.join(common, "id").where(100 * F.col("c") >= percent * F.col("n"))
        return written(some.select("id", "n", "c", "sig"), "linkable")

    members = with_common(common_counts(sets))
    lists = lists.join(members.select("id", (F.col("n") - F.col("c")).alias("own")), "id")
    # The most central member of each list, and the most central of all its
    # lists; own and id as one number, so that the aggregates hash.
    central = F.col("own").cast("decimal(38,0)") * F.lit(str(TEN_19)).cast("decimal(20,0)") + F.col("id")
    centers = written(lists.groupBy("key").agg(F.min(central).alias("center")), "centers")
    first = lists.join(centers, "key").groupBy("id").agg(F.min("center").alias("low"), F.max("center").alias("high"))
    of = [F.pmod(F.col(c), F.lit(str(TEN_19)).cast("decimal(20,0)")).cast("long") for c in ("low", "high")]
    tries = first.select(F.explode(F.array_distinct(F.array(*of))).alias("a"), F.col("id").alias("b")).where("a <> b")
    tries = written(close(tries, members, percent), "tries")
    links = written(confirmed(tries, sets, percent), "links-1")
    component = connected(links)
    rows = open_members(lists.select("key", "id"), component)
    members = with_common(common_counts(sets, rows.select("id").distinct()))
    clusters = clusters_of(written(rows.join(members.select("id"), "id", "left_semi"), "open-linkable"))
    more = written(links_in_clusters(clusters, sets, percent), "links-2")
    return component if more.isEmpty() else connected(links.union(more))


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return rows_of(docs, words, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def rows_of(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, row (hash of the text), n_shingles, component_id and first of
    every row: whether it is the one of its component with the smallest doc_id
    (nulls last), then the smallest row."""
    found = written(features(docs, words), "features")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("least")
    classes = found.where("n > 0").groupBy("n", "s1", "s2").agg(least, F.first("sig").alias("sig"))
    classes = classes.select("n", "s1", "s2", "sig", F.col("least.doc_id").alias("doc"), F.col("least.row").alias("row"), F.monotonically_increasing_id().alias("id"))
    classes = written(classes, "classes")
    component = links_of(docs, classes, words, percent)
    labelled = classes.drop("sig").join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = labelled.groupBy("component").agg(F.min(F.struct(F.col("doc").isNull().alias("null"), "doc", "row")).alias("head"))
    final = labelled.join(heads, "component").select("n", "s1", "s2", F.col("head.doc").alias("head_doc"), F.col("head.row").alias("head_row"), F.lit(True).alias("linked"))
    out = found.join(written(final, "class-components"), ["n", "s1", "s2"], "left")
    alone = F.col("linked").isNull()  # without a word
    return out.select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("head_doc")).alias("component_id"),
        (alone | F.col("doc_id").eqNullSafe(F.col("head_doc")) & (F.col("row") == F.col("head_row"))).alias("first"),
    )
