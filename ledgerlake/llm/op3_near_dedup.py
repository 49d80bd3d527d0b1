"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles, held as 64-bit hashes; a minwise
sketch embeds the set in 256 coordinates. Documents with the same set are one class and only
classes are joined. Each tree starts at another coordinate: classes with the same minwise token
there are a node. Nodes of up to ``SMALL`` classes are compared exhaustively by their sketches;
larger ones are first split by bands of set size, which parts no link, and those still larger choose one or two coordinates by the node's path and branch by the tokens found
there, unless all but a few of their classes are linked already: then these few are held against
the others block by block. A pair at the threshold goes on with 0.75 * 11 / 6 > 1 children in the
mean, so it does not die out with depth: a tree parts it with a probability of at most 0.4, and
``TREES`` of them bring its recall beyond 0.9999 at any depth. Every pair found is confirmed on
the full sets.

Only links that can join two components matter, so nodes whose classes are all linked already
are left. First each class is held against the least class that shares three tokens with it
(a star); then the most similar pair between two components of a node, and where a node has more
than ``DENSE`` such pairs for each component only the most similar that join all they join; then,
where one of these is no link, every pair left, by the full sets within the node. So
a group of thousands of near copies costs a few links for each copy. A node that does not fall
apart in ``DEPTH`` double levels is compared in pairs of blocks.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. A
text of fewer than five words is one shingle. Keys may repeat or be null: rows are told apart by
key and text; a component is named by its least key that is not null. A document is kept if its
key names its component. Ties do not arise: links are symmetric and the least key is unique. An
empty table gives an empty table. Existing columns with the names of new ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import (
    BROADCAST_ROWS, bytes_of, fresh, identified, lean, prepare, rows_of, settle, sized, table,
)
from ledgerlake.llm.graph import components
from ledgerlake.llm.shingles import FUNCTIONS, ROOTS, shingles, similar, sketches

PERCENT = 75
#: Equal coordinates of two sketches from which a pair is confirmed: a pair at the threshold has
#: fewer with a probability of about 2e-5.
LEAST_EQUAL = 163
#: Classes of a node that are compared by their sketches, and by their full sets.
SMALL, SMALL_SETS = 4000, 1000
DEPTH, TREES, STARS = 5, 12, 8
#: Pairs for each component that leave a node before they are thinned to a spanning forest.
DENSE = 4


def _sets(rows: DataFrame, key: str, rid: str, text: str) -> DataFrame:
    """Size, signature, sketch and roots of each row's set."""
    kind = rows.schema[key].dataType.simpleString()

    def emit(batches):
        for batch in batches:
            sets = [shingles(t) for t in bytes_of(batch.column(2))]
            some = [s for s in sets if len(s)]
            found = sketches(some) if some else np.empty((0, FUNCTIONS), dtype=np.uint32)
            coarse, roots = found.astype("u1"), found[:, :ROOTS].astype("<u4")
            row = iter(range(len(some)))
            parts: list[tuple] = []
            for s in sets:
                k = next(row) if len(s) else None
                parts.append((len(s), None, None, None) if k is None else
                             (len(s), xxhash.xxh3_128_digest(s), coarse[k].tobytes(), roots[k].tobytes()))
            size, signature, sketch, root = zip(*parts) if parts else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(signature, pa.binary()),
                 pa.array(sketch, pa.binary()), pa.array(root, pa.binary())],
                names=["r_key", "r_rid", "n_shingles", "signature", "sketch", "roots"])

    return rows.select(key, rid, text).mapInArrow(
        lean(emit), f"r_key {kind}, r_rid long, n_shingles long, signature binary, sketch binary, roots binary")


def _root_paths(classes: DataFrame, levels: int, trees: int, *carried: str) -> DataFrame:
    """For each class and tree the path of its first ``levels`` tokens."""

    def emit(batches):
        for batch in batches:
            n = batch.num_rows
            roots = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u4").reshape(n, ROOTS).astype(np.uint64)
            paths = np.empty((n, trees), dtype=np.uint64)
            for t in range(trees):
                at = [t, (t + 5) % ROOTS, (t + 11) % ROOTS][:levels]
                path = np.full(n, (t + 1) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
                for c in at:
                    path = _step(path, roots[:, c])
                paths[:, t] = path
            row = pa.array(np.repeat(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths.reshape(-1).view(np.int64)), *(c.take(row) for c in batch.columns[1:])],
                names=["path", "id", *carried])

    return classes.select("roots", "id", *carried).mapInArrow(
        lean(emit), "path long, id long" + "".join(f", {c} long" for c in carried))


def _step(path: np.ndarray, token: np.ndarray) -> np.ndarray:
    out = (path ^ token) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _grandchildren(path: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The paths each class goes to and its row: twice by two coordinates, in a sixth of the nodes
    by one."""
    row = np.arange(len(path))
    for _ in range(2):
        choice = _step(path, np.uint64(0x51ED270B))
        first = (choice % np.uint64(FUNCTIONS)).astype(np.int64)
        second = (first + 1 + ((choice >> np.uint64(8)) % np.uint64(FUNCTIONS - 1)).astype(np.int64)) % FUNCTIONS
        two = (choice >> np.uint64(40)) % np.uint64(6) != 0
        path, row = np.concatenate([path, path[two]]), np.concatenate([row, row[two]])
        at = np.concatenate([first, second[two]])
        path = _step(_step(path, at.astype(np.uint64)), sketch[row, at].astype(np.uint64))
    return path, row


def _branch(nodes: DataFrame) -> DataFrame:
    """The grandchildren that each class goes to."""

    def emit(batches):
        for batch in batches:
            sketch = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="u1").reshape(-1, FUNCTIONS)
            path, row = _grandchildren(batch.column(0).to_numpy().view(np.uint64), sketch)
            index = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path.view(np.int64)), batch.column(1).take(index), batch.column(2).take(index)],
                names=["path", "id", "label"])

    return nodes.select("path", "id", "label", "sketch").mapInArrow(lean(emit), "path long, id long, label long")


def _forest(one: np.ndarray, other: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of edges between ``n`` vertices, best first: which are in the best spanning forest, and the
    tree of each vertex (Boruvka)."""
    chosen, tree, left = np.zeros(len(one), dtype=bool), np.arange(n), np.arange(len(one))
    while True:
        a, b = tree[one[left]], tree[other[left]]
        apart = a != b
        a, b, left = a[apart], b[apart], left[apart]
        if not len(left):
            return chosen, tree
        best = np.full(n, len(a))
        np.minimum.at(best, a, np.arange(len(a)))
        np.minimum.at(best, b, np.arange(len(a)))
        root = np.flatnonzero(best < len(a))
        edge = best[root]
        chosen[left[edge]] = True
        to = np.arange(n)
        to[root] = np.where(a[edge] == root, b[edge], a[edge])
        mutual = (to[to] == np.arange(n)) & (np.arange(n) < to)  # both ends took the same edge
        to[mutual] = np.flatnonzero(mutual)
        while (to[to] != to).any():
            to = to[to]
        tree = to[tree]


def _thinned(lo: np.ndarray, hi: np.ndarray, equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of labels leave a node, and which of them stand for others that do not.
    Labels joined by many pairs keep a spanning forest of the most alike: if all of it are links,
    the others join nothing; if not, each label that could still be joined is at one that is none."""
    keep, stands = np.ones(len(lo), dtype=bool), np.zeros(len(lo), dtype=bool)
    if len(lo) <= DENSE * (2 * DENSE + 2):  # fewer labels have no more pairs than that
        return keep, stands
    names, ends = np.unique(np.concatenate([lo, hi]), return_inverse=True)
    order = np.argsort(-equal, kind="stable")
    one, other = ends[:len(lo)][order], ends[len(lo):][order]
    chosen, tree = _forest(one, other, len(names))
    dense = np.bincount(tree[one], minlength=len(names)) > DENSE * np.bincount(tree, minlength=len(names))
    stands[order] = dense[tree[one]]
    keep[order] = chosen | ~dense[tree[one]]
    return keep, stands


def _compare(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of one node that differ in label and whose sketches are alike: the most
    alike of each two labels, and whether there are ``more``, between them or among labels that
    are joined by too many pairs to send them all. Every node is small."""

    def pairs(ids, labels, matrix, sizes):
        one, other, equal = [], [], []
        order = np.argsort(sizes, kind="stable")
        ids, labels, matrix, sizes = ids[order], labels[order], matrix[order], sizes[order]
        # Sets much larger cannot be alike: those that can follow each other.
        reach = np.searchsorted(sizes, 100 * sizes // percent, side="right")
        for i in range(len(ids) - 1):
            ok = np.flatnonzero(labels[i + 1:reach[i]] != labels[i]) + i + 1
            if len(ok):
                same = np.count_nonzero(matrix[ok] == matrix[i], axis=1)
                alike = same >= LEAST_EQUAL
                other.append(ok[alike])
                equal.append(same[alike])
                one.append(np.full(len(other[-1]), i))
        if not one:
            return None
        one, other, equal = map(np.concatenate, (one, other, equal))
        more = np.zeros(len(one), dtype=bool)
        if len(one) > 1:
            lo, hi = np.minimum(labels[one], labels[other]), np.maximum(labels[one], labels[other])
            order = np.lexsort((-equal, hi, lo))
            lo, hi = lo[order], hi[order]
            head = np.ones(len(order), dtype=bool)
            head[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            one, other = one[order[head]], other[order[head]]
            more = np.diff(np.append(np.flatnonzero(head), len(head))) > 1
            keep, stands = _thinned(lo[head], hi[head], equal[order[head]])
            one, other, more = one[keep], other[keep], (more | stands)[keep]
        return ids[one], ids[other], more

    def emit(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                part = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(),
                        np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="u1").reshape(-1, FUNCTIONS),
                        batch.column(4).to_numpy())
                held = part if held is None else tuple(np.concatenate(x) for x in zip(held, part))
            if held is None:
                continue
            path, ids, labels, matrix, sizes = held
            edge = np.flatnonzero(np.diff(path)) + 1
            bounds = [0, *edge.tolist()]
            if batch is None:
                bounds.append(len(path))
            found = [x for a, b in zip(bounds, bounds[1:]) if b - a > 1
                     and (x := pairs(ids[a:b], labels[a:b], matrix[a:b], sizes[a:b])) is not None]
            held = tuple(x[bounds[-1]:] for x in held) if batch is not None else None
            if found:
                a, b, more = (np.concatenate([x[k] for x in found]) for k in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)),
                                                  pa.array(more)], names=["a", "b", "more"])

    return (nodes.select("path", "id", "label", "sketch", "size").repartition("path").sortWithinPartitions("path")
            .mapInArrow(lean(emit), "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more")))


def _with_end(batches):
    yield from batches
    yield None


def _link(nodes: DataFrame, percent: int) -> DataFrame:
    """Links between components within each node, by the full sets of its members. What is linked
    within the node already is not compared again, so that few pairs leave it."""

    def links(table: pa.Table):
        ids, labels, sizes = (table.column(k).to_numpy() for k in ("id", "label", "size"))
        matrix = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype="u1").reshape(-1, FUNCTIONS)
        elements = table.column("elements")
        order = np.argsort(sizes, kind="stable")
        ids, labels, matrix, sizes = ids[order], labels[order], matrix[order], sizes[order]
        reach = np.searchsorted(sizes, 100 * sizes // percent, side="right")
        parent: dict[int, int] = {}

        def full(i: int) -> np.ndarray:  # a view, as the sets of a node are its largest part
            return np.frombuffer(elements[int(order[i])].as_buffer(), dtype=np.uint64)

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for i in range(len(ids) - 1):
            ok = np.flatnonzero(labels[i + 1:reach[i]] != labels[i]) + i + 1
            ok = ok[np.count_nonzero(matrix[ok] == matrix[i], axis=1) >= LEAST_EQUAL] if len(ok) else ok
            for j in ok.tolist():
                one, other = find(int(labels[i])), find(int(labels[j]))
                if one != other and similar(full(i), full(j), percent):
                    parent[one] = other
                    yield max(int(ids[i]), int(ids[j])), min(int(ids[i]), int(ids[j]))

    def emit(batches):
        held: pa.Table | None = None
        for batch in _with_end(batches):
            if batch is not None:
                part = pa.Table.from_batches([batch])
                held = part if held is None else pa.concat_tables([held, part])
            if held is None:
                continue
            edge = (np.flatnonzero(np.diff(held.column("path").to_numpy())) + 1).tolist()
            bounds = [0, *edge] if batch is not None else [0, *edge, held.num_rows]
            found = [x for a, b in zip(bounds, bounds[1:]) if b - a > 1 for x in links(held.slice(a, b - a))]
            held = held.slice(bounds[-1]) if batch is not None else None
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)],
                                                 names=["a", "b"])

    return (nodes.select("path", "id", "label", "size", "sketch", "elements").repartition("path")
            .sortWithinPartitions("path").mapInArrow(lean(emit), "a long, b long").distinct())


def _full_sets(wanted: DataFrame, rows: DataFrame, key: str, rid: str, text: str) -> DataFrame:
    """``id`` and ``elements``, the hashes of the whole set, of the classes in ``wanted``."""
    found = rows.join(sized(wanted), (rows[rid] == F.col("r_rid")) & rows[key].eqNullSafe(F.col("r_key"))) \
        .select("id", text)

    def emit(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(t).tobytes() for t in bytes_of(batch.column(1))], pa.binary())],
                names=["id", "elements"])

    return found.mapInArrow(lean(emit), "id long, elements binary").dropDuplicates(["id"])


def _nodes(state: DataFrame, percent: int, most: int) -> DataFrame:
    """Small nodes (path, id, label) of all trees; ``state`` has id, label, size, sketch, roots."""
    members = _root_paths(state, 1, TREES, "label")
    small: list[DataFrame] = []
    for level in range(DEPTH + 2):
        by_label = members.groupBy("path", "label").agg(F.count(F.lit(1)).alias("k"))
        mixed = (by_label.groupBy("path").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("labels"),
                                              F.max(F.struct("k", "label")).alias("most"))
                 .where(F.col("labels") > 1)
                 .select("path", "n", (F.col("n") - F.col("most.k")).alias("others"), F.col("most.label").alias("main")))
        alive = settle(members.join(mixed, "path"), "nodes")
        fits = F.col("n") <= most
        # Few classes beside those of one label, which are linked already: no need to branch.
        few = ~fits & (F.col("others") <= most // 2)
        small.append(alive.where(fits).select("path", "id", "label"))
        small.append(_against_main(alive.where(few), most))
        large = alive.where(~fits & ~few)
        if not large.take(1):
            break
        if level == DEPTH + 1:
            small.append(_blocks(large, most))
            break
        if level:
            next_ = _branch(large.join(state.select("id", "sketch"), "id"))
        else:
            next_ = _banded(large.join(state.select("id", "size"), "id"), percent)
        members = settle(next_.distinct(), "nodes")
    nodes = small[0]
    for part in small[1:]:
        nodes = nodes.unionByName(part)
    return nodes


def _banded(nodes: DataFrame, percent: int) -> DataFrame:
    """Each node by bands of set size. Sets that can be alike lie in one band or in neighbours, so
    each class goes to its own and the next."""
    width = float(np.log(100 / percent)) + 1e-9
    band = F.floor(F.ln(F.col("size").cast("double")) / F.lit(width))
    return (nodes.withColumn("band", F.explode(F.array(band, band + 1)))
            .select(F.xxhash64("path", "band").alias("path"), "id", "label"))


def _against_main(nodes: DataFrame, most: int) -> DataFrame:
    """Nodes whose classes have one label but for a few: the main part in blocks, the few in each."""
    half = most // 2
    blocks = F.ceil((F.col("n") - F.col("others")) / half).cast("long")
    block = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("id", "path"), blocks))) \
        .otherwise(F.sequence(F.lit(0).cast("long"), blocks - 1))
    return (nodes.withColumn("block", F.explode(block))
            .select(F.xxhash64("path", "block").alias("path"), "id", "label"))


def _blocks(large: DataFrame, most: int) -> DataFrame:
    """Nodes too alike to fall apart, as pairs of blocks: every two classes of a node meet."""
    half = most // 4
    blocks = F.ceil(F.col("n") / half).cast("long")
    own = F.pmod(F.xxhash64("id", "path"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    return (large.withColumn("own", own).withColumn("other", other)
            .select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("path"),
                    "id", "label"))


def _confirm(pairs: DataFrame, classes: DataFrame, rows: DataFrame, key: str, rid: str, text: str,
             percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike. Each text travels once for each pair it is the
    first of, and once as the second of all its pairs."""
    first = pairs.groupBy("a").agg(F.collect_set("b").alias("to")).select(F.col("a").alias("id"), "to",
                                                                       F.lit(False).alias("second"))
    second = pairs.select(F.col("b").alias("id")).distinct().select(
        "id", F.array("id").alias("to"), F.lit(True).alias("second"))
    wanted = first.unionByName(second).join(classes.select("id", "r_key", "r_rid"), "id")
    if rows_of(pairs) <= BROADCAST_ROWS // 2:  # each pair wants two documents at most
        wanted = F.broadcast(wanted)
    sent = (rows.join(wanted, (rows[rid] == F.col("r_rid")) & rows[key].eqNullSafe(F.col("r_key")))
            .select("id", "second", F.explode("to").alias("b"), F.col(text).alias("words")))
    left = sent.where(~F.col("second")).select(F.col("id").alias("a"), "b", "words")
    right = sent.where("second").select("b", F.col("words").alias("against"))
    both = left.join(right, "b").select("a", "b", "words", "against")

    def emit(batches):
        last, held = None, None
        for batch in batches:
            a, b, words, against = (batch.column(k) for k in range(4))
            keep = []
            # Converted value by value: rows of one pivot follow each other and share its set.
            for i, pivot in enumerate(b.to_pylist()):
                if pivot != last:
                    last, held = pivot, shingles((against[i].as_py() or "").encode())
                if similar(shingles((words[i].as_py() or "").encode()), held, percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(lean(emit), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """For every row its identity (``r_key``, ``r_rid``), ``n_shingles``, ``component_id``, ``kept``."""
    prepare(docs.sparkSession)
    (rid,) = fresh(docs, "rid")
    rows = identified(docs.select(key, text), key, text, rid)
    base = settle(_sets(rows, key, rid, text), "sets")
    # Equal sets are one class, represented by its least row.
    least = F.min(F.struct(F.col("r_key").isNull().alias("no"), "r_key", "r_rid")).alias("least")
    classes = settle(
        base.where(F.col("n_shingles") > 0).groupBy("signature")
        .agg(least, F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"),
             F.first("roots").alias("roots"))
        .select(F.monotonically_increasing_id().alias("id"), "signature", F.col("least.r_key").alias("r_key"),
                F.col("least.r_rid").alias("r_rid"), "size", "sketch", "roots"), "classes")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return settle(_confirm(pairs, classes, rows, key, rid, text, percent), "links")

    star_members = _root_paths(classes, 3, STARS)
    pivots = star_members.groupBy("path").agg(F.min("id").alias("b"), F.max("id").alias("top")) \
        .where(F.col("b") < F.col("top")).select("path", "b")
    tried = settle(star_members.join(pivots, "path").where(F.col("id") != F.col("b"))
                   .select(F.col("id").alias("a"), "b").distinct(), "pairs")
    links = confirmed(tried)
    labels = components(links)

    def labelled_state() -> DataFrame:
        return settle(classes.select("id", "r_key", "r_rid", "size", "sketch", "roots").join(labels, "id", "left")
                      .withColumn("label", F.coalesce("label", "id")), "state")

    state = labelled_state()
    pairs = settle(_compare(_nodes(state, percent, SMALL).join(state.select("id", "sketch", "size"), "id"), percent), "pairs")
    if pairs.take(1):
        new = confirmed(pairs.select("a", "b").join(tried, ["a", "b"], "left_anti"))
        links = links.unionByName(new)
        if new.take(1):
            labels = components(links)
        # Only components whose most similar pair is no link, though there are others, and that
        # are not joined by another way.
        open_pairs = pairs.where("more").join(links, ["a", "b"], "left_anti").select("a", "b")
        for end in ("a", "b"):
            open_pairs = open_pairs.join(labels.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}")), end, "left") \
                .withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
        apart = settle(open_pairs.where("label_a <> label_b")
                       .select(F.explode(F.array("label_a", "label_b")).alias("label")).distinct(), "open")
        if apart.take(1):
            state = labelled_state()
            state = settle(state.join(apart, "label", "left_semi"), "state")
            sets = settle(_full_sets(state.select("id", "r_key", "r_rid"), rows, key, rid, text), "sets")
            members = _nodes(state, percent, SMALL_SETS).join(state.select("id", "sketch", "size"), "id").join(sets, "id")
            new = settle(_link(members, percent), "links")
            if new.take(1):
                links = links.unionByName(new)
                labels = components(links)

    labelled = classes.select("id", "signature", "r_key").join(labels, "id", "left") \
        .withColumn("label", F.coalesce("label", "id"))
    named = labelled.groupBy("label").agg(F.min("r_key").alias("component_id"))
    of_set = settle(labelled.join(named, "label").select("signature", "component_id"), "components")
    return (base.select("r_key", "r_rid", "n_shingles", "signature").join(of_set, "signature", "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("r_key")))
            .withColumn("kept", F.col("r_key").eqNullSafe(F.col("component_id"))).drop("signature"))


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component."""
    (rid,) = fresh(docs, "rid")
    found = near_duplicates(docs, key=key, text=text, **options)
    gone = settle(found.where(~F.col("kept")).select("r_key", "r_rid").distinct(), "dropped")
    rows = identified(docs, key, text, rid)
    return rows.join(sized(gone), (rows[rid] == F.col("r_rid")) & rows[key].eqNullSafe(F.col("r_key")),
                     "left_anti").drop(rid)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("r_key").alias("doc_id"), "n_shingles", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, list_slice(w, i, i + least(5, len(w)) - 1) AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b USING (gram)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), named AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM named LEFT JOIN sizes USING (doc_id)
"""
