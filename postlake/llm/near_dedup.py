"""Near-duplicates by chosen-path set similarity join over word shingles.

1. One pass hashes each document's distinct shingles to a set digest, ``COORDINATES`` minwise tokens kept as a sketch
   of a byte each, and the document's root branches. Equal sets are collapsed to their smallest doc_id first.
2. Independent trees branch the remaining sets: at each node a document follows ``BRANCHES`` selected minwise tokens.
   Nodes of one document vanish, nodes up to ``LEAF`` are compared exhaustively, larger ones are relieved (below) and
   branch again. Comparing sketches keeps pairs with ``CLOSE`` of ``COORDINATES`` equal bytes, far below what the
   threshold gives, and of those only a spanning forest of each leaf.
3. Components of these candidate pairs hold every link that the trees recalled. Their texts are fetched once and the
   links confirmed on full shingle sets; the answer is the components of the confirmed links.

Large groups are never compared pair by pair. All members are compared with a few pivots (``PIVOTS`` in a node,
``TEXT_PIVOTS`` on full sets), and each member reports one pivot that it is linked with; pivots that a member has in
common are joined. Members of the component that holds most need no comparison with each other; the others are compared
with all members, in blocks (at once if they are few or the trees are ``ROUNDS`` deep, else after branching). Rows thus
grow with the members where pivots join most of a group, and with members times others / ``BLOCK`` where they do not. No
link between components is lost and no task gets a whole large group.

Recall: a pair at similarity s misses every root branch with probability (1 - s) ** (TREES * BRANCHES), 4e-9 at 0.8,
and falls below ``CLOSE`` with probability 4e-6; both are below for larger s.

Defined results: null, empty and word-less texts have no shingles and are their own component. A text of fewer words
than a shingle has one shingle of all its words. Repeated rows keep their rows and share a component; texts that
share an id are linked by what any of them is. A row without an id is linked with nothing: component_id null, kept true. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.components import connected_components
from postlake.llm.tables import staged, table, with_columns
from postlake.llm.words import BETWEEN_SPACES, Words, mix, words_of

SIMILARITY = 80  # percent
SHINGLE_WORDS = 4
STAGE_SHINGLE_WORDS = 5
COORDINATES = 64
CLOSE = 36
TREES, BRANCHES = 6, 2
LEAF = 128
ROUNDS = 1
PIVOTS = 6
TEXT_PIVOTS = 48
BLOCK = 256  # pivots of a part
PART = 2048  # members of a part, about

_random = np.random.default_rng(77)
_MASKS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_FACTORS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_PICKS = _random.permutation(COORDINATES)[: TREES * BRANCHES]
_FIELDS = "n_shingles long, high long, low long, sketch binary, roots array<long>"


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle."""
    keys, whole = words.runs(size)
    counts = words.counts
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * words.rows
    for i in np.flatnonzero(counts >= size).tolist():
        out[i] = np.unique(keys[words.first[i] : words.first[i + 1] - size + 1])
    for n in range(1, size):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            short, _ = words.runs(n)
            for i in rows.tolist():
                out[i] = short[words.first[i] : words.first[i] + 1]
    return out


def sketch(column: pa.Array, size: int) -> list[pa.Array]:
    n, high, low, sketches, roots = [], [], [], [], []
    for words in words_of(column, BETWEEN_SPACES, lower=True):
        sets = shingle_sets(words, size)
        n += [len(s) for s in sets]
        full = [i for i, s in enumerate(sets) if len(s)]
        digest = np.zeros((2, words.rows), np.uint64)
        least = np.zeros((COORDINATES, words.rows), np.uint64)
        if full:
            every = np.concatenate([sets[i] for i in full])
            first = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
            digest[0, full] = np.add.reduceat(mix(every), first)
            digest[1, full] = np.add.reduceat(mix(every ^ np.uint64(0x5851F42D4C957F2D)), first)
            for k in range(COORDINATES):
                least[k, full] = np.minimum.reduceat((every ^ _MASKS[k]) * _FACTORS[k], first)
        branches = mix(least[_PICKS] + mix(np.arange(len(_PICKS), dtype=np.uint64) + np.uint64(11))[:, None])
        bytes_ = np.ascontiguousarray((mix(least) >> np.uint64(56)).astype(np.uint8).T)
        high.append(digest[0].view(np.int64))
        low.append(digest[1].view(np.int64))
        sketches += [row.tobytes() for row in bytes_]
        roots += list(branches.T.astype(np.int64))
    return [
        pa.array(n, pa.int64()),
        pa.array(np.concatenate(high)),
        pa.array(np.concatenate(low)),
        pa.array(sketches, pa.binary()),
        pa.array(roots, pa.list_(pa.int64())),
    ]


class Forest:
    """Union-find over positions; a smaller position leads."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))
        self.parts = n

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        self.parts -= 1
        return True


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal first ``keys`` columns, whole, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in range(keys):
            value = batch.column(k).to_numpy(zero_copy_only=False)
            change |= value[1:] != value[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and any(held[0].column(k)[0] != batch.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(low, high - low))
            if high < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _edges(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _compare_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the close pairs of each node (node, rep, sketch)."""
    a, b = [], []
    for group in groups(batches, 1):
        rep = group.column(1).to_pylist()
        rows = np.frombuffer(b"".join(group.column(2).to_pylist()), np.uint8).reshape(len(rep), COORDINATES)
        forest = Forest(len(rep))
        for i in range(len(rep) - 1):
            if forest.parts == 1:
                break
            close = (rows[i + 1 :] == rows[i]).sum(axis=1) >= CLOSE
            for j in (np.flatnonzero(close) + i + 1).tolist():
                if forest.join(i, j):
                    a.append(rep[i])
                    b.append(rep[j])
        if len(a) >= 10_000:
            yield _edges(a, b)
            a, b = [], []
    yield _edges(a, b)


def _in_groups(df: DataFrame, keys: list[str], order: list[str], run, schema: str) -> DataFrame:
    """``run`` over whole groups, sorted; a task gets many small groups."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


_MET = "cluster long, rep long, pivot long, joint boolean, size long"


def _parts(pivots: DataFrame, members: DataFrame, run) -> DataFrame:
    """``run`` over pivots and members (cluster, chunk, rep, data, size), each chunk of pivots with every part.

    Members of a large cluster are dealt to parts of about ``PART``, to each of which its pivots are copied.
    """
    given = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), _n_parts() - 1)))
    taken = members.withColumn("salt", _part())
    part = F.xxhash64("cluster", "chunk", "salt").alias("part")
    rows = given.select(part, F.lit(0).alias("rank"), "rep", "data", "cluster", "size").union(
        taken.select(part, F.lit(1).alias("rank"), "rep", "data", "cluster", "size")
    )
    return _in_groups(rows, ["part"], ["rank", "rep"], run, _MET)


def _n_parts():
    return F.ceil(F.col("size") / PART).cast("long")


def _part():
    """The part of its cluster that a member is dealt to."""
    return F.pmod(F.xxhash64("rep"), _n_parts())


def _met_pivots(members: DataFrame, run, n_pivots: int) -> DataFrame:
    """The members that are linked with one of about ``n_pivots`` pivots, with one such, and the pairs of pivots that members
    have joined (``joint``)."""
    members = members.withColumn("chunk", F.lit(0).cast("long"))
    chosen = F.pmod(F.xxhash64("cluster", "rep"), F.col("size")) < n_pivots
    return staged(_parts(members.filter(chosen), members, run), "met")


def _links(met: DataFrame) -> DataFrame:
    return met.filter("pivot IS NOT NULL").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))


def _join_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each cluster (cluster, pivot, other, n, size): its pivots, the component of each, and how many members these hold."""
    out = [[], [], [], [], []]
    for group in groups(batches, 1):
        cluster, pivot, other, n, size = (group.column(i).to_pylist() for i in range(5))
        names = sorted({p for p in pivot if p is not None} | {o for o in other if o is not None})
        at = {p: i for i, p in enumerate(names)}
        forest = Forest(len(names))
        for p, o in zip(pivot, other):
            if o is not None:
                forest.join(at[p], at[o])
        held = dict.fromkeys(names, 0)
        for p, k in zip(pivot, n):
            if p is not None:
                held[names[forest.find(at[p])]] += k
        comps = [names[forest.find(i)] for i in range(len(names))]
        for column, value in zip(out, (cluster[0], names, comps, [held[c] for c in comps], size[0])):
            column.append(value)
    longs = pa.list_(pa.int64())
    kinds = (pa.int64(), longs, longs, longs, pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], list("abcde"))


def _outside(members: DataFrame, met: DataFrame) -> DataFrame:
    """Members of the clusters that pivots leave in more than one component: all columns, ``out`` for those outside the
    component of pivots that holds most members, and how many these are (``rest``).

    A cluster is described by one row, copied to the parts of its members, so no key has all members of a large one.
    """
    rows = met.groupBy("cluster", "size", "joint", "pivot", F.when(F.col("joint"), F.col("rep")).alias("other")).agg(
        F.sum(F.when(F.col("joint"), 0).otherwise(1)).alias("n")
    )
    described = _in_groups(
        rows.select("cluster", "pivot", "other", "n", "size"), ["cluster"], ["pivot", "other"], _join_pivots,
        "cluster long, pivots array<long>, comps array<long>, held array<long>, size long",
    )
    held = F.coalesce(F.array_max("held"), F.lit(0))
    open_ = described.withColumn("rest", F.col("size") - held).filter("rest > 0").select(
        "cluster",
        "rest",
        F.when(F.size("held") > 0, F.element_at("comps", F.array_position("held", held).cast("int"))).alias("most"),
        F.map_from_arrays("pivots", "comps").alias("comps"),
        F.explode(F.sequence(F.lit(0).cast("long"), _n_parts() - 1)).alias("salt"),
    )
    one = met.filter("NOT joint").select("cluster", "rep", "pivot")
    found = members.join(one, ["cluster", "rep"], "left").withColumn("salt", _part()).join(open_, ["cluster", "salt"])
    comp = F.when(F.col("pivot").isNotNull(), F.element_at("comps", F.col("pivot")))
    out = comp.isNull() | ~comp.eqNullSafe(F.col("most"))
    return staged(found.select("cluster", "rep", "data", "size", out.alias("out"), "rest"), "outside")


def _others_with_all(outside: DataFrame, run) -> DataFrame:
    """Members left apart, in chunks of about ``BLOCK``, against all members, as :func:`_met_pivots` has them."""
    chunks = F.ceil(F.col("rest") / BLOCK).cast("long")
    pivots = outside.filter("out").withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks))
    members = outside.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    return _parts(pivots, members, run)


def _against(index_of, values_of):
    """A task over parts (part, rank, rep, data, cluster, size): pivots, of rank 0, are indexed, then members are looked
    up. A member that is linked with a pivot gives one row, and one for each pair of components of pivots that it joins
    up; where a cluster has no pivot, each member gives a row without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pivots, values, find, forest = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            met: list[tuple] = []
            parts, ranks, reps, clusters, sizes = (batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5))
            for part, rank, rep, cluster, size, one in zip(parts, ranks, reps, clusters, sizes, values_of(batch.column(3))):
                if part != held:
                    held, pivots, values, find = part, [], [], None
                if rank == 0:
                    pivots.append(rep)
                    values.append(one)
                    continue
                if find is None:
                    find, forest = index_of(values), Forest(len(pivots))
                found = find(one) if pivots else []
                if found or not pivots:
                    met.append((cluster, rep, pivots[found[0]] if found else None, False, size))
                for j in found[1:]:
                    if forest.join(found[0], j):
                        met.append((cluster, pivots[j], pivots[found[0]], True, size))
            columns = list(zip(*met)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["cluster", "rep", "pivot", "joint", "size"]
            )

    return run


def _sketches(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint8) for v in column.to_pylist()]


def _close(sketches: list[np.ndarray]):
    """Positions of the sketches close to one."""
    rows = np.array(sketches).reshape(-1, COORDINATES)
    return lambda one: np.flatnonzero((rows == one).sum(axis=1) >= CLOSE).tolist()


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """Close pairs (a, b) that connect all close pairs of any node of the trees; ``reps`` has rep, sketch, roots."""
    live = reps.select(F.explode("roots").alias("cluster"), "rep")
    sketches = reps.select("rep", F.col("sketch").alias("data"))
    found = []
    for depth in range(ROUNDS + 1):
        sizes = live.groupBy("cluster").agg(F.count("*").alias("size")).filter("size > 1")
        members = live.join(sizes, "cluster").join(sketches, "rep").select("cluster", "rep", "data", "size")
        members = staged(members, "nodes")
        leaves, large = members.filter(F.col("size") <= LEAF), members.filter(F.col("size") > LEAF)
        leaves = leaves.select("cluster", "rep", "data")
        found.append(staged(_in_groups(leaves, ["cluster"], ["rep"], _compare_leaves, "a long, b long"), "pairs"))
        if large.isEmpty():
            break
        met = _met_pivots(large, _against(_close, _sketches), PIVOTS)
        outside = _outside(large, met)
        last = depth == ROUNDS
        ready = outside if last else outside.filter(F.col("rest") <= BLOCK)
        more = staged(_others_with_all(ready, _against(_close, _sketches)), "pairs")
        found += [_links(met), _links(more)]
        if last:
            break
        live = staged(_branches(outside.filter(F.col("rest") > BLOCK)), "branches")
    return _union(found).filter("a <> b").distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def _branches(members: DataFrame) -> DataFrame:
    """The child nodes (cluster, rep) that each member of a node goes on to."""

    def branch(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy().astype(np.uint64)
            rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, COORDINATES)
            for k in range(BRANCHES):
                at = mix(node + np.uint64(k)) % np.uint64(COORDINATES)
                value = rows[np.arange(len(rows)), at.astype(np.int64)].astype(np.uint64)
                key = mix(node + mix(value + np.uint64(256 * k + 1))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(1)], ["cluster", "rep"])

    return members.select("cluster", "rep", "data").mapInArrow(branch, "cluster long, rep long")


class Inverted:
    """Shingle sets by shingle, to count what one set shares with all of them."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.values, self.first = np.unique(every[order], return_index=True)
        self.first = np.append(self.first, len(every))
        self.owner = owner[order]
        self.sizes = np.array([len(s) for s in sets])

    def similar(self, one: np.ndarray) -> np.ndarray:
        """Which sets are linked with ``one``."""
        at = np.searchsorted(self.values, one)
        inside = at < len(self.values)
        at, one_in = at[inside], one[inside]
        at = at[self.values[at] == one_in]
        low, n = self.first[at], self.first[at + 1] - self.first[at]
        index = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(at) else at
        shared = np.bincount(self.owner[index], minlength=len(self.sizes))
        union = self.sizes + len(one) - shared
        return (100 * shared >= SIMILARITY * union) & (shared > 0)


def _sets(texts: pa.ChunkedArray | pa.Array, size: int) -> list[np.ndarray]:
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return [s for words in words_of(column, BETWEEN_SPACES, lower=True) for s in shingle_sets(words, size)]


def _confirm_small(size: int):
    """Links of each cluster (cluster, rep, text) that span its components."""

    def run(batches):
        for group in groups(batches, 1):
            rep, sets = group.column(1).to_pylist(), _sets(group.column(2), size)
            index, forest = Inverted(sets), Forest(len(rep))
            a, b = [], []
            for i in range(len(rep)):
                if forest.parts == 1:
                    break
                for j in np.flatnonzero(index.similar(sets[i])).tolist():
                    if forest.join(i, j):
                        a.append(rep[i])
                        b.append(rep[j])
            if a:
                yield _edges(a, b)

    return run


def confirmed_links(docs: DataFrame, clusters: DataFrame, size: int) -> DataFrame:
    """Links (a, b) on full sets that span every component within the clusters (rep, cluster)."""
    counts = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    texts = docs.select(F.col("doc_id").alias("rep"), F.col("text").alias("data"))
    # the same plan at every size: texts are shuffled by id once, no table that grows with them is broadcast
    members = clusters.join(counts, "cluster").hint("merge").join(texts, "rep").select("cluster", "rep", "data", "size")
    members = staged(members, "members")
    small = members.filter(F.col("size") <= BLOCK).select("cluster", "rep", "data")
    found = [staged(_in_groups(small, ["cluster"], ["rep"], _confirm_small(size), "a long, b long"), "links")]
    large = members.filter(F.col("size") > BLOCK)
    if not large.isEmpty():

        def sets(column: pa.Array) -> list[np.ndarray]:
            return _sets(column, size)

        def linked(values: list[np.ndarray]):
            index = Inverted(values)
            return lambda one: np.flatnonzero(index.similar(one)).tolist()

        met = _met_pivots(large, _against(linked, sets), TEXT_PIVOTS)
        more = staged(_others_with_all(_outside(large, met), _against(linked, sets)), "links")
        found += [_links(met), _links(more)]
    return _union(found)


def components(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    rows = staged(with_columns(docs, "text", lambda column: sketch(column, size), _FIELDS, ["doc_id"]), "sketches")
    filled = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = filled.groupBy("high", "low").agg(
        F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("roots").alias("roots")
    )
    sets = staged(sets, "sets")
    pairs = candidate_pairs(sets)
    roots = connected_components(pairs)
    clusters = roots.select(F.col("id").alias("rep"), F.col("root").alias("cluster"))
    clusters = staged(clusters.union(clusters.select("cluster", "cluster").distinct()), "clusters")
    found = connected_components(confirmed_links(docs, clusters, size))
    labels = sets.select("high", "low", "rep").join(found, F.col("rep") == F.col("id"), "left").select(
        "high", "low", F.coalesce("root", "rep").alias("component")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    joined = rows.select("doc_id", "n_shingles", "high", "low").join(labels, ["high", "low"], "left")
    return joined.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: shingles, component, whether it stands for its component."""
    return components(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each component; five words to a shingle."""
    dropped = components(docs.select("doc_id", "text"), STAGE_SHINGLE_WORDS).filter("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
