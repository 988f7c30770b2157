"""Near-duplicate groups by MinHash banding, verified on full shingle sets.

Text is lower-cased (A-Z); a document's set holds its distinct 5-word shingles
(one for the whole text if it is shorter). Documents with equal sets form a class,
and only classes go on. A class has ``BANDS * ROWS`` minima of universal hashes;
classes that agree on all rows of a band share a bucket.

1. In every bucket each class is paired with the smallest one. Pairs whose
   signatures agree well enough are verified on full sets, and links become
   components by alternating large-star and small-star.
2. In buckets that still hold several components, all other pairs across
   components are examined, block by block inside tasks: signatures first (128 bytes a
   class are all that moves), which mark the classes that have a partner, then the
   full sets of those, in blocks bounded by the shingles they hold. Components that
   meet in a block are one from then on. Only links leave a task, never candidate pairs.

Two sets at the threshold share a bucket with probability
``1 - (1 - 0.75**ROWS)**BANDS`` (more than 0.99999), and signatures reject
them with about the same small probability; ``least_matches=0`` verifies every pair
that shares a bucket.

Defined results: a null, empty or blank text has an empty set, links with nothing
and is its own component. Rows that share an id are one node. A null id has a null
component and is kept. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import connected_components
from starloom.llm.words import WordHashes, Windows, shingles, texts
from starloom.operators.dedup import dedup
from starloom.scratch import materialise

SHINGLE = 5
BANDS, ROWS = 32, 4
#: Matching minima of 128 below which a pair at 0.75 is out of the question (five deviations).
LEAST_MATCHES = 72
#: Members of a bucket whose signatures are compared in one block; members and shingles
#: of a block of full sets (a larger set is a block of its own).
BLOCK, SETS, SHINGLES = 8192, 2048, 1_000_000
#: A class of equal sets with more than 1 / HOT of all rows is hot; there are fewer than HOT.
HOT = 20_000
_random = np.random.default_rng(20240607)
_MULTIPLY = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None]


def minima(values: np.ndarray) -> np.ndarray:
    """The smallest (a * x + b) mod 2**64 over the set, for each hash function."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 512):
        part = values[None, start : start + 512] * _MULTIPLY
        part += _ADD
        np.minimum(least, part.min(axis=1), out=least)
    return least


class Shingler:
    """Sets of shingle hashes of texts."""

    def __init__(self) -> None:
        self.hashes = WordHashes()
        self.windows = Windows(SHINGLE)

    def __call__(self, text: bytes) -> np.ndarray:
        return shingles(self.hashes.of(text.lower().split()), SHINGLE, self.windows)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        out = {name: [] for name in ("n", "key", "signature", "bands")}
        for text in texts(batch, 1):
            own = shingler(text)
            out["n"].append(len(own))
            if not len(own):
                for name in ("key", "signature", "bands"):
                    out[name].append(None)
                continue
            least = minima(own) >> np.uint64(32)
            out["key"].append(xxhash.xxh3_128_digest(own.tobytes()))
            out["signature"].append(least.astype("<u1").tobytes())
            rows = least.astype("<u4").reshape(BANDS, ROWS)
            # The band's number seeds its key: buckets of different bands never meet.
            out["bands"].append([xxhash.xxh3_64_intdigest(r.tobytes(), b) - (1 << 63) for b, r in enumerate(rows)])
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        arrays = [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *out])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        data = pa.array([shingler(text).tobytes() for text in texts(batch, 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), data], names=["id", "set"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, lead, id) of buckets with two classes or more, from rows sorted by bucket and id."""
    last, lead, shown = None, None, True
    for batch in batches:
        buckets, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out: list[tuple] = []
        for bucket, node in zip(buckets, ids, strict=True):
            if bucket != last:
                last, lead, shown = bucket, node, False
            elif node != lead:
                if not shown:
                    out.append((bucket, lead, lead))
                    shown = True
                out.append((bucket, lead, node))
        columns = zip(*out, strict=True) if out else ([], [], [])
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), batch.schema.types[1], batch.schema.types[1]), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "lead", "id"])


def _matching(least: int):
    """A task that keeps pairs (a, b, sizes, signatures) that can reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_matrix(batch.column(k)) for k in (4, 5))
            m, n = (np.asarray(batch.column(k)) for k in (2, 3))
            good = ((x == y).sum(1) >= least) & (100 * np.minimum(m, n) >= 75 * np.maximum(m, n))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good))

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u1").reshape(-1, BANDS * ROWS)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


class _Block:
    """One block of a bucket, or two that face each other, with signatures."""

    def __init__(self, table: pa.Table, least: int) -> None:
        self.table, self.least = table, least
        self.group, self.size, own = (table.column(n).to_numpy() for n in ("component", "n", "block"))
        self.signature = _matrix(table.column("signature").combine_chunks())
        self.left = np.flatnonzero(own == table.column("i")[0].as_py())
        self.right = np.flatnonzero(own == table.column("j")[0].as_py())

    def pairs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, row, matching minima) of pairs of these rows across components that may link."""
        right = self.right
        score = np.stack([np.count_nonzero(self.signature[right] == self.signature[r], axis=1) for r in rows])
        sizes = self.size[rows, None], self.size[right]
        fits = 100 * np.minimum(*sizes) >= 75 * np.maximum(*sizes)
        x, y = np.nonzero((score >= self.least) & fits & (self.group[rows, None] != self.group[right]))
        return rows[x], right[y], score[x, y]

    def slices(self) -> Iterator[np.ndarray]:
        """The rows of the left side, a few at a time."""
        for start in range(0, len(self.left), 32):
            yield self.left[start : start + 32]


def _chunks(rows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in runs of up to SETS members and SHINGLES shingles."""
    start, held = 0, 0
    for k, n in enumerate(sizes[rows]):
        if k > start and (k - start == SETS or held + n > SHINGLES):
            yield rows[start:k]
            start, held = k, 0
        held += n
    if len(rows):
        yield rows[start:]


def _marked(least: int):
    """A group's task: the rows that have a partner, in blocks bounded by their shingles."""

    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, least)
        marked = np.zeros(table.num_rows, bool)
        for rows in block.slices():
            a, b, _ = block.pairs(rows)
            marked[a] = True
            marked[b] = True
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        left = list(_chunks(block.left[marked[block.left]], block.size))
        right = left if same else list(_chunks(block.right[marked[block.right]], block.size))
        order, i, j, own = [], [], [], []
        for x, mine in enumerate(left):
            for y, other in enumerate(right):
                if same and y < x:
                    continue
                # Numbers of one side, so that a row of the other is told apart.
                sides = [(mine, 2 * x)] if same and x == y else [(mine, 2 * x), (other, 2 * y if same else 2 * y + 1)]
                for rows, number in sides:
                    order.append(rows)
                    own.append(np.full(len(rows), number))
                    i.append(np.full(len(rows), 2 * x))
                    j.append(np.full(len(rows), 2 * y if same else 2 * y + 1))
        picked = table.take(pa.array(np.concatenate(order) if order else np.zeros(0, np.int64)))
        # The part names the group that these blocks come from.
        part = pa.array([f"{table.column('i')[0].as_py()}-{table.column('j')[0].as_py()}"] * picked.num_rows, pa.string())
        columns = {n: picked.column(n) for n in ("bucket", "id", "component", "n", "signature")}
        numbers = {n: pa.array(np.concatenate(x) if x else np.zeros(0), pa.int32()) for n, x in (("block", own), ("i", i), ("j", j))}
        return pa.table(columns | {"part": part} | numbers)

    return run


def _links(least: int):
    """A group's task: links across components, verified on full sets."""

    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, least)
        node = table.column("id").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("set")]
        # Renamed as components meet; pairs that are one component by then are not looked at.
        block.group = block.group.copy()
        out = []
        for rows in block.slices():
            a, b, score = block.pairs(rows)
            for k in np.argsort(-score.astype(np.int64), kind="stable"):
                x, y = block.group[a[k]], block.group[b[k]]
                if x == y:
                    continue
                own, other = sets[a[k]], sets[b[k]]
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= 75 * (len(own) + len(other) - both):
                    block.group[block.group == y] = x
                    out.append(sorted((int(node[a[k]]), int(node[b[k]]))))
        kind = table.schema.field("id").type
        return pa.table({"a": pa.array([x for x, _ in out], kind), "b": pa.array([y for _, y in out], kind)})

    return run


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", least_matches: int = LEAST_MATCHES
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    The id must be an integer column. ``component_id`` is the smallest id reachable
    over links of at least 0.75; ``kept`` is true for it alone.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {kind}, n long, key binary, signature binary, bands array<long>"
    signed = materialise(named.mapInArrow(_sign, schema), "minhash-signatures")
    nodes = signed.where(F.col("id").isNotNull() & F.col("key").isNotNull())
    members = materialise(_represented(nodes.select("id", "key")).distinct(), "minhash-members")
    # A class speaks through its smallest member.
    classes = nodes.join(members.where(F.col("id") == F.col("rep")).select("id", "key"), ["id", "key"])
    classes = classes.dropDuplicates(["id", "key"])

    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    entries = classes.select(F.explode("bands").alias("bucket"), "id")
    dealt = entries.repartition(tasks, "bucket").sortWithinPartitions("bucket", "id")
    buckets = materialise(dealt.mapInArrow(_stars, f"bucket long, lead {kind}, id {kind}"), "minhash-buckets")

    signatures = classes.select("id", "n", "signature")
    pairs = buckets.where(F.col("lead") != F.col("id")).select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    # Texts move once: the sets of all classes that share a bucket with another.
    sets = _read_sets(buckets.select("id").distinct(), named, kind)
    links = _verified(_signature_check(pairs, signatures, kind, least_matches), sets, kind)
    # Rows that share an id are one node, whatever class they are in.
    same = members.where(F.col("id") != F.col("rep")).select(F.col("rep").alias("u"), F.col("id").alias("v")).distinct()
    found = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same))
    found = materialise(found, "minhash-components")
    links = materialise(_cross_links(buckets, found, classes, sets, kind, least_matches), "minhash-links")
    if not links.isEmpty():
        found = _merged(found, links)

    named_ = found.select(F.col("node").alias("id"), F.col("component").alias("component_id"))
    result = signed.select("id", "n").join(named_, "id", "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _represented(nodes: DataFrame) -> DataFrame:
    """(id, rep, key): every node with the smallest of its class; members of a hot class are not shuffled."""
    least = materialise(nodes.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "minhash-classes")
    total = least.agg(F.sum("rows")).first()[0] or 0
    is_hot = F.col("rows") * HOT > total
    hot, cold = F.broadcast(least.where(is_hot).drop("rows")), least.where(~is_hot).drop("rows")
    rest = nodes.join(hot, "key", "left_anti").join(cold, "key")
    return nodes.join(hot, "key").unionByName(rest).select("id", "rep", "key")


def _signature_check(pairs: DataFrame, signatures: DataFrame, kind: str, least: int) -> DataFrame:
    side = lambda x: signatures.select(
        F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")
    )
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(_matching(least), f"a {kind}, b {kind}").distinct()


def _read_sets(ids: DataFrame, named: DataFrame, kind: str) -> DataFrame:
    """(id, set) of the given ids, which are too many to be sent to every task."""
    sets = named.join(ids.hint("merge"), "id", "left_semi").mapInArrow(_sets, f"id {kind}, set binary")
    return materialise(sets, "minhash-sets")


def _verified(pairs: DataFrame, sets: DataFrame, kind: str) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(_verify, f"a {kind}, b {kind}").distinct()


def _cross_links(buckets: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame, kind: str, least: int) -> DataFrame:
    """Links between members of different components that share a bucket.

    A bucket of many members is cut into blocks, and each pair of blocks is a task
    of its own. Pairs with the lead have been examined before.
    """
    nodes = found.select(F.col("node").alias("id"), "component")
    rest = buckets.where(F.col("id") != F.col("lead")).join(nodes, "id", "left")
    rest = rest.select("bucket", "id", F.coalesce("component", "id").alias("component"))
    mixed = rest.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = mixed.where(F.col("low") < F.col("high")).select("bucket", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    members = rest.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    known = members.join(classes.select("id", "n", "signature"), "id")
    facing = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("facing")
    spread = known.select("bucket", "id", "component", "n", "signature", "block", facing)
    spread = spread.withColumn("i", F.least("block", "facing")).withColumn("j", F.greatest("block", "facing")).drop("facing")
    schema = f"bucket long, id {kind}, component {kind}, n long, signature binary, part string, block int, i int, j int"
    marked = materialise(spread.groupBy("bucket", "i", "j").applyInArrow(_marked(least), schema), "minhash-marked")
    grouped = marked.join(sets, "id").groupBy("bucket", "part", "i", "j")
    return grouped.applyInArrow(_links(least), f"a {kind}, b {kind}").distinct()


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only the links between components are solved."""
    group = found.select("node", "component")
    u = links.join(group.select(F.col("node").alias("a"), F.col("component").alias("u")), "a", "left")
    v = u.join(group.select(F.col("node").alias("b"), F.col("component").alias("v")), "b", "left")
    between = v.select(F.coalesce("u", "a").alias("u"), F.coalesce("v", "b").alias("v"))
    joined = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = group.unionByName(ends.join(group, "node", "left_anti").select("node", F.col("node").alias("component")))
    moved = nodes.join(joined, "component", "left")
    return materialise(moved.select("node", F.coalesce("joined", "component").alias("component")), "minhash-components")


def keep_one_each(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each near-duplicate group, with all its columns; rows without an id all stay.

    Rows that share the id that is kept: of those with one text the first by the other
    columns stays, and every other text stays as well.
    """
    groups = near_duplicates(docs, id_column=id_column, text_column=text_column)
    kept = groups.where(F.col("kept") & F.col(id_column).isNotNull()).select(id_column).distinct()
    named = dedup(docs.join(kept, id_column, "left_semi").select(*docs.columns), [id_column, text_column])
    return named.unionByName(docs.where(F.col(id_column).isNull()))
