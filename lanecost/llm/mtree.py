"""Exact top-k by inner product with a forest of M-trees, searched best-first.

Vectors become whole numbers, floor(scale * x), so scores are exact. With one more
coordinate, sqrt(M - |x|^2) for rows and 0 for queries (M: the largest squared norm), the
squared distance of a query to a row is |q|^2 + M - 2 <q, x>: the nearest row is the one of
the highest score, and the metric bounds of an M-tree apply.

Building: equal vectors are one object that keeps its k + 1 smallest ids (no more can be
in an answer), so a vector that a third of all rows share is one entry. Objects go to the
nearest of a few pivots; a pivot's region is cut by hash into blocks of about
``tree_rows``, one M-tree each, built in one task and written as pages, a row each. An entry
of a page holds an object, its distance to the page's routing object and, above the
leaves, the covering radius of the page below it.

Searching: each different query vector first asks the tree where its like would lie; its
(k + 1)th score there is a bound. Tree roots, themselves paged, then say which trees may
hold anything as good, and only these are asked. In a tree pages wait in a queue by the
best score they can hold. What is known of the distance to a page's routing object bounds
the distance to each of its entries (triangle inequality), so most are never computed.
Pages and queries meet in an equi-join by stream: the pages of a tree come first, its
queries after them one by one, a tree with very many queries being read by several tasks.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import stage

#: Squared norms stay under this, so every score fits a long.
MOST_NORM = 1 << 62
#: Under this, sums of products are exact in doubles.
EXACT_DOUBLE = 1 << 52
#: What rounding may do to a distance, as a share of the largest norm, with much to spare.
SLACK = 1e-5


def whole_numbers(rows: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, vec): the scaled vectors as packed 32-bit integers. Rows without an id or
    a vector, with a component that is null or not finite, or with a squared norm of
    2^62 or more (whose scores need not fit a long) are left out."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("vec", T.BinaryType())])

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            fine = np.isfinite(values) & (np.abs(values) < 2.0 ** 31)
            ints = np.where(fine, values, 0).astype(np.int64)
            lengths = np.array([x or 0 for x in lists.value_lengths().to_pylist()], dtype=np.int64)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~fine)])
            ids, vecs = [], []
            for i, (key, end, size) in enumerate(zip(batch.column(0).to_pylist(), ends, lengths)):
                start = end - size
                part = ints[start:end]
                if bad[end] == bad[start] and float((part.astype(np.float64) ** 2).sum()) < MOST_NORM * (1 - 1e-9):
                    ids.append(key)
                    vecs.append(part.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())], names=schema.names)

    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).mapInArrow(run, schema))


def norms(objects: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", objects, objects)


class Metric:
    """Distances between objects and from queries to objects, with the extra coordinate."""

    def __init__(self, largest: int):
        self.largest = largest
        self.kind = np.float64 if largest < EXACT_DOUBLE else np.int64
        self.slack = SLACK * math.sqrt(1 + largest)

    def unpack(self, blob: bytes, dim: int) -> np.ndarray:
        return np.frombuffer(blob, "<i4").reshape(-1, dim).astype(self.kind) if dim else np.zeros((1, 0))

    def lift(self, objects: np.ndarray) -> np.ndarray:
        """Objects as points of the metric space."""
        own = objects.astype(np.float64)
        return np.hstack([own, np.sqrt(np.maximum(self.largest - norms(own), 0))[:, None]])

    def reach(self, q2: float, score: float) -> float:
        """A distance that no row of this score or a better one lies beyond."""
        return math.sqrt(max(q2 + self.largest - 2 * score, 0)) + self.slack


def _bisected(points: np.ndarray, members: np.ndarray, parts: int) -> list[np.ndarray]:
    """``members`` in ``parts`` groups of like size: the largest group is cut at the median
    between two of its far points until there are enough."""
    groups = [members]
    while len(groups) < parts:
        groups.sort(key=len)
        group = groups.pop()
        own = points[group]
        a = own[np.argmax(((own - own[0]) ** 2).sum(1))]
        b = own[np.argmax(((own - a) ** 2).sum(1))]
        side = np.argsort(((own - a) ** 2).sum(1) - ((own - b) ** 2).sum(1), kind="stable")
        groups += [group[side[:len(group) // 2]], group[side[len(group) // 2:]]]
    return groups


def build_tree(objects: np.ndarray, metric: Metric, page_rows: int, fanout: int) -> list[dict]:
    """Pages of one tree over distinct objects, the root first. A page: ``rows`` (its
    objects), ``near`` (their distances to the page's routing object), and above the leaves
    ``far`` (covering radii) and ``child`` (page numbers)."""
    points = metric.lift(objects)
    pages: list[dict] = []

    def router(members):
        own = points[members]
        return int(members[np.argmin(((own - own.mean(0)) ** 2).sum(1))])

    def apart(members, at):
        return np.sqrt(((points[members] - points[at]) ** 2).sum(1))

    def page(members, at):
        me = len(pages)
        pages.append({})
        if len(members) <= page_rows:
            pages[me] = {"rows": members, "near": apart(members, at), "far": [], "child": []}
            return me
        groups = _bisected(points, members, min(fanout, -(-len(members) // page_rows)))
        heads = [router(g) for g in groups]
        pages[me] = {"rows": np.array(heads), "near": apart(np.array(heads), at),
                     "far": [float(apart(g, h).max()) for g, h in zip(groups, heads)],
                     "child": [page(g, h) for g, h in zip(groups, heads)]}
        return me

    everything = np.arange(len(objects))
    first = router(everything)
    page(everything, first)
    return [{"rows": np.array([first]), "near": np.zeros(1), "far": [float(apart(everything, first).max())],
             "child": [1]}] + [p | {"child": [c + 1 for c in p["child"]]} for p in pages]


class Best:
    """The ``size`` best (score, id) so far, ties to the smaller id; ``bar``: a row needs
    this score at least."""

    def __init__(self, size: int, bar: float = -math.inf):
        self.size, self.bar, self.heap = size, bar, []

    def add(self, score: int, key: int) -> None:
        entry = (score, -key)
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)
        if len(self.heap) == self.size:
            self.bar = max(self.bar, self.heap[0][0])

    def found(self) -> list[tuple[int, int]]:
        return [(s, -k) for s, k in sorted(self.heap, reverse=True)]


def best_first(pages: list[dict], metric: Metric, query: np.ndarray, size: int,
               bar: float = -math.inf) -> tuple[list[tuple[int, int]], int]:
    """The ``size`` best (score, id) of a tree among rows of score ``bar`` or more, and how
    many distances were computed. Pages (``objects``, ``near``, ``far``, ``child``,
    ``ids``) are visited by the least distance that a row in them can have."""
    best, computed = Best(size, bar), 0
    q2 = float(np.dot(query.astype(np.float64), query.astype(np.float64)))
    queue = [(0.0, 0, None)]
    while queue:
        least, number, to_router = heapq.heappop(queue)
        reach = metric.reach(q2, best.bar) if best.bar > -math.inf else math.inf
        if least > reach:
            break
        page = pages[number]
        objects, far = page["objects"], page["far"]
        chosen = None
        if to_router is not None and reach < math.inf:
            gap = np.abs(to_router - page["near"])
            chosen = np.flatnonzero(gap <= (reach + far if len(far) else reach))
            if not len(chosen):
                continue
            if len(chosen) == len(objects):
                chosen = None
            else:
                objects = objects[chosen]
        scores = objects @ query
        computed += len(objects)
        if len(far):
            dist = np.sqrt(np.maximum(q2 + metric.largest - 2.0 * scores, 0))
            at = range(len(objects)) if chosen is None else chosen.tolist()
            for j, d in zip(at, dist.tolist()):
                low = max(least, d - far[j] - metric.slack)
                if low <= reach:
                    heapq.heappush(queue, (low, page["child"][j], d))
            continue
        for i in np.flatnonzero(scores >= best.bar).tolist():
            score = int(scores[i])
            if score >= best.bar:
                for key in page["ids"][i if chosen is None else chosen[i]]:
                    best.add(score, key)
    return best.found(), computed


_PAGE = [T.StructField("tree", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("dim", T.IntegerType()),
         T.StructField("objects", T.BinaryType()), T.StructField("near", T.ArrayType(T.DoubleType())),
         T.StructField("far", T.ArrayType(T.DoubleType())), T.StructField("child", T.ArrayType(T.IntegerType())),
         T.StructField("ids", T.ArrayType(T.ArrayType(T.LongType())))]
PAGES = T.StructType(_PAGE)
_ARROW = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()),
          pa.list_(pa.int32()), pa.list_(pa.list_(pa.int64())))


def _in_regions(objects: DataFrame, pivots: dict[int, np.ndarray], largest: int) -> DataFrame:
    """Adds ``region``: the dimension and the nearest pivot of it (-1: none)."""
    names = objects.columns
    at = names.index("vec")
    schema = T.StructType([*objects.schema.fields, T.StructField("region", T.StringType())])

    def run(batches):
        metric = Metric(largest)
        lifted = {d: metric.lift(p) for d, p in pivots.items()}
        for batch in batches:
            out = []
            for start in range(0, batch.num_rows, 512):
                blobs = batch.column(at).slice(start, 512).to_pylist()
                region = [f"{len(b) // 4}/-1" for b in blobs]
                for dim in {len(b) // 4 for b in blobs} & set(lifted):
                    which = [i for i, b in enumerate(blobs) if len(b) // 4 == dim]
                    x = metric.lift(np.vstack([metric.unpack(blobs[i], dim) for i in which]))
                    p = lifted[dim]
                    near = np.argmin((p ** 2).sum(1)[None, :] - 2 * (x @ p.T), axis=1)
                    for i, r in zip(which, near.tolist()):
                        region[i] = f"{dim}/{r}"
                out += region
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(out, pa.string())], names=schema.names)

    return objects.mapInArrow(run, schema)


class Index:
    """An M-tree forest: ``pages`` and ``regions`` (region, blocks) as tables, the pivots
    and the largest squared norm."""

    def __init__(self, pages: DataFrame, regions: DataFrame, pivots: dict[int, np.ndarray], largest: int, k: int,
                 scale: int):
        self.pages, self.regions, self.pivots, self.largest, self.k, self.scale = pages, regions, pivots, largest, k, scale


def index(rows: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256,
          tree_rows: int = 4096, page_rows: int = 128, fanout: int = 16, most_pivots: int = 1024) -> Index:
    """Index every row for the best ``k`` of a query. The pivots are ``most_pivots`` distinct
    vectors at most, those of the smallest hashes; everything else sees all rows."""
    spark = rows.sparkSession
    vectors = whole_numbers(rows, id_col, vec_col, scale).distinct()
    # the k + 1 smallest ids of each vector: ranks are cut off before the shuffle
    ranked = vectors.selectExpr("*", "row_number() OVER (PARTITION BY vec ORDER BY vec_id) AS r").filter(F.col("r") <= k + 1)
    objects = stage(ranked.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "objects")

    def largest_norm(batches):
        top = 0
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                v = np.frombuffer(blob, "<i4").astype(np.int64)
                top = max(top, int((v * v).sum()))
        yield pa.RecordBatch.from_arrays([pa.array([top], pa.int64())], names=["top"])

    largest = objects.select("vec").mapInArrow(largest_norm, "top long").agg(F.max("top")).first()[0] or 0
    n = objects.count()
    sample = (objects.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(max(1, min(most_pivots, -(-n // tree_rows)))).collect())
    pivots: dict[int, list] = {}
    for r in sample:
        pivots.setdefault(len(r.vec) // 4, []).append(np.frombuffer(bytes(r.vec), "<i4").astype(np.int64))
    pivots = {d: np.vstack(p) for d, p in pivots.items()}
    placed = stage(_in_regions(objects, pivots, largest), "regions")
    regions = stage(placed.groupBy("region").agg(F.expr(f"cast(ceil(count(1) / {tree_rows}) as long)").alias("blocks")), "blocks")
    keyed = placed.join(regions, "region").select(_tree("vec").alias("tree"), "vec", "ids")

    def build(key, table):
        blobs, ids = table.column("vec").to_pylist(), table.column("ids").to_pylist()
        order = sorted(range(len(blobs)), key=blobs.__getitem__)
        dim = len(blobs[0]) // 4
        metric = Metric(largest)
        packed = [blobs[i] for i in order]
        objects = metric.unpack(b"".join(packed), dim)
        tree = table.column("tree")[0].as_py()
        cols: list[list] = [[] for _ in _ARROW]
        for number, p in enumerate(build_tree(objects, metric, page_rows, fanout)):
            leaf = not p["child"]
            row = (tree, number, dim, b"".join(packed[i] for i in p["rows"]), p["near"].tolist(), p["far"], p["child"],
                   [ids[order[i]] for i in p["rows"]] if leaf else [])
            for c, v in zip(cols, row):
                c.append(v)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW)], names=PAGES.names)

    pages = stage(keyed.repartition(_parts(spark, regions), "tree").groupBy("tree").applyInArrow(build, PAGES), "pages")
    return Index(pages, regions, pivots, largest, k, scale)


def _tree(vec: str):
    """The tree of a vector in a region of ``blocks`` trees."""
    return F.concat("region", F.lit("/"), F.pmod(F.xxhash64(vec), F.col("blocks")).cast("string"))


def _parts(spark, regions: DataFrame, slots: int = 1) -> int:
    """Tasks for work of which each tree and slot is a unit, whatever its bytes."""
    trees = regions.agg(F.sum("blocks")).first()[0] or 1
    return int(min(max(trees * slots, 1), max(10_000, int(spark.conf.get("spark.sql.shuffle.partitions")))))


_QUERY = T.StructType([T.StructField("q", T.LongType()), T.StructField("vec", T.BinaryType()), T.StructField("bar", T.LongType())])


def _meet(pages: DataFrame, asked: DataFrame, by: str, slots: int, parts: int, schema: T.StructType, work) -> DataFrame:
    """Runs ``work(unit, pages)`` -> function(q, vec, bar) -> rows, over queries (``by``, q,
    vec, bar) and the pages of the same ``by``. Pages go once to each of ``slots`` slots, a
    query to one; in a partition the pages of a unit come before its queries."""
    fields = [f for f in pages.schema if f.name != by]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    left = pages.select(by, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.lit(0).alias("kind"),
                        *[f.name for f in fields], *[F.lit(None).cast(f.dataType).alias(f.name) for f in _QUERY])
    right = asked.select(by, F.pmod("q", F.lit(slots)).cast("int").alias("slot"), F.lit(1).alias("kind"), *none, *_QUERY.names)
    stream = left.unionByName(right).repartition(parts, by, "slot").sortWithinPartitions(by, "slot", "kind")
    at = 3 + len(fields)
    types = [pa.from_numpy_dtype(np.int64) if isinstance(f.dataType, T.LongType) else pa.string() if isinstance(f.dataType, T.StringType)
             else pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())])) for f in schema]

    def run(batches):
        unit, held, answer = None, [], None
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != unit:
                    unit, held, answer = row[:2], [], None
                if row[2] == 0:
                    held.append(row[3:at])
                elif held:
                    answer = answer or work(unit[0], held)
                    rows += answer(*row[at:])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)],
                                             names=schema.names)

    return stream.mapInArrow(run, schema)


_HITS = T.StructType([T.StructField("q", T.LongType()), T.StructField("computed", T.LongType()),
                      T.StructField("hits", T.ArrayType(T.StructType([T.StructField("score", T.LongType()),
                                                                      T.StructField("vec_id", T.LongType())])))])
_TO_TREES = T.StructType([T.StructField("tree", T.StringType()), T.StructField("q", T.LongType())])


def _ask_trees(ix: Index, asked: DataFrame, slots: int, parts: int) -> DataFrame:
    """Best rows of each (tree, query), above the query's bar."""
    largest, size = ix.largest, ix.k + 1

    def work(tree, held):
        metric = Metric(largest)
        pages = [{"objects": metric.unpack(blob, dim), "near": np.array(near), "far": np.array(far), "child": child, "ids": ids}
                 for _, dim, blob, near, far, child, ids in sorted(held, key=lambda h: h[0])]

        def answer(q, vec, bar):
            query = metric.unpack(vec, len(vec) // 4)[0]
            found, computed = best_first(pages, metric, query, size, -math.inf if bar is None else bar)
            return [(q, computed, [{"score": s, "vec_id": i} for s, i in found])]

        return answer

    return _meet(ix.pages, asked, "tree", slots, parts, _HITS, work)


def _ask_roots(ix: Index, queries: DataFrame, slots: int, chunk: int) -> DataFrame:
    """(tree, q): the trees whose root says that they may hold a row as good as the bar."""
    largest = ix.largest
    roots = ix.pages.filter(F.col("page") == 0).select(
        F.col("dim"), F.col("tree"), F.col("objects"), F.element_at("far", 1).alias("far"))
    trees = max(1, int(ix.regions.agg(F.sum("blocks")).first()[0] or 1))
    chunks = -(-trees // chunk)
    roots = roots.withColumn("chunk", F.pmod(F.xxhash64("tree"), F.lit(chunks)))
    asked = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def work(_, held):
        metric = Metric(largest)
        dims: dict[int, list] = {}
        for dim, tree, blob, far in held:
            dims.setdefault(dim, []).append((tree, blob, far))
        ready = {d: ([h[0] for h in hs], metric.unpack(b"".join(h[1] for h in hs), d) if d else np.zeros((len(hs), 0)),
                     np.array([h[2] for h in hs])) for d, hs in dims.items()}

        def answer(q, vec, bar):
            dim = len(vec) // 4
            if dim not in ready:
                return []
            trees, centers, far = ready[dim]
            query = metric.unpack(vec, dim)[0]
            q2 = float(np.dot(query.astype(np.float64), query.astype(np.float64)))
            reach = math.inf if bar is None else metric.reach(q2, bar)
            least = np.sqrt(np.maximum(q2 + largest - 2.0 * (centers @ query), 0)) - far - metric.slack
            return [(trees[i], q) for i in np.flatnonzero(least <= reach).tolist()]

        return answer

    return _meet(roots, asked, "chunk", slots, max(slots * chunks, 8), _TO_TREES, work)


def search(ix: Index, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", query_block: int = 2048,
           root_chunk: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` rows of the
    index with the highest inner products, ties to the smaller id, all where there are
    fewer; rows of the query's own id are no candidates.

    Rows that repeat id and vector count once; an id with several vectors is several rows,
    each asking and answering for itself. Rows without an id, with a null vector or with
    components that are null or not finite take no part; nor do those whose squared norm
    reaches 2^62. A query only meets vectors of its length (empty ones score 0 with each
    other). Other columns are ignored; empty tables give no rows.
    """
    k = ix.k
    asking = stage(whole_numbers(queries, id_col, vec_col, ix.scale).distinct(), "asking")
    # a number for each different vector, fixed by the write
    numbers = stage(_in_regions(asking.select("vec").distinct(), ix.pivots, ix.largest)
                    .select(F.monotonically_increasing_id().alias("q"), "vec", "region"), "query-vectors")
    slots = max(1, -(-numbers.count() // query_block))
    parts = _parts(queries.sparkSession, ix.regions, slots)
    homes = numbers.join(ix.regions, "region").select(_tree("vec").alias("tree"), "q", "vec", F.lit(None).cast("long").alias("bar"))
    seeds = stage(_ask_trees(ix, homes, slots, parts), "seeds")
    bars = seeds.select("q", F.try_element_at("hits", F.lit(k + 1))["score"].alias("bar"))
    barred = stage(numbers.join(bars, "q", "left").select("q", "vec", "bar"), "bars")
    pairs = _ask_roots(ix, barred, slots, root_chunk).join(homes.select("tree", "q"), ["tree", "q"], "left_anti")
    rest = _ask_trees(ix, pairs.join(barred, "q").select("tree", "q", "vec", "bar"), slots, parts)
    hits = seeds.unionByName(rest).select("q", F.inline("hits"))
    best = (hits.selectExpr("*", "row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS r")
            .filter(F.col("r") <= k + 1).groupBy("q")
            .agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("hits")))
    answers = numbers.join(best, "q").select("vec", "hits")
    own = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return (asking.select(F.col("vec_id").alias("query_id"), "vec").join(answers, "vec")
            .select("query_id", F.posexplode(own).alias("i", "h"))
            .select("query_id", (F.col("i") + 1).alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score")))
