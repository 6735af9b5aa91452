"""Near-duplicate grouping by SuperMinHash, banding, exact verification and
distributed union-find.

A document is the set of its distinct word shingles, as 64-bit hashes. SuperMinHash
gives every element one random permutation of the signature positions and one
uniform number a step; a position keeps the least ``step + uniform`` it meets. All
values of step j lie in [j, j + 1), so once every position holds a value, later
steps cannot change the signature: that is the early stop, taken here step by step
over all elements of a block of documents at once.

Documents with equal sets are one node. Nodes that agree on all rows of a band are
candidates. A candidate pair is a link only if the exact sets are similar enough.
Pairs inside a bucket are not listed: each round compares a bucket's members with
one member (first the most central one), links are joined to components, and the
next round takes only buckets that still hold several components. For what pivots
leave over, a last round finds the pairs that can be links by an exact prefix filter,
so no link that shares a bucket and would join two components stays unseen.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lanecost.llm.graph import stars, with_roots
from lanecost.llm.util import Memo, doc_key, mix64, slices, stage

_MULT = np.uint64(0x9DDFEA08EB382D69)


def shingle_sets(texts: list[str | None], words: Memo, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. ASCII upper case is lowered;
    words are split at space, tab, LF, VT, FF and CR; a text of fewer words is one
    shingle of all of them; a null text or one without words has none."""
    parts = [(t or "").encode("utf-8", "replace").lower().split() for t in texts]
    n = np.array([len(p) for p in parts], dtype=np.int64)
    h = np.fromiter(map(words.__getitem__, chain.from_iterable(parts)), dtype=np.uint64, count=int(n.sum()))
    ends = np.cumsum(n)
    rolled = np.zeros(max(0, len(h) - width + 1), dtype=np.uint64)
    for j in range(width):
        rolled = rolled * _MULT + h[j:j + len(rolled)]
    rolled = mix64(rolled)
    out = []
    for k, end in zip(n, ends):
        start = end - k
        if k >= width:
            out.append(np.unique(rolled[start:end - width + 1]))
        elif k:
            value = np.array([k], dtype=np.uint64)
            for x in h[start:end]:
                value = mix64(value * _MULT + x)
            out.append(value)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def word_hashes() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def super_minhash(sets: list[np.ndarray], m: int = 128, block: int = 1 << 16) -> np.ndarray:
    """Signatures (documents, m) of uint64: step in the top 8 bits, uniform below."""
    if not 1 <= m <= 255:
        raise ValueError("a signature has 1 to 255 positions")
    sig = np.full((len(sets), m), np.iinfo(np.uint64).max, dtype=np.uint64)
    at = 0
    while at < len(sets):
        end, n = at, 0
        while end < len(sets) and (end == at or n + len(sets[end]) <= block):
            n += len(sets[end])
            end += 1
        _fill(sig[at:end], sets[at:end], m)
        at = end
    return sig


def _fill(sig: np.ndarray, sets: list[np.ndarray], m: int) -> None:
    sizes = [len(s) for s in sets]
    if not sum(sizes):
        return
    e = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), sizes)
    none = np.iinfo(np.uint64).max
    flat = sig.reshape(-1)
    perm = None
    for j in range(m):
        z = mix64(e + np.uint64((j + 1) * 0x632BE59BD9B4E019 % (1 << 64)))
        k = (j + (((z >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
        value = (mix64(z) >> np.uint64(8)) | np.uint64(j << 56)
        if j == 0:
            pos = k
        else:
            row = np.arange(len(e))
            pos = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
        np.minimum.at(flat, doc * m + pos, value)
        open_docs = (sig == none).any(axis=1)
        live = open_docs[doc]
        if not live.any():
            return
        if j == 0:
            first = k
            e, doc, first = e[live], doc[live], first[live]
            perm = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(e), m)).copy()
            perm[np.arange(len(e)), first] = perm[:, 0]
        elif not live.all():
            e, doc, perm = e[live], doc[live], perm[live]


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) int64 keys; a band's number is part of its key."""
    bands = sig.shape[1] // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    for r in range(rows):
        key = mix64(key * _MULT + sig[:, r:bands * rows:rows])
    return key.view(np.int64)


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int, m: int, rows: int) -> DataFrame:
    """(id, n_shingles, node, bands): node is a 128-bit hash of the set, null when empty."""
    schema = T.StructType([docs.schema[id_col], T.StructField("n_shingles", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        words = word_hashes()
        for batch in batches:
            nodes, counts, bands = [], [], []
            for (texts,) in slices([batch.select([1])], 0):
                sets = shingle_sets(texts, words, width)
                same: dict[bytes, int] = {}
                rank, distinct = [], []
                for s in sets:
                    node = xxhash.xxh128_digest(s.tobytes()) if len(s) else None
                    nodes.append(node)
                    counts.append(len(s))
                    if node is not None and node not in same:
                        same[node] = len(distinct)
                        distinct.append(s)
                    rank.append(same.get(node))
                keys = band_keys(super_minhash(distinct, m), rows)
                bands += [None if r is None else keys[r] for r in rank]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()),
                                              pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                             names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _sets(rows: DataFrame, text_col: str, width: int) -> DataFrame:
    """(node, shingles) of rows that carry a node and its text."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches):
        words = word_hashes()
        for batch in batches:
            nodes, values = [], []
            for (texts,) in slices([batch.select([1])], 0):
                for s in shingle_sets(texts, words, width):
                    nodes.append(xxhash.xxh128_digest(s.tobytes()))
                    values.append(s.view(np.int64))
            keep = [i for i, (a, b) in enumerate(zip(nodes, batch.column(0).to_pylist())) if a == b]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in keep], pa.binary()),
                                              pa.array([values[i] for i in keep], pa.list_(pa.int64()))],
                                             names=schema.names)

    return rows.select("node", text_col).mapInArrow(run, schema).dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 75, positions: int = 128, rows: int = 4, pivot_rounds: int = 2) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|``. The
    component id is the smallest id reachable over links, the document's own
    included (null ids count as larger than any other; all null: null), and
    ``kept`` tells whether the id equals it. Documents without words (null, empty or
    blank text) are linked with nothing, kept, and their own component. Repeated rows
    and ties share a set and so a component; texts of any length are taken whole; an
    empty table gives no rows; other columns are ignored, whatever their names. With ``positions`` 128 in bands of 4 a pair at similarity
    0.75 shares no band with probability 5e-6, and less above.
    """
    comp = _groups(docs, id_col, text_col, width, percent, positions, rows, pivot_rounds)
    return comp.select(F.col("key.id").alias(id_col), "n_shingles", F.col("comp.id").alias("component_id"),
                       F.col("key.id").eqNullSafe(F.col("comp.id")).alias("kept"))


def _groups(docs: DataFrame, id_col: str, text_col: str, width: int = 5, percent: int = 75, positions: int = 128,
            rows: int = 4, pivot_rounds: int = 2) -> DataFrame:
    """(key, n_shingles, comp) of every row: its ``doc_key`` and the least of its component."""
    docs = docs.select(doc_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    sketch = stage(_sketches(docs, "key", "text", width, positions, rows), "sketch")
    reps = _nodes(sketch, "key")
    linked = stage(_components(docs, sketch, "key", "text", width, percent, pivot_rounds, reps), "components")
    # nodes of one row and no link are their own component; the others are looked up
    several = (reps.select("node", F.col("id").alias("key"), "rows").join(linked, "node", "left")
               .filter(F.col("comp").isNotNull() | (F.col("rows") > 1))
               .select("node", "key", F.coalesce("comp", "node").alias("comp")))
    least = several.groupBy("comp").agg(F.min("key").alias("least"))
    named = several.join(least, "comp").select("node", "least")
    return (sketch.select("key", "n_shingles", "node").join(named, "node", "left")
            .select("key", "n_shingles", F.coalesce("least", "key").alias("comp")))


def _nodes(sketch: DataFrame, id_col: str) -> DataFrame:
    """(node, id, n, bands, rows): one row a node, with its least id and how many rows it has."""
    least = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("n_shingles").alias("n"), "bands"))
    nodes = sketch.filter(F.col("node").isNotNull()).groupBy("node").agg(least.alias("r"), F.count("*").alias("rows"))
    return stage(nodes.select("node", "r.id", "r.n", "r.bands", "rows"), "nodes")


def _components(docs, sketch, id_col, text_col, width, percent, pivot_rounds, reps=None) -> DataFrame:
    """(node, comp) of every node that has a link; ``reps`` are the sketch's ``_nodes``, if at hand."""
    spark = docs.sparkSession
    reps = _nodes(sketch, id_col) if reps is None else reps
    buckets = reps.select("node", "n", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    live = stage(buckets.join(sizes, "band"), "buckets")
    central = live.groupBy("node").agg(F.sum(F.log("size")).alias("central"))
    live = stage(live.join(central, "node"), "buckets")

    # the exact sets of candidate nodes, from the text of one row of each
    wanted = reps.select("node", F.col("id").alias("__rid")).join(live.select("node").distinct(), "node", "left_semi")
    texts = docs.select(id_col, text_col).join(wanted, F.col(id_col).eqNullSafe(F.col("__rid")))
    sets = stage(_sets(texts, text_col, width), "sets")

    tested = None
    comps = None
    for turn in range(pivot_rounds + 1):
        if comps is not None:
            # a component's smallest node has no row of its own
            known = comps.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            here = live.join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        else:
            here = live.withColumn("comp", F.col("node"))
        if turn < pivot_rounds:
            order = (F.struct("central", "node", "comp", "n") if turn == 0 else
                     F.struct(F.xxhash64(F.lit(turn), "node").alias("central"), "node", "comp", "n"))
            mixed = (here.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(order).alias("p"))
                     .filter(F.col("lo") != F.col("hi")).select("band", "p"))
            pairs = here.join(mixed, "band").filter(F.col("p.comp") != F.col("comp"))
            pairs = pairs.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"),
                                 F.col("p.node").alias("b"), F.col("p.n").alias("nb"), F.col("p.comp").alias("cb"))
        else:
            pairs = _prefix_pairs(here, sets, percent)
        # |A & B| / |A | B| is at most the ratio of the sizes
        pairs = pairs.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                             F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        sa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        checked = stage(pairs.join(sa, "a").join(sb, "b")
                        .select("a", "b", "ca", "cb", (100 * common >= percent * union).alias("link")), "links")
        tested = checked.select("a", "b") if tested is None else tested.unionByName(checked.select("a", "b"))
        # a round without new pairs ends nothing: its pivots may only have been of the wrong size
        if not checked.agg(F.sum(F.col("link").cast("int"))).first()[0]:
            continue
        # links join the components known so far, so earlier links are not walked again
        new = stars(checked.filter("link").select("ca", "cb"), "ca", "cb")
        if comps is None:
            comps = new
        else:
            moved = new.select(F.col("u").alias("v"), F.col("v").alias("to"))
            comps = stage(comps.join(moved, "v", "left").select("u", F.coalesce("to", "v").alias("v")).unionByName(new), "comps")
    if comps is None:
        return spark.createDataFrame([], T.StructType([T.StructField("node", T.BinaryType()),
                                                       T.StructField("comp", T.BinaryType())]))
    return with_roots(comps)


def _prefix_pairs(here: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, na, ca, b, nb, cb): every pair that may be a link between two components, among the
    nodes of buckets that hold several components.

    Exact: all shingles are put in one order, those seen in a single component first,
    then the rarer before the more frequent. Sets of x and y elements that are linked
    have at least t = ceil(percent * (x + y) / (100 + percent)) in common, so they
    share one among the first x - t + 1 of the one and y - t + 1 of the other. What a
    large group has in common stands last and is in few prefixes.
    """
    mixed = (here.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter(F.col("lo") != F.col("hi")).select("band"))
    nodes = here.join(mixed, "band").select("node", "n", "comp").distinct()
    rows = nodes.join(sets, "node").select("node", "n", "comp", F.explode("shingles").alias("s"))
    seen = rows.groupBy("s").agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    seen = seen.select("s", "df", (F.col("lo") != F.col("hi")).alias("across"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("across", "df", "s"))
    # the shortest partner has percent / 100 of the elements
    longest = F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1
    head = rows.join(seen, "s").withColumn("at", place).filter(F.col("across") & (F.col("at") <= longest))
    head = stage(head.select("s", "node", "n", "comp", "at"), "prefixes")
    least = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100.0 + percent) - 1e-9)
    short, long = _by_length(head, percent)
    both = short.join(long, ["s", "size"]).filter(
        ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b"))))
        & (F.col("comp_a") != F.col("comp_b"))
        & (F.col("at_a") <= F.col("n_a") - least + 1) & (F.col("at_b") <= F.col("n_b") - least + 1))
    return both.select(F.col("node_a").alias("a"), F.col("n_a").alias("na"), F.col("comp_a").alias("ca"),
                       F.col("node_b").alias("b"), F.col("n_b").alias("nb"), F.col("comp_b").alias("cb"))


def _by_length(head: DataFrame, percent: int, classes: int = 4) -> tuple[DataFrame, DataFrame]:
    """(short, long): prefix entries as the shorter and as the longer set of a pair, both
    with ``size``, a class of lengths (``classes`` to a factor of 100 / percent), to be joined
    on it beside the shingle. An entry at place ``at`` of a set of n can only prove a
    link to a set of at most (n - at + 1) * (100 + percent) / percent - n elements, so the
    shorter one goes to the classes up to that and often to none: what all documents
    of a template share stands behind what each has of its own and meets nobody."""
    def size_of(n):
        return F.floor(F.log(n) * F.lit(classes / np.log(100.0 / percent)) + 1e-9).cast("int")
    most = F.least((F.col("n") - F.col("at") + 1) * (100.0 + percent) / percent - F.col("n"), F.col("n") * 100.0 / percent)
    top = F.floor(most + 1e-9)
    columns = ("node", "n", "comp", "at")
    short = (head.filter(top >= F.col("n")).withColumn("size", F.explode(F.sequence(size_of(F.col("n")), size_of(top))))
             .select("s", "size", *[F.col(c).alias(f"{c}_a") for c in columns]))
    long = head.select("s", size_of(F.col("n")).alias("size"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return short, long


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near duplicates: that of the least id (null ids last; ties by
    a hash of the text). Of rows that repeat its id and text, or its text without an id,
    the one whose other columns are least stays; columns that hold maps have no order and
    do not count. Documents without words are linked with nothing: all their rows stay."""
    comp = _groups(docs, id_col, text_col, **options)
    marks = stage(comp.groupBy("key").agg(F.max(F.col("key") != F.col("comp")).alias("gone"),
                                          F.max("n_shingles").alias("n_shingles"), F.count("*").alias("rows"))
                  .filter(F.col("gone") | ((F.col("rows") > 1) & (F.col("n_shingles") > 0))).select("key", "gone"), "marks")
    here = doc_key(id_col, text_col)
    single = docs.join(marks.select(F.col("key").alias("__mark")), here == F.col("__mark"), "left_anti")
    again = docs.join(marks.filter(~F.col("gone")).select(F.col("key").alias("__mark")), here == F.col("__mark"), "left_semi")
    order = [f.name for f in docs.schema if f.name not in (id_col, text_col) and "map<" not in f.dataType.simpleString()]
    # grouped by other columns than the join's, so a hot key is collapsed before it is shuffled
    one = (again.groupBy(F.col(id_col).alias("__id"), F.sha2(F.col(text_col), 256).alias("__text"))
           .agg(F.min_by(F.struct(*docs.columns), F.struct(F.lit(0), *order)).alias("__row")).select("__row.*"))
    return single.union(one)
