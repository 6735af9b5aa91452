"""Top-k search, Merkle manifest and fill-in-the-middle against brute force, with nulls,
ties, repeated rows, empty tables, long texts and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from lanecost.llm import fill_middle, merkle, mtree

# --- M-tree search

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    # names that the operator gives its results or uses inside
                    T.StructField("score", T.StringType()), T.StructField("vec", T.StringType()), T.StructField("q", T.LongType())])


def vectors():
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        center = [(i % 4 == j) * 0.9 for j in range(6)]
        rows.append((i, [c + rnd.gauss(0, 0.05) for c in center]))
    common = [0.5, -0.5, 0.5, 0.25, 0.0, 0.125]
    rows += [(200 + i, common) for i in range(40)]                                     # equal vectors, queries among them
    rows += [(300 + i, [float(i % 3), 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(20)]    # ties
    rows += [(400, None), (450, [float("nan")] * 6), (451, [math.inf] + [0.0] * 5), (500, [None] + [0.1] * 5),
             (501, []), (550, []), (551, [0.5, 0.5]), (600, [0.25, 0.75]), (650, [3e38] * 6),
             (-50, common), (0, [0.1] * 6), (700, common), (700, common), (None, common)]
    return rows


def brute_topk(rows, k):
    kept = set()
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if sum(x * x for x in whole) < 1 << 62:
            kept.add((i, whole))
    want = collections.Counter()
    for i, v in kept:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in kept if j != i and len(w) == len(v))[:k]
            want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(best))
    return want


@pytest.fixture(scope="module")
def vecs(spark):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in vectors()], VEC).repartition(3)


@pytest.mark.parametrize("k,options,asking", [
    (5, {}, {}), (3, dict(tree_rows=16, page_rows=4, fanout=3, most_pivots=5), dict(query_block=2, root_chunk=2))])
def test_topk_equals_brute_force(vecs, k, options, asking):
    out = mtree.search(mtree.index(vecs, k=k, **options), vecs.filter(F.col("vec_id") % 50 == 0), **asking)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert collections.Counter(map(tuple, out.collect())) == brute_topk(vectors(), k)


def test_topk_of_empty_tables(spark, vecs):
    none = vecs.filter("false")
    assert mtree.search(mtree.index(none), none).count() == 0
    assert mtree.search(mtree.index(vecs), none).count() == 0
    assert mtree.search(mtree.index(none), vecs).count() == 0


def tree_of(objects, **options):
    largest = int((objects.astype(np.int64) ** 2).sum(1).max())
    metric = mtree.Metric(largest)
    objects = objects.astype(metric.kind)
    pages = mtree.build_tree(objects, metric, **options)
    return metric, objects, [p | {"objects": objects[p["rows"]], "far": np.array(p["far"]),
                                  "ids": [[int(i)] for i in p["rows"]]} for p in pages]


def test_tree_covers_its_objects():
    objects = np.unique(np.random.default_rng(1).integers(-200, 200, (500, 8)), axis=0)
    metric, objects, pages = tree_of(objects, page_rows=16, fanout=4)
    points = metric.lift(objects)

    def under(number):
        p = pages[number]
        return set(p["rows"].tolist()) if not p["child"] else set().union(*map(under, p["child"]))

    assert under(0) == set(range(len(objects)))
    for p in pages:
        assert len(p["rows"]) <= 16
        for at, far, child in zip(p["rows"], p["far"], p["child"]):
            assert max(np.linalg.norm(points[i] - points[at]) for i in under(child)) <= far + 1e-6
            assert np.allclose(pages[child]["near"], [np.linalg.norm(points[i] - points[at]) for i in pages[child]["rows"]])


@pytest.mark.parametrize("scale", [1, 200, 1 << 20])
def test_best_first_is_exact_and_computes_few_distances(scale):
    rng = np.random.default_rng(7)
    centers = rng.integers(-100, 100, (30, 4))
    objects = np.unique(centers[rng.integers(0, 30, 3000)] * 8 + rng.integers(-6, 7, (3000, 4)), axis=0) * scale // 10
    objects = np.unique(objects, axis=0)
    metric, objects, pages = tree_of(objects, page_rows=32, fanout=8)
    total = 0
    for i in range(0, len(objects), 97):
        query = objects[i].astype(metric.kind)
        found, computed = mtree.best_first(pages, metric, query, 6)
        scores = [int(x) for x in objects.astype(object) @ objects[i].astype(object)]
        assert found == sorted(((s, j) for j, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:6]
        again, fewer = mtree.best_first(pages, metric, query, 6, found[-1][0])
        assert again == found and fewer <= computed
        total += computed
    assert total < 0.5 * len(objects) * len(range(0, len(objects), 97))


# --- Merkle manifest

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                    T.StructField("node", T.StringType()), T.StructField("slot", T.LongType()), T.StructField("n", T.LongType())])
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_merkle(rows, fanout):
    """{(id, leaf): (subroot, root, proof, folded)} of rows (doc_id, text, lang, source, n_chars)."""
    def leaf(r, text):
        d = dict(doc_id=r[0], text=text, lang=r[2], source=r[3], n_chars=r[4])
        return sha("".join("-" if d[c] is None else f"{len(str(d[c]).encode())}:{d[c]}" for c in COLUMNS))

    def lower(t):
        return t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def climb(hashes):
        """Levels of a tree and, per leaf, the (left, right) siblings upwards."""
        paths, levels = [[] for _ in hashes], [hashes]
        while len(levels[-1]) > 1:
            cur = levels[-1]
            for i, path in enumerate(paths):
                at = i // fanout ** (len(levels) - 1)
                run = at // fanout * fanout
                path.append((cur[run:at], cur[at + 1:run + fanout]))
            levels.append([sha("".join(cur[i:i + fanout])) for i in range(0, len(cur), fanout)])
        return levels[-1][0], paths

    groups = collections.defaultdict(list)
    for r in rows:
        own = leaf(r, r[1])
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append(((r[0] is not None, r[0] or 0), own, leaf(r, lower(r[1])) if hit else own, r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[1] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, upper = climb([trees[g][0] for g in order])
    want = collections.Counter()
    for g, up in zip(order, upper):
        subroot, paths = trees[g]
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), paths):
            folded = x[2]
            for left, right in path + up:
                folded = sha("".join(left) + folded + "".join(right))
            proof = "".join("".join(left + right) for left, right in path + up)
            want[x[3], x[1], subroot, root, proof, folded] += 1
    return want


def manifest_rows():
    rnd = random.Random(9)
    rows = [(rnd.randrange(10 ** 9), rnd.choice([None, "", "Ab Zé", "x" * 3000 + "Q", "line\nTwo"]), rnd.choice(["en", "de"]),
             rnd.choice(["s", None]), rnd.choice([3, None])) for _ in range(150)]
    rows += [(5, "Lone", "xx", "s", 4), (None, "No Id", "en", "s", 5), (None, "No id", "en", "s", 5), (7, "A", None, None, None),
             (8, "B", "", "s", 1), (-3, "Negative", "é", "s", 8)]
    rows += [(11, "Again", "en", "s", 5)] * 20 + [(11, "Other", "en", "s", 5)]
    return rows


def tampered_proofs(df, fanout=8):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claimed = merkle.digest(*[merkle.encoded(c, F.when(hit, lower).otherwise(F.col("text")) if c == "text" else None) for c in COLUMNS])
    out = merkle.prove(merkle.build(df, "doc_id", "lang", COLUMNS, claimed, fanout))
    return collections.Counter((r.key, r.leaf, r.subroot, r.root, r.proof, r.folded) for r in out.collect())


@pytest.mark.parametrize("fanout,some", [(8, slice(None)), (3, slice(None)), (8, slice(0, 1)), (8, slice(150, 151))])
def test_merkle_equals_brute_force(spark, fanout, some):
    rows = manifest_rows()[some]
    df = spark.createDataFrame([r + ("n", 1, 2) for r in rows], DOC).repartition(4)
    assert tampered_proofs(df, fanout) == brute_merkle(rows, fanout)


def test_merkle_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOC)
    m = merkle.build(empty)
    assert m.root is None and merkle.prove(m).count() == 0


def test_merkle_copies_are_spread(spark):
    rows = spark.range(3).select(F.lit("a").alias("x")).unionByName(spark.range(1).select(F.lit(None).cast("string").alias("x")))
    assert sorted((r.x or "", r["__copy"]) for r in merkle._spread(rows, chunk=2).collect()) == [("", 0), ("a", 0), ("a", 1), ("a", 2)]


def test_merkle_untampered_leaves_fold_to_the_root(spark):
    rows = manifest_rows()
    df = spark.createDataFrame([r + ("n", 1, 2) for r in rows], DOC)
    m = merkle.build(df)
    assert {r.folded for r in merkle.prove(m).collect()} == {m.root}


# --- fill in the middle

@pytest.mark.parametrize("block", [1, 2, 7, 1 << 16])
def test_rotation_exchanges_segments_in_place(block):
    rnd = random.Random(4)
    for size in (0, 1, 2, 5, 33, 200):
        data = bytes(rnd.randrange(256) for _ in range(size))
        lo, mid, hi = sorted(rnd.randint(0, size) for _ in range(3))
        buf = bytearray(data)
        fill_middle.rotate(buf, lo, mid, hi, block)
        assert bytes(buf) == data[:lo] + data[mid:hi] + data[lo:mid] + data[hi:]
        fill_middle.rotate(buf, lo, lo + hi - mid, hi, block)
        assert bytes(buf) == data


def brute_middle(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def middle_rows():
    rnd = random.Random(6)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb", "a\r\nb\r\n", "é\nü\n\U0001f600", "has <P> in it", "<M>", "x<S>y", "<<P <S <M >\n<",
             "<P\n>S>\n<", "Ab\n" * 90_000, "\x0b\x0c\u2028 no breaks", "<" * 50 + "\n" + ">" * 50]
    texts += ["".join(rnd.choice("ab\n<é> ") for _ in range(rnd.randint(1, 60))) for _ in range(120)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no\nid\n"), (3, "\n\n\n"), (-12, "neg\native"), (2 ** 62, "big\nid")]


@pytest.mark.parametrize("rate", [100, 40])
def test_fill_middle_equals_brute_force_and_restores(spark, rate):
    rows = middle_rows()
    df = spark.createDataFrame([(i, t, "c", "d", 1) for i, t in rows],
                               "doc_id long, text string, form string, output string, n long").repartition(3)
    out = fill_middle.restore(fill_middle.fill_middle(df, rate=rate)).collect()
    assert collections.Counter(tuple(r)[:6] for r in out) == collections.Counter(brute_middle(i, t, rate) for i, t in rows)
    assert collections.Counter((r.doc_id, r.restored) for r in out) == collections.Counter((i, t or "") for i, t in rows)
    assert {"plain", "psm", "spm"} == {r.form for r in out}


def test_fill_middle_of_an_empty_table_and_of_other_sentinels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.restore(fill_middle.fill_middle(empty)).count() == 0
    df = spark.createDataFrame([(str(i), t) for i, t in middle_rows()], "key string, body string")
    with pytest.raises(ValueError):
        fill_middle.fill_middle(df, "key", "body", sentinels=("<P>", "<P>x", "<S>"))
    with pytest.raises(ValueError):
        fill_middle.fill_middle(df, "key", "body", sentinels=("<<P>", "<M>", "<S>"))
    marks = ("[pre]", "[mid]", "[suf]")
    out = fill_middle.restore(fill_middle.fill_middle(df, "key", "body", sentinels=marks), sentinels=marks)
    assert collections.Counter((r.key, r.restored) for r in out.collect()) == collections.Counter(
        (str(i), t or "") for i, t in middle_rows())
