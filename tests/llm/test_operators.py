"""Training-data operators against brute force, round trips and held-out accuracy, and
on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import collections
import hashlib
import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F, types as T

from lanecost.llm import (catalog, chat, decontam, graph, html_extract, langid, license_scan, near_dup, packing, quality,
                          suffix_dedup, warc)

SYLLABLES = "the of and ing er th st ea on re ti an en ha sh".split()
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                    # clash with names that operators give their results or use inside
                    T.StructField("node", T.StringType()), T.StructField("score", T.DoubleType())])


def words(rnd, n):
    return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 3))) for _ in range(n))


def corpus():
    rnd = random.Random(5)
    texts = [words(rnd, rnd.choice([3, 8, 40, 120])) for _ in range(40)]
    passage = words(rnd, 90)
    texts += [words(rnd, 30) + " " + passage + " " + words(rnd, 20) for _ in range(4)]
    base = texts[3] if len(texts[3]) > 500 else words(rnd, 120)
    for k in range(6):
        w = base.split()
        for _ in range(k):
            w[rnd.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [None, "", "  \n\t ", "12 34 !!", "é" * 900, "x" * 1500, "x" * 700, "Äé " * 300, words(rnd, 6000), texts[0], texts[0]]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "n", 0.5) for i, t in enumerate(corpus())]
    rows.append((None, rows[10][1], None, None, None, None, None))
    rows.append(rows[5])      # a repeated row
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


def got(df, key="doc_id"):
    out = collections.defaultdict(set)
    for r in df.collect():
        d = r.asDict()
        k = d.pop(key)
        out[k].add(tuple(tuple(v) if isinstance(v, list) else v for v in d.values()))
    return out


# --- suffix-array dedup

def brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        cover = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        out.append((len(r), sum(cover), len(re.findall(b"\1+", bytes(cover))), bytes(b for b, c in zip(r, cover) if not c)))
    return out


@pytest.mark.parametrize("length,reach,max_class", [(400, 256, 50_000), (60, 24, 50_000), (60, 24, 3)])
def test_suffix_dedup_equals_brute_force(docs, length, reach, max_class):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = collections.defaultdict(set)
    for (i, _), w in zip(rows, brute_removed([t for _, t in rows], length)):
        want[i].add(w)
    out = suffix_dedup.remove_repeats(docs, length=length, reach=reach, max_class=max_class, bucket_rows=50)
    have = collections.defaultdict(set)
    for r in out.collect():
        have[r.doc_id].add((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)))
    assert have == want


@pytest.mark.parametrize("length,shorter,reach,max_class", [(400, 256, 160, 50_000), (400, 256, 160, 3), (60, 44, 24, 50_000), (60, 44, 24, 3)])
def test_suffix_dedup_of_two_lengths_equals_brute_force_of_each(docs, length, shorter, reach, max_class):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [t for _, t in rows]
    want = collections.defaultdict(set)
    for (i, _), w, x in zip(rows, brute_removed(texts, length), brute_removed(texts, shorter)):
        want[i].add(w + x[1:3])
    out = suffix_dedup.remove_repeats(docs, length=length, shorter=shorter, reach=reach, max_class=max_class, bucket_rows=50)
    have = collections.defaultdict(set)
    for r in out.collect():
        have[r.doc_id].add((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.n_shorter, r.n_shorter_spans))
    assert have == want


@pytest.mark.parametrize("count", [24, 300])     # classes gone through by pairs, and in numpy
def test_two_lengths_on_texts_of_one_word_said_again(spark, count):
    rnd = random.Random(count)
    texts = [words(rnd, rnd.randint(0, 4)) + rnd.choice(["Heti ", "As ", "Onorer. "]) * rnd.randint(1, 60) + words(rnd, rnd.randint(0, 12))
             for _ in range(count)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length=60, shorter=44, reach=24).collect()}
    for i, (w, x) in enumerate(zip(brute_removed(texts, 60), brute_removed(texts, 44))):
        r = out[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.n_shorter, r.n_shorter_spans) == w + x[1:3]


@pytest.mark.parametrize("word_count", [51, 55, 60])
def test_op1_tells_passages_of_over_fifty_words(spark, tmp_path, word_count):
    rnd = random.Random(word_count)
    plain = "the of and a to in is you that it he was for on are as with his they at be this have from or one had by word but".split()

    def prose(n):
        return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 2))) + rnd.choice(plain) for _ in range(n))

    passage = prose(word_count)
    assert 256 <= len(passage.encode())
    texts = [f"{prose(80)} {passage} {prose(60)}" if i < 6 else prose(90) for i in range(12)] + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in catalog.op1_suffix_dedup(spark, str(tmp_path)).collect()}
    removed, passages = brute_removed(texts, 400), brute_removed(texts, 256)
    for i in range(len(texts)):
        r = out[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == removed[i][:3]
        assert r.kept_sha256 == hashlib.sha256(removed[i][3]).hexdigest()
        assert (r.n_passage_bytes, r.n_passages) == passages[i][1:3] and (r.n_passages > 0) == (i < 6)


def test_class_windows_numpy_path_equals_pairs():
    rnd = random.Random(2)
    base = bytes(rnd.choices(b"ab", k=60))
    entries = []
    for _ in range(80):
        left, right = bytearray(base[:30]), bytearray(base[30:])
        for part in (left, right):
            if rnd.random() < .7:
                part[rnd.randrange(len(part))] = 99
        entries.append((bytes(right)[:rnd.choice([24, 30])] + b"\xff" + bytes(left)[::-1], ))
    keys = sorted(k for k, in entries)
    rights = [k.index(b"\xff") for k in keys]
    shared = [0] + [suffix_dedup.common(a, b) for a, b in itertools.pairwise(keys)]
    args = (keys, rights, shared, [0] * len(keys), [30] * len(keys), 40)
    assert suffix_dedup.class_windows(*args, pairwise=1000) == suffix_dedup.class_windows(*args, pairwise=0)


def test_merge_runs_sorts_and_knows_common_prefixes():
    rnd = random.Random(3)
    keys = [bytes(rnd.choices(b"ab", k=rnd.randint(0, 12))) for _ in range(300)]
    for count in (1, 2, 3, 7):
        runs = [sorted(keys[i::count]) for i in range(count)]
        merged = list(suffix_dedup.merge_runs([suffix_dedup.front_code(r) for r in runs]))
        assert [m[2] for m in merged] == sorted(keys)
        assert all(runs[r][i] == k for r, i, k, _ in merged)
        assert [m[3] for m in merged][1:] == [suffix_dedup.common(a[2], b[2]) for a, b in itertools.pairwise(merged)]


@pytest.mark.parametrize("word_count", [51, 52, 60])
def test_pipeline_stage_removes_passages_of_over_fifty_words(spark, word_count):
    import corpus_pipeline as P
    rnd = random.Random(word_count)
    plain = "the of and a to in is you that it he was for on are as with his they at be this have from or one had by word but".split()

    def prose(n):
        return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 2))) + rnd.choice(plain) for _ in range(n))

    passage = prose(word_count)
    rows = [(i, f"{prose(80)} {passage} {prose(60)}" if i < 6 else prose(90), "en", "s", 1, "n", .5) for i in range(12)]
    out = {r.doc_id: r.text for r in P.repeats(spark, spark.createDataFrame(rows, DOC), "").collect()}
    assert len(passage.encode()) >= 256
    for i, text, *_ in rows:
        assert out[i] == (text.replace(passage, "") if i < 6 else text) or i < 6 and passage[8:-8] not in out[i]


def test_strip_repeats_with_clashing_columns(spark):
    rnd = random.Random(1)
    same = words(rnd, 200)
    rows = [(i, same if i < 2 else words(rnd, 50), True, i, i, i, "x") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, n_bytes long, n_removed long, n_spans long, __text string")
    out = suffix_dedup.strip_repeats(df, chars_col=None)
    assert out.schema == df.schema
    assert sorted((r.doc_id, r.text, r.n_spans) for r in out.collect()) == [(i, "" if i < 2 else t, i) for i, t, *_ in rows]


def test_strip_repeats_keeps_columns(docs, no_docs):
    out = suffix_dedup.strip_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert suffix_dedup.strip_repeats(no_docs).collect() == []
    assert all((r.text is None) == (r.n_chars in (None, 0) and r.text is None) for r in out.collect())


# --- near duplicates

def brute_near(rows, percent=75):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            up[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    out = collections.defaultdict(set)
    for i, (d, _) in enumerate(rows):
        c = min((x for x in groups[find(i)] if x is not None), default=None)
        out[d].add((len(sets[i]), c, d == c))
    return out


def test_near_duplicates_equal_brute_force(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for rounds in (0, 2):     # without pivots the prefix filter does everything
        assert got(near_dup.near_duplicates(docs, pivot_rounds=rounds)) == brute_near(rows)
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, v in brute_near(rows).items() if any(x[2] for x in v)}
    assert near_dup.near_duplicates(no_docs).collect() == []


def test_rows_without_an_id_or_of_one_id_are_judged_by_their_text(spark):
    rnd = random.Random(12)
    a, b, c, d = (words(rnd, 60) for _ in range(4))
    rows = [(1, a), (None, a + " more"), (None, b), (None, b + " more"), (None, c), (5, d), (5, c + " more"), (6, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.text for r in near_dup.drop_near_duplicates(docs).collect()))
    assert len(kept) == 4 and a in kept and d in kept and c + " more" in kept and len({b, b + " more"} & set(kept)) == 1
    bench = spark.createDataFrame([(1, c)], "item_id long, text string")
    rest = sorted((r.text for r in decontam.drop_leaks(docs, bench).collect()))
    assert rest == sorted(t for _, t in rows if not t.startswith(c))


def test_repeated_rows_and_copies_without_an_id_keep_one_whole_document(spark):
    rnd = random.Random(21)
    a, b, c = (words(rnd, 150) for _ in range(3))
    rows = [(1, a, "z"), (1, a, "y"), (1, a, "y"), (None, b, "x"), (None, b, "x"), (None, b, None), (2, c, "x"),
            (3, c, "x"), (3, c, "x"), (None, c, "x"), (4, "", "x"), (4, "", "x"), (None, None, "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = near_dup.drop_near_duplicates(docs)
    want = [(1, a, "y"), (None, b, None), (2, c, "x")] + rows[10:]
    assert collections.Counter(map(tuple, kept.collect())) == collections.Counter(want)
    left = suffix_dedup.strip_repeats(kept)
    assert collections.Counter(map(tuple, left.collect())) == collections.Counter(want)


def test_links_survive_a_round_whose_pivot_fits_nobody(spark):
    base = [f"w{i}" for i in range(120)]
    small = " ".join(base), " ".join(base[:-6] + [f"x{i}" for i in range(6)])
    # a text of another size that all buckets choose as pivot: the one of the greatest node
    node = lambda t: xxhash.xxh128_digest(near_dup.shingle_sets([t], near_dup.word_hashes())[0].tobytes())
    large = next(t for t in (" ".join(base + [f"y{k}_{i}" for i in range(300)]) for k in range(1000))
                 if node(t) > max(map(node, small)))
    docs = spark.createDataFrame([(1, small[0]), (2, small[1]), (3, large)], "doc_id long, text string")
    sketch = near_dup._sketches(docs, "doc_id", "text", 5, 128, 4).withColumn("bands", F.array(F.lit(7).cast("long")))
    comps = near_dup._components(docs, sketch, "doc_id", "text", 5, 75, 2).collect()
    assert {bytes(r.node) for r in comps} == set(map(node, small)) and len({bytes(r.comp) for r in comps}) == 1


def test_template_documents_below_the_threshold_meet_nobody(spark):
    # 100 common and 20 own shingles: similarity 0.71; the common ones stand behind the own
    rows = [(bytes([i]), 120, bytes([i]), 21 + j, 1000 + j) for i in range(40) for j in range(11)]
    head = spark.createDataFrame(rows, "node binary, n int, comp binary, at int, s long")
    short, long = near_dup._by_length(head, 75)
    assert short.count() == 0 and long.count() == len(rows)


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_length_classes_lose_no_pair(spark, percent):
    rows = [(n, at) for n in range(1, 60) for at in range(1, n + 1)]
    head = spark.createDataFrame([(f"{n}/{at}".encode(), n, b"", at, 1) for n, at in rows], "node binary, n int, comp binary, at int, s long")
    short, long = near_dup._by_length(head, percent)
    met = {(r.n_a, r.at_a, r.n_b, r.at_b) for r in short.join(long, ["s", "size"]).select("n_a", "at_a", "n_b", "at_b").collect()}
    for na, pa in rows:
        for nb, pb in rows:
            t = -(-percent * (na + nb) // (100 + percent))
            if na <= nb and 100 * na >= percent * nb and pa <= na - t + 1 and pb <= nb - t + 1:
                assert (na, pa, nb, pb) in met


def test_signatures_follow_similarity():
    import numpy as np
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], rnd.integers(0, 1 << 63, 100, dtype=np.uint64)])
    sig = near_dup.super_minhash([np.unique(a), np.unique(b), np.unique(a), a[:1], a[:0]])
    assert (sig[0] == sig[2]).all() and abs((sig[0] == sig[1]).mean() - .6) < .15
    assert (sig[3] != np.iinfo(np.uint64).max).all() and (sig[4] == np.iinfo(np.uint64).max).all()


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7), (None, 1)]
    have = {r.node: r.comp for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}

    def find(x):
        up.setdefault(x, x)
        return x if up[x] == x else find(up[x])
    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    assert have == {x: find(x) for x in list(up)}


# --- decontamination

def test_leaks_finds_exact_shouted_and_exchanged_questions(spark, docs, no_docs):
    item = ("Last week Alice bought 12 red apples and 5 kg of flour at the market before Bob paid 30 dollars for "
            "the whole basket and went home by train.")
    twisted = item.replace("Alice", "Maria").replace("Bob", "Peter").replace("12", "17").replace("5 kg", "9 lb").replace("30", "44")
    broken = twisted.replace("Peter paid 44", "Maria paid 9")
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "too few", "x")], "item_id long, text string, doc_id string")
    rnd = random.Random(8)
    rows = [(1, words(rnd, 50) + ". " + item + " " + words(rnd, 30)), (2, words(rnd, 9) + ".\n" + twisted), (3, item.lower()),
            (4, words(rnd, 400)), (5, None), (6, ""), (7, twisted), (7, twisted), (None, item), (8, "too few"), (9, broken)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in decontam.leaks(df, bench).collect()}
    assert set(out) - {9} == {1, 2, 3, 7, None} and all(r.item_id == 1 for r in out.values())
    assert out[2].exchanged and not out[1].exchanged
    assert out[2].coverage == 1.0 and (9 not in out or out[9].coverage < 1.0)
    assert {r.doc_id for r in decontam.drop_leaks(df, bench).collect()} >= {4, 5, 6, 8}
    small = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench, block_windows=1).collect()}
    assert small == {(d, 1) for d in out}
    assert decontam.leaks(no_docs, bench).collect() == []
    assert decontam.leaks(df, bench.limit(0)).collect() == []
    assert decontam.leaks(docs, bench).collect() == []


def test_leaks_finds_verbatim_copies_of_short_and_wordless_items(spark):
    items = {1: "What is 12 + 34 + 56 + 78 + 90?", 2: "Who discovered polonium?", 3: "日本で一番高い山は何ですか。",
             4: "What is the capital of France?"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = [(k, "Some text before it. " + t + " And after.") for k, t in items.items()]
    rows += [(14, "Question 5\nWhat is the capital of France?"), (13, "これは試験です。" + items[3] + "富士山です。"),
             (21, "What is 12 + 34 - 56 + 78 + 90?"), (22, "Who discovered it? polonium"), (23, "日本の山"), (24, "\n 12 34")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.leaks(df, bench).collect()}
    assert set(found) == {(k, k) for k in items} | {(14, 4), (13, 3)}
    assert all(r.coverage == 1.0 and not r.exchanged for r in found.values())
    assert {r.doc_id for r in decontam.drop_leaks(df, bench).collect()} == {21, 22, 23, 24}


def test_leaks_finds_exchanged_names_that_open_sentences(spark):
    item = "Alice has 12 apples. Bob has 5 pears. Alice gives Bob 3 apples. How many apples does Alice have now?"
    twisted = "Maria has 40 apples. Peter has 8 pears. Maria gives Peter 6 apples. How many apples does Maria have now?"
    wrapped = twisted.replace("does Maria", "does\nMaria").replace(". ", ".\n")
    mixed = twisted.replace("Maria gives Peter", "Peter gives Peter").replace("does Maria", "does Jane")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, "He reads a task. " + twisted + " The end of it."), (2, wrapped), (3, mixed), (4, item),
            (5, "Maria likes apples. Peter likes pears. How many people like them is not known to Maria.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in decontam.leaks(df, bench).collect()}
    assert {1, 2, 4} <= set(found) <= {1, 2, 3, 4}
    assert found[1].coverage > .5 and found[1].exchanged == found[2].exchanged == 8 and not found[4].exchanged
    assert 3 not in found or found[3].coverage < found[1].coverage


def test_consistent_drops_windows_of_contradicting_slots():
    pairs = [(0, 2, "alice", "maria"), (5, 2, "bob", "maria"), (20, 1, "3", "4")]
    assert decontam.consistent(pairs, [0, 2, 6, 20], 4) == [0, 6, 20]
    assert decontam.consistent(pairs[:1] + pairs[2:], [0, 2], 4) == [0, 2]


# --- language identification

def test_language_held_out_accuracy_and_edges(spark, docs, no_docs):
    rnd = random.Random(1)
    lex = {"en": "the and of ing tion with house".split(), "de": "der und sch keit über nicht haus".split(), "fr": "le et eau ment où très maison".split()}
    rows = [(i, " ".join("".join(rnd.choices(lex[g], k=rnd.randint(1, 2))) for _ in range(30)), g)
            for i, g in enumerate(rnd.choices(list(lex), k=300))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(df.drop("lang"), df.filter(~langid.held_out()), carry=["doc_id", "text"])
    hit = {r.doc_id: r.lang_pred for r in out.filter(langid.held_out()).collect()}
    assert sum(hit[i] == g for i, _, g in rows if i in hit) / len(hit) > .97
    odd = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(
        spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "DER UND " * 9000)], "doc_id long, text string"), df).collect()}
    assert odd[1] == odd[2] == odd[3] == ("und", 0.0) and odd[4][0] == "de" and 0 < odd[4][1] <= 1
    assert {r.lang_pred for r in langid.identify(docs, df.limit(0)).collect()} == {"und"}
    assert langid.identify(no_docs, df).collect() == []
    assert langid.drop_unknown(docs).columns == docs.columns


def test_language_of_few_texts_is_learned(spark):
    rnd = random.Random(8)
    de = [" ".join(rnd.choices("und der die das nicht wir haben".split(), k=30)) for _ in range(400)]
    xx = [" ".join(rnd.choices("qui tlax nahu coatl mictl".split(), k=40)) for _ in range(3)]
    rows = [(i, t, "de") for i, t in enumerate(de)] + [(1000 + i, xx[i % 3], "xx") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.lang_pred for r in langid.identify(df, df).filter("doc_id >= 1000").collect()}
    assert got == {"xx"}


def test_training_sample_is_bounded_over_all_languages(spark):
    df = spark.createDataFrame([(f"t{i} word", f"l{i % 30}") for i in range(3000)], "text string, lang string")
    rows = langid.training_rows(df, "lang", "text", 50, 1000, most_rows=90)
    assert len(rows) <= 90 and {r.lang for r in rows} == {f"l{i}" for i in range(30)}


def test_ppm_lengths_are_a_code():
    model = langid.train([("a", "abracadabra abracadabra"), ("b", "zzyzx zzyzx")], min_count=1)
    import numpy as np
    prob = np.exp2(-model["bits"].reshape(-1, model["size"], 2).astype(float))
    weight = np.ones(model["size"])
    weight[0] = 256 - (model["size"] - 1)
    assert np.allclose((prob * weight[None, :, None]).sum(axis=1), 1, atol=1e-4)
    one, two = langid.code_lengths(model, ["abra", "cadabra"]), langid.code_lengths(model, ["cadabra", "abra"], block=3)
    assert np.allclose(one, two[::-1], rtol=1e-5)


# --- quality, licences

def brute_quality(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {i + j for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), n < 10 or 100 * len(cover) > 20 * n


def test_quality_base_equals_brute_force(docs, no_docs):
    out = quality.assess(docs).collect()
    texts = collections.defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(brute_quality(r.text))
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in texts[r.doc_id]
        assert not (r.base_failed and r.kept)
    assert len(out) == docs.count()
    assert quality.assess(no_docs).collect() == []


def test_quality_divergence_tells_junk(spark):
    rnd = random.Random(6)
    rows = [(i, words(rnd, 200).capitalize() + ".", "en") for i in range(60)]
    rows += [(100, " ".join(w + "***#" for w in words(rnd, 200).split()), "en"), (101, "a\tb\n a\tb\n" * 3 + "x y z", None)]
    out = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(out[i].kept for i in range(60)) and not out[100].kept and out[100].js_chars > .3
    assert out[101].js_chars is None


def test_license_base_equals_brute_force_and_templates(spark, no_docs):
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, "the MIT license, MIT License; cc-by. Apache\nLICENSE"), (3, None), (4, ""),
            (5, "GNU General Public License, version 3. cc by cc by"), (6, "permit licence é mit élicense"),
            (7, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction"),
            (8, "Permission is hereby granted, free of charge, to any human obtaining a copy of this software and associated "
                "documentation files to deal in the Software without restriction"), (9, "w " * 50000 + "mit license"), (9, "x")]
    out = collections.defaultdict(list)
    for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        out[r.doc_id].append(r)
    for i, t in rows[:9]:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        at, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            hits = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            at += hits
            labels |= {label} if hits else set()
        want = (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert want in [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out[i]]
    assert out[1][0].labels == "cc-by,cc-by-nc-4.0" and out[7][0].labels == "mit-partial" and out[8][0].labels == ""
    assert (out[1][0].score, out[7][0].score) == (0.75, 0.25)
    assert out[5][0].labels == "cc-by,gpl,gpl-3.0" and out[3][0].score == 0
    assert license_scan.scan_licenses(no_docs).collect() == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%sTHIS SOFTWARE IS PROVIDED BY %s "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = """3. Neither the name of Example Corp. nor the names of its contributors may be used to
   endorse or promote products derived from this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""


def test_whole_licences_match_to_their_end():
    scan = license_scan.Scanner(license_scan.KINDS, license_scan.BASE).scan
    bsd2, bsd3 = BSD % ("", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS"), BSD % (THIRD, "EXAMPLE CORP. AND OTHERS")
    for text, label in ((MIT, "mit"), (ISC, "isc"), (bsd2, "bsd-2-clause"), (bsd3, "bsd-3-clause")):
        for t in (text, "Copyright (c) 2020 A\n\n" + text, "// " + text.replace("\n", "\n// ")):
            assert scan(t)[5:7] == (label, 1.0)
    assert scan(GPL)[5:7] == ("gpl,gpl-3.0", 1.0) and scan(APACHE)[5:7] == ("apache,apache-2.0", 1.0)


def test_changed_or_cut_licences_are_partial():
    scan = license_scan.Scanner(license_scan.KINDS, license_scan.BASE).scan
    opening = MIT[:MIT.index(", including")]
    bsd = BSD % ("", "US")
    changed = [(opening + ", except for any commercial purpose, which is forbidden", "mit-partial"),
               (bsd[:bsd.index("1.")] + "you pay us", "bsd-partial"), (MIT.replace("merge, ", ""), "mit-partial"),
               (MIT.replace("without restriction,", "without restriction, except for war,"), "mit-partial"),
               (MIT[:-20], "mit-partial"), (ISC.replace("OR PROFITS", ""), "isc-partial"),
               (bsd.replace("DISCLAIMED", "GIVEN"), "bsd-partial")]
    for text, label in changed:
        assert scan(text)[5:7] == (label, 0.25)
    assert scan(GPL.replace("WITHOUT ANY WARRANTY", "WITH A WARRANTY"))[5:7] == ("gpl,gpl-3.0", 0.75)
    assert scan("released under the MIT license")[5:7] == ("mit", 0.75)


def test_automaton_regions():
    a = license_scan.Automaton("a <<opt>>b <<any>>c<<or>>d e<</any>><</opt>> f <<var:2>> g")
    ok = ["a f g", "a b c f g", "a b d e f x g", "a f x y g"]
    no = ["a b f g", "a b d f g", "a f x y z g", "a c f g"]
    assert all(a.match(license_scan.words_of(t), 0) == len(t.split()) for t in ok)
    assert all(a.match(license_scan.words_of(t), 0) is None for t in no)
    with pytest.raises(ValueError):
        license_scan.Automaton("<<opt>>a<</opt>> b")


# --- chat

def test_chat_fold_applies_events(spark):
    ev = [(1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", "Hel"), (1, 3, "delta", 2, None, "lo"),
          (1, 4, "delta", 2, None, " you"), (1, 5, "message", 3, "user", "bye"), (1, 6, "regenerate", 2, "assistant", "New"),
          (1, 7, "delta", 2, None, "er"), (1, 8, "message", 3, "user", "ok"), (1, 9, "edit", 1, None, "hey"),
          (None, 1, "message", 1, None, None), (2, 1, "delta", 1, "user", "only"), (2, 2, "unknown", 1, "user", "x"), (2, 3, "edit", None, "user", "x")]
    df = spark.createDataFrame(ev, "conv long, seq long, kind string, target long, role string, text string")
    out = {(r.conv, r.target): (r.role, r.text) for r in chat.fold(df).collect()}
    assert out == {(1, 1): ("user", "hey"), (1, 2): ("assistant", "Newer"), (1, 3): ("user", "ok"), (None, 1): ("", ""), (2, 1): ("user", "only")}
    gone = {(r.conv, r.target) for r in chat.fold(df.filter("seq < 8")).collect()}
    assert (1, 3) not in gone and (1, 2) in gone


def test_chat_round_trip_and_digest(spark):
    texts = ["", None, "plain", r"\### Assistant: </turn> ok", "### user: x</turn>\n### assistant: y", "a\nb\r\n\\", "é😀" * 500, "<<##\\\\"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(itertools.product(["user", "assistant", "so: #<r", None], texts))]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    rendered = chat.render(chat.fold(chat.message_events(df)))
    for r in rendered.limit(40).collect():
        assert chat.parse(r.segment)
    want = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda z: (z[1], z[2] or "", z[3] or "")):
        want[c].append((r or "", x or ""))
    for r in chat.digest(rendered).collect():
        turns = want[r.conv_id]
        loss = "".join(x for role, x in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(chat.render(chat.fold(chat.message_events(df.limit(0))))).collect() == []


# --- archives

def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "long " * 60000
    rows = [(5, "http://a/x", "<p>one"), (3, "http://a/y\r\nX: 1", "<p>one"), (9, None, None), (8, "u", ""), (1, "u", big), (2, "u", big),
            (None, "u", "<p>one"), (4, "é", "é"), (4, "é", "é")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for least in (0, 100):
        out = warc.archive(df, str(tmp_path / f"w{least}"), min_payload=least, frame_bytes=500, bundle_bytes=2000).collect()
        assert len(out) == len(rows)
        for r in out:
            html = [(h or "").encode() for p, _, h in rows if p == r.page_id][0]
            first = min(p for p, _, h in rows if (h or "").encode() == html and p is not None)
            revisit = len(html) >= least and r.page_id != first
            assert r.payload_bytes == len(html)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(html).digest()).decode()
            assert (r.record_type, r.refers_to) == (("revisit", str(first)) if revisit else ("response", None))
            assert bytes(r.payload) == (b"" if revisit else html)
    assert warc.archive(df.limit(0), str(tmp_path / "none")).collect() == []


# --- extraction

def test_html_main_text():
    f = html_extract.main_text
    page = ("<html><head><title>T</title><script>var a='</p><article>x';</script></head><body><header>Site</header><nav><a href=/>Home</a></nav>"
            "<div class='cookie-notice'>We use</div><article><header><h1>Big &amp; title</h1><span>by me</span></header>"
            "<p><b>One</b>two&nbsp; three<br>four<p>five <!-- c --><div class=ad>buy</div><form>f<input></form>"
            "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><section id=comments><p>nice post</section></article>"
            "<aside>side</aside><footer>&copy; x</footer>")
    assert f(page) == "Big & title Onetwo three four five a b c d"
    assert f("") == "" and f("plain text") == "plain text"
    assert f("<body><div><p>Long enough words here</p><ul><li><a>x</a><li><a>y</a></ul></div>") == "Long enough words here"
    assert f("<p>" * 3000 + "deep" + "<div>" * 3000 + "er") == "deep er"
    assert f("<p a='unclosed <b>x") in ("", "<p a='unclosed x", "<p a='unclosed  x")


def test_html_classes_of_wrappers_and_deep_nests_keep_the_article():
    f = html_extract.main_text
    article = "<article><h1>Title</h1><p>Body text<section id=comments><article class=comment>first</article></section></article>"
    for page in ("<body class='single-post has-sidebar'>%s</body>", "<body><div id='page' class='no-comments'>%s</div>",
                 "<main class='with-sidebar'>%s</main>", "<div class='no-ads'><div class='no-comments'>%s</div></div>"):
        assert f(page % article) == "Title Body text"
    page = "<article>a</article><section id=comments><article>c</article></section><div class=ad><article>d</article></div>"
    assert f(page) == "a" and f("<nav><article>x</article></nav>") == ""
    nest = "<div>" * 200 + "deep" + "</div>" * 200
    assert f(f"<body><div><article>one{nest}<p>two</p></article></div><p>out</body>") == "one deep two"
    assert f("<article>a" + "<div>" * 200 + "b</article>c") == "a b"


def test_html_wrapper_drops_constant_nodes(spark):
    rnd = random.Random(9)
    rows = [(i, "http://Host.example/p%d" % i, f"<body><div class=brand>Same everywhere</div><div class=top>{words(rnd, 3)}</div>"
             f"<div class=body><p>{words(rnd, 9)}<p>{words(rnd, 5)}</div><div class=end>All rights</div></body>") for i in range(12)]
    rows += [(50, None, "<p>alone"), (51, "http://few.example/", "<div>kept</div>"), (52, "http://few.example/", None)]
    rows += [(60 + i, "http://copies.example/", "<div class=a>all</div><p>alike</p>") for i in range(9)]
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(12):
        assert "Same" not in out[i] and "rights" not in out[i]
        assert out[i].split() == re.sub(r"<[^>]*>", " ", rows[i][2].replace("Same everywhere", "").replace("All rights", "")).split()
    assert out[50] == "alone" and out[51] == "kept" and out[52] == "" and out[60] == "all alike"


@pytest.mark.parametrize("odd", [[None], ["<p>Not found</p>"], ["", "  ", "<body></body>"]])
def test_html_one_odd_page_does_not_switch_a_template_off(spark, odd):
    rnd = random.Random(4)
    pages = [f"<body><div class=x>Same banner</div><div class=body><p>{words(rnd, 9)}</div></body>" for _ in range(50)] + odd
    rows = [(i, f"http://h.example/{i}", h) for i, h in enumerate(pages)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert len(out) == len(pages) and not [r for r in out if "banner" in r.text]
    assert all(r.text for r in out if r.page_id < 50)


@pytest.mark.parametrize("last_first", [False, True])
def test_html_many_nodes_and_any_row_order(spark, last_first):
    rnd = random.Random(5)
    rows = []
    for i in range(24):
        own = "".join(f"<div class=o{i}x{j}>{words(rnd, 2)}</div>" for j in range(300))
        rows.append((i, "http://big.example/", f"<body><div class=body><p>{words(rnd, 9)}</div>{own}" + ("<div class=foot>All of us</div>" if i < 20 else "")))
    df = spark.createDataFrame(rows[::-1] if last_first else rows, "page_id long, url string, html string").coalesce(1)
    out = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert not [i for i in out if "All of us" in out[i]]
    assert all(out[i] == " ".join(re.sub(r"<[^>]*>", " ", h.split("<div class=foot>")[0]).split()) for i, _, h in rows)


def test_html_templates_equal_counting_by_hand(spark):
    rnd = random.Random(6)
    rows, want = [], {}
    for host in range(6):
        n = rnd.choice([3, 8, 20])
        fixed = [f"part{k}" for k in range(4)]
        on = {k: rnd.choice([1.0, 0.8, 0.3]) for k in fixed}
        pages = [[k for k in fixed if rnd.random() < on[k]] for _ in range(n)]
        for i, own in enumerate(pages):
            body = words(rnd, 8)
            rows.append((len(rows), f"http://h{host}.example/{i}", "<body><main class=z><p>" + body + "</p>"
                         + "".join(f"<section class={k}>fixed {k}</section>" for k in own) + "</main></body>"))
            kept = [k for k in own if n < 5 or 2 * sum(k in p for p in pages) <= n]
            want[len(rows) - 1] = " ".join([body] + [f"fixed {k}" for k in kept])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "n_chars": F.lit(1), "fixed": F.lit(2)})
    assert {r.page_id: r.text for r in html_extract.extract(df.repartition(3)).collect()} == want
    assert html_extract.extract(df.filter("false")).collect() == []


# --- packing

def test_packing_covers_every_id_once(spark, docs, no_docs):
    tokenizer = catalog.packing_tokenizer()
    encode = packing.encoder(*tokenizer)
    out = packing.pack_documents(docs, *tokenizer, capacity=64, buffer_tokens=500).collect()
    parts, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        parts[r.doc_id].append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    for r in docs.collect():
        ids = encode(r.text or "").tobytes() + b"\0\0\0\0"
        mine = sorted(parts[r.doc_id])
        if r.doc_id != 5:       # that row is there twice, and may be cut in two ways
            assert b"".join(p[2] for p in mine) == ids and all(p[3] == len(ids) // 4 for p in mine)
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(p[1] for v in parts.values() for p in v)
    assert len(seqs) * 64 - total < 64 * (3 + total // 400)
    assert packing.pack_documents(no_docs, *tokenizer).collect() == []


def test_packing_ids_equal_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.encoder(*catalog.packing_tokenizer())
    assert fast("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    rnd = random.Random(3)
    odd = ["<|endoftext|>", "<|endoftext|><|endoftext|>", "x<|endoftext|>\n\n y", "<|endoftext|", " <|endoftext|> ", "<|<|endoftext|>|>", "", " ", "a  b\n\n c", "don't I'll", "12,345.6", "<|endoftext|> x", "é😀   ñ", "\t\r\n", "x" * 3000, "​ "]
    odd += ["".join(chr(rnd.choice([32, 10, 65, 97, 48, 233, 0x4E2D, 0x1F600, 39])) for _ in range(80)) for _ in range(200)]
    for t in odd + [x for x in corpus() if x]:
        assert fast(t).tolist() == plain.encode(t, add_special_tokens=False).ids


def test_balance_prefers_cheap_sequences():
    n, placed = packing.balance([10, 6, 6, 4, 4, 2], 16, 1.0, .01)
    assert n == 2
    room = collections.Counter()
    for _, _, length, at, offset in placed:
        assert offset == room[at]
        room[at] += length
    assert room == {0: 16, 1: 16}


# --- registered queries

def test_catalog_registers_thirteen_operators():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in catalog.QUERIES) == list(range(1, 14))


def test_pipeline_stages_hand_on_documents(spark, tmp_path):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    docs, left = source, source.count()
    for name, f in P.STAGES[:-1]:
        f(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == source.columns and docs.count() <= left
        left = docs.count()
    packed = P.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == left
