"""Exact removal of repeated byte strings by a common-prefix-aware distributed merge
sort of sampled suffixes.

Anchors. Each window of ``length`` bytes has one anchor: among its first ``reach``
positions the one whose 16-byte hash is least (leftmost on ties). Equal windows have
their anchor at the same offset, so only suffixes that start at an anchor, about two in
``reach``, have to be compared. A window with offset d is the d bytes left of its
anchor and the ``length - d`` bytes right of it, and the latter hold at least the
``length - reach + 1`` bytes that define the anchor's class; a class of one cannot
repeat and leaves early, by a count of hashes.

Sort. A task sorts the suffixes of its documents (right context, then the left
context backwards) into one run for each bucket of classes and front-codes them: a
suffix ships only what differs from the one before it. A bucket's runs are merged by a
loser tree whose nodes keep the common prefix with the last suffix put out: unequal
prefixes decide without looking at the text, equal ones are compared from there on.
The merged order yields the common prefix of neighbours, and so each class and the right
match of any two members (the least value between them).

Windows. A pair of anchors with left match l and right match r repeats a window iff
l + r >= length. For every member the extreme offsets of repeated windows are found
exactly: pair by pair in small classes, else by going through the distinct right
matches and taking neighbours in the order of left contexts. All windows of an anchor
hold the anchor, so the bytes they cover are one interval.

A class of over ``max_class`` members is not sent to one task: all its windows are
hashed (128 bits) and counted by Spark instead, with the same result.

Two lengths. The anchor of a window is told by its first ``reach`` positions alone, so the
anchors of a shorter length are those of every longer one too: one sort, with the right
contexts of the longer length, serves both, and each class is gone through once a length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import mix64, release, row_key, slices, stage
from lanecost.operators.key_filter import KeyFilter

_LOW = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_END = b"\xff"      # no byte of UTF-8 text: ends a right context


def _least(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (length n - w + 1)."""
    n = len(v)
    rows = -(-n // w)
    a = np.full(rows * w, np.iinfo(v.dtype).max, dtype=v.dtype)
    a[:n] = v
    a = a.reshape(rows, w)
    ahead = np.minimum.accumulate(a, axis=1).reshape(-1)
    back = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchors(raw: list[bytes], length: int, reach: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor, least offset, greatest offset, class hash) arrays of all
    windows' anchors in each text."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    long = [i for i, r in enumerate(raw) if len(r) >= length]
    if not long:
        return none
    data = b"".join(raw[i] for i in long) + b"\0" * 16
    n = len(data) - 16
    sizes = np.array([len(raw[i]) for i in long], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    lo, hi = (np.ndarray((n,), "<u8", data, offset=o, strides=(1,)) for o in (0, 8))
    h = mix64((lo * np.uint64(0x9E3779B97F4A7C15)) ^ mix64(hi))
    v = (h & _HIGH) | np.arange(n, dtype=np.uint64)
    least = _least(v, reach)
    starts = np.concatenate([np.arange(a, a + s - length + 1) for a, s in zip(first, sizes)])
    at = (least[starts] & _LOW).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    p = at[cut]
    last = np.r_[cut[1:], len(at)] - 1
    most, fewest = p - starts[cut], p - starts[last]
    owner = np.searchsorted(first, p, side="right") - 1
    need = length - reach + 1
    digest = xxhash.xxh64_intdigest
    cls = np.fromiter((digest(data[x:x + need]) for x in p.tolist()), dtype=np.uint64, count=len(p)).view(np.int64)
    return np.array(long)[owner], p - first[owner], fewest, most, cls


def common(a: bytes, b: bytes, h: int = 0) -> int:
    """Length of the common prefix, known to be at least h."""
    n = min(len(a), len(b))
    while h < n:
        x, y = a[h:min(n, h + 48)], b[h:min(n, h + 48)]
        if x != y:
            d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return h + len(x) - (d.bit_length() + 7) // 8
        h += len(x)
    return n


def front_code(keys: list[bytes]) -> tuple[list[int], bytes, list[int]]:
    """Sorted keys as (common prefix with the one before, all remainders, their lengths)."""
    shared, rest, prev = [], [], b""
    for k in keys:
        c = common(prev, k)
        shared.append(c)
        rest.append(k[c:])
        prev = k
    return shared, b"".join(rest), [len(r) for r in rest]


def merge_runs(runs: list[tuple[list[int], bytes, list[int]]]):
    """Merge front-coded runs: yields (run, position, key, common prefix with the key
    before). A loser tree; ties go to the run of the lower number."""
    count = len(runs)
    size = 1
    while size < count:
        size *= 2
    key: list[bytes | None] = [None] * size     # None: the run is over
    lcp = [0] * size                            # with the key put out last
    pos = [-1] * size
    off = [0] * size

    def advance(r: int) -> None:
        shared, rest, lens = runs[r]
        i = pos[r] + 1
        pos[r] = i
        if i >= len(lens):
            key[r] = None
            return
        c, o, n = shared[i], off[r], lens[i]
        key[r] = (key[r][:c] if c else b"") + rest[o:o + n]
        lcp[r] = c
        off[r] = o + n

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        ka, kb = key[a], key[b]
        if ka is None:
            return b, a
        if kb is None:
            return a, b
        la, lb = lcp[a], lcp[b]
        if la != lb:
            return (a, b) if la > lb else (b, a)
        c = common(ka, kb, la)
        if c == len(ka) or c == len(kb):
            a_first = len(ka) < len(kb) or len(ka) == len(kb) and a < b
        else:
            a_first = ka[c] < kb[c]
        if a_first:
            lcp[b] = c
            return a, b
        lcp[a] = c
        return b, a

    for r in range(count):
        advance(r)
    loser = [0] * size
    winners = list(range(size))
    for level_start in [size >> k for k in range(1, size.bit_length())]:
        up = []
        for i in range(level_start):
            w, lo = play(winners[2 * i], winners[2 * i + 1])
            loser[level_start + i] = lo
            up.append(w)
        winners = up
    top = winners[0]
    while key[top] is not None:
        yield top, pos[top], key[top], lcp[top]
        advance(top)
        node = (size + top) >> 1
        while node:
            top, loser[node] = play(top, loser[node])
            node >>= 1


def class_windows(keys: list[bytes], rights: list[int], shared: list[int], fewest: list[int], most: list[int],
                  length: int, pairwise: int = 40) -> list[tuple[int, int] | None]:
    """For each member of a class, in merged order, the least and greatest offset of
    its windows that another member repeats, or None. ``rights`` are the lengths of the
    right contexts, which may be longer than the member's windows reach."""
    n = len(keys)
    out: list[tuple[int, int] | None] = [None] * n
    # equal contexts repeat each other entirely; one of them stands for all
    rep = [0]
    for i in range(1, n):
        if shared[i] == len(keys[i]) == len(keys[i - 1]):
            out[i] = (fewest[i], most[i])
            out[rep[-1]] = (fewest[rep[-1]], most[rep[-1]])
        else:
            rep.append(i)
    if len(rep) == 1:
        return out
    lefts = [keys[i][rights[i] + 1:] for i in rep]
    # a window that reaches farther has another anchor
    r_len = [min(rights[i], length - fewest[i]) for i in rep]
    near = [0] * len(rep)
    for x in range(1, len(rep)):
        near[x] = min(shared[rep[x - 1] + 1:rep[x] + 1])
    k = len(rep)
    if k <= pairwise:
        lo, hi = [length] * k, [-1] * k
        for a in range(k):
            run = 1 << 30
            for b in range(a + 1, k):
                run = min(run, near[b])
                r = min(run, r_len[a], r_len[b])
                if r + min(len(lefts[a]), len(lefts[b])) < length:
                    continue
                d = common(lefts[a], lefts[b])
                if r + d >= length:
                    for x in (a, b):
                        lo[x] = min(lo[x], length - r)
                        hi[x] = max(hi[x], d)
    else:
        lo, hi = _by_right_match(lefts, np.array(r_len), np.array(near), length,
                                 any(r < rights[i] for r, i in zip(r_len, rep)))
    for x, i in enumerate(rep):
        if hi[x] >= 0 and out[i] is None:
            out[i] = (max(fewest[i], int(lo[x])), min(most[i], int(hi[x])))
    return out


def _by_right_match(lefts: list[bytes], r_len: np.ndarray, near: np.ndarray, length: int,
                    bounded: bool) -> tuple[np.ndarray, np.ndarray]:
    """``bounded``: contexts go on after ``r_len``, so neighbours may agree beyond it and
    members farther apart match in a bound that no neighbours have in common."""
    k = len(lefts)
    order = sorted(range(k), key=lefts.__getitem__)
    rank = np.empty(k, dtype=np.int64)
    rank[order] = np.arange(k)
    step = np.array([0] + [common(lefts[order[i - 1]], lefts[order[i]]) for i in range(1, k)], dtype=np.int64)
    table = [step]                              # table[j][i] = min(step[i : i + 2**j])
    while 2 << (len(table) - 1) <= k:
        t, h = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(t[:-h], t[h:]))
    lo, hi = np.full(k, length), np.full(k, -1)
    matches = np.r_[near[1:], r_len] if bounded else np.minimum(near[1:], np.minimum(r_len[1:], r_len[:-1]))
    for r in np.unique(matches[matches <= r_len.max()]):
        r = int(r)
        group = np.cumsum(near < r)
        who = np.flatnonzero(r_len >= r)
        who = who[np.lexsort((rank[who], group[who]))]
        if len(who) < 2:
            continue
        a, b = rank[who[:-1]] + 1, rank[who[1:]] + 1
        same = group[who[1:]] == group[who[:-1]]
        j = np.zeros(len(a), dtype=np.int64)
        width = np.where(same, b - a, 1)
        j = np.floor(np.log2(width)).astype(np.int64)
        left = np.full(len(a), -1)
        for level in np.unique(j[same]):
            x = np.flatnonzero(same & (j == level))
            t = table[level]
            left[x] = np.minimum(t[a[x]], t[b[x] - (1 << level)])
        best = np.full(len(who), -1)
        best[1:] = left
        best[:-1] = np.maximum(best[:-1], left)
        good = best + r >= length
        g = who[good]
        lo[g] = np.minimum(lo[g], length - r)
        hi[g] = np.maximum(hi[g], best[good])
    return lo, hi


_KEY = ["__k1", "__k2"]
_SPAN = T.StructType([T.StructField("__k1", T.StringType()), T.StructField("__k2", T.LongType()),
                      T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                      T.StructField("length", T.IntegerType())])


def _anchor_rows(docs: DataFrame, length: int, reach: int) -> DataFrame:
    schema = T.StructType([*_SPAN.fields[:2]] + [T.StructField(c, T.IntegerType()) for c in ("p", "fewest", "most")]
                          + [T.StructField("cls", T.LongType())])

    def run(batches):
        for k1, k2, texts in slices(batches, 2):
            who, p, fewest, most, cls = anchors([(t or "").encode("utf-8", "replace") for t in texts], length, reach)
            if len(who):
                at = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1, pa.string()).take(at), pa.array(k2, pa.int64()).take(at)]
                    + [pa.array(x.astype(np.int32)) for x in (p, fewest, most)] + [pa.array(cls)], names=schema.names)

    return docs.select("__k1", "__k2", "__text").mapInArrow(run, schema)


_RUN = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("k1", T.ArrayType(T.StringType())),
                     T.StructField("k2", T.ArrayType(T.LongType()))]
                    + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("p", "fewest", "most", "shared", "rest_len")]
                    + [T.StructField("rest", T.BinaryType())])


def _runs(rows: DataFrame, length: int, buckets: int, most_bytes: int = 32 << 20) -> DataFrame:
    """Front-coded sorted runs, one row for each bucket and flush of a task."""

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            held.sort(key=lambda e: e[:2])
            cols: list[list] = [[] for _ in _RUN]
            a = 0
            while a < len(held):
                b = a
                while b < len(held) and held[b][0] == held[a][0]:
                    b += 1
                part = held[a:b]
                shared, rest, rest_len = front_code([e[1] for e in part])
                for c, v in zip(cols, [part[0][0], *([e[i] for e in part] for i in range(2, 7)), shared, rest_len, rest]):
                    c.append(v)
                a = b
            held.clear()
            types = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 5 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=_RUN.names)

        for k1s, k2s, texts, lists in slices(batches, 2):
            for k1, k2, text, found in zip(k1s, k2s, texts, lists):
                raw = (text or "").encode("utf-8", "replace")
                for x in found:
                    p, fewest, most = x["p"], x["fewest"], x["most"]
                    key = raw[p:p - fewest + length] + _END + raw[p - most:p][::-1]
                    held.append((x["cls"] % buckets, key, k1, k2, p, fewest, most))
                    size += len(key) + 200
                if size >= most_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return rows.mapInArrow(run, _RUN)


def _merged(runs: DataFrame, lengths: list[int], reach: int) -> DataFrame:
    need = lengths[0] - reach + 1

    def run(table: pa.Table) -> pa.Table:
        c = {n: table.column(n).to_pylist() for n in _RUN.names}
        spans: list[tuple] = []
        members: list[tuple] = []   # (run, position, key, common prefix)

        def close():
            if len(members) > 1:
                fewest = [c["fewest"][m[0]][m[1]] for m in members]
                most = [c["most"][m[0]][m[1]] for m in members]
                rights = [m[2].index(_END) for m in members]
                for length in lengths:
                    # windows of this length end where the text does
                    ends = [max(f, length - r) for f, r in zip(fewest, rights)]
                    found = class_windows([m[2] for m in members], rights, [m[3] for m in members], ends, most, length)
                    before = len(spans)
                    for m, d in zip(members, found):
                        if d and d[0] <= d[1]:
                            r, i = m[:2]
                            p = c["p"][r][i]
                            spans.append((c["k1"][r][i], c["k2"][r][i], p - d[1], p - d[0] + length, length))
                    if len(spans) == before:    # nor does a longer window repeat
                        break
            members.clear()

        for r, i, key, shared in merge_runs(list(zip(c["shared"], c["rest"], c["rest_len"]))):
            if shared < need:
                close()
            members.append((r, i, key, shared))
        close()
        cols = list(zip(*spans)) or [()] * 5
        return pa.Table.from_arrays([pa.array(x, t) for x, t in
                                     zip(cols, (pa.string(), pa.int64(), *[pa.int32()] * 3))], names=_SPAN.names)

    return runs.groupBy("bucket").applyInArrow(run, _SPAN)


def _windows(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """The hash of every window of anchors in very large classes. Equal windows of one text
    that overlap (a run of one character) are a single row."""
    schema = T.StructType([*_SPAN.fields, T.StructField("n", T.LongType()), T.StructField("window", T.BinaryType())])
    types = (pa.string(), pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.binary())

    def run(batches):
        for k1s, k2s, texts, lists in slices(batches, 2, 1 << 18):
            out: list[list] = []
            for k1, k2, text, found in zip(k1s, k2s, texts, lists):
                raw = (text or "").encode("utf-8", "replace")
                last: dict[bytes, list] = {}
                for x in sorted(found, key=lambda f: f["p"]):
                    for length in lengths:
                        for s in range(x["p"] - x["most"], min(x["p"] - x["fewest"], len(raw) - length) + 1):
                            h = xxhash.xxh128_digest(raw[s:s + length])
                            row = last.get(h)
                            if row is not None and s <= row[3]:
                                row[3] = s + length
                                row[5] += 1
                            else:
                                row = last[h] = [k1, k2, s, s + length, length, 1, h]
                                out.append(row)
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _window_spans(windows: DataFrame) -> DataFrame:
    """Spans of the windows whose hash occurs more than once."""
    again = windows.groupBy("window").agg(F.sum("n").alias("n")).filter(F.col("n") > 1).select("window")
    return windows.join(again, "window").select(*_SPAN.names)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   reach: int = 256, max_class: int = 50_000, bucket_rows: int = 8_000,
                   shorter: int | None = None) -> DataFrame:
    """(__k1, __k2, start, end, length): byte spans of the documents that repeat elsewhere,
    for the rows whose ``row_key`` is (__k1, __k2), found by strings of ``length`` bytes and,
    if given, by those of ``shorter`` bytes. Spans may overlap and occur twice."""
    if shorter and shorter >= length:
        raise ValueError("shorter is not below length")
    lengths = [shorter, length] if shorter else [length]
    if not 16 <= lengths[0] - reach + 1:
        raise ValueError("reach leaves fewer than 16 bytes to compare")
    spark = docs.sparkSession
    keyed = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("__text"))
    found = stage(_anchor_rows(keyed, lengths[0], reach), "anchors")
    counts = stage(found.groupBy("cls").agg(F.count("*").alias("__n")).filter(F.col("__n") > 1), "classes")
    # an anchor of a class of one leaves before the join, by a bit array of the other classes
    some = KeyFilter.of_keys(counts, ["cls"], counts.count()).flag(found, ["cls"], "__maybe").filter("__maybe").drop("__maybe")
    # very large classes leave before the others are shuffled by class: their list is
    # written, so the planner knows its size (at most one class in max_class anchors)
    large = stage(counts.filter(F.col("__n") > max_class).select("cls"), "large-classes")
    both = (some.join(large, "cls", "left_anti").join(counts.hint("merge"), "cls").drop("__n").withColumn("__large", F.lit(False))
            .unionByName(some.join(large, "cls").withColumn("__large", F.lit(True))))
    one = F.struct("p", "fewest", "most", "cls")
    # repeated rows have the same anchors: one list of them serves each row
    lists = (both.groupBy("__k1", "__k2")
             .agg(F.collect_set(F.when(~F.col("__large"), one)).alias("__found"),
                  F.collect_set(F.when(F.col("__large"), one)).alias("__hot"),
                  F.count("*").alias("__all")))
    lists = stage(lists, "candidates")
    release(spark, found, counts, large)
    total, hot, owners = lists.agg(F.sum("__all"), F.max(F.size("__hot")), F.count("*")).first()
    # only texts that hold such an anchor are shuffled to the list of theirs
    owned = KeyFilter.of_keys(lists, _KEY, owners).flag(keyed, _KEY, "__maybe").filter("__maybe").drop("__maybe")
    rows = owned.join(lists, _KEY)
    buckets = max(1, -(-(total or 0) // bucket_rows))
    spans = _merged(_runs(rows.select(*_KEY, "__text", "__found"), length, buckets), lengths, reach)
    windows = None
    if hot:
        big = rows.filter(F.size("__hot") > 0).select(*_KEY, "__text", "__hot")
        windows = stage(_windows(big, lengths), "windows")
        spans = spans.unionByName(_window_spans(windows))
    spans = stage(spans, "spans")
    release(spark, lists, *([windows] if windows else []))
    return spans


def _runs_of(spans: list[int]) -> list[list[int]]:
    """Maximal runs (start, end) that the spans cover; spans that touch are one run."""
    out: list[list[int]] = []
    for x in sorted(spans):
        start, end = x >> 32, x & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _covered(runs: list[list[int]]) -> int:
    return sum(end - start for start, end in runs)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                   as_text: bool = False, shorter: int | None = None, **options) -> DataFrame:
    """``carry`` columns (the id by default) with ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs) and ``kept`` (the remaining bytes concatenated: binary, or with
    ``as_text`` a string without what is left of characters that were cut).

    Every byte covered by a string of ``length`` bytes that also starts anywhere else,
    in this document or another, is removed; strings are judged on the input. A null
    text is empty, texts shorter than ``length`` never change, texts of any length are
    taken whole, repeated rows repeat each other and lose all windows, and an empty table
    gives no rows. Other columns are ignored, whatever their names.

    With ``shorter``, a smaller number of bytes, ``n_shorter`` and ``n_shorter_spans`` follow:
    the bytes covered by strings of that length that also start anywhere else, and their
    maximal runs. They are counted, not removed.
    """
    carry = carry or [id_col]
    spans = repeated_spans(docs, id_col, text_col, shorter=shorter, **options)
    # a span is one number: its start, then in 32 bits its end
    span = F.col("start").cast("long") * (1 << 32) + F.col("end")
    short = F.col("length") == shorter if shorter else F.lit(False)
    lists = stage(spans.groupBy(*_KEY).agg(F.collect_set(F.when(~short, span)).alias("__spans"),
                                           F.collect_set(F.when(short, span)).alias("__short")), "span-lists")
    release(docs.sparkSession, spans)
    at = len(carry)
    rows = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)], F.col(text_col).alias("__text"),
                       *row_key(id_col, text_col))
    # texts without a span need no join
    flagged = KeyFilter.of_keys(lists, _KEY, lists.count()).flag(rows, _KEY, "__maybe")
    alone = flagged.filter("not __maybe").withColumns({c: F.lit(None).cast("array<bigint>") for c in ("__spans", "__short")})
    rows = flagged.filter("__maybe").join(lists, _KEY, "left").unionByName(alone)
    rows = rows.select(*[f"__c{i}" for i in range(at)], "__text", "__spans", "__short")
    schema = T.StructType([docs.schema[c] for c in carry]
                          + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept", T.StringType() if as_text else T.BinaryType())]
                          + [T.StructField(c, T.LongType()) for c in ("n_shorter", "n_shorter_spans") if shorter])

    def run(batches):
        for batch in batches:
            rows = ([], [], [], [], [], [])
            for columns in slices([batch.select([at, at + 1, at + 2])], 0):
                for text, spans, short in zip(*columns):
                    raw = (text or "").encode("utf-8", "replace")
                    cut, short = _runs_of(spans or ()), _runs_of(short or ())
                    left = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in cut)], [*(s for s, _ in cut), len(raw)]))
                    if as_text:
                        left = left.decode("utf-8", "ignore")
                    for c, v in zip(rows, (len(raw), _covered(cut), len(cut), left, _covered(short), len(short))):
                        c.append(v)
            types = [*[pa.int64()] * 3, pa.string() if as_text else pa.binary(), *[pa.int64()] * 2]
            yield pa.RecordBatch.from_arrays(batch.columns[:at] + [pa.array(c, t) for c, t in zip(rows, types)][:len(schema) - at],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                  **options) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text_col`` (null stays null; a
    character cut in two goes) and, if there is such a column, ``chars_col`` counted anew."""
    names = [f"__s{i}" for i in range(len(docs.columns))]
    private = dict(zip(docs.columns, names))
    out = remove_repeats(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in private.items()]), private[id_col],
                         private[text_col], carry=names, as_text=True, **options)
    there = F.col(private[text_col]).isNotNull()
    text = F.when(there, F.col("kept"))
    cols = []
    for f in docs.schema:
        value = F.col(private[f.name])
        if f.name == text_col:
            value = text
        elif f.name == chars_col:
            value = F.when(there, F.length(text)).otherwise(value)
        cols.append(value.cast(f.dataType).alias(f.name))
    return out.select(*cols)
