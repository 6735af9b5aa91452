"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens in which numbers, names and units are typed
placeholders and every other word is itself, lower-cased and without the punctuation
around it. Items and documents are compared by hashes of token windows, so an item
whose numbers or names were exchanged still meets its template. A hit counts only if
the exchange is consistent: along one alignment, equal slot values of the item stand
for equal values of the document and different ones for different ones.

A capitalised word that opens a sentence may be a name or not, so template windows are
hashed in both readings: all such words as words, and all as names.

Beside the templates stands an exact class: windows of the plain lower-cased words, numbers
and names included, without a least number of words. It finds verbatim copies of items
that hold little but numbers and of items whose slots are read differently there. A
character of a script without blanks between words is a token of its own.

The benchmark is the query set: its windows are compared with every window of every
document in blocks of at most ``block_windows``, so what a task holds is bounded
however large the benchmark is.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import Memo, doc_key, mix64, slices, stage

# Words that stand for numbers, and units that may follow a number.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion half double twice".split())
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces oz "
    "pound pounds lb lbs ton tons ml l liter liters litre litres gallon gallons cup cups second seconds s minute "
    "minutes min hour hours h day days week weeks month months year years percent % degree degrees c f kelvin volt "
    "volts watt watts joule joules newton newtons hertz hz dollar dollars cent cents euro euros usd eur mph kph".split())
_NUMBER = re.compile(r"[+\-−]?[$€£]?\d[\d.,:/]*%?")
_QUANTITY = re.compile(r"[+\-−]?[$€£]?\d[\d.,:/]*[^\W\d_]{1,6}")
_EDGE = re.compile(r"^[^\w$€£+\-−%]+|[^\w%]+$")
_STOP = re.compile(r"[.!?:][\"')\]»”’]*$")
_NUM, _CAP, _END, _UNIT = 1, 2, 4, 8
# Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han: scripts without blanks between words
_DENSE = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
                    "\uf900-\ufaff\U00020000-\U0003ffff])")
_BREAK = "\0"       # stands for a line break among the raw tokens
_WORDS, _NAMES, _EXACT = 0, 1, 2    # readings of a window
_SIGNS = frozenset("+ - − – * × · / ÷ = < > ≤ ≥ ^ ±".split())
_TYPES = np.array([0x1111111111111110, 0x2222222222222220, 0x3333333333333330], dtype=np.uint64)  # number, name, unit
_MULT = np.uint64(0xC2B2AE3D27D4EB4F)
_LEAST_EXACT = 3    # words of the shortest item that an exact match tells anything about
_BREAK_CODE = 1     # no word's: those are 16 at least


def core(raw: str) -> str:
    return _EDGE.sub("", raw)


def _attributes(raw: str) -> int:
    """Hash of the canonical word with four flags in its low bits; 0: no word."""
    word = core(raw)
    if raw == _BREAK:
        return _BREAK_CODE
    if not any(ch.isalnum() or ch == "%" for ch in word):
        return 0
    low = word.lower()
    flags = 0
    if _NUMBER.fullmatch(word) or _QUANTITY.fullmatch(word) or low in NUMBER_WORDS:
        flags |= _NUM
    elif word[0].isupper() and not word.isupper():   # shouted words and initials are words
        flags |= _CAP
    if low in UNITS:
        flags |= _UNIT
    if _STOP.search(raw):
        flags |= _END
    return (xxhash.xxh64_intdigest(low.encode("utf-8", "replace")) & ~15 or 16) | flags


def raw_tokens(text: str) -> list[str]:
    """Words at blanks, a mark for each line break, characters of scripts without blanks singly."""
    if not text.isascii() and _DENSE.search(text):
        text = _DENSE.sub(r" \1 ", text)
    if "\r" in text:
        text = text.replace("\r", "\n")
    return text.replace("\n", f" {_BREAK} ").split()


class Canon:
    """Canonical tokens of texts: ``kind`` (0 word, 1 number, 2 name, 3 unit; two arrays:
    words that open a sentence read as words, and as names) and ``hashes`` by reading,
    ``place`` (index among the raw tokens), ``start`` (of each text). A line break ends a
    sentence."""

    def __init__(self, texts: list[str], memo: Memo):
        self.raw = [raw_tokens(t) for t in texts]
        sizes = np.array([len(r) for r in self.raw], dtype=np.int64)
        v = np.fromiter(map(memo.__getitem__, chain.from_iterable(self.raw)), dtype=np.uint64, count=int(sizes.sum()))
        doc = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(v)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        full = v != 0
        lines = np.cumsum(v == _BREAK_CODE)
        full &= v != _BREAK_CODE
        lines = lines[full]
        v, self.doc, self.place = v[full], doc[full], place[full]
        self.start = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        flag = (v & np.uint64(15)).astype(np.int64)
        begins = np.ones(len(v), dtype=bool)
        begins[1:] = (self.doc[1:] != self.doc[:-1]) | (flag[:-1] & _END > 0) | (lines[1:] != lines[:-1])
        num = flag & _NUM > 0
        after_num = np.zeros(len(v), dtype=bool)
        after_num[1:] = num[:-1] & (self.doc[1:] == self.doc[:-1])
        unit = (flag & _UNIT > 0) & after_num & ~num
        name = (flag & _CAP > 0) & ~num & ~unit
        plain = v >> np.uint64(4)
        self.kind = [np.select([num, n, unit], [1, 2, 3], 0) for n in (name & ~begins, name)]
        self.hashes = [np.where(k > 0, _TYPES[np.maximum(k, 1) - 1], plain) for k in self.kind] + [plain]

    def signs(self, text: int, x: int) -> list[str]:
        """The arithmetic signs between a text's token x and the one before it."""
        at = int(self.start[text]) + x
        return [r for r in self.raw[text][int(self.place[at - 1]) + 1:int(self.place[at])] if r in _SIGNS]

    def windows(self, width: int, min_words: int, reading: int = _WORDS) -> tuple[np.ndarray, np.ndarray]:
        """(hash, usable) of the window at each token: inside its text and, but for the
        exact class, with enough words that are not placeholders."""
        hashes = self.hashes[reading]
        n = len(hashes)
        h = np.zeros(n, dtype=np.uint64)
        if n < width:
            return h, np.zeros(n, dtype=bool)
        m = n - width + 1
        for j in range(width):
            h[:m] = h[:m] * _MULT + hashes[j:j + m]
        usable = np.zeros(n, dtype=bool)
        usable[:m] = self.doc[width - 1:] == self.doc[:m]
        if reading != _EXACT:
            words = np.cumsum(np.r_[0, self.kind[reading] == 0])
            usable[:m] &= words[width:] - words[:m] >= min_words
        return mix64(h + np.uint64(width + (reading << 16))), usable


def canon_memo() -> Memo:
    return Memo(_attributes, 300_000)


def consistent(pairs: list[tuple[int, int, str, str]], starts: list[int], width: int) -> list[int]:
    """Window starts (in the item, ascending, of one alignment) whose slots agree. ``pairs``:
    (item token, kind, item value, document value) of the aligned slots, ascending.
    A value pair that contradicts an earlier one spoils the windows that hold it."""
    there, back, spoilt = {}, {}, []
    for at, kind, a, b in pairs:
        if there.setdefault((kind, a), b) != b or back.setdefault((kind, b), a) != a:
            spoilt.append(at)
    if not spoilt:
        return starts
    return [s for s in starts if not any(s <= x < s + width for x in spoilt)]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", width: int = 8, min_words: int = 4,
          min_coverage: float = 0.5, min_run: int = 20, block_windows: int = 500_000) -> DataFrame:
    """One row per document and benchmark item found in it: the ids, ``coverage`` (part of
    the item's windows found), ``longest_run`` (tokens of one unbroken stretch) and
    ``exchanged`` (slots whose value differs from the item's).

    A pair is reported when ``coverage >= min_coverage`` or ``longest_run >= min_run`` holds
    among the template windows, those with ``min_words`` plain words, or among the exact ones;
    the greater figures are given. An item of fewer than ``width`` tokens is one window of
    all its tokens. Items of one or two words (a character of a script without blanks counts
    half a word), and null or empty texts on either side, match nothing. Rows that repeat on either side are reported once for each (doc, item) pair
    of ids; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ids = [T.StructField("__doc", docs.schema[id_col].dataType), T.StructField("__item", benchmark.schema[item_col].dataType)]
    schema = T.StructType(ids + [T.StructField("coverage", T.DoubleType()), T.StructField("longest_run", T.LongType()),
                                 T.StructField("exchanged", T.LongType())])
    items = benchmark.select(F.col(item_col), F.col(item_text_col)).filter(F.col(item_text_col).isNotNull()).distinct()
    src = docs.filter(F.col(text_col).isNotNull()).select(id_col, text_col)

    def block(rows: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(_query_block(rows, width, min_words))

        def run(batches):
            q, memo = shared.value, canon_memo()
            for batch in batches:
                out: list[tuple] = []
                for doc_ids, texts in slices([batch], 1):
                    out += _search(q, doc_ids, texts, memo, width, min_words, min_coverage, min_run)
                cols = list(zip(*out)) or [()] * 5
                types = [batch.schema.field(0).type, q["item_type"], pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)

        return src.mapInArrow(run, schema)

    found, rows, size = [], [], 0
    for r in items.orderBy(item_col).toLocalIterator():
        rows.append((r[0], r[1]))
        size += 3 * len(raw_tokens(r[1])) + 1     # of each reading
        if size >= block_windows:
            found.append(stage(block(rows), "leaks"))
            rows, size = [], 0
    if rows or not found:
        found.append(block(rows))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return (out.groupBy(F.col("__doc").alias(id_col), F.col("__item").alias(item_col))
            .agg(F.max("coverage").alias("coverage"), F.max("longest_run").alias("longest_run"),
                 F.min("exchanged").alias("exchanged")))


def _query_block(rows: list[tuple], width: int, min_words: int) -> dict:
    """Windows of a block of items: sorted hashes, and for each hash its (item, token)."""
    memo = canon_memo()
    c = Canon([t for _, t in rows], memo)
    sizes = np.diff(c.start)
    by_reading: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = {}
    # places of windows that can be found: template windows in either reading, exact ones
    total = {False: np.zeros(len(rows), dtype=np.int64), True: np.zeros(len(rows), dtype=np.int64)}
    tokens = [[(*k, core(c.raw[d][p]).lower()) for *k, p in zip(*(x[a:b].tolist() for x in (*c.kind, c.place)))]
              for d, (a, b) in enumerate(zip(c.start[:-1], c.start[1:]))]
    enough = [sum(.5 if _DENSE.match(t[2]) else 1 for t in words) >= _LEAST_EXACT for words in tokens]
    for w in sorted({min(width, int(n)) for n in sizes if n}):
        for reading in (_WORDS, _NAMES, _EXACT):
            h, ok = c.windows(w, min_words, reading)
            at = defaultdict(list)
            for i in np.flatnonzero(ok).tolist():
                d = int(c.doc[i])
                if (w == width or sizes[d] == w) and (enough[d] or reading != _EXACT):
                    at[int(h[i])].append((d, i - int(c.start[d])))
                    # a window with enough words in the reading as names has them in that as words
                    total[reading == _EXACT][d] += reading != _NAMES
            if at:
                by_reading[reading, w] = dict(at)
    signs = [[c.signs(d, x) if x else [] for x in range(int(n))] for d, n in enumerate(sizes)]
    return {"ids": [i for i, _ in rows], "windows": by_reading, "total": total, "tokens": tokens, "signs": signs,
            "item_type": pa.array([i for i, _ in rows]).type if rows else pa.int64(),
            "filter": {k: _bits(list(at)) for k, at in by_reading.items()}}


def _bits(hashes: list[int]) -> np.ndarray:
    bits = np.zeros(1 << 22, dtype=bool)
    bits[np.array(hashes, dtype=np.uint64) & np.uint64((1 << 22) - 1)] = True
    return bits


def _search(q: dict, doc_ids: list, texts: list[str], memo: Memo, width: int, min_words: int, min_coverage: float,
            min_run: int) -> list[tuple]:
    if not q["windows"]:
        return []
    c = Canon(texts, memo)
    # (document, item) -> {(exact, width, diagonal): {reading: [item window starts]}}
    hits: dict[tuple[int, int], dict] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for (reading, w), at in q["windows"].items():
        h, ok = c.windows(w, min_words, reading)
        maybe = np.flatnonzero(ok & q["filter"][reading, w][h & np.uint64((1 << 22) - 1)])
        for i, value in zip(maybe.tolist(), h[maybe].tolist()):
            for item, j in at.get(value, ()):
                d = int(c.doc[i])
                hits[d, item][reading == _EXACT, w, i - int(c.start[d]) - j][reading].append(j)
    out = []
    for (d, item), lines in hits.items():
        a, raw = int(c.start[d]), c.raw[d]
        tokens, signs, exchanged = q["tokens"][item], q["signs"][item], 0
        covered, longest = {False: set(), True: set()}, {False: 0, True: 0}
        for (exact, w, diagonal), readings in lines.items():
            good, changed = set(), set()
            for reading, starts in readings.items():
                if exact:
                    good |= {s for s in starts if all(signs[x] == c.signs(d, diagonal + x) for x in range(s + 1, s + w))}
                    continue
                inside = sorted({x for s in starts for x in range(s, s + w) if tokens[x][reading]})
                pairs = [(x, tokens[x][reading], tokens[x][2], core(raw[int(c.place[a + diagonal + x])]).lower()) for x in inside]
                good.update(consistent(pairs, sorted(starts), w))
                changed |= {p[0] for p in pairs if p[2] != p[3]}
            exchanged += len(changed)
            covered[exact] |= good
            run, before = 0, None
            for s in sorted(good):
                run = run + 1 if before == s - 1 else w
                longest[exact], before = max(longest[exact], run), s
        coverage = {e: len(covered[e]) / max(1, int(q["total"][e][item])) for e in covered}
        if any(covered[e] and (coverage[e] >= min_coverage or longest[e] >= min_run) for e in covered):
            out.append((doc_ids[d], q["ids"][item], max(coverage.values()), max(longest.values()), exchanged))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found. Rows that share an id, or
    have none, are each judged by their own text."""
    keyed = docs.select(doc_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    gone = leaks(keyed, benchmark, "key", "text", **options).select(F.col("key").alias("__gone")).distinct()
    return docs.join(gone, doc_key(id_col, text_col) == F.col("__gone"), "left_anti")
