"""Quality rules by distribution divergence from language references.

References, one per value of the language column, come from all its documents: the
histogram over character classes, and over the common words, those that make up at
least ``common`` of the words of a language (the rest is one bin). Common words are
found exactly: a word that frequent overall is that frequent in some block of words,
so each block proposes its frequent words and a second pass counts the proposals.

A document of at least ``min_words`` words fails if its Jensen-Shannon distance (base 2,
0 to 1) to the nearest reference exceeds ``max_chars`` for characters or ``max_words``
for words. Shorter documents are too small a sample and are judged by the base rules
alone.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import Memo, mix64, slices

_MULT = np.uint64(0x9DDFEA08EB382D69)
SYMBOLS = b"#*$%&|<>"


def _class_table() -> np.ndarray:
    """byte -> class: 0 space, 1 line end, 2 lower, 3 upper, 4 digit, 5 sentence mark, 6
    symbol, 7 other ASCII, 8-12 lead bytes of UTF-8 by block, 13 continuation."""
    t = np.full(256, 7, dtype=np.int64)
    for chars, c in ((b" \t", 0), (b"\n\r\v\f", 1), (bytes(range(97, 123)), 2), (bytes(range(65, 91)), 3),
                     (b"0123456789", 4), (b".,;:!?'\"-()", 5), (SYMBOLS, 6)):
        t[list(chars)] = c
    for lo, hi, c in ((0x80, 0xC0, 13), (0xC0, 0xC4, 8), (0xC4, 0xD0, 9), (0xD0, 0xE0, 10), (0xE0, 0xF0, 11), (0xF0, 0x100, 12)):
        t[lo:hi] = c
    return t


_CLASS = _class_table()
_CLASSES = 13      # continuation bytes are not characters
_WORDLIKE = bytes(b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    """Lower-cased runs of letters (ASCII letters and anything beyond ASCII)."""
    return text.lower().encode("utf-8", "replace").translate(_WORDLIKE).split()


def char_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=_CLASSES + 1)[:_CLASSES]


def references(docs: DataFrame, text_col: str, lang_col: str, common: float, block_words: int = 1 << 20) -> dict:
    """{"langs", "words" (word -> bin from 1), "chars" (langs, classes), "hist" (langs, bins)}."""
    src = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(lang_col, text_col)
    pair = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.BinaryType())])

    def propose(batches):
        counts: dict[str, Counter] = defaultdict(Counter)
        total: Counter = Counter()

        def frequent(lang):
            least = common * total.pop(lang)
            return [(lang, w) for w, n in counts.pop(lang).items() if n >= least]

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()),
                                               pa.array([x[1] for x in found], pa.binary())], names=pair.names)
        for langs, texts in slices(batches, 1):
            for lang, text in zip(langs, texts):
                w = plain_words(text)
                counts[lang].update(w)
                total[lang] += len(w)
                if total[lang] >= block_words:
                    yield rows(frequent(lang))
        yield rows([x for lang in list(total) for x in frequent(lang)])

    proposed = src.mapInArrow(propose, pair).distinct()
    # at most 1 / common words a block and language, and far fewer survive overall
    vocabulary = sorted({bytes(r["word"]) for r in proposed.select("word").distinct().toLocalIterator()})
    index = {w: i for i, w in enumerate(vocabulary, 1)}
    shared = docs.sparkSession.sparkContext.broadcast(index)
    size = len(vocabulary) + 1
    count = T.StructType([T.StructField("lang", T.StringType()), T.StructField("kind", T.IntegerType()),
                          T.StructField("bin", T.IntegerType()), T.StructField("n", T.LongType())])

    def measure(batches):
        find = shared.value.get
        words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(size, dtype=np.int64))
        chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(_CLASSES, dtype=np.int64))
        for langs, texts in slices(batches, 1):
            for lang, text in zip(langs, texts):
                w = plain_words(text)
                words[lang] += np.bincount(np.fromiter((find(x, 0) for x in w), np.int64, len(w)), minlength=size)
                chars[lang] += char_histogram(text.encode("utf-8", "replace"))
        out = [(lang, kind, int(b), int(v[b])) for kind, h in ((0, words), (1, chars)) for lang, v in h.items()
               for b in np.flatnonzero(v)]
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=count.names)

    sums = src.mapInArrow(measure, count).groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in sums})
    hist, chars = np.zeros((len(langs), size)), np.zeros((len(langs), _CLASSES))
    for r in sums:
        (hist if r["kind"] == 0 else chars)[langs.index(r["lang"]), r["bin"]] = r["n"]
    if langs:
        rare = (hist < common * np.maximum(1, hist.sum(axis=1, keepdims=True))).all(axis=0)
        rare[0] = False
        hist[:, 0] += hist[:, rare].sum(axis=1)
        hist = hist[:, ~rare]
        index = {w: i for i, w in enumerate((w for w, r in zip(vocabulary, rare[1:]) if not r), 1)}
    return {"langs": langs, "words": index, "chars": chars, "hist": hist}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distances (rows of p, rows of q) of count histograms; 1 where one is empty."""
    def norm(x):
        s = x.sum(axis=1, keepdims=True)
        return np.divide(x, s, out=np.zeros(x.shape), where=s > 0)

    def plogp(x):
        return np.where(x > 0, x * np.log2(np.maximum(x, 1e-300)), 0)
    a, b = norm(p.astype(float)), norm(q.astype(float))
    out = np.ones((len(a), len(b)))
    for j in range(len(b)):
        m = (a + b[j]) / 2
        d = (plogp(a) + plogp(b[j])).sum(axis=1) / 2 - plogp(m).sum(axis=1)
        full = (a.sum(axis=1) > 0) & (b[j].sum() > 0)
        out[full, j] = np.sqrt(np.clip(d[full], 0, 1))
    return out


def base_counts(text: str, words: Memo) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated 5-word
    windows) of a text; words are split at space, tab, LF, VT, FF and CR."""
    raw = text.encode("utf-8", "replace")
    w = raw.split()
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = 0
    if len(w) > 5:
        h = np.fromiter(map(words.__getitem__, w), dtype=np.uint64, count=len(w))
        n = len(w) - 4
        rolled = np.zeros(n, dtype=np.uint64)
        for j in range(5):
            rolled = rolled * _MULT + h[j:j + n]
        rolled = mix64(rolled)
        order = np.argsort(rolled, kind="stable")
        same = rolled[order[1:]] == rolled[order[:-1]]
        if same.any():
            again = np.zeros(n, dtype=bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            cover = np.zeros(len(w), dtype=bool)
            for j in range(5):
                cover[j:j + n] |= again
            repeat = int(cover.sum())
    return len(w), chars, symbols, dup, repeat


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           common: float = 0.002, min_words: int = 50, max_chars: float = 0.3, max_words: float = 0.65) -> DataFrame:
    """One row per document: id, base counts, ``base_failed``, ``kept``, the two distances
    (null where not judged).

    A null text is empty; documents of under ten words, or of which over a fifth of the
    words lies in repeated 5-word windows, fail the base rules. Without any labelled
    text there are no references and only the base rules decide. Repeated rows are
    judged alike and texts used whole; other columns are ignored; an empty table gives
    no rows.
    """
    ref = references(docs, text_col, lang_col, common)
    shared = docs.sparkSession.sparkContext.broadcast(ref)
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType([docs.schema[id_col]] + [T.StructField(c, T.LongType()) for c in longs]
                          + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
                          + [T.StructField(c, T.DoubleType()) for c in ("js_chars", "js_words")])

    def run(batches):
        ref = shared.value
        find, size = ref["words"].get, len(ref["words"]) + 1
        words = Memo(xxhash.xxh64_intdigest)
        for batch in batches:
            counts, failed, kept, js_c, js_w = [], [], [], [], []
            for (texts,) in slices([batch.select([1])], 0):
                texts = [t or "" for t in texts]
                base = [base_counts(t, words) for t in texts]
                bad = [b[0] < 10 or 100 * b[4] > 20 * b[0] for b in base]
                judged = [i for i, b in enumerate(base) if ref["langs"] and not bad[i] and b[0] >= min_words]
                dist = {}
                if judged:
                    c = np.stack([char_histogram(texts[i].encode("utf-8", "replace")) for i in judged])
                    h = np.zeros((len(judged), size), dtype=np.int64)
                    for k, i in enumerate(judged):
                        w = plain_words(texts[i])
                        h[k] = np.bincount(np.fromiter((find(x, 0) for x in w), np.int64, len(w)), minlength=size)
                    near_c, near_w = js_distance(c, ref["chars"]), js_distance(h, ref["hist"])
                    lang = (near_c + near_w).argmin(axis=1)
                    at = np.arange(len(judged))
                    dist = dict(zip(judged, zip(near_c[at, lang].tolist(), near_w[at, lang].tolist())))
                for i, b in enumerate(base):
                    dc, dw = dist.get(i, (None, None))
                    js_c.append(dc)
                    js_w.append(dw)
                    failed.append(bad[i])
                    kept.append(not bad[i] and (dc is None or dc <= max_chars and dw <= max_words))
                counts += base
            cols = list(zip(*counts)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in cols]
                + [pa.array(c, pa.bool_()) for c in (failed, kept)] + [pa.array(c, pa.float64()) for c in (js_c, js_w)],
                names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
