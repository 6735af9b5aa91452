"""Language identification by prediction by partial matching (PPM).

Training counts, per language, how often each byte follows each context of up to
``order`` bytes (texts lower-cased). A context node exists where it was seen
``min_count`` times in some language. The code length of a byte under a node is
that of PPM method C with exclusion: a seen byte costs ``-log2(c / (n + q))``,
any other costs the escape ``-log2(q / (n + q))`` plus its length under the next
shorter context, renormalised over the bytes not seen here; below order 0 all 256
byte values are equally likely. The counts are frozen, so code lengths are worked
out once for every (node, byte, language) and scoring is two table look-ups a
byte. The predicted language has the shortest code for the whole text.

Bounds: the training sample is at most ``rows_per_lang`` different texts of at most
``row_bytes`` bytes a language and ``most_rows`` texts over all languages, chosen by
hash, and the table broadcast to the executors at most ``table_bytes``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lanecost.llm.util import slices

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def training_rows(docs: DataFrame, lang_col: str, text_col: str, rows_per_lang: int, row_bytes: int,
                  most_rows: int = 6000) -> list:
    """A bounded, hash-chosen sample of labelled rows, the same on every run: different
    texts, ``rows_per_lang`` a language and ``most_rows`` in all (one a language at least)."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
                       & (F.octet_length(F.col(text_col)) <= row_bytes))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # a share by hash of about three times the wanted texts (one number a language), then
    # the first of these; only that share is ever shuffled. Copies count once: the share is
    # taken from a bounded sketch of the different texts
    texts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    if not texts:
        return []
    rows_per_lang = max(1, min(rows_per_lang, most_rows // len(texts)))
    share = {g: min(1.0, 3.0 * (rows_per_lang + 20) / max(n, 1)) for g, n in texts.items()}
    keep = F.create_map(*[F.lit(x) for kv in sorted(share.items()) for x in kv])[F.col("lang")]
    chance = (F.xxhash64("text").bitwiseAND(F.lit((1 << 30) - 1))) / F.lit(float(1 << 30))
    some = rows.filter(chance < keep).dropDuplicates(["lang", "text"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(7), "text"), "text"))
    return some.withColumn("__r", rank).filter(F.col("__r") <= rows_per_lang).select("lang", "text").collect()


def train(samples: list[tuple[str, str]], order: int = 3, min_count: int = 3,
          table_bytes: int = 96 << 20) -> dict | None:
    """Frozen model: byte -> symbol map, context -> node map, and the code lengths
    (node, symbol, language) in bits. None without samples."""
    langs = sorted({lang for lang, _ in samples})
    if not langs:
        return None
    pad = b" " * order
    data = {g: np.frombuffer(b"".join(pad + t.lower().encode("utf-8", "replace") for g2, t in samples if g2 == g),
                             dtype=np.uint8) for g in langs}
    seen = np.unique(np.concatenate([np.unique(d) for d in data.values()] + [np.array([32], dtype=np.uint8)]))
    size = len(seen) + 1                      # symbol 0: any byte never seen in training
    symbol = np.zeros(256, dtype=np.int64)
    symbol[seen] = np.arange(1, size)
    codes = {g: symbol[d] for g, d in data.items()}
    weight = np.ones(size)                    # byte values a symbol stands for
    weight[0] = max(1, 256 - len(seen))
    floor = weight / weight.sum()

    def counts(g: str, k: int) -> dict[int, np.ndarray]:
        """{context code: counts by symbol} of order k."""
        s = codes[g]
        n = len(s) - k
        if n <= 0:
            return {}
        key = np.zeros(n, dtype=np.int64)
        for j in range(k + 1):
            key = key * size + s[j:j + n]
        val, num = np.unique(key, return_counts=True)
        ctx, sym = val // size, val % size
        out: dict[int, np.ndarray] = {}
        starts = np.flatnonzero(np.r_[True, ctx[1:] != ctx[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(ctx)]):
            row = np.zeros(size)
            row[sym[a:b]] = num[a:b]
            out[int(ctx[a])] = row
        return out

    by_order = [{g: counts(g, k) for g in langs} for k in range(order + 1)]
    most_nodes = max(1, table_bytes // (size * len(langs) * 4))
    wanted: list[tuple[int, int, float]] = []
    for k in range(1, order + 1):
        total: dict[int, float] = {}
        for g in langs:
            for c, row in by_order[k][g].items():
                total[c] = max(total.get(c, 0), row.sum())
        wanted += [(k, c, n) for c, n in total.items() if n >= min_count]
    wanted.sort(key=lambda x: (-x[2], x[0], x[1]))
    nodes = sorted((k, c) for k, c, _ in wanted[:most_nodes - 1])
    node_of = {(0, 0): 0} | {kc: i + 1 for i, kc in enumerate(nodes)}

    def step(row: np.ndarray | None, lower: np.ndarray) -> np.ndarray:
        if row is None:
            return lower
        hit, n = row > 0, row.sum()
        q = hit.sum()
        rest = lower[~hit].sum()
        if rest <= 0:
            return row / n
        p = np.where(hit, row / (n + q), 0)
        return np.where(hit, p, lower * (q / (n + q) / rest))

    prob = np.empty((len(node_of), size, len(langs)))
    suffix = np.zeros(len(node_of), dtype=np.int64)
    for li, g in enumerate(langs):
        prob[0, :, li] = step(by_order[0][g].get(0), floor)
    for (k, c), i in node_of.items():
        if k:
            kk, cc = k - 1, c % size ** (k - 1)
            while (kk, cc) not in node_of:
                kk, cc = kk - 1, cc % size ** (kk - 1)
            suffix[i] = node_of[kk, cc]
            for li, g in enumerate(langs):
                prob[i, :, li] = step(by_order[k][g].get(c), prob[suffix[i], :, li])
    # context code of full order -> the longest node that is a suffix of it
    state = np.zeros(1, dtype=np.int32)
    for k in range(1, order + 1):
        state = np.tile(state, size)          # a longer context falls back to its suffix
        for (kk, c), i in node_of.items():
            if kk == k:
                state[c] = i
    bits = -np.log2(prob / weight[None, :, None])
    return {"langs": langs, "order": order, "size": size, "symbol": symbol.astype(np.int32), "state": state,
            "bits": bits.reshape(-1, len(langs)).astype(np.float32)}


def code_lengths(model: dict, texts: list[str], block: int = 1 << 18) -> np.ndarray:
    """Bits of each text under each language, as an array (texts, languages)."""
    order, size = model["order"], model["size"]
    pad = b" " * order
    raw = [pad + t.lower().encode("utf-8", "replace") for t in texts]
    out = np.zeros((len(raw), len(model["langs"])))
    if not raw:
        return out
    s = model["symbol"][np.frombuffer(b"".join(raw), dtype=np.uint8)]
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - [len(r) for r in raw]
    live = np.ones(len(s), dtype=bool)        # the padding is context only
    for j in range(order):
        live[starts + j] = False
    owner = np.repeat(np.arange(len(raw)), ends - starts)
    for a in range(order, len(s), block):
        b = min(len(s), a + block)
        ctx = np.zeros(b - a, dtype=np.int64)
        for j in range(order, 0, -1):
            ctx = ctx * size + s[a - j:b - j]
        keep = live[a:b]
        at = model["state"][ctx].astype(np.int64) * size + s[a:b]
        part, who = model["bits"][at[keep]], owner[a:b][keep]
        if len(who):
            cut = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            out[who[cut]] += np.add.reduceat(part, cut, axis=0, dtype=np.float64)
    return out


def identify(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", rows_per_lang: int = 300, row_bytes: int = 1 << 16, order: int = 3,
             min_count: int = 3, table_bytes: int = 96 << 20, carry: list[str] | None = None,
             pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``carry`` columns (the id by default), ``lang_pred`` and ``score`` for every row.

    Learns from the labelled rows of ``training`` only. A null text or one without
    letters, and every text when nothing can be learned, is ``und`` with score 0.
    The score is the best language's share of ``2 ** -(bits a byte * 16)``, between 0 and
    1. Ties go to the label that sorts first. Repeated rows are judged alike; texts of any
    length are used whole; an empty table gives no rows; columns that are not carried are
    ignored, whatever their names.
    """
    spark = docs.sparkSession
    samples = [(r[0], r[1]) for r in training_rows(training, lang_col, text_col, rows_per_lang, row_bytes)]
    shared = spark.sparkContext.broadcast(train(samples, order, min_count, table_bytes))
    carry = carry or [id_col]
    src = docs.select(*carry) if text_col in carry else docs.select(*carry, text_col)
    schema = T.StructType([docs.schema[c] for c in carry]
                          + [T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    width, at_text = len(carry), src.columns.index(text_col)

    def run(batches):
        model = shared.value
        for batch in batches:
            preds, scores = [], []
            for cols in slices([batch.select([at_text])], 0):
                texts = [t or "" for t in cols[0]]
                ok = [i for i, t in enumerate(texts) if model and _LETTER.search(t)]
                pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if ok:
                    chosen = [texts[i] for i in ok]
                    bits = code_lengths(model, chosen)
                    best = bits.argmin(axis=1)
                    per = (bits - bits.min(axis=1, keepdims=True)) / np.array([[max(1, len(t))] for t in chosen])
                    share = 1 / np.exp2(-16 * per).sum(axis=1)
                    for i, b, v in zip(ok, best, share):
                        pred[i], score[i] = model["langs"][b], float(v)
                preds += pred
                scores += score
            yield pa.RecordBatch.from_arrays(
                batch.columns[:width] + [pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                names=schema.names)

    return src.mapInArrow(run, schema)


def drop_unknown(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text has a recognisable language (all but ``und``)."""
    out = identify(docs, docs, text_col=text_col, carry=docs.columns, pred_col="__lang_pred", score_col="__score", **options)
    return out.filter(F.col("__lang_pred") != UNKNOWN).select(*docs.columns)


def held_out(id_col: str = "doc_id"):
    """True for one document in five, by crc32 of the id as text (null id: of '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
