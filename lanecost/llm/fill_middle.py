"""Fill-in-the-middle texts by block rotation inside one byte buffer.

A text's UTF-8 bytes are scanned once for the ends of its lines; two of them, drawn from
a hash of the document's id, cut it into prefix, middle and suffix. The three sentinels
are inserted in front of these parts, and one rotation then brings the parts into their
final order: a rotation exchanges two neighbouring segments by reversing each of them and
then both together, in the buffer itself. Reading a result back finds the sentinels,
makes the rotation undone and takes the sentinels out.

Both directions are narrow stages without a shuffle: a task holds a slice of rows and one
buffer, so a lost task is simply run again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import slices

PLAIN, PSM, SPM = "plain", "psm", "spm"
SENTINELS = ("<P>", "<M>", "<S>")


def reverse(buf: bytearray, lo: int, hi: int, block: int = 1 << 16) -> None:
    """Reverse ``buf[lo:hi]`` where it stands, from both ends inwards; never more than
    two blocks are held beside the buffer."""
    while hi - lo > 2 * block:
        left, right = buf[lo:lo + block], buf[hi - block:hi]
        left.reverse()
        right.reverse()
        buf[lo:lo + block], buf[hi - block:hi] = right, left
        lo, hi = lo + block, hi - block
    rest = buf[lo:hi]
    rest.reverse()
    buf[lo:hi] = rest


def rotate(buf: bytearray, lo: int, mid: int, hi: int, block: int = 1 << 16) -> None:
    """Exchange ``buf[lo:mid]`` and ``buf[mid:hi]`` in place by three reversals."""
    if lo < mid < hi:
        reverse(buf, lo, mid, block)
        reverse(buf, mid, hi, block)
        reverse(buf, lo, hi, block)


def check_sentinels(sentinels: tuple[str, str, str]) -> tuple[bytes, bytes, bytes]:
    """The sentinels as bytes. A first byte may stand at the start of sentinels only and
    none may begin another, so text beside a sentinel can never make up a false one."""
    marks = tuple(s.encode() for s in sentinels)
    firsts = {m[:1] for m in marks}
    if (not all(marks) or any(m[i:i + 1] in firsts for m in marks for i in range(1, len(m)))
            or any(a.startswith(b) for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j)):
        raise ValueError("sentinels must differ and start with a byte that they hold nowhere else")
    return marks


def draws(key: str) -> list[int]:
    """The first four unsigned 32-bit groups of the SHA-256 of ``key``."""
    digest = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def line_ends(raw: bytes) -> np.ndarray:
    """Byte offsets after each line; the last line needs no line break."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return ends if not raw or raw.endswith(b"\n") else np.append(ends, len(raw))


def code_points(raw) -> int:
    """Characters in valid UTF-8 bytes: those that continue none."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def arrange(buf: bytearray, first: int, second: int, form: str, marks: tuple[bytes, bytes, bytes]) -> None:
    """Put the sentinels in and the parts, cut at ``first`` and ``second``, in order."""
    p, m, s = marks
    buf[second:second] = s
    buf[first:first] = m
    buf[0:0] = p
    middle = len(p) + first
    suffix = middle + len(m) + second - first
    rotate(buf, 0 if form == SPM else middle, suffix, len(buf))


def rejoin(buf: bytearray, form: str, marks: tuple[bytes, bytes, bytes]) -> None:
    """Undo ``arrange``: the text stands in the buffer again."""
    if form == PLAIN:
        return
    p, m, s = marks
    if form == SPM:
        rotate(buf, 0, buf.index(p), len(buf))
    else:
        rotate(buf, buf.index(s), buf.index(m), len(buf))
    for mark in (s, m, p):
        at = buf.index(mark)
        del buf[at:at + len(mark)]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
                spm_rate: int = 50, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """The id with ``n`` (lines), ``form`` (plain, psm or spm), ``prefix_chars``,
    ``middle_chars`` (code points, null where plain) and ``output``, the text itself.

    Of 100 documents ``rate`` are rearranged, of 100 of these ``spm_rate`` in the order
    suffix, prefix, middle and the others as prefix, suffix, middle. Cuts and form
    depend on the id and ``seed`` alone, so equal ids with different texts draw alike
    and repeated rows give repeated results. A null text is empty; an empty text, and one
    that holds a sentinel, stays plain; a null id draws as an empty one. Texts of any
    length are taken whole; other columns are ignored; an empty table gives no rows.
    """
    marks = check_sentinels(sentinels)
    schema = T.StructType([docs.schema[id_col], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.BinaryType())])

    def one(key: str, raw: bytes):
        ends = line_ends(raw)
        n = len(ends)
        h = draws(f"{seed}:{key}")
        if not raw or any(x in raw for x in marks) or h[2] % 100 >= rate:
            return n, PLAIN, None, None, raw
        form = SPM if h[3] % 100 < spm_rate else PSM
        first, second = (int(ends[i - 1]) if i else 0 for i in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        buf = bytearray(raw)
        chars = code_points(raw[:first]), code_points(raw[first:second])
        arrange(buf, first, second, form, marks)
        return n, form, *chars, bytes(buf)

    def run(batches):
        kind = None

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b

        for ids, keys, raws in slices(typed(), 2):
            cols = list(zip(*(one(key, raw) for key, raw in zip(keys, raws))))
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind)] + [pa.array(c, t) for c, t in zip(cols, types)],
                                             names=schema.names)

    rows = docs.select(F.col(id_col), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__key"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__raw"))
    return rows.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restore(rows: DataFrame, form_col: str = "form", output_col: str = "output", name: str = "restored",
            sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``rows`` with a column ``name``: the text that ``output_col`` was made from, read
    from it and the form alone. A null output or form gives null; any other columns stay."""
    marks = check_sentinels(sentinels)
    if name in rows.columns:
        raise ValueError(f"there is a column {name!r} already")
    at = len(rows.columns)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(rows.schema)]
                          + [T.StructField("back", T.BinaryType())])

    def one(raw, form):
        if raw is None or form is None:
            return None
        buf = bytearray(raw)
        rejoin(buf, form, marks)
        return bytes(buf)

    def run(batches):
        for batch in batches:
            back = []
            for raws, forms in slices([batch.select([at, at + 1])], 0):
                back += map(one, raws, forms)
            yield pa.RecordBatch.from_arrays(batch.columns[:at] + [pa.array(back, pa.binary())], names=schema.names)

    plain = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rows.columns)],
                        F.col(output_col).cast("binary").alias("raw"), F.col(form_col).alias("form"))
    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns)], F.col("back").cast("string").alias(name))
