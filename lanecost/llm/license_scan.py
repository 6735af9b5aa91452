"""Licence scan: base phrases and template-markup matching.

A template is licence wording with marked regions: ``<<opt>> ... <</opt>>`` may be
absent, ``<<var:n>>`` stands for up to n words of any kind, and
``<<any>> a <<or>> b <</any>>`` takes one of its branches. Each template is compiled to an
automaton over words, and a text is accepted where all mandatory wording follows
word for word, to the template's last word. Matching starts only where the words before a
template's first mark (four at most) stand, so a text without them costs one substring
search a template.

Whole licences and whole notices are sure; a licence named in a few words is less so; the
opening of a licence without the rest of its mandatory wording (a clause changed, cut or
put in) is reported as ``<label>-partial`` and counts least. The wordings are in
``license_texts``.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from lanecost.llm.license_texts import MENTIONS, NOTICES, OPENINGS, TEXTS
from lanecost.llm.util import slices

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# (score, what is added to the label, label -> wordings), the surest first.
KINDS = ((1.0, "", TEXTS), (1.0, "", NOTICES), (0.75, "", MENTIONS), (0.25, "-partial", OPENINGS))
BASE_SCORE = 0.5

_MARK = re.compile(r"<<(/?\w+)(?::(\d+))?>>")
_LOWER_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """ASCII upper case lowered; runs of ASCII letters and digits and of anything beyond ASCII."""
    return text.encode("utf-8", "replace").lower().translate(_LOWER_WORD).split()


class Automaton:
    """States with word edges, any-word edges and free edges; state 0 starts, ``final`` accepts."""

    def __init__(self, markup: str):
        self.word: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        self.lead: list[bytes] = []      # mandatory words before the first marked region
        parts, at = [], 0
        for m in _MARK.finditer(markup):
            parts += [("word", w) for w in words_of(markup[at:m.start()])]
            parts.append((m[1], m[2]))
            at = m.end()
        parts += [("word", w) for w in words_of(markup[at:])]
        for kind, w in parts:
            if kind != "word":
                break
            self.lead.append(w)
        if not self.lead:
            raise ValueError(f"a template has to start with a mandatory word: {markup!r}")
        self._parts, self._at = parts, 0
        self.final = self._sequence(0, ())
        if self._at < len(parts):
            raise ValueError(f"unbalanced mark in template: {markup!r}")

    def _state(self) -> int:
        self.word.append({})
        self.any.append(None)
        self.free.append([])
        return len(self.word) - 1

    def _sequence(self, state: int, until: tuple) -> int:
        while self._at < len(self._parts):
            kind, value = self._parts[self._at]
            if kind in until:
                return state
            self._at += 1
            nxt = self._state()
            if kind == "word":
                self.word[state][value] = nxt
            elif kind == "var":
                for _ in range(int(value or 1)):
                    self.free[state].append(nxt)
                    step = self._state()
                    self.any[state] = step
                    state = step
                self.free[state].append(nxt)
            elif kind == "opt":
                inner = self._state()
                self.free[state] += [inner, nxt]
                self.free[self._sequence(inner, ("/opt",))].append(nxt)
                self._close("/opt")
            elif kind == "any":
                while True:
                    branch = self._state()
                    self.free[state].append(branch)
                    self.free[self._sequence(branch, ("or", "/any"))].append(nxt)
                    if self._close("or", "/any") == "/any":
                        break
            else:
                raise ValueError(f"unknown mark <<{kind}>>")
            state = nxt
        return state

    def _close(self, *wanted: str) -> str:
        if self._at >= len(self._parts) or self._parts[self._at][0] not in wanted:
            raise ValueError(f"template lacks one of {wanted}")
        self._at += 1
        return self._parts[self._at - 1][0]

    def _reach(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def match(self, words: list[bytes], start: int) -> int | None:
        """End of the longest match that starts there, or None."""
        now, end, i = self._reach({0}), None, start
        while now:
            if self.final in now:
                end = i
            if i >= len(words):
                break
            step = {t for s in now if (t := self.word[s].get(words[i])) is not None}
            step |= {t for s in now if (t := self.any[s]) is not None}
            now, i = self._reach(step), i + 1
        return end


class Scanner:
    def __init__(self, kinds, base: dict[str, str]):
        self.base = [(tuple(p.encode().split()), label) for p, label in base.items()]
        self.automata = [(label, score, suffix, Automaton(t)) for score, suffix, templates in kinds
                         for label, many in templates.items() for t in many]
        self.leads = [b" " + b" ".join(a.lead[:4]) + b" " for *_, a in self.automata]

    @staticmethod
    def _places(joined: bytes, needle: bytes):
        """Word index of each place where the needle (blank at both ends) stands."""
        at, seen, index = joined.find(needle), 0, 0
        while at >= 0:
            index += joined.count(b" ", seen, at)
            seen = at
            yield index
            at = joined.find(needle, at + 1)

    def scan(self, text: str) -> tuple:
        """(n_words, n_base, first_word, last_word, base labels, labels, score, spans)"""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for phrase, label in self.base:
            found = list(self._places(joined, b" " + b" ".join(phrase) + b" "))
            if found:
                places += found
                base.add(label)
        spans, best = [], BASE_SCORE if base else 0.0
        for (label, score, suffix, automaton), lead in zip(self.automata, self.leads):
            for i in self._places(joined, lead):
                end = automaton.match(words, i)
                if end is not None and end > i and not (suffix and any(a <= i and end <= b for a, b, *_ in spans)):
                    spans.append((i, end, label + suffix))
                    best = max(best, score)
        found = base | {s[2] for s in spans}
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                ",".join(sorted(found)), best, sorted(spans))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  kinds=KINDS, base: dict[str, str] | None = None) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_base`` (places of base phrases),
    ``first_word`` and ``last_word`` (their smallest and largest start), ``base_labels`` and
    ``labels`` (distinct, sorted, comma-joined; empty if none), ``score`` (1 a whole text or
    notice, 0.75 a licence named with its version, 0.5 base phrases only, 0.25 an opening
    only, 0 nothing) and ``spans`` (template matches: first word, end, label).

    A null text is empty. Texts of any length are scanned whole, repeated rows alike, other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    base = base or BASE
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType())])
    schema = T.StructType([docs.schema[id_col]] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
                          + [T.StructField(c, T.StringType()) for c in ("base_labels", "labels")]
                          + [T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    arrow = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))]

    def run(batches):
        scanner = Scanner(kinds, base)
        for batch in batches:
            rows = []
            for (texts,) in slices([batch.select([1])], 0):
                for t in texts:
                    *head, spans = scanner.scan(t or "")
                    rows.append((*head, [{"start": a, "end": b, "label": c} for a, b, c in spans]))
            cols = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, arrow)], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
