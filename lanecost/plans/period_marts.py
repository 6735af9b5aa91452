"""Marts kept up to date period by period, without a rebuild from all rows.

The rows of a period are modelled once, when it is loaded. Three marts are rows or groups
of one period each, so the load replaces that period's part of them. The scorecard spans
all periods: of a period only its counts per firm, corridor and quarter are kept
(``scorecard_state``), dealt to buckets by firm, and a load adds up the states of the
buckets that its firms are in. Reloading a period replaces its states, so nothing has to
be subtracted; a load without rows takes the period out.

All parts of a load become visible by one record in one log (see ``VersionedTable``): a
reader sees the four marts of before or of after it. The record also names, for each
bucket, the states its scorecard rows were made of. Where these are not the states in
force, as another load came between, the reader adds up that bucket itself; loads of
different periods may therefore run side by side.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.functions.expr import col
from lanecost.operators import marts as M
from lanecost.plans.flows import LazyFrames, ModelConfig
from lanecost.session import materialized
from lanecost.sinks.commit_log import CommitLog
from lanecost.sinks.versioned import VersionedTable

SLOT = "__slot"
STATES, SCORECARD = "scorecard_states", "transparency_scorecard"
BY_PERIOD = ("corridor_cost_trends", "provider_comparison", "spotlight")


class _Share:
    """What the records common to all marts say about one of them, as a log to read."""

    def __init__(self, records: Iterable[Mapping], name: str):
        self._own = [{"id": r["id"], **r["tables"][name]} for r in records if name in r["tables"]]

    def records(self) -> list[dict]:
        return self._own


class PeriodMarts:
    """The marts under ``base``. ``buckets`` is fixed by the first load."""

    def __init__(self, spark: SparkSession, base: str, cfg: ModelConfig = ModelConfig(), buckets: int = 16):
        self.spark, self.base, self.cfg = spark, base.rstrip("/"), cfg
        self.log = CommitLog.at(spark, f"{self.base}/_loads")
        self._buckets = buckets

    # ---- slots: the parts of a table that are replaced one by one ------------------

    @staticmethod
    def _slot(*parts) -> str:
        return json.dumps(parts, separators=(",", ":"))

    def _bucketed(self, df: DataFrame, buckets: int, period: Iterable[str | None] = ()) -> DataFrame:
        """A slot ``[period, bucket]`` or ``[bucket]``, by the firm."""
        head = "".join(json.dumps(p) + "," for p in period)
        at = F.pmod(F.xxhash64(col("firm"), col("firm_type")), F.lit(buckets))
        return df.withColumn(SLOT, F.concat(F.lit("[" + head), at.cast("string"), F.lit("]")))

    def _table(self, name: str, records: Iterable[Mapping]) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.base}/{name}", SLOT, log=_Share(records, name))

    def _schema(self, name: str, records: list[dict]) -> T.StructType:
        return T.StructType.fromJson(next(
            r["tables"][name]["schema"] for r in reversed(records) if name in r["tables"]))

    def _states_in_force(self, records: list[dict]) -> dict[int, list[tuple[str, str]]]:
        """bucket -> its states, as (slot, version)."""
        out: dict[int, list[tuple[str, str]]] = {}
        for slot, (version, n) in sorted(self._table(STATES, records).state().items()):
            if n:
                out.setdefault(json.loads(slot)[-1], []).append((slot, version))
        return out

    @staticmethod
    def _fingerprint(states: list[tuple[str, str]]) -> str:
        return hashlib.sha256(json.dumps(states).encode()).hexdigest()

    def _merged(self, records: list[dict], buckets: Iterable[int]) -> DataFrame:
        """Scorecard rows of ``buckets``; no state of another bucket is read."""
        in_force = self._states_in_force(records)
        slots = [s for b in buckets for s, _ in in_force.get(b, [])]
        states = self._table(STATES, records).read(self._schema(STATES, records), slots)
        return M.scorecard_of_states(states, self.cfg.min_sample)

    # ---- load and read -----------------------------------------------------------------

    def load(self, flagged: DataFrame, period: str | None) -> int:
        """Replace the share of ``period`` by its flagged rows, all of which must be given;
        the id of the record that made them visible. Rows of more than one quarter, or of
        one that another period holds, are refused: groups of the trend mart would be
        split between periods."""
        records = self.log.records()
        buckets = records[0]["buckets"] if records else self._buckets
        rows = materialized(flagged, "period_rows")
        quarters = [list(r) for r in rows.select("period_year", "period_quarter").distinct().limit(2).collect()]
        if len(quarters) > 1:
            raise ValueError(f"rows of several quarters in period {period!r}")
        held = {r["period"]: r["quarters"] for r in records}
        other = [p for p, q in held.items() if p != period and q and q == quarters]
        if other:
            raise ValueError(f"period {other[0]!r} holds the quarter of {period!r}")

        built = {
            "corridor_cost_trends": M.corridor_cost_trends(
                rows, self.cfg.approx_median, self.cfg.ranged_median, stored=True),
            "provider_comparison": M.provider_comparison(rows),
            "spotlight": M.spotlight(rows, self.cfg.spotlight_country),
        }
        tables = {n: self._write(n, df.withColumn(SLOT, F.lit(self._slot(period))), [self._slot(period)])
                  for n, df in built.items()}
        old = [s for s in self._table(STATES, records).state() if json.loads(s)[0] == period]
        tables[STATES] = self._write(STATES, self._bucketed(M.scorecard_state(rows), buckets, [period]), old)
        touched = sorted({json.loads(s)[-1] for s, _ in tables[STATES]["periods"]})
        record = {"period": period, "quarters": quarters, "buckets": buckets, "tables": tables}
        after = [*records, record | {"id": None}]
        scorecard = self._bucketed(self._merged(after, touched), buckets)
        in_force = self._states_in_force(after)
        tables[SCORECARD] = self._write(SCORECARD, scorecard, [self._slot(b) for b in touched]) | {
            "made_of": {str(b): self._fingerprint(in_force.get(b, [])) for b in touched}}
        return self.log.append(record)

    def _write(self, name: str, df: DataFrame, replaced: Iterable[str]) -> dict:
        """A version of ``name`` and what a record says of it; slots of ``replaced`` that
        have no rows any more are empty from then on."""
        version, counts = self._table(name, []).write_version(df)
        counts = {s: 0 for s in replaced} | counts
        return {"version": version, "periods": [[s, n] for s, n in counts.items()],
                "schema": df.schema.jsonValue()}

    def stale_buckets(self, records: list[dict] | None = None) -> list[int]:
        """Buckets whose stored scorecard rows are not those of the states in force."""
        records = self.log.records() if records is None else records
        made_of: dict[str, str] = {}
        for r in records:
            made_of.update(r["tables"][SCORECARD]["made_of"])
        in_force = self._states_in_force(records)
        return [b for b in sorted({int(b) for b in made_of} | set(in_force))
                if made_of.get(str(b)) != self._fingerprint(in_force.get(b, []))]

    def marts(self) -> Mapping[str, DataFrame]:
        """The marts as the last record left them, as ``build_marts`` over the rows of all
        loaded periods would give them. Raises where nothing was ever loaded."""
        records = self.log.records()
        if not records:
            raise ValueError(f"no period was loaded into {self.base}")

        def read(name: str, slots=None) -> DataFrame:
            return self._table(name, records).read(self._schema(name, records), slots).drop(SLOT)

        def scorecard() -> DataFrame:
            stale = self.stale_buckets(records)
            if not stale:
                return read(SCORECARD)
            stored = [s for s in self._table(SCORECARD, records).state() if json.loads(s)[0] not in stale]
            return read(SCORECARD, stored).unionByName(self._merged(records, stale))

        return LazyFrames({**{n: (lambda n=n: read(n)) for n in BY_PERIOD}, SCORECARD: scorecard})
