"""Commit log, versioned publish and step ledger: no shared id, no lost row, nothing half
visible, nothing done twice."""

import glob
import itertools
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from lanecost.plans import ledger as L
from lanecost.sinks import writers as W
from lanecost.sinks.commit_log import CommitLog, HadoopFolder
from lanecost.sinks.versioned import VersionedTable

SF = "/root/testdata/sf0.001"


class Plain:
    """A store without atomic create: a put overwrites whatever is there."""

    def __init__(self):
        self.files = {}

    def names(self):
        return sorted(self.files)

    def read(self, name):
        return self.files[name]

    def put(self, name, text):
        self.files[name] = text

    def delete(self, name):
        del self.files[name]


class Turns:
    """Lets writers make one store operation at a time, in the order of a schedule."""

    def __init__(self, writers):
        self.go = [threading.Semaphore(0) for _ in range(writers)]
        self.at_gate = [threading.Semaphore(0) for _ in range(writers)]
        self.over = [False] * writers

    def store(self, inner, writer):
        turns = self

        class Gated:
            def __getattr__(self, op):
                def call(*args):
                    turns.at_gate[writer].release()
                    turns.go[writer].acquire()
                    return getattr(inner, op)(*args)
                return call
        return Gated()

    def run(self, works, schedule):
        def body(i):
            works[i]()
            self.over[i] = True
            self.at_gate[i].release()
        threads = [threading.Thread(target=body, args=(i,)) for i in range(len(works))]
        for t in threads:
            t.start()
        for g in self.at_gate:
            g.acquire()
        for i in itertools.chain(schedule, itertools.cycle(range(len(works)))):
            if all(self.over):
                break
            if not self.over[i]:
                self.go[i].release()
                self.at_gate[i].acquire()
        for t in threads:
            t.join()


def appended(writers, each, schedule, seed=0):
    claims, entries, turns = Plain(), Plain(), Turns(writers)
    ids = [[] for _ in range(writers)]

    def work(i):
        log = CommitLog(turns.store(claims, i), turns.store(entries, i), random.Random(seed + i))
        return lambda: ids[i].extend(log.append({"row": [i, k]}) for k in range(each))
    turns.run([work(i) for i in range(writers)], schedule)
    return ids, CommitLog(claims, entries).records()


def test_two_writers_in_every_order_share_no_id_and_lose_no_row():
    clashes = 0
    for schedule in itertools.product((0, 1), repeat=9):
        ids, records = appended(2, 1, schedule)
        assert len({n for w in ids for n in w}) == 2
        assert sorted(r["row"] for r in records) == [[0, 0], [1, 0]]
        assert sorted(r["id"] for r in records) == sorted(n for w in ids for n in w)
        clashes += max(n for w in ids for n in w) > 2
    assert clashes      # some orders did make both give way


def test_many_writers_in_random_order():
    rnd = random.Random(1)
    for seed in range(25):
        schedule = [rnd.randrange(4) for _ in range(60)]
        ids, records = appended(4, 3, schedule, seed)
        assert len(records) == len({r["id"] for r in records}) == 12
        assert sorted(r["row"] for r in records) == [[i, k] for i in range(4) for k in range(3)]
        assert all(w == sorted(w) for w in ids)


def test_a_claim_without_a_record_is_never_used_again(spark, tmp_base):
    log = CommitLog.at(spark, f"{tmp_base}/log")
    assert log.append({"a": 1}) == 1
    log._claim("died")
    assert log.append({"a": "é\n"}) == 3
    assert log.records() == [{"a": 1, "id": 1}, {"a": "é\n", "id": 3}]


def test_load_ids_of_writers_at_once_differ(spark, tmp_base):
    audit = f"{tmp_base}/audit"
    threads = [threading.Thread(target=W.append_audit, args=(spark, audit, [f"p{i}", None], i, "SUCCESS")) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = W.read_audit(spark, audit).collect()
    assert len(rows) == len({r.load_id for r in rows}) == 8 and all(r.loaded_at for r in rows)
    assert sorted((r.quarter_label or "", r.row_count) for r in rows) == sorted([(f"p{i}", i) for i in range(4)] + [("", i) for i in range(4)])


SCHEMA = "id long, period string, corridor string"


def quotes(spark, periods, tag="c"):
    return spark.createDataFrame([(i, p, f"{tag}{i}") for i, p in enumerate(periods)], SCHEMA)


def seen(spark, target):
    return sorted((r.period or "", r.corridor) for r in W.read_landing(spark, target, quotes(spark, []).schema).collect())


def test_a_load_that_dies_between_two_periods_changes_nothing_for_readers(spark, tmp_base, monkeypatch):
    schema, target, audit = quotes(spark, []).schema, f"{tmp_base}/t", f"{tmp_base}/a"
    both = ["2016_1Q", "2016_2Q"]
    W.replace_partition_load(spark, quotes(spark, both, "old"), target, both, audit, schema)
    old = seen(spark, target)
    # the second period's rows fail after the first period's were written
    new = quotes(spark, both, "new").coalesce(1)
    bad = new.withColumn("corridor", F.when(F.col("period") == "2016_2Q", F.raise_error(F.lit("killed"))).otherwise(F.col("corridor")))
    with pytest.raises(Exception, match="killed"):
        W.replace_partition_load(spark, bad, target, both, audit, schema)
    assert seen(spark, target) == old

    # the process dies, at any file it would put, after both periods were written
    put, count = HadoopFolder.put, itertools.count()
    for dies_at in range(4):
        count = itertools.count()

        def dying(self, name, text):
            if next(count) == dies_at:
                raise KeyboardInterrupt
            return put(self, name, text)
        monkeypatch.setattr(HadoopFolder, "put", dying)
        try:
            W.replace_partition_load(spark, new, target, both, audit, schema)
        except KeyboardInterrupt:
            pass
        monkeypatch.undo()
        assert seen(spark, target) in (old, [("2016_1Q", "new0"), ("2016_2Q", "new1")])
        assert (seen(spark, target) == old) == (dies_at < 2)   # the record is the second file
    table = VersionedTable(spark, target)
    assert len(table.vacuum(3600)) == 0 and len(table.vacuum(0)) >= 3
    assert seen(spark, target) == [("2016_1Q", "new0"), ("2016_2Q", "new1")]


def test_loads_at_once_of_other_periods_are_all_there(spark, tmp_base):
    schema, target, audit = quotes(spark, []).schema, f"{tmp_base}/t", f"{tmp_base}/a"
    labels = ["2016_1Q", "2016_2Q", "odd/name=x", None]
    df = quotes(spark, labels)
    threads = [threading.Thread(target=W.replace_partition_load, args=(spark, df, target, p, audit, schema)) for p in labels]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert seen(spark, target) == sorted((p or "", f"c{i}") for i, p in enumerate(labels))
    assert max(r.row_count for r in W.read_audit(spark, audit).collect()) == 4


def test_readers_of_a_record_and_pruning(spark, tmp_base):
    table, schema = VersionedTable(spark, f"{tmp_base}/t"), quotes(spark, []).schema
    assert table.read(schema).collect() == [] and table.periods() == [] and table.vacuum(0) == []
    first = table.publish(*table.write_version(quotes(spark, ["a", "b", "b"], "x")))
    table.publish(*table.write_version(quotes(spark, ["b"], "y")))
    assert sorted(r.corridor for r in table.read(schema).collect()) == ["x0", "y0"]
    assert sorted(r.corridor for r in table.read(schema, upto=first).collect()) == ["x0", "x1", "x2"]
    assert table.rows() == 2 and table.read(schema).schema == schema
    one = table.read(schema).filter("period = 'b'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and one.count() == 1


# --- ledger

def test_content_fingerprint_follows_rows_only(spark):
    a = spark.range(50).selectExpr("id", "cast(id % 7 as string) as s")
    mark = L.content_fingerprint(a)
    assert L.content_fingerprint(a.repartition(5).orderBy(F.desc("id"))) == mark
    assert L.content_fingerprint(a.unionByName(a.limit(1))) != mark
    assert L.content_fingerprint(a.withColumn("s", F.when(F.col("id") > 0, F.col("s")))) != mark
    assert L.content_fingerprint(a.withColumn("id", F.col("id").cast("int"))) != mark
    assert L.content_fingerprint(a.limit(0)) == L.content_fingerprint(a.filter("false"))


def test_ledger_runs_a_step_again_only_for_cause(spark, tmp_base):
    book, out, runs = L.Ledger(spark, f"{tmp_base}/ledger"), f"{tmp_base}/out", []

    def work():
        runs.append(1)
        spark.range(3).write.mode("overwrite").parquet(out)

    def run(key, reads):
        return book.run("step", key, reads, [out], work)
    mark = run("p", ["x"])
    assert run("p", ["x"]) == mark and len(runs) == 1
    run("p", ["y"])
    assert len(runs) == 2
    run("q", ["y"])
    assert len(runs) == 3
    os.remove(glob.glob(f"{out}/*.parquet")[0])
    run("q", ["y"])
    assert len(runs) == 4

    def broken():
        raise OSError
    with pytest.raises(OSError):
        book.run("step", "r", ["z"], [out], broken)
    assert book.last("step", "r") is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared test data not present")
def test_rerun_after_a_failed_load_goes_on_with_the_load(spark, tmp_base):
    from lanecost.plans.incremental import incremental_period_run, paths
    from lanecost.sources.fixtures import wide_quotes
    drop = wide_quotes(spark, SF)
    p = paths(tmp_base)

    def files():
        return {f: os.stat(f).st_mtime_ns for of in (p["raw"], p["curated"]) for f in glob.glob(f"{of}/**/*.parquet", recursive=True)}

    def broken(*args, **kwargs):
        raise OSError("injected")
    with pytest.raises(OSError):
        incremental_period_run(spark, drop, tmp_base, load=broken)
    before = files()
    assert before
    with pytest.raises(OSError):
        incremental_period_run(spark, drop, tmp_base, load=broken)
    assert files() == before
    # a drop that changed is taken anew
    changed = drop.withColumn("firm", F.concat("firm", F.lit("!")))
    label, total = incremental_period_run(spark, changed, tmp_base)
    assert not set(files()) & {f for f in before if "/raw/" in f or "/clean/" in f}
    landed = W.read_landing(spark, p["landing"])
    assert landed.count() == total > 0 and landed.filter("firm not like '%!'").count() == 0
    assert [r["step"] for r in L.Ledger(spark, p["ledger"]).log.records()] == ["ingest", "curate", "report"] * 2
    assert incremental_period_run(spark, changed, tmp_base)[0] < label


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared test data not present")
def test_stream_calls_go_on_and_a_foreign_checkpoint_is_refused(spark, tmp_base):
    from lanecost.plans import flows
    from lanecost.sources.fixtures import wide_quotes
    from lanecost.streaming.drop_watch import stream_period_loads
    w = wide_quotes(spark, SF).filter("period in ('1995_1Q', '1995_2Q')")
    drop, base = f"{tmp_base}/drop", f"{tmp_base}/out"
    for part in (0, 1):
        w.filter(F.pmod("id", F.lit(2)) == part).write.mode("append").parquet(drop)
        stream_period_loads(spark, drop, w.schema, base)
    want = flows.curate(w)[0].count()
    assert W.read_landing(spark, f"{base}/landing").count() == want > 0
    with pytest.raises(ValueError, match="another checkpoint"):
        stream_period_loads(spark, drop, w.schema, base, checkpoint=f"{tmp_base}/new")
    os.rename(f"{base}/checkpoint", f"{tmp_base}/gone")
    with pytest.raises(ValueError, match="another checkpoint"):
        stream_period_loads(spark, drop, w.schema, base)
    assert W.read_landing(spark, f"{base}/landing").count() == want
