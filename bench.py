"""Benchmark the headline operators.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``; every query is fully executed (noop sink, no collect) once as a
warm-up and three times timed; the median is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revisa.operators import changes as ch  # noqa: E402
from revisa.operators import revision as rv  # noqa: E402
from revisa.plans import fixtures as fx  # noqa: E402
from revisa.session import local_session  # noqa: E402

B = fx.B_SPEC


def b_frames(spark, sf_dir):
    """Prepared baseline and edit, rows with a key only (all these queries join on the key)."""
    o = fx.big_original(spark, sf_dir)
    u = fx.big_updated(spark, sf_dir, o)
    return rv.prepare(o, B, keyed_only=True), rv.prepare(u, B, keyed_only=True)


def q_updatable_changes(spark, sf_dir):
    o, u = b_frames(spark, sf_dir)
    return rv.updatable_changes(o, u, B)


def q_row_change_summary(spark, sf_dir):
    o, u = b_frames(spark, sf_dir)
    return rv.row_change_summary(o, u, B)


def q_keys_missing(spark, sf_dir):
    o = fx.big_original(spark, sf_dir)
    u = fx.big_updated(spark, sf_dir, o)
    return rv.keys_missing(rv.key_frame(o, B), rv.key_frame(u, B))


def q_apply_updates(spark, sf_dir):
    o, u = b_frames(spark, sf_dir)
    return ch.apply_updates(ch.stored_table(o, B), ch.update_entries(o, u, B), B)


def _registered(key):
    def run(spark, sf_dir):
        from revisa.plans import registry

        registry.load_all()
        return registry.QUERIES[key](spark, sf_dir)

    return run


BENCH = {
    "updatable_changes": q_updatable_changes,
    "row_change_summary": q_row_change_summary,
    "keys_missing": q_keys_missing,
    "apply_updates": q_apply_updates,
    "segment_change_class": _registered("segment_change_class"),
    "cell_diff": _registered("cell_diff"),
    "token_reuse_new": _registered("token_reuse_new"),
    "check_revision": _registered("check_revision"),
    "change_set_stages": _registered("change_set_stages"),
}


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="revisa-bench")
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    times = {}
    for name, fn in BENCH.items():
        if only and name not in only:
            continue
        try:
            run_once(spark, fn, sf_dir)
            times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(3)), 3)
        except KeyError:
            continue
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "sum_median_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
