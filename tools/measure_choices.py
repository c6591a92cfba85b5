"""Measure the library-level plan choices on written inputs (median of N runs).

    python tools/measure_choices.py [/root/testdata/sf0.1] [reps]

1. wide-record melt: filtered array + inline (Generate) vs unpivot (Expand) + filter
2. deduplicated mentions: dedup of matched records before the phenotype join
   vs dedup of the joined mentions
3. several counts from one written mention table vs re-running the plan
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from phenospark.operators.mentions import (  # noqa: E402
    dedup,
    match,
    mentions,
    narrow_records,
    unite,
    wide_records,
)
from phenospark.operators.summary import codes_per_phenotype, coverage  # noqa: E402
from phenospark.session import local_session  # noqa: E402
from phenospark.sinks import write_table  # noqa: E402
from phenospark.sources.starschema import DIAG_SLOTS, OPERTN_SLOTS, StarSchema  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    reps = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    spark = local_session(8, shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="phenospark-measure-", dir="/tmp")
    s = StarSchema(spark, sf_dir)
    write_table(narrow_records(s.narrow(), person="person_id", date="dt", code="code"), f"{root}/narrow")
    write_table(s.wide(), f"{root}/wide")
    write_table(s.codelist(), f"{root}/codelist")
    narrow = spark.read.parquet(f"{root}/narrow")
    wide = spark.read.parquet(f"{root}/wide")
    codelist = spark.read.parquet(f"{root}/codelist")
    slots = {"ICD": DIAG_SLOTS, "OPCS": OPERTN_SLOTS}

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def median(fn):
        fn()  # warm
        times = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        return round(statistics.median(times), 3)

    def melt(method):
        return wide_records(wide, person="person_id", date="dt", slots=slots, method=method)

    out = {
        "melt_generate": median(lambda: noop(melt("generate"))),
        "melt_unpivot": median(lambda: noop(melt("unpivot"))),
        "mentions_dedup_records_first": median(
            lambda: noop(mentions(codelist, narrow=narrow, wide=melt("generate")))),
        "mentions_dedup_after_join": median(
            lambda: noop(dedup(unite(match(narrow, codelist.distinct(), "SNOMEDCT", broadcast=True),
                                     match(melt("generate"), codelist.distinct(), broadcast=True))))),
    }

    def recount():
        m = mentions(codelist, narrow=narrow, wide=melt("generate"))
        coverage(m).collect()
        codes_per_phenotype(m).collect()

    def written():
        write_table(mentions(codelist, narrow=narrow, wide=melt("generate")), f"{root}/m")
        m = spark.read.parquet(f"{root}/m")
        coverage(m).collect()
        codes_per_phenotype(m).collect()

    out["two_counts_rerun_plan"] = median(recount)
    out["two_counts_from_written"] = median(written)
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
