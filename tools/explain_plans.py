"""Write PLANS.md: the physical plans of the core stages on written inputs.

    python tools/explain_plans.py [/root/testdata/sf0.1]

Inputs are derived from the star schema and written first (as real inputs
would be stored), so each plan starts at parquet scans. Only the operator
lines of each plan are kept (scans abbreviated), which is enough to read
where the exchanges and broadcasts are.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from phenospark.operators import categories as category_ops  # noqa: E402
from phenospark.operators import features, history, sketches, sparse, summary  # noqa: E402
from phenospark.operators.catalog import to_catalog  # noqa: E402
from phenospark.operators.codelist import build_codelist  # noqa: E402
from phenospark.operators.mentions import mentions, narrow_records, wide_records  # noqa: E402
from phenospark.session import local_session  # noqa: E402
from phenospark.sinks import write_and_read, write_table  # noqa: E402
from phenospark.sources.starschema import (  # noqa: E402
    DIAG_SLOTS,
    OPERTN_SLOTS,
    SOURCE_DATABASE,
    SOURCE_PREFIX,
    StarSchema,
)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    lines = []
    for line in buf.getvalue().splitlines():
        if not line.strip() or line.startswith("=="):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"(FileScan parquet) \[([^\]]*)\].*", r"\1 [\2]", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        lines.append(line[:160])
    return "\n".join(lines)


def pruning_report(spark, m, root: str, files: int = 64) -> list[str]:
    """Share of a written table's bytes in files whose span of a key holds a value of
    it, on average over the key's values: what a filter on one value has to read."""
    keys = ["person_id_deid", "code", "phenotype"]
    out = [f"## Bytes read by a filter on one value of a key ({files} files)", "", "| layout | person | code | phenotype |", "| --- | --- | --- | --- |"]
    for name, how in (("clustered by person", {"cluster_by": keys}), ("Z-ordered by the three", {"zorder_by": keys})):
        path = f"{root}/{name.replace(' ', '_')}"
        write_table(m, path, partitions=files, **how)
        table, shares = spark.read.parquet(path), []
        for key in keys:
            size = F.first("_metadata.file_size").alias("bytes")
            spans = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), size)
            values = table.select(key).distinct()
            read = values.join(spans, F.col(key).between(F.col("lo"), F.col("hi")), "left").groupBy(key).agg(F.sum("bytes").alias("bytes"))
            total = spans.agg(F.sum("bytes")).first()[0]
            shares.append(read.agg(F.avg("bytes")).first()[0] / total)
        out.append(f"| {name} | " + " | ".join(f"{100 * x:.0f} %" for x in shares) + " |")
    return [*out, ""]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="phenospark-plans-", dir="/tmp")
    s = StarSchema(spark, sf_dir)
    narrow = write_and_read(narrow_records(s.narrow(), person="person_id", date="dt", code="code"),
                            f"{root}/narrow")
    wide_in = write_and_read(s.wide(), f"{root}/wide")
    codelist = write_and_read(s.codelist(), f"{root}/codelist")
    dictionary = write_and_read(s.dictionary(), f"{root}/dictionary")
    sources = write_and_read(s.sources().withColumnRenamed("stem", "source"), f"{root}/sources")
    categories = write_and_read(s.categories(), f"{root}/categories")
    abbreviations = write_and_read(s.abbreviations(), f"{root}/abbreviations")
    wide = wide_records(wide_in, person="person_id", date="dt",
                        slots={"ICD": DIAG_SLOTS, "OPCS": OPERTN_SLOTS})
    m = write_and_read(mentions(codelist, narrow=narrow, wide=wide), f"{root}/mentions")
    mapping = write_and_read(category_ops.build_mapping(categories, abbreviations), f"{root}/mapping")

    by = ["terminology", "year"]
    dictionary_of = write_and_read(sparse.phenotype_dictionary(codelist), f"{root}/phenotypes")
    person_ids = write_and_read(sparse.person_rows(m, dictionary_of), f"{root}/person_ids")

    sections = [
        ("Codelist build: catalog x all sources",
         build_codelist(to_catalog(dictionary, SOURCE_PREFIX, SOURCE_DATABASE), sources)),
        ("Mentions (codelist fits: broadcast semi join, one exchange, broadcast join)",
         mentions(codelist, narrow=narrow, wide=wide)),
        ("Mentions, codelist over the broadcast bound (Bloom filter of its keys below the exchange, salted join)",
         mentions(codelist, narrow=narrow, wide=wide, max_broadcast_bytes=0)),
        ("Raw (bag) mentions", mentions(codelist, narrow=narrow, wide=wide, deduplicate=False)),
        ("First dates", features.first_dates(m)),
        ("Per-code summary (the one shuffle behind all per-person features)", features.code_summary(m)),
        ("First date and occurrences per phenotype, from the summary", features.features_from_summary(
            write_and_read(features.code_summary(m), f"{root}/code_summary"))["features_by_phenotype"]),
        ("All counts of the mentions stage", summary.mention_volumes(codelist, narrow, wide)),
        ("Flag matrix", features.flag_matrix(m)),
        ("Sparse person rows (phenotype ids)", sparse.person_rows(m, dictionary_of)),
        ("Flag cells from the sparse rows", sparse.cells(person_ids, dictionary_of)),
        ("History of mention dates (one delivery)", history.code_history(m)),
        ("Coverage of cuts from stored sketches", sketches.coverage_of_cuts(
            write_and_read(sketches.sketch_coverage(m.withColumn("year", F.year("date")), by), f"{root}/sketches"), [["year"], []], by)),
        ("Coverage (exact distinct counts)", summary.coverage(m)),
        ("Categorise (left join, checked broadcast)", category_ops.categorise(m, mapping)),
        ("Codes per category", summary.codes_per_category(category_ops.categorise(m, mapping))),
    ]
    out = ["# Physical plans of the core stages",
           "",
           f"Generated by `tools/explain_plans.py` on inputs derived from `{sf_dir}` and",
           "written as parquet first. AQE is on, so each plan shows the initial",
           "strategy; broadcast sizes were checked by the library before planning.",
           ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    out += pruning_report(spark, m, root)
    target = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(target, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
