"""End-to-end jobs: dictionary + codelist sources -> codelist; records ->
mentions; mentions -> features and categories.

Each stage writes its result (to a given location, or to the cluster's
shared checkpoint folder) and the next stage reads that table back. A lost
executor therefore costs a re-read of the last written stage, never a replay
of the whole history, and the summaries that follow a stage share one
computation of it instead of re-running its plan once per count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from phenospark.operators import catalog as catalog_ops
from phenospark.operators import categories as category_ops
from phenospark.operators import features, summary
from phenospark.operators.codelist import build_codelist
from phenospark.operators.mentions import mentions as build_mentions
from phenospark.sinks import materialise, write_and_read


@dataclass
class WorkflowInputs:
    """What the workflow reads. ``codes`` is ``source, code`` (see
    :func:`phenospark.sources.codelists.read_code_files`); ``narrow`` and
    ``wide`` are record adapters' outputs (``narrow_records`` /
    ``wide_records``)."""

    dictionary: DataFrame
    codes: DataFrame
    narrow: DataFrame | None
    wide: DataFrame | None
    categories: DataFrame
    abbreviations: DataFrame
    table_prefix: str = catalog_ops.DEFAULT_TABLE_PREFIX
    database: str | None = None


def _keep(df: DataFrame, name: str, out_root: str | None) -> DataFrame:
    if out_root is None:
        return materialise(df, name)
    return write_and_read(df, f"{out_root.rstrip('/')}/{name}")


def codelist_stage(inputs: WorkflowInputs, out_root: str | None = None) -> dict[str, DataFrame]:
    catalog = _keep(
        catalog_ops.to_catalog(inputs.dictionary, inputs.table_prefix, inputs.database),
        "catalog", out_root,
    )
    codelist = _keep(build_codelist(catalog, inputs.codes), "codelist", out_root)
    return {"catalog": catalog, "codelist": codelist}


def mentions_stage(
    codelist: DataFrame, inputs: WorkflowInputs, out_root: str | None = None
) -> dict[str, DataFrame]:
    mentions = build_mentions(codelist, narrow=inputs.narrow, wide=inputs.wide)
    return {"mentions": _keep(mentions, "mentions", out_root)}


def feature_stage(
    mentions: DataFrame, out_root: str | None = None, codelist: DataFrame | None = None
) -> dict[str, DataFrame]:
    """One shuffle of the mentions (the per-code summary, written), then the
    features from that smaller table; with ``codelist``, also the flag matrix
    with one column per codelist phenotype (a fixed schema, whatever the
    records hold)."""
    per_code = _keep(features.code_summary(mentions), "code_summary", out_root)
    derived = features.features_from_summary(per_code)
    out = {name: _keep(df, name, out_root) for name, df in derived.items()}
    if codelist is not None:
        out["flag_matrix"] = _keep(
            features.flag_matrix(per_code, phenotypes=features.phenotype_names(codelist)), "flag_matrix", out_root)
    return out


def category_stage(
    mentions: DataFrame, inputs: WorkflowInputs, out_root: str | None = None
) -> dict[str, DataFrame]:
    mapping = _keep(
        category_ops.build_mapping(inputs.categories, inputs.abbreviations), "category_mapping", out_root
    )
    categorised = _keep(category_ops.categorise(mentions, mapping), "mentions_categorised", out_root)
    return {"category_mapping": mapping, "mentions_categorised": categorised}


def run_workflow(inputs: WorkflowInputs, out_root: str | None = None) -> dict[str, DataFrame]:
    """All stages in order; returns every written table (read back) plus the
    summary frames computed from them."""
    out = codelist_stage(inputs, out_root)
    out.update(mentions_stage(out["codelist"], inputs, out_root))
    out.update(feature_stage(out["mentions"], out_root, codelist=out["codelist"]))
    out.update(category_stage(out["mentions"], inputs, out_root))
    out["codelist_totals"] = summary.codelist_totals(out["codelist"])
    out["mentions_totals"] = summary.coverage(out["mentions"])
    out["category_sizes"] = summary.category_sizes(out["category_mapping"])
    out["codes_per_category"] = summary.codes_per_category(out["mentions_categorised"])
    return out
