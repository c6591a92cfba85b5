"""Reference-shaped inputs derived from the driver's star-schema tables.

The workflow's real inputs (patient records, codelist files, a clinical
dictionary) are private, so the contract queries run on tables that Spark
derives from ``orders, lineitem, part, supplier, nation, region, events``.
Each derivation is a plain DataFrame plan over the whole tables, so its work
grows with them. Definitions (see FIXTURES.md, section B):

* ``narrow``      — events as primary-care records: ``person_id, dt, code``.
* ``wide``        — one row per order with 7 diagnosis slots (``'P'`` + part
                    key of line i) and 7 operation slots (``'S'`` + supplier
                    key of line i).
* ``codes``       — a raw codelist over three terminologies (ICD from parts,
                    OPCS from suppliers, SNOMEDCT from groups of four parts).
* ``categories``, ``abbreviations``, ``dictionary``, ``sources``,
  ``two_codes`` — the category list, its abbreviations, the wide dictionary,
  the codelist files as ``(stem, code)`` and a two-code-column source.
"""

from __future__ import annotations

from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenospark.functions.names import normalise_name
from phenospark.operators.codelist import tidy_codes

# Lines per order in the driver's lineitem table (l_linenumber 1..7): the
# number of slots per family in the wide fixture.
WIDE_SLOTS = 7
DIAG_SLOTS = tuple(f"diag_{i:02d}" for i in range(1, WIDE_SLOTS + 1))
OPERTN_SLOTS = tuple(f"opertn_{i:02d}" for i in range(1, WIDE_SLOTS + 1))

# Prefix and database of the derived codelist catalog (stems of ``sources``).
SOURCE_PREFIX = "codes_"
SOURCE_DATABASE = "codelists"


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


#: Digits that a key may have to be ranked by :func:`_text_rank`.
RANK_DIGITS = 17


def _text_rank(key: str, width: int) -> F.Column:
    """A number that orders non-negative whole numbers of up to ``width`` digits as
    their decimal texts are ordered: the digits, filled up on the right, then how many."""
    digits = _s(key)
    return F.shiftleft(F.rpad(digits, width, "0").cast("bigint"), 5) + F.length(digits)


def _ranked_text(rank: str, width: int) -> F.Column:
    """The decimal text of a :func:`_text_rank`."""
    digits = F.lpad(_s(F.shiftright(rank, 5)), width, "0")
    return F.substr(digits, F.lit(1), F.col(rank).bitwiseAND(F.lit(31)).cast("int"))


_READERS: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def _once(method):
    """Build a fixture's plan once per :class:`StarSchema` (plans are lazy;
    this only saves re-analysing the same plan for every use)."""

    @wraps(method)
    def cached(self, *args):
        key = (method.__name__, *args)
        if key not in self._plans:
            self._plans[key] = method(self, *args)
        return self._plans[key]

    return cached


class StarSchema:
    """Loads the driver tables of one scale factor and derives the fixtures."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._plans: dict = {}

    def table(self, name: str) -> DataFrame:
        """A driver table. Its (lazy) reader is shared by every query of the
        same session, so the file listing and footer read happen once."""
        key = (id(self.spark), f"{self.sf_dir}/{name}.parquet")
        entry = _READERS.get(key)
        if entry is None or entry[0] is not self.spark:
            entry = (self.spark, self.spark.read.parquet(key[1]))
            _READERS[key] = entry
        return entry[1]

    # -- records -----------------------------------------------------------
    @_once
    def narrow(self) -> DataFrame:
        ev = self.table("events")
        code = _s(F.floor(F.col("value") * 25).cast("bigint"))
        return ev.select(
            F.col("user_id").alias("person_id"),
            F.col("ts").cast("date").alias("dt"),
            code.alias("code"),
        )

    @_once
    def wide(self) -> DataFrame:
        """Lines are reduced per order before the join (a partial aggregate, so
        a hot order key is collapsed map-side), then attached to their order;
        the final grouping runs on the join's partitioning. The least code of a slot
        is found by its keys' :func:`_text_rank`, so the aggregates hold numbers
        (hashed, not sorted), where every key has one; else by the texts. A line's two
        slots stand side by side and the numbers are no wider than the keys need, so that
        the rows compress well in the exchange."""
        li = self.table("lineitem")
        ln = F.col("l_linenumber")
        families = {"l_partkey": DIAG_SLOTS, "l_suppkey": OPERTN_SLOTS}
        widths = self._rank_widths(li, *families)
        rank = {k: _text_rank(k, widths[k]) if widths else _s(k) for k in families}
        per_order = li.groupBy("l_orderkey").agg(
            *[F.min(F.when(ln == i + 1, rank[k])).alias(slots[i]) for i in range(WIDE_SLOTS) for k, slots in families.items()],
        )

        def text(key: str, slot: str) -> F.Column:
            return _ranked_text(slot, widths[key]) if widths else F.col(slot)

        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
        least = joined.groupBy(
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderkey"),
            F.col("o_orderdate").cast("date").alias("dt"),
        ).agg(*[F.min(s).alias(s) for s in DIAG_SLOTS + OPERTN_SLOTS])
        return least.select(
            "person_id", "o_orderkey", "dt",
            *[F.concat(F.lit("P"), text("l_partkey", s)).alias(s) for s in DIAG_SLOTS],
            *[F.concat(F.lit("S"), text("l_suppkey", s)).alias(s) for s in OPERTN_SLOTS],
        )

    @staticmethod
    def _rank_widths(df: DataFrame, *keys: str) -> dict[str, int] | None:
        """The digits of the largest value of each of the integer ``keys``; None unless
        all values lie in the range of :func:`_text_rank`."""
        if any(df.schema[k].dataType.typeName() not in ("byte", "short", "integer", "long") for k in keys):
            return None
        ends = df.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
        if not all(v is None or 0 <= v < 10**RANK_DIGITS for v in ends):
            return None
        return {k: len(str(ends[f"max_{k}"] or 0)) for k in keys}

    # -- codelists ---------------------------------------------------------
    @_once
    def _suppliers_by_region(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return supplier.join(geo, supplier.s_nationkey == geo.n_nationkey)

    @_once
    def codes(self) -> DataFrame:
        part = self.table("part")
        key = _s("p_partkey")
        icd = part.select(
            F.concat(F.col("p_type"), F.lit(" ("), F.col("p_name"), F.lit(")")).alias("phenotype"),
            F.lit("ICD").alias("terminology"),
            F.concat(F.lit("P"), F.substr(key, F.lit(1), F.lit(1)), F.lit("."),
                     F.substr(key, F.lit(2))).alias("code"),
        )
        opcs = self._suppliers_by_region().select(
            F.concat(F.col("n_name"), F.lit("/"), F.col("r_name")).alias("phenotype"),
            F.lit("OPCS").alias("terminology"),
            F.concat(F.lit("S"), _s("s_suppkey")).alias("code"),
        )
        # four neighbouring parts share a code: a code of several phenotypes
        snomed = part.select(
            F.concat(F.col("p_type"), F.lit(" & "), F.col("p_brand")).alias("phenotype"),
            F.lit("SNOMEDCT").alias("terminology"),
            _s(F.floor(F.col("p_partkey") / 4).cast("bigint")).alias("code"),
        )
        return icd.unionByName(opcs).unionByName(snomed)

    @_once
    def codelist(self) -> DataFrame:
        raw = self.codes()
        return tidy_codes(raw.withColumn("phenotype", normalise_name("phenotype")))

    # -- categories --------------------------------------------------------
    @_once
    def categories(self) -> DataFrame:
        part = self.table("part")
        parts = part.where(F.col("p_type") != "PROMO").select(
            F.concat(F.col("p_type"), F.lit(" ("), F.col("p_name"), F.lit(")")).alias("Phenotype"),
            F.concat(F.col("p_type"), F.lit(" parts")).alias("Category"),
        ).distinct()
        nation = self.table("nation")
        region = self.table("region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.concat(F.col("n_name"), F.lit("/"), F.col("r_name")).alias("Phenotype"),
            F.concat(F.lit("Region, "), F.col("r_name")).alias("Category"),
        )
        blank = region.agg(
            F.lit(None).cast("string").alias("Phenotype"),
            F.min(F.concat(F.lit("Region, "), F.col("r_name"))).alias("Category"),
        )
        return reduce(DataFrame.unionByName, [parts, places, blank])

    @_once
    def abbreviations(self) -> DataFrame:
        types = self.table("part").select(
            F.concat(F.col("p_type"), F.lit(" parts")).alias("Category"),
            F.lower("p_type").alias("Short"),
        ).distinct()
        regions = self.table("region").select(
            F.concat(F.lit("Region, "), F.col("r_name")).alias("Category"),
            F.lower(F.translate("r_name", " ", "_")).alias("Short"),
        )
        return types.unionByName(regions)

    # -- dictionary and codelist sources ------------------------------------
    @_once
    def dictionary(self) -> DataFrame:
        nation = self.table("nation")
        region = self.table("region")
        key = F.col("n_nationkey")

        def file_name(kind: str) -> F.Column:
            return F.concat(F.lit(f"{kind}_N"), _s(key), F.lit(".csv"))

        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.concat(F.col("n_name"), F.lit("/"), F.col("r_name")).alias("phenotype"),
            F.when(key % 5 != 4, file_name("CPRD")).alias("CPRD"),
            F.when(key % 5 != 3, file_name("ICD")).alias("ICD"),
            F.when(key % 4 == 0, file_name("OPCS")).alias("OPCS"),
        )

    @_once
    def sources(self) -> DataFrame:
        part = self.table("part")
        icd = part.select(
            F.concat(F.lit("codes_icd_n"), _s(F.col("p_partkey") % 25)).alias("stem"),
            F.concat(F.lit("P"), _s("p_partkey"), F.lit(".0")).alias("code"),
        )
        opcs = self.table("supplier").select(
            F.concat(F.lit("codes_opcs_n"), _s("s_nationkey")).alias("stem"),
            F.concat(F.lit("S"), _s("s_suppkey")).alias("code"),
        )
        snomed = part.select(
            F.concat(F.lit("codes_cprd_n"), _s(F.col("p_size") % 25), F.lit("_snomedct")).alias("stem"),
            _s("p_size").alias("code"),
        )
        return reduce(DataFrame.unionByName, [icd, opcs, snomed])

    @_once
    def two_codes(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_name").alias("phenotype"),
            F.col("p_brand").alias("Readcode"),
            F.when(F.col("p_partkey") % 3 != 0, _s("p_partkey")).alias("Medcode"),
        )
