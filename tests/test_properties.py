"""
deduplicated mentions equal the brute-force set join of records and
codelist, on the broadcast and the salted shuffle paths, and the bag output
has exactly one row per (record, codelist entry) pair."""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from phenospark.operators import mentions

CODES = ["A1", "A2", "B1", "B.2", "7"]
TERMS = ["ICD", "SNOMEDCT"]

records_st = st.lists(
    st.tuples(st.sampled_from(["p1", "p2", "p3"]),
              st.one_of(st.none(), st.sampled_from([dt.date(2020, 1, d) for d in (1, 2, 3)])),
              st.sampled_from(CODES + [None]),
              st.sampled_from(TERMS)),
    max_size=25)
codelist_st = st.lists(
    st.tuples(st.sampled_from(["x", "y", "z"]), st.sampled_from(TERMS), st.sampled_from(CODES)),
    max_size=10)


def _brute(records, codelist):
    by_key = collections.defaultdict(list)
    for ph, term, code in codelist:
        by_key[(term, code)].append(ph)
    return [(p, ph, d, c, t) for p, d, c, t in records for ph in by_key.get((t, c), [])]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(records=records_st, codelist=codelist_st)
def test_mentions_equal_brute_force(spark, records, codelist):
    long = spark.createDataFrame(records, "person_id_deid string, date date, code string, terminology string")
    cl = spark.createDataFrame(codelist, "phenotype string, terminology string, code string")
    bag = _brute(records, codelist)
    for bound in (None, 0):
        kwargs = {} if bound is None else {"max_broadcast_bytes": bound}
        got = [tuple(r) for r in mentions(cl, records=long, **kwargs).collect()]
        assert _sorted(got) == _sorted(set(bag))
        got_bag = [tuple(r) for r in mentions(cl, records=long, deduplicate=False, **kwargs).collect()]
        assert _sorted(got_bag) == _sorted(bag)
