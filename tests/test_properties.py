"""Property tests over generated flight rows (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from opslake import spec
from rows import lake, leg

TIMES = st.sampled_from([0, 16, -180, 1500, 60, "null", "bad", None])
ROW = st.builds(
    leg,
    icao_airline=st.sampled_from(["VCA", "DUO", "QQQ", "XAL", None, ""]),
    flight_number=st.sampled_from(["1", "2"]),
    di_code=st.sampled_from(["0", "1", "D", None]),
    line_type_code=st.sampled_from(["N", "I", "X", None]),
    icao_origin=st.sampled_from(["SBAA", "SNCC", "KZZZ", "", None]),
    icao_destination=st.sampled_from(["SBBB", "SBXX", "", None]),
    scheduled_departure=TIMES, actual_departure=TIMES, scheduled_arrival=TIMES, actual_arrival=TIMES,
    flight_status=st.sampled_from(["REALIZADO", "CANCELADO", "DESCONHECIDO", None]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=12))
def test_layer_invariants(spark, rows):
    lh = lake(spark, rows)
    silver = lh.silver_flights
    n = silver.count()
    assert n == len(rows)                                   # lossless mirror
    q = lh.quarantine
    assert q.count() <= n                                   # quarantine ⊆ silver
    assert q.where(f"{spec.REASONS_COLUMN} = ''").count() == 0   # reasons non-empty
    keys = silver.select(*spec.DEDUP_KEYS).distinct().count()
    assert lh.fact.count() == keys                          # fact = distinct keys
    assert lh.obt.count() == keys                           # OBT = fact
    m = lh.contract_metrics.first()
    assert m.quarantined == q.count()
