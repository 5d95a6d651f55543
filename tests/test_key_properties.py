"""Property test: the trip key equals an independent Python computation for
random trips, including where NULL parts are coalesced and where they make
the key NULL."""
from __future__ import annotations

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kerbside.operators import facts
from kerbside.schemas import SILVER_TRIPS

EPOCH = dt.datetime(2024, 1, 1)

trip = st.tuples(
    st.integers(0, 31 * 86_400 * 10**6 - 1),             # pickup, µs after EPOCH
    st.integers(0, 6 * 3_600 * 10**6),                    # duration, µs
    st.one_of(st.none(), st.integers(1, 265)),            # pickup zone (not coalesced)
    st.one_of(st.none(), st.integers(1, 265)),            # dropoff zone (coalesced)
    st.one_of(st.none(), st.integers(0, 9)),              # passengers (coalesced)
    st.integers(1, 10**7),                                # distance, hundredths
    st.integers(1, 10**7),                                # amount, cents
)


def expected_key(pickup, dropoff, pu, do, pax, dist, amount):
    if pu is None:
        return None
    text = "|".join([
        pickup.strftime("%Y-%m-%d %H:%M:%S.%f"), dropoff.strftime("%Y-%m-%d %H:%M:%S.%f"),
        str(pu), "" if do is None else str(do), repr(dist), repr(amount),
        "" if pax is None else str(pax)])
    return hashlib.md5(text.encode()).hexdigest().upper()


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_trip_key_matches_python(spark, trips):
    rows, want = [], []
    for p_us, d_us, pu, do, pax, dist, amount in trips:
        pickup = EPOCH + dt.timedelta(microseconds=p_us)
        dropoff = pickup + dt.timedelta(microseconds=d_us)
        rows.append((pickup, dropoff, pu, do, pax, dist / 100, amount / 100, "2024-01"))
        want.append(expected_key(pickup, dropoff, pu, do, pax, dist / 100, amount / 100))
    got = [r.trip_key for r in
           facts.keyed_trips(spark.createDataFrame(rows, SILVER_TRIPS)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
