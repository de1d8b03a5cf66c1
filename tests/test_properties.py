"""Property test of the round-trip law through key-value CSV files:
restore(melt(t), recover(describe(t))) == t for generated tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cellfold.plans.jobs import load_key_value, restore_table
from conftest import same_rows

SCHEMA = "i int, s string, d double, b boolean"

texts = st.one_of(st.none(), st.text(
    alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"),
    max_size=12))
rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)), texts,
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
    st.one_of(st.none(), st.booleans())), max_size=25)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(data=rows)
def test_round_trip_through_key_value_csv(spark, scratch, data):
    df = spark.createDataFrame(data, SCHEMA)
    target = scratch("prop")
    load_key_value(spark, df, target, name="gen")
    back, name = restore_table(spark, target)
    assert name == "gen" and back.schema == df.schema
    assert same_rows(back, df)
