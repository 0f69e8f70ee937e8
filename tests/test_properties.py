"""Property tests: Spark expressions against the loader's string semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st

from wardmart.functions import pad_id

WS = st.sampled_from([" ", "\t", "\n", " ", " ", ""])
IDS = st.builds(lambda a, sign, digits, b: a + sign + digits + b,
                st.lists(WS, max_size=3).map("".join),
                st.sampled_from(["", "", "-", "+"]),
                st.text(alphabet="0123456789", min_size=0, max_size=9),
                st.lists(WS, max_size=3).map("".join))


@settings(max_examples=6, deadline=None)
@given(st.lists(IDS, min_size=200, max_size=200), st.sampled_from([5, 6]))
def test_pad_id_matches_strip_zfill(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(pad_id("v", width)).collect()]
    assert got == [v.strip().zfill(width) for v in values]
