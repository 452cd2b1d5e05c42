"""Generated dirty text against an independent Python model of the hours rule."""

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from effort_analytics import functions as X

PLAIN = re.compile(r"\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)\s*")


def model(text):
    if text is None or not PLAIN.fullmatch(text):
        return Decimal("0")
    try:
        v = Decimal(text.strip()).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return Decimal("0")
    return v if abs(v) < Decimal(10) ** 8 else Decimal("0")


texts = st.one_of(st.none(), st.text(alphabet="0123456789.,- +ea", min_size=0, max_size=12))


@settings(max_examples=4, deadline=None)
@given(st.lists(texts, min_size=100, max_size=300))
def test_hours_decimal_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(X.hours_decimal(F.col("v"))).collect()]
    assert got == [model(v) for v in values]
