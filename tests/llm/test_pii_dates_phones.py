"""Dates and phones of all the formats that the README names."""

import datetime
import re

from pyspark.sql import functions as F

from effort_analytics.llm import pseudonyms


def _out(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.pii_found, r.pii_kinds) for r in sorted(pseudonyms.pseudonymise(df).collect(), key=lambda r: r.doc_id)]


def test_dates(spark):
    iso, us, short, german, little = _out(spark, ["on 2024-01-02.", "on 01/02/2024.", "on 1/2/2024.", "on 2.1.2024.", "on 25/12/2020 and 25/12/2020, 25/1/2020."])
    day = datetime.date.fromisoformat(iso[0][3:-1])
    assert day != datetime.date(2024, 1, 2)
    assert us[0] == f"on {day:%m/%d/%Y}." and short[0] == f"on {day.month}/{day.day}/{day.year}." and german[0] == f"on {day.day}.{day.month}.{day.year}."
    one, two, other = re.findall(r"\d+/\d+/\d{4}", little[0])
    assert one == two != other and one != "25/12/2020" and other != "25/1/2020" and little[1] == 3
    assert datetime.datetime.strptime(one, "%d/%m/%Y").day > 12 and datetime.datetime.strptime(other, "%d/%m/%Y").day > 12
    assert [x[1] for x in _out(spark, ["31/02/2020", "13/13/2020", "0/1/2020", "1.2.3", "2020/12/25"])] == [0] * 5


def test_late_days_are_permuted(spark):
    days = spark.range(189 * 773).select(F.date_add(F.lit(pseudonyms.FIRST_DAY).cast("date"), F.col("id").cast("int")).alias("day")).where("day(day) > 12")
    new = days.select(pseudonyms._late_day(F.col("day"), "k").alias("x"))
    n = 9 * 9833
    assert days.count() == n and new.distinct().count() == n
    assert new.where("day(x) <= 12 OR x IS NULL OR year(x) < 1800 OR year(x) > 2199").count() == 0


def test_phones(spark):
    texts = ["5551234567", "+15551234567", "(555) 123-4567", "1-555-123-4567", "+44 20 7946 0958", "+442079460958", "+49 (0)30 123456", "+353-1-679-6000"]
    out = _out(spark, [f"call {t}, please" for t in texts])
    for t, (new, n, kinds) in zip(texts, out, strict=True):
        assert n == 1 and kinds == "phone" and t not in new
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", f"call {t}, please")
    digits = [re.sub(r"\D", "", x) for x, _, _ in out]
    assert len({x[-10:] for x in digits[:4]}) == 1  # one number, however it is written
    assert digits[4] == digits[5] and digits[4][:2] == "44" and digits[6][:2] == "49" and digits[7][:3] == "353"
    assert [x[1] for x in _out(spark, ["1234567890", "+1234", "23456789012", "x5551234567", "a+b"])] == [0] * 5
