"""Property tests: Spark expressions against plain-Python models of the same rules."""
import math

from hypothesis import given, settings, strategies as st

from quaystone.functions.numbers import parse_number

ALPHABET = "0123456789.,，%/ -+e"


def model_parse_number(text):
    """The rule, one cell at a time: a number in text without thousands separators, a hundredth of it with a
    percent sign at the end, and 0 for anything that is no finite number."""
    cell = text.strip()
    try:
        number = float("".join(c for c in cell if c not in ",，").rstrip("%"))
    except ValueError:
        return 0.0
    return 0.0 if not math.isfinite(number) else number / 100 if cell[-1:] == "%" else number


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=50, max_size=120))
def test_parse_number_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.x for r in df.select("i", parse_number("s").alias("x")).collect()}
    want = [model_parse_number(v) for v in values]
    for i, v in enumerate(values):
        a, b = got[i], want[i]
        assert a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=0.0), (v, a, b)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(min_value=__import__("datetime").date(1, 1, 1),
                         max_value=__import__("datetime").date(9999, 12, 31)), min_size=40, max_size=80))
def test_contract_date_round_trip(spark, days):
    from quaystone.functions.dates import DATE_PLACEHOLDERS, contract_date
    rows = []
    for i, d in enumerate(days):
        y = f"{d.year:04d}"
        rows += [(i, f"{y}{d.month:02d}{d.day:02d}"), (i, f"{y}-{d.month:02d}-{d.day:02d}"),
                 (i, f" {y}/{d.month:02d}/{d.day:02d} "), (i, f"{y}-{d.month:02d}-{d.day:02d}T08:30:00")]
    rows += [(-1, p) for p in DATE_PLACEHOLDERS] + [(-1, ""), (-1, None)]
    df = spark.createDataFrame(rows, "i int, s string")
    for r in df.select("i", "s", contract_date("s").alias("d")).collect():
        if r.i < 0:
            assert r.d is None, r
        else:
            assert r.d == days[r.i], r


def test_name_join_repeats_few_rows(spark):
    """A name with far more pairs than a task is to have: the rows repeated stay far below the pairs."""
    from quaystone.operators import views as V
    left = spark.range(3000).selectExpr("id AS a", "'x' AS n")
    right = spark.range(300).selectExpr("id AS b", "'x' AS m")
    sides = V.name_join_sides(left, right, "n", "m", rows_per_task=10)
    assert sum(s.count() for s in sides) < 20_000
    out = V.name_join(left, right, "n", "m", rows_per_task=10)
    assert out.count() == out.distinct().count() == 900_000
