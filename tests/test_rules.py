from datetime import date

import pytest
from pyspark.sql import functions as F

from staffcast.functions import rules, text

D = date


def column(spark, rows, schema, expression):
    """Values of an expression over hand-made rows, in row order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_required_positions_takes_filled_when_either_is_missing(spark):
    got = column(spark, [(3, 2), (2, 3), (None, 2), (4, None)], "r int, f int", rules.required_positions(F.col("r"), F.col("f")))
    assert got == [3, 3, 2, None]


def test_coverage_of_nothing_is_missing(spark):
    assert column(spark, [(0, 0), (1, 2)], "f int, r int", rules.coverage_rate(F.col("f"), F.col("r"))) == [None, 0.5]


@pytest.mark.parametrize(
    "status,filled,coverage,expected",
    [
        ("Open", 1, 1.0, "Closed"), ("Open", 1, 0.9, "Open"),
        ("Open", 2, 1.0, "Closed"), ("Open", 2, 0.99, "Open"),
        ("Open", 3, 0.66, "Closed"), ("Open", 3, 0.65, "Open"),
        ("Open", 4, 0.75, "Closed"), ("Open", 4, 0.74, "Open"),
        ("Open", 5, 0.70, "Closed"), ("Open", 5, 0.69, "Open"),
        ("Open", 6, 0.25, "Closed"), ("Open", 6, 0.24, "Open"),
        ("Open", 9, 0.25, "Closed"), ("Open", 9, 0.10, "Open"),
        ("Open", 0, None, "Open"), ("Open", 0, 0.0, "Open"),
        ("Closed", 0, None, "Closed"), ("Closed", None, None, "Closed"),
        ("Open", None, None, None), ("Paused", 1, 1.0, None), (None, 1, 1.0, None),
    ],
)
def test_status_rules(spark, status, filled, coverage, expected):
    rule = rules.settled_status(F.col("s"), F.col("f"), F.col("c"))
    assert column(spark, [(status, filled, coverage)], "s string, f int, c double", rule) == [expected]


def test_forced_closure(spark):
    rows = [("Open", D(2001, 1, 1)), ("Open", D(2001, 6, 30)), ("Open", None), ("Closed", D(1999, 1, 1)), ("Closed", None), (None, D(2000, 1, 1))]
    rule = rules.forced_closure(F.col("s"), F.col("d"), D(2001, 7, 1), 180)
    assert column(spark, rows, "s string, d date", rule) == ["Closed", "Open", None, "Closed", "Closed", None]


def test_target_of_every_size(spark):
    rows = [
        ("Open", 1, 1, 1.0), ("Closed", 1, 90, 1.0), ("Closed", 1, 91, 1.0), ("Closed", 2, 10, 0.9), ("Closed", 3, 5, 0.66),
        ("Closed", 4, 5, 0.70), ("Closed", 4, 5, 0.69), ("Closed", 5, 5, 0.60), ("Closed", 6, 5, 0.9), ("Closed", 0, 5, None),
        ("Closed", 1, None, 1.0),
    ]
    args = (F.col("s"), F.col("f"), F.col("d"), F.col("c"), 90)
    schema = "s string, f int, d int, c double"
    assert column(spark, rows, schema, rules.target_label(*args)) == [-1, 1, 0, 0, 1, 1, 0, 1, 0, 0, 0]
    documented = rules.target_label(*args, large_request_rule="as_documented")
    assert column(spark, rows, schema, documented) == [-1, 1, 0, 0, 1, 1, 0, 1, 1, 0, 0]
    with pytest.raises(ValueError):
        rules.target_label(*args, large_request_rule="other")


def test_bands(spark):
    levels = [(5.0,), (5.5,), (6.0,), (9.0,), (9.5,), (10.0,), (None,)]
    assert column(spark, levels, "l double", rules.job_level_band(F.col("l"))) == [
        "high_level", "0", "senior", "senior", "0", "junior", "0",
    ]
    assert column(spark, [(75.0,), (74.9,), (40.0,), (39.0,), (None,)], "p double", rules.probability_band(F.col("p"))) == [1, 0, 0, -1, -1]
    pairs = [(80.0, 75.0), (80.0, 1.0), (1.0, 75.0), (30.0, 30.0), (30.0, 31.0), (None, 80.0), (None, 10.0)]
    assert column(spark, pairs, "a double, b double", rules.mixed_band(F.col("a"), F.col("b"))) == [2, 1, 1, -1, 0, 1, 0]
    assert column(spark, [(2,), (1,), (0,), (None,)], "r int", rules.several_positions(F.col("r"))) == [1, 0, -1, -1]
    assert column(spark, [(100,), (99,), (0,), (None,)], "p int", rules.remote_status(F.col("p"))) == [
        "Fully Remote", "Hybrid", "On-site", "On-site",
    ]


def test_salary_rules(spark):
    assert column(spark, [(4.0,), (5.0,), (99.0,), (100.0,), (None,)], "s double", rules.full_salary(F.col("s"))) == [
        4.0, 5000.0, 99000.0, 100.0, None,
    ]
    grown = rules.growth_flag(F.col("n"), F.col("u"))
    assert column(spark, [(2.0, 1.0), (1.0, 1.0), (1.0, 0.0), (None, 1.0)], "n double, u double", grown) == [1, 0, 0, 0]
    assert column(spark, [(0.0,), (3.0,), (None,)], "s double", rules.known_positive(F.col("s"))) == [None, 3.0, None]
    assert column(spark, [(0.0,), (-1.0,), (None,)], "p double", rules.known_probability(F.col("p"))) == [0.0, None, None]
    assert column(spark, [("a",), (None,)], "v string", rules.equals_flag(F.col("v"), "a")) == [1, 0]
    assert column(spark, [(-2.0,), (2.0,), (None,)], "v double", rules.clamp_negative(F.col("v"))) == [0.0, 2.0, None]


def test_folding_and_tokens(spark):
    folded = column(spark, [("Straße ÉCOLE Ñandú œuvre",), (None,)], "t string", text.fold_text(F.col("t")))
    assert folded == ["strasse ecole nandu oeuvre", ""]
    words = column(spark, [("a bc the c++ x1 don't bc",)], "t string", text.tokens(F.col("t"), ["the"]))
    assert words == [["bc", "x1", "don", "bc"]]


def test_profile_cleaning(spark):
    rows = [("Analyst Area 3 L01",), ("Dev  L02",), ("abc",), (None,)]
    assert column(spark, rows, "p string", text.clean_profile(F.col("p"))) == ["Analyst", "Dev", "", None]


def test_lists(spark):
    rows = [("a|b",), ("a",), ("",), (None,), ("|" * 19,)]
    assert column(spark, rows, "v string", text.count_values(F.col("v"))) == [2, 1, 1, 0, 20]
    assert column(spark, rows[:4], "v string", text.several_values(F.col("v"))) == [1, 0, 0, 0]
    assert column(spark, [(" a | b|",)], "v string", text.split_values(F.col("v"))) == [["a", "b", ""]]


def test_work_zone_takes_the_first_known_word(spark):
    rows = [("Zona SEVILLA madrid",), ("Cádiz",), ("Cadiz",), ("cualquier  lugar",), (None,), ("",), ("Oslo",)]
    assert column(spark, rows, "a string", text.work_zone(F.col("a"))) == [
        "Andalusia", "Andalusia", "Other", "Any location", "Other", "Other", "Other",
    ]


def test_dates(spark):
    rows = [(D(2025, 3, 1), D(2025, 4, 1)), (D(2025, 4, 1), D(2025, 3, 1)), (D(2025, 3, 1), D(2025, 3, 1)), (None, D(2025, 3, 1))]
    schema = "c date, n date"
    assert column(spark, rows, schema, text.early_flag(F.col("c"), F.col("n"))) == [1, 0, 0, 0]
    assert column(spark, rows, schema, text.lead_sign(F.col("c"), F.col("n"))) == [1, -1, 0, 0]
    assert column(spark, rows, schema, text.month_name(F.col("c"))) == ["March", "April", "March", None]
    texts = [("2025-03-01",), ("2025-03-01 10:00:00",), (" 2025-03-01T10:00Z",), ("2025/03/01",), ("20250301",), ("01/03/2025",), ("01.03.2025",), ("soon",), ("2025-02-30",), ("",), (None,)]
    day = D(2025, 3, 1)
    assert column(spark, texts, "t string", text.to_day(F.col("t"))) == [day] * 7 + [None] * 4
    assert column(spark, texts, "t string", text.unread_day(F.col("t"))) == [0] * 7 + [1, 1, 0, 0]


def test_folding_beyond_west_european_letters(spark):
    rows = [("Tiếng Việt re\u0301sume\u0301 Привет",), ("ŁÓDŹ Straße",), (None,)]
    folded = text.fold_text(F.col("t"))
    assert column(spark, rows, "t string", folded) == ["tieng viet resume привет", "lodz strasse", ""]
    assert column(spark, rows[:1], "t string", text.tokens(folded, [])) == [["tieng", "viet", "resume", "привет"]]
