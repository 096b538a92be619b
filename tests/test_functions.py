from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from labtrail import functions as fn
from labtrail.rules import MATRIX_CODES, RESULT_DATE_FORMATS, SHEET_DATE_FORMATS


@pytest.mark.parametrize(
    "raw, want",
    [
        ("< 0,0030", ("<", "0,0030", None)),
        ("<250.00", ("<", "250.00", None)),
        ("> 1", (">", "1", None)),
        ("109,39", (None, "109,39", None)),
        (" -2.5 ", (None, "-2.5", None)),
        ("Ausente", (None, None, "Ausente")),
        ("< LQ", ("<", None, "< LQ")),
        ("1.234,56", (None, None, "1.234,56")),
        ("<", (None, None, "<")),
        ("", (None, None, "")),
        (None, (None, None, None)),
    ],
)
def test_parse_result(values, raw, want):
    assert tuple(values(fn.parse_result, [raw])[0]) == want


def test_numbers_with_comma(values):
    texts = ["1,5", "2.5", " 3 ", "1e3", "-0,25", "", "-", "12.5d", "NaN", "Infinity", "abc", None]
    got = values(fn.decimal_comma, texts)
    assert got == [1.5, 2.5, 3.0, 1000.0, -0.25] + [None] * 7
    assert values(fn.quantification_limit, ["250,00", " - ", "n/a"]) == [250.0, None, None]


def test_names(values):
    raw = ["PT_01-SO-100826 -0.5", "PT-02-Terc-ASUB-110826-Terc", "a\tb\n", None]
    clean = ["PT-01-SO-100826-0,5", "PT-02-ASUB-110826", "ab", None]
    assert values(fn.clean_sample_name, raw) == clean
    depths = ["PT-01-SO-100826-0,5", "PM-122-ASUB-310726", "PT", "x-1,2,3", "x,"]
    assert values(fn.depth_from_name, depths) == [0.5, 310726.0, None, None, None]
    assert values(fn.base_parameter, ["Ferro Total (mg/L)", "DISSOLVIDO Ferro", "Ferro"]) == [
        "Ferro  (mg/L)", "Ferro", "Ferro",
    ]
    assert values(fn.first_int, ["14 dias", "-", "de 7 a 9", None]) == [14, None, 7, None]


def test_codes(values):
    codes = ["SO", "ASUB", "LNAPL", None]
    assert values(lambda c: fn.map_codes(c, MATRIX_CODES), codes) == ["Solo", "Água Subterrânea", "LNAPL", None]
    assert values(lambda c: fn.map_codes(c, {}), codes) == codes
    folded = ["Água Subterrânea", "Água subterrânea", "Solo", None]
    assert values(lambda c: fn.fold_value(c, "Água Subterrânea", "Agua Subterranea"), folded) == [
        "Agua Subterranea", "Agua Subterranea", "Solo", None,
    ]


def test_dates_first_format_wins(values):
    texts = [
        "10/08/2026 09:00", "2026-08-10 09:00:01", "07-08-26 10:00", "07-23-26 10:00",
        "2026-08-10T09:00:00.123Z", "2026-08-10T09:00:00.1Z", "02/01/26 10:00", "sem data", "", None,
    ]
    assert values(lambda c: fn.parse_timestamp(c, RESULT_DATE_FORMATS).cast("timestamp_ntz"), texts) == [
        datetime(2026, 8, 10, 9), datetime(2026, 8, 10, 9, 0, 1), datetime(2026, 8, 7, 10), datetime(2026, 7, 23, 10),
        datetime(2026, 8, 10, 9, 0, 0, 123000), datetime(2026, 8, 10, 9, 0, 0, 100000), None, None, None, None,
    ]


def test_shapes_lose_no_date(spark, values):
    """The shape test changes nothing: every format still reads what it read without it."""
    for fmt in (*RESULT_DATE_FORMATS, *SHEET_DATE_FORMATS):
        text = spark.range(1).select(F.date_format(F.lit("2026-08-07 10:11:12.345").cast("timestamp"), fmt)).first()[0]
        with_shape = values(lambda c, f=fmt: fn.parse_timestamp(c, [f]).cast("string"), [text])
        plain = values(lambda c, f=fmt: F.try_to_timestamp(c, F.lit(f)).cast("string"), [text])
        assert with_shape == plain and plain[0] is not None


def test_week_and_period(values):
    days = [date(2026, 9, 13), date(2026, 9, 14), date(2026, 9, 19)]
    assert values(lambda c: fn.week_window(c)[1], days, "date") == [date(2026, 9, 13)] * 3
    assert values(lambda c: fn.week_window(c)[0], days, "date") == [date(2026, 9, 6)] * 3
    names = ["src_20260823_20260830_20260831_0700", "src_20260914_1530", "src_20261399_20260830", None]
    assert values(fn.period_text, names) == ["23/08/2026 a 30/08/2026"] + ["Nao disponivel"] * 3


def test_rpd_and_ranges(rows):
    df = rows("a double, b double", (0.0, 0.0), (1.0, -1.0), (10.0, 12.0), (None, 1.0))
    assert [r[0] for r in df.select(fn.rpd(F.col("a"), F.col("b"))).collect()] == [0.0, None, 18.18, None]
    v = rows("v double", (79.99,), (80.0,), (120.0,), (120.01,), (None,))
    assert [r[0] for r in v.select(fn.outside(F.col("v"), 80, 120)).collect()] == [True, False, False, True, None]


def test_folder_urls(values):
    urls = [
        "https://host.example/sites/Team/Forms/AllItems.aspx?id=%2Fsites%2FTeam%2FDocs%2FGeral%2FA%20%2B%20B&p=1",
        "https://host.example/sites/Team/x?id=%2Fsites%2FTeam%2FDocs",
        "https://host.example/sites/Team/x?p=1",
        "https://host.example/other?id=%2Fa%2Fb",
        "not a url",
        None,
    ]
    assert values(fn.url_folder, urls) == ["Geral/A + B", "", None, None, None, None]
    assert values(fn.url_site, urls)[:2] == ["host.example:/sites/Team"] * 2
