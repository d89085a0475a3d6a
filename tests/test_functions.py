import re
import unicodedata
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import dates, money, text
from ledgermill.operators import checks


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def cleaned(spark, steps, values):
    df = text.stepwise(texts(spark, values), "x", steps)
    return [r.x for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("written,expected", [
    (" Ana Souza ", "Ana Souza"),
    ("JOÃ\u0083O PEREIRA", "João Pereira"),
    ("maria  DA silva", "Maria da Silva"),
    ("LucÃ­a FernÃ¡ndez", "Lucía Fernández"),
    ("JOÃO E MARIA", "João e Maria"),
    ("o'neil  ana-maria", "O'neil Ana-maria"),
    ("  ", None),
    ("", None),
    (None, None),
])
def test_person_name(spark, written, expected):
    assert cleaned(spark, text.PERSON_NAME, [written]) == [expected]


def test_countries_and_currencies(spark):
    written = ["FranÃ§a", "CANADÃ\u0081", "CANADÃ", "uk", "Inglaterra ", "USA ", "Estados  Unidos da AmÃ©rica", "Chile",
               " ", None, "eua", "Â�Brasil"]
    names = ["FRANCA", "CANADA", "CANADA", "REINO UNIDO", "REINO UNIDO", "ESTADOS UNIDOS", "ESTADOS UNIDOS", "CHILE",
             None, None, "ESTADOS UNIDOS", "A�BRASIL"]
    codes = ["EUR", "CAD", "CAD", "GBP", "GBP", "USD", "USD", None, None, None, "USD", None]
    df = text.stepwise(texts(spark, written), "x", text.COUNTRY_NAME)
    got = df.withColumn("m", text.currency_of(F.col("x"))).orderBy("i").collect()
    assert [r.x for r in got] == names
    assert [r.m for r in got] == codes


def test_repair_is_stable_under_a_second_pass(spark):
    written = ["FranÃ§a", "CANADÃ", "São Paulo", "Â�", "plain", "Ã", "Ã\u0083Â§", None]
    once = cleaned(spark, [text.repair_encoding], written)
    assert once[0] == "França" and once[1] == "CANADÃ"
    assert cleaned(spark, [text.repair_encoding], once)[:3] == once[:3]


def test_accent_folding_agrees_with_compatibility_decomposition(spark):
    sample = "ÀÉîõÜçñ ﬁ ² ½ ㈱ Ａ é ş ǅ Å ḟ … ŀ ª 中 ß Ω ё"
    expected = "".join(c for c in unicodedata.normalize("NFKD", sample) if not unicodedata.combining(c))
    assert cleaned(spark, text.FOLD_ACCENTS, [sample]) == [expected]


def test_every_letter_folds_as_in_the_standard(spark):
    letters = [chr(c) for c in [*range(0x21, 0x10000), *range(0x10000, 0x32000)] if not 0xD800 <= c <= 0xDFFF]
    assert cleaned(spark, text.CATEGORY_LABEL, ["\U0001d400BC", "x\U0001f100y"]) == ["ABC", "X0 Y"]
    expected = ["".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)) for x in letters]
    assert cleaned(spark, text.FOLD_ACCENTS, letters) == expected


@pytest.mark.parametrize("written,expected", [
    ("SOFTWARE / LICENÇA DE USO", "SOFTWARE LICENCA DE USO"),
    ("RECEITA FINANCEIRA SOBRE APLICAÇÕES", "RECEITA FINANCEIRA SOBRE APLICACOES"),
    ("ReceitA", "RECEITA"),
    (" ///  ", None),
    ("", None),
    (None, None),
])
def test_category_label(spark, written, expected):
    assert cleaned(spark, text.CATEGORY_LABEL, [written]) == [expected]


def test_column_suffix(spark):
    df = texts(spark, ["JUROS RECEBIDOS", "A/B--C", "Ação", "  ", None, "_x_"])
    got = [r.s for r in df.select("i", text.column_suffix(F.col("x")).alias("s")).orderBy("i").collect()]
    assert got == ["juros_recebidos", "a_b_c", "ação", "sem_categoria", "sem_categoria", "x"]


def parsed(spark, values, layouts, repair):
    df = dates.parse_dates(texts(spark, values), "x", layouts, repair)
    return [r.x for r in df.orderBy("i").collect()]


def test_ledger_dates(spark):
    first = date(2025, 1, 5)
    cases = {
        "2025-01-05": first, "05/01/2025": first, "01-05-2025": first, "5/1/2025": first, " 2025-1-5 ": first,
        "29/02/2025": date(2025, 2, 28), "2025-02-29": date(2025, 2, 28), "02-29-2025": date(2025, 2, 28),
        "29/02/2024": date(2024, 2, 29), "31/04/2025": None, "13-01-2025": None, "2025-01-05 00:00:00": None,
        "nan": None, "NaT": None, "": None, None: None, "25-01-05": None, "0000-02-29": None, "2025-2-29": None,
        "29/2/2025": None, "05/01/25": None, "x/y/z": None,
    }
    assert parsed(spark, list(cases), dates.LEDGER_LAYOUTS, True) == list(cases.values())


def test_dates_without_repair(spark):
    written = ["29/02/2025", "2025-02-29", "28/02/2025", "02-28-2025"]
    assert parsed(spark, written, dates.LEDGER_LAYOUTS, False) == [None, None, date(2025, 2, 28), date(2025, 2, 28)]
    assert parsed(spark, ["12/01/2023", "01-13-2023", "29/02/2023"], dates.CLIENT_LAYOUTS, False) == [
        date(2023, 1, 12), None, None]


def test_typed_dates_pass_through(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 5, 13, 0),)], "x timestamp")
    assert dates.parse_dates(df, "x", dates.LEDGER_LAYOUTS).first().x == date(2025, 1, 5)


def test_parsing_agrees_with_plain_python_on_many_texts(spark):
    shapes = ["{y:04d}-{m:02d}-{d:02d}", "{d:02d}/{m:02d}/{y:04d}", "{m:02d}-{d:02d}-{y:04d}", "{d}/{m}/{y:04d}"]
    written = [s.format(y=y, m=m, d=d) for s in shapes for y in (1999, 2000, 2024) for m in range(0, 14)
               for d in (0, 1, 9, 28, 29, 30, 31, 32)]

    def plain(value):
        for fmt in ("%Y-%m-%d", "%d/%m/%Y", "%m-%d-%Y"):
            try:
                return datetime.strptime(value, fmt).date()
            except ValueError:
                continue
        return None

    assert parsed(spark, written, dates.LEDGER_LAYOUTS, False) == [plain(w) for w in written]


def test_calendar_attributes(spark):
    df = spark.sql("select explode(array(date'2025-01-05', date'2025-01-06')) d")
    got = [tuple(r) for r in df.select("d", *[c.alias(n) for n, c in dates.calendar_attributes(F.col("d")).items()])
           .orderBy("d").collect()]
    assert got == [
        (date(2025, 1, 5), 2025, 1, 1, "janeiro", 5, 6, "domingo", True),
        (date(2025, 1, 6), 2025, 1, 1, "janeiro", 6, 0, "segunda", False),
    ]


def test_identifiers(spark):
    cases = {"12": 12, "12.0": 12, " 7 ": 7, "+3": 3, "-4": -4, "1e3": 1000, "1.5": None, "x": None, "nan": None,
             "": None, None: None, "12d": None, "9007199254740993": 9007199254740993, "1e30": None}
    df = money.to_identifier(texts(spark, list(cases)), "x")
    assert [r.x for r in df.orderBy("i").collect()] == list(cases.values())


def test_numbers(spark):
    cases = {"12": 12.0, "1.5": 1.5, ".5": 0.5, "1e3": 1000.0, "-2": -2.0, "abc": None, "nan": None, "12f": None,
             "Infinity": None, "1,5": None, " 3 ": 3.0, None: None}
    df = money.to_number(texts(spark, list(cases)), "x")
    assert [r.x for r in df.orderBy("i").collect()] == list(cases.values())


def test_typed_numbers(spark):
    df = spark.createDataFrame([(1.0, 2), (float("nan"), 3), (1.5, None)], "a double, b int")
    assert [r.a for r in money.to_number(df, "a").collect()] == [1.0, None, 1.5]
    assert [r.a for r in money.to_identifier(df, "a").collect()] == [1, None, None]
    assert [r.b for r in money.to_identifier(df, "b").collect()] == [2, 3, None]


def test_target_amounts(spark):
    cases = {"700k": 700000.0, "1,5k": 1500.0, "1.5k": 15000.0, "1.234,50": 1234.5, "abc": None, "k": None,
             " 650K ": 650000.0, None: None}
    df = money.to_target_amount(texts(spark, list(cases)), "x", "v")
    assert [r.v for r in df.orderBy("i").collect()] == list(cases.values())


def test_brl_value(spark):
    df = spark.createDataFrame([
        ("BRL", date(2025, 1, 3), 5.1), (" ", date(2025, 1, 3), 5.1), (None, date(2025, 1, 3), 5.1),
        ("USD", date(2025, 1, 3), 5.1), ("usd ", date(2025, 1, 3), 5.1), ("USD", date(2025, 1, 1), None),
        ("USD", None, 5.1), ("ARS", date(2025, 1, 3), None), ("ARS", None, None),
    ], "m string, d date, s double")
    got = [r.v for r in df.select(money.brl_value(F.lit(100.0), F.col("m"), F.col("d"), F.col("s")).alias("v")).collect()]
    assert got == pytest.approx([100, 100, 100, 510, 510, 100, 100, 0.37, 100])


def test_no_python_runs_per_row(spark):
    df = texts(spark, ["x"])
    for steps in (text.PERSON_NAME, text.COUNTRY_NAME, text.CATEGORY_LABEL):
        plan = text.stepwise(df, "x", steps)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow", plan.replace("LogicalRDD", ""))


def test_every_blank_and_sign_at_the_ends_of_a_column(spark):
    signs = ["", *text._BLANK_CHARS, *map(chr, range(0x21, 0x7F)), "\x7f", "\x00", "é", "€", "\U0001f600", "\u200b"]
    written = [a + middle + b for a in signs for middle in ("", "x y") for b in signs]
    df = texts(spark, written).withColumn("y", text.strip_column(F.col("x")))
    got = [r.y for r in df.withColumn("x", text.strip_blanks(F.col("x"))).where("not y <=> x").collect()]
    assert got == [] and cleaned(spark, [text.strip_column], [None, " \t", "\u00a0a ", "b"]) == [None, "", "a", "b"]


def test_odd_dates_parse_as_by_regular_expressions(spark):
    days = ["1999-12-31", "31/12/1999", "12-31-1999", "29/02/1999", "02-29-1999", "1999-02-29", "0000-02-29", "2000-02-29"]
    written = [w[:i] + c + w[i + k:] for w in days for i in range(len(w) + 1) for k in (0, 1) for c in ("", "-", "/", "0", " ", "T", "é", "+")]

    def plain(value):
        value = value.strip()
        for shape in (r"(?P<d>\d{1,2})/(?P<m>\d{1,2})/(?P<y>\d{4})", r"(?P<m>\d{1,2})-(?P<d>\d{1,2})-(?P<y>\d{4})",
                      r"(?P<y>\d{4})-(?P<m>\d{1,2})-(?P<d>\d{1,2})"):
            found = re.fullmatch(shape, value)
            if found:
                y, m, d = (int(found[part]) for part in "ymd")
                leap = found["m"] == "02" and found["d"] == "29"
                try:
                    return date(y, m, d)
                except ValueError:
                    return date(y, 2, 28) if leap and y else None
        return None

    assert parsed(spark, written, dates.LEDGER_LAYOUTS, True) == [plain(w) for w in written]


def test_usual_dates_and_states_are_not_searched_for_blanks(spark, capsys):
    df = dates.parse_dates(texts(spark, [" 05/01/2025"]), "x", dates.LEDGER_LAYOUTS, repair_feb29=True)
    df = df.withColumn("s", checks.status_like("i", "1"))
    df.explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical")[0]
    assert plan.count("btrim(") + plan.count("trim(") == plan.count("ELSE trim(") + plan.count("ELSE btrim(") > 0
