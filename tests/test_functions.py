import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import casts, dates, text, vectors
from sedimenta.plans.parliament import PROMPT, RESULTS


def apply(spark, fn, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def check(spark, fn, cases, kind="string"):
    assert apply(spark, fn, [c[0] for c in cases], kind) == [c[1] for c in cases]


def test_repair_mojibake(spark):
    cases = [
        ("NÃ\u0083O INFORMADO", "NÃO INFORMADO"),
        ("aÃ§Ã£o", "ação"),
        ("NÃO", "NÃO"),
        ("a–b", "a–b"),
        ("\u0080x", "\u0080x"),
        ("plain", "plain"),
        ("", ""),
        ("Ã© ", "Ã© "),
        ("linha\nÃ©\n", "linha\né\n"),
        (None, None),
    ]
    check(spark, text.repair_mojibake, cases)


def expected_repair(s):
    import unicodedata

    try:
        s = s.encode("latin1").decode("utf-8")
    except (UnicodeDecodeError, UnicodeEncodeError):
        pass
    return unicodedata.normalize("NFC", s)


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(st.characters(max_codepoint=0x2FF, exclude_categories=("Cs",)), max_size=12),
            st.text(st.characters(max_codepoint=0x2FF, exclude_categories=("Cs",)), max_size=12).map(
                lambda s: s.encode("utf-8").decode("latin1")
            ),
            st.text(st.characters(exclude_categories=("Cs", "Cn", "Co")), max_size=8),
        ),
        min_size=200,
        max_size=300,
    )
)
def test_repair_and_nfc_follow_the_codec_rule(spark, inputs):
    got = apply(spark, lambda c: text.nfc(text.repair_mojibake(c)), inputs)
    assert got == [expected_repair(s) for s in inputs]


def test_repair_undoes_damage(spark):
    inputs = ["Saúde pública", "Ação – já", "naïve café", "日本語", "ß"]
    damaged = [s.encode("utf-8").decode("latin1") for s in inputs]
    assert apply(spark, text.repair_mojibake, damaged) == inputs


def test_nfc_and_upper(spark):
    check(spark, text.nfc, [("é", "é"), ("abc", "abc"), (None, None)])
    check(spark, text.standardise, [("straße", "STRASSE"), ("é", "É"), (None, None)])


def test_uri_tail(spark):
    cases = [("HTTPS://X/ORGAOS/180", 180), ("x/", None), ("x/abc", None), ("42", 42), (None, None)]
    check(spark, casts.uri_id, cases)
    check(spark, casts.uri_tail, [("a/b/c", "c"), ("x/", None)])


def test_digits_only(spark):
    check(
        spark,
        casts.digits_id,
        [("0012", 12), ("-3", None), ("1.0", None), (" 1", None), ("9" * 30, None), (None, None)],
    )


def test_strip_hyphen(spark):
    check(spark, casts.strip_hyphen, [("1228863-64", "122886364"), ("-5", "5"), (None, None)])


def test_to_long(spark):
    cases = [
        ("12", 12),
        (" 12 ", 12),
        ("2.0", 2),
        ("1e3", 1000),
        ("1.5", None),
        ("x", None),
        ("1d", None),
        ("0x10", None),
        ("inf", None),
        ("9007199254740993", 9007199254740993),
        ("", None),
        (None, None),
    ]
    check(spark, casts.to_long, cases)
    by_type = lambda c: casts.to_long(c, T.DoubleType())
    check(spark, by_type, [(2.0, 2), (1.5, None), (None, None)], "double")


def test_to_double(spark):
    cases = [("1e3", 1000.0), ("abc", None), ("12d", None), ("-0.5", -0.5), (".5", 0.5), (None, None)]
    check(spark, casts.to_double, cases)


def test_to_bool(spark):
    cases = [
        ("1", True),
        ("true", True),
        ("True", True),
        ("0", False),
        ("false", False),
        ("False", False),
        ("TRUE", None),
        ("yes", None),
        (None, None),
    ]
    check(spark, casts.to_bool, cases)
    numeric = lambda c: casts.to_bool(c, T.DoubleType())
    check(spark, numeric, [(1.0, True), (0.0, False), (2.0, None)], "double")


def test_to_timestamp(spark):
    shown = lambda c: F.date_format(
        casts.to_timestamp(c, formats=("dd/MM/yyyy HH:mm",)), "yyyy-MM-dd HH:mm:ss"
    )
    cases = [
        ("2024-01-01T23:00:00-03:00", "2024-01-02 02:00:00"),
        ("2024-01-01", "2024-01-01 00:00:00"),
        ("05/01/2024 10:30", "2024-01-05 10:30:00"),
        ("9999-12-31", "9999-12-31 00:00:00"),
        ("1826-04-29", "1826-04-29 00:00:00"),
        ("ontem", None),
        (None, None),
    ]
    check(spark, shown, cases)


def test_valid_id(spark):
    cases = [("12", True), ("0", False), ("-1", False), ("1.5", False), ("abc", False), ("NaN", False), (None, False)]
    check(spark, casts.valid_id, cases)


def test_amount(spark):
    cases = [("12.345", Decimal("12.35")), ("x", Decimal("0.00")), (None, Decimal("0.00"))]
    check(spark, casts.amount, cases)


def test_date_keys(spark):
    days = [dt.date(2024, 1, 5), dt.date(9999, 12, 31), None]
    keys = apply(spark, dates.date_key, days, "date")
    assert keys == [20240105, 99991231, None]
    assert apply(spark, dates.key_date, keys, "int") == days
    assert dates.key_of(days[0]) == 20240105


def test_percent(spark):
    cases = [(0.9125, Decimal("91.3")), (0.5, Decimal("50.0")), (None, None)]
    check(spark, dates.percent, cases, "double")


def test_labels_and_fills(spark):
    check(spark, lambda c: text.filled(c, "X"), [(None, "X"), ("", "X"), ("  ", "X"), (" saúde ", "SAÚDE")])
    check(spark, text.blank_to_null, [("", None), (" ", " "), ("a", "a")])
    check(spark, lambda c: text.three_way(c, **RESULTS), [(True, "Aprovado"), (False, "Rejeitado"), (None, "NÃO INFORMADO")], "boolean")
    check(spark, lambda c: text.two_way(c > 1), [(2, "Sim"), (1, "Não"), (None, "Não")], "int")


def test_trim_takes_spaces_only(spark):
    check(spark, F.trim, [("\t a ", "\t a")])
    check(spark, text.strip, [("\t a  \n", "a"), ("  ", ""), (None, None)])


def test_first_item_label(spark):
    schema = "a array<struct<siglaTipo: string, numero: int, ano: int>>, b array<struct<siglaTipo: string, numero: int, ano: int>>"
    rows = [
        ([("PEC", 32, 2015), ("PL", 1, 2020)], [("PL", 9, 2021)]),
        ([], [("PL", 9, 2021)]),
        (None, None),
        ([], []),
        ([("PEC", None, 2015)], []),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(text.first_item_label(F.col("a"), F.col("b"))).collect()]
    assert got == ["PEC 32/2015", "PL 9/2021", None, None, None]


@pytest.mark.parametrize("long, has", [("detalhe", True), (None, False), (" \n ", False)])
def test_prompt(spark, long, has):
    df = spark.createDataFrame([("  curta\n", long)], "s string, l string")
    got = df.select(text.prompt(F.col("s"), F.col("l"), **PROMPT)).first()[0]
    assert got.startswith("Ementa: curta\n\n")
    assert ("Texto completo: detalhe" in got) is has


def test_escape_html(spark):
    check(spark, text.escape_html, [("a<b>&c", "a&lt;b&gt;&amp;c")])


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(
        vectors.normalize(F.col("a")).alias("u"),
        vectors.normalize(F.col("z")).alias("zero"),
        vectors.dot(F.col("a"), F.col("a")).alias("d"),
        vectors.cosine(F.col("a"), F.col("z")).alias("c"),
        vectors.to_text(F.col("a")).alias("t"),
        vectors.from_text(vectors.to_text(F.col("a"))).alias("back"),
    ).first()
    assert row["u"] == pytest.approx([0.6, 0.8])
    assert (row["zero"], row["d"], row["c"]) == (None, 25.0, None)
    assert (row["t"], row["back"]) == ("[3.00000000,4.00000000]", [3.0, 4.0])


def test_uri_tails_need_no_pattern(spark):
    texts = ["https://x/api/orgaos/12", "12", "a/", "", "/", None, "a/é 1", "a/12\n", "a/\n", "a//b", "x\n/7"]
    df = spark.createDataFrame([(t,) for t in texts], "u string")
    tail = F.regexp_substr("u", F.lit("[^/]+$"))
    got = df.select(casts.uri_tail(F.col("u")).alias("new"), tail.alias("old")).collect()
    assert [r.new for r in got] == [r.old for r in got]
    assert "regexp" not in df.select(casts.uri_id(F.col("u")))._jdf.queryExecution().optimizedPlan().toString()
