from decimal import Decimal

from barlens.functions import (after_first_colon, cap_bucket, crossover, decode_entities,
                               normalize_code, parse_count, parse_price, pnl_columns)


def test_cap_bucket_boundaries(spark):
    caps = [None, 5e10, 5e11, 2e12, 2e12 + 1, 5e10 - 1]
    df = spark.createDataFrame([(c,) for c in caps], "m double")
    got = [r[0] for r in df.select(cap_bucket("m")).collect()]
    assert got == ["Unknown", "Small Cap", "Mid Cap", "Mid Cap", "Large Cap", "Micro Cap"]


def test_text_numbers(spark):
    texts = ["1,231.50", " 12 ", "12.0", "NaN", "-", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(parse_price("t").alias("p"), parse_count("t").alias("c")).collect()
    assert [r.p for r in rows] == [Decimal("1231.5000"), Decimal("12.0000"), Decimal("12.0000"),
                                   None, None, None, None]
    assert [r.c for r in rows] == [1231, 12, 12, None, None, None, None]


def test_after_first_colon(spark):
    df = spark.createDataFrame([("RELI",), ("NSEI:A:B",), ("NSEI:RELIANCE",), (None,)], "u string")
    assert [r[0] for r in df.select(after_first_colon("u")).collect()] == [None, "A:B", "RELIANCE", None]


def test_normalize_and_entities(spark):
    df = spark.createDataFrame([("  abc ", "Finance &amp; Investments &amp;lt;")], "a string, b string")
    r = df.select(normalize_code("a"), decode_entities("b")).first()
    assert r[0] == "ABC"
    assert r[1] == "Finance & Investments &lt;"


def test_crossover_strict_and_loose(spark):
    rows = [(2.0, 1.0, 1.0, 1.0),    # touch then cross: strict none, loose BUY
            (2.0, 1.0, 0.5, 1.0),    # cross up
            (0.5, 1.0, 2.0, 1.0),    # cross down
            (2.0, 1.0, None, None)]  # first row: no previous
    df = spark.createDataFrame(rows, "f double, s double, pf double, ps double")
    got = df.select(crossover("f", "s", "pf", "ps").alias("a"),
                    crossover("f", "s", "pf", "ps", strict=False).alias("b")).collect()
    assert [r.a for r in got] == [None, "BUY", "SELL", None]
    assert [r.b for r in got] == ["BUY", "BUY", "SELL", None]


def test_pnl_is_exact_decimal(spark):
    df = spark.createDataFrame([(Decimal("300.0000"), Decimal("301.0050"))],
                               "buy_price decimal(10,4), sell_price decimal(10,4)")
    r = df.withColumns(pnl_columns()).first()
    # 100000/300 = 333.333333333333 (12 places) * 301.005 - 100000 = 335.00 (HALF_UP)
    assert r.shares_bought == Decimal("333.33")
    assert r.profit_or_loss == Decimal("335.00")
    assert r.percent_profit_loss == Decimal("0.34")
    zero = spark.createDataFrame([(Decimal(0), Decimal(1))], "buy_price decimal(10,4), sell_price decimal(10,4)")
    assert zero.withColumns(pnl_columns()).first().shares_bought is None


def test_sql_text_rules_match_column_rules(spark):
    from barlens.functions import sqlexpr as X
    rows = [(t, m, f, s, pf, ps, b, e) for t, m, f, s, pf, ps, b, e in [
        ("1,231.50", None, 2.0, 1.0, 1.0, 1.0, Decimal("300.0000"), Decimal("301.0050")),
        (" 12.0 ", 5e10, 0.5, 1.0, 2.0, 1.0, Decimal("999.9900"), Decimal("12.3400")),
        ("-", 2e12 + 1, 2.0, 1.0, None, 1.0, Decimal("0.0001"), Decimal("999999.9999")),
        ("NaN", 4.9e11, 1.0, 1.0, 1.0, 2.0, Decimal("1.0000"), Decimal("1.0000"))]]
    df = spark.createDataFrame(rows, "t string, m double, f double, s double, pf double, ps double, "
                                     "buy_price decimal(10,4), sell_price decimal(10,4)")
    col = df.select(parse_price("t").alias("a"), parse_count("t").alias("b"), cap_bucket("m").alias("c"),
                    crossover("f", "s", "pf", "ps").alias("d"),
                    crossover("f", "s", "pf", "ps", strict=False).alias("e"),
                    *[v.alias(k) for k, v in pnl_columns().items()]).collect()
    sql = df.selectExpr(f"{X.parse_price('t')} AS a", f"{X.parse_count('t')} AS b",
                        f"{X.cap_bucket('m')} AS c", f"{X.crossover('f', 's', 'pf', 'ps')} AS d",
                        f"{X.crossover('f', 's', 'pf', 'ps', False)} AS e", *X.pnl()).collect()
    assert [tuple(r) for r in col] == [tuple(r) for r in sql]
