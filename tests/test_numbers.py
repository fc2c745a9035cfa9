"""Published sample numbers the operators have to agree with, and hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketmill.operators import analyst as A
from marketmill.operators import calendars as H
from marketmill.operators import holdings as J
from marketmill.operators import insiders as K
from marketmill.operators import macro as N
from marketmill.operators import maintain as B
from marketmill.operators import prices as P
from marketmill.operators import search as C
from marketmill.operators import valuation as V

D = dt.date.fromisoformat


def test_bar_identities(spark):
    ts = [dt.datetime(2025, 2, 4, h) for h in (10, 11, 12, 13)]
    rows = [("A", t, p, 1, i) for i, (t, p) in enumerate(zip(ts, (227.2, 233.13, 226.65, 232.8)))]
    r = P.bars_eod(spark.createDataFrame(rows, "symbol string, ts timestamp, price double, size bigint, id bigint")).first()
    assert (r.open, r.high, r.low, r.close, r.volume) == (227.2, 233.13, 226.65, 232.8, 4)
    assert round(r.change, 2) == 5.6 and round(r.changePercent, 5) == 2.46479 and round(r.vwap, 2) == 230.86


def test_open_and_close_follow_time_then_id(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("A", t, 3.0, 1, 2**62), ("A", t, 1.0, 1, 5), ("A", t, 2.0, 1, -(2**62))]
    r = P.bars_eod(spark.createDataFrame(rows, "symbol string, ts timestamp, price double, size bigint, id bigint")).first()
    assert (r.open, r.close) == (2.0, 3.0)


def bars(spark, closes, start="2024-01-01", symbol="A"):
    day = D(start)
    rows = [(symbol, day + dt.timedelta(i), float(c), float(c), float(c), float(c), 1) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume bigint")


def test_quote_change(spark):
    q = P.quotes(bars(spark, [228.01, 232.8])).first()
    assert round(q.change, 2) == 4.79 and round(q.changePercentage, 4) == 2.1008


def test_splits_and_dividends(spark):
    b = bars(spark, [10, 20, 30])
    split = spark.createDataFrame([("A", D("2024-01-02"), 2, 1), ("A", D("2024-01-03"), 3, 1)], "symbol string, date date, numerator bigint, denominator bigint")
    got = [round(r.adjClose, 9) for r in P.unadjust(b, split).orderBy("date").collect()]
    assert got == [60.0, 60.0, 30.0]
    div = spark.createDataFrame([("A", D("2024-01-02"), 1.0), ("A", D("2024-01-03"), 4.0), ("A", D("2024-01-01"), 1.0)], "symbol string, date date, dividend double")
    got = [round(r.adjClose, 9) for r in P.adjust_dividends(b, div).orderBy("date").collect()]
    assert got == [round(10 * 0.9 * 0.8, 9), 16.0, 30.0]


def test_price_changes(spark):
    r = P.price_changes(bars(spark, [10, 20, 30, 40, 50, 60, 90], "2023-12-30")).first()
    assert r["1D"] == 50.0 and r["5D"] == 350.0 and r["ytd"] == 350.0 and r["max"] == 800.0 and r["1M"] is None


BASE = (
    "symbol string, date date, revenue double, revenueGrowth double, ebitda double, ebit double, depreciation double, "
    "totalCash double, receivables double, inventories double, payable double, capitalExpenditure double, "
    "operatingCashFlow double, sellingGeneralAndAdministrativeExpenses double, price double, "
    "dilutedSharesOutstanding double, totalDebt double, beta double, taxRateCash double"
)


def dcf_base(spark, growth=0.0):
    scale = (1 + growth) ** 5
    year5 = dict(revenue=657173266965, ebitda=205521399637, ebit=182813984515, dep=22707415125, rec=100795299078,
                 inv=10202330691, pay=106124867281, capex=20111200574, ocf=189682120638)
    v = {k: x / scale for k, x in year5.items()}
    row = ("AAPL", D("2024-09-28"), v["revenue"], growth, v["ebitda"], v["ebit"], v["dep"], 106629e6 - 76686e6, v["rec"], v["inv"],
           v["pay"], v["capex"], v["ocf"], 0.0, 232.8, 15408095000.0, 106629e6, 1.244, 0.1491958)
    return spark.createDataFrame([row], BASE)


def test_levered_dcf_numbers(spark):
    r = V.dcf_levered(dcf_base(spark, 0.1094)).filter("year = '2029'").first()
    near = lambda a, b, tol=1e-6: abs(a / b - 1) < tol
    assert round(r.costOfEquity, 2) == 9.51 and round(r.wacc, 2) == 9.33 and near(r.wacc, 9.326497)
    assert round(r.debtWeighting, 2) == 2.89 and round(r.equityWeighting, 2) == 97.11
    assert near(r.totalEquity, 3587004516000) and r.netDebt == 76686000000
    assert near(r.freeCashFlow, 209793321212) and near(r.freeCashFlowT1, 218185054060)
    assert near(r.pvLfcf, 134327365439) and near(r.terminalValue, 4096220460472) and near(r.presentTerminalValue, 2622745564702)


def test_unlevered_dcf_numbers(spark):
    r = V.dcf_custom(dcf_base(spark, 0.1094)).filter("year = '2029'").first()
    near = lambda a, b, tol=1e-6: abs(a / b - 1) < tol
    assert near(r.ebiat, 155538906468) and near(r.revenue, 657173266965)
    assert near(r.freeCashFlowT1, r.ufcf * 1.04)
    assert near(r.terminalValue, r.freeCashFlowT1 / (r.wacc / 100 - 0.04))
    assert near(r.equityValuePerShare, (r.sumPvUfcf + r.presentTerminalValue - 76686000000) / 15408095000)


def test_dcf_assumptions(spark):
    base = dcf_base(spark)
    with pytest.raises(TypeError):
        V.dcf_custom(base, nonsense=1)
    r = V.dcf_custom(base, long_term_growth_rate=20.0).first()
    assert r.terminalValue is None and r.equityValuePerShare is None
    assert V.dcf_custom(base, cost_of_equity=10.0).first().costOfEquity == 10.0
    grid = spark.createDataFrame([(1.0,), (1.244,)], "beta double")
    assert sorted(round(r.wacc, 4) for r in V.dcf_sweep(base, grid).collect())[1] == 9.3265


def test_holder_performance_identity(spark):
    # one filer, one quarter-end price for the market: the sample position and a second filer fix the price
    px, last = 171.21, 252876459509 / 1303688506
    rows = [("1", "AAPL", "T", D("2023-06-30"), 1303688506, 252876459509.0, "Share"),
            ("1", "AAPL", "T", D("2023-09-30"), 1299997133, 1299997133 * px, "Share"),
            ("1", "GONE", "T", D("2023-06-30"), 10, 100.0, "Share"), ("1", "NEW", "T", D("2023-09-30"), 10, 100.0, "Call"),
            ("2", "AAPL", "T", D("2023-06-30"), 5, 5 * last, "Share")]
    h = spark.createDataFrame(rows, "cik string, symbol string, industry string, date date, shares bigint, value double, putCallShare string")
    out = spark.createDataFrame([("AAPL", 15599000000), ("GONE", 100), ("NEW", 100)], "symbol string, outstanding bigint")
    a = {(r.cik, r.symbol, str(r.date)): r for r in J.holder_analytics(J.positions(h), out).collect()}
    r = a[("1", "AAPL", "2023-09-30")]
    assert abs(r.performance / -29671950396 - 1) < 1e-6 and round(r.performancePercentage, 4) == -11.7338
    assert r.changeInSharesNumber == -3691373 and round(r.changeInSharesNumberPercentage, 4) == -0.2831
    assert round(r.changeInMarketValuePercentage, 3) == -11.984
    assert r.holdingPeriod == 2 and str(r.firstAdded) == "2023-06-30" and not r.isNew and not r.isSoldOut
    assert a[("1", "GONE", "2023-09-30")].isSoldOut and a[("1", "NEW", "2023-09-30")].isNew
    assert not a[("1", "GONE", "2023-06-30")].isNew
    # the second filer filed no third quarter, so its position is not sold out
    assert ("2", "AAPL", "2023-09-30") not in a
    p = J.holder_performance(J.holder_analytics(J.positions(h), out), cik="1").orderBy("date").collect()[1]
    assert (p.portfolioSize, p.securitiesAdded, p.securitiesRemoved, p.turnover) == (2, 1, 1, 1.0)


def test_insider_stats_identity(spark):
    rows = [("A", D("2024-11-01"), "A", "A-Award", 994544 // 6 if i else 994544 - 5 * (994544 // 6)) for i in range(6)]
    rows += [("A", D("2024-11-01"), "D", "S-Sale", 2297088 // 38 if i else 2297088 - 37 * (2297088 // 38)) for i in range(38)]
    f = spark.createDataFrame(rows, "symbol string, filingDate date, acquisitionOrDisposition string, transactionType string, securitiesTransacted bigint")
    r = K.insider_stats(f).first()
    assert round(r.acquiredDisposedRatio, 4) == 0.1579 and r.totalAcquired == 994544 and r.totalSales == 38
    assert round(r.averageAcquired, 4) == 165757.3333 and round(r.averageDisposed, 4) == 60449.6842


def test_economic_calendar_identity(spark):
    r = spark.createDataFrame([(D("2024-03-01"), -0.112, -0.096)], "date date, previous double, actual double")
    out = N.economic_calendar(r).first()
    assert round(out.change, 3) == 0.016 and round(out.changePercentage, 3) == 14.286


def test_cot_analysis_identity(spark):
    rows = [("B6", D("2024-02-20"), 46312 + 10000, 10000), ("B6", D("2024-02-27"), 46358 + 10000, 10000), ("B6", D("2024-03-05"), 1, 2)]
    rep = spark.createDataFrame(rows, "symbol string, date date, noncommPositionsLongAll bigint, noncommPositionsShortAll bigint")
    r = N.cot_analysis(rep).orderBy("date").collect()
    assert (r[1].netPosition, r[1].previousNetPosition, round(r[1].changeInNetPosition, 1)) == (46358, 46312, 0.1)
    assert r[1].marketSentiment == "Increasing Bullish" and r[1].reversalTrend is False and r[2].reversalTrend is True


def test_grades(spark):
    rows = [("A", "f", D("2024-01-05"), 1, "hold"), ("A", "f", D("2024-01-05"), 2, "buy"), ("A", "f", D("2024-02-05"), 3, "sell"),
            ("A", "g", D("2024-03-05"), 4, "strongBuy")]
    g = spark.createDataFrame(rows, "symbol string, gradingCompany string, date date, id bigint, newGrade string")
    got = {r.id: (r.previousGrade, r.action) for r in A.grades(g).collect()}
    assert got == {1: (None, "initialise"), 2: ("hold", "upgrade"), 3: ("buy", "downgrade"), 4: (None, "initialise")}
    hist = [(str(r.date), r.strongBuy, r.buy, r.hold, r.sell) for r in A.grades_history(g).orderBy("date").collect()]
    assert hist == [("2024-01-31", 0, 1, 0, 0), ("2024-02-29", 0, 0, 0, 1), ("2024-03-31", 1, 0, 0, 1)]
    c = A.grades_consensus(g).first()
    assert (c.consensus, c.buyPercent) == ("Strong Buy", 50.0)


def test_us_only(spark):
    rows = [("AAPL", "USD", 1), ("AAPL", "usd", 1), ("^AEX", "EUR", 0), ("^GSPC", None, 1), ("BRK-B", "  ", 1), ("0700.HK", None, 0),
            ("0P0000X", None, 0), ("", "USD", 0), (None, "USD", 0), ("X", " USD ", 0)]
    df = spark.createDataFrame(rows, "symbol string, currency string, keep int")
    assert C.us_only(df).agg(F.min("keep"), F.count("*")).first() == (1, 4)
    assert C.us_only(df, None).count() == 6


def test_quarantine(spark):
    rows = [(1, " aapl ", "2024-99-99", 10, 0), (2, "a", "2024/01/01", None, None), (3, " ", None, 1, 0), (4, "a", "", 0, -1),
            (5, "a", "20240-1-01", 10001, None), (6, None, "2024-01-01", 1, 1), (7, "a", "2024-1-001", 1, 1)]
    df = spark.createDataFrame(rows, "id int, symbol string, date string, limit int, page int")
    valid, bad = C.quarantine(df)
    assert [(r.id, r.symbol) for r in valid.orderBy("id").collect()] == [(1, "AAPL"), (7, "A")]
    assert {r.id: list(r.reasons) for r in bad.collect()} == {
        2: ["date"], 3: ["symbol"], 4: ["limit", "page"], 5: ["limit"], 6: ["symbol"]
    }
    assert {r.id: list(r.reasons) for r in C.quarantine(df, strict=True)[1].collect()}[1] == ["date"]


def test_screen_rejects_unknown_bounds(spark):
    df = spark.createDataFrame([("a", "A", 1.0, 2.0)], "symbol string, companyName string, marketCap double, price double")
    assert C.screen(df, price_more_than=2.0).count() == 0 and C.screen(df, price_more_than=1.9, sector=None).count() == 1
    with pytest.raises(TypeError):
        C.screen(df, size_more_than=1)


def test_ipo_total(spark):
    rows = [("A", D("2024-01-01"), "prospectus", 10.0, 100, 1000.0), ("B", D("2024-01-01"), "prospectus", 10.0, 100, 900.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, kind string, pricePublicPerShare double, shares bigint, pricePublicTotal double")
    assert {r.symbol: r.totalAgrees for r in H.ipos(df, "prospectus").collect()} == {"A": True, "B": False}


def test_summary_stats(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    assert tuple(C.summary_stats(df, "a").first()) == (2, 1.0, 3.0, 2.0)
    assert tuple(C.summary_stats(df, "b").first()) == (3, None, None, None)
    assert tuple(C.summary_stats(df.limit(0), "a").first()) == (0, None, None, None)


def test_null_close_does_not_end_a_series(spark):
    from marketmill.operators import indicators as I

    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]
    close = [100.0 + (i * 7) % 11 for i in range(40)]
    schema = "symbol string, date date, high double, low double, close double"
    specs = [(n, n, 3) for n in ("ema", "dema", "tema", "rsi", "adx")]
    full = [("A", d, c + 1, c - 1, c) for d, c in zip(days, close)]
    holed = full[:20] + [("A", dt.date(2024, 6, 1), 1.0, None, None)] + full[20:]
    holed = [("A", dt.date(2025, 1, 1) + dt.timedelta(i), *r[2:]) for i, r in enumerate(holed)]
    a = [r[5:] for r in I.indicators(spark.createDataFrame(full, schema), specs).orderBy("date").collect()]
    b = [r[5:] for r in I.indicators(spark.createDataFrame(holed, schema), specs).orderBy("date").collect()]
    assert b[20] == (None,) * 5
    assert [[round(x, 9) if x is not None else x for x in r] for r in b[:20] + b[21:]] == [
        [round(x, 9) if x is not None else x for x in r] for r in a
    ]


def test_total_loss_stays_a_loss(spark):
    from marketmill.operators import holdings as H

    rows = [("1", dt.date(2024, 3 * q, 28), "S", False, False, 1, 100.0, 100.0, p) for q, p in ((1, -100.0), (2, 10.0))]
    a = spark.createDataFrame(rows, "cik string, date date, symbol string, isNew boolean, isSoldOut boolean, "
                              "holdingPeriod int, marketValue double, lastMarketValue double, performance double")
    assert [r["performancePercentage1year"] for r in H.holder_performance(a).collect()] == [-100.0, -100.0]


def test_null_filers_are_a_group_and_undated_positions_are_left_out(spark):
    schema = "cik string, symbol string, industry string, date date, putCallShare string, shares long, value double"
    day = [dt.date(2024, 3, 31), dt.date(2024, 6, 30)]
    rows = [(c, "x", "i", d, "Share", 10, 100.0) for c in (None, "1") for d in (*day, None)]
    pos = J.positions(spark.createDataFrame(rows, schema))
    shares = spark.createDataFrame([("x", 1000)], "symbol string, outstanding long")
    got = J.holder_analytics(pos, shares).orderBy("cik", "date").collect()
    assert [(r.cik, r.date) for r in got] == [(c, d) for c in (None, "1") for d in day]
    assert [r.isNew for r in got] == [False] * 4 and [r.holdingPeriod for r in got] == [1, 2, 1, 2]
    per = J.holder_performance(J.holder_analytics(pos, shares)).collect()
    assert len(per) == 4 and all(r.averageHoldingPeriodTop10 is not None for r in per)


def test_null_scopes_keep_one_checkpoint(spark):
    seen = spark.createDataFrame([(None, dt.date(2024, 5, 1)), ("a", dt.date(2024, 1, 1))], "k string, date date")
    old = spark.createDataFrame([(None, dt.date(2024, 1, 1)), ("a", dt.date(2024, 2, 1))], "k string, checkpoint date")
    got = {(r.k, str(r.checkpoint)) for r in B.advance_checkpoints(seen, old, ["k"], "date").collect()}
    assert got == {(None, "2024-05-01"), ("a", "2024-02-01")}
