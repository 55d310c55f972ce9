"""Validation (V1-V9) on planted faults."""

from tidemark.operators.validate import issue_report, total_issues


def _count(report, check, column=None):
    rows = [r for r in report.collect() if r["check"] == check and (column is None or r["column"] == column)]
    return rows[0]["count"] if rows else None


def test_detects_null_customer_id(make_raw, raw_rows):
    raw_rows[0]["Customer Id"] = None
    assert _count(issue_report(make_raw(raw_rows)), "null_customer_id") == 1


def test_detects_negative_price(make_raw, raw_rows):
    raw_rows[0]["Product Price"] = "-10"
    assert _count(issue_report(make_raw(raw_rows)), "negative_price") == 1


def test_detects_duplicates(make_raw, raw_rows):
    df = make_raw(raw_rows)
    assert _count(issue_report(df.unionByName(df)), "duplicates") == 2


def test_null_ids_count_as_one_value(make_raw, raw_rows):
    raw_rows[0]["Order Item Id"] = None
    raw_rows[1]["Order Item Id"] = None
    assert _count(issue_report(make_raw(raw_rows)), "duplicates") == 1


def test_null_status_is_unknown_and_dates_checked(make_raw, raw_rows):
    raw_rows[0]["Delivery Status"] = None
    raw_rows[1]["order date (DateOrders)"] = "31/31/2017 25:99"
    rep = issue_report(make_raw(raw_rows))
    assert _count(rep, "unknown_delivery_status") == 1
    assert _count(rep, "invalid_date", "order date (DateOrders)") == 1
    # V1 counts the NULL status too, with a percentage
    miss = [r for r in rep.collect() if r["check"] == "missing_values" and r["column"] == "Delivery Status"]
    assert miss[0]["count"] == 1 and miss[0]["pct"] == 50.0


def test_total_issues(make_raw, raw_rows):
    rep = issue_report(make_raw(raw_rows))
    total = total_issues(rep).collect()[0]["total_issues"]
    assert total == sum(r["count"] for r in rep.collect())
