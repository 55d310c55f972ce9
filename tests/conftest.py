import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schemas import RAW_COLUMNS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def _item(**fields):
    """A raw order item of our own: a small shop's sale, with the given fields."""
    row = dict.fromkeys(RAW_COLUMNS)
    row.update({
        "Type": "DEBIT", "Days for shipping (real)": "2", "Days for shipment (scheduled)": "4", "Benefit per order": "12.40",
        "Sales per customer": "61.20", "Delivery Status": "Advance shipping", "Late_delivery_risk": "0", "Category Id": "11",
        "Category Name": "garden tools", "Customer City": "lyon", "Customer Country": "France", "Customer Email": "hidden",
        "Customer Password": "hidden", "Customer Segment": "Home Office", "Customer State": "RH", "Customer Street": "9 quai nord",
        "Department Id": "3", "Department Name": "outdoors", "Latitude": "45.76", "Longitude": "4.84", "Market": "Europe",
        "Order City": "Málaga", "Order Country": "Spain", "Order Region": "southern europe", "Order State": "Andalucía",
        "Order Status": "COMPLETE", "Order Item Discount": "1.80", "Order Item Discount Rate": "0.03",
        "Order Item Product Price": "31.50", "Order Item Profit Ratio": "0.20", "Order Item Quantity": "2", "Sales": "63.00",
        "Order Item Total": "61.20", "Order Profit Per Order": "12.40", "Product Card Id": "77", "Order Item Cardprod Id": "77",
        "Product Category Id": "11", "Product Name": "pruning shears", "Product Price": "31.50", "Product Status": "0",
        "Shipping Mode": "Second Class", "order date (DateOrders)": "5/6/2019 9:05", "shipping date (DateOrders)": "5/8/2019 9:05"})
    row.update(fields)
    return row


FIXTURE_ROWS = [
    _item(**{"Customer Id": "41", "Order Customer Id": "41", "Customer Fname": "Noor", "Customer Lname": "Haddad",
             "Customer Zipcode": "69001", "Order Id": "900", "Order Item Id": "9001"}),
    _item(**{"Customer Id": "42", "Order Customer Id": "42", "Customer Fname": "Ilse", "Customer Lname": None,
             "Customer Zipcode": None, "Order Id": "901", "Order Item Id": "9011", "Type": "TRANSFER",
             "Days for shipping (real)": "6", "Delivery Status": "Late delivery", "Late_delivery_risk": "1",
             "Sales": "58.75", "Order Profit Per Order": "-4.10", "Order Status": "PENDING",
             "order date (DateOrders)": "11/23/2019 18:40", "shipping date (DateOrders)": "11/29/2019 18:40"}),
]


@pytest.fixture()
def raw_rows():
    return [dict(r) for r in FIXTURE_ROWS]


@pytest.fixture()
def make_raw(spark):
    from tidemark.schemas import RAW_COLUMNS, RAW_SCHEMA

    def make(rows):
        return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)
    return make


@pytest.fixture()
def tmp_dir():
    import tempfile
    return tempfile.mkdtemp(prefix="tidemark-test-", dir=os.environ.get("TMPDIR") or "/tmp")
