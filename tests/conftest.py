import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SAMPLE_ORDERS = """order_id,customer_id,product_name,category,quantity,unit_price,order_date,shipping_city,shipping_country,payment_method,status
O1,C1,lamp,electronics,2,10.50,2024-01-01T08:00:00Z,x,us,card,completed
O2,C1,desk,furniture,1,100.00,2024-01-01T09:00:00Z,x,de,card,completed
O3,C2,usb,electronics,3,5.25,2024-01-02T09:00:00Z,x,us,card,completed
O4,C2,usb,electronics,1,5.25,2024-01-02T09:00:00Z,x,us,card,cancelled
O5,C3,chair,furniture,4,25.00,2024-01-03T09:00:00Z,x,de,card,completed
O3,C2,usb,electronics,4,5.25,2024-01-02T09:00:00Z,x,us,card,completed
O6,C1,lamp,electronics,1,10.50,2024-01-03T10:00:00Z,x,us,card,completed
"""
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session
    s = get_session("local[4]", 8, app_name="strata-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch(tmp_path):
    """A fresh folder per test (pytest's tmp_path, a new one each run)."""
    return str(tmp_path)


@pytest.fixture(scope="session")
def sample_csv(tmp_path_factory):
    """Seven order lines: one key delivered twice, one line cancelled."""
    path = tmp_path_factory.mktemp("sample") / "orders.csv"
    path.write_text(SAMPLE_ORDERS)
    return str(path)
