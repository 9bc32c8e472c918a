"""Hand-written raw rows for unit tests."""

from decimal import Decimal as D


def row(tid, cust="CUST1", prod="P1", cat="Electronics", city="Mumbai", state="S1",
        qty=1, price="10.00", disc="0.0000", total=None, pay="UPI",
        od="2024-01-10", dd="2024-01-12"):
    p, d = D(price), D(disc)
    if total is None and qty is not None:
        total = (abs(qty) * p * (1 - d)).quantize(D("0.01"))
    elif total is not None:
        total = D(total)
    return (tid, cust, prod, cat, city, state, qty, p, d, total, pay, od, dd)
