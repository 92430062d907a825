"""A small bank: hand-written batches for a few days, and helpers to deliver and spoil them."""
from __future__ import annotations

import hashlib
import json
import os
from datetime import date, datetime, timedelta
from decimal import Decimal, InvalidOperation
from zoneinfo import ZoneInfo

import pandas as pd

from millrace.registry import BY_ENTITY

START = date(2026, 9, 14)          # a Monday


def folder(root, feed, day):
    return os.path.join(root, feed.source, feed.entity, f"{day:%Y}", f"{day:%m}", f"{day:%d}")


def to_line(row) -> str:
    return row if isinstance(row, str) else json.dumps(row, ensure_ascii=False, separators=(",", ":"))


def number(text):
    try:
        return Decimal(str(text))
    except InvalidOperation:
        return None


def announced_totals(feed, rows):
    """What a sender would announce: the feed's amounts by currency, from the rows that are objects."""
    if not feed.amount:
        return None
    table = pd.DataFrame([r for r in rows if isinstance(r, dict)], dtype=object)
    if feed.amount not in table:
        return {}
    names = table[feed.currency].map(str) if feed.currency in table else pd.Series("ALL", table.index)
    sums = table[feed.amount].map(number).dropna().groupby(names).sum()
    return {name: f"{total:.2f}" for name, total in sums.items()}


def put_file(root, feed, day, rows, part=1):
    path = folder(root, feed, day)
    os.makedirs(path, exist_ok=True)
    data = "".join(to_line(r) + "\n" for r in rows).encode("utf-8")
    name = f"part-{part:04d}.jsonl"
    with open(os.path.join(path, name), "wb") as f:
        f.write(data)
    return {"name": name, "records": len(rows), "sha256": hashlib.sha256(data).hexdigest()}


def put_manifest(root, feed, day, files, rows, **changes):
    document = {"schema_version": "1.0", "source": feed.source, "entity": feed.entity, "business_date": day.isoformat(),
                "files": files, "record_count": len(rows), "amount_field": feed.amount, "currency_field": feed.currency,
                "amount_totals": announced_totals(feed, rows), "generated_at": f"{day + timedelta(days=1)}T00:30:00Z", **changes}
    with open(os.path.join(folder(root, feed, day), "_manifest.json"), "w", encoding="utf-8") as f:
        json.dump(document, f)


def deliver(root, entity, day, rows, **changes):
    feed = BY_ENTITY[entity]
    put_manifest(root, feed, day, [put_file(root, feed, day, rows)], rows, **changes)


def seq(day, n):
    return int(f"{day:%Y%m%d}") * 10_000_000 + n


def at(day, hour=12, minute=0):
    local = datetime(day.year, day.month, day.day, hour, minute, tzinfo=ZoneInfo("Europe/Vilnius"))
    return local.astimezone(ZoneInfo("UTC")).strftime("%Y-%m-%dT%H:%M:%SZ")


def change(day, n, op="I", **fields):
    return {"op": op, "change_seq": seq(day, n), "change_ts": at(day, 4, n), **fields}


def customer(day, n, cid, op="I", **fields):
    base = {"customer_id": cid, "old_customer_id": None, "first_name": "Rasa", "last_name": "Ona", "email": "x@example.com",
            "phone": "+370600000", "date_of_birth": "1990-01-01", "city": "Vilnius", "country": "LT", "segment": "mass",
            "kyc_status": "verified", "risk_rating": "low", "customer_since": "2020-01-01"}
    return change(day, n, op, **{**base, **fields})


def merchant(day, n, mid, op="I", **fields):
    base = {"merchant_id": mid, "merchant_name": mid, "mcc": "5411", "category": "Groceries", "city": "Vilnius", "country": "LT"}
    return change(day, n, op, **{**base, **fields})


def txn(day, n, kind="purchase", **fields):
    letter = {"purchase": "P", "refund": "R", "bill_payment": "B", "transfer_out": "X", "salary_in": "S"}[kind]
    base = {"transaction_id": f"T{day:%Y%m%d}{letter}{n}", "event_ts": at(day, 12, n % 60), "transaction_type": kind,
            "customer_id": "C-1", "account_id": "A-1", "payment_method": "debit_card", "channel": "pos", "merchant_id": None,
            "biller_id": None, "bill_reference": None, "due_date": None, "counterparty_iban": None,
            "original_transaction_id": None, "amount": "10.00", "currency": "EUR", "status": "completed"}
    if kind == "purchase":
        base["merchant_id"] = "M-1"
    if kind == "bill_payment":
        base.update(biller_id="B-1", bill_reference="r", due_date=day.isoformat(), payment_method="bank_transfer", channel="web")
    return {**base, **fields}


def transactions(day):
    """The clean transactions of a day."""
    rows = [txn(day, 1), txn(day, 2, customer_id="C-2", account_id="A-2", merchant_id="M-2", amount="43.00", currency="PLN",
                             channel="online"),
            txn(day, 3, "bill_payment", amount="30.00", due_date=(day - timedelta(days=2)).isoformat()),
            txn(day, 4, status="declined", amount="99.00")]
    if day == START + timedelta(days=2):
        rows.append(txn(day, 5, "refund", original_transaction_id=f"T{START:%Y%m%d}P1", merchant_id="M-1", amount="4.00"))
    if day == START:
        rows.append(txn(day, 6, "salary_in", amount="1000.00", channel="bank_network", payment_method="bank_transfer"))
    return rows


DAYS = [START + timedelta(days=i) for i in range(9)]      # Mon 14 .. Tue 22


def master_data(root):
    """Everything but transactions, for all days."""
    d0, d1, d2 = DAYS[:3]
    empty = {"customers": {}, "accounts": {}, "account_holders": {}, "merchants": {}, "support_cases": {}, "kyc_checks": {}}
    rows = {
        "customers": {d0: [customer(d0, 1, "C-1"), customer(d0, 2, "C-2", segment="premium", risk_rating="high")],
                      d1: [customer(d1, 1, "C-1", "U", segment="affluent")],
                      # the key change carries the row on, under a new id
                      d2: [customer(d2, 1, "C-9", "U", old_customer_id="C-2", segment="premium", risk_rating="high")]},
        "accounts": {d0: [change(d0, 1, account_id="A-1", account_type="current", status="active", currency="EUR",
                                 open_date="2020-01-01", credit_limit=None),
                          change(d0, 2, account_id="A-2", account_type="current", status="active", currency="EUR",
                                 open_date="2020-01-01", credit_limit=None)]},
        "account_holders": {d0: [change(d0, 1, account_id="A-1", customer_id="C-1", role="primary"),
                                 change(d0, 2, account_id="A-2", customer_id="C-2", role="primary")],
                            d2: [change(d2, 1, "D", account_id="A-2", customer_id="C-2", role="primary"),
                                 change(d2, 2, "I", account_id="A-2", customer_id="C-9", role="primary")]},
        "merchants": {d0: [merchant(d0, 1, "M-1"), merchant(d0, 2, "M-2", country="PL", category="Fuel")]},
        "kyc_checks": {d1: [{"kyc_check_id": "K-1", "check_ts": at(d1), "customer_id": "C-1", "check_type": "periodic_review",
                             "result": "pass", "provider": "p"}]},
        "support_cases": {d1: [change(d1, 1, case_id="CS-1", customer_id="C-2", channel="chat", reason="card_issue",
                                      status="opened", opened_ts=at(d1, 9), first_response_ts=None, resolved_ts=None)],
                          d2: [change(d2, 1, "U", case_id="CS-1", customer_id="C-9", channel="chat", reason="card_issue",
                                      status="in_progress", opened_ts=at(d1, 9), first_response_ts=at(d2, 10), resolved_ts=None)],
                          DAYS[4]: [change(DAYS[4], 1, "U", case_id="CS-1", customer_id="C-9", channel="chat", reason="card_issue",
                                           status="resolved", opened_ts=at(d1, 9), first_response_ts=at(d2, 10),
                                           resolved_ts=at(DAYS[4], 9))]},
    }
    for entity in empty:
        for day in DAYS:
            deliver(root, entity, day, rows[entity].get(day, []))
    for i, day in enumerate(DAYS):
        billers = [{"biller_id": "B-1", "biller_name": "Energy", "bill_type": "utility"}]
        if i < 5:
            billers.append({"biller_id": "B-2", "biller_name": "TV", "bill_type": "internet"})
        deliver(root, "billers", day, billers)
        deliver(root, "invest_products", day, [
            {"isin": "X1", "product_name": "Bond", "asset_class": "bond_fund", "risk_level": 2, "currency": "EUR"},
            {"isin": "X2", "product_name": "Tech", "asset_class": "etf", "risk_level": 6 if i < 4 else 7, "currency": "EUR"}])
        if day.weekday() < 5:
            deliver(root, "fx_rates", day, [{"rate_date": day.isoformat(), "base_currency": "EUR", "currency": "PLN",
                                             "rate": f"4.{30 + i}00", "source": "s"}])
            deliver(root, "holdings", day, [
                {"business_date": day.isoformat(), "customer_id": "C-1", "isin": "X1", "units": "10.0000",
                 "price": f"{20 + i}.0000", "market_value": f"{10 * (20 + i)}.00", "currency": "EUR"},
                {"business_date": day.isoformat(), "customer_id": "C-1", "isin": "X2", "units": "1.0000",
                 "price": "50.0000", "market_value": "50.00", "currency": "EUR"}])
    first = date(2026, 10, 1)
    deliver(root, "credit_scores", first, [
        {"report_month": "2026-09", "customer_id": "C-1", "score": 700, "risk_band": "B", "open_credit_lines": 1,
         "days_past_due_max": 2, "bureau": "b"},
        {"report_month": "2026-09", "customer_id": "C-9", "score": 820, "risk_band": "A", "open_credit_lines": 0,
         "days_past_due_max": 0, "bureau": "b"}])


def all_transactions(root, days=DAYS):
    for day in days:
        deliver(root, "transactions", day, transactions(day))
