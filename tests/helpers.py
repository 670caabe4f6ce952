"""Small tables for tests, and the audit rules restated row by row in Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from ledgerlens.operators import cleaning
from ledgerlens.schema import TRANSACTION_SCHEMA, VENDOR_SCHEMA

FIELDS = TRANSACTION_SCHEMA.fieldNames()
MONDAY = dt.date(2024, 1, 8)


def payment(number, **values):
    """A clean payment on a Monday at ten, below any limit."""
    base = {
        "transaction_id": f"T{number:05d}",
        "transaction_date": MONDAY,
        "transaction_time": "10:00:00",
        "vendor_id": "V1",
        "vendor_name": "Vendor 1",
        "amount": Decimal("100.00"),
        "currency": "GBP",
        "invoice_number": f"INV-{number}",
        "payment_method": "BACS",
        "status": "posted",
    }
    return {**base, **values}


def typed(spark, payments):
    rows = [tuple(p[f] for f in FIELDS) for p in payments]
    # every column nullable: dirty rows carry NULLs where the staging schema forbids them
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRANSACTION_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


def prepared(spark, payments):
    return cleaning.prepare(typed(spark, payments))


def vendors(spark, rows):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in VENDOR_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


def ids(df):
    return sorted(r["transaction_id"] for r in df.select("transaction_id").collect())


def random_payments(seed, n, with_nulls=False):
    """Payments that collide often; vendor V1 owns a third of them."""
    rng = random.Random(seed)
    out = []
    for number in range(n):
        day = MONDAY + dt.timedelta(days=rng.randrange(60))
        values = {
            "vendor_id": "V1" if rng.random() < 0.33 else f"V{rng.randrange(2, 8)}",
            "amount": Decimal(rng.choice(["10.00", "20.00", "35.50"])),
            "currency": rng.choice(["GBP", "EUR"]),
            "invoice_number": rng.choice(["A", "B", "A ", "", "  ", None]),
            "transaction_date": day,
            "transaction_time": f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:00",
        }
        if with_nulls:
            for column in ("amount", "transaction_date", "vendor_id", "currency", "transaction_time"):
                if rng.random() < 0.08:
                    values[column] = None
        out.append(payment(number, **values))
    return out


def chain_clusters(payments, window=7):
    """Chained clusters as {id: (group, cluster number, size)}; dates first, NULL dates last."""
    groups = defaultdict(list)
    for p in payments:
        invoice = (p["invoice_number"] or "").strip() or None
        groups[(p["vendor_id"], p["amount"], p["currency"], invoice)].append(p)
    found = {}
    for key, members in groups.items():
        members.sort(key=lambda p: (p["transaction_date"] is None, p["transaction_date"] or MONDAY, p["transaction_id"]))
        clusters, last = [[]], None
        for p in members:
            day = p["transaction_date"]
            if last is not None and day is not None and (day - last).days > window:
                clusters.append([])
            clusters[-1].append(p)
            last = day
        for number, cluster in enumerate(clusters):
            for p in cluster:
                found[p["transaction_id"]] = (key, number, len(cluster))
    return found


def paired_duplicates(payments, window=7):
    """Ids with a partner under the SQL rule, by comparing all pairs."""

    def key(p):
        return p["vendor_id"], p["amount"], p["currency"], p["invoice_number"] or ""

    def match(a, b):
        if None in key(a) or None in (a["transaction_date"], b["transaction_date"]):
            return False
        near = abs((a["transaction_date"] - b["transaction_date"]).days) <= window
        return key(a) == key(b) and near and a["transaction_id"] != b["transaction_id"]

    return sorted(a["transaction_id"] for a in payments if any(match(a, b) for b in payments))
