"""Small order feeds for the streaming tests."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

EPOCH = datetime(2025, 1, 1, tzinfo=timezone.utc)

# The trace: per micro-batch, orders as (id, seconds after the epoch, product, price, address).
TRACE = [
    [("a0", 1, "p", 10, "x"), ("a1", 2, "q", 20, "x")],
    [("b0", 5, "p", 10, "x"), ("b1", 35, "p", 10, "x")],
    [("c0", 100, "p", 10, "x"), ("c1", 31, "q", 7, "y")],
    [("d0", 3, "p", 999, "late"), ("d1", 105, "q", 10, "x")],
]


def order_json(order_id, second, product, price, ip, quantity=1):
    return json.dumps(
        {
            "order_id": order_id,
            "timestamp": (EPOCH + timedelta(seconds=second)).isoformat(),
            "user_id": "USER1000",
            "product_id": product,
            "product_name": product,
            "price": price,
            "quantity": quantity,
            "ip_address": ip,
            "payment_method": "card",
        }
    )


def write_batch(folder, number, lines):
    """One file per micro-batch, its file time rising with its number so that files are read in order."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number:03d}.json")
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + 10 * number,) * 2)


def write_trace(folder, batches=range(len(TRACE))):
    for number in batches:
        write_batch(folder, number, [order_json(*order) for order in TRACE[number]])
