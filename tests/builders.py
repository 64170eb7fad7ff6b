"""Rows of the raw feed, and results as plain values."""

from ledgerloom import schema as S

AS_OF = "2024-07-01"


def line(id, **fields):
    return {"id": id, "product_id": "p1", "title": "Thing", "quantity": "1", "price": "10.0",
            "total_discount": "0.0", **fields}


def shipment(id, **fields):
    return {"id": id, "created_at": "2024-01-02 00:00:00", "updated_at": "2024-01-03 00:00:00",
            "status": "SUCCESS", **fields}


def order(id, batch=0, customer="c1", **fields):
    """A raw row: one order as delivered by one sync batch."""
    made = {
        "id": id, "name": f"#{id}", "order_number": "1", "created_at": "2024-01-01 00:00:00",
        "updated_at": "2024-01-01 00:00:00", "total_price": "50.0", "subtotal_price": "50.0",
        "total_discounts": "0.0", "total_tax": "0.0", "total_tip_received": "0.0",
        "financial_status": "PAID", "source_name": "web", "email": "a@b.co",
        "buyer_accepts_marketing": "false",
        "_daton_batch_id": f"b{batch}", "_daton_batch_runtime": str(1_704_067_200_000 + batch * 1000),
        "customer": [{"id": customer}] if customer else [], "line_items": [], "fulfillments": None,
        **fields,
    }
    unknown = set(made) - set(S.RAW_ORDERS.names)
    assert not unknown, unknown
    return made


def by(df, key):
    return {r[key]: r for r in df.collect()}


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
