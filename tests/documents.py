"""Small documents for the tests."""

import json

from tradewind import schemas


def line(**kw):
    item = {"id": "MLB1", "title": "Thing", **kw.pop("item", {})}
    return {"quantity": 1, "unit_price": "10.00", "item": item, **kw}


def payment(id, **kw):
    return {
        "id": id, "status": "approved", "payment_method_id": "pix", "payment_type": "bank",
        "operation_type": "regular", "transaction_amount": "10.00", "total_paid_amount": "10.00",
        "date_created": "2024-01-01T10:00:00.000-04:00", "collector": {"id": 5}, **kw,
    }


def order(id, seller=5, **kw):
    return {
        "id": id, "seller": {"id": seller}, "status": "paid",
        "date_created": "2024-01-01T10:00:00.000-04:00", "total_amount": "10.00",
        "paid_amount": "10.00", "currency_id": "BRL", "order_items": [line()],
        "payments": [payment(f"p-{id}")], **kw,
    }


def listing(id, **kw):
    return {"id": id, "title": "Thing", "seller_id": 5, "status": "active", **kw}


def land(spark, path, documents, schema=schemas.RAW_ORDER, name="part"):
    """Write documents as a JSON-lines file and scan the folder."""
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{name}.json").write_text(
        "".join(json.dumps(d, ensure_ascii=False) + "\n" for d in documents), encoding="utf-8"
    )
    return spark.read.schema(schema).json(str(path))


def ordered(spark, tmp_path, documents, schema=schemas.RAW_ORDER, name="part"):
    """Documents with their place in the list as ``ord``."""
    numbered = [{**d, "ord": n} for n, d in enumerate(documents)]
    return land(spark, tmp_path / f"landing-{name}", numbered, f"ord BIGINT, {schema}", name)
