"""Hand-written tables for edge cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ratelattice.schemas import TABLES, columns_of
from ratelattice.sources.tables import RateTables

DAY = dt.datetime(2024, 1, 1)


def day(n: int) -> dt.datetime:
    return DAY + dt.timedelta(days=n)


def rate(text) -> Decimal | None:
    return None if text is None else Decimal(str(text)).quantize(Decimal("0.0001"))


def frame(spark, schema: str, rows: list[dict]):
    names = [name for name, _ in columns_of(schema)]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


class TinyTables(RateTables):
    """Tables given as lists of dicts; the ones left out are empty."""

    def __init__(self, spark, **tables):
        super().__init__(spark, "memory")
        self._rows = tables

    def __getattr__(self, name):
        if name not in TABLES:
            raise AttributeError(name)
        return frame(self.spark, TABLES[name], self._rows.get(name, []))


def categories(*ids):
    return [{"id": i, "name": f"C{i}", "is_active": 1} for i in ids]


def nodes(*rows, parent="parent_id"):
    """(id, parent, name, active) tuples."""
    return [{"id": i, parent: p, "name": n, "is_active": a} for i, p, n, a in rows]


def entry(id, line, r, l2=None, l3=None):
    return {"id": id, "product_line_id": line, "rate": rate(r), "l2_id": l2, "l3_id": l3, "created_on": DAY}


def line(id, code=None, sub=1, active=1, base="1"):
    return {"id": id, "code": code or f"PL{id}", "business_sub_category_id": sub, "is_active": active, "base_rate": rate(base), "color_code_id": 1}


def change(id, e, n, r, old=None):
    return {"id": id, "rate_entry_id": e, "created_on": day(n), "rate": rate(r), "old_rate": rate(old or r), "attachment_id": 1, "created_by": "u", "note": "n"}


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
