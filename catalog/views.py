"""Input views and contracts that several queries share. The SQL texts run on both engines."""

from __future__ import annotations

import dataclasses

from contractframe.contract import Contract, Field, contract_from_dict

# Orders as a delimited file would give them: all text, with faults.
RAW_ORDERS = """
SELECT o_orderkey AS _row_id,
       cast(o_orderkey AS string) AS order_no,
       CASE WHEN o_orderstatus = 'P' THEN cast(o_custkey AS string) || '.0'
            WHEN o_custkey = 13 THEN 'unknown'
            WHEN o_custkey = 14 THEN NULL
            ELSE cast(o_custkey AS string) END AS cust,
       CASE WHEN o_custkey = 15 THEN 'X' ELSE o_orderstatus END AS status,
       CASE WHEN o_custkey = 16 THEN '12,5'
            WHEN o_custkey = 17 THEN 'nan'
            ELSE cast(o_totalprice AS string) END AS total,
       CASE WHEN o_custkey = 18 THEN 'not a date'
            WHEN o_orderstatus = 'F' THEN substr(cast(o_orderdate AS string), 6, 2) || '/' ||
                 substr(cast(o_orderdate AS string), 9, 2) || '/' || substr(cast(o_orderdate AS string), 1, 4)
            ELSE cast(o_orderdate AS string) END AS placed,
       CASE WHEN o_orderstatus = 'O' THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END AS priority_text,
       'left over' AS remark
FROM {orders}
"""

# The same rows with the types of the contract; null where the text does not fit.
TYPED_ORDERS = """
SELECT o_orderkey AS _row_id, o_orderkey AS order_id,
       CASE WHEN o_orderstatus <> 'P' AND o_custkey IN (13, 14) THEN NULL ELSE o_custkey END AS customer_id,
       CASE WHEN o_custkey = 15 THEN 'X' ELSE o_orderstatus END AS status,
       CASE WHEN o_custkey IN (16, 17) THEN NULL ELSE o_totalprice END AS total,
       CASE WHEN o_custkey = 18 THEN NULL ELSE o_orderdate END AS placed,
       CASE WHEN o_orderstatus = 'O' THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END AS priority
FROM orders
"""

ORDERS: Contract = contract_from_dict(
    {
        "dataset": {"name": "orders", "grain": "one row per order", "source": "order entry"},
        "fields": [
            {"name": "order_id", "label": "Order", "type": "identifier", "dtype": "Int64", "source_column": "order_no"},
            {"name": "customer_id", "label": "Customer", "type": "integer", "dtype": "Int64", "source_column": "cust"},
            {"name": "status", "label": "Status", "type": "categorical", "dtype": "string",
             "allowed_values": ["O", "F", "P"]},
            {"name": "total", "label": "Total price", "type": "decimal", "dtype": "float64", "nullable": True,
             "min": 0, "max": 495000, "null_tolerance": 0.01},
            {"name": "placed", "label": "Date placed", "type": "date", "dtype": "datetime64[ns]"},
            {"name": "priority", "label": "Priority", "type": "text", "dtype": "string",
             "pattern": r"\s*[1-5]-", "source_column": "priority_text", "notes": "ask jane@example.com"},
        ],
        "derived_fields": [
            {"name": "customer_total", "label": "All orders of the customer", "type": "decimal", "dtype": "float64",
             "transformation": "groupby(customer_id).total.sum()"},
            {"name": "customer_orders", "label": "Orders of the customer", "type": "integer", "dtype": "Int64",
             "transformation": "groupby(customer_id).size()"},
            {"name": "share", "label": "Share of the customer's total", "type": "decimal", "dtype": "float64",
             "transformation": "total / customer_total"},
        ],
    }
)


def orders_rule(field: str, **rules) -> Contract:
    """A contract of the one orders field, with these rules alone."""
    base = ORDERS.names().fields[field]
    bare = dataclasses.replace(base, allowed_values=None, min=None, max=None, pattern=None, nullable=True)
    return Contract(fields=[dataclasses.replace(bare, **rules)])


# One row per order with column pairs for the cross-column checks.
PAIRS = """
SELECT o_orderkey AS _row_id,
       o_orderdate AS start_date, max(l_shipdate) AS end_date,
       min(l_shipdate) AS open_ship, o_orderdate AS close_ship,
       o_orderdate AS created_at, min(l_shipdate) AS updated_at,
       min(l_extendedprice) AS min_price, o_totalprice AS max_price,
       max(l_quantity) AS low, 45.0 AS high,
       CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS account,
       o_custkey AS billed_account,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS person,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS company
FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_orderdate, o_totalprice, o_orderstatus, o_custkey, o_orderpriority
"""

# Values that may be personal data, one per customer.
VALUES = """
SELECT c_custkey AS _row_id,
       CASE c_mktsegment
            WHEN 'BUILDING' THEN ' user.' || cast(c_custkey AS string) || '@example.com '
            WHEN 'MACHINERY' THEN '123-45-' || lpad(cast(c_custkey AS string), 4, '0')
            WHEN 'HOUSEHOLD' THEN '+1 (555) 010-' || lpad(cast(c_custkey AS string), 4, '0')
            WHEN 'AUTOMOBILE' THEN CASE WHEN c_nationkey < 8 THEN '4111 1111-1111' || lpad(cast(c_custkey AS string), 4, '0')
                                        WHEN c_nationkey < 16 THEN 'Visa Ending in 41' || lpad(cast(c_nationkey AS string), 2, '0')
                                        ELSE '..' || cast(1000 + c_custkey AS string) END
            ELSE CASE WHEN c_nationkey < 5 THEN '2024-03-28'
                      WHEN c_nationkey < 10 THEN 'Mary Ann O''Neil-' || substr('ABCDE', c_nationkey - 4, 1)
                      WHEN c_nationkey < 15 THEN '=SUM(A1:A' || cast(c_custkey AS string) || ')'
                      WHEN c_nationkey < 20 THEN '-' || c_name
                      WHEN c_nationkey < 22 THEN '$1,' || lpad(cast(c_nationkey AS string), 3, '0') || '.50%'
                      ELSE c_name END
       END AS value
FROM {customer}
"""
