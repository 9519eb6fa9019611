"""Seed rows of the reference's source databases, as bronze batches.

Fixed values: the seed inserts of the retailer and supplier databases
(categories, products, customers, orders, order items, suppliers, product
suppliers), in their original order.
"""

from __future__ import annotations

from tierline.schemas import REGISTRY

# Every seed row was inserted at one instant (the column defaults).
T0 = "1743069600000"

CATEGORIES = [
    (1, "Electronics"), (2, "Clothing"), (3, "Home Appliances"), (4, "Books"), (5, "Toys"),
    (6, "Furniture"), (7, "Sports"), (8, "Health & Beauty"), (9, "Automotive"), (10, "Grocery"),
]

PRODUCTS = [
    (101, "Laptop", 1, 1000.00), (102, "T-Shirt", 2, 20.00), (103, "Refrigerator", 3, 500.00),
    (104, "Novel", 4, 15.00), (105, "Doll", 5, 25.00), (106, "Sofa", 6, 300.00),
    (107, "Football", 7, 30.00), (108, "Shampoo", 8, 10.00), (109, "Car Tire", 9, 100.00),
    (110, "Rice Bag", 10, 40.00), (111, "Headphones", 1, 150.00), (112, "Jeans", 2, 50.00),
    (113, "Microwave", 3, 200.00), (114, "Comic Book", 4, 12.00), (115, "Toy Car", 5, 35.00),
    (116, "Dining Table", 6, 450.00), (117, "Basketball", 7, 25.00), (118, "Perfume", 8, 60.00),
    (119, "Engine Oil", 9, 45.00), (120, "Coffee Beans", 10, 20.00),
]

CUSTOMERS = [
    (1, "John Doe", "john@example.com"), (2, "Jane Smith", "jane@example.com"),
    (3, "Michael Johnson", "michael@example.com"), (4, "Emily Davis", "emily@example.com"),
    (5, "David Wilson", "david@example.com"), (6, "Sarah Miller", "sarah@example.com"),
    (7, "Daniel Anderson", "daniel@example.com"), (8, "Olivia Thomas", "olivia@example.com"),
    (9, "James Martinez", "james@example.com"), (10, "Emma Hernandez", "emma@example.com"),
]

ORDERS = [
    (1001, 1, 1020.00), (1002, 2, 20.00), (1003, 3, 150.00), (1004, 4, 35.00), (1005, 5, 60.00),
    (1006, 6, 450.00), (1007, 7, 200.00), (1008, 8, 75.00), (1009, 9, 120.00), (1010, 10, 90.00),
]

ORDER_ITEMS = [
    (1, 1001, 101, 1, 1000.00), (2, 1001, 102, 1, 20.00), (3, 1002, 102, 1, 20.00),
    (4, 1003, 111, 1, 150.00), (5, 1004, 115, 1, 35.00), (6, 1005, 118, 1, 60.00),
    (7, 1006, 116, 1, 450.00), (8, 1007, 113, 1, 200.00), (9, 1008, 120, 1, 75.00),
    (10, 1009, 119, 1, 120.00),
]

SUPPLIERS = [
    (1, "ABC Suppliers", "John Doe", "+1-555-1234", "john@abc.com", "123 Main St", "New York", "USA"),
    (2, "Global Distributors", "Alice Smith", "+44-203-4567", "alice@global.com", "456 High St", "London", "UK"),
    (3, "Asian Traders", "Raj Kumar", "+91-9876543210", "raj@asian.com", "789 MG Road", "Mumbai", "India"),
    (4, "Tech Supplies Ltd", "Mike Johnson", "+1-555-6789", "mike@techsupplies.com", "987 Elm St", "San Francisco", "USA"),
    (5, "Euro Parts", "Sophie Laurent", "+33-123-4567", "sophie@europarts.com", "32 Rue de Lyon", "Paris", "France"),
    (6, "Gulf Traders", "Omar Al-Farsi", "+971-50-1234567", "omar@gulftraders.com", "Al Maktoum St", "Dubai", "UAE"),
    (7, "Pacific Imports", "Lily Chen", "+86-21-98765432", "lily@pacificimports.com", "456 Nanjing Road", "Shanghai", "China"),
]

PRODUCT_SUPPLIERS = [
    (1, 101, 12.50), (1, 102, 15.00), (2, 103, 10.75), (3, 101, 11.25), (3, 104, 9.90),
    (4, 105, 14.30), (5, 106, 13.20), (6, 107, 16.40), (7, 108, 18.75), (8, 109, 12.85),
]


def bronze(spark):
    """The seed as bronze batches (instants as epoch-ms text)."""
    mk = lambda name, data: spark.createDataFrame(data, REGISTRY[name].schema)
    return {
        "categories": mk("categories", [(i, n, T0) for i, n in CATEGORIES]),
        "products": mk("products", [(i, n, c, p, T0) for i, n, c, p in PRODUCTS]),
        "customers": mk("customers", [(i, n, e, T0) for i, n, e in CUSTOMERS]),
        "orders": mk("orders", [(i, c, T0, a, T0) for i, c, a in ORDERS]),
        "order_items": mk("order_items", [(i, o, p, q, pr, T0) for i, o, p, q, pr in ORDER_ITEMS]),
        "suppliers": mk("suppliers", [row + (T0,) for row in SUPPLIERS]),
        "product_suppliers": mk("product_suppliers", [(s, p, pr, T0) for s, p, pr in PRODUCT_SUPPLIERS]),
        "customer_reviews": mk("customer_reviews", []),
    }


def source(spark):
    """The seed in source shape (instants as TIMESTAMP), as an OLTP database holds it."""
    from pyspark.sql import functions as F

    from tierline.functions.time import parse_event_ts
    out = {}
    for name, df in bronze(spark).items():
        spec = REGISTRY[name]
        cols = []
        for f in spec.schema.fields:
            c = F.col(f.name)
            if f.name in ("updated_at", "created_at", "last_updated", "order_date", "review_date"):
                c = parse_event_ts(c)
            cols.append(c.alias(f.name))
        out[name] = df.select(cols)
    return out
