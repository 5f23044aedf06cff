import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from deliveries import records  # noqa: E402
from starmart.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]").appName("starmart-tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")   # small deliveries need few tasks
        .config("spark.driver.memory", os.environ.get("TEST_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def shop():
    """A small clean delivery: three products, two users, three carts with five lines."""
    product = lambda i, title, price, category, rate, count: {
        "id": i, "title": title, "price": price, "category": category, "description": f" about {i} ",
        "image": f"http://img/{i}.png", "rating": {"rate": rate, "count": count}}
    user = lambda i, email, first, last, street, number: {
        "id": i, "email": email, "username": f"User{i} ", "password": "hidden",
        "name": {"firstname": first, "lastname": last}, "phone": f"1-{i}",
        "address": {"city": "green  hill", "street": street, "number": number, "zipcode": "10-1",
                    "geolocation": {"lat": "-37.3159", "long": "81.1496"}}}
    cart = lambda i, u, day, *lines: {
        "id": i, "userId": u, "date": day, "products": [{"productId": p, "quantity": q} for p, q in lines]}
    return {
        "products": [
            product(1, "  Walking   Bag ", 109.95, "Men's Clothing", 3.9, 120),
            product(2, "Plain Shirt", 22.3, "men's clothing", 4.1, 259),
            product(3, "Gold Ring", 64, "jewelery", 4.6, 400),
        ],
        "users": [
            user(1, "John.Doe@Gmail.com", "john", "doe", "new road", 7682),
            user(2, "m@mail.org", "mary ann", "o'neil", "kilcoole", 7),
        ],
        "carts": [
            cart(1, 1, "2020-03-02T00:00:00.000Z", (1, 4), (2, 1)),
            cart(2, 1, "2020-03-04T00:00:00.000Z", (3, 2)),
            cart(3, 2, "2020-03-10T00:00:00.000Z", (1, 1), (3, 6)),
        ],
    }


@pytest.fixture
def deliver(spark):
    return lambda shop: {entity: records(spark, rows) for entity, rows in shop.items()}
