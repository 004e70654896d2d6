"""The gold tables on random logs full of NULLs and ties, against plain SQL over the same rows."""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from tests.conftest import rows_of
from tidemart.plans import order_items_fact, product_dimension, sales_report
from tidemart.slices import Slice

ITEM_KINDS = dict(
    id="long", order_id="long", user_id="long", product_id="long", inventory_item_id="long", status="string",
    created_at="timestamp_ntz", updated_at="timestamp_ntz", shipped_at="timestamp_ntz", delivered_at="timestamp_ntz",
    returned_at="timestamp_ntz", sale_price="double",
)
PRODUCT_KINDS = dict(id="long", brand="string", department="string", category="string", updated_at="timestamp_ntz")
DUCK = {"long": "bigint", "string": "varchar", "timestamp_ntz": "timestamp", "double": "double"}


def random_rows(rng):
    def when(chance=0.85):
        return datetime(2024, 1, 1) + timedelta(hours=6 * rng.randrange(32)) if rng.random() < chance else None

    def some(values, chance=0.9):
        return rng.choice(values) if rng.random() < chance else None

    items = []
    for _ in range(120):
        updated = when(0.95)
        returned = some([updated, when()], 0.4)
        delivered = some([updated, when()], 0.8)
        items.append(
            (
                some(range(25), 0.97), 1, 1, some(range(6)), some(range(3)), some("ab"), when(0.9), updated, None,
                delivered, returned, some([1.25, 10.0, 3.1], 0.95),
            )
        )
    products = [
        (some(range(6), 0.95), some(["p", "q"]), some(["Men", "Women"]), some("xyz"), when(0.95)) for _ in range(60)
    ]
    return items + items[:5], products + products[:3]


def load(spark, duck, name, rows, kinds):
    duck.execute(f"create or replace table {name} ({', '.join(f'{c} {DUCK[k]}' for c, k in kinds.items())})")
    duck.executemany(f"insert into {name} values ({', '.join('?' * len(kinds))})", rows)
    return spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def latest_sql(table, kinds, window):
    rest = ", ".join(f"{c} nulls last" for c in kinds if c not in ("id", "updated_at"))
    return f"""select {', '.join(kinds)} from (
        select *, row_number() over (partition by id, cast(updated_at as date) order by updated_at desc nulls last, {rest}) n
        from {table} where {window}) where n = 1"""


def report_sql(window, rank_by):
    return f"""
    with fact as ({latest_sql('items', ITEM_KINDS, "updated_at >= timestamp '2020-01-01'")}),
         dim as ({latest_sql('products', PRODUCT_KINDS, "updated_at >= timestamp '2000-01-01'")}),
         sales as (select *, row_number() over () as line from fact
                   where {window} and delivered_at is not null
                     and (cast(delivered_at as date) = cast(updated_at as date)
                          or cast(returned_at as date) = cast(updated_at as date)))
    select cast(updated_at as date) as sales_date, category, brand, department,
           cast(sum(case when returned_at is not null then -cast(sale_price as decimal(18,4))
                         else cast(sale_price as decimal(18,4)) end) as double) as total_sales
    from (select s.updated_at, d.category, d.brand, d.department, s.sale_price, s.returned_at,
                 row_number() over (partition by {rank_by}
                                    order by d.updated_at desc nulls last, s.updated_at desc nulls last) as n
          from sales s left join dim d on s.product_id = d.id and s.created_at >= d.updated_at)
    where n = 1 group by all"""


@pytest.mark.parametrize("seed", range(5))
def test_gold_on_random_logs(spark, seed):
    duck = duckdb.connect()
    items, products = random_rows(random.Random(seed))
    item_log = load(spark, duck, "items", items, ITEM_KINDS)
    product_log = load(spark, duck, "products", products, PRODUCT_KINDS)
    fact = order_items_fact(item_log, Slice.since("2020-01-01"))
    dim = product_dimension(product_log, Slice.since("2000-01-01"))
    sql = lambda text: sorted(duck.execute(text).fetchall(), key=repr)
    assert rows_of(fact) == sql(latest_sql("items", ITEM_KINDS, "updated_at >= timestamp '2020-01-01'"))
    assert rows_of(dim) == sql(latest_sql("products", PRODUCT_KINDS, "updated_at >= timestamp '2000-01-01'"))
    everything, day = "updated_at >= timestamp '2020-01-01'", "cast(updated_at as date) = date '2024-01-03'"
    assert rows_of(sales_report(fact, dim, Slice.since("2020-01-01"))) == sql(report_sql(everything, "s.line"))
    assert rows_of(sales_report(fact, dim, Slice.since("2020-01-01"), "item")) == sql(report_sql(everything, "s.id"))
    assert rows_of(sales_report(fact, dim, Slice.day("2024-01-03"))) == sql(report_sql(day, "s.line"))
    duck.close()
