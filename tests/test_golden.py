"""Hand-worked cases of every kind of message, on tables of the shapes in spec.py."""

from helpers import RAW_SCHEMA, SENTINEL, envelope, raw_rows
from tidemark.functions.envelope import parse_envelope
from tidemark.operators.apply import apply_changes, archive_rows, project
from tidemark.operators.journal import to_messages
from tidemark.spec import CUSTOMERS, ORDERS, PRODUCTS, PRODUCTS_ON_HAND, REFERENCE_TABLES

MIRA = ('{"id": 7, "first_name": "Mira", "last_name": "Holt", "email": "mira@example.org",'
        ' "valid_from": 1700000000000000100, "valid_to": -4852116231933722724}')
MIRA_2 = ('{"id": 7, "first_name": "Mira", "last_name": "Holt-Vane", "email": "mira@example.org",'
          ' "valid_from": 1700000100000000300, "valid_to": -4852116231933722724}')
OTTO = ('{"id": 12, "first_name": "Otto", "last_name": "Brandt", "email": "otto@example.org",'
        ' "valid_from": 1700000000500000000, "valid_to": -4852116231933722724}')


def _messages(spark, envelopes):
    raw = spark.createDataFrame(raw_rows(envelopes), RAW_SCHEMA)
    return to_messages(parse_envelope(raw), REFERENCE_TABLES)


def _seed(spark, spec, images):
    import json
    rows = [json.loads(i) for i in images]
    return spark.createDataFrame(rows, spec.row_schema) if rows else None


def test_customer_update_and_delete(spark):
    msgs = _messages(spark, [
        envelope("r", "customers", 1700000050000000000, None, MIRA),    # snapshot read: never applied
        envelope("r", "customers", 1700000050000000000, None, OTTO),
        envelope("u", "customers", 1700000100004000000, MIRA, MIRA_2),
        envelope("d", "customers", 1700000200000000000, OTTO, None),
        None,                                                           # tombstone after the delete
    ])
    cur = apply_changes(_seed(spark, CUSTOMERS, [MIRA, OTTO]), msgs, CUSTOMERS).collect()
    assert [(r.id, r.last_name, r.valid_from, r.valid_to) for r in cur] == [(7, "Holt-Vane", 1700000100000000300, SENTINEL)]
    arch = sorted((r.id, r.last_name, r.valid_from, r.valid_to, r.deleted)
                  for r in archive_rows(msgs, CUSTOMERS).collect())
    assert arch == [(7, "Holt", 1700000000000000100, 1700000100000000300, False),
                    (12, "Brandt", 1700000000500000000, 1700000200000000000, True)]


def test_snapshot_reads_apply_nothing(spark):
    msgs = _messages(spark, [envelope("r", "customers", 1, None, MIRA), envelope("r", "customers", 1, None, OTTO)])
    assert apply_changes(None, msgs, CUSTOMERS).count() == 0


def _product(ident, name, weight, start):
    return f'{{"id": {ident}, "name": "{name}", "description": null, "weight": {weight}, "valid_from": {start}, "valid_to": {SENTINEL}}}'


def test_product_create_twice_update_delete(spark):
    lamp, lamp_again, rope, rope_2 = _product(50, "lamp", 1.5, 300), _product(50, "other lamp", 1.6, 301), _product(9, "rope", 4, 100), \
        _product(9, "long rope", 5, 400)
    created = _messages(spark, [envelope("c", "products", 310, None, lamp), envelope("c", "products", 320, None, lamp_again)])
    cur = apply_changes(_seed(spark, PRODUCTS, [rope.replace("4,", "4.0,")]), created, PRODUCTS)
    assert sorted((r.id, r.name) for r in cur.collect()) == [(9, "rope"), (50, "lamp")]
    later = _messages(spark, [envelope("u", "products", 410, rope, rope_2), envelope("d", "products", 500, lamp, None)])
    cur2 = apply_changes(cur, later, PRODUCTS).collect()
    assert [(r.id, r.name) for r in cur2] == [(9, "long rope")]
    arch = sorted((r.id, r.valid_from, r.valid_to, r.deleted) for r in archive_rows(later, PRODUCTS).collect())
    assert arch == [(9, 100, 400, False), (50, 300, 500, True)]


def test_on_hand_keyed_by_product_id(spark):
    stock = lambda p, q, start: f'{{"product_id": {p}, "quantity": {q}, "valid_from": {start}, "valid_to": {SENTINEL}}}'
    msgs = _messages(spark, [envelope("u", "products_on_hand", 65, stock(3, 20, 10), stock(3, 19, 60)),
                             envelope("d", "products_on_hand", 70, stock(4, 8, 11), None)])
    keys = sorted((r.key_id, r.operation) for r in msgs.collect())
    assert keys == [(3, "u"), (4, "d")]
    cur = apply_changes(_seed(spark, PRODUCTS_ON_HAND, [stock(3, 20, 10), stock(4, 8, 11)]), msgs, PRODUCTS_ON_HAND).collect()
    assert [(r.product_id, r.quantity) for r in cur] == [(3, 19)]
    arch = sorted((r.product_id, r.quantity, r.valid_to, r.deleted)
                  for r in archive_rows(msgs, PRODUCTS_ON_HAND).collect())
    assert arch == [(3, 20, 60, False), (4, 8, 70, True)]


def test_order_image_wire_date(spark):
    import datetime
    # fixed value: wire day 16816 is 2016-01-16
    img = '{"id":5,"order_date":16816,"purchaser":7,"quantity":2,"product_id":9,"valid_from":1,"valid_to":-4852116231933722724}'
    msgs = _messages(spark, [envelope("c", "orders", 5, None, img)])
    cur = project(apply_changes(None, msgs, ORDERS), ORDERS).collect()
    assert cur[0].order_date == datetime.date(2016, 1, 16)


def test_archive_topic_messages_match_no_route(spark):
    msgs = _messages(spark, [envelope("c", "customers_archive", 7, None, MIRA)])
    for spec in REFERENCE_TABLES:
        assert apply_changes(None, msgs, spec).count() == 0
    row = msgs.collect()[0]
    assert row.key_id == 7 and row.event_time == -4852116231933722724   # event time = after.valid_to
